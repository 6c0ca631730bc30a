"""Nested picks, text forms and fallbacks."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.catalog import Registry, hists, query
from checks.recipes import address_part as part_sql
from checks.recipes import address_text
from orgtrail.functions import addresses as A
from orgtrail.functions.activities import activity_codes, clean_codes, principal_activity
from orgtrail.functions.countries import addr, country_field, first_country, norm_country
from orgtrail.functions.mandates import rep_status, rep_type, rep_type_by_pid
from orgtrail.functions.names import first_name_of, first_nonempty, legal_status, lookup_name, rep_last_name
from orgtrail.functions.records import account_export, establishment_export, publication_export
from orgtrail.functions.text import or_empty
from orgtrail.operators.joins import enrich
from orgtrail.operators.nested import (
    flatten_mandate,
    flatten_participation,
    flatten_profit_loss,
    persons_slim,
)
from orgtrail.plans.portfolio import latest_accounts, org_export

CREATED_AT = datetime(2024, 1, 31, 12, 0, 0)


def entries(r: Registry) -> DataFrame:
    """Every history entry of every company, with its position."""
    return r.orgs().select("vat", F.posexplode("address_hists").alias("i", "hist"))


@query(
    "pick_address_language",
    "select vat, i, case when has_addr then street end as street, cc as country_code from org_hist",
)
def address_language(r: Registry):
    address = addr(F.col("hist"))
    return entries(r).select("vat", "i", address["street"].alias("street"), address["country_code"].alias("country_code"))


@query("pick_country_field", "select vat, i, cc_field as country from org_hist")
def country_by_field(r: Registry):
    return entries(r).select("vat", "i", country_field(F.col("hist")).alias("country"))


@query("norm_country", "select vat, i, upper(trim(coalesce(cc, ''))) as country from org_hist")
def normal_country(r: Registry):
    return entries(r).select("vat", "i", norm_country(addr(F.col("hist"))["country_code"]).alias("country"))


@query("first_nonempty_country", "select vat, country from org left join org_country using (vat)")
def first_nonempty_country(r: Registry):
    return r.orgs().select("vat", first_country(hists()).alias("country"))


def pick_sql(table: str) -> str:
    return f"""
select o.vat, cast(h.start_date as string) as start_date, cast(h.end_date as string) as end_date,
       case when h.has_addr then h.number end as number, h.cc as country_code
from org o left join {table} h on o.vat = h.vat"""


def picked(r: Registry, pick) -> DataFrame:
    shown = r.orgs().select("vat", pick(hists()).alias("hist"))
    return shown.select(
        "vat",
        "hist.start_date",
        "hist.end_date",
        addr(F.col("hist"))["number"].alias("number"),
        addr(F.col("hist"))["country_code"].alias("country_code"),
    )


@query("pick_latest_address", pick_sql("org_latest"))
def latest(r: Registry):
    return picked(r, A.latest_hist)


@query("pick_current_or_latest_address", pick_sql("org_current"))
def current_or_latest(r: Registry):
    return picked(r, A.current_or_latest_hist)


@query("pick_first_open_or_last", pick_sql("org_first_open"))
def first_open_or_last(r: Registry):
    return picked(r, A.first_open_or_last_hist)


@query("pick_previous_address", pick_sql("org_previous"))
def previous(r: Registry):
    return picked(r, A.previous_hist)


@query("pick_last_closed_address", pick_sql("org_last_closed"))
def last_closed(r: Registry):
    return picked(r, A.last_closed_hist)


@query("pick_last_address", pick_sql("org_last"))
def last(r: Registry):
    return picked(r, A.last_hist)


def text_sql(style: str) -> str:
    return f"select h.vat, h.i, {address_text(style, 'h')} as address from org_hist h"


def texts(r: Registry, style: str) -> DataFrame:
    return entries(r).select("vat", "i", A.fmt_address(addr(F.col("hist")), style).alias("address"))


@query("fmt_address_comma_trim", text_sql("comma_trim"))
def comma_trim(r: Registry):
    return texts(r, "comma_trim")


@query("fmt_address_comma_nulls", text_sql("comma_nulls"))
def comma_nulls(r: Registry):
    return texts(r, "comma_nulls")


@query("fmt_address_concat_ws", text_sql("concat_ws"))
def concat_ws(r: Registry):
    return texts(r, "concat_ws")


@query("fmt_address_comma_space", text_sql("comma_space"))
def comma_space(r: Registry):
    return texts(r, "comma_space")


@query("fmt_address_line", text_sql("line"))
def address_line(r: Registry):
    return texts(r, "line")


@query(
    "fmt_previous_address",
    f"select o.vat, {address_text('full', 'h')} as address from org o left join org_previous h on o.vat = h.vat",
)
def previous_address(r: Registry):
    previous_one = addr(A.previous_hist(hists()))
    return r.orgs().select("vat", previous_one.alias("previous")).select(
        "vat", A.fmt_address(F.col("previous"), "full").alias("address")
    )


@query(
    "extract_address_parts",
    f"select h.vat, h.i, {part_sql('zip_code', 'h')} as zip_code, {part_sql('cc', 'h')} as country, "
    f"{part_sql('city', 'h')} as city from org_hist h",
)
def address_parts(r: Registry):
    address = addr(F.col("hist"))
    return entries(r).select(
        "vat",
        "i",
        A.address_part(address, "zip_code").alias("zip_code"),
        A.address_part(address, "country_code").alias("country"),
        A.address_part(address, "city").alias("city"),
    )


@query("name_fallback_3", "select vat, coalesce(name_nl, name_fr, name, '') as shown from org")
def name_fallback_3(r: Registry):
    return r.orgs().select("vat", first_name_of(F.col("name_nl"), F.col("name_fr"), F.col("name")).alias("shown"))


@query(
    "name_fallback_nonempty",
    "select vat, case when name_nl <> '' then name_nl else coalesce(name_fr, '') end as shown from org",
)
def name_fallback_nonempty(r: Registry):
    return r.orgs().select("vat", first_nonempty(F.col("name_nl"), F.col("name_fr")).alias("shown"))


@query(
    "name_fallback_lookup",
    "select vat, coalesce(name_nl, '') as shown, coalesce(name_nl, name_fr, '') as with_fallback from org",
)
def name_fallback_lookup(r: Registry):
    nl, fr = F.col("name_nl"), F.col("name_fr")
    return r.orgs().select(
        "vat", lookup_name(nl, fr).alias("shown"), lookup_name(nl, fr, fallback=True).alias("with_fallback")
    )


@query(
    "default_empty_names",
    "select pid, coalesce(first_name, '') as first_name, coalesce(last_name, '') as last_name from person",
)
def default_empty_names(r: Registry):
    return r.persons().select(
        "pid", or_empty(F.col("first_name")).alias("first_name"), or_empty(F.col("last_name")).alias("last_name")
    )


@query("rep_last_name_fallback", "select pid, coalesce(last_name, name, '') as last_name from person")
def rep_last_name_fallback(r: Registry):
    return r.persons().select("pid", rep_last_name(F.col("last_name"), F.col("name")).alias("last_name"))


def principal_sql(table: str) -> str:
    return f"""
select o.vat, coalesce(a.code, '') as code, coalesce(a.description_nl, a.description_fr, '') as description
from org o left join {table} a on o.vat = a.vat"""


def principal(r: Registry, rule: str) -> DataFrame:
    return r.orgs().select("vat", principal_activity(F.col("activities"), rule).alias("a")).select("vat", "a.*")


@query("principal_activity_strict_then_any", principal_sql("principal_strict"))
def principal_strict(r: Registry):
    return principal(r, "strict")


@query("principal_activity_contains", principal_sql("principal_contains"))
def principal_contains(r: Registry):
    return principal(r, "contains")


@query(
    "clean_activity_codes",
    r"""
select 'establishment' as kind, cast(est_id as string) as key, 0 as pos, activity as code from establishment
where regexp_matches(activity, '[0-9]') and length(trim(activity)) between 1 and 10
union all
select 'organisation', vat, cast(row_number() over (partition by vat order by i) - 1 as int), code
from activity where regexp_matches(code, '[0-9]') and length(trim(code)) between 1 and 10""",
)
def clean_activity_codes(r: Registry):
    sites = r.establishments().select(
        F.lit("establishment").alias("kind"),
        F.col("est_id").cast("string").alias("key"),
        F.posexplode(clean_codes(F.col("activities"))).alias("pos", "code"),
    )
    orgs = r.orgs().select(
        F.lit("organisation").alias("kind"),
        F.col("vat").alias("key"),
        F.posexplode(activity_codes(F.col("activities"))).alias("pos", "code"),
    )
    return sites.unionByName(orgs)


@query(
    "rep_status_lower",
    "select vat, pid, role, cast(start_date as string) as start_date, "
    "case when end_date is null then 'current' else 'previous' end as status from mandate",
)
def rep_status_lower(r: Registry):
    return r.mandates().select("vat", "pid", "role", "start_date", rep_status(F.col("end_date")).alias("status"))


@query(
    "rep_status_upper",
    "select vat, pid, role, cast(start_date as string) as start_date, "
    "case when end_date is null then 'CURRENT' else 'PREVIOUS' end as status "
    "from org left join mandate using (vat)",
)
def rep_status_upper(r: Registry):
    rows = flatten_mandate(r.orgs_with_mandates().select("vat", "person_mandates"), outer=True)
    return rows.select("vat", "pid", "role", "start_date", rep_status(F.col("end_date"), upper=True).alias("status"))


@query(
    "rep_type_flag",
    "select pid, case when is_moral then 'moral' when not is_moral then 'physical' else '' end as type from person",
)
def rep_type_flag(r: Registry):
    return r.persons().select("pid", rep_type(F.col("is_moral")).alias("type"))


@query(
    "rep_type_by_pid",
    "select vat, pid, role, cast(start_date as string) as start_date, "
    "case when pid is not null then 'physical' else 'moral' end as type from mandate",
)
def rep_type_pid(r: Registry):
    return r.mandates().select("vat", "pid", "role", "start_date", rep_type_by_pid(F.col("pid")).alias("type"))


@query("legal_status_fallback", "select vat, coalesce(juridical_form, juridical_situation) as legal_status from org")
def legal_status_fallback(r: Registry):
    status = legal_status(F.col("juridical_form"), F.col("juridical_situation"))
    return r.orgs().select("vat", status.alias("legal_status"))


@query(
    "project_profit_loss",
    "select vat, cast(period_end_date as string) as period_end_date, year, turnover, ebitda, "
    "operating_profit, profit_after_tax, employees, schema_type, currency from annual_account",
)
def project_profit_loss(r: Registry):
    return flatten_profit_loss(r.accounts())


@query(
    "project_balance_sheet",
    "select vat, cast(period_end_date as string) as period_end_date, turnover, profit_after_tax as profit, "
    "ebitda, equity, land_buildings, financial_health as financial_health_indicator from annual_account",
)
def project_balance_sheet(r: Registry):
    return r.accounts().select("vat", F.explode(account_export(F.col("summaries"))).alias("a")).select("vat", "a.*")


@query(
    "project_establishment",
    "select vat, name_nl, name_fr, cast(start_date as string) as start_date, cast(end_date as string) as end_date, "
    "city_nl, city_fr, street, telephone, email, website, activity from establishment",
)
def project_establishment(r: Registry):
    return r.establishments().select("vat", establishment_export().alias("e")).select(
        "vat",
        "e.name_nl",
        "e.name_fr",
        "e.start_date",
        "e.end_date",
        F.col("e.address_nl.city").alias("city_nl"),
        F.col("e.address_fr.city").alias("city_fr"),
        F.coalesce("e.address_nl.street", "e.address_fr.street").alias("street"),
        "e.telephone",
        "e.email",
        "e.website",
        F.array_join("e.activities", "|").alias("activity"),
    )


@query(
    "project_publication",
    "select publication_number, cast(publication_date as string) as publication_date, pdf_link, language, source, "
    "coalesce(subject, '') as subjects, case when subject is null then 0 else 1 end as n_subjects from publication",
)
def project_publication(r: Registry):
    return r.publications().select(publication_export().alias("p")).select(
        "p.publication_number",
        "p.publication_date",
        "p.pdf_link",
        "p.language",
        "p.source",
        F.array_join("p.subjects", "|").alias("subjects"),
        F.size("p.subjects").alias("n_subjects"),
    )


@query(
    "project_org_export",
    f"""
select o.vat, o.name_nl, o.name_fr, cast(o.founding_date as string) as founding_date,
       coalesce(o.juridical_form, o.juridical_situation) as legal_status,
       o.financial_health as financial_health_score, o.employee_count as number_of_employees,
       case when not h.nl_null then h.city end as city_nl, case when not h.fr_null then h.city end as city_fr,
       coalesce(c.n, 0) as n_codes, 0 as n_establishments, 0 as n_publications,
       coalesce(a.n, 0) as n_accounts, '{CREATED_AT}' as created_at
from org o left join org_last h on o.vat = h.vat
left join (select vat, cast(count(code) as int) as n from activity group by vat) c on o.vat = c.vat
left join (select vat, cast(least(count(*), 5) as int) as n from annual_account group by vat) a on o.vat = a.vat""",
)
def project_org_export(r: Registry):
    orgs = enrich(r.orgs(), latest_accounts(r.accounts()))
    missing = orgs.withColumns(
        {
            "establishments": F.lit(None).cast("array<struct<name_nl: string>>"),
            "publications": F.lit(None).cast("array<struct<language: string>>"),
            "page": F.lit(0),
        }
    )
    return org_export(missing, CREATED_AT).select(
        "vat",
        "name_nl",
        "name_fr",
        "founding_date",
        "legal_status",
        "financial_health_score",
        "number_of_employees",
        F.col("address_nl.city").alias("city_nl"),
        F.col("address_fr.city").alias("city_fr"),
        F.size("nacebel_codes").alias("n_codes"),
        F.size("establishments").alias("n_establishments"),
        F.size("publications").alias("n_publications"),
        F.size("annual_account_summaries_5y").alias("n_accounts"),
        F.col("export_metadata_created_at").alias("created_at"),
    )


MANDATE_SQL = (
    'select vat, pid, category, role, "function", '
    "cast(start_date as string) as start_date, cast(end_date as string) as end_date from "
)


@query("project_mandate", MANDATE_SQL + "mandate")
def project_mandate(r: Registry):
    return flatten_mandate(r.orgs_with_mandates().select("vat", "person_mandates"))


@query(
    "project_participation",
    "select vat, related_vat, interests_type, percentage, source from participation",
)
def project_participation(r: Registry):
    return flatten_participation(r.orgs().select("vat", "participation_hists"))


@query("project_persons_slim", "select pid, first_name, last_name, name as person_name, is_moral from person")
def project_persons_slim(r: Registry):
    return persons_slim(r.persons())
