"""The reports, end to end."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.catalog import HOME, OTHER, SECTOR, TARGET, YEARS, Registry, query
from checks.recipes import address_part, address_text
from orgtrail.functions.mandates import ADMINISTER, SHAREHOLDER
from orgtrail.plans import owners, people
from orgtrail.plans.portfolio import portfolio
from orgtrail.plans.representatives import representatives
from orgtrail.plans.sector import sector_financials

CREATED_AT = datetime(2024, 1, 31, 12, 0, 0)


def people_sql(pick: str, style: str, test: str, blank: bool = False) -> str:
    shown = "coalesce(p.{0}, '') as {0}" if blank else "p.{0}"
    return f"""
select p.pid, {shown.format('first_name')}, {shown.format('last_name')}, {address_text(style, 'h')} as last_address
from person p join {pick} h on p.pid = h.pid
where p.pid in (select pid from person_hist where {test})"""


def company_columns(style: str, alias: str = "h") -> str:
    return f"o.vat, o.name_nl, o.name_fr, {address_text(style, alias)} as last_address_for_company"


LATEST_PEOPLE = people_sql("person_latest", "comma_trim", f"upper(trim(cc)) = '{TARGET}'", blank=True)
LAST_PEOPLE = people_sql("person_last", "comma_nulls", f"upper(cc) = '{TARGET}'")
FIELD_PEOPLE = people_sql("person_last", "concat_ws", f"upper(cc_field) = '{OTHER}'")


@query("country_persons_latest", LATEST_PEOPLE)
def country_persons_latest(r: Registry):
    return people.country_persons(r.persons(), TARGET, people.LATEST)


@query(
    "country_admins_home_companies",
    f"""
select x.*, {company_columns('comma_trim')}
from ({LATEST_PEOPLE}) x join mandate m on x.pid = m.pid join org o on m.vat = o.vat
left join org_latest h on h.vat = o.vat
where upper(trim(m.role)) in ('ADMINISTER', 'ADMINISTRATOR')
  and o.vat in (select vat from org_hist where upper(trim(cc)) = '{HOME}')""",
)
def country_admins_home_companies(r: Registry):
    return people.country_admins(r.persons(), r.orgs_with_mandates(), TARGET, HOME)


def ownership_sql(owner: str, owned: str) -> str:
    return f"""
select p.vat as owner_vat, coalesce(a.name_nl, '') as owner_name, ca.country as owner_country,
       p.related_vat as owned_vat, coalesce(b.name_nl, '') as owned_name, cb.country as owned_country
from participation p join org a on p.vat = a.vat join org b on p.related_vat = b.vat
join org_country ca on ca.vat = a.vat join org_country cb on cb.vat = b.vat
where ca.country in ({owner}) and cb.country in ({owned})"""


@query("ownership_home_owns_target", ownership_sql(f"'{HOME}', ''", f"'{TARGET}'"))
def ownership_home_owns_target(r: Registry):
    return owners.ownership(r.orgs(), [HOME, ""], [TARGET])


@query("ownership_target_owns_home", ownership_sql(f"'{TARGET}'", f"'{HOME}', ''"))
def ownership_target_owns_home(r: Registry):
    return owners.ownership(r.orgs(), [TARGET], [HOME, ""])


@query("country_persons_last", LAST_PEOPLE.replace("select p.pid", "select distinct p.pid"))
def country_persons_last(r: Registry):
    return people.country_persons(r.persons(), TARGET, people.LAST)


@query(
    "country_companies_last",
    f"""
select distinct {company_columns('comma_nulls')} from org o join org_last h on h.vat = o.vat
where o.vat in (select vat from org_hist where upper(cc) = '{TARGET}')""",
)
def country_companies_last(r: Registry):
    return people.country_companies(r.orgs(), TARGET)


@query(
    "country_mandates_dated",
    f"""
select distinct x.*, {company_columns('comma_nulls')}, m.category as mandate_category,
       cast(m.start_date as string) as mandate_start_date, cast(m.end_date as string) as mandate_end_date
from ({LAST_PEOPLE}) x join mandate m on x.pid = m.pid join org o on m.vat = o.vat
left join org_last h on h.vat = o.vat
where o.vat in (select vat from mandate where category = 'ADMINISTER')""",
)
def country_mandates_dated(r: Registry):
    return people.country_mandates(r.persons(), r.orgs_with_mandates(), TARGET, [ADMINISTER], "org")


@query(
    "sector_financials",
    f"""
select o.vat, o.name_nl, o.name_fr, coalesce(o.juridical_form, o.juridical_situation) as legal_status,
       cast(o.founding_date as string) as founding_date, a.year, cast(a.period_end_date as string) as period_end_date,
       a.schema_type, a.currency, a.turnover, a.ebitda, a.operating_profit, a.profit_after_tax, a.employees
from org o left join (select * from annual_account where year between {YEARS[0]} and {YEARS[1]}) a on o.vat = a.vat
where o.vat in (select vat from activity where code like '{SECTOR}%')
order by o.vat, a.year""",
)
def sector(r: Registry):
    return sector_financials(r.orgs(), r.accounts(), SECTOR, *YEARS)


@query("cc_persons", FIELD_PEOPLE.replace("select p.pid", "select distinct p.pid"))
def cc_persons(r: Registry):
    return people.country_persons(r.persons(), OTHER, people.FIELD)


@query(
    "cc_admin_shareholder_companies",
    f"""
select x.*, {company_columns('concat_ws')}
from ({FIELD_PEOPLE}) x join mandate m on x.pid = m.pid join org o on m.vat = o.vat
left join org_last h on h.vat = o.vat
where m.category in ('ADMINISTER', 'SHAREHOLDER')""",
)
def cc_admin_shareholder_companies(r: Registry):
    wanted = [ADMINISTER, SHAREHOLDER]
    return people.country_mandates(r.persons(), r.orgs_with_mandates(), OTHER, wanted, "mandate")


def links_sql(home_key: str, target_key: str) -> str:
    return f"""
select b.vat as vat_home, b.name_nl as name_nl_home, b.name_fr as name_fr_home, t.vat, t.name_nl, t.name_fr,
       {address_text('concat_ws', 'h')} as last_address, p.interests_type as type, p.percentage, p.source
from participation p join org b on p.{home_key} = b.vat join org t on p.{target_key} = t.vat
left join org_last h on h.vat = t.vat
where b.vat in (select vat from org_hist where upper(cc_field) in ('{HOME}', ''))
  and t.vat in (select vat from org_hist where upper(cc_field) = '{OTHER}')"""


@query("cc_target_owned_by_home", links_sql("vat", "related_vat"))
def cc_target_owned_by_home(r: Registry):
    return owners.participation_links(r.orgs(), OTHER, HOME, owner="home")


@query("cc_home_owned_by_target", links_sql("related_vat", "vat"))
def cc_home_owned_by_target(r: Registry):
    return owners.participation_links(r.orgs(), OTHER, HOME, owner="target")


@query(
    "vat_representatives",
    f"""
select o.vat, coalesce(o.name_nl, o.name_fr, o.name, '') as name, {address_text('line', 'c')} as address,
       {address_part('zip_code', 'c')} as postcode, {address_part('cc', 'c')} as country,
       coalesce(a.code, '') as principal_code, coalesce(a.description_nl, a.description_fr, '') as principal_description,
       coalesce(p.first_name, '') as representative_first_name,
       coalesce(p.last_name, p.name, '') as representative_last_name,
       case when p.is_moral then 'moral' when not p.is_moral then 'physical' else '' end as representative_type,
       case when m.end_date is null then 'current' else 'previous' end as representative_status,
       {address_text('full', 'b')} as additional_address
from org o join keys k on k.vat = o.vat
left join org_current c on c.vat = o.vat left join org_previous b on b.vat = o.vat
left join principal_strict a on a.vat = o.vat
left join mandate m on m.vat = o.vat left join person p on p.pid = m.pid""",
)
def vat_representatives(r: Registry):
    return representatives(r.orgs_with_mandates(), r.persons(), r.keys(), "file")


@query(
    "vat_list_representatives",
    f"""
select o.vat as vat_id, case when o.name_nl <> '' then o.name_nl else coalesce(o.name_fr, '') end as name,
       {address_text('comma_space', 'c')} as address,
       {address_part('zip_code', 'c')} as postcode, {address_part('cc', 'c')} as country,
       coalesce(a.code, '') as principal_code, coalesce(a.description_nl, a.description_fr, '') as principal_description,
       p.first_name as rep_first_name, p.last_name as rep_last_name,
       case when m.pid is not null then 'physical' else 'moral' end as rep_type,
       case when m.end_date is null then 'CURRENT' else 'PREVIOUS' end as rep_status,
       {address_text('comma_space', 'b')} as additional_address, m.category as rep_category,
       cast(m.start_date as string) as rep_start_date, cast(m.end_date as string) as rep_end_date
from org o join keys k on k.vat = o.vat
left join org_first_open c on c.vat = o.vat left join org_last_closed b on b.vat = o.vat
left join principal_contains a on a.vat = o.vat
left join mandate m on m.vat = o.vat left join person p on p.pid = m.pid""",
)
def vat_list_representatives(r: Registry):
    return representatives(r.orgs_with_mandates(), r.persons(), r.keys(), "list")


@query(
    "portfolio_enriched",
    f"""
select o.vat, 0 as page, o.name_nl, o.name_fr, cast(o.founding_date as string) as founding_date,
       coalesce(o.juridical_form, o.juridical_situation) as legal_status,
       o.financial_health as financial_health_score, o.employee_count as number_of_employees,
       case when not h.nl_null then h.city end as city_nl, case when not h.fr_null then h.city end as city_fr,
       '{CREATED_AT}' as created_at, x.part, x.pos, x.label, x.day, x.amount
from org o join keys k on k.vat = o.vat left join org_last h on h.vat = o.vat
join (
  select vat, 'company' as part, 0 as pos, cast(null as string) as label, cast(null as string) as day, cast(null as double) as amount from org
  union all
  select vat, 'code', cast(row_number() over (partition by vat order by i) - 1 as int), code, null, null
  from activity where code is not null
  union all
  select vat, 'establishment', cast(row_number() over (partition by vat order by start_date nulls first, est_id) - 1 as int),
         name_nl, cast(start_date as string), null from establishment
  union all
  select vat, 'publication', cast(row_number() over (partition by vat order by publication_date, publication_number) - 1 as int),
         publication_number, cast(publication_date as string), null from ranked_publication where latest <= 50
  union all
  select vat, 'account', cast(row_number() over (partition by vat order by period_end_date) - 1 as int),
         null, cast(period_end_date as string), turnover from ranked_account where latest <= 5
) x on x.vat = o.vat""",
)
def portfolio_enriched(r: Registry):
    """The nested documents, unfolded to one row per array item and one per company."""
    documents = portfolio(
        r.orgs(), r.accounts(), r.establishments(), r.publications(), r.keys(), CREATED_AT
    )

    def part(name: str, label, day, amount):
        return F.struct(
            F.lit(name).alias("part"),
            label.cast("string").alias("label"),
            day.cast("string").alias("day"),
            amount.cast("double").alias("amount"),
        )

    def numbered(array: str, build):
        return F.transform(
            array, lambda item, at: F.struct(at.cast("int").alias("pos"), build(item).alias("item"))
        )

    nothing = F.lit(None)
    parts = F.concat(
        F.array(F.struct(F.lit(0).alias("pos"), part("company", nothing, nothing, nothing).alias("item"))),
        numbered("nacebel_codes", lambda code: part("code", code, nothing, nothing)),
        numbered("establishments", lambda e: part("establishment", e["name_nl"], e["start_date"], nothing)),
        numbered(
            "publications", lambda p: part("publication", p["publication_number"], p["publication_date"], nothing)
        ),
        numbered(
            "annual_account_summaries_5y", lambda a: part("account", nothing, a["period_end_date"], a["turnover"])
        ),
    )
    return documents.select(
        "vat",
        "page",
        "name_nl",
        "name_fr",
        "founding_date",
        "legal_status",
        "financial_health_score",
        "number_of_employees",
        F.col("address_nl.city").alias("city_nl"),
        F.col("address_fr.city").alias("city_fr"),
        F.col("export_metadata_created_at").alias("created_at"),
        F.explode(parts).alias("x"),
    ).select("*", "x.pos", "x.item.*").drop("x")
