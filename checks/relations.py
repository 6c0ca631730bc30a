"""Generators, joins, groupings and sorts."""

from pyspark.sql import functions as F

from checks.catalog import HOME, TARGET, YEARS, Registry, hists, query
from checks.projections import MANDATE_SQL
from checks.recipes import address_text
from orgtrail.functions.addresses import sort_hists
from orgtrail.functions.countries import country_field
from orgtrail.functions.records import (
    account_export,
    distinct_keys,
    establishment_export,
    latest_in_array,
    publication_export,
    year_between,
)
from orgtrail.operators import grouping as G
from orgtrail.operators import joins as J
from orgtrail.operators.nested import (
    flatten_mandate,
    flatten_participation,
    flatten_profit_loss,
    persons_slim,
    publication_keys,
    unnest,
)
from orgtrail.operators.ordering import sort_report
from orgtrail.plans.owners import at_home, ownership_lookup
from orgtrail.plans.people import FIELD
from orgtrail.plans.portfolio import (
    ESTABLISHMENT_ORDER,
    PUBLICATION_ORDER,
    PUBLICATIONS_KEPT,
    latest_accounts,
)


@query("explode_mandates", MANDATE_SQL + "mandate")
def explode_mandates(r: Registry):
    rows = unnest(r.orgs_with_mandates().select("vat", "person_mandates"), "person_mandates")
    return rows.select("vat", "person_mandates.*")


@query("explode_outer_mandates", MANDATE_SQL + "org left join mandate using (vat)")
def explode_outer_mandates(r: Registry):
    return flatten_mandate(r.orgs_with_mandates().select("vat", "person_mandates"), outer=True)


@query("explode_participations", "select vat, related_vat, interests_type, percentage, source from participation")
def explode_participations(r: Registry):
    rows = unnest(r.orgs().select("vat", "participation_hists"), "participation_hists")
    return rows.select("vat", "participation_hists.*")


@query(
    "explode_addresses",
    f"select vat, cast(start_date as string) as start_date, cast(end_date as string) as end_date "
    f"from org_hist where upper(cc_field) = '{TARGET}'",
)
def explode_addresses(r: Registry):
    rows = unnest(r.orgs().select("vat", "address_hists"), "address_hists", outer=True)
    here = F.upper(country_field(hists())) == TARGET
    return rows.filter(here).select("vat", "address_hists.start_date", "address_hists.end_date")


@query(
    "explode_accounts",
    "select vat, cast(period_end_date as string) as period_end_date, turnover, equity, employees from annual_account",
)
def explode_accounts(r: Registry):
    return unnest(r.accounts(), "summaries").select(
        "vat",
        "summaries.period_end_date",
        "summaries.profit_loss.turnover",
        "summaries.balance_sheet.equity",
        "summaries.employees",
    )


@query(
    "explode_publication_orgs",
    "select distinct publication_number, vat, language from publication_org join publication using (publication_number) "
    "where vat is not null",
)
def explode_publication_orgs(r: Registry):
    return publication_keys(r.publications()).select("publication_number", "vat", "language")


@query(
    "join_inner_person_mandate",
    "select pid, last_name, vat, category, role, cast(start_date as string) as start_date "
    "from person join mandate using (pid)",
)
def join_inner_person_mandate(r: Registry):
    joined = J.join_mandates(r.persons(), r.mandates())
    return joined.select("pid", "last_name", "vat", "category", "role", "start_date")


@query("join_broadcast_vat_list", "select vat, name_nl, name_fr from org join keys using (vat)")
def join_broadcast_vat_list(r: Registry):
    listed = J.restrict(r.orgs(), r.keys(), keep="join")
    return listed.select("vat", "name_nl", "name_fr")


@query("join_semi_portfolio", "select vat, name_nl, name_fr from org where vat in (select vat from keys)")
def join_semi_portfolio(r: Registry):
    return J.restrict(r.orgs(), r.keys()).select("vat", "name_nl", "name_fr")


@query(
    "join_semi_home_orgs",
    "select vat, pid, role, cast(start_date as string) as start_date from mandate "
    f"where vat in (select vat from org_hist where upper(trim(cc)) = '{HOME}')",
)
def join_semi_home_orgs(r: Registry):
    return J.restrict_home(r.mandates(), r.orgs(), HOME).select("vat", "pid", "role", "start_date")


@query(
    "join_ownership_two_sided",
    """
select p.vat as owner_vat, coalesce(a.name_nl, '') as owner_name, ca.country as owner_country,
       p.related_vat as owned_vat, coalesce(b.name_nl, '') as owned_name, cb.country as owned_country
from participation p join org a on p.vat = a.vat join org b on p.related_vat = b.vat
left join org_country ca on ca.vat = a.vat left join org_country cb on cb.vat = b.vat""",
)
def join_ownership_two_sided(r: Registry):
    parts = flatten_participation(r.orgs().select("vat", "participation_hists"))
    return J.ownership_pairs(parts.select("vat", "related_vat"), ownership_lookup(r.orgs()))


@query(
    "join_participation_target",
    f"""
select p.vat as vat_home, p.related_vat as vat, o.name_nl, {address_text('concat_ws', 'h')} as last_address, p.source
from participation p join org o on p.related_vat = o.vat left join org_last h on h.vat = o.vat
where o.vat in (select vat from org_hist where upper(cc_field) = '{TARGET}')""",
)
def join_participation_target(r: Registry):
    parts = flatten_participation(r.orgs().select(F.col("vat").alias("vat_home"), "participation_hists"))
    targets = r.orgs().filter(FIELD.matches(TARGET)).select("vat", "name_nl", "address_hists")
    targets = FIELD.with_text(targets, "last_address")
    joined = J.participation_join(parts.withColumnRenamed("related_vat", "vat"), targets)
    return joined.select("vat_home", "vat", "name_nl", "last_address", "source")


@query(
    "join_participation_home",
    f"""
select p.vat, p.related_vat as vat_home, o.name_nl, p.percentage, p.source
from participation p join org o on p.related_vat = o.vat
where o.vat in (select vat from org_hist where upper(cc_field) in ('{HOME}', ''))""",
)
def join_participation_home(r: Registry):
    parts = flatten_participation(r.orgs().select("vat", "participation_hists"))
    homes = r.orgs().filter(at_home(HOME)).select(F.col("vat").alias("vat_home"), "name_nl")
    joined = J.participation_join(parts.withColumnRenamed("related_vat", "vat_home"), homes, "vat_home")
    return joined.select("vat", "vat_home", "name_nl", "percentage", "source")


@query(
    "join_left_person_names",
    "select m.vat, m.pid, m.role, cast(m.start_date as string) as start_date, p.first_name, p.last_name, "
    "p.name as person_name, p.is_moral from mandate m left join person p on m.pid = p.pid",
)
def join_left_person_names(r: Registry):
    joined = J.add_person_names(r.mandates(), persons_slim(r.persons()))
    return joined.select(
        "vat", "pid", "role", "start_date", "first_name", "last_name", "person_name", "is_moral"
    )


@query(
    "join_left_financials",
    f"""
select o.vat, a.year, a.turnover, a.employees
from org o left join (select * from annual_account where year between {YEARS[0]} and {YEARS[1]}) a on o.vat = a.vat""",
)
def join_left_financials(r: Registry):
    accounts = flatten_profit_loss(r.accounts()).filter(year_between(F.col("period_end_date"), *YEARS))
    return J.add_financials(r.orgs(), accounts).select("vat", "year", "turnover", "employees")


@query(
    "join_left_enrich_three",
    """
select o.vat, 0 as page, coalesce(e.n, 0) as n_establishments, coalesce(p.n, 0) as n_publications,
       coalesce(a.n, 0) as n_accounts
from org o
left join (select vat, cast(count(*) as int) as n from establishment group by vat) e on o.vat = e.vat
left join (select vat, cast(count(*) as int) as n from ranked_publication where latest <= 50 group by vat) p on o.vat = p.vat
left join (select vat, cast(count(*) as int) as n from ranked_account where latest <= 5 group by vat) a on o.vat = a.vat""",
)
def join_left_enrich_three(r: Registry):
    pubs = G.collect_latest(
        publication_keys(r.publications()), "vat", PUBLICATION_ORDER, PUBLICATIONS_KEPT,
        publication_export(), "publications",
    )
    enriched = G.attach_sorted(
        J.enrich(r.orgs(), pubs, latest_accounts(r.accounts())),
        r.establishments(), "vat", ESTABLISHMENT_ORDER, establishment_export(), "establishments",
    )
    return enriched.select(
        "vat",
        "page",
        F.size("establishments").alias("n_establishments"),
        F.size(F.coalesce("publications", F.array())).alias("n_publications"),
        F.size(F.coalesce("annual_account_summaries_5y", F.array())).alias("n_accounts"),
    )


@query("distinct_rows", "select distinct pid, category, role from mandate")
def distinct_rows(r: Registry):
    return G.distinct(r.mandates().select("pid", "category", "role"))


@query("distinct_keys", "select vat from keys")
def distinct_key_list(r: Registry):
    return r.keys()


@query(
    "group_collect_establishments",
    """
select vat, 0 as page, cast(row_number() over (partition by vat order by start_date nulls first, est_id) - 1 as int) as pos,
       name_nl, cast(start_date as string) as start_date, activity from establishment""",
)
def group_collect_establishments(r: Registry):
    pages = G.collect_sorted(r.establishments(), "vat", ESTABLISHMENT_ORDER, establishment_export(), "items")
    return pages.select("vat", "page", F.posexplode("items").alias("pos", "e")).select(
        "vat", "page", "pos", "e.name_nl", "e.start_date", F.array_join("e.activities", "|").alias("activity")
    )


LATEST_PUBLICATIONS_SQL = """
select vat, cast(row_number() over (partition by vat order by publication_date, publication_number) - 1 as int) as pos,
       publication_number, cast(publication_date as string) as publication_date, language
from ranked_publication where latest <= 50"""


@query("group_collect_publications", LATEST_PUBLICATIONS_SQL)
def group_collect_publications(r: Registry):
    named = publication_keys(r.publications())
    arrays = G.collect_latest(named, "vat", PUBLICATION_ORDER, PUBLICATIONS_KEPT, publication_export(), "items")
    return arrays.select("vat", F.posexplode("items").alias("pos", "p")).select(
        "vat", "pos", "p.publication_number", "p.publication_date", "p.language"
    )


@query(
    "group_person_address",
    f"""
select distinct p.pid, p.first_name, p.last_name, {address_text('concat_ws', 'h')} as last_address
from person p left join person_last h on p.pid = h.pid""",
)
def group_person_address(r: Registry):
    return G.one_per_person(FIELD.with_text(r.persons(), "last_address"))


@query(
    "array_distinct_keys",
    """
select publication_number, cast(count(distinct vat) as int) as n_keys, min(vat) as first_key, max(vat) as last_key
from publication_org group by publication_number""",
)
def array_distinct_keys(r: Registry):
    keys = distinct_keys(F.col("organizations")["vat"])
    return r.publications().select("publication_number", keys.alias("keys")).select(
        "publication_number",
        F.size("keys").alias("n_keys"),
        F.array_min("keys").alias("first_key"),
        F.array_max("keys").alias("last_key"),
    )


@query("sort_vat_year", "select vat, year, turnover, employees from annual_account order by vat, year")
def sort_vat_year(r: Registry):
    return sort_report(flatten_profit_loss(r.accounts()).select("vat", "year", "turnover", "employees"))


def sorted_sql(by: str, order: str) -> str:
    return f"""
select '{by}' as sorted_by, vat, cast(row_number() over (partition by vat order by {order}) - 1 as int) as pos,
       cast(start_date as string) as start_date, cast(end_date as string) as end_date, number
from org_hist"""


def sorted_hists(r: Registry, by: str):
    rows = r.orgs().select("vat", F.posexplode(sort_hists(hists(), by)).alias("pos", "hist"))
    number = F.coalesce("hist.address_nl.number", "hist.address_fr.number")
    return rows.select(
        F.lit(by).alias("sorted_by"), "vat", "pos", "hist.start_date", "hist.end_date", number.alias("number")
    )


ASCENDING = "end_date is null, end_date, coalesce(start_date, date '1970-01-01'), i"


@query(
    "array_sort_addresses",
    sorted_sql("end_start", ASCENDING).replace(", number", ", case when has_addr then number end as number"),
)
def array_sort_addresses(r: Registry):
    return sorted_hists(r, "end_start")


@query(
    "array_sort_by_start",
    f"select sorted_by, vat, pos, start_date, end_date from ({sorted_sql('start', 'start_date nulls first, i')}) s "
    f"union all select sorted_by, vat, pos, start_date, end_date from ({sorted_sql('end', 'end_date nulls first, i')}) e",
)
def array_sort_by_start(r: Registry):
    return sorted_hists(r, "start").unionByName(sorted_hists(r, "end")).drop("number")


@query(
    "sort_establishments",
    """
select vat, 0 as page, cast(row_number() over (partition by vat order by start_date nulls first, est_id) - 1 as int) as pos,
       est_id, cast(start_date as string) as start_date from establishment""",
)
def sort_establishments(r: Registry):
    value = F.struct("est_id", "start_date")
    pages = G.collect_sorted(r.establishments(), "vat", ESTABLISHMENT_ORDER, value, "items")
    return pages.select("vat", "page", F.posexplode("items").alias("pos", "e")).select("vat", "page", "pos", "e.*")


@query(
    "topk_publications_50",
    "select vat, publication_number, cast(publication_date as string) as publication_date "
    "from ranked_publication where latest <= 50",
)
def topk_publications(r: Registry):
    named = publication_keys(r.publications())
    latest = G.latest_per_key(named, "vat", PUBLICATION_ORDER, PUBLICATIONS_KEPT)
    return latest.select("vat", "publication_number", "publication_date")


@query(
    "topk_accounts_5",
    """
select vat, cast(row_number() over (partition by vat order by period_end_date) - 1 as int) as pos,
       cast(period_end_date as string) as period_end_date, turnover, equity
from ranked_account where latest <= 5""",
)
def topk_accounts(r: Registry):
    latest = latest_in_array(account_export(F.col("summaries")), "period_end_date", 5)
    return r.accounts().select("vat", F.posexplode(latest).alias("pos", "a")).select(
        "vat", "pos", "a.period_end_date", "a.turnover", "a.equity"
    )
