"""Mechanisms for large inputs: pages of hot keys, bitmaps, key checks, dealt keys, sorted parts, account shapes."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from checks.catalog import Registry, query
from orgtrail import jobs
from orgtrail.functions.records import account_export
from orgtrail.operators import grouping as G
from orgtrail.operators import joins as J
from orgtrail.operators import keys as K
from orgtrail.operators.nested import flatten_profit_loss, publication_keys
from orgtrail.operators.sides import maybe_listed, rest
from orgtrail.plans.portfolio import ESTABLISHMENT_ORDER
from orgtrail.schemas import ANNUAL_ACCOUNTS_BY_SHEET
from orgtrail.session import scratch_dir
from orgtrail.sources.sinks import read_csv_sorted, read_manifest, write_csv_sorted
from orgtrail.sources.tables import scan

PAGE = 4


@query(
    "paged_establishments",
    f"""
select vat, cast(floor(n / {PAGE}) as int) as page, cast(n % {PAGE} as int) as pos, est_id, name_nl, telephone
from (select *, row_number() over (partition by vat order by start_date nulls first, est_id) - 1 as n from establishment) e""",
)
def paged_establishments(r: Registry):
    value = F.struct("est_id", "name_nl", "telephone")
    pages = G.collect_sorted(r.establishments(), "vat", ESTABLISHMENT_ORDER, value, "items", PAGE)
    return pages.select("vat", "page", F.posexplode("items").alias("pos", "e")).select("vat", "page", "pos", "e.*")


@query(
    "numbered_publications",
    """
select vat, publication_number,
       cast(row_number() over (partition by vat order by publication_date, publication_number) - 1 as bigint) as n
from (select distinct publication_number, vat from publication_org where vat is not null) o
join publication using (publication_number)""",
)
def numbered_publications(r: Registry):
    named = publication_keys(r.publications()).select("vat", "publication_date", "publication_number")
    found = G.numbered(named, "vat", ["publication_date", "publication_number"], "n")
    return found.select("vat", "publication_number", F.col("n").cast("long").alias("n"))


@query(
    "repeated_publication_companies",
    """
select vat, cast(count(*) as bigint) as n, cast(count(distinct language) as int) as variants
from (select distinct publication_number, vat, language from publication_org join publication using (publication_number)
      where vat is not null) p
group by vat having count(distinct language) > 1""",
)
def repeated_publication_companies(r: Registry):
    found = K.repeated_keys(publication_keys(r.publications()), "vat", ["language"])
    return found.select("vat", F.col("rows").alias("n"), "variants")


@query("repeated_companies", "select vat, cast(count(*) as bigint) as n from org group by vat having count(*) > 1")
def repeated_companies(r: Registry):
    return K.repeated_keys(r.orgs(), "vat").select("vat", F.col("rows").alias("n"))


@query(
    "bitmap_cut_accounts",
    "select vat, year, turnover from annual_account where vat in (select vat from keys)",
)
def bitmap_cut_accounts(r: Registry):
    """What a list beyond the broadcast bound does: a bitmap beside the scan, an exact join behind it."""
    side = rest(r.keys(), "keys")
    cut = maybe_listed(r.accounts(), side, "vat").join(side.frame, "vat", "left_semi")
    return flatten_profit_loss(cut).select("vat", "year", "turnover")


@query(
    "join_dealt_persons",
    "select pid, last_name, vat, category, cast(start_date as string) as start_date from person join mandate using (pid)",
)
def join_dealt_persons(r: Registry):
    """Persons with more mandates than an even share of 64 tasks, each dealt to several."""
    heavy = J.heavy_keys(r.mandates(), "pid", 64)
    joined = J.spread_join(r.mandates(), r.persons().select("pid", "last_name"), "pid", "inner", heavy)
    return joined.select("pid", "last_name", "vat", "category", "start_date")


@query(
    "sorted_parts",
    """
select cast(row_number() over (order by vat, year) as bigint) as at, vat, year, turnover, employees
from annual_account""",
)
def sorted_parts(r: Registry):
    """Rows numbered by the manifest's order of parts and their order inside."""
    report = flatten_profit_loss(r.accounts()).select("vat", "year", "turnover", "employees")
    path = scratch_dir(r.spark, "sorted")
    write_csv_sorted(report, path, ["vat", "year"], 6)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # At most six parts.
    starts = read_manifest(r.spark, path).select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy("vat", "year")
    rows = read_csv_sorted(r.spark, path, report.schema).join(F.broadcast(starts), "part")
    return rows.select(
        (F.col("start") + F.row_number().over(inside)).alias("at"), "vat", "year", "turnover", "employees"
    )


def by_sheet(accounts: DataFrame) -> DataFrame:
    """The accounts in their other shape."""

    def amount(value):
        return F.struct(value.alias("current"), (value - 1).alias("previous"))

    def summary(s):
        return F.struct(
            s["period_end_date"].alias("period_end_date"),
            F.struct(
                amount(s["profit_loss"]["profit_after_tax"]).alias("gain_loss_period"),
                amount(s["profit_loss"]["turnover"]).alias("turnover"),
                amount(s["balance_sheet"]["equity"]).alias("equity"),
                amount(s["balance_sheet"]["land_buildings"]).alias("land_buildings"),
            ).alias("balance_sheet"),
            F.struct(
                s["profit_loss"]["ebitda"].alias("ebitda"), s["financial_health"].alias("financial_health_indicator")
            ).alias("financial_analysis"),
            s["employees"].alias("employees"),
            s["schema_type"].alias("schema_type"),
            s["currency"].alias("currency"),
        )

    return accounts.select("vat", F.transform("summaries", summary).alias("summaries"))


@query(
    "account_shapes",
    """
select shape, vat, cast(period_end_date as string) as period_end_date, turnover, profit_after_tax as profit, ebitda, equity,
       land_buildings, financial_health as financial_health_indicator
from annual_account, (values ('by sheet'), ('usual')) s(shape)""",
)
def account_shapes(r: Registry):
    """Both shapes of yearly accounts give the same export."""
    path = scratch_dir(r.spark, "by-sheet")
    by_sheet(r.accounts()).write.parquet(path)
    shapes = {"usual": r.accounts(), "by sheet": scan(r.spark, path, (r.accounts().schema, ANNUAL_ACCOUNTS_BY_SHEET))}

    def exported(name):
        accounts = shapes[name]
        kind = accounts.schema["summaries"].dataType
        rows = accounts.select("vat", F.explode(account_export(F.col("summaries"), kind)).alias("a"))
        return rows.select(F.lit(name).alias("shape"), "vat", "a.*")

    return exported("usual").unionByName(exported("by sheet"))


def reports_sql(owner: str, owned: str) -> str:
    return (
        "select p.vat as owner_vat, p.related_vat as owned_vat from participation p join org_country a on a.vat = p.vat "
        f"join org_country b on b.vat = p.related_vat where a.country in ({owner}) and b.country in ({owned})"
    )


@query("shared_scan_ownership", reports_sql("'BE', ''", "'CN'") + " union all " + reports_sql("'CN'", "'BE', ''"))
def shared_scan_ownership(r: Registry):
    """Two reports of one job, from companies that were scanned and narrowed once."""
    reports = jobs.cross_border_reports(r.orgs_with_mandates(), r.persons(), "CN", "BE")
    there, back = reports["CNCompaniesOwnedByBECompanies.csv"], reports["BECompaniesOwnedByCNCompanies.csv"]
    return there.unionByName(back).select("owner_vat", "owned_vat")
