"""Sources, sinks and dumps: each writes to the session's shared folder and reads back."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.catalog import HOME, TARGET, Registry, query
from checks.exports import CREATED_AT, LATEST_PEOPLE
from orgtrail.plans import people
from orgtrail.plans.dumps import CORE_TABLES, full_dump
from orgtrail.plans.portfolio import portfolio
from orgtrail.schemas import ESTABLISHMENTS, PUBLICATIONS
from orgtrail.session import scratch_dir
from orgtrail.sources.keylists import read_vat_list, vat_list
from orgtrail.sources.sinks import write_csv, write_csv_named, write_json, write_parquet
from orgtrail.sources.tables import scan, scan_registry


def partitions(r: Registry) -> int:
    return int(r.spark.conf.get("spark.sql.shuffle.partitions"))


def dumped(r: Registry, df: DataFrame, name: str) -> DataFrame:
    """A core table, dumped and read back by name."""
    base = scratch_dir(r.spark, "dump")
    full_dump(df, CORE_TABLES[name][0], f"{base}/{name}", partitions(r))
    return scan_registry(r.spark, base, name)


@query(
    "dump_organisations",
    """
select o.vat, o.name_nl, o.name_fr, o.name, o.juridical_form, o.juridical_situation,
       cast(o.founding_date as string) as founding_date, o.employee_count, o.financial_health,
       h.n as n_addresses, coalesce(a.n, 0) as n_activities, coalesce(m.n, 0) as n_mandates, coalesce(p.n, 0) as n_participations
from org o
left join (select vat, cast(count(i) as int) as n from (select vat from org where k % 100 <> 0) s
           left join org_address using (vat) group by vat) h on h.vat = o.vat
left join (select vat, cast(count(*) as int) as n from activity group by vat) a on a.vat = o.vat
left join (select vat, cast(count(*) as int) as n from mandate group by vat) m on m.vat = o.vat
left join (select vat, cast(count(*) as int) as n from participation group by vat) p on p.vat = o.vat""",
)
def dump_organisations(r: Registry):
    return dumped(r, r.orgs_with_mandates(), "organisations").select(
        "vat",
        "name_nl",
        "name_fr",
        "name",
        "juridical_form",
        "juridical_situation",
        "founding_date",
        "employee_count",
        "financial_health",
        F.when(F.col("address_hists").isNotNull(), F.size("address_hists")).alias("n_addresses"),
        F.size("activities").alias("n_activities"),
        F.size("person_mandates").alias("n_mandates"),
        F.size("participation_hists").alias("n_participations"),
    )


@query(
    "dump_persons",
    "select p.pid, p.first_name, p.last_name, p.name, p.is_moral, h.i, cast(h.start_date as string) as start_date, "
    "cast(h.end_date as string) as end_date, h.cc as country_code from person p join person_hist h on h.pid = p.pid",
)
def dump_persons(r: Registry):
    rows = dumped(r, r.persons(), "persons").select("*", F.posexplode("address_hists").alias("i", "hist"))
    country = F.coalesce("hist.address_nl", "hist.address_fr")["country_code"]
    return rows.select(
        "pid", "first_name", "last_name", "name", "is_moral", "i", "hist.start_date", "hist.end_date",
        country.alias("country_code"),
    )


@query(
    "dump_annual_accounts",
    "select vat, cast(period_end_date as string) as period_end_date, turnover, ebitda, operating_profit, "
    "profit_after_tax, equity, land_buildings, employees, schema_type, currency from annual_account",
)
def dump_annual_accounts(r: Registry):
    rows = dumped(r, r.accounts(), "annual_accounts").select("vat", F.explode("summaries").alias("a"))
    return rows.select(
        "vat", "a.period_end_date", "a.profit_loss.*", "a.balance_sheet.*", "a.employees", "a.schema_type", "a.currency"
    )


@query(
    "scan_registry",
    """
select 'organisations' as dataset, vat as key, 1 as items from org
union all select 'persons', pid, 2 from person
union all select 'annual_accounts', vat, cast(count(*) as int) from annual_account group by vat""",
)
def scan_by_name(r: Registry):
    base = scratch_dir(r.spark, "registry")
    tables = {"organisations": r.orgs(), "persons": r.persons(), "annual_accounts": r.accounts()}
    for name, df in tables.items():
        df.write.parquet(f"{base}/{name}")
    orgs, persons, accounts = (scan_registry(r.spark, base, name) for name in tables)

    def listed(dataset: str, df: DataFrame, key: str, items) -> DataFrame:
        return df.select(F.lit(dataset).alias("dataset"), F.col(key).alias("key"), items.alias("items"))

    return (
        listed("organisations", orgs, "vat", F.lit(1))
        .unionByName(listed("persons", persons, "pid", F.size("address_hists")))
        .unionByName(listed("annual_accounts", accounts, "vat", F.size("summaries")))
    )


@query(
    "scan_parquet_typed",
    """
select 'establishment' as dataset, vat as key, name_nl as label, cast(start_date as string) as day from establishment
union all
select 'publication', publication_number, language, cast(publication_date as string) from publication""",
)
def scan_parquet_typed(r: Registry):
    base = scratch_dir(r.spark, "typed")
    r.establishments().write.parquet(f"{base}/establishments")
    r.publications().write.parquet(f"{base}/publications")
    sites = scan(r.spark, f"{base}/establishments", ESTABLISHMENTS).select(
        F.lit("establishment").alias("dataset"),
        F.col("vat").alias("key"),
        F.col("name_nl").alias("label"),
        F.col("start_date").alias("day"),
    )
    pubs = scan(r.spark, f"{base}/publications", PUBLICATIONS).select(
        F.lit("publication").alias("dataset"),
        F.col("publication_number").alias("key"),
        F.col("language").alias("label"),
        F.col("publication_date").alias("day"),
    )
    return sites.unionByName(pubs)


def key_file(r: Registry, header: str) -> str:
    path = scratch_dir(r.spark, "keys")
    raw = r.raw_keys().select(F.col("vat").alias(header), F.lit("note").alias("remark"))
    raw.write.option("header", True).option("sep", ";").csv(path)
    return path


@query("scan_vat_list_auto", "select vat from keys")
def scan_vat_list_auto(r: Registry):
    return read_vat_list(r.spark, key_file(r, "VAT"))


@query("scan_vat_list_strict", "select vat from keys")
def scan_vat_list_strict(r: Registry):
    return read_vat_list(r.spark, key_file(r, "vat"), column="vat")


@query(
    "vat_list_inline",
    "select vat, name_fr from org where vat in ('BE0000000004', 'BE0000000019')",
)
def vat_list_inline(r: Registry):
    keys = vat_list(r.spark, ["BE0000000004", "BE0000000019", "BE0000000004", "BE9999999999"])
    return r.orgs().join(keys, "vat", "left_semi").select("vat", "name_fr")


@query(
    "sink_parquet",
    "select vat, name_nl, name_fr, cast(founding_date as string) as founding_date, employee_count from org",
)
def sink_parquet(r: Registry):
    path = scratch_dir(r.spark, "parquet")
    orgs = r.orgs().select("vat", "name_nl", "name_fr", "founding_date", "employee_count")
    write_parquet(orgs, path, "vat", partitions(r), split_skew=False)
    return r.spark.read.parquet(path)


def read_csv(r: Registry, path: str) -> DataFrame:
    return r.spark.read.option("header", True).option("sep", ";").csv(path)


READ_BACK = "select {columns} from ({report}) w"


def read_back_sql(report: str, *columns: str) -> str:
    """Null and the empty string come back from CSV as one."""
    shown = ", ".join(f"nullif(cast({name} as string), '') as {name}" for name in columns)
    return READ_BACK.format(columns=shown, report=report)


@query("sink_csv_single", read_back_sql(LATEST_PEOPLE, "pid", "first_name", "last_name", "last_address"))
def sink_csv_single(r: Registry):
    path = scratch_dir(r.spark, "single")
    write_csv(people.country_persons(r.persons(), TARGET), path, single_file=True)
    return read_csv(r, path)


@query(
    "sink_csv_named",
    read_back_sql("select * from person", "pid", "first_name", "last_name", "name", "is_moral"),
)
def sink_csv_named(r: Registry):
    folder = scratch_dir(r.spark, "named")
    return read_csv(r, write_csv_named(r.persons().drop("address_hists"), folder, f"{HOME}Persons.csv"))


@query(
    "sink_csv_partitioned",
    read_back_sql("select * from org", "vat", "name_nl", "name_fr", "name", "juridical_form"),
)
def sink_csv_partitioned(r: Registry):
    path = scratch_dir(r.spark, "parts")
    write_csv(r.orgs().select("vat", "name_nl", "name_fr", "name", "juridical_form"), path)
    return read_csv(r, path)


@query(
    "sink_json",
    """
select o.vat, o.name_nl, coalesce(e.n, 0) as n_establishments, coalesce(p.n, 0) as n_publications,
       coalesce(a.n, 0) as n_accounts
from org o join keys k on k.vat = o.vat
left join (select vat, cast(count(*) as int) as n from establishment group by vat) e on o.vat = e.vat
left join (select vat, cast(count(*) as int) as n from ranked_publication where latest <= 50 group by vat) p on o.vat = p.vat
left join (select vat, cast(count(*) as int) as n from ranked_account where latest <= 5 group by vat) a on o.vat = a.vat""",
)
def sink_json(r: Registry):
    documents = portfolio(
        r.orgs(), r.accounts(), r.establishments(), r.publications(), r.keys(), CREATED_AT
    )
    path = scratch_dir(r.spark, "json")
    write_json(documents, path)
    return r.spark.read.schema(documents.schema).json(path).select(
        "vat",
        "name_nl",
        F.size("establishments").alias("n_establishments"),
        F.size("publications").alias("n_publications"),
        F.size("annual_account_summaries_5y").alias("n_accounts"),
    )
