"""From nested histories to flat rows."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgtrail.functions.countries import addr
from orgtrail.functions.records import account_values, distinct_keys
from orgtrail.schemas import MANDATE

MANDATE_COLUMNS = MANDATE.fieldNames()
PERSON_COLUMNS = ["pid", "first_name", "last_name", "name", "is_moral"]


def unnest(df: DataFrame, array: str, outer: bool = False) -> DataFrame:
    """One row per element of ``array``; ``outer`` keeps rows without elements.

    The element replaces the array under the array's own name.
    """
    explode = F.explode_outer if outer else F.explode
    return df.withColumn(array, explode(array))


def with_address(df: DataFrame, pick: Callable[[Column], Column], name: str) -> DataFrame:
    """``df`` with the address of the picked history entry as a struct column.

    The entry is a column first and the address then reads it, so that the pick runs once
    per row however many address fields a report shows.
    """
    return df.withColumn(name, pick(F.col("address_hists"))).withColumn(name, addr(F.col(name)))


def with_fields(df: DataFrame, array: str, fields: dict[str, Column]) -> DataFrame:
    """``df`` with ``array`` cut to ``fields``, each an array of one nested field.

    Such as ``F.col("summaries")["currency"]``. Do this next to the scan: it then reads only
    these fields, where exploding or passing on the whole structs makes it read all.
    """
    zipped = F.arrays_zip(*[field.alias(name) for name, field in fields.items()])
    return df.withColumn(array, zipped)


def with_mandate_fields(orgs: DataFrame, *names: str) -> DataFrame:
    mandates = F.col("person_mandates")
    return with_fields(orgs, "person_mandates", {name: mandates[name] for name in names})


def flatten_mandate(df: DataFrame, outer: bool = False) -> DataFrame:
    """One row per mandate: the other columns of ``df``, then the mandate's fields."""
    rest = [name for name in df.columns if name != "person_mandates"]
    return unnest(df, "person_mandates", outer).select(*rest, "person_mandates.*")


def flatten_participation(df: DataFrame) -> DataFrame:
    """One row per participation: the other columns of ``df``, then its fields."""
    rest = [name for name in df.columns if name != "participation_hists"]
    return unnest(df, "participation_hists").select(*rest, "participation_hists.*")


def flatten_profit_loss(accounts: DataFrame) -> DataFrame:
    """One row per company and yearly account of either shape, with the profit-and-loss metrics."""
    summaries, kind = F.col("summaries"), accounts.schema["summaries"].dataType
    plain = ("period_end_date", "employees", "schema_type", "currency")
    metrics = ("turnover", "ebitda", "operating_profit", "profit_after_tax")
    fields = {name: summaries[name] for name in plain}
    fields |= {
        name: account_values(summaries, kind, "profit" if name == "profit_after_tax" else name) for name in metrics
    }
    rows = unnest(with_fields(accounts.select("vat", "summaries"), "summaries", fields), "summaries")
    return rows.select("vat", "summaries.*").select(
        "vat",
        "period_end_date",
        F.year("period_end_date").alias("year"),
        *metrics,
        "employees",
        "schema_type",
        "currency",
    )


def publication_keys(pubs: DataFrame) -> DataFrame:
    """One row per publication and distinct company it names."""
    keys = distinct_keys(F.col("organizations")["vat"])
    return pubs.withColumn("vat", F.explode(keys)).drop("organizations")


def persons_slim(persons: DataFrame) -> DataFrame:
    """What a report shows of a representative; the name is kept apart from a company's."""
    return persons.select(*PERSON_COLUMNS).withColumnRenamed("name", "person_name")
