"""Structs that the nested export carries, and tests on yearly accounts."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from orgtrail.schemas import ACCOUNT_SUMMARY

# Where a field of yearly accounts stands, in either shape of theirs.
ACCOUNT_PATHS = {
    "turnover": ("profit_loss.turnover", "balance_sheet.turnover"),
    "profit": ("profit_loss.profit_after_tax", "balance_sheet.gain_loss_period"),
    "operating_profit": ("profit_loss.operating_profit",),
    "ebitda": ("profit_loss.ebitda", "financial_analysis.ebitda"),
    "equity": ("balance_sheet.equity",),
    "land_buildings": ("balance_sheet.land_buildings",),
    "financial_health_indicator": ("financial_health", "financial_analysis.financial_health_indicator"),
}


def year_between(date: Column, first: int, last: int) -> Column:
    """The year lies in an inclusive range."""
    return F.year(date).between(first, last)


def _found(summaries: Column, kind: DataType, path: str) -> Column | None:
    """The array of one nested field if the type has it; of an amount its current value."""
    value = summaries
    for name in path.split("."):
        if not isinstance(kind, StructType) or name not in kind.names:
            return None
        value, kind = value[name], kind[name].dataType
    if isinstance(kind, StructType):
        return value["current"] if "current" in kind.names else None
    return value


def account_values(summaries: Column, kind: ArrayType, name: str) -> Column:
    """The array of one account field, from wherever the type of the summaries has it.

    Resolved while the query is planned: a scan reads the places that exist and no others. Where a
    type has several, the first that is not null counts; where it has none, all are null.
    """
    places = [_found(summaries, kind.elementType, path) for path in ACCOUNT_PATHS[name]]
    places = [place for place in places if place is not None]
    if not places:
        return F.transform(summaries["period_end_date"], lambda _: F.lit(None).cast("double"))
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.coalesce(x, y)), places)


def account_export(summaries: Column, kind: ArrayType = ArrayType(ACCOUNT_SUMMARY)) -> Column:
    """Yearly accounts of either shape in export form; null becomes an empty array.

    Zips arrays of single fields, so that a scan reads no other ones. ``kind`` is the column's type.
    """
    names = ("turnover", "profit", "ebitda", "equity", "land_buildings", "financial_health_indicator")
    exported = F.arrays_zip(
        summaries["period_end_date"].alias("period_end_date"),
        *[account_values(summaries, kind, name).alias(name) for name in names],
    )
    return F.coalesce(exported, F.array())


def latest_in_array(array: Column, order: str, k: int = 5) -> Column:
    """The ``k`` items with the highest ``order`` field, ascending; of equals the later wins."""
    keyed = F.sort_array(
        F.transform(
            array,
            lambda item, at: F.struct(item[order].alias("by"), at.alias("at"), item.alias("item")),
        )
    )
    latest = F.slice(keyed, F.greatest(F.size(keyed) - F.lit(k - 1), F.lit(1)), F.lit(k))
    return F.transform(latest, lambda entry: entry["item"])


def distinct_keys(keys: Column) -> Column:
    """The distinct non-null keys of one row's array; null becomes empty."""
    return F.array_distinct(
        F.filter(F.coalesce(keys, F.array()), lambda key: key.isNotNull())
    )


def establishment_export() -> Column:
    return F.struct(
        "name_nl",
        "name_fr",
        "start_date",
        "end_date",
        "address_nl",
        "address_fr",
        "telephone",
        "email",
        "website",
        "activities",
    )


def publication_export() -> Column:
    return F.struct(
        "publication_date",
        "publication_number",
        "pdf_link",
        "language",
        F.coalesce("subjects", F.array()).alias("subjects"),
        "source",
    )
