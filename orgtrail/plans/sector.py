"""Companies of a sector with their yearly financials."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgtrail.functions.activities import has_activity_prefix
from orgtrail.functions.names import legal_status
from orgtrail.functions.records import year_between
from orgtrail.operators.joins import add_financials
from orgtrail.operators.nested import flatten_profit_loss
from orgtrail.operators.ordering import sort_report
from orgtrail.operators.sides import cut_to, rest


def sector_companies(orgs: DataFrame, prefix: str, classification: str | None = None) -> DataFrame:
    """Companies with an activity code under ``prefix``."""
    return orgs.filter(has_activity_prefix(F.col("activities"), prefix, classification)).select(
        "vat",
        "name_nl",
        "name_fr",
        legal_status(F.col("juridical_form"), F.col("juridical_situation")).alias("legal_status"),
        "founding_date",
    )


def sector_financials(
    orgs: DataFrame,
    accounts: DataFrame,
    prefix: str,
    year_from: int,
    year_to: int,
    classification: str | None = None,
) -> DataFrame:
    """Sector companies beside their accounts of a year range, ordered by company and year.

    The companies are written at rest, once; accounts of others are dropped where they are read.
    """
    companies = rest(sector_companies(orgs, prefix, classification), "sector")
    in_range = flatten_profit_loss(cut_to(accounts, companies, "vat")).filter(
        year_between(F.col("period_end_date"), year_from, year_to)
    )
    report = add_financials(companies.frame, in_range).select(
        "vat",
        "name_nl",
        "name_fr",
        "legal_status",
        "founding_date",
        "year",
        "period_end_date",
        "schema_type",
        "currency",
        "turnover",
        "ebitda",
        "operating_profit",
        "profit_after_tax",
        "employees",
    )
    return sort_report(report)
