"""A portfolio of companies with their establishments, publications and accounts."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgtrail.functions.activities import activity_codes
from orgtrail.functions.names import legal_status
from orgtrail.functions.records import (
    account_export,
    establishment_export,
    latest_in_array,
    publication_export,
)
from orgtrail.operators.grouping import attach_sorted, collect_latest
from orgtrail.operators.joins import enrich, restrict
from orgtrail.operators.nested import publication_keys, with_fields
from orgtrail.operators.sides import Side, as_side

PUBLICATIONS_KEPT = 50
ACCOUNTS_KEPT = 5
PUBLICATION_ORDER = ["publication_date", "publication_number"]
ESTABLISHMENT_ORDER = ["start_date", "est_id"]


def latest_publications(pubs: DataFrame, vats: DataFrame | Side, k: int = PUBLICATIONS_KEPT) -> DataFrame:
    """Per listed company its latest publications; the list cuts them before the ranking."""
    named = restrict(publication_keys(pubs), vats)
    return collect_latest(
        named, "vat", PUBLICATION_ORDER, k, publication_export(), "publications"
    )


def latest_accounts(accounts: DataFrame, k: int = ACCOUNTS_KEPT) -> DataFrame:
    exported = account_export(F.col("summaries"), accounts.schema["summaries"].dataType)
    return accounts.select(
        "vat", latest_in_array(exported, "period_end_date", k).alias("annual_account_summaries_5y")
    )


def org_export(df: DataFrame, created_at: datetime) -> DataFrame:
    """The export row; a missing array becomes an empty one.

    Pages after the first carry ``vat``, ``page``, establishments and the time; their other
    fields are null and their other arrays empty, so that nothing appears twice.
    """

    def once(value: Column) -> Column:
        return F.when(F.col("page") == 0, value)

    def array_once(value: Column) -> Column:
        return F.coalesce(once(value), F.array())

    status = legal_status(F.col("juridical_form"), F.col("juridical_situation"))
    return df.select(
        "vat",
        "page",
        once(F.col("name_nl")).alias("name_nl"),
        once(F.col("name_fr")).alias("name_fr"),
        once(F.col("founding_date")).alias("founding_date"),
        once(status).alias("legal_status"),
        once(F.col("financial_health")).alias("financial_health_score"),
        once(F.col("employee_count")).alias("number_of_employees"),
        once(F.col("address_nl")).alias("address_nl"),
        once(F.col("address_fr")).alias("address_fr"),
        array_once(activity_codes(F.col("activities"))).alias("nacebel_codes"),
        F.coalesce("establishments", F.array()).alias("establishments"),
        array_once(F.col("publications")).alias("publications"),
        array_once(F.col("annual_account_summaries_5y")).alias("annual_account_summaries_5y"),
        F.lit(created_at).alias("export_metadata_created_at"),
    )


def portfolio(
    orgs: DataFrame,
    accounts: DataFrame,
    establishments: DataFrame,
    pubs: DataFrame,
    vats: DataFrame | Side,
    created_at: datetime,
    page_rows: int | None = None,
) -> DataFrame:
    """One document per listed company, or with ``page_rows`` one per page of establishments.

    ``page`` is 0 in the first document of a company and counts on in those that follow. The
    list is put at rest once and cuts every table where it is read, before anything is shuffled.
    """
    vats = as_side(vats, "keys")
    orgs = with_fields(orgs, "activities", {"code": F.col("activities")["code"]})
    enriched = attach_sorted(
        enrich(
            restrict(orgs, vats),
            latest_publications(pubs, vats),
            latest_accounts(restrict(accounts, vats)),
        ),
        restrict(establishments, vats),
        "vat",
        ESTABLISHMENT_ORDER,
        establishment_export(),
        "establishments",
        page_rows,
    )
    return org_export(enriched, created_at)
