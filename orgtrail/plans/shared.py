"""Narrow companies that all reports of a job read, so that the histories are scanned once.

Each function keeps what its reports show or test of a company: flags instead of histories, the
shown address as text, and the fields of mandates and participations in use. A job writes the
result at rest, builds every report from it and deletes it.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgtrail.functions.countries import any_country, first_country
from orgtrail.functions.names import lookup_name
from orgtrail.operators.nested import with_fields, with_mandate_fields
from orgtrail.plans.owners import at_home
from orgtrail.plans.people import COMPANY_COLUMNS, FIELD, LAST, LATEST


def cross_border_companies(orgs: DataFrame, home: str) -> DataFrame:
    """For administrators at home and ownership across the border."""
    parts = {"related_vat": F.col("participation_hists")["related_vat"]}
    narrow = with_fields(with_mandate_fields(orgs, "pid", "role"), "participation_hists", parts)
    shown = narrow.select(
        "vat",
        "name_nl",
        "name_fr",
        lookup_name(F.col("name_nl"), F.col("name_fr"), False).alias("name"),
        first_country(F.col("address_hists")).alias("country"),
        any_country(F.col("address_hists"), home).alias("at_home"),
        "person_mandates",
        "participation_hists",
        "address_hists",
    )
    return LATEST.with_text(shown, COMPANY_COLUMNS[-1])


def linked_companies(orgs: DataFrame, cc: str, home: str) -> DataFrame:
    """For mandates of a category and participations between home and a country."""
    narrow = with_mandate_fields(orgs, "pid", "category").select(
        "vat",
        "name_nl",
        "name_fr",
        at_home(home).alias("at_home"),
        FIELD.matches(cc).alias("there"),
        "person_mandates",
        "participation_hists",
        "address_hists",
    )
    return FIELD.with_text(narrow, COMPANY_COLUMNS[-1])


def tied_companies(orgs: DataFrame, cc: str) -> DataFrame:
    """For companies of a country and dated mandates."""
    narrow = with_mandate_fields(orgs, "pid", "category", "start_date", "end_date").select(
        "vat", "name_nl", "name_fr", LAST.matches(cc).alias("there"), "person_mandates", "address_hists"
    )
    return LAST.with_text(narrow, COMPANY_COLUMNS[-1])
