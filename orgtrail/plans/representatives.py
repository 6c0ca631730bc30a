"""Who represents a list of companies."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgtrail.functions.activities import principal_activity
from orgtrail.functions.addresses import (
    address_part,
    current_or_latest_hist,
    first_open_or_last_hist,
    fmt_address,
    last_closed_hist,
    previous_hist,
)
from orgtrail.functions.mandates import rep_status, rep_type, rep_type_by_pid
from orgtrail.functions.names import first_name_of, first_nonempty, rep_last_name
from orgtrail.functions.text import or_empty
from orgtrail.operators.joins import add_person_names, restrict
from orgtrail.operators.nested import (
    flatten_mandate,
    persons_slim,
    with_address,
    with_mandate_fields,
)
from orgtrail.operators.sides import Side, cut_to, rest


def representatives(
    orgs: DataFrame, persons: DataFrame, vats: DataFrame | Side, variant: str = "file"
) -> DataFrame:
    """Each listed company beside its representatives; one without any keeps a row.

    ``file`` shows the current address line, the strict principal activity, the moral flag
    and the latest closed address. ``list`` shows the first open address, the first primary
    NACE activity, the type by person key, the last closed address, category and dates. A
    key listed twice counts once.

    The listed companies are read once: their mandates carry what is shown of the company, and
    are written at rest. Names come from persons cut to those that they name. A company
    may take several rows of ``orgs`` with its mandates spread over them.
    """
    if variant not in ("file", "list"):
        raise ValueError(f"unknown variant {variant!r}")
    companies, report, fields = _VARIANTS[variant]
    listed = companies(restrict(with_mandate_fields(orgs, *fields), vats))
    mandates = rest(flatten_mandate(listed.select(*_COMPANY_COLUMNS, "person_mandates"), outer=True), "mandates")
    named = rest(cut_to(persons_slim(persons), mandates.select("pid"), "pid"), "named")
    return report(add_person_names(mandates.frame, named))


_COMPANY_COLUMNS = [
    "vat",
    "company_name",
    "address",
    "postcode",
    "country",
    "activity",
    "additional_address",
]


def _with_columns(orgs: DataFrame, current, before, rule: str) -> DataFrame:
    shown = with_address(with_address(orgs, current, "current"), before, "before")
    return shown.withColumn("activity", principal_activity(F.col("activities"), rule))


def _file_companies(orgs: DataFrame) -> DataFrame:
    return _with_columns(orgs, current_or_latest_hist, previous_hist, "strict").select(
        "*",
        first_name_of(F.col("name_nl"), F.col("name_fr"), F.col("name")).alias("company_name"),
        fmt_address(F.col("current"), "line").alias("address"),
        address_part(F.col("current"), "zip_code").alias("postcode"),
        address_part(F.col("current"), "country_code").alias("country"),
        fmt_address(F.col("before"), "full").alias("additional_address"),
    )


def _list_companies(orgs: DataFrame) -> DataFrame:
    return _with_columns(orgs, first_open_or_last_hist, last_closed_hist, "contains").select(
        "*",
        first_nonempty(F.col("name_nl"), F.col("name_fr")).alias("company_name"),
        fmt_address(F.col("current"), "comma_space").alias("address"),
        address_part(F.col("current"), "zip_code").alias("postcode"),
        address_part(F.col("current"), "country_code").alias("country"),
        fmt_address(F.col("before"), "comma_space").alias("additional_address"),
    )


def _file_report(joined: DataFrame) -> DataFrame:
    return joined.select(
        "vat",
        F.col("company_name").alias("name"),
        "address",
        "postcode",
        "country",
        F.col("activity.code").alias("principal_code"),
        F.col("activity.description").alias("principal_description"),
        or_empty(F.col("first_name")).alias("representative_first_name"),
        rep_last_name(F.col("last_name"), F.col("person_name")).alias("representative_last_name"),
        rep_type(F.col("is_moral")).alias("representative_type"),
        rep_status(F.col("end_date")).alias("representative_status"),
        "additional_address",
    )


def _list_report(joined: DataFrame) -> DataFrame:
    return joined.select(
        F.col("vat").alias("vat_id"),
        F.col("company_name").alias("name"),
        "address",
        "postcode",
        "country",
        F.col("activity.code").alias("principal_code"),
        F.col("activity.description").alias("principal_description"),
        F.col("first_name").alias("rep_first_name"),
        F.col("last_name").alias("rep_last_name"),
        rep_type_by_pid(F.col("pid")).alias("rep_type"),
        rep_status(F.col("end_date"), upper=True).alias("rep_status"),
        "additional_address",
        F.col("category").alias("rep_category"),
        F.col("start_date").alias("rep_start_date"),
        F.col("end_date").alias("rep_end_date"),
    )


_VARIANTS = {
    "file": (_file_companies, _file_report, ["pid", "end_date"]),
    "list": (_list_companies, _list_report, ["pid", "category", "start_date", "end_date"]),
}
