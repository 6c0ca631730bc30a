"""Persons and companies with ties to a country."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgtrail.functions.addresses import fmt_address, last_hist, latest_hist
from orgtrail.functions.countries import any_country
from orgtrail.functions.mandates import ADMIN_ROLES, category_in, has_category, role_in
from orgtrail.functions.text import or_empty
from orgtrail.operators.grouping import distinct
from orgtrail.operators.joins import join_mandates
from orgtrail.operators.nested import flatten_mandate, with_address, with_mandate_fields
from orgtrail.operators.sides import cut_to, maybe_listed, rest


@dataclass(frozen=True)
class CountryRules:
    """How a report tests the country and shows the address of a history."""

    mode: str
    trim: bool
    pick: Callable[[Column], Column]
    style: str
    blank_names: bool
    distinct: bool

    def matches(self, cc: str) -> Column:
        return any_country(F.col("address_hists"), cc, mode=self.mode, trim=self.trim)

    def with_text(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the shown address as text in place of the history."""
        shown = with_address(df, self.pick, name).drop("address_hists")
        return shown.withColumn(name, fmt_address(F.col(name), self.style))

    def keep(self, df: DataFrame) -> DataFrame:
        return distinct(df) if self.distinct else df


LATEST = CountryRules("struct", True, latest_hist, "comma_trim", True, False)
LAST = CountryRules("struct", False, last_hist, "comma_nulls", False, True)
FIELD = CountryRules("field", False, last_hist, "concat_ws", False, True)

PERSON_COLUMNS = ["pid", "first_name", "last_name", "last_address"]
COMPANY_COLUMNS = ["vat", "name_nl", "name_fr", "last_address_for_company"]


def country_persons(persons: DataFrame, cc: str, rules: CountryRules = LATEST) -> DataFrame:
    """Persons with any address in ``cc``, with the address the rules show."""
    shown = or_empty if rules.blank_names else (lambda name: name)
    found = persons.filter(rules.matches(cc)).select(
        "pid",
        shown(F.col("first_name")).alias("first_name"),
        shown(F.col("last_name")).alias("last_name"),
        "address_hists",
    )
    return rules.keep(rules.with_text(found, "last_address"))


def country_companies(orgs: DataFrame, cc: str, rules: CountryRules = LAST) -> DataFrame:
    """Companies with any address in ``cc``."""
    return rules.keep(shown_companies(orgs.filter(rules.matches(cc)), rules).select(*COMPANY_COLUMNS))


def shown_companies(orgs: DataFrame, rules: CountryRules) -> DataFrame:
    """Companies with their shown address in place of the history; as they are if it is there already."""
    if COMPANY_COLUMNS[-1] in orgs.columns:
        return orgs
    return rules.with_text(orgs, COMPANY_COLUMNS[-1])


def _beside_mandates(
    people: DataFrame, orgs: DataFrame, rules: CountryRules, fields: list[str], keep=None
) -> DataFrame:
    """``people`` beside the ``fields`` of their mandates and the company that gave them.

    One scan: a mandate carries its company's columns. Few people are broadcast, and only
    companies that are hit get their address written out. Of many people a bitmap cuts the
    mandates first, so that hits alone are shuffled. A company may take several rows of ``orgs``.
    """
    side = rest(people, "people")
    shown = [name for name in (*COMPANY_COLUMNS, "address_hists") if name in orgs.columns]
    rows = flatten_mandate(with_mandate_fields(orgs, "pid", *fields).select(*shown, "person_mandates"))
    rows = rows if keep is None else rows.filter(keep)
    if side.fits():
        return shown_companies(join_mandates(side, rows), rules)
    return join_mandates(side, shown_companies(maybe_listed(rows, side, "pid"), rules))


def country_admins(
    persons: DataFrame,
    orgs: DataFrame,
    cc: str,
    home: str,
    roles=ADMIN_ROLES,
    rules: CountryRules = LATEST,
) -> DataFrame:
    """Persons of ``cc`` who administer a company with an address in ``home``."""
    return admins_at(persons, orgs.filter(any_country(F.col("address_hists"), home)), cc, roles, rules)


def admins_at(
    persons: DataFrame, companies: DataFrame, cc: str, roles=ADMIN_ROLES, rules: CountryRules = LATEST
) -> DataFrame:
    """Persons of ``cc`` who administer one of the companies, given with history or shown address."""
    people = country_persons(persons, cc, rules)
    rows = _beside_mandates(people, companies, rules, ["role"], role_in(F.col("role"), roles))
    return rows.select(*PERSON_COLUMNS, *COMPANY_COLUMNS)


def country_mandates(
    persons: DataFrame,
    orgs: DataFrame,
    cc: str,
    categories,
    match: str = "org",
    rules: CountryRules | None = None,
) -> DataFrame:
    """Persons of ``cc`` beside the mandates they hold.

    ``match="org"`` shows every mandate of a company that has some mandate of a listed
    category, dated and without repeats. ``match="mandate"`` shows the mandates that are of
    a listed category themselves. A company may take several rows of ``orgs``, with its
    mandates spread over them, so the companies with a listed category are found apart, among
    those that were hit.
    """
    if match not in ("org", "mandate"):
        raise ValueError(f"unknown match {match!r}")
    rules = rules or (LAST if match == "org" else FIELD)
    people = country_persons(persons, cc, rules)
    if match == "mandate":
        listed = category_in(F.col("category"), categories)
        rows = _beside_mandates(people, orgs, rules, ["category"], listed)
        return rows.select(*PERSON_COLUMNS, *COMPANY_COLUMNS)
    dated = ["category", "start_date", "end_date"]
    hits = rest(_beside_mandates(people, orgs, rules, dated), "hits")
    having = orgs.filter(has_category(F.col("person_mandates"), categories)).select("vat")
    having = cut_to(having, hits, "vat")
    return distinct(
        hits.frame.join(having, "vat", "left_semi").select(
            *PERSON_COLUMNS,
            *COMPANY_COLUMNS,
            F.col("category").alias("mandate_category"),
            F.col("start_date").alias("mandate_start_date"),
            F.col("end_date").alias("mandate_end_date"),
        )
    )
