"""Reports on hand-made rows, and invariants on the derived registry."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.catalog import Registry
from orgtrail.functions import names as N
from orgtrail.functions.activities import clean_codes, has_activity_prefix, principal_activity
from orgtrail.functions.mandates import ADMINISTER, SHAREHOLDER, rep_type, role_in
from orgtrail.functions.text import nonblank
from orgtrail.operators.nested import flatten_mandate, unnest
from orgtrail.operators.sides import Side, rest
from orgtrail.plans import owners, people
from orgtrail.plans.representatives import representatives
from orgtrail.plans.sector import sector_financials
from orgtrail.sources.derived import with_mandates
from orgtrail.sources.keylists import vat_list
from tests import build as B


def collected(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)


def in_country(code):
    return [B.hist("2000-01-01", nl=B.address(code, street="S", number="1"))]


@pytest.fixture(scope="module")
def world(spark):
    persons = B.persons(
        spark,
        {"pid": "P1", "first_name": None, "last_name": "One", "name": "N1", "is_moral": False, "address_hists": in_country("IR")},
        {"pid": "P2", "last_name": None, "name": "N2", "is_moral": True, "address_hists": in_country(" ir ")},
        {"pid": "P3", "name": "N3", "is_moral": None, "address_hists": in_country("BE")},
    )
    orgs = B.orgs(
        spark,
        {
            "vat": "A", "name_nl": "", "name_fr": "Af", "address_hists": in_country("BE"),
            "person_mandates": [
                B.mandate("P1", "ADMINISTER", " administrator "),
                B.mandate("P1", "AUDITOR", "Manager", "2001-01-01", "2002-01-01"),
                B.mandate("P2", "SHAREHOLDER", "ADMINISTER"),
                B.mandate(None, "AUDITOR"),
                B.mandate("P9", "AUDITOR", end="2003-01-01"),
            ],
            "participation_hists": [{"related_vat": "B", "interests_type": "DIRECT", "percentage": 5.0, "source": "s"}],
        },
        {
            "vat": "B", "name_nl": "Bn", "address_hists": in_country("IR"),
            "person_mandates": [B.mandate("P1", "AUDITOR", "ADMINISTER")],
            "participation_hists": [{"related_vat": "A"}, {"related_vat": "Q"}],
        },
        {"vat": "C", "name": "Cc", "address_hists": in_country("")},
    )
    return persons, orgs


def test_admins_of_home_companies(world):
    found = people.country_admins(*world, "ir", "BE")
    assert collected(found, "pid", "first_name", "last_address", "vat") == [
        ("P1", "", "S,1,IR", "A"),
        ("P2", "", "S,1,ir", "A"),
    ]


def test_mandates_by_company_and_by_mandate(world):
    by_org = people.country_mandates(*world, "IR", [ADMINISTER])
    assert collected(by_org, "pid", "vat", "mandate_category") == [
        ("P1", "A", "ADMINISTER"),
        ("P1", "A", "AUDITOR"),
    ]
    by_mandate = people.country_mandates(*world, "IR", [ADMINISTER, SHAREHOLDER], "mandate")
    assert collected(by_mandate, "pid", "vat") == [("P1", "A")]
    with pytest.raises(ValueError):
        people.country_mandates(*world, "IR", [ADMINISTER], "person")


def test_paged_companies_give_the_same_mandates(spark, world):
    persons, orgs = world
    flat = flatten_mandate(orgs.select("vat", "person_mandates"))
    paged = with_mandates(orgs, flat, page_rows=1)
    assert paged.count() > orgs.count()
    for match in ("org", "mandate"):
        wanted = people.country_mandates(persons, orgs, "IR", [ADMINISTER], match)
        found = people.country_mandates(persons, paged, "IR", [ADMINISTER], match)
        assert collected(found, "*") == collected(wanted, "*")


def test_many_people_join_by_shuffle_to_the_same_rows(world, monkeypatch):
    wanted = collected(people.country_admins(*world, "IR", "BE"), "*")
    links = collected(owners.participation_links(world[1], "IR", "BE"), "*")
    monkeypatch.setattr(Side.fits, "__defaults__", (0, 0))
    assert collected(people.country_admins(*world, "IR", "BE"), "*") == wanted
    assert collected(owners.participation_links(world[1], "IR", "BE"), "*") == links


def test_broadcast_bounds_rows_and_bytes(spark):
    rows = spark.createDataFrame([("abc", [1, 2], 1), (None, None, 2)], "t string, a array<int>, n int")
    side = rest(rows, "rows")
    assert (side.rows, side.size) == (2, 3 + 2 * 8 + 2 * 8)
    assert side.fits(2, 35) and not side.fits(1, 35) and not side.fits(2, 34)
    assert rest(rows.limit(0), "none").fits(0, 0)


def test_ownership_names_and_directions(world):
    _, orgs = world
    there = owners.ownership(orgs, ["BE", ""], ["IR"])
    back = owners.ownership(orgs, ["IR"], ["BE", ""])
    assert collected(there, "owner_vat", "owner_name", "owned_vat") == [("A", "", "B")]
    assert collected(back, "owner_vat", "owned_vat") == [("B", "A")]
    swapped = collected(owners.ownership(orgs, ["BE"], ["IR"]), "owner_vat", "owned_vat")
    assert swapped == [("A", "B")]


def test_participation_links(world):
    _, orgs = world
    there = owners.participation_links(orgs, "IR", "BE")
    assert collected(there, "vat_home", "vat", "last_address", "type", "percentage") == [
        ("A", "B", "1,S,IR", "DIRECT", 5.0)
    ]
    back = owners.participation_links(orgs, "IR", "BE", owner="target")
    assert collected(back, "vat", "vat_home") == [("B", "A")]
    with pytest.raises(ValueError):
        owners.participation_links(orgs, "IR", "BE", owner="nobody")


def test_representatives_of_a_file(spark, world):
    persons, orgs = world
    keys = vat_list(spark, ["A", "C", "Q", "A"])
    found = representatives(orgs, persons, keys)
    shown = ["vat", "name", "representative_last_name", "representative_type", "representative_status"]
    assert collected(found, *shown) == [
        ("A", "", "", "", "current"),
        ("A", "", "", "", "previous"),
        ("A", "", "N2", "moral", "current"),
        ("A", "", "One", "physical", "current"),
        ("A", "", "One", "physical", "previous"),
        ("C", "Cc", "", "", "current"),
    ]


def test_representatives_of_a_list(spark, world):
    persons, orgs = world
    found = representatives(orgs, persons, vat_list(spark, ["A", "C"]), "list")
    assert collected(found, "vat_id", "name", "rep_type", "rep_status", "rep_category") == [
        ("A", "Af", "moral", "CURRENT", "AUDITOR"),
        ("A", "Af", "physical", "CURRENT", "ADMINISTER"),
        ("A", "Af", "physical", "CURRENT", "SHAREHOLDER"),
        ("A", "Af", "physical", "PREVIOUS", "AUDITOR"),
        ("A", "Af", "physical", "PREVIOUS", "AUDITOR"),
        ("C", "", "moral", "CURRENT", None),
    ]
    with pytest.raises(ValueError):
        representatives(orgs, persons, vat_list(spark, ["A"]), "other")


def activity(classification=None, label=None, code=None, nl=None, fr=None):
    return {"classification": classification, "type_label": label, "code": code, "description_nl": nl, "description_fr": fr}


def test_principal_activity_rules(spark):
    orgs = B.orgs(
        spark,
        {"vat": "A", "activities": [activity("nacebel", "x", "1", fr="f"), activity("NACEBEL_2008", "PRIMARY", "2", "n", "f")]},
        {"vat": "B", "activities": [activity("ISIC", "Primary", "3"), activity("NACEBEL", None, "4")]},
        {"vat": "C", "activities": [activity("old NACE", "a primary one", None, None, "f")]},
        {"vat": "D", "activities": None},
    )

    def codes(rule):
        chosen = orgs.select("vat", principal_activity(F.col("activities"), rule).alias("a"))
        return {row["vat"]: tuple(row["a"]) for row in chosen.collect()}

    assert codes("strict") == {"A": ("2", "n"), "B": ("4", ""), "C": ("", ""), "D": ("", "")}
    assert codes("contains") == {"A": ("2", "n"), "B": ("", ""), "C": ("", "f"), "D": ("", "")}
    with pytest.raises(ValueError):
        principal_activity(F.col("activities"), "loose")
    with_code = orgs.filter(has_activity_prefix(F.col("activities"), "2", "NACEBEL_2008"))
    assert collected(with_code, "vat") == [("A",)]
    assert orgs.filter(has_activity_prefix(F.col("activities"), "2", "ISIC")).count() == 0


def test_clean_codes(spark):
    rows = spark.createDataFrame(
        [([" 56101 ", "", "abc", "12345678901", "\t7\n", None, "1234567890 "],), (None,)], "codes array<string>"
    )
    found = [row[0] for row in rows.select(clean_codes(F.col("codes"))).collect()]
    assert found == [[" 56101 ", "\t7\n", "1234567890 "], []]


def test_scalar_fallbacks(spark):
    rows = spark.createDataFrame(
        [("a", "b", "c"), ("", "b", "c"), (None, "b", "c"), (None, None, "c"), (None, None, None)],
        "x string, y string, z string",
    )
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    shown = rows.select(
        N.first_name_of(x, y, z), N.first_nonempty(x, y), N.lookup_name(x, y), N.lookup_name(x, y, True),
        N.rep_last_name(x, z), N.legal_status(x, y),
    )
    assert [tuple(row) for row in shown.collect()] == [
        ("a", "a", "a", "a", "a", "a"),
        ("", "b", "", "", "", ""),
        ("b", "b", "", "b", "c", "b"),
        ("c", "", "", "", "c", None),
        ("", "", "", "", "", None),
    ]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "m boolean")
    assert [row[0] for row in flags.select(rep_type(F.col("m"))).collect()] == ["moral", "physical", ""]
    roles = spark.createDataFrame([(" administrator",), ("ADMIN",), (None,), ("\tadminister",)], "r string")
    assert [row[0] for row in roles.filter(role_in(F.col("r"))).collect()] == [" administrator"]
    blanks = spark.createDataFrame([(" ",), ("",), (None,), (" a",)], "k string")
    assert [row[0] for row in blanks.filter(nonblank(F.col("k"))).collect()] == [" a"]


def test_sector_keeps_companies_without_accounts_in_range(spark, monkeypatch):
    orgs = B.orgs(
        spark,
        {"vat": "B", "activities": [activity(code="5610")]},
        {"vat": "A", "activities": [activity(code="56")], "juridical_situation": "s"},
        {"vat": "C", "activities": [activity(code="156"), activity()]},
    )
    accounts = B.accounts(
        spark,
        {"vat": "A", "summaries": [{"period_end_date": date(y, 6, 30), "profit_loss": {}, "balance_sheet": {}} for y in (2021, 2019, 2018)]},
        {"vat": "B", "summaries": [{"period_end_date": date(2024, 1, 1), "profit_loss": {}, "balance_sheet": {}}]},
    )
    wanted = [("A", "s", 2019), ("A", "s", 2021), ("B", None, None)]
    report = sector_financials(orgs, accounts, "56", 2019, 2023)
    assert [tuple(row) for row in report.select("vat", "legal_status", "year").collect()] == wanted
    monkeypatch.setattr(Side.fits, "__defaults__", (0, 0))
    report = sector_financials(orgs, accounts, "56", 2019, 2023)
    assert [tuple(row) for row in report.select("vat", "legal_status", "year").collect()] == wanted


def test_invariants_on_the_derived_registry(spark, sf_dir):
    r = Registry(spark, sf_dir)
    orgs = r.orgs_with_mandates()
    inner, outer = flatten_mandate(orgs), unnest(orgs, "person_mandates", outer=True)
    assert inner.count() <= outer.count()
    assert outer.select("vat").distinct().count() == r.orgs().count()
    any_ir = r.persons().filter(people.LAST.matches("CN")).select("pid")
    last = people.country_persons(r.persons(), "CN", people.LAST).select("pid")
    assert last.subtract(any_ir).count() == 0
    assert r.orgs().groupBy("vat").count().filter("count > 1").count() == 0
