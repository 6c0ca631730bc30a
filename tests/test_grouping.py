"""Arrays per key, pages of hot keys and latest rows, against brute force."""

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from orgtrail.functions.records import account_export, latest_in_array
from orgtrail.operators import grouping as G
from orgtrail.operators.nested import publication_keys
from orgtrail.plans.portfolio import latest_accounts, portfolio
from orgtrail.sources.derived import with_mandates
from orgtrail.sources.keylists import vat_list
from tests import build as B


def skewed(n=400, seed=3):
    """Rows of which key A holds a third, many of these without a date or on one date."""
    rng = random.Random(seed)
    days = [None, date(2000, 1, 1), date(2000, 1, 1)] + [date(1990, 1, 1) + timedelta(d) for d in range(40)]
    keys = ["A"] * (n // 3) + [rng.choice("BCDEFGH") for _ in range(n - n // 3)]
    return [(key, rng.choice(days), at) for at, key in enumerate(keys)]


def by_key(rows):
    groups = defaultdict(list)
    for key, day, at in rows:
        groups[key].append((day, at))
    return {
        key: sorted(items, key=lambda item: (item[0] is not None, item[0] or date.min, item[1]))
        for key, items in groups.items()
    }


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(skewed(), "vat string, start_date date, id int")


ORDER = ["start_date", "id"]


def test_one_page_per_key_when_nothing_is_big(table):
    found = G.collect_sorted(table, "vat", ORDER, F.struct("start_date", "id"), "items").collect()
    assert {row["page"] for row in found} == {0}
    assert {row["vat"]: [tuple(item) for item in row["items"]] for row in found} == by_key(skewed())


@pytest.mark.parametrize("page_rows", [7, 20, 60])
def test_pages_hold_every_row_once_in_order(table, page_rows):
    found = G.collect_sorted(table, "vat", ORDER, F.struct("start_date", "id"), "items", page_rows).collect()
    wanted = by_key(skewed())
    pages = defaultdict(dict)
    for row in found:
        pages[row["vat"]][row["page"]] = [tuple(item) for item in row["items"]]
    for key, items in wanted.items():
        got = [pages[key][page] for page in sorted(pages[key])]
        assert sorted(sum(got, []), key=str) == sorted(items, key=str)
        days = [day for page in got for day, _ in page]
        assert days == [day for day, _ in items]
        if len(items) <= page_rows:
            assert list(pages[key]) == [0]
        else:
            assert len(pages[key]) > 1
            # A page begun by earlier steps may take in one share of a split step.
            assert max(len(page) for page in got) <= 4 * page_rows


def test_attach_keeps_rows_without_items_and_repeats_per_page(spark, table):
    left = spark.createDataFrame([("A", 1), ("B", 2), ("Z", 3)], "vat string, n int")
    value = F.struct("start_date", "id")
    found = G.attach_sorted(left, table, "vat", ORDER, value, "items", 20).collect()
    wanted = by_key(skewed())
    for key in "AB":
        rows = [row for row in found if row["vat"] == key]
        assert sum(len(row["items"]) for row in rows) == len(wanted[key])
        assert sorted(row["page"] for row in rows) == sorted({row["page"] for row in rows})
    (none,) = [row for row in found if row["vat"] == "Z"]
    assert (none["page"], none["items"]) == (0, [])


def test_rows_without_a_key_are_left_out(spark):
    rows = spark.createDataFrame([(None, None, 1), ("A", None, 2)], "vat string, start_date date, id int")
    found = G.collect_sorted(rows, "vat", ORDER, F.struct("id"), "items").collect()
    assert [row["vat"] for row in found] == ["A"]


def test_latest_per_key_on_a_hot_key(table):
    found = G.latest_per_key(table, "vat", ORDER, 5).collect()
    got = by_key([(row["vat"], row["start_date"], row["id"]) for row in found])
    assert got == {key: items[-5:] for key, items in by_key(skewed()).items()}


def publication(number, day, *vats, subjects=None):
    return {
        "publication_number": f"{number:08d}",
        "publication_date": day,
        "subjects": subjects,
        "organizations": [{"vat": vat} for vat in vats],
    }


def test_fifty_and_fifty_one_publications(spark):
    day = date(2020, 1, 1)
    rows = [publication(n, day + timedelta(min(n, 48)), "A", "A", None) for n in range(50)]
    rows += [publication(100 + n, day + timedelta(min(n, 49)), "B") for n in range(51)]
    rows.append({**publication(900, day), "organizations": None})
    named = publication_keys(B.publications(spark, *rows))
    assert named.count() == 101
    order = ["publication_date", "publication_number"]
    found = G.collect_latest(named, "vat", order, 50, F.col("publication_number"), "numbers")
    numbers = {row["vat"]: [int(n) for n in row["numbers"]] for row in found.collect()}
    assert numbers == {"A": list(range(50)), "B": list(range(101, 151))}


def account(year, turnover=None):
    return {
        "period_end_date": date(year, 12, 31),
        "profit_loss": {"turnover": turnover},
        "balance_sheet": {},
    }


def test_latest_accounts(spark):
    rows = B.accounts(
        spark,
        {"vat": "A", "summaries": [account(y) for y in (2003, 2001, 2004, 2002)]},
        {"vat": "B", "summaries": [account(y) for y in (2006, 2001, 2005, 2002, 2004, 2003)]},
        {"vat": "C", "summaries": []},
        {"vat": "D", "summaries": None},
        {"vat": "E", "summaries": [account(2001, float(n)) for n in range(6)]},
    )
    found = {row["vat"]: row[1] for row in latest_accounts(rows).collect()}
    years = {vat: [a["period_end_date"].year for a in items] for vat, items in found.items()}
    assert years["A"] == [2001, 2002, 2003, 2004]
    assert years["B"] == [2002, 2003, 2004, 2005, 2006]
    assert years["C"] == [] and years["D"] == []
    assert [a["turnover"] for a in found["E"]] == [1.0, 2.0, 3.0, 4.0, 5.0]
    one = rows.select(latest_in_array(account_export(F.col("summaries")), "period_end_date", 1).alias("a"))
    assert {len(row["a"]) for row in one.collect()} == {0, 1}


def test_portfolio_pages_hold_every_establishment(spark):
    sites = B.establishments(
        spark,
        *[{"vat": "A", "est_id": n, "name_nl": str(n), "start_date": date(2000, 1, 1 + n % 9)} for n in range(90)],
        *[{"vat": "B", "est_id": 500 + n, "name_nl": str(n), "start_date": None} for n in range(3)],
        {"vat": "X", "est_id": 900},
    )
    orgs = B.orgs(spark, {"vat": "A"}, {"vat": "B"}, {"vat": "C"}, {"vat": "X"})
    made = date(2024, 1, 1)
    documents = portfolio(
        orgs,
        B.accounts(spark, {"vat": "A", "summaries": [account(2001)]}),
        sites,
        B.publications(spark, publication(1, made, "A")),
        vat_list(spark, ["A", "B", "C", "Q"]),
        made,
        page_rows=20,
    ).collect()
    names = defaultdict(list)
    for row in documents:
        names[row["vat"]].append([int(site["name_nl"]) for site in row["establishments"]])
        head = row["vat"] == "A" and row["page"] == 0
        assert len(row["annual_account_summaries_5y"]) == head
        assert len(row["publications"]) == head
        assert row["nacebel_codes"] == []
    assert names.keys() == {"A", "B", "C"}
    assert sorted(sum(names["A"], [])) == list(range(90)) and len(names["A"]) > 1
    assert names["B"] == [[0, 1, 2]] and names["C"] == [[]]


def test_mandates_folded_in_pages(spark):
    flat = spark.createDataFrame(
        [("A", f"P{n}", "ADMINISTER", None, None, date(2000, 1, 1 + n % 5), None) for n in range(60)]
        + [("B", "P1", "AUDITOR", None, None, date(2000, 1, 1), None)],
        "vat string, pid string, category string, role string, function string, start_date date, end_date date",
    )
    orgs = B.orgs(spark, {"vat": "A"}, {"vat": "B"}, {"vat": "C"})
    rows = with_mandates(orgs, flat, page_rows=8).collect()
    pids = [m["pid"] for row in rows if row["vat"] == "A" for m in row["person_mandates"]]
    assert sorted(pids) == sorted(f"P{n}" for n in range(60))
    assert sum(row["vat"] == "A" for row in rows) > 1
    assert [len(row["person_mandates"]) for row in rows if row["vat"] in "BC"] in ([1, 0], [0, 1])
