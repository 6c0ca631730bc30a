"""Picking from address histories, countries and address texts, on hand-made rows."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from orgtrail.functions import addresses as A
from orgtrail.functions.countries import addr, any_country, country_field, first_country, norm_country
from tests import build as B

HERE, THERE = B.address("IR", number="1"), B.address("BE", number="2")


def numbered(*spans):
    return [B.hist(start, end, nl=B.address(number=str(i))) for i, (start, end) in enumerate(spans)]


def pick(spark, how, hists):
    rows = B.orgs(spark, {"vat": "A", "address_hists": hists})
    found = rows.select(how(F.col("address_hists")).alias("hist")).first()["hist"]
    return None if found is None else int(found["address_nl"]["number"])


def test_equal_open_entries_give_the_later_one(spark):
    hists = numbered(("2000-01-01", None), ("2000-01-01", None))
    assert pick(spark, A.latest_hist, hists) == 1
    assert pick(spark, A.current_or_latest_hist, hists) == 1


def test_missing_start_is_the_epoch_in_one_rule_and_lowest_in_the_other(spark):
    hists = numbered((None, None), ("1960-01-01", None))
    assert pick(spark, A.latest_hist, hists) == 0
    assert pick(spark, A.current_or_latest_hist, hists) == 1


def test_picks_without_open_or_closed_entries(spark):
    closed = numbered(("2001-01-01", "2002-01-01"), ("2000-01-01", "2003-01-01"))
    assert pick(spark, A.current_or_latest_hist, closed) == 0
    assert pick(spark, A.first_open_or_last_hist, closed) == 1
    assert pick(spark, A.previous_hist, closed) == 1
    still_open = numbered(("2001-01-01", None), ("2000-01-01", None))
    assert pick(spark, A.previous_hist, still_open) is None
    assert pick(spark, A.last_closed_hist, still_open) is None
    assert pick(spark, A.first_open_or_last_hist, still_open) == 0


PICKS = (
    A.latest_hist,
    A.current_or_latest_hist,
    A.first_open_or_last_hist,
    A.previous_hist,
    A.last_closed_hist,
    A.last_hist,
)


@pytest.mark.parametrize("how", PICKS)
@pytest.mark.parametrize("hists", [None, []])
def test_no_history_gives_null(spark, how, hists):
    assert pick(spark, how, hists) is None


def brute(spans):
    """The six picks by plain sorting; a stable sort keeps the later of equals last."""
    far, epoch, low = date.max, date(1970, 1, 1), date.min
    rows = list(enumerate(spans))
    still_open = [row for row in rows if row[1][1] is None]
    closed = [row for row in rows if row[1][1] is not None]

    def last(found):
        return found[-1][0] if found else None

    return [
        last(sorted(rows, key=lambda row: (row[1][1] or far, row[1][0] or epoch))),
        last(sorted(still_open or rows, key=lambda row: row[1][0] or low)),
        still_open[0][0] if still_open else last(rows),
        last(sorted(closed, key=lambda row: row[1][1])),
        last(closed),
        last(rows),
    ]


def test_picks_on_random_histories(spark):
    rng = random.Random(7)

    def day():
        return rng.choice([None, "1955-01-01", "1970-01-01", "1999-12-31", "2010-06-01"])

    cases = [[(day(), day()) for _ in range(rng.randrange(6))] for _ in range(300)]
    rows = B.orgs(spark, *[{"vat": str(at), "address_hists": numbered(*spans)} for at, spans in enumerate(cases)])
    shown = [how(F.col("address_hists"))["address_nl"]["number"].cast("int").alias(f"p{i}") for i, how in enumerate(PICKS)]
    found = {int(row["vat"]): list(row[1:]) for row in rows.select("vat", *shown).collect()}
    for at, spans in enumerate(cases):
        dated = [tuple(None if text is None else date.fromisoformat(text) for text in span) for span in spans]
        assert found[at] == brute(dated), spans


def test_sort_hists(spark):
    hists = numbered(("2001-01-01", None), (None, "2005-01-01"), ("2000-01-01", "2005-01-01"), (None, None))
    rows = B.orgs(spark, {"vat": "A", "address_hists": hists})

    def order(by):
        found = rows.select(A.sort_hists(F.col("address_hists"), by).alias("hists")).first()["hists"]
        return [int(hist["address_nl"]["number"]) for hist in found]

    assert order("end_start") == [1, 2, 3, 0]
    assert order("start") == [1, 3, 2, 0]
    assert order("end") == [0, 3, 1, 2]


def matches(spark, hists, cc, **rules):
    rows = B.orgs(spark, {"vat": "A", "address_hists": hists})
    return rows.filter(any_country(F.col("address_hists"), cc, **rules)).count() == 1


def test_country_by_address_and_by_field(spark):
    hists = [B.hist(nl=B.address(None), fr=HERE)]
    assert not matches(spark, hists, "IR")
    assert matches(spark, hists, "IR", mode="field")


def test_country_trimming(spark):
    padded = [B.hist(nl=B.address("\t ir "))]
    assert matches(spark, padded, "ir ")
    assert not matches(spark, padded, "IR", trim=False)
    assert not matches(spark, padded, "IR", mode="field")
    assert matches(spark, [B.hist(fr=B.address("ir"))], "IR", trim=False)


def test_blank_country_is_none_by_address(spark):
    blank = [B.hist(nl=B.address(" "))]
    assert not matches(spark, blank, "")
    assert matches(spark, [B.hist(nl=B.address(""))], "", trim=False)


def test_home_strict_and_home_or_empty(spark):
    blank, gone = [B.hist(nl=B.address(""))], [B.hist()]
    for hists in (blank, gone):
        assert not matches(spark, hists, "BE")
        assert matches(spark, hists, "BE", mode="field", empty_is_home=True)
        assert matches(spark, hists, "BE", mode="struct", empty_is_home=True)
    assert matches(spark, [B.hist(nl=THERE)], "BE")
    for hists in ([], None):
        assert not matches(spark, hists, "BE", mode="field", empty_is_home=True)


def test_country_columns(spark):
    hists = [B.hist(nl=B.address(None), fr=B.address(" be ")), B.hist(nl=HERE)]
    rows = B.orgs(spark, {"vat": "A", "address_hists": hists}, {"vat": "B"}, {"vat": "C", "address_hists": [B.hist()]})
    first = {row["vat"]: row["cc"] for row in rows.select("vat", first_country(F.col("address_hists")).alias("cc")).collect()}
    assert first == {"A": "BE", "B": None, "C": None}
    entry = rows.filter("vat = 'A'").select(F.col("address_hists")[0].alias("h"))
    row = entry.select(
        country_field(F.col("h")).alias("field"), norm_country(addr(F.col("h"))["country_code"]).alias("norm")
    ).first()
    assert (row["field"], row["norm"]) == (" be ", "")


def text(spark, address, style):
    rows = B.orgs(spark, {"vat": "A", "address_nl": address})
    return rows.select(A.fmt_address(F.col("address_nl"), style).alias("t")).first()["t"]


FULL = B.address(" BE", street=" Main ", number="7", box="b", zip_code="1000", city="", province="P")
STYLES = {
    "comma_trim": "Main,7,1000,b,BE",
    "comma_nulls": "7, Main ,1000,,P, BE",
    "concat_ws": "7, Main ,1000,,P, BE",
    "comma_space": " Main , 7, 1000,  BE",
    "line": "Main  7 b",
    "full": "Main  7 b, 1000 ,  BE",
}


@pytest.mark.parametrize("style", STYLES)
def test_address_text(spark, style):
    assert text(spark, FULL, style) == STYLES[style]
    assert text(spark, None, style) == (None if style == "comma_nulls" else "")
    assert text(spark, B.address(), style) == (",  , " if style == "full" else "")


def test_unknown_style_mode_and_rule(spark):
    with pytest.raises(ValueError):
        A.fmt_address(F.col("x"), "round")
    with pytest.raises(ValueError):
        any_country(F.col("x"), "BE", mode="loose")
