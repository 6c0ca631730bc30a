"""The same results when nothing may be broadcast and hot partitions are split."""

import pytest

import __spark_entry__ as entry
from checks.catalog import Registry
from checks.compare import differ, oracle
from orgtrail.operators.nested import flatten_mandate
from orgtrail.operators.sides import Side
from orgtrail.sources.derived import with_mandates

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

SHUFFLE_ALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
}


@pytest.fixture
def shuffled(spark, monkeypatch):
    monkeypatch.setattr(Side.fits, "__defaults__", (0, 0))
    for name, value in SHUFFLE_ALL.items():
        spark.conf.set(name, value)
    yield
    for name in SHUFFLE_ALL:
        spark.conf.unset(name)


@pytest.mark.parametrize(
    "name",
    [
        "country_admins_home_companies",
        "country_mandates_dated",
        "ownership_home_owns_target",
        "cc_target_owned_by_home",
        "cc_home_owned_by_target",
        "sector_financials",
        "vat_representatives",
        "portfolio_enriched",
        "join_inner_person_mandate",
        "join_left_person_names",
        "join_left_enrich_three",
    ],
)
def test_shuffled_joins_equal_the_oracle(spark, shuffled, sf_dir, name):
    problem, _ = differ(spark, oracle(sf_dir), name, sf_dir, QUERIES, ORACLES)
    assert problem is None


def test_small_pages_hold_the_same_mandates(spark, sf_dir):
    r = Registry(spark, sf_dir)
    paged = with_mandates(r.orgs(), r.mandates(), page_rows=3)
    assert paged.count() > r.orgs().count()

    def rows(orgs):
        return flatten_mandate(orgs.select("vat", "person_mandates"), outer=True)

    whole = rows(r.orgs_with_mandates())
    assert rows(paged).exceptAll(whole).count() == 0
    assert whole.exceptAll(rows(paged)).count() == 0
