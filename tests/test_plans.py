"""What the planned reports read, shuffle and broadcast."""

import pytest
from pyspark.sql import functions as F

from checks.catalog import QUERIES, Registry
from orgtrail.functions.countries import any_country
from orgtrail.functions.mandates import has_category
from orgtrail.operators import grouping as G
from orgtrail.operators.nested import flatten_participation, flatten_profit_loss, publication_keys
from orgtrail.plans import owners, people
from orgtrail.plans.portfolio import latest_accounts


@pytest.fixture(scope="module")
def r(spark, sf_dir):
    # Statistics must not decide for us: only a checked size may broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Registry(spark, sf_dir)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_few_people_mean_no_shuffle_of_mandates(r, capsys):
    shown = plan(people.country_admins(r.persons(), r.orgs_with_mandates(), "IR", "BE"), capsys)
    assert "BroadcastHashJoin" in shown
    assert "SortMergeJoin" not in shown and "hashpartitioning" not in shown


@pytest.mark.parametrize("owner,owned", [("BE", "IR"), ("IR", "BE")])
def test_ownership_shuffles_neither_side(r, capsys, owner, owned):
    shown = plan(owners.ownership(r.orgs(), [owner], [owned]), capsys)
    assert "BroadcastHashJoin" in shown and "hashpartitioning" not in shown


def test_latest_per_key_cuts_before_the_shuffle(r, capsys):
    named = publication_keys(r.publications())
    shown = plan(G.latest_per_key(named, "vat", ["publication_date"], 50), capsys)
    assert shown.count("WindowGroupLimit") >= 2


def test_scans_read_only_the_nested_fields_in_use(r, capsys):
    hists = F.col("address_hists")
    home = r.orgs().filter(any_country(hists, "BE", mode="field", empty_is_home=True)).select("vat")
    shown = plan(home, capsys)
    assert "country_code" in shown and "street:" not in shown
    listed = r.orgs_with_mandates().filter(has_category(F.col("person_mandates"), ["A"])).select("vat")
    shown = plan(listed, capsys)
    assert "category:string" in shown and "start_date:" not in shown
    parts = flatten_participation(r.orgs().select("vat", "participation_hists")).select("related_vat")
    shown = plan(parts, capsys)
    assert "related_vat:string" in shown and "percentage:" not in shown


def test_reports_read_only_the_mandate_fields_they_show(r, capsys):
    shown = plan(people.country_admins(r.persons(), r.orgs_with_mandates(), "IR", "BE"), capsys)
    assert "person_mandates:array<struct<pid:string,role:string>>" in shown
    accounts = flatten_profit_loss(r.accounts()).select("vat", "turnover")
    assert "balance_sheet" not in plan(accounts, capsys)
    latest = plan(latest_accounts(r.accounts()), capsys)
    assert "currency" not in latest and "operating_profit" not in latest


def test_no_python_and_no_cross_join_in_any_query(spark, sf_dir, capsys):
    for name, build in QUERIES.items():
        shown = plan(build(spark, sf_dir), capsys)
        for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in shown, name
