"""Sides at rest, bitmap cuts, heavy keys, key checks, numbering of hot keys, sorted parts."""

import os

import pytest
from pyspark.sql import functions as F

from orgtrail.operators import joins as J
from orgtrail.operators import sides as S
from orgtrail.operators.grouping import collect_sorted, numbered
from orgtrail.operators.keys import repeated_keys, require_companies, require_unique
from orgtrail.plans.portfolio import latest_publications
from orgtrail.session import drop_dir, scratch_dir, scratch_released
from orgtrail.sources.sinks import read_csv_sorted, read_manifest, write_csv_sorted
from tests import build as B


def plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture
def long_lists(monkeypatch):
    """Nothing fits a broadcast."""
    monkeypatch.setattr(S.Side.fits, "__defaults__", (0, 0))


@pytest.fixture
def no_adaptive(spark):
    for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
        spark.conf.set(name, {"spark.sql.adaptive.enabled": "false"}.get(name, "-1"))
    yield
    for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
        spark.conf.unset(name)


def test_a_side_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = spark.sparkContext.parallelize([(i, "x" * i) for i in range(10)], 3).map(lambda r: (seen.add(1), r)[1])
    side = S.rest(spark.createDataFrame(rows, "n int, t string"), "once")
    assert (side.rows, side.size) == (10, 10 * 8 + 45)
    joined = J.sized_join(spark.range(5).withColumnRenamed("id", "n"), side, "n")
    assert joined.count() == 5 and seen.value == 10


def test_widths_of_nested_values(spark):
    rows = spark.sql("select array(named_struct('a', 'xy', 'b', 1L), null) s, map('k', array('v', null)) m, cast(null as string) t")
    assert S.rest(rows, "nested").size == 2 + 8 + 8 + 2


@pytest.mark.parametrize("n_keys", [0, 1, 400, 5000])
def test_bitmap_loses_no_listed_row_and_few_others_pass(spark, n_keys):
    side = S.rest(spark.range(n_keys).select((F.col("id") * 7).cast("string").alias("k")), "keys")
    rows = spark.range(60_000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("_x"))
    passed = {r["k"] for r in S.maybe_listed(rows, side, "k").collect()}
    wanted = {str(7 * i) for i in range(n_keys)} & {str(i) for i in range(60_000)}
    assert wanted <= passed and len(passed - wanted) < 0.06 * 60_000
    assert S.key_bitmap(side, "k").count() == S._chunks(n_keys)


def test_bitmap_is_bounded_at_any_number_of_keys():
    assert S._chunks(10**12) * S.CHUNK_BITS == S.MAX_BITMAP_BYTES * 8
    assert S._chunks(0) == 1


def test_long_lists_cut_tables_before_their_exchange(spark, sf_dir, capsys, long_lists, no_adaptive):
    from checks.catalog import Registry

    r = Registry(spark, sf_dir)
    keys = S.rest(r.keys(), "keys")
    for table in (r.accounts(), r.establishments(), r.orgs_with_mandates()):
        shown = plan(J.restrict(table, keys), capsys).split("== Physical Plan ==")[1]
        tree = shown.split("\n\n")[0]
        # Read from above: the exact join, its exchange, the bitmap's join, then the table's scan.
        order = [tree.index(word) for word in ("SortMergeJoin LeftSemi", "Exchange", "BroadcastHashJoin LeftSemi", "Scan parquet")]
        assert order == sorted(order)
        wanted = table.join(r.keys(), "vat", "left_semi")
        assert J.restrict(table, keys).select("vat").exceptAll(wanted.select("vat")).isEmpty()
        assert J.restrict(table, keys).count() == wanted.count()
    tree = plan(latest_publications(r.publications(), keys), capsys)
    tree = tree.split("== Physical Plan ==")[1].split("\n\n")[0]
    order = [tree.index(word) for word in ("SortMergeJoin LeftSemi", "Exchange", "BroadcastHashJoin LeftSemi", "Scan parquet")]
    assert order == sorted(order)


def test_a_heavy_person_is_split_without_adaptive_execution(spark, no_adaptive):
    mandates = spark.range(3000).select(
        F.when(F.col("id") % 10 < 3, F.lit("HOT")).when(F.col("id") % 97 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("P"), F.col("id") % 500)
        ).alias("pid"),
        F.col("id").alias("m"),
    )
    persons = spark.range(400).select(F.concat(F.lit("P"), "id").alias("pid"), F.col("id").alias("p")).union(
        spark.createDataFrame([("HOT", 9999), (None, 7)], "pid string, p long")
    )
    assert J.heavy_keys(mandates, "pid", 16).keys() == {"HOT"}
    for how in ("inner", "left"):
        joined = J.spread_join(mandates, persons, "pid", how, J.heavy_keys(mandates, "pid", 16))
        wanted = mandates.join(persons, "pid", how)
        assert joined.exceptAll(wanted).isEmpty() and joined.count() == wanted.count()
        tasks = joined.filter("pid = 'HOT'").groupBy(F.spark_partition_id()).count().count()
        assert tasks > 1
    assert J.heavy_keys(mandates.limit(0), "pid", 16) == {}


def test_persons_beyond_the_bound_give_the_same_names(spark, long_lists):
    persons = S.rest(spark.createDataFrame([("a", 1), ("b", 2)], "pid string, x int"), "persons")
    mandates = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("q", 4), ("q", 4)], "pid string, m int")
    found = sorted((tuple(r) for r in J.add_person_names(mandates, persons).select("pid", "m", "x").collect()), key=repr)
    assert found == sorted([("a", 1, 1), ("a", 2, 1), (None, 3, None), ("q", 4, None), ("q", 4, None)], key=repr)
    assert sorted(tuple(r) for r in J.join_mandates(persons, mandates).collect()) == [("a", 1, 1), ("a", 1, 2)]


def test_repeated_keys_are_reported(spark):
    rows = spark.createDataFrame(
        [("a", 1), ("a", 1), ("b", 1), ("c", 1), ("c", 2), ("c", 2), (None, 1), (None, 2)], "k string, v int"
    )
    assert sorted(tuple(r) for r in repeated_keys(rows, "k").collect()) == [("a", 2, 1), ("c", 3, 1)]
    assert [tuple(r) for r in repeated_keys(rows, "k", ["v"]).collect()] == [("c", 3, 2)]
    assert repeated_keys(rows.filter("k = 'b'"), "k").collect() == []
    assert repeated_keys(rows.limit(0), "k", ["v"]).collect() == []
    with pytest.raises(ValueError, match="things: 2 repeated k, such as 'c', 'a'"):
        require_unique(rows, "k", "things")
    require_unique(rows.filter("k in ('a', 'b')"), "k", "things", ["v"])


def test_company_pages_pass_and_other_repeats_do_not(spark):
    page = {"vat": "A", "name_nl": "n", "address_hists": [B.hist("2000-01-01")]}
    require_companies(B.orgs(spark, {**page, "person_mandates": [B.mandate("P1")]}, page, {"vat": "B"}, {"vat": None}, {"vat": None}))
    with pytest.raises(ValueError, match="organisations: 1 repeated vat, such as 'A'"):
        require_companies(B.orgs(spark, page, {**page, "address_hists": [B.hist("2001-01-01")]}, {"vat": "B"}))


def hot_rows(spark, n=4000):
    """A third of all rows has one key; dates and ids order a key, some dates are missing."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("k"),
        F.when(F.col("id") % 11 != 0, F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") * 37 % 500).cast("int"))).alias("d"),
        F.col("id"),
    ).repartition(5)


def test_a_hot_key_is_numbered_by_several_tasks(spark, no_adaptive):
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        rows = hot_rows(spark)
        found = numbered(rows, "k", ["d", "id"], "n").withColumn("task", F.spark_partition_id()).collect()
        assert len(found) == 4000
        by_key = {}
        for r in found:
            by_key.setdefault(r["k"], []).append(((r["d"] is not None, r["d"], r["id"]), r["n"]))
        for items in by_key.values():
            items.sort(key=lambda item: (item[0][0], str(item[0][1]), item[0][2]))
            assert [n for _, n in items] == list(range(len(items)))
        assert len({r["task"] for r in found if r["k"] == "HOT"}) > 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_pages_equal_one_sort_cut_in_pages(spark):
    rows = hot_rows(spark, 900)
    whole = {r["k"]: r["v"] for r in collect_sorted(rows, "k", ["d", "id"], F.col("id"), "v").collect()}
    pages = collect_sorted(rows, "k", ["d", "id"], F.col("id"), "v", page_rows=7).collect()
    assert len(pages) == sum(-(-len(v) // 7) for v in whole.values())
    for r in pages:
        assert r["v"] == whole[r["k"]][7 * r["page"] : 7 * r["page"] + 7]
    with pytest.raises(ValueError):
        collect_sorted(rows, "k", ["d", "id"], F.col("id"), "v", page_rows=0)
    assert collect_sorted(rows.limit(0), "k", ["d", "id"], F.col("id"), "v", page_rows=7).collect() == []


def test_parts_in_manifest_order_are_the_global_sort(spark, tmp_path):
    rows = hot_rows(spark, 1000).withColumn("t", F.when(F.col("id") % 5 == 0, F.lit('a;"b"')))
    path = str(tmp_path / "sorted")
    write_csv_sorted(rows, path, ["k", "d", "id"], parts=6)
    parts = read_manifest(spark, path).collect()
    assert len(parts) > 1 and [p["part"] for p in parts] == sorted(p["part"] for p in parts)
    found = []
    for part in parts:
        folder = f"{path}/part={part['part']}"
        files = [name for name in os.listdir(folder) if name.endswith(".csv")]
        assert len(files) == 1
        got = spark.read.option("header", True).option("sep", ";").schema(rows.schema).csv(folder).collect()
        assert len(got) == part["rows"]
        assert (got[0]["k"], got[0]["id"]) == (part["first"]["k"], part["first"]["id"])
        assert (got[-1]["k"], got[-1]["id"]) == (part["last"]["k"], part["last"]["id"])
        found += [tuple(r) for r in got]
    assert found == [tuple(r) for r in rows.orderBy(*[F.asc_nulls_first(c) for c in ("k", "d", "id")]).collect()]
    assert read_csv_sorted(spark, path, rows.schema).count() == 1000


def test_scratch_is_released_at_the_end_of_the_block(spark):
    kept = scratch_dir(spark, "kept")
    spark.range(3).write.parquet(kept)
    with scratch_released(spark):
        inside = S.rest(spark.range(5), "inside")
        assert inside.frame.count() == 5
        path = inside.frame.inputFiles()[0]
    assert not os.path.exists(path.removeprefix("file://"))
    assert spark.read.parquet(kept).count() == 3
    drop_dir(spark, kept)
    assert not os.path.exists(kept.removeprefix("file:"))


def test_bits_and_zeros_of_a_bitmap_are_merged_by_one_shuffle(spark):
    side = S.rest(spark.range(400).select(F.col("id").alias("k")), "keys")
    plan = S.key_bitmap(side, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
