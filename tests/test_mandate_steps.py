"""What is shuffled for mandates: numbers before text, arrays once."""

import pytest
from pyspark.sql import functions as F

from orgtrail.operators import grouping as G
from orgtrail.sources import derived

KEYS = [0, 1, 5, 23, 46, 58, 483023, None, -7, 12345678901, 12345678902]
#: Mandates by their definition on text, repeats removed last.
WIDE = """
select distinct concat('BE', lpad(cast(o_custkey as string), 10, '0')) as vat,
  case when b % 23 = 0 then null when b % 29 = 0 then concat('Q', l_suppkey) else concat('P', l_suppkey) end as pid,
  case b % 3 when 0 then 'ADMINISTER' when 1 then 'SHAREHOLDER' else 'AUDITOR' end as category,
  case b % 4 when 0 then ' administrator' when 1 then 'Administer ' when 2 then 'Manager' else null end as role,
  if(b % 5 = 0, null, concat('Function ', b % 7)) as function,
  date_add(date'2000-01-01', d) as start_date, if(b % 2 = 0, null, date_add(date'2003-01-01', d)) as end_date
from (select *, o_custkey + l_suppkey as b, cast((o_custkey * 7 + l_suppkey) % 7000 as int) as d
      from orders join lines on o_orderkey = l_orderkey)"""


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines"))
    orders = [(at, key) for at, key in enumerate(KEYS * 2)] + [(None, 3), (900, 4)]
    lines = [(at, key + more if key is not None else None) for at in range(len(KEYS) * 2) for key in KEYS for more in (0, 23, 0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([*lines, (None, 2)], "l_orderkey long, l_suppkey long").write.parquet(f"{path}/lineitem.parquet")
    return path


def test_mandates_equal_their_definition_on_text(spark, folder):
    found = derived.mandates(spark, folder)
    spark.read.parquet(f"{folder}/orders.parquet").createOrReplaceTempView("orders")
    spark.read.parquet(f"{folder}/lineitem.parquet").createOrReplaceTempView("lines")
    wanted = spark.sql(WIDE)
    assert found.columns == wanted.columns and found.count() == wanted.count() > 100
    assert found.exceptAll(wanted).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_repeats_of_mandates_go_as_numbers(spark, folder):
    keys = [line for line in plan(derived.mandates(spark, folder)).splitlines() if "HashAggregate(keys=" in line]
    assert len(keys) == 2 and all("keys=[company#" in line for line in keys)


def test_tasks_grow_with_the_lines(spark, folder, monkeypatch):
    monkeypatch.setattr(G, "TASK_ROWS", 100)
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count() - 1
    assert f", {-(-lines // 100)}), REPARTITION_BY_NUM" in plan(derived.mandates(spark, folder))


def test_gathered_arrays_are_not_shuffled_again_for_the_join(spark, monkeypatch):
    monkeypatch.setattr(G, "TASK_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        orgs = spark.range(30).select(F.concat(F.lit("C"), "id").alias("vat"))
        rows = spark.range(90).select(
            F.concat(F.lit("C"), F.col("id") % 29).alias("vat"), F.lit("x").alias("category"), F.col("id").alias("pid")
        )
        folded = G.attach_sorted(orgs, rows, "vat", ["pid"], ["pid", "category"], "items")
        arrays = [line for line in plan(folded).splitlines() if "Exchange" in line]
        assert len(arrays) == 2
        found = {r["vat"]: [tuple(i) for i in r["items"]] for r in folded.collect()}
        assert found["C3"] == [(3, "x"), (32, "x"), (61, "x")] and found["C29"] == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
