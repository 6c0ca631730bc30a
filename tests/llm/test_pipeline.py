"""The pipeline's stages against brute force, on the whole smallest table."""

import corpus_pipeline as P
from pyspark.sql import functions as F
from tests.llm.build import docs, rows

from orgtrail.llm import decontamination, quality
from orgtrail.llm import ngram_join as J
from orgtrail.llm.common import read_table

SF = "/root/testdata/sf0.001"
NAMES = ("doc_id", "text", "lang", "source", "n_chars")


def kept(frame):
    return {r.doc_id for r in frame.collect()}


def test_stages_in_the_given_order():
    assert [name for name, _ in P.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_first_stage_rejects_what_the_model_rejects(spark):
    given = read_table(spark, SF, "documents")
    model = quality.fit_quality(quality.training_part(given), read_table(spark, SF, "labels"))
    out = P.good(spark, given, SF)
    features = quality.Featurizer()
    want = {r.doc_id for r in given.collect() if model.score(features(r.text)) >= 0.5}
    assert kept(out) == want and out.columns == given.columns
    assert 0 < len(want) < given.count()


def test_near_duplicates_keep_one_of_each_group(spark):
    given = read_table(spark, SF, "documents")
    sets = {r.doc_id: set(J.shingle_set(r.text, 5).tolist()) for r in given.collect()}
    least = {i: i for i in sets}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in sets:
        for j in sets:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                least[max(a, b)] = min(a, b)
    out = P.distinct_texts(spark, given, SF)
    assert kept(out) == {i for i in sets if find(i) == i} and out.columns == given.columns
    assert len(kept(out)) < len(sets)


def test_leaks_leave(spark):
    given, items = read_table(spark, SF, "documents"), read_table(spark, SF, "benchmark")
    leaks = {r.doc_id for r in decontamination.find_leaks(given, items).collect()}
    out = P.clean(spark, given, SF)
    assert kept(out) == kept(given) - leaks and leaks and out.columns == given.columns


def test_each_stage_works_on_what_the_last_kept(spark):
    found = P.run(spark, SF)
    assert {"shard", "slot", *NAMES} <= set(found.columns)
    left = read_table(spark, SF, "documents")
    for _, stage in P.STAGES[:3]:
        left = stage(spark, left, SF)
    assert kept(found) <= kept(left)
    slots = rows(found, "shard", "slot")
    assert len(set(slots)) == len(slots)
    assert found.groupBy("shard").agg(F.max("slot").alias("m"), F.count("*").alias("n")).filter("m + 1 <> n").count() == 0


def test_stages_bear_nulls_repeats_and_no_rows(spark):
    given = docs(spark, [None, "", "a b c", "a b c", "word " * 30_000], sources=[None, "a", "a", "a", "b"])
    given = given.unionByName(given).unionByName(
        spark.createDataFrame([(None, "no id at all", None, None, None)], given.schema)
    )
    for frame in (given, given.filter("false")):
        for name, stage in P.STAGES:
            out = stage(spark, frame, SF)
            if name != "sharding":
                assert out.columns == frame.columns
            assert out.count() <= frame.count() * 3
    for name, stage in P.STAGES[:-1]:
        more = given.selectExpr("*", "'x' as score", "1 as cls", "2 as size", "3 as label", "4 as shard")
        assert stage(spark, more, SF).columns == more.columns, name


def test_one_row_of_each_group_for_repeats_reused_ids_and_nulls(spark):
    passage, lone = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    given = [(1, passage), (1, passage), (2, passage), (2, lone), (None, passage), (None, "p q r s t u"), (None, "p q r s t u"), (None, None)]
    frame = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in given], "doc_id long, text string, lang string, source string, n_chars long")
    want = [(1, passage), (2, lone), (None, "p q r s t u"), (None, None)]
    assert rows(P.distinct_texts(spark, frame, SF), "doc_id", "text") == sorted(want, key=repr)


def test_rows_without_an_id_are_mixed_one_by_one(spark):
    texts = [f"{w} " * 50 for w in "abcdefghij"]
    given = [(None, t, "en", "small", 1) for t in texts] + [(None, "z " * 50, "en", "big", i) for i in range(60)]
    frame = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long")
    taken = P.mixing.mix(frame).collect()
    want = sum(int(r.taken / r["size"] + 0.5) for r in taken)
    out = P.mixed(spark, frame, SF).collect()
    assert len(out) == want
    assert len({r.text for r in out if r.source == "small"}) == 10
    big = [r.n_chars for r in out if r.source == "big"]
    assert 0 < len(set(big)) < 60 and sum(r.taken for r in taken if r.source == "big") < 50 * 60
