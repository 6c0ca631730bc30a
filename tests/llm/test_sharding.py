import zlib
from collections import Counter

from tests.llm.build import docs, rows

from orgtrail.llm import sharding


def jump(key, n):
    """The published algorithm, in plain integers."""
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards_equal_the_published_algorithm(spark):
    keys = [0, 1, -1, 7, 123456789, (1 << 63) - 1, -(1 << 63), *range(100, 160)]
    frame = spark.createDataFrame([(k,) for k in keys], "key long")
    for n in (1, 2, 24, 25):
        found = frame.select("key", sharding.jump_shard(frame.key, n).alias("s")).collect()
        assert {r.key: r.s for r in found} == {k: jump(k, n) for k in keys}


def test_report_is_gapless_and_grows_into_the_new_shard(spark):
    texts = [None, "", "é", "same", "same", *[f"text {i}" for i in range(300)]]
    found = sharding.shard_report(docs(spark, texts, extra="7 as size")).collect()
    assert len(found) == len(texts)
    for r in found:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert r.shard == jump(r.doc_id, 24)
        assert r.grown_shard in (r.shard, 24)
    for shard, n in Counter(r.shard for r in found).items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))


def test_null_keys_repeated_rows_and_no_rows(spark):
    frame = spark.createDataFrame([(None, "a"), (5, "x"), (5, "x"), (5, None)], "doc_id long, text string")
    found = sharding.shard_report(frame)
    assert rows(found, "doc_id", "shard") == sorted([(None, jump(-1, 24)), *[(5, jump(5, 24))] * 3], key=repr)
    for shard in {jump(-1, 24), jump(5, 24)}:
        slots = sorted(r.slot for r in found.collect() if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert sharding.shard_report(frame.filter("false")).count() == 0


def test_files_hold_every_row_in_its_shard(spark, tmp_path):
    frame = docs(spark, [f"t{i}" for i in range(50)])
    sharding.write_shards(frame, str(tmp_path / "shards"), n_shards=4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert rows(back, "doc_id", "shard") == [(i, jump(i, 4)) for i in sorted(range(50), key=lambda i: repr((i, jump(i, 4))))]


def test_a_hot_key_is_numbered_in_many_parts(spark):
    frame = spark.range(600).selectExpr("if(id % 3 = 0, null, id) as doc_id", "concat('t', id, repeat('x', int(id % 7))) as text")
    found = sharding.assign_shards(frame, n_shards=3, parts=16).collect()
    hot = [r for r in found if r.doc_id is None]
    assert len({r.shard for r in hot}) == 1 and len(hot) == 200
    slots = sorted(r.slot for r in found if r.shard == hot[0].shard)
    assert slots == list(range(len(slots)))
    # The hot key's rows do not stand together, as they would in one part.
    assert max(r.slot for r in hot) - min(r.slot for r in hot) > len(hot)


def test_very_long_texts(spark):
    frame = spark.createDataFrame([(1, "é" * 2_000_000), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in sharding.shard_report(frame).collect()}
    assert found[1].size == 4_000_008 and found[1].text_crc32 == zlib.crc32(("é" * 2_000_000).encode())
    assert found[2].size == 8
