import random
import zlib

import pytest
from pyspark.sql import functions as F

from airshed.llm import sharding

from .conftest import rows_of


def plain_jump(key, shards):
    """The published loop: the shard and the shard of the next jump."""
    shard, after, state = -1, 0, key & (1 << 64) - 1
    while after < shards:
        shard = after
        state = (state * sharding.MULTIPLIER + 1) & (1 << 64) - 1
        after = int((shard + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return shard, after


def plain_manifest(rows, shards=24):
    sized = [(r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows]
    out, slots = [], {}
    for doc_id, size, crc in sorted(sized, key=lambda r: (r[0] is not None, r[0] or 0, r[1:])):
        shard = plain_jump(doc_id or 0, shards)[0]
        slots[shard] = slots.get(shard, -1) + 1
        out.append((doc_id, size, crc, "key", shard, slots[shard], plain_jump(doc_id or 0, shards + 1)[0]))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def keys(spark):
    rng = random.Random(9)
    keys = [rng.randrange(-2**63, 2**63) for _ in range(400)] + list(range(100)) + [-1, 2**63 - 1, -2**63]
    return keys, spark.createDataFrame([(k,) for k in keys], "doc_id long")


@pytest.mark.parametrize("shards", [1, 2, 24, 25, 64, 65, 66, 1000])
def test_shards_are_those_of_the_published_loop(keys, shards):
    got = {r.doc_id: (r.shard, r.moves_at) for r in sharding.with_shards(keys[1], shards).collect()}
    assert got == {k: plain_jump(k, shards) for k in keys[0]}


def test_more_jumps_than_usual(keys, monkeypatch):
    monkeypatch.setattr(sharding, "USUAL_JUMPS", 2)
    got = {r.doc_id: r.shard for r in sharding.with_shards(keys[1], 40).collect()}
    assert got == {k: plain_jump(k, 40)[0] for k in keys[0]}


def test_an_appended_shard_takes_rows_only_into_itself(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    both = sharding.with_shards(ids, 24).join(sharding.with_shards(ids, 25).select("doc_id", F.col("shard").alias("grown")),
                                             "doc_id")
    moved = both.where("shard != grown")
    assert moved.where("grown != 24").count() == 0
    assert moved.select("doc_id").exceptAll(sharding.movers(ids, 24).select("doc_id")).count() == 0
    assert abs(moved.count() - 20_000 / 25) < 120
    sizes = [r["count"] for r in both.groupBy("shard").count().collect()]
    assert len(sizes) == 24 and max(sizes) < 1.2 * 20_000 / 24


def test_manifest(make, corpus, odd_rows):
    rows = [(k * 7, t, "en", "s", 0) for k, t in enumerate(corpus)] + odd_rows
    got = sharding.manifest(make(rows, clashing=True))
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 3 + ["string", "int", "bigint", "int"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_manifest(rows)


def test_hot_ids_and_copies_are_spread(make):
    """A null id with many texts, and a row that is there 500 times: slots stay gapless, pieces of copies included."""
    rows = [(None, f"text {k}", "en", "s", 0) for k in range(300)] + [(3, "copy", "en", "s", 0)] * 500 + rows_of(["a", "b"])
    got = sharding.manifest(make(rows)).collect()
    assert sorted(map(tuple, got), key=str) == plain_manifest(rows)
    slots = sharding.numbered(make(rows).groupBy("doc_id").agg(F.count("*").alias("n")).withColumn("shard", F.lit(1)),
                              "shard", ["doc_id"], "n", "test-slots")
    spread = sharding.each_copy(slots, "n", "slot", at_once=64).collect()
    assert sorted(r.slot for r in spread) == list(range(len(rows)))


def test_key_of_several_columns_and_written_shards(make, spark, tmp_dir):
    docs = make(rows_of([f"text {k}" for k in range(200)]))
    key = F.xxhash64("source", "doc_id")
    sharding.write_shards(docs, f"{tmp_dir}/shards", 6, key, files_per_shard=2)
    back = spark.read.parquet(f"{tmp_dir}/shards")
    assert back.drop("shard").exceptAll(docs).count() == 0 and back.count() == 200
    assert back.select(*docs.columns, "shard").exceptAll(sharding.with_shards(docs, 6, key).drop("moves_at")).count() == 0


def test_dealing_needs_no_exchange_and_no_python(make):
    docs = make(rows_of(["a", "b"]))
    plan = sharding.with_shards(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Python" not in plan and "Arrow" not in plan


def test_a_very_long_text(make):
    text = "é" * 3_000_000
    assert [tuple(r) for r in sharding.manifest(make([(5, text, "en", "s", 0)])).collect()] == plain_manifest([(5, text)])


def test_empty_table(make):
    assert sharding.manifest(make([])).collect() == []
