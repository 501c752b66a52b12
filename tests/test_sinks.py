import glob
import os

import pytest
from pyspark.sql import functions as F

from airshed.operators import sinks, storage

SCHEMA = "k1 string, k2 int, seq int, v string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dedupe_keeps_one_and_passes_null_keys(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "y"), ("b", None, 1, "n1"), ("b", None, 2, "n2")],
                               SCHEMA)
    assert rows(sinks.dedupe_by_key(df, ["k1", "k2"], ["seq"], keep="first")) == \
        [("a", 1, 1, "x"), ("b", None, 1, "n1"), ("b", None, 2, "n2")]
    assert rows(sinks.dedupe_by_key(df, ["k1", "k2"], ["seq"], keep="last"))[0] == ("a", 1, 2, "y")


def test_insert_if_absent_existing_wins_and_idempotent(spark):
    target = spark.createDataFrame([("a", 1, 0, "old")], SCHEMA)
    batch = spark.createDataFrame([("a", 1, 5, "new"), ("c", 3, 1, "c1"), ("c", 3, 2, "c2"), ("n", None, 1, "z"),
                                   ("n", None, 1, "z")], SCHEMA)
    new = sinks.insert_if_absent(target, batch, ["k1", "k2"], ["seq"])
    assert rows(new) == [("c", 3, 1, "c1"), ("n", None, 1, "z"), ("n", None, 1, "z")]
    after = sinks.apply_insert_if_absent(target, batch, ["k1", "k2"], ["seq"])
    keyed_after = after.filter("k2 IS NOT NULL")
    again = sinks.insert_if_absent(keyed_after, batch.filter("k2 IS NOT NULL"), ["k1", "k2"], ["seq"])
    assert again.count() == 0                                   # re-running the same load adds nothing
    assert rows(sinks.insert_if_absent(after, batch, ["k1", "k2"], ["seq"])) == [("n", None, 1, "z")] * 2
    assert rows(after.filter("k1 = 'a'")) == [("a", 1, 0, "old")]


def test_insert_if_absent_prunes_target_by_range(spark):
    target = spark.createDataFrame([("a", 1, 0, "old"), ("a", 9, 0, "far")], SCHEMA)
    batch = spark.createDataFrame([("a", 1, 5, "new"), ("a", 2, 5, "n2")], SCHEMA)
    new = sinks.insert_if_absent(target, batch, ["k1", "k2"], ["seq"], prune_col="k2")
    assert rows(new) == [("a", 2, 5, "n2")]


def test_upsert_last_write_wins_and_idempotent(spark):
    target = spark.createDataFrame([("a", 1, 9, "t-late"), ("b", 2, 1, "b")], SCHEMA)
    batch = spark.createDataFrame([("a", 1, 1, "u1"), ("a", 1, 2, "u2"), ("c", 3, 1, "c"), ("x", None, 1, "bad")],
                                  SCHEMA)
    up = sinks.upsert_latest(target, batch, ["k1", "k2"], ["seq"])
    assert rows(up) == [("a", 1, 2, "u2"), ("b", 2, 1, "b"), ("c", 3, 1, "c")]   # later load beats larger seq
    assert rows(sinks.upsert_latest(up, batch.filter("k2 IS NOT NULL"), ["k1", "k2"], ["seq"])) == rows(up)
    assert sinks.rejected_rows(batch, ["k1", "k2"]).count() == 1


def test_strict_append_conflicts_and_refusal(spark, tmp_dir):
    target = spark.createDataFrame([("a", 1, 0, "t")], SCHEMA)
    batch = spark.createDataFrame([("a", 1, 1, "x"), ("b", 2, 1, "y"), ("b", 2, 2, "z"), ("c", 3, 1, "ok")], SCHEMA)
    rep = {(r["k1"], r["k2"]): (r["n_batch"], r["n_target"]) for r in
           sinks.strict_append_conflicts(target, batch, ["k1", "k2"]).collect()}
    assert rep == {("a", 1): (1, 1), ("b", 2): (2, 0)}
    path = f"{tmp_dir}/road"
    target.write.parquet(path)
    with pytest.raises(ValueError, match="2 conflicting keys"):
        sinks.strict_append(path, spark.read.parquet(path), batch, ["k1", "k2"])
    sinks.strict_append(path, spark.read.parquet(path), batch.filter("k1 = 'c'"), ["k1", "k2"])
    assert spark.read.parquet(path).count() == 2


def test_union_history_and_staging(spark):
    h = spark.createDataFrame([(1, "a")], "id int, x string")
    n = spark.createDataFrame([(2, "b", 5.0)], "id int, x string, extra double")
    u = sinks.union_history(h, n, slice_col="slice")
    assert rows(u.select("slice", "id", "extra")) == [("history", 1, None), ("new", 2, 5.0)]
    staged = sinks.staged_rewrite(u, "hist")
    assert staged.count() == 2


def test_upsert_table_rewrites_only_touched_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/weather"
    first = spark.createDataFrame([("a", 1, 1, "d1"), ("b", 2, 1, "d2")], "k1 string, day int, seq int, v string")
    sinks.upsert_table(path, first, ["k1", "day"], ["seq"], "day")
    untouched = sorted(os.listdir(f"{path}/day=2"))
    second = spark.createDataFrame([("a", 1, 2, "d1-new"), ("c", 3, 1, "d3")], "k1 string, day int, seq int, v string")
    sinks.upsert_table(path, second, ["k1", "day"], ["seq"], "day")
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k1", "day", "v").collect())
    assert got == [("a", 1, "d1-new"), ("b", 2, "d2"), ("c", 3, "d3")]
    assert sorted(os.listdir(f"{path}/day=2")) == untouched            # day 2 files were not rewritten


DAYS = "k1 string, day int, seq int, v string"


def test_upsert_fails_on_an_unreadable_partition(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    sinks.upsert_table(path, spark.createDataFrame([("a", 0, 1, "x"), ("b", 1, 1, "y"), ("c", 1, 1, "z")], DAYS),
                       ["k1", "day"], ["seq"], "day")
    for part in glob.glob(f"{path}/day=0/*.parquet"):
        with open(part, "wb") as fh:
            fh.write(b"not parquet")
    for crc in glob.glob(f"{path}/day=0/.*.crc"):
        os.remove(crc)
    with pytest.raises(Exception):
        sinks.upsert_table(path, spark.createDataFrame([("d", 0, 1, "n"), ("e", 1, 1, "n")], DAYS), ["k1", "day"],
                           ["seq"], "day")
    kept = spark.read.schema("k1 string, seq int, v string").parquet(f"{path}/day=1")
    assert sorted(r.k1 for r in kept.collect()) == ["b", "c"]        # nothing was replaced


def test_upsert_keeps_rows_without_a_partition_value(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    for batch in ([("a", None, 1, "x"), ("b", 1, 1, "y")], [("c", None, 1, "z")], [("a", None, 1, "x2")]):
        sinks.upsert_table(path, spark.createDataFrame(batch, DAYS), ["k1"], ["seq"], "day")
    assert sorted((r.k1, r.day, r.v) for r in spark.read.parquet(path).collect() if r.day is None) == \
        [("a", None, "x2"), ("c", None, "z")]
    assert spark.read.parquet(path).count() == 3


def test_a_failing_write_leaves_the_table(spark, tmp_dir):
    path = f"{tmp_dir}/view"
    sinks.write_table(spark.range(2), path)
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception):
        sinks.write_table(broken, path)
    assert spark.read.parquet(path).count() == 2
    assert [n for n in os.listdir(tmp_dir) if n.startswith("_")] == []     # no staging left behind
    sinks.write_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_partitions_are_replaced_and_removed(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    frame = lambda days: spark.createDataFrame([(d, d) for d in days], "day int, v int")
    write = lambda df: lambda staging: storage.write_partitioned(df, staging, ["day"])
    storage.replace_partitions(spark, path, write(frame([1, 2, 3])))
    storage.replace_partitions(spark, path, write(frame([2])), gone=lambda name: name >= "day=2")
    assert sorted(r.day for r in spark.read.parquet(path).collect()) == [1, 2]


def test_missing_table_is_empty_and_others_fail(spark, tmp_dir):
    assert storage.read_if_exists(spark, f"{tmp_dir}/none") is None
    os.makedirs(f"{tmp_dir}/bad")
    with open(f"{tmp_dir}/bad/part-0.parquet", "wb") as fh:
        fh.write(b"no")
    with pytest.raises(Exception):
        storage.read_if_exists(spark, f"{tmp_dir}/bad")


def test_files_per_partition_are_few_and_ordered(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    df = spark.range(4000).select((F.col("id") % 20).cast("int").alias("day"), F.rand(1).alias("city"),
                                  "id").repartition(8)
    storage.write_partitioned(df, path, ["day"], ["city"])
    files = glob.glob(f"{path}/day=*/*.parquet")
    assert len(files) == 20                                                # one per day, not tasks times days
    for part in files:
        cities = [r.city for r in spark.read.parquet(part).collect()]
        assert cities == sorted(cities)


def test_a_lookup_reads_few_files_of_a_large_day(spark, tmp_dir):
    """Dealt by ranges, a city's rows are in one or two of a day's files by the row groups' bounds."""
    import pyarrow.parquet as pq

    df = spark.range(20_000).select(F.lit(1).alias("day"), F.concat(F.lit("c"), (F.col("id") * 7 % 100 + 100).cast("string"))
                                    .alias("city"), F.col("id").alias("date")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        storage.write_partitioned(sinks.staged_rewrite(df), f"{tmp_dir}/t", ["day"], ["city", "date"], ranges=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = glob.glob(f"{tmp_dir}/t/day=1/*.parquet")
    groups = [pq.ParquetFile(f).metadata.row_group(g).column(0) for f in files
              for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert len(files) == 4 and {c.path_in_schema for c in groups} == {"city"}
    for city in ("c100", "c137", "c199"):
        assert 1 <= sum(c.statistics.min <= city <= c.statistics.max for c in groups) <= 2
    assert spark.read.parquet(f"{tmp_dir}/t").where("city = 'c137'").count() == 200


def test_a_batch_written_again_replaces_itself(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    for name, n in (("b0", 3), ("b1", 2), ("b0", 4)):
        storage.append_batch(spark, path, name, lambda staging, n=n: spark.range(n).write.parquet(staging))
    assert spark.read.parquet(path).count() == 6
