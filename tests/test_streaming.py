import datetime as dt
import os

from airshed.operators.sinks import apply_insert_if_absent
from airshed.streaming.ingest import dedupe_in_stream, incremental_ingest

SCHEMA = "k string, ts timestamp_ntz, v int"


def test_two_increments_equal_one_batch(spark, tmp_dir):
    rows1 = [("a", dt.datetime(2024, 1, 1, 6), 1), ("a", dt.datetime(2024, 1, 1, 7), 2), ("b", dt.datetime(2024, 1, 1, 6), 3)]
    rows2 = [("a", dt.datetime(2024, 1, 2, 6), 4), ("c", dt.datetime(2024, 1, 2, 6), 5), ("b", dt.datetime(2024, 1, 3, 6), 6)]
    src, tgt, ck = (os.path.join(tmp_dir, x) for x in ("src", "tgt", "ck"))
    spark.createDataFrame(rows1, SCHEMA).coalesce(1).write.parquet(os.path.join(src, "inc1"))
    first = spark.createDataFrame(rows1, SCHEMA).schema
    incremental_ingest(spark, src, first, tgt, ck, ["k"], ["ts"], source_format="parquet",
                       transform=None)
    assert spark.read.parquet(tgt).count() == 2
    spark.createDataFrame(rows2, SCHEMA).coalesce(1).write.parquet(os.path.join(src, "inc2"))
    incremental_ingest(spark, src, first, tgt, ck, ["k"], ["ts"], source_format="parquet")   # picks up inc2 only
    streamed = sorted(tuple(r) for r in spark.read.parquet(tgt).select("k", "ts", "v").collect())
    empty = spark.createDataFrame([], SCHEMA)
    batch = apply_insert_if_absent(empty, spark.createDataFrame(rows1 + rows2, SCHEMA), ["k"], ["ts"])
    # first-wins per key: keys already loaded by the first increment are not replaced by later rows
    assert streamed == sorted(tuple(r) for r in batch.collect())


def test_dedupe_in_stream_plan(spark, tmp_dir):
    src = os.path.join(tmp_dir, "s")
    spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 6), 1), ("a", dt.datetime(2024, 1, 1, 6), 1)],
                          SCHEMA).write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    q = (dedupe_in_stream(stream, ["k"], "ts").writeStream.format("memory").queryName("dd")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("SELECT count(*) AS n FROM dd").first()["n"] == 1


def test_stream_upsert_mode(spark, tmp_dir):
    src, tgt, ck = (os.path.join(tmp_dir, x) for x in ("src", "tgt", "ck"))
    schema = "k string, day int, seq int, v string"
    spark.createDataFrame([("a", 1, 1, "x"), ("b", 2, 1, "y")], schema).write.parquet(os.path.join(src, "i1"))
    st = spark.createDataFrame([], schema).schema
    incremental_ingest(spark, src, st, tgt, ck, ["k", "day"], ["seq"], mode="upsert", partition_col="day")
    spark.createDataFrame([("a", 1, 0, "x2")], schema).write.parquet(os.path.join(src, "i2"))
    incremental_ingest(spark, src, st, tgt, ck, ["k", "day"], ["seq"], mode="upsert", partition_col="day")
    got = sorted(tuple(r) for r in spark.read.parquet(tgt).select("k", "day", "v").collect())
    assert got == [("a", 1, "x2"), ("b", 2, "y")]                      # the later load wins despite a lower seq


def test_hourly_counts_stream_equals_batch(spark, tmp_dir):
    from airshed.operators.aggregates import hourly_counts
    from airshed.streaming.ingest import hourly_counts_stream
    rows = [("cdg", dt.datetime(2024, 1, 1, 6, m), 1) for m in (0, 10, 59)] + \
           [("CDG", dt.datetime(2024, 1, 1, 7, 5), 1), ("ory", dt.datetime(2024, 1, 2, 8, 30), 1)]
    src = os.path.join(tmp_dir, "ev")
    spark.createDataFrame(rows, SCHEMA).write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    out = os.path.join(tmp_dir, "hourly")

    def sink(batch, _id):
        batch.write.mode("overwrite").parquet(out)

    q = (hourly_counts_stream(stream, "k", "ts").writeStream.outputMode("complete").foreachBatch(sink)
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    streamed = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    batch = hourly_counts(spark.createDataFrame(rows, SCHEMA), "k", "ts", "n", lo=0, hi=23)
    assert streamed == sorted(tuple(r) for r in batch.select("airport_code", "date", "n").collect())


def test_a_replayed_batch_adds_nothing(spark, tmp_dir):
    """Rows with a NULL in their key never conflict, so only the batch's name keeps a replay from adding them again."""
    from airshed.streaming.ingest import merge_batch
    schema = "k string, day int, v int"
    tgt = os.path.join(tmp_dir, "tgt")
    one = spark.createDataFrame([("a", 1, 1), (None, 1, 2), (None, 1, 2)], schema)
    two = spark.createDataFrame([("a", 1, 9), ("b", 2, 3), (None, 2, 4)], schema)
    for batch, name in ((one, "b0"), (two, "b1"), (two, "b1"), (one, "b0")):
        merge_batch(batch, tgt, ["k", "day"], ["v"], name, partition_col="day", prune_col="day")
    got = sorted((r["k"] or "-", r["day"], r["v"]) for r in spark.read.parquet(tgt).collect())
    assert got == [("-", 1, 2), ("-", 1, 2), ("-", 2, 4), ("a", 1, 1), ("b", 2, 3)]


def test_late_rows_over_several_runs(spark, tmp_dir):
    """Rows behind the watermark of earlier runs are left out by both stateful operators; repeats inside it count once
    in the one and as rows of their hour in the other."""
    from airshed.streaming.ingest import append_stream, hourly_counts_stream
    at = lambda day, hour: dt.datetime(2024, 1, day, hour, 30)
    drops = [[("a", at(1, 6), 1), ("b", at(9, 6), 2)], [("b", at(9, 6), 2), ("c", at(10, 7), 3)],
             [("late", at(2, 6), 4), ("d", at(20, 6), 5)]]
    outs = {}
    for name, transform in (("dedupe", lambda s: dedupe_in_stream(s, ["k"], "ts")),
                            ("hourly", lambda s: hourly_counts_stream(s, "k", "ts"))):
        src, out, ck = (os.path.join(tmp_dir, name, x) for x in ("src", "out", "ck"))
        for n, rows in enumerate(drops):
            frame = spark.createDataFrame(rows, SCHEMA)
            frame.write.parquet(os.path.join(src, str(n)))
            append_stream(spark, src, frame.schema, transform, out, ck)
        outs[name] = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert [r[0] for r in outs["dedupe"]] == ["a", "b", "c", "d"]
    assert [(r[0], r[2]) for r in outs["hourly"]] == [("A", 1), ("B", 2), ("C", 1)]      # d's hour is still open


def test_a_batch_of_two_days_opens_two_folders(spark, tmp_dir, monkeypatch):
    from airshed.operators import storage
    from airshed.streaming import ingest
    schema, tgt, told = "k string, day int, v int", os.path.join(tmp_dir, "tgt"), []
    for day in range(6):
        ingest.merge_batch(spark.createDataFrame([(f"k{day}", day, 1)], schema), tgt, ["k", "day"], ["v"], f"b{day}",
                           partition_col="day", prune_col="day")
    listed, real = [], storage.names_in
    monkeypatch.setattr(storage, "names_in", lambda s, p: listed.append(p) or real(s, p))
    opened = []
    load = storage.read_partitions
    monkeypatch.setattr(storage, "read_partitions", lambda *a, **k: opened.append(load(*a, **k)) or opened[-1])
    ingest.merge_batch(spark.createDataFrame([("k0", 0, 9), ("new", 5, 9)], schema), tgt, ["k", "day"], ["v"], "b9",
                       partition_col="day", prune_col="day", touched=told.append)
    assert not [p for p in listed if p.startswith(tgt)] and told == [[0, 5]]
    assert sorted(os.path.dirname(f)[-5:] for f in opened[0].inputFiles()) == ["day=0", "day=5"]
    assert sorted((r.k, r.v) for r in spark.read.parquet(tgt).where("day in (0, 5)").collect()) == \
        [("k0", 1), ("k5", 1), ("new", 9)]
