"""Property tests (few examples each: every example runs Spark jobs)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airshed.operators import aggregates, joins, sinks
from airshed.plans import planning

FEW = settings(max_examples=8, deadline=None)
keys = st.sampled_from(["a", "b", "c", "d"])


@FEW
@given(st.lists(st.tuples(keys, st.integers(1, 5)), max_size=12), st.lists(st.tuples(keys, st.integers(1, 5)),
                                                                           max_size=12))
def test_full_outer_keeps_both_key_sets(spark, left, right):
    lc = spark.createDataFrame(left, "k string, n int").groupBy("k").agg(F.sum("n").alias("a"))
    rc = spark.createDataFrame(right, "k string, n int").groupBy("k").agg(F.sum("n").alias("b"))
    out = {r["k"]: (r["a"], r["b"], r["t"]) for r in joins.full_outer_counts(lc, rc, ["k"], "a", "b", "t").collect()}
    assert set(out) == {k for k, _ in left} | {k for k, _ in right}
    for k, (a, b, t) in out.items():
        assert a == sum(n for kk, n in left if kk == k) and b == sum(n for kk, n in right if kk == k) and t == a + b


@FEW
@given(st.lists(st.tuples(keys, st.floats(-100, 100), st.floats(0.5, 10)), min_size=1, max_size=15))
def test_weighted_mean_within_bounds(spark, rows):
    df = spark.createDataFrame(rows, "k string, x double, w double")
    for r in aggregates.weighted_means(df, ["k"], "w", ["x"]).collect():
        xs = [x for k, x, _ in rows if k == r["k"]]
        assert min(xs) - 1e-9 <= r["x"] <= max(xs) + 1e-9


@FEW
@given(st.dates(dt.date(2023, 1, 1), dt.date(2025, 1, 1)), st.integers(0, 60), st.integers(1, 10))
def test_segments_cover_range_without_overlap(spark, start, length, width):
    end = start + dt.timedelta(days=length)
    df = spark.createDataFrame([(start, end)], "s date, e date")
    segs = sorted((r["seg_start"], r["seg_end"]) for r in
                  planning.explode_segments(df, "s", "e", width, inclusive_tail=True, keep=[]).collect())
    assert segs[0][0] == start and segs[-1][1] == end
    assert all((b[0] - a[1]).days == 1 for a, b in zip(segs, segs[1:]))
    assert all(0 <= (e - s).days < width for s, e in segs)


@FEW
@given(st.lists(st.tuples(keys, st.integers(0, 3)), min_size=1, max_size=15))
def test_keyed_sinks_are_idempotent(spark, rows):
    batch = spark.createDataFrame(rows, "k string, seq int")
    once = sinks.apply_insert_if_absent(batch.limit(0), batch, ["k"], ["seq"])
    twice = sinks.apply_insert_if_absent(once, batch, ["k"], ["seq"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    up = sinks.upsert_latest(batch.limit(0), batch, ["k"], ["seq"])
    assert sorted(map(tuple, sinks.upsert_latest(up, batch, ["k"], ["seq"]).collect())) == \
        sorted(map(tuple, up.collect()))
