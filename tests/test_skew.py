"""Hot keys: one key holds over a third of all rows (and a block of identical copies). Results are checked against
brute force, and plans must aggregate map-side before the shuffle."""

import io
import contextlib

import pytest
from pyspark.sql import functions as F

from airshed.operators import aggregates, latest, sinks
from airshed.operators.percentile import exact_percentile

from test_percentile import interpolated


@pytest.fixture(scope="module")
def skewed(spark):
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 5 < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
        .alias("key"),
        F.col("id").alias("seq"),
        F.when(F.col("id") < 3000, F.lit(1.5)).otherwise(F.rand(11) * 100).alias("v"),   # 3000 identical copies
        (F.col("id") % 7 + 1).cast("double").alias("w"))
    return df, df.toPandas()


def physical(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_key_share(skewed):
    _, pdf = skewed
    assert (pdf.key == "hot").mean() > 1 / 3


def test_latest_per_key_partial_aggregation(skewed):
    df, pdf = skewed
    out = latest.latest_per_key(df, ["key"], ["seq"], ["v", "seq"])
    plan = physical(out)
    assert "partial_max_by" in plan and plan.index("partial_max_by") > plan.index("Exchange")  # partial below exchange
    got = {r["key"]: r["seq"] for r in out.collect()}
    want = pdf.groupby("key").seq.max().to_dict()
    assert got == want


def test_dedupe_and_insert_if_absent_with_hot_key(skewed, spark):
    df, pdf = skewed
    d = sinks.dedupe_by_key(df, ["key"], ["seq"], keep="first")
    assert d.count() == pdf.key.nunique()
    copies = df.filter("seq < 3000").select("v")          # a block of identical rows collapses to one
    assert sinks.dedupe_by_key(copies.withColumn("k", F.lit(1)), ["k"], ["v"]).count() == 1
    target = d.filter("key = 'hot'")
    new = sinks.insert_if_absent(target, df, ["key"], ["seq"])
    assert new.filter("key = 'hot'").count() == 0 and new.count() == pdf.key.nunique() - 1


def test_weighted_means_and_counts_with_hot_key(skewed):
    df, pdf = skewed
    got = {r["key"]: r["v"] for r in aggregates.weighted_means(df, ["key"], "w", ["v"]).collect()}
    hot = pdf[pdf.key == "hot"]
    assert got["hot"] == pytest.approx((hot.v * hot.w).sum() / hot.w.sum(), rel=1e-9)
    plan = physical(aggregates.load_stats(df, ["key"], ["seq"]))
    assert "partial_count" in plan


def test_exact_median_with_hot_group(skewed):
    df, pdf = skewed
    out = exact_percentile(df, ["key"], ["v", "w"], 0.5, ["mv", "mw"])
    got = {r["key"]: (r["mv"], r["mw"]) for r in out.collect()}
    for key in ["hot", "k0", "k996"]:
        sub = pdf[pdf.key == key]
        assert got[key] == (interpolated(sub.v.tolist(), 0.5), interpolated(sub.w.tolist(), 0.5))
    assert len(got) == pdf.key.nunique()
    assert "partial_count" in physical(out)
