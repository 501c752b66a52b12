"""Dashboard statistics: correlations, regression lines, limit exceedance shares and overview KPIs.

All are single-pass aggregates (co-moments are merged from partial aggregates), so they scale with the input and never
gather a group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.functions._util import as_col


def corr_by_group(df: DataFrame, by: Sequence[str], pairs: Sequence[tuple[str, str]],
                  names: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of each (x, y) pair per group."""
    names = list(names or [f"corr_{x}_{y}" for x, y in pairs])
    return df.groupBy(*by).agg(*[F.corr(x, y).alias(n) for (x, y), n in zip(pairs, names)])


def regr_by_group(df: DataFrame, by: Sequence[str], y: str, x: str, prefix: str = "") -> DataFrame:
    """Least-squares line y = slope·x + intercept with R², per group (NULL pairs skipped)."""
    return df.groupBy(*by).agg(
        F.regr_count(y, x).alias(f"{prefix}n"),
        F.regr_slope(y, x).alias(f"{prefix}slope"),
        F.regr_intercept(y, x).alias(f"{prefix}intercept"),
        F.regr_r2(y, x).alias(f"{prefix}r2"),
    )


def limit_exceedance(daily: DataFrame, limits: DataFrame, key: str, measure: str, limit_col: str = "limit_value") \
        -> DataFrame:
    """Per key: days observed, days whose measure exceeds the caller's limit, and that share.

    ``limits`` is a caller-supplied table ``(key, limit_value)``; keys without a limit are not judged.
    """
    judged = daily.join(limits, [key], "inner").withColumn("_over", F.col(measure) > F.col(limit_col))
    return judged.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.count_if(F.col("_over")).alias("n_days_over"),
        F.try_divide(F.count_if(F.col("_over")).cast("double"), F.count(F.lit(1)).cast("double")).alias("share_over"),
    )


def overview_kpis(df: DataFrame, ts, entity: str, measure: str) -> DataFrame:
    """Time frame, totals and distinct entities in one row."""
    t = as_col(ts)
    return df.agg(
        F.min(t).alias("first_ts"), F.max(t).alias("last_ts"), F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.col(entity)).alias("n_entities"), F.count_distinct(F.to_date(t)).alias("n_days"),
        F.sum(F.col(measure)).alias("total_measure"),
    )


def hourly_profile(df: DataFrame, key: str, ts, measure: str) -> DataFrame:
    """Pattern per location: observations and mean measure per (key, hour of day)."""
    return df.groupBy(F.col(key), F.hour(as_col(ts)).alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(measure).cast("double")).alias(f"avg_{measure}"))
