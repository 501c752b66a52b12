"""Grouped aggregates of the warehouse views: hourly counts, daily max/mean, length-weighted means, code lists,
high-water marks, distinct pairs and load statistics.

All of them are plain ``groupBy().agg()`` plans, so Spark runs a partial (map-side) aggregate before the shuffle and a
hot key costs one row per map task, not one row per input record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.functions._util import as_col
from airshed.functions.time import HISTORY_START, epoch_seconds, hour_in_window, hour_trunc


def hourly_counts(df: DataFrame, code, ts, count_name: str, status_col: str | None = None,
                  status_value: str | None = None, lo: int = 6, hi: int = 9, inclusive_hi: bool = True) -> DataFrame:
    """Rows per (UPPER(code), hour) inside the morning window, optionally for one status only.

    Grouping is on the upper-cased code, so codes differing only in case count together.
    """
    rows = df
    if status_col is not None:
        rows = rows.filter(F.col(status_col) == F.lit(status_value))
    rows = rows.filter(hour_in_window(ts, lo, hi, inclusive_hi))
    return (rows.groupBy(F.upper(as_col(code)).alias("airport_code"), hour_trunc(ts).alias("date"))
            .agg(F.count(F.lit(1)).alias(count_name)))


def window_counts(df: DataFrame, ts, windows: dict[str, tuple[int, int, bool]], by: Sequence[Column] | None = None) \
        -> DataFrame:
    """Per day (or ``by``) the number of rows inside each named hour window ``name → (lo, hi, inclusive_hi)``."""
    keys = list(by) if by is not None else [F.to_date(as_col(ts)).alias("date")]
    return df.groupBy(*keys).agg(*[F.count_if(hour_in_window(ts, lo, hi, inc)).alias(name)
                                   for name, (lo, hi, inc) in windows.items()])


def daily_max(df: DataFrame, key: str, ts, measures: Sequence[str], key_name: str | None = None,
              day_name: str = "date") -> DataFrame:
    """MAX of each measure per (key, day); NULLs are ignored."""
    return (df.groupBy(F.col(key).alias(key_name or key), F.to_date(as_col(ts)).alias(day_name))
            .agg(*[F.max(m).alias(m) for m in measures]))


def daily_mean(df: DataFrame, key: str, ts, measures: Sequence[str], key_name: str | None = None,
               day_name: str = "date") -> DataFrame:
    """AVG of each measure (as double) per (key, day)."""
    return (df.groupBy(F.col(key).alias(key_name or key), F.to_date(as_col(ts)).alias(day_name))
            .agg(*[F.avg(F.col(m).cast("double")).alias(m) for m in measures]))


def weighted_means(df: DataFrame, keys: Sequence[str], weight: str, measures: Sequence[str],
                   total_name: str | None = None) -> DataFrame:
    """Length-weighted means Σ(x·w)/Σ(w) per key, plus Σ(w).

    Rows with a NULL key are dropped (the grouping in the road loader silently loses them). A NULL measure adds nothing
    to its numerator while its weight still counts; a zero total weight yields NULL instead of a division error.
    """
    valid = df
    for k in keys:
        valid = valid.filter(F.col(k).isNotNull())
    total = F.sum(F.col(weight).cast("double"))
    aggs = [total.alias(total_name or weight)]
    aggs += [F.try_divide(F.coalesce(F.sum(F.col(m) * F.col(weight)), F.lit(0.0)), total).alias(m) for m in measures]
    return valid.groupBy(*keys).agg(*aggs)


def string_agg(df: DataFrame, keys: Sequence[str], value: str, list_name: str, sep: str = ", ",
               ordered: bool = True, mins: Sequence[str] = ()) -> DataFrame:
    """STRING_AGG(value, sep) per key (NULL values skipped) plus independent MIN of ``mins``.

    Meant for dimension tables (airports per city); the list per group is bounded by the dimension, not the facts.
    """
    quoted_sep = sep.replace("'", "''")
    order = f" WITHIN GROUP (ORDER BY `{value}`)" if ordered else ""
    agg = F.expr(f"listagg(`{value}`, '{quoted_sep}'){order}")
    return df.groupBy(*keys).agg(agg.alias(list_name), *[F.min(m).alias(m) for m in mins])


def split_explode(df: DataFrame, list_col: str, out_col: str, sep: str = ", ") -> DataFrame:
    """UNNEST(STRING_TO_ARRAY(list, sep)): one row per element; a NULL list gives no row."""
    pattern = "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in sep)
    rest = [c for c in df.columns if c != list_col]
    return df.select(*rest, F.explode(F.split(F.col(list_col), pattern)).alias(out_col))


def high_water_mark(df: DataFrame, ts, by: Sequence[str] = (), floor: str = HISTORY_START,
                    name: str = "high_water_mark") -> DataFrame:
    """Latest timestamp (global or per ``by``) floored at the history start."""
    floor_ts = F.lit(floor).cast("timestamp_ntz")
    return df.groupBy(*by).agg(F.greatest(F.max(as_col(ts)), floor_ts).alias(name))


def high_water_epoch(df: DataFrame, ts, by: Sequence[str] = (), floor: str = HISTORY_START,
                     name: str = "hwm_epoch") -> DataFrame:
    """As :func:`high_water_mark`, in epoch seconds."""
    floor_epoch = epoch_seconds(F.lit(floor).cast("timestamp_ntz"))
    return df.groupBy(*by).agg(F.greatest(F.max(epoch_seconds(ts)), floor_epoch).alias(name))


def distinct_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def load_stats(df: DataFrame, by: Sequence[str], keys: Sequence) -> DataFrame:
    """Rows, distinct keys and duplicate rows per source slice, in two partial-aggregation stages."""
    per_key = df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy(*by).agg(F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
                                     F.sum(F.col("_n") - 1).alias("n_duplicates"))
