"""Join operators: full-outer count merge, dimension lookups, positional zips."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def full_outer_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], left_count: str, right_count: str,
                      total_name: str) -> DataFrame:
    """FULL OUTER JOIN of two count tables on ``keys``; keys coalesced, missing counts become 0, plus their sum.

    Both inputs are already aggregated to one row per key, so no key is hot on either side.
    """
    joined = left.join(right, list(keys), "full")
    lc = F.coalesce(F.col(left_count), F.lit(0))
    rc = F.coalesce(F.col(right_count), F.lit(0))
    return joined.select(*keys, lc.alias(left_count), rc.alias(right_count), (lc + rc).alias(total_name))


def lookup_join(pairs: DataFrame, lookup: DataFrame, on: Sequence[str], match_equal: Sequence[tuple[str, str]] = (),
                require_non_empty: Sequence[str] = ()) -> DataFrame:
    """Equi-join candidate pairs to a lookup, keep matches whose attributes agree and whose codes are non-empty."""
    joined = pairs.join(lookup, list(on), "inner")
    for left_col, right_col in match_equal:
        joined = joined.filter(F.col(left_col) == F.col(right_col))
    for c in require_non_empty:
        joined = joined.filter(F.col(c).isNotNull() & (F.col(c) != ""))
    return joined


def zip_lists(df: DataFrame, list_cols: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """Parallel arrays → one row per position; unequal lengths raise (strict zip)."""
    names = list(names or list_cols)
    sizes = [F.size(c) for c in list_cols]
    same = reduce(lambda a, b: a & b, [s == sizes[0] for s in sizes[1:]], F.lit(True))
    zipped = F.arrays_zip(*[F.col(c).alias(n) for c, n in zip(list_cols, names)])
    # The check is part of the generated expression, so column pruning cannot drop it.
    guarded = F.when(same, zipped).otherwise(F.raise_error(F.lit("parallel lists differ in length")))
    rest = [c for c in df.columns if c not in list_cols]
    return df.select(*rest, F.inline(guarded))
