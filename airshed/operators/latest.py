"""Latest row per key (``DISTINCT ON … ORDER BY … DESC``) as an aggregate.

``max_by`` over a struct ordering key is a declarative aggregate with a partial (map-side) phase, so a key that holds a
third of all rows is reduced to one candidate per map task before the shuffle — unlike ``row_number()`` over a window,
which would sort the whole hot key inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordering_key(order_cols: Sequence[str], nulls_latest: bool = True) -> Column:
    """Struct compared field by field. With ``nulls_latest`` a NULL sorts above every value, like PostgreSQL's
    ``DESC`` (NULLS FIRST)."""
    fields = []
    for i, c in enumerate(order_cols):
        if nulls_latest:
            fields.append(F.col(c).isNull().alias(f"_null{i}"))
        fields.append(F.col(c).alias(f"_key{i}"))
    return F.struct(*fields)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], value_cols: Sequence[str],
                   nulls_latest: bool = True, earliest: bool = False) -> DataFrame:
    """One row per key: the values of the row with the greatest (or least, ``earliest``) ordering key.

    ``keys`` are column names (derive computed keys with ``withColumn`` first). Put a unique column last in
    ``order_cols`` to make ties deterministic.
    """
    payload = F.struct(*[F.col(c) for c in value_cols])
    pick = F.min_by if earliest else F.max_by
    return (df.groupBy(*keys).agg(pick(payload, ordering_key(order_cols, nulls_latest)).alias("_row"))
            .select(*keys, "_row.*"))


def latest_value(df: DataFrame, keys: Sequence[str], value: str, order_col: str, name: str | None = None) -> DataFrame:
    """``max_by(value, order_col)`` per key (the file with the newest modification time, the last event id …)."""
    return df.groupBy(*keys).agg(F.max_by(F.col(value), F.col(order_col)).alias(name or value))
