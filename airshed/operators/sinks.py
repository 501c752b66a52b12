"""Keyed loads into warehouse tables: insert-if-absent, last-write-wins upsert, strict append, history union.

Plain Parquet has no MERGE, so each load is computed as a DataFrame (anti join / latest-per-key / collision report).
Insert-if-absent and strict append only append new files; an upsert writes the merged partitions beside the table and
then puts them in the place of the old ones. Deduplication always goes through ``max_by``/``min_by`` aggregates
(partial aggregation), never through a window that would gather a hot key into one task.

A load touches the partitions of its own values and no others: their set (days, so bounded by the calendar) is found
with one look at the batch, and only these folders of the target are opened.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.operators import storage
from airshed.operators.latest import latest_per_key
from airshed.session import shared_path


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per non-NULL key, chosen deterministically by ``order_cols`` (``keep`` = 'first' or 'last').

    Rows with a NULL key component pass through untouched: a SQL UNIQUE constraint never sees them as equal. They get a
    number of their own beside the key, so one aggregate over one scan serves both kinds.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    values = [c for c in df.columns if c not in keys]
    alone = df.withColumn("_alone", F.when(any_null(keys), F.monotonically_increasing_id()))
    picked = latest_per_key(alone, [*keys, "_alone"], order_cols, values, nulls_latest=False, earliest=(keep == "first"))
    return picked.select(*df.columns)


def partition_values(batch: DataFrame, col: str) -> list:
    """The different values of a column with few of them, such as the day a table is partitioned by; NULL comes first."""
    found = [r[0] for r in batch.select(col).distinct().collect()]
    return sorted(found, key=lambda v: (v is not None, v))


def holds_value(col: str, values: Sequence) -> Column:
    """Whether the column has one of these values, of which NULL may be one; reaches a scan as its partition filter."""
    some = [v for v in values if v is not None]
    one_of = F.col(col).isin(some) if some else F.lit(False)
    return one_of | F.col(col).isNull() if None in values else one_of


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                     keep: str = "first", prune_col: str | None = None) -> DataFrame:
    """Rows of ``batch`` to append: ``INSERT … ON CONFLICT (keys) DO NOTHING``.

    The batch is deduplicated first (one row per key); existing keys win; keys with a NULL never conflict (an anti join
    never matches them). ``prune_col`` (a column in both tables, e.g. a day the table is partitioned by) restricts the
    target scan to the batch's values, so only the touched partitions are read.
    """
    fresh = dedupe_by_key(batch, keys, order_cols, keep)
    existing = target if prune_col is None else target.filter(holds_value(prune_col, partition_values(batch, prune_col)))
    return fresh.join(existing.select(*keys), list(keys), "left_anti").select(*batch.columns)


def apply_insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                           keep: str = "first") -> DataFrame:
    """The table after the load: target ∪ new rows."""
    return target.unionByName(insert_if_absent(target, batch, keys, order_cols, keep))


def upsert_latest(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The table after ``INSERT … ON CONFLICT (keys) DO UPDATE SET`` every other column.

    Later loads overwrite earlier ones (batch order first), and inside one load the last record by ``order_cols``
    wins. Primary-key columns cannot be NULL, so rows with a NULL key are rejected (see :func:`rejected_rows`).
    """
    cols = target.columns
    tagged = (target.withColumn("_load", F.lit(0)).unionByName(batch.select(*cols).withColumn("_load", F.lit(1)))
              .filter(~any_null(keys)))
    values = [c for c in cols if c not in keys]
    return latest_per_key(tagged, keys, ["_load", *order_cols], values, nulls_latest=False).select(*cols)


def rejected_rows(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows a primary key refuses (NULL key component)."""
    return batch.filter(any_null(keys))


def strict_append_conflicts(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                            prune_col: str | None = None) -> DataFrame:
    """Keys that would make a strict (COPY-style) append fail: repeated inside the batch or already in the target.

    Both sides are reduced to one row per key by partial aggregation before they meet. ``prune_col`` (a function of the
    key) limits the target scan to the batch's values of that column.
    """
    batch_keys = batch.filter(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_batch"))
    if prune_col is not None:
        target = target.filter(holds_value(prune_col, partition_values(batch, prune_col)))
    target_keys = target.filter(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_target"))
    report = batch_keys.join(target_keys, list(keys), "left")
    return (report.select(*keys, "n_batch", F.coalesce(F.col("n_target"), F.lit(0)).alias("n_target"))
            .filter((F.col("n_batch") > 1) | (F.col("n_target") > 0)))


def union_history(history: DataFrame, new: DataFrame, slice_col: str | None = None,
                  slice_names: tuple[str, str] = ("history", "new")) -> DataFrame:
    """UNION ALL by column name; columns missing on one side become NULL. No rewrite of the history itself."""
    if slice_col:
        history = history.withColumn(slice_col, F.lit(slice_names[0]))
        new = new.withColumn(slice_col, F.lit(slice_names[1]))
    return history.unionByName(new, allowMissingColumns=True)


def strict_append(target_path: str, target: DataFrame, batch: DataFrame, keys: Sequence[str],
                  fmt: str = "parquet", prune_col: str | None = None, partition_by: Sequence[str] = (),
                  sort_within: Sequence[str] = (), load: str | None = None) -> None:
    """Append ``batch`` only when no key collides; otherwise raise with the number of conflicting keys.

    The files are added all or none. A ``load`` of that name that the table holds already is taken back first, so a job
    that ended half-way and runs again doesn't collide with itself; ``target`` must have been read without it (see
    :func:`read_without`).
    """
    conflicts = strict_append_conflicts(target, batch, keys, prune_col)
    if not conflicts.isEmpty():
        raise ValueError(f"strict append refused: {conflicts.count()} conflicting keys")
    append_rows(target_path, batch, load, partition_by, sort_within, fmt)


def read_without(spark: SparkSession, target_path: str, load: str | None, fmt: str = "parquet") -> DataFrame | None:
    """The table once a load of that name, if it holds one, is taken back."""
    if load is not None:
        storage.remove_batch(spark, target_path, load)
    return storage.read_if_exists(spark, target_path, fmt)


def append_rows(target_path: str, rows: DataFrame, load: str | None = None, partition_by: Sequence[str] = (),
                sort_within: Sequence[str] = (), fmt: str = "parquet") -> str:
    """Append a load that has no key: every row counts, also one that is there already. Returns the load's name.

    The load's files are added all or none, and a load of the same name again replaces the former one, so a job that
    runs twice under one name has run once.
    """
    name = load or f"load-{uuid.uuid4().hex}"
    storage.append_batch(rows.sparkSession, target_path, name, lambda staging: storage.write_partitioned(
        rows, staging, partition_by, sort_within, fmt))
    return name


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_within: Sequence[str] = (),
                fmt: str = "parquet") -> None:
    """Write a new version of a table (optionally partitioned, rows in order inside each file for row-group skipping).

    The version is complete beside the table before it takes its place; a failing write leaves the table as it was.
    """
    storage.replace_table(df.sparkSession, path, lambda staging: storage.write_partitioned(
        df, staging, partition_by, sort_within, fmt))


def staged_rewrite(df: DataFrame, label: str = "stage", fmt: str = "parquet") -> DataFrame:
    """Materialise ``df`` to a fresh folder under the shared checkpoint directory and read it back.

    Cuts lineage, so executor loss cannot replay a half-written source. The folder goes when the session ends.
    """
    path = shared_path(df.sparkSession, "staging", f"{label}-{uuid.uuid4().hex}")
    fs, jpath = storage._fs(df.sparkSession, path)
    fs.deleteOnExit(jpath)
    df.write.mode("errorifexists").format(fmt).save(path)
    return df.sparkSession.read.schema(df.schema).format(fmt).load(path)


def upsert_table(target_path: str, batch: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                 partition_col: str, fmt: str = "parquet", sort_within: Sequence[str] = ()) -> None:
    """Upsert ``batch`` into a table partitioned by ``partition_col`` (a function of the key, e.g. the day of the
    observation timestamp; it may be NULL), rewriting only the partitions the batch touches.

    The touched partitions, and no others, are opened, merged with :func:`upsert_latest`, written beside the table and
    moved into the place of the old ones. A table that cannot be read fails the job; only a missing one counts as empty.
    """
    spark = batch.sparkSession
    values = partition_values(batch, partition_col)
    target = storage.read_partitions(spark, target_path, partition_col, values, fmt)
    if target is None:
        merged = upsert_latest(batch.limit(0), batch, keys, order_cols)
    else:
        kind = batch.schema[partition_col].dataType
        target = target.withColumn(partition_col, F.col(partition_col).cast(kind))
        merged = upsert_latest(target, batch.select(*target.columns), keys, order_cols)
    storage.replace_partitions(spark, target_path, lambda staging: storage.write_partitioned(
        merged, staging, [partition_col], sort_within, fmt))
