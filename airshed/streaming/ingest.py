"""Incremental ingest (T1) with Structured Streaming.

The daily loads of the warehouse become a file-source stream run with ``trigger(availableNow=True)``: every run picks
up exactly the files that arrived since the last one (tracked in the checkpoint), and each micro-batch is merged into
the target with the keyed sinks. A batch's files carry the batch's name and are recorded with the table, and a batch
that is run again after a failure first removes exactly those; an upsert comes out the same when it is repeated. So rows
arrive exactly once, those with a NULL in their key included. A batch opens its record and the day folders that its rows
fall in, so its cost does not grow with the table. Late history (flights arrive days late) is handled by the keyed merge itself; an
optional in-stream dedupe uses ``dropDuplicatesWithinWatermark`` with a 4-day lateness.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from airshed.operators import storage
from airshed.operators.sinks import insert_if_absent, partition_values, staged_rewrite, upsert_table


def merge_batch(batch: DataFrame, target_path: str, keys: Sequence[str], order_cols: Sequence[str],
                batch_name: str, mode: str = "insert_if_absent", keep: str = "first",
                partition_col: str | None = None, prune_col: str | None = None,
                sort_within: Sequence[str] = (), touched: Callable[[list], None] | None = None) -> None:
    """Merge one micro-batch into a Parquet table; the same ``batch_name`` again replaces what it added before.

    ``insert_if_absent``: only rows with new keys are appended (existing keys win), in folders by ``partition_col`` if
    given; ``prune_col`` (a key column such as the day) limits the target scan to the batch's values, and where it is the
    partition column no other folder is opened. ``upsert``: last write wins; only the partitions (``partition_col``) the
    batch touches are rewritten. The batch is written out once, as merging looks at it several times. ``touched`` is
    told the batch's partition values before the table changes.
    """
    spark = batch.sparkSession
    rows = staged_rewrite(batch, "batch")
    values = partition_values(rows, partition_col) if partition_col else []
    if touched:
        touched(values)
    if mode == "upsert":
        if partition_col is None:
            raise ValueError("upsert needs the partition column the key determines")
        upsert_table(target_path, rows, keys, order_cols, partition_col, sort_within=sort_within)
        return
    if mode != "insert_if_absent":
        raise ValueError("mode must be 'insert_if_absent' or 'upsert'")
    storage.remove_batch(spark, target_path, batch_name)
    by_folder = partition_col is not None and prune_col == partition_col
    target = storage.read_partitions(spark, target_path, partition_col, [v for v in values if v is not None]) \
        if by_folder else storage.read_if_exists(spark, target_path)
    new = insert_if_absent(rows.limit(0) if target is None else target, rows, keys, order_cols, keep,
                           prune_col=None if target is None or by_folder else prune_col)
    storage.append_batch(spark, target_path, batch_name, lambda staging: storage.write_partitioned(
        new, staging, [partition_col] if partition_col else [], sort_within))


def incremental_ingest(spark: SparkSession, source_dir: str, schema: StructType | None, target_path: str,
                       checkpoint_path: str, keys: Sequence[str], order_cols: Sequence[str],
                       source_format: str = "parquet", glob: str | None = None, files_per_trigger: int | None = None,
                       transform: Callable[[DataFrame], DataFrame] | None = None,
                       mode: str = "insert_if_absent", recursive: bool = True, keep: str = "first",
                       partition_col: str | None = None, prune_col: str | None = None,
                       sort_within: Sequence[str] = (), reader_options: Mapping[str, str] | None = None,
                       prepare: Callable[[DataFrame], DataFrame] | None = None,
                       touched: Callable[[list], None] | None = None) -> None:
    """Process every file not yet seen under ``source_dir`` and merge it into ``target_path``; returns when done.

    ``prepare`` maps the stream (e.g. adds file columns), ``transform`` maps each micro-batch to warehouse rows (e.g.
    flight flattening). ``reader_options`` go to the source (e.g. ``wholetext`` for files holding a JSON array).
    """
    reader = spark.readStream.format(source_format)
    if schema is not None:
        reader = reader.schema(schema)
    options = dict(reader_options or {})
    if recursive:  # landing folders (day, city) are plain directories, not key=value partitions
        options["recursiveFileLookup"] = "true"
    if glob:
        options["pathGlobFilter"] = glob
    if files_per_trigger:
        options["maxFilesPerTrigger"] = str(files_per_trigger)
    stream = reader.options(**options).load(source_dir)
    if prepare:
        stream = prepare(stream)
    source = hashlib.sha1(checkpoint_path.encode()).hexdigest()[:10]  # two streams may feed one table

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        merge_batch(rows, target_path, keys, order_cols, f"b{source}x{batch_id}", mode, keep, partition_col, prune_col,
                    sort_within, touched)

    query = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def append_stream(spark: SparkSession, source_dir: str, schema: StructType, transform: Callable[[DataFrame], DataFrame],
                  target_path: str, checkpoint_path: str, source_format: str = "parquet") -> None:
    """Run a stateful stream over the files not yet seen and append what it emits to ``target_path``.

    State and watermark stay with the checkpoint from run to run; the sink's own log makes its files appear once.
    """
    stream = spark.readStream.format(source_format).schema(schema).option("recursiveFileLookup", "true").load(source_dir)
    query = (transform(stream).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start(target_path))
    query.awaitTermination()


def dedupe_in_stream(stream: DataFrame, keys: Sequence[str], event_time: str, lateness: str = "4 days") -> DataFrame:
    """Drop repeated keys inside the stream while they can still arrive (event time must be TIMESTAMP, so an NTZ
    column is cast first)."""
    timed = stream.withColumn("_event_time", F.col(event_time).cast("timestamp"))
    return (timed.withWatermark("_event_time", lateness).dropDuplicatesWithinWatermark([*keys])
            .drop("_event_time"))


def hourly_counts_stream(stream: DataFrame, code: str, event_time: str, lateness: str = "4 days") -> DataFrame:
    """Tumbling one-hour counts per upper-cased code, emitted once the watermark passes the hour."""
    timed = stream.withColumn("_event_time", F.col(event_time).cast("timestamp"))
    return (timed.withWatermark("_event_time", lateness)
            .groupBy(F.upper(F.col(code)).alias("airport_code"), F.window("_event_time", "1 hour"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("airport_code", F.col("window.start").cast("timestamp_ntz").alias("date"), "n"))
