"""Line deduplication over levelled sorted runs of line hashes.

State: runs, each a bucketed and sorted table of line keys with the number of documents that hold the line and the
largest doc_id among them. A key is in one run only. A new batch is aggregated to its keys, written bucketed and sorted
once, and merged with every run in turn: the counts of the keys that a run has are added to the run's, and the keys that
no run has, found by a merge anti join, become a run of level 0. When a level has ``fanout`` runs they become one run of
the next level, by putting their rows together, as no two of them share a key; so a batch meets few runs. Whether a line
is in enough documents is read from the runs as they stand. A manifest names the runs of each level, so a later job
opens the state again and adds its batches.

A line's key is the line without white space at both ends and with A-Z in lower case; it is held as two 64-bit hashes.
Lines to drop are found as places in their row, and what is kept is put together from the stretches between them, so a
text's work grows with its lines.

Nulls and odd rows: a null or empty text is one empty line. A null doc_id takes no part: its lines count for nothing and
stay. Rows that repeat a doc_id are one document for the counts and lose the same lines. An empty table gives no rows.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import SPACE_CHARS, documents, let, shuffle_partitions, stage, staging_path, table
from airshed.operators.storage import delete, names_in, read_text, write_text

MIN_CHARS = 20
MIN_DOCUMENTS = 3
BATCHES = 4
FANOUT = 2
KEY = ["h1", "h2"]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else (``lower`` would also fold other letters; it serves where there are none)."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)) \
        .otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def line_key(line: Column) -> Column:
    """The two hashes of a line's key, or null where the key is too short to count."""
    key = F.trim(line, F.lit(SPACE_CHARS))
    folded = lower_ascii(key)
    return F.when(F.length(key) >= MIN_CHARS,
                  F.struct(F.xxhash64(folded).alias("h1"), F.xxhash64(F.lit(1), folded).alias("h2")))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def text_hash(text: Column) -> Column:
    """Tells apart rows that repeat a doc_id with another text."""
    return F.xxhash64(text)


def keyed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, place, h1, h2)``: a row per line of the input that counts, places from 0."""
    rows = documents(docs, id_col, text_col).where("doc_id is not null")
    split = rows.select("doc_id", text_hash(F.col("text")).alias("text_hash"), lines_of(F.col("text")).alias("lines"))
    lines = split.select("doc_id", "text_hash", F.posexplode("lines").alias("place", "line"))  # no text beside a line
    return lines.select("doc_id", "text_hash", "place", line_key(F.col("line")).alias("key")) \
        .where("key is not null").select("doc_id", "text_hash", "place", "key.*")


class LineRuns:
    """Levelled sorted runs of line keys in a folder of shared storage."""

    SCHEMA = "h1 long, h2 long, n_docs long, last_doc long"

    def __init__(self, spark: SparkSession, path: str, fanout: int = FANOUT, buckets: int | None = None):
        """Open the state in ``path``; a folder without one is an empty state with this number of buckets."""
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), fanout
        versions = [n for n in names_in(spark, self.path) if n.startswith("manifest-")]
        state = json.loads(read_text(spark, f"{self.path}/{versions[-1]}")) if versions else {}
        self.version = len(versions) and int(versions[-1].removeprefix("manifest-"))
        self.buckets = state.get("buckets") or buckets or shuffle_partitions(spark)
        self.levels: list[list[str]] = state.get("levels", [])

    def _open(self, name: str) -> DataFrame:
        """A bucketed table's reader; its catalog entry is there only while the reader is made."""
        entry = f"line_run_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE TABLE {entry} ({self.SCHEMA}) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}'")
        reader = self.spark.table(entry)
        self.spark.sql(f"DROP TABLE {entry}")
        return reader

    def _write(self, rows: DataFrame, dealt: bool = False) -> str:
        """A file per bucket, sorted by key, so joins of runs and batches need no exchange. Rows that come from one run
        are ``dealt`` to its buckets already."""
        name, entry = f"run-{uuid.uuid4().hex}", f"line_run_{uuid.uuid4().hex}"
        rows = rows.select(*KEY, "n_docs", "last_doc")
        (rows if dealt else rows.repartition(self.buckets, *KEY)).write.format("parquet") \
            .option("compression", "zstd").option("path", f"{self.path}/{name}").bucketBy(self.buckets, *KEY) \
            .sortBy(*KEY).saveAsTable(entry)
        self.spark.sql(f"DROP TABLE {entry}")
        return name

    def names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def keys(self) -> DataFrame:
        """``(h1, h2, n_docs, last_doc)`` of all batches: the runs' rows as they stand, a row per key."""
        runs = [self._open(name) for name in self.names()]
        return reduce(DataFrame.unionByName, runs) if runs else self.spark.createDataFrame([], self.SCHEMA)

    def fresh(self, batch: DataFrame) -> DataFrame:
        """The rows of a bucketed batch whose key no run has."""
        return reduce(lambda rows, name: rows.join(self._open(name), KEY, "left_anti"), self.names(), batch)

    @staticmethod
    def updated(run: DataFrame, batch: DataFrame) -> DataFrame:
        """The run with the batch's counts added to those of the keys it has."""
        more = batch.select(*KEY, F.col("n_docs").alias("more"), F.col("last_doc").alias("later"))
        return run.join(more, KEY, "left").select(
            *KEY, (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs"),
            F.greatest("last_doc", "later").alias("last_doc"))

    def add(self, batch: DataFrame) -> None:
        """Add a batch of ``(h1, h2, n_docs, last_doc)``, a row per key. The state changes as a whole, by the manifest.

        A batch must hold whole documents, and a document must not come in two batches.
        """
        before = self.names()
        staged = self._write(batch)
        rows = self._open(staged)
        levels = [[[self.updated(self._open(name), rows)] for name in level] for level in self.levels] or [[]]
        levels[0].append([self.fresh(rows)])
        k = 0
        while k < len(levels):  # a full level becomes one run of the next
            if len(levels[k]) >= self.fanout:
                levels += [[]] * (k + 1 == len(levels))
                levels[k + 1] = [*levels[k + 1], sum(levels[k], [])]
                levels[k] = []
            k += 1
        self.levels = [[self._write(reduce(DataFrame.unionByName, parts), dealt=len(parts) == 1) for parts in level]
                       for level in levels]
        self.version += 1
        write_text(self.spark, f"{self.path}/manifest-{self.version:08d}",
                   json.dumps({"buckets": self.buckets, "levels": self.levels}))
        for name in [*before, staged]:
            delete(self.spark, f"{self.path}/{name}")
        if self.version > 1:
            delete(self.spark, f"{self.path}/manifest-{self.version - 1:08d}")


def add_documents(runs: LineRuns, keyed: DataFrame) -> None:
    """Add the lines of some documents, none of which the runs have met, as one batch."""
    once = keyed.select("doc_id", *KEY).distinct()
    runs.add(once.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc")))


def repeated_lines(keyed: DataFrame, min_documents: int = MIN_DOCUMENTS, batches: int = BATCHES,
                   state: str | None = None) -> DataFrame:
    """``(h1, h2, n_docs, last_doc)`` of the keys held by at least ``min_documents`` documents, batch by batch.

    ``state`` is a folder whose runs the documents are added to, where there are some from an earlier job.
    """
    spark = keyed.sparkSession
    runs = LineRuns(spark, state or staging_path(spark, "line-runs"))
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for k in range(batches):
        add_documents(runs, keyed.where(batch == k))
    return runs.keys().where(F.col("n_docs") >= min_documents)


def without_places(lines: Column, gone: Column) -> Column:
    """The lines but those at the (ascending, different) places ``gone``, in time that grows with the lines.

    A flag for each line is laid out stretch by stretch, as a look-up or a slice per line would pass over the whole
    array each time.
    """
    bounds = F.concat(F.array(F.lit(-1)), gone)
    flags = let(bounds, lambda b: F.flatten(F.transform(F.sequence(F.lit(1), F.size(b) - 1), lambda k: F.concat(
        F.array_repeat(F.lit(False), b[k] - b[k - 1] - 1), F.array(F.lit(True))))))
    marked = F.zip_with(lines, flags, lambda line, drop: F.when(~F.coalesce(drop, F.lit(False)), line))
    return F.filter(marked, lambda line: line.isNotNull())


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_documents: int = MIN_DOCUMENTS, batches: int = BATCHES, state: str | None = None) -> DataFrame:
    """The rows of ``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``.

    Other columns are carried along; input columns of those three names are replaced. Lines whose key at least
    ``min_documents`` documents hold go, except from the largest doc_id that holds them. With ``state`` the documents of
    earlier jobs count too (see :func:`repeated_lines`).
    """
    keyed = stage(keyed_lines(docs, id_col, text_col), "line-keys")
    repeated = stage(repeated_lines(keyed, min_documents, batches, state).select(*KEY, "last_doc"), "line-repeats")
    drops = keyed.join(repeated, KEY).where("doc_id < last_doc").groupBy("doc_id", "text_hash") \
        .agg(F.sort_array(F.collect_set("place")).alias("line_drops")) \
        .withColumnsRenamed({"doc_id": "line_doc", "text_hash": "line_text"})
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(id_col).cast("long").alias("id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    joined = inner.join(drops, (F.col("id") == F.col("line_doc")) & (text_hash(F.col("text")) == F.col("line_text")),
                        "left")
    lines = lines_of(F.col("text"))
    some = F.col("line_drops").isNotNull()
    carried = [F.col("row").getField(c).alias(c) for c in docs.columns
               if c not in ("n_lines", "n_dropped", "kept_text")]
    return joined.select(
        *carried, F.size(lines).cast("long").alias("n_lines"),
        F.when(some, F.size("line_drops")).otherwise(F.lit(0)).cast("long").alias("n_dropped"),
        F.when(some, F.array_join(without_places(lines, F.col("line_drops")), "\n")).otherwise(F.col("text"))
        .alias("kept_text"))


def q_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


_DUCK_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, {_DUCK_SPACE}), '{_UPPER}', '{_UPPER.lower()}') AS line_key
  FROM lines),
repeated AS (
  SELECT line_key, max(doc_id) AS last_doc FROM keyed
  WHERE length(line_key) >= {MIN_CHARS}
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}),
marked AS (
  SELECT k.doc_id, k.pos, k.line, r.line_key IS NOT NULL AND k.doc_id <> r.last_doc AS dropped
  FROM keyed k LEFT JOIN repeated r USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
