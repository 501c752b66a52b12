"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.session import shared_path

# Fixed value: the white space that separates words and is stripped from line keys (blank, tab to carriage return).
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id long, text string)`` of any input: a null text reads as empty, all other columns are left behind."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


class Recent(dict):
    """A bounded cache in two generations: when the newer is full, the older goes.

    The newer generation is the mapping itself, so a plain ``get`` is as fast as can be; ``recall`` also asks the older
    one and moves what it finds to the newer.
    """

    def __init__(self, entries: int):
        super().__init__()
        self.entries, self.older = entries, {}

    def recall(self, key):
        value = self.older.get(key)
        if value is not None:
            self[key] = value
        return value

    def age(self) -> None:
        """Start a new generation if this one is full; to be called where no lookup is under way."""
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()


def holes(values: list):
    """The places of None in a list."""
    at = -1
    for _ in range(values.count(None)):
        at = values.index(None, at + 1)
        yield at


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text: its maximal runs of characters other than white space."""
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a reader of it.

    Cuts the lineage: a lost executor costs a re-read, not a re-run. The folder goes when the session's file system
    closes, as lazily evaluated results may read it until then.
    """
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staging_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the driver's file system closes."""
    path = shared_path(spark, f"{label}-{uuid.uuid4().hex}")
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def bucketed(df: DataFrame, label: str, buckets: int, *columns: str, sort: bool = False) -> DataFrame:
    """Write ``df`` once in the shared folder, bucketed (and sorted) by columns, and return a reader that knows it.

    Joins and aggregates on the columns then leave its rows where they are. Buckets need a catalog entry to be written
    and read; it is dropped as soon as the reader has it, so nothing stays in a metastore.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("compression", "zstd").option("path", staging_path(spark, name)) \
        .bucketBy(buckets, *columns)
    (writer.sortBy(*columns) if sort else writer).saveAsTable(name)
    reader = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return reader


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
