"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

An item is found in a document when at least ``min_containment`` of the item's distinct shingles (five words, A-Z and
other letters in lower case, joined by a blank) occur in the document. A whole document's MinHash says nothing about an
item of thirty words inside it, so only the items are sketched: the items are partitioned by size (powers of two of
their shingle count), and an item's sketch is the k least hashes of its shingles, with k taken from the upper size of
its partition so that it exceeds the number of shingles a document may lack. Every document that holds the item thus
holds one of the sketch's hashes: the search loses nothing. Each candidate pair is then verified on the shingles
themselves. Items of fewer words than a shingle are size partitions of their own: their shingle is the whole item, and
the documents are read in windows of that length too, where such items occur.

The document side is never shuffled for the search as long as the sketches fit ``BROADCAST_BYTES`` (their bytes are
known: two longs a row); beyond it the same join is left to Spark to shuffle.

Nulls and odd rows: null texts have no words and match nothing, null ids take no part. An item of fewer words than a
shingle has one shingle, its whole sequence; one without words has none. Rows that repeat an id are one document (item)
with the shingles of all its rows; an item's rows of different short lengths are searched apart and found where the
shingles of one length suffice. Empty tables give no rows.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import documents, stage, table, words_of

SHINGLE_WORDS = 5
MIN_CONTAINMENT = Fraction(4, 5)
BROADCAST_BYTES = 32 << 20
_ROW_BYTES = 24  # hash and item id with a row's overhead


def _word_windows(words: Column, n: int) -> Column:
    """Windows of ``n`` words as structs; the last ``n - 1`` have null ends. A shorter text has one, with null ends."""
    shifted = [words.alias("w0")] + [F.slice(words, k + 1, F.greatest(F.size(words), F.lit(1))).alias(f"w{k}")
                                     for k in range(1, n)]
    return F.arrays_zip(*shifted)


def shingle_rows(texts: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, w0 .. w{n-1})`` of ``(doc_id, text)``: a row per shingle; a short text's row has nulls at its end."""
    split = texts.select("doc_id", words_of(F.lower("text")).alias("words")).where("size(words) > 0")
    windows = F.slice(_word_windows(F.col("words"), n), 1, F.greatest(F.size("words") - (n - 1), F.lit(1)))
    return split.select("doc_id", F.inline(windows))


def _columns(n: int) -> list[Column]:
    return [F.col(f"w{k}") for k in range(n)]


def shingle_hash(n: int = SHINGLE_WORDS) -> Column:
    return F.xxhash64(*_columns(n))


def shingle_text(n: int = SHINGLE_WORDS) -> Column:
    return F.concat_ws(" ", *_columns(n))


def item_shingles(items: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """``(item_id, shingle, hash, n_shingles)`` of every item, each shingle once."""
    rows = shingle_rows(documents(items, id_col, text_col).where("doc_id is not null"), n) \
        .select(F.col("doc_id").alias("item_id"), shingle_text(n).alias("shingle"), shingle_hash(n).alias("hash")) \
        .distinct()
    sizes = rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_shingles"))
    return rows.join(sizes, "item_id")


def sketches(shingles: DataFrame, min_containment: Fraction = MIN_CONTAINMENT) -> DataFrame:
    """``(item_id, hash)``: the bottom-k MinHash of every item, k by its size partition."""
    upper = F.pow(F.lit(2.0), F.ceil(F.log2("n_shingles")))  # the partition's largest size
    may_lack = F.floor(upper * float(1 - min_containment) + 1e-9)
    per_item = shingles.groupBy("item_id").agg(F.sort_array(F.collect_set("hash")).alias("hashes"),
                                               F.max("n_shingles").alias("n_shingles"))
    return per_item.select("item_id", F.explode(F.slice("hashes", F.lit(1), (may_lack + 1).cast("int"))).alias("hash"))


def _find_long(texts: DataFrame, items: DataFrame, n: int, min_containment: Fraction) -> DataFrame:
    """:func:`find_items` for items ``(doc_id, text)`` of at least ``n`` words."""
    shingles = stage(item_shingles(items, "doc_id", "text", n), "decontam-items")
    sketch = stage(sketches(shingles, min_containment), "decontam-sketches")
    if sketch.count() * _ROW_BYTES <= BROADCAST_BYTES:
        sketch = F.broadcast(sketch)

    probes = shingle_rows(texts, n).select("doc_id", shingle_hash(n).alias("hash"))
    candidates = stage(probes.join(sketch, "hash").select("doc_id", "item_id").distinct(), "decontam-candidates")

    suspects = texts.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
    held = shingle_rows(suspects, n).select("doc_id", shingle_text(n).alias("shingle")).distinct()
    wanted = candidates.join(shingles.select("item_id", "shingle", "n_shingles"), "item_id")
    shared = wanted.join(held, ["doc_id", "shingle"]).groupBy("doc_id", "item_id", "n_shingles") \
        .agg(F.count(F.lit(1)).alias("n_shared"))
    enough = F.col("n_shared") * min_containment.denominator >= F.col("n_shingles") * min_containment.numerator
    return shared.where(enough).select("doc_id", "item_id", "n_shared", "n_shingles")


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", shingle_words: int = SHINGLE_WORDS,
               min_containment: Fraction = MIN_CONTAINMENT) -> DataFrame:
    """``(doc_id, item_id, n_shared, n_shingles)`` for every document and item it holds."""
    n = shingle_words
    texts = documents(docs, id_col, text_col).where("doc_id is not null")
    wanted = documents(items, item_col, item_text_col).where("doc_id is not null")
    sized = stage(wanted.withColumn("length", F.least(F.size(words_of(F.lower("text"))), F.lit(n)))
                  .where("length > 0"), "decontam-lengths")
    lengths = sorted(r["length"] for r in sized.select("length").distinct().collect()) or [n]  # n of them at most
    found = [_find_long(texts, sized.where(F.col("length") == m).drop("length"), m, min_containment) for m in lengths]
    return found[0] if len(found) == 1 else reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(
        F.max_by(F.struct("n_shared", "n_shingles"), "n_shingles").alias("best")).select("doc_id", "item_id", "best.*")


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_DUCK_WORDS = r"[x FOR x IN string_split_regex(lower(text), '[\x20\x09-\x0D]+') IF x <> '']"

# An item is searched in windows of its own length, up to that of a shingle.
ORACLE = f"""
WITH items AS (
  SELECT item_id, w, least(len(w), {SHINGLE_WORDS}) AS n FROM (SELECT item_id, {_DUCK_WORDS} AS w FROM benchmark)
  WHERE len(w) > 0 AND item_id IS NOT NULL),
wanted AS (
  SELECT DISTINCT item_id, n, unnest([list_aggregate(w[i:i + n - 1], 'string_agg', ' ')
                                      FOR i IN range(1, len(w) - n + 2)]) AS shingle FROM items),
held AS (
  SELECT DISTINCT doc_id, n, unnest([list_aggregate(w[i:i + n - 1], 'string_agg', ' ')
                                     FOR i IN range(1, len(w) - n + 2)]) AS shingle
  FROM (SELECT doc_id, {_DUCK_WORDS} AS w FROM documents WHERE doc_id IS NOT NULL), (SELECT DISTINCT n FROM items)),
sized AS (SELECT item_id, n, shingle, count(*) OVER (PARTITION BY item_id, n) AS n_shingles FROM wanted)
SELECT doc_id, item_id, count(*) AS n_shared, n_shingles
FROM held JOIN sized USING (n, shingle)
GROUP BY doc_id, item_id, n_shingles
HAVING count(*) * {MIN_CONTAINMENT.denominator} >= n_shingles * {MIN_CONTAINMENT.numerator}
"""
