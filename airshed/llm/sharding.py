"""Shards by jump consistent hashing: no ring, no table, and an appended shard takes rows only into itself.

A key's jumps are the shard counts at which it moves: with ``b`` the shard it has now, the next one is
``floor((b + 1) * 2^31 / r)`` with ``r`` drawn from the key's own sequence of 64-bit numbers. The last jump below the
shard count is the shard, the one after it tells when the row will move next. All of it is one expression a row, so
dealing documents to shards needs no exchange. The 64-bit products are built from limbs of 21 bits, which no SQL
arithmetic overflows.

The manifest numbers the rows of a shard without gaps, by doc_id, size and checksum. Rows that agree in all three are
counted first, then ranges of (shard, doc_id, size, checksum) are numbered on their own and moved by the counts of the
ranges before them, so no task sees a shard and a doc_id that holds a third of all rows is spread over many ranges.

Nulls and odd rows: a null text has no bytes (size 8, checksum of nothing). A null doc_id counts as 0 for the key, so
such rows are in one shard, as are rows that repeat an id; each gets a slot of its own. An empty table gives no rows,
and an empty shard no slots. Columns of the input beside id and text are carried by ``with_shards`` (columns named
``shard`` or ``moves_at`` are replaced) and left behind by ``manifest``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airshed.llm.common import documents, let, shuffle_partitions, stage, table

SHARDS = 24
ROW_BYTES = 8
# Fixed value: the multiplier of the generator that the published jump hash uses; its increment is 1.
MULTIPLIER = 2862933555777941757
LIMB = 21
_MASK, _TOP = (1 << LIMB) - 1, (1 << 64 - 2 * LIMB) - 1
# With n shards a key makes about ln(n) jumps; keys that make more than this many are followed to their end apart.
USUAL_JUMPS = 64
COPIES_AT_ONCE = 1 << 16


def next_draw(state: Column) -> Column:
    """``state * MULTIPLIER + 1`` modulo 2^64, as a signed 64-bit number."""
    k0, k1, k2 = (F.shiftrightunsigned(state, LIMB * k).bitwiseAND(_MASK if k < 2 else _TOP) for k in range(3))
    m0, m1, m2 = (F.lit(MULTIPLIER >> LIMB * k & (_MASK if k < 2 else _TOP)).cast("long") for k in range(3))
    low = k0 * m0 + 1
    middle = k0 * m1 + k1 * m0 + F.shiftrightunsigned(low, LIMB)
    odd = F.shiftleft((k1 * m2 + k2 * m1).bitwiseAND(F.lit(1).cast("long")), LIMB)  # lands on the top bit
    high = k0 * m2 + k1 * m1 + k2 * m0 + F.shiftrightunsigned(middle, LIMB) + odd
    return low.bitwiseAND(_MASK).bitwiseOR(F.shiftleft(middle.bitwiseAND(_MASK), LIMB)) \
        .bitwiseOR(F.shiftleft(high.bitwiseAND(_TOP), 2 * LIMB))


def jump(key: Column, shards: int) -> Column:
    """``struct(shard, moves_at)`` of a 64-bit key: its shard, and the shard that takes it as the next one."""
    def after(state: Column) -> Column:
        draw = F.shiftrightunsigned(state["draws"], 33) + 1
        return ((state["shard"] + 1) * (F.lit(float(1 << 31)) / draw.cast("double"))).cast("long")

    def step(state: Column, _: Column) -> Column:
        moved = F.struct(after(state).alias("shard"), next_draw(state["draws"]).alias("draws"))
        return F.when(after(state) < shards, moved).otherwise(state)

    def followed(jumps: int) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("shard"), next_draw(key).alias("draws"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(jumps)), start, step)

    def result(state: Column) -> Column:
        return F.struct(state["shard"].cast("int").alias("shard"), after(state).alias("moves_at"))

    if shards == 1:
        return result(F.struct(F.lit(0).cast("long").alias("shard"), next_draw(key).alias("draws")))
    most = shards - 1  # a jump goes up by one at least
    if most <= USUAL_JUMPS:
        return let(followed(most), result)
    usual = let(followed(USUAL_JUMPS), result)
    return let(usual, lambda found: F.when(found["moves_at"] >= shards, found)
               .otherwise(let(followed(most), result)))


def with_shards(docs: DataFrame, shards: int = SHARDS, key: Column | str = "doc_id") -> DataFrame:
    """``docs`` with ``shard`` and ``moves_at``, the shard count minus one at which the row leaves its shard.

    ``key`` is any 64-bit expression of the row: an id, or a hash of several columns.
    """
    key = F.col(key) if isinstance(key, str) else key
    placed = jump(F.coalesce(key.cast("long"), F.lit(0).cast("long")), shards)
    carried = [F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "moves_at")]
    return docs.select(*carried, placed.alias("shard")).select(
        *carried, F.col("shard.shard").alias("shard"), F.col("shard.moves_at").alias("moves_at"))


def movers(docs: DataFrame, shards: int = SHARDS, key: Column | str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that an appended shard takes over, about one in ``shards + 1``, with their old shard."""
    return with_shards(docs, shards, key).where(F.col("moves_at") == shards)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, key: Column | str = "doc_id",
                 files_per_shard: int = 1) -> None:
    """Write ``docs`` as Parquet, a folder a shard; a shard's rows are salted over a number of files."""
    placed = with_shards(docs, shards, key).drop("moves_at")
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if c != "shard"]), F.lit(files_per_shard))
    placed.repartition(shards * files_per_shard, "shard", salt).write.partitionBy("shard").parquet(path)


def numbered(rows: DataFrame, shard: str, order: list[str], copies: str, label: str) -> DataFrame:
    """``rows`` with ``slot``: how many rows of the shard come before it, a row counting for its ``copies``.

    The rows are dealt by ranges of (shard, order) and written with their range; a range is numbered in one task and
    moved by the sums of the shard's ranges before it, of which there are as many as ranges.
    """
    keys = [shard, *order]
    ranged = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys)
    ranged = stage(ranged.withColumn("part", F.spark_partition_id()), f"{label}-ranges")
    sums = ranged.groupBy("part", shard).agg(F.sum(copies).alias("n"))
    before = sums.select("part", shard, (F.sum("n").over(Window.partitionBy(shard).orderBy("part")) - F.col("n"))
                         .alias("before"))
    inside = Window.partitionBy("part", shard).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.withColumn("inside", F.coalesce(F.sum(copies).over(inside), F.lit(0)))
    return counted.join(before, ["part", shard]).withColumn("slot", F.col("before") + F.col("inside")) \
        .drop("part", "before", "inside")


def each_copy(rows: DataFrame, copies: str, slot: str, at_once: int = COPIES_AT_ONCE) -> DataFrame:
    """A row for each of the ``copies``, with slots from ``slot`` on; large counts are dealt out in pieces first."""
    def spread(df: DataFrame, first: Column, n: Column) -> DataFrame:
        return df.withColumn("copy", F.explode(F.sequence(first, first + n - 1))) \
            .withColumn(slot, F.col(slot) + F.col("copy")).drop("copy", copies)

    nothing, count = F.lit(0).cast("long"), F.col(copies)
    few = spread(rows.where(count <= at_once), nothing, count)
    pieces = rows.where(count > at_once) \
        .withColumn("piece", F.explode(F.sequence(nothing, F.floor((count - 1) / at_once).cast("long")))) \
        .withColumn("piece", F.col("piece") * at_once)
    pieces = pieces.repartition("piece", slot)
    many = spread(pieces, F.col("piece"), F.least(F.lit(at_once).cast("long"), count - F.col("piece"))).drop("piece")
    return reduce(DataFrame.unionByName, [few, many])


def manifest(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row per input row.

    ``size`` is the text's bytes and ``ROW_BYTES`` more; ``slot`` numbers a shard's rows; ``grown_shard`` is the shard
    once another one is appended.
    """
    rows = documents(docs, id_col, text_col).select(
        "doc_id", (F.octet_length("text") + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    alike = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    placed = stage(with_shards(alike, shards), "shard-rows")
    slots = numbered(placed, "shard", ["doc_id", "size", "text_crc32"], "copies", "shard")
    grown = F.when(F.col("moves_at") == shards, F.lit(shards)).otherwise(F.col("shard"))
    return each_copy(slots, "copies", "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        grown.cast("int").alias("grown_shard"))


def q_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


# The jumps of all keys go on together, a step a level, and the last one below the shard count is a key's shard. Fixed
# value: the reversed polynomial of the checksum, 3988292384.
ORACLE = f"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS steps FROM bits WHERE k = 8),
jumps(key, shard, draw) AS (
  SELECT DISTINCT coalesce(doc_id, 0), 0::BIGINT,
         ((coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616 * {MULTIPLIER} + 1)
         % 18446744073709551616
  FROM documents
  UNION ALL
  SELECT key, floor((shard + 1) * (2147483648::DOUBLE / ((draw >> 33) + 1)::DOUBLE))::BIGINT,
         (draw * {MULTIPLIER} + 1) % 18446744073709551616
  FROM jumps WHERE shard < {SHARDS}),
placed AS (
  SELECT key, max(shard) FILTER (shard < {SHARDS}) AS shard, max(shard) FILTER (shard <= {SHARDS}) AS grown
  FROM jumps GROUP BY key),
sums AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + {ROW_BYTES} AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
             lambda s, x: xor(s >> 8, steps[(xor(s, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
       grown::INTEGER AS grown_shard
FROM sums JOIN placed ON coalesce(doc_id, 0) = key
"""
