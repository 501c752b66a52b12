"""SimHash near-duplicate detection with pigeonring filtering.

A document's fingerprint has 64 bits; two documents are linked when their fingerprints differ in at most
``max_distance`` bits, and a component is what links reach.

Candidate search (the pigeonring principle): cut the fingerprint into ``max_distance + 1`` consecutive segments on a
ring. For any two fingerprints within the distance there is a segment where every chain that begins there stays within
its share of the budget: the first segment differs in no bit, the first two in one bit at most, the first three in two,
and so on. A difference of one bit leaves one half of the second segment equal, so (first segment, one half of the
second) is an equality key for a join: eight keys a fingerprint at distance three, 24 equal bits each. The longer chains
are checked on the joined pair before the full Hamming distance.

Skew: copies share a fingerprint and are collapsed before any search. A key shared by over ``bucket_limit`` different
fingerprints is not searched by pairs. Its fingerprints meet in probe points instead: two fingerprints within distance
d have a point within d // 2 bits of one and d - d // 2 of the other, so each fingerprint is linked to the least
fingerprint of every point it reaches. The work is linear in the fingerprints, and components come out the same.

Nulls and odd rows: a null text is an empty one. A text without words has fingerprint zero and is linked like any other.
A null doc_id gets a fingerprint, no component, and takes no part in linking. Repeated rows each return a row. An empty
table returns no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import documents, stage, table
from airshed.llm.components import connected_components

BITS = 64
MAX_DISTANCE = 3
SHINGLE_WORDS = 3
BUCKET_LIMIT = 64
HASH_SEED = 42
_BLOCK = 1 << 15  # shingles hashed at a time, so that a long text needs no more memory than a short one


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> bytes:
    """The 8-byte SimHash of a text, most significant bit first."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return bytes(BITS // 8)
    n = max(1, len(words) - shingle_words + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        part = words[at:at + _BLOCK + shingle_words - 1]
        columns = [part[k:] for k in range(min(shingle_words, len(words)))]
        digests = b"".join([xxhash.xxh64_digest(b" ".join(s), HASH_SEED) for s in zip(*columns)])
        bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, BITS // 8), axis=1)
        ones += np.add.reduce(bits, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed long, one row per input row."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = b"".join(fingerprint(t.as_py(), shingle_words) for t in batch.column("text"))
            values = np.frombuffer(prints, dtype=">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], names=["doc_id", "fp"])

    return documents(docs, id_col, text_col).mapInArrow(hashed, "doc_id long, fp long")


def _segments(max_distance: int) -> list[tuple[int, int]]:
    """``(shift, width)`` of the ring's segments, which cover all bits."""
    n = max_distance + 1
    cuts = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _bits(value: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << width) - 1))


def ring_keys(fp: Column, max_distance: int) -> Column:
    """Equality keys of a fingerprint: (start, first segment, one half of the second segment)."""
    ring = _segments(max_distance)
    keys = []
    for k, (shift, width) in enumerate(ring):
        shift2, width2 = ring[(k + 1) % len(ring)]
        low = width2 // 2
        for half, (s, w) in enumerate(((shift2, low), (shift2 + low, width2 - low))):
            keys.append(F.struct(F.lit(2 * k + half).alias("start"), _bits(fp, shift, width).alias("first"),
                                 _bits(fp, s, w).alias("second")))
    return F.array(*keys)


def chains_hold(start: Column, a: Column, b: Column, max_distance: int) -> Column:
    """Whether every chain of segments from ``start`` on stays within its share of the budget, and so the whole ring."""
    ring = _segments(max_distance)
    diff = a.bitwiseXOR(b)
    verdict = F.lit(False)
    for k in range(len(ring)):
        spent, ok = F.lit(0), F.lit(True)
        for length in range(1, len(ring) + 1):
            shift, width = ring[(k + length - 1) % len(ring)]
            spent = spent + F.bit_count(_bits(diff, shift, width))
            ok = ok & (spent <= length * max_distance // len(ring))
        verdict = F.when(F.shiftright(start, 1) == k, ok).otherwise(verdict)
    return verdict & (F.bit_count(diff) <= max_distance)


def _ball(prints: DataFrame, radius: int) -> DataFrame:
    """``(fp, x)``: every point within ``radius`` bits of each fingerprint, once."""
    out = prints.select("fp", F.col("fp").alias("x"), F.lit(0).alias("low"))
    for _ in range(radius):
        flips = (f"concat(array(struct(x, {BITS} as low)), if(low >= {BITS}, array(), "
                 f"transform(sequence(low, {BITS - 1}), i -> struct(x ^ shiftleft(1L, i) as x, i + 1 as low))))")
        out = out.selectExpr("fp", f"inline({flips})")
    return out.select("fp", "x")


def links(prints: DataFrame, max_distance: int = MAX_DISTANCE, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``(u, v)`` links between distinct fingerprints ``(fp)`` that connect all those within ``max_distance`` bits.

    Every returned pair is within the distance. In buckets of at most ``bucket_limit`` fingerprints all pairs are
    returned; in larger ones enough of them to connect the same components.
    """
    if not 0 <= max_distance <= 4:
        raise ValueError("max_distance must be between 0 and 4")
    if max_distance == 0:
        return prints.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    keyed = prints.select("fp", F.explode(ring_keys(F.col("fp"), max_distance)).alias("key")).select("fp", "key.*")
    on = ["start", "first", "second"]
    sizes = keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stage(keyed.join(sizes, on), "simhash-keys")

    small = shared.where(F.col("size") <= bucket_limit)
    a, b = small.alias("a"), small.alias("b")
    near = chains_hold(F.col("a.start"), F.col("a.fp"), F.col("b.fp"), max_distance)
    pairs = a.join(b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on] + [F.col("a.fp") < F.col("b.fp"), near]) \
        .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))

    crowded = shared.where(F.col("size") > bucket_limit).select("fp").distinct()
    inner = max_distance // 2
    least = _ball(crowded, inner).groupBy("x").agg(F.min("fp").alias("least"))
    # the size estimate of a ball is that of its centres: without the hint Spark would broadcast it
    met = _ball(crowded, max_distance - inner).join(least.hint("merge"), "x").where("fp != least") \
        .select(F.col("fp").alias("u"), F.col("least").alias("v"))
    return pairs.union(met).distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
                       bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row; component_id is the least doc_id reached."""
    prints = stage(fingerprints(docs, id_col, text_col, shingle_words), "simhash-prints")
    classes = prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    roots = connected_components(links(classes.select("fp"), max_distance, bucket_limit)) \
        .select(F.col("node").alias("fp"), "root")
    rooted = classes.join(roots, "fp", "left").select("fp", "first_doc", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    members = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(members, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), BITS // 4, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
