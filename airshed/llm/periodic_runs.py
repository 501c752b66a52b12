"""Runs of words that repeat with a period, found from equal minimizers at several scales.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends, at least three periods
and ``MIN_WORDS`` long. Each scale P looks for the periods in (P, 2P]: grams of P/2 words are hashed, and of every window
of P/2 grams the least hash is a minimizer. In a run the windows repeat at period distance, and so do their minimizers;
two equal minimizers at a distance in the scale's range are a seed, which is extended to both sides as far as the words
that far apart are equal. Periods up to ``SHORT`` are too short for a scale; each of them is scanned for directly, as a
lag over all words.

Why nothing is lost: windows begin at more than q places of a run and repeat q words on. A gram that itself has a period
of a third of its length or less would meet itself too often, so it is no minimizer; such grams lie in runs that the
smaller scales have found. Not all grams of a run are of that kind, or the run had that smaller period. Any other gram
meets itself at most twelve times within the range. Hashes decide only where to look; words are compared by their ids.

Documents are worked off in slices of a batch, longest first, so that a scale's documents are the front of the arrays.

Nulls and odd rows: a null text has no words and no runs. Rows are independent: each gives a row, also with a null or
repeated doc_id; other columns are left behind, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.batches import IS_SPACE, slices, text_arrays
from airshed.llm.common import documents, let, table, words_of

MIN_WORDS = 24
MIN_PERIODS = 3
# Periods up to this one are scanned for as lags; the scales begin here. The least gram has half as many words.
SHORT = 16
RUN_TYPE = "array<struct<start:long,length:long,period:long>>"
PLANT_ONE_IN = 10


def split_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, text after text, and the number of words of each text."""
    space = IS_SPACE[data]
    filled = ends > starts
    begins, closes = ~space, ~space
    begins[1:] &= space[:-1]
    closes[:-1] &= space[1:]
    begins[starts[filled]] |= ~space[starts[filled]]
    closes[ends[filled] - 1] |= ~space[ends[filled] - 1]
    first = np.flatnonzero(begins)
    lengths = np.flatnonzero(closes) + 1 - first
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data[~space]))
    return words, np.searchsorted(first, ends) - np.searchsorted(first, starts)


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers; products wrap. The constants of the SplitMix64 finaliser."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def sliding(values: np.ndarray, window: int, pick) -> np.ndarray:
    """The least (or greatest) of every window of a power of two of neighbours."""
    width = 1
    while width < window:
        values = pick(values[:-width], values[width:])
        width *= 2
    return values


def stretches(places: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches of at least ``least`` consecutive numbers among ascending places: their starts and ends."""
    far = places[least - 1:] - places[:max(len(places) - least + 1, 0)] == least - 1
    hit = np.flatnonzero(far)
    if not len(hit):
        return hit, hit
    new = np.flatnonzero(np.diff(hit) > 1)
    return places[hit[np.append(0, new + 1)]], places[hit[np.append(new, len(hit) - 1)] + least - 1] + 1


def prime_factors(number: int) -> list[int]:
    found, factor = [], 2
    while factor * factor <= number:
        if number % factor == 0:
            found.append(factor)
            while number % factor == 0:
                number //= factor
        factor += 1
    return found + [number] * (number > 1)


class RunFinder:
    """Runs of an array of word ids in which a number of its own stands after each text."""

    def __init__(self, words: np.ndarray, least: int):
        self.words, self.least = words, least
        self.found: list[tuple[int, int, int]] = []  # start, end, period

    def _keep(self, start: int, end: int, period: int) -> None:
        """Take the run unless its words also have a smaller period; that one is found on its own."""
        head = self.words[start:start + period]
        for factor in prime_factors(period):
            part = period // factor
            if np.array_equal(head[part:], head[:period - part]):
                return
        self.found.append((start, end, period))

    def scan_lag(self, lag: int, least: int) -> None:
        equal = np.flatnonzero(self.words[:-lag] == self.words[lag:])
        need = max((MIN_PERIODS - 1) * lag, least - lag)
        for start, end in zip(*(part.tolist() for part in stretches(equal, need))):
            self._keep(start, end + lag, lag)

    def _extent(self, place: int, lag: int) -> tuple[int, int]:
        """How far to both sides of ``place`` the words equal those ``lag`` words on."""
        words, end, step = self.words, place, 64
        while end + lag < len(words):
            to = min(end + step, len(words) - lag)
            differ = words[end:to] != words[end + lag:to + lag]
            if differ.any():
                end += int(differ.argmax())
                break
            end, step = to, 2 * step
        start, step = place, 64
        while start > 0:
            to = max(start - step, 0)
            differ = words[to:start] != words[to + lag:start + lag]
            if differ.any():
                start -= int(differ[::-1].argmax())
                break
            start, step = to, 2 * step
        return start, end

    def minimizers(self, hashes: np.ndarray, gram: int, limit: int) -> np.ndarray:
        """Places of the window minima among the grams that have no short period."""
        free = np.ones(len(hashes), bool)
        for start, end, period in self.found:
            if MIN_PERIODS * period <= gram <= end - start and start < limit:
                free[start:end - gram + 1] = False
        ranked = np.where(free, hashes, np.uint64(0xFFFFFFFFFFFFFFFF))
        least = sliding(ranked, gram, np.minimum)
        edge = np.zeros(gram - 1, np.uint64)
        reached = sliding(np.concatenate([edge, least, edge]), gram, np.maximum)
        return np.flatnonzero((reached == ranked) & free)

    def scan_scale(self, scale: int, hashes: np.ndarray, gram: int, limit: int) -> None:
        """Runs with a period in (scale, 2 * scale] among the first ``limit`` words."""
        places = self.minimizers(hashes, gram, limit)
        order = np.argsort(hashes[places], kind="stable")
        places = places[order]
        value = hashes[places]
        seeds, far = [], 1
        while far < len(places):
            lag = places[far:] - places[:-far]
            near = (value[far:] == value[:-far]) & (lag <= 2 * scale)
            if not near.any():
                break
            use = near & (lag > scale)
            at, lag = places[:-far][use], lag[use]
            # a run goes on for a gram at least to one of the sides
            on, back = np.minimum(at + gram, len(hashes) - 1 - lag), np.maximum(at - gram, 0)
            grows = (hashes[on] == hashes[on + lag]) | (hashes[back] == hashes[back + lag])
            seeds.append(np.stack([lag[grows], at[grows]]))
            far += 1
        if not seeds:
            return
        lags, at = np.concatenate(seeds, axis=1)
        before = seen = None
        for lag, place in sorted(zip(lags.tolist(), at.tolist())):
            if lag == before and place < seen:
                continue  # in the stretch just extended
            start, end = self._extent(place, lag)
            before, seen = lag, end
            if end - start >= (MIN_PERIODS - 1) * lag:
                self._keep(start, end + lag, lag)

    def run(self, lengths: np.ndarray) -> list[tuple[int, int, int]]:
        """All runs of at least ``least`` words; ``lengths`` are the texts' words, longest first."""
        ends = np.cumsum(lengths + 1)
        longest = int(lengths[0]) if len(lengths) else 0
        gram = SHORT // 2
        for lag in range(1, min(SHORT, longest // MIN_PERIODS) + 1):
            self.scan_lag(lag, gram)
        scale, width, hashes = SHORT, 1, mixed(self.words.astype(np.uint64))
        while MIN_PERIODS * (scale + 1) <= longest:
            limit = int(ends[np.searchsorted(-lengths, -MIN_PERIODS * (scale + 1), "right") - 1])
            hashes = hashes[:limit - width + 1]
            while width < gram:
                hashes = mixed(hashes[:-width] * np.uint64(0x9E3779B97F4A7C15) + hashes[width:])
                width *= 2
            self.scan_scale(scale, hashes, gram, limit)
            scale, gram = 2 * scale, 2 * gram
        return sorted(run for run in self.found if run[1] - run[0] >= self.least)


def find_runs(words: pa.Array, counts: np.ndarray, least: int = MIN_WORDS) -> dict[int, list[tuple[int, int, int]]]:
    """``(start, length, period)`` of the runs of each text that has any, by the text's number."""
    order = np.argsort(-counts, kind="stable")
    lengths = counts[order]
    lengths = lengths[:np.searchsorted(-lengths, -least, "right")]  # the others are too short for a run
    if not len(lengths):
        return {}
    order = order[:len(lengths)]
    first = (np.cumsum(counts) - counts)[order]
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    source = np.arange(int(begin[-1] + lengths[-1] + 1)) - np.repeat(begin - first, lengths + 1)
    closing = begin + lengths
    source[closing] = 0
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy()[source].astype(np.int64)
    ids[closing] = len(coded.dictionary) + np.arange(len(lengths))
    out: dict[int, list[tuple[int, int, int]]] = {}
    for start, end, period in RunFinder(ids, least).run(lengths):
        text = int(np.searchsorted(begin, start, "right")) - 1
        out.setdefault(int(order[text]), []).append((start - int(begin[text]), end - start, period))
    return out


def collapsed(words: pa.Array, counts: np.ndarray, runs: dict[int, list[tuple[int, int, int]]]) -> pa.Array:
    """The texts' words joined by a blank, without those that a run holds after its first period."""
    first = np.cumsum(counts) - counts
    covered = np.zeros(len(words) + 1, np.int64)
    for text, found in runs.items():
        for start, length, period in found:
            covered[first[text] + start + period] += 1
            covered[first[text] + start + length] -= 1
    kept = np.cumsum(covered[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(kept)])[np.append(first, len(words))]
    lists = pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), words.filter(pa.array(kept)))
    return pc.binary_join(lists, " ")


def periodic_runs(docs: DataFrame, least: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``, one row per input row: the runs by start, then period, and the text's
    words without the repeats, joined by a blank."""
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words, counts = split_words(*text_arrays(piece.column("text")))
                runs = find_runs(words, counts, least)
                listed = [[dict(zip(("start", "length", "period"), r)) for r in runs.get(k, ())]
                          for k in range(piece.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(counts.astype(np.int64)), pa.array(listed, pa.list_(run)),
                     collapsed(words, counts, runs)], names=["doc_id", "n_words", "runs", "collapsed"])

    return documents(docs, id_col, text_col).mapInArrow(
        find, f"doc_id long, n_words long, runs {RUN_TYPE}, collapsed string")


def planted(docs: DataFrame, one_in: int = PLANT_ONE_IN) -> DataFrame:
    """``(doc_id, text)`` with a periodic tail in the documents that the checksum of their id selects: from word a on,
    the p words there are repeated to the text's end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / one_in).cast("long")

    def tail(words: Column) -> Column:
        n = F.size(words).cast("long")
        return let(F.struct((g % n).alias("a"), n.alias("n")), lambda at: let(F.struct(
            at["a"].alias("a"), at["n"].alias("n"),
            (F.floor((at["n"] - at["a"]) / (g % 8 + 3)) + 1).cast("long").alias("p")), lambda s: F.array_join(
                F.transform(F.sequence(F.lit(0).cast("long"), s["n"] - 1), lambda i: F.get(
                    words, F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]).cast("int"))), " ")))

    rows = documents(docs)
    repeated = let(words_of(F.col("text")), lambda words: F.when(F.size(words) > 0, tail(words)).otherwise(F.lit("")))
    return rows.select("doc_id", F.when(h % one_in == 0, repeated).otherwise(F.col("text")).alias("text"))


def q_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(table(spark, sf_dir, "documents")))
    runs = F.col("runs")
    best = F.aggregate(runs, F.get(runs, 0), lambda a, r: F.when(
        r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    listed = F.array_join(F.transform(runs, lambda r: F.concat_ws(
        ",", *[r[c].cast("string") for c in ("start", "length", "period")])), "\n")
    lines = F.when(F.size(runs) > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    exponent = F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long")
    return found.withColumn("best", best).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"), exponent.alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
