"""Quality classifier from weak labels: labelling heuristics, their accuracies by EM, and a hashed linear scorer.

1. Heuristic labellers look at a document and vote good (+1), bad (-1) or abstain (0). Each is weak, and they overlap.
2. Expectation-maximisation on the vote patterns estimates, without any given label, the share of good documents and
   every labeller's votes on good and on bad documents. Patterns are counted over all documents; there are at most
   3 ** labellers of them, so the counts are small whatever the corpus.
3. A pattern's posterior is a document's soft label. A logistic scorer on hashed features (words and their shapes) is
   fitted to soft labels on a bounded sample (``SAMPLE`` documents, those with the least hash of their id and text) and
   scores every document from its whole text.

Nulls and odd rows: a null text is an empty one; it gets votes and a score like any short text. Each input row gives a
row, also with a null or repeated doc_id. With no documents there is no row.
"""

from __future__ import annotations

import functools
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import Recent, documents, stage, table

BUCKETS = 1 << 12
SAMPLE = 4000
THRESHOLD = 0.5
EM_ROUNDS = 200
EPOCHS = 300
L2 = 1e-3
RATE = 2.0

# Common words of the languages the labellers know, and the symbols that prose has few of.
COMMON = frozenset("""
    the of and to a in is that it for was on with as be by are this at from
    de la que el en y los las se del un por con no una su para es al lo
    le et les des du une est pour par dans avec qui pas sur au
    der die und den von zu das mit sich auf für ist im nicht dem ein eine als
""".split())
LABELLERS = 8
SYMBOLS = frozenset("#*$%&|<>!{}[]=_~^\\")


def _vote(value: float, bad_below: float | None = None, good_from: float | None = None,
          bad_above: float | None = None, good_to: float | None = None) -> int:
    """A labeller's vote on a value: bad outside the outer bounds, good within the inner ones, else abstain."""
    if (bad_below is not None and value < bad_below) or (bad_above is not None and value > bad_above):
        return -1
    if (good_from is None or value >= good_from) and (good_to is None or value <= good_to):
        return 1
    return 0


@dataclass
class Look:
    """What the labellers see of a document: its length, and sums over its tokens."""

    chars: int
    tokens: int
    distinct: int
    twins: int  # tokens equal to the one before
    letters: int
    capitals: int
    marked: int
    common: int
    ended: int
    repeated_lines: float


def votes(look: Look) -> list[int]:
    """The labellers' votes on a document."""
    n = look.tokens
    if not n:
        return [-1] + [0] * (LABELLERS - 1)
    return [
        _vote(n, bad_below=10, good_from=40),
        _vote(look.marked / n, bad_above=0.30, good_to=0.05),
        _vote(look.capitals / n, bad_above=0.40, good_to=0.10),
        _vote(look.twins / n, bad_above=0.15, good_to=0.02) if n >= 10 else 0,
        _vote(look.distinct / min(n, 200 + n / 10), bad_below=0.20, good_from=0.50) if n >= 30 else 0,
        _vote(look.common / n, bad_below=0.05, good_from=0.15) if n >= 20 else 0,
        _vote(look.ended / n, bad_below=0.01, good_from=0.04, bad_above=0.60, good_to=0.40) if n >= 20 else 0,
        _vote(look.letters / max(1, look.chars), bad_below=0.60, good_from=0.75) if look.repeated_lines < 0.5 else -1,
    ]


def shape(token: str) -> str:
    """A token's shape: runs of capitals, small letters and digits as one character each, other characters as they are."""
    out = []
    for c in token:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out[:8])


class Reader:
    """Reads documents by their distinct tokens: for the labellers, and as hashed features for the scorer.

    Features are tokens, shapes, and shapes of repeated tokens. What a token contributes is kept in a bounded cache.
    """

    def __init__(self, buckets: int = BUCKETS, entries: int = 300_000):
        self.buckets, self.known = buckets, Recent(entries)

    def _hash(self, space: str, value: str) -> int:
        return zlib.crc32(f"{space}\x1f{value}".encode("utf-8", "replace")) % self.buckets

    def _of(self, token: str) -> tuple[int, ...]:
        """Buckets of a token (word, shape, repeated shape) and what the labellers count."""
        out = self.known.recall(token)
        if out is None:
            form = shape(token)
            out = self.known[token] = (
                self._hash("word", token.lower()), self._hash("shape", form), self._hash("again", form),
                sum(map(str.isalpha, token)), token.isupper() and len(token) > 1, not SYMBOLS.isdisjoint(token),
                token.strip(".,;:!?\"'()").lower() in COMMON, token[-1] in ".,;:?")
        return out

    def read(self, text: str, features: bool = True) -> tuple[int, np.ndarray, np.ndarray]:
        """``(vote pattern, buckets, weights)``; weights are damped counts of unit length."""
        tokens = text.split()
        found: dict[int, int] = {}
        letters = capitals = marked = common = ended = 0
        get, distinct = self.known.get, Counter(tokens)
        for token, times in distinct.items():
            word, form, _, a, b, c, d, e = get(token) or self._of(token)
            letters, capitals, marked = letters + a * times, capitals + b * times, marked + c * times
            common, ended = common + d * times, ended + e * times
            if features:
                found[word] = found.get(word, 0) + times
                found[form] = found.get(form, 0) + times
        twins = [t for t, before in zip(tokens[1:], tokens) if t == before]
        for token in twins if features else ():
            again = (get(token) or self._of(token))[2]
            found[again] = found.get(again, 0) + 1
        self.known.age()
        lines = text.split("\n")
        repeated = 1 - len(set(lines)) / len(lines) if len(lines) > 3 else 0.0
        pattern = pattern_of(votes(Look(len(text), len(tokens), len(distinct), len(twins), letters, capitals, marked,
                                        common, ended, repeated)))
        at = np.fromiter(found.keys(), dtype=np.int32, count=len(found))
        weights = np.log1p(np.fromiter(found.values(), dtype=np.float64, count=len(found)))
        return pattern, at, weights / max(1e-9, float(np.sqrt(weights @ weights)))


@functools.lru_cache(maxsize=2)
def _reader(buckets: int) -> Reader:
    """The reader of a Python worker: its cache serves all the worker's tasks."""
    return Reader(buckets)


def pattern_of(cast: list[int]) -> int:
    """Votes as one number, base three."""
    out = 0
    for v in cast:
        out = 3 * out + v + 1
    return out


def votes_of(pattern: int) -> list[int]:
    out = []
    for _ in range(LABELLERS):
        pattern, v = divmod(pattern, 3)
        out.append(v - 1)
    return out[::-1]


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, dict]:
    """EM on vote patterns: every pattern's posterior of good, and the model (prior, vote probabilities).

    Labellers are independent given the class; ``p[class, labeller, vote]`` are its vote probabilities, smoothed by one
    document each. The start is the share of good votes among the votes cast, which also fixes which class is good.
    """
    cast = np.array([votes_of(int(p)) for p in patterns], dtype=np.int64).reshape(-1, LABELLERS)
    weights = counts.astype(np.float64)
    good = 0.5 + 0.45 * cast.sum(axis=1) / np.maximum(1, np.abs(cast).sum(axis=1))
    onehot = np.stack([cast == v for v in (-1, 0, 1)], axis=2).astype(np.float64)
    prior, p = 0.5, np.full((2, LABELLERS, 3), 1 / 3)
    for _ in range(rounds):
        both = np.stack([weights * (1 - good), weights * good])
        prior = float((both[1].sum() + 1) / (both.sum() + 2))
        p = np.einsum("cn,nlv->clv", both, onehot) + 1.0
        p /= p.sum(axis=2, keepdims=True)
        odds = np.log(prior) - np.log(1 - prior) + np.einsum("nlv,lv->n", onehot, np.log(p[1]) - np.log(p[0]))
        new = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        if np.abs(new - good).max(initial=0) < 1e-9:
            break
        good = new
    return good, {"prior": prior, "votes": p}


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, buckets: int = BUCKETS,
          epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Logistic weights and bias by gradient descent on soft labels; the classes weigh the same."""
    x = np.zeros((len(rows), buckets), dtype=np.float32)
    for k, (at, weights) in enumerate(rows):
        x[k, at] = weights
    share = np.clip(labels.mean() if len(labels) else 0.5, 0.02, 0.98)
    weight = np.where(labels >= 0.5, 0.5 / share, 0.5 / (1 - share))
    w, b, n = np.zeros(buckets, dtype=np.float32), 0.0, np.float32(max(1, len(rows)))
    for _ in range(epochs):
        score = 1 / (1 + np.exp(-np.clip(x @ w + np.float32(b), -40, 40)))
        error = (weight * (score - labels)).astype(np.float32)
        w -= np.float32(RATE) * (error @ x / n + np.float32(L2) * w)
        b -= RATE * float(error.sum() / n)
    return w, b


def quality_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
                   buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, posterior, score, kept)``: the weak label, the scorer's probability of good, and its verdict."""
    texts = documents(docs, id_col, text_col)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(buckets)
        for batch in batches:
            found = [reader.read(t, features=False)[0] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rank"), pa.array(found, pa.int32())],
                names=["doc_id", "rank", "pattern"])

    ranked = texts.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("rank"))
    cast = stage(ranked.mapInArrow(vote, "doc_id long, rank long, pattern int"), "weak-votes")
    seen = sorted((r["pattern"], r["n"]) for r in cast.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect())
    patterns, counts = np.array([p for p, _ in seen], dtype=np.int64), np.array([n for _, n in seen], dtype=np.int64)
    posterior, _ = estimate(patterns, counts)
    label = dict(zip(patterns.tolist(), posterior.tolist()))

    chosen = cast.orderBy("rank", "doc_id").limit(sample).select("rank").distinct()
    learning = ranked.join(F.broadcast(chosen), "rank", "left_semi")  # at most ``sample`` longs

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(buckets)
        for batch in batches:
            rows = [reader.read(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rank"), pa.array([label[p] for p, _, _ in rows], pa.float64()),
                 pa.array([at.tobytes() for _, at, _ in rows], pa.binary()),
                 pa.array([w.astype(np.float32).tobytes() for _, _, w in rows], pa.binary())],
                names=["rank", "label", "buckets", "weights"])

    # the sample's rows are bounded: at most ``sample`` of at most ``buckets`` numbers (repeated rows count once)
    rows = learning.mapInArrow(featurise, "rank long, label double, buckets binary, weights binary") \
        .dropDuplicates(["rank"]).orderBy("rank").collect()
    w, b = train([(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["weights"], np.float32)) for r in rows],
                 np.array([r["label"] for r in rows]), buckets)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(buckets)
        for batch in batches:
            soft, scores = [], []
            for text in batch.column("text").to_pylist():
                pattern, at, weights = reader.read(text)
                soft.append(label[pattern])
                scores.append(float(1 / (1 + np.exp(-np.clip(w[at] @ weights + b, -40, 40)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(soft, pa.float64()), pa.array(scores, pa.float64()),
                 pa.array([s >= threshold for s in scores], pa.bool_())],
                names=["doc_id", "posterior", "score", "kept"])

    return texts.mapInArrow(score, "doc_id long, posterior double, score double, kept boolean")


def q_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"))
