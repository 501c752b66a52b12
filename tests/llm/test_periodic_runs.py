import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from airshed.llm import periodic_runs as runs
from airshed.llm.batches import slices, text_arrays

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=24):
    """Every lag over the whole text; a run counts when no smaller lag holds all over it."""
    found, n = [], len(words)
    for lag in range(1, n // 3 + 1):
        at = 0
        while at + lag < n:
            end = at
            while end + lag < n and words[end] == words[end + lag]:
                end += 1
            length = end - at + lag
            if length >= max(least, 3 * lag):
                piece = words[at:at + length]
                if not any(piece[k:] == piece[:-k] for k in range(1, lag)):
                    found.append((at, length, lag))
            at = max(end, at + 1)
    return sorted(found)


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        a, g = (h // 10) % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (
        "".join(f"{s},{length},{q}\n" for s, length, q in found), " ".join(w for k, w in enumerate(words) if k not in gone))]
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, *digest)


def repetitive(rng):
    words = []
    while len(words) < rng.choice([0, 30, 200, 500]):
        kinds = rng.choice([1, 2, 3, 20, 200])
        unit = [str(rng.randrange(kinds)) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 15, 16, 17, 31, 33, 40, 65, 90]))]
        if rng.random() < 0.4:
            unit = unit * rng.randint(1, 4) + [str(rng.randrange(50))] * rng.randint(0, 2)
        words += (unit * rng.choice([1, 1, 2, 3, 4, 5, 9]))[:-rng.randint(0, 3) or None]
    return words[:900]


def found_in(texts):
    words, counts = runs.split_words(*text_arrays(texts if isinstance(texts, pa.Array) else pa.array(texts)))
    return words, counts, runs.find_runs(words, counts)


def test_runs_equal_those_of_every_lag():
    rng, total = random.Random(11), 0
    for _ in range(60):
        docs = [repetitive(rng) for _ in range(rng.randint(1, 8))]
        words, counts, found = found_in([rng.choice(["", "\n"]) + " \t".join(d) + rng.choice(["", " "]) for d in docs])
        assert words.to_pylist() == [w for d in docs for w in d] and counts.tolist() == [len(d) for d in docs]
        assert [found.get(k, []) for k in range(len(docs))] == [plain_runs(d) for d in docs]
        total += sum(map(len, found.values()))
    assert total > 300


@pytest.mark.parametrize("period", [1, 8, 16, 17, 32, 33, 64, 65, 127, 128, 129, 256, 300, 1025])
def test_a_run_of_exactly_three_periods(period):
    rng = random.Random(period)
    unit = [str(rng.random()) for _ in range(period)]
    for shift in (0, 1, 7):
        around = [str(rng.random()) for _ in range(shift)]
        least = max(24, 3 * period)
        body = (unit * 25)[:least]
        for words, expected in ((around + body + around, [(shift, least, period)]), (around + body[:-1] + around, [])):
            assert found_in([" ".join(words)])[2].get(0, []) == expected


def test_a_fibonacci_text_and_one_word_many_times():
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    for words in (list(b), ["x"] * 700, ["x"] * 300 + ["y"] + ["x"] * 300):
        assert found_in([" ".join(words)])[2].get(0, []) == plain_runs(words)


def test_equal_hashes_decide_nothing(monkeypatch):
    """With a hash of three values almost every gram is a seed; the runs stay the same."""
    monkeypatch.setattr(runs, "mixed", lambda values: values % np.uint64(3))
    rng = random.Random(2)
    for _ in range(10):
        words = repetitive(rng)
        assert found_in([" ".join(words)])[2].get(0, []) == plain_runs(words)


def test_slices_do_not_matter(corpus):
    texts = corpus + ["a b c " * 50 + t for t in corpus[:20]]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    pieces = [found_in(piece.column("text"))[2] | {None: piece.num_rows} for piece in slices(batch, "text", 3000)]
    joined, first = {}, 0
    for found in pieces:
        n = found.pop(None)
        joined |= {first + k: r for k, r in found.items()}
        first += n
    assert len(pieces) > 10 and first == len(texts) and joined == found_in(texts)[2] != {}


def test_query_equals_the_plain_version(spark, make, corpus, odd_rows, tmp_dir):
    rng = random.Random(4)
    texts = [t for t in corpus if len(t) < 6000] + [" ".join(repetitive(rng)) for _ in range(60)]
    rows = [(k + 10, t, "en", "s", 0) for k, t in enumerate(texts)] + odd_rows
    make(rows, clashing=True).write.parquet(f"{tmp_dir}/t/documents.parquet")
    got = runs.q_periodic_runs(spark, f"{tmp_dir}/t")
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    assert sorted(map(tuple, got.collect()), key=str) == sorted((plain_row(r[0], r[1]) for r in rows), key=str)


def test_a_very_long_text(make):
    rng = random.Random(8)
    lead = [str(rng.randrange(10**6)) for _ in range(300_000)]
    words = lead + lead[:90_000] * 4 + ["z"] * 50_000
    row = runs.periodic_runs(make([(1, " ".join(words), "en", "s", 0), (2, "a", "en", "s", 0)])).where("doc_id = 1").first()
    assert [tuple(r) for r in row.runs] == [(300_000, 360_000, 90_000), (660_000, 50_000, 1)]
    assert row.collapsed.split(" ") == lead + lead[:90_000] + ["z"]


def test_empty_table(make):
    assert runs.periodic_runs(make([])).collect() == []
