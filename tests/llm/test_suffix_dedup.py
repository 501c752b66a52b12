import random

import pytest

from airshed.llm import suffix_dedup

from .conftest import rows_of


def plain_repeats(rows, length=50):
    """(doc_id, n_bytes, spans, kept) of (doc_id, text) rows."""
    least = {}
    for doc, text in rows:
        data = (text or "").encode()
        if doc is not None:
            for k in range(len(data) - length + 1):
                piece = data[k:k + length]
                least[piece] = min(least.get(piece, doc), doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        if doc is not None:
            for k in range(len(data) - length + 1):
                if least[data[k:k + length]] < doc:
                    gone[k:k + length] = [True] * length
        spans, at = [], 0
        while at < len(data):
            end = at
            while end < len(data) and gone[end]:
                end += 1
            if end > at:
                spans.append((at, end))
            at = max(end, at + 1)
        out.append((doc, len(data), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=str)


def compare(df, rows, length=50):
    got = sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=str)
    assert got == plain_repeats([(r[0], r[1]) for r in rows], length)


@pytest.mark.parametrize("block_bytes", [200, 5000, 4 << 20])
def test_matches_brute_force(make, corpus, block_bytes):
    rows = rows_of(corpus)
    compare(suffix_dedup.remove_repeats(make(rows, clashing=True), block_bytes=block_bytes), rows)


@pytest.mark.parametrize("length", [32, 33, 50, 64])
def test_lengths(make, corpus, length):
    rows = rows_of(corpus[38:58])
    compare(suffix_dedup.remove_repeats(make(rows), length=length, block_bytes=1000), rows, length)


def test_chunks_do_not_show(make, corpus, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 37)
    block = {"block": 0, "doc_ids": [3, None, 1], "lengths": [200, 60, 180],
             "data": (corpus[40] * 3)[:200].encode()[:200] + b"y" * 60 + (corpus[40] * 3).encode()[:180]}
    small = suffix_dedup.Block(block, 50)
    keys = small.anchors(5)[0]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1 << 18)
    assert set(keys.tolist()) == set(suffix_dedup.Block(block, 50).anchors(5)[0].tolist())


def test_edges_of_fifty_bytes(make):
    rng = random.Random(2)
    base = "".join(rng.choices("abcdefgh", k=400))
    rows = rows_of([base[:50], base[1:51], base[:49], base[:120], base[60:110] + base[:50], base[300:] + base, base])
    for blocks in (10, 10_000):
        compare(suffix_dedup.remove_repeats(make(rows), block_bytes=blocks), rows)


def test_runs_without_cuts_and_one_repeated_byte(make):
    rows = rows_of(["a" * 700, "a" * 49, "a" * 50, "b" + "a" * 60, "é" * 200, "xé" + "é" * 30])
    compare(suffix_dedup.remove_repeats(make(rows), block_bytes=300), rows)


def test_odd_rows(make, odd_rows):
    long = "a passage that is longer than fifty bytes, so that it counts as one"
    rows = odd_rows + [(9, long, "en", "s", 1), (9, long, "en", "s", 1), (None, long, "en", "s", 1), (10, long, "en", "s", 1)]
    compare(suffix_dedup.remove_repeats(make(rows, clashing=True)), rows)


def test_empty_table(make):
    assert suffix_dedup.remove_repeats(make([])).collect() == []


def test_length_is_checked(make):
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(make([]), length=20)
