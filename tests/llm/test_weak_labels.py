import os

import numpy as np
import pytest

from airshed.llm import weak_labels as w

from .conftest import rows_of

DATA = "/root/testdata/sf0.01"


def test_em_finds_accuracies_of_known_labellers():
    rng = np.random.default_rng(1)
    n, accuracy, cover = 20000, np.array([.9, .85, .8, .75, .7, .65, .6, .9]), np.array([1, .9, .8, 1, .7, .6, .9, .5])
    truth = rng.random(n) < 0.7
    right, casts = rng.random((n, 8)) < accuracy, rng.random((n, 8)) < cover
    cast = np.where(casts, np.where(right == truth[:, None], 1, -1), 0)
    numbers = np.array([w.pattern_of(row.tolist()) for row in cast])
    patterns, which, counts = np.unique(numbers, return_inverse=True, return_counts=True)
    good, model = w.estimate(patterns, counts)
    assert abs(model["prior"] - 0.7) < 0.02
    for k in range(8):
        votes = model["votes"][1, k]
        assert abs(votes[2] / (votes[0] + votes[2]) - accuracy[k]) < 0.03
    assert ((good[which] >= 0.5) == truth).mean() > ((cast.sum(axis=1) >= 0) == truth).mean()


def test_patterns_are_numbers_and_back():
    for cast in ([-1] * 8, [0] * 8, [1, 0, -1, 1, 0, -1, 1, 1]):
        assert w.votes_of(w.pattern_of(cast)) == cast


def test_one_pattern_and_none():
    good, _ = w.estimate(np.array([w.pattern_of([1] * 8)]), np.array([5]))
    assert good[0] > 0.5
    assert len(w.estimate(np.array([], dtype=np.int64), np.array([], dtype=np.int64))[0]) == 0


def test_scorer_separates_soft_labels():
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for k in range(200):
        good = k % 4 != 0
        at = rng.choice(50, 10, replace=False) + (0 if good else 50)
        rows.append((at.astype(np.int32), np.full(10, 10 ** -0.5)))
        labels.append(0.9 if good else 0.1)
    weights, bias = w.train(rows, np.array(labels), buckets=128, epochs=200)
    scores = np.array([weights[at] @ v + bias for at, v in rows])
    assert ((scores > 0) == (np.array(labels) > 0.5)).all()


def plain_look(text):
    """What the labellers see, token by token."""
    tokens, lines = text.split(), text.split("\n")
    return w.Look(
        len(text), len(tokens), len(set(tokens)), sum(a == b for a, b in zip(tokens, tokens[1:])),
        sum(c.isalpha() for c in text), sum(t.isupper() and len(t) > 1 for t in tokens),
        sum(any(c in w.SYMBOLS for c in t) for t in tokens),
        sum(t.strip(".,;:!?\"'()").lower() in w.COMMON for t in tokens), sum(t[-1] in ".,;:?" for t in tokens),
        1 - len(set(lines)) / len(lines) if len(lines) > 3 else 0.0)


@pytest.mark.parametrize("entries", [1, 10 ** 6])
def test_reader_sees_what_a_plain_one_does(corpus, entries):
    reader = w.Reader(64, entries=entries)
    for text in [*corpus, "", " \n", "THE the THE THE end. $$$ a#b", "x\nx\nx\nx\ny"] * 2:
        expected = w.pattern_of(w.votes(plain_look(text)))
        assert reader.read(text)[0] == reader.read(text, features=False)[0] == expected


def test_shape_and_features():
    assert w.shape("Abc12$$$") == "Aa0$" and w.shape("THE!!") == "A!"
    reader = w.Reader(64, entries=2)
    _, at, weights = reader.read("a a b a c c c")
    assert len(at) == len(set(at.tolist())) and abs(weights @ weights - 1) < 1e-9
    assert len(reader.read("")[1]) == 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_accuracy_on_labels_never_seen(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    scored = w.quality_scores(docs).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").collect()
    assert len(scored) > 300
    right = sum(r.kept == bool(r.quality) for r in scored) / len(scored)
    good_kept = np.mean([r.kept for r in scored if r.quality == 1])
    bad_caught = np.mean([not r.kept for r in scored if r.quality == 0])
    assert right > 0.95 and good_kept > 0.97 and bad_caught > 0.8, (right, good_kept, bad_caught)


def test_sample_is_bounded_and_results_are_whole(make, corpus, odd_rows):
    rows = rows_of(corpus, start=50) + odd_rows
    docs = make(rows, clashing=True)
    first = sorted(map(str, w.quality_scores(docs, sample=10).collect()))
    assert len(first) == len(rows)
    assert first == sorted(map(str, w.quality_scores(docs, sample=10).collect()))


def test_empty_table(make):
    assert w.quality_scores(make([])).collect() == []
