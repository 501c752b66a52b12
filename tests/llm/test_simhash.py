import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from airshed.llm import simhash
from airshed.llm.components import connected_components

from .conftest import rows_of


def plain_fingerprint(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=3):
    """Least id reachable, for {id: fingerprint}."""
    parent = {d: d for d in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {d: find(d) for d in ids}


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_fingerprint_is_that_of_the_rules(corpus):
    for text in [*corpus, "", " ", "one two", "ÀB c"]:
        assert int.from_bytes(simhash.fingerprint(text), "big") == plain_fingerprint(text)


def test_long_text_in_blocks_has_the_same_fingerprint(corpus, monkeypatch):
    whole = simhash.fingerprint(corpus[-1])
    monkeypatch.setattr(simhash, "_BLOCK", 7)
    assert simhash.fingerprint(corpus[-1]) == whole


def test_spark_hash_agrees(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a bc d"))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"a bc d", 42)


def test_components_match_brute_force(make, corpus):
    got = {r.doc_id: r for r in simhash.simhash_components(make(rows_of(corpus), clashing=True)).collect()}
    prints = {k: plain_fingerprint(t) for k, t in enumerate(corpus)}
    expected = plain_components(prints)
    assert {d: r.component_id for d, r in got.items()} == expected
    assert {d: r.fingerprint for d, r in got.items()} == {d: f"{p:016x}" for d, p in prints.items()}


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4])
@pytest.mark.parametrize("limit", [1, 64])
def test_links_connect_what_brute_force_connects(spark, distance, limit):
    rng = random.Random(distance)
    prints = set()
    for _ in range(6):  # clouds around centres, so that buckets are crowded and chains leave them
        centre = rng.getrandbits(64)
        for _ in range(12):
            value = centre
            for _ in range(rng.randint(0, 5)):
                value ^= 1 << rng.randrange(64)
            prints.add(value)
    table = {k: v for k, v in enumerate(sorted(prints))}
    df = spark.createDataFrame([(signed(v),) for v in table.values()], "fp long")
    edges = simhash.links(df, distance, bucket_limit=limit)
    pairs = [(r.u % (1 << 64), r.v % (1 << 64)) for r in edges.collect()]
    assert all((a ^ b).bit_count() <= distance for a, b in pairs)
    number = {v: k for k, v in table.items()}
    expected = plain_components(table, distance)
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in connected_components(edges).collect()}
    groups = {}
    for k, v in table.items():
        groups.setdefault(roots.get(v, v), set()).add(k)
    wanted = {}
    for k, root in expected.items():
        wanted.setdefault(root, set()).add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))
    assert number


def test_odd_rows(make, odd_rows):
    got = simhash.simhash_components(make(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    component = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert component[1] == component[2] == component[3] == 1  # no words: fingerprint zero, linked
    assert component[6] == component[5] == 5
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert [r.fingerprint for r in got if r.doc_id == 1] == ["0" * 16]


def test_empty_table(make):
    assert simhash.simhash_components(make([])).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 130)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 130)}
