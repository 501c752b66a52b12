import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from airshed.llm import wavelet
from airshed.llm.common import staging_path

from .conftest import rows_of

PATH = wavelet.byte_vocabulary()


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 511, 512, 513, 5000])
def test_matrix_against_a_plain_sequence(n):
    rng = np.random.default_rng(n)
    ids = rng.choice(np.array([0, 1, 2, 7, 300, 50256]), size=n).astype(np.uint32)
    built = wavelet.WaveletMatrix.build(ids, 16)
    matrix = wavelet.WaveletMatrix.from_bytes(n, built.zeros, *built.to_bytes())
    assert np.array_equal(matrix.ids(), ids)
    places = rng.integers(0, n, 50) if n else np.zeros(0, dtype=int)
    assert np.array_equal(matrix.access(places), ids[places])
    for token in (0, 1, 2, 7, 300, 50256, 5, 65535, 65536, -1):
        where = np.flatnonzero(ids == token)
        a, b = n // 5, n - n // 7
        assert matrix.count(token) == len(where)
        assert matrix.count(token, a, b) == np.count_nonzero((where >= a) & (where < b))
        assert np.array_equal(matrix.occurrences(token), where)
        assert np.array_equal(matrix.occurrences(token, a, b), where[(where >= a) & (where < b)])
        for k in (0, len(where) // 2, len(where) - 1, len(where)):
            assert matrix.select(token, k) == (int(where[k]) if 0 <= k < len(where) else None)


def written(spark, docs, shard_ids=1 << 20):
    path = staging_path(spark, "test-ids")
    wavelet.write_token_ids(docs, path, PATH, shard_ids=shard_ids)
    return wavelet.read_shards(spark, path)


@pytest.mark.parametrize("shard_ids", [1, 100, 1 << 20])
def test_digests_and_ids(spark, make, corpus, shard_ids):
    texts = corpus + ["<|endoftext|> a <|endoftext|>", "two  spaces ", " \n lead", "tab\t x", "\n", "a\x1cb c"]
    rows = rows_of(texts)
    random.Random(1).shuffle(rows)
    shards = written(spark, make(rows, clashing=True), shard_ids)
    library, expected, at = Tokenizer.from_file(PATH), {}, 0
    ids_of = {}
    for k, text in enumerate(texts):
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        ids_of[k] = ids
        expected[k] = (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in wavelet.token_digests(shards).collect()}
    assert got == expected
    read = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in wavelet.document_ids(shards).collect()}
    assert read == ids_of
    for token in (2, ids_of[0][0], 49999):
        places = sorted((d, i) for d, ids in ids_of.items() for i, x in enumerate(ids) if x == token)
        assert sorted(map(tuple, wavelet.find_token(shards, token).collect())) == places
        assert wavelet.count_token(shards, token).first().n == len(places)


def test_odd_rows(spark, make, odd_rows):
    got = wavelet.token_digests(written(spark, make(odd_rows, clashing=True))).collect()
    assert len(got) == len(odd_rows)
    spans = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    ordered = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ordered == [None, None] + sorted(d for d in ordered if d is not None)
    assert [r.n_tokens for r in got if r.doc_id in (1, 2)] == [1, 1]


def test_empty_table(spark, make):
    shards = written(spark, make([]))
    assert wavelet.token_digests(shards).collect() == [] and wavelet.count_token(shards, 2).first().n == 0


def test_cache_that_forgets_gives_the_same_ids(corpus):
    import pyarrow as pa

    texts = (corpus + [t.upper() for t in corpus] + ["", " lead", "end ", "a b c", "x\ty z\n w", "don't won't. it's!?"]) * 2
    library = Tokenizer.from_file(PATH)
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for entries in (1, 50, 10 ** 6):
        encoder = wavelet._Encoder(PATH, entries=entries)
        got = [ids.tolist() for at in range(0, len(texts), 7) for ids in encoder.encode(pa.array(texts[at:at + 7]))]
        assert got == expected
    assert wavelet._Encoder(PATH).encode(pa.array([], pa.string())) == []
