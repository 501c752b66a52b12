import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from airshed.llm import bpe_stream, wavelet

from .conftest import rows_of

WORDS, BYTES = bpe_stream.word_vocabulary(), wavelet.byte_vocabulary()


@pytest.fixture(scope="module", params=[WORDS, BYTES])
def both(request):
    return Tokenizer.from_file(request.param), bpe_stream.load(request.param)


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), dtype="<u4").tolist()


def check(both, text, block=bpe_stream.BLOCK):
    library, vocabulary = both
    expected = library.encode(text, add_special_tokens=False).ids
    got = ids_of(bpe_stream.Encoder(vocabulary, block=block), text)
    assert got == expected
    decoder = bpe_stream.Decoder(vocabulary)
    parts = [decoder.feed(got[k:k + 3]) for k in range(0, len(got), 3)]
    assert "".join(parts) + decoder.finish() == library.decode(expected, skip_special_tokens=False)


def test_corpus(both, corpus):
    for text in corpus:
        check(both, text)


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text(both, text):
    check(both, text)


ODD = ["", " ", "  a  b ", "It's WE'LL Σίσυφος ΟΔΟΣ", "<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|>",
       "a\x1cb\x85c d e", "é ﬁ İ ſ K", "12345 ¼ ²", "日本語テキスト", "👩‍👩‍👧 🇫🇷", "\n\n\n x\n y", "%%%!!!***"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(both, text):
    check(both, text)


def test_long_words_stream_with_small_blocks(both):
    rng = random.Random(5)
    library, vocabulary = both
    for alphabet in ("ab", "aeiounst", "ing", "!?*", "é日"):
        word = "".join(rng.choices(alphabet, k=6000))
        check(both, word, block=16)


def test_transducer_memory_is_bounded_and_tokens_are_stable():
    vocabulary, library = bpe_stream.load(WORDS), Tokenizer.from_file(WORDS)
    rng = random.Random(9)
    word = "".join(rng.choices("thearingosn", k=60000))
    transducer, got = bpe_stream.Transducer(vocabulary, block=64), []
    for at in range(0, len(word), 100):
        got += transducer.feed(word[at:at + 100].encode())
    assert got  # something came out before the end
    got += transducer.finish()
    assert got == library.encode(word, add_special_tokens=False).ids
    assert transducer.peak <= vocabulary.lookahead + 64 + 64 + 64


def test_lookahead_of_small_merge_lists():
    # ab then bc: whether bc forms depends on what is left of it, ab on nothing to its right
    lengths = {0: 1, 1: 1, 2: 1, 3: 2, 4: 2, 5: 3}
    assert bpe_stream.sufficient_lookahead([(0, 1, 3)], lengths) == 1
    # bc first: ab needs to see that no c follows
    assert bpe_stream.sufficient_lookahead([(1, 2, 4), (0, 1, 3)], lengths) == 2


def test_restored_text_round_trip(make, corpus):
    vocabulary = bpe_stream.load(WORDS)
    text = "the quick brown fox 42"
    ids = ids_of(bpe_stream.Encoder(vocabulary), text)
    decoder = bpe_stream.Decoder(vocabulary, words=True)
    assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == "the quick brown fox 4 2 "
    docs = make(rows_of(corpus))
    back = bpe_stream.decode_documents(bpe_stream.encode_documents(docs, BYTES), BYTES)
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(corpus))


def test_query_rows(make, odd_rows):
    library = Tokenizer.from_file(WORDS)
    got = bpe_stream.token_digests(make(odd_rows, clashing=True), WORDS).collect()
    assert len(got) == len(odd_rows)
    texts = {r[0]: r[1] for r in odd_rows if r[0] is not None}
    for row in got:
        if row.doc_id is None:
            continue
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty_table(make):
    assert bpe_stream.token_digests(make([]), WORDS).collect() == []
