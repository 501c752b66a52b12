"""Byte-pair encoding as a streaming transducer with bounded lookahead, and an incremental decoder.

Lookahead. Whether a merge rule forms its token at a place depends on what stands to the right of it only through rules
of lower rank that overlap it: a rule that takes the token's right end away, or one that takes its left part and in turn
depends on its own right. Following these dependencies in rank order gives every rule a reach, the number of symbols to
the right of its token that can matter, and the merge list a sufficient lookahead: no token that ends more than that
many symbols before the end of what was read can change any more. The transducer encodes a buffer, emits the tokens
that are that far from its end and starts anew behind them (a boundary is never crossed later, so what follows it is
encoded as if it began there). Memory is bounded by the lookahead and the block, whatever the length of a word.

Short words are encoded whole and kept in a bounded cache.

Normalisation and splitting follow the tokenizer file (NFC, white space, lower case; a split pattern or the byte-level
one); a file with other parts is refused. Engines know different versions of Unicode, so a text with a code point that
is unassigned here is normalised and split by the tokenizers library; its words are encoded like all others.

A null text is an empty one and has no tokens.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from pathlib import Path
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from airshed.llm.common import Recent, documents, holes, table

BLOCK = 256
CACHE_ENTRIES = 400_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or one from U+0100 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


_ASSIGNED: set[str] = set()  # code points seen and found to have a meaning; at most as many as there are


def has_unassigned(text: str) -> bool:
    """Whether a text has a code point without a meaning in this Unicode version."""
    if text.isascii():
        return False
    new = set(text) - _ASSIGNED
    if any(unicodedata.category(c) == "Cn" for c in new):
        return True
    _ASSIGNED.update(new)
    return False


def sufficient_lookahead(rules: list[tuple[int, int, int]], lengths: dict[int, int]) -> int:
    """Symbols behind a token that decide it, over all rules ``(left, right, merged)`` in rank order."""
    reach: dict[int, int] = {}  # of a token: over the rules that form it
    taken_left: dict[int, int] = {}  # over the rules so far that have the token as their left part
    taken_right: dict[int, int] = {}  # ... as their right part
    most = 0
    for left, right, merged in rules:
        n = lengths[right]
        here = max(0, reach.get(right, 0), taken_left.get(right, 0), reach.get(left, 0) - n,
                   taken_right.get(left, 0) - n)
        reach[merged] = max(reach.get(merged, 0), here)
        taken_left[left] = max(taken_left.get(left, 0), n + here)
        taken_right[right] = max(taken_right.get(right, 0), here)
        most = max(most, lengths[merged] - 1 + here)
    return most


class Vocabulary:
    """A BPE tokenizer file: merge rules on token ids, the text's preparation, added tokens and the decoder's kind."""

    def __init__(self, path: str):
        import regex

        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("only byte-level BPE files are supported")
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        rules = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, merged = self.ids[a], self.ids[b], self.ids[a + b]
            self.merges[left, right] = (rank, merged)
            rules.append((left, right, merged))
        self.tokens: dict[int, str] = {i: t for t, i in self.ids.items()}
        lengths = {i: len(t.removesuffix(self.suffix) if self.suffix else t) for i, t in self.tokens.items()}
        self.lookahead = sufficient_lookahead(rules, lengths)
        self.alphabet = byte_alphabet()
        self.byte_of = {c: b for b, c in enumerate(self.alphabet)}
        self.inner = [self.ids.get(c) for c in self.alphabet]
        self.last = [self.ids.get(c + self.suffix) for c in self.alphabet]

        added = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens must be matched as they stand")
        self.added = {t["content"]: t["id"] for t in added}
        self.tokens |= {i: t for t, i in self.added.items()}
        by_length = sorted(self.added, key=len, reverse=True)
        self.added_pattern = regex.compile("|".join(map(regex.escape, by_length))) if by_length else None

        normalizer = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
        steps = normalizer["normalizers"] if normalizer["type"] == "Sequence" else [normalizer]
        kinds = [s["type"] for s in steps]
        if any(k not in ("NFC", "Replace", "Lowercase") for k in kinds) or any(
                s["type"] == "Replace" and (s["pattern"].get("Regex"), s["content"]) != (r"\s+", " ") for s in steps):
            raise ValueError(f"unsupported normalizer: {kinds}")
        self.nfc, self.lower = "NFC" in kinds, "Lowercase" in kinds

        splitter = spec["pre_tokenizer"]
        parts = splitter["pretokenizers"] if splitter["type"] == "Sequence" else [splitter]
        split = [p for p in parts if p["type"] == "Split"]
        if [p["type"] for p in parts] not in (["Split", "ByteLevel"], ["ByteLevel"]) or any(
                p.get("add_prefix_space") for p in parts):
            raise ValueError("unsupported pre-tokenizer")
        if split and not (split[0]["behavior"] == "Removed" and split[0]["invert"]):
            raise ValueError("unsupported split")
        # Fixed value: the pattern of byte-level pre-tokenizers.
        gpt = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.pattern = regex.compile(split[0]["pattern"]["Regex"] if split else gpt)
        self.spaces_vanish = bool(split)
        self.space = regex.compile(r"\s+")
        self.path = path
        self.byte_decoder = (spec.get("decoder") or {}).get("type") == "ByteLevel"

    def prepare(self, text: str) -> str:
        if self.nfc:
            text = unicodedata.normalize("NFC", text)
        if self.lower:  # character by character: no final sigma
            text = text.replace("Σ", "σ").lower()
        return text

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def split_by_library(self, text: str) -> Iterator[bytes]:
        """The words of a text as bytes."""
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        for word, _ in self.library.pre_tokenizer.pre_tokenize_str(text):
            yield bytes([self.byte_of[c] for c in word])


@functools.lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_all(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply the merge rules in rank order, leftmost first, to a list of token ids."""
    n = len(symbols)
    if n < 2:
        return symbols
    if n <= 24:
        out = list(symbols)
        while True:
            best, at = None, -1
            for k in range(len(out) - 1):
                rule = merges.get((out[k], out[k + 1]))
                if rule is not None and (best is None or rule < best):
                    best, at = rule, k
            if best is None:
                return out
            out[at:at + 2] = [best[1]]
    out, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rule[0], k, rule[1]) for k in range(n - 1) if (rule := merges.get((out[k], out[k + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        rank, k, merged = heapq.heappop(heap)
        right = after[k]
        if out[k] < 0 or right >= n or merges.get((out[k], out[right])) != (rank, merged):
            continue  # one of the two has been merged meanwhile
        out[k], out[right], after[k] = merged, -1, after[right]
        if after[k] < n:
            before[after[k]] = k
            if (rule := merges.get((merged, out[after[k]]))) is not None:
                heapq.heappush(heap, (rule[0], k, rule[1]))
        if before[k] >= 0 and (rule := merges.get((out[before[k]], merged))) is not None:
            heapq.heappush(heap, (rule[0], before[k], rule[1]))
    return [t for t in out if t >= 0]


class Transducer:
    """Encodes one word given in pieces of bytes: tokens come out as soon as no continuation can change them."""

    def __init__(self, vocabulary: Vocabulary, block: int = BLOCK):
        self.v, self.block = vocabulary, block
        self.buffer = bytearray()
        self.peak = 0

    def feed(self, piece: bytes) -> Iterator[int]:
        for at in range(0, len(piece), self.block):
            self.buffer += piece[at:at + self.block]
            self.peak = max(self.peak, len(self.buffer))
            stable = len(self.buffer) - self.v.lookahead
            if stable <= 0 or len(self.buffer) < self.v.lookahead + self.block:
                continue
            done = 0
            for token in merge_all([self.v.inner[b] for b in self.buffer], self.v.merges):
                n = len(self.v.tokens[token])
                if done + n > stable:
                    break
                done += n
                yield token
            del self.buffer[:done]

    def finish(self) -> Iterator[int]:
        if self.buffer:
            symbols = [self.v.inner[b] for b in self.buffer[:-1]] + [self.v.last[self.buffer[-1]]]
            yield from merge_all(symbols, self.v.merges)
        self.buffer = bytearray()


class Encoder:
    """Texts to ids, by words; repeated words, and chunks between white space, come from caches of bounded size."""

    def __init__(self, vocabulary: Vocabulary, cache_entries: int = CACHE_ENTRIES, block: int = BLOCK):
        self.v, self.block = vocabulary, block
        self.words, self.chunks = Recent(cache_entries), Recent(cache_entries)

    def _encode(self, word: bytes) -> bytes:
        transducer = Transducer(self.v, self.block)
        ids = list(transducer.feed(word))
        ids += transducer.finish()
        return pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        known = self.words.get(word) or self.words.recall(word)
        if known is None:
            known = self._encode(word.encode("utf-8", "replace"))
            if len(word) <= self.block:
                self.words[word] = known
        return known

    def _chunk(self, chunk: str) -> bytes:
        known = self.chunks.recall(chunk)
        if known is None:
            known = b"".join(map(self._word, self.v.pattern.findall(chunk)))
            if len(chunk) <= self.block:
                self.chunks[chunk] = known
        return known

    def _plain(self, text: str) -> bytes:
        if has_unassigned(text):
            return b"".join(map(self._encode, self.v.split_by_library(text)))
        text = self.v.prepare(text)
        if not self.v.spaces_vanish:  # words carry their blanks
            return b"".join([self._word(match[0]) for match in self.v.pattern.finditer(text)])
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")  # white space to Python alone
        chunks = self.v.space.split(text) if odd else text.split()
        ids = list(map(self.chunks.get, chunks))
        for at in holes(ids):
            ids[at] = self._chunk(chunks[at])
        self.chunks.age()
        self.words.age()
        return b"".join(ids)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.v.added_pattern is None:
            return self._plain(text)
        out, at = [], 0
        for match in self.v.added_pattern.finditer(text):
            out += [self._plain(text[at:match.start()]), pack("<I", self.v.added[match[0]])]
            at = match.end()
        return b"".join([*out, self._plain(text[at:] if at else text)])


@functools.lru_cache(maxsize=2)
def shared_encoder(path: str) -> Encoder:
    """The encoder of a Python worker: its cache serves all the worker's tasks."""
    return Encoder(load(path))


class Decoder:
    """Ids to text, incrementally: a state machine from bytes to characters that holds an unfinished character only.

    ``words`` False follows the tokenizer file (one without a decoder gives its tokens, a blank between any two). True
    restores the text: bytes to characters, word ends to blanks.
    """

    def __init__(self, vocabulary: Vocabulary, words: bool = False):
        self.v, self.words = vocabulary, words
        self.joined = not words and not vocabulary.byte_decoder
        self.first = True
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        tokens = self.v.tokens
        if self.joined:
            text = " ".join([tokens[i] for i in ids if i in tokens])
            if not text:
                return ""
            lead, self.first = "" if self.first else " ", False
            return lead + text
        out = []
        for i in ids:
            token = tokens.get(i, "")
            if token in self.v.added:
                out.append(self.utf8.decode(token.encode()))
                continue
            end = bool(self.words and self.v.suffix and token.endswith(self.v.suffix))
            body = token.removesuffix(self.v.suffix) if end else token
            out.append(self.utf8.decode(bytes([self.v.byte_of[c] for c in body])))
            if end:
                out.append(self.utf8.decode(b" "))
        return "".join(out)

    def finish(self) -> str:
        return "" if self.joined else self.utf8.decode(b"", final=True)


def encode_documents(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids binary)``: ids as little-endian unsigned 32-bit integers, one row per input row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(vocabulary_path)
        for batch in batches:
            ids = [encoder.encode(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())],
                                             names=["doc_id", "ids"])

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, vocabulary_path: str, words: bool = False, block: int = 1 << 14) -> DataFrame:
    """``(doc_id, text)`` of ``(doc_id, ids)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(vocabulary_path)
        for batch in batches:
            texts = []
            for value in batch.column("ids"):
                ids, decoder = np.frombuffer(value.as_py() or b"", dtype="<u4"), Decoder(vocabulary, words)
                parts = [decoder.feed(ids[at:at + block].tolist()) for at in range(0, len(ids), block)]
                texts.append("".join(parts) + decoder.finish())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def token_digests(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
                  block: int = 1 << 14) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` per row: each text is encoded and its ids decoded again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(vocabulary_path)
        encoder = shared_encoder(vocabulary_path)
        for batch in batches:
            counts, id_digests, text_digests = [], [], []
            for value in batch.column("text"):
                raw = encoder.encode(value.as_py())
                ids, decoder, digest = np.frombuffer(raw, dtype="<u4"), Decoder(vocabulary), hashlib.sha256()
                for at in range(0, len(ids), block):
                    digest.update(decoder.feed(ids[at:at + block].tolist()).encode("utf-8"))
                digest.update(decoder.finish().encode("utf-8"))
                counts.append(len(ids))
                id_digests.append(hashlib.sha256(raw).hexdigest())
                text_digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_digests), pa.array(text_digests)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def q_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), word_vocabulary())
