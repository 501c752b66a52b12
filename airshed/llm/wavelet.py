"""Token-id output as wavelet matrices: one shard of ids per row of compressed Parquet files.

A shard holds whole documents in ascending doc_id order. Its ids are stored as bit planes, most significant first; each
plane keeps the order of the ids after all zeros of the plane above have been moved before all ones. With the ones
counted per 512 bits, a plane answers rank by a directory entry and a few popcounts, and so a shard answers without
being decoded: the id at a place (access), the number of times an id occurs in a range (count), the place of its k-th
occurrence (select).

File format, a Parquet row per shard: ``part, shard`` (order), ``start`` (ids before it in its part), ``n_ids``,
``doc_ids``, ``doc_lengths``, ``zeros`` (per plane), ``planes`` (bits, little end first, each plane padded to 64 bits),
``ranks`` (unsigned 32-bit ones before each block of 512 bits). Parquet compresses the columns (zstd).

Nulls and odd rows: a null text is an empty one and holds the end id only. Null doc_ids come first, repeated ones next
to each other by text; each input row is a document. An empty table writes no shard.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import documents, shuffle_partitions, staging_path, table

SHARD_IDS = 1 << 20
END_ID = 2
TEXT_BYTES = 16 << 20  # encoded at a time
WORDS = 256  # in a call of the library
CACHED_CHUNKS = 1_000_000  # in a Python worker, about 200 MB
BLOCK_BITS = 512
FILE_SCHEMA = ("part int, shard int, start long, n_ids long, doc_ids array<long>, doc_lengths array<long>, "
               "zeros array<long>, planes binary, ranks binary")
_SHARD = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())),
                    ("zeros", pa.list_(pa.int64())), ("planes", pa.binary()), ("ranks", pa.binary())])


class WaveletMatrix:
    """Bit planes of a sequence of unsigned integers with rank and select."""

    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.zeros, self.planes, self.ranks = n, zeros, planes, ranks

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        ids = ids.astype(np.uint16 if width <= 16 else np.uint32)
        zeros, planes, ranks = [], [], []
        for k in range(width - 1, -1, -1):
            ones = (ids & ids.dtype.type(1 << k)) != 0
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(max(1, -(-len(ids) // 64)), dtype="<u8")
            words.view(np.uint8)[:len(packed)] = packed
            per_block = np.add.reduceat(np.bitwise_count(words).astype(np.uint32),
                                        np.arange(0, len(words), BLOCK_BITS // 64))
            planes.append(words)
            ranks.append(np.concatenate(([0], np.cumsum(per_block)[:-1])).astype("<u4"))
            zeros.append(int(len(ids) - ones.sum()))
            ids = np.concatenate((np.compress(~ones, ids), np.compress(ones, ids)))
        return cls(len(ids), zeros, planes, ranks)

    def to_bytes(self) -> tuple[bytes, bytes]:
        return b"".join(p.tobytes() for p in self.planes), b"".join(r.tobytes() for r in self.ranks)

    @classmethod
    def from_bytes(cls, n: int, zeros: list[int], planes: bytes, ranks: bytes) -> WaveletMatrix:
        width = max(1, len(zeros))
        return cls(n, list(zeros), list(np.frombuffer(planes, dtype="<u8").reshape(width, -1)),
                   list(np.frombuffer(ranks, dtype="<u4").reshape(width, -1)))

    def _bit(self, plane: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[plane][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)

    def _ones(self, plane: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place (a place may be the end)."""
        words = self.planes[plane]
        at = np.asarray(at, dtype=np.int64)
        word = at >> 6
        block = np.minimum(at // BLOCK_BITS, len(self.ranks[plane]) - 1)
        total = self.ranks[plane][block].astype(np.int64)
        first = block * (BLOCK_BITS // 64)
        for k in range(BLOCK_BITS // 64):
            inside = first + k < word
            total += np.where(inside, np.bitwise_count(words[np.minimum(first + k, len(words) - 1)]), 0)
        rest = (at & 63).astype(np.uint64)
        here = words[np.minimum(word, len(words) - 1)] & ((np.uint64(1) << rest) - np.uint64(1))
        return total + np.where(word < len(words), np.bitwise_count(here), 0)

    def access(self, at) -> np.ndarray:
        """The ids at the given places."""
        at = np.asarray(at, dtype=np.int64)
        out = np.zeros(len(at), dtype=np.uint32)
        for k in range(len(self.planes)):
            bit, ones = self._bit(k, at).astype(bool), self._ones(k, at)
            out = (out << np.uint32(1)) | bit.astype(np.uint32)
            at = np.where(bit, self.zeros[k] + ones, at - ones)
        return out

    def ids(self) -> np.ndarray:
        """All ids in order: the planes are undone from the last to the first."""
        out = np.zeros(self.n, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for k in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[k].view(np.uint8), bitorder="little", count=self.n).view(bool)
            back = np.empty_like(out)
            back[np.flatnonzero(~ones)] = out[:self.zeros[k]]
            back[np.flatnonzero(ones)] = out[self.zeros[k]:] | out.dtype.type(1 << (len(self.planes) - 1 - k))
            out = back
        return out.astype(np.uint32)

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a token between two places stand below the last plane."""
        at = np.array([start, end], dtype=np.int64)
        for k in range(len(self.planes)):
            ones = self._ones(k, at)
            at = self.zeros[k] + ones if token >> (len(self.planes) - 1 - k) & 1 else at - ones
        return int(at[0]), int(at[1])

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token between two places."""
        if token < 0 or token >> len(self.planes):
            return 0
        low, high = self._range(token, start, self.n if end is None else end)
        return high - low

    def _select_bit(self, plane: int, bit: bool, k: np.ndarray) -> np.ndarray:
        """The place of the k-th (from zero) such bit: binary search on rank."""
        low, high = np.zeros(len(k), dtype=np.int64), np.full(len(k), self.n, dtype=np.int64)
        while np.any(low < high):
            mid = (low + high) // 2
            ones = self._ones(plane, mid + 1)
            seen = ones if bit else mid + 1 - ones
            low, high = np.where(seen > k, low, np.minimum(mid + 1, high)), np.where(seen > k, mid, high)
        return low

    def occurrences(self, token: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """The places of a token between two places, ascending."""
        if token < 0 or token >> len(self.planes):
            return np.zeros(0, dtype=np.int64)
        low, high = self._range(token, start, self.n if end is None else end)
        at = np.arange(low, high, dtype=np.int64)
        for k in range(len(self.planes) - 1, -1, -1):
            one = bool(token >> (len(self.planes) - 1 - k) & 1)
            at = self._select_bit(k, one, at - self.zeros[k] if one else at)
        return at

    def select(self, token: int, k: int) -> int | None:
        """The place of the k-th occurrence (from zero), None beyond the last."""
        low, high = self._range(token, 0, self.n) if 0 <= token < 1 << len(self.planes) else (0, 0)
        if not 0 <= k < high - low:
            return None
        at = np.array([low + k], dtype=np.int64)
        for plane in range(len(self.planes) - 1, -1, -1):
            one = bool(token >> (len(self.planes) - 1 - plane) & 1)
            at = self._select_bit(plane, one, at - self.zeros[plane] if one else at)
        return int(at[0])


def _gather(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of an array one behind the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return ids[np.repeat((starts - ends + lengths).astype(np.int32), lengths) + np.arange(total, dtype=np.int32)]


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones stand for themselves, the others
    take the letters from U+0100 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: chr(b if b in own else next(others)) for b in range(256)}


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()  # many times as fast as to_pylist


class _Grown:
    """Numbers in an array that grows by doubling, so adding some costs no copy of the others."""

    def __init__(self, kind):
        self.array, self.used = np.zeros(1 << 10, kind), 0

    def scratch(self, more: np.ndarray) -> np.ndarray:
        """The numbers with some more behind them, which the next ones overwrite."""
        end = self.used + len(more)
        if end > len(self.array):
            grown = np.zeros(max(end, 2 * len(self.array)), self.array.dtype)
            grown[:self.used] = self.array[:self.used]
            self.array = grown
        self.array[self.used:end] = more
        return self.array[:end]

    def add(self, more: np.ndarray) -> None:
        self.scratch(more)
        self.used += len(more)

    def keep(self, some: np.ndarray) -> None:
        self.array, self.used = some, len(some)


class _Encoder:
    """Texts to ids by the tokenizers library, one thread, with a bounded cache of blank-separated chunks.

    The byte-level pattern never joins what stands before a blank to what follows it, unless more white space or the
    end follows the blank. So a text without such blanks is the sequence of its chunks, each with its blank in front;
    the library encodes the chunks that the cache lacks, a word apart from the marks behind it, which the pattern never
    joins either. Any other text goes to the library whole, and so does one with the string of an added token.

    Arrow splits the texts and finds the distinct chunks. The cache is a dict from a chunk to its place beside one array
    of all their ids, which both only grow, so a look-up costs the chunks that are asked for and not those that are held.
    It lives as long as the Python worker, over all its tasks, and when it is full only what the last texts used stays.
    """

    _LONE_BLANK = re.compile(r" (?:\s|\Z)")
    _SPACE = re.compile(r"\s")
    _MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    _LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")  # letters only, so a word of them is one piece of the pattern

    def __init__(self, path: str, entries: int = CACHED_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.entries = Tokenizer.from_file(path), entries
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line_feed = self.tokenizer.token_to_id("Ċ")
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.whole_words = self.tokenizer.normalizer is None and isinstance(self.tokenizer.pre_tokenizer, ByteLevel)
        self.width = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        self.places = {"": 0}  # an empty chunk has no ids
        self.starts, self.lengths, self.ids = _Grown(np.int64), _Grown(np.int64), _Grown(np.uint32)
        self.starts.add(np.zeros(1, np.int64))
        self.lengths.add(np.zeros(1, np.int64))

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts in one array, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], dtype=np.uint32), np.fromiter(map(len, found), np.int64)

    def _latin(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`_words`, for words of Latin letters: the library's model gets each as its one piece, in the letters
        that stand for its bytes, without a search for pieces."""
        blank, tokenize = self.letters[ord(" ")], self.model.tokenize
        found = [[t.id for t in tokenize(blank + w.encode().decode("latin-1").translate(self.letters))] for w in words]
        return np.array([i for ids in found for i in ids], dtype=np.uint32), np.fromiter(map(len, found), np.int64)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`_library`, for words with a blank in front, by one call: a line feed stands between any two.

        A line feed before a blank and a word is a token of its own, so the ids can be told apart; words that hold
        white space themselves are given to the library one by one.
        """
        if self._SPACE.search("".join(words)):
            return self._library([" " + w for w in words])
        ids, _ = self._library([" " + "\n ".join(words)])
        between = ids == self.line_feed
        cuts = np.flatnonzero(between)
        return ids[~between], np.diff(cuts, prepend=-1, append=len(ids)) - 1

    def _add(self, chunks: list[str], ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Put chunks with their ids into the cache; returns their places."""
        first = self.starts.used
        self.starts.add(self.ids.used + np.cumsum(lengths) - lengths)
        self.lengths.add(lengths)
        self.ids.add(ids)
        self.places.update(zip(chunks, range(first, first + len(chunks))))
        return first + np.arange(len(chunks))

    def _find(self, chunks: list[str]) -> np.ndarray:
        """Places in the cache, -1 for what it lacks."""
        get = self.places.get
        return np.fromiter((get(c, -1) for c in chunks), np.int64, len(chunks))

    def _learn(self, chunks: pa.Array) -> np.ndarray:
        """Put distinct chunks (without their blank) into the cache; returns their places."""
        words = pc.utf8_rtrim(chunks, characters=self._MARKS)
        last = pc.utf8_slice_codeunits(words, start=-1).dictionary_encode()
        letter = np.array([c.isalpha() for c in last.dictionary.to_pylist()], dtype=bool)[last.indices.to_numpy()]
        marked = letter & (pc.binary_length(words).to_numpy() < pc.binary_length(chunks).to_numpy())
        mask = pa.array(marked, pa.bool_())
        base = pc.if_else(mask, words, chunks).dictionary_encode()

        names = _strings(base.dictionary)
        places = self._find(names)
        new = np.flatnonzero(places < 0)
        latin = np.array([self.whole_words and self._LATIN.fullmatch(names[k]) is not None for k in new.tolist()], bool)
        for which, encode, most in ((new[latin], self._latin, len(new)), (new[~latin], self._words, WORDS)):
            if len(which):
                lacking = [names[k] for k in which.tolist()]
                some = [encode(lacking[at:at + most]) for at in range(0, len(lacking), most)]
                places[which] = self._add(lacking, *map(np.concatenate, zip(*some)))
        out = places[base.indices.to_numpy()]
        if marked.any():
            whole, stems = _strings(chunks.filter(mask)), _strings(words.filter(mask))
            marks = pa.array([n[len(w):] for n, w in zip(whole, stems)]).dictionary_encode()
            ids, lengths = self._library(marks.dictionary.to_pylist())
            word, mark, size = out[marked], marks.indices.to_numpy(), self.ids.used
            starts = np.stack((self.starts.array[word], (size + np.cumsum(lengths) - lengths)[mark]), axis=1)
            counts = np.stack((self.lengths.array[word], lengths[mark]), axis=1)
            both = _gather(self.ids.scratch(ids), starts.ravel(), counts.ravel())
            out[marked] = self._add(whole, both, counts.sum(axis=1))
        return out

    def _whole(self, text: str) -> bool:
        return self._LONE_BLANK.search(text) is not None or any(a in text for a in self.added)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        whole = texts.to_pylist()
        if not whole:
            return []
        apart = [self._whole(t) for t in whole]
        parts = pc.split_pattern(pc.if_else(pa.array(apart, pa.bool_()), "", texts), " ")
        bounds, coded = parts.offsets.to_numpy() - parts.offsets[0].as_py(), parts.flatten().dictionary_encode()
        places = self._find(_strings(coded.dictionary))
        new = np.flatnonzero(places < 0)
        if len(new):
            places[new] = self._learn(coded.dictionary.take(pa.array(new)))
        at = places[coded.indices.to_numpy()]

        # the first chunk has no blank in front
        heads, counts = self._library([t if a else t.partition(" ")[0] for t, a in zip(whole, apart)])
        starts, lengths = self.starts.array[at], self.lengths.array[at]
        starts[bounds[:-1]], lengths[bounds[:-1]] = self.ids.used + np.cumsum(counts) - counts, counts
        out = _gather(self.ids.scratch(heads), starts, lengths)
        ends = np.cumsum(lengths)[bounds[1:] - 1]
        if len(self.places) > self.entries:
            self._forget(np.union1d([0], places))
        return np.split(out, ends[:-1])

    def _forget(self, keep: np.ndarray) -> None:
        """Leave only some entries in the cache."""
        starts, lengths = self.starts.array[keep], self.lengths.array[keep]
        self.ids.keep(_gather(self.ids.array, starts, lengths))
        self.lengths.keep(lengths)
        self.starts.keep(np.cumsum(lengths) - lengths)
        moved = dict(zip(keep.tolist(), range(len(keep))))
        self.places = {c: moved[k] for c, k in self.places.items() if k in moved}


def _portions(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of about ``most`` in sum."""
    start, held = 0, 0
    for k, size in enumerate(sizes):
        held += size
        if held >= most:
            yield start, k + 1
            start, held = k + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def write_token_ids(docs: DataFrame, path: str, vocabulary_path: str, end_id: int = END_ID,
                    shard_ids: int = SHARD_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id``, and write the shards in ascending doc_id order to ``path``."""
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary_path)
        part, shard, start = TaskContext.get().partitionId(), 0, 0
        doc_ids, pieces, held = [], [], 0

        def full() -> pa.RecordBatch:
            ids = np.concatenate(pieces)
            matrix = WaveletMatrix.build(ids, max(encoder.width, int(end_id).bit_length()))
            planes, ranks = matrix.to_bytes()
            row = {"part": part, "shard": shard, "start": start, "n_ids": len(ids), "doc_ids": doc_ids,
                   "doc_lengths": [len(p) for p in pieces], "zeros": matrix.zeros, "planes": planes, "ranks": ranks}
            return pa.RecordBatch.from_pylist([row], schema=_SHARD)

        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for at, end in _portions(pc.binary_length(texts).to_pylist(), TEXT_BYTES):
                for doc_id, ids in zip(names[at:end], encoder.encode(texts.slice(at, end - at))):
                    doc_ids.append(doc_id)
                    pieces.append(np.append(ids, np.uint32(end_id)))
                    held += len(ids) + 1
                    if held >= shard_ids:
                        yield full()
                        shard, start, doc_ids, pieces, held = shard + 1, start + held, [], [], 0
        if pieces:
            yield full()

    texts = documents(docs, id_col, text_col)
    ordered = texts.repartitionByRange(shuffle_partitions(docs.sparkSession), "doc_id") \
        .sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(shards, FILE_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start`` counted from the first id of the whole output.

    The ids before a part are summed up from one number a part: as many rows as the write had range partitions.
    """
    shards = spark.read.schema(FILE_SCHEMA).parquet(path)
    before, offsets = 0, []
    for row in sorted(shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()):
        offsets.append((row["part"], before))
        before += row["n"]
    parts = spark.createDataFrame(offsets, "part int, before long")
    return shards.join(F.broadcast(parts), "part").withColumn("start", F.col("start") + F.col("before")).drop("before")


def _matrix(row: dict) -> WaveletMatrix:
    return WaveletMatrix.from_bytes(row["n_ids"], row["zeros"], row["planes"], row["ranks"])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):  # one shard in memory at a time
        yield batch.slice(k, 1).to_pylist()[0]


def document_ids(shards: DataFrame) -> DataFrame:
    """``(doc_id, start, ids binary)`` of every document: little-endian unsigned 32-bit ids read from the shards."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in _rows(b)):
            raw, ends = _matrix(row).ids().astype("<u4"), np.cumsum(row["doc_lengths"])
            starts = ends - row["doc_lengths"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["start"], pa.int64()),
                 pa.array([raw[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())],
                names=["doc_id", "start", "ids"])

    return shards.mapInArrow(read, "doc_id long, start long, ids binary")


def token_digests(shards: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read from the shards."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in _rows(b)):
            raw, ends = _matrix(row).ids().astype("<u4"), np.cumsum(row["doc_lengths"])
            starts = ends - row["doc_lengths"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["start"], pa.int64()),
                 pa.array(row["doc_lengths"], pa.int64()),
                 pa.array([zlib.crc32(raw[a:b].tobytes()) for a, b in zip(starts, ends)], pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """``(doc_id, place)`` of every occurrence of a token; place counts from the document's first id."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in _rows(b)):
            places, ends = _matrix(row).occurrences(token), np.cumsum(row["doc_lengths"])
            which = np.searchsorted(ends, places, side="right")
            starts = ends - row["doc_lengths"]
            ids = pa.array(row["doc_ids"], pa.int64()).take(pa.array(which))
            yield pa.RecordBatch.from_arrays([ids, pa.array(places - starts[which], pa.int64())],
                                             names=["doc_id", "place"])

    return shards.mapInArrow(find, "doc_id long, place long")


def count_token(shards: DataFrame, token: int) -> DataFrame:
    """``(n)``: how often a token occurs, by rank alone."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in _rows(b)):
            yield pa.RecordBatch.from_arrays([pa.array([_matrix(row).count(token)], pa.int64())], names=["n"])

    return shards.mapInArrow(count, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def q_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "token-ids")
    write_token_ids(table(spark, sf_dir, "documents"), path, byte_vocabulary())
    return token_digests(read_shards(spark, path))
