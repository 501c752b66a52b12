"""Removal of repeated passages by distributed prefix doubling over all byte positions.

Every position stands for the suffix that begins there. Prefix doubling sorts the pairs (rank of the first h bytes, rank
of the bytes from h on) to rank all positions by 2h bytes, and goes on until a position is alone or the length passes
the threshold. Here a rank is held as a name, a hash of the string: equal strings have equal names, which is all that
duplicates need. The doublings up to 32 bytes run inside a task on arrays. Spark then deals names to partitions, sorts
them there, and tells each block which of its names are shared; positions that are alone leave before the next round:

A. Length 32 (pairs at offset 16). A window of ``LENGTH`` bytes holds 19 strings of 32 bytes; only the one with the
   least name is sent, so neighbouring windows mostly send the same one. If it occurs in one document only, so does the
   window.
B. Segments. What is left is cut where the 16 bytes at a position hash to zero modulo 64, which shared text does at the
   same places. A segment, with the bytes its last window needs, that occurs in a smaller document settles all its
   windows with one name.
C. Length 50 (pairs at offset 18) for the windows still open: the least document that holds each name.

Round A only drops positions, and its short names can err on the safe side alone. Names that remove bytes have 96 bits.
A document that holds a window and is the least one is never settled in B, so C still sees it.

Blocks of whole documents are written once, as a table bucketed by block, so the rounds join their answers to the text
without moving the text again. A name leaves a block once, with the least document of the block that holds it: copies
and common passages, however many, reach a sort as one row per block. Long texts are hashed in chunks.

Nulls and odd rows: a null text is an empty one. A null doc_id takes no part and stays whole. Rows that repeat a doc_id
are the same document: they don't repeat each other, but lose what a smaller doc_id holds. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import bucketed, documents, shuffle_partitions, stage, table

LENGTH = 50
BLOCK_BYTES = 4 << 20
CHUNK = 1 << 18
PART_BYTES = 8 << 20  # text per partition of names
SEGMENT_MASK = 63

_BLOCK = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                    ("data", pa.binary())])
_BLOCK_SQL = "block long, doc_ids array<long>, lengths array<long>, data binary"
_NAMES_SQL = "part int, block long, high binary, low binary, doc_ids binary, counts binary"
_NAMES = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("high", pa.binary()), ("low", pa.binary()),
                    ("doc_ids", pa.binary()), ("counts", pa.binary())])
_ANSWER_SQL = "block long, part int, answer binary"
_ANSWER = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("answer", pa.binary())])


# --- names of strings ------------------------------------------------------------------------------------------------

_WORD, _HALF, _FULL = 8, 16, 32
_MULTIPLIERS = ((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes at every place where eight are left, as one integer: their own name."""
    n = max(0, len(data) - _WORD + 1)
    out = np.empty(n, dtype=np.uint64)
    for k in range(min(_WORD, n)):
        count = (n - k + _WORD - 1) // _WORD
        out[k::_WORD] = np.frombuffer(data[k:k + count * _WORD].tobytes(), dtype="<u8")
    return out


def _pair(first: np.ndarray, second: np.ndarray, lane: int = 0) -> np.ndarray:
    """The name of two neighbouring strings from their names."""
    one, two = _MULTIPLIERS[lane]
    x = first * np.uint64(one)
    x ^= x >> np.uint64(32)
    x += second
    x *= np.uint64(two)
    x ^= x >> np.uint64(29)
    return x


def _double(names: np.ndarray, n: int) -> np.ndarray:
    """Names of the strings of ``2 * n`` bytes from those of ``n`` bytes."""
    return _pair(names[:-n], names[n:])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    n = 1
    while 2 * n <= width:
        values, n = np.minimum(values[:-n], values[n:]), 2 * n
    return values if n == width else np.minimum(values[:n - width], values[width - n:])


class Block:
    """A block of whole documents and what is known of its windows."""

    def __init__(self, row: dict, length: int):
        self.number, self.length = row["block"], length
        self.data = np.frombuffer(row["data"], dtype=np.uint8)
        self.raw = row["data"]
        lengths = np.asarray(row["lengths"], dtype=np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.names = row["doc_ids"]
        known = np.array([d is not None for d in self.names], dtype=bool)
        ids = np.array([d if d is not None else 0 for d in self.names], dtype=np.int64)
        self.ids = np.unique(ids[known])
        self.order = np.searchsorted(self.ids, ids).astype(np.int64)  # a document's place among the block's ids
        self.windows = np.zeros(len(self.data), dtype=bool)
        for start, end, ok in zip(self.starts, self.ends, known):
            if ok and end - start >= length:
                self.windows[start:end - length + 1] = True

    def chunks(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """``(start, end, bytes)`` with the bytes that the last windows of the chunk need, zeros behind the end."""
        for at in range(0, len(self.data), CHUNK):
            end = min(at + CHUNK, len(self.data))
            piece = self.data[at:end + self.length - 1]
            missing = end - at + self.length - 1 - len(piece)
            yield at, end, np.concatenate((piece, np.zeros(missing, np.uint8))) if missing else piece

    def documents_at(self, places: np.ndarray) -> np.ndarray:
        return self.order[np.searchsorted(self.ends, places, side="right")]

    def anchors(self, parts: int, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Round A: ``(keys, places, run lengths)`` of runs of windows whose least 32-byte string is the same.

        A key is the part in the upper half and 32 bits of the name in the lower one. ``cuts``, if given, is set where
        the 16 bytes at a place end a segment.
        """
        keys, places, runs = [], [], []
        for at, end, piece in self.chunks():
            inside = self.windows[at:end]
            if not inside.any():
                continue
            half = _double(_words(piece), _WORD)
            if cuts is not None:
                cuts[at:end] = half[:end - at] & np.uint64(SEGMENT_MASK) == 0
            least = _sliding_least(_double(half, _HALF), self.length - _FULL + 1)[:end - at]
            new = np.ones(end - at, dtype=bool)
            new[1:] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
            new[(self.starts[(self.starts > at) & (self.starts < end)] - at)] = True
            first = np.flatnonzero(new)
            length = np.diff(np.append(first, end - at))
            use = inside[first]
            name = least[first[use]]
            keys.append((name >> np.uint64(32)) % np.uint64(parts) << np.uint64(32) | name & np.uint64(0xFFFFFFFF))
            places.append(first[use] + at)
            runs.append(length[use])
        if not keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(keys), np.concatenate(places), np.concatenate(runs)

    def active(self, shared: list[dict], parts: int) -> tuple[np.ndarray, np.ndarray]:
        """``(active, cuts)``: windows whose least 32-byte string another document holds too; where segments end."""
        cuts = np.zeros(len(self.data), dtype=bool)
        kept = [np.frombuffer(a["answer"], "<u4").astype(np.uint64) | np.uint64(a["part"] << 32)
                for a in sorted(shared or [], key=lambda a: a["part"])]
        if not kept:
            return np.zeros(len(self.data), dtype=bool), cuts
        keys, places, runs = self.anchors(parts, cuts)
        known = np.concatenate(kept)
        hit = known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys
        return self.spread(places[hit], places[hit] + runs[hit]), cuts

    def spread(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places inside disjoint ranges."""
        edge = np.zeros(len(self.data) + 1, dtype=np.int8)
        edge[starts] += 1
        edge[ends] -= 1
        return np.cumsum(edge[:-1], dtype=np.int8) > 0

    def segments(self, active: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Round B: ``(high, low, first window, end of windows)`` of the segments whose windows are all active."""
        cut[self.starts[self.starts < len(self.data)]] = True
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(self.data))
        idle = np.concatenate(([0], np.cumsum(self.windows & ~active)))
        here = np.concatenate(([0], np.cumsum(self.windows)))
        use = (idle[last] == idle[first]) & (here[last] > here[first])
        first = first[use]
        last = first + (here[last[use]] - here[first])  # windows of a document are at its beginning, without gaps
        stops = last + self.length - 1
        digests = b"".join([hashlib.blake2b(self.raw[a:b], digest_size=12).digest()
                            for a, b in zip(first.tolist(), stops.tolist())])
        pairs = np.frombuffer(digests, dtype=np.dtype([("high", "<u8"), ("low", "<u4")]))
        return pairs["high"].copy(), pairs["low"].copy(), first, last

    def windows_names(self, use: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Round C: ``(high, low, place)`` of the chosen windows, in two lanes of doublings from eight bytes on."""
        high, low, places = [], [], []
        for at, end, piece in self.chunks():
            chosen = np.flatnonzero(use[at:end])
            if len(chosen):
                words = _words(piece)
                for lane, out in ((0, high), (1, low)):
                    out.append(self._name(words, chosen, lane))
                places.append(chosen + at)
        if not places:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(high), (np.concatenate(low) >> np.uint64(32)).astype(np.uint32), np.concatenate(places)

    def _name(self, words: np.ndarray, at: np.ndarray, lane: int) -> np.ndarray:
        def full(shift: int) -> np.ndarray:
            halves = [_pair(words[at + shift + k], words[at + shift + k + _WORD], lane) for k in (0, _HALF)]
            return _pair(*halves, lane)

        return _pair(full(0), full(self.length - _FULL), lane)


def _runs(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, new)``: a stable order that brings equal names together, and where a name begins in it."""
    order = np.argsort(high, kind="stable")
    h, w = high[order], low[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    if np.any((w[1:] != w[:-1]) & ~new[1:]):  # equal in one half only
        order = np.lexsort((low, high))
        h, w = high[order], low[order]
        new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
    return order, new


class Distinct:
    """Names of one block, each once with the least document that holds it, sorted by part and place.

    Names come by place, and a block's documents stand in ascending order, so a name's first place is that of the least.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray, order: np.ndarray, parts: int):
        by_name, new = _runs(high, low)
        first = by_name[new]
        places = np.zeros(len(high), dtype=bool)
        places[first] = True
        places = np.flatnonzero(places)
        part = (high[places] % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.int64)
        dealt = np.argsort(part, kind="stable")
        entries = places[dealt]
        self.high, self.low, self.order = high[entries], low[entries], order[entries]
        self.part = part[dealt].astype(np.int64)
        number = np.empty(len(high), dtype=np.int64)
        number[entries] = np.arange(len(entries))
        self.of = np.empty(len(high), dtype=np.int64)  # entry of each given name
        self.of[by_name] = number[first][np.cumsum(new) - 1]

    def rows(self, block: Block) -> Iterator[dict]:
        cuts = np.flatnonzero(np.diff(self.part, prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(self.part))):
            first = np.flatnonzero(np.diff(self.order[a:b], prepend=-1))
            yield {"part": int(self.part[a]), "block": block.number, "high": self.high[a:b].astype("<u8").tobytes(),
                   "low": self.low[a:b].astype("<u4").tobytes(),
                   "doc_ids": block.ids[self.order[a:b][first]].astype("<i8").tobytes(),
                   "counts": np.diff(np.append(first, b - a)).astype("<u4").tobytes()}

    def settled(self, answers: list[dict], order: np.ndarray) -> np.ndarray:
        """For each given name and its document: whether a smaller document holds it, in this block or another."""
        elsewhere = np.zeros(len(self.part), dtype=bool)
        first = np.searchsorted(self.part, [a["part"] for a in answers or []])
        for a, at in zip(answers or [], first):
            n = int(np.searchsorted(self.part, a["part"], side="right")) - at
            elsewhere[at:at + n] = np.unpackbits(np.frombuffer(a["answer"], np.uint8), count=n).astype(bool)
        return elsewhere[self.of] | (order > self.order[self.of])


# --- rounds ------------------------------------------------------------------------------------------------------------

def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):  # one block in memory at a time
            yield batch.slice(k, 1).to_pylist()[0]


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, bytes))
        if size >= 4 << 20 or len(held) >= 1000:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def write_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Whole documents gathered to blocks of about ``block_bytes``, as a table bucketed by block."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                data = text.as_py().encode("utf-8", "surrogatepass")
                ids.append(doc_id)
                texts.append(data)
                size += len(data)
                if size >= block_bytes:
                    yield _block(number, ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield _block(number, ids, texts)

    blocks = documents(docs, id_col, text_col).mapInArrow(gather, _BLOCK_SQL)
    return bucketed(blocks, "text_blocks", shuffle_partitions(docs.sparkSession), "block")


def _block(number: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is not None, ids[k]))  # ascending, null ids first
    row = {"block": number, "doc_ids": [ids[k] for k in order], "lengths": [len(texts[k]) for k in order],
           "data": b"".join([texts[k] for k in order])}
    return pa.RecordBatch.from_pylist([row], schema=_BLOCK)


def _shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round A in a part: the names that two documents hold, back to the blocks that sent them."""
    def answers() -> Iterator[dict]:
        for part, rows in _parts(batches):
            names = [np.frombuffer(r["low"], "<u4") for r in rows]
            several = [np.unpackbits(np.frombuffer(r["counts"], np.uint8), count=len(n)).astype(bool)
                       for r, n in zip(rows, names)]
            together = np.concatenate(names)
            order = np.argsort(together, kind="stable")
            new = np.diff(together[order], prepend=together[order[:1]] - np.uint32(1)) != 0
            run = np.cumsum(new) - 1
            many = (np.bincount(run) > 1) | (np.bincount(run, weights=np.concatenate(several)[order]) > 0)
            hit = np.empty(len(together), dtype=bool)
            hit[order] = many[run]
            for r, n, flags in zip(rows, names, np.split(hit, np.cumsum([len(n) for n in names])[:-1])):
                if flags.any():
                    yield {"block": r["block"], "part": part, "answer": n[flags].tobytes()}

    yield from _batches(answers(), _ANSWER)


def _least_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rounds B and C in a part: a bit for each name sent, set if a smaller document of another block holds it."""
    def answers() -> Iterator[dict]:
        for part, rows in _parts(batches):
            high = np.concatenate([np.frombuffer(r["high"], "<u8") for r in rows])
            low = np.concatenate([np.frombuffer(r["low"], "<u4") for r in rows])
            doc = np.concatenate([np.repeat(np.frombuffer(r["doc_ids"], "<i8"), np.frombuffer(r["counts"], "<u4"))
                                  for r in rows])
            order, new = _runs(high, low)
            least = np.minimum.reduceat(doc[order], np.flatnonzero(new))
            smaller = np.empty(len(order), dtype=bool)
            smaller[order] = least[np.cumsum(new) - 1] < doc[order]
            at = 0
            for r in rows:
                n = len(r["low"]) // 4
                if smaller[at:at + n].any():
                    yield {"block": r["block"], "part": part, "answer": np.packbits(smaller[at:at + n]).tobytes()}
                at += n

    yield from _batches(answers(), _ANSWER)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows sorted by part, gathered by part (its names are a hash share of all, its size set by ``PART_BYTES``)."""
    part, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part and rows:
                yield part, rows
                rows = []
            part = row["part"]
            rows.append(row)
    if rows:
        yield part, rows


def _round(sent: DataFrame, resolve, parts: int, label: str) -> DataFrame:
    """Deal every part to a task of its own, sort, resolve; returns one row of answers per block."""
    dealt = sent.repartitionById(parts, "part").sortWithinPartitions("part", "block")
    answers = stage(dealt.mapInArrow(resolve, _ANSWER_SQL), label)
    return answers.groupBy("block").agg(F.collect_list(F.struct("part", "answer")).alias("answers"))


def _with(blocks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """Answers beside their block; the block's row stays where its bucket is."""
    return blocks.join(answers.withColumnRenamed("answers", name).hint("shuffle_hash"), "block", "left")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)``: byte spans that ``length``-byte strings of smaller documents cover, the rest.

    One row per input row. ``length`` is from 32 to 64.
    """
    if not _FULL <= length <= 2 * _FULL:
        raise ValueError("length must be between 32 and 64")
    blocks = write_blocks(docs, id_col, text_col, block_bytes)
    total = blocks.select(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()[0] or 0
    parts = max(shuffle_partitions(docs.sparkSession), -(-total // part_bytes))

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for row in _rows(batches):
                block = Block(row, length)
                keys, places, _ = block.anchors(parts)
                order, by_key = block.documents_at(places), np.argsort(keys, kind="stable")
                keys, order = keys[by_key], order[by_key]
                first = np.flatnonzero(np.diff(keys, prepend=keys[:1] - np.uint64(1)) != 0)
                if not len(first):
                    continue
                several = np.minimum.reduceat(order, first) != np.maximum.reduceat(order, first)
                keys = keys[first]
                part = (keys >> np.uint64(32)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(part, prepend=-1))
                for a, b in zip(cuts, np.append(cuts[1:], len(part))):
                    yield {"part": int(part[a]), "block": block.number,
                           "low": (keys[a:b] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(),
                           "counts": np.packbits(several[a:b]).tobytes()}

        yield from _batches(rows(), _NAMES)

    def segments(row: dict) -> tuple[Block, np.ndarray, Distinct, np.ndarray, np.ndarray, np.ndarray]:
        block = Block(row, length)
        active, cuts = block.active(row["shared"], parts)
        high, low, first, last = block.segments(active, cuts)
        order = block.documents_at(first)
        return block, active, Distinct(high, low, order, parts), order, first, last

    def send_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for row in _rows(batches):
                block, _, distinct, *_ = segments(row)
                yield from distinct.rows(block)

        yield from _batches(rows(), _NAMES)

    def open_windows(row: dict) -> tuple[Block, np.ndarray, Distinct, np.ndarray, np.ndarray]:
        """What round B settled, and the names of the windows it left open."""
        block, active, distinct, order, first, last = segments(row)
        done = distinct.settled(row["settled"], order)
        settled = block.spread(first[done], last[done])
        high, low, places = block.windows_names(active & ~settled)
        order = block.documents_at(places)
        return block, settled, Distinct(high, low, order, parts), order, places

    def send_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for row in _rows(batches):
                block, _, distinct, *_ = open_windows(row)
                yield from distinct.rows(block)

        yield from _batches(rows(), _NAMES)

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block, starts, distinct, order, places = open_windows(row)
            starts[places[distinct.settled(row["least"], order)]] = True
            edge = np.zeros(len(block.data) + 1, dtype=np.int32)
            at = np.flatnonzero(starts)
            edge[at] += 1
            edge[at + length] -= 1
            covered = np.cumsum(edge[:-1]) > 0
            spans, kept = [], []
            for a, b in zip(block.starts, block.ends):
                gone = covered[a:b]
                if gone.any():
                    change = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
                    spans.append([{"start": s, "end": e} for s, e in change.reshape(-1, 2).tolist()])
                    kept.append(block.data[a:b][~gone].tobytes())
                else:
                    spans.append([])
                    kept.append(block.raw[a:b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.names, pa.int64()), pa.array(block.ends - block.starts, pa.int64()),
                 pa.array(spans, span), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    state = blocks
    for send, resolve, answer in ((send_anchors, _shared_anchors, "shared"),
                                  (send_segments, _least_documents, "settled"),
                                  (send_windows, _least_documents, "least")):
        sent = state.mapInArrow(send, _NAMES_SQL)
        state = _with(state, _round(sent, resolve, parts, f"repeats-{answer}"), answer)
    return state.mapInArrow(cut, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def q_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
