"""Fill-in-middle transformation by displacement scatter, and its inverse by gather.

A text is cut at two of its units (a word with the white space before it; white space at the end is a unit of its own)
into prefix, middle and suffix, which are put in another order with a marker before each. Whole Arrow batches are moved
at once: one scan finds the unit ends and the cuts, a difference array over the batch's bytes takes the change of
displacement at every cut, its running sum is each byte's displacement, and one scatter moves all bytes; markers are
scattered into the gaps. The inverse finds the markers in the output alone and gathers the bytes back.

Cuts, form and order follow from the document's id and the seed alone, so a lost task gives the same rows again.
Displacements are held for ``BLOCK`` bytes at a time, so memory is a few times the batch's text, however long a text is.

Nulls and odd rows: a null text is an empty one and stays plain; a null doc_id draws nothing and stays plain. Rows are
independent: each gives a row, repeated ones alike. Other columns are left behind, whatever their names. An empty table
gives no rows. A text that holds a marker itself stays plain, as it could not be restored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.batches import IS_SPACE, blocks, slices, text_arrays, text_column
from airshed.llm.common import documents, table

# The markers' letters, in the order prefix, suffix, middle; a marker is the letter in angle brackets.
LETTERS = b"PSM"
MARK = 3
SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)
BLOCK = 1 << 20

_PREFIX, _SUFFIX, _MIDDLE = range(3)


class Displacement:
    """How far each byte of a row of segments moves, from the difference array of its cuts."""

    def __init__(self, starts: np.ndarray, shifts: np.ndarray):
        """Segments begin at ``starts`` (ascending; empty ones share a start) and move by ``shifts``."""
        self.starts, self.changes = starts, np.diff(shifts, prepend=0)

    def targets(self, total: int, block: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """``(a, b, places)``: where the bytes a to b belong, block by block."""
        carried = 0
        for a, b in blocks(total, block):
            lo, hi = np.searchsorted(self.starts, (a, b))
            moves = np.zeros(b - a, np.int64)
            np.add.at(moves, self.starts[lo:hi] - a, self.changes[lo:hi])
            moves[0] += carried
            np.cumsum(moves, out=moves)
            carried = moves[-1]
            moves += np.arange(a, b)
            yield a, b, moves


def marker_places(data: np.ndarray, ends: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and letters of the markers that lie within one text; ``ends`` are the texts' ends."""
    found = []
    for a, b in blocks(max(len(data) - MARK + 1, 0), block):
        at = a + np.flatnonzero(data[a:b] == ord("<"))
        found.append(at[(data[at + 2] == ord(">")) & np.isin(data[at + 1], list(LETTERS))])
    at = np.concatenate(found) if found else np.empty(0, np.int64)
    at = at[at + MARK <= ends[np.searchsorted(ends, at, side="right")]] if len(at) else at
    return at, data[at + 1]


def unit_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The ends of all units, text after text, and the number of units of each text."""
    found = []
    last = ends[ends > starts] - 1
    for a, b in blocks(len(data), block):
        space = IS_SPACE[data[a:b + 1]]
        follows = np.append(space[1:b - a], True) if len(space) == b - a else space[1:]
        closes = ~space[:b - a] & follows
        lo, hi = np.searchsorted(last, (a, b))
        closes[last[lo:hi] - a] = True  # a word's or a blank tail's last byte
        found.append(a + 1 + np.flatnonzero(closes))
    all_ends = np.concatenate(found) if found else np.empty(0, np.int64)
    return all_ends, np.searchsorted(all_ends, ends, "right") - np.searchsorted(all_ends, starts, "right")


def chars_before(data: np.ndarray, places: np.ndarray, block: int) -> np.ndarray:
    """Code points that begin before each of the (ascending) places."""
    out, count = np.empty(len(places), np.int64), 0
    at = 0
    for a, b in blocks(len(data), block):
        leads = np.cumsum((data[a:b] & 0xC0) != 0x80)
        to = np.searchsorted(places, b, "left")
        inside = places[at:to] - a
        out[at:to] = count + np.where(inside > 0, leads[inside - 1], 0)
        at, count = to, count + int(leads[-1])
    out[at:] = count
    return out


def order_starts(form: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where prefix, suffix and middle begin in the output (rows: texts); a marker stands right before each."""
    prefix, suffix, middle = lengths[:, _PREFIX], lengths[:, _SUFFIX], lengths[:, _MIDDLE]
    begin = np.empty_like(lengths)
    begin[:, _PREFIX] = np.select([form == PSM, form == SPM], [MARK, 2 * MARK + suffix], 0)
    begin[:, _SUFFIX] = np.select([form == PSM, form == SPM], [2 * MARK + prefix, MARK], prefix + middle)
    begin[:, _MIDDLE] = np.select([form == PLAIN], [prefix], 3 * MARK + prefix + suffix)
    return begin


def transform(column: pa.Array, draws: np.ndarray, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
              block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """``(n, form, chars, output)`` of a column of texts; ``draws`` has four numbers a row, -1 where nothing is drawn."""
    data, starts, ends = text_arrays(column)
    size = ends - starts
    unit, n = unit_ends(data, starts, ends, block)
    form = np.where(draws[:, 3] % 100 < spm_percent, SPM, PSM)
    form[(draws[:, 2] % 100 >= fim_percent) | (draws[:, 2] < 0) | (size == 0)] = PLAIN
    marked, _ = marker_places(data, ends, block)
    form[np.searchsorted(ends, marked, side="right")] = PLAIN

    first_unit = np.searchsorted(unit, starts, "right")
    cut = np.sort(np.maximum(draws[:, :2], 0) % (n[:, None] + 1), axis=1)
    reach = np.append(unit, 0)[first_unit[:, None] + cut - 1] if len(n) else np.empty((0, 2), np.int64)
    cuts = np.where(cut > 0, reach, starts[:, None])
    lengths = np.stack([cuts[:, 0] - starts, ends - cuts[:, 1], cuts[:, 1] - cuts[:, 0]], axis=1)

    total = size + np.where(form == PLAIN, 0, 3 * MARK)
    out_start = np.cumsum(total) - total
    begin = order_starts(form, lengths) + out_start[:, None]
    out = np.empty(int(total.sum()), np.uint8)
    source = np.stack([starts, cuts[:, 0], cuts[:, 1]], axis=1)
    shifts = begin[:, [_PREFIX, _MIDDLE, _SUFFIX]] - source
    for a, b, places in Displacement(source.ravel(), shifts.ravel()).targets(len(data), block):
        out[places] = data[a:b]
    made = form != PLAIN
    for part, letter in enumerate(LETTERS):
        at = begin[made, part] - MARK
        out[at], out[at + 1], out[at + 2] = ord("<"), letter, ord(">")

    at_cut = chars_before(data, source.ravel(), block).reshape(-1, 3)
    chars = np.diff(at_cut, axis=1) if len(n) else np.empty((0, 2), np.int64)
    return n, form, chars, text_column(out, out_start, total)


def restore(column: pa.Array, form: np.ndarray, block: int = BLOCK) -> pa.Array:
    """The texts that gave these outputs, from the outputs and their forms."""
    data, starts, ends = text_arrays(column)
    at, letter = marker_places(data, ends, block)
    text = np.searchsorted(ends, at, side="right")
    made = np.flatnonzero(form != PLAIN)
    held = form[text] != PLAIN if len(at) else np.empty(0, bool)
    at, letter, text = at[held], letter[held], text[held]
    order = np.where((form[made] == PSM)[:, None], list(b"PSM"), list(b"SPM"))
    if len(at) != 3 * len(made) or not (np.array_equal(letter, order.ravel()) and np.array_equal(text, made.repeat(3))):
        raise ValueError("an output does not have its three markers in the order of its form")
    at = at.reshape(-1, 3)
    after = np.concatenate([at[:, 1:], ends[made][:, None]], axis=1)
    lengths = np.zeros((len(starts), 3), np.int64)
    lengths[:, _PREFIX] = ends - starts  # a plain text is all prefix
    begin = np.repeat(starts[:, None], 3, axis=1)
    for kind, places in ((PSM, [_PREFIX, _SUFFIX, _MIDDLE]), (SPM, [_SUFFIX, _PREFIX, _MIDDLE])):
        rows = form[made] == kind
        for k, part in enumerate(places):
            begin[made[rows], part] = at[rows, k] + MARK
            lengths[made[rows], part] = after[rows, k] - at[rows, k] - MARK
    read = [_PREFIX, _MIDDLE, _SUFFIX]
    sizes = lengths[:, read]
    to = (np.cumsum(sizes.ravel()) - sizes.ravel()).reshape(-1, 3)
    out = np.empty(int(sizes.sum()), np.uint8)
    for a, b, places in Displacement(to.ravel(), (begin[:, read] - to).ravel()).targets(len(out), block):
        out[a:b] = data[places]
    return text_column(out, to[:, 0], sizes.sum(axis=1))


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers of a document: the first four groups of eight digits of the digest of its id under the seed."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256)
    return [F.coalesce(F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long"), F.lit(-1)).alias(f"draw{k}")
            for k in range(4)]


def fim_documents(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``, one row per input row; chars are null if plain."""
    rows = documents(docs, id_col, text_col)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output", pa.string())])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                drawn = np.stack([piece.column(f"draw{k}").to_numpy() for k in range(4)], axis=1)
                n, form, chars, output = transform(piece.column("text"), drawn, fim_percent, spm_percent)
                plain = form == PLAIN
                names = pa.array(FORMS).take(pa.array(form))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(n), names, pa.array(chars[:, 0], mask=plain),
                     pa.array(chars[:, 1], mask=plain), output], schema=schema)

    return rows.select("doc_id", "text", *draws(F.col("doc_id"), seed)).mapInArrow(
        move, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored_documents(rows: DataFrame) -> DataFrame:
    """The rows with ``restored`` in the place of ``output``: the texts rebuilt from ``output`` and ``form``."""
    kept = [f for f in rows.schema.fields if f.name not in ("output", "restored")]
    carried = [f.name for f in kept]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "output"):
                form = pc.index_in(piece.column("form"), value_set=pa.array(FORMS)).to_numpy()
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in carried),
                                                  restore(piece.column("output"), form)], names=[*carried, "restored"])

    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.select(*[F.col(f"`{c}`") for c in carried], "output").mapInArrow(gather, f"{listed}, restored string")


def q_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim_documents(table(spark, sf_dir, "documents"))
    made = made.withColumn("output_sha256", F.sha2("output", 256))
    return restored_documents(made).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
                                           F.sha2("restored", 256).alias("restored_sha256"))


_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

ORACLE = f"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS u,
         sha256('{SEED}:' || doc_id) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, text, u, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS c1,
         ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= {FIM_PERCENT} THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM units),
parts AS (
  SELECT doc_id, text, n, form, coalesce(array_to_string(u[1:least(c1, c2)], ''), '') AS prefix,
         coalesce(array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS middle,
         coalesce(array_to_string(u[greatest(c1, c2) + 1:], ''), '') AS suffix
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
