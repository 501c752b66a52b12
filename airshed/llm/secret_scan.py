"""Secret scan: all rules in one combined deterministic automaton, one byte pass over every text.

A rule is a prefix and a value pattern; the automaton finds their matches (leftmost, non-overlapping per kind), and a
match counts when its value and its whole are long enough. Matches that fail still use up their text, as with a search
for the pattern without its lengths.

Nulls and odd rows: a null text is an empty one, without spans. Rows are independent of each other; each gives a row,
also with a null or repeated doc_id; repeated rows give equal rows. Other columns are left behind, whatever their names.
Offsets are code points of the text, the end exclusive. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.automaton import CombinedAutomaton
from airshed.llm.common import documents, table


@dataclass(frozen=True)
class Rule:
    kind: str
    prefix: str
    value: str
    min_value: int = 0
    min_total: int = 0
    ignore_case: bool = False


# The patterns and lengths of the base kinds, then those of well-known tokens, in the order of listing.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+",
         min_value=12, ignore_case=True),
    Rule("access", r"AKIA", r"[A-Z0-9]+", min_total=18),
    Rule("hex", r"", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_", r"[A-Za-z0-9]+", min_value=36),
    Rule("slack", r"xox[abprs]-", r"[A-Za-z0-9-]+", min_value=10),
    Rule("google", r"AIza", r"[A-Za-z0-9_-]+", min_value=35),
    Rule("stripe", r"[rs]k_live_", r"[A-Za-z0-9]+", min_value=16),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ", r"[A-Za-z0-9_.-]+", min_value=16),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r""),
)
SPAN_TYPE = "array<struct<kind:string,start:long,end:long>>"


class Scanner:
    """The compiled rules; small enough to travel with a task."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.automaton = CombinedAutomaton([(r.prefix + r.value, r.ignore_case) for r in rules])
        self.prefixes = [re.compile(r.prefix.encode(), re.I if r.ignore_case else 0) for r in rules]

    def _counts(self, rule: int, match: bytes) -> bool:
        spec = self.rules[rule]
        if len(match) < spec.min_total:
            return False
        return not spec.min_value or len(match) - self.prefixes[rule].match(match).end() >= spec.min_value

    def spans(self, text: str) -> list[dict]:
        """Spans by start, then by kind as listed; offsets in code points."""
        data = text.encode("utf-8", "surrogatepass")
        found = [(s, r, e) for s, r, e in self.automaton.matches(data) if self._counts(r, data[s:e])]
        if not found:
            return []
        at, chars, place = 0, 0, {}
        for offset in sorted({o for s, _, e in found for o in (s, e)}):
            chars += len(data[at:offset].decode("utf-8", "surrogatepass"))
            at, place[offset] = offset, chars
        return [{"kind": self.rules[r].kind, "start": place[s], "end": place[e]} for s, r, e in found]


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, spans)``, one row per input row; the rules are compiled once, on the driver."""
    scanner = Scanner(rules)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = pa.array([scanner.spans(t.as_py()) for t in batch.column("text")], pa.list_(kind))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), spans], names=["doc_id", "spans"])

    return documents(docs, id_col, text_col).mapInArrow(scan, f"doc_id long, spans {SPAN_TYPE}")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def q_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secret_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE_RULES]))
    counts = [_count(r.kind) for r in BASE_RULES]
    return spans.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"))
