import os
import re

from pyspark.sql import functions as F

from airshed.llm import line_runs

from .conftest import rows_of

SPACE = " \t\n\x0b\x0c\r"


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))


def plain_dedup(rows, min_documents=3):
    """(doc_id, kept text, lines dropped) of (doc_id, text) rows."""
    holders = {}
    for doc, text in rows:
        if doc is None:
            continue
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 20:
                holders.setdefault(key_of(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(holders.get(key_of(x), ())) < min_documents
                or max(holders[key_of(x)]) == doc]
        out.append((doc, "\n".join(kept), len(lines) - len(kept)))
    return out


def texts():
    a, b, c = "A line that comes back often", "  Zeile mit Ümlaut, ÉCOLE und mehr \t", "short"
    return [f"{a}\n{c}\nunique one that is long enough", f"{a.upper()}\n{a}\n{c}", f"x\n \t{a}\r\n{b}", f"{b}\n{b}",
            b.replace("É", "é"), f"{b}\n{a}", f"{c}\n{c}\n", b.lower().replace("ü", "Ü").replace("é", "É"), a + " "]


def compare(got, rows):
    assert sorted(map(str, ((r.doc_id, r.kept_text, r.n_dropped) for r in got))) == sorted(map(str, plain_dedup(rows)))


def test_matches_brute_force(make, corpus):
    rows = rows_of(texts() + corpus)
    got = line_runs.dedup_lines(make(rows, clashing=True)).collect()
    compare(got, [(r[0], r[1]) for r in rows])


def test_number_of_batches_does_not_matter(make):
    rows = rows_of(texts() * 3)
    for batches in (1, 3, 9):
        compare(line_runs.dedup_lines(make(rows), batches=batches).collect(), [(r[0], r[1]) for r in rows])


def batch_of(spark, start, last_doc, n=20):
    return spark.range(start, start + n).select(
        F.col("id").alias("h1"), F.lit(0).cast("long").alias("h2"), F.lit(1).cast("long").alias("n_docs"),
        F.lit(last_doc).cast("long").alias("last_doc"))


def test_runs_hold_a_key_once_and_are_compacted(spark, tmp_dir):
    runs = line_runs.LineRuns(spark, f"{tmp_dir}/state", fanout=2, buckets=3)
    shapes = []
    for k in range(5):
        runs.add(batch_of(spark, k * 10, k))
        shapes.append([len(level) for level in runs.levels])
    assert shapes == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
    kept = [r.h1 for name in runs.names() for r in runs._open(name).collect()]
    assert sorted(kept) == list(range(60))
    counts = {r.h1: (r.n_docs, r.last_doc) for r in runs.keys().collect()}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run")]
    assert counts[5] == (1, 0) and counts[15] == (2, 1) and counts[45] == (2, 4) and counts[55] == (1, 4)
    assert sorted(os.listdir(f"{tmp_dir}/state")) == sorted([*runs.names(), "manifest-00000005", ".manifest-00000005.crc"])


def test_a_later_job_opens_the_state(spark, make, tmp_dir):
    rows = rows_of(texts() * 2)
    first, second = rows[:7], rows[7:]
    line_runs.dedup_lines(make(first), state=f"{tmp_dir}/state", batches=2).count()
    again = line_runs.LineRuns(spark, f"{tmp_dir}/state")
    assert again.version == 2 and len(again.names()) == 1
    got = {r.doc_id: (r.kept_text, r.n_dropped) for r in
           line_runs.dedup_lines(make(second), state=f"{tmp_dir}/state", batches=2).collect()}
    whole = {doc: (text, n) for doc, text, n in plain_dedup([(r[0], r[1]) for r in rows])}
    assert got == {doc: whole[doc] for doc in got} and len(got) == len(second)


def test_the_verdict_needs_the_merge(make, monkeypatch):
    """Known keys would keep their first count, and lines that are in three documents would stay."""
    rows = rows_of(texts())
    monkeypatch.setattr(line_runs.LineRuns, "updated", staticmethod(lambda run, batch: run))
    without = line_runs.dedup_lines(make(rows)).collect()
    assert sorted(r.n_dropped for r in without) != sorted(n for _, _, n in plain_dedup([(r[0], r[1]) for r in rows]))


def test_the_runs_need_the_anti_join(spark, tmp_dir, monkeypatch):
    """Keys would stand in two runs and be counted on in both."""
    monkeypatch.setattr(line_runs.LineRuns, "fresh", lambda self, batch: batch)
    runs = line_runs.LineRuns(spark, f"{tmp_dir}/state", fanout=2, buckets=3)
    for k in range(2):
        runs.add(batch_of(spark, 0, k))
    rows = runs.keys().collect()
    assert len(rows) == 40 and len({r.h1 for r in rows}) == 20


def test_runs_are_joined_without_an_exchange(spark, tmp_dir):
    runs = line_runs.LineRuns(spark, f"{tmp_dir}/state", fanout=9, buckets=3)
    runs.add(batch_of(spark, 0, 0))
    batch = runs._open(runs._write(batch_of(spark, 10, 1)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [df._jdf.queryExecution().executedPlan().toString()
                 for df in (runs.fresh(batch), runs.updated(runs.keys(), batch))]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("SortMergeJoin" in p and "Exchange" not in p for p in plans)


def test_a_text_of_very_many_lines(spark):
    often = "a line that many documents hold"
    lines = F.transform(F.sequence(F.lit(0), F.lit(199_999)), lambda k: F.when(k % 3 == 0, F.lit(often)).otherwise(
        F.concat(F.lit("line number "), k.cast("string"), F.lit(" of the long text"))))
    docs = spark.range(4).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 3, F.lit(often)).otherwise(
        F.array_join(lines, "\n")).alias("text")).coalesce(1)
    out = line_runs.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.length("kept_text").alias("n"), F.substring("kept_text", 1, 40).alias("head"))
    got = {r.doc_id: tuple(r)[1:] for r in out.collect()}
    assert got[0] == got[1] == (200_000, 200_000, 0, "") and got[3] == (1, 0, len(often), often)
    kept = [f"line number {k} of the long text" for k in range(200_000) if k % 3]
    assert got[2] == (200_000, 66_667, len("\n".join(kept)), "\n".join(kept)[:40])


def test_odd_rows(make, odd_rows):
    rows = odd_rows + [(8, odd_rows[5][1], "en", "s", 0), (None, odd_rows[5][1], "en", "s", 0)]
    got = line_runs.dedup_lines(make(rows, clashing=True)).collect()
    compare(got, [(r[0], r[1]) for r in rows])
    assert {r.doc_id: r.n_lines for r in got}[1] == 1


def test_empty_table(make):
    assert line_runs.dedup_lines(make([])).collect() == []
