import hashlib
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from airshed.llm import bpe_stream

from .test_decontam import plain_find
from .test_line_runs import plain_dedup
from .test_quality_rules import junk, plain_verdicts
from .test_simhash import plain_components, plain_fingerprint

ITEM_SCHEMA = "item_id long, text string"


def plain_pipeline(rows, items):
    """{doc_id: (n_tokens, ids digest, text digest)} by plain Python, for rows (doc_id, text, lang, source, n_chars)."""
    rows = [r for r, (_, _, ok) in zip(rows, plain_verdicts(rows)) if ok]
    rows = [(doc, text) for doc, text, _ in plain_dedup([(r[0], r[1]) for r in rows])]
    groups = plain_components({d: plain_fingerprint(t) for d, t in rows})
    rows = [(d, t) for d, t in rows if groups[d] == d]
    held = {d for d, *_ in plain_find(rows, items)}
    library, out = Tokenizer.from_file(bpe_stream.word_vocabulary()), {}
    for doc, text in rows:
        if doc not in held:
            ids = library.encode(text, add_special_tokens=False).ids
            out[doc] = (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                        hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    return out


@pytest.fixture()
def tables(spark, make, tmp_path):
    def write(rows, items, clashing=False):
        make(rows, clashing).write.parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame(items, ITEM_SCHEMA).write.parquet(str(tmp_path / "benchmark.parquet"))
        return str(tmp_path)
    return write


def test_matches_plain_version(spark, tables, corpus):
    items = [(0, " ".join(corpus[0].split()[:25])), (1, " ".join(corpus[7].split()[3:30])), (2, "nowhere to be found in it")]
    line = "a line that is in many documents of this corpus"
    texts = corpus + junk(corpus) + [f"{line}\n{t}" for t in corpus[20:26]] + [f"before {items[1][1]} after {corpus[30]}"]
    rows = [(k, t, ("en", "fr")[k % 2], "s", len(t)) for k, t in enumerate(texts)]
    got = corpus_pipeline.run(spark, tables(rows, items)).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == plain_pipeline(rows, items)
    assert len(got) < len(rows)


def test_stages_keep_columns_and_survive_odd_rows(spark, tables, odd_rows, corpus):
    rows = odd_rows + [(None, corpus[50], "en", "s", 0), (30, corpus[50], "en", "s", 0), (31, corpus[50], "en", "s", 0)]
    path = tables(rows, [(None, None), (1, ""), (2, None)], clashing=True)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, path)
        assert out.columns == docs.columns, name
        docs = out
    kept = sorted(str(r.doc_id) for r in docs.collect())
    assert kept == ["30", "None"]  # the copy 31 goes; a row without an id is compared with nothing
    assert corpus_pipeline.STAGES[-1][1](spark, docs, path).count() == 2


def test_rows_without_an_id_are_searched_for_items(spark, make, tables, corpus):
    item = " ".join(corpus[7].split()[3:30])
    rows = [(None, f"before {item} after", "en", "s", 0), (None, corpus[30], "en", "s", 0), (None, None, "en", "s", 0),
            (1, f"lead {item} out", "en", "s", 0), (2, corpus[31], "en", "s", 0)]
    path = tables(rows, [(1, item)])
    got = corpus_pipeline.decontamination_stage(spark, make(rows, clashing=True), path)
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == sorted(
        (str(r[0]), str(r[1])) for r in (rows[1], rows[2], rows[4]))


def test_empty_tables(spark, tables):
    assert corpus_pipeline.run(spark, tables([], [])).collect() == []


def test_stage_order():
    assert [re.split(" ", n)[0] for n, _ in corpus_pipeline.STAGES] == ["quality", "line", "SimHash", "benchmark", "BPE"]
