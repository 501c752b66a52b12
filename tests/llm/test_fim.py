import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from airshed.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_row(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n, form = len(units), "plain"
    if doc_id is not None:
        digest = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
        if text and not re.search("<[PSM]>", text) and h3 % 100 < 50:
            form = "spm" if h4 % 100 < 80 else "psm"
    if form == "plain":
        return doc_id, n, form, None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    output = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, form, len(prefix), len(middle), output


@pytest.fixture(scope="module")
def texts(corpus):
    rng = random.Random(6)
    parts = [" ", "\n", "\t", "\x0b", "\r", "a", "é", "日本", "𝄞", "\x1f", "\x85", " ", "<", "P", "S>", ">", "M", "word", "<P", "<S>"]
    return corpus + ["".join(rng.choices(parts[:-1], k=rng.randint(0, 30))) for _ in range(400)] + [
        "".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(40)] + ["", " ", "x", "<", "<<S", ">>", "<P><S><M>"]


@pytest.mark.parametrize("block", [1, 2, 7, 1 << 20])
def test_blocks_do_not_matter(texts, block):
    texts = [t for t in texts if len(t) < 400]
    rng = np.random.default_rng(1)
    draws = rng.integers(0, 1 << 32, (len(texts), 4))
    column = pa.array(texts)
    whole, some = (fim.transform(column, draws, block=size) for size in (1 << 20, block))
    assert all(np.array_equal(a, b) for a, b in zip(whole[:3], some[:3])) and whole[3].equals(some[3])
    assert fim.restore(some[3], some[1], block=block).to_pylist() == texts
    assert {"plain", "psm", "spm"} == {fim.FORMS[k] for k in whole[1]}


def test_a_slice_of_a_column(texts):
    column = pa.array(["skipped", *texts, "left out"]).slice(1, len(texts))
    draws = np.random.default_rng(3).integers(0, 1 << 32, (len(texts), 4))
    n, form, _, output = fim.transform(column, draws, fim_percent=100)
    assert n.tolist() == [len(UNIT.findall(t)) for t in texts]
    assert fim.restore(output, form).to_pylist() == texts
    assert all((form[k] == fim.PLAIN) == (not t or bool(re.search("<[PSM]>", t))) for k, t in enumerate(texts))


def test_documents_equal_the_plain_version(make, texts, odd_rows):
    rows = [(k + 100, t, "en", "s", 0) for k, t in enumerate(texts)] + odd_rows
    made = fim.fim_documents(make(rows, clashing=True))
    assert sorted(map(tuple, made.collect()), key=str) == sorted((plain_row(r[0], r[1]) for r in rows), key=str)
    back = fim.restored_documents(made)
    assert back.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "restored"]
    assert sorted((str(r.doc_id), r.restored) for r in back.collect()) == sorted((str(r[0]), r[1] or "") for r in rows)


def test_query_digests(spark, make, texts, tmp_dir):
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)]
    make(rows).write.parquet(f"{tmp_dir}/t/documents.parquet")
    got = fim.q_fill_in_middle(spark, f"{tmp_dir}/t")
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert sorted(map(tuple, got.collect())) == [
        (*plain_row(r[0], r[1])[:5], digest(plain_row(r[0], r[1])[5]), digest(r[1])) for r in rows]


def test_an_output_that_was_tampered_with_is_refused():
    for output in ("<P>a<M>b<S>c", "<S>a<P>b", "a", "<S>a<S>a<P>b<M>c"):
        with pytest.raises(ValueError):
            fim.restore(pa.array([output]), np.array([fim.SPM]))


def test_a_very_long_text(make):
    text = "wörd \n" * 1_500_000
    rows = fim.fim_documents(make([(k, text, "en", "s", 0) for k in range(3)]), fim_percent=100)
    assert all(r.restored == text for r in fim.restored_documents(rows).collect())


def test_empty_table(make):
    assert fim.restored_documents(fim.fim_documents(make([]))).collect() == []
