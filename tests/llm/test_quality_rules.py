import math
import random
import re

import pytest
from pyspark.sql import functions as F

from airshed.llm import quality_rules as q

from .conftest import COLUMNS, rows_of

CLASSES = [("small", "a-z"), ("capital", "A-Z"), ("digit", "0-9"), ("space", r"\x20\x09-\x0D"),
           ("mark", r"!\"'()+,./:;=?@\[\\\]^_`{}~-"), ("symbol", r"#*$%&|<>")]


def plain_features(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for k in range(len(words) - 4):
        windows.setdefault(tuple(words[k:k + 5]), []).append(k)
    covered = {k + j for places in windows.values() if len(places) > 1 for k in places for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars = [len(re.findall(f"[{c}]", text)) for _, c in CLASSES]
    common = [words.count(w) for w in q.COMMON_WORDS]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": chars[-1],
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_chars": len(text),
            "chars": [*chars, len(text) - sum(chars)], "common": [*common, len(words) - sum(common)]}


def plain_distance(a, b):
    if not sum(a) or not sum(b):
        return None
    total = 0.0
    for x, y in zip(a, b):
        p, r = x / sum(a), y / sum(b)
        for share in (p, r):
            if share:
                total += share * math.log2(share / ((p + r) / 2)) / 2
    return math.sqrt(max(total, 0))


def plain_verdicts(rows):
    feats = [(r[2], plain_features(r[1])) for r in rows]
    failed = [f["n_words"] < 10 or 100 * f["n_repeat_words"] > 20 * f["n_words"] for _, f in feats]
    refs = {}
    for (lang, f), bad in zip(feats, failed):
        if not bad and f["n_chars"] >= q.MIN_CHARS_JUDGED:
            ref = refs.setdefault(lang, ([0] * len(f["chars"]), [0] * len(f["common"])))
            for total, part in zip(ref, (f["chars"], f["common"])):
                total[:] = [x + y for x, y in zip(total, part)]
    out = []
    for (lang, f), bad in zip(feats, failed):
        far = False
        if lang in refs and f["n_chars"] >= q.MIN_CHARS_JUDGED:
            far |= (plain_distance(f["chars"], refs[lang][0]) or 0) > q.MAX_CHAR_DISTANCE
        if lang in refs and f["n_words"] >= q.MIN_WORDS_JUDGED:
            ref = refs[lang][1]
            share, wanted = 1 - f["common"][-1] / f["n_words"], 1 - ref[-1] / sum(ref)
            far |= ((plain_distance(f["common"], ref) or 0) > q.MAX_WORD_DISTANCE + q.WORD_ALLOWANCE / f["n_words"]
                    and wanted > 0 and share / wanted < q.MIN_COMMON_SHARE)
        out.append((f, bad, not bad and not far))
    return out


def junk(corpus):
    return [" ".join(w.upper() + "!!" for w in corpus[1].split()) * 3, "a b c d e " * 10, "x1 " * 9, "1 2 3 4 5 6 7 8 9 10",
            " | ".join(corpus[2].split()), "line one is here\nline one is here\n\n  \n\nline two", "%$# &&& ***" * 40,
            "one two three four five six one two three four five seven eight nine ten eleven twelve"]


def test_matches_plain_version(make, corpus):
    texts = corpus + junk(corpus)
    rows = [(k, t, ("en", "fr", None)[k % 3], "s", 0) for k, t in enumerate(texts)]
    got = {r.doc_id: r for r in q.quality_verdicts(make(rows, clashing=True)).collect()}
    assert len(got) == len(rows)
    for k, (f, failed, kept) in enumerate(plain_verdicts(rows)):
        row = got[k].asDict()
        for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
            assert row[name] == f[name], (k, name)
        assert (row["base_failed"], row["kept"]) == (failed, kept), k


def test_two_languages_are_kept_and_a_text_without_common_words_is_not(make):
    rng = random.Random(5)
    own = {"en": "the of and to a in is that it for".split(), "fr": "de la le et les des un du une est".split()}

    def prose(lang, n):
        made = ["".join(rng.choices("aeilnorst", k=6)) for _ in range(400)]
        return " ".join(rng.choice(own[lang]) if rng.random() < .3 else rng.choice(made) for _ in range(n))

    rows = [(k, prose(lang, 300), lang, "s", 0) for k, lang in enumerate(["en", "fr"] * 20)]
    rows += [(100, prose("en", 200) + " " + prose("fr", 250), "en", "s", 0), (101, prose("fr", 300), "en", "s", 0),
             (102, " ".join("".join(rng.choices("aeilnorst", k=6)) for _ in range(300)), "en", "s", 0)]
    got = {r.doc_id: r for r in q.quality_verdicts(make(rows)).collect()}
    assert [k for k, r in got.items() if not r.kept] == [102]
    assert got[101].word_distance > 0.4  # far, but made of common words


def test_short_fragments_without_common_words_go_and_short_prose_stays(make):
    rng = random.Random(6)
    common = "the of and to a in is that it for".split()
    made = ["".join(rng.choices("aeilnorst", k=6)) for _ in range(400)]

    def prose(n, share):
        words = rng.sample(made, n - int(n * share)) + rng.choices(common, k=int(n * share))
        rng.shuffle(words)
        return words

    rows = [(k, " ".join(prose(300, .3)), "en", "s", 0) for k in range(20)]
    rows += [(100 + n, " ".join(prose(n, .3)), "en", "s", 0) for n in (45, 60, 99)]
    rows += [(200 + n, " | ".join(prose(n // 2, 0)), "en", "s", 0) for n in (60, 80, 99)]  # every bar is a word
    rows += [(400, " ".join(prose(158, .04)), "en", "s", 0), (401, " ".join(prose(270, .1)), "en", "s", 0)]
    got = q.quality_verdicts(make(rows)).collect()
    assert sorted(r.doc_id for r in got if not r.kept and not r.base_failed) == [260, 280, 299, 400, 401]
    assert not any(r.base_failed for r in got if r.doc_id < 200)


def test_histograms(make, corpus):
    rows = rows_of(corpus + junk(corpus))
    for r in q.features(make(rows)).collect():
        f = plain_features(rows[r.doc_id][1])
        by_class = dict(zip([c for c, _ in CLASSES] + ["other"], f["chars"]))
        assert r.chars == [by_class[c] for c in q.CHAR_CLASSES]
        assert r.common == f["common"]


@pytest.mark.parametrize("a,b", [([1, 0], [0, 1]), ([3, 1], [3, 1]), ([5, 2, 0], [1, 1, 1]), ([0, 0], [1, 1])])
def test_distance(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
    got = df.select(q.js_distance(F.col("a"), F.col("b"))).first()[0]
    expected = plain_distance(a, b)
    assert got == expected if expected is None else abs(got - expected) < 1e-12


def test_kept_documents_keep_their_columns(make, corpus, odd_rows):
    rows = odd_rows + rows_of(corpus + junk(corpus), start=100)
    docs = make(rows, clashing=True)
    kept = q.kept_documents(docs)
    assert kept.columns == docs.columns
    expected = [r[:2] for r, (_, _, ok) in zip(rows, plain_verdicts(rows)) if ok]
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, expected))


def test_odd_rows_and_empty_table(spark, make, odd_rows):
    got = q.quality_verdicts(make(odd_rows, clashing=True)).collect()
    assert len(got) == len(odd_rows)
    assert not any(r.kept for r in got)  # all are shorter than the least number of words
    assert q.quality_verdicts(make([])).collect() == []
    assert spark.createDataFrame([], COLUMNS).count() == 0


def test_no_python_in_the_plan(make, corpus):
    plan = q.quality_verdicts(make(rows_of(corpus)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
