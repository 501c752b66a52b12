import hashlib
import random
import re

import pytest

from airshed.llm import queries, secret_scan
from airshed.llm.automaton import CombinedAutomaton

from .conftest import rows_of

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 16]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]


def noisy_texts(n=400):
    rng = random.Random(3)
    parts = ["password", "PassWD", "secret", "token", "api_key", "apikey", "=", ":", " ", "  ", '"', "'", "==", "abcdef012345",
             "0123456789abcdef", "AKIA", "AKIAAKIA", "ABCDEFGH12345678", "A-b_c.d/e+f=", "é", "日本", "\n", "x", "secretoken",
             "deadbeefdeadbeefdead", "ghp_" + "a1" * 20, "eyJhbGci.eyJzdWIi.c2lnbmF0dXJl", "-----BEGIN RSA PRIVATE KEY-----"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def scanner():
    return secret_scan.Scanner(secret_scan.BASE_RULES + secret_scan.MORE_RULES)


def test_base_spans_match_regular_expressions(scanner, corpus):
    base = {r.kind for r in secret_scan.BASE_RULES}
    for text in [*noisy_texts(), *corpus]:
        got = [(s["kind"], s["start"], s["end"]) for s in scanner.spans(text) if s["kind"] in base]
        assert got == plain_spans(text), text


def test_more_rules(scanner):
    text = "x ghp_" + "z1" * 18 + " y -----BEGIN RSA PRIVATE KEY----- z xoxb-1234567890ab sk_live_ABCDEFGHIJKLMNOP"
    assert [s["kind"] for s in scanner.spans(text)] == ["github", "pem", "slack", "stripe"]
    assert [text[s["start"]:s["end"]] for s in scanner.spans(text)][1] == "-----BEGIN RSA PRIVATE KEY-----"


@pytest.mark.parametrize("pattern", ["ab+", "(a|bc)+d", "a{2,3}", "x[0-9]{3,}", "[^a ]b?c", "a?b?c+"])
def test_automaton_finds_what_a_search_finds(pattern):
    rng = random.Random(1)
    automaton = CombinedAutomaton([(pattern, False)])
    for _ in range(300):
        text = "".join(rng.choices("abcdx019 ", k=rng.randint(0, 25)))
        expected, at = [], 0
        while at < len(text):  # leftmost, then longest
            ends = [e for e in range(len(text), at, -1) if re.fullmatch(pattern, text[at:e])]
            if ends:
                expected.append((at, 0, ends[0]))
                at = ends[0]
            else:
                at += 1
        assert automaton.matches(text.encode()) == expected, (pattern, text)


def test_minimisation_keeps_fewer_states(scanner):
    assert scanner.automaton.n_states < scanner.automaton.n_subsets


def test_refused_patterns():
    for pattern in ("a*", "(ab", "a.b", "(ab)+"):
        with pytest.raises(ValueError):
            CombinedAutomaton([(pattern, False)])


def test_query_digest(spark, make, odd_rows, tmp_path):
    rows = rows_of(noisy_texts(60), start=100) + odd_rows
    make(rows, clashing=True).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.queries()["op2_secret_scan"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for row in got:
        if row.doc_id is None:
            continue
        spans = plain_spans(texts[row.doc_id] or "")
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        assert set(listed.split(",")) - {""} <= set(row.spans.split(","))


def test_empty_table(make):
    assert secret_scan.secret_spans(make([])).collect() == []
