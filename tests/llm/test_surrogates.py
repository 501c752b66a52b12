import hashlib
import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from airshed.llm import surrogates

from .conftest import rows_of

TEXTS = [
    "Write to anna.b@mail.example.com or ANNA.B@MAIL.EXAMPLE.COM, phone +1 (017) 555-7713.",
    "Herr Müller and Mr. Smith met Mary Smith; Frau Smith called 017 555 7713 from 10.1.2.3.",
    "Card 4539578763621486 or 4539 5787 6362 1486, not 4539578763621487; ssn 123-45-6789, again 123-45-6789.",
    "господин Иванов и госпожа Иванова, also MR. SMITH. anna.b@mail.example.com",
    "nothing personal: 12.5 percent, v1.2.3, 2024-01-02, id 12345, a@b, token 4539578763621486abc",
    "Dr. Kim Lee, Dr. Lee",
]


def replaced(make, texts, key="k", clashing=False):
    out = surrogates.replace_personal_data(make(rows_of(texts), clashing=clashing), key)
    return {r.doc_id: (r.text, r.n_entities) for r in out.collect()}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def test_replacements_are_consistent_and_typed(make):
    got = replaced(make, TEXTS, clashing=True)
    text = {k: t for k, (t, _) in got.items()}
    for k in (0, 1, 2, 3, 5):
        for value in ("anna.b@", "555-7713", "Müller", "Smith", "4539578763621486 ", "123-45-6789", "Иванов", "10.1.2.3",
                      "Lee", "SMITH"):
            assert value not in text[k]
    mail = re.findall(r"\S+@\S+\.com", text[0])
    assert len(mail) == 1 + 1 or mail[0].endswith(".com")
    first = re.search(r"Write to (\S+) or (\S+),", text[0])
    assert first[1].upper() == first[2] and first[1].endswith(".com")  # format kept, same entity
    assert text[3].endswith(first[1])
    assert re.search(r"phone \+1 \(\d{3}\) \d{3}-\d{4}\.", text[0])

    family = re.search(r"^Herr (\S+) and Mr\. (\S+) met (\S+) (\S+); Frau (\S+) called", text[1])
    assert family[2] == family[4] == family[5] != family[1]
    women = {n for (s, g), names in surrogates.GIVEN.items() if g == "f" and s == "latin" for n in names}
    assert family[3] in women and family[3] != "Mary"
    assert f"MR. {family[2].upper()}." in text[3]
    assert re.search(r"господин [А-Яа-я]+ и госпожа [А-Яа-я]+", text[3])

    cards = re.search(r"Card (\d{16}) or (\d{4} \d{4} \d{4} \d{4}), not (\d{16}); ssn (\d{3}-\d\d-\d{4}), again (\S+)\.", text[2])
    assert cards[1] == cards[2].replace(" ", "") and luhn(cards[1]) and cards[1][0] == "4"
    assert cards[3] != cards[1] and cards[4] == cards[5] and cards[4][0] == "9"
    assert text[4] == TEXTS[4] and got[4][1] == 0
    lee = re.search(r"^Dr\. \S+ (\S+), Dr\. (\S+)$", text[5])
    assert lee[1] == lee[2]


def test_key_decides(make):
    assert replaced(make, TEXTS) == replaced(make, TEXTS)
    assert replaced(make, TEXTS, "k")[0] != replaced(make, TEXTS, "other")[0]


def test_entities_stay_distinct(make):
    texts = [f"{k % 10}@m.example.com and {k}.{k}@m.example.com and Mr. {a}{b}en x Mary {a}{b}on" for k, (a, b) in
             enumerate((a, b) for a in "ABCDEFGHIJKL" for b in "abcdefghij")]
    texts += [f"{n} Hill" for (s, g), names in surrogates.GIVEN.items() if (s, g) == ("latin", "f") for n in names]
    out = replaced(make, texts)
    before = [re.findall(r"\S+@\S+", t) + re.findall(r"(?<=Mr\. )\S+", t) for t in texts]
    after = [re.findall(r"\S+@\S+", out[k][0]) + re.findall(r"(?<=Mr\. )\S+", out[k][0]) for k in range(len(texts))]
    mapping = {}
    for old, new in zip(before, after):
        assert len(old) == len(new)
        for a, b in zip(old, new):
            assert mapping.setdefault(a, b) == b
    assert len(set(mapping.values())) == len(mapping)
    assert not set(mapping) & set(mapping.values())
    women = [out[k][0].split()[0] for k in range(len(texts) - 10, len(texts))]
    assert len(set(women)) == 10


def test_assignment_avoids_real_values(spark):
    every = [("ip", f"{a}.{b}.1.1") for a in range(11, 100) for b in range(1, 20)]
    chosen = surrogates.assign_surrogates(spark.createDataFrame(every, "kind string, canon string"), "k").collect()
    values = [r.surrogate for r in chosen]
    assert len(values) == len(set(values)) == len(every) and not set(values) & {c for _, c in every}


def test_odd_rows(make, odd_rows):
    shared = "mail x.y@z.example.org twice x.y@z.example.org"
    rows = odd_rows + [(11, shared, "en", "s", 0), (11, shared, "en", "s", 0), (11, shared + " more", "en", "s", 0),
                       (None, shared, None, None, None)]
    got = surrogates.replace_personal_data(make(rows, clashing=True), "k").collect()
    assert len(got) == len(rows)
    assert {r.text for r in got if r.doc_id == 1} == {None}
    changed = [r for r in got if r.n_entities]
    assert len(changed) == 4 and all(r.n_entities == 2 and "x.y@" not in r.text for r in changed)
    assert len({r.text.split()[1] for r in changed}) == 1
    untouched = sorted((str(r.doc_id), str(r.text)) for r in got if not r.n_entities)
    assert untouched == sorted((str(r[0]), str(r[1])) for r in odd_rows)


def test_long_text_and_empty_table(make, corpus):
    text = corpus[-1] + " a.b@c.example.net " + corpus[-1]
    assert "a.b@" not in replaced(make, [text])[0][0]
    assert surrogates.replace_personal_data(make([]), "k").collect() == []


def test_no_python_in_the_plan(make):
    out = surrogates.replace_personal_data(make(rows_of(TEXTS)), "k").select(F.col("text"))
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("text", ["1234567890123456789012345", "1.2.3.4.5", "a@", "@b.c", "+1 555", "Mr. x", "Mary had"])
def test_near_misses_stay(make, text):
    assert replaced(make, [text])[0] == (text, 0)


# --- a plain version of the whole operator ---------------------------------------------------------------------------

PIECE = regex.compile(surrogates.PATTERN.replace(r"\p{IsCyrillic}", r"\p{Cyrillic}"))
BARE = regex.compile(rf"^{surrogates._TITLE}\.? ")
LATIN, CYRILLIC = surrogates.LETTERS["latin"], surrogates.LETTERS["cyrillic"]


def draw(key, what, index):
    return int(hashlib.sha256("\x1f".join([key, what, str(index)]).encode()).hexdigest()[:12], 16)


def redrawn(key, value, what):
    out = []
    for i, c in enumerate(value, start=1):
        n = draw(key, what, i)
        out.append(str(n % 10) if c in "0123456789" else CYRILLIC[n % len(CYRILLIC)] if regex.match(r"\p{Cyrillic}", c)
                   else LATIN[n % 26] if regex.match(r"\p{L}", c) else c)
    return "".join(out)


def plain_surrogate(key, kind, canon, attempt):
    what = "\x1f".join([kind, canon, str(attempt)])
    if kind == "email":
        local, domain = canon.split("@")[0], canon.split("@")[-1]
        top = domain.split(".")[-1]
        more = "".join(LATIN[draw(key, what, i + 1000) % 26] for i in range(1, attempt + 1))
        body = redrawn(key, domain[:-len(top) - 1], "\x1fdomain" + domain)
        return f"{redrawn(key, local, what)}{more}@{body}.{top}"
    if kind == "ip":
        return ".".join(str(11 + draw(key, what, i) % 89 if i == 1 else 1 + draw(key, what, i) % 254) for i in range(1, 5))
    drawn = redrawn(key, canon, what)
    if kind == "phone":
        head = max(len(canon) - 10, 0)
        return canon[:head] + drawn[head:]
    if kind == "ssn":
        return "9" + drawn[1:]
    if kind == "card":
        front = canon[0] + drawn[1:-1]
        return front + (next(d for d in "0123456789" if luhn(front + d)) if luhn(canon) else drawn[-1])
    part, script, *gender = kind.split(":")
    syllables = surrogates.SYLLABLES[script]
    made = lambda n: "".join(syllables[draw(key, what, i) % len(syllables)] for i in range(1, n + attempt + 1))
    if part == "family":
        return made(3)
    names = surrogates.GIVEN[script, gender[0]]
    ends = surrogates.GENDER_END_CYRILLIC if script == "cyrillic" else surrogates.GENDER_END
    return names[draw(key, what, 0) % len(names)].lower() if attempt == 0 else made(1) + ends[gender[0]]


def plain_entities(mention):
    """(kind of mention, {part: (kind, canonical value)})."""
    for kind in ("email", "ip", "card", "ssn", "phone"):
        if regex.fullmatch(surrogates.PATTERNS[kind], mention):
            digits = "".join(c for c in mention if c in "0123456789")
            return kind, {"whole": (kind, digits if kind in ("card", "ssn", "phone") else mention.lower())}
    script = "cyrillic" if regex.search(r"\p{Cyrillic}", mention) else "latin"
    bare = BARE.sub("", mention)
    given, family = bare.split(" ")[0] if " " in bare else None, bare.split(" ")[-1]
    known = {n: g for (_, g), names in surrogates.GIVEN.items() for n in names if g != "n"}
    gender = known.get(given, "n")
    for g in ("m", "f"):
        if regex.match(rf"^(?:{surrogates._titles([g])})\.? ", mention):
            gender = g
    parts = {"family": (f"family:{script}", family.lower())}
    if given:
        parts["given"] = (f"given:{script}:{gender}", given.lower())
    return "name", parts


def plain_replace(texts, key):
    found = [PIECE.findall(t) for t in texts]
    real = {e for mentions in found for m in mentions for e in plain_entities(m)[1].values()}
    space = lambda kind: kind.split(":")[0]
    taken = {(space(k), c) for k, c in real}
    attempts = dict.fromkeys(real, 0)
    while True:
        chosen = {e: plain_surrogate(key, *e, n) for e, n in attempts.items()}
        first = {}
        for (kind, canon), value in chosen.items():
            claim = (attempts[kind, canon], kind, canon)
            first[space(kind), value] = min(first.get((space(kind), value), claim), claim)
        again = [e for e, value in chosen.items() if (space(e[0]), value) in taken
                 or first[space(e[0]), value] != (attempts[e], *e)]
        if not again:
            break
        for e in again:
            attempts[e] += 1

    def render(mention):
        kind, parts = plain_entities(mention)
        new = {p: chosen[e] for p, e in parts.items()}
        if kind in ("card", "ssn", "phone"):
            digits = iter(new["whole"])
            return "".join(next(digits) if c in "0123456789" else c for c in mention)
        if kind == "name":
            title = (BARE.match(mention) or [""])[0]
            names = " ".join(new[p][0].upper() + new[p][1:] for p in ("given", "family") if p in new)
            return title + (names.upper() if not regex.search(r"\p{Ll}", BARE.sub("", mention)) else names)
        loud = regex.search(r"\p{Lu}", mention) and not regex.search(r"\p{Ll}", mention)
        return new["whole"].upper() if loud else new["whole"]

    return [PIECE.sub(lambda m: render(m[0]), t) for t in texts], [len(m) for m in found]


def test_matches_plain_version(make, corpus):
    rng = random.Random(11)
    pieces = ["a.b@x.example.com", "A.B@X.EXAMPLE.COM", "7@q.de", "é.9@mail-1.example.org", "10.0.0.1", "255.1.2.3",
              "4539578763621486", "4539 5787 6362 1486", "3782-822463-10005", "1111111111111111", "123-45-6789",
              "+1 (017) 555-7713", "017 555 7713", "+49 030 555-1234", "Mr. Smith", "MRS. ANNA SMITH", "Mary Smith",
              "Mary O’Neil", "Dr Kim Lee", "господин Иванов", "Анна Иванова", "Herr Müller", "Frau Müller", "no match 12"]
    pieces += [f"{k}@q.de" for k in range(10)] + [f"{n} Hill" for n in surrogates.GIVEN["latin", "m"]]
    texts = [" ".join(rng.choices(pieces, k=rng.randint(0, 9))) + "\n" + rng.choice(corpus)[:200] for _ in range(60)] + TEXTS
    expected, counts = plain_replace(texts, "key")
    got = replaced(make, texts, "key")
    for k, text in enumerate(expected):
        assert got[k] == (text, counts[k])
