import random

import pytest

# Names that the operators use inside; an input may have columns of these names.
CLASHING = ["fp", "words", "line", "h1", "block", "kind", "row", "rank", "hash", "root", "spans", "n_lines", "kept_text",
            "component_id", "n_entities", "text_hash", "gone", "id", "shingle", "item_id", "kept", "label"]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(texts, start=0):
    return [(start + k, t, "en", "src", None if t is None else len(t)) for k, t in enumerate(texts)]


@pytest.fixture()
def make(spark):
    """A documents table of (doc_id, text, lang, source, n_chars) rows, on request with clashing columns."""
    def build(rows, clashing=False):
        df = spark.createDataFrame(rows, COLUMNS).repartition(3)
        if clashing:
            for name in CLASHING:
                df = df.withColumn(name, df.text)
        return df
    return build


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared lines and passages, from a fixed seed."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdeéñß", k=rng.randint(1, 7))) for _ in range(300)]

    def prose(n):
        out = []
        for _ in range(n):
            out.append(rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", "\n"]))
        return " ".join(out)

    texts = [prose(rng.randint(1, 160)) for _ in range(40)]
    shared = prose(40)
    texts += [prose(30) + "\n" + shared + "\n" + prose(20) for _ in range(6)]
    texts += [texts[3], texts[3], texts[5]]
    for k in (0, 1, 2):
        words = texts[10 + k].split(" ")
        words[len(words) // 2] = "changed"
        texts += [" ".join(words), " ".join(words).upper()]
    texts += ["x" * 5000, ("ab " * 2000), prose(3000)]
    return texts


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, white space, null and repeated ids, repeated rows, a null language."""
    return [(1, None, "en", None, None), (2, "", "en", "s", 0), (3, " \t\n\r ", None, "s", 5), (None, "no id here", "en", "s", 10),
            (4, "one", None, None, 3), (5, "same text in two rows with one id", "en", "s", 1),
            (5, "same text in two rows with one id", "en", "s", 1), (6, "same text in two rows with one id", "en", "s", 1),
            (7, "a\n\n\nb\x0bc\x1fd", "xx", "s", 9), (None, None, None, None, None)]
