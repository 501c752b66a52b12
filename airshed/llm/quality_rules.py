"""Quality rules: repetition and length rules, and the divergence of a text from its language's reference.

A document's features come from its whole text in one pass of column expressions, without a shuffle. They hold a
histogram of character classes and one of common words (each listed word, and all others). A language's reference is the
sum of the histograms of its documents that pass the base rules and are long enough, over all documents of the corpus.
The verdict compares a document with the reference of its own language by Jensen-Shannon distance (base 2, from 0 to
1): a text that is long enough for a histogram to mean something and lies farther off than the limit is rejected. The
word histogram needs a least number of words; shorter texts are not judged by it. A text in several languages is far
from each of their references, yet holds as many common words as they do; by words only a text that also lacks them is
rejected. That share carries the verdict of a short text, whose distance is large by chance alone; both limits allow for
the number of words.

Repeated windows are found by 64-bit hashes of their five words; a chance collision inside one document would have to
hit two of its windows.

Nulls and odd rows: a null text has no words and fails the base rules. A null language is a language of its own. Each
input row gives a row, also with a null or repeated doc_id. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import let, stage, table, words_of

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW_WORDS = 5
MIN_CHARS_JUDGED = 300
MIN_WORDS_JUDGED = 45
MAX_CHAR_DISTANCE = 0.33
MAX_WORD_DISTANCE = 0.20
MIN_COMMON_SHARE = 0.5  # of the reference's share of common words
WORD_ALLOWANCE = 1  # over the number of words: what chance adds to the distance of a short text
SHARE_ALLOWANCE = 6  # over the number of words: what chance takes from the share of a short text

# Common words of the four languages of the corpus, by language.
COMMON_WORDS = list(dict.fromkeys("""
    the of and to a in is that it for was on with as be
    de la que el en y los se del las un por con no una
    le et les des du une est pour par dans avec qui pas sur
    der die und den von zu das sich mit auf für ist im nicht
""".split()))
CHAR_CLASSES = ["small", "capital", "digit", "space", "mark", "symbol", "other"]


def _repeated_windows(words: Column, n: int) -> Column:
    """Words covered by windows of ``n`` words that occur twice or more."""
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1)))

    def hashed(w: Column) -> Column:
        return F.transform(starts, lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(n)]))

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(placed, lambda s: let(F.array_sort(F.transform(F.filter(s, lambda x, i: F.coalesce(
            (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]),
            (F.get(s, i - 1)["h"] == x["h"]), (F.get(s, i + 1)["h"] == x["h"]), F.lit(False))), lambda x: x["i"])),
            _covered_words(n)))

    return F.coalesce(let(hashed(words), lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0))), F.lit(0))


def _covered_words(n: int):
    """Words that windows at ascending places cover together."""
    def total(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("total"), F.lit(-n).alias("last"))
        return F.aggregate(places, start, lambda acc, at: F.struct(
            (acc["total"] + F.least(F.lit(n), at - acc["last"])).alias("total"), at.alias("last")),
            lambda acc: acc["total"])
    return total


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """A row per row: ``doc_id, lang, text_hash``, the base counts, ``chars`` and ``common`` (the two histograms)."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    split = texts.select("doc_id", "lang", "text", F.xxhash64("text").alias("text_hash"),
                         words_of(F.col("text")).alias("words"),
                         F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
                         F.regexp_replace("text", "[a-z]+", "").alias("rest"))
    # what is left after the commonest class goes is short, so the other classes cost little
    counted = split.select(
        "doc_id", "lang", "text_hash", "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.filter("words", lambda w: w.isin(COMMON_WORDS)).alias("found"),
        F.length("text").alias("n_chars"), F.length("rest").alias("n_rest"),
        F.regexp_replace("rest", r"[\x20\x09-\x0D]+", "").alias("rest"))
    classed = counted.select(
        "*", (F.col("n_rest") - F.length("rest")).alias("space"),
        _without("A-Z").alias("capital"), _without("0-9").alias("digit"),
        _without(r"#*$%&|<>").alias("symbol"), _without(r"!\"'()+,./:;=?@\[\\\]^_`{}~-").alias("mark"))
    ascii_classes = ["space", "capital", "digit", "symbol", "mark"]
    other = F.length("rest")
    for c in ascii_classes[1:]:
        other = other - F.col(c)
    values = {"small": F.col("n_chars") - F.col("n_rest"), "other": other} | {c: F.col(c) for c in ascii_classes}
    per_word = [(F.size("found") - F.size(F.array_remove("found", w))).cast("long") for w in COMMON_WORDS]
    return classed.select(
        "doc_id", "lang", "text_hash", "n_words", "word_chars", F.col("symbol").cast("long").alias("n_symbols"),
        "n_dup_lines",
        _repeated_windows(F.col("words"), WINDOW_WORDS).cast("long").alias("n_repeat_words"),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.array(*[values[c].cast("long") for c in CHAR_CLASSES]).alias("chars"),
        F.array(*per_word, (F.col("n_words") - F.size("found")).cast("long")).alias("common"))


def _without(chars: str) -> Column:
    """How many of the characters the rest holds."""
    return F.length("rest") - F.length(F.regexp_replace("rest", f"[{chars}]+", ""))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | \
        (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def _entropy_term(p: Column) -> Column:
    return F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0))


def js_distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance of two histograms (arrays of counts of the same length); null if one is empty."""
    def shares(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x)
        return let(total, lambda t: F.when(t > 0, F.transform(counts, lambda x: x / t)))

    terms = F.zip_with(shares(a), shares(b), lambda p, q: (
        _entropy_term(p) + _entropy_term(q)) / 2 - _entropy_term((p + q) / 2))
    divergence = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.when(divergence < 0, F.lit(0.0)).otherwise(divergence))  # rounding can leave it just below zero


def references(rows: DataFrame) -> DataFrame:
    """``(lang, ref_chars, ref_common)``: the summed histograms of a language's documents that pass the base rules."""
    usable = rows.where(~base_failed() & (F.col("n_chars") >= MIN_CHARS_JUDGED))
    return usable.groupBy("lang").agg(
        F.array(*[F.sum(F.col("chars")[k]) for k in range(len(CHAR_CLASSES))]).alias("ref_chars"),
        F.array(*[F.sum(F.col("common")[k]) for k in range(len(COMMON_WORDS) + 1)]).alias("ref_common")) \
        .withColumnRenamed("lang", "ref_lang")


def _common_share(counts: Column) -> Column:
    """The share of listed words in a word histogram; null if it is empty."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x)
    return let(total, lambda t: F.when(t > 0, 1 - F.element_at(counts, -1) / t))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang") -> DataFrame:
    """The base counts, ``base_failed, kept, char_distance, word_distance`` and ``common_share`` of every row.

    Columns: ``doc_id, lang, text_hash, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and these;
    common_share is relative to the reference's.
    """
    rows = stage(features(docs, id_col, text_col, lang_col), "quality-features")
    judged = rows.join(references(rows), F.col("lang").eqNullSafe(F.col("ref_lang")), "left").select(
        "doc_id", "lang", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        F.when(F.col("n_chars") >= MIN_CHARS_JUDGED, js_distance(F.col("chars"), F.col("ref_chars")))
        .alias("char_distance"),
        F.when(F.col("n_words") >= MIN_WORDS_JUDGED, js_distance(F.col("common"), F.col("ref_common")))
        .alias("word_distance"),
        F.try_divide(_common_share(F.col("common")), _common_share(F.col("ref_common"))).alias("common_share"))
    far_chars = F.coalesce(F.col("char_distance") > MAX_CHAR_DISTANCE, F.lit(False))
    far_words = F.coalesce((F.col("word_distance") > MAX_WORD_DISTANCE + WORD_ALLOWANCE / F.col("n_words"))
                           & (F.col("common_share") < MIN_COMMON_SHARE - SHARE_ALLOWANCE / F.col("n_words")),
                           F.lit(False))
    found = ["char_distance", "word_distance", "common_share"]
    return judged.select(*[c for c in judged.columns if c not in found],
                         (~(F.col("base_failed") | far_chars | far_words)).alias("kept"), *found)


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep; a verdict belongs to a row's id, language and text."""
    gone = quality_verdicts(docs, id_col, text_col, lang_col).where("not kept") \
        .select("doc_id", "lang", "text_hash").distinct().alias("gone")
    row = {c: F.col(f"row.`{c}`") for c in (id_col, text_col, lang_col)}
    same = row[id_col].cast("long").eqNullSafe(F.col("gone.doc_id")) & \
        row[lang_col].cast("string").eqNullSafe(F.col("gone.lang")) & \
        (F.xxhash64(F.coalesce(row[text_col], F.lit(""))) == F.col("gone.text_hash"))
    return docs.alias("row").join(gone, same, "left_anti")


def q_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents")).drop("lang", "text_hash")
