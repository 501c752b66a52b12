"""Personal data replaced by keyed, type-consistent surrogates.

Mentions are found by one pattern (mail and IP addresses, card, social security and phone numbers, personal names after
a title or with a known given name). A mention is taken apart into entities, each a kind and a canonical value: digits
only for numbers, lower case for addresses and names, given name and family name apart. So mentions that are written
differently but mean the same are replaced alike everywhere (coreference).

An entity's surrogate is drawn from a keyed hash of kind, value and attempt: digits for digits, letters of the same
script for letters, valid check digits on cards that had one, a country code kept, names of the same script and gender.
Collision checks run over all entities of the input: surrogates that two entities share, or that are some entity's real
value, are drawn again with the next attempt for all but the first claimant, until every entity has its own
(distinctness). The mention's format (separators, capitals, title) stays.

Everything is column expressions, joins and aggregates. Entities are joined on their value, so a very common one is a
skewed join key whose mentions Spark may split; per document only its own mentions are gathered.

Nulls and odd rows: a null text stays null and has no mentions. Rows with a null or repeated doc_id are handled like
any other: mentions belong to the (doc_id, text) they come from. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import stage, table

MAX_ATTEMPTS = 64

# Titles by gender, given names by script and gender, alphabets by script, parts of family names.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа"],
    "n": ["Dr", "Prof"],
}
GIVEN = {
    ("latin", "m"): ["James", "Robert", "Michael", "William", "David", "Thomas", "Daniel", "Carlos", "Hans", "Pierre"],
    ("latin", "f"): ["Mary", "Linda", "Susan", "Elizabeth", "Sarah", "Anna", "Maria", "Laura", "Sophie", "Ursula"],
    ("latin", "n"): ["Robin", "Alex", "Kim", "Sascha", "Dominique"],
    ("cyrillic", "m"): ["Иван", "Пётр", "Сергей", "Алексей", "Дмитрий"],
    ("cyrillic", "f"): ["Анна", "Мария", "Ольга", "Елена", "Наталья"],
    ("cyrillic", "n"): ["Саша", "Женя", "Валя"],
}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя"}
SYLLABLES = {"latin": ["bar", "den", "fol", "gan", "hol", "ker", "lun", "mar", "nor", "per", "ros", "sel", "tor", "val",
                       "wes", "zan"],
             "cyrillic": ["бар", "вол", "гор", "дан", "зор", "кон", "лук", "мар", "нов", "пет", "рос", "сол"]}
GENDER_END = {"m": "", "f": "a", "n": "i"}
GENDER_END_CYRILLIC = {"m": "", "f": "а", "n": "и"}


def _either(words) -> str:
    return "|".join(sorted(words, key=len, reverse=True))


_CAP = r"\p{Lu}[\p{L}'’-]+"


def _titles(genders) -> str:
    """Titles of the given genders, also in capitals."""
    return _either({form for g in genders for t in TITLES[g] for form in (t, t.upper())})


_TITLE = f"(?:{_titles(TITLES)})"
_KNOWN = f"(?:{_either(n for ns in GIVEN.values() for n in ns)})"
_CARD = r"(?:\d{4}[ -]?\d{6}[ -]?\d{5}|\d{4}(?:[ -]?\d{4}){3})"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "ip": r"(?<![\p{L}\p{N}.])(?:\d{1,3}\.){3}\d{1,3}(?![\p{L}\p{N}]|\.\d)",
    "card": rf"(?<![\p{{L}}\p{{N}}-]){_CARD}(?![\p{{L}}\p{{N}}-])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "phone": r"(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\p{L}\p{N}])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE}\.? {_CAP}(?: {_CAP})?|{_KNOWN} {_CAP})(?![\p{{L}}\p{{N}}])",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _kind(mention: Column) -> Column:
    """Which pattern a mention matches as a whole, in the order of listing."""
    out = F.lit("name")
    for kind in reversed([k for k in PATTERNS if k != "name"]):
        out = F.when(mention.rlike(f"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(out)
    return out


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))


def _name_parts(mention: Column) -> tuple[Column, Column, Column]:
    """``(given or null, family, gender)`` of a name mention."""
    bare = F.regexp_replace(mention, rf"^{_TITLE}\.? ", "")
    given = F.when(bare.contains(" "), F.substring_index(bare, " ", 1))
    family = F.substring_index(bare, " ", -1)
    gender = F.lit("n")
    for g in ("m", "f"):
        known = [n for (_, of), names in GIVEN.items() if of == g for n in names]
        gender = F.when(given.isin(known), F.lit(g)).otherwise(gender)
    for g in ("m", "f"):
        gender = F.when(mention.rlike(rf"^(?:{_titles([g])})\.? "), F.lit(g)).otherwise(gender)
    return given, family, gender


def mentions(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, pos, mention, kind)`` of ``(doc_id, text)``, in reading order."""
    found = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("found"))
    rows = found.select("doc_id", "text_hash", F.posexplode("found").alias("pos", "mention"))
    return rows.withColumn("kind", _kind(F.col("mention"))).dropDuplicates(["doc_id", "text_hash", "pos"])


def entities_of(found: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, pos, mention, part, kind, canon)``: the entities of every mention, names in two parts."""
    mention = F.col("mention")
    given, family, gender = _name_parts(mention)
    digits = F.regexp_replace(mention, "[^0-9]", "")
    number = F.col("kind").isin("card", "ssn", "phone")
    canon = F.when(number, digits).otherwise(F.lower(mention))
    whole = F.array(F.struct(F.lit("whole").alias("part"), F.col("kind").alias("kind"), canon.alias("canon")))
    parts = F.array(
        F.struct(F.lit("given").alias("part"), F.concat_ws(":", F.lit("given"), _script(mention), gender).alias("kind"),
                 F.lower(given).alias("canon")),
        F.struct(F.lit("family").alias("part"), F.concat_ws(":", F.lit("family"), _script(mention)).alias("kind"),
                 F.lower(family).alias("canon")))
    each = F.when(F.col("kind") == "name", F.filter(parts, lambda p: p["canon"].isNotNull())).otherwise(whole)
    return found.select("doc_id", "text_hash", "pos", "mention", F.explode(each).alias("e")) \
        .select("doc_id", "text_hash", "pos", "mention", "e.*")


# --- drawing surrogates ------------------------------------------------------------------------------------------------

def _draw(key: str, what: str, index: str) -> str:
    """SQL of a keyed number for a value and an index."""
    seed = f"concat_ws('\\u001f', {_text(key)}, {what}, cast({index} as string))"
    return f"cast(conv(substring(sha2({seed}, 256), 1, 12), 16, 10) as bigint)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _redrawn(key: str, value: str, what: str) -> str:
    """SQL: every letter and digit of a value drawn anew within its alphabet, the rest kept."""
    n, c = _draw(key, what, "i"), f"substring({value}, i, 1)"
    pick = {name: f"substring({_text(letters)}, cast(1 + {n} % {len(letters)} as int), 1)"
            for name, letters in LETTERS.items()}
    one = (f"case when {c} rlike '[0-9]' then cast({n} % 10 as string) "
           f"when {c} rlike '\\\\p{{IsCyrillic}}' then {pick['cyrillic']} "
           f"when {c} rlike '\\\\p{{L}}' then {pick['latin']} else {c} end")
    return f"if(length({value}) = 0, '', array_join(transform(sequence(1, length({value})), i -> {one}), ''))"


def _card_sum(digits: str, total: str) -> str:
    """SQL of the check sum of a digit string whose last digit stands at place ``total`` from the left."""
    d = f"cast(substring({digits}, i, 1) as int)"
    doubled = f"if(({total} - i) % 2 = 1, if({d} > 4, 2 * {d} - 9, 2 * {d}), {d})"
    return f"aggregate(transform(sequence(1, length({digits})), i -> {doubled}), 0, (s, x) -> s + x)"


def surrogate(key: str) -> Column:
    """The surrogate of ``(kind, canon, attempt)``."""
    what = "concat_ws('\\u001f', kind, canon, cast(attempt as string))"
    local, domain = "substring_index(canon, '@', 1)", "substring_index(canon, '@', -1)"
    body, top = f"substring({domain}, 1, length({domain}) - length({{0}}) - 1)", f"substring_index({domain}, '.', -1)"
    body = body.format(top)
    more = (f"if(attempt = 0, '', array_join(transform(sequence(1, attempt), i -> substring({_text(LETTERS['latin'])}, "
            f"cast(1 + {_draw(key, what, 'i + 1000')} % 26 as int), 1)), ''))")
    email = (f"concat({_redrawn(key, local, what)}, {more}, '@', "
             f"{_redrawn(key, body, f'concat({_text(chr(31) + 'domain')}, {domain})')}, '.', {top})")

    octet = _draw(key, what, "i")
    ip = (f"array_join(transform(sequence(1, 4), i -> cast(if(i = 1, 11 + {octet} % 89, 1 + {octet} % 254) as string)), "
          "'.')")

    drawn = _redrawn(key, "canon", what)
    head = "greatest(length(canon) - 10, 0)"
    phone = f"concat(substring(canon, 1, {head}), substring({drawn}, 1 + {head}))"
    ssn = f"concat('9', substring({drawn}, 2))"
    front = f"concat(substring(canon, 1, 1), substring({drawn}, 2, length(canon) - 2))"
    check = f"cast((10 - {_card_sum(front, 'length(canon)')} % 10) % 10 as string)"
    valid = f"{_card_sum('canon', 'length(canon)')} % 10 = 0"
    card = f"concat({front}, if({valid}, {check}, substring({drawn}, length(canon), 1)))"

    cases = [("kind = 'email'", email), ("kind = 'ip'", ip), ("kind = 'card'", card), ("kind = 'ssn'", ssn),
             ("kind = 'phone'", phone)]
    for script, syllables in SYLLABLES.items():
        listed = f"array({', '.join(map(_text, syllables))})"
        syllable = f"element_at({listed}, cast(1 + {_draw(key, what, 'i')} % {len(syllables)} as int))"
        made = f"array_join(transform(sequence(1, {{0}} + attempt), i -> {syllable}), '')"
        cases.append((f"kind = 'family:{script}'", made.format(3)))
        for gender in TITLES:
            names = GIVEN[script, gender]
            end = (GENDER_END_CYRILLIC if script == "cyrillic" else GENDER_END)[gender]
            first = (f"element_at(array({', '.join(_text(n.lower()) for n in names)}), "
                     f"cast(1 + {_draw(key, what, '0')} % {len(names)} as int))")
            cases.append((f"kind = 'given:{script}:{gender}'",
                          f"if(attempt = 0, {first}, concat({made.format(1)}, '{end}'))"))
    return F.expr("case " + " ".join(f"when {when} then {then}" for when, then in cases) + " end")


def assign_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, canon, surrogate)`` for the distinct ``(kind, canon)``: no surrogate is shared or a real value."""
    real = stage(entities.select("kind", "canon").distinct(), "pii-entities")
    space = F.substring_index("kind", ":", 1)  # names are kept apart across scripts and genders, too
    taken = real.select(space.alias("space"), F.col("canon").alias("surrogate")).distinct() \
        .withColumn("is_real", F.lit(True))
    drawn = real.withColumn("attempt", F.lit(0))
    for _ in range(MAX_ATTEMPTS):
        drawn = stage(drawn.withColumn("surrogate", surrogate(key)).withColumn("space", space), "pii-surrogates")
        claim = F.struct("attempt", "kind", "canon")
        first = drawn.groupBy("space", "surrogate").agg(F.min(claim).alias("first"))
        judged = drawn.join(first, ["space", "surrogate"]).join(taken, ["space", "surrogate"], "left")
        judged = judged.withColumn("redraw", (claim != F.col("first")) | F.coalesce("is_real", F.lit(False)))
        judged = stage(judged.select("kind", "canon", "attempt", "surrogate", "redraw"), "pii-judged")
        if judged.where("redraw").isEmpty():
            return judged.select("kind", "canon", "surrogate")
        drawn = judged.select("kind", "canon", (F.col("attempt") + F.col("redraw").cast("int")).alias("attempt"))
    raise RuntimeError(f"no distinct surrogates after {MAX_ATTEMPTS} attempts")


def rendered() -> Column:
    """The replacement of a mention in its own format, from ``(mention, kind, whole, given, family)``."""
    digits = ("array_join(transform(sequence(1, length(mention)), i -> if(substring(mention, i, 1) rlike '[0-9]', "
              "substring(whole, length(regexp_replace(substring(mention, 1, i), '[^0-9]', '')), 1), "
              "substring(mention, i, 1))), '')")
    bare = rf"^{_TITLE}\.? "
    title = F.regexp_extract("mention", f"({bare})", 1)
    capital = "concat(upper(substring({0}, 1, 1)), substring({0}, 2))"
    shouted = F.regexp_replace("mention", bare, "").rlike(r"^[^\p{Ll}]+$")
    names = F.concat_ws(" ", F.expr(f"if(given is null, null, {capital.format('given')})"),
                        F.expr(capital.format("family")))
    name = F.concat(title, F.when(shouted, F.upper(names)).otherwise(names))
    loud = F.col("mention").rlike(r"\p{Lu}") & ~F.col("mention").rlike(r"\p{Ll}")
    return F.when(F.col("kind").isin("card", "ssn", "phone"), F.expr(digits)) \
        .when(F.col("kind") == "name", name) \
        .when(loud, F.upper("whole")).otherwise(F.col("whole"))


def replace_personal_data(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the text's personal data replaced and ``n_entities``.

    Other columns are carried along; an input column named ``n_entities`` is replaced.
    """
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = stage(mentions(plain.select("doc_id", "text")), "pii-mentions")
    parts = entities_of(found)
    chosen = assign_surrogates(parts, key)
    replaced = parts.join(chosen, ["kind", "canon"]).groupBy("doc_id", "text_hash", "pos").agg(
        F.first("mention").alias("mention"),
        F.first(F.when(F.col("part") == "whole", F.col("kind")).otherwise("name")).alias("kind"),
        *[F.max(F.when(F.col("part") == p, F.col("surrogate"))).alias(p) for p in ("whole", "given", "family")])
    per_doc = replaced.select("doc_id", "text_hash", "pos", rendered().alias("replacement")) \
        .groupBy("doc_id", "text_hash") \
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "replacement"))),
                         lambda r: r["replacement"]).alias("replacements")) \
        .withColumnRenamed("doc_id", "of_doc")
    joined = plain.withColumn("hash", F.xxhash64("text")).join(
        per_doc, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("hash") == F.col("text_hash")), "left")
    pieces = F.split("text", PATTERN, -1)
    woven = F.array_join(F.flatten(F.zip_with(
        pieces, F.col("replacements"), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    has = F.col("replacements").isNotNull()
    text = F.when(has, woven).otherwise(F.col("text"))
    n = F.when(has, F.size("replacements")).otherwise(F.lit(0)).cast("long")
    columns = [text.alias(c) if c == text_col else F.col("row").getField(c).alias(c)
               for c in docs.columns if c != "n_entities"]
    return joined.select(*columns, n.alias("n_entities"))


def q_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_personal_data(docs, key="corpus-release").select("doc_id", "n_entities", "text")
