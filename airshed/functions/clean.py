"""Scalar cleaning expressions: lenient numbers, blank handling, regex cleaning, path tokens, synonyms, buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from airshed.functions._util import as_col

# City-name synonyms applied by the road view, and the flight-volume bucket layout of the master view.
CITY_SYNONYMS = {"Zürich": "Zurich", "Frankfurt am Main": "Frankfurt"}
VOLUME_BUCKET_WIDTH = 50
VOLUME_BUCKETS = 10
# Patterns that strip trailing digits and "[n]" footnotes from scraped table cells.
TRAILING_DIGITS = r"\d+$"
FOOTNOTE = r"\[\d+\]"


def safe_int(text) -> Column:
    """``int(float(x or 0))``: NULL and '' become 0, fractions truncate toward zero, junk becomes 0.

    Junk is whatever is not a number that an int can hold: other text, NaN, infinities, 1e12.
    """
    return F.coalesce(as_col(text).try_cast("double").try_cast("int"), F.lit(0))


def blank_to_null(c) -> Column:
    """Empty strings land as NULL after a CSV round trip; make that explicit."""
    return F.nullif(as_col(c), F.lit(""))


def non_empty(c) -> Column:
    """Python truthiness of a string: NULL and '' are false."""
    col = as_col(c)
    return col.isNotNull() & (col != "")


def strip_trailing_digits(c) -> Column:
    return F.trim(F.regexp_replace(as_col(c), TRAILING_DIGITS, ""))


def strip_footnotes(c) -> Column:
    return F.trim(F.regexp_replace(as_col(c), FOOTNOTE, ""))


def thousands_to_long(c) -> Column:
    """'1,234,567' → 1234567 (NULL when not a number)."""
    return F.regexp_replace(strip_footnotes(c), ",", "").try_cast("bigint")


def url_host(url) -> Column:
    return F.regexp_extract(as_col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def url_path(url) -> Column:
    return F.regexp_extract(as_col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def basename(path) -> Column:
    """Last '/'-separated element ('' for a trailing slash)."""
    return F.element_at(F.split(as_col(path), "/"), -1)


def strip_extension(name, ext: str = ".json") -> Column:
    return F.regexp_replace(as_col(name), _escape(ext) + "$", "")


def _escape(text: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in text)


def name_token(name, index: int, sep: str = "_") -> Column:
    """1-based token of a name split on ``sep``; negative indexes count from the end; NULL when absent."""
    parts = F.split(as_col(name), _escape(sep))
    return F.try_element_at(parts, F.lit(index))


def decode_file_name(name) -> Column:
    """``_metadata.file_name`` percent-encodes spaces but keeps non-ASCII characters; undo the encoding."""
    return F.url_decode(F.replace(as_col(name), F.lit("+"), F.lit("%2B")))


def synonym_case(c, synonyms: Mapping[str, str] = CITY_SYNONYMS) -> Column:
    """CASE WHEN c = k1 THEN v1 ... ELSE c END."""
    col = as_col(c)
    out = None
    for src, dst in synonyms.items():
        out = F.when(col == src, F.lit(dst)) if out is None else out.when(col == src, F.lit(dst))
    return col if out is None else out.otherwise(col)


def volume_bucket(total, width: int = VOLUME_BUCKET_WIDTH, buckets: int = VOLUME_BUCKETS) -> Column:
    """``<= width → 1``, ``<= 2·width → 2`` … ``<= (buckets−1)·width → buckets−1``, anything else (NULL too) → buckets."""
    col = as_col(total)
    out = F.when(col <= width, F.lit(1))
    for b in range(2, buckets):
        out = out.when(col <= b * width, F.lit(b))
    return out.otherwise(F.lit(buckets))


def allow_list(c, values: Sequence) -> Column:
    """IN-list filter where an empty list means 'everything'."""
    return F.lit(True) if not values else as_col(c).isin(list(values))


def flow_quality(jam_factor, functional_class=None, lo: float = 0.0, hi: float = 9.9,
                 classes: Sequence[int] = (1, 2, 3)) -> Column:
    """Road-flow quality predicate: jam factor within [lo, hi] and (when the field exists) a functional class in
    ``classes``."""
    ok = as_col(jam_factor).between(lo, hi)
    return ok if functional_class is None else ok & as_col(functional_class).isin(list(classes))


def has_key(json_text, key: str) -> Column:
    """Key presence in a JSON object text, even when the value is null; NULL for non-objects."""
    return F.array_contains(F.json_object_keys(as_col(json_text)), F.lit(key))
