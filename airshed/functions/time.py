"""Time expressions: lenient timestamp parsing, hour windows, epochs, file-name stamps, local→UTC windows.

Everything returns a Column built from Spark built-ins, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airshed.functions._util import as_col

# Fixed value: the start of the history every feed is collected from.
HISTORY_START = "2023-12-01 00:00:00"


def to_ntz(c) -> Column:
    """Cast to TIMESTAMP_NTZ (wall clock in the session zone, which this package pins to UTC)."""
    return as_col(c).cast("timestamp_ntz")


def _ntz(text: Column, fmt: str) -> Column:
    # try_to_timestamp only decides whether the text parses (NULL for junk and impossible dates); the value comes
    # from to_timestamp_ntz, which reads the wall clock without the session time zone.
    return F.when(F.try_to_timestamp(text, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(text, F.lit(fmt)))


def parse_iso_ntz(text, sep: str = "T", fraction: str = "optional") -> Column:
    """``yyyy-MM-dd<sep>HH:mm:ss[.f…]`` text → TIMESTAMP_NTZ, NULL when unparsable.

    ``fraction``: 'required' (1–6 digits must follow the seconds), 'optional', or 'none'. The value never passes
    through the session time zone, so wall-clock times inside a daylight-saving gap of that zone stay intact.
    """
    base = "yyyy-MM-dd" + (f"'{sep}'" if sep.isalpha() else sep) + "HH:mm:ss"
    formats = {"required": [base + ".SSSSSS"], "optional": [base + ".SSSSSS", base], "none": [base]}[fraction]
    s = as_col(text)
    return F.coalesce(*[_ntz(s, f) for f in formats])


def parse_flight_ts(text, strict_fraction: bool = True) -> Column:
    """Parse a flight time string; a lower-case 't' separator is accepted; failure yields NULL.

    With ``strict_fraction`` (the loader behaviour) a value without a fractional second counts as unparsable. The
    fraction may have one to six digits.
    """
    fixed = F.translate(as_col(text), "t", "T")
    return parse_iso_ntz(fixed, "T", "required" if strict_fraction else "optional")


def parse_ts_multi(text, formats: list[str], strict: bool = False) -> Column:
    """Try each Spark datetime pattern in order; with ``strict`` an unparsable non-NULL value raises instead of
    yielding NULL. The wall clock is read as it stands, without the session time zone."""
    s = as_col(text)
    parsed = F.coalesce(*[_ntz(s, fmt) for fmt in formats])
    if strict:
        parsed = F.when(s.isNull() | parsed.isNotNull(), parsed).otherwise(
            F.raise_error(F.concat(F.lit("unparsable timestamp: "), s)))
    return parsed


def hour_in_window(ts, lo: int = 6, hi: int = 9, inclusive_hi: bool = True) -> Column:
    """Morning filter. ``inclusive_hi`` gives ``hour BETWEEN lo AND hi``; otherwise ``lo <= hour < hi``."""
    h = F.hour(as_col(ts))
    return (h >= lo) & ((h <= hi) if inclusive_hi else (h < hi))


def hour_trunc(ts) -> Column:
    """DATE_TRUNC('hour') of a TIMESTAMP_NTZ, computed on the wall clock (no session-zone round trip)."""
    t = as_col(ts)
    return F.timestamp_add("HOUR", F.hour(t), F.to_date(t).cast("timestamp_ntz"))


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 00:00 of a wall-clock (TIMESTAMP_NTZ) value read as UTC."""
    t = as_col(ts)
    return (F.unix_date(F.to_date(t)).cast("bigint") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
            + F.second(t)).cast("bigint")


def epoch_to_utc(epoch) -> Column:
    """Epoch seconds → naive UTC timestamp."""
    return F.timestamp_add("SECOND", as_col(epoch), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def utc_text(ts, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(as_col(ts), fmt)


def file_stamp_to_ts(stamp) -> Column:
    """ISO stamp from a lake file name, with ':' written as '--', back to a timestamp."""
    return parse_iso_ntz(F.replace(as_col(stamp), F.lit("--"), F.lit(":")), "T", "optional")


def local_to_utc(local_ts, zone) -> Column:
    """Local wall-clock time in an IANA zone → naive UTC (daylight saving handled by the zone rules)."""
    return F.convert_timezone(as_col(zone), F.lit("UTC"), as_col(local_ts))


def local_to_utc_fixed(local_ts, utc_offset_hours, summer_shift_hours,
                       summer_from: str = "2024-03-31 00:00:00", summer_to: str = "2024-10-27 00:00:00") -> Column:
    """Table-driven conversion with a fixed summer period, for parity with the request planner.

    UTC = local − offset; inside [summer_from, summer_to] (judged on that first UTC value) a further summer shift is
    subtracted.
    """
    base = as_col(local_ts) - F.make_interval(hours=as_col(utc_offset_hours))
    in_summer = (base >= F.lit(summer_from).cast("timestamp_ntz")) & (base <= F.lit(summer_to).cast("timestamp_ntz"))
    return to_ntz(F.when(in_summer, base - F.make_interval(hours=as_col(summer_shift_hours))).otherwise(base))
