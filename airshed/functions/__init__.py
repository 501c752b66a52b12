"""Scalar Column expressions (JVM built-ins only)."""

from airshed.functions.clean import (allow_list, basename, blank_to_null, decode_file_name, has_key, name_token,
                                     non_empty, safe_int, strip_extension, strip_footnotes, strip_trailing_digits,
                                     synonym_case, thousands_to_long, url_host, url_path, volume_bucket)
from airshed.functions.time import (epoch_seconds, epoch_to_utc, file_stamp_to_ts, hour_in_window, hour_trunc,
                                    local_to_utc, local_to_utc_fixed, parse_flight_ts, parse_iso_ntz, parse_ts_multi,
                                    to_ntz,
                                    utc_text)

__all__ = [
    "allow_list", "basename", "blank_to_null", "decode_file_name", "has_key", "name_token", "non_empty", "safe_int",
    "strip_extension", "strip_footnotes", "strip_trailing_digits", "synonym_case", "thousands_to_long", "url_host",
    "url_path", "volume_bucket", "epoch_seconds", "epoch_to_utc", "file_stamp_to_ts", "hour_in_window", "hour_trunc",
    "local_to_utc", "local_to_utc_fixed", "parse_flight_ts", "parse_iso_ntz", "parse_ts_multi", "to_ntz", "utc_text",
]
