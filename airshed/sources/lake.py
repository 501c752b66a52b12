"""Readers for the raw lake: JSON arrays per file (flights, road flow, pollution and weather histories), raw API
payloads, the airport map, small JSON dimensions and the busiest-airports CSV.

Design: a file is one logical record set, so files are read whole (``text(wholetext=True)``), split into array
elements with ``from_json(…, 'array<string>')`` and only then parsed with an explicit schema. Keeping the element text
lets us test *key presence* (a code-share key with a null value still excludes the flight; a road record without a
length is an error) and tell non-object elements apart — things a schema reader silently null-fills. Readers of feeds
and of the airport map return a :class:`Load`: the clean rows plus a ``rejects`` DataFrame (file, position, reason)
instead of logging and dropping. Rows and rejects come from one classified table with a row per element (an unparsable
file is a row of its own), which :meth:`Load.once` writes out so that both are read from it. Small dimension files that
do not parse fail the job.
Files are independent tasks, so the read parallelises over files; nothing is collected to the driver. A file is held by
one task and must stay below 2 GB; the histories that the jobs write are many files of JSON lines.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from airshed.functions.clean import (blank_to_null, decode_file_name, name_token, safe_int, strip_extension,
                                     strip_footnotes, strip_trailing_digits, thousands_to_long)
from airshed.functions.time import epoch_to_utc, file_stamp_to_ts, hour_in_window, parse_flight_ts, parse_iso_ntz
from airshed.operators import storage
from airshed.operators.joins import zip_lists
from airshed.operators.sinks import dedupe_by_key, staged_rewrite
from airshed.sources import schemas


ACCEPTED = "accepted"
# Why a reader rejects a file or an element.
REASONS = ("bad_file", "not_object", "codeshared", "no_actual_time", "outside_window", "missing_key", "no_list")


@dataclass
class Load:
    """Rows accepted by a reader and the rejected inputs with a reason each, both views of one classified table.

    ``classified`` holds the row's columns, ``file_path``, ``pos`` and ``_reason`` (NULL: accepted). ``counts`` has the
    elements by reason where the table was written and counted on the way.
    """
    classified: DataFrame
    columns: list[str]
    counts: dict[str, int] | None = None

    @property
    def rows(self) -> DataFrame:
        return self.classified.filter(F.col("_reason").isNull()).select(*self.columns)

    @property
    def rejects(self) -> DataFrame:
        return self.classified.filter(F.col("_reason").isNotNull()).select("file_path", "pos",
                                                                         F.col("_reason").alias("reason"))

    def once(self) -> Load:
        """The same load read from a staged copy: the files are parsed once, whatever is asked of the load. The write
        counts what passes, so the statistics need no look at the copy."""
        seen = Observation()
        reason = F.coalesce("_reason", F.lit(ACCEPTED))
        known = [F.count_if(reason == r).alias(r) for r in (ACCEPTED, *REASONS)]
        counted = self.classified.observe(seen, *known, F.count_if(~reason.isin(ACCEPTED, *REASONS)).alias("other"))
        copy = staged_rewrite(counted, "load")
        return Load(copy, self.columns, {r: n for r, n in seen.get.items() if n})

    def stats(self) -> DataFrame:
        """Load statistics: accepted rows and rejects per reason, as counted by the write, or by one small aggregate."""
        if self.counts is not None:
            return self.classified.sparkSession.createDataFrame(list(self.counts.items()), "reason string, n long")
        return self.classified.groupBy(F.coalesce("_reason", F.lit(ACCEPTED)).alias("reason")) \
            .agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------------------------------------------------
# Files and elements

_DAY_FOLDER = re.compile(r"\d{4}-\d{2}-\d{2}")
_FILE_COLUMNS = "file_path string, file_name string, parent string, modified timestamp, value string"


def read_files(spark: SparkSession, path: str | Sequence[str], glob: str = "*.json", recursive: bool = True) -> DataFrame:
    """One row per file: ``file_path, file_name, parent, modified, value`` (whole text).

    ``path`` is a folder or several (see :func:`day_paths`). ``glob`` selects files by name (``*_2024-01-01.json`` for one
    day, ``*.json`` for all); with ``recursive`` day folders that are not ``key=value`` partitions are still listed.
    """
    if not path:
        return spark.createDataFrame([], _FILE_COLUMNS)
    reader = spark.read.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return with_file_columns(reader.text(path if isinstance(path, str) else list(path), wholetext=True))


def day_paths(spark: SparkSession, base: str, day: str) -> str | list[str]:
    """Where a day's files of a lake may be: of the folders that are named by days only those of this day, and all else.

    One look at the names in ``base``; the other days' folders are never listed.
    """
    names = storage.names_in(spark, base)
    if not any(_DAY_FOLDER.match(n) for n in names):
        return base
    return [f"{base.rstrip('/')}/{n}" for n in names if n.startswith(day) or not _DAY_FOLDER.match(n)]


def with_file_columns(files: DataFrame) -> DataFrame:
    """The columns of :func:`read_files` for a batch or stream of whole text files."""
    meta = F.col("_metadata")
    return files.select(
        meta["file_path"].alias("file_path"),
        decode_file_name(meta["file_name"]).alias("file_name"),
        decode_file_name(F.element_at(F.split(meta["file_path"], "/"), -2)).alias("parent"),
        meta["file_modification_time"].alias("modified"),
        F.col("value"),
    )


def json_elements(files: DataFrame, lines: bool = False) -> DataFrame:
    """The file columns with ``pos``, ``elem`` (element text), ``is_object`` and ``bad_file``, a row per array element.

    A file whose text is not a JSON array (an object, a truncated or unparsable document) is one row with ``bad_file``.
    With ``lines`` a file may hold one object per line instead.
    """
    elements = F.from_json("value", "array<string>")
    if lines:
        rows = F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "")
        elements = F.when(F.col("value").rlike(r"^\s*\{"), rows).otherwise(elements)
    file_cols = [c for c in files.columns if c != "value"]
    # Told before the array is exploded: what is asked of it beside the generator stands above that and has it in every row.
    parsed = files.select(*file_cols, elements.alias("_arr")).withColumn("bad_file", F.col("_arr").isNull())
    return parsed.select(*file_cols, "bad_file", F.posexplode_outer("_arr").alias("pos", "elem")) \
        .filter("bad_file or pos is not null").withColumn("is_object", F.json_object_keys("elem").isNotNull())


def _reason(checks: Sequence[tuple[Column, str]]) -> Column:
    """First failing check's reason, or NULL when the row is accepted."""
    out = None
    for failed, reason in checks:
        out = F.when(failed, F.lit(reason)) if out is None else out.when(failed, F.lit(reason))
    return out


def _has_key(json_text: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(json_text), F.lit(key)), F.lit(False))


def _has_path(elem: Column, parent: str, key: str) -> Column:
    return _has_key(F.get_json_object(elem, f"$.{parent}"), key)


def _first_checks() -> list[tuple[Column, str]]:
    return [(F.col("bad_file"), "bad_file"), (~F.col("is_object"), "not_object")]


# ---------------------------------------------------------------------------------------------------------------------
# Flights

# The columns of the flight tables.
ARRIVAL_COLUMNS = ["flight_number", "flight_iata_number", "type", "status", "departure_iata", "departure_delay",
                   "departure_scheduled_time", "departure_actual_time", "arrival_iata", "arrival_scheduled_time",
                   "arrival_actual_time", "arrival_delay", "airline_name", "airline_iata"]
DEPARTURE_COLUMNS = ["flight_number", "flight_iata_number", "type", "status", "departure_iata", "departure_delay",
                     "departure_scheduled_time", "departure_actual_time", "arrival_iata", "arrival_scheduled_time",
                     "arrival_estimated_time", "airline_name", "airline_iata"]
STRING_COLUMNS = ["flight_number", "flight_iata_number", "type", "status", "departure_iata", "arrival_iata",
                  "airline_name", "airline_iata"]


def flatten_flights(elements: DataFrame, direction: str = "arrival", lo: int = 6, hi: int = 9) -> DataFrame:
    """Classify flight elements and flatten accepted ones (``_reason`` NULL) to the warehouse columns.

    Rejected: unparsable files, non-object elements, code-shares (key present, whatever its value), a missing or unparsable actual time
    of the loaded direction, an actual time outside ``lo <= hour < hi``.
    """
    if direction not in ("arrival", "departure"):
        raise ValueError("direction must be 'arrival' or 'departure'")
    r = F.from_json("elem", schemas.FLIGHT_RECORD)
    rec = F.col("_rec")
    with_rec = elements.withColumn("_rec", r)
    actual = parse_flight_ts(rec[direction]["actualTime"])
    reason = _reason([
        *_first_checks(),
        (_has_key(F.col("elem"), "codeshared"), "codeshared"),
        (actual.isNull(), "no_actual_time"),
        (~hour_in_window(actual, lo, hi, inclusive_hi=False), "outside_window"),
    ])
    cols = {
        "flight_number": rec["flight"]["number"], "flight_iata_number": rec["flight"]["iataNumber"],
        "type": rec["type"], "status": rec["status"],
        "departure_iata": rec["departure"]["iataCode"], "departure_delay": safe_int(rec["departure"]["delay"]),
        "departure_scheduled_time": parse_flight_ts(rec["departure"]["scheduledTime"]),
        "departure_actual_time": parse_flight_ts(rec["departure"]["actualTime"]),
        "arrival_iata": rec["arrival"]["iataCode"],
        "arrival_scheduled_time": parse_flight_ts(rec["arrival"]["scheduledTime"]),
        "arrival_actual_time": parse_flight_ts(rec["arrival"]["actualTime"]),
        "arrival_estimated_time": parse_flight_ts(rec["arrival"]["estimatedTime"]),
        "arrival_delay": safe_int(rec["arrival"]["delay"]),
        "airline_name": rec["airline"]["name"], "airline_iata": rec["airline"]["iataCode"],
    }
    names = ARRIVAL_COLUMNS if direction == "arrival" else DEPARTURE_COLUMNS
    out = [(blank_to_null(cols[n]) if n in STRING_COLUMNS else cols[n]).alias(n) for n in names]
    return with_rec.select("file_path", "parent", "pos", *out, reason.alias("_reason"))


def read_flights(spark: SparkSession, path: str, direction: str = "arrival", glob: str = "*.json", lo: int = 6,
                 hi: int = 9) -> Load:
    """Flight lake files ``{dir}/{City}/{IATA}_{date}.json`` → warehouse rows (+ ``city`` from the folder)."""
    return flights_from_files(read_files(spark, path, glob), direction, lo, hi)


def flights_from_files(files: DataFrame, direction: str = "arrival", lo: int = 6, hi: int = 9) -> Load:
    """As :func:`read_flights`, from the rows of :func:`read_files` (also those of a micro-batch)."""
    classified = flatten_flights(json_elements(files), direction, lo, hi).withColumnRenamed("parent", "city")
    names = ARRIVAL_COLUMNS if direction == "arrival" else DEPARTURE_COLUMNS
    return Load(classified, [*names, "city", "file_path"])


# ---------------------------------------------------------------------------------------------------------------------
# Road flow

# The keys a road record must have.
ROAD_REQUIRED = [("location", "length"), ("currentFlow", "speed"), ("currentFlow", "freeFlow"),
                 ("currentFlow", "jamFactor")]


def read_road(spark: SparkSession, path: str, glob: str = "*.json", strict: bool = False, day: str | None = None) -> Load:
    """Road-flow files ``{dir}/{day}/{City}_{startUTC}_{endUTC}.json`` (':' written '--') → rows
    ``date, city, road, length, speed, freeflow, jamfactor``.

    ``location.description`` is optional (NULL road; an empty one stays ''); the other four keys are required. With
    ``strict`` a reject fails the job (the bulk loader aborts): the files are parsed once into a staged table, which is
    checked and then read. Otherwise the element is rejected with reason ``missing_key``. ``day`` takes the files with
    that day in their name and lists that day's folders only.
    """
    files = read_files(spark, day_paths(spark, path, day), road_day_glob(day)) if day else read_files(spark, path, glob)
    elements = json_elements(files)
    missing = ~reduce(lambda a, b: a & b, [_has_path(F.col("elem"), p, k) for p, k in ROAD_REQUIRED])
    rec = F.from_json("elem", schemas.ROAD_RECORD)
    stem = strip_extension(F.col("file_name"))
    classified = elements.select(
        "file_path", "pos",
        file_stamp_to_ts(name_token(stem, 2)).alias("date"), name_token(stem, 1).alias("city"),
        rec["location"]["description"].alias("road"), rec["location"]["length"].alias("length"),
        rec["currentFlow"]["speed"].alias("speed"), rec["currentFlow"]["freeFlow"].alias("freeflow"),
        rec["currentFlow"]["jamFactor"].alias("jamfactor"),
        _reason([*_first_checks(), (missing, "missing_key")]).alias("_reason"),
    )
    load = Load(classified, ["date", "city", "road", "length", "speed", "freeflow", "jamfactor"])
    if strict:
        load = load.once()
        first = load.rejects.head(1)  # only that one row reaches the driver
        if first:
            raise ValueError(f"road load aborted: {first[0]['reason']} in {first[0]['file_path']}")
    return load


# ---------------------------------------------------------------------------------------------------------------------
# Pollution and weather histories (flat arrays) and raw API payloads

def _history(spark: SparkSession, path: str, schema, required: Sequence[str], nested: dict[str, Sequence[str]],
             glob: str) -> DataFrame:
    elements = json_elements(read_files(spark, path, glob), lines=True)
    checks = [_has_key(F.col("elem"), k) for k in required]
    checks += [_has_path(F.col("elem"), p, k) for p, ks in nested.items() for k in ks]
    missing = ~reduce(lambda a, b: a & b, checks)
    return elements.withColumn("_rec", F.from_json("elem", schema)).withColumn(
        "_reason", _reason([*_first_checks(), (missing, "missing_key")]))


def _load(classified: DataFrame, cols: list[Column], names: list[str], with_source: bool) -> Load:
    own = _source_cols() if with_source else []
    table = classified.select(*cols, *own, "file_path", "pos", "_reason")
    return Load(table, names + (["source_file", "source_pos"] if with_source else []))


POLLUTION_FIELDS = ["place", "latitude", "longitude", "timestamp", "date", "air_quality_index", *schemas.POLLUTANTS]


def read_pollution_history(spark: SparkSession, path: str, glob: str = "*.json", with_source: bool = False) -> Load:
    """Pollution history (JSON arrays or lines) → ``place, latitude, longitude, timestamp, date, air_quality_index,
    co … nh3`` (``with_source`` adds ``source_file``/``source_pos``, the input order)."""
    classified = _history(spark, path, schemas.POLLUTION_RECORD,
                          ["place", "latitude", "longitude", "timestamp", "date", "air_quality_index"],
                          {"components": schemas.POLLUTANTS}, glob)
    rec = F.col("_rec")
    cols = [rec["place"].alias("place"), rec["latitude"].alias("latitude"), rec["longitude"].alias("longitude"),
            rec["timestamp"].alias("timestamp"),
            parse_iso_ntz(rec["date"], " ", "optional").alias("date"),
            rec["air_quality_index"].alias("air_quality_index"),
            *[rec["components"][p].alias(p) for p in schemas.POLLUTANTS]]
    return _load(classified, cols, POLLUTION_FIELDS, with_source)


# The columns of the weather table.
WEATHER_FIELDS = ["place", "latitude", "longitude", "timestamp", "date", "temperature", "humidity", "pressure",
                  "wind_speed", "weather_main", "weather_description"]


def read_weather_history(spark: SparkSession, path: str, glob: str = "*.json", with_source: bool = False) -> Load:
    """Weather history (JSON arrays or lines) → the weather table columns in their fixed order."""
    classified = _history(spark, path, schemas.WEATHER_RECORD, WEATHER_FIELDS, {}, glob)
    rec = F.col("_rec")
    cols = [(parse_iso_ntz(rec[f], " ", "optional") if f == "date" else rec[f]).alias(f) for f in WEATHER_FIELDS]
    return _load(classified, cols, WEATHER_FIELDS, with_source)


def history_records(rows: DataFrame, kind: str) -> DataFrame:
    """Observation rows as the records the history readers take: dates as text, pollutants under ``components``.

    A ``day`` column, if there is one, is kept for the folder.
    """
    fields = {"pollution": POLLUTION_FIELDS, "weather": WEATHER_FIELDS}[kind]
    cols = [F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date") if f == "date" else F.col(f)
            for f in fields if f not in schemas.POLLUTANTS]
    if kind == "pollution":
        cols.append(F.struct(*schemas.POLLUTANTS).alias("components"))
    return rows.select(*cols, *[c for c in rows.columns if c == "day"])


def _source_cols() -> list[Column]:
    return [F.col("file_path").alias("source_file"), F.col("pos").alias("source_pos")]


def _payload_rows(spark: SparkSession, path: str, schema, glob: str, coordinates: DataFrame | None) -> DataFrame:
    """Landed API payloads ``{dir}/{place}/….json`` → one row per ``list`` entry with its file and position (so "the
    last record wins" can be decided later), and one with a reason per payload that is no JSON object or has no list."""
    files = read_files(spark, path, glob)
    body = files.select("file_path", F.col("parent").alias("place"), F.from_json("value", schema)["list"].alias("_l"),
                        _reason([(F.json_object_keys("value").isNull(), "bad_file"),
                                 (~_has_key(F.col("value"), "list"), "no_list")]).alias("_bad"))
    rows = body.select("place", "file_path", F.posexplode_outer("_l").alias("pos", "e"), "_bad") \
        .filter("_bad is not null or pos is not null")
    if coordinates is not None:
        coords = coordinates.select(F.col("city_name").alias("place"), F.col("lat").alias("latitude"),
                                    F.col("lon").alias("longitude"))
        return rows.join(coords, "place", "left")
    return rows.withColumn("latitude", F.lit(None).cast("double")).withColumn("longitude", F.lit(None).cast("double"))


def _payload_load(rows: DataFrame, cols: list[Column], names: list[str], lo: int, hi: int, with_source: bool) -> Load:
    """Entries outside ``lo <= UTC hour < hi`` are not part of a load; they are no rejects either."""
    ts = epoch_to_utc(F.col("e")["dt"])
    wanted = rows.filter(F.col("_bad").isNotNull() | hour_in_window(ts, lo, hi, inclusive_hi=False))
    return _load(wanted.withColumnRenamed("_bad", "_reason"), cols, names, with_source)


def read_pollution_payloads(spark: SparkSession, path: str, glob: str = "*.json", coordinates: DataFrame | None = None,
                            lo: int = 6, hi: int = 10, with_source: bool = False) -> Load:
    """Raw pollution history responses → history records, observations with ``lo <= UTC hour < hi`` only.
    ``with_source`` keeps ``source_file``/``source_pos`` (input order)."""
    rows, e = _payload_rows(spark, path, schemas.POLLUTION_PAYLOAD, glob, coordinates), F.col("e")
    cols = [F.col("place"), F.col("latitude"), F.col("longitude"), e["dt"].alias("timestamp"),
            epoch_to_utc(e["dt"]).alias("date"), e["main"]["aqi"].alias("air_quality_index"),
            *[e["components"][p].alias(p) for p in schemas.POLLUTANTS]]
    return _payload_load(rows, cols, POLLUTION_FIELDS, lo, hi, with_source)


def read_weather_payloads(spark: SparkSession, path: str, glob: str = "*.json", coordinates: DataFrame | None = None,
                          lo: int = 6, hi: int = 10, strict: bool = False, with_source: bool = False) -> Load:
    """Raw weather responses → weather records; only the first ``weather`` entry is used. With ``strict`` an empty
    ``weather`` list fails the job (as indexing an empty list does); otherwise its label columns are NULL."""
    rows, e = _payload_rows(spark, path, schemas.WEATHER_PAYLOAD, glob, coordinates), F.col("e")
    first = F.element_at(e["weather"], 1) if strict else F.get(e["weather"], 0)
    cols = [F.col("place"), F.col("latitude"), F.col("longitude"), e["dt"].alias("timestamp"),
            epoch_to_utc(e["dt"]).alias("date"), e["main"]["temp"].alias("temperature"),
            e["main"]["humidity"].alias("humidity"), e["main"]["pressure"].alias("pressure"),
            e["wind"]["speed"].alias("wind_speed"), first["main"].alias("weather_main"),
            first["description"].alias("weather_description")]
    return _payload_load(rows, cols, WEATHER_FIELDS, lo, hi, with_source)


def pollution_from_payloads(spark: SparkSession, path: str, **options) -> DataFrame:
    """The accepted rows of :func:`read_pollution_payloads`."""
    return read_pollution_payloads(spark, path, **options).rows


def weather_from_payloads(spark: SparkSession, path: str, **options) -> DataFrame:
    """The accepted rows of :func:`read_weather_payloads`."""
    return read_weather_payloads(spark, path, **options).rows


def drop_nested_key(json_text: Column, key: str) -> Column:
    """A JSON object's text without ``key`` in its first-level objects; everything else stays, of whatever shape."""
    def pruned(value: Column) -> Column:
        return F.when(F.schema_of_variant(value).startswith("OBJECT"), F.to_variant_object(F.map_filter(
            value.try_cast("map<string, variant>"), lambda k, _: k != key))).otherwise(value)

    top = F.parse_json(json_text).cast("map<string, variant>")
    return F.to_json(F.to_variant_object(F.transform_values(top, lambda _, v: pruned(v))))


def prune_road_payload(spark: SparkSession, path: str, glob: str = "*.json", strict: bool = True) -> DataFrame:
    """Raw road responses ``{"results": [...]}`` → ``file_path, pos, elem``: the text of every result without
    ``subSegments`` in its first-level objects; all other fields stay. A payload without ``results`` is an error under
    ``strict`` (else it yields nothing)."""
    files = read_files(spark, path, glob)
    body = files.select("file_path", F.from_json("value", "results array<string>").alias("_p"),
                        _has_key(F.col("value"), "results").alias("_ok"))
    if strict:
        body = body.withColumn("_ok", F.when(F.col("_ok"), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("key `results` not found in "), F.col("file_path")))))
    elems = body.filter("_ok").select("file_path", F.posexplode(F.col("_p")["results"]).alias("pos", "elem"))
    return elems.select("file_path", "pos", drop_nested_key(F.col("elem"), "subSegments").alias("elem"))


# ---------------------------------------------------------------------------------------------------------------------
# Dimensions

# The airport map's fields and the columns they become.
AIRPORT_RENAMES = [("GMT", "gmt_offset"), ("codeIataAirport", "code_iata_airport"),
                   ("codeIataCity", "code_iata_city"), ("codeIcaoAirport", "code_icao_airport"),
                   ("codeIso2Country", "code_iso2_country"), ("latitudeAirport", "latitude"),
                   ("longitudeAirport", "longitude"), ("nameAirport", "name_airport"),
                   ("nameCountry", "name_country"), ("phone", "phone"), ("timezone", "timezone")]


def read_airport_map(spark: SparkSession, path: str, dedupe: bool = True) -> Load:
    """Airport map ``{city: [airport, …]}`` → one row per airport with ``city_name``; a file that is no JSON object is
    rejected. With ``dedupe`` one row per IATA code (a reload must not duplicate airports and inflate flight sums)."""
    files = read_files(spark, path, glob="*.json", recursive=False)
    bad = F.json_object_keys("value").isNull()
    cities = files.select("file_path", bad.alias("_bad"), F.explode_outer(F.when(~bad, F.from_json(
        "value", schemas.AIRPORTS_BY_CITY))).alias("city_name", "_list"))
    each = cities.select("file_path", "_bad", "city_name", F.posexplode_outer("_list").alias("pos", "_a")) \
        .filter("_bad or pos is not null")
    names = ["city_name", *[dst for _, dst in AIRPORT_RENAMES]]
    airports = each.select("file_path", "pos", "city_name", *[F.col("_a")[src].alias(dst) for src, dst in AIRPORT_RENAMES],
                           F.when(F.col("_bad"), F.lit("bad_file")).alias("_reason"))
    if dedupe:  # rows without a code, rejects among them, pass through
        airports = dedupe_by_key(airports, ["code_iata_airport"], ["city_name", "name_airport"], keep="first")
    return Load(airports, names)


def read_airports(spark: SparkSession, path: str, dedupe: bool = True) -> DataFrame:
    """The accepted rows of :func:`read_airport_map`."""
    return read_airport_map(spark, path, dedupe).rows


def _object_text() -> Column:
    """The text of a dimension file; one that is no JSON object fails the job."""
    return F.when(F.json_object_keys("value").isNotNull(), F.col("value")).otherwise(
        F.raise_error(F.concat(F.lit("not a JSON object: "), F.col("file_path"))))


def read_busiest_airports(spark: SparkSession, path: str) -> DataFrame:
    """Busiest-airports CSV → ``rank, country, airport, city_served, passengers`` with footnotes, trailing digits and
    thousands separators removed."""
    raw = spark.read.csv(path, header=True, schema=schemas.BUSIEST_AIRPORTS_CSV, quote='"', escape='"')
    named = raw.toDF("rank", "country", "airport", "city_served", "passengers_text")
    return named.select("rank", strip_trailing_digits("country").alias("country"),
                        strip_footnotes("airport").alias("airport"), strip_footnotes("city_served").alias("city_served"),
                        thousands_to_long("passengers_text").alias("passengers"))


def read_city_boxes(spark: SparkSession, path: str) -> DataFrame:
    """``{city: {topLeftPoint, btmRightPoint}}`` → ``city, west, south, east, north``."""
    files = read_files(spark, path, glob="*.json", recursive=False)
    boxes = files.select(F.explode(F.from_json(_object_text(), schemas.CITY_BOXES)).alias("city", "b"))
    return boxes.select("city", F.col("b.topLeftPoint.lon").alias("west"), F.col("b.btmRightPoint.lat").alias("south"),
                        F.col("b.btmRightPoint.lon").alias("east"), F.col("b.topLeftPoint.lat").alias("north"))


def read_city_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """Config ``{"coordinates": [{city_name, lat, lon}]}`` → ``city_name, lat, lon``."""
    files = read_files(spark, path, glob="*.json", recursive=False)
    return files.select(F.inline(F.from_json(_object_text(), schemas.CITY_COORDINATES)["coordinates"]))


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Parallel lists (cities, country codes, UTC offsets, summer shifts) → one row per city; unequal lengths fail."""
    files = read_files(spark, path, glob="*.json", recursive=False)
    lists = files.select(F.from_json(_object_text(), schemas.CALENDAR).alias("c")).select("c.*")
    return zip_lists(lists, ["cities", "country_codes", "timezones", "summer_time_addition"],
                     ["city", "country_code", "utc_offset", "summer_shift"])


def filter_lookup(pairs: DataFrame, city: str = "city", country: str = "country",
                  payload: str = "payload") -> DataFrame:
    """Airport lookup answers per (city, country): keep airports of the same country with a non-empty ICAO code;
    cities left without airports are dropped. ``payload`` is the landed JSON text of the answer."""
    answer = F.from_json(F.col(payload), schemas.LOOKUP_PAYLOAD)["airportsByCities"]
    kept = F.filter(F.coalesce(answer, F.array()), lambda a: (a["nameCountry"] == F.col(country))
                    & a["codeIcaoAirport"].isNotNull() & (a["codeIcaoAirport"] != ""))
    return pairs.select(city, country, kept.alias("airports")).filter(F.size("airports") > 0)


def lookup_codes(filtered: DataFrame, code_field: str = "codeIataAirport") -> DataFrame:
    """All airport codes over all cities of a filtered lookup, non-empty ones only; duplicates are kept."""
    codes = filtered.select(F.explode("airports").alias("_a")).select(F.col("_a")[code_field].alias("code"))
    return codes.filter(F.col("code").isNotNull() & (F.col("code") != ""))


def geocode_first_hit(answers: DataFrame, city: str = "city", payload: str = "payload") -> DataFrame:
    """Landed geocoder answers (a JSON array of hits per city) → the first hit's lat/lon; a city without hits is
    dropped."""
    hits = F.from_json(F.col(payload), "array<struct<name string, lat double, lon double, country string>>")
    first = F.get(hits, 0)
    return answers.select(F.col(city).alias("city_name"), first["lat"].alias("lat"), first["lon"].alias("lon")) \
        .filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())


# ---------------------------------------------------------------------------------------------------------------------
# File selection, latest file, lake writer

def day_glob(day: str) -> str:
    """Files of one day by name suffix (also matches back-fill names ending in ``_to_{day}.json``)."""
    return f"*_{day}.json"


def road_day_glob(day: str) -> str:
    """Road files of one day: the day stands inside the name (``{City}_{start}_{end}.json``)."""
    return f"*{day}*.json"


def month_dirs(base: str, year: int | None, month: int | None) -> str | None:
    """Day folders of one month (``base/2024-11-*``); a missing year or month selects nothing."""
    if year is None or month is None:
        return None
    return f"{base}/{year:04d}-{month:02d}-*"


def latest_file(spark: SparkSession, path: str, glob: str = "*.json", after: str | None = None) -> DataFrame:
    """The most recently modified file under ``path`` (one row), of several at one moment the one with the last path.

    Only the listing is looked at, no file is opened. ``after`` ('YYYY-MM-DDTHH:mm:ss') leaves out files that were not
    modified since.
    """
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if after:
        reader = reader.option("modifiedAfter", after)
    files = reader.format("binaryFile").load(path).select("path", "modificationTime")
    last = F.max(F.struct("modificationTime", "path")).alias("last")
    return files.agg(last).select(F.col("last.path").alias("file_path"), F.col("last.modificationTime").alias("modified"))


def write_lake_json(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "append") -> None:
    """Land records as JSON lines, one folder per partition value (source / direction / city / day).

    Fields without a value are written as null: the readers test for the key.
    """
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)
