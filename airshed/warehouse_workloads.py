"""Registered queries through the warehouse's writers: appends with and without a key, reload, refresh of the views after
late loads, the latest landed file, and streams with a watermark.

Each query builds a warehouse of its own in the shared folder from whole driver tables and reads back what the writers
have left there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions.clean import VOLUME_BUCKET_WIDTH
from airshed.lake_workloads import _landed
from airshed.operators import sinks, storage
from airshed.plans import changes, jobs, views
from airshed.session import shared_path
from airshed.sources import lake
from airshed.sources.tables import Tables
from airshed.streaming.ingest import append_stream, dedupe_in_stream, hourly_counts_stream
from airshed.workloads import (CUTOFF_MIDDAY, MASTER_DOUBLES, MASTER_POLLUTANTS, REGISTRY, _customer_airports,
                               _event_cities, _round, master_sql, register)

LATE_MINUTE = 55  # events of the first half after it in their hour come late
STREAM_CUTS = ("2024-01-11", "2024-01-21")
LATENESS_DAYS = 4
# What the first days' sign-ups are to the stream: they come with the last files, long after the watermark has passed.
HELD_BACK, HELD_BACK_TO = "signup", "2024-01-04"

_COLUMNS = ["event_id", "user_id", "event_type", "ts", "value", "date"]


def _root(spark: SparkSession, name: str) -> str:
    return shared_path(spark, name, uuid.uuid4().hex)


def _events(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.withColumn("date", F.to_date("ts")).select(*_COLUMNS)


def _time(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _two_loads(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    ev = _events(spark, d)
    return ev.filter(F.col("ts") < _time(CUTOFF_MIDDAY)), ev.filter(F.col("ts") >= _time(CUTOFF_MIDDAY))


# ---------------------------------------------------------------------------------------------------------------------
# Appends and reload

_EVENTS_SQL = "SELECT event_id, user_id, event_type, ts, value, CAST(ts AS DATE) AS date FROM events"


@register("append_round_trip", f"""
{_EVENTS_SQL} UNION ALL {_EVENTS_SQL} WHERE ts < TIMESTAMP '{CUTOFF_MIDDAY}'
""")
def q_append_round_trip(spark, d):
    """Loads without a key: the first rows are loaded twice under two names and count twice, the later ones twice under
    one name, as by a job that ran again, and count once."""
    path = _root(spark, "append") + "/events"
    first, later = _two_loads(spark, d)
    for name, rows in (("first", first), ("later", later), ("first again", first), ("later", later)):
        sinks.append_rows(path, rows, name, ["date"], ["event_type"])
    return storage.read_if_exists(spark, path).select(*_COLUMNS)


@register("strict_append_round_trip", f"SELECT *, true AS refused FROM ({_EVENTS_SQL})")
def q_strict_append_round_trip(spark, d):
    """Strict loads on event_id: rows of which some are there already are refused whole, the others are added, also by a
    job that runs again under its name."""
    path = _root(spark, "strict") + "/events"
    first, later = _two_loads(spark, d)
    refused = False
    for name, rows in (("first", first), ("all", first.union(later)), ("later", later), ("later", later)):
        target = sinks.read_without(spark, path, name)
        try:
            sinks.strict_append(path, rows.limit(0) if target is None else target, rows, ["event_id"], prune_col="date",
                                partition_by=["date"], load=name)
        except ValueError:
            refused = name == "all"
    return storage.read_if_exists(spark, path).select(*_COLUMNS, F.lit(refused).alias("refused"))


@register("road_reload_round_trip", REGISTRY["lake_road"].sql)
def q_road_reload_round_trip(spark, d):
    """The road table reloaded whole, twice, from the landed files; the second version takes the first one's place."""
    wh, feed = jobs.Warehouse(_root(spark, "reload")), _landed(spark, d, "road")
    for _ in range(2):
        jobs.load_road(spark, wh, feed, strict=False, reload=True)
    road = wh.read(spark, "road_traffic").select("date", "city", "road", "length", "speed", "freeflow", "jamfactor")
    return _round(_round(road, ["speed", "freeflow", "jamfactor"]), ["length"], 4)


# ---------------------------------------------------------------------------------------------------------------------
# Refresh

def _load_feeds(spark: SparkSession, t: Tables, wh: jobs.Warehouse, which) -> None:
    """Append the events that ``which`` selects to the warehouse tables, each feed's days noted."""
    ev, cities = t.events.filter(which), _event_cities(t).filter(which)
    place = [F.col("city").alias("place"), F.col("ts").alias("date"), F.to_date("ts").alias("day")]
    code = F.col("user_id").cast("string")
    feeds = {
        "arrivals": ev.filter("event_type = 'purchase'").select(
            code.alias("arrival_iata"), F.col("ts").alias("arrival_actual_time"), F.lit("landed").alias("status"),
            F.to_date("ts").alias("day")),
        "departures": ev.filter("event_type = 'view'").select(
            code.alias("departure_iata"), F.col("ts").alias("departure_actual_time"), F.lit("active").alias("status"),
            F.to_date("ts").alias("day")),
        "road_traffic": cities.filter("event_type = 'click'").select(
            F.col("ts").alias("date"), "city", F.col("value").alias("speed"), F.col("k").alias("freeflow"),
            F.hour("ts").cast("double").alias("jamfactor"), F.to_date("ts").alias("day")),
        "air_pollution_data": cities.filter("event_type = 'error'").select(
            *place, F.col("k").cast("int").alias("air_quality_index"),
            *[(F.col("value") if p == "co" else F.col("k")).alias(p) for p in views.POLLUTANTS]),
        "weather_data": cities.select(
            *place, F.col("k").alias("temperature"), F.hour("ts").alias("humidity"), F.minute("ts").alias("pressure"),
            F.second("ts").cast("double").alias("wind_speed"), F.col("event_type").alias("weather_main")),
    }
    for table, rows in feeds.items():
        changes.note(spark, wh.root, table, sinks.partition_values(rows, "day"))
        sinks.append_rows(wh.path(table), rows, partition_by=["day"])


@register("refresh_round_trip", master_sql(VOLUME_BUCKET_WIDTH))
def q_refresh_round_trip(spark, d):
    """A load and, late, what it lacked of the first half's days, each followed by a refresh of what it touched; the master
    view is read back from its files."""
    t, root = Tables(spark, d), _root(spark, "refresh")
    wh, views_dir = jobs.Warehouse(f"{root}/warehouse"), f"{root}/views"
    storage.replace_table(spark, wh.path("airports"), lambda staging: _customer_airports(t).write.parquet(staging))
    late = (F.col("ts") < _time(CUTOFF_MIDDAY)) & (F.minute("ts") >= LATE_MINUTE)
    for which in (~late, late):
        _load_feeds(spark, t, wh, which)
        report = jobs.refresh_changed(spark, wh, views_dir)
        if not report.ok:
            raise RuntimeError(f"refresh of {report.failed}: {report.error}")
    master = storage.read_if_exists(spark, f"{views_dir}/master_view_v").drop(
        *[p for p in views.POLLUTANTS if p not in MASTER_POLLUTANTS])
    return _round(master, MASTER_DOUBLES)


# ---------------------------------------------------------------------------------------------------------------------
# Landed files

@register("latest_file", """
SELECT event_type AS city, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, COUNT(*) AS n_events
FROM events WHERE CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events)
  AND event_type = (SELECT MAX(event_type) FROM events WHERE CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events))
GROUP BY ALL
""")
def q_latest_file(spark, d):
    """The file that the collector wrote last, of files that came by day and city, read alone."""
    root = _root(spark, "latest")
    _events(spark, d).select("event_id", F.col("event_type").alias("city"), F.date_format("ts", "yyyy-MM-dd").alias("day")) \
        .repartition("day", "city").write.partitionBy("day", "city").json(root)
    files = [(folder, name) for folder, name in storage._data_files(spark, root) if name.endswith(".json")]
    for at, (folder, name) in enumerate(sorted(files)):
        storage._renew(spark, f"{root}/{folder}/{name}", 1_700_000_000 + at)
    path = lake.latest_file(spark, root, after="2023-11-14T00:00:00").first()["file_path"]
    rows = spark.read.option("basePath", root).schema("event_id long, day string, city string").json(path)
    return rows.groupBy("city", "day").agg(F.count("event_id").alias("n_events"))


# ---------------------------------------------------------------------------------------------------------------------
# Streams with a watermark

def _increments(spark: SparkSession, d: str) -> list[DataFrame]:
    """Three drops of events: the second repeats the first one's last days, the third brings what was held back."""
    ev = _events(spark, d)
    held = (F.col("event_type") == HELD_BACK) & (F.col("ts") < _time(HELD_BACK_TO))
    one, two = (_time(f"{c} 00:00:00") for c in STREAM_CUTS)
    repeats = F.date_sub(F.lit(STREAM_CUTS[0]).cast("date"), 2).cast("timestamp_ntz")
    return [ev.filter((F.col("ts") < one) & ~held), ev.filter((F.col("ts") >= repeats) & (F.col("ts") < two)),
            ev.filter((F.col("ts") >= two) | held)]


def _streamed(spark: SparkSession, d: str, name: str, transform) -> DataFrame:
    """What a stream has appended after a run for each drop of files."""
    root = _root(spark, name)
    for k, drop in enumerate(_increments(spark, d)):
        drop.write.parquet(f"{root}/landing/{k}")
        append_stream(spark, f"{root}/landing", drop.schema, transform, f"{root}/out", f"{root}/progress")
    return spark.read.parquet(f"{root}/out")


_NOT_HELD = f"NOT (event_type = '{HELD_BACK}' AND ts < TIMESTAMP '{HELD_BACK_TO}')"


@register("stream_dedupe", f"SELECT event_id, user_id, event_type, ts FROM events WHERE {_NOT_HELD}")
def q_stream_dedupe(spark, d):
    """Each event once, though days of events come twice; what comes after the watermark is left out."""
    rows = _streamed(spark, d, "dedupe", lambda s: dedupe_in_stream(s, ["event_id"], "ts", f"{LATENESS_DAYS} days"))
    return rows.select("event_id", "user_id", "event_type", "ts")


@register("stream_hourly_counts", f"""
WITH drops AS (
  SELECT event_type, ts FROM events WHERE {_NOT_HELD}
  UNION ALL
  SELECT event_type, ts FROM events
  WHERE ts >= DATE '{STREAM_CUTS[0]}' - INTERVAL 2 DAY AND ts < TIMESTAMP '{STREAM_CUTS[0]}')
SELECT UPPER(event_type) AS airport_code, date_trunc('hour', ts) AS date, COUNT(*) AS n FROM drops
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL {LATENESS_DAYS} DAY
GROUP BY 1, 2
""")
def q_stream_hourly_counts(spark, d):
    """Counts per type and hour, appended once the watermark has passed the hour; the last days are still open."""
    return _streamed(spark, d, "hourly", lambda s: hourly_counts_stream(s, "event_type", "ts", f"{LATENESS_DAYS} days"))
