"""The scheduled jobs of the warehouse, composed from the readers, sinks and views.

* flights (daily or bulk): lake files → flattened rows → insert-if-absent into ``arrivals`` / ``departures``;
* flights as a stream: the files that arrived since the last run, each exactly once;
* observations: landed pollution / weather payloads → history lake (partitioned append) → upsert into
  ``air_pollution_data`` / ``weather_data`` (only the touched days are rewritten);
* road: lake files → per-road length-weighted means → strict append into ``road_traffic``, or a full reload;
* refresh: all six views rebuilt from the tables, in dependency order, or the days only that loads have touched.

Tables live under one warehouse folder as Parquet, partitioned by day, each file in order of the table's lookup columns.
A table that is missing counts as empty; one that cannot be read fails the job. A load opens the day folders that its
rows fall in, adds its files all or none, and notes its days for the refresh. Every job is a handful of distributed
Spark jobs; the driver only sees row counts, days, folder names and the yes/no of a strict-append conflict.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions.clean import blank_to_null
from airshed.functions.time import epoch_to_utc
from airshed.operators import storage
from airshed.operators.aggregates import weighted_means
from airshed.operators.sinks import (append_rows, dedupe_by_key, insert_if_absent, partition_values, strict_append,
                                      upsert_table, write_table)
from airshed.plans import changes, views
from airshed.plans.refresh import RefreshReport, Scope, refresh_views
from airshed.sources import lake
from airshed.streaming.ingest import incremental_ingest

# The unique keys of the warehouse tables.
TABLE_KEYS = {
    "arrivals": ["flight_number", "arrival_scheduled_time", "arrival_actual_time"],
    "departures": ["flight_number", "departure_scheduled_time", "departure_actual_time"],
    "road_traffic": ["date", "city", "road"],
    "air_pollution_data": ["timestamp", "place"],
    "weather_data": ["timestamp", "place"],
}


# The columns that queries look up in a table; its files are in their order.
TABLE_LOOKUP = {
    "arrivals": ["arrival_iata", "arrival_actual_time"],
    "departures": ["departure_iata", "departure_actual_time"],
    "road_traffic": ["city", "road"],
    "air_pollution_data": ["place", "timestamp"],
    "weather_data": ["place", "timestamp"],
}


@dataclass
class Warehouse:
    root: str

    def path(self, table: str) -> str:
        return os.path.join(self.root, table)

    def read(self, spark: SparkSession, table: str) -> DataFrame | None:
        return storage.read_if_exists(spark, self.path(table))

    def read_days(self, spark: SparkSession, table: str, days) -> DataFrame | None:
        """The table's rows of these days; only their folders are opened."""
        return storage.read_partitions(spark, self.path(table), "day", days)


def _flight_rows(load: lake.Load, direction: str) -> DataFrame:
    """The table's rows. It is partitioned by the day of the direction's actual time, which is part of the key: only
    target partitions inside a batch's day range can conflict, and only those are read."""
    return load.rows.drop("city", "file_path").withColumn("day", F.to_date(f"{direction}_actual_time"))


def _order(rows: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in rows.columns if c not in keys]  # total order over the record → deterministic pick


def load_flights(spark: SparkSession, wh: Warehouse, lake_dir: str, direction: str = "arrival",
                 day: str | None = None) -> lake.Load:
    """Load one day (``day``) or every file of a direction; existing keys win, NULL keys never conflict."""
    where = lake.day_paths(spark, lake_dir, day) if day else lake_dir
    load = lake.read_flights(spark, where, direction, glob=lake.day_glob(day) if day else "*.json").once()
    table = f"{direction}s"
    keys, rows = TABLE_KEYS[table], _flight_rows(load, direction)
    days = partition_values(rows, "day")
    target = wh.read_days(spark, table, [d for d in days if d is not None])  # a NULL in the key never conflicts
    new = insert_if_absent(rows.limit(0) if target is None else target, rows, keys, _order(rows, keys))
    changes.note(spark, wh.root, table, days)
    append_rows(wh.path(table), new, partition_by=["day"], sort_within=TABLE_LOOKUP[table])
    return load


def ingest_flights(spark: SparkSession, wh: Warehouse, lake_dir: str, checkpoint_path: str,
                   direction: str = "arrival") -> None:
    """As :func:`load_flights`, for the files that came since the last run of the same checkpoint folder."""
    table = f"{direction}s"
    example = _flight_rows(lake.flights_from_files(lake.read_files(spark, lake_dir), direction), direction)
    keys = TABLE_KEYS[table]
    incremental_ingest(
        spark, lake_dir, None, wh.path(table), checkpoint_path, keys, _order(example, keys), source_format="text",
        glob="*.json", reader_options={"wholetext": "true"}, prepare=lake.with_file_columns,
        transform=lambda files: _flight_rows(lake.flights_from_files(files, direction), direction),
        partition_col="day", prune_col="day", sort_within=TABLE_LOOKUP[table],
        touched=lambda days: changes.note(spark, wh.root, table, days))


# The reader of landed payloads, the reader of histories and the table of each kind of observation.
OBSERVATIONS = {
    "pollution": (lake.read_pollution_payloads, lake.read_pollution_history, "air_pollution_data"),
    "weather": (lake.read_weather_payloads, lake.read_weather_history, "weather_data"),
}


def _observation_kind(kind: str):
    if kind not in OBSERVATIONS:
        raise ValueError("kind must be 'pollution' or 'weather'")
    return OBSERVATIONS[kind]


def _day(rows: DataFrame) -> DataFrame:
    """The day comes from the key (the timestamp), so a key has one partition whatever its ``date`` text says."""
    return rows.withColumn("day", F.to_date(epoch_to_utc("timestamp")))


def _upsert_observations(wh: Warehouse, load: lake.Load, table: str) -> DataFrame:
    """Inside one load the last record of a key wins (file order, then position in the file)."""
    keys = TABLE_KEYS[table]
    keyed = load.rows.filter(F.col("timestamp").isNotNull() & F.col("place").isNotNull())
    rows = _day(dedupe_by_key(keyed, keys, ["source_file", "source_pos"], keep="last")
                .drop("source_file", "source_pos"))
    spark = rows.sparkSession
    # The views go by the date, which may be another day than the key's; the dates that are replaced count too.
    dates, before = rows.select("date"), wh.read_days(spark, table, partition_values(rows, "day"))
    dates = dates if before is None else dates.union(before.select("date"))
    changes.note(spark, wh.root, table, partition_values(dates.select(F.to_date("date").alias("day")), "day"))
    upsert_table(wh.path(table), rows, keys, ["date"], partition_col="day", sort_within=TABLE_LOOKUP[table])
    return rows


def load_observations(spark: SparkSession, wh: Warehouse, payload_dir: str, kind: str, history_dir: str | None = None,
                      coordinates: DataFrame | None = None) -> lake.Load:
    """Landed pollution or weather responses → optional history lake append → upsert by (timestamp, place)."""
    reader, _, table = _observation_kind(kind)
    load = reader(spark, payload_dir, coordinates=coordinates, with_source=True).once()
    if history_dir:
        lake.write_lake_json(lake.history_records(_day(load.rows), kind), history_dir, partition_by=["day"],
                             mode="append")
    _upsert_observations(wh, load, table)
    return load


def import_history(spark: SparkSession, wh: Warehouse, history_dir: str, kind: str) -> lake.Load:
    """History lake files (arrays of records, or the lines that :func:`load_observations` writes) → upsert by
    (timestamp, place); inside the import the last record of a key wins; records missing a required key are rejected
    (see the returned load's ``rejects``)."""
    _, reader, table = _observation_kind(kind)
    load = reader(spark, history_dir, with_source=True).once()
    _upsert_observations(wh, load, table)
    return load


def load_road(spark: SparkSession, wh: Warehouse, lake_dir: str, glob: str = "*.json", strict: bool = True,
              day: str | None = None, reload: bool = False, name: str | None = None) -> lake.Load:
    """Road files → per (window start, city, road) length-weighted means → strict append (a repeated key aborts).

    ``day`` takes the files with that day in their name. ``reload`` replaces the whole table instead of appending. A load
    that is given a ``name`` and runs again takes its former rows back first, so it doesn't collide with itself.
    Roads without a name are left out, those with an empty one are grouped and stored without a name.
    """
    load = lake.read_road(spark, lake_dir, glob=glob, strict=strict, day=day)
    if not strict:
        load = load.once()
    means = weighted_means(load.rows, ["date", "city", "road"], "length", ["speed", "freeflow", "jamfactor"])
    per_road = means.withColumn("road", blank_to_null("road")).withColumn("day", F.to_date("date"))
    path, sort = wh.path("road_traffic"), TABLE_LOOKUP["road_traffic"]
    if reload:
        changes.note(spark, wh.root, "road_traffic", None)
        write_table(per_road, path, ["day"], sort)
        return load
    keys, days = TABLE_KEYS["road_traffic"], partition_values(per_road, "day")
    changes.note(spark, wh.root, "road_traffic", days)
    if name is not None:
        storage.remove_batch(spark, path, name)
    # Partitioned by day (a function of the key's window start): the collision check opens the batch's days only.
    target = wh.read_days(spark, "road_traffic", days)
    strict_append(path, per_road.limit(0) if target is None else target, per_road, keys, partition_by=["day"],
                  sort_within=sort, load=name)
    return load


def load_airports(spark: SparkSession, wh: Warehouse, airport_map_dir: str) -> lake.Load:
    """Airport dimension, reloaded whole (deduplicated on the IATA code). A map file that does not parse fails the load
    and leaves the table as it is: an empty dimension would empty every view that joins it."""
    load = lake.read_airport_map(spark, airport_map_dir).once()
    bad = load.rejects.head(1)
    if bad:
        raise ValueError(f"airport load refused: {bad[0]['reason']} in {bad[0]['file_path']}")
    changes.note(spark, wh.root, "airports", None)
    write_table(load.rows, wh.path("airports"))
    return load


# The day column each view is partitioned by (every view row belongs to one day of data).
VIEW_DAY = {"flights_v": "day", "air_pollution_v": "day", "road_traffic_v": "traffic_date", "weather_v": "day",
            "master_view_v": "date"}


# The tables that each view is made of, at first or second hand.
VIEW_SOURCES = {
    "flights_v": ["arrivals", "departures"],
    "city_airports_v": ["airports"],
    "air_pollution_v": ["air_pollution_data"],
    "road_traffic_v": ["road_traffic"],
    "weather_v": ["weather_data"],
    "master_view_v": ["arrivals", "departures", "airports", "air_pollution_data", "road_traffic", "weather_data"],
}


def _refresh(spark: SparkSession, wh: Warehouse, views_dir: str, scopes: dict[str, Scope],
             order: list[str]) -> RefreshReport:
    """Rebuild the views of ``order``, those with a scope for its days only."""

    def whole(name):
        df = wh.read(spark, name)
        if df is None:
            raise FileNotFoundError(f"{wh.path(name)}: no such table")
        return df

    def table(name, view):
        """A table of the days that a view is rebuilt for."""
        scope = scopes.get(view)
        some = wh.read_days(spark, name, scope.days) if scope and scope.days is not None else None
        if some is not None:
            return some
        return whole(name).filter(scope.rows("day")) if scope else whole(name)

    def dated(name, view):
        """Observations by their date, which may be another day than that of the folder they are in."""
        scope, df = scopes.get(view), whole(name)
        if scope is None:
            return df
        known = sorted(d for d in scope.days or () if d is not None)
        of_day = df.withColumn("_of", F.to_date("date")).filter(scope.rows("_of")).drop("_of")
        if scope.days is None:
            return of_day.filter(F.col("date") >= F.lit(scope.since).cast("timestamp_ntz"))
        if None in scope.days or not known:
            return of_day
        first, last = (F.lit(d.isoformat()).cast("timestamp_ntz") for d in (known[0], known[-1]))
        return of_day.filter((F.col("date") >= first) & (F.col("date") < last + F.expr("INTERVAL 1 DAY")))

    def view(name):
        """A written view, of the days that the master view is rebuilt for."""
        scope, path = scopes.get("master_view_v"), os.path.join(views_dir, name)
        if name not in VIEW_DAY or scope is None:
            return storage.read_if_exists(spark, path)
        some = None if scope.days is None else storage.read_partitions(spark, path, VIEW_DAY[name], scope.days)
        return some if some is not None else storage.read_if_exists(spark, path).filter(scope.rows(VIEW_DAY[name]))

    def by_day(df, ts_col):
        return df.withColumn("day", F.to_date(ts_col))

    builders = {
        "flights_v": lambda: by_day(views.flights_view(table("arrivals", "flights_v"),
                                                       table("departures", "flights_v")), "date"),
        "city_airports_v": lambda: views.city_airports_view(table("airports", "city_airports_v")),
        "air_pollution_v": lambda: by_day(views.air_pollution_view(dated("air_pollution_data", "air_pollution_v")),
                                          "date"),
        "road_traffic_v": lambda: views.road_traffic_view(table("road_traffic", "road_traffic_v")),
        "weather_v": lambda: by_day(views.weather_view(dated("weather_data", "weather_v")), "date"),
        "master_view_v": lambda: views.master_view(view("flights_v"), view("city_airports_v"), view("road_traffic_v"),
                                                   view("air_pollution_v"), view("weather_v")),
    }
    return refresh_views({v: builders[v] for v in order}, views_dir,
                         partition_by={k: [v] for k, v in VIEW_DAY.items()}, scopes=scopes)


def refresh_all(spark: SparkSession, wh: Warehouse, views_dir: str, since: str | None = None) -> RefreshReport:
    """Rebuild the six views from the warehouse tables (each view reads the written upstream views).

    Views are partitioned by day. Every view row depends only on the data of its own day, so ``since`` ('YYYY-MM-DD')
    recomputes just the days from ``since`` on — reading only those days of the tables (filters reach the scans,
    partition pruning for the day-partitioned tables) — and replaces exactly those partitions. Without ``since`` the
    whole history is rebuilt. The city-airport dimension is always rebuilt whole.
    """
    if since:
        return _refresh(spark, wh, views_dir, {v: Scope(since) for v in VIEW_DAY}, list(VIEW_SOURCES))
    noted = _noted(spark, wh)
    report = _refresh(spark, wh, views_dir, {}, list(VIEW_SOURCES))
    if report.ok:
        changes.forget(spark, noted.values())
    return report


def _noted(spark: SparkSession, wh: Warehouse) -> dict[str, changes.Changes]:
    return {t: changes.pending(spark, wh.root, t) for t in VIEW_SOURCES["master_view_v"]}


def refresh_changed(spark: SparkSession, wh: Warehouse, views_dir: str) -> RefreshReport:
    """Bring the views up to date with what loads have touched since the last refresh, however late the data are.

    The loads have noted their days. A view is rebuilt for the days of its tables only, and whole where it isn't there
    yet or one of its tables was replaced; a view without a change is left as it is. The notes go once all views are
    done; a refresh that fails leaves them for the next one.
    """
    noted = _noted(spark, wh)
    scopes, order = {}, []
    for name, tables in VIEW_SOURCES.items():
        there = bool(storage.names_in(spark, os.path.join(views_dir, name)))
        if not there or any(noted[t].whole for t in tables):
            order.append(name)
        elif days := frozenset().union(*[noted[t].days for t in tables]):
            order.append(name)
            scopes[name] = Scope(days=days)
    report = _refresh(spark, wh, views_dir, scopes, order)
    if report.ok:
        changes.forget(spark, noted.values())
    return report
