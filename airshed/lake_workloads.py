"""Registered queries over landed files: the driver's tables are landed as the JSON and CSV files of the feeds, and the
lake readers, the file selection, the payload cleaning and the keyed writers run on them.

Landing is the collector's part: whole tables become files on shared storage, once per session and data directory. Events
stand in for flights, road segments and observations (files per event type and day, the type as city), suppliers for
airports, parts for the busiest-airports list. A group's records are dealt to as many files as their bytes ask for, so no
row and no file grows with the table. What makes a record odd (code-share, missing time, missing key) follows
from its event_id, so the oracle knows it too.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airshed.functions import clean, time as tfn
from airshed.operators import sinks, storage
from airshed.operators.aggregates import weighted_means
from airshed.plans import planning, views
from airshed.session import shared_path
from airshed.sources import lake, schemas
from airshed.sources.tables import Tables
from airshed.workloads import CUTOFF_HALF, _round, register

DAY = "2024-01-15"
FILE_BYTES = 32 << 20  # about as much text a landed file holds
_LANDED: dict[tuple[str, str, str], str] = {}


def _landed(spark: SparkSession, d: str, feed: str) -> str:
    """The folder of a feed's files, landed at the first call."""
    key = (spark.sparkContext.applicationId, d, feed)
    if key not in _LANDED:
        root = shared_path(spark, "landed", f"{feed}-{uuid.uuid4().hex}")
        if feed == "busiest":
            _land_busiest(Tables(spark, d), root)
        else:
            _land(_FEEDS[feed](Tables(spark, d)), root)
        _LANDED[key] = root
    return _LANDED[key]


def _land(files: DataFrame, root: str) -> None:
    """Write ``folder, name, head, text, tail`` rows as the files ``root/folder/name``: a file's head, its texts, a line
    each with commas between, and its tail. The writer passes the lines on, so no task holds a file. Only the names pass
    through the driver."""
    spark = files.sparkSession
    numbered = files.withColumn("n", F.xxhash64("folder", "name"))
    of_file = Window.partitionBy("n").orderBy("n")
    placed = numbered.select("n", "head", "text", "tail", F.row_number().over(of_file).alias("at"),
                             F.lead(F.lit(1)).over(of_file).isNull().alias("last"))
    line = F.concat(F.when(F.col("at") == 1, F.col("head")).otherwise(","), "text",
                    F.when(F.col("last"), F.col("tail")).otherwise(""))
    staging = f"{root}-parts"
    placed.select("n", "at", line.alias("text")).sortWithinPartitions("n", "at").select("n", "text") \
        .write.partitionBy("n").text(staging)
    for row in numbered.select("n", "folder", "name").distinct().collect():
        part = storage.names_in(spark, f"{staging}/n={row['n']}")
        storage.move(spark, f"{staging}/n={row['n']}/{part[0]}", f"{root}/{row['folder']}/{row['name']}")
    storage.delete(spark, staging)


def _whole(files: DataFrame) -> DataFrame:
    """``(folder, name, text)`` rows, each a file of its own, as :func:`_land` takes them."""
    return files.select("folder", "name", F.lit("").alias("head"), "text", F.lit("").alias("tail"))


def _dealt(rows: DataFrame, keys: list[str], size: Column, row_id: str, staged: bool = False) -> DataFrame:
    """The rows with ``slot``, the number (as text) of the file of their group that takes them: a hash of the row's id
    over as many files as the group's bytes ask for. With ``staged`` the groups, a small table, are written first and so
    measured once, whatever is asked of the rows."""
    files = rows.groupBy(*[F.col(k).alias(f"of_{k}") for k in keys]).agg(
        F.greatest(F.lit(1), F.ceil(F.sum(size) / FILE_BYTES)).alias("n_files"))
    if staged:
        files = sinks.staged_rewrite(files, "groups")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"of_{k}"))
    return rows.join(files, same).withColumn("slot", F.pmod(F.xxhash64(row_id), F.col("n_files")).cast("string"))


def _array(wrap: str = "") -> Column:
    """The array of a group's ``record`` texts, in a JSON object under ``wrap`` if given."""
    array = F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]"))
    return F.concat(F.lit('{"' + wrap + '":'), array, F.lit("}")) if wrap else array


def _arrays(events: DataFrame, record: Column, folder: Column, name: Column, wrap: str = "") -> DataFrame:
    """Files of the ``record`` texts of an event type and ``day``, an array each, in a JSON object under ``wrap`` if given;
    folder or name holds the file's ``slot``."""
    rows = events.withColumn("day", _stamp("ts", "yyyy-MM-dd"))
    dealt = _dealt(rows, ["event_type", "day"], F.octet_length(record), "event_id", staged=True)
    head, tail = ('{"' + wrap + '":[', "]}") if wrap else ("[", "]")
    return dealt.select(folder.alias("folder"), name.alias("name"), F.lit(head).alias("head"), record.alias("text"),
                        F.lit(tail).alias("tail"))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def _stamp(ts, fmt: str = "yyyy-MM-dd'T'HH:mm:ss.SSS") -> Column:
    return F.date_format(ts, fmt)


def _day_file() -> Column:
    return F.concat("slot", F.lit("_"), "day", F.lit(".json"))


def _every(n: int, rest: int = 0) -> Column:
    return F.col("event_id") % n == rest


# ---------------------------------------------------------------------------------------------------------------------
# Feeds

def _flight_files(t: Tables) -> DataFrame:
    ev = t.events
    late = F.timestamp_add("MINUTE", F.lit(30), F.col("ts"))
    actual = F.when(_every(11), F.lit(None)).when(_every(13), _stamp("ts", "yyyy-MM-dd'T'HH:mm:ss")) \
        .when(_every(5, 1), _stamp("ts", "yyyy-MM-dd't'HH:mm:ss.SSS")).otherwise(_stamp("ts"))
    code = F.concat(F.lit("C"), (F.col("user_id") % 40).cast("string"))
    side = lambda when: F.struct(code.alias("iataCode"), F.col("value").cast("string").alias("delay"),
                                 _stamp("ts").alias("scheduledTime"), when.alias("actualTime"),
                                 _stamp("ts").alias("estimatedTime"))
    record = F.to_json(F.struct(
        F.lit("arrival").alias("type"), F.col("event_type").alias("status"), side(_stamp(late)).alias("departure"),
        side(actual).alias("arrival"), F.struct(F.lit("Air").alias("name"), F.lit("").alias("iataCode")).alias("airline"),
        F.struct(F.when(_every(17), F.lit("")).otherwise(F.col("user_id").cast("string")).alias("number"),
                 F.lit("X1").alias("iataNumber")).alias("flight")))
    record = F.when(_every(7), F.regexp_replace(record, r"\}$", ',"codeshared":null}')).when(_every(23), F.lit("42")) \
        .otherwise(record)
    files = _arrays(ev, record, F.col("event_type"), F.concat(F.lit("XYZ"), "slot", F.lit("_"), "day", F.lit(".json")))
    odd = ev.sparkSession.createDataFrame(
        [("view", "CUT_2024-01-01.json", '[{"type": "arrival"'), ("view", "ONE_2024-01-01.json", '{"type": "arrival"}'),
         ("view", f"notes_{DAY}.txt", "not a feed")], "folder string, name string, text string")
    return files.unionByName(_whole(odd))


def _road_files(t: Tables) -> DataFrame:
    name = F.when(_every(9), F.lit(None)).when(_every(9, 1), F.lit("")) \
        .otherwise(F.concat(F.lit("R"), (F.col("user_id") % 20).cast("string")))
    flow = F.struct(_k().alias("speed"), (F.col("event_id") % 50).cast("double").alias("freeFlow"),
                    (F.col("event_id") % 10).cast("double").alias("jamFactor"))
    where = F.struct(name.alias("description"), F.col("value").alias("length")).alias("location")
    whole = F.to_json(F.struct(where, flow.alias("currentFlow")))
    lacking = F.to_json(F.struct(where, flow.dropFields("jamFactor").alias("currentFlow")))
    record = F.when(_every(19), lacking).otherwise(whole)
    return _arrays(t.events, record, F.concat("day", F.lit("/"), "slot"),
                   F.concat("event_type", F.lit("_"), "day", F.lit("T05--00--00_"), "day", F.lit("T08--00--00.json")))


def _road_payload_files(t: Tables) -> DataFrame:
    record = F.to_json(F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.col("event_type").alias("description"), F.col("value").alias("length"),
                 F.array(F.struct(F.col("event_id").alias("length"))).alias("subSegments"),
                 F.sequence(F.lit(1), (F.col("event_id") % 3 + 1)).alias("links")).alias("location"),
        F.struct(_k().alias("speed"), F.array(F.lit(1)).alias("subSegments"),
                 F.when(_every(2), F.lit(True)).alias("extra")).alias("currentFlow")))
    return _arrays(t.events, record, F.col("event_type"), _day_file(), wrap="results")


def _components() -> Column:
    return F.struct(*[(F.col("value") if p == "co" else F.when(_every(4), F.lit(None)).otherwise(_k())).alias(p)
                      for p in schemas.POLLUTANTS])


_NULLS = {"ignoreNullFields": "false"}


def _pollution_history_files(t: Tables) -> DataFrame:
    place = F.col("event_type").alias("place")
    rest = [(F.col("user_id") / 2).alias("latitude"), F.lit(None).cast("double").alias("longitude"),
            tfn.epoch_seconds("ts").alias("timestamp"), _stamp("ts", "yyyy-MM-dd HH:mm:ss").alias("date"),
            (F.col("event_id") % 5 + 1).cast("int").alias("air_quality_index"), _components().alias("components")]
    record = F.when(_every(19), F.to_json(F.struct(*rest), _NULLS)).otherwise(F.to_json(F.struct(place, *rest), _NULLS))
    return _arrays(t.events, record, F.col("event_type"), _day_file())


def _weather_history_files(t: Tables) -> DataFrame:
    record = F.to_json(F.struct(
        F.col("event_type").alias("place"), F.col("value").alias("latitude"), F.lit(None).cast("double").alias("longitude"),
        tfn.epoch_seconds("ts").alias("timestamp"), _stamp("ts", "yyyy-MM-dd HH:mm:ss").alias("date"),
        _k().alias("temperature"), F.hour("ts").alias("humidity"), F.minute("ts").alias("pressure"),
        F.col("value").alias("wind_speed"), F.upper("event_type").alias("weather_main"),
        F.col("props").alias("weather_description")), _NULLS)
    return _arrays(t.events, record, F.col("event_type"), _day_file())


def _payload_files(t: Tables) -> DataFrame:
    label = F.struct(F.upper("event_type").alias("main"), F.col("props").alias("description"))
    record = F.to_json(F.struct(
        tfn.epoch_seconds("ts").alias("dt"),
        F.struct((F.col("event_id") % 5 + 1).cast("int").alias("aqi"), _k().alias("temp"), F.hour("ts").alias("humidity"),
                 F.minute("ts").alias("pressure")).alias("main"),
        _components().alias("components"), F.struct(F.col("value").alias("speed")).alias("wind"),
        F.when(_every(6), F.array().cast("array<struct<main:string,description:string>>"))
        .otherwise(F.array(label, label)).alias("weather")), _NULLS)
    files = _arrays(t.events, record, F.col("event_type"), _day_file(), wrap="list")
    odd = t.spark.createDataFrame([("view", "cut.json", '{"list": [{"dt": 17'), ("view", "none.json", '{"cod": 200}')],
                                  "folder string, name string, text string")
    return files.unionByName(_whole(odd))


def _airport_files(t: Tables) -> DataFrame:
    airport = F.struct(
        F.lit("1").alias("GMT"), F.col("s_name").alias("codeIataAirport"), F.lit("C").alias("codeIataCity"),
        F.when(F.col("s_suppkey") % 4 == 0, F.lit("")).otherwise(F.lit("X")).alias("codeIcaoAirport"),
        F.col("n_regionkey").cast("string").alias("codeIso2Country"),
        F.col("s_acctbal").cast("decimal(10,6)").cast("string").alias("latitudeAirport"),
        F.col("s_suppkey").cast("string").alias("longitudeAirport"), F.col("s_name").alias("nameAirport"),
        F.col("n_name").alias("nameCountry"), F.lit("").alias("phone"), F.lit("UTC").alias("timezone"))
    each = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")) \
        .select("s_suppkey", "n_nationkey", "n_name", airport.alias("airport"))
    dealt = _dealt(each, ["n_nationkey", "n_name"], F.octet_length(F.to_json("airport")), "s_suppkey")
    name = F.concat(F.lit("airport_per_city_"), F.col("n_nationkey").cast("string"), F.lit("_"), "slot", F.lit(".json"))
    return dealt.groupBy(F.lit("map").alias("folder"), name.alias("name"), "n_name") \
        .agg(F.collect_list("airport").alias("airports")) \
        .select("folder", "name", F.to_json(F.create_map("n_name", "airports")).alias("text")).transform(_whole)


def _dimension_files(t: Tables) -> DataFrame:
    """Boxes, coordinates and calendar of the nations, each one small file."""
    key = F.col("n_nationkey").cast("double")
    box = F.struct(F.struct((key + 1).alias("lat"), key.alias("lon")).alias("topLeftPoint"),
                   F.struct(key.alias("lat"), (key + 2).alias("lon")).alias("btmRightPoint"))
    types = t.events.select("event_type").distinct()
    boxes = t.nation.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("n_name", box)))).alias("text")) \
        .select(F.lit("boxes").alias("folder"), F.lit("boxes.json").alias("name"), "text")
    coordinates = types.agg(F.to_json(F.struct(F.collect_list(F.struct(
        F.col("event_type").alias("city_name"), F.length("event_type").cast("double").alias("lat"),
        F.lit(2.5).alias("lon"))).alias("coordinates"))).alias("text")) \
        .select(F.lit("coordinates").alias("folder"), F.lit("config.json").alias("name"), "text")
    ordered = F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name", "n_regionkey")))
    calendar = t.nation.agg(ordered.alias("rows")).select(
        F.lit("calendar").alias("folder"), F.lit("config.json").alias("name"), F.to_json(F.struct(
            F.transform("rows", lambda r: r["n_name"]).alias("cities"),
            F.transform("rows", lambda r: r["n_regionkey"].cast("string")).alias("country_codes"),
            F.transform("rows", lambda r: r["n_nationkey"].cast("int")).alias("timezones"),
            F.transform("rows", lambda r: (r["n_nationkey"] % 2).cast("int")).alias("summer_time_addition"))).alias("text"))
    return _whole(boxes.unionByName(coordinates).unionByName(calendar))


def _land_busiest(t: Tables, root: str) -> None:
    """The busiest-airports list as CSV files, each with the header."""
    t.part.select(
        F.col("p_partkey").alias("Rank"), F.col("p_brand").alias("Country"),
        F.concat("p_type", F.lit(" Airport[3]")).alias("Airport"), F.concat("p_name", F.lit("[12]")).alias("City served"),
        F.concat(F.col("p_size").cast("string"), F.lit(","), F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"),
                 F.lit("[2]")).alias("Passengers 2023")).write.csv(f"{root}/csv", header=True, quote='"', escape='"')


_FEEDS = {"flights": _flight_files, "road": _road_files, "road-payloads": _road_payload_files,
          "pollution-history": _pollution_history_files, "weather-history": _weather_history_files,
          "payloads": _payload_files, "airports": _airport_files, "dimensions": _dimension_files}

# ---------------------------------------------------------------------------------------------------------------------
# Flights

_FLIGHTS_SQL = """
SELECT NULLIF(CASE WHEN event_id % 17 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END, '') AS flight_number,
       event_type AS status, 'C' || CAST(user_id % 40 AS VARCHAR) AS {side}_iata, {time} AS {side}_actual_time,
       CAST(trunc(value) AS INTEGER) AS departure_delay, NULL AS airline_iata, event_type AS city
FROM (SELECT *, date_trunc('millisecond', ts) AS ms FROM events)
WHERE event_id % 7 <> 0 AND event_id % 23 <> 0 AND hour({time}) IN (6, 7, 8) {more}
"""
_ARRIVAL_TIME = "AND event_id % 11 <> 0 AND event_id % 13 <> 0"


def _flight_columns(rows: DataFrame, side: str) -> DataFrame:
    return rows.select("flight_number", "status", f"{side}_iata", f"{side}_actual_time", "departure_delay", "airline_iata",
                       "city")


@register("lake_arrivals", _FLIGHTS_SQL.format(side="arrival", time="ms", more=_ARRIVAL_TIME))
def q_lake_arrivals(spark, d):
    return _flight_columns(lake.read_flights(spark, _landed(spark, d, "flights"), "arrival").rows, "arrival")


@register("lake_departures", _FLIGHTS_SQL.format(side="departure", time="(ms + INTERVAL 30 MINUTE)", more=""))
def q_lake_departures(spark, d):
    return _flight_columns(lake.read_flights(spark, _landed(spark, d, "flights"), "departure").rows, "departure")


@register("lake_day_files", _FLIGHTS_SQL.format(side="arrival", time="ms", more=_ARRIVAL_TIME)
          + f"AND CAST(ts AS DATE) = DATE '{DAY}'")
def q_lake_day_files(spark, d):
    load = lake.read_flights(spark, _landed(spark, d, "flights"), "arrival", glob=lake.day_glob(DAY))
    return _flight_columns(load.rows, "arrival")


@register("lake_flight_rejects", """
SELECT CASE WHEN event_id % 7 = 0 THEN 'codeshared' WHEN event_id % 23 = 0 THEN 'not_object'
            WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN 'no_actual_time'
            WHEN hour(ts) NOT IN (6, 7, 8) THEN 'outside_window' ELSE 'accepted' END AS reason, COUNT(*) AS n
FROM events GROUP BY 1 UNION ALL SELECT 'bad_file', 2
""")
def q_lake_flight_rejects(spark, d):
    return lake.read_flights(spark, _landed(spark, d, "flights"), "arrival").once().stats()


# ---------------------------------------------------------------------------------------------------------------------
# Road

_ROAD_SQL = """
WITH r AS (
  SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 5 HOUR AS date, event_type AS city,
         CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 9 = 1 THEN '' ELSE 'R' || CAST(user_id % 20 AS VARCHAR) END
           AS road, value AS length, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS speed,
         CAST(event_id % 50 AS DOUBLE) AS freeflow, CAST(event_id % 10 AS DOUBLE) AS jamfactor
  FROM events WHERE event_id % 19 <> 0)
"""


@register("lake_road", _ROAD_SQL + """
SELECT date, city, NULLIF(road, '') AS road, ROUND(SUM(length), 4) AS length,
       ROUND(SUM(speed * length) / NULLIF(SUM(length), 0), 6) AS speed,
       ROUND(SUM(freeflow * length) / NULLIF(SUM(length), 0), 6) AS freeflow,
       ROUND(SUM(jamfactor * length) / NULLIF(SUM(length), 0), 6) AS jamfactor
FROM r WHERE road IS NOT NULL GROUP BY date, city, road
""")
def q_lake_road(spark, d):
    rows = lake.read_road(spark, _landed(spark, d, "road")).rows
    means = weighted_means(rows, ["date", "city", "road"], "length", ["speed", "freeflow", "jamfactor"])
    named = means.withColumn("road", clean.blank_to_null("road"))
    return _round(_round(named, ["speed", "freeflow", "jamfactor"]), ["length"], 4)


@register("lake_road_day", _ROAD_SQL + f"""
SELECT date, city, COUNT(*) AS n_rows, COUNT(road) AS n_named FROM r
WHERE CAST(date AS DATE) = DATE '{DAY}' GROUP BY 1, 2
""")
def q_lake_road_day(spark, d):
    rows = lake.read_road(spark, _landed(spark, d, "road"), day=DAY).rows
    return rows.groupBy("date", "city").agg(F.count(F.lit(1)).alias("n_rows"), F.count("road").alias("n_named"))


@register("lake_road_month", _ROAD_SQL + """
SELECT city, COUNT(*) AS n_rows, COUNT(DISTINCT date) AS n_days FROM r WHERE date_trunc('month', date) = DATE '2024-01-01'
GROUP BY 1
""")
def q_lake_road_month(spark, d):
    rows = lake.read_road(spark, lake.month_dirs(_landed(spark, d, "road"), 2024, 1)).rows
    return rows.groupBy("city").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("date").alias("n_days"))


@register("lake_road_prune", """
SELECT event_id AS id, event_type AS description, value AS length, CAST(event_id % 3 + 1 AS INTEGER) AS n_links,
       event_id % 2 = 0 AS has_extra, FALSE AS has_segments
FROM events
""")
def q_lake_road_prune(spark, d):
    elem = lake.prune_road_payload(spark, _landed(spark, d, "road-payloads"))
    get = lambda path: F.get_json_object("elem", path)
    return elem.select(
        get("$.id").cast("long").alias("id"), get("$.location.description").alias("description"),
        get("$.location.length").cast("double").alias("length"),
        F.json_array_length(get("$.location.links")).alias("n_links"),
        get("$.currentFlow.extra").isNotNull().alias("has_extra"),
        (get("$.location.subSegments").isNotNull() | get("$.currentFlow.subSegments").isNotNull()).alias("has_segments"))


# ---------------------------------------------------------------------------------------------------------------------
# Pollution and weather

_OBSERVED = """
SELECT event_type AS place, epoch_us(ts) // 1000000 AS timestamp, date_trunc('second', ts) AS date,
       CAST(event_id % 5 + 1 AS INTEGER) AS air_quality_index, value AS co,
       CASE WHEN event_id % 4 <> 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS nh3
FROM events
"""
_OBSERVED_COLUMNS = ["place", "timestamp", "date", "air_quality_index", "co", "nh3"]


@register("lake_pollution_history", _OBSERVED + "WHERE event_id % 19 <> 0")
def q_lake_pollution_history(spark, d):
    load = lake.read_pollution_history(spark, _landed(spark, d, "pollution-history"))
    return views.air_pollution_view(load.rows.select("timestamp", "place", "date", "air_quality_index",
                                                     *schemas.POLLUTANTS)).select(
        "place", tfn.epoch_seconds("date").alias("timestamp"), "date", "air_quality_index", "co", "nh3")


@register("lake_weather_history", """
SELECT event_type AS place, date_trunc('second', ts) AS date, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS temperature,
       CAST(hour(ts) AS INTEGER) AS humidity, CAST(minute(ts) AS INTEGER) AS pressure, value AS wind_speed,
       UPPER(event_type) AS weather_main
FROM events WHERE event_type = 'click'
""")
def q_lake_weather_history(spark, d):
    rows = views.weather_view(lake.read_weather_history(spark, _landed(spark, d, "weather-history")).rows)
    return rows.filter(F.col("place") == "click")


@register("lake_pollution_payloads", "SELECT o.*, CAST(length(place) AS DOUBLE) AS latitude FROM (" + _OBSERVED
          + "WHERE hour(ts) IN (6, 7, 8, 9)) o")
def q_lake_pollution_payloads(spark, d):
    places = lake.read_city_coordinates(spark, _landed(spark, d, "dimensions") + "/coordinates")
    load = lake.read_pollution_payloads(spark, _landed(spark, d, "payloads"), coordinates=places)
    return load.rows.select(*_OBSERVED_COLUMNS, "latitude")


@register("lake_weather_payloads", """
SELECT event_type AS place, epoch_us(ts) // 1000000 AS timestamp, CAST(hour(ts) AS INTEGER) AS humidity,
       value AS wind_speed, CASE WHEN event_id % 6 <> 0 THEN UPPER(event_type) END AS weather_main
FROM events WHERE hour(ts) IN (6, 7, 8, 9)
""")
def q_lake_weather_payloads(spark, d):
    load = lake.read_weather_payloads(spark, _landed(spark, d, "payloads"))
    return load.rows.select("place", "timestamp", "humidity", "wind_speed", "weather_main")


@register("lake_payload_rejects", """
SELECT 'accepted' AS reason, COUNT(*) AS n FROM events WHERE hour(ts) IN (6, 7, 8, 9)
UNION ALL SELECT 'bad_file', 1 UNION ALL SELECT 'no_list', 1
""")
def q_lake_payload_rejects(spark, d):
    return lake.read_pollution_payloads(spark, _landed(spark, d, "payloads")).stats()


@register("history_round_trip", _OBSERVED + "WHERE hour(ts) IN (6, 7, 8, 9)")
def q_history_round_trip(spark, d):
    """Payloads → history records on shared storage → the history reader."""
    rows = lake.read_pollution_payloads(spark, _landed(spark, d, "payloads")).rows
    path = shared_path(spark, "history", uuid.uuid4().hex)
    day = F.to_date(tfn.epoch_to_utc("timestamp"))
    lake.write_lake_json(lake.history_records(rows.withColumn("day", day), "pollution"), path, partition_by=["day"])
    return lake.read_pollution_history(spark, path).rows.select(*_OBSERVED_COLUMNS)


# ---------------------------------------------------------------------------------------------------------------------
# Dimensions

@register("lake_airports", """
SELECT n_name AS city_name, s_name AS code_iata_airport, CAST(n_regionkey AS VARCHAR) AS code_iso2_country,
       CAST(s_acctbal AS DECIMAL(10, 6)) AS latitude
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def q_lake_airports(spark, d):
    return lake.read_airports(spark, _landed(spark, d, "airports") + "/map").select(
        "city_name", "code_iata_airport", "code_iso2_country", "latitude")


@register("lake_busiest", r"""
SELECT CAST(p_partkey AS INTEGER) AS rank, trim(regexp_replace(p_brand, '\d+$', '')) AS country,
       p_type || ' Airport' AS airport, p_name AS city_served,
       CAST(CAST(p_size AS VARCHAR) || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS BIGINT) AS passengers
FROM part
""")
def q_lake_busiest(spark, d):
    return lake.read_busiest_airports(spark, _landed(spark, d, "busiest") + "/csv")


@register("lake_city_boxes", """
SELECT n_name AS city, CAST(n_nationkey AS DOUBLE) AS west, CAST(n_nationkey AS DOUBLE) AS south,
       CAST(n_nationkey + 2 AS DOUBLE) AS east, CAST(n_nationkey + 1 AS DOUBLE) AS north
FROM nation
""")
def q_lake_city_boxes(spark, d):
    return lake.read_city_boxes(spark, _landed(spark, d, "dimensions") + "/boxes")


@register("lake_calendar", """
SELECT n_name AS city, CAST(n_regionkey AS VARCHAR) AS country_code, CAST(n_nationkey AS INTEGER) AS utc_offset,
       CAST(n_nationkey % 2 AS INTEGER) AS summer_shift
FROM nation
""")
def q_lake_calendar(spark, d):
    return lake.read_calendar(spark, _landed(spark, d, "dimensions") + "/calendar")


def _answers(t: Tables) -> DataFrame:
    """Landed lookup answers per nation: the suppliers of its region, each with its own nation, in pages."""
    airport = F.struct(F.col("o.n_name").alias("nameCountry"),
                       F.when(F.col("s_suppkey") % 4 == 0, F.lit("")).otherwise(F.lit("ICAO")).alias("codeIcaoAirport"),
                       F.when(F.col("s_suppkey") % 5 == 0, F.lit("")).otherwise(F.col("s_name")).alias("codeIataAirport"))
    each = t.supplier.join(t.nation.alias("o"), F.col("s_nationkey") == F.col("o.n_nationkey")) \
        .select("s_suppkey", "n_regionkey", F.to_json(airport).alias("record"))
    pages = _dealt(each, ["n_regionkey"], F.octet_length("record"), "s_suppkey").groupBy("n_regionkey", "slot") \
        .agg(_array("airportsByCities").alias("payload"))
    return t.nation.select(F.col("n_name").alias("city"), F.col("n_name").alias("country"), "n_regionkey") \
        .join(pages, "n_regionkey").select("city", "country", "payload")


@register("lookup_filter", """
SELECT n_name AS city, COUNT(*) AS n_airports FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE s_suppkey % 4 <> 0 GROUP BY 1
""")
def q_lookup_filter(spark, d):
    pages = lake.filter_lookup(_answers(Tables(spark, d)))
    return pages.groupBy("city").agg(F.sum(F.size("airports")).alias("n_airports"))


@register("lookup_codes", "SELECT s_name AS code FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey % 5 <> 0")
def q_lookup_codes(spark, d):
    return lake.lookup_codes(lake.filter_lookup(_answers(Tables(spark, d))))


@register("geocode_first_hit", """
SELECT n_name AS city_name, CAST(n_nationkey AS DOUBLE) AS lat, CAST(n_regionkey AS DOUBLE) AS lon
FROM nation WHERE n_nationkey % 6 <> 0
""")
def q_geocode_first_hit(spark, d):
    hit = lambda lat, lon: F.struct(F.col("n_name").alias("name"), lat.cast("double").alias("lat"),
                                    lon.cast("double").alias("lon"))
    hits = F.to_json(F.array(hit(F.col("n_nationkey"), F.col("n_regionkey")), hit(F.lit(0), F.lit(0))))
    answers = Tables(spark, d).nation.select(
        F.col("n_name").alias("city"), F.when(F.col("n_nationkey") % 6 == 0, F.lit("[]")).otherwise(hits).alias("payload"))
    return lake.geocode_first_hit(answers)


# ---------------------------------------------------------------------------------------------------------------------
# Planning, parsing and quality

@register("planning_days", """
WITH u AS (SELECT user_id, MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events GROUP BY 1)
SELECT user_id, CAST(1 AS INTEGER) AS seg_no, hi AS seg_start, hi AS seg_end, CAST(hi - lo + 1 AS INTEGER) AS n_days,
       CAST(hi AS TIMESTAMP) - INTERVAL 28 DAY AS oldest_week
FROM u
""")
def q_planning_days(spark, d):
    spans = Tables(spark, d).events.groupBy("user_id").agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi"))
    weeks = planning.rolling_weeks(F.col("hi").cast("timestamp_ntz"), 4)
    extra = spans.select("user_id", "hi", F.size(planning.day_range("lo", "hi")).alias("n_days"),
                         F.get(weeks, 0)["week_start"].alias("oldest_week"))
    return planning.daily_segment(extra, "hi", keep=["user_id", "n_days", "oldest_week"])


@register("parse_ts_strict", "SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def q_parse_ts_strict(spark, d):
    text = F.when(F.col("event_id") % 2 == 0, _stamp("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(
        _stamp("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    formats = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss"]
    return Tables(spark, d).events.select("event_id", tfn.parse_ts_multi(text, formats, strict=True).alias("parsed"))


@register("flow_quality", """
SELECT p_brand, COUNT(*) AS n_parts FROM part
WHERE p_size / 5.0 BETWEEN 0 AND 9.9 AND p_partkey % 5 IN (1, 2, 3) GROUP BY 1
""")
def q_flow_quality(spark, d):
    part = Tables(spark, d).part
    good = part.filter(clean.flow_quality(F.col("p_size") / 5.0, F.col("p_partkey") % 5))
    return good.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_parts"))


# ---------------------------------------------------------------------------------------------------------------------
# Keyed writers on storage

@register("upsert_round_trip", f"""
WITH u AS (
  SELECT user_id, event_type, event_id, value, CASE WHEN user_id % 10 > 0 THEN CAST(user_id % 10 AS INTEGER) END AS slot,
         CASE WHEN ts < TIMESTAMP '{CUTOFF_HALF}' THEN 0 ELSE 1 END AS load
  FROM events)
SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id, value, slot
FROM u ORDER BY user_id, event_type, load DESC, event_id DESC
""")
def q_upsert_round_trip(spark, d):
    """Two upserts into a partitioned table on storage (rows without a partition value among them), read back."""
    ev = Tables(spark, d).events
    slot = F.when(F.col("user_id") % 10 > 0, (F.col("user_id") % 10).cast("int"))
    rows = ev.select("user_id", "event_type", "event_id", "value", slot.alias("slot"), "ts")
    path, cut = shared_path(spark, "upserts", uuid.uuid4().hex), F.lit(CUTOFF_HALF).cast("timestamp_ntz")
    for part in (rows.filter(F.col("ts") < cut), rows.filter(F.col("ts") >= cut)):
        sinks.upsert_table(path, part.drop("ts"), ["user_id", "event_type"], ["event_id"], "slot")
    return spark.read.parquet(path)
