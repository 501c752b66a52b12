"""Registered queries: the package's operators applied to the driver's TPC-H-like tables, each paired with an
equivalent DuckDB SQL text that serves as an independent oracle.

The driver tables are not flights or air-quality feeds, so each query maps them onto the operator by analogy
(``events`` rows stand in for flights and sensor observations, ``customer → nation`` for airport → city, ``lineitem``
measures for road and pollution readings). Every query reads whole tables; the only row limit is the top-k query,
where the limit is the feature. Doubles are rounded to 6 places (money to 2) with the same arithmetic on both sides,
so summation order cannot change the comparison; the averaged measures of the master view's analog are integer-valued, so
every sum is exact.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions import clean, time as tfn
from airshed.operators import aggregates as agg
from airshed.operators import joins, latest, sinks, stats
from airshed.operators.percentile import exact_percentile
from airshed.plans import planning, views
from airshed.sources.tables import Tables


@dataclass(frozen=True)
class Workload:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Workload] = {}


def register(name: str, sql: str | None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = Workload(name, fn, sql)
        return fn
    return deco


def _fixed(c, places: int = 6):
    """Round a double to ``places`` decimals as ``round(x * 10^p) / 10^p`` — the same arithmetic as the oracle's
    ROUND(x, p), so values lying exactly on a half-way tie round the same way in both engines."""
    scale = float(10 ** places)
    return F.round(F.col(c) * scale if isinstance(c, str) else c * scale) / scale


def _round(df: DataFrame, cols, places: int = 6) -> DataFrame:
    return df.select(*[_fixed(c, places).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------------------------------------------------------------
# Parameters shared by the Spark side and the SQL side (they are the caller's inputs, not data).
CUTOFF_MIDDAY = "2024-01-15 12:00:00"
CUTOFF_HALF = "2024-01-16 00:00:00"
NOW_EPOCH = 1707523200  # 2024-02-10 00:00:00 UTC, the planning "now"
VOLUME_WIDTH = 2  # flight counts of the analog are small, so the bucket width shrinks with them
NATION_SYNONYMS = {"NATION_10": "NATION_1", "NATION_20": "NATION_2"}
ALLOWED_REGIONS = ["EUROPE", "ASIA", "AMERICA"]
TARGET_PRIORITIES = ["1-URGENT", "2-HIGH"]
DAILY_LIMITS = {"purchase": 250.0, "view": 250.0, "click": 300.0, "error": 200.0, "signup": 275.0}
# An IANA zone, a standard UTC offset and a summer shift per region of the analog calendar.
REGION_ZONES = {
    "AFRICA": ("Africa/Cairo", 2, 1),
    "AMERICA": ("America/New_York", -5, 1),
    "ASIA": ("Asia/Tokyo", 9, 0),
    "EUROPE": ("Europe/Zurich", 1, 1),
    "MIDDLE EAST": ("Asia/Dubai", 4, 0),
}


def _sql_in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _sql_bucket(col: str, width: int, buckets: int = 10) -> str:
    whens = " ".join(f"WHEN {col} <= {b * width} THEN {b}" for b in range(1, buckets))
    return f"CASE {whens} ELSE {buckets} END"


def _sql_synonyms(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE {col} END"


# ---------------------------------------------------------------------------------------------------------------------
# Slice 1: flights view (hourly counts + full outer merge)

@register("hourly_count", """
SELECT UPPER(event_type) AS airport_code, date_trunc('hour', ts) AS date, COUNT(*) AS no_arrivals
FROM events WHERE event_type = 'purchase' AND hour(ts) BETWEEN 6 AND 9
GROUP BY 1, 2
""")
def q_hourly_count(spark, d):
    ev = Tables(spark, d).events
    return agg.hourly_counts(ev, "event_type", "ts", "no_arrivals", status_col="event_type", status_value="purchase")


def _flights_v(arrivals: DataFrame, departures: DataFrame) -> DataFrame:
    code = F.col("user_id").cast("string")
    return views.flights_view(arrivals, departures, arrival_code=code, arrival_ts="ts", departure_code=code,
                              departure_ts="ts", arrival_status="purchase", departure_status="view",
                              status_col="event_type")


@register("full_outer_hourly", """
SELECT UPPER(CAST(user_id AS VARCHAR)) AS airport_code, date_trunc('hour', ts) AS date,
       COUNT(*) FILTER (event_type = 'purchase') AS no_arrivals, COUNT(*) FILTER (event_type = 'view') AS no_departures,
       COUNT(*) AS no_total_flights
FROM events WHERE event_type IN ('purchase', 'view') AND hour(ts) BETWEEN 6 AND 9
GROUP BY ALL
""")
def q_full_outer_hourly(spark, d):
    # Two handles of the table, as with two feeds: counted apart and merged by the full outer join.
    return _flights_v(Tables(spark, d).events, Tables(spark, d).events)


@register("hour_window_filter", """
SELECT CAST(ts AS DATE) AS date,
       CAST(SUM(CASE WHEN hour(ts) >= 6 AND hour(ts) < 9 THEN 1 ELSE 0 END) AS BIGINT) AS n_6_to_9_loader,
       CAST(SUM(CASE WHEN hour(ts) >= 6 AND hour(ts) < 10 THEN 1 ELSE 0 END) AS BIGINT) AS n_6_to_10_sensor,
       CAST(SUM(CASE WHEN hour(ts) BETWEEN 6 AND 9 THEN 1 ELSE 0 END) AS BIGINT) AS n_6_to_9_view
FROM events GROUP BY 1
""")
def q_hour_window_filter(spark, d):
    ev = Tables(spark, d).events
    return agg.window_counts(ev, "ts", {"n_6_to_9_loader": (6, 9, False), "n_6_to_10_sensor": (6, 10, False),
                                        "n_6_to_9_view": (6, 9, True)})


# ---------------------------------------------------------------------------------------------------------------------
# Dimension roll-ups and buckets

@register("dim_rollup", """
SELECT n.n_name AS nation, CAST(o.o_orderdate AS DATE) AS date, COUNT(*) AS n_orders,
       ROUND(SUM(o.o_totalprice), 2) AS total_price
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2
""")
def q_dim_rollup(spark, d):
    t = Tables(spark, d)
    # Aggregate the fact to (customer, day) before it meets the dimension: a customer holding a third of all orders
    # shrinks to one row per day per map task before any shuffle.
    per_cust = (t.orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("date"))
                .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total_price")))
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    rolled = (per_cust.join(cust, "o_custkey").join(nation, "c_nationkey")
              .groupBy("nation", "date").agg(F.sum("n_orders").alias("n_orders"),
                                             _fixed(F.sum("total_price"), 2).alias("total_price")))
    return rolled


@register("volume_bucket", f"""
SELECT nation, month, n_orders, {_sql_bucket('n_orders', VOLUME_WIDTH)} AS custom_group FROM (
  SELECT n.n_name AS nation, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month, COUNT(*) AS n_orders
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2)
""")
def q_volume_bucket(spark, d):
    t = Tables(spark, d)
    per_cust = (t.orders.groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("month"))
                .agg(F.count(F.lit(1)).alias("n_orders")))
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    counts = (per_cust.join(cust, "o_custkey").join(nation, "c_nationkey")
              .groupBy("nation", "month").agg(F.sum("n_orders").alias("n_orders")))
    return counts.withColumn("custom_group", clean.volume_bucket("n_orders", VOLUME_WIDTH))


# ---------------------------------------------------------------------------------------------------------------------
# Daily statistics

@register("daily_max", """
SELECT l_returnflag, CAST(l_shipdate AS DATE) AS date, MAX(l_quantity) AS l_quantity,
       MAX(l_extendedprice) AS l_extendedprice, MAX(l_discount) AS l_discount, MAX(l_tax) AS l_tax
FROM lineitem GROUP BY 1, 2
""")
def q_daily_max(spark, d):
    li = Tables(spark, d).lineitem
    return agg.daily_max(li, "l_returnflag", "l_shipdate", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@register("daily_avg", """
SELECT l_linestatus, CAST(l_shipdate AS DATE) AS date, ROUND(AVG(l_quantity), 6) AS l_quantity,
       ROUND(AVG(l_discount), 6) AS l_discount, ROUND(AVG(l_tax), 6) AS l_tax
FROM lineitem GROUP BY 1, 2
""")
def q_daily_avg(spark, d):
    li = Tables(spark, d).lineitem
    out = agg.daily_mean(li, "l_linestatus", "l_shipdate", ["l_quantity", "l_discount", "l_tax"])
    return _round(out, ["l_quantity", "l_discount", "l_tax"])


@register("median_by_group", """
SELECT l_returnflag, CAST(l_shipdate AS DATE) AS date,
       ROUND(quantile_cont(l_quantity, 0.5), 6) AS median_quantity,
       ROUND(quantile_cont(l_extendedprice, 0.5), 6) AS median_extendedprice,
       ROUND(quantile_cont(l_discount, 0.5), 6) AS median_discount
FROM lineitem GROUP BY 1, 2
""")
def q_median_by_group(spark, d):
    li = Tables(spark, d).lineitem.select("l_returnflag", F.to_date("l_shipdate").alias("date"), "l_quantity",
                                          "l_extendedprice", "l_discount")
    names = ["median_quantity", "median_extendedprice", "median_discount"]
    out = exact_percentile(li, ["l_returnflag", "date"], ["l_quantity", "l_extendedprice", "l_discount"], 0.5, names)
    return _round(out, names)


@register("case_normalize", f"""
SELECT {_sql_synonyms('n.n_name', NATION_SYNONYMS)} AS nation, COUNT(*) AS n_customers,
       ROUND(SUM(c.c_acctbal), 2) AS total_acctbal
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1
""")
def q_case_normalize(spark, d):
    t = Tables(spark, d)
    per_nation = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("s"))
    named = per_nation.join(t.nation, per_nation["c_nationkey"] == t.nation["n_nationkey"])
    return (named.groupBy(clean.synonym_case("n_name", NATION_SYNONYMS).alias("nation"))
            .agg(F.sum("n").alias("n_customers"), _fixed(F.sum("s"), 2).alias("total_acctbal")))


@register("weighted_avg", """
SELECT l_suppkey, l_returnflag, SUM(l_quantity) AS l_quantity,
       ROUND(COALESCE(SUM(l_discount * l_quantity), 0) / NULLIF(SUM(l_quantity), 0), 6) AS l_discount,
       ROUND(COALESCE(SUM(l_tax * l_quantity), 0) / NULLIF(SUM(l_quantity), 0), 6) AS l_tax,
       ROUND(COALESCE(SUM(l_extendedprice * l_quantity), 0) / NULLIF(SUM(l_quantity), 0), 6) AS l_extendedprice
FROM lineitem WHERE l_suppkey IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY 1, 2
""")
def q_weighted_avg(spark, d):
    li = Tables(spark, d).lineitem
    out = agg.weighted_means(li, ["l_suppkey", "l_returnflag"], "l_quantity", ["l_discount", "l_tax", "l_extendedprice"])
    return _round(out, ["l_discount", "l_tax", "l_extendedprice"])


@register("road_traffic_view", f"""
WITH road AS (
  SELECT l.l_shipdate AS date, n.n_name AS city, CAST(l.l_partkey AS VARCHAR) AS road, l.l_quantity AS length,
         l.l_discount AS speed, l.l_tax AS freeflow, l.l_extendedprice AS jamfactor
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey),
per_road AS (
  SELECT date, city, road, SUM(length) AS length,
         COALESCE(SUM(speed * length), 0) / NULLIF(SUM(length), 0) AS speed,
         COALESCE(SUM(freeflow * length), 0) / NULLIF(SUM(length), 0) AS freeflow,
         COALESCE(SUM(jamfactor * length), 0) / NULLIF(SUM(length), 0) AS jamfactor
  FROM road WHERE date IS NOT NULL AND city IS NOT NULL AND road IS NOT NULL GROUP BY 1, 2, 3)
SELECT {_sql_synonyms('city', NATION_SYNONYMS)} AS city, CAST(date AS DATE) AS traffic_date,
       ROUND(quantile_cont(speed, 0.5), 6) AS median_speed, ROUND(quantile_cont(freeflow, 0.5), 6) AS median_freeflow,
       ROUND(quantile_cont(jamfactor, 0.5), 6) AS median_jam
FROM per_road GROUP BY 1, 2
""")
def q_road_traffic_view(spark, d):
    """Road loader + road view on lineitem: per (ship time, supplier nation, part) quantity-weighted means, then the
    synonym CASE on the nation and exact medians per (nation, day)."""
    t = Tables(spark, d)
    nation = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("city"))
    supplier = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    road = (t.lineitem.join(supplier, "l_suppkey").join(nation, "s_nationkey")
            .select(F.col("l_shipdate").alias("date"), "city", F.col("l_partkey").cast("string").alias("road"),
                    F.col("l_quantity").alias("length"), F.col("l_discount").alias("speed"),
                    F.col("l_tax").alias("freeflow"), F.col("l_extendedprice").alias("jamfactor")))
    per_road = agg.weighted_means(road, ["date", "city", "road"], "length", ["speed", "freeflow", "jamfactor"])
    out = views.road_traffic_view(per_road, synonyms=NATION_SYNONYMS)
    return _round(out, views.ROAD_MEDIANS)


# ---------------------------------------------------------------------------------------------------------------------
# Latest-per-key

@register("latest_per_group", """
SELECT DISTINCT ON (user_id, CAST(ts AS DATE)) user_id, CAST(ts AS DATE) AS date, event_type, event_id
FROM events ORDER BY user_id, CAST(ts AS DATE), ts DESC, event_id DESC
""")
def q_latest_per_group(spark, d):
    ev = Tables(spark, d).events.withColumn("date", F.to_date("ts"))
    return latest.latest_per_key(ev, ["user_id", "date"], ["ts", "event_id"], ["event_type", "event_id"])


@register("latest_by", """
SELECT user_id, arg_max(event_id, ts) AS latest_event_id, MAX(ts) AS latest_ts FROM events GROUP BY 1
""")
def q_latest_by(spark, d):
    ev = Tables(spark, d).events
    return ev.groupBy("user_id").agg(F.max_by("event_id", "ts").alias("latest_event_id"),
                                     F.max("ts").alias("latest_ts"))


# ---------------------------------------------------------------------------------------------------------------------
# City-airport dimension: STRING_AGG, UNNEST, the view itself

@register("string_agg", """
SELECT r.r_regionkey, r.r_name, STRING_AGG(n.n_name, ', ' ORDER BY n.n_name) AS nations,
       MIN(n.n_nationkey) AS n_nationkey
FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2
""")
def q_string_agg(spark, d):
    t = Tables(spark, d)
    joined = t.nation.join(t.region, t.nation["n_regionkey"] == t.region["r_regionkey"])
    return agg.string_agg(joined, ["r_regionkey", "r_name"], "n_name", "nations", mins=["n_nationkey"])


@register("split_explode", """
SELECT r_regionkey, r_name, n_nationkey, UNNEST(string_split(nations, ', ')) AS n_name FROM (
  SELECT r.r_regionkey, r.r_name, STRING_AGG(n.n_name, ', ' ORDER BY n.n_name) AS nations,
         MIN(n.n_nationkey) AS n_nationkey
  FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2)
""")
def q_split_explode(spark, d):
    return agg.split_explode(q_string_agg(spark, d), "nations", "n_name")


def _supplier_airports(t: Tables) -> DataFrame:
    """Suppliers as airports: city = nation name, country = region."""
    return (t.supplier.join(t.nation, t.supplier["s_nationkey"] == t.nation["n_nationkey"])
            .join(t.region, t.nation["n_regionkey"] == t.region["r_regionkey"])
            .select(F.col("n_name").alias("city_name"), F.col("n_regionkey").cast("string").alias("code_iso2_country"),
                    F.col("r_name").alias("name_country"), F.col("s_name").alias("code_iata_airport"),
                    F.col("s_acctbal").alias("latitude"), F.col("s_suppkey").cast("double").alias("longitude")))


@register("city_airports_view", """
SELECT n_name AS city_name, CAST(n_regionkey AS VARCHAR) AS code_iso2_country, r_name AS name_country,
       MIN(s_acctbal) OVER city AS latitude, MIN(CAST(s_suppkey AS DOUBLE)) OVER city AS longitude, s_name AS iata_code
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WINDOW city AS (PARTITION BY n_name, n_regionkey, r_name)
QUALIFY s_name IS NOT NULL
""")
def q_city_airports_view(spark, d):
    return views.city_airports_view(_supplier_airports(Tables(spark, d)))


# ---------------------------------------------------------------------------------------------------------------------
# Distinct, top-k, lookup

@register("distinct_pairs", "SELECT DISTINCT p_brand, p_type FROM part")
def q_distinct_pairs(spark, d):
    return agg.distinct_pairs(Tables(spark, d).part, ["p_brand", "p_type"])


@register("topk_then_distinct", """
SELECT DISTINCT p_brand FROM (SELECT p_brand FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20)
""")
def q_topk_then_distinct(spark, d):
    part = Tables(spark, d).part
    return part.orderBy(F.desc("p_retailprice"), F.asc("p_partkey")).limit(20).select("p_brand").distinct()


@register("lookup_join", f"""
SELECT p.n_name, p.r_name, s.s_suppkey, s.s_name
FROM (SELECT n.n_nationkey, n.n_regionkey, n.n_name, r.r_name FROM nation n JOIN region r
      ON n.n_regionkey = r.r_regionkey WHERE r.r_name IN ({_sql_in(ALLOWED_REGIONS)})) p
JOIN (SELECT s.s_suppkey, s.s_name, s.s_nationkey, n.n_regionkey FROM supplier s JOIN nation n
      ON s.s_nationkey = n.n_nationkey) s
  ON p.n_regionkey = s.n_regionkey
WHERE p.n_nationkey = s.s_nationkey AND s.s_name IS NOT NULL AND s.s_name <> ''
""")
def q_lookup_join(spark, d):
    t = Tables(spark, d)
    # Candidate (nation, region) pairs restricted to an allow-list, looked up by region and kept when the supplier's
    # nation equals the pair's nation and its name is non-empty.
    pairs = (t.nation.join(t.region, t.nation["n_regionkey"] == t.region["r_regionkey"])
             .filter(clean.allow_list("r_name", ALLOWED_REGIONS))
             .select("n_nationkey", F.col("n_regionkey").alias("regionkey"), "n_name", "r_name"))
    lookup = (t.supplier.join(t.nation.select("n_nationkey", "n_regionkey"),
                              t.supplier["s_nationkey"] == F.col("n_nationkey"))
              .select("s_suppkey", "s_name", "s_nationkey", F.col("n_regionkey").alias("regionkey")))
    found = joins.lookup_join(pairs, lookup, ["regionkey"], match_equal=[("n_nationkey", "s_nationkey")],
                              require_non_empty=["s_name"])
    return found.select("n_name", "r_name", "s_suppkey", "s_name")


# ---------------------------------------------------------------------------------------------------------------------
# Master view

def _event_cities(t: Tables) -> DataFrame:
    """Morning events with the city (nation name) of their user."""
    users = t.customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
    ev = t.events.filter(tfn.hour_in_window("ts", 6, 9, True))
    return (ev.join(users, "user_id").join(nation, "c_nationkey")
            .select("ts", "event_type", "value", F.get_json_object("props", "$.k").cast("double").alias("k"), "city"))


def _customer_airports(t: Tables) -> DataFrame:
    return (t.customer.join(t.nation, t.customer["c_nationkey"] == t.nation["n_nationkey"])
            .join(t.region, t.nation["n_regionkey"] == t.region["r_regionkey"])
            .select(F.col("n_name").alias("city_name"), F.col("n_regionkey").cast("string").alias("code_iso2_country"),
                    F.col("r_name").alias("name_country"), F.col("c_custkey").cast("string").alias("code_iata_airport"),
                    F.col("c_acctbal").alias("latitude"), F.col("c_nationkey").cast("double").alias("longitude")))


MASTER_POLLUTANTS = ["co", "no2"]
MASTER_DOUBLES = ["median_speed", "median_freeflow", "median_jam", "temperature", "humidity", "pressure", "wind_speed"]


def master_sql(width: int) -> str:
    """The master view in SQL, with a flight-count bucket of this width."""
    return f"""
WITH morning AS (
  SELECT n_name AS city, CAST(ts AS DATE) AS date, ts, event_type AS kind, value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE hour(ts) BETWEEN 6 AND 9),
city_days AS (
  SELECT city, date,
         COUNT(*) FILTER (kind = 'purchase') AS no_arrivals, COUNT(*) FILTER (kind = 'view') AS no_departures,
         COUNT(*) FILTER (kind IN ('purchase', 'view')) AS no_total_flights,
         quantile_cont(value, 0.5) FILTER (kind = 'click') AS median_speed,
         quantile_cont(k, 0.5) FILTER (kind = 'click') AS median_freeflow,
         quantile_cont(CAST(hour(ts) AS DOUBLE), 0.5) FILTER (kind = 'click') AS median_jam,
         MAX(CAST(k AS INTEGER)) FILTER (kind = 'error') AS air_quality_index, MAX(value) FILTER (kind = 'error') AS co,
         MAX(k) FILTER (kind = 'error') AS no2,
         AVG(k) AS temperature, AVG(hour(ts)) AS humidity, AVG(minute(ts)) AS pressure, AVG(second(ts)) AS wind_speed,
         LAST(kind ORDER BY ts, kind) AS weather_main
  FROM morning GROUP BY ALL),
countries AS (
  SELECT DISTINCT n_name AS city, CAST(r_regionkey AS VARCHAR) AS code_iso2_country, r_name AS name_country
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT city, code_iso2_country, name_country, date, no_arrivals, no_departures, no_total_flights,
       {_sql_bucket('no_total_flights', width)} AS custom_group,
       ROUND(median_speed, 6) AS median_speed, ROUND(median_freeflow, 6) AS median_freeflow,
       ROUND(median_jam, 6) AS median_jam, air_quality_index, co, no2, ROUND(temperature, 6) AS temperature,
       ROUND(humidity, 6) AS humidity, ROUND(pressure, 6) AS pressure, ROUND(wind_speed, 6) AS wind_speed, weather_main
FROM city_days JOIN countries USING (city)
WHERE no_total_flights > 0
"""


@register("master_view", master_sql(VOLUME_WIDTH))
def q_master_view(spark, d):
    t = Tables(spark, d)
    flights_v = _flights_v(t.events, t.events)
    ca = views.city_airports_view(_customer_airports(t))
    ev = _event_cities(t)
    road = ev.filter(F.col("event_type") == "click").select(
        "city", F.col("ts").alias("date"), F.col("value").alias("speed"), F.col("k").alias("freeflow"),
        F.hour("ts").cast("double").alias("jamfactor"))
    road_v = views.road_traffic_view(road, synonyms={})
    pollution_v = ev.filter(F.col("event_type") == "error").select(
        F.col("city").alias("place"), F.col("ts").alias("date"), F.col("k").cast("int").alias("air_quality_index"),
        F.col("value").alias("co"), F.col("k").alias("no2"))
    # Integer-valued weather measures: their sums are exact in any order.
    weather_v = ev.select(F.col("city").alias("place"), F.col("ts").alias("date"), F.col("k").alias("temperature"),
                          F.hour("ts").alias("humidity"), F.minute("ts").alias("pressure"),
                          F.second("ts").cast("double").alias("wind_speed"), F.col("event_type").alias("weather_main"))
    out = views.master_view(flights_v, ca, road_v, pollution_v, weather_v, pollutants=MASTER_POLLUTANTS,
                            bucket_width=VOLUME_WIDTH)
    return _round(out, MASTER_DOUBLES)


# ---------------------------------------------------------------------------------------------------------------------
# Keyed sinks

_EV_KEY = ["user_id", "event_type", "date"]
_EV_VALUES = ["user_id", "event_type", "date", "event_id", "ts", "value"]


@register("insert_if_absent", f"""
WITH tgt AS (
  SELECT DISTINCT ON (user_id, event_type, CAST(ts AS DATE)) user_id, event_type, CAST(ts AS DATE) AS date, event_id,
         ts, value
  FROM events WHERE ts < TIMESTAMP '{CUTOFF_MIDDAY}'
  ORDER BY user_id, event_type, CAST(ts AS DATE), ts DESC, event_id DESC),
batch AS (
  SELECT DISTINCT ON (user_id, event_type, CAST(ts AS DATE)) user_id, event_type, CAST(ts AS DATE) AS date, event_id,
         ts, value
  FROM events ORDER BY user_id, event_type, CAST(ts AS DATE), ts DESC, event_id DESC)
SELECT * FROM tgt
UNION ALL
SELECT * FROM batch b WHERE NOT EXISTS (
  SELECT 1 FROM tgt WHERE tgt.user_id = b.user_id AND tgt.event_type = b.event_type AND tgt.date = b.date)
""")
def q_insert_if_absent(spark, d):
    ev = Tables(spark, d).events.withColumn("date", F.to_date("ts")).select(*_EV_VALUES)
    target = sinks.dedupe_by_key(ev.filter(F.col("ts") < F.lit(CUTOFF_MIDDAY).cast("timestamp_ntz")), _EV_KEY,
                                 ["ts", "event_id"], keep="last")
    return sinks.apply_insert_if_absent(target, ev, _EV_KEY, ["ts", "event_id"], keep="last")


@register("upsert_latest", f"""
WITH u AS (
  SELECT user_id, event_type, event_id, ts, value, 0 AS load FROM events WHERE ts >= TIMESTAMP '{CUTOFF_HALF}'
  UNION ALL
  SELECT user_id, event_type, event_id, ts, value, 1 AS load FROM events WHERE ts < TIMESTAMP '{CUTOFF_HALF}')
SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id, ts, value
FROM u ORDER BY user_id, event_type, load DESC, ts DESC, event_id DESC
""")
def q_upsert_latest(spark, d):
    ev = Tables(spark, d).events.select("user_id", "event_type", "event_id", "ts", "value")
    cut = F.lit(CUTOFF_HALF).cast("timestamp_ntz")
    # Back-fill scenario: the newer half was loaded first, the older half is loaded last and so overwrites it.
    return sinks.upsert_latest(ev.filter(F.col("ts") >= cut), ev.filter(F.col("ts") < cut), ["user_id", "event_type"],
                               ["ts", "event_id"])


@register("strict_append_conflicts", f"""
WITH b AS (SELECT o_custkey, o_orderdate, COUNT(*) AS n_batch FROM orders
           WHERE o_orderpriority NOT IN ({_sql_in(TARGET_PRIORITIES)}) GROUP BY 1, 2),
t AS (SELECT o_custkey, o_orderdate, COUNT(*) AS n_target FROM orders
      WHERE o_orderpriority IN ({_sql_in(TARGET_PRIORITIES)}) GROUP BY 1, 2)
SELECT b.o_custkey, b.o_orderdate, b.n_batch, COALESCE(t.n_target, 0) AS n_target
FROM b LEFT JOIN t ON b.o_custkey = t.o_custkey AND b.o_orderdate = t.o_orderdate
WHERE b.n_batch > 1 OR COALESCE(t.n_target, 0) > 0
""")
def q_strict_append_conflicts(spark, d):
    o = Tables(spark, d).orders
    in_target = F.col("o_orderpriority").isin(TARGET_PRIORITIES)
    return sinks.strict_append_conflicts(o.filter(in_target), o.filter(~in_target), ["o_custkey", "o_orderdate"])


@register("union_history", f"""
WITH u AS (
  SELECT 'history' AS slice, event_type, NULL AS props FROM events WHERE ts < TIMESTAMP '{CUTOFF_HALF}'
  UNION ALL
  SELECT 'new' AS slice, event_type, props FROM events WHERE ts >= TIMESTAMP '{CUTOFF_HALF}')
SELECT slice, event_type, COUNT(*) AS n_rows, COUNT(props) AS n_with_props FROM u GROUP BY 1, 2
""")
def q_union_history(spark, d):
    ev = Tables(spark, d).events
    cut = F.lit(CUTOFF_HALF).cast("timestamp_ntz")
    history = ev.filter(F.col("ts") < cut).select("event_id", "ts", "user_id", "event_type", "value")
    new = ev.filter(F.col("ts") >= cut).select("event_id", "ts", "user_id", "event_type", "value", "props")
    u = sinks.union_history(history, new, slice_col="slice")
    return u.groupBy("slice", "event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.count("props").alias("n_with_props"))


@register("load_stats", """
WITH k AS (SELECT event_type, user_id, CAST(ts AS DATE) AS d, COUNT(*) AS n FROM events GROUP BY 1, 2, 3)
SELECT event_type, CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_keys, CAST(SUM(n - 1) AS BIGINT) AS n_duplicates
FROM k GROUP BY 1
""")
def q_load_stats(spark, d):
    ev = Tables(spark, d).events
    return agg.load_stats(ev, ["event_type"], ["user_id", F.to_date("ts").alias("d")])


# ---------------------------------------------------------------------------------------------------------------------
# Scalar cleaning and parsing

@register("json_flatten", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       list_contains(json_keys(props), 'k') AS has_k, list_contains(json_keys(props), 'codeshared') AS has_codeshared
FROM events
""")
def q_json_flatten(spark, d):
    ev = Tables(spark, d).events
    return ev.select("event_id", F.from_json("props", "k INT")["k"].alias("k"), clean.has_key("props", "k").alias("has_k"),
                     clean.has_key("props", "codeshared").alias("has_codeshared"))


def _ts_text() -> F.Column:
    return (F.when(F.col("event_type") == "purchase", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd't'HH:mm:ss.SSSSSS")))


@register("parse_ts_multi", """
WITH t AS (SELECT event_id, CASE WHEN event_type = 'purchase' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                                 ELSE strftime(ts, '%Y-%m-%dt%H:%M:%S.%f') END AS ts_text FROM events)
SELECT event_id, ts_text,
       COALESCE(try_strptime(replace(ts_text, 't', 'T'), '%Y-%m-%dT%H:%M:%S.%f'),
                try_strptime(replace(ts_text, 't', 'T'), '%Y-%m-%dT%H:%M:%S')) AS parsed_ts,
       try_strptime(replace(ts_text, 't', 'T'), '%Y-%m-%dT%H:%M:%S.%f') AS loader_ts
FROM t
""")
def q_parse_ts_multi(spark, d):
    ev = Tables(spark, d).events.select("event_id", _ts_text().alias("ts_text"))
    fixed = F.translate("ts_text", "t", "T")
    return ev.select("event_id", "ts_text",
                     tfn.parse_iso_ntz(fixed, "T", "optional").alias("parsed_ts"),
                     tfn.parse_flight_ts("ts_text").alias("loader_ts"))


# Texts that are no int: every fifth row has one in turn.
JUNK_NUMBERS = ["NaN", "Infinity", "-Infinity", "1e12", "-3000000000", "12abc", "junk"]


@register("safe_int", f"""
WITH t AS (
  SELECT event_id, CASE WHEN event_id % 5 = 0
                        THEN [{_sql_in(JUNK_NUMBERS)}][CAST((event_id // 5) % {len(JUNK_NUMBERS)} AS INTEGER) + 1]
                        WHEN event_type = 'error' THEN '' WHEN event_type = 'signup' THEN NULL
                        ELSE CAST(value AS VARCHAR) END AS delay_text
  FROM events),
n AS (SELECT event_id, delay_text, TRY_CAST(delay_text AS DOUBLE) AS x FROM t)
SELECT event_id, CASE WHEN isfinite(x) AND abs(trunc(x)) <= 2147483647 THEN CAST(trunc(x) AS INTEGER) ELSE 0 END AS delay
FROM n
""")
def q_safe_int(spark, d):
    ev = Tables(spark, d).events
    junk = F.array(*[F.lit(x) for x in JUNK_NUMBERS])
    number = F.floor(F.col("event_id") / 5).cast("int") % len(JUNK_NUMBERS)
    text = (F.when(F.col("event_id") % 5 == 0, F.get(junk, number)).when(F.col("event_type") == "error", F.lit(""))
            .when(F.col("event_type") == "signup", F.lit(None)).otherwise(F.col("value").cast("string")))
    return ev.select("event_id", clean.safe_int(text).alias("delay"))


@register("epoch_to_ts", """
SELECT event_id, epoch_us(ts) // 1000000 AS epoch, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS utc_ts,
       CAST(hour(ts) AS INTEGER) AS hour, strftime(make_timestamp((epoch_us(ts) // 1000000) * 1000000), '%Y-%m-%d %H:%M:%S') AS utc_text
FROM events
""")
def q_epoch_to_ts(spark, d):
    ev = Tables(spark, d).events.select("event_id", tfn.epoch_seconds("ts").alias("epoch"))
    utc = tfn.epoch_to_utc("epoch")
    return ev.select("event_id", "epoch", utc.alias("utc_ts"), F.hour(utc).alias("hour"),
                     tfn.utc_text(utc).alias("utc_text"))


@register("path_tokens", r"""
WITH p AS (SELECT page_id, url,
                  regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) AS scheme,
                  regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host,
                  regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, scheme, host, string_split(host, '.')[1] AS subdomain, string_split(path, '/')[2] AS lang,
       string_split(path, '/')[-1] AS basename, regexp_replace(string_split(path, '/')[-1], '\.html$', '') AS stem,
       CAST(len(string_split(path, '/')) - 1 AS INTEGER) AS n_segments
FROM p
""")
def q_path_tokens(spark, d):
    pages = Tables(spark, d).pages
    path = clean.url_path("url")
    parts = F.split(path, "/")
    base = clean.basename(path)
    return pages.select("page_id",
                        F.regexp_extract("url", r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1).alias("scheme"),
                        clean.url_host("url").alias("host"),
                        clean.name_token(clean.url_host("url"), 1, ".").alias("subdomain"),
                        F.try_element_at(parts, F.lit(2)).alias("lang"),
                        base.alias("basename"), clean.strip_extension(base, ".html").alias("stem"),
                        (F.size(parts) - 1).alias("n_segments"))


@register("regex_clean", r"""
SELECT p_partkey, trim(regexp_replace(p_brand, '\d+$', '')) AS brand_stem,
       CAST(regexp_extract(p_brand, '(\d+)$', 1) AS INTEGER) AS brand_no,
       trim(regexp_replace(p_name || ' [' || CAST(p_size AS VARCHAR) || ']', '\[\d+\]', '')) AS name_clean,
       CAST(regexp_replace(CAST(p_size AS VARCHAR) || ',' || lpad(CAST(p_partkey AS VARCHAR), 3, '0'), ',', '') AS BIGINT)
         AS size_key
FROM part
""")
def q_regex_clean(spark, d):
    part = Tables(spark, d).part
    footnoted = F.concat("p_name", F.lit(" ["), F.col("p_size").cast("string"), F.lit("]"))
    thousands = F.concat(F.col("p_size").cast("string"), F.lit(","), F.lpad(F.col("p_partkey").cast("string"), 3, "0"))
    return part.select("p_partkey", clean.strip_trailing_digits("p_brand").alias("brand_stem"),
                       F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int").alias("brand_no"),
                       clean.strip_footnotes(footnoted).alias("name_clean"),
                       clean.thousands_to_long(thousands).alias("size_key"))


# ---------------------------------------------------------------------------------------------------------------------
# Planning tables

@register("high_water_mark", """
SELECT user_id, GREATEST(MAX(ts), TIMESTAMP '2023-12-01 00:00:00') AS high_water_mark FROM events GROUP BY 1
""")
def q_high_water_mark(spark, d):
    return agg.high_water_mark(Tables(spark, d).events, "ts", by=["user_id"])


HISTORY_EPOCH = 1701388800  # 2023-12-01 00:00:00 UTC, the start of every history


@register("gap_plan", f"""
WITH marks AS (
  SELECT c_custkey AS user_id, GREATEST(MAX(epoch_us(ts) // 1000000), {HISTORY_EPOCH}) AS seen
  FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1),
known AS (SELECT user_id FROM events GROUP BY 1),
blocks AS (
  SELECT user_id, seen AS hwm_epoch, UNNEST(generate_series(seen + 1, {NOW_EPOCH}, 604800)) AS start_epoch
  FROM (SELECT user_id, GREATEST(MAX(epoch_us(ts) // 1000000), {HISTORY_EPOCH}) AS seen FROM events GROUP BY 1)
  WHERE seen < {NOW_EPOCH}
  UNION ALL
  SELECT user_id, NULL AS hwm_epoch, UNNEST(generate_series({HISTORY_EPOCH}, {NOW_EPOCH}, 604800)) AS start_epoch
  FROM marks ANTI JOIN known USING (user_id)),
ended AS (
  SELECT *, CASE WHEN hwm_epoch IS NULL THEN start_epoch + 604799 ELSE LEAST({NOW_EPOCH}, start_epoch + 604799) END
            AS end_epoch
  FROM blocks)
SELECT user_id, hwm_epoch,
       CAST((start_epoch - COALESCE(hwm_epoch + 1, {HISTORY_EPOCH})) // 604800 + 1 AS INTEGER) AS seg_no, start_epoch,
       end_epoch, make_timestamp(start_epoch * 1000000) AS start_utc, make_timestamp(end_epoch * 1000000) AS end_utc
FROM ended
""")
def q_gap_plan(spark, d):
    t = Tables(spark, d)
    return planning.gap_plan(t.events, ["user_id"], "ts", NOW_EPOCH,
                             entities=t.customer.select(F.col("c_custkey").alias("user_id")))


@register("segment_plan", """
WITH s AS (SELECT user_id, MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events GROUP BY 1),
g AS (SELECT user_id, lo, hi, CAST(UNNEST(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                                  INTERVAL 7 DAY)) AS DATE) AS seg_start
      FROM s)
SELECT user_id, CAST(date_diff('day', lo, seg_start) // 7 + 1 AS INTEGER) AS seg_no, seg_start,
       LEAST(seg_start + 6, hi) AS seg_end
FROM g
""")
def q_segment_plan(spark, d):
    return planning.segment_plan(Tables(spark, d).events, ["user_id"], "ts", width_days=7)


def _zone_table(spark) -> DataFrame:
    rows = [(r, z, off, shift) for r, (z, off, shift) in REGION_ZONES.items()]
    return spark.createDataFrame(rows, "r_name string, zone string, utc_offset int, summer_shift int")


def _sql_zone_values() -> str:
    return ", ".join(f"('{r}', '{z}', {off}, {shift})" for r, (z, off, shift) in REGION_ZONES.items())


@register("utc_window", f"""
WITH z(r_name, zone, utc_offset, summer_shift) AS (VALUES {_sql_zone_values()}),
days AS (SELECT DISTINCT n.n_name AS city, r.r_name, CAST(e.ts AS DATE) AS day
         FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
         JOIN region r ON n.n_regionkey = r.r_regionkey),
w AS (SELECT days.city, days.day, z.zone, z.utc_offset, z.summer_shift,
             ((CAST(days.day AS TIMESTAMP) + INTERVAL 6 HOUR) AT TIME ZONE z.zone) AT TIME ZONE 'UTC' AS start_utc,
             CAST(days.day AS TIMESTAMP) + INTERVAL 6 HOUR - z.utc_offset * INTERVAL 1 HOUR AS base
      FROM days JOIN z ON days.r_name = z.r_name)
SELECT city, day, zone, start_utc, start_utc + INTERVAL 3 HOUR AS end_utc,
       CASE WHEN base >= TIMESTAMP '2024-03-31 00:00:00' AND base <= TIMESTAMP '2024-10-27 00:00:00'
            THEN base - summer_shift * INTERVAL 1 HOUR ELSE base END AS start_utc_fixed
FROM w
""")
def q_utc_window(spark, d):
    t = Tables(spark, d)
    user_region = (t.customer.join(t.nation, t.customer["c_nationkey"] == t.nation["n_nationkey"])
                   .join(t.region, t.nation["n_regionkey"] == t.region["r_regionkey"])
                   .select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("city"), "r_name"))
    # Distinct (user, day) first, so a busy user is one row per day before the dimension join.
    user_days = t.events.select("user_id", F.to_date("ts").alias("day")).distinct()
    days = user_days.join(user_region, "user_id").select("city", "r_name", "day").distinct()
    days = days.join(_zone_table(spark), "r_name")
    win = planning.utc_windows(days, "day", F.col("zone"))
    local = F.col("day").cast("timestamp_ntz") + F.make_interval(hours=F.lit(6))
    return win.select("city", "day", "zone", "start_utc", "end_utc",
                      tfn.local_to_utc_fixed(local, F.col("utc_offset"), F.col("summer_shift")).alias("start_utc_fixed"))


@register("request_grid", """
WITH b AS (SELECT MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events),
u AS (SELECT DISTINCT user_id FROM events),
s AS (SELECT lo, hi, CAST(UNNEST(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE)
             AS seg_start FROM b)
SELECT u.user_id, CAST(date_diff('day', s.lo, s.seg_start) // 7 + 1 AS INTEGER) AS seg_no, s.seg_start,
       LEAST(s.seg_start + 6, s.hi) AS seg_end
FROM u, s
""")
def q_request_grid(spark, d):
    ev = Tables(spark, d).events
    return planning.request_grid(ev.select("user_id").distinct(), ev, "ts", width_days=7, inclusive_tail=True)


# ---------------------------------------------------------------------------------------------------------------------
# Dashboard statistics

@register("corr_by_group", """
SELECT l_returnflag, ROUND(corr(l_quantity, l_extendedprice), 6) AS corr_qty_price,
       ROUND(corr(l_discount, l_tax), 6) AS corr_discount_tax
FROM lineitem GROUP BY 1
""")
def q_corr_by_group(spark, d):
    li = Tables(spark, d).lineitem
    out = stats.corr_by_group(li, ["l_returnflag"], [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax")],
                              ["corr_qty_price", "corr_discount_tax"])
    return _round(out, ["corr_qty_price", "corr_discount_tax"])


@register("regr_by_group", """
SELECT l_returnflag, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n,
       ROUND(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       ROUND(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       ROUND(regr_r2(l_extendedprice, l_quantity), 6) AS r2
FROM lineitem GROUP BY 1
""")
def q_regr_by_group(spark, d):
    li = Tables(spark, d).lineitem
    out = stats.regr_by_group(li, ["l_returnflag"], "l_extendedprice", "l_quantity")
    return _round(out, ["slope", "intercept", "r2"])


def _limits_sql() -> str:
    return ", ".join(f"('{k}', {v})" for k, v in DAILY_LIMITS.items())


@register("limit_exceedance", f"""
WITH lim(event_type, limit_value) AS (VALUES {_limits_sql()}),
daily AS (SELECT event_type, CAST(ts AS DATE) AS date, MAX(value) AS value FROM events GROUP BY 1, 2)
SELECT d.event_type, COUNT(*) AS n_days, CAST(COUNT_IF(d.value > l.limit_value) AS BIGINT) AS n_days_over,
       ROUND(COUNT_IF(d.value > l.limit_value) / COUNT(*), 6) AS share_over
FROM daily d JOIN lim l ON d.event_type = l.event_type GROUP BY 1
""")
def q_limit_exceedance(spark, d):
    ev = Tables(spark, d).events
    daily = agg.daily_max(ev, "event_type", "ts", ["value"])
    limits = spark.createDataFrame(list(DAILY_LIMITS.items()), "event_type string, limit_value double")
    out = stats.limit_exceedance(daily, limits, "event_type", "value")
    return _round(out, ["share_over"])


@register("overview_kpis", """
SELECT MIN(ts) AS first_ts, MAX(ts) AS last_ts, COUNT(*) AS n_rows, COUNT(DISTINCT user_id) AS n_entities,
       COUNT(DISTINCT CAST(ts AS DATE)) AS n_days, ROUND(SUM(value), 6) AS total_measure
FROM events
""")
def q_overview_kpis(spark, d):
    out = stats.overview_kpis(Tables(spark, d).events, "ts", "user_id", "value")
    return _round(out, ["total_measure"])


@register("hourly_profile", """
SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour, COUNT(*) AS n, ROUND(AVG(value), 6) AS avg_value
FROM events GROUP BY 1, 2
""")
def q_hourly_profile(spark, d):
    out = stats.hourly_profile(Tables(spark, d).events, "event_type", "ts", "value")
    return _round(out, ["avg_value"])


# ---------------------------------------------------------------------------------------------------------------------
# Incremental ingest: what it loads, increment by increment, is what one load of all events would

@register("stream_ingest", """
SELECT DISTINCT ON (user_id, event_type, CAST(ts AS DATE)) user_id, event_type, CAST(ts AS DATE) AS date, event_id, ts,
       value
FROM events ORDER BY user_id, event_type, CAST(ts AS DATE), ts, event_id
""")
def q_stream_ingest(spark, d):
    """Two increments of ``events`` (before / after the midday cut) land as files in a fresh folder of the shared
    checkpoint directory; an availableNow file stream merges them into a keyed table (insert-if-absent, one row per
    (user, type, day)); the result is the loaded table, equal to a one-shot batch load of all events."""
    import uuid

    from airshed.session import shared_path
    from airshed.streaming.ingest import incremental_ingest

    root = shared_path(spark, "stream_ingest", uuid.uuid4().hex)
    ev = Tables(spark, d).events.withColumn("date", F.to_date("ts")).select(*_EV_VALUES)
    cut = F.lit(CUTOFF_MIDDAY).cast("timestamp_ntz")
    for i, part in enumerate([ev.filter(F.col("ts") < cut), ev.filter(F.col("ts") >= cut)], start=1):
        part.write.parquet(f"{root}/landing/increment-{i}")          # a new day of files lands …
        incremental_ingest(spark, f"{root}/landing", ev.schema, f"{root}/table", f"{root}/checkpoint", _EV_KEY,
                           ["ts", "event_id"], source_format="parquet", partition_col="date",
                           prune_col="date")                            # … and the scheduled run picks it up
    return spark.read.parquet(f"{root}/table").select(*_EV_VALUES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: w.run for name, w in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: w.sql.strip() for name, w in REGISTRY.items() if w.sql}
