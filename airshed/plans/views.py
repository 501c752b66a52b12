"""The warehouse views, each a function ``(DataFrames) → DataFrame`` with column names as parameters.

Refreshing a view is writing its DataFrame (see :mod:`airshed.plans.refresh`). The master view aggregates every feed to
the (city, day) grain *before* joining, so each join meets one row per key on both sides; the reference's wide
GROUP BY that undoes the fan-out is therefore unnecessary (averages are unchanged by a constant fan-out).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.functions.clean import CITY_SYNONYMS, VOLUME_BUCKET_WIDTH, VOLUME_BUCKETS, synonym_case, volume_bucket
from airshed.functions.time import hour_in_window, hour_trunc
from airshed.operators.aggregates import daily_max, hourly_counts
from airshed.operators.joins import full_outer_counts
from airshed.operators.latest import ordering_key
from airshed.operators.percentile import exact_percentile

# Pollutant columns of the pollution feed and the weather means of the master view.
POLLUTANTS = ["co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3"]
WEATHER_MEANS = ["temperature", "humidity", "pressure", "wind_speed"]
ROAD_MEASURES = ["speed", "freeflow", "jamfactor"]
ROAD_MEDIANS = ["median_speed", "median_freeflow", "median_jam"]


def flights_view(arrivals: DataFrame, departures: DataFrame, arrival_code="arrival_iata",
                 arrival_ts="arrival_actual_time", departure_code="departure_iata",
                 departure_ts="departure_actual_time", arrival_status: str | None = "landed",
                 departure_status: str | None = "active", status_col: str = "status", lo: int = 6, hi: int = 9,
                 inclusive_hi: bool = True) -> DataFrame:
    """Arrivals and departures per (airport, hour) in the morning window, full-outer merged.

    Columns: airport_code, date (hour), no_arrivals, no_departures, no_total_flights.
    """
    arr = hourly_counts(arrivals, arrival_code, arrival_ts, "no_arrivals",
                        status_col if arrival_status is not None else None, arrival_status, lo, hi, inclusive_hi)
    dep = hourly_counts(departures, departure_code, departure_ts, "no_departures",
                        status_col if departure_status is not None else None, departure_status, lo, hi, inclusive_hi)
    return full_outer_counts(arr, dep, ["airport_code", "date"], "no_arrivals", "no_departures", "no_total_flights")


def city_airports_view(airports: DataFrame, city="city_name", country_code="code_iso2_country",
                       country_name="name_country", code="code_iata_airport", lat="latitude",
                       lon="longitude") -> DataFrame:
    """One row per airport code of a (city, country) group with the group's independent MIN(lat), MIN(lon).

    Equivalent to STRING_AGG of the codes followed by UNNEST(STRING_TO_ARRAY(…, ', ')) for codes without ', ', but
    without building one string per city: codes are joined back to the per-group minima.
    """
    keys = [city, country_code, country_name]
    dims = airports.groupBy(*[F.col(k).alias(f"_d{i}") for i, k in enumerate(keys)]) \
        .agg(F.min(lat).alias("latitude"), F.min(lon).alias("longitude"))
    codes = airports.filter(F.col(code).isNotNull()).select(*keys, F.col(code).alias("iata_code"))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_d{i}")) for i, k in enumerate(keys)])
    return codes.join(dims, on, "inner").select(
        F.col(city).alias("city_name"), F.col(country_code).alias("code_iso2_country"),
        F.col(country_name).alias("name_country"), "latitude", "longitude", "iata_code")


def road_traffic_view(road: DataFrame, city="city", ts="date", measures: Sequence[str] = tuple(ROAD_MEASURES),
                      names: Sequence[str] = tuple(ROAD_MEDIANS),
                      synonyms: Mapping[str, str] = CITY_SYNONYMS) -> DataFrame:
    """Exact interpolated medians of the road measures per (normalised city, day)."""
    normalised = road.select(synonym_case(city, synonyms).alias("city"), F.to_date(F.col(ts)).alias("traffic_date"),
                             *[F.col(m) for m in measures])
    return exact_percentile(normalised, ["city", "traffic_date"], list(measures), 0.5, list(names))


def air_pollution_view(pollution: DataFrame, pollutants: Sequence[str] = tuple(POLLUTANTS)) -> DataFrame:
    return pollution.select("place", "date", "air_quality_index", *pollutants)


def weather_view(weather: DataFrame) -> DataFrame:
    return weather.select("place", "date", *WEATHER_MEANS, "weather_main")


def master_view(flights_v: DataFrame, city_airports_v: DataFrame, road_v: DataFrame, pollution_v: DataFrame,
                weather_v: DataFrame, pollutants: Sequence[str] = tuple(POLLUTANTS),
                weather_means: Sequence[str] = tuple(WEATHER_MEANS), road_medians: Sequence[str] = tuple(ROAD_MEDIANS),
                bucket_width: int = VOLUME_BUCKET_WIDTH, buckets: int = VOLUME_BUCKETS) -> DataFrame:
    """One row per (city, country, day) with flight counts and bucket, road medians, pollution maxima, weather means
    and the day's latest weather label. Flights at airports missing from the city dimension are dropped (inner join);
    every other feed is optional (left joins keep NULLs)."""
    ca = city_airports_v
    codes = ca.select(F.col("iata_code"), F.col("city_name"))
    af = (flights_v.join(codes, flights_v["airport_code"] == codes["iata_code"], "inner")
          .groupBy(F.col("city_name").alias("city"), F.to_date("date").alias("date"))
          .agg(F.sum("no_arrivals").cast("bigint").alias("no_arrivals"),
               F.sum("no_departures").cast("bigint").alias("no_departures"),
               F.sum("no_total_flights").cast("bigint").alias("no_total_flights")))
    af = af.withColumn("custom_group", volume_bucket("no_total_flights", bucket_width, buckets))

    rt = road_v.select(F.col("city"), F.col("traffic_date").alias("date"), *road_medians)
    ap = daily_max(pollution_v, "place", "date", ["air_quality_index", *pollutants], key_name="city")
    weather = weather_v.groupBy(F.col("place").alias("city"), F.to_date("date").alias("_day")).agg(
        *[F.avg(F.col(m).cast("double")).alias(m) for m in weather_means],
        F.max_by("weather_main", ordering_key(["date", "weather_main"])).alias("weather_main")) \
        .withColumnRenamed("_day", "date")
    cdim = ca.select(F.col("city_name").alias("city"), "code_iso2_country", "name_country").distinct()

    out = af
    for side in (rt, ap, weather):
        out = out.join(side, ["city", "date"], "left")
    out = out.join(cdim, ["city"], "left")
    return out.select("city", "code_iso2_country", "name_country", "date", "no_arrivals", "no_departures",
                      "no_total_flights", "custom_group", *road_medians, "air_quality_index", *pollutants,
                      *weather_means, "weather_main")
