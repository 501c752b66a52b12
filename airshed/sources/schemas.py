"""Explicit reader schemas for the lake feeds (never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DecimalType, DoubleType, IntegerType, LongType, MapType, StringType,
                               StructField, StructType)


def _s(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


# Flight record: every leaf is read as text; numbers and timestamps are converted by the cleaning expressions.
FLIGHT_RECORD = StructType([
    StructField("type", StringType()),
    StructField("status", StringType()),
    StructField("departure", StructType(_s("iataCode", "delay", "scheduledTime", "actualTime", "estimatedTime"))),
    StructField("arrival", StructType(_s("iataCode", "delay", "scheduledTime", "actualTime", "estimatedTime"))),
    StructField("airline", StructType(_s("name", "iataCode"))),
    StructField("flight", StructType(_s("number", "iataNumber"))),
])

ROAD_RECORD = StructType([
    StructField("location", StructType([StructField("description", StringType()),
                                        StructField("length", DoubleType())])),
    StructField("currentFlow", StructType([StructField("speed", DoubleType()), StructField("freeFlow", DoubleType()),
                                           StructField("jamFactor", DoubleType())])),
])

POLLUTANTS = ["co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3"]
COMPONENTS = StructType([StructField(p, DoubleType()) for p in POLLUTANTS])

POLLUTION_RECORD = StructType([
    StructField("place", StringType()), StructField("latitude", DoubleType()), StructField("longitude", DoubleType()),
    StructField("timestamp", LongType()), StructField("date", StringType()),
    StructField("air_quality_index", IntegerType()), StructField("components", COMPONENTS),
])

WEATHER_RECORD = StructType([
    StructField("place", StringType()), StructField("latitude", DoubleType()), StructField("longitude", DoubleType()),
    StructField("timestamp", LongType()), StructField("date", StringType()), StructField("temperature", DoubleType()),
    StructField("humidity", IntegerType()), StructField("pressure", IntegerType()),
    StructField("wind_speed", DoubleType()), StructField("weather_main", StringType()),
    StructField("weather_description", StringType()),
])

POLLUTION_PAYLOAD = StructType([StructField("list", ArrayType(StructType([
    StructField("dt", LongType()), StructField("main", StructType([StructField("aqi", IntegerType())])),
    StructField("components", COMPONENTS)])))])

WEATHER_PAYLOAD = StructType([StructField("list", ArrayType(StructType([
    StructField("dt", LongType()),
    StructField("main", StructType([StructField("temp", DoubleType()), StructField("humidity", IntegerType()),
                                    StructField("pressure", IntegerType())])),
    StructField("wind", StructType([StructField("speed", DoubleType())])),
    StructField("weather", ArrayType(StructType(_s("main", "description")))),
])))])

AIRPORT = StructType([
    StructField("GMT", StringType()), StructField("codeIataAirport", StringType()),
    StructField("codeIataCity", StringType()), StructField("codeIcaoAirport", StringType()),
    StructField("codeIso2Country", StringType()), StructField("latitudeAirport", DecimalType(10, 6)),
    StructField("longitudeAirport", DecimalType(10, 6)), StructField("nameAirport", StringType()),
    StructField("nameCountry", StringType()), StructField("phone", StringType()), StructField("timezone", StringType()),
])
AIRPORTS_BY_CITY = MapType(StringType(), ArrayType(AIRPORT))

LOOKUP_PAYLOAD = StructType([StructField("airportsByCities", ArrayType(StructType(
    _s("nameCountry", "codeIcaoAirport", "codeIataAirport"))))])

POINT = StructType([StructField("lat", DoubleType()), StructField("lon", DoubleType())])
CITY_BOXES = MapType(StringType(), StructType([StructField("topLeftPoint", POINT),
                                               StructField("btmRightPoint", POINT)]))

CITY_COORDINATES = StructType([StructField("coordinates", ArrayType(StructType([
    StructField("city_name", StringType()), StructField("lat", DoubleType()), StructField("lon", DoubleType())])))])

CALENDAR = StructType([
    StructField("cities", ArrayType(StringType())), StructField("country_codes", ArrayType(StringType())),
    StructField("timezones", ArrayType(IntegerType())), StructField("summer_time_addition", ArrayType(IntegerType())),
])

BUSIEST_AIRPORTS_CSV = StructType([
    StructField("Rank", IntegerType()), StructField("Country", StringType()), StructField("Airport", StringType()),
    StructField("City served", StringType()), StructField("Passengers 2023", StringType()),
])
