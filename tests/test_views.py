"""Warehouse views on a hand-made fixture (FIXTURES.md §2 golden checks)."""

import datetime as dt

import pytest

from airshed.plans import views

T = dt.datetime
POLLUTANTS = views.POLLUTANTS


@pytest.fixture()
def feeds(spark):
    arrivals = spark.createDataFrame([
        ("CDG", "landed", T(2024, 1, 1, 6, 10)), ("CDG", "landed", T(2024, 1, 1, 6, 20)),
        ("CDG", "landed", T(2024, 1, 1, 7, 5)), ("CDG", "active", T(2024, 1, 1, 6, 30)),   # wrong status
        ("CDG", "landed", T(2024, 1, 1, 10, 0)),                                              # after the window
        ("ory", "landed", T(2024, 1, 1, 8, 15)),                                              # lower-case code
        ("XXX", "landed", T(2024, 1, 1, 6, 0)),                                               # unmapped airport
        ("BRN", "landed", T(2024, 1, 2, 6, 0)),                                               # arrivals-only day
    ], "arrival_iata string, status string, arrival_actual_time timestamp_ntz")
    departures = spark.createDataFrame([
        ("CDG", "active", T(2024, 1, 1, 6, 40)), ("CDG", "active", T(2024, 1, 1, 9, 30)),
        ("CDG", "landed", T(2024, 1, 1, 6, 50)),                                              # wrong status
        ("BRN", "active", T(2024, 1, 3, 7, 0)),                                               # departures-only day
    ], "departure_iata string, status string, departure_actual_time timestamp_ntz")
    airports = spark.createDataFrame([
        ("Paris", "FR", "France", "CDG", 49.0, 2.5), ("Paris", "FR", "France", "ORY", 48.7, 2.4),
        ("Bern", "CH", "Switzerland", "BRN", 46.9, 7.5), ("Bern", "CH", "Switzerland", None, 40.0, 1.0),
    ], "city_name string, code_iso2_country string, name_country string, code_iata_airport string, "
       "latitude double, longitude double")
    road = spark.createDataFrame([
        (T(2024, 1, 1, 5), "Paris", "R1", 10.0, 30.0, 50.0, 1.0),
        (T(2024, 1, 1, 5), "Paris", "R2", 10.0, 40.0, 60.0, 3.0),
    ], "date timestamp_ntz, city string, road string, length double, speed double, freeflow double, "
       "jamfactor double")
    pol_cols = ", ".join(f"{p} double" for p in POLLUTANTS)
    pollution = spark.createDataFrame([
        ("Paris", T(2024, 1, 1, 6), 2, 1.0, None, *([None] * 6)),
        ("Paris", T(2024, 1, 1, 7), 3, 0.5, 4.0, *([None] * 6)),
    ], f"place string, date timestamp_ntz, air_quality_index int, {pol_cols}")
    weather = spark.createDataFrame([
        ("Paris", T(2024, 1, 1, 6), 1.0, 80, 1000, 2.0, "Clouds"),
        ("Paris", T(2024, 1, 1, 7), 2.0, 70, 1010, 4.0, "Rain"),
        ("Paris", T(2024, 1, 1, 8), 6.0, 60, 1020, 6.0, "Clear"),
    ], "place string, date timestamp_ntz, temperature double, humidity int, pressure int, wind_speed double, "
       "weather_main string")
    return arrivals, departures, airports, road, pollution, weather


def test_flights_view_full_outer(spark, feeds):
    arrivals, departures, *_ = feeds
    got = {(r["airport_code"], r["date"]): (r["no_arrivals"], r["no_departures"], r["no_total_flights"])
           for r in views.flights_view(arrivals, departures).collect()}
    assert got == {
        ("CDG", T(2024, 1, 1, 6)): (2, 1, 3), ("CDG", T(2024, 1, 1, 7)): (1, 0, 1),
        ("ORY", T(2024, 1, 1, 8)): (1, 0, 1), ("CDG", T(2024, 1, 1, 9)): (0, 1, 1),
        ("XXX", T(2024, 1, 1, 6)): (1, 0, 1), ("BRN", T(2024, 1, 2, 6)): (1, 0, 1),
        ("BRN", T(2024, 1, 3, 7)): (0, 1, 1),
    }


def test_city_airports_view(spark, feeds):
    airports = feeds[2]
    got = sorted(tuple(r) for r in views.city_airports_view(airports).collect())
    assert got == [("Bern", "CH", "Switzerland", 40.0, 1.0, "BRN"),
                   ("Paris", "FR", "France", 48.7, 2.4, "CDG"), ("Paris", "FR", "France", 48.7, 2.4, "ORY")]


def test_master_view_golden(spark, feeds):
    arrivals, departures, airports, road, pollution, weather = feeds
    master = views.master_view(views.flights_view(arrivals, departures), views.city_airports_view(airports),
                               views.road_traffic_view(road), views.air_pollution_view(pollution),
                               views.weather_view(weather))
    got = {(r["city"], r["date"]): r.asDict() for r in master.collect()}
    assert set(got) == {("Paris", dt.date(2024, 1, 1)), ("Bern", dt.date(2024, 1, 2)),
                        ("Bern", dt.date(2024, 1, 3))}                       # the unmapped XXX flight is gone
    p = got[("Paris", dt.date(2024, 1, 1))]
    assert (p["code_iso2_country"], p["name_country"]) == ("FR", "France")
    assert (p["no_arrivals"], p["no_departures"], p["no_total_flights"], p["custom_group"]) == (4, 2, 6, 1)
    assert (p["median_speed"], p["median_freeflow"], p["median_jam"]) == (35.0, 55.0, 2.0)
    assert (p["air_quality_index"], p["co"], p["no"], p["no2"]) == (3, 1.0, 4.0, None)
    assert (p["temperature"], p["humidity"], p["pressure"], p["wind_speed"]) == (3.0, 70.0, 1010.0, 4.0)
    assert p["weather_main"] == "Clear"                                       # latest observation of the day
    b = got[("Bern", dt.date(2024, 1, 3))]
    assert (b["no_arrivals"], b["no_departures"], b["custom_group"]) == (0, 1, 1)
    assert b["median_speed"] is None and b["air_quality_index"] is None and b["weather_main"] is None
    assert master.columns[:8] == ["city", "code_iso2_country", "name_country", "date", "no_arrivals",
                                  "no_departures", "no_total_flights", "custom_group"]


def test_city_name_in_two_countries_and_duplicate_airports(spark, feeds):
    arrivals, departures, airports, road, pollution, weather = feeds
    more = spark.createDataFrame([("Paris", "US", "United States", "PRX", 33.6, -95.5)], airports.schema)
    master = views.master_view(views.flights_view(arrivals, departures), views.city_airports_view(airports.union(more)),
                               views.road_traffic_view(road), views.air_pollution_view(pollution),
                               views.weather_view(weather))
    paris = sorted((r["code_iso2_country"], r["no_total_flights"]) for r in master.filter("city = 'Paris'").collect())
    # one row per country of the city name, flights summed over every airport called Paris
    assert paris == [("FR", 6), ("US", 6)]
