"""Lake readers on small hand-made files; every expected value below is worked out by hand."""

import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from airshed.operators.aggregates import weighted_means
from airshed.plans.views import road_traffic_view
from airshed.sources import lake


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def flight(actual, code="CDG", status="landed", delay=None, **extra):
    rec = {"type": "arrival", "status": status,
           "departure": {"iataCode": "ams", "delay": None, "scheduledTime": "2024-01-01T05:00:00.000",
                         "actualTime": "2024-01-01T05:10:00.000"},
           "arrival": {"iataCode": code, "delay": delay, "scheduledTime": "2024-01-01T06:00:00.000",
                       "actualTime": actual},
           "airline": {"name": "Air Test", "iataCode": "AT"}, "flight": {"number": "100", "iataNumber": "AT100"}}
    rec.update(extra)
    return rec


@pytest.fixture()
def flight_lake(tmp_dir):
    base = os.path.join(tmp_dir, "arrivals")
    day1 = [
        flight("2024-01-01t06:00:00.000", delay="12.7"),                 # accepted, lower-case separator
        flight("2024-01-01T06:10:00.000", codeshared=None),              # code-share key with null value
        flight("2024-01-01T07:00:00"),                                    # no fraction → unparsable
        flight(None),                                                     # no actual time
        flight("2024-01-01T05:59:00.000"),                                # before the window
        flight("2024-01-01T09:00:00.000"),                                # 09:xx excluded by the loader
        flight("2024-01-01T08:59:59.999", delay=""),                      # accepted, '' delay → 0
        42,                                                               # not an object
        flight("2024-01-01T07:30:00.500", code="cdg", delay="0", flight={"number": None, "iataNumber": ""}),
    ]
    write(os.path.join(base, "Paris", "CDG_2024-01-01.json"), json.dumps(day1))
    write(os.path.join(base, "Paris", "CDG_2024-01-02.json"), json.dumps(flight("2024-01-02T06:00:00.000")))
    write(os.path.join(base, "Paris", "CDG_2024-01-03.json"), '[{"type": "arrival"')
    write(os.path.join(base, "Frankfurt am Main", "FRA_2024-01-01.json"),
          json.dumps([flight("2024-01-01T06:45:00.000", code="FRA")]))
    return base


def test_flight_reader_accepts_and_rejects(spark, flight_lake):
    load = lake.read_flights(spark, flight_lake, "arrival")
    rows = load.rows.orderBy("city", "arrival_actual_time").collect()
    assert [(r["city"], r["arrival_iata"], r["arrival_actual_time"], r["arrival_delay"]) for r in rows] == [
        ("Frankfurt am Main", "FRA", dt.datetime(2024, 1, 1, 6, 45), 0),
        ("Paris", "CDG", dt.datetime(2024, 1, 1, 6, 0), 12),
        ("Paris", "cdg", dt.datetime(2024, 1, 1, 7, 30, 0, 500000), 0),
        ("Paris", "CDG", dt.datetime(2024, 1, 1, 8, 59, 59, 999000), 0),
    ]
    by_num = {r["arrival_actual_time"].minute: r for r in rows}
    assert by_num[30]["flight_number"] is None and by_num[30]["flight_iata_number"] is None  # '' lands as NULL
    assert rows[0]["departure_actual_time"] == dt.datetime(2024, 1, 1, 5, 10)
    reasons = {r["reason"]: r["n"] for r in load.rejects.groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert reasons == {"codeshared": 1, "no_actual_time": 2, "outside_window": 2, "not_object": 1, "bad_file": 2}
    stats = {r["reason"]: r["n"] for r in load.stats().collect()}
    assert stats["accepted"] == 4


def test_flight_reader_day_selection_and_departures(spark, flight_lake):
    load = lake.read_flights(spark, flight_lake, "arrival", glob=lake.day_glob("2024-01-01"))
    assert load.rows.count() == 4
    assert load.rejects.filter("reason = 'bad_file'").count() == 0
    dep = lake.read_flights(spark, flight_lake, "departure", glob=lake.day_glob("2024-01-01"))
    # departures filter on the departure actual time (05:10 for every fixture record) → all outside the window
    assert dep.rows.count() == 0
    assert set(dep.rows.columns) >= {"arrival_estimated_time"} and "arrival_delay" not in dep.rows.columns


def road_rec(desc, length, speed=50.0, free=60.0, jam=1.0, drop=None):
    loc = {"length": length, "shape": "x", "subSegments": [{"a": 1}]}
    if desc is not None:
        loc["description"] = desc
    flow = {"speed": speed, "freeFlow": free, "jamFactor": jam, "subSegments": [1]}
    if drop:
        flow.pop(drop)
    return {"location": loc, "currentFlow": flow}


@pytest.fixture()
def road_lake(tmp_dir):
    base = os.path.join(tmp_dir, "road")
    recs = [road_rec("A1", 100, 50, 60, 1), road_rec("A1", 300, 30, 60, 3), road_rec(None, 50),
            road_rec("B2", 0, 40, 50, 2), road_rec("C3", 200, None, 70, 0)]
    recs.append(road_rec("", 10, 70))
    write(os.path.join(base, "2024-01-01", "Zürich_2024-01-01T05--00--00_2024-01-01T08--00--00.json"),
          json.dumps(recs))
    write(os.path.join(base, "2024-01-01", "Paris_2024-01-01T05--00--00_2024-01-01T08--00--00.json"),
          json.dumps([road_rec("P1", 10, 20, 30, 4), road_rec("P2", 10, 40, 50, 6), road_rec("P9", 10, drop="speed")]))
    return base


def test_road_reader_weighted_means_and_medians(spark, road_lake):
    load = lake.read_road(spark, road_lake)
    assert load.rejects.collect()[0]["reason"] == "missing_key"
    rows = load.rows
    assert rows.filter("city = 'Zürich'").count() == 6
    assert rows.select(F.min("date")).first()[0] == dt.datetime(2024, 1, 1, 5)
    seg = weighted_means(rows, ["date", "city", "road"], "length", ["speed", "freeflow", "jamfactor"])
    got = {(r["city"], r["road"]): (r["length"], r["speed"], r["freeflow"], r["jamfactor"]) for r in seg.collect()}
    assert got[("Zürich", "A1")] == (400.0, 35.0, 60.0, 2.5)
    assert got[("Zürich", "B2")] == (0.0, None, None, None)      # zero total length → no mean
    assert got[("Zürich", "C3")] == (200.0, 0.0, 70.0, 0.0)      # NULL speed adds 0 but its length counts
    assert ("Zürich", None) not in got                          # roads without description vanish
    view = {r["city"]: r for r in road_traffic_view(seg).collect()}
    assert set(view) == {"Zurich", "Paris"}
    assert got[("Zürich", "")] == (10.0, 70.0, 60.0, 1.0)        # an empty name is a group
    assert view["Zurich"]["median_speed"] == 35.0                # of 0, 35 and 70; B2 has no speed
    assert view["Zurich"]["traffic_date"] == dt.date(2024, 1, 1)
    assert view["Paris"]["median_jam"] == 5.0


def test_road_reader_strict_aborts(spark, road_lake):
    with pytest.raises(ValueError, match="missing_key"):
        lake.read_road(spark, road_lake, strict=True)


def test_road_payload_prune(spark, tmp_dir):
    base = os.path.join(tmp_dir, "raw")
    rec = road_rec("A1", 10)
    rec.update(id=7, geo=[1, {"subSegments": "kept, as it stands deeper"}], note=None, text="ä \"q\"")
    rec["location"]["links"] = [{"length": 1.5}]
    rec["currentFlow"]["extra"] = {"subSegments": 1}
    write(os.path.join(base, "a.json"), json.dumps({"results": [rec, {"id": 8}]}))
    out = [json.loads(r["elem"]) for r in lake.prune_road_payload(spark, base).orderBy("pos").collect()]
    for side in ("location", "currentFlow"):
        rec[side].pop("subSegments")
    assert out == [rec, {"id": 8}]                       # everything but the first-level objects' key is kept
    write(os.path.join(tmp_dir, "raw2", "b.json"), json.dumps({"other": []}))
    with pytest.raises(Exception, match="results"):
        lake.prune_road_payload(spark, os.path.join(tmp_dir, "raw2")).collect()


def epoch(y, m, d, h):
    return int(dt.datetime(y, m, d, h, tzinfo=dt.timezone.utc).timestamp())


def test_pollution_and_weather_histories(spark, tmp_dir):
    comps = {p: 1.0 for p in ["co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3"]}
    pol = [{"place": "Paris", "latitude": 48.8, "longitude": 2.3, "timestamp": epoch(2024, 1, 1, 6),
            "date": "2024-01-01 06:00:00", "air_quality_index": 2, "components": dict(comps, co=None)},
           {"place": "Paris", "latitude": 48.8, "longitude": 2.3, "timestamp": epoch(2024, 1, 1, 7),
            "date": "2024-01-01 07:00:00", "air_quality_index": 3, "components": {"co": 1.0}}]
    write(os.path.join(tmp_dir, "pollution", "air_pollution_data.json"), json.dumps(pol))
    load = lake.read_pollution_history(spark, os.path.join(tmp_dir, "pollution"))
    rows = load.rows.collect()
    assert len(rows) == 1 and rows[0]["co"] is None and rows[0]["date"] == dt.datetime(2024, 1, 1, 6)
    assert load.rejects.first()["reason"] == "missing_key"
    wea = [{"place": "Paris", "latitude": 1.0, "longitude": 2.0, "timestamp": epoch(2024, 1, 1, 6),
            "date": "2024-01-01 06:00:00", "temperature": 1.5, "humidity": 80, "pressure": 1010, "wind_speed": 3.0,
            "weather_main": "Clouds", "weather_description": "few clouds"}]
    write(os.path.join(tmp_dir, "weather", "weather_data.json"), json.dumps(wea))
    w = lake.read_weather_history(spark, os.path.join(tmp_dir, "weather")).rows
    assert w.columns == lake.WEATHER_FIELDS and w.first()["humidity"] == 80


def test_raw_payloads(spark, tmp_dir):
    comps = {p: 2.0 for p in ["co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3"]}
    entries = [{"dt": epoch(2024, 1, 1, h), "main": {"aqi": h}, "components": comps} for h in (5, 6, 9, 10)]
    write(os.path.join(tmp_dir, "pp", "Paris", "r1.json"), json.dumps({"list": entries}))
    write(os.path.join(tmp_dir, "pp", "Paris", "r2.json"), json.dumps({"cod": 200}))
    coords = spark.createDataFrame([("Paris", 48.8, 2.3)], "city_name string, lat double, lon double")
    pol = lake.pollution_from_payloads(spark, os.path.join(tmp_dir, "pp"), coordinates=coords).orderBy("timestamp")
    write(os.path.join(tmp_dir, "pp", "Bern", "cut.json"), json.dumps({"list": entries})[:-20])
    load = lake.read_pollution_payloads(spark, os.path.join(tmp_dir, "pp"), coordinates=coords)
    assert {r["reason"]: r["n"] for r in load.stats().collect()} == {"accepted": 2, "bad_file": 1, "no_list": 1}
    assert [r["file_path"].split("/")[-1] for r in load.rejects.filter("reason = 'bad_file'").collect()] == ["cut.json"]
    got = [(r["air_quality_index"], r["date"].hour, r["latitude"]) for r in pol.collect()]
    assert got == [(6, 6, 48.8), (9, 9, 48.8)]
    wx = [{"dt": epoch(2024, 1, 1, 6), "main": {"temp": 1.0, "humidity": 70, "pressure": 1000}, "wind": {"speed": 2.0},
           "weather": [{"main": "Rain", "description": "light rain"}, {"main": "Mist", "description": "mist"}]},
          {"dt": epoch(2024, 1, 1, 7), "main": {"temp": 2.0, "humidity": 71, "pressure": 1001}, "wind": {"speed": 1.0},
           "weather": []}]
    write(os.path.join(tmp_dir, "wp", "Bern", "r1.json"), json.dumps({"list": wx}))
    w = lake.weather_from_payloads(spark, os.path.join(tmp_dir, "wp")).orderBy("timestamp").collect()
    assert [(r["place"], r["weather_main"]) for r in w] == [("Bern", "Rain"), ("Bern", None)]
    with pytest.raises(Exception):
        lake.weather_from_payloads(spark, os.path.join(tmp_dir, "wp"), strict=True).collect()


def airport(code, city_code="PAR", country="France", icao="LFPG", lat="49.009722"):
    return {"GMT": "1", "codeIataAirport": code, "codeIataCity": city_code, "codeIcaoAirport": icao,
            "codeIso2Country": "FR", "latitudeAirport": lat, "longitudeAirport": "2.547778", "nameAirport": f"{code} A",
            "nameCountry": country, "phone": "", "timezone": "Europe/Paris"}


def test_airport_map_and_dimensions(spark, tmp_dir):
    amap = {"Paris": [airport("CDG"), airport("ORY", lat="48.723333")], "Paris2": [airport("CDG")],
            "Bern": [airport(None, "BRN", "Switzerland")]}
    write(os.path.join(tmp_dir, "airports", "airport_per_city.json"), json.dumps(amap))
    write(os.path.join(tmp_dir, "airports2", "airport_per_city.json"), json.dumps(amap)[:-30])
    cut = lake.read_airport_map(spark, os.path.join(tmp_dir, "airports2"))
    assert cut.rows.count() == 0 and cut.rejects.first()["reason"] == "bad_file"
    rows = lake.read_airports(spark, os.path.join(tmp_dir, "airports")).collect()
    assert sorted((r["city_name"], r["code_iata_airport"]) for r in rows if r["code_iata_airport"]) == \
        [("Paris", "CDG"), ("Paris", "ORY")]                      # the repeated CDG is loaded once
    assert any(r["code_iata_airport"] is None for r in rows)
    assert str(next(r for r in rows if r["code_iata_airport"] == "ORY")["latitude"]) == "48.723333"

    csv = 'Rank,Country,Airport,City served,Passengers 2023\n1,Turkey12,Istanbul Airport[1],Istanbul,"76,027,321[2]"\n'
    write(os.path.join(tmp_dir, "csv", "busiest.csv"), csv)
    b = lake.read_busiest_airports(spark, os.path.join(tmp_dir, "csv")).first()
    assert (b["rank"], b["country"], b["airport"], b["passengers"]) == (1, "Turkey", "Istanbul Airport", 76027321)

    boxes = {"Paris": {"topLeftPoint": {"lat": 49.0, "lon": 2.0}, "btmRightPoint": {"lat": 48.0, "lon": 3.0}}}
    write(os.path.join(tmp_dir, "boxes", "geocode_data.json"), json.dumps(boxes))
    bx = lake.read_city_boxes(spark, os.path.join(tmp_dir, "boxes")).first()
    assert (bx["west"], bx["south"], bx["east"], bx["north"]) == (2.0, 48.0, 3.0, 49.0)

    write(os.path.join(tmp_dir, "boxes2", "geocode_data.json"), json.dumps(boxes)[:-5])
    with pytest.raises(Exception, match="not a JSON object"):
        lake.read_city_boxes(spark, os.path.join(tmp_dir, "boxes2")).collect()
    write(os.path.join(tmp_dir, "coords", "config.json"),
          json.dumps({"coordinates": [{"city_name": "Paris", "lat": 48.8, "lon": 2.3}]}))
    assert lake.read_city_coordinates(spark, os.path.join(tmp_dir, "coords")).first()["lat"] == 48.8

    write(os.path.join(tmp_dir, "cal", "config.json"), json.dumps(
        {"cities": ["Paris", "Bern"], "country_codes": ["FR", "CH"], "timezones": [1, 1],
         "summer_time_addition": [1, 1]}))
    cal = lake.read_calendar(spark, os.path.join(tmp_dir, "cal")).orderBy("city").collect()
    assert [(r["city"], r["country_code"], r["utc_offset"]) for r in cal] == [("Bern", "CH", 1), ("Paris", "FR", 1)]
    write(os.path.join(tmp_dir, "cal2", "config.json"), json.dumps(
        {"cities": ["Paris", "Bern"], "country_codes": ["FR"], "timezones": [1, 1], "summer_time_addition": [1, 1]}))
    with pytest.raises(Exception):
        lake.read_calendar(spark, os.path.join(tmp_dir, "cal2")).collect()


def test_lookup_filter(spark):
    ans = lambda *a: json.dumps({"airportsByCities": [
        {"nameCountry": c, "codeIcaoAirport": i, "codeIataAirport": x} for c, i, x in a]})
    pairs = spark.createDataFrame([
        ("London", "United Kingdom", ans(("United Kingdom", "EGLL", "LHR"), ("Canada", "CYXU", "YXU"),
                                          ("United Kingdom", "", "XXX"))),
        ("Nowhere", "France", ans(("Spain", "LEMD", "MAD"))),
        ("Empty", "France", json.dumps({})),
    ], "city string, country string, payload string")
    out = lake.filter_lookup(pairs).collect()
    assert [(r["city"], [a["codeIataAirport"] for a in r["airports"]]) for r in out] == [("London", ["LHR"])]


def test_latest_file_and_lake_writer(spark, tmp_dir):
    base = os.path.join(tmp_dir, "hist")
    write(os.path.join(base, "old.json"), "[]")
    write(os.path.join(base, "new.json"), "[]")
    os.utime(os.path.join(base, "old.json"), (1_600_000_000, 1_600_000_000))
    os.utime(os.path.join(base, "new.json"), (1_700_000_000, 1_700_000_000))
    assert lake.latest_file(spark, base).first()["file_path"].endswith("new.json")
    df = spark.createDataFrame([("Paris", "2024-01-01", 1)], "city string, day string, n int")
    lake.write_lake_json(df, os.path.join(tmp_dir, "out"), ["city", "day"])
    assert os.path.isdir(os.path.join(tmp_dir, "out", "city=Paris", "day=2024-01-01"))


def test_lookup_codes_and_geocoder(spark):
    ans = json.dumps({"airportsByCities": [{"nameCountry": "France", "codeIcaoAirport": "LFPG", "codeIataAirport": "CDG"},
                                           {"nameCountry": "France", "codeIcaoAirport": "LFPO", "codeIataAirport": ""}]})
    pairs = spark.createDataFrame([("Paris", "France", ans), ("Paris", "France", ans)],
                                  "city string, country string, payload string")
    assert [r["code"] for r in lake.lookup_codes(lake.filter_lookup(pairs)).collect()] == ["CDG", "CDG"]
    geo = spark.createDataFrame([("Paris", json.dumps([{"name": "Paris", "lat": 48.8, "lon": 2.3},
                                                       {"name": "Paris TX", "lat": 33.6, "lon": -95.5}])),
                                 ("Atlantis", "[]")], "city string, payload string")
    assert [tuple(r) for r in lake.geocode_first_hit(geo).collect()] == [("Paris", 48.8, 2.3)]


def test_road_reader_strict_aborts_on_bad_file(spark, tmp_dir):
    good = [road_rec("P1", 10, 20, 30, 4)]
    base = os.path.join(tmp_dir, "road2")
    write(os.path.join(base, "2024-01-01", "Paris_2024-01-01T05--00--00_2024-01-01T08--00--00.json"), json.dumps(good))
    write(os.path.join(base, "2024-01-02", "Bern_2024-01-02T05--00--00_2024-01-02T08--00--00.json"), "[{")
    lenient = lake.read_road(spark, base)
    assert lenient.rejects.filter("reason = 'bad_file'").count() == 1 and lenient.rows.count() == 1
    with pytest.raises(ValueError, match="bad_file"):
        lake.read_road(spark, base, strict=True)
    clean = os.path.join(tmp_dir, "road3")
    write(os.path.join(clean, "2024-01-01", "Paris_2024-01-01T05--00--00_2024-01-01T08--00--00.json"), json.dumps(good))
    assert lake.read_road(spark, clean, strict=True).rows.count() == 1


def test_month_folder_selection(spark, tmp_dir):
    base = os.path.join(tmp_dir, "road4")
    for day in ("2024-01-05", "2024-01-20", "2024-02-01"):
        write(os.path.join(base, day, f"Paris_{day}T05--00--00_{day}T08--00--00.json"),
              json.dumps([road_rec("P1", 10, 20, 30, 4)]))
    jan = lake.read_road(spark, lake.month_dirs(base, 2024, 1)).rows
    assert sorted(r["date"].day for r in jan.collect()) == [5, 20]
    assert lake.month_dirs(base, None, 1) is None                  # a missing year selects nothing


def test_history_as_json_lines(spark, tmp_dir):
    rec = {"place": "Paris", "latitude": 1.0, "longitude": 2.0, "timestamp": epoch(2024, 1, 1, 6),
           "date": "2024-01-01 06:00:00", "temperature": 1.5, "humidity": 80, "pressure": 1010, "wind_speed": 3.0,
           "weather_main": None, "weather_description": "x"}
    write(os.path.join(tmp_dir, "w", "day=2024-01-01", "part-0.json"), f"{json.dumps(rec)}\n\n{json.dumps(rec)}\n42\n")
    write(os.path.join(tmp_dir, "w", "cut.json"), "[{")
    load = lake.read_weather_history(spark, os.path.join(tmp_dir, "w"))
    assert load.rows.count() == 2
    assert sorted(r["reason"] for r in load.rejects.collect()) == ["bad_file", "not_object"]


def test_empty_array_is_no_reject(spark, tmp_dir):
    write(os.path.join(tmp_dir, "e", "Paris", "CDG_2024-01-01.json"), "[]")
    load = lake.read_flights(spark, os.path.join(tmp_dir, "e"))
    assert load.rows.count() == 0 and load.rejects.count() == 0


def test_road_files_of_a_day(spark, tmp_dir):
    base = os.path.join(tmp_dir, "road5")
    for day in ("2024-01-05", "2024-01-06"):
        write(os.path.join(base, f"Paris_{day}T05--00--00_{day}T08--00--00.json"), json.dumps([road_rec("P1", 10)]))
    rows = lake.read_road(spark, base, glob=lake.road_day_glob("2024-01-06")).rows.collect()
    assert [r["date"].day for r in rows] == [6]


def test_a_staged_load_parses_its_files_once(spark, flight_lake):
    load = lake.read_flights(spark, flight_lake, "arrival").once()
    plan = load.rows._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and "FileScan parquet" in plan
    assert load.rows.count() == 4


def _road(speed):
    return {"location": {"length": 1.0}, "currentFlow": {"speed": speed, "freeFlow": 1.0, "jamFactor": 0.0}}


def test_a_day_lists_its_own_folders(spark, tmp_dir):
    for day in range(1, 9):
        write(f"{tmp_dir}/road/2024-01-{day:02d}/Paris_2024-01-{day:02d}T05--00--00_2024-01-{day:02d}T08--00--00.json",
              json.dumps([_road(float(day))]))
    write(f"{tmp_dir}/road/backfill/Rome_2024-01-03T05--00--00_2024-01-03T08--00--00.json",
          json.dumps([_road(33.0)]))
    assert lake.day_paths(spark, f"{tmp_dir}/road", "2024-01-03") == [f"{tmp_dir}/road/2024-01-03", f"{tmp_dir}/road/backfill"]
    rows = lake.read_road(spark, f"{tmp_dir}/road", day="2024-01-03").rows
    assert sorted(r.speed for r in rows.collect()) == [3.0, 33.0]
    assert lake.read_road(spark, f"{tmp_dir}/road/backfill", day="2024-01-03").rows.count() == 1   # no day folders
    only_days = f"{tmp_dir}/only"
    write(f"{only_days}/2024-01-01/Paris_2024-01-01T05--00--00_2024-01-01T08--00--00.json", "[]")
    assert lake.read_road(spark, only_days, day="2024-02-01").rows.count() == 0


def test_the_write_counts_the_load(spark, tmp_dir):
    """Reasons and numbers are those of a count over the rows, and come without a job of their own."""
    write(f"{tmp_dir}/road/Paris_2024-01-01T05--00--00_2024-01-01T08--00--00.json",
          json.dumps([_road(1.0), 5, {"location": {}, "currentFlow": {"speed": 1.0}}]))
    write(f"{tmp_dir}/road/Rome_2024-01-01T05--00--00_2024-01-01T08--00--00.json", json.dumps({"not": "an array"}))
    load = lake.read_road(spark, f"{tmp_dir}/road")
    counted = load.once()
    assert counted.counts == {r["reason"]: r["n"] for r in load.stats().collect()} == {
        "accepted": 1, "not_object": 1, "missing_key": 1, "bad_file": 1}
    assert {r["reason"]: r["n"] for r in counted.stats().collect()} == counted.counts
    assert "Scan parquet" not in counted.stats()._jdf.queryExecution().executedPlan().toString()
    assert lake.read_road(spark, f"{tmp_dir}/road", glob="nothing*.json").once().counts == {}


def test_exploded_rows_do_not_carry_their_file(spark, tmp_dir):
    """A row per element that holds the whole parsed array too takes memory by the square of a file's elements."""
    write(os.path.join(tmp_dir, "Paris", "X_2024-01-01T05--00--00_2024-01-01T08--00--00.json"), json.dumps([{"a": 1}, 42]))
    loads = [lake.read_flights(spark, tmp_dir), lake.read_road(spark, tmp_dir), lake.read_pollution_history(spark, tmp_dir),
             lake.read_weather_history(spark, tmp_dir)]
    for df in [x for load in loads for x in (load.rows, load.rejects)]:
        plan = df._jdf.queryExecution().executedPlan().toString()
        carried = re.findall(r"Generate posexplode\w*\(_arr#\d+\), \[([^\]]*)\]", plan)
        assert carried and not any("_arr" in c or "value" in c for c in carried)
