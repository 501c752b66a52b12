"""Refresh of what loads have touched, however late they come."""

import datetime as dt
import os

from pyspark.sql import functions as F

from airshed.operators import sinks, storage
from airshed.plans import changes, jobs
from airshed.plans.refresh import Scope


def day(d):
    return dt.date(2024, 1, d)


def test_notes_are_gathered_and_forgotten(spark, tmp_dir):
    for days in ([day(1), None], [day(1), day(3)], []):
        changes.note(spark, tmp_dir, "road", days)
    found = changes.pending(spark, tmp_dir, "road")
    assert found.days == {day(1), day(3), None} and not found.whole and len(found.notes) == 2
    changes.note(spark, tmp_dir, "road", None)                  # comes while the refresh is under way
    changes.forget(spark, [found])
    after = changes.pending(spark, tmp_dir, "road")
    assert after.whole and not after.days and changes.pending(spark, tmp_dir, "airports").notes == []


def test_scope_of_days_and_of_since(spark):
    rows = spark.createDataFrame([(day(1),), (day(2),), (None,)], "d date")
    some = Scope(days=frozenset({day(2), None}))
    assert [r.d for r in rows.filter(some.rows("d")).collect()] == [day(2), None]
    assert [r.d for r in rows.filter(Scope("2024-01-02").rows("d")).collect()] == [day(2)]
    names = ["d=2024-01-01", "d=2024-01-02", "d=__HIVE_DEFAULT_PARTITION__"]
    assert [some.folder(n) for n in names] == [False, True, True]
    assert [Scope("2024-01-02").folder(n) for n in names] == [False, True, False]


def _road(spark, *rows):
    return spark.createDataFrame([(dt.datetime(2024, 1, d, 5), "Paris", "R", v, v, v) for d, v in rows],
                                 "date timestamp_ntz, city string, road string, speed double, freeflow double, "
                                 "jamfactor double").withColumn("day", F.to_date("date"))


def test_a_late_load_rewrites_its_days_only(spark, tmp_dir):
    """Only the road feed changes: the other views have no tables and are not asked for."""
    wh, views_dir = jobs.Warehouse(f"{tmp_dir}/wh"), f"{tmp_dir}/views"

    def load(rows):
        changes.note(spark, wh.root, "road_traffic", sinks.partition_values(rows, "day"))
        sinks.append_rows(wh.path("road_traffic"), rows, partition_by=["day"])

    def files(d):
        return sorted(os.listdir(f"{views_dir}/road_traffic_v/traffic_date=2024-01-{d:02d}"))

    load(_road(spark, *[(d, 1.0) for d in range(1, 5)]))
    report = jobs._refresh(spark, wh, views_dir, {}, ["road_traffic_v"])
    assert report.ok and report.refreshed == ["road_traffic_v"]
    changes.forget(spark, [changes.pending(spark, wh.root, "road_traffic")])
    before = {d: files(d) for d in range(1, 5)}
    load(_road(spark, (2, 3.0), (9, 5.0)))
    scope = Scope(days=frozenset(changes.pending(spark, wh.root, "road_traffic").days))
    assert jobs._refresh(spark, wh, views_dir, {"road_traffic_v": scope}, ["road_traffic_v"]).ok
    got = {r.traffic_date.day: r.median_speed for r in storage.read_if_exists(spark, f"{views_dir}/road_traffic_v").collect()}
    assert got == {1: 1.0, 2: 2.0, 3: 1.0, 4: 1.0, 9: 5.0}
    assert [d for d in before if files(d) != before[d]] == [2]


def test_observations_go_by_their_date(spark, tmp_dir):
    """A date that is another day than the key's: the refresh finds the row in the folder it is in."""
    wh, views_dir = jobs.Warehouse(f"{tmp_dir}/wh"), f"{tmp_dir}/views"
    columns = "place string, date timestamp_ntz, temperature double, humidity int, pressure int, wind_speed double, " \
              "weather_main string, day date"

    def load(*rows):
        frame = spark.createDataFrame([("Paris", dt.datetime(2024, 1, d, 6), t, 1, 1, 1.0, "x", day(folder))
                                       for d, folder, t in rows], columns)
        sinks.append_rows(wh.path("weather_data"), frame, partition_by=["day"])

    load((1, 1, 1.0), (2, 3, 2.0))
    assert jobs._refresh(spark, wh, views_dir, {}, ["weather_v"]).ok
    load((2, 2, 4.0))
    assert jobs._refresh(spark, wh, views_dir, {"weather_v": Scope(days=frozenset({day(2)}))}, ["weather_v"]).ok
    rows = storage.read_if_exists(spark, f"{views_dir}/weather_v").collect()
    assert sorted((r.day, r.temperature) for r in rows) == [(day(1), 1.0), (day(2), 2.0), (day(2), 4.0)]


def test_a_failing_refresh_keeps_the_notes(spark, tmp_dir):
    wh = jobs.Warehouse(f"{tmp_dir}/wh")
    changes.note(spark, wh.root, "road_traffic", [day(1)])
    report = jobs.refresh_changed(spark, wh, f"{tmp_dir}/views")  # no table is there
    assert not report.ok and "no such table" in report.error
    assert changes.pending(spark, wh.root, "road_traffic").days == {day(1)}
