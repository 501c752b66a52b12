"""Landed files stay bounded: small files land and read back to the same results."""

import json
import os
import re
import types

import pytest
from pyspark.sql import functions as F

from airshed import lake_workloads as w
from airshed.sources import lake
from airshed.sources.tables import Tables
from airshed.workloads import REGISTRY
from tools.oracle_check import run_checks

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")
QUERIES = {"lake_day_files", "lake_flight_rejects", "lake_airports", "lookup_filter", "lookup_codes"}


def test_groups_land_as_many_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(w, "FILE_BYTES", 1500)
    monkeypatch.setattr(w, "_LANDED", {})
    results = list(run_checks(spark, DATA, only=QUERIES))
    assert {n: d for n, s, d in results if s != "OK"} == {} and len(results) == len(QUERIES)
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(w._landed(spark, DATA, "flights")) \
        .agg(F.max("length"), F.sum(F.col("path").contains("/XYZ1_").cast("int"))).first()
    assert sizes[0] < 8000 and sizes[1] > 0


def test_lookup_answers_come_in_pages(spark, monkeypatch):
    monkeypatch.setattr(w, "FILE_BYTES", 50)
    pages = w._answers(Tables(spark, DATA)).groupBy("city").count()
    assert pages.agg(F.max("count")).first()[0] > 1
    assert [s for _, s, _ in run_checks(spark, DATA, only={"lookup_filter", "lookup_codes"})] == ["OK", "OK"]


def test_busiest_list_is_written_by_every_task(spark, tmp_path):
    part = Tables(spark, DATA).part
    w._land_busiest(types.SimpleNamespace(part=part.repartition(3)), str(tmp_path))
    files = [f for f in os.listdir(tmp_path / "csv") if f.endswith(".csv")]
    assert len(files) == 3
    assert lake.read_busiest_airports(spark, str(tmp_path / "csv")).count() == part.count()


def events(spark, n):
    return spark.range(n).select(
        F.col("id").alias("event_id"), F.lit("2024-01-15 07:00:00").cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 9).alias("user_id"), F.lit("click").alias("event_type"), F.col("id").cast("double").alias("value"),
        F.lit('{"k": 1}').alias("props"))


def test_no_task_gathers_a_landed_file(spark):
    tables = types.SimpleNamespace(events=events(spark, 10), spark=spark)
    for feed in ("flights", "road", "road-payloads", "pollution-history", "weather-history", "payloads"):
        plan = w._FEEDS[feed](tables)._jdf.queryExecution().executedPlan().toString()
        assert "collect_list" not in plan and "array_join" not in plan, feed


def test_a_landed_file_is_one_array_of_all_its_records(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(w, "FILE_BYTES", 100_000)
    rows = events(spark, 9000).repartition(7)                   # more than a window holds in memory at once
    record = F.to_json(F.struct("event_id"))
    for wrap in ("", "list"):
        w._land(w._arrays(rows, record, F.col("event_type"), w._day_file(), wrap), f"{tmp_path}/{wrap or 'flat'}")
        files = [json.loads(f.read_text()) for f in (tmp_path / (wrap or "flat") / "click").iterdir() if f.suffix == ".json"]
        found = [r["event_id"] for f in files for r in (f[wrap] if wrap else f)]
        assert len(files) == 2 and sorted(found) == list(range(9000))


@pytest.mark.parametrize("name", ["lake_day_files", "lake_pollution_history", "road_reload_round_trip", "lake_flight_rejects",
                                  "lake_departures"])
def test_a_query_explodes_its_files_into_bare_elements(spark, monkeypatch, tmp_path, name):
    """The results are whole, and what the query reads its files by, staged or not, holds no array or text per element."""
    events(spark, 400).coalesce(1).write.parquet(f"{tmp_path}/parts")
    next(tmp_path.glob("parts/*.parquet")).rename(tmp_path / "events.parquet")
    monkeypatch.setattr(w, "_LANDED", {})
    read, staged = [], lake.staged_rewrite
    monkeypatch.setattr(lake, "staged_rewrite", lambda df, *label: read.append(df) or staged(df, *label))
    result = REGISTRY[name].run(spark, str(tmp_path))
    for df in read or [result]:
        plan = df._jdf.queryExecution().executedPlan().toString()
        carried = re.findall(r"Generate posexplode\w*\(_arr#\d+\), \[([^\]]*)\]", plan)
        assert carried and not any("_arr" in c or "value" in c for c in carried)
    assert [s for _, s, _ in run_checks(spark, str(tmp_path), only={name})] == ["OK"]
