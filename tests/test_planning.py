import datetime as dt

from pyspark.sql import functions as F

from airshed.plans import planning

D = dt.date


def test_segments_keep_every_day_by_default(spark):
    df = spark.createDataFrame([("u", dt.datetime(2024, 1, 1, 5)), ("u", dt.datetime(2024, 1, 8, 5)),
                                ("one", dt.datetime(2024, 1, 3, 1))], "e string, ts timestamp_ntz")
    plan = {(r["e"], r["seg_no"]): (r["seg_start"], r["seg_end"]) for r in planning.segment_plan(df, ["e"], "ts").collect()}
    assert plan == {("u", 1): (D(2024, 1, 1), D(2024, 1, 7)), ("u", 2): (D(2024, 1, 8), D(2024, 1, 8)),
                    ("one", 1): (D(2024, 1, 3), D(2024, 1, 3))}


def test_entities_without_facts_get_the_first_run_plan(spark):
    floor, week = 1701388800, 7 * 86400
    now = floor + 9 * 86400
    ev = spark.createDataFrame([("known", dt.datetime(2023, 12, 8))], "e string, ts timestamp_ntz")
    ents = spark.createDataFrame([("known",), ("new",), ("new",)], "e string")
    got = sorted((r["e"], r["seg_no"], r["hwm_epoch"], r["start_epoch"], r["end_epoch"]) for r in
                 planning.gap_plan(ev, ["e"], "ts", now, entities=ents).collect())
    assert got == [("known", 1, floor + week, floor + week + 1, now), ("new", 1, None, floor, floor + week - 1),
                   ("new", 2, None, floor + week, floor + 2 * week - 1)]


def segs(spark, start, end, width=7, inclusive=False):
    df = spark.createDataFrame([(start, end)], "s date, e date")
    return [(r["seg_no"], r["seg_start"], r["seg_end"]) for r in
            planning.explode_segments(df, "s", "e", width, inclusive, keep=[]).orderBy("seg_no").collect()]


def test_weekly_segments_strict_and_inclusive(spark):
    assert segs(spark, D(2024, 1, 1), D(2024, 1, 1)) == []                                  # start = end
    assert segs(spark, D(2024, 1, 1), D(2024, 1, 1), inclusive=True) == [(1, D(2024, 1, 1), D(2024, 1, 1))]
    assert segs(spark, D(2024, 1, 1), D(2024, 1, 7)) == [(1, D(2024, 1, 1), D(2024, 1, 7))]  # 7-day range
    assert segs(spark, D(2024, 1, 1), D(2024, 1, 8)) == [(1, D(2024, 1, 1), D(2024, 1, 7))]  # 8 days: tail lost
    assert segs(spark, D(2024, 1, 1), D(2024, 1, 8), inclusive=True) == [
        (1, D(2024, 1, 1), D(2024, 1, 7)), (2, D(2024, 1, 8), D(2024, 1, 8))]
    assert segs(spark, D(2024, 1, 1), D(2024, 1, 15)) == [
        (1, D(2024, 1, 1), D(2024, 1, 7)), (2, D(2024, 1, 8), D(2024, 1, 14))]              # 15 days
    assert segs(spark, D(2024, 1, 1), D(2024, 1, 12), width=6, inclusive=True) == [
        (1, D(2024, 1, 1), D(2024, 1, 6)), (2, D(2024, 1, 7), D(2024, 1, 12))]


def test_segments_cover_without_overlap(spark):
    out = segs(spark, D(2024, 1, 3), D(2024, 3, 1), inclusive=True)
    assert out[0][1] == D(2024, 1, 3) and out[-1][2] == D(2024, 3, 1)
    for (_, _, e1), (_, s2, _) in zip(out, out[1:]):
        assert (s2 - e1).days == 1


def test_gap_plan(spark):
    week = 7 * 86400
    floor = 1701388800  # 2023-12-01 UTC
    now = floor + 20 * 86400
    ev = spark.createDataFrame([
        ("fresh", dt.datetime(2023, 12, 21)),           # hwm == now → no gap
        ("lagging", dt.datetime(2023, 12, 10)),
        ("ancient", dt.datetime(2020, 1, 1)),           # older than the floor → floored
    ], "e string, ts timestamp_ntz")
    plan = {(r["e"], r["seg_no"]): (r["start_epoch"], r["end_epoch"]) for r in
            planning.gap_plan(ev, ["e"], "ts", now).collect()}
    hwm = floor + 9 * 86400
    assert plan[("lagging", 1)] == (hwm + 1, hwm + week) and plan[("lagging", 2)] == (hwm + week + 1, now)
    assert plan[("ancient", 1)] == (floor + 1, floor + week)
    assert ("ancient", 3) in plan and plan[("ancient", 3)][1] == now
    assert not any(k[0] == "fresh" for k in plan)
    init = planning.initial_plan(spark, now).orderBy("seg_no").collect()
    assert [(r["start_epoch"], r["end_epoch"]) for r in init] == [
        (floor, floor + week - 1), (floor + week, floor + 2 * week - 1), (floor + 2 * week, floor + 3 * week - 1)]


def test_request_grid_and_utc_windows(spark):
    facts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 6),), (dt.datetime(2024, 1, 10, 6),)], "ts timestamp_ntz")
    ents = spark.createDataFrame([("Paris",), ("Bern",)], "city string")
    grid = planning.request_grid(ents, facts, "ts").collect()
    assert len(grid) == 4 and {r["seg_end"] for r in grid} == {D(2024, 1, 7), D(2024, 1, 10)}
    days = spark.createDataFrame([(D(2024, 7, 1), "Europe/Zurich"), (D(2024, 1, 1), "Europe/Zurich")],
                                 "day date, zone string")
    w = {r["day"]: (r["start_utc"], r["end_utc"]) for r in planning.utc_windows(days, "day", F.col("zone")).collect()}
    assert w[D(2024, 7, 1)] == (dt.datetime(2024, 7, 1, 4), dt.datetime(2024, 7, 1, 7))
    assert w[D(2024, 1, 1)] == (dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 8))


def test_day_range_and_rolling_weeks(spark):
    r = spark.range(1).select(planning.day_range(F.lit("2024-01-30"), F.lit("2024-02-02")).alias("d")).first()["d"]
    assert len(r) == 4 and r[-1] == D(2024, 2, 2)
    wk = spark.range(1).select(planning.rolling_weeks(F.lit(dt.datetime(2024, 12, 31)), 52).alias("w")).first()["w"]
    assert len(wk) == 52 and wk[-1]["week_end"] == dt.datetime(2024, 12, 31)
    assert wk[0]["week_start"] == dt.datetime(2024, 12, 31) - dt.timedelta(days=364)


def test_daily_segment_and_flow_quality(spark):
    from airshed.functions.clean import flow_quality
    df = spark.createDataFrame([(D(2024, 1, 5),)], "d date")
    assert [tuple(r) for r in planning.daily_segment(df, "d").collect()] == [(D(2024, 1, 5), 1, D(2024, 1, 5),
                                                                              D(2024, 1, 5))]
    q = spark.createDataFrame([(0.0, 1), (9.9, 3), (10.0, 1), (5.0, 4), (None, 1)], "j double, fc int")
    assert [r["ok"] for r in q.select(flow_quality("j", "fc").alias("ok")).collect()] == [True, True, False, False, None]


def test_target_day_and_hourly_profile(spark):
    from airshed.operators.stats import hourly_profile
    assert planning.target_day(D(2024, 3, 3)) == "2024-02-28" and planning.target_day(D(2024, 3, 3), 0) == "2024-03-03"
    df = spark.createDataFrame([("Paris", dt.datetime(2024, 1, 1, 7, 5), 10.0), ("Paris", dt.datetime(2024, 1, 2, 7, 50), 20.0),
                                ("Paris", dt.datetime(2024, 1, 2, 8, 0), 5.0)], "city string, ts timestamp_ntz, speed double")
    got = {(r["city"], r["hour"]): (r["n"], r["avg_speed"]) for r in hourly_profile(df, "city", "ts", "speed").collect()}
    assert got == {("Paris", 7): (2, 15.0), ("Paris", 8): (1, 5.0)}


def test_fixed_offset_windows_and_latest_value(spark):
    from airshed.operators.latest import latest_value
    days = spark.createDataFrame([(D(2024, 7, 1), 1, 1), (D(2024, 1, 1), 1, 1), (D(2024, 7, 1), 9, 0)],
                                 "day date, off int, shift int")
    got = sorted((r["day"], r["off"], r["start_utc"]) for r in
                 planning.utc_windows_fixed(days, "day", F.col("off"), F.col("shift")).collect())
    assert got == [(D(2024, 1, 1), 1, dt.datetime(2024, 1, 1, 5)), (D(2024, 7, 1), 1, dt.datetime(2024, 7, 1, 4)),
                   (D(2024, 7, 1), 9, dt.datetime(2024, 6, 30, 21))]
    files = spark.createDataFrame([("a", "f1", 10), ("a", "f2", 30), ("b", "f3", 5)], "k string, path string, m int")
    assert sorted(tuple(r) for r in latest_value(files, ["k"], "path", "m").collect()) == [("a", "f2"), ("b", "f3")]
