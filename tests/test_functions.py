import datetime as dt

from pyspark.sql import functions as F

from airshed.functions import clean
from airshed.functions import time as tfn


def one(spark, expr, value, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_parse_flight_ts_edge_cases(spark):
    rows = [("2024-01-01T06:30:00.000",), ("2024-01-01t06:30:00.123",), ("2024-01-01T06:30:00",),
            (None,), ("",), ("junk",), ("2024-01-01T06:30:00.123456",)]
    df = spark.createDataFrame(rows, "s string")
    strict = [r["r"] for r in df.select(tfn.parse_flight_ts("s").alias("r")).collect()]
    assert strict == [dt.datetime(2024, 1, 1, 6, 30), dt.datetime(2024, 1, 1, 6, 30, 0, 123000), None, None, None,
                      None, dt.datetime(2024, 1, 1, 6, 30, 0, 123456)]
    lenient = [r["r"] for r in df.select(tfn.parse_flight_ts("s", strict_fraction=False).alias("r")).collect()]
    assert lenient[2] == dt.datetime(2024, 1, 1, 6, 30)
    assert df.select(tfn.parse_flight_ts("s")).schema[0].dataType.typeName() == "timestamp_ntz"


def test_parse_ts_multi_strict_raises(spark):
    import pytest
    df = spark.createDataFrame([("2024-01-01 06:00:00",), ("nope",)], "s string")
    with pytest.raises(Exception):
        df.select(tfn.parse_ts_multi("s", ["yyyy-MM-dd HH:mm:ss"], strict=True)).collect()
    ok = df.select(tfn.parse_ts_multi("s", ["yyyy-MM-dd HH:mm:ss"]).alias("r")).collect()
    assert [r["r"] for r in ok] == [dt.datetime(2024, 1, 1, 6), None]


def test_parse_ts_multi_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-03-10T02:30:00",)], "s string")  # a gap there
        out = df.select(tfn.parse_ts_multi("s", ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss"], strict=True).alias("r"))
        assert [r["r"] for r in out.collect()] == [dt.datetime(2024, 3, 10, 2, 30)] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_safe_int(spark):
    vals = [None, "", "0", "12.7", "-3.9", "junk", "7", "NaN", "Infinity", "-Infinity", "1e12", "-3e9", "2147483647",
            "2147483648", "12abc"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    assert [r["r"] for r in df.select(clean.safe_int("s").alias("r")).collect()] == [
        0, 0, 0, 12, -3, 0, 7, 0, 0, 0, 0, 0, 2147483647, 0, 0]


def test_hour_windows(spark):
    hours = [dt.datetime(2024, 1, 1, h, m) for h, m in [(5, 59), (6, 0), (8, 59), (9, 0), (9, 59), (10, 0)]]
    df = spark.createDataFrame([(h,) for h in hours], "ts timestamp_ntz")
    loader = [r["r"] for r in df.select(tfn.hour_in_window("ts", 6, 9, inclusive_hi=False).alias("r")).collect()]
    view = [r["r"] for r in df.select(tfn.hour_in_window("ts", 6, 9, inclusive_hi=True).alias("r")).collect()]
    assert loader == [False, True, True, False, False, False]
    assert view == [False, True, True, True, True, False]


def test_volume_bucket(spark):
    df = spark.createDataFrame([(v,) for v in [0, 50, 51, 450, 451, None]], "n long")
    assert [r["b"] for r in df.select(clean.volume_bucket("n").alias("b")).collect()] == [1, 1, 2, 9, 10, 10]


def test_synonyms_and_keys(spark):
    df = spark.createDataFrame([("Zürich",), ("Frankfurt am Main",), ("Paris",), (None,)], "c string")
    assert [r["r"] for r in df.select(clean.synonym_case("c").alias("r")).collect()] == \
        ["Zurich", "Frankfurt", "Paris", None]
    js = spark.createDataFrame([('{"a": 1, "codeshared": null}',), ('{"a": 1}',), ("[1, 2]",), ("3",)], "j string")
    assert [r["r"] for r in js.select(clean.has_key("j", "codeshared").alias("r")).collect()] == \
        [True, False, None, None]


def test_cleaning_tokens(spark):
    assert one(spark, clean.strip_trailing_digits("s"), "Germany12") == "Germany"
    assert one(spark, clean.strip_footnotes("s"), "1,234[3]") == "1,234"
    assert one(spark, clean.thousands_to_long("s"), "65,123,456[2]") == 65123456
    assert one(spark, clean.url_host("s"), "https://a.b.example.com/x/y?z=1") == "a.b.example.com"
    assert one(spark, clean.url_path("s"), "https://a.b.example.com/x/y.html?z=1#t") == "/x/y.html"
    assert one(spark, clean.name_token(clean.strip_extension("s"), 2), "Paris_2024-01-01T05--00--00_x.json") == \
        "2024-01-01T05--00--00"
    assert one(spark, clean.decode_file_name("s"), "Frankfurt%20am%20Main_x.json") == "Frankfurt am Main_x.json"
    assert one(spark, tfn.file_stamp_to_ts("s"), "2024-01-01T05--00--00") == dt.datetime(2024, 1, 1, 5)


def test_epoch_roundtrip(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 14, 23, 47, 57, 999688),)], "ts timestamp_ntz")
    r = df.select(tfn.epoch_seconds("ts").alias("e")).select("e", tfn.epoch_to_utc("e").alias("u")).first()
    assert r["e"] == 1705276077 and r["u"] == dt.datetime(2024, 1, 14, 23, 47, 57)


def test_local_to_utc_zone_and_fixed_table(spark):
    days = ["2024-03-30", "2024-03-31", "2024-10-27", "2024-10-28"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(
        (F.to_date("d").cast("timestamp_ntz") + F.make_interval(hours=F.lit(6))).alias("local"))
    zurich = [r["r"] for r in df.select(tfn.local_to_utc("local", F.lit("Europe/Zurich")).alias("r")).collect()]
    assert [z.hour for z in zurich] == [5, 4, 5, 5]  # zone rules: summer time from 03-31 02:00 to 10-27 03:00
    fixed = [r["r"] for r in df.select(tfn.local_to_utc_fixed("local", F.lit(1), F.lit(1)).alias("r")).collect()]
    assert [f.hour for f in fixed] == [5, 4, 5, 5]  # table rule: the bound is 10-27 00:00, so 05:00 that day is winter
    tokyo = df.select(tfn.local_to_utc("local", F.lit("Asia/Tokyo")).alias("r")).first()["r"]
    assert tokyo == dt.datetime(2024, 3, 29, 21)


def test_time_expressions_ignore_the_session_zone(spark):
    """Wall-clock values must not move when the session zone is not UTC (a DST gap in the session zone included)."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2024-03-10T02:30:00.250",)], "s string").select(
            tfn.parse_flight_ts("s").alias("t"))
        r = df.select("t", tfn.hour_trunc("t").alias("h"), tfn.epoch_seconds("t").alias("e"),
                      tfn.epoch_to_utc(tfn.epoch_seconds("t")).alias("back"),
                      tfn.local_to_utc("t", F.lit("Europe/Zurich")).alias("u"),
                      tfn.file_stamp_to_ts(F.lit("2024-03-10T02--30--00")).alias("f")).first()
        assert r["t"] == dt.datetime(2024, 3, 10, 2, 30, 0, 250000)
        assert r["h"] == dt.datetime(2024, 3, 10, 2, 0)
        assert r["e"] == int(dt.datetime(2024, 3, 10, 2, 30, tzinfo=dt.timezone.utc).timestamp())
        assert r["back"] == dt.datetime(2024, 3, 10, 2, 30)
        assert r["u"] == dt.datetime(2024, 3, 10, 1, 30, 0, 250000)
        assert r["f"] == dt.datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_parse_iso_rejects_impossible_dates(spark):
    df = spark.createDataFrame([("2024-13-01T06:00:00.1",), ("2024-02-30T06:00:00.1",), ("2024-02-29T06:00:00.1",)],
                               "s string")
    assert [r["t"] for r in df.select(tfn.parse_flight_ts("s").alias("t")).collect()] == \
        [None, None, dt.datetime(2024, 2, 29, 6, 0, 0, 100000)]
