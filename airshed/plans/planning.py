"""Request-planning tables: date segments, missing-range (gap) plans, local→UTC windows, request grids.

Plans are derived per entity from the fact tables (min/max per entity, then ``sequence`` + ``posexplode``), so they are
generators over distributed rows: no driver loop, no cross join. Global bounds enter as scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions._util import as_col
from airshed.functions.time import HISTORY_START, epoch_to_utc, local_to_utc, local_to_utc_fixed
from airshed.operators.aggregates import high_water_epoch

WEEK_SECONDS = 7 * 86400


def explode_segments(df: DataFrame, start, end, width_days: int = 7, inclusive_tail: bool = True,
                     keep: Sequence[str] | None = None) -> DataFrame:
    """Cut each row's [start, end] date range into numbered segments (seg_no, seg_start, seg_end) of ``width_days``.

    Every day of the range is in a segment. ``inclusive_tail=False`` reproduces a ``while current < end`` loop for
    parity: a trailing one-day segment starting on ``end`` is not produced and a single-day range yields nothing.
    ``start``/``end`` may be columns or scalar subqueries (``DataFrame.scalar()``).
    """
    s, e = F.to_date(as_col(start)), F.to_date(as_col(end))
    last_start = e if inclusive_tail else F.date_sub(e, 1)
    starts = F.when(s <= last_start, F.sequence(s, last_start, F.expr(f"INTERVAL {width_days} DAYS")))
    cols = list(keep) if keep is not None else df.columns
    return (df.select(*cols, e.alias("_end"), F.posexplode(starts).alias("_pos", "seg_start"))
            .select(*cols, (F.col("_pos") + 1).alias("seg_no"), "seg_start",
                    F.least(F.date_add("seg_start", width_days - 1), F.col("_end")).alias("seg_end")))


def target_day(today, lag_days: int = 4) -> str:
    """The day a scheduled load picks up: flight history is complete after ``lag_days`` (4), road data the same day
    (``lag_days=0``). ``today`` is a ``datetime.date``."""
    return (today - timedelta(days=lag_days)).isoformat()


def daily_segment(df: DataFrame, day, keep: Sequence[str] | None = None) -> DataFrame:
    """The single-day segment (start = end = ``day``) used by scheduled daily runs."""
    return explode_segments(df, day, day, 1, inclusive_tail=True, keep=keep)


def segment_plan(df: DataFrame, entity: Sequence[str], ts, width_days: int = 7,
                 inclusive_tail: bool = True) -> DataFrame:
    """Per entity: the date range it covers in the facts, cut into numbered segments."""
    spans = df.groupBy(*entity).agg(F.min(F.to_date(as_col(ts))).alias("_lo"), F.max(F.to_date(as_col(ts))).alias("_hi"))
    return explode_segments(spans, "_lo", "_hi", width_days, inclusive_tail, keep=entity)


def gap_plan(df: DataFrame, entity: Sequence[str], ts, now_epoch: int, floor: str = HISTORY_START,
             width_seconds: int = WEEK_SECONDS, entities: DataFrame | None = None) -> DataFrame:
    """Per entity: the missing epoch ranges after its high-water mark (floored at the history start), in blocks of
    ``width_seconds`` capped at ``now``: (hwm+1, min(now, hwm+width)), (…+width, …) while the start ≤ now.

    ``entities`` (rows with the entity columns) adds those without a fact row: they get the first-run blocks of
    :func:`initial_plan`, with no high-water mark.
    """
    keys = list(entity)
    hwm = high_water_epoch(df, ts, by=keys, floor=floor, name="hwm_epoch")
    now = F.lit(now_epoch).cast("bigint")
    starts = F.when(F.col("hwm_epoch") < now,
                    F.sequence(F.col("hwm_epoch") + 1, now, F.lit(width_seconds).cast("bigint")))
    plan = hwm.select(*keys, "hwm_epoch", F.posexplode(starts).alias("_pos", "start_epoch")).select(
        *keys, "hwm_epoch", (F.col("_pos") + 1).alias("seg_no"), "start_epoch",
        F.least(now, F.col("start_epoch") + width_seconds - 1).alias("end_epoch"))
    if entities is not None:
        missing = entities.select(*keys).distinct().join(hwm.select(*keys), keys, "left_anti")
        first = missing.select(*keys, F.posexplode(_initial_starts(now_epoch, floor, width_seconds)).alias(
            "_pos", "start_epoch")).select(
            *keys, F.lit(None).cast("bigint").alias("hwm_epoch"), (F.col("_pos") + 1).alias("seg_no"), "start_epoch",
            (F.col("start_epoch") + width_seconds - 1).alias("end_epoch"))
        plan = plan.unionByName(first)
    return plan.withColumn("start_utc", epoch_to_utc("start_epoch")).withColumn("end_utc", epoch_to_utc("end_epoch"))


def _initial_starts(now_epoch: int, floor: str, width_seconds: int) -> Column:
    """Starts of the blocks from the floor on that begin by ``now``."""
    floor_epoch = int(datetime.fromisoformat(floor).replace(tzinfo=timezone.utc).timestamp())
    last = floor_epoch + (now_epoch - floor_epoch) // width_seconds * width_seconds
    return F.sequence(*[F.lit(x).cast("bigint") for x in (floor_epoch, last, width_seconds)])


def initial_plan(spark: SparkSession, now_epoch: int, floor: str = HISTORY_START,
                 width_seconds: int = WEEK_SECONDS) -> DataFrame:
    """First run without history: fixed blocks from the floor; the last block may end after ``now``."""
    return spark.range(1).select(F.posexplode(_initial_starts(now_epoch, floor, width_seconds)).alias(
        "_pos", "start_epoch")).select((F.col("_pos") + 1).alias("seg_no"), "start_epoch",
                                       (F.col("start_epoch") + width_seconds - 1).alias("end_epoch"))


def utc_windows(days: DataFrame, day, zone, local_start_hour: int = 6, hours: int = 3) -> DataFrame:
    """Local ``local_start_hour`` of each day in each entity's IANA zone → [start, end) in UTC."""
    local = F.to_date(as_col(day)).cast("timestamp_ntz") + F.make_interval(hours=F.lit(local_start_hour))
    start = local_to_utc(local, zone)
    return days.withColumn("start_utc", start).withColumn("end_utc", start + F.make_interval(hours=F.lit(hours)))


def utc_windows_fixed(days: DataFrame, day, utc_offset, summer_shift, local_start_hour: int = 6,
                      hours: int = 3) -> DataFrame:
    """Parity variant with integer offsets and the fixed 2024 summer period."""
    local = F.to_date(as_col(day)).cast("timestamp_ntz") + F.make_interval(hours=F.lit(local_start_hour))
    start = local_to_utc_fixed(local, utc_offset, summer_shift)
    return days.withColumn("start_utc", start).withColumn("end_utc", start + F.make_interval(hours=F.lit(hours)))


def request_grid(entities: DataFrame, facts: DataFrame, ts, width_days: int = 7,
                 inclusive_tail: bool = True) -> DataFrame:
    """Every entity × every segment of the facts' global date range (the places × time-ranges request loop).

    The global range enters as two scalar subqueries; each entity row generates its segments locally, so no join is
    needed.
    """
    lo = facts.select(F.min(F.to_date(as_col(ts)))).scalar()
    hi = facts.select(F.max(F.to_date(as_col(ts)))).scalar()
    return explode_segments(entities, lo, hi, width_days, inclusive_tail)


def day_range(start, end) -> Column:
    """Inclusive list of days between two dates."""
    return F.sequence(F.to_date(as_col(start)), F.to_date(as_col(end)), F.expr("INTERVAL 1 DAY"))


def rolling_weeks(now, weeks: int = 52) -> Column:
    """(start, end) weekly ranges going back ``weeks`` weeks from ``now``, oldest first."""
    n = as_col(now)
    return F.transform(F.sequence(F.lit(weeks - 1), F.lit(0), F.lit(-1)), lambda k: F.struct(
        (n - F.make_interval(days=(k + 1) * 7)).alias("week_start"), (n - F.make_interval(days=k * 7)).alias("week_end")))
