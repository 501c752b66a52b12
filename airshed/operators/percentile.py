"""Exact, interpolated percentiles (``PERCENTILE_CONT``) per group by successive selection of bit ranges.

A value's key is a 64-bit number in the order of the values (sign, exponent and mantissa of the double, computed with
exact arithmetic). The first round counts the values of every group and measure by the leading ``DIGIT_BITS`` bits of
the key; the counts in order tell which one or two ranges hold the ranks ⌊p⌋ and ⌈p⌉, p = q·(n−1). Each further round
looks only at the values of these ranges and counts them by the next bits, until no range holds more than
``RANGE_VALUES`` values or all bits but the last ``DIGIT_BITS`` are used up. What is left is ordered and interpolated.

So no task sees more than ``RANGE_VALUES`` different values of a group: a round has at most that many counts a range, a
last range that many values or bit patterns, whatever the values' distribution. Counts are combined before they are
exchanged, so a value that a third of all rows hold is one row a task. The rows are written once (the columns that
count), as each round reads them; the driver sees one number a round, the largest count. A group's result comes from
the same arithmetic alone or inside any larger table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.operators.sinks import staged_rewrite

DIGIT_BITS = 16
RANGE_VALUES = 1 << DIGIT_BITS
# The exponents of the smallest normal and the largest double, and the bits of a mantissa.
MIN_EXPONENT, MAX_EXPONENT, MANTISSA_BITS = -1022, 1023, 52


def ordered_keys(df: DataFrame, value: str, key: str) -> DataFrame:
    """``df`` with a 64-bit ``key`` in the order of a double column: NULL for NULL, equal for 0 and -0, NaN greatest.

    The exponent comes from the logarithm, which may be one off next to a power of two and is put right; scaling by a
    power of two is exact, so the mantissa's bits are.
    """
    size = F.abs(F.col(value))
    guess = F.greatest(F.least(F.floor(F.log2(size)), F.lit(MAX_EXPONENT)), F.lit(MIN_EXPONENT)).cast("int")
    near = df.withColumn("_e", guess).withColumn("_f", size / F.pow(F.lit(2.0), F.col("_e")))
    low = (F.col("_f") < 1) & (F.col("_e") > MIN_EXPONENT)
    shift = F.when(low, -1).when(F.col("_f") >= 2, 1).otherwise(0)
    scale = F.when(low, 2.0).when(F.col("_f") >= 2, 0.5).otherwise(1.0)
    unit = 1 << MANTISSA_BITS
    bits = (F.col("_e") + shift - (MIN_EXPONENT - 1)).cast("long") * F.lit(unit) \
        + ((F.col("_f") * scale - 1) * float(unit)).cast("long")
    infinity = F.lit((MAX_EXPONENT - MIN_EXPONENT + 2) * unit)
    v = F.col(value)
    return near.withColumn(key, F.when(v.isNull(), F.lit(None).cast("long")).when(F.isnan(v), infinity + 1)
                           .when(v == float("inf"), infinity).when(v == float("-inf"), -infinity)
                           .when(v == 0, F.lit(0).cast("long")).when(v < 0, -bits).otherwise(bits)).drop("_e", "_f")


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def _low() -> Column:
    return F.floor("_pos")


def _high() -> Column:
    return F.ceil("_pos")


def _holds_a_rank() -> Column:
    """Whether the counted values, ``_before`` others before them, hold one of the two ranks."""
    return reduce(lambda a, b: a | b, [(rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_c"))
                                       for rank in (_low(), _high())])


class _Selection:
    """The rows of a percentile and the ranges of keys that hold its ranks, refined round by round."""

    def __init__(self, df: DataFrame, g: Sequence[str], value_cols: Sequence[str], q: float):
        self.g, self.shift = list(g), 64 - DIGIT_BITS
        narrow = staged_rewrite(df.select(*self.g, *[F.col(c).cast("double").alias(f"_x{i}")
                                                     for i, c in enumerate(value_cols)]), "percentile-rows")
        measures = F.array(*[F.struct(F.lit(i).alias("_m"), F.col(f"_x{i}").alias("_v"))
                             for i in range(len(value_cols))])
        self.rows = ordered_keys(narrow.select(*self.g, F.inline(measures)), "_v", "_k")
        group = Window.partitionBy(*self.g, "_m")
        first = (self.rows.groupBy(*self.g, "_m", F.shiftright("_k", self.shift).alias("_d"))
                 .agg(F.count("_v").alias("_c")).withColumn("_n", F.sum("_c").over(group)))
        first = self._placed(first, [*self.g, "_m"], F.lit(0)).withColumn("_pos", F.lit(float(q)) * (F.col("_n") - 1))
        # a measure without values has one range, which holds no rank and keeps the group in the result
        found = staged_rewrite(first.where(_holds_a_rank() | (F.col("_n") == 0)), "percentile-ranges")
        self.empty = found.where("_n = 0")
        self.ranges = found.where("_n > 0").select(*self.g, "_m", "_d", "_c", "_before", "_pos")

    def _placed(self, counted: DataFrame, within: Sequence[str], before: Column, order: str = "_d") -> DataFrame:
        running = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return counted.withColumn("_before", before + F.sum("_c").over(running) - F.col("_c"))

    def most(self) -> int:
        """The largest count of a range."""
        return self.ranges.agg(F.max("_c")).first()[0] or 0

    def inside(self) -> DataFrame:
        """The rows within the ranges: ``(group…, _m, _v, _k, _range, _ahead, _pos)``."""
        keys = [*self.g, "_m", "_d"]
        renamed = [f"_w{i}" for i in range(len(keys))]
        ranges = self.ranges.select(*[F.col(c).alias(r) for c, r in zip(keys, renamed)],
                                    F.col("_before").alias("_ahead"), "_pos")
        return self.rows.withColumn("_d", F.shiftright("_k", self.shift)).join(ranges, _same(keys, renamed)) \
            .withColumnRenamed("_d", "_range").drop(*renamed)

    def refine(self) -> None:
        """Ranges ``DIGIT_BITS`` bits narrower, from the rows inside the present ones."""
        rows, self.shift = self.inside(), self.shift - DIGIT_BITS
        counted = rows.groupBy(*self.g, "_m", "_range", "_ahead", "_pos",
                               F.shiftright("_k", self.shift).alias("_d")).agg(F.count("_v").alias("_c"))
        placed = self._placed(counted, [*self.g, "_m", "_range"], F.col("_ahead"))
        self.ranges = staged_rewrite(placed.where(_holds_a_rank()).select(*self.g, "_m", "_d", "_c", "_before", "_pos"),
                                     "percentile-ranges")

    def values(self) -> DataFrame:
        """``(group…, _m, _lo, _hi, _pos)``: the values at the two ranks."""
        counted = self.inside().groupBy(*self.g, "_m", "_range", "_ahead", "_pos", "_k") \
            .agg(F.count("_v").alias("_c"), F.max("_v").alias("_v"))
        placed = self._placed(counted, [*self.g, "_m", "_range"], F.col("_ahead"), "_k")
        end = F.col("_before") + F.col("_c")
        picks = [F.max(F.when((rank >= F.col("_before")) & (rank < end), F.col("_v"))) for rank in (_low(), _high())]
        return placed.groupBy(*self.g, "_m").agg(picks[0].alias("_lo"), picks[1].alias("_hi"),
                                                 F.max("_pos").alias("_pos"))


def select_ranges(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str], q: float) -> _Selection:
    """Refine until every range is small enough to be ordered by one task."""
    selection = _Selection(df, group_cols, value_cols, q)
    while selection.shift > DIGIT_BITS and selection.most() > RANGE_VALUES:
        selection.refine()
    return selection


def exact_percentile(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str], q: float = 0.5,
                     names: Sequence[str] | None = None) -> DataFrame:
    """One row per group with the exact ``percentile_cont(q)`` of each value column (NULLs ignored).

    Groups whose values are all NULL yield NULL, like SQL. Grouping keys may be NULL (NULL forms one group).
    """
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must be within [0, 1]")
    g = list(group_cols)
    names = list(names or [f"p{int(q * 100)}_{c}" for c in value_cols])
    selection = select_ranges(df, g, value_cols, q)
    picked = selection.values().select(
        *g, "_m", (F.col("_lo") + (F.col("_pos") - F.floor("_pos")) * (F.col("_hi") - F.col("_lo"))).alias("_p"))
    every = picked.unionByName(selection.empty.select(*g, "_m", F.lit(None).cast("double").alias("_p")))
    return every.groupBy(*g).agg(*[F.max(F.when(F.col("_m") == i, F.col("_p"))).alias(n) for i, n in enumerate(names)])


def exact_median(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str],
                 names: Sequence[str] | None = None) -> DataFrame:
    return exact_percentile(df, group_cols, value_cols, 0.5, names or [f"median_{c}" for c in value_cols])
