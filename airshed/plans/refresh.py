"""Materialised-view refresh: write every view in dependency order, stop and report at the first failure."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.operators import storage
from airshed.operators.sinks import holds_value, staged_rewrite

# Fixed value: refresh order of the views (sources before the master view that reads them).
VIEW_ORDER = ["flights_v", "city_airports_v", "air_pollution_v", "road_traffic_v", "weather_v", "master_view_v"]
# The lookup columns each view is clustered on inside its files (the index columns of the warehouse),
# so readers filtering on them skip row groups.
VIEW_CLUSTERING = {
    "flights_v": ["airport_code", "date"],
    "city_airports_v": ["city_name", "iata_code"],
    "air_pollution_v": ["place", "date"],
    "road_traffic_v": ["city", "traffic_date"],
    "weather_v": ["place", "date"],
    "master_view_v": ["city", "date"],
}


@dataclass
class RefreshReport:
    refreshed: list[str] = field(default_factory=list)
    failed: str | None = None
    error: str | None = None

    @property
    def ok(self) -> bool:
        return self.failed is None


@dataclass(frozen=True)
class Scope:
    """The days of a refresh: all from ``since`` ('YYYY-MM-DD') on, or a set in which None stands for rows without a
    day, which ``since`` never covers."""
    since: str | None = None
    days: frozenset[date | None] | None = None

    def rows(self, day: str) -> Column:
        """Whether a row with this day column is covered; reaches a scan as its partition filter."""
        if self.days is None:
            return F.col(day) >= F.lit(self.since).cast("date")
        return holds_value(day, sorted(self.days, key=lambda d: (d is not None, d)))

    def folder(self, name: str) -> bool:
        """Whether a partition folder such as ``day=2024-01-01`` is covered."""
        value = unquote(name.partition("=")[2])
        day = value if value[:1].isdigit() else None
        if self.days is None:
            return day is not None and day >= self.since
        return (date.fromisoformat(day) if day else None) in self.days


def _writer(df: DataFrame, parts: Sequence[str], sort: Sequence[str]) -> Callable[[str], None]:
    return lambda staging: storage.write_partitioned(df, staging, parts, sort, ranges=True)


def refresh_views(builders: dict[str, Callable[[], DataFrame]], root: str, order: Sequence[str] = tuple(VIEW_ORDER),
                  partition_by: dict[str, Sequence[str]] | None = None,
                  clustering: dict[str, Sequence[str]] | None = None, since: str | None = None,
                  scopes: dict[str, Scope] | None = None) -> RefreshReport:
    """Rebuild ``root/<view>`` for each view in ``order``; a failing view stops the run and is reported.

    A view is written beside its old version and then takes its place, so a failure leaves the old one readable. Rows
    are dealt to files by ranges of day and lookup columns and sorted within each, so a lookup reads few files of a large
    day. With a scope of its own, or ``since``
    ('YYYY-MM-DD') for all, a partitioned view replaces the partitions of these days: those it yields, and those that no
    longer yield rows go.
    """
    report = RefreshReport()
    clustering = VIEW_CLUSTERING if clustering is None else clustering
    for name in order:
        if name not in builders:
            continue
        parts, sort, path = (partition_by or {}).get(name, ()), clustering.get(name, ()), f"{root}/{name}"
        try:
            df = staged_rewrite(builders[name](), name)
            write = _writer(df, parts, sort)
            scope = (scopes or {}).get(name, Scope(since) if since else None)
            if scope and parts:
                storage.replace_partitions(df.sparkSession, path, write, gone=scope.folder)
            else:
                storage.replace_table(df.sparkSession, path, write)
        except Exception as exc:  # report, do not pretend success
            report.failed, report.error = name, f"{type(exc).__name__}: {exc}"
            break
        report.refreshed.append(name)
    return report
