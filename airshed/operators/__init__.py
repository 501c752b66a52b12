"""Relational operators over DataFrames."""

from airshed.operators.aggregates import (daily_max, daily_mean, distinct_pairs, high_water_epoch, high_water_mark,
                                          hourly_counts, load_stats, split_explode, string_agg, weighted_means,
                                          window_counts)
from airshed.operators.joins import full_outer_counts, lookup_join, zip_lists
from airshed.operators.latest import latest_per_key, latest_value
from airshed.operators.percentile import exact_median, exact_percentile
from airshed.operators.sinks import (append_rows, apply_insert_if_absent, dedupe_by_key, insert_if_absent,
                                     partition_values, read_without, rejected_rows, staged_rewrite, strict_append,
                                     strict_append_conflicts, union_history, upsert_latest, write_table)
from airshed.operators.stats import corr_by_group, limit_exceedance, overview_kpis, regr_by_group

__all__ = [
    "daily_max", "daily_mean", "distinct_pairs", "high_water_epoch", "high_water_mark", "hourly_counts", "load_stats",
    "split_explode", "string_agg", "weighted_means", "window_counts",
    "full_outer_counts", "lookup_join", "zip_lists", "latest_per_key", "latest_value", "exact_median",
    "exact_percentile", "append_rows", "apply_insert_if_absent", "dedupe_by_key", "insert_if_absent",
    "partition_values", "read_without", "rejected_rows", "staged_rewrite", "strict_append", "strict_append_conflicts", "union_history", "upsert_latest", "write_table",
    "corr_by_group", "limit_exceedance", "overview_kpis", "regr_by_group",
]
