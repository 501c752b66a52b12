"""Readers: lake JSON/CSV feeds and the parquet tables of a data directory."""

from airshed.sources.tables import TABLES, Tables, read_table

__all__ = ["TABLES", "Tables", "read_table"]
