"""airshed — city-level mobility and air-quality analytics on Spark DataFrames.

Layout:
  sources/    lake readers (JSON/CSV), driver table loader, file selection
  functions/  scalar Column expressions (time parsing, cleaning, bucketing)
  operators/  relational operators (aggregates, exact percentiles, joins, latest-per-key, keyed sinks, statistics)
  plans/      view compositions (flights, city airports, road, pollution, weather, master) and request planning
  streaming/  incremental ingest with Structured Streaming
"""

from airshed.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
