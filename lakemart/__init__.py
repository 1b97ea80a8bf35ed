"""lakemart — PySpark-native lakehouse analytics toolkit.

Everything here is plain DataFrame / SQL / Structured Streaming / Spark ML
code: functions take DataFrames (or a session + paths) and return lazy
DataFrames, so Catalyst sees one plan per query and can push filters and
projections into the scans.
"""

from lakemart.session import build_session, scratch_path, table

__all__ = ["build_session", "scratch_path", "table"]
