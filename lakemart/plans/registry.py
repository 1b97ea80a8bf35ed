"""Registry of named queries and their DuckDB oracle SQL.

``@query(name, sql=..., rnd=(...))`` registers a ``(spark, sf_dir) ->
DataFrame`` callable.  Double columns listed in ``rnd`` are rounded the same
way on both sides (float sums depend on partition order).  Queries without
``sql`` get the driver's weaker rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def round_sql(sql: str, cols, digits: int) -> str:
    if not cols:
        return sql
    parts = []
    for c in cols:
        c, d = c if isinstance(c, tuple) else (c, digits)
        scale = f"{10 ** d}.0"
        parts.append(f"floor({c} * {scale} + 0.5) / {scale} AS {c}")
    repl = ", ".join(parts)
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) AS _q"


def round_half_up(c, digits: int):
    """floor(x * 10^d + 0.5) / 10^d: the same IEEE operations in Spark and
    DuckDB, so equal inputs give bit-equal outputs (``round`` differs between
    engines on representation ties)."""
    scale = float(10 ** digits)
    return F.floor(F.col(c) * scale + 0.5) / scale


def query(name: str, sql: str | None = None, rnd=(), digits: int = 6):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            if rnd:
                df = df.withColumns({
                    (c[0] if isinstance(c, tuple) else c):
                        round_half_up(*(c if isinstance(c, tuple) else (c, digits))) for c in rnd})
            return df
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = round_sql(sql, rnd, digits)
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    for mod in ("q_trips", "q_sql", "q_profile", "q_nested", "q_sources",
                "q_catalog", "q_stream", "q_ml", "q_misc"):
        try:
            importlib.import_module(f"lakemart.plans.{mod}")
        except ModuleNotFoundError as exc:
            if exc.name != f"lakemart.plans.{mod}":
                raise
