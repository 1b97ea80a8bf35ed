"""Shared trip builders (Spark) and their SQL twins (DuckDB oracle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemart.operators import lake
from lakemart.operators.enrich import bounded
from lakemart.operators.clean import TAXI_BOUNDS, Bound
from lakemart.plans import standins as st

# ---- fixed values: vendor codes of the original trip data -----------------
VENDOR_CODES = [(1, "Creative Mobile Technologies"), (2, "VeriFone Inc.")]

KINDS = ("lineitem", "events")


def bounds_for(kind: str) -> dict[str, Bound]:
    return st.LINEITEM_BOUNDS if kind == "lineitem" else TAXI_BOUNDS


def raw_trips(spark: SparkSession, sf_dir: str, kind: str, zones: tuple[str, ...] = st.ZONE_COLUMNS) -> DataFrame:
    """The bronze trips; ``zones``: which of the joined zone columns are wanted."""
    return st.lineitem_trips(spark, sf_dir, zones) if kind == "lineitem" else st.event_trips(spark, sf_dir)


def dims(spark: SparkSession, sf_dir: str, kind: str) -> dict[str, DataFrame]:
    # supplier-based vendors grow with the data (Spark's size check decides);
    # the literal vendor code list is bounded by construction: broadcast it,
    # or the fact would be shuffled on a two-value key.
    vend = (st.vendors(spark, sf_dir) if kind == "lineitem"
            else bounded(st.code_list(spark, VENDOR_CODES, "vendorid", "vendor_name")))
    return {
        "vendors": vend,
        "ratecodes": st.code_list(spark, st.RATECODES, "ratecodeid", "ratecode_name"),
        "payments": st.code_list(spark, st.PAYMENTS, "payment_type", "payment_name"),
        "zones": st.zones(spark, sf_dir),
    }


def clean(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return lake.clean_trips(raw_trips(spark, sf_dir, kind), bounds_for(kind))


def facts(spark: SparkSession, sf_dir: str, kind: str, needs: tuple[str, ...]) -> DataFrame:
    """The cleaned trips with only the joins that the columns ``needs`` ask for."""
    role = {"pulocationid": "pickup", "dolocationid": "dropoff"}
    zones = tuple(c for c in st.ZONE_COLUMNS if c in needs or any(n.startswith(f"{role[c]}_") for n in needs))
    trips = lake.clean_trips(raw_trips(spark, sf_dir, kind, zones), bounds_for(kind))
    if any(n in columns for n in needs for columns in lake.DIMENSION_COLUMNS.values()):
        return lake.enrich_trips(trips, **dims(spark, sf_dir, kind), columns=needs)
    return trips


def eda(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return lake.eda(raw_trips(spark, sf_dir, kind), bounds_for(kind), **dims(spark, sf_dir, kind))


# ---------------------------------------------------------------------------
# SQL twins
# ---------------------------------------------------------------------------

def bounds_sql(bounds: dict[str, Bound]) -> str:
    parts = []
    for name, (low, high, li, hi) in bounds.items():
        col = "year(tpep_pickup_datetime)" if name == "pickup_year" else name
        if low is not None:
            parts.append(f"{col} {'>=' if li else '>'} {low}")
        if high is not None:
            parts.append(f"{col} {'<=' if hi else '<'} {high}")
    return " AND ".join(parts)


def _trips_sql(kind: str) -> str:
    return st.LINEITEM_TRIPS_SQL if kind == "lineitem" else st.EVENT_TRIPS_SQL


def _vendors_sql(kind: str) -> str:
    if kind == "lineitem":
        return st.VENDORS_SQL
    return ("SELECT CAST(vendorid AS BIGINT) AS vendorid, vendor_name FROM ("
            + st.values_sql(VENDOR_CODES, "vendorid", "vendor_name") + ")")


P = "tpep_pickup_datetime"


def clean_cte(kind: str) -> str:
    """CTEs ``trips``, ``dur``, ``clean`` (clean = filtered + features)."""
    return f"""
trips AS ({_trips_sql(kind)}),
dur AS (SELECT *, (floor(epoch(tpep_dropoff_datetime)) - floor(epoch({P}))) / 60 AS trip_duration_minutes
        FROM trips),
kept AS (SELECT * FROM dur WHERE {bounds_sql(bounds_for(kind))}),
clean AS (
  SELECT * EXCLUDE (store_and_fwd_flag),
    CAST(date_trunc('month', {P}) AS DATE) AS date_month,
    CAST(year({P}) AS INTEGER) AS year,
    CAST(month({P}) AS INTEGER) AS month,
    CAST(day({P}) AS INTEGER) AS day,
    CAST(dayofweek({P}) + 1 AS INTEGER) AS day_of_week,
    CAST(hour({P}) AS INTEGER) AS hour,
    CASE WHEN dayofweek({P}) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN hour({P}) >= 5 AND hour({P}) < 12 THEN 'Утро'
         WHEN hour({P}) >= 12 AND hour({P}) < 17 THEN 'День'
         WHEN hour({P}) >= 17 AND hour({P}) < 21 THEN 'Вечер'
         ELSE 'Ночь' END AS time_of_day,
    CASE WHEN hour({P}) BETWEEN 7 AND 10 OR hour({P}) BETWEEN 16 AND 19 THEN 1 ELSE 0 END AS is_rush_hour,
    CASE WHEN trip_duration_minutes > 0
         THEN (trip_distance * 1.60934) / (trip_duration_minutes / 60.0) END AS avg_speed_kmh,
    CASE WHEN fare_amount <> 0 THEN tip_amount / fare_amount END AS tip_ratio,
    CASE WHEN tip_amount > 0 THEN 1 ELSE 0 END AS has_tip,
    CASE WHEN trip_duration_minutes > 0 THEN total_amount / trip_duration_minutes END AS revenue_per_minute
  FROM kept)"""


def eda_cte(kind: str) -> str:
    """``clean_cte`` plus ``eda`` = clean left-joined to the four dimensions."""
    cols = ", ".join(lake.EDA_COLUMNS)
    return clean_cte(kind) + f""",
vendors AS ({_vendors_sql(kind)}),
ratecodes AS ({st.values_sql(st.RATECODES, 'ratecodeid', 'ratecode_name')}),
payments AS ({st.values_sql(st.PAYMENTS, 'payment_type', 'payment_name')}),
zones AS ({st.ZONES_SQL}),
eda AS (
  SELECT {cols} FROM (
    SELECT c.*, v.vendor_name, r.ratecode_name, p.payment_name,
           pz.borough AS pickup_borough, pz.zone AS pickup_zone,
           dz.borough AS dropoff_borough, dz.zone AS dropoff_zone
    FROM clean c
    LEFT JOIN vendors v ON c.vendorid = v.vendorid
    LEFT JOIN ratecodes r ON c.ratecodeid = r.ratecodeid
    LEFT JOIN payments p ON c.payment_type = p.payment_type
    LEFT JOIN zones pz ON c.pulocationid = pz.locationid
    LEFT JOIN zones dz ON c.dolocationid = dz.locationid))"""


def with_eda(kind: str, select: str) -> str:
    return f"WITH {eda_cte(kind)}\n{select}"


def with_clean(kind: str, select: str) -> str:
    return f"WITH {clean_cte(kind)}\n{select}"
