"""Mart aggregations as declarative specs.

A mart is ``(keys, measures, filter, order)``; ``build_mart`` turns it into
one ``groupBy().agg()``.  Every measure is an algebraic aggregate (count,
sum, avg, min, max), so Spark computes partial aggregates map-side and
shuffles one row per key per task — a hot key costs one partial row per task,
not a third of the data in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import features as fx


def n() -> Column:
    return F.count(F.lit(1))


def H() -> Column:
    """tip probability = avg(has_tip as double)."""
    return F.avg(F.col("has_tip").cast("double"))


@dataclass
class Mart:
    keys: list
    measures: dict  # alias -> zero-arg callable returning an aggregate Column
    where: Column | None = None
    order: list = field(default_factory=list)
    limit: int | None = None
    #: columns that a join brings to the trips; a mart without any reads the fact alone
    needs: tuple[str, ...] = ()


def build_mart(df: DataFrame, spec: Mart) -> DataFrame:
    if spec.where is not None:
        df = df.filter(spec.where)
    keys = [k if isinstance(k, Column) else F.col(k) for k in spec.keys]
    out = df.groupBy(*keys).agg(*[fn().alias(alias) for alias, fn in spec.measures.items()])
    if spec.order:
        out = out.orderBy(*spec.order)
    if spec.limit is not None:
        out = out.limit(spec.limit)
    return out


def _avg(c):
    return lambda: F.avg(c)


def _sum(c):
    return lambda: F.sum(c)


G1_KEYS = ["date_month", "year", "month", "day_of_week", "time_of_day", "pulocationid"]
G1_MEASURES = {
    "trip_count": n, "total_revenue": _sum("total_amount"), "avg_revenue": _avg("total_amount"),
    "avg_duration": _avg("trip_duration_minutes"), "avg_distance": _avg("trip_distance"),
    "avg_speed": _avg("avg_speed_kmh"), "avg_tip_ratio": _avg("tip_ratio"), "tip_probability": H,
    "avg_passengers": _avg("passenger_count"), "avg_efficiency": _avg("revenue_per_minute"),
}


def speed_bucket():
    return fx.bucket("avg_speed_kmh", fx.SPEED_BUCKETS).alias("speed_bucket")


def distance_bucket():
    return fx.bucket("trip_distance", fx.DISTANCE_BUCKETS).alias("distance_bucket")


def marts() -> dict[str, Mart]:
    """The trip marts of Appendix A, keyed by their query name."""
    return {
        "mart_trip_cube": Mart(G1_KEYS, G1_MEASURES, needs=("pulocationid",)),
        "mart_trip_cube_wide": Mart(G1_KEYS + ["pickup_borough", "pickup_zone", "payment_type", "payment_name"],
                                    G1_MEASURES, needs=("pulocationid", "pickup_borough", "pickup_zone", "payment_name")),
        "mart_hourly": Mart(["hour"], {
            "total_trips": n, "avg_distance": _avg("trip_distance"), "avg_revenue": _avg("total_amount"),
            "avg_duration": _avg("trip_duration_minutes"), "avg_speed": _avg("avg_speed_kmh"),
            "avg_tip_ratio": _avg("tip_ratio"), "tip_probability": H, "total_revenue": _sum("total_amount")},
            order=["hour"]),
        "mart_dow": Mart(["day_of_week", "is_weekend"], {
            "total_trips": n, "avg_revenue": _avg("total_amount"),
            "avg_duration": _avg("trip_duration_minutes"), "avg_passengers": _avg("passenger_count")},
            order=["day_of_week"]),
        "mart_time_of_day": Mart(["time_of_day"], {
            "trip_count": n, "avg_revenue": _avg("total_amount"), "avg_duration": _avg("trip_duration_minutes"),
            "avg_speed": _avg("avg_speed_kmh"), "avg_tip_ratio": _avg("tip_ratio")}),
        "bucket_speed": Mart([speed_bucket()], {
            "trip_count": n, "avg_revenue": _avg("total_amount"), "avg_duration": _avg("trip_duration_minutes"),
            "avg_revenue_per_min": _avg("revenue_per_minute")}, where=F.col("avg_speed_kmh") > 0),
        "bucket_distance": Mart([distance_bucket()], {
            "trip_count": n, "avg_revenue": _avg("total_amount"), "avg_duration": _avg("trip_duration_minutes"),
            "avg_tip_ratio": _avg("tip_ratio")}),
        "mart_payment": Mart(["payment_type"], {
            "transaction_count": n, "avg_amount": _avg("total_amount"), "avg_tip_ratio": _avg("tip_ratio"),
            "tip_probability": H}),
        "mart_top_pickup": Mart(["pulocationid"], {
            "pickup_count": n, "avg_fare_from_zone": _avg("total_amount"),
            "avg_duration_from_zone": _avg("trip_duration_minutes"),
            "avg_tip_ratio_from_zone": _avg("tip_ratio")}, order=[F.desc("pickup_count"), "pulocationid"], needs=("pulocationid",)),
        "mart_top_routes": Mart(["pulocationid", "dolocationid"], {
            "route_popularity": n, "avg_route_distance": _avg("trip_distance"),
            "avg_route_revenue": _avg("total_amount"), "avg_route_duration": _avg("trip_duration_minutes")},
            order=[F.desc("route_popularity"), "pulocationid", "dolocationid"], needs=("pulocationid", "dolocationid")),
        "mart_ratecode": Mart(["ratecodeid"], {
            "trip_count": n, "avg_amount": _avg("total_amount"), "avg_distance": _avg("trip_distance"),
            "avg_duration": _avg("trip_duration_minutes")}),
        "mart_tips": Mart(["payment_type", "time_of_day"], {
            "total_transactions": n, "tipped_transactions": _sum("has_tip"),
            "avg_tip_amount": _avg("tip_amount"), "avg_tip_ratio": _avg("tip_ratio"),
            "tip_frequency": lambda: F.sum("has_tip") / F.count(F.lit(1))}),
        "mart_vendor": Mart(["vendorid"], {
            "total_trips": n, "avg_revenue_per_trip": _avg("total_amount"),
            "avg_duration": _avg("trip_duration_minutes"), "avg_passengers": _avg("passenger_count"),
            "avg_tip_ratio": _avg("tip_ratio"), "total_revenue": _sum("total_amount")}),
        "mart_heatmap": Mart(["time_of_day", "day_of_week"], {
            "trip_count": n, "avg_revenue": _avg("total_amount"), "avg_duration": _avg("trip_duration_minutes"),
            "efficiency": _avg("revenue_per_minute")}),
        "mart_zone_time": Mart(["pulocationid", "time_of_day"], {
            "pickup_count": n, "avg_revenue": _avg("total_amount"), "avg_duration": _avg("trip_duration_minutes")},
            needs=("pulocationid",)),
        "revenue_per_hour": Mart(["day_of_week", "hour"], {
            "avg_revenue_per_hour": lambda: F.avg(fx.per_hour("total_amount", "tpep_pickup_datetime",
                                                              "tpep_dropoff_datetime"))}),
        "kpi_summary": Mart([], {
            "total_trips": n, "total_revenue": _sum("total_amount"), "avg_revenue": _avg("total_amount"),
            "pct_tipped": lambda: F.avg(F.col("has_tip").cast("double")) * 100,
            "avg_speed": _avg("avg_speed_kmh")}),
        "daily_counts": Mart([fx.format_minute("tpep_pickup_datetime").substr(1, 10).alias("pickup_date")],
                             {"trips": n}, order=["pickup_date"]),
        "avg_fare_by_hour": Mart(["hour"], {"avg_fare": _avg("fare_amount")}, order=["hour"]),
        "global_averages": Mart([], {"avg_duration": _avg("trip_duration_minutes"),
                                     "avg_distance": _avg("trip_distance")}),
        "hourly_demand": Mart(["hour", "day_of_week"], {"trips": n}, order=["day_of_week", "hour"]),
        "daily_revenue_by_zone": Mart([F.to_date("tpep_pickup_datetime").alias("pickup_date"), "pickup_zone"], {
            "trips": n, "revenue": _sum("total_amount")}, needs=("pickup_zone",)),
        "duration_by_hour": Mart(["hour"], {"avg_trip_duration": _avg("trip_duration_minutes"), "trips": n}),
        "passenger_stats": Mart(["passenger_count"], {
            "trips": n, "avg_fare": _avg("fare_amount"), "avg_distance": _avg("trip_distance")}),
    }


def simple_counts(df: DataFrame) -> DataFrame:
    """Hour peak, drop-off zone and payment counts as one long table
    (dimension, value, trips).  Each row contributes one (dimension, value)
    pair per dimension, so ONE scan and ONE partially aggregated shuffle
    serve all three counts."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("dimension"), F.col(c).cast("string").alias("value"))
        for name, c in (("hour", "hour"), ("dropoff_zone", "dolocationid"), ("payment", "payment_type"))]))
    return (df.select(pairs.alias("p")).select("p.*")
            .groupBy("dimension", "value").agg(n().alias("trips")))


def ratio_of_averages(df: DataFrame, keys: list[str], num: str,
                      den: str = "trip_duration_minutes") -> DataFrame:
    """Ratio of averages per key (revenue per minute of a group), descending."""
    return (df.groupBy(*keys)
            .agg((F.avg(num) / F.avg(den)).alias("revenue_per_minute_ratio"),
                 n().alias("trips"))
            .orderBy(F.desc("revenue_per_minute_ratio")))
