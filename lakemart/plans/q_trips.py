"""Trip queries: lake (C), filters (D), features (E), marts (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions import features as fx
from lakemart.operators import clean as cl
from lakemart.operators import lake, layers
from lakemart.operators.enrich import bounded
from lakemart.operators.marts import G1_KEYS, build_mart, marts, simple_counts
from lakemart.operators.skew import skew_left_join
from lakemart.plans import standins as st
from lakemart.plans import trips as tp
from lakemart.plans.registry import query
from lakemart.session import scratch_path, table
from lakemart.sources import jdbc

L, E = "lineitem", "events"

G1_SQL_MEASURES = """count(*) AS trip_count, sum(total_amount) AS total_revenue,
  avg(total_amount) AS avg_revenue, avg(trip_duration_minutes) AS avg_duration,
  avg(trip_distance) AS avg_distance, avg(avg_speed_kmh) AS avg_speed,
  avg(tip_ratio) AS avg_tip_ratio, avg(CAST(has_tip AS DOUBLE)) AS tip_probability,
  avg(passenger_count) AS avg_passengers, avg(revenue_per_minute) AS avg_efficiency"""
G1_ROUND = ("total_revenue", "avg_revenue", "avg_duration", "avg_distance", "avg_speed",
            "avg_tip_ratio", "tip_probability", "avg_passengers", "avg_efficiency")


def _mart(kind, name):
    """A mart over the trips with no more joins than its columns need."""
    def run(spark, sf):
        spec = marts()[name]
        return build_mart(tp.facts(spark, sf, kind, spec.needs), spec)
    return run


# ---- G1 / C11: the gold cube (flagship) -----------------------------------
query("mart_trip_cube", rnd=G1_ROUND, sql=tp.with_eda(L, f"""
SELECT date_month, year, month, day_of_week, time_of_day, pulocationid, {G1_SQL_MEASURES}
FROM eda GROUP BY ALL"""))(_mart(L, "mart_trip_cube"))

query("mart_trip_cube_wide", rnd=G1_ROUND, sql=tp.with_eda(L, f"""
SELECT date_month, year, month, day_of_week, time_of_day, pulocationid,
       pickup_borough, pickup_zone, payment_type, payment_name, {G1_SQL_MEASURES}
FROM eda GROUP BY ALL"""))(_mart(L, "mart_trip_cube_wide"))

query("mart_hourly", rnd=("avg_distance", "avg_revenue", "avg_duration", "avg_speed", "avg_tip_ratio",
                          "tip_probability", "total_revenue"), sql=tp.with_eda(E, """
SELECT hour, count(*) AS total_trips, avg(trip_distance) AS avg_distance, avg(total_amount) AS avg_revenue,
  avg(trip_duration_minutes) AS avg_duration, avg(avg_speed_kmh) AS avg_speed, avg(tip_ratio) AS avg_tip_ratio,
  avg(CAST(has_tip AS DOUBLE)) AS tip_probability, sum(total_amount) AS total_revenue
FROM eda GROUP BY hour ORDER BY hour"""))(_mart(E, "mart_hourly"))

query("mart_dow", rnd=("avg_revenue", "avg_duration", "avg_passengers"), sql=tp.with_eda(L, """
SELECT day_of_week, is_weekend, count(*) AS total_trips, avg(total_amount) AS avg_revenue,
  avg(trip_duration_minutes) AS avg_duration, avg(passenger_count) AS avg_passengers
FROM eda GROUP BY ALL ORDER BY day_of_week"""))(_mart(L, "mart_dow"))

query("mart_time_of_day", rnd=("avg_revenue", "avg_duration", "avg_speed", "avg_tip_ratio"), sql=tp.with_eda(E, """
SELECT time_of_day, count(*) AS trip_count, avg(total_amount) AS avg_revenue,
  avg(trip_duration_minutes) AS avg_duration, avg(avg_speed_kmh) AS avg_speed, avg(tip_ratio) AS avg_tip_ratio
FROM eda GROUP BY ALL"""))(_mart(E, "mart_time_of_day"))

query("bucket_speed", rnd=("avg_revenue", "avg_duration", "avg_revenue_per_min"), sql=tp.with_eda(E, """
SELECT CASE WHEN avg_speed_kmh < 10 THEN '0-10 kmh' WHEN avg_speed_kmh < 20 THEN '10-20 kmh'
            WHEN avg_speed_kmh < 30 THEN '20-30 kmh' ELSE '30+ kmh' END AS speed_bucket,
  count(*) AS trip_count, avg(total_amount) AS avg_revenue, avg(trip_duration_minutes) AS avg_duration,
  avg(revenue_per_minute) AS avg_revenue_per_min
FROM eda WHERE avg_speed_kmh > 0 GROUP BY ALL"""))(_mart(E, "bucket_speed"))

query("bucket_distance", rnd=("avg_revenue", "avg_duration", "avg_tip_ratio"), sql=tp.with_eda(L, """
SELECT CASE WHEN trip_distance < 1 THEN '0-1 mi' WHEN trip_distance < 3 THEN '1-3 mi'
            WHEN trip_distance < 5 THEN '3-5 mi' WHEN trip_distance < 10 THEN '5-10 mi' ELSE '10+ mi' END
         AS distance_bucket,
  count(*) AS trip_count, avg(total_amount) AS avg_revenue, avg(trip_duration_minutes) AS avg_duration,
  avg(tip_ratio) AS avg_tip_ratio
FROM eda GROUP BY ALL"""))(_mart(L, "bucket_distance"))

query("mart_payment", rnd=("avg_amount", "avg_tip_ratio", "tip_probability"), sql=tp.with_eda(L, """
SELECT payment_type, count(*) AS transaction_count, avg(total_amount) AS avg_amount,
  avg(tip_ratio) AS avg_tip_ratio, avg(CAST(has_tip AS DOUBLE)) AS tip_probability
FROM eda GROUP BY ALL"""))(_mart(L, "mart_payment"))

query("mart_top_pickup", rnd=("avg_fare_from_zone", "avg_duration_from_zone", "avg_tip_ratio_from_zone"),
      sql=tp.with_eda(L, """
SELECT pulocationid, count(*) AS pickup_count, avg(total_amount) AS avg_fare_from_zone,
  avg(trip_duration_minutes) AS avg_duration_from_zone, avg(tip_ratio) AS avg_tip_ratio_from_zone
FROM eda GROUP BY ALL ORDER BY pickup_count DESC"""))(_mart(L, "mart_top_pickup"))

query("mart_top_routes", rnd=("avg_route_distance", "avg_route_revenue", "avg_route_duration"),
      sql=tp.with_eda(L, """
SELECT pulocationid, dolocationid, count(*) AS route_popularity, avg(trip_distance) AS avg_route_distance,
  avg(total_amount) AS avg_route_revenue, avg(trip_duration_minutes) AS avg_route_duration
FROM eda GROUP BY ALL ORDER BY route_popularity DESC"""))(_mart(L, "mart_top_routes"))

query("mart_ratecode", rnd=("avg_amount", "avg_distance", "avg_duration"), sql=tp.with_eda(L, """
SELECT ratecodeid, count(*) AS trip_count, avg(total_amount) AS avg_amount, avg(trip_distance) AS avg_distance,
  avg(trip_duration_minutes) AS avg_duration
FROM eda GROUP BY ALL"""))(_mart(L, "mart_ratecode"))

query("mart_tips", rnd=("avg_tip_amount", "avg_tip_ratio", "tip_frequency"), sql=tp.with_eda(E, """
SELECT payment_type, time_of_day, count(*) AS total_transactions,
  CAST(sum(has_tip) AS BIGINT) AS tipped_transactions, avg(tip_amount) AS avg_tip_amount,
  avg(tip_ratio) AS avg_tip_ratio, sum(has_tip) / count(*) AS tip_frequency
FROM eda GROUP BY ALL"""))(_mart(E, "mart_tips"))

query("mart_vendor", rnd=("avg_revenue_per_trip", "avg_duration", "avg_passengers", "avg_tip_ratio",
                          "total_revenue"), sql=tp.with_eda(L, """
SELECT vendorid, count(*) AS total_trips, avg(total_amount) AS avg_revenue_per_trip,
  avg(trip_duration_minutes) AS avg_duration, avg(passenger_count) AS avg_passengers,
  avg(tip_ratio) AS avg_tip_ratio, sum(total_amount) AS total_revenue
FROM eda GROUP BY ALL"""))(_mart(L, "mart_vendor"))

query("mart_heatmap", rnd=("avg_revenue", "avg_duration", "efficiency"), sql=tp.with_eda(E, """
SELECT time_of_day, day_of_week, count(*) AS trip_count, avg(total_amount) AS avg_revenue,
  avg(trip_duration_minutes) AS avg_duration, avg(revenue_per_minute) AS efficiency
FROM eda GROUP BY ALL"""))(_mart(E, "mart_heatmap"))

query("mart_zone_time", rnd=("avg_revenue", "avg_duration"), sql=tp.with_eda(E, """
SELECT pulocationid, time_of_day, count(*) AS pickup_count, avg(total_amount) AS avg_revenue,
  avg(trip_duration_minutes) AS avg_duration
FROM eda GROUP BY ALL"""))(_mart(E, "mart_zone_time"))

query("revenue_per_hour", rnd=("avg_revenue_per_hour",), sql=tp.with_eda(E, """
SELECT day_of_week, hour,
  avg(CASE WHEN floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime)) <> 0
           THEN total_amount / ((floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime))) / 3600.0)
      END) AS avg_revenue_per_hour
FROM eda GROUP BY ALL"""))(_mart(E, "revenue_per_hour"))

query("kpi_summary", rnd=("total_revenue", "avg_revenue", "pct_tipped", "avg_speed"), sql=tp.with_eda(L, """
SELECT count(*) AS total_trips, sum(total_amount) AS total_revenue, avg(total_amount) AS avg_revenue,
  avg(CAST(has_tip AS DOUBLE)) * 100 AS pct_tipped, avg(avg_speed_kmh) AS avg_speed
FROM eda"""))(_mart(L, "kpi_summary"))

query("daily_counts", sql=tp.with_eda(L, """
SELECT strftime(tpep_pickup_datetime, '%Y-%m-%d') AS pickup_date, count(*) AS trips
FROM eda GROUP BY ALL ORDER BY pickup_date"""))(_mart(L, "daily_counts"))

query("avg_fare_by_hour", rnd=("avg_fare",), sql=tp.with_eda(E, """
SELECT hour, avg(fare_amount) AS avg_fare FROM eda GROUP BY hour ORDER BY hour"""))(_mart(E, "avg_fare_by_hour"))

query("global_averages", rnd=("avg_duration", "avg_distance"), sql=tp.with_eda(L, """
SELECT avg(trip_duration_minutes) AS avg_duration, avg(trip_distance) AS avg_distance
FROM eda"""))(_mart(L, "global_averages"))

query("hourly_demand", sql=tp.with_eda(E, """
SELECT hour, day_of_week, count(*) AS trips FROM eda GROUP BY ALL"""))(_mart(E, "hourly_demand"))

query("daily_revenue_by_zone", rnd=("revenue",), sql=tp.with_eda(L, """
SELECT CAST(tpep_pickup_datetime AS DATE) AS pickup_date, pickup_zone, count(*) AS trips,
  sum(total_amount) AS revenue
FROM eda GROUP BY ALL"""))(_mart(L, "daily_revenue_by_zone"))

query("duration_by_hour", rnd=("avg_trip_duration",), sql=tp.with_eda(E, """
SELECT hour, avg(trip_duration_minutes) AS avg_trip_duration, count(*) AS trips
FROM eda GROUP BY hour"""))(_mart(E, "duration_by_hour"))

query("passenger_stats", rnd=("avg_fare", "avg_distance"), sql=tp.with_eda(L, """
SELECT passenger_count, count(*) AS trips, avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance
FROM eda GROUP BY ALL"""))(_mart(L, "passenger_stats"))


@query("simple_counts", sql=tp.with_eda(E, """
SELECT 'hour' AS dimension, CAST(hour AS VARCHAR) AS value, count(*) AS trips FROM eda GROUP BY ALL
UNION ALL
SELECT 'dropoff_zone', CAST(dolocationid AS VARCHAR), count(*) FROM eda GROUP BY ALL
UNION ALL
SELECT 'payment', CAST(payment_type AS VARCHAR), count(*) FROM eda GROUP BY ALL"""))
def q_simple_counts(spark, sf):
    """Hour peak, drop-off zone and payment counts."""
    return simple_counts(tp.eda(spark, sf, E))


# ---- C9 / D1 / E*: the cleaned + enriched layer itself -------------------
EDA_ROUND = ("trip_duration_minutes", "avg_speed_kmh", "tip_ratio", "revenue_per_minute")


@query("trips_eda", rnd=EDA_ROUND, sql=tp.with_eda(L, "SELECT * FROM eda"))
def q_trips_eda(spark, sf):
    """Clean + enrich the lineitem trips into the 39-column layer."""
    return tp.eda(spark, sf, L)


@query("outlier_filter", sql=tp.with_clean(L, """
SELECT count(*) AS n_rows, CAST(sum(passenger_count) AS BIGINT) AS sum_passengers,
  round(sum(total_amount), 4) AS sum_total FROM kept"""))
def q_outlier_filter(spark, sf):
    """Declarative bounds as one conjunctive filter."""
    d = tp.raw_trips(spark, sf, L).withColumn(
        "trip_duration_minutes", fx.duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime"))
    k = cl.filter_bounds(d, st.LINEITEM_BOUNDS)
    return k.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("passenger_count").alias("sum_passengers"),
                 F.round(F.sum("total_amount"), 4).alias("sum_total"))


@query("trip_duration", rnd=("trip_duration_minutes",), sql=f"""
WITH {tp.clean_cte(E)}
SELECT tpep_pickup_datetime, tpep_dropoff_datetime, trip_duration_minutes FROM dur""")
def q_trip_duration(spark, sf):
    """Minutes between two timestamps (whole seconds)."""
    t = tp.raw_trips(spark, sf, E)
    return t.select("tpep_pickup_datetime", "tpep_dropoff_datetime",
                    fx.duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime")
                    .alias("trip_duration_minutes"))


@query("date_parts", sql="""
SELECT event_id, CAST(date_trunc('month', ts) AS DATE) AS date_month, CAST(year(ts) AS INTEGER) AS year,
  CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, CAST(hour(ts) AS INTEGER) AS hour,
  CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
FROM events""")
def q_date_parts(spark, sf):
    """Month start, calendar parts, weekend flag."""
    e = table(spark, sf, "events")
    return fx.add_time_features(e.select("event_id", "ts"), "ts").drop(
        "ts", "time_of_day", "is_rush_hour")


@query("time_of_day", sql="""
SELECT CAST(hour(ts) AS INTEGER) AS hour,
  CASE WHEN hour(ts) >= 5 AND hour(ts) < 12 THEN 'Утро' WHEN hour(ts) >= 12 AND hour(ts) < 17 THEN 'День'
       WHEN hour(ts) >= 17 AND hour(ts) < 21 THEN 'Вечер' ELSE 'Ночь' END AS time_of_day,
  count(*) AS events
FROM events GROUP BY ALL""")
def q_time_of_day(spark, sf):
    """Day part per hour, counted."""
    e = table(spark, sf, "events").select(F.hour("ts").alias("hour"))
    return e.groupBy("hour", fx.time_of_day("hour").alias("time_of_day")).agg(
        F.count(F.lit(1)).alias("events"))


@query("rush_hour", sql="""
SELECT CASE WHEN hour(ts) BETWEEN 7 AND 10 OR hour(ts) BETWEEN 16 AND 19 THEN 1 ELSE 0 END AS is_rush_hour,
  count(*) AS events, round(sum(value), 2) AS total_value
FROM events GROUP BY ALL""")
def q_rush_hour(spark, sf):
    """Rush-hour flag."""
    e = table(spark, sf, "events")
    return e.groupBy(fx.is_rush_hour(F.hour("ts")).alias("is_rush_hour")).agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("total_value"))


@query("speed", rnd=("avg_speed_kmh", "speed_mph"), sql=f"""
WITH {tp.clean_cte(E)}
SELECT tpep_pickup_datetime, trip_distance, trip_duration_minutes,
  CASE WHEN trip_duration_minutes > 0 THEN (trip_distance * 1.60934) / (trip_duration_minutes / 60.0) END
    AS avg_speed_kmh,
  CASE WHEN trip_duration_minutes > 0 THEN trip_distance / (trip_duration_minutes / 60.0) ELSE 0.0 END AS speed_mph
FROM dur""")
def q_speed(spark, sf):
    """km/h (NULL on zero duration) and mph (0 on zero duration)."""
    d = tp.raw_trips(spark, sf, E).withColumn(
        "trip_duration_minutes", fx.duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime"))
    return d.select("tpep_pickup_datetime", "trip_distance", "trip_duration_minutes",
                    fx.speed_kmh("trip_distance", "trip_duration_minutes").alias("avg_speed_kmh"),
                    fx.speed_mph("trip_distance", "trip_duration_minutes").alias("speed_mph"))


@query("tip_features", rnd=("tip_ratio", "revenue_per_minute"), sql=f"""
WITH {tp.clean_cte(E)}
SELECT tpep_pickup_datetime, fare_amount, tip_amount,
  CASE WHEN fare_amount <> 0 THEN tip_amount / fare_amount END AS tip_ratio,
  CASE WHEN tip_amount > 0 THEN 1 ELSE 0 END AS has_tip,
  CASE WHEN trip_duration_minutes > 0 THEN total_amount / trip_duration_minutes END AS revenue_per_minute
FROM dur""")
def q_tip_features(spark, sf):
    """E10-E12 on the raw (unfiltered) trips, zero denominators included."""
    d = tp.raw_trips(spark, sf, E).withColumn(
        "trip_duration_minutes", fx.duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime"))
    return d.select("tpep_pickup_datetime", "fare_amount", "tip_amount",
                    fx.ratio("tip_amount", "fare_amount").alias("tip_ratio"),
                    fx.flag(F.col("tip_amount") > 0).alias("has_tip"),
                    fx.per_minute("total_amount", "trip_duration_minutes").alias("revenue_per_minute"))


@query("isin_flag", sql="""
SELECT pulocationid, dolocationid,
  CASE WHEN pulocationid IN (1, 7, 13) OR dolocationid IN (1, 7, 13) THEN 1 ELSE 0 END AS airport_trip,
  count(*) AS trips
FROM (""" + st.EVENT_TRIPS_SQL + ") GROUP BY ALL")
def q_isin_flag(spark, sf):
    """Airport flag from zone lists (isin)."""
    t = tp.raw_trips(spark, sf, E)
    zones = [1, 7, 13]
    flagc = fx.flag(F.col("pulocationid").isin(zones) | F.col("dolocationid").isin(zones))
    return t.groupBy("pulocationid", "dolocationid", flagc.alias("airport_trip")).agg(
        F.count(F.lit(1)).alias("trips"))


@query("anomaly_filter", sql="""
SELECT * FROM (""" + st.EVENT_TRIPS_SQL + """) WHERE passenger_count > 5 OR fare_amount > 300 OR trip_distance > 24""")
def q_anomaly_filter(spark, sf):
    """Disjunctive anomaly filter."""
    return cl.any_exceeds(tp.raw_trips(spark, sf, E),
                          {"passenger_count": 5, "fare_amount": 300, "trip_distance": 24})


@query("filter_expr", rnd=("avg_revenue",), sql=tp.with_eda(L, """
SELECT month, payment_name, count(*) AS trips, avg(total_amount) AS avg_revenue
FROM eda WHERE month = 9 GROUP BY ALL"""))
def q_filter_expr(spark, sf):
    """SQL-string filter on a mart input (``month = 9``)."""
    e = tp.eda(spark, sf, L).filter("month = 9")
    return e.groupBy("month", "payment_name").agg(F.count(F.lit(1)).alias("trips"),
                                                   F.avg("total_amount").alias("avg_revenue"))


@query("unmatched_dim_rows", sql=tp.with_eda(L, """
SELECT year, month, ratecodeid, ratecode_name, count(*) AS count
FROM eda WHERE ratecode_name IS NULL GROUP BY ALL"""))
def q_unmatched_dim_rows(spark, sf):
    """Rows whose dimension lookup failed, by (year, month, id)."""
    e = tp.eda(spark, sf, L).filter(F.col("ratecode_name").isNull())
    return e.groupBy("year", "month", "ratecodeid", "ratecode_name").agg(F.count(F.lit(1)).alias("count"))


@query("enrich_dims", sql=tp.with_eda(L, """
SELECT vendorid, vendor_name, ratecodeid, ratecode_name, payment_type, payment_name, count(*) AS trips
FROM eda GROUP BY ALL"""))
def q_enrich_dims(spark, sf):
    """F1j: left joins by column name, dims broadcast behind a size check."""
    e = tp.eda(spark, sf, L)
    return e.groupBy("vendorid", "vendor_name", "ratecodeid", "ratecode_name", "payment_type",
                     "payment_name").agg(F.count(F.lit(1)).alias("trips"))


@query("enrich_role_playing", sql=tp.with_eda(L, """
SELECT pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, count(*) AS trips
FROM eda GROUP BY ALL"""))
def q_enrich_role_playing(spark, sf):
    """F2j/F3j: the zone dimension joined twice under role aliases."""
    e = tp.eda(spark, sf, L)
    return e.groupBy("pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone").agg(
        F.count(F.lit(1)).alias("trips"))


@query("project_rename", sql="""
SELECT event_id AS id, ts AS event_time, user_id, value AS amount FROM events""")
def q_project_rename(spark, sf):
    """Projection by list, rename, drop."""
    e = table(spark, sf, "events")
    return (e.select("*").drop("props", "event_type")
            .withColumnsRenamed({"event_id": "id", "ts": "event_time", "value": "amount"}))


# ---- lake (C) ---------------------------------------------------------------

@query("slice_census", sql=tp.with_eda(L, """
SELECT date_month, year, month, count(*) AS count FROM eda GROUP BY ALL ORDER BY year, month"""))
def q_slice_census(spark, sf):
    """C12."""
    return lake.slice_census(tp.eda(spark, sf, L))


@query("clean_report", sql=tp.with_clean(L, """
SELECT (SELECT count(*) FROM dur) AS rows_before, (SELECT count(*) FROM kept) AS rows_after,
  (SELECT count(*) FROM dur) - (SELECT count(*) FROM kept) AS rows_removed,
  round(((SELECT count(*) FROM dur) - (SELECT count(*) FROM kept)) * 100.0 / (SELECT count(*) FROM dur), 4)
    AS pct_removed"""))
def q_clean_report(spark, sf):
    """before/after/removed in one pass."""
    return lake.clean_report(tp.raw_trips(spark, sf, L), st.LINEITEM_BOUNDS)


@query("load_check", sql=tp.with_eda(L, """
SELECT count(*) AS n_rows, count(*) > 0 AS ok FROM (
  SELECT date_month, pulocationid FROM eda GROUP BY ALL)"""))
def q_load_check(spark, sf):
    """C14: the gold table is not empty."""
    gold = tp.eda(spark, sf, L).groupBy("date_month", "pulocationid").agg(F.count(F.lit(1)).alias("n"))
    return lake.load_check(gold)


STANDARDIZE_SQL = f"""
SELECT coalesce(TRY_CAST(vendorid AS INTEGER), 0) AS vendorid, tpep_pickup_datetime, tpep_dropoff_datetime,
  coalesce(TRY_CAST(passenger_count AS INTEGER), 0) AS passenger_count, coalesce(trip_distance, 0.0) AS trip_distance,
  coalesce(TRY_CAST(ratecodeid AS INTEGER), 0) AS ratecodeid, store_and_fwd_flag,
  coalesce(TRY_CAST(pulocationid AS INTEGER), 0) AS pulocationid,
  coalesce(TRY_CAST(dolocationid AS INTEGER), 0) AS dolocationid,
  coalesce(TRY_CAST(payment_text AS INTEGER), 0) AS payment_type,
  coalesce(fare_amount, 0.0) AS fare_amount, coalesce(extra, 0.0) AS extra, coalesce(mta_tax, 0.0) AS mta_tax,
  coalesce(tip_amount, 0.0) AS tip_amount, coalesce(tolls_amount, 0.0) AS tolls_amount,
  coalesce(improvement_surcharge, 0.0) AS improvement_surcharge, coalesce(total_amount, 0.0) AS total_amount,
  coalesce(congestion_surcharge, 0.0) AS congestion_surcharge, coalesce(airport_fee, 0.0) AS airport_fee
FROM (SELECT *, CASE WHEN payment_type = 5 THEN 'n/a' ELSE CAST(payment_type AS VARCHAR) END AS payment_text
      FROM ({st.LINEITEM_TRIPS_SQL}))"""


def _bronze_like(spark, sf):
    """Bronze rows with upper-case names and a dirty text-typed id column."""
    t = tp.raw_trips(spark, sf, L)
    t = t.withColumn("payment_type", F.when(F.col("payment_type") == 5, F.lit("n/a"))
                     .otherwise(F.col("payment_type").cast("string")))
    return t.withColumnsRenamed({"vendorid": "VendorID", "pulocationid": "PULocationID",
                                 "dolocationid": "DOLocationID", "ratecodeid": "RatecodeID"})


@query("standardize", sql=STANDARDIZE_SQL)
def q_standardize(spark, sf):
    """Lower-case names, typed coalesce, existing columns in order."""
    return lake.standardize(_bronze_like(spark, sf))


@query("typed_coalesce", sql=f"""
SELECT coalesce(TRY_CAST(payment_text AS INTEGER), 0) AS payment_type, count(*) AS trips
FROM (SELECT CASE WHEN payment_type = 5 THEN 'n/a' ELSE CAST(payment_type AS VARCHAR) END AS payment_text
      FROM ({st.LINEITEM_TRIPS_SQL})) GROUP BY ALL""")
def q_typed_coalesce(spark, sf):
    """Unparsable text -> 0 without ANSI errors."""
    b = _bronze_like(spark, sf)
    return b.groupBy(fx.typed_coalesce("payment_type", "int", 0).alias("payment_type")).agg(
        F.count(F.lit(1)).alias("trips"))


def _write_order_slices(spark, sf):
    root = scratch_path(spark, "bronze-orders")
    o = table(spark, sf, "orders").withColumn("slice", F.date_format("o_orderdate", "yyyy-MM"))
    lake.write_slices(o, root)
    return root


@query("slice_from_path", sql="""
SELECT strftime(o_orderdate, '%Y-%m') AS slice, count(*) AS orders FROM orders GROUP BY ALL""")
def q_slice_from_path(spark, sf):
    """Write monthly slices, read back, recover the slice from the file path."""
    root = _write_order_slices(spark, sf)
    df = spark.read.parquet(root).select(lake.slice_key(F.col("_metadata.file_path")).alias("slice"))
    return df.groupBy("slice").agg(F.count(F.lit(1)).alias("orders"))


@query("pending_slices", sql="""
SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS slice FROM orders
WHERE strftime(o_orderdate, '%Y-%m') >= '1998-01'""")
def q_pending_slices(spark, sf):
    """Candidates from the file listing minus slices done in the manifest."""
    root = _write_order_slices(spark, sf)
    manifest = scratch_path(spark, "manifest")
    cands = lake.list_candidates(spark, root)
    done = cands.filter(F.col("slice") < "1998-01")
    lake.append_manifest(spark, manifest, done.select("slice", F.lit(0).alias("rows")).distinct(), done)
    return lake.pending_slices(cands, lake.read_manifest(spark, manifest))


@query("missing_files", sql="""
SELECT strftime(l_shipdate, '%Y-%m') AS slice FROM lineitem
EXCEPT SELECT strftime(o_orderdate, '%Y-%m') FROM orders""")
def q_missing_files(spark, sf):
    """Remote slices minus local slices (set difference)."""
    remote = table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("slice"))
    local = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("slice"))
    return lake.missing(remote, local)


@query("incremental_norm", sql=f"""
SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS slice, count(*) AS rows, 'done' AS status
FROM ({st.LINEITEM_TRIPS_SQL}) GROUP BY ALL""")
def q_incremental_norm(spark, sf):
    """Two incremental runs; the second only processes the new slices.

    Returns the union of both runs' status rows (each slice exactly once).
    """
    bronze = scratch_path(spark, "bronze-trips")
    silver = scratch_path(spark, "silver-norm")
    manifest = scratch_path(spark, "manifest")
    trips = _bronze_like(spark, sf).withColumn("slice", F.date_format("tpep_pickup_datetime", "yyyy-MM"))
    lake.write_slices(trips.filter(F.col("slice") < "1998-01"), bronze)
    first = lake.incremental_normalize(spark, bronze, silver, manifest)
    first = spark.createDataFrame(first.collect(), first.schema)  # O(slices) status rows
    lake.write_slices(trips.filter(F.col("slice") >= "1998-01"), bronze)
    second = lake.incremental_normalize(spark, bronze, silver, manifest)
    return first.unionByName(second)


@query("mart_extract", rnd=("total_revenue",), sql=tp.with_eda(L, """
SELECT date_month, pulocationid, time_of_day, count(*) AS trip_count, sum(total_amount) AS total_revenue
FROM eda WHERE month = 9 GROUP BY date_month, day_of_week, time_of_day, pulocationid, year, month
HAVING count(*) > 1"""))
def q_mart_extract(spark, sf):
    """The September rows of the cube extracted to a table of their own, and read back."""
    path = scratch_path(spark, "extract")
    cube = build_mart(tp.facts(spark, sf, L, ("pulocationid",)), marts()["mart_trip_cube"])
    jdbc.extract(cube, "month = 9 AND trip_count > 1",
                 ["date_month", "pulocationid", "time_of_day", "trip_count", "total_revenue"], lambda d: d.write.parquet(path))
    return spark.read.parquet(path)


@query("skewed_supplier_join", sql="""
SELECT n_name AS nation, count(*) AS trips, CAST(sum(floor(l_extendedprice)) AS DOUBLE) AS fare
FROM (SELECT l.*, CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 31 = 0 THEN NULL ELSE l_suppkey END AS key FROM lineitem l)
LEFT JOIN supplier ON key = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""")
def q_skewed_supplier_join(spark, sf):
    """F1j under skew: a third of the line items belong to one supplier and some to none.
    Size-based broadcasts are off for the join, as if suppliers were too many: heavy
    suppliers are found by a sketch and joined apart, the others by sort-merge."""
    key = (F.when(F.col("l_orderkey") % 3 == 0, 1).when(F.col("l_orderkey") % 31 == 0, F.lit(None))
           .otherwise(F.col("l_suppkey"))).cast("bigint")
    li = table(spark, sf, "lineitem").select(key.alias("suppkey"), "l_extendedprice")
    sup = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    joined = skew_left_join(li, sup.hint("merge"), "suppkey", "s_suppkey", always=True)
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    return (joined.join(nation, joined.s_nationkey == nation.n_nationkey, "left").groupBy("nation").agg(
        F.count(F.lit(1)).alias("trips"), F.sum(F.floor("l_extendedprice").cast("double")).alias("fare")))


BAD_SLICE = "1995-03"


def _layers(spark, sf):
    """Paths of a fresh set of layers, and the trips with the month they belong to."""
    names = ("bronze", "norm", "norm-manifest", "eda", "eda-ledger", "gold", "gold-ledger")
    at = {n: scratch_path(spark, f"layers-{n}") for n in names}
    return at, tp.raw_trips(spark, sf, L).withColumn("slice", F.date_format("tpep_pickup_datetime", "yyyy-MM"))


def _norm_schema(trips):
    return lake.standardize(trips, expected=lake.TRIP_COLUMNS + ["slice"], add_missing=True).schema


def _advance_eda(spark, sf, at, schema):
    norm = lake.manifest_versions(lake.read_manifest(spark, at["norm-manifest"]))
    return layers.incremental_eda(spark, at["norm"], norm, at["eda"], at["eda-ledger"], schema, bounds=tp.bounds_for(L),
                                  dims=tp.dims(spark, sf, L))


@query("eda_incremental", sql=tp.with_clean(L, f"""
SELECT slice, CASE WHEN slice = '{BAD_SLICE}' THEN NULL ELSE coalesce(n, 0) END AS rows,
  CASE WHEN slice = '{BAD_SLICE}' THEN 'error' ELSE 'done' END AS status, 1::BIGINT AS run
FROM (SELECT DISTINCT strftime({tp.P}, '%Y-%m') AS slice FROM trips)
LEFT JOIN (SELECT strftime({tp.P}, '%Y-%m') AS slice, count(*) AS n FROM clean GROUP BY ALL) USING (slice)
UNION ALL
SELECT '{BAD_SLICE}', count(*), 'done', 2 FROM clean WHERE strftime({tp.P}, '%Y-%m') = '{BAD_SLICE}'"""))
def q_eda_incremental(spark, sf):
    """silver_norm to silver_eda with one slice that can't be read: it gets an
    error row and the others go on; redone in silver_norm, it alone is pending again."""
    at, trips = _layers(spark, sf)
    lake.write_slices(trips, at["bronze"])
    lake.incremental_normalize(spark, at["bronze"], at["norm"], at["norm-manifest"])
    bad = F.col("slice") == BAD_SLICE
    whole = spark.read.parquet(at["norm"]).withColumn("slice", F.col("slice").cast("string"))
    broken = whole.filter(bad).withColumn("fare_amount", F.concat(F.lit("$"), F.col("fare_amount").cast("string")))
    lake.write_slices(broken, at["norm"])
    schema = _norm_schema(trips)
    first = _advance_eda(spark, sf, at, schema).withColumn("run", F.lit(1).cast("long"))
    # the month is delivered again: silver_norm redoes it, and silver_eda sees its new version
    lake.write_slices(trips.filter(bad), at["bronze"])
    lake.incremental_normalize(spark, at["bronze"], at["norm"], at["norm-manifest"])
    second = _advance_eda(spark, sf, at, schema).withColumn("run", F.lit(2).cast("long"))
    return first.unionByName(second).select("slice", "rows", "status", "run")


@query("gold_incremental", rnd=G1_ROUND, sql=tp.with_eda(L, f"""
SELECT date_month, year, month, day_of_week, time_of_day, CAST(pulocationid AS INTEGER) AS pulocationid, {G1_SQL_MEASURES}
FROM eda WHERE date_month <> DATE '1997-11-01' GROUP BY ALL"""))
def q_gold_incremental(spark, sf):
    """C11: gold kept from persisted silver.  After the first run a late file joins
    one month and another month's files are removed; only the states of those two
    are touched, and gold equals a full recompute."""
    at, trips = _layers(spark, sf)
    schema = _norm_schema(trips)

    def run():
        lake.incremental_normalize(spark, at["bronze"], at["norm"], at["norm-manifest"])
        _advance_eda(spark, sf, at, schema)
        return layers.incremental_gold(spark, at["eda"], at["eda-ledger"], at["gold"], at["gold-ledger"], G1_KEYS,
                                       layers.CUBE_MEASURES)

    late = (F.col("slice") == "1996-07") & (F.col("passenger_count") % 2 == 0)
    lake.write_slices(trips.filter(~late), at["bronze"])
    run()
    trips.filter(late).drop("slice").write.mode("append").parquet(f"{at['bronze']}/slice=1996-07")
    layers.delete_slices(spark, at["bronze"], ["1997-11"])
    run()
    return layers.read_gold(spark, at["gold"], G1_KEYS, layers.CUBE_MEASURES)


@query("zone_lookup_csv", sql=tp.with_eda(L, f"""
SELECT z.borough AS pickup_borough_csv, count(*) AS trips
FROM eda LEFT JOIN ({st.ZONES_SQL}) z ON eda.pulocationid = z.locationid GROUP BY ALL"""))
def zone_lookup_csv(spark, sf):
    """F15j/A3: the zone lookup kept as a small CSV with an explicit schema,
    read back and left-joined (broadcast: a bounded geography) to the trips."""
    path = scratch_path(spark, "zones-csv")
    from lakemart.sources import files as fs
    fs.write_csv(st.zones(spark, sf), path)
    zones = fs.read_csv(spark, path, header=True, schema="locationid bigint, borough string, zone string")
    e = tp.eda(spark, sf, L)
    j = e.join(bounded(zones.select("locationid", F.col("borough").alias("pickup_borough_csv"))),
               e.pulocationid == F.col("locationid"), "left")
    return j.groupBy("pickup_borough_csv").agg(F.count(F.lit(1)).alias("trips"))
