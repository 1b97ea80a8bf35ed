"""Stand-ins that turn the given testdata tables into the reference's inputs.

No taxi, flight or review data ships with the testdata, so each reference
input is derived *by Spark from the given tables* (SURVEY §7.3).  Work grows
with the tables: nothing here is a fixed literal dataset except code lists
(dimension names) that the reference itself hard-codes.

Two trip facts:

* ``lineitem_trips`` — one trip per line item: pickup = order date, drop-off
  = ship date, distance = quantity, fare = extended price, pickup/drop-off
  zone = customer/supplier nation.  Largest table, used by the lake marts.
* ``event_trips`` — one trip per event: real clock times, duration = value
  minutes.  Used where hours matter (order dates are all midnight).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.clean import Bound
from lakemart.operators.enrich import bounded
from lakemart.operators.skew import skew_left_join
from lakemart.session import table

# ---- fixed values: code lists of the original taxi dimensions -------------
RATECODES = [(1, "Стандартный тариф"), (2, "JFK Airport"), (3, "Newark Airport"),
             (4, "Nassau or Westchester"), (5, "Negotiated fare"), (6, "Group ride")]
PAYMENTS = [(1, "Кредитная карта"), (2, "Наличные"), (3, "Без оплаты"),
            (4, "Спор"), (5, "Неизвестно"), (6, "Voided trip")]
# ---- fixed values: event and group names of the streaming dimensions ------
EVENT_NAMES = [(1, "Покупка крипты"), (2, "Вложение в акции"), (3, "Оплата товара"),
               (4, "Донатная помойка"), (5, "Пожертвование сектам")]
GROUP_NAMES = [(1, "Новые"), (2, "Иностранные"), (3, "Рептилойды"), (4, "Gold"), (5, "Platinum")]

# Stand-in mapping of event types to payment / event ids.  Event id 9 for
# "error" is missing from the event dimension on purpose -> left-join NULLs;
# in the lineitem trips rate code 99 plays the same role.
EVENT_TYPE_PAYMENT = {"purchase": 1, "click": 2, "view": 3, "error": 4, "signup": 5}
EVENT_TYPE_EVENT_ID = {"purchase": 1, "click": 2, "view": 3, "signup": 4, "error": 9}

# Outlier bounds rescaled to the lineitem stand-in (orders/shipments span
# years, prices are in thousands): every clause still removes some rows.
LINEITEM_BOUNDS: dict[str, Bound] = {
    "passenger_count": (0, 6, True, True),
    "trip_duration_minutes": (1440, 1440 * 1500, False, False),
    "fare_amount": (0, 100000, False, False),
    "extra": (0, None, True, False),
    "mta_tax": (0, None, True, False),
    "improvement_surcharge": (0, None, True, False),
    "tip_amount": (0, 10000, True, False),
    "tolls_amount": (0, 8000, True, False),
    "total_amount": (0, 110000, False, False),
    "trip_distance": (0, 50, False, False),
    "pickup_year": (1995, 2001, True, False),
}


def _code_case(col: str, mapping: dict[str, int]):
    expr = None
    for k, v in mapping.items():
        expr = F.when(F.col(col) == k, v) if expr is None else expr.when(F.col(col) == k, v)
    return expr


#: columns of the lineitem trips that come from a join on a unique key
ZONE_COLUMNS = ("pulocationid", "dolocationid")


def lineitem_trips(spark: SparkSession, sf_dir: str, zones: tuple[str, ...] = ZONE_COLUMNS) -> DataFrame:
    """Bronze-shaped trips from lineitem ⋈ orders (+ customer / supplier nation).

    ``zones``: joined zone columns to bring; a left join on a unique key that
    nobody reads is not made.

    Join order matters at scale: orders ⋈ customer runs first (the smaller
    side), so the wide lineitem fact is shuffled only twice — by order key,
    then by supplier key — instead of once more by customer key.  None of
    these tables is force-broadcast: they grow with the data, and Spark's
    size check (planner estimate, then AQE runtime statistics) decides; beyond
    it, suppliers that hold a large share of the line items are joined apart.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    oc = o.join(c, o.o_custkey == c.c_custkey, "left") if "pulocationid" in zones else o
    j = li.join(oc, li.l_orderkey == oc.o_orderkey, "inner")
    if "dolocationid" in zones:
        j = skew_left_join(j, s, "l_suppkey", "s_suppkey")
    # Whole-dollar amounts: floor of the same IEEE product in every engine,
    # so sums are exact and averages bit-identical across engines.
    fare = F.floor("l_extendedprice").cast("double")
    tip = F.floor(F.col("l_extendedprice") * F.col("l_discount")).cast("double")
    tolls = F.floor(F.col("l_extendedprice") * F.col("l_tax")).cast("double")
    return j.select(
        F.col("l_suppkey").alias("vendorid"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.when(F.col("l_returnflag") == "N", 1).when(F.col("l_returnflag") == "R", 2)
         .otherwise(99).alias("ratecodeid"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("store_and_fwd_flag"),
        *[F.col(c).cast("bigint").alias(name) for name, c in zip(ZONE_COLUMNS, ("c_nationkey", "s_nationkey"), strict=True)
          if name in zones],
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type"),
        fare.alias("fare_amount"),
        F.col("l_tax").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        tip.alias("tip_amount"),
        tolls.alias("tolls_amount"),
        F.col("l_tax").alias("improvement_surcharge"),
        (fare + tip + tolls).alias("total_amount"),
        F.col("l_discount").alias("congestion_surcharge"),
        F.lit(0.0).alias("airport_fee"),
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped trips from events: one row-local projection, no shuffle."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    seconds = F.round(F.col("value") * 60).cast("int")
    tipped = F.col("event_type").isin("purchase", "view")
    # Whole-dollar money (floor of the same IEEE expression in every engine):
    # exact sums, bit-identical averages.
    fare = F.floor("value").cast("double")
    tip = F.when(tipped, F.floor(F.col("value") * 15 / 100).cast("double")).otherwise(0.0)
    return e.select(
        (F.col("user_id") % 2 + 1).alias("vendorid"),
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + F.make_dt_interval(secs=seconds)).alias("tpep_dropoff_datetime"),
        (F.col("user_id") % 7).cast("int").alias("passenger_count"),
        (k / 4.0).alias("trip_distance"),
        # rate code from the data (a literal key would turn the dimension
        # join into a nested-loop join): very long trips use code 2
        F.when(F.col("value") > 300, 2).otherwise(1).alias("ratecodeid"),
        F.lit("N").alias("store_and_fwd_flag"),
        (F.col("user_id") % 25).alias("pulocationid"),
        (k % 25).cast("bigint").alias("dolocationid"),
        _code_case("event_type", EVENT_TYPE_PAYMENT).alias("payment_type"),
        fare.alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        tip.alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        (fare + tip).alias("total_amount"),
        F.lit(0.0).alias("congestion_surcharge"),
        F.lit(0.0).alias("airport_fee"),
    )


def code_list(spark: SparkSession, rows, key: str, name: str) -> DataFrame:
    """A literal code list as a dimension: a local relation, so Spark knows its size."""
    body = ", ".join("({}, '{}')".format(k, v.replace("'", "\\'")) for k, v in rows)
    return spark.sql(f"SELECT CAST({key} AS INT) AS {key}, {name} FROM VALUES {body} AS t({key}, {name})")


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor dimension = supplier; unbounded at scale (no forced broadcast)."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("vendorid"), F.col("s_name").alias("vendor_name"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension = nation (zone) + region (borough); 25 rows by definition."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(bounded(r), n.n_regionkey == r.r_regionkey, "left")
            .select(F.col("n_nationkey").cast("bigint").alias("locationid"),
                    F.col("r_name").alias("borough"), F.col("n_name").alias("zone")))


# ---------------------------------------------------------------------------
# The same stand-ins as DuckDB SQL (oracle side).  Kept next to the Spark
# builders so a change to one is seen next to the other.
# ---------------------------------------------------------------------------

LINEITEM_TRIPS_SQL = """
SELECT l.l_suppkey AS vendorid,
       o.o_orderdate AS tpep_pickup_datetime,
       l.l_shipdate AS tpep_dropoff_datetime,
       l.l_linenumber AS passenger_count,
       l.l_quantity AS trip_distance,
       CASE WHEN l.l_returnflag = 'N' THEN 1 WHEN l.l_returnflag = 'R' THEN 2 ELSE 99 END AS ratecodeid,
       CASE WHEN l.l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
       CAST(c.c_nationkey AS BIGINT) AS pulocationid,
       CAST(s.s_nationkey AS BIGINT) AS dolocationid,
       CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
       CAST(floor(l.l_extendedprice) AS DOUBLE) AS fare_amount,
       l.l_tax AS extra, l.l_tax AS mta_tax,
       CAST(floor(l.l_extendedprice * l.l_discount) AS DOUBLE) AS tip_amount,
       CAST(floor(l.l_extendedprice * l.l_tax) AS DOUBLE) AS tolls_amount,
       l.l_tax AS improvement_surcharge,
       CAST(floor(l.l_extendedprice) AS DOUBLE) + CAST(floor(l.l_extendedprice * l.l_discount) AS DOUBLE)
         + CAST(floor(l.l_extendedprice * l.l_tax) AS DOUBLE) AS total_amount,
       l.l_discount AS congestion_surcharge,
       0.0::DOUBLE AS airport_fee
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""

EVENT_TRIPS_SQL = """
SELECT user_id % 2 + 1 AS vendorid,
       ts AS tpep_pickup_datetime,
       ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS tpep_dropoff_datetime,
       CAST(user_id % 7 AS INTEGER) AS passenger_count,
       CAST(json_extract_string(props, '$.k') AS INTEGER) / 4.0::DOUBLE AS trip_distance,
       CASE WHEN value > 300 THEN 2 ELSE 1 END AS ratecodeid,
       'N' AS store_and_fwd_flag,
       user_id % 25 AS pulocationid,
       CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 25 AS BIGINT) AS dolocationid,
       CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3
                       WHEN 'error' THEN 4 WHEN 'signup' THEN 5 END AS payment_type,
       CAST(floor(value) AS DOUBLE) AS fare_amount,
       0.5::DOUBLE AS extra, 0.5::DOUBLE AS mta_tax,
       CASE WHEN event_type IN ('purchase', 'view') THEN CAST(floor(value * 15 / 100) AS DOUBLE)
            ELSE 0.0::DOUBLE END AS tip_amount,
       0.0::DOUBLE AS tolls_amount, 0.3::DOUBLE AS improvement_surcharge,
       CAST(floor(value) AS DOUBLE) + CASE WHEN event_type IN ('purchase', 'view')
         THEN CAST(floor(value * 15 / 100) AS DOUBLE) ELSE 0.0::DOUBLE END AS total_amount,
       0.0::DOUBLE AS congestion_surcharge, 0.0::DOUBLE AS airport_fee
FROM events
"""


def values_sql(rows, key: str, name: str) -> str:
    body = ", ".join(f"({k}, '{v}')" for k, v in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({key}, {name})"


ZONES_SQL = """
SELECT CAST(n.n_nationkey AS BIGINT) AS locationid, r.r_name AS borough, n.n_name AS zone
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""
VENDORS_SQL = "SELECT s_suppkey AS vendorid, s_name AS vendor_name FROM supplier"
