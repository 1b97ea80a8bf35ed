"""Catalog SQL surface, snapshots and time travel (§2 K)."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from lakemart.plans import catalog as cat
from lakemart.plans.registry import query
from lakemart.session import scratch_path, table


@query("sql_view", rnd=("avg_total",), sql="""
SELECT o_orderpriority, count(*) AS orders, avg(o_totalprice) AS avg_total FROM orders
WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""")
def sql_view(spark, sf):
    """K8: temp view + spark.sql."""
    view = f"orders_{uuid.uuid4().hex[:8]}"
    table(spark, sf, "orders").createOrReplaceTempView(view)
    return spark.sql(f"""SELECT o_orderpriority, count(*) AS orders, avg(o_totalprice) AS avg_total
                         FROM {view} WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""")


@query("catalog_insert_select", sql="""
SELECT o_orderstatus AS status, count(*) AS orders, sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100.0 AS total
FROM orders GROUP BY ALL""")
def catalog_insert_select(spark, sf):
    """K1-K4: namespace, typed table, INSERT ... SELECT with current_timestamp, SELECT."""
    ns = "lakemart_ws"
    cat.create_namespace(spark, ns, scratch_path(spark, "namespace"))
    name = f"{ns}.orders_{uuid.uuid4().hex[:8]}"
    cat.create_table(spark, name, "order_id BIGINT, status STRING, total DOUBLE, loaded_at TIMESTAMP",
                     location=scratch_path(spark, "table"))
    view = f"src_{uuid.uuid4().hex[:8]}"
    table(spark, sf, "orders").createOrReplaceTempView(view)
    spark.sql(f"INSERT INTO {name} SELECT o_orderkey, o_orderstatus, o_totalprice, current_timestamp() FROM {view}")
    return spark.sql(f"""SELECT status, count(*) AS orders,
                           CAST(sum(CAST(round(total * 100) AS BIGINT)) AS DOUBLE) / 100 AS total
                         FROM {name} GROUP BY status""")


def _snapshots(spark, sf):
    """Three commits from orders: append <=1996, append 1997, then overwrite >=1998."""
    t = cat.SnapshotTable(spark, scratch_path(spark, "snapshots"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    y = F.year("o_orderdate")
    t.commit(o.filter(y <= 1996), "append")
    t.commit(o.filter(y == 1997), "append")
    t.commit(o.filter(y >= 1998), "overwrite")
    return t


@query("snapshot_history", sql="""
SELECT 1::BIGINT AS version, 'append' AS operation, count(*) FILTER (WHERE year(o_orderdate) <= 1996) AS rows FROM orders
UNION ALL SELECT 2, 'append', count(*) FILTER (WHERE year(o_orderdate) = 1997) FROM orders
UNION ALL SELECT 3, 'overwrite', count(*) FILTER (WHERE year(o_orderdate) >= 1998) FROM orders""")
def snapshot_history(spark, sf):
    """K6: snapshot list (version, operation, rows)."""
    return _snapshots(spark, sf).history().drop("committed_at")


@query("time_travel", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders FROM orders
WHERE year(o_orderdate) <= 1997 GROUP BY ALL""")
def time_travel(spark, sf):
    """K7: VERSION AS OF 2 sees both appends, not the later overwrite."""
    v2 = _snapshots(spark, sf).read(2)
    return v2.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("orders"))


@query("snapshot_two_writers", sql="""
SELECT o_orderstatus, count(*) AS orders, 2::BIGINT AS versions FROM orders GROUP BY ALL""")
def snapshot_two_writers(spark, sf):
    """K6/K7: two writers commit at the same time; each takes a version of its own
    and the table holds the rows of both."""
    t = cat.SnapshotTable(spark, scratch_path(spark, "two-writers"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    halves = [o.filter("o_orderkey % 2 = 0"), o.filter("o_orderkey % 2 <> 0")]
    with ThreadPoolExecutor(2) as pool:
        versions = sorted(pool.map(t.commit, halves))
    return t.read().groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"),
                                                 F.lit(len(set(versions))).cast("long").alias("versions"))


@query("catalog_insert_values", sql="""
SELECT CAST(r_regionkey AS BIGINT) AS code, r_name AS name, 'region' AS kind FROM region
UNION ALL SELECT -1::BIGINT, 'O''Neill \\ sons', NULL""")
def catalog_insert_values(spark, sf):
    """K2/K4/K5: INSERT ... VALUES with the load time, into a table of a namespace that
    SHOW NAMESPACES lists; the rows are the region table's (five by definition) and an odd one."""
    ns = "lakemart_values"
    cat.create_namespace(spark, ns, scratch_path(spark, "namespace"))
    name = f"{ns}.codes_{uuid.uuid4().hex[:8]}"
    cat.create_table(spark, name, "code BIGINT, name STRING, kind STRING, loaded_at TIMESTAMP",
                     location=scratch_path(spark, "table"))
    regions = table(spark, sf, "region").select("r_regionkey", "r_name").collect()
    cat.insert_values(spark, name, [(r[0], r[1], "region") for r in regions] + [(-1, "O'Neill \\ sons", None)])
    listed = not cat.show_namespaces(spark).filter(F.col("namespace") == ns).isEmpty()
    return spark.table(name).filter(F.lit(listed) & F.col("loaded_at").isNotNull()).select("code", "name", "kind")
