"""SQL exercises (Appendix B), windows (I) and joins (F) on the testdata.

Stand-ins (SURVEY §7.3): customers/employees = customer, orders = orders,
products/goods = part, sales = lineitem, departments = region -> nation ->
supplier.  Money sums are taken in integer cents so totals are exact and
orderings by revenue have no float ties.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions import features as fx
from lakemart.operators import enrich as en
from lakemart.operators import windows as win
from lakemart.plans.registry import query
from lakemart.session import table

AGE_STANDIN = 5000          # "age > 30" -> account balance above this
REFERENCE_CATEGORY = "ECONOMY"   # stands in for 'Electronics'
PRICE_LOW, PRICE_HIGH = 1200, 1800   # price-class thresholds rescaled to part prices
AS_OF = "2002-01-01"        # fixed "today" for days-since


def cents(c):
    """Exact integer cents of a 2-decimal money column."""
    return F.round(F.col(c) * 100).cast("bigint")


CENTS_SQL = "CAST(round({c} * 100) AS BIGINT)"


@query("sql01_join_filter_sum", rnd=("order_sum",), sql="""
SELECT c.c_name AS customer_name, sum(o.o_totalprice) AS order_sum
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey AND c.c_acctbal > 5000
GROUP BY c.c_name""")
def sql01(spark, sf):
    """F4j/G32: inner join with an extra ON predicate, sum per customer name."""
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders")
    j = c.join(o, (c.c_custkey == o.o_custkey) & (c.c_acctbal > AGE_STANDIN), "inner")
    return j.groupBy(F.col("c_name").alias("customer_name")).agg(F.sum("o_totalprice").alias("order_sum"))


@query("sql02_having", sql="""
SELECT o_custkey AS user_id, count(*) AS order_count FROM orders
GROUP BY o_custkey HAVING count(*) > 3 ORDER BY order_count DESC""")
def sql02(spark, sf):
    """GROUP BY ... HAVING count > 3 ORDER BY count DESC."""
    o = table(spark, sf, "orders")
    return (o.groupBy(F.col("o_custkey").alias("user_id")).agg(F.count(F.lit(1)).alias("order_count"))
            .filter(F.col("order_count") > 3).orderBy(F.desc("order_count")))


SQL03_CATS = f"""SELECT p_type FROM part GROUP BY p_type
HAVING avg(p_retailprice) > (SELECT avg(p_retailprice) FROM part WHERE p_type = '{REFERENCE_CATEGORY}')"""


def _sql03_categories(spark, sf):
    p = table(spark, sf, "part")
    ref = p.filter(F.col("p_type") == REFERENCE_CATEGORY).agg(F.avg("p_retailprice")).scalar()
    return (p.groupBy("p_type").agg(F.avg("p_retailprice").alias("avg_price"))
                           .filter(F.col("avg_price") > ref).select("p_type"))


@query("sql03_above_avg_join", sql=f"""
WITH avg_pr AS ({SQL03_CATS})
SELECT p.p_partkey AS product_id FROM part p JOIN avg_pr ap ON p.p_type = ap.p_type""")
def sql03_join(spark, sf):
    """F5j/G31: categories above the reference category's average (scalar
    subquery), joined back to the products."""
    p = table(spark, sf, "part")
    cats = _sql03_categories(spark, sf)
    return p.join(cats, "p_type", "inner").select(F.col("p_partkey").alias("product_id"))


@query("sql03_above_avg_semi", sql=f"""
SELECT p_partkey AS product_id FROM part WHERE p_type IN ({SQL03_CATS})""")
def sql03_semi(spark, sf):
    """F6j: the same as ``IN (subquery)`` = left semi join."""
    p = table(spark, sf, "part")
    return en.semi(p, _sql03_categories(spark, sf), "p_type").select(F.col("p_partkey").alias("product_id"))


@query("sql04_dept_avg", rnd=("dept_avg_salary",), sql="""
SELECT c_custkey AS employee_id, c_mktsegment AS department,
       avg(c_acctbal) OVER (PARTITION BY c_mktsegment) AS dept_avg_salary
FROM customer""")
def sql04(spark, sf):
    """Department average on every employee row (skew-safe form)."""
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("employee_id"), F.col("c_mktsegment").alias("department"),
        F.col("c_acctbal").alias("salary"))
    return win.with_group_average(c, "department", "salary", "dept_avg_salary").drop("salary")


@query("sql05_price_class", sql=f"""
SELECT p_partkey AS good_id, p_name AS name, p_retailprice AS price,
  CASE WHEN p_retailprice < {PRICE_LOW} THEN 'Дешевые'
       WHEN p_retailprice >= {PRICE_LOW} AND p_retailprice <= {PRICE_HIGH} THEN 'Средняя стоимость'
       WHEN p_retailprice > {PRICE_HIGH} THEN 'Дорогие' END AS category
FROM part""")
def sql05(spark, sf):
    """Price class; NULL price stays NULL."""
    p = table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("good_id"), F.col("p_name").alias("name"),
                    F.col("p_retailprice").alias("price"),
                    fx.price_class("p_retailprice", PRICE_LOW, PRICE_HIGH).alias("category"))


@query("sql06_days_since", sql=f"""
SELECT o_orderkey AS client_id, DATE '{AS_OF}' AS today, CAST(o_orderdate AS DATE) AS registration_date,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since
FROM orders""")
def sql06(spark, sf):
    """Whole days from registration to a fixed as-of date."""
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("client_id"), F.to_date(F.lit(AS_OF)).alias("today"),
                    F.to_date("o_orderdate").alias("registration_date"),
                    fx.days_since("o_orderdate", AS_OF).alias("days_since"))


SALES_SQL = f"""SELECT l_partkey AS product_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS sale_month,
  sum({CENTS_SQL.format(c='l_extendedprice')}) AS revenue_cents
FROM lineitem GROUP BY ALL"""


def _sales(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_partkey").alias("product_id"),
                      F.trunc(F.to_date("l_shipdate"), "month").alias("sale_month")).agg(
        F.sum(cents("l_extendedprice")).alias("revenue_cents"))


@query("sql07_mom_growth", rnd=("percent",), sql=f"""
WITH sales AS ({SALES_SQL}),
g AS (SELECT product_id, sale_month, revenue_cents,
        lag(revenue_cents, 1) OVER (PARTITION BY product_id ORDER BY sale_month) AS lag_cents FROM sales)
SELECT product_id, sale_month, CAST(revenue_cents AS BIGINT) / 100.0 AS revenue,
  CAST(lag_cents AS BIGINT) / 100.0 AS revenue_lag1,
  CAST(revenue_cents - lag_cents AS BIGINT) / 100.0 AS revenue_change_lag1,
  CASE WHEN lag_cents <> 0 THEN CAST(revenue_cents - lag_cents AS BIGINT) / CAST(lag_cents AS BIGINT) END * 100
    AS percent,
  CASE WHEN lag_cents IS NULL THEN 'Нет данных' WHEN revenue_cents - lag_cents > 0 THEN 'Рост'
       WHEN revenue_cents - lag_cents = 0 THEN 'Плато' WHEN revenue_cents - lag_cents < 0 THEN 'Падение' END
    AS grow_status
FROM g ORDER BY 1, 2""")
def sql07(spark, sf):
    """LAG over existing months, change, percent and status."""
    g = win.lag_growth(_sales(spark, sf), "product_id", "sale_month", "revenue_cents")
    return g.select(
        "product_id", "sale_month",
        (F.col("revenue_cents") / 100.0).alias("revenue"),
        (F.col("revenue_lag1") / 100.0).alias("revenue_lag1"),
        (F.col("revenue_change_lag1") / 100.0).alias("revenue_change_lag1"),
        "percent", "grow_status").orderBy("product_id", "sale_month")


NODES_SQL = """SELECT 'R' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent_id, r_name AS name FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name FROM nation
  UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey, s_name FROM supplier"""


def departments(spark, sf):
    r = table(spark, sf, "region")
    n = table(spark, sf, "nation")
    s = table(spark, sf, "supplier")
    def sid(prefix, c):
        return F.concat(F.lit(prefix), F.col(c).cast("string"))
    return (r.select(sid("R", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent_id"),
                     F.col("r_name").alias("name"))
            .unionByName(n.select(sid("N", "n_nationkey").alias("id"), sid("R", "n_regionkey").alias("parent_id"),
                                  F.col("n_name").alias("name")))
            .unionByName(s.select(sid("S", "s_suppkey").alias("id"), sid("N", "s_nationkey").alias("parent_id"),
                                  F.col("s_name").alias("name"))))


@query("sql08_hierarchy", sql=f"""
WITH RECURSIVE nodes AS ({NODES_SQL}),
tree AS (
  SELECT id, parent_id, name, 1 AS level, name AS path FROM nodes WHERE parent_id IS NULL
  UNION ALL
  SELECT n.id, n.parent_id, n.name, t.level + 1, t.path || ' -> ' || n.name
  FROM nodes n JOIN tree t ON n.parent_id = t.id)
SELECT id AS dept_id, parent_id AS parent_dept_id, name AS dept_name, level, path FROM tree ORDER BY path""")
def sql08(spark, sf):
    """I13/I12/F14j: recursive walk from the roots with level and path."""
    t = win.hierarchy(spark, departments(spark, sf))
    return t.select(F.col("id").alias("dept_id"), F.col("parent_id").alias("parent_dept_id"),
                    F.col("name").alias("dept_name"), "level", "path").orderBy("path")


@query("sql09_last_order", sql="""
SELECT DISTINCT ON (u.c_custkey) u.c_custkey AS user_id, u.c_name AS username,
       o.o_orderkey AS order_id, o.o_orderdate AS order_date
FROM customer u LEFT JOIN orders o ON u.c_custkey = o.o_custkey
ORDER BY u.c_custkey, o.o_orderkey DESC""")
def sql09(spark, sf):
    """I3/I4/F7j: last order (highest id) per user, users without orders kept."""
    u = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username"))
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("order_id"),
                                          F.col("o_orderdate").alias("order_date"))
    return win.latest_per_key(u, o, "user_id", "order_id", ["order_date"])


@query("sql10_top_products", sql=f"""
SELECT p.p_partkey AS product_id, sum({CENTS_SQL.format(c='s.l_extendedprice')}) / 100.0 AS total_revenue
FROM part p JOIN lineitem s ON p.p_partkey = s.l_partkey
GROUP BY p.p_partkey ORDER BY total_revenue DESC, product_id LIMIT 10""")
def sql10_top(spark, sf):
    """Join, aggregate, top 10 by revenue (tie-break on id)."""
    p = table(spark, sf, "part")
    s = table(spark, sf, "lineitem")
    j = p.join(s, p.p_partkey == s.l_partkey, "inner")
    agg = j.groupBy(F.col("p_partkey").alias("product_id")).agg(
        (F.sum(cents("l_extendedprice")) / 100.0).alias("total_revenue"))
    return win.top_k(agg, 10, F.desc("total_revenue"), "product_id")


@query("sql10_eager_agg", sql=f"""
WITH agg AS (SELECT l_partkey AS product_id, sum({CENTS_SQL.format(c='l_extendedprice')}) AS cents
             FROM lineitem GROUP BY l_partkey)
SELECT p.p_partkey AS product_id, a.cents / 100.0 AS total_revenue
FROM part p JOIN agg a ON p.p_partkey = a.product_id
ORDER BY total_revenue DESC, product_id LIMIT 10""")
def sql10_eager(spark, sf):
    """F10j: aggregate the fact before the join; same rows as sql10_top_products."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"))
    s = table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "product_id")
    agg = en.eager_aggregate_join(s, p, "product_id", [F.sum(cents("l_extendedprice")).alias("cents")])
    return win.top_k(agg.select("product_id", (F.col("cents") / 100.0).alias("total_revenue")),
                     10, F.desc("total_revenue"), "product_id")


@query("rolling_7d", rnd=("daily_value", "rolling_7"), sql=f"""
WITH d AS (SELECT CAST(ts AS DATE) AS day, sum({CENTS_SQL.format(c='value')}) AS cents FROM events GROUP BY 1)
SELECT day, cents / 100.0 AS daily_value,
  avg(cents / 100.0) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7
FROM d""")
def rolling_7d(spark, sf):
    """7-row rolling mean of a daily series (min_periods=1)."""
    e = table(spark, sf, "events")
    daily = e.groupBy(F.to_date("ts").alias("day")).agg((F.sum(cents("value")) / 100.0).alias("daily_value"))
    return win.rolling_mean(daily, "day", "daily_value", 7).withColumnRenamed("rolling_7", "rolling_7")


@query("leaderboard", sql=f"""
WITH s AS (SELECT o_custkey AS member, sum({CENTS_SQL.format(c='o_totalprice')}) / 100.0 AS score
           FROM orders GROUP BY 1)
SELECT member, score, CAST(row_number() OVER (ORDER BY score DESC, member) AS INTEGER) AS rank,
  (SELECT count(*) FROM s WHERE score >= 2500000) AS n_at_or_above
FROM s ORDER BY score DESC, member LIMIT 3""")
def leaderboard(spark, sf):
    """I8: top-3 members by score, and how many score >= a threshold."""
    o = table(spark, sf, "orders")
    s = o.groupBy(F.col("o_custkey").alias("member")).agg(
        (F.sum(cents("o_totalprice")) / 100.0).alias("score"))
    return win.leaderboard(s, "member", "score", 3, 2500000)


@query("set_distinct", sql="SELECT DISTINCT user_id, event_type FROM events")
def set_distinct(spark, sf):
    """A set — duplicates ignored."""
    return table(spark, sf, "events").select("user_id", "event_type").distinct()


@query("set_intersect", sql="""
SELECT user_id FROM events WHERE event_type = 'purchase'
INTERSECT SELECT user_id FROM events WHERE event_type = 'error'""")
def set_intersect(spark, sf):
    """Users in both sets."""
    e = table(spark, sf, "events")
    return win.set_intersect(e.filter(F.col("event_type") == "purchase").select("user_id"),
                             e.filter(F.col("event_type") == "error").select("user_id"))


@query("above_group_avg", rnd=("avg_value", "group_avg"), sql="""
WITH fine AS (SELECT c_nationkey, c_mktsegment, count(*) AS n, avg(c_acctbal) AS avg_value,
                     max(c_acctbal) AS max_value FROM customer GROUP BY ALL),
coarse AS (SELECT c_nationkey, avg(c_acctbal) AS group_avg FROM customer GROUP BY ALL)
SELECT f.*, c.group_avg FROM fine f JOIN coarse c USING (c_nationkey) WHERE f.avg_value > c.group_avg""")
def above_group_avg(spark, sf):
    """F8j/G35: (nation, segment) stats above their nation's average."""
    c = table(spark, sf, "customer")
    return en.above_group_average(c, ["c_nationkey", "c_mktsegment"], ["c_nationkey"], "c_acctbal")


@query("agg_then_join", sql=f"""
WITH e AS (SELECT user_id, count(*) AS n_events, sum({CENTS_SQL.format(c='value')}) / 100.0 AS event_value
           FROM events GROUP BY 1),
o AS (SELECT o_custkey AS user_id, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT e.user_id, n_events, event_value, n_orders FROM e JOIN o ON e.user_id = o.user_id""")
def agg_then_join(spark, sf):
    """F9j: aggregate both sides on the key, then join the aggregates."""
    e = table(spark, sf, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"), (F.sum(cents("value")) / 100.0).alias("event_value"))
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    return e.join(o, "user_id", "inner")
