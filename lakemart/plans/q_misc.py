"""Flight, review and remaining marts (§2 D2, E15, E23, E24, E29, G23-G29,
G34, G36, G37, N3).

Stand-ins (built by Spark from the given tables):
* flights = events: date/time from ``ts``, origin/destination from user and
  ``props.k``, delays in whole minutes (exact sums, exact averages);
* reviews = documents LEFT JOIN labels: product = source, rating from the
  labels, review time from the document id.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions import features as fx
from lakemart.operators import clean as cl
from lakemart.plans import trips as tp
from lakemart.plans.registry import query
from lakemart.session import table

# ---------------------------------------------------------------- flights ----

FLIGHTS_SQL = """SELECT CAST(ts AS DATE) AS FL_DATE, upper(substr(event_type, 1, 2)) AS OP_CARRIER,
  user_id AS OP_CARRIER_FL_NUM, 'O' || CAST(user_id % 20 AS VARCHAR) AS ORIGIN,
  'D' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 20 AS VARCHAR) AS DEST,
  CAST(hour(ts) * 100 AS INTEGER) AS CRS_DEP_TIME, CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS DEP_TIME,
  CAST(minute(ts) - 30 AS DOUBLE) AS DEP_DELAY,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE floor(value) - 40.0 END AS ARR_DELAY
FROM events"""


def flights(spark, sf):
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.to_date("ts").alias("FL_DATE"), F.upper(F.substring("event_type", 1, 2)).alias("OP_CARRIER"),
        F.col("user_id").alias("OP_CARRIER_FL_NUM"),
        F.concat(F.lit("O"), (F.col("user_id") % 20).cast("string")).alias("ORIGIN"),
        F.concat(F.lit("D"), (k % 20).cast("string")).alias("DEST"),
        (F.hour("ts") * 100).alias("CRS_DEP_TIME"), (F.hour("ts") * 100 + F.minute("ts")).alias("DEP_TIME"),
        (F.minute("ts") - 30).cast("double").alias("DEP_DELAY"),
        F.when(F.col("event_id") % 13 == 0, F.lit(None)).otherwise(F.floor("value") - 40.0)
        .cast("double").alias("ARR_DELAY"))


def flight_features_df(df):
    """Delay flag, route, departure hour."""
    return df.withColumns({
        "IS_DELAYED": fx.flag(F.col("ARR_DELAY") > 15),
        "ROUTE": fx.route("ORIGIN", "DEST"),
        "DEP_HOUR": fx.hour_from_hhmm("DEP_TIME"),
    })


FEATURES_SQL = f"""SELECT *, CASE WHEN ARR_DELAY > 15 THEN 1 ELSE 0 END AS IS_DELAYED,
  ORIGIN || '-' || DEST AS ROUTE, CAST(DEP_TIME // 100 AS INTEGER) AS DEP_HOUR FROM ({FLIGHTS_SQL})"""
CLEAN_FLIGHTS_SQL = f"SELECT * FROM ({FEATURES_SQL}) WHERE ARR_DELAY IS NOT NULL AND DEP_TIME IS NOT NULL"


@query("flight_features", sql=FEATURES_SQL)
def flight_features(spark, sf):
    """Flags and keys of the flight job."""
    return flight_features_df(flights(spark, sf))


@query("drop_null_keys", sql=f"""
SELECT OP_CARRIER, count(*) AS flights FROM ({CLEAN_FLIGHTS_SQL}) GROUP BY ALL""")
def drop_null_keys(spark, sf):
    """Rows with a NULL key or measure dropped."""
    f = cl.drop_null_keys(flights(spark, sf), ["ARR_DELAY", "DEP_TIME"])
    return f.groupBy("OP_CARRIER").agg(F.count(F.lit(1)).alias("flights"))


@query("flight_top_routes", rnd=("avg_delay",), sql=f"""
SELECT ROUTE, CAST(sum(IS_DELAYED) AS BIGINT) AS total_delays, avg(ARR_DELAY) AS avg_delay
FROM ({CLEAN_FLIGHTS_SQL}) GROUP BY ROUTE ORDER BY total_delays DESC, ROUTE LIMIT 10""")
def flight_top_routes(spark, sf):
    """Dict-style agg, auto-named columns renamed, top 10 routes by delays."""
    f = flight_features_df(cl.drop_null_keys(flights(spark, sf), ["ARR_DELAY", "DEP_TIME"]))
    agg = (f.groupBy("ROUTE").agg({"IS_DELAYED": "sum", "ARR_DELAY": "avg"})
           .withColumnsRenamed({"sum(IS_DELAYED)": "total_delays", "avg(ARR_DELAY)": "avg_delay"}))
    return agg.orderBy(F.desc("total_delays"), "ROUTE").limit(10)


@query("flight_delay_by_origin", rnd=("avg_dep_delay",), sql=f"""
SELECT ORIGIN, count(*) AS flights, avg(DEP_DELAY) AS avg_dep_delay FROM ({CLEAN_FLIGHTS_SQL}) GROUP BY ALL""")
def flight_delay_by_origin(spark, sf):
    """Average departure delay by origin."""
    f = cl.drop_null_keys(flights(spark, sf), ["ARR_DELAY", "DEP_TIME"])
    return f.groupBy("ORIGIN").agg(F.count(F.lit(1)).alias("flights"), F.avg("DEP_DELAY").alias("avg_dep_delay"))


@query("flight_delay_trend", rnd=("avg_arr_delay",), sql=f"""
SELECT CAST(month(FL_DATE) AS INTEGER) AS month, DEP_HOUR, count(*) AS flights, avg(ARR_DELAY) AS avg_arr_delay
FROM ({CLEAN_FLIGHTS_SQL}) GROUP BY ALL""")
def flight_delay_trend(spark, sf):
    """Delay by month and departure hour."""
    f = flight_features_df(cl.drop_null_keys(flights(spark, sf), ["ARR_DELAY", "DEP_TIME"]))
    return f.groupBy(F.month("FL_DATE").alias("month"), "DEP_HOUR").agg(
        F.count(F.lit(1)).alias("flights"), F.avg("ARR_DELAY").alias("avg_arr_delay"))


# ---------------------------------------------------------------- reviews ----

REVIEW_EPOCH = 1_600_000_000

REVIEWS_SQL = f"""SELECT d.doc_id, d.source AS asin, d.text AS reviewText,
  CAST(1 + l.quality * 3 + (1 - l.toxic) AS DOUBLE) AS overall,
  {REVIEW_EPOCH} + d.doc_id * 3600 AS unixReviewTime, d.n_chars % 7 AS helpful
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
CLEAN_REVIEWS_SQL = f"""SELECT *, make_timestamp(unixReviewTime * 1000000) AS review_ts
FROM ({REVIEWS_SQL}) WHERE reviewText IS NOT NULL AND overall IS NOT NULL"""


def reviews(spark, sf):
    """Reviews: every document, rating from its label when there is one."""
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels")
    j = d.join(lab, "doc_id", "left")
    return j.select("doc_id", F.col("source").alias("asin"), F.col("text").alias("reviewText"),
                    (1 + F.col("quality") * 3 + (1 - F.col("toxic"))).cast("double").alias("overall"),
                    (F.lit(REVIEW_EPOCH) + F.col("doc_id") * 3600).alias("unixReviewTime"),
                    (F.col("n_chars") % 7).alias("helpful"))


def clean_reviews(spark, sf):
    """Reviews without text or rating dropped; epoch -> timestamp."""
    r = cl.drop_null_keys(reviews(spark, sf), ["reviewText", "overall"])
    return r.withColumn("review_ts", fx.epoch_to_timestamp("unixReviewTime"))


@query("epoch_to_ts", sql=f"SELECT doc_id, asin, review_ts FROM ({CLEAN_REVIEWS_SQL})")
def epoch_to_ts(spark, sf):
    """Epoch seconds -> timestamp."""
    return clean_reviews(spark, sf).select("doc_id", "asin", "review_ts")


@query("review_features", sql=f"""
SELECT doc_id, CAST(length(reviewText) AS INTEGER) AS reviewLength, CAST(year(review_ts) AS INTEGER) AS reviewYear,
  CAST(month(review_ts) AS INTEGER) AS reviewMonth FROM ({CLEAN_REVIEWS_SQL})""")
def review_features(spark, sf):
    """Text length, review year and month."""
    r = clean_reviews(spark, sf)
    return r.select("doc_id", F.length("reviewText").alias("reviewLength"),
                    F.year("review_ts").alias("reviewYear"), F.month("review_ts").alias("reviewMonth"))


PRODUCT_SQL = f"""SELECT asin, avg(overall) AS avg_rating, count(*) AS review_count,
  sum(helpful) AS total_helpful_votes, max(review_ts) AS last_updated FROM ({CLEAN_REVIEWS_SQL}) GROUP BY asin"""


def product_analytics(spark, sf):
    r = clean_reviews(spark, sf)
    return r.groupBy("asin").agg(F.avg("overall").alias("avg_rating"), F.count(F.lit(1)).alias("review_count"),
                                 F.sum("helpful").alias("total_helpful_votes"),
                                 F.max("review_ts").alias("last_updated"))


@query("product_reviews", rnd=("avg_rating",), sql=PRODUCT_SQL.replace(
    "sum(helpful) AS", "CAST(sum(helpful) AS BIGINT) AS"))
def product_reviews(spark, sf):
    """Per-product rating, count, helpful votes, last update."""
    return product_analytics(spark, sf)


MIN_REVIEWS = 10


@query("top_rated", rnd=("avg_rating",), sql=f"""
SELECT asin, avg_rating, review_count FROM ({PRODUCT_SQL}) WHERE review_count > {MIN_REVIEWS}
ORDER BY avg_rating DESC, asin LIMIT 10""")
def top_rated(spark, sf):
    """Top 10 products by average rating among those with enough reviews."""
    p = product_analytics(spark, sf).filter(F.col("review_count") > MIN_REVIEWS)
    return p.select("asin", "avg_rating", "review_count").orderBy(F.desc("avg_rating"), "asin").limit(10)


@query("rating_histogram", sql=f"""
SELECT CAST(floor(avg_rating) AS INTEGER) AS rating_bucket, count(*) AS products
FROM ({PRODUCT_SQL}) GROUP BY ALL""")
def rating_histogram(spark, sf):
    """How many products per whole-star average rating."""
    p = product_analytics(spark, sf)
    return p.groupBy(F.floor("avg_rating").cast("int").alias("rating_bucket")).agg(
        F.count(F.lit(1)).alias("products"))


# ---- fixed values: a small polarity lexicon for the default scorer --------
LEXICON = {"good": 1, "great": 1, "excellent": 1, "happy": 1, "love": 1, "best": 1,
           "bad": -1, "poor": -1, "sad": -1, "hate": -1, "worst": -1, "terrible": -1}
TOKEN_SPLIT = r"[^\p{L}]+"


def _lexicon_pattern(words) -> str:
    """One regex for every lexicon word as a whole token.  The first-letter
    lookahead rejects most positions before the (costlier) lookbehind runs."""
    first = "".join(sorted({w[0] for w in words}))
    return f"(?=[{first}])(?<!\\p{{L}})({'|'.join(sorted(words))})(?!\\p{{L}})"


def score_text(text_col, lexicon: dict[str, int] = LEXICON):
    """(n_tokens, score) of a text by lexicon lookup, row-local.

    Tokens are maximal runs of letters; a lexicon word counts where a token
    equals it.  Two regex passes over the whole text (JVM built-ins): a
    token count, and one extraction of all lexicon hits; the few hits are then
    scored against the lexicon map.  No explode, no shuffle, no Python.  A
    pandas_udf scorer can replace this function where a model is required.
    """
    low = F.lower(text_col)
    n_tok = F.regexp_count(low, F.lit("\\p{L}+"))
    hits = F.regexp_extract_all(low, F.lit(_lexicon_pattern(lexicon)), 1)
    lex = F.create_map(*[x for k, v in lexicon.items() for x in (F.lit(k), F.lit(v))])
    score = F.aggregate(hits, F.lit(0), lambda acc, w: acc + F.coalesce(F.element_at(lex, w), F.lit(0)))
    return n_tok.cast("int"), score.cast("int")


@query("sentiment_lexicon", sql="""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{L}]+'), lambda x: x <> '') AS toks
           FROM documents)
SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens,
  CAST(coalesce(list_sum(list_transform(toks, lambda x: CASE WHEN x IN ('good','great','excellent','happy','love','best')
       THEN 1 WHEN x IN ('bad','poor','sad','hate','worst','terrible') THEN -1 ELSE 0 END)), 0) AS INTEGER) AS score
FROM t""")
def sentiment_lexicon(spark, sf):
    """Lexicon sentiment of every whole document."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    n_tok, score = score_text(F.col("text"))
    return d.select("doc_id", n_tok.alias("n_tokens"), score.alias("score"))


# ------------------------------------------------------------------ misc ----

@query("global_agg", rnd=("avg_total",), sql="""
SELECT count(*) AS orders, sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100.0 AS sum_total,
  avg(o_totalprice) AS avg_total, max(o_totalprice) AS max_total FROM orders""")
def global_agg(spark, sf):
    """groupBy() with no keys — one global row."""
    o = table(spark, sf, "orders")
    return o.groupBy().agg(F.count(F.lit(1)).alias("orders"),
                           (F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")) / 100.0).alias("sum_total"),
                           F.avg("o_totalprice").alias("avg_total"), F.max("o_totalprice").alias("max_total"))


@query("yearly_totals", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  count(*) AS records, sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100.0 AS total
FROM orders GROUP BY ALL ORDER BY year, month""")
def yearly_totals(spark, sf):
    """(year, month) record count and total."""
    o = table(spark, sf, "orders")
    return (o.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
            .agg(F.count(F.lit(1)).alias("records"),
                 (F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")) / 100.0).alias("total"))
            .orderBy("year", "month"))


@query("order_totals", rnd=(("order_total", 4),), sql="""
SELECT l.l_orderkey, count(*) AS n_items,
  sum(p.p_retailprice * l.l_quantity * (1 - l.l_discount)) AS order_total
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_orderkey""")
def order_totals(spark, sf):
    """Line total = unit price * quantity * (1 - discount), summed per order."""
    li = table(spark, sf, "lineitem")
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    j = li.join(p, li.l_partkey == p.p_partkey)
    line = F.col("p_retailprice") * F.col("l_quantity") * (1 - F.col("l_discount"))
    return j.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_items"), F.sum(line).alias("order_total"))


@query("profitability", rnd=("revenue_per_minute_ratio",), sql=tp.with_eda("events", """
SELECT time_of_day, avg(total_amount) / avg(trip_duration_minutes) AS revenue_per_minute_ratio, count(*) AS trips
FROM eda GROUP BY ALL"""))
def profitability(spark, sf):
    """Ratio of averages per day part (a fixed key), descending."""
    from lakemart.operators.marts import ratio_of_averages
    return ratio_of_averages(tp.eda(spark, sf, "events"), ["time_of_day"], "total_amount")


@query("distinct_months", sql=tp.with_eda("lineitem", """
SELECT count(*) AS n_months FROM (SELECT DISTINCT year, month FROM eda)"""))
def distinct_months(spark, sf):
    """Distinct (year, month) count."""
    e = tp.eda(spark, sf, "lineitem")
    return e.select("year", "month").distinct().agg(F.count(F.lit(1)).alias("n_months"))


@query("monthly_unique_exact", sql="""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(DISTINCT o_custkey) AS users
FROM orders GROUP BY ALL""")
def monthly_unique_exact(spark, sf):
    """G37 exact twin: distinct users per month."""
    o = table(spark, sf, "orders")
    return o.groupBy(fx.month_start("o_orderdate").alias("month")).agg(
        F.count_distinct("o_custkey").alias("users"))


@query("monthly_unique_users")
def monthly_unique_users(spark, sf):
    """G37/N2 (rows-only): approximate distinct users per month two ways —
    ``approx_count_distinct`` and mergeable HLL sketches built per day and
    unioned per month (sketches can be stored and re-merged later)."""
    o = table(spark, sf, "orders").withColumn("month", fx.month_start("o_orderdate"))
    daily = o.groupBy("month", F.to_date("o_orderdate").alias("day")).agg(
        F.hll_sketch_agg("o_custkey", 14).alias("sketch"))
    merged = daily.groupBy("month").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("hll_users"))
    approx = o.groupBy("month").agg(F.approx_count_distinct("o_custkey", 0.01).alias("approx_users"))
    return approx.join(merged, "month")
