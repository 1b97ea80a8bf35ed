"""Nested data, JSON / text scans and string predicates (§2 J, A12-A18, D4, D7, D8, D14, E17, E18).

Inputs are written by Spark from the given tables into the shared scratch
area first (chat exports, game catalogues, JSON lines, text lines), then read
back with the scan under test.  Documents are bounded by construction (a
chat chunk holds at most 64 messages, a catalogue file at most 50 apps), so
no group is collected whole into one task.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions import features as fx
from lakemart.functions import nested as nx
from lakemart.operators import clean as cl
from lakemart.plans.registry import query
from lakemart.session import scratch_path, table
from lakemart.sources import files as fs

CHAT_CHUNK = 64
CHAT_SCHEMA = ("chats STRUCT<list: ARRAY<STRUCT<id: BIGINT, name: STRING, type: STRING, "
               "messages: ARRAY<STRUCT<id: BIGINT, date: STRING, from: STRING, from_id: STRING, "
               "text: STRING, type: STRING>>>>>")


def write_chat_export(spark, sf, target: int = fs.PACK_BYTES) -> str:
    """Chat-export documents in multi-line JSON files of about ``target`` bytes, from conversations."""
    c = table(spark, sf, "conversations").withColumn("chunk", (F.col("turn") / CHAT_CHUNK).cast("bigint"))
    c = fs.pack_by_bytes(c, F.coalesce(F.octet_length("text"), F.lit(0)) + 200, ["conv_id", "chunk"], target)
    # As in real exports, some messages carry their text as an array of
    # pieces (split after ". ", so the pieces join back to the original).
    pieces = F.parse_json(F.to_json(F.split("text", r"(?<=\. )")))
    plain = F.variant_get(F.parse_json(F.to_json(F.struct(F.col("text").alias("t")))), "$.t", "variant")
    text = F.when(F.col("turn") % 5 == 2, pieces).otherwise(plain)
    msg = F.struct(F.col("turn").alias("id"), F.lit(None).cast("string").alias("date"),
                   F.col("role").alias("from"),
                   F.concat(F.col("role"), F.lit("_"), F.col("conv_id").cast("string")).alias("from_id"),
                   text.alias("text"), F.lit("message").alias("type"))
    chunks = c.groupBy("pack", "conv_id", "chunk").agg(F.collect_list(msg).alias("messages"))
    chat = F.struct(F.col("conv_id").alias("id"),
                    F.concat(F.lit("chat_"), F.col("conv_id").cast("string")).alias("name"),
                    F.lit("personal_chat").alias("type"), F.col("messages"))
    doc = chunks.select("pack", F.to_json(F.struct(F.struct(F.array(chat).alias("list")).alias("chats")),
                                          {"pretty": "true"}).alias("value"))
    path = scratch_path(spark, "chat-export")
    fs.write_json_arrays(doc, path)
    return path


def read_chats(spark, path: str):
    """Multi-line JSON documents (a top-level array per file), UTF-8, explicit schema."""
    return fs.read_json_documents(spark, path, CHAT_SCHEMA)


CHAT_SQL = """SELECT conv_id AS chat_id, 'chat_' || conv_id AS chat_name, 'personal_chat' AS chat_type,
  turn AS message_id, role AS "from", role || '_' || conv_id AS from_id, text, 'message' AS type
FROM conversations"""


@query("chat_flatten", sql=CHAT_SQL)
def chat_flatten(spark, sf):
    """Multi-line JSON export -> explode chats -> explode messages."""
    flat = nx.explode_chats(read_chats(spark, write_chat_export(spark, sf)))
    return flat.drop("date")


@query("chat_text_count", sql=f"""
SELECT chat_id, chat_name, count(*) FILTER (WHERE text LIKE '%the%') AS n_messages
FROM ({CHAT_SQL}) GROUP BY ALL""")
def chat_text_count(spark, sf):
    """Per chat, messages whose text contains a word."""
    flat = nx.explode_chats(read_chats(spark, write_chat_export(spark, sf)))
    return flat.groupBy("chat_id", "chat_name").agg(
        F.count_if(F.col("text").like("%the%")).alias("n_messages"))


APP_SCHEMA = ("STRUCT<name: STRING, release_date: STRING, required_age: INT, price: DOUBLE, "
              "developers: ARRAY<STRING>, genres: ARRAY<STRING>>")
def write_game_catalogue(spark, sf, target: int = fs.PACK_BYTES) -> str:
    """Whole-file JSON objects keyed by app id, about ``target`` bytes each, from part."""
    p = fs.pack_by_bytes(table(spark, sf, "part"), F.octet_length("p_name") + F.octet_length("p_type") + 150, ["p_partkey"],
                         target)
    day = F.date_add(F.to_date(F.lit("2020-01-01")), (F.col("p_partkey") % 1000).cast("int"))
    release = (F.when(F.col("p_partkey") % 3 == 0, F.date_format(day, "MMM d, yyyy"))
               .when(F.col("p_partkey") % 3 == 1, F.date_format(day, "MMM yyyy"))
               .otherwise(F.lit("TBA")))
    devs = F.when(F.col("p_partkey") % 10 == 0, F.array().cast("array<string>")).otherwise(F.array("p_brand"))
    # every 7th app has no price: to_json drops NULL fields, so the key is
    # absent from its JSON object and must read back as NULL (never a default)
    price = F.when(F.col("p_partkey") % 7 != 0, F.col("p_retailprice"))
    app = F.struct(F.col("p_name").alias("name"), release.alias("release_date"),
                   (F.col("p_size") % 18).alias("required_age"), price.alias("price"),
                   devs.alias("developers"), F.split("p_type", " ").alias("genres"))
    files = p.groupBy("pack").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("p_partkey").cast("string"), app))).alias("m"))
    path = scratch_path(spark, "games")
    files.select(F.to_json("m").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path


@query("json_object_to_rows", sql="""
SELECT p_partkey AS app_id, p_name AS name,
  CASE WHEN p_partkey % 3 = 0 THEN DATE '2020-01-01' + CAST(p_partkey % 1000 AS INTEGER)
       WHEN p_partkey % 3 = 1 THEN CAST(date_trunc('month', DATE '2020-01-01' + CAST(p_partkey % 1000 AS INTEGER)) AS DATE)
  END AS release_date,
  CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END AS developer,
  CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END AS price, CAST(p_size % 18 AS INTEGER) AS required_age
FROM part""")
def json_object_to_rows(spark, sf):
    """Whole-file object -> rows; first developer or NULL; dates."""
    text = spark.read.text(write_game_catalogue(spark, sf), wholetext=True)
    apps = nx.json_object_rows(text, APP_SCHEMA, "app_id")
    return apps.select(F.col("app_id").cast("bigint").alias("app_id"), "name",
                       fx.parse_multi_date("release_date").alias("release_date"),
                       nx.first_or_null("developers").alias("developer"), "price", "required_age")


@query("parse_dates", sql="""
SELECT o_orderkey,
  CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS DATE)
                      WHEN 1 THEN CAST(date_trunc('month', o_orderdate) AS DATE)
                      WHEN 2 THEN CAST(o_orderdate AS DATE) END AS parsed
FROM orders""")
def parse_dates(spark, sf):
    """E17: "MMM d, yyyy" / "MMM yyyy" / ISO / junk -> DATE or NULL, no ANSI error."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey") % 4
    text = (F.when(k == 0, F.date_format("o_orderdate", "MMM d, yyyy"))
            .when(k == 1, F.date_format("o_orderdate", "MMM yyyy"))
            .when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.lit("TBA")))
    return o.select("o_orderkey", fx.parse_multi_date(text).alias("parsed"))


@query("format_ts", sql="""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS ts_minute FROM events""")
def format_ts(spark, sf):
    """Timestamp -> "yyyy-MM-dd HH:mm"."""
    return table(spark, sf, "events").select("event_id", fx.format_minute("ts").alias("ts_minute"))


@query("flatten_struct", sql="""
SELECT user_id AS actor_id, 'user' || user_id AS actor_login,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS repo_id, 'repo/' || json_extract_string(props, '$.k') AS repo_name,
  event_type AS type, ts AS created_at
FROM events""")
def flatten_struct(spark, sf):
    """Nested actor/repo structs -> flat, prefixed columns."""
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    nested = e.select(
        F.struct(F.col("user_id").alias("id"),
                 F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("login")).alias("actor"),
        F.struct(k.cast("int").alias("id"), F.concat(F.lit("repo/"), k).alias("name")).alias("repo"),
        F.col("event_type").alias("type"), F.col("ts").alias("created_at"))
    return nx.flatten_struct(nested)


@query("filter_nested_eq", sql="""
SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) = 42""")
def filter_nested_eq(spark, sf):
    """Equality on a nested struct field."""
    e = table(spark, sf, "events").withColumn("p", F.from_json("props", "k INT"))
    return e.filter(F.col("p.k") == 42).select("event_id", "user_id", F.col("p.k").alias("k"))


@query("like_filter", sql="""
SELECT url LIKE '%example.com%' AS has_com, url LIKE '%#top' AS ends_top, count(*) AS pages
FROM pages GROUP BY ALL""")
def like_filter(spark, sf):
    """LIKE contains / suffix."""
    p = table(spark, sf, "pages")
    return p.groupBy(F.col("url").like("%example.com%").alias("has_com"),
                     F.col("url").like("%#top").alias("ends_top")).agg(F.count(F.lit(1)).alias("pages"))


RLIKE = r"^https://[a-z.]+\.example\.net/[a-z]{2}/[0-9]+"


@query("rlike_filter", sql=f"""
SELECT page_id, url FROM pages WHERE regexp_matches(url, '{RLIKE}')""")
def rlike_filter(spark, sf):
    """Regular-expression match."""
    return table(spark, sf, "pages").filter(F.col("url").rlike(RLIKE)).select("page_id", "url")


@query("text_pattern_count", sql="""
SELECT count(*) AS n_lines FROM (
  SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS line FROM documents)
WHERE contains(line, 'the')""")
def text_pattern_count(spark, sf):
    """Write whole texts as lines, scan them, count lines with a word."""
    path = scratch_path(spark, "text-lines")
    table(spark, sf, "documents").select("text").write.text(path)
    return cl.count_lines_with(spark.read.text(path), "the")


def _cents(c):
    return F.round(F.col(c) * 100).cast("bigint")


@query("json_lines_scan", sql="""
SELECT event_type, count(*) AS n, sum(CAST(round(value * 100) AS BIGINT)) / 100.0 AS total_value
FROM events GROUP BY ALL""")
def json_lines_scan(spark, sf):
    """JSON-lines write (gzip) and glob scan, then an aggregate."""
    path = scratch_path(spark, "json-lines")
    table(spark, sf, "events").write.option("compression", "gzip").json(path)
    e = spark.read.option("multiline", "false").json(f"{path}/*.json.gz")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                       (F.sum(_cents("value")) / 100.0).alias("total_value"))


@query("scan_permissive_json", sql="""
SELECT count(*) FILTER (WHERE event_id % 50 <> 0) AS n_ok, count(*) FILTER (WHERE event_id % 50 = 0) AS n_corrupt,
  count(*) FILTER (WHERE event_id % 50 <> 0) AS n_dropmalformed
FROM events""")
def scan_permissive_json(spark, sf):
    """Corrupt-record modes on a JSON-lines file with broken lines."""
    path = scratch_path(spark, "dirty-json")
    e = table(spark, sf, "events")
    line = F.when(F.col("event_id") % 50 == 0, F.lit("{broken json"))\
        .otherwise(F.to_json(F.struct("event_id", "user_id", "event_type", "value")))
    e.select(line.alias("value")).write.text(path)
    schema = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, _corrupt_record STRING"
    permissive = (spark.read.schema(schema).option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    counts = permissive.agg(F.count_if(F.col("_corrupt_record").isNull() & F.col("event_id").isNotNull()).alias("n_ok"),
                            F.count_if(F.col("_corrupt_record").isNotNull()).alias("n_corrupt"))
    dropped = (spark.read.schema("event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")
               .option("mode", "DROPMALFORMED").json(path).agg(F.count(F.lit(1)).alias("n_dropmalformed")))
    n_drop = dropped.first()[0]
    return counts.withColumn("n_dropmalformed", F.lit(n_drop).cast("bigint"))


DEEP_SQL = """
SELECT l_orderkey, l_linenumber, price FROM (
  SELECT l_orderkey, l_linenumber, l_extendedprice AS price FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_discount * 100 FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_linenumber * 10.0 FROM lineitem)"""


def _deep_docs(li):
    """Nested documents with ``price`` at three depths (store.items[], cart.products[], sale)."""
    doc = li.select(
        "l_orderkey", "l_linenumber",
        F.struct(F.struct(F.array(F.struct(F.col("l_extendedprice").alias("price")),
                                  F.struct(F.col("l_quantity").alias("price"))).alias("items")).alias("store"),
                 F.struct(F.array(F.struct((F.col("l_discount") * 100).alias("price"))).alias("products"),
                          F.col("l_tax").alias("total")).alias("cart"),
                 F.struct((F.col("l_linenumber") * 10.0).alias("price")).alias("sale")).alias("d"))
    return doc.select("l_orderkey", "l_linenumber", "d.*")


@query("json_deep_values", sql=DEEP_SQL)
def json_deep_values(spark, sf):
    """Every ``price`` at any depth of JSON documents ($..price), paths from the schema."""
    path = scratch_path(spark, "deep-json")
    docs = _deep_docs(table(spark, sf, "lineitem"))
    docs.write.json(path)
    # Explicit schema: no inference pass over the documents.
    back = spark.read.schema(docs.schema).json(path)
    return nx.deep_values(back, "price", ["l_orderkey", "l_linenumber"])


@query("json_deep_values_variant", sql=DEEP_SQL)
def json_deep_values_variant(spark, sf):
    """J6 without a schema: the same documents read as plain text lines and
    walked with VARIANT (``parse_json`` + ``variant_explode_outer`` per level)."""
    li = table(spark, sf, "lineitem")
    path = scratch_path(spark, "deep-json-text")
    _deep_docs(li).write.json(path)
    lines = spark.read.text(path)
    v = F.parse_json("value")
    docs = lines.select(F.variant_get(v, "$.l_orderkey", "bigint").alias("l_orderkey"),
                        F.variant_get(v, "$.l_linenumber", "int").alias("l_linenumber"), "value")
    return nx.deep_values_variant(spark, docs, ["l_orderkey", "l_linenumber"], "value", "price")


@query("json_roundtrip", sql="""
SELECT c_custkey, c_mktsegment AS segment, c_acctbal AS balance, c_nationkey AS nation, true AS same
FROM customer""")
def json_roundtrip(spark, sf):
    """Struct -> JSON text -> struct; the round trip is lossless."""
    c = table(spark, sf, "customer")
    prefs = F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
                     F.col("c_nationkey").alias("nation"))
    j = c.select("c_custkey", prefs.alias("orig"), F.to_json(prefs).alias("json"))
    back = j.withColumn("p", F.from_json("json", "segment STRING, balance DOUBLE, nation INT"))
    return back.select("c_custkey", "p.segment", "p.balance", "p.nation",
                       (F.col("p") == F.col("orig")).alias("same"))


@query("matrix_add_max", rnd=(("total", 4),), sql="""
WITH c AS (SELECT vec_id, vec_id // 2 AS i, unnest(range(len(embedding))) AS j, unnest(embedding) AS v
           FROM embeddings),
s AS (SELECT i, j, sum(CAST(v AS DOUBLE)) AS v FROM c GROUP BY i, j)
SELECT count(*) AS n_cells, max(v) AS max_value, sum(v) AS total FROM s""")
def matrix_add_max(spark, sf):
    """Two matrices (even / odd vectors) as coordinates, summed, then max."""
    emb = table(spark, sf, "embeddings")
    coords = emb.select("vec_id", (F.col("vec_id") / 2).cast("bigint").alias("row"), "embedding")
    a = nx.to_coordinates(coords.filter(F.col("vec_id") % 2 == 0), "row", "embedding")
    b = nx.to_coordinates(coords.filter(F.col("vec_id") % 2 == 1), "row", "embedding")
    m = nx.matrix_add(a, b)
    return m.agg(F.count(F.lit(1)).alias("n_cells"), F.max("v").alias("max_value"), F.sum("v").alias("total"))
