"""Nested data: structs, arrays, JSON documents, coordinate matrices (§2 J).

All operators are schema-driven column expressions (``explode``,
``from_json``, struct field access) — no Python parsing of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Replace every struct column by its leaves, ``parent_child`` names."""
    def leaves(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from leaves(f.dataType, path + [f.name])
        else:
            yield path
    cols = []
    for f in df.schema.fields:
        for path in leaves(f.dataType, [f.name]):
            cols.append(F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)))
    return df.select(cols)


def explode_chats(doc: DataFrame) -> DataFrame:
    """Chats.list[] -> chat, then chat.messages[] -> message, keeping parent
    fields.  Chats with an empty ``messages`` array produce no rows (explode).
    ``text`` read as a string may hold a JSON array of pieces (F15); it is
    joined back into one string."""
    chats = doc.select(F.explode("chats.list").alias("chat"))
    msgs = chats.select(
        F.col("chat.id").alias("chat_id"), F.col("chat.name").alias("chat_name"),
        F.col("chat.type").alias("chat_type"), F.explode("chat.messages").alias("m"))
    return msgs.select("chat_id", "chat_name", "chat_type",
                       F.col("m.id").alias("message_id"), F.col("m.date").alias("date"),
                       F.col("m.from").alias("from"), F.col("m.from_id").alias("from_id"),
                       text_of(F.col("m.text")).alias("text"), F.col("m.type").alias("type"))


def text_of(c: str | Column) -> Column:
    """a chat ``text`` that may be a string or an array of pieces -> string.

    Given a VARIANT/JSON string, arrays are joined; plain strings pass.
    """
    col = F.col(c) if isinstance(c, str) else c
    arr = F.from_json(col, "array<string>")
    # a plain text that merely starts with "[" is kept as it is
    return F.when(F.trim(col).startswith("["), F.coalesce(F.array_join(arr, ""), col)).otherwise(col)


def json_object_rows(text: DataFrame, value_schema: str, key_name: str = "key") -> DataFrame:
    """A whole-file JSON object ``{key: {...}, ...}`` -> one row per key.

    ``value`` is read with ``wholetext=True``; ``from_json`` with a
    ``map<string, struct>`` schema turns missing fields into NULL (never into
    a placeholder) and ``explode`` yields (key, value) rows.  Each file is one
    task, so producers of such objects should bound their files in bytes
    (``sources.files.pack_by_bytes``).
    """
    parsed = text.select(F.explode(F.from_json("value", f"map<string, {value_schema}>")).alias(key_name, "v"))
    return parsed.select(key_name, "v.*")


def first_or_null(c: str | Column) -> Column:
    """First array element or NULL (also for empty / NULL arrays)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_element_at(col, F.lit(1))


def paths_ending_in(dtype: T.DataType, key: str, path: str = "") -> list[tuple[str, int]]:
    """All field paths whose last name is ``key``; the int counts array levels."""
    out = []
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            p = f"{path}.{f.name}" if path else f.name
            if f.name == key and not isinstance(f.dataType, (T.StructType, T.ArrayType)):
                out.append((p, 0))
            out.extend(paths_ending_in(f.dataType, key, p))
    elif isinstance(dtype, T.ArrayType):
        for p, depth in paths_ending_in(dtype.elementType, key, ""):
            out.append((f"{path}[]{'.' + p if p else ''}", depth + 1))
    return out


def _values_at(path: str) -> Column:
    """Array of every value at a path that may cross arrays (``a.items[].price``)."""
    parts = path.split("[]")
    expr = F.col(parts[0])
    if len(parts) == 1:
        return F.array(expr)
    def getter(field):
        return (lambda x: x.getField(field)) if field else (lambda x: x)

    for i, rest in enumerate(parts[1:]):
        step = F.transform(expr, getter(rest.lstrip(".")))
        expr = step if i == len(parts) - 2 else F.flatten(step)
    return expr


def deep_values(df: DataFrame, key: str, id_cols: list[str]) -> DataFrame:
    """``$..key`` — every value of ``key`` at any depth, one row each.

    Spark's JSONPath has no recursive descent, so the paths are found from the
    schema and each becomes an array expression; the arrays are concatenated
    and exploded (row-local, no shuffle).
    """
    paths = paths_ending_in(df.schema, key)
    none = F.array().cast("array<double>")      # a document without a path keeps its other values
    allv = F.concat(none, *[F.coalesce(_values_at(p).cast("array<double>"), none) for p, _ in paths])
    return df.select(*id_cols, F.explode(F.filter(allv, lambda x: x.isNotNull())).alias(key))


def to_coordinates(df: DataFrame, row_col: str, vec_col: str) -> DataFrame:
    """Dense vectors -> (i, j, v) coordinate rows via ``posexplode``."""
    return df.select(F.col(row_col).alias("i"), F.posexplode(vec_col).alias("j", "v"))


def matrix_add(a: DataFrame, b: DataFrame) -> DataFrame:
    """Element-wise sum of two coordinate matrices (a missing cell is 0).

    Union + ``groupBy(i, j).sum``: one hash aggregation instead of a
    full-outer sort-merge join; each cell group holds at most two rows.
    """
    cells = a.select("i", "j", F.col("v").cast("double").alias("v")).unionByName(
        b.select("i", "j", F.col("v").cast("double").alias("v")))
    return cells.groupBy("i", "j").agg(F.sum("v").alias("v"))


#: Levels of a document walked between two writes of what is open.
LEVELS = 4


def deep_values_variant(spark, df: DataFrame, id_cols: list[str], json_col: str, key: str) -> DataFrame:
    """J6 over JSON of *any* shape: ``$..key`` with the VARIANT type.

    Documents are parsed once (``parse_json``) and walked ``LEVELS`` levels per
    round in one job: at each level ``variant_explode_outer`` opens the values
    that are no hit, and passes hits on.  A round writes once to shared storage
    (a lost executor recomputes one round): ``found`` holds a scalar whose key
    matches, ``open`` an object or array for the next round; both are then read
    from there.  Rounds end with the documents' nesting depth.  All the work is
    distributed: nothing but a count is collected.
    """
    import uuid

    from lakemart.session import scratch_path
    ids = ", ".join(f"`{c}`" for c in id_cols)
    frontier = df.select(*id_cols, F.parse_json(json_col).alias("open"))
    out = None
    while True:
        level = frontier.withColumn("found", F.lit(None).cast("double"))
        views = []
        for _ in range(LEVELS):
            views.append(f"lakemart_variant_{uuid.uuid4().hex[:12]}")
            level.createOrReplaceTempView(views[-1])
            level = spark.sql(f"SELECT {ids}, found AS hit, e.key AS k, e.value AS v "
                              f"FROM {views[-1]}, LATERAL variant_explode_outer(open) AS e")
            # an object or array is no number; a scalar that stays open has nothing inside
            hit = F.coalesce("hit", F.when(F.col("k") == key, F.try_variant_get("v", "$", "double")))
            level = (level.select(*id_cols, "v", hit.alias("found"))
                     .select(*id_cols, F.when(F.col("found").isNull(), F.col("v")).alias("open"), "found")
                     .filter(F.col("open").isNotNull() | F.col("found").isNotNull()))
        kind = F.schema_of_variant("open")
        container = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        tagged = level.withColumn("open", F.when(F.col("open").isNotNull() & container, F.col("open")))
        tagged = tagged.filter(F.col("open").isNotNull() | F.col("found").isNotNull())
        path = scratch_path(spark, "variant-level")
        tagged.write.parquet(path)
        for view in views:
            spark.catalog.dropTempView(view)
        back = spark.read.schema(tagged.schema).parquet(path)
        part = back.filter(F.col("found").isNotNull()).select(*id_cols, F.col("found").alias(key))
        out = part if out is None else out.unionByName(part)
        if not back.agg(F.count("open")).first()[0]:
            return out
        frontier = back.filter(F.col("open").isNotNull()).select(*id_cols, "open")
