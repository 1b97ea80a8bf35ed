"""Helpers shared by the operators: words, small column idioms, packed blobs."""

from __future__ import annotations

import numpy as np
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but space, tab, line feed, vertical tab, form
#: feed and carriage return: what ``bytes.split()`` yields on UTF-8.
WS = r"[ \t\n\x0B\f\r]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A testdata-style table, read by Spark alone (any Hadoop file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it
    (where it is installed on the executors, this changes nothing)."""
    import os
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder: lineage cut that
    survives lost executors."""
    from lakemart.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (bound to a lambda)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_array(text: Column) -> Column:
    """Words of a text as an array; null and blank texts give an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WS), lambda w: w != F.lit(""))


def utf8(text) -> bytes:
    """UTF-8 bytes of a pandas cell; null is empty."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def buckets_for(spark: SparkSession, per_partition: int = 4) -> int:
    """How many hash buckets to deal work into: a few per shuffle partition,
    so it follows the one setting a cluster sizes with its data."""
    return per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))


class WordHashes(dict):
    """Word bytes -> 64-bit hash, memoised; emptied when it grows past ``bound``."""

    def __init__(self, seed: int = 0, bound: int = 500_000):
        super().__init__()
        self.seed, self.bound = seed, bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), so that orders of hashes are unrelated."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each run of ``width`` consecutive values (doubling)."""
    if len(x) < width:
        return x[:0]
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def pack(*parts, level: int = 3) -> bytes:
    """Arrays and byte strings in one blob, each compressed by itself (see ``unpack``)."""
    squeeze = zstandard.ZstdCompressor(level=level).compress
    raw = [squeeze(p.tobytes() if isinstance(p, np.ndarray) else p) for p in parts]
    return np.array([len(raw), *map(len, raw)], np.int64).tobytes() + b"".join(raw)


def unpack(blob: bytes) -> list[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    sizes = np.frombuffer(blob, np.int64, n, 8)
    ends = 8 * (n + 1) + np.cumsum(sizes)
    return [expand(blob[int(e - s):int(e)]) for s, e in zip(sizes, ends, strict=True)]


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read
    back: computed once, survives lost executors, removed when the application
    ends."""
    import uuid

    from lakemart.session import checkpoint_root
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; component: its smallest node.

    Large-star and small-star rounds: every node links to the smallest node it
    sees, so paths shorten geometrically and the links end as stars.  Each
    round is written to shared storage; the driver sees one count per round.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    pairs, mark = materialized(pairs, "links"), None
    while True:
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = now
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v")))).distinct()
        pairs = materialized(small, "links")


#: Rows that a join may broadcast: only below this many bytes, by exact count.
BROADCAST_BYTES = 8 << 20


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows stay below ``limit``
    bytes, else as it is (Spark then shuffles and splits hot keys).  Meant for
    tables already written: they are counted by one cheap job."""
    return F.broadcast(df) if df.limit(limit // row_bytes + 1).count() * row_bytes <= limit else df


def partitions_for(df: DataFrame, bytes_each: int = 64 << 20) -> int:
    """Partitions by the input's size in bytes (Spark's estimate of the scan),
    at least as many as the session shuffles to."""
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, size // bytes_each) if size < 1 << 60 else least


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Written rows of ``df`` with pos (0, 1, ... by ``order`` within ``group``), size
    (rows of the group) and first (a number of the group, ascending as groups do;
    nulls come first).  No group lies in one task: rows are sorted by ranges, and
    what a range adds is counted per range.  Equal rows are dealt apart.
    """
    keys = [*group, *order]
    rows = (df.withColumn("tie_", F.monotonically_increasing_id())
            .repartitionByRange(partitions_for(df), *keys, "tie_").sortWithinPartitions(*keys, "tie_").drop("tie_")
            .withColumn("id_", F.monotonically_increasing_id()))
    rows = materialized(rows, name).withColumn("range_", F.shiftright("id_", 33))
    ranges = rows.groupBy(*group, "range_").agg(F.min("id_").alias("low_"), F.count(F.lit(1)).alias("n_"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = whole.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(*group, "range_", "low_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("before_"),
                           F.sum("n_").over(whole).alias("size"), F.min("low_").over(whole).alias("first"))
    match = F.col("a.range_") == F.col("b.range_")
    for g in group:
        match &= F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    return rows.alias("a").join(ranges.alias("b"), match).select(
        *[F.col(f"a.`{c}`") for c in df.columns], (F.col("id_") - F.col("low_") + F.col("before_")).alias("pos"),
        "size", "first")
