"""Operator 2, SimHash near-duplicates: pigeonhole blocks, join, Hamming check.

A 64-bit fingerprint is cut into ``max_bits + 3`` blocks.  Two fingerprints
within ``max_bits`` bits agree on at least three whole blocks, so rows keyed by
every choice of three blocks (some 38 bits) bring them together; the join is
verified by Hamming distance.

Only distinct fingerprints are joined, so copies never multiply.  A block value
shared by more than ``pair_limit`` distinct fingerprints is not paired off:
its members are keyed by every fingerprint within half the distance instead
(two fingerprints are within 2 bits exactly if they have a neighbour at 1 bit
in common) and link to the smallest member of each key, which keeps the
components whole with rows in proportion to the members.  Components are
found by ``connected_components`` on shared storage.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import connected_components, materialized, utf8

SHINGLE, MAX_BITS, SEED, PAIR_LIMIT = 3, 2, 42, 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of lower-cased (A-Z) word shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(words[i:i + shingle]), SEED) for i in range(n)), np.dtype("<u8"), n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(doc_id, h, fp): ``h`` tells rows that repeat an id with another text apart."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(utf8(t.as_py()), shingle) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "h", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), _text_hash(text).alias("h"),
                       F.col(text).alias("text")).mapInArrow(of, "doc_id long, h long, fp long")


def _text_hash(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks(max_bits: int) -> list[int]:
    blocks = max_bits + 3
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    part = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [_signed(part[a] | part[b] | part[c]) for a, b, c in combinations(range(blocks), 3)]


def close_pairs(fps: DataFrame, max_bits: int = MAX_BITS, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """(a, b) links among distinct fingerprints ``fp``: every pair within
    ``max_bits`` is linked, directly or through links as close."""
    if max_bits % 2:
        raise ValueError("max_bits must be even: crowded blocks are split by half the distance")
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in _masks(max_bits)]))
                       .alias("mask", "key"))
    shared = keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = materialized(keyed.join(shared, ["mask", "key"]), "blocks")
    few = members.filter(F.col("n") <= pair_limit)
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = (few.select("mask", "key", F.col("fp").alias("a"))
             .join(few.select("mask", "key", F.col("fp").alias("b")), ["mask", "key"])
             .filter((F.col("a") < F.col("b")) & close).select("a", "b"))
    flips = [0] + [_signed(sum(1 << i for i in bits)) for r in range(1, max_bits // 2 + 1)
                   for bits in combinations(range(64), r)]
    near = (members.filter(F.col("n") > pair_limit).select("fp").distinct()
            .select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(x)) for x in flips])).alias("key")))
    least = near.groupBy("key").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    hubs = near.join(least, "key").select(F.col("fp").alias("a"), "b").filter(F.col("a") != F.col("b")).filter(close)
    return pairs.union(hubs).distinct()


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                       max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: doc_id, h (hash of the text), fp (long), group (one
    value per component), component_id (smallest doc_id of the component).

    Null, empty and blank texts have fingerprint 0 and link like any other.  A
    null doc_id is the smallest only where all of its component are null.
    Repeated rows stay, in one component.  An empty table gives no rows.
    Other columns are ignored, whatever their names.
    """
    rows = materialized(_fingerprints(docs, doc_id, text, shingle), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    parts = connected_components(close_pairs(distinct.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    named = materialized(distinct.join(parts, "fp", "left")
                         .select("fp", "least", F.coalesce("component", "fp").alias("group")), "groups")
    lows = named.groupBy("group").agg(F.min("least").alias("component_id"))
    named = named.join(lows, "group").select("fp", "group", "component_id")
    return (rows.join(named, "fp")
            .select(F.col("doc_id").alias(doc_id), "h", "fp", "group", "component_id"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id.

    Where rows repeat that id within the component, the one with the smallest
    text hash stays, once; a component without ids keeps one row.
    """
    groups = simhash_components(docs, doc_id, text, shingle, max_bits)
    first = groups.groupBy("group").agg(F.min(F.struct(
        F.col(doc_id).isNull().alias("_none"), F.coalesce(doc_id, F.lit(0)).alias("_id"), F.col("h").alias("_h"))).alias("s"))
    key = ["_none", "_id", "_h"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(doc_id).isNull().alias("_none"),
                       F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("_id"), _text_hash(text).alias("_h"))
    return rows.dropDuplicates(key).join(first.select("s.*"), key, "left_semi").select("_row.*")
