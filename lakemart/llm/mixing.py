"""Operator 8, mixing sources to target weights: a low-discrepancy schedule.

The schedule is a sequence of slots, about ``BLOCK_WORDS`` words each.  Slot
``i`` takes the golden-ratio point ``frac((i + 1) * phi)``, which falls into one
source's interval of the cumulative targets.  Each source's documents are
shuffled (by a hash), laid end to end and cut into blocks of equal words, as
many as its target asks for; the source's slots are ranked, and its ``k``-th slot
takes block ``k mod blocks``.  Slots and blocks are joined: a document is taken
as often as its words lie in taken blocks, and its first slot says when.

A source too small for the points of its interval to be its target (fewer than
``LEAST_SLOTS``) has slots of its own at van der Corput points, spread evenly.

Slots are made where they are counted: a row of the schedule stands for 65,536
slots, and the ranks before it follow from an exact count of the points below a
bound (a floor sum), so no slot is collected, sorted or shifted.  Documents are
sorted by ranges, with prefix sums over ranges, so one source, or rows that
repeat one id, may hold any share of the table.  Texts are read once, to count
their words, and not sorted.  Only the sources' names and sizes reach the
driver: a mix states a weight for each source, so their number is bounded by
what the caller configures.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.llm.common import broadcast_if_small, materialized, partitions_for

GOLDEN = np.uint64(0x9E3779B97F4A7C15)      # frac(phi) * 2**64
BLOCK_WORDS = 1000
LEAST_SLOTS = 256
SLOT_RANGE = 1 << 16
MAX_EPOCHS = 3


def cycle_weights(names: list[str | None], cycle=(5, 2, 1)) -> dict[str | None, float]:
    """Sources by code point, null last, weigh 5, 2, 1, repeating."""
    ordered = sorted((n for n in names if n is not None), key=lambda n: [ord(c) for c in n])
    ordered += [None] if None in names else []
    return {n: float(cycle[i % len(cycle)]) for i, n in enumerate(ordered)}


def target_sizes(sizes: dict[str | None, int], weights: dict[str | None, float],
                 epochs: int = MAX_EPOCHS) -> dict[str | None, float]:
    """Share all sizes by weight; a target stops at ``epochs`` times its source,
    the excess is reshared among the others until none is above."""
    total, capped, free = float(sum(sizes.values())), {}, dict(weights)
    while free:
        rest, share = total - sum(capped.values()), sum(free.values())
        target = {n: rest * w / share for n, w in free.items()}
        above = [n for n, t in target.items() if t > epochs * sizes[n]]
        if not above:
            return capped | target
        for n in above:
            capped[n] = float(epochs * sizes[n])
            del free[n]
    return capped


def _floor_sum(n: int, m: int, a: int, b: int) -> int:
    """Sum of ``(a * i + b) // m`` for ``i`` below ``n``, by Euclid's steps."""
    total = 0
    while n:
        total += n * (n - 1) // 2 * (a // m) + n * (b // m)
        a, b = a % m, b % m
        n, b = divmod(a * n + b, m)
        m, a = a, m
    return total


def _slots_below(point: int, slots: int) -> int:
    """How many of the first ``slots`` golden-ratio points lie below ``point`` (of 2**64)."""
    whole, step = 1 << 64, int(GOLDEN)
    return _floor_sum(slots, whole, step, step) + slots - _floor_sum(slots, whole, step, step - point + whole)


@dataclass
class Source:
    """A source of the schedule: its interval of points, its slots, its blocks."""

    name: str | None
    size: int
    target: float
    low: int                    # points from low up to high (of 2**64) are its slots
    high: int
    slots: int
    blocks: int
    own: bool                   # its slots are van der Corput points, not those of its interval


def plan(sizes: dict[str | None, int], targets: dict[str | None, float], block_words: int = BLOCK_WORDS,
         epochs: int = MAX_EPOCHS) -> tuple[int, list[Source]]:
    """(slots of the schedule, its sources).  A source's blocks are so many that
    its slots, each a block, make its target: slots / blocks is target / size."""
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    total = sum(targets.values())
    slots = math.ceil(total / block_words)
    ends = np.minimum(np.cumsum([targets[n] for n in names]) / max(1.0, total) * 2.0 ** 64, 2.0 ** 64 - 2048)
    bounds = [0, *(int(e) for e in ends[:-1].astype(np.uint64)), 1 << 64] if names else [0]
    out = []
    for name, low, high in zip(names, bounds, bounds[1:], strict=False):
        size, target = sizes[name], targets[name]
        below = [slots if b == 1 << 64 else _slots_below(b, slots) for b in (low, high)]
        n, least = below[1] - below[0], min(LEAST_SLOTS, math.ceil(target))
        own = n < least
        n = least if own else n
        # no block more often than epochs times, none without a word
        blocks = min(size, max(1, round(n * size / target), math.ceil(n / epochs))) if n and size else 0
        out.append(Source(name, size, target, low, high, min(n, epochs * blocks), blocks, own))
    return slots, out


def schedule(spark: SparkSession, slots: int, sources: list[Source]) -> DataFrame:
    """The slots (slot, source, rank, block): ``source`` numbers ``sources``."""
    bounds = np.array([s.high for s in sources[:-1]], np.uint64)
    shared = np.array([not s.own for s in sources])
    blocks = np.array([max(1, s.blocks) for s in sources], np.int64)
    limit = np.array([s.slots for s in sources], np.int64)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.column(0).to_pylist():
                first = r * SLOT_RANGE
                slot = np.arange(first, min(first + SLOT_RANGE, slots), dtype=np.int64)
                point = (slot.astype(np.uint64) + np.uint64(1)) * GOLDEN
                source = np.searchsorted(bounds, point, side="right")
                # ranks within the range, shifted by the slots of the source before it
                order = np.argsort(source, kind="stable")
                start = np.searchsorted(source[order], np.arange(len(sources)))
                before = [0, *(_slots_below(int(b), first) for b in bounds), first]
                rank = np.empty(len(slot), np.int64)
                rank[order] = np.arange(len(slot)) + (np.diff(before) - start)[source[order]]
                keep = shared[source] & (rank < limit[source])
                slot, source, rank = slot[keep], source[keep], rank[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array(source.astype(np.int32)), pa.array(rank), pa.array(rank % blocks[source])],
                    names=["slot", "source", "rank", "block"])

    schema = "slot long, source int, rank long, block long"
    out = spark.range(math.ceil(slots / SLOT_RANGE)).mapInArrow(of, schema)
    small = [(i, s.slots, s.blocks) for i, s in enumerate(sources) if s.own and s.slots]
    if small:
        bits = LEAST_SLOTS.bit_length() - 1
        # the digits of a number of so many bits, mirrored at the point, are its van der Corput fraction
        mirrored = F.conv(F.reverse(F.lpad(F.bin("rank"), bits, "0")), 2, 10).cast("long")
        own = (spark.createDataFrame(small, "source int, slots long, blocks long")
               .select("source", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("rank"))
               .select(F.floor(mirrored * slots / (1 << bits)).alias("slot"), "source", "rank", (F.col("rank") % F.col("blocks")).alias("block")))
        out = out.unionByName(own)
    return out


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the words before them in their range and source."""
    source, total = object(), 0
    for batch in batches:
        names, size = batch.column("_source").to_pylist(), batch.column("_size").to_numpy()
        if not names:
            continue
        before = np.cumsum(size) - size
        cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
        local = np.empty(len(names), np.int64)
        for a, b in zip(cuts, cuts[1:], strict=False):
            total = total if names[a] == source else 0
            local[a:b] = before[a:b] - before[a] + total
            source, total = names[a], int(local[b - 1] + size[b - 1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local)], names=[*batch.schema.names, "_local"])


def placed(sized: DataFrame) -> DataFrame:
    """Rows (_id, _source, _size, _hash, _tie) with _start: the words before them in
    their shuffled source.  ``_tie`` only deals rows apart that are equal otherwise."""
    keys = ["_source", "_hash", "_id", "_size", "_tie"]
    rows = (sized.repartitionByRange(partitions_for(sized), *keys).sortWithinPartitions(*keys)
            .withColumn("_range", F.spark_partition_id()))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    rows = materialized(rows.mapInArrow(_running, f"{types}, _local long"), "mix-rows")
    before = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("_source", "_range").agg(F.sum("_size").alias("n")).select(
        "_source", "_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    a, b = rows.alias("a"), broadcast_if_small(materialized(ranges, "mix-ranges"), 64).alias("b")
    return a.join(b, F.col("a._source").eqNullSafe(F.col("b._source")) & (F.col("a._range") == F.col("b._range"))).select(
        "a.*", (F.col("_local") + F.col("_offset")).alias("_start"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _wide(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def mix_sources(docs: DataFrame, weigh: Callable[[list], dict] = cycle_weights, doc_id: str = "doc_id",
                text: str = "text", source: str = "source", block_words: int = BLOCK_WORDS,
                epochs: int = MAX_EPOCHS, seed: int = 8, keep: tuple = ()) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, taken, first_slot.

    ``size`` counts the words of the whole text (null or blank: 0); ``taken``
    is the words the mix takes, repeats counted, at most ``epochs * size``;
    ``first_slot`` is the place in the schedule at which the document first comes
    up (null if it is not taken).  ``keep`` names further columns to carry along:
    they are written beside the sizes, and meet the result in the last join only.

    A null source is a source.  Repeated rows are documents of their own; rows
    equal in id and size are interchangeable.  A source without words, and a
    document without words, is taken 0 times.  An empty table gives no rows.
    Other columns are ignored, whatever their names.  The order within a
    source depends on ids and sizes alone, so reruns agree.
    """
    spark = docs.sparkSession
    sized = materialized(docs.select(
        F.col(doc_id).alias("_id"), F.col(source).cast("string").alias("_source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long").alias("_size"),
        F.xxhash64(F.lit(seed), F.col(doc_id)).alias("_hash"), F.monotonically_increasing_id().alias("_tie"),
        F.struct(F.lit(0).alias("_none"), *keep).alias("_keep")), "mix-sizes")
    sizes = {r["_source"]: int(r["n"]) for r in
             sized.groupBy("_source").agg(F.sum("_size").alias("n")).collect()}
    targets = target_sizes(sizes, weigh(list(sizes)), epochs)
    slots, sources = plan(sizes, targets, block_words, epochs)
    takes = schedule(spark, slots, sources).groupBy("source", "block").agg(
        F.count(F.lit(1)).alias("times"), F.min("slot").alias("first_slot"))
    facts = F.broadcast(spark.createDataFrame(          # a row per source
        [(s.name, i, s.size, float(s.target), s.blocks) for i, s in enumerate(sources)],
        "name string, number int, source_size long, target double, blocks long"))
    rows = placed(sized.drop("_keep")).join(facts, F.col("_source").eqNullSafe(F.col("name")))

    # blocks that a document's words lie in: block j of b begins at word floor(j * size / b)
    size, blocks = _wide(F.col("source_size")), _wide(F.col("blocks"))

    def block_of(word: Column) -> Column:
        return _div(_wide(word + 1) * blocks - 1, size)

    def begin_of(block: Column) -> Column:
        return _div(_wide(block) * size, blocks)

    start, end = F.col("_start"), F.col("_start") + F.col("_size")
    pieces = (rows.filter("_size > 0 AND blocks > 0")
              .withColumn("block", F.explode(F.sequence(block_of(start), block_of(end - 1))))
              .select("_tie", F.col("number").alias("source"), "block",
                      (F.least(end, begin_of(F.col("block") + 1)) - F.greatest(start, begin_of(F.col("block")))).alias("words")))
    taken = materialized(pieces.join(takes, ["source", "block"]).groupBy("_tie").agg(
        F.sum(F.col("words") * F.col("times")).alias("taken"), F.min("first_slot").alias("first_slot")), "mix-taken")
    return (sized.join(facts, F.col("_source").eqNullSafe(F.col("name"))).join(broadcast_if_small(taken, 24), "_tie", "left")
            .select(F.col("_id").alias(doc_id), F.col("_source").alias(source), F.col("_size").alias("size"),
                    "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot",
                    *[F.col("_keep")[k].alias(k) for k in keep]))
