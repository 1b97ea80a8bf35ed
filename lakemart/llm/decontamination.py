"""Operator 10, benchmark decontamination: size-partitioned MinHash containment.

Test items are short, documents long, so a whole document's MinHash says little
about containment.  Items are partitioned by size (shingle counts up to 8, 16,
32, ...); for a partition of size ``s`` a document is searched in windows of
``2 s`` shingles, ``s`` apart, whose Jaccard similarity with a contained item is
at least about 0.2.  A window and an item that agree on one of ``K`` minima are
a candidate; candidates are verified by exact containment of word shingles in
the whole document.  A containment of 0.8 is missed with a probability below
(1 - 0.19) ** K, some 1e-6 for K = 64.  Items of at most 4 shingles are far
smaller than any window; they are candidates wherever one of their shingles is.

Window minima come from block minima, merged upwards from size to size, so each
shingle is hashed once for all partitions.  Documents are only scanned, never
shuffled.  Items are the query set: they go to the tasks in blocks of bounded
size, one scan each, however many there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import WordHashes, mix64, utf8

SHINGLE, CONTAINMENT, MINIMA, SMALLEST = 5, 0.8, 64, 8
EXACT = SMALLEST // 2       # items of so many shingles are looked up shingle by shingle
BLOCK_ITEMS = 4096          # items sent to the tasks at once
CELLS = 1 << 20             # prefilter of signature values
CHUNK = 1 << 14             # shingles hashed at once


def normal_words(text) -> list[bytes]:
    """Words of a text, A-Z lower-cased; null has none."""
    return utf8(text).lower().split()


def shingle_set(words: list[bytes], n: int) -> set[bytes]:
    return {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` words."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(hashes) - n + 1, np.uint64)
        for k in range(n):
            out = out * np.uint64(0x100000001B3) + hashes[k:len(hashes) - n + 1 + k]
        return mix64(out + np.uint64(n))


def _multipliers(minima: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(b"minimum", k) | 1 for k in range(minima)], np.uint64)


def _minima(shingles: np.ndarray, multipliers: np.ndarray, block: int) -> np.ndarray:
    """Minimum of each hash function over blocks of ``block`` shingles.

    A block of more than ``CHUNK`` shingles is the minimum of its chunks' minima.
    """
    if block > CHUNK:
        return np.concatenate([_minima(shingles[at:at + block], multipliers, CHUNK).min(axis=1, keepdims=True)
                               for at in range(0, len(shingles), block)], axis=1)
    out = []
    step = CHUNK // block * block
    for at in range(0, len(shingles), step):
        part = shingles[at:at + step]
        with np.errstate(over="ignore"):
            values = multipliers[:, None] * part[None, :]
        out.append(np.minimum.reduceat(values, np.arange(0, len(part), block), axis=1))
    return np.concatenate(out, axis=1)


def _pairs_of(x: np.ndarray, combine) -> np.ndarray:
    """Adjacent columns combined two by two; a last odd one stays."""
    if x.shape[1] % 2:
        return np.concatenate([combine(x[:, :-1:2], x[:, 1::2]), x[:, -1:]], axis=1)
    return combine(x[:, ::2], x[:, 1::2])


class ItemIndex:
    """Signatures of a block of items, by size partition."""

    def __init__(self, items: list[tuple[int, str]], shingle: int, minima: int):
        self.shingle, self.multipliers = shingle, _multipliers(minima)
        hashes = WordHashes()
        self.items = []                         # (item_id, width, shingles)
        sizes: dict[int, list] = {}             # partition -> [(values, item)]
        short: dict[int, list] = {}             # width -> [(shingles, item)] of items up to EXACT shingles
        for item_id, text in items:
            words = normal_words(text)
            if not words:
                continue
            width = min(shingle, len(words))
            self.items.append((item_id, width, shingle_set(words, width)))
            h = np.unique(shingle_hashes(hashes.array(words), width))
            at = len(self.items) - 1
            if len(h) <= EXACT:
                short.setdefault(width, []).append((h, at))
            else:
                size = max(SMALLEST, 1 << (len(h) - 1).bit_length())
                sizes.setdefault(size, []).append((_minima(h, self.multipliers, len(h))[:, 0], at))
        self.sizes = {s: self._lookup(v) for s, v in sorted(sizes.items())}
        self.short = {w: self._lookup(v) for w, v in short.items()}

    @staticmethod
    def _lookup(entries: list) -> tuple:
        values = np.concatenate([v for v, _ in entries])
        owner = np.concatenate([np.full(len(v), at) for v, at in entries])
        order = np.argsort(values, kind="stable")
        cells = np.zeros(CELLS, bool)
        cells[values >> np.uint64(44)] = True
        return values[order], owner[order], cells

    @staticmethod
    def _matching(values: np.ndarray, lookup: tuple) -> set[int]:
        known, owner, cells = lookup
        values = values[cells[(values >> np.uint64(44)).astype(np.int64)]]
        low, high = np.searchsorted(known, values, "left"), np.searchsorted(known, values, "right")
        return {int(o) for a, b in zip(low[high > low], high[high > low], strict=True) for o in owner[a:b]}

    def candidates(self, hashes: np.ndarray) -> set[int]:
        found: set[int] = set()
        for width, lookup in self.short.items():
            found |= self._matching(shingle_hashes(hashes, width), lookup)
        shingles = shingle_hashes(hashes, self.shingle)
        if not len(shingles) or not self.sizes:
            return found
        size = min(self.sizes)
        blocks = _minima(shingles, self.multipliers, size)
        for s, lookup in self.sizes.items():
            while size < s:
                blocks, size = _pairs_of(blocks, np.minimum), size * 2
            windows = np.minimum(blocks[:, :-1], blocks[:, 1:]) if blocks.shape[1] > 1 else blocks
            found |= self._matching(windows.ravel(), lookup)
        return found

    def search(self, words: list[bytes], hashes: np.ndarray, containment: float) -> list[tuple[int, int, int]]:
        """(item_id, shared shingles, item's shingles) of the items contained."""
        sets: dict[int, set[bytes]] = {}
        out = []
        for at in sorted(self.candidates(hashes)):
            item_id, width, shingles = self.items[at]
            if width not in sets:
                sets[width] = shingle_set(words, width)
            shared = len(shingles & sets[width])
            if shared >= containment * len(shingles):
                out.append((item_id, shared, len(shingles)))
        return out


def contained_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    item_id: str = "item_id", item_text: str = "text", shingle: int = SHINGLE,
                    containment: float = CONTAINMENT, minima: int = MINIMA,
                    block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(doc_id, h, item_id, n_shared, n_shingles, containment) of every item whose
    distinct ``shingle``-word shingles lie to ``containment`` or more in a document.

    ``h`` is a hash of the text, which tells rows repeating an id apart.  An
    item of fewer words is one shingle of all its words; an item without words
    is in no document.  Null texts have no words.  Repeated documents give
    their rows each; items repeating an id and text give their rows each; a null id is
    kept.  Empty tables give no rows.  Other columns are ignored.
    """
    spark = docs.sparkSession
    items = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t"))
    n_blocks = max(1, math.ceil(items.count() / block_items))
    block_of = F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"), F.col(text).alias("text"))
    found = None
    for block in range(n_blocks):
        index = spark.sparkContext.broadcast(
            ItemIndex([tuple(r) for r in items.filter(block_of == block).collect()], shingle, minima))
        hits = rows.mapInArrow(_searcher(index, containment),
                               "doc_id long, h long, item_id long, n_shared long, n_shingles long")
        found = hits if found is None else found.union(hits)
    return found.select(F.col("doc_id").alias(doc_id), "h", F.col("item_id"), "n_shared", "n_shingles",
                        (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def _searcher(index, containment: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        types = [pa.int64()] * 5
        for batch in batches:
            out = []
            for doc_id, h, text in zip(*batch.columns, strict=True):
                words = normal_words(text.as_py())
                for hit in index.value.search(words, hashes.array(words), containment):
                    out.append((doc_id.as_py(), h.as_py(), *hit))
            columns = zip(*out, strict=True) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=["doc_id", "h", "item_id", "n_shared", "n_shingles"])
    return search


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``docs`` without the rows that contain an item."""
    hits = contained_items(docs, items, doc_id, text, **kw).select(F.col(doc_id).alias("_id"), F.col("h").alias("_h")).distinct()
    own = F.xxhash64(F.coalesce(F.col(f"d.`{text}`"), F.lit("")))
    return docs.alias("d").join(hits, F.col(f"d.`{doc_id}`").cast("long").eqNullSafe(F.col("_id"))
                                & (own == F.col("_h")), "left_anti")


_WORDS = r"list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '')"
ORACLE_SQL = rf"""
WITH i AS (SELECT row_number() OVER () AS n, item_id, {_WORDS} AS w FROM benchmark),
k AS (SELECT n, item_id, w, least({SHINGLE}, len(w)) AS width FROM i WHERE len(w) > 0),
s AS (SELECT DISTINCT n, item_id, width, array_to_string(w[p:p + width - 1], ' ') AS sh
      FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS p FROM k)),
c AS (SELECT n, count(*) AS n_shingles FROM s GROUP BY n),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
e AS (SELECT DISTINCT r, doc_id, width, array_to_string(w[p:p + width - 1], ' ') AS sh
      FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS p
            FROM d CROSS JOIN (SELECT DISTINCT width FROM k) WHERE len(w) >= width)),
m AS (SELECT r, doc_id, n, item_id, count(*) AS n_shared FROM e JOIN s USING (width, sh) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
FROM m JOIN c USING (n) WHERE n_shared >= {CONTAINMENT} * n_shingles
"""
