"""Operator 5, substring dedup: super-k-mer partitioning of word windows.

The minimiser of a window of 13 words is its smallest 2-word gram, under an
order that puts long grams (which are rare) first and hashes within a length
class.  Consecutive windows sharing a minimiser travel as one packed string, with its
document and position, to the bucket of that minimiser; equal windows share a
minimiser, so each bucket counts its windows exactly, by sorting them.

Strings are pre-aggregated before they are shuffled: of equal strings in a run
of rows only those of the smallest document travel, the others are repeats
already.  A passage in a third of all documents thus sends one string per run.
The strings for one bucket are packed and compressed together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import spans
from lakemart.llm.common import WordHashes, buckets_for, mix64, pack, sliding_min, unpack, utf8

WINDOW, GRAM = 13, 2
LONG = (4,)                  # mean word lengths that bound the classes of the order
RUN_WORDS = 500_000         # words whose strings are pre-aggregated together
HELD_WORDS = 250_000        # word hashes that a task remembers
CHUNK_BYTES = 1 << 20       # bytes hashed at once

PARCEL = "bucket int, doc_id long, h long, data binary"


def _super_kmers(hashes: np.ndarray, lengths: np.ndarray, ends: np.ndarray, window: int, gram: int):
    """Runs of windows sharing a minimiser, none across documents:
    (minimiser, first word, number of windows, document) arrays."""
    n = len(hashes)
    if n < window:
        return (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)
    with np.errstate(over="ignore"):
        grams = np.zeros(n - gram + 1, np.uint64)
        for k in range(gram):
            grams = grams * np.uint64(0x100000001B3) + hashes[k:n - gram + 1 + k]
        total = np.convolve(lengths, np.ones(gram, np.int64), "valid")
        rank = np.searchsorted(-gram * np.array(LONG), -total).astype(np.uint64)
        low = sliding_min((rank << np.uint64(62)) | (mix64(grams) >> np.uint64(2)), window - gram + 1)
    doc = np.searchsorted(ends, np.arange(len(low)), side="right")
    valid = np.arange(len(low)) + window <= ends[doc]
    first = np.r_[True, (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])] & valid
    at = np.flatnonzero(first)
    # a run ends at the next start or where its document has no further window
    count = np.minimum(np.r_[at[1:], len(low)], ends[doc[at]] - window + 1) - at
    return low[at], at, count, doc[at]


#: Base of the rolling hashes (odd, so it has an inverse modulo 2**64), and a number for each byte.
BASE = 0x9E3779B97F4A7C15
BYTE = np.random.default_rng(5).integers(1, 1 << 63, 256, np.uint64)
_POWERS: list[np.ndarray] = [np.empty(0, np.uint64)] * 2


def _powers(n: int) -> list[np.ndarray]:
    """BASE**i and BASE**-i for i < ``n``, modulo 2**64; kept up to two chunks' length."""
    if len(_POWERS[0]) < n:
        size = max(n, 2 * CHUNK_BYTES)
        tables = []
        for factor in (BASE, pow(BASE, -1, 1 << 64)):
            t = np.full(size, factor, np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        if size > 2 * CHUNK_BYTES:
            return tables
        _POWERS[:] = tables
    return [p[:n] for p in _POWERS]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``values[s:e]``; equal ranges have equal hashes wherever they lie."""
    with np.errstate(over="ignore"):
        power, inverse = _powers(len(values) + 1)
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[:-1], out=total[1:])
        return mix64((total[ends] - total[starts]) * inverse[starts])


def _equal_runs(key: np.ndarray, at: Callable[[int], bytes]) -> Iterator[np.ndarray]:
    """Groups (of two or more) of positions whose bytes ``at`` are equal: those of
    equal keys, compared byte by byte."""
    order = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.diff(key[order])) + 1
    starts, ends = np.r_[0, cuts], np.r_[cuts, len(order)]
    for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
        group = order[s:e]
        first = at(int(group[0]))
        same = [at(i) == first for i in group[1:].tolist()]
        if all(same):
            yield group
        else:                           # a collision of hashes: told apart by the bytes themselves
            apart: dict[bytes, list[int]] = {}
            for i in group.tolist():
                apart.setdefault(at(i), []).append(i)
            yield from (np.array(g) for g in apart.values() if len(g) > 1)


class _Run:
    """Documents whose windows are cut and pre-aggregated together."""

    def __init__(self, buckets: int, window: int, gram: int):
        self.buckets, self.window, self.gram = buckets, window, gram
        self.hash = WordHashes(bound=HELD_WORDS)
        self.clear()

    def clear(self):
        self.texts, self.hashes, self.lengths, self.ends, self.ids, self.n_words = [], [], [], [], [], 0

    def add(self, doc_id: int, h: int, text: bytes):
        words = text.split()
        if doc_id is not None and len(words) >= self.window:
            self.texts.append(b" ".join(words))
            self.hashes.append(self.hash.array(words))
            self.lengths.append(np.fromiter(map(len, words), np.int64, len(words)))
            self.n_words += len(words)
            self.ends.append(self.n_words)
            self.ids.append((doc_id, h))

    def parcels(self) -> Iterator[tuple]:
        """Rows (bucket, doc_id, h, data): spans known here, then packed strings."""
        if not self.ids:
            return
        ends, reach = np.array(self.ends, np.int64), self.window - 1
        hashes, lengths, text = np.concatenate(self.hashes), np.concatenate(self.lengths), b" ".join(self.texts)
        keys = np.array(self.ids, np.int64)
        self.clear()
        anchor, at, count, doc = _super_kmers(hashes, lengths, ends, self.window, self.gram)
        # a string lies between the first byte of its first and the last byte of its last word
        after = np.cumsum(lengths + 1)
        begin_byte, end_byte = (after - lengths - 1)[at], after[at + count + reach - 1] - 1
        span = list(zip(begin_byte.tolist(), end_byte.tolist(), strict=True))
        ids = keys[doc, 0]
        keep = np.ones(len(at), bool)
        for group in _equal_runs(range_hashes(hashes, at, at + count + reach), lambda i: text[span[i][0]:span[i][1]]):
            # of equal strings only those of the smallest document travel; the others repeat it
            keep[group[ids[group] > ids[group].min()]] = False
        del hashes, lengths, after
        begin = np.r_[0, ends[:-1]]
        gone = np.flatnonzero(~keep)
        for part in np.split(gone, np.flatnonzero(np.diff(doc[gone])) + 1):
            if len(part):
                d = doc[part[0]]
                s, e = spans.merged(at[part] - begin[d], at[part] + count[part] + reach - begin[d])
                yield int(keys[d, 1]) % self.buckets, *keys[d].tolist(), spans.to_blob(s, e)
        rows = np.flatnonzero(keep)
        bucket = (anchor[rows] % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for part in np.split(order, cuts):
            r = rows[part]
            yield int(bucket[part[0]]), None, None, pack(
                (anchor[r] >> np.uint64(16)).astype(np.uint32), keys[doc[r]].T.copy(), at[r] - begin[doc[r]],
                end_byte[r] - begin_byte[r], b"".join([text[a:b] for a, b in map(span.__getitem__, r.tolist())]))


def _parcels(docs: DataFrame, buckets: int, window: int, gram: int, run_words: int) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _Run(buckets, window, gram)

        def flushed():
            rows = list(run.parcels())
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                        pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    names=["bucket", "doc_id", "h", "data"])

        for batch in batches:
            for doc_id, h, text in zip(*batch.columns, strict=True):
                run.add(doc_id.as_py(), h.as_py(), utf8(text.as_py()))
                if run.n_words >= run_words:
                    yield from flushed()
        yield from flushed()

    return docs.mapInArrow(of, PARCEL)


def _windows(text: bytes, begin: np.ndarray, size: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """All windows of some strings of ``text``: (string, first word, first byte, end byte, hash).

    Strings are taken in chunks of bounded bytes: a hash doesn't depend on its place."""
    found = []
    cut = np.cumsum(size) // CHUNK_BYTES
    for part in np.split(np.arange(len(begin)), np.flatnonzero(np.diff(cut)) + 1):
        if not len(part):
            continue
        low = np.cumsum(size[part] + 1) - size[part] - 1            # of the strings in the chunk
        strings = [text[b:e] for b, e in zip(begin[part].tolist(), (begin + size)[part].tolist(), strict=True)]
        chunk = np.frombuffer(b" ".join([*strings, b""]), np.uint8)
        word_end = np.flatnonzero(chunk == 32)
        word = np.r_[0, word_end[:-1] + 1]
        string = np.searchsorted(low, word, side="right") - 1
        first = np.searchsorted(word, low)                          # each string's first word
        n_words = np.diff(np.r_[first, len(word)])
        at = np.flatnonzero(np.arange(len(word)) - first[string] <= n_words[string] - window)
        s, e = word[at], word_end[at + window - 1]
        found.append((part[string[at]], at - first[string[at]], begin[part[string[at]]] + s - low[string[at]],
                      begin[part[string[at]]] + e - low[string[at]], range_hashes(BYTE[chunk], s, e)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 5


def _bucket_spans(blobs: list[bytes], window: int) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """(doc_id, h) -> spans of words, from all packed strings of a bucket.

    Minimisers of one document are left out.  Equal strings are counted once,
    with the smallest of their documents; their windows are sorted by hash,
    compared byte by byte where hashes tie, and the least document of equal
    windows is found."""
    parts = [unpack(b) for b in blobs]
    if not parts:
        return {}
    anchor = np.concatenate([np.frombuffer(p[0], np.uint32) for p in parts])
    doc, h = np.concatenate([np.frombuffer(p[1], np.int64).reshape(2, -1) for p in parts], axis=1)
    at = np.concatenate([np.frombuffer(p[2], np.int64) for p in parts])
    size = np.concatenate([np.frombuffer(p[3], np.int64) for p in parts])
    text = b"".join(p[4] for p in parts)
    del parts
    begin = np.cumsum(size) - size
    order = np.lexsort((doc, anchor))
    group = np.flatnonzero(np.r_[True, anchor[order][1:] != anchor[order][:-1]])
    last = np.r_[group[1:], len(order)]
    mixed = doc[order[group]] != doc[order[last - 1]]               # documents sorted: more than one
    rows = order[np.repeat(mixed, last - group)]
    del order, group, last, anchor
    doc, h, at, size, begin = doc[rows], h[rows], at[rows], size[rows], begin[rows]
    whole = _string_hashes(np.frombuffer(text, np.uint8), begin, size)
    # equal strings: the smallest document's first row stands for all of them
    stands, least = np.arange(len(rows)), doc.copy()
    for same in _equal_runs(whole, lambda i: text[begin[i]:begin[i] + size[i]]):
        stands[same], least[same] = same[0], doc[same].min()
    some = np.flatnonzero(stands == np.arange(len(rows)))
    string, first, s, e, key = _windows(text, begin[some], size[some], window)
    low = least[some][string]
    for same in _equal_runs(key, lambda i: text[s[i]:e[i]]):
        low[same] = low[same].min()
    # windows of a string, one after the other; copies of a string share them
    n = np.bincount(string, minlength=len(some))
    start = np.cumsum(n) - n
    place = np.empty(len(rows), np.int64)
    place[some] = np.arange(len(some))
    place = place[stands]
    take = np.repeat(start[place] - (np.cumsum(n[place]) - n[place]), n[place]) + np.arange(int(n[place].sum()))
    row = np.repeat(np.arange(len(rows)), n[place])
    hit = low[take] < doc[row]
    row, word = row[hit], at[row[hit]] + first[take[hit]]
    order = np.lexsort((word, h[row], doc[row]))
    row, word = row[order], word[order]
    cuts = np.flatnonzero((np.diff(doc[row]) != 0) | (np.diff(h[row]) != 0)) + 1
    return {(int(doc[row[k[0]]]), int(h[row[k[0]]])): spans.merged(word[k], word[k] + window)
            for k in np.split(np.arange(len(row)), cuts) if len(k)}


def _string_hashes(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of whole strings, chunk by chunk of the packed text."""
    out = np.empty(len(begin), np.uint64)
    order = np.argsort(begin, kind="stable")
    cut = (begin + size)[order] // CHUNK_BYTES
    for part in np.split(order, np.flatnonzero(np.diff(cut)) + 1):
        if len(part):
            a, b = begin[part[0]], begin[part[-1]] + size[part[-1]]
            out[part] = range_hashes(BYTE[raw[a:b]], begin[part] - a, begin[part] + size[part] - a)
    return out


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, run_words: int = RUN_WORDS) -> DataFrame:
    """(doc_id, h, spans) of words to remove, from ``keyed_texts``."""
    parcels = _parcels(docs, buckets_for(docs.sparkSession), window, gram, run_words)

    def of(table: pa.Table) -> pa.Table:
        data = table.column("data").to_pylist()
        ids, hs = table.column("doc_id").to_pylist(), table.column("h").to_pylist()
        rows = [(i, h, d) for i, h, d in zip(ids, hs, data, strict=True) if i is not None]
        found = _bucket_spans([d for i, d in zip(ids, data, strict=True) if i is None], window)
        rows += [(i, h, spans.to_blob(s, e)) for (i, h), (s, e) in found.items()]
        i, h, d = zip(*rows, strict=True) if rows else ((),) * 3
        return pa.table({"doc_id": pa.array(i, pa.int64()), "h": pa.array(h, pa.int64()), "spans": pa.array(d, pa.binary())})

    return parcels.groupBy("bucket").applyInArrow(of, spans.KEY + ", spans binary")


def _cut_words(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, bytes]:
    words = text.split()
    if not len(starts):
        return len(words), b" ".join(words)
    kept, at = [], 0
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        kept += words[at:s]
        at = e
    return len(words), b" ".join(kept + words[at:])


def remove_repeated_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                               gram: int = GRAM, run_words: int = RUN_WORDS, carry: bool = False,
                               carry_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, n_spans, kept_text,
    kept_sha256 (with ``carry`` also the input's other columns as ``row``, with
    ``carry_text`` its text, null as empty).

    A word goes if a window of ``window`` words covering it also starts in a
    document with a smaller doc_id; windows are judged on the input.  Kept words
    are joined by one space.  Null and blank texts have no words.  Rows that
    repeat an id don't repeat each other; a row without an id takes no part and
    keeps its words.  An empty table gives no rows.  Other columns are ignored.
    """
    keyed = spans.keyed_texts(docs, doc_id, text)
    found = repeated_spans(keyed, window, gram, run_words)
    if carry:
        keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), spans.text_hash(text).alias("h"),
                            F.col(text).alias("text"), F.struct(
                                *[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"))
    out = spans.cut_spans(keyed, found, _cut_words, carry, carry_text)
    return out.withColumnRenamed("n_items", "n_words").withColumn("kept_text", F.col("kept_text").cast("string"))
