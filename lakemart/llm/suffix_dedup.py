"""Operator 3, suffix-array dedup: repeated 200-byte strings, removed everywhere.

Suffixes are dealt into buckets by the minimiser (smallest 16-byte gram under a
hash) of their first 200 bytes, so equal 200-byte strings meet; runs of
suffixes sharing a minimiser travel as one packed string.  Equal strings of a
run of rows are known repeats and travel once.  In a bucket, strings whose
minimiser is unique are set aside; over the rest a suffix array is built by
two-stage sorting: only suffixes smaller than their successors are sorted
directly, the others are induced by scanning the buckets of first bytes in
order; adjacent common prefixes of 200 bytes or more mark the repeats.  Order
beyond 200 bytes is of no use here and not established.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakemart.llm import spans
from lakemart.llm.common import buckets_for, mix64, pack, sliding_min, unpack, utf8

LENGTH, GRAM_DOUBLINGS = 200, 4         # grams of 2 ** 4 bytes
RUN_BYTES = 2_000_000
STOP = 0xFF                             # in no UTF-8 text: ends a string
NO_ID = -(1 << 63)                      # stands for a null id inside parcels


def gram_hashes(data: np.ndarray, doublings: int = GRAM_DOUBLINGS) -> np.ndarray:
    """Hash of the ``2 ** doublings`` bytes from each position."""
    h = data.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(doublings):
            step = 1 << k
            h = h[:-step] * np.uint64(0x9E3779B97F4A7C15 + 2 * k) + h[step:]
            h ^= h >> np.uint64(29)
        return mix64(h)


def _next_words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one big-endian number; zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k:k + len(data)]
    return out


def smaller_than_successor(data: np.ndarray) -> np.ndarray:
    """Type of each suffix; the last is larger than the empty one after it."""
    n = len(data)
    change = np.flatnonzero(data[1:] != data[:-1])          # a run of equal bytes ends here
    rising = np.r_[data[change] < data[change + 1], False]
    return rising[np.searchsorted(change, np.arange(n), side="left")]


def _sorted_directly(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``at`` sorted by ``depth`` bytes, eight at a time, ties only."""
    if not len(at):
        return at
    at = at[np.argsort(words[at], kind="stable")]
    group = np.cumsum(np.r_[True, words[at][1:] != words[at][:-1]])
    live = np.arange(len(at))
    for off in range(8, depth, 8):
        g = group[live]
        tied = np.r_[False, g[1:] == g[:-1]]
        live = live[tied | np.r_[tied[1:], False]]
        if not len(live):
            break
        g, suffix = group[live], at[live]
        key = words[np.minimum(suffix + off, len(words) - 1)]
        key = np.where(suffix + off < len(words), key, np.uint64(0))
        order = np.lexsort((key, g))
        at[live], key = suffix[order], key[order]
        first = np.r_[True, (g[1:] != g[:-1]) | (key[1:] != key[:-1])]
        group[live] = live[np.maximum.accumulate(np.where(first, np.arange(len(live)), 0))] + len(at) + 1
    return at


def suffix_array(data: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes ordered by their first ``depth`` bytes: two-stage sorting."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    small = smaller_than_successor(data)
    direct = _sorted_directly(np.flatnonzero(small), _next_words(data), depth)
    bounds = np.searchsorted(data[direct], np.arange(257)) if len(direct) else np.zeros(257, int)
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[data[-1]].append(np.array([n - 1]))

    def push(suffixes: np.ndarray, byte: int) -> np.ndarray:
        """Predecessors of suffixes scanned in order, into their buckets; those
        of the bucket in hand are returned."""
        before = suffixes[suffixes > 0] - 1
        before = before[~small[before]]
        first = data[before]
        order = np.argsort(first, kind="stable")
        for part in np.split(before[order], np.flatnonzero(np.diff(first[order])) + 1):
            if len(part) and data[part[0]] != byte:
                induced[data[part[0]]].append(part)
        return before[first == byte]

    out = []
    for byte in range(256):
        queue = np.concatenate(induced[byte]) if induced[byte] else np.empty(0, np.int64)
        while len(queue):
            out.append(queue)
            queue = push(queue, byte)
        rest = direct[bounds[byte]:bounds[byte + 1]]
        if len(rest):
            out.append(rest)
            push(rest, byte)
    return np.concatenate(out)


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Bytes that adjacent suffixes share, counted up to ``depth``, in eights."""
    words = _next_words(data)
    out = np.zeros(max(0, len(order) - 1), np.int64)
    live = np.arange(len(out))
    for off in range(0, depth, 8):
        a, b = order[live] + off, order[live + 1] + off
        inside = np.maximum(a, b) < len(words)
        live, a, b = live[inside], a[inside], b[inside]
        live = live[words[a] == words[b]]
        if not len(live):
            break
        out[live] = off + 8
    return out


def _mark(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, which of its ``length``-byte windows occur more than once among all."""
    sizes = np.array([len(s) for s in strings], np.int64)
    data = np.frombuffer(b"".join(s + bytes([STOP]) for s in strings), np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    valid = np.zeros(len(data), np.int64)
    np.add.at(valid, starts, 1)
    np.add.at(valid, starts + sizes - length + 1, -1)
    valid = np.cumsum(valid) > 0
    order = suffix_array(data, length)
    order = order[valid[order]]
    equal = np.flatnonzero(common_prefixes(data, order, length) >= length)
    hit = np.zeros(len(data), bool)
    hit[order[equal]] = hit[order[equal + 1]] = True
    return [hit[a:a + s - length + 1] for a, s in zip(starts.tolist(), sizes.tolist(), strict=True)]


class _Run:
    """Documents whose suffixes are dealt and pre-aggregated together."""

    def __init__(self, buckets: int, length: int):
        self.buckets, self.length = buckets, length
        self.clear()

    def clear(self):
        self.texts, self.ids, self.size = [], [], 0

    def add(self, doc_id, h: int, text: bytes):
        if len(text) >= self.length:
            self.texts.append(text)
            self.ids.append((NO_ID if doc_id is None else doc_id, h))
            self.size += len(text)

    def parcels(self) -> Iterator[tuple]:
        """Rows (bucket, doc_id, h, data): spans known here, then (h null) packed strings."""
        if not self.ids:
            return
        joined, length = b"".join(self.texts), self.length
        ends = np.cumsum([len(t) for t in self.texts])
        begin = np.r_[0, ends[:-1]]
        grams = gram_hashes(np.frombuffer(joined, np.uint8))
        width = length - (1 << GRAM_DOUBLINGS) + 1
        low = sliding_min(grams, width)
        doc = np.repeat(np.arange(len(ends)), ends - begin)[:len(low)]
        place = np.arange(len(low))
        first = np.r_[True, (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])] & (place + length <= ends[doc])
        at = np.flatnonzero(first)
        doc = doc[at]
        count = np.minimum(np.r_[at[1:], len(low)], ends[doc] - length + 1) - at
        anchor = low[at]
        again = self._meets_itself(grams, low, at, count, anchor, width)
        strings: dict[bytes, list[int]] = {}
        for i, (a, c) in enumerate(zip(at.tolist(), count.tolist(), strict=True)):
            strings.setdefault(joined[a:a + c + length - 1], []).append(i)
        local: dict[int, list[int]] = {}
        for rows in strings.values():
            if len(rows) > 1:
                for i in rows:
                    local.setdefault(int(doc[i]), []).append(i)
        for d, rows in local.items():
            s = at[rows] - begin[d]
            s, e = spans.merged(s, s + count[rows] + length - 1)
            yield self.ids[d][1] % self.buckets, None if self.ids[d][0] == NO_ID else self.ids[d][0], self.ids[d][1], spans.to_blob(s, e)
        sent = list(strings.items())
        rows = np.array([r[0] for _, r in sent], np.int64)
        many = np.array([len(r) > 1 for _, r in sent])
        bucket = (anchor[rows] % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        keys = np.array(self.ids, np.int64)
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            r = rows[part]
            texts = [sent[k][0] for k in part]
            yield int(bucket[part[0]]), None, None, pack(
                (anchor[r] >> np.uint64(16)).astype(np.uint32), keys[doc[r]].T.copy(), at[r] - begin[doc[r]],
                np.array([len(t) for t in texts], np.int64), many[part].astype(np.uint8) + 2 * again[r].astype(np.uint8),
                b"".join(texts))

    @staticmethod
    def _meets_itself(grams, low, at, count, anchor, width) -> np.ndarray:
        """Strings in which the minimiser may stand twice (never missing one)."""
        reach = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
        spots = np.flatnonzero(~sliding_min(~reach, width)[:len(grams)] == grams)     # minimisers of some window
        a, b = np.searchsorted(spots, at), np.searchsorted(spots, at + count + width - 1)
        times = np.zeros(len(at), np.int64)
        for k in range(8):
            there = a + k < b
            spot = spots[np.minimum(a + k, len(spots) - 1)]
            times += there & (grams[spot] == anchor)
        return (times > 1) | (b - a > 8)


def _bucket_spans(blobs: list[bytes], length: int) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """(doc_id, h) -> spans of bytes, from all packed strings of a bucket."""
    parts = [unpack(b) for b in blobs]
    if not parts:
        return {}
    anchor = np.concatenate([np.frombuffer(p[0], np.uint32) for p in parts])
    doc, h = np.concatenate([np.frombuffer(p[1], np.int64).reshape(2, -1) for p in parts], axis=1)
    at, size = (np.concatenate([np.frombuffer(p[k], np.int64) for p in parts]) for k in (2, 3))
    flag = np.concatenate([np.frombuffer(p[4], np.uint8) for p in parts])
    _, inverse, times = np.unique(anchor, return_inverse=True, return_counts=True)
    chosen = np.flatnonzero((times[inverse] > 1) | (flag >= 2))
    if not len(chosen):
        return {}
    pieces, end = [], 0
    wanted = np.zeros(len(anchor), bool)
    wanted[chosen] = True
    offset = 0
    for p in parts:                             # only the strings that may repeat
        n = len(p[0]) // 4
        ends = np.cumsum(np.frombuffer(p[3], np.int64))
        for i in np.flatnonzero(wanted[offset:offset + n]):
            pieces.append(p[5][ends[i - 1] if i else 0:ends[i]])
        offset += n
    del parts
    uses: dict[bytes, list[int]] = {}
    for row, piece in zip(chosen.tolist(), pieces, strict=True):
        uses.setdefault(piece, []).append(row)
    # a string that is alone with its minimiser, however often it occurs, needs no sorting
    kinds: dict[int, int] = {}
    for rows in uses.values():
        kinds[inverse[rows[0]]] = kinds.get(inverse[rows[0]], 0) + 1
    sort = [s for s, rows in uses.items() if kinds[inverse[rows[0]]] > 1 or (flag[rows] >= 2).any()]
    marks = dict(zip(sort, _mark(sort, length), strict=True)) if sort else {}
    out: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for string, rows in uses.items():
        copies = len(rows) > 1
        for r in rows:
            if flag[r] & 1:
                continue                        # its repeats were known where it came from
            if copies:
                pairs = [(int(at[r]), int(at[r] + size[r]))]
            else:
                i = np.flatnonzero(marks[string]) + at[r] if string in marks else np.empty(0, np.int64)
                s, e = spans.merged(i, i + length)
                pairs = list(zip(s.tolist(), e.tolist(), strict=True))
            if pairs:
                out.setdefault((int(doc[r]), int(h[r])), []).extend(pairs)
    return out


def repeated_spans(docs: DataFrame, length: int = LENGTH, run_bytes: int = RUN_BYTES) -> DataFrame:
    """(doc_id, h, spans) of bytes to remove, from ``spans.keyed_texts``."""
    buckets = buckets_for(docs.sparkSession)
    types = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
    names = ["bucket", "doc_id", "h", "data"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _Run(buckets, length)

        def flushed():
            rows = list(run.parcels())
            run.clear()
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for doc_id, h, text in zip(*batch.columns, strict=True):
                run.add(doc_id.as_py(), h.as_py(), utf8(text.as_py()))
                if run.size >= run_bytes:
                    yield from flushed()
        yield from flushed()

    def find(table: pa.Table) -> pa.Table:
        ids, hs, data = (table.column(c).to_pylist() for c in names[1:])
        rows = [(i, h, d) for i, h, d in zip(ids, hs, data, strict=True) if h is not None]
        for (i, h), pairs in _bucket_spans([d for h, d in zip(hs, data, strict=True) if h is None], length).items():
            s, e = spans.merged(*(np.array(x, np.int64) for x in zip(*pairs, strict=True)))
            rows.append((None if i == NO_ID else i, h, spans.to_blob(s, e)))
        columns = zip(*rows, strict=True) if rows else [()] * 3
        return pa.table([pa.array(c, t) for c, t in zip(columns, types[1:], strict=True)], names=["doc_id", "h", "spans"])

    parcels = docs.mapInArrow(deal, "bucket int, doc_id long, h long, data binary")
    return parcels.groupBy("bucket").applyInArrow(find, spans.KEY + ", spans binary")


def _cut_bytes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, bytes]:
    at, kept = 0, []
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        kept.append(text[at:s])
        at = e
    return len(text), b"".join([*kept, text[at:]])


def remove_repeated_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                          run_bytes: int = RUN_BYTES) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_text
    (binary: a cut may fall inside a character), kept_sha256.

    A byte goes if a ``length``-byte string covering it also starts anywhere
    else, in the same document or another; strings never cross documents and
    are judged on the input.  Null texts are empty.  Repeated rows are documents
    of their own and repeat each other, as do rows without an id.  An empty
    table gives no rows.  Other columns are ignored.
    """
    keyed = spans.keyed_texts(docs, doc_id, text)
    return spans.cut_spans(keyed, repeated_spans(keyed, length, run_bytes), _cut_bytes).withColumnRenamed("n_items", "n_bytes")
