"""Operator 4, language-model scoring: a weighted backoff automaton.

Model: n-grams smoothed towards the next shorter order,

    P(w | h) = (c(h w) + K * P(w | h')) / (c(h) + K),   h' = h without its first word,

down to the add-one unigram (c + 1) / (N + V + 1).  As an automaton, every
n-gram shorter than the order is a state; a seen continuation is an arc that
carries its log-probability; an unseen one takes the state's failure arc, of
weight K / (c(h) + K), to the state of h'.  A text is scored by one traversal
from left to right that carries the state.

Counts are taken over all training texts and never gathered in one place.
Documents are dealt into chunks.  A chunk asks for the counts of its distinct
n-grams, with its own training counts, in sorted hash parcels, one for each
count bucket; a bucket sums over the chunks and answers each in the order it
asked, so answers carry no keys; a chunk then builds the automaton of its own
n-grams and scores its documents.  A frequent n-gram costs one entry in a chunk,
however often it occurs there.  N-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import WordHashes, buckets_for, mix64, pack, unpack, utf8

ORDER, PULL = 2, 400.0
RUN_WORDS = 1_000_000
NO_ARC = 1.0                # no log-probability
START, END = np.uint64(0xA5A5A5A5A5A5A5A5), np.uint64(0x5A5A5A5A5A5A5A5A)   # no word's business: see WordHashes


def pack_sorted(hashes: np.ndarray) -> bytes:
    """Sorted hashes as the byte planes of their differences."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


class Chunk:
    """The n-grams of some texts: for each order the gram that ends at each
    position.  Every text starts with a START token, which is context only."""

    def __init__(self, texts: list[bytes], train: np.ndarray, order: int):
        memo = WordHashes(4)
        parts, self.sizes = [], np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            words = text.lower().split()
            parts.append(np.concatenate([[START], memo.array(words), [END]]))
            self.sizes[i] = len(words) + 2
        tokens = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        place = np.arange(len(tokens)) - np.repeat(self.starts, self.sizes)
        weight = np.repeat(train.astype(np.int64), self.sizes)
        self.grams, self.at, self.last, self.own = [], [], [], []
        rolling = np.zeros(len(tokens), np.uint64)
        for k in range(1, order + 1):
            with np.errstate(over="ignore"):        # hash of the k tokens that end here
                rolling = tokens if k == 1 else np.r_[np.uint64(0), rolling[:-1]] * np.uint64(0x9E3779B97F4A7C15) + tokens
                hashed = mix64(rolling + np.uint64(k))
            ends = np.flatnonzero(place >= k - 1)
            grams, inverse = np.unique(hashed[ends], return_inverse=True)
            at = np.full(len(tokens), -1, np.int64)
            at[ends] = inverse
            last = np.empty(len(grams), np.int64)       # where each gram ends for the last time
            last[inverse] = ends
            self.grams.append(grams)
            self.last.append(last)
            self.at.append(at)
            self.own.append(np.bincount(inverse, weight[ends], len(grams)).astype(np.int64))

    def buckets(self, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each bucket, order and index of the chunk's grams, hashes sorted."""
        hashes = np.concatenate(self.grams) if self.grams else np.empty(0, np.uint64)
        bucket = (hashes % np.uint64(n)).astype(np.int64)
        order = np.lexsort((hashes, bucket))
        return np.split(order, np.searchsorted(bucket[order], np.arange(1, n)))

    def requests(self, n: int) -> Iterator[tuple[int, bytes]]:
        hashes, own = np.concatenate(self.grams), np.concatenate(self.own)
        for b, rows in enumerate(self.buckets(n)):
            if len(rows):
                yield b, pack(pack_sorted(hashes[rows]), own[rows].astype(np.uint32))

    def counts(self, n: int, answers: dict[int, bytes]) -> list[np.ndarray]:
        """Counts over the whole corpus, for each order."""
        total = np.zeros(sum(map(len, self.grams)), np.int64)
        for b, rows in enumerate(self.buckets(n)):
            if len(rows):
                total[rows] = np.frombuffer(unpack(answers[b])[0], np.int64)
        return np.split(total, np.cumsum([len(g) for g in self.grams])[:-1])


class Automaton:
    """States, arcs and failure arcs of a chunk's n-grams.

    A state is a seen n-gram shorter than the order; the root is the empty one.
    The arc by which it reads a word is the gram one word longer: the chunk
    knows that gram at each position, so arcs are found by index.  A seen gram's
    suffixes are seen, so a failure arc leads to the state one word shorter.
    """

    def __init__(self, chunk: Chunk, counts: list[np.ndarray], n: int, v: int, pull: float):
        self.at, self.live = chunk.at, counts[0] > 0
        p = (counts[0] + 1) / (n + v + 1)
        self.base = np.log10(p)
        self.arcs, self.loss = [self.base], []      # the root reads any word
        for k in range(1, len(counts)):
            seen = np.flatnonzero(counts[k] > 0)
            at = chunk.last[k][seen]
            prefix, suffix = chunk.at[k - 1][at - 1], chunk.at[k - 1][at]
            lower = np.zeros(len(counts[k]))
            lower[seen] = (counts[k][seen] + pull * p[suffix]) / (counts[k - 1][prefix] + pull)
            arcs = np.full(len(counts[k]), NO_ARC)
            arcs[seen] = np.log10(lower[seen])
            self.arcs.append(arcs)
            self.loss.append(np.log10(pull / (counts[k - 1] + pull)))
            p = lower

    def score(self, start: int, size: int) -> float:
        """Log10 probability of the tokens after ``start``: one traversal, which
        carries the length of its state (the gram of so many tokens before)."""
        words = slice(start + 1, start + size)
        arcs = [w[at[words]].tolist() for w, at in zip(self.arcs, self.at, strict=True)]
        loss = [[], *[w[at[start:start + size - 1]].tolist() for w, at in zip(self.loss, self.at)]]
        live = self.live[self.at[0][start:start + size]].tolist()
        top = len(arcs) - 1
        longer = [min(k + 1, top) for k in range(top + 1)]
        state, total = longer[0] if live[0] else 0, 0.0
        for i, known in enumerate(live[1:]):
            weight = arcs[state][i]
            while weight > 0:
                total += loss[state][i]
                state -= 1
                weight = arcs[state][i]
            total += weight
            state = longer[state] if known else 0
        return total


def _vocabulary(docs: DataFrame, buckets: int) -> tuple[int, int]:
    """Tokens and distinct tokens of the training texts (END counted)."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, size = WordHashes(4), [], 0

        def flushed():
            hashes, counts = np.unique(np.concatenate(held), return_counts=True)
            bucket = (hashes % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((hashes, bucket))
            parts = [(b, r) for b, r in enumerate(np.split(order, np.searchsorted(bucket[order], np.arange(1, buckets)))) if len(r)]
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in parts], pa.int32()),
                 pa.array([pack(pack_sorted(hashes[r]), counts[r]) for _, r in parts], pa.binary())], names=["bucket", "data"])

        for batch in batches:
            for text in batch.column(0):
                held.append(np.concatenate([memo.array(utf8(text.as_py()).lower().split()), [END]]))
                size += len(held[-1])
                if size >= RUN_WORDS:
                    yield flushed()
                    held, size = [], 0
        if held:
            yield flushed()

    def total(table: pa.Table) -> pa.Table:
        parts = [unpack(d) for d in table.column("data").to_pylist()]
        hashes = np.concatenate([unpack_sorted(p[0]) for p in parts])
        n = sum(int(np.frombuffer(p[1], np.int64).sum()) for p in parts)
        return pa.table({"n": pa.array([n], pa.int64()), "v": pa.array([len(np.unique(hashes))], pa.int64())})

    row = (docs.mapInArrow(words, "bucket int, data binary").groupBy("bucket").applyInArrow(total, "n long, v long")
           .agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first())
    return int(row.n or 0), int(row.v or 0)


def trained_on(doc_id: str = "doc_id") -> Column:
    """The training fold: crc32 of the id as text, mod 7, is not 2 (a null id trains)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 != 2, F.lit(True))


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", train: Column | None = None,
                order: int = ORDER, pull: float = PULL) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigrams), score (the model's log10 probability).

    A null, empty or blank text is its end token alone.  Repeated rows count
    each and get equal rows.  Without training texts nothing is known and both
    scores are uniform.  An empty table gives no rows.  Other columns are ignored.
    """
    spark = docs.sparkSession
    train = trained_on(doc_id) if train is None else train
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), train.alias("train"), F.col(text).alias("text"))
    buckets, chunks = buckets_for(spark, 1), buckets_for(spark)
    n, v = _vocabulary(rows.filter("train").select("text"), buckets)

    def squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([squeeze(utf8(t.as_py())) for t in batch.column(3)], pa.binary())],
                names=["chunk", "doc_id", "train", "text"])

    chunk_of = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int")
    dealt = rows.select(chunk_of.alias("chunk"), "doc_id", "train", "text").mapInArrow(
        squeezed, "chunk int, doc_id long, train boolean, text binary")

    def read(table: pa.Table) -> Chunk:
        expand = zstandard.ZstdDecompressor().decompress
        return Chunk([expand(t) for t in table.column("text").to_pylist()],
                     np.array(table.column("train").to_pylist(), bool), order)

    def ask(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        b, data = zip(*read(table).requests(buckets), strict=True)
        return pa.table({"bucket": pa.array(b, pa.int32()), "chunk": pa.array([chunk] * len(b), pa.int32()),
                         "data": pa.array(data, pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        parts = [unpack(d) for d in table.column("data").to_pylist()]
        hashes = [unpack_sorted(p[0]) for p in parts]
        own = np.concatenate([np.frombuffer(p[1], np.uint32) for p in parts])
        _, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(inverse, own).astype(np.int64)[inverse]
        data = [pack(t) for t in np.split(total, np.cumsum([len(h) for h in hashes])[:-1])]
        return pa.table({"chunk": table.column("chunk").cast(pa.int32()), "bucket": table.column("bucket").cast(pa.int32()),
                         "data": pa.array(data, pa.binary())})

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = read(table)
        counts = chunk.counts(buckets, dict(zip(answers.column("bucket").to_pylist(),
                                                answers.column("data").to_pylist(), strict=True)))
        automaton = Automaton(chunk, counts, n, v, pull)
        word = chunk.at[0]
        out = []
        for a, size in zip(chunk.starts.tolist(), chunk.sizes.tolist(), strict=True):
            ids = word[a + 1:a + size]
            out.append((size - 1, int((counts[0][ids] > 0).sum()), n, float(automaton.base[ids].sum()),
                        automaton.score(a, size)))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        held = [not t for t in table.column("train").to_pylist()]
        return pa.table([table.column("doc_id"), pa.array(held, pa.bool_()),
                         *[pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    asked = dealt.groupBy("chunk").applyInArrow(ask, "bucket int, chunk int, data binary")
    answered = asked.groupBy("bucket").applyInArrow(answer, "chunk int, bucket int, data binary")
    out = dealt.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("doc_id", doc_id)
