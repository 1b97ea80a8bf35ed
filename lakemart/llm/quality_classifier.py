"""Operator 6, quality classifier: random indexing and a small numpy network.

Words (and their shapes, such as ``Xx.``) fall into 65,536 hash buckets.  A
bucket's index vector is sparse, random and fixed; its word vector is the
normalised sum of the index vectors of its neighbours in all documents.
A document is the mean of its word vectors, the mean of its shape vectors and
three counts, over its whole text.  A network of two layers scores it, and a
temperature fitted on rows apart calibrates the probabilities.

Word vectors need no labels: every task sums its documents into a table of
fixed size, and the tables are added up slice by slice, in whole numbers, so
reruns agree to the last bit.  The network learns from a bounded sample of
labelled rows (``max_rows``), written once; only its features, one short row
for each sampled id, reach the driver.  Everything broadcast has a fixed size.
Scoring is one more scan, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import materialized, pack, unpack, utf8

MAX_ROWS, THRESHOLD = 4000, 0.3
BUCKETS, DIM, NEAR, NONZERO = 1 << 16, 32, 2, 4
SLICE = 1 << 10             # buckets of a word-vector table that are added up together
HIDDEN, STEPS, RATE, DECAY = 32, 600, 0.01, 1e-3
_SHAPES = bytes(0x78 if 97 <= b <= 122 or b >= 128 else 0x58 if 65 <= b <= 90 else 0x39 if 48 <= b <= 57 else b for b in range(256))


class Buckets(dict):
    """Word -> bucket of the lower-cased word and bucket of its shape, as one number; memoised."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        shape = re.sub(rb"(.)\1+", rb"\1", word.translate(_SHAPES), flags=re.DOTALL)
        at = self[word] = (xxhash.xxh32_intdigest(word.lower(), 1) % BUCKETS * BUCKETS
                           + xxhash.xxh32_intdigest(shape, 2) % BUCKETS)
        return at


def index_vectors() -> np.ndarray:
    rng = np.random.default_rng(6)
    out = np.zeros((BUCKETS, DIM), np.int32)
    rows = np.arange(BUCKETS)
    for _ in range(NONZERO):
        out[rows, rng.integers(0, DIM, BUCKETS)] += rng.choice([-1, 1], BUCKETS).astype(np.int32)
    return out


def _token_buckets(text, memo: Buckets) -> np.ndarray:
    """(words, 2) buckets of words and shapes."""
    words = utf8(text).split()
    both = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
    return np.stack([both // BUCKETS, both % BUCKETS], axis=1)


def context_sums(texts, index: np.ndarray, table: np.ndarray, memo: Buckets) -> None:
    """Add to ``table`` the index vectors of each word's neighbours in its text."""
    for text in texts:
        tokens = _token_buckets(text, memo)
        for at in range(0, len(tokens), 1 << 16):
            # NEAR words on either side are the context of a piece's outer words
            low = max(0, at - NEAR)
            part = tokens[low:at + (1 << 16) + NEAR]
            summed = np.zeros((len(part) + 2 * NEAR + 1, DIM), np.int32)
            np.cumsum(index[part[:, 0]] + index[part[:, 1]], axis=0, out=summed[NEAR + 1:-NEAR])
            summed[-NEAR:] = summed[-NEAR - 1]
            own = summed[NEAR + 1:-NEAR] - summed[NEAR:-NEAR - 1]
            around = summed[2 * NEAR + 1:] - summed[:-2 * NEAR - 1] - own
            inner = slice(at - low, at - low + min(1 << 16, len(tokens) - at))
            part, around = part[inner], around[inner]
            for column in (0, 1):
                order = np.argsort(part[:, column], kind="stable")
                keys = part[order, column]
                cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                table[keys[cut]] += np.add.reduceat(around[order], cut, axis=0)


def document_features(text, vectors: np.ndarray, memo: Buckets) -> np.ndarray:
    """Pooled vectors and counts of a whole text; zeros for a text without words."""
    out = np.zeros(2 * DIM + 3, np.float32)
    tokens = _token_buckets(text, memo)
    n = len(tokens)
    if n:
        pooled = np.zeros((2, DIM))
        for at in range(0, n, 1 << 16):
            pooled += vectors[tokens[at:at + (1 << 16)]].sum(axis=0)
        out[:2 * DIM] = (pooled / n).ravel()
        out[2 * DIM:] = np.log1p(n), len(np.unique(tokens[:, 0])) / n, len(np.unique(tokens[:, 1])) / n
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Two layers over standardised features, logits divided by a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def train_network(x: np.ndarray, y: np.ndarray) -> Network:
    """Fit by Adam on four fifths, the temperature on the rest.  Without rows
    of both classes every score is their only class, or one half."""
    dim = x.shape[1]
    rng = np.random.default_rng(61)
    if len(set(y.tolist())) < 2:
        logit = 0.0 if not len(y) else (3.0 if y[0] else -3.0)
        return Network(np.zeros(dim), np.ones(dim), np.zeros((dim, 1)), np.zeros(1), np.zeros(1), logit)
    order = rng.permutation(len(y))
    fit, apart = order[len(y) // 5:], order[:len(y) // 5]
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3
    z, t = (x[fit] - mean) / scale, y[fit].astype(float)
    params = [rng.normal(0, dim ** -0.5, (dim, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        h = np.tanh(z @ params[0] + params[1])
        error = (_sigmoid(h @ params[2] + params[3]) - t) / len(t)
        back = np.outer(error, params[2]) * (1 - h * h)
        grads = [z.T @ back + DECAY * params[0], back.sum(axis=0), h.T @ error + DECAY * params[2], error.sum(keepdims=True)]
        for p, g, m, v in zip(params, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    net = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]))
    if len(apart):
        logits, target = net.logits(x[apart]), y[apart]

        def loss(temperature):
            p = np.clip(_sigmoid(logits / temperature), 1e-9, 1 - 1e-9)
            return -np.mean(np.where(target == 1, np.log(p), np.log(1 - p)))
        net.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return net


def held_out(doc_id: str = "doc_id"):
    """The fold never learned from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The table of word vectors, from all texts: partial sums per task, added up
    by slices of buckets (``BUCKETS / SLICE`` rows reach the driver: 16 MB)."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, memo, table = index_vectors(), Buckets(), None
        for batch in batches:
            table = np.zeros((BUCKETS, DIM), np.int64) if table is None else table
            context_sums((t.as_py() for t in batch.column(0)), index, table, memo)
        if table is not None:
            parts = [pack(table[i:i + SLICE]) for i in range(0, BUCKETS, SLICE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())],
                                             names=["slice", "sums"])

    def added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLICE * DIM, np.int64)
        for batch in batches:
            for part in batch.column("sums"):
                total += np.frombuffer(unpack(part.as_py())[0], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         names=["slice", "sums"])

    schema = "slice int, sums binary"
    found = docs.select(F.col(text).alias("text")).mapInArrow(sums, schema).groupBy("slice").applyInArrow(added, schema)
    table = index_vectors().astype(np.float64)      # an unseen bucket keeps its own index vector
    for row in found.collect():
        table[row.slice * SLICE:(row.slice + 1) * SLICE] += np.frombuffer(row.sums, np.int64).reshape(SLICE, DIM)
    table /= np.linalg.norm(table, axis=1, keepdims=True) + 1e-6
    return table.astype(np.float32)


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, max_rows: int) -> DataFrame:
    """(text, label) of at most ``max_rows`` ids outside the held-out fold, chosen by hash.

    Null labels and ids are left out; an id with two labels counts as its smaller
    one, an id of several rows as one of them (of the smallest text hash)."""
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y")).dropna()
    known = known.groupBy("_id").agg(F.min("_y").alias("_y")).filter(~held_out("_id"))
    chosen = F.broadcast(materialized(known.orderBy(F.xxhash64("_id"), "_id").limit(max_rows), "quality-ids"))
    rows = docs.join(chosen, F.col(f"`{doc_id}`") == F.col("_id")).select("_id", "_y", F.col(text).alias("text"))
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("row")
    return materialized(rows.groupBy("_id", "_y").agg(one).select(F.col("row.text").alias("text"), "_y"), "quality-sample")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        max_rows: int = MAX_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors from all documents, the network from the labelled sample."""
    table = word_vectors(docs, text)
    vectors = docs.sparkSession.sparkContext.broadcast(table)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Buckets()
        for batch in batches:
            x = [document_features(t.as_py(), vectors.value, memo).tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), batch.column(1)], names=["x", "y"])

    sample = labelled_sample(docs, labels, doc_id, text, label, max_rows)
    rows = sorted((bytes(r.x), r.y) for r in sample.mapInArrow(features, "x binary, y int").collect())
    x = np.array([np.frombuffer(r[0], np.float32) for r in rows]).reshape(-1, 2 * DIM + 3).astype(float)
    return table, train_network(x, np.array([r[1] for r in rows], int))


def score_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  label: str = "quality", threshold: float = THRESHOLD, max_rows: int = MAX_ROWS,
                  carry: bool = False) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (with ``carry``: the input row as ``row``).

    Null, empty and blank texts have no words and one score.  A null id is
    never held out.  Repeated rows get equal rows.  Without usable labels every
    score is one half; with labels of one class, near that class.  An empty
    table gives no rows.  Other columns are never read.
    """
    table, net = fit(docs, labels, doc_id, text, label, max_rows)
    model = docs.sparkSession.sparkContext.broadcast((table, net))
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"),
                       F.col(text).alias("text"), *row)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, network = model.value
        memo = Buckets()
        for batch in batches:
            x = np.array([document_features(t.as_py(), vectors, memo) for t in batch.column(2)], float)
            scores = network.scores(x.reshape(-1, 2 * DIM + 3))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), *batch.columns[3:]],
                names=["doc_id", "held_out", "score", *(["row"] if carry else [])])

    schema = "doc_id long, held_out boolean, score double"
    if carry:
        schema += f", row {rows.schema['row'].dataType.simpleString()}"
    out = rows.mapInArrow(of, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    return out.withColumnRenamed("doc_id", doc_id)
