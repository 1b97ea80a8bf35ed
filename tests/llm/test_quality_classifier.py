"""Quality classifier: held-out accuracy and calibration, edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import quality_classifier as qc

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("clash")).withColumn("row", F.lit(0))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = qc.score_quality(docs, labels)
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50
    good = [r for r in rows if r.quality == 1]
    assert sum(r.predicted == 1 for r in good) >= 0.97 * len(good)
    assert sum(r.predicted == r.quality for r in rows) >= 0.9 * len(rows)
    s, y = np.array([r.score for r in rows]), np.array([r.quality for r in rows])
    assert s.min() >= 0 and s.max() <= 1 and np.mean((s - y) ** 2) < 0.08


def test_folds_follow_crc32(spark):
    import zlib
    got = spark.range(50).select("id", qc.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, " \n", 1), (4, "a " * 50_000, 1), (4, "b c", 1), (None, "x", 1)],
                                 "doc_id long, text string, held_out int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = qc.score_quality(docs, none).collect()
    assert len(out) == 6 and all(r.score == 0.5 and r.predicted == 1 for r in out)
    some = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 1, 0), (3, None, 0), (None, 1, 1)], none.schema)
    out = qc.score_quality(docs, some).collect()
    blank = {r.score for r in out if r.doc_id in (1, 2, 3)}
    assert len(out) == 6 and len(blank) == 1
    assert qc.score_quality(docs.limit(0), none).count() == 0
    kept = qc.score_quality(docs, none, carry=True).select("row.*")
    assert kept.columns == docs.columns


def plain_buckets(word):
    import re

    import xxhash
    shape = "".join("9" if "0" <= c <= "9" else "X" if "A" <= c <= "Z" else c if ord(c) < 128 and not c.islower() else
                    "x" * len(c.encode()) for c in word)
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)
    return [xxhash.xxh32_intdigest(lower.encode(), 1) % qc.BUCKETS,
            xxhash.xxh32_intdigest(re.sub(r"(.)\1+", r"\1", shape, flags=re.DOTALL).encode(), 2) % qc.BUCKETS]


TEXTS = ["The cat sat. The CAT ran 12 times!", "ünï cödé wörds", "", None, "one", "a b", "x y z " * 300, "The cat sat. The CAT ran 12 times!"]


def brute_vectors(texts):
    index = qc.index_vectors().astype(int)
    table = index.astype(float)
    for t in texts:
        words = [plain_buckets(w) for w in (t or "").split()]
        for i, own in enumerate(words):
            for k in range(max(0, i - qc.NEAR), min(len(words), i + qc.NEAR + 1)):
                if k != i:
                    for b in own:
                        table[b] += index[words[k][0]] + index[words[k][1]]
    return (table / (np.linalg.norm(table, axis=1, keepdims=True) + 1e-6)).astype(np.float32)


def test_word_vectors_pooling_and_scores_by_brute_force(spark):
    """All documents shape the word vectors; a score is the network over plainly pooled vectors."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(TEXTS))], "doc_id long, quality int")
    table, net = qc.fit(docs, labels)
    assert (table == brute_vectors(TEXTS)).all()
    scores = {r.doc_id: r.score for r in qc.score_quality(docs, labels).collect()}
    for i, t in enumerate(TEXTS):
        words = (t or "").split()
        x = np.zeros(2 * qc.DIM + 3)
        if words:
            found = np.array([plain_buckets(w) for w in words])
            x[:qc.DIM], x[qc.DIM:-3] = table[found[:, 0]].mean(axis=0), table[found[:, 1]].mean(axis=0)
            x[-3:] = np.log1p(len(words)), len(set(found[:, 0])) / len(words), len(set(found[:, 1])) / len(words)
        h = np.tanh((x - net.mean) / net.scale @ net.w1 + net.b1)
        assert scores[i] == pytest.approx(1 / (1 + np.exp(-(h @ net.w2 + net.b2) / net.temperature)), abs=1e-5)


def test_pieces_of_a_long_text_share_their_borders(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(140_000))
    whole = np.zeros((qc.BUCKETS, qc.DIM), np.int64)
    index, memo = qc.index_vectors(), qc.Buckets()
    qc.context_sums([text], index, whole, memo)
    tokens = np.array([plain_buckets(w) for w in text.split()])
    vectors = index[tokens[:, 0]].astype(np.int64) + index[tokens[:, 1]]
    around = np.zeros_like(vectors)
    for d in range(1, qc.NEAR + 1):
        around[d:] += vectors[:-d]
        around[:-d] += vectors[d:]
    expected = np.zeros_like(whole)
    for column in (0, 1):
        np.add.at(expected, tokens[:, column], around)
    assert (whole == expected).all()


def test_sample_is_bounded_by_ids_not_rows(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "b"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (99, 1)], "doc_id long, quality int")
    rows = qc.labelled_sample(docs, labels, "doc_id", "text", "quality", 100).collect()
    assert len(rows) == 3 - sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in (1, 2, 3))
