"""Substring dedup against brute force."""

import hashlib
import random
import re

from lakemart.llm import substring_dedup as sd

SCHEMA = "doc_id long, text string, h int, spans string, row int"


def words(t):
    return re.findall(r"[^ \t\n\x0B\f\r]+", t or "")


def brute(rows, window=13):
    first = {}
    for d, t in rows:
        if d is not None:
            w = words(t)
            for i in range(len(w) - window + 1):
                k = tuple(w[i:i + window])
                first[k] = min(d, first.get(k, d))
    out = []
    for d, t in rows:
        w = words(t)
        gone = {i + k for i in range(len(w) - window + 1) if d is not None and first[tuple(w[i:i + window])] < d
                for k in range(window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(d), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


def corpus(n=80, seed=2):
    rng = random.Random(seed)
    vocab = [f"v{i}ö" for i in range(40)]
    passages = [[rng.choice(vocab) for _ in range(rng.randint(13, 60))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocab) for _ in range(rng.randint(1, 40))]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(500, rows[1][1]), (1, rows[1][1]), (2, rows[3][1]), (None, rows[5][1]), (501, None), (502, " "),
             (503, "same " * 60), (504, "same " * 40), (505, "ab cd " * 30), (506, "ab cd " * 25), (600, "x" * 100_000)]
    return rows


def check(spark, rows, **kw):
    got = sd.remove_repeated_substrings(spark.createDataFrame([(*r, 1, "", 1) for r in rows], SCHEMA).repartition(5), **kw)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got.collect()) == brute(rows)


def test_by_brute_force(spark):
    check(spark, corpus())


def test_small_runs_and_grams(spark):
    check(spark, corpus(60, 9), run_words=50, gram=2)


def test_near_copies(spark):
    rng = random.Random(11)
    base = [f"t{rng.randrange(10 ** 6)}" for _ in range(200)]
    rows = []
    for i in range(30):
        w = list(base)
        for _ in range(i % 4):
            w[rng.randrange(200)] = f"edit{i}"
        rows.append((i, " ".join(w)))
    check(spark, rows)


def test_empty_table(spark):
    assert sd.remove_repeated_substrings(spark.createDataFrame([], SCHEMA)).count() == 0


def test_carries_rows(spark):
    df = spark.createDataFrame([(1, "a b", 7, "s", 3)], SCHEMA)
    r = sd.remove_repeated_substrings(df, carry=True).first()
    assert r.row.asDict() == {"doc_id": 1, "h": 7, "spans": "s", "row": 3}
