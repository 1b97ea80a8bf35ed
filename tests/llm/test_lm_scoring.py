"""Language-model scores against direct recursion over brute-force counts."""

import math
import random
import zlib
from collections import Counter

import pytest

from lakemart.llm import lm_scoring as lm

SCHEMA = "doc_id long, text string, chunk int, train string"


def trains(d):
    return d is None or zlib.crc32(str(d).encode()) % 7 != 2


def brute(rows, order, pull):
    c, n = Counter(), 0
    for d, t in rows:
        if trains(d):
            w = ["<s>", *(t or "").encode().lower().split(), "</s>"]
            n += len(w) - 1
            for k in range(1, order + 1):
                c.update(tuple(w[i - k + 1:i + 1]) for i in range(k - 1, len(w)))
    v = sum(1 for g in c if len(g) == 1 and g != ("<s>",))

    def p(h, w):
        if not h:
            return (c[(w,)] + 1) / (n + v + 1)
        return (c[h + (w,)] + pull * p(h[1:], w)) / (c[h] + pull)

    out = []
    for d, t in rows:
        w = ["<s>", *(t or "").encode().lower().split(), "</s>"]
        score = sum(math.log10(p(tuple(w[max(0, i - order + 1):i]), w[i])) for i in range(1, len(w)))
        base = sum(math.log10(p((), x)) for x in w[1:])
        out.append((str(d), not trains(d), len(w) - 1, sum(c[(x,)] > 0 for x in w[1:]), n, base, score))
    return sorted(out)


def corpus():
    rng = random.Random(3)
    vocab = [f"w{i}É" for i in range(30)] + ["THE", "of"]
    rows = [(i, rng.choice([" ", "\n"]).join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    return rows + [(500, None), (501, " "), (None, "the of"), (3, rows[3][1]), (4, "new words Here"), (502, "rep " * 20_000)]


@pytest.mark.parametrize("order,pull", [(2, 50.0), (3, 5.0), (1, 1.0), (4, 2.0)])
def test_by_brute_force(spark, order, pull):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                 for r in lm.score_texts(df, order=order, pull=pull).collect())
    want = brute(rows, order, pull)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_edges(spark):
    assert lm.score_texts(spark.createDataFrame([], SCHEMA)).count() == 0
    held = next(i for i in range(100) if not trains(i))
    r = lm.score_texts(spark.createDataFrame([(held, "a b", 1, "")], SCHEMA)).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_sorted_parcels():
    import numpy as np
    x = np.sort(np.random.default_rng(1).integers(0, 2 ** 64, 1000, dtype=np.uint64))
    assert (lm.unpack_sorted(lm.pack_sorted(x)) == x).all()
