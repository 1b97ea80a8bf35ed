"""Suffix-array dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest

from lakemart.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string, h int, spans string"


def brute(rows, length):
    seen, texts = {}, [(t or "").encode() for _, t in rows]
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((str(d), len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_array_orders():
    rng = random.Random(1)
    for data in [b"", b"a", b"aaaa", b"banana", b"abab" * 50, bytes(rng.choice(b"ab") for _ in range(400)),
                 bytes(rng.randrange(255) for _ in range(500)), b"zyx" * 30 + b"a" * 90 + b"\xff" + b"zyx" * 30]:
        arr = np.frombuffer(data, np.uint8)
        got = [data[i:i + 64] for i in sd.suffix_array(arr, 64)]
        assert sorted(sd.suffix_array(arr, 64).tolist()) == list(range(len(data)))
        assert got == sorted(data[i:i + 64] for i in range(len(data)))


def corpus():
    rng = random.Random(7)

    def prose(n):
        return "".join(rng.choice("abcdé \n") for _ in range(n))
    passages = [prose(k) for k in (199, 200, 201, 350, 900)]
    rows = [(i, "".join(rng.choice(passages) if rng.random() < 0.4 else prose(rng.randint(0, 500))
                        for _ in range(rng.randint(0, 5)))) for i in range(60)]
    base = prose(1500)
    rows += [(100 + k, base[:40 * k] + "#" + base[40 * k:]) for k in range(20)]
    rows += [(200, None), (201, ""), (None, rows[1][1]), (5, rows[5][1]), (5, prose(300)), (202, "!" * 3000),
             (203, "ab " * 400), (204, "ab " * 60), (205, "x" * 199), (206, "y" * 201), (None, prose(250)), (None, base)]
    return rows


@pytest.mark.parametrize("run_bytes", [2_000_000, 700])
def test_by_brute_force(spark, run_bytes):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "") for r in rows], SCHEMA).repartition(4)
    got = sd.remove_repeated_bytes(df, run_bytes=run_bytes).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(rows, 200)


def test_empty_table(spark):
    assert sd.remove_repeated_bytes(spark.createDataFrame([], SCHEMA)).count() == 0
