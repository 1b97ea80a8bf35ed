"""SimHash fingerprints and components against brute force."""

import random

import xxhash
from pyspark.sql import functions as F

from lakemart.llm import simhash

SCHEMA = "doc_id long, text string, h int, fp string, `group` int"


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hs) > len(hs))


def components(ids, fps, bits=2, roots=False):
    """Smallest id of each row's component, or of each component."""
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    if roots:
        return [low.get(r) for r in {find(i) for i in range(len(ids))}]
    return [low.get(find(i)) for i in range(len(ids))]


def corpus():
    rng = random.Random(5)
    vocab = [f"w{i}é" for i in range(300)]
    base = [[rng.choice(vocab) for _ in range(rng.randint(30, 300))] for _ in range(25)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for k in range(120):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((100 + k, " ".join(w)))
    return rows + [(900, None), (901, ""), (3, " \t\n"), (902, "One"), (903, "oNe two"), (None, "one"), (7, rows[7][1]),
                   (8, "x " * 40_000), (None, "alone null")]


def test_spark_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("é one two")).alias("x")).first()
    assert row.x % 2 ** 64 == xxhash.xxh64_intdigest("é one two".encode(), 42)


def test_components_by_brute_force(spark):
    rows = corpus()
    got = simhash.simhash_components(spark.createDataFrame([(*r, 1, "", 1) for r in rows], SCHEMA)).collect()
    fps = [slow_fingerprint(t) for _, t in rows]
    assert sorted((str(r.doc_id), r.fp % 2 ** 64, str(r.component_id)) for r in got) == sorted(
        (str(d), f, str(c)) for (d, _), f, c in zip(rows, fps, components([d for d, _ in rows], fps)))


def test_crowded_blocks_lose_no_link(spark):
    rng = random.Random(6)
    fps = set()
    for _ in range(6):
        center = rng.getrandbits(64)
        for _ in range(60):
            x = center
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    for limit in (2, 16):
        links = simhash.close_pairs(df, 2, limit).collect()
        assert all(((a ^ b) % 2 ** 64).bit_count() <= 2 for a, b in links)
        index = {simhash._signed(x): i for i, x in enumerate(fps)}
        parent = list(range(len(fps)))

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i
        for a, b in links:
            parent[find(index[a])] = find(index[b])
        want = components(list(range(len(fps))), fps)
        assert len({(find(i), want[i]) for i in range(len(fps))}) == len(set(want)) == len({find(i) for i in range(len(fps))})


def test_one_of_each_component_stays(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "", 1) for r in rows], SCHEMA)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    fps = [slow_fingerprint(t) for _, t in rows]
    want = components([d for d, _ in rows], fps, roots=True)
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(set(map(str, got)))
    assert sorted(str(d) for d, _ in got) == sorted(map(str, want))


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.simhash_components(df).count() == 0 and simhash.drop_near_duplicates(df).count() == 0
