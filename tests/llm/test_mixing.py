"""Source mixing: targets by brute force, schedule against a plain simulation."""

import random

import pytest
from pyspark.sql import functions as F

from lakemart.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, target int"


def docs(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.randint(1, 200)), rng.choice(["a", "b", "b", "b", "c", "ü", None]), 1, 2) for i in range(n)]
    rows += [(1000, None, "a", 1, 2), (1001, "", "d", 1, 2), (None, "x y", "a", 1, 2), (7, "x y z", "a", 1, 2), (7, "x y z", "a", 1, 2)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_targets_stop_and_reshare():
    sizes = {"a": 10, "b": 100, "c": 1000}
    t = mixing.target_sizes(sizes, {"a": 5.0, "b": 2.0, "c": 1.0})
    assert t["a"] == 30 and t["b"] == 300 and t["c"] == pytest.approx(780)
    assert mixing.target_sizes({"x": 0}, {"x": 5.0}) == {"x": 0.0}
    assert mixing.cycle_weights(["b", None, "a", "c"]) == {"a": 5, "b": 2, "c": 1, None: 5}


def test_mix_meets_targets_and_limits(spark):
    rows, df = docs(spark)
    out = mixing.mix_sources(df).collect()
    assert len(out) == len(rows)
    sums = {}
    for r in out:
        assert 0 <= r.taken <= 3 * r.size
        s = sums.setdefault(r.source, [0, 0, r.target, r.source_size])
        s[0] += r.taken
        s[1] += r["size"]
    sizes = {k: v[1] for k, v in sums.items()}
    want = mixing.target_sizes(sizes, mixing.cycle_weights(list(sizes)))
    for k, (taken, size, target, source_size) in sums.items():
        assert size == source_size and target == pytest.approx(want[k])
        assert abs(taken - target) <= 0.01 * target + 8
    again = mixing.mix_sources(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def simulated(sizes, block_words):
    """Slot by slot: how often each block of each source is taken, and when first."""
    t = mixing.target_sizes(sizes, mixing.cycle_weights(list(sizes)))
    slots, sources = mixing.plan(sizes, t, block_words)
    takes = {s.name: {} for s in sources}
    ranks = {s.name: 0 for s in sources}

    def take(s, slot):
        if ranks[s.name] < s.slots:
            times, first = takes[s.name].get(ranks[s.name] % s.blocks, (0, slot))
            takes[s.name][ranks[s.name] % s.blocks] = times + 1, min(first, slot)
        ranks[s.name] += 1

    for i in range(slots):
        u = (i + 1) * int(mixing.GOLDEN) % 2 ** 64
        s = next(x for x in sources if x.low <= u < x.high)
        if not s.own:
            take(s, i)
    for s in sources:
        for k in range(s.slots if s.own else 0):
            take(s, int(f"{k:08b}"[::-1], 2) * slots // 256)
    return sources, takes


@pytest.mark.parametrize("block_words", [1, 7, 97])
def test_schedule_by_simulation(spark, block_words):
    """Every document's takes and first slot equal those of a slot-by-slot run."""
    rows, df = docs(spark, 60, 3)
    rows += [(2000 + i, "w " * 3000, "c", 1, 2) for i in range(20)]
    out = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA), block_words=block_words).collect()
    sizes = {}
    for _, t, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    sources, takes = simulated(sizes, block_words)
    assert any(s.own for s in sources) == (block_words == 97) and any(s.blocks < s.size for s in sources) == (block_words > 1)
    hashes = {r.doc_id: r.h for r in spark.createDataFrame([(i,) for i in {r[0] for r in rows}], "doc_id long").select(
        "doc_id", F.xxhash64(F.lit(8), "doc_id").alias("h")).collect()}
    expected = []
    for s in sources:
        words = sorted(((hashes[d], d is not None, d or 0, len((t or "").split())) for d, t, x, *_ in rows if x == s.name))
        at = 0
        for _, known, d, n in words:
            hit = [takes[s.name][k] for w in range(at, at + n) if (k := ((w + 1) * s.blocks - 1) // s.size) in takes[s.name]]
            expected.append((d if known else None, s.name, n, sum(x for x, _ in hit), min((f for _, f in hit), default=None)))
            at += n
    assert sorted(map(str, expected)) == sorted(str((r.doc_id, r.source, r["size"], r.taken, r.first_slot)) for r in out)


def test_slots_of_the_schedule_follow_the_targets(spark):
    """Ranks count up within a source, over ranges of slots, and prefixes keep the weights."""
    sizes = {"a": 60_000_000, "b": 90_000_000, "c": 900}
    targets = mixing.target_sizes(sizes, mixing.cycle_weights(list(sizes)))
    slots, sources = mixing.plan(sizes, targets)
    got = sorted((r.slot, r.source, r.rank, r.block) for r in mixing.schedule(spark, slots, sources).collect())
    assert slots > 2 * mixing.SLOT_RANGE
    for i, s in enumerate(sources):
        ranks = sorted(r for _, x, r, _ in got if x == i)
        assert ranks == list(range(s.slots)) and abs(s.slots / s.blocks * s.size - s.target) <= 0.01 * s.target
        for part in (1000, 50_000):
            share = sum(1 for slot, x, *_ in got if x == i and slot < part) / part
            assert abs(share - s.slots / slots) < 0.005


def test_slots_are_counted_exactly():
    rng = random.Random(5)
    for slots in (0, 1, 2, 97, 3000):
        points = [(i + 1) * int(mixing.GOLDEN) % 2 ** 64 for i in range(slots)]
        for c in [0, 1, 2 ** 64 - 2048, *points[:3], *(rng.randrange(2 ** 64) for _ in range(20))]:
            assert mixing._slots_below(c, slots) == sum(p < c for p in points)


def test_small_sources_beside_many_words(spark):
    """60 million words in one source: small ones still come near their targets."""
    small = {f"s{n}": n for n in (3, 20, 100, 1000)}
    rows = [(10_000 + i, "w " * (n // 2), s) for i, (s, n) in enumerate(small.items()) for _ in range(2)]
    rows += [(20_000, "w", "s3"), (20_001, "null source", None)]
    big = spark.range(600).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', 100000)").alias("text"), F.lit("big").alias("source"))
    out = mixing.mix_sources(big.union(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    got = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert len(got) == 6
    for r in got:
        assert abs(r.taken - r.target) <= max(4, 0.01 * r.target), r


def test_thousand_words_beside_five_billion():
    """At every position of its interval a source of 1,000 words gets its target."""
    for k in range(200):
        sizes = {"a": 25_000_000 * k + 1, "b": 1000, "c": 5_000_000_000 - 25_000_000 * k}
        targets = mixing.target_sizes(sizes, {"a": 1.0, "b": 5.0, "c": 2.0})
        for s in mixing.plan(sizes, targets)[1]:
            assert s.slots <= 3 * s.blocks
            assert abs(s.slots / s.blocks * s.size - s.target) <= max(4, 0.01 * s.target)


def test_one_id_on_many_rows(spark):
    """Rows that repeat one id are spread over ranges, and reruns agree."""
    rows = [(7, "w " * (i % 5), "a", 1, 2) for i in range(3000)] + [(i, "x y", "b", 1, 2) for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    one = sorted(map(str, mixing.mix_sources(df, block_words=10).collect()))
    assert one == sorted(map(str, mixing.mix_sources(df.repartition(3), block_words=10).collect()))


def test_empty_and_wordless(spark):
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    out = mixing.mix_sources(spark.createDataFrame([(1, None, None, 1, 1)], SCHEMA)).collect()
    assert [(r["size"], r.taken, r.target) for r in out] == [(0, 0, 0.0)]


def test_keeps_columns(spark):
    _, df = docs(spark, 20)
    out = mixing.mix_sources(df, keep=("text",)).collect()
    assert all(r["size"] == len((r.text or "").split()) for r in out)
