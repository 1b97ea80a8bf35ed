"""Containment search against brute force."""

import random

from lakemart.llm import decontamination as dc

DOCS, ITEMS = "doc_id long, text string, item_id string, h int", "item_id long, text string, doc_id int"


def brute(docs, items):
    out = []
    for d, t in docs:
        w = dc.normal_words(t)
        for i, x in items:
            iw = dc.normal_words(x)
            n = min(5, len(iw))
            if n:
                s = dc.shingle_set(iw, n)
                shared = len(s & dc.shingle_set(w, n))
                if shared >= 0.8 * len(s):
                    out.append((str(d), str(i), shared, len(s)))
    return sorted(out)


def corpus():
    rng = random.Random(8)
    vocab = [f"b{i}ä" for i in range(500)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([5, 6, 9, 14, 30, 60, 130, 400])))) for i in range(60)]
    items += [(100, "three short words"), (101, "One"), (102, ""), (103, None), (None, items[0][1]), (0, items[0][1])]
    docs = []
    for d in range(120):
        w = [rng.choice(vocab) for _ in range(rng.choice([0, 20, 300, 4000]))]
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(items[:60])[1].split()
            if rng.random() < 0.5:
                passage[rng.randrange(len(passage))] = "EDIT"
            at = rng.randint(0, len(w))
            w[at:at] = [x.upper().replace("Ä", "ä") for x in passage]
        docs.append((d, " \n"[d % 2].join(w)))
    long = [rng.choice(vocab) for _ in range(60_000)]
    long[40_000:40_000] = items[5][1].split()
    docs += [(500, " ".join(long)), (501, None), (502, "x ONE y"), (503, "a three short words"), (None, items[1][1]), (3, docs[3][1])]
    return docs, items


def run(spark, docs, items, **kw):
    df = spark.createDataFrame([(*r, "", 1) for r in docs], DOCS)
    return df, dc.contained_items(df, spark.createDataFrame([(*r, 1) for r in items], ITEMS), **kw)


def test_by_brute_force(spark):
    docs, items = corpus()
    want = brute(docs, items)
    assert len(want) > 40
    for kw in ({}, {"block_items": 10}):
        _, out = run(spark, docs, items, **kw)
        assert sorted((str(r.doc_id), str(r.item_id), r.n_shared, r.n_shingles) for r in out.collect()) == want


def test_drops_documents(spark):
    docs, items = corpus()
    df, _ = run(spark, docs, items)
    bad = {d for d, *_ in brute(docs, items)}
    kept = dc.drop_contaminated(df, spark.createDataFrame([(*r, 1) for r in items], ITEMS))
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if str(d) not in bad)


def test_item_longer_than_a_chunk(spark):
    rng = random.Random(3)
    item = " ".join(f"v{rng.randrange(5000)}" for _ in range(20_000))
    other = " ".join(f"v{rng.randrange(5000)}" for _ in range(20_000))
    docs = [(1, f"before {item} after"), (2, other), (3, " ".join(item.split()[:18_000])), (4, " ".join(item.split()[:9_000]))]
    for items in ([(7, item)], [(7, item), (8, "before v1"), (9, " ".join(item.split()[50:80]))]):
        got = sorted((str(r.doc_id), str(r.item_id), r.n_shared, r.n_shingles) for r in run(spark, docs, items)[1].collect())
        assert got == brute(docs, items)
        assert {d for d, i, *_ in got if i == "7"} == {"1", "3"}


def test_items_of_few_shingles_are_never_missed():
    rng = random.Random(6)
    hashes = dc.WordHashes()
    missed = []
    for k in range(1500):
        item = [f"i{k}w{j}".encode() for j in range(5 + k % 4)]
        words = [f"d{rng.randrange(10**6)}".encode() for _ in range(40)]
        at = rng.choice([0, 20, 40])
        words[at:at] = item
        index = dc.ItemIndex([(k, b" ".join(item).decode())], dc.SHINGLE, dc.MINIMA)
        if not index.search(words, hashes.array(words), dc.CONTAINMENT):
            missed.append(k)
    assert missed == []


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")])[1].count() == 0
    assert run(spark, [(1, "a")], [])[1].count() == 0
