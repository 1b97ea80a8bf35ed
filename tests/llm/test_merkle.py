"""Merkle manifest against a brute-force tree and fold."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lakemart.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree int, path string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def tree_of(leaves):
    """(root, for each leaf its siblings as (left, right) from the bottom up)."""
    proofs, at = [[] for _ in leaves], list(range(len(leaves)))
    level = leaves
    while len(level) > 1:
        for k, i in enumerate(at):
            s = i // 3 * 3
            proofs[k].append(("".join(level[s:i]), "".join(level[i + 1:s + 3])))
            at[k] = i // 3
        level = [sha("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
    return level[0], proofs


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = [tree_of([leaf_of(r) for r in groups[g]]) for g in order]
    root, above = tree_of([t[0] for t in trees])
    out = []
    for g, (subroot, proofs), upper in zip(order, trees, above):
        for r, proof in zip(groups[g], proofs):
            steps = proof + upper
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            digest = leaf_of((*r[:4], r[4].replace("\n", "")) if hit else r)
            for a, b in steps:
                digest = sha(a + digest + b)
            out.append((r[0], leaf_of(r), subroot, root, sha("".join(a + b for a, b in steps)), digest, digest == root))
    return sorted(out, key=str)


def result(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    out = merkle.merkle_manifest(df, tampered={"text": merkle.without_newlines()}, **kw)
    return sorted((tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                                "verified").collect()), key=str)


@pytest.mark.parametrize("block_levels", [2, 7])
def test_matches_brute_force(spark, monkeypatch, block_levels):
    """One group holds most rows; nulls in every column, repeated ids, repeated rows, a lone row."""
    monkeypatch.setattr(merkle, "broadcast_if_small", lambda df, size: df)
    rng = random.Random(4)
    rows = [(i, rng.choice(["hot", "hot", "b", "é", None]), rng.choice(["en", None]), rng.choice([i, None]),
             rng.choice(["a\nb", "ä", "", None, f"t{i}\n"])) for i in range(300)]
    rows += [(7, "hot", "en", 1, "again"), (7, "hot", "en", 1, "again"), (None, "b", None, None, None), (500, "lone", "en", 2, "x\n" * 9)]
    rows += [(900 + i, f"s{i}", None, None, f"{i}\n") for i in range(11)]
    assert result(spark, rows, block_levels=block_levels) == brute(rows)


def test_small_and_empty(spark):
    for rows in ([(1, None, None, None, "one\n")], [(i, "s", "en", i, f"{i}\n") for i in range(4)],
                 [(i, str(i), "en", i, None) for i in range(4)]):
        assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []


def test_proof_is_a_real_output(spark):
    """Anyone holding a row, its path and the root can check it without the table."""
    rows = [(i, "ab"[i % 2], "en", i, f"text {i}") for i in range(20)]
    out = merkle.merkle_manifest(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA))
    for r in out.collect():
        digest = r.leaf
        for k, (a, b) in enumerate(r.path):
            if k == r.in_group:
                assert digest == r.subroot
            digest = sha(a.hex() + digest + b.hex())
        assert digest == r.root and r.verified
