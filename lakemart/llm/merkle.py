"""Operator 13, Merkle dataset manifest with proofs by pointer jumping.

Rows are hashed to leaves; the leaves of a group, in key order, make a tree of
runs of three; the groups' roots, in group order, make one more.  A node knows
the sibling digests of its own run and points to its parent.  Jumping joins the
table of nodes with itself: a node's path gets its ancestor's path behind it,
its pointer becomes the ancestor's pointer, and the distance doubles, until the
paths of all leaves reach the root.  Depth costs log2(depth) joins.

Leaves take positions by ranges (``numbered``), so a group that holds a third of
all rows is spread.  Trees grow in blocks of 3**7 nodes, seven levels a job.  In
a jump over d levels an ancestor is asked by at most 3**d leaves; only nodes
that the next jumps ask for are kept, and once those are few (counted: under
8 MB) they are broadcast.  Texts are read once and never shuffled.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import broadcast_if_small, materialized, numbered

RUN = 3
BLOCK_LEVELS = 7                # levels grown by one job
TOP, NOWHERE = -1, -2           # the tree of trees; pointers at or below NOWHERE point to nothing
SPREAD = 1024                   # finished leaves are dealt to so many different null pointers

NODE = ("tree long, level int, pos long, size long, height int, open boolean, digest binary, "
        "left binary, right binary, doc_id long, altered binary")
KEY = ["tree", "level", "pos"]
AT = ["at_tree", "at_level", "at_pos"]


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(*values: Column) -> Column:
    """Binary SHA-256 of the fields of a row."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def height_of(size: int) -> int:
    """Levels above the leaves of a tree: runs of three until one node is left."""
    levels = 0
    while size > 1:
        size, levels = -(-size // RUN), levels + 1
    return levels


def _grow_block(table: pa.Table, block_levels: int) -> pa.Table:
    """The next levels above consecutive nodes of one tree.  Nodes whose parent
    is known get their siblings; the last level stays open."""
    rows = sorted(table.select(["pos", "digest", "doc_id", "altered"]).to_pylist(), key=lambda r: r["pos"])
    tree, level, size = (table.column(c)[0].as_py() for c in ("tree", "level", "size"))
    height, first = height_of(size), rows[0]["pos"]
    nodes, extra = [r["digest"] for r in rows], [(r["doc_id"], r["altered"]) for r in rows]
    out = []
    for _ in range(min(block_levels, height - level)):
        parents = []
        for i in range(0, len(nodes), RUN):
            run = nodes[i:i + RUN]
            parents.append(hashlib.sha256("".join(d.hex() for d in run).encode()).digest())
            for k, d in enumerate(run):
                out.append((tree, level, first + i + k, size, height, False, d, b"".join(run[:k]),
                            b"".join(run[k + 1:]), *(extra[i + k] if extra else (None, None))))
        nodes, extra, level, first = parents, [], level + 1, first // RUN
    out += [(tree, level, first + i, size, height, True, d, None, None, *(extra[i] if extra else (None, None)))
            for i, d in enumerate(nodes)]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), *[pa.binary()] * 3, pa.int64(),
             pa.binary()]
    names = [c.split()[0] for c in NODE.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def grown(leaves: DataFrame, name: str, block_levels: int) -> DataFrame:
    """All nodes (``NODE``) of the trees over ``leaves`` (tree, pos, size, digest,
    doc_id, altered); the only open ones are the trees' roots."""
    level = leaves.withColumn("level", F.lit(0))
    nodes, base = None, 0

    def of(table: pa.Table) -> pa.Table:
        return _grow_block(table, block_levels)

    while True:
        wide = level.withColumn("block", F.expr(f"pos div {RUN ** block_levels}"))
        made = materialized(wide.groupBy("tree", "block").applyInArrow(of, NODE), f"{name}-{base}")
        more = made.filter("open and level < height")
        closed = made.filter("not open or level = height")
        nodes = closed if nodes is None else nodes.unionByName(closed)
        if more.isEmpty():
            return nodes
        base += block_levels
        level = more.select("tree", "level", "pos", "size", "digest", "doc_id", "altered")


def manifest_nodes(docs: DataFrame, group: str, doc_id: str, digest: Column, altered: Column,
                   block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Nodes of all groups' trees and of the tree above them, each with its own
    siblings as ``path`` and a pointer to its parent (``AT``)."""
    rows = docs.select(F.col(group).cast("string").alias("group"), F.col(doc_id).cast("long").alias("doc_id"),
                       digest.alias("digest"), altered.alias("altered"))
    # equal ids follow each other by digest, so reruns agree
    leaves = numbered(rows, ["group"], ["doc_id", "digest"], "leaves").withColumn("tree", F.col("first"))
    below = grown(leaves.select("tree", "pos", "size", "digest", "doc_id", "altered"), "trees", block_levels)
    subroots = below.filter("open").select("tree", "height", "digest")
    ranked = numbered(subroots, [], ["tree"], "subroots")
    above = grown(ranked.select(F.lit(TOP).cast("long").alias("tree"), "pos", "size", "digest",
                                # the node that this leaf of the upper tree is below: its tree, and its height packed behind
                                (F.col("tree") * 64 + F.col("height")).alias("doc_id"),
                                F.lit(None).cast("binary").alias("altered")), "top", block_levels)
    is_leaf = F.col("level") == 0
    pointer = [F.col("tree").alias("at_tree"), (F.col("level") + 1).alias("at_level"),
               F.expr(f"pos div {RUN}").alias("at_pos")]
    path = F.array(F.struct("left", "right"))
    nowhere = [F.lit(NOWHERE).cast("long").alias("at_tree"), F.lit(0).alias("at_level"), F.lit(0).cast("long").alias("at_pos")]
    no_path = F.slice(path, 1, 0).alias("path")
    more = ["height", "digest", "doc_id", "altered", "leaf"]
    inside = below.withColumn("leaf", is_leaf)
    # a tree's root takes its siblings and its parent from the upper tree
    lower = inside.filter("not open").select(*KEY, *pointer, path.alias("path"), *more)
    lone = inside.filter("open and leaf").select(      # a group of one row: leaf and subroot, it points to itself
        *KEY, F.col("tree").alias("at_tree"), F.col("level").alias("at_level"), F.col("pos").alias("at_pos"), no_path, *more)
    upper = above.select(
        F.when(is_leaf, F.expr("doc_id div 64")).otherwise(F.col("tree")).alias("tree"),
        F.when(is_leaf, F.expr("doc_id % 64").cast("int")).otherwise(F.col("level")).alias("level"),
        F.when(is_leaf, F.lit(0)).otherwise(F.col("pos")).alias("pos"), "open", "left", "right", *pointer, "height", "digest",
        F.lit(None).cast("long").alias("doc_id"), "altered", F.lit(False).alias("leaf"))
    links = upper.filter("not open").select(*KEY, *AT, path.alias("path"), *more)
    root = upper.filter("open").select(*KEY, *nowhere, no_path, *more)
    return materialized(lower.unionByName(lone).unionByName(links).unionByName(root), "nodes")


def _jump(nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """Every path continued by its ancestor's; finished ones stay."""
    far = asked.select(*[F.col(k).alias(a) for k, a in zip(KEY, AT, strict=True)], F.col("path").alias("far_path"),
                       *[F.col(a).alias(f"far_{a}") for a in AT])
    joined = nodes.join(far, AT, "left")
    found = F.col("far_path").isNotNull()
    ended = F.lit(NOWHERE) - F.pmod(F.hash(*KEY), F.lit(SPREAD))
    at_tree = F.when(~found, F.col("at_tree")).when(F.col("far_at_tree") <= NOWHERE, ended).otherwise(F.col("far_at_tree"))
    return joined.select(
        *[c for c in nodes.columns if c not in (*AT, "path")], at_tree.cast("long").alias("at_tree"),
        F.when(found, F.col("far_at_level")).otherwise(F.col("at_level")).alias("at_level"),
        F.when(found, F.col("far_at_pos")).otherwise(F.col("at_pos")).alias("at_pos"),
        F.when(found, F.concat("path", "far_path")).otherwise(F.col("path")).alias("path"))


def jumped(nodes: DataFrame) -> DataFrame:
    """The leaves of ``manifest_nodes``, with paths up to the root."""
    leaves = nodes.filter("leaf")
    inner = nodes.filter("not leaf").select(*KEY, *AT, "path")
    depth = nodes.groupBy((F.col("tree") == TOP).alias("top")).agg(F.max("level").alias("level")).collect()
    depth = max(sum(r.level for r in depth), 1) + 1
    step = 1
    while True:
        asked = inner.filter((F.col("tree") == TOP) | (F.col("level") % step == 0))
        asked = broadcast_if_small(asked, 120 + 130 * step)
        leaves = _jump(leaves, asked)
        if step * 2 >= depth:
            return leaves
        inner = materialized(_jump(inner.filter((F.col("tree") == TOP) | (F.col("level") % (2 * step) == 0)), asked),
                             f"jump-{2 * step}")
        step *= 2


def folded(leaf: Column, path: Column) -> Column:
    """The digest that ``leaf`` and the siblings of ``path`` hash up to."""
    return F.aggregate(path, leaf, lambda d, s: F.unhex(F.sha2(F.concat(
        as_hex(s["left"]), as_hex(d), as_hex(s["right"])), 256)))


def merkle_manifest(docs: DataFrame, group: str = "source", doc_id: str = "doc_id",
                    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
                    tampered: dict[str, Column] | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per input row: doc_id, leaf, subroot, root, proof_sha256, folded_root,
    verified, and the proof itself: path (array of the siblings left and right
    of the way, bottom up) and in_group (how many of its entries lead to subroot).

    ``tampered`` replaces columns by what an audit finds in their place; the
    proof of every row is checked against those values.  Nulls hash as ``-`` and
    a null group is a group of its own, the first.  Rows that repeat an id are
    leaves of their own, in the order of their digests; equal rows are too.  An
    empty table gives no rows.  Columns not in ``fields`` are ignored.
    """
    columns = {c: F.col(f"`{c}`") for c in fields}
    found = columns | (tampered or {})
    nodes = manifest_nodes(docs, group, doc_id, row_digest(*columns.values()), row_digest(*found.values()),
                           block_levels)
    top = nodes.filter((F.col("at_tree") == NOWHERE)).select(as_hex("digest")).first()
    root = F.lit(top[0] if top else None).cast("string")
    leaves = jumped(nodes)
    siblings = F.flatten(F.transform("path", lambda s: F.array(as_hex(s["left"]), as_hex(s["right"]))))
    out = leaves.select(
        "doc_id", as_hex("digest").alias("leaf"), as_hex(folded(F.col("digest"), F.slice("path", F.lit(1), F.col("height"))))
        .alias("subroot"), root.alias("root"), F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        as_hex(folded(F.col("altered"), F.col("path"))).alias("folded_root"), "path", F.col("height").alias("in_group"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def without_newlines(text: str = "text", doc_id: str = "doc_id") -> Column:
    """The contract's tampering: rows of even crc32 of the id lose their line feeds."""
    hit = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 2 == 0
    return F.when(hit, F.translate(text, "\n", "")).otherwise(F.col(text))


ORACLE_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, source, text, lang, n_chars, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
    list_reduce([4294967295::BIGINT] || flatten([[(ascii(c) >> k) & 1 for k in range(8)]
                for c in string_split(CAST(doc_id AS VARCHAR), '')])::BIGINT[],
      lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))) AS not_crc
  FROM documents),
hashed AS (
  SELECT *, head || coalesce(strlen(text) || ':' || text, '-') AS row_text,
    head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-') AS other_text
  FROM (SELECT *, strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id || coalesce(strlen(source) || ':' || source, '-')
          || coalesce(strlen(lang) || ':' || lang, '-')
          || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM docs)),
leaves AS (
  SELECT doc_id, tree, pos, n, sha256(row_text) AS leaf,
    CASE WHEN xor(not_crc, 4294967295) % 2 = 0 THEN sha256(other_text) ELSE sha256(row_text) END AS found
  FROM hashed),
lower_nodes(tree, level, pos, n, digest) AS (
  SELECT tree, 0, pos, n, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM lower_nodes WHERE n > 1 GROUP BY tree, level, pos // 3, n),
subroots AS (SELECT tree, level, digest, count(*) OVER () AS trees FROM lower_nodes WHERE n = 1),
upper_nodes(level, pos, n, digest) AS (
  SELECT 0, tree - 1, trees, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 3, n),
nodes AS (
  SELECT tree, level, pos, digest FROM lower_nodes WHERE n > 1
  UNION ALL SELECT 0, level, pos, digest FROM upper_nodes WHERE n > 1),
sides AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3 GROUP BY ALL),
steps AS (
  SELECT doc_id, level AS k, l, r FROM leaves JOIN sides USING (tree)
  WHERE sides.pos = leaves.pos // CAST(pow(3, level) AS BIGINT)
  UNION ALL
  SELECT doc_id, s.level + u.level, l, r FROM leaves JOIN subroots s USING (tree) JOIN sides u ON u.tree = 0
  WHERE u.pos = (s.tree - 1) // CAST(pow(3, u.level) AS BIGINT)),
fold(doc_id, k, digest) AS (
  SELECT doc_id, 0, found FROM leaves
  UNION ALL
  SELECT f.doc_id, f.k + 1, sha256(l || digest || r) FROM fold f JOIN steps s ON f.doc_id = s.doc_id AND f.k = s.k),
proofs AS (SELECT doc_id, string_agg(l || r, '' ORDER BY k) AS proof FROM steps GROUP BY doc_id),
root AS (SELECT digest AS root FROM upper_nodes WHERE n = 1)
SELECT doc_id, leaf, subroots.digest AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256,
  f.digest AS folded_root, f.digest = root AS verified
FROM leaves JOIN subroots USING (tree) CROSS JOIN root LEFT JOIN proofs USING (doc_id)
JOIN (SELECT doc_id, arg_max(digest, k) AS digest FROM fold GROUP BY doc_id) f USING (doc_id)
"""
