"""Operator 12, source divergence audit: how far apart the sources of a language are.

Every (lang, source) group has a smoothed frequency for each kept term of its
language.  The distance of two groups is the sum of absolute differences over
all kept terms, those that neither has included.

Rows of the distance matrix are accumulated by Gustavson's method.  A language's
terms are dealt into blocks; a block holds a term-major index (for each term
the groups that have it).  Each group scatters its terms through the index into
one dense accumulator, a number per peer, so no pair of postings is ever emitted.
Terms that a group lacks stand at its baseline, the frequency of count 0:

  sum over t of |p - q|  =  V |b - c|                                  all terms at the baselines b, c
      + sum over the group's terms of |p - c| - |b - c|                by its own sorted frequencies
      + sum over the peer's terms  of |b - q| - |b - c|                by the peers' sorted frequencies
      + sum over common terms of |p - q| - |p - c| - |b - q| + |b - c|    scattered through the index

The accumulators of a group are added over the blocks.  All numbers are integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import broadcast_if_small, materialized, utf8

LEAST_DOCS = 30
TOP_TERMS = 50
SCALE, SMOOTH = 1_000_000_000, 5
#: Postings of a block of the index: as many as a block has distances of two
#: groups, so that accumulators are no more data than postings, within these bounds.
BLOCK_POSTINGS = (50_000, 2_000_000)
SCATTER = 1 << 21               # postings scattered at once
HELD_TERMS = 400_000            # distinct (group, term) pairs that a task counts before it passes them on
PIECE = 1 << 20                 # bytes of a text split at once

#: Bytes of a term: A-Z as a-z, a-z, all beyond ASCII; others end a term.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))

COUNTS = "lang string, source string, term string, n long, docs long"


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, split piece by piece (a piece ends between terms)."""
    text, at = text.translate(FOLD), 0
    while at < len(text):
        end = len(text) if at + PIECE >= len(text) else text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, partly added up."""
    empty = F.lit("")
    rows = docs.select(F.coalesce(F.col(lang), empty).alias("lang"), F.coalesce(F.col(source), empty).alias("source"),
                       F.col(text).alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}

        def flushed():
            for (a, b), (n, d) in counts.items():
                keys = list(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a] * len(keys), pa.string()), pa.array([b] * len(keys), pa.string()),
                     pa.array(keys, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                     pa.array([d[k] for k in keys], pa.int64())], names=["lang", "source", "term", "n", "docs"])
            counts.clear()

        for batch in batches:
            for a, b, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                n, d = counts.setdefault((a, b), (Counter(), Counter()))
                seen: set[bytes] = set()
                for terms in _pieces(utf8(t.as_py())):
                    n.update(terms)
                    seen.update(terms)
                d.update(seen)
            if sum(len(n) for n, _ in counts.values()) > HELD_TERMS:
                yield from flushed()
        yield from flushed()

    return rows.mapInArrow(of, COUNTS)


def frequency(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 5) / (total + 5 * terms)), exact; null without terms."""
    wide = "decimal(38,0)"
    return F.when(terms > 0, F.call_function(
        "div", (count + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"),
        (total + SMOOTH * terms).cast(wide)) + 1)


def _rows_of(baseline: np.ndarray, n_terms: int, own: np.ndarray, term: np.ndarray, p: np.ndarray) -> Iterator[np.ndarray]:
    """Row by row the block's part of the distances: for group 0, 1, ... an
    accumulator over all groups.  ``own``, ``term``, ``p``: the block's postings;
    ``n_terms`` counts the terms that stand at their baselines at first."""
    groups = len(baseline)
    by_term = np.lexsort((own, term))
    index_group, index_p = own[by_term], p[by_term]
    first = np.searchsorted(term[by_term], np.arange(term.max() + 2 if len(term) else 1))
    by_group = np.lexsort((p, own))
    rank, sorted_p, sorted_term = (own[by_group] << 32) | p[by_group], p[by_group], term[by_group]
    start = np.searchsorted(own[by_group], np.arange(groups + 1))
    below = np.r_[0, np.cumsum(sorted_p)]
    size, total = np.diff(start), below[start[1:]] - below[start[:-1]]
    peer = np.arange(groups)
    for g in range(groups):
        b = baseline[g]
        gap = np.abs(baseline - b)
        acc = n_terms * gap
        # the group's terms against the peers' baselines
        mine = sorted_p[start[g]:start[g + 1]]
        k = np.searchsorted(mine, baseline)
        low = below[start[g] + k] - below[start[g]]
        acc += baseline * k - low + (total[g] - low) - baseline * (size[g] - k) - size[g] * gap
        # the peers' terms against the group's baseline
        k = np.searchsorted(rank, (peer << 32) | b)
        low = below[k] - below[start[:-1]]
        k = k - start[:-1]
        acc += b * k - low + (total - low) - b * (size - k) - size * gap
        # terms that both have, through the index
        terms = sorted_term[start[g]:start[g + 1]]
        many = first[terms + 1] - first[terms]
        ends = np.cumsum(many)
        at = 0
        while at < len(terms):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SCATTER, side="right")))
            m = many[at:to]
            rows = np.repeat(first[terms[at:to]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            h, q, mp = index_group[rows], index_p[rows], np.repeat(mine[at:to], m)
            np.add.at(acc, h, np.abs(mp - q) - np.abs(mp - baseline[h]) - np.abs(b - q) + gap[h])
            at = to
        yield acc


def _accumulated(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Accumulators (lang, gid, acc) of all groups of a language, for one block."""
    table = pa.Table.from_batches(list(batches))
    lang, block = (k.as_py() for k in key)
    zero = table.filter(pc.is_null(table.column("term"))).sort_by("gid")
    posted = table.filter(pc.is_valid(table.column("term")))
    baseline = zero.column("p").to_numpy().astype(np.int64)
    codes = posted.column("term").combine_chunks().dictionary_encode().indices if len(posted) else pa.array([], pa.int32())
    # the first block stands for all terms of the language, at their baselines
    n_terms = int(zero.column("terms")[0].as_py()) if block == 0 else 0
    rows: list[bytes] = []
    done = 0
    for acc in _rows_of(baseline, n_terms, posted.column("gid").to_numpy().astype(np.int64),
                        codes.to_numpy(zero_copy_only=False).astype(np.int64), posted.column("p").to_numpy().astype(np.int64)):
        rows.append(acc.astype(np.int64).tobytes())
        if len(rows) * len(baseline) > 1 << 20 or done + len(rows) == len(baseline):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(rows), pa.string()), pa.array(range(done, done + len(rows)), pa.int64()),
                 pa.array(rows, pa.binary())], names=["lang", "gid", "acc"])
            done, rows = done + len(rows), []


def _added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for acc in batch.column("acc"):
            part = np.frombuffer(acc.as_py(), np.int64)
            total = part.copy() if total is None else total + part
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.string()), pa.array([key[1].as_py()], pa.int64()),
                                      pa.array([total], pa.list_(pa.int64()))], names=["lang", "gid", "row"])


def source_divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
                      least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS,
                      block_postings: tuple[int, int] = BLOCK_POSTINGS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair``, the distance to each
    other source of the language, and part ``term``, the terms in which a source
    exceeds its language most.

    Null text, lang and source are empty strings.  A group without terms is
    compared at its baseline; in a language without kept terms all distances
    are 0.  A language of one source has no pairs.  Repeated rows count each.
    An empty table gives no rows; other columns are ignored.

    A group or term that holds a third of all rows is counted in the tasks
    before it is shuffled; a language's index is split by term, so it lies in
    as many tasks as it has blocks.  What a task holds grows with the block
    (``block_postings``) and with the number of a language's sources.
    """
    group, both = ["lang", "source"], ["lang", "term"]
    counted = term_counts(docs, lang, source, text).groupBy(*group, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy(*both)
    kept = materialized(
        counted.withColumns({"in_docs": F.sum("docs").over(term), "lang_n": F.sum("n").over(term),
                             "one": (F.row_number().over(term.orderBy("source")) == 1).cast("long")})
        .filter(F.col("in_docs") >= least_docs).select(*group, "term", "n", "lang_n", "one"), "kept-terms")
    empty = F.lit("")
    named = docs.select(F.coalesce(F.col(lang), empty).alias("lang"), F.coalesce(F.col(source), empty).alias("source")).distinct()
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("one").alias("terms"),
                                     F.count(F.lit(1)).alias("postings"))
    sizes = kept.groupBy(*group).agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    whole = Window.partitionBy("lang")
    least, most = (F.lit(n).cast("long") for n in block_postings)
    peers = F.count(F.lit(1)).over(whole)
    in_block = F.least(F.greatest(peers * peers, least), most)
    groups = named.join(sizes, group, "left").join(langs, "lang", "left").select(
        *group, *[F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "terms")],
        F.coalesce(F.ceil(F.col("postings") / in_block), F.lit(1)).alias("blocks"))
    groups = materialized(groups.withColumn("gid", F.row_number().over(whole.orderBy("source")).cast("long") - 1), "groups")
    facts = broadcast_if_small(groups, 200)
    posted = kept.join(facts, group).withColumns({
        "p": frequency(F.col("n"), F.col("total"), F.col("terms")),
        "q": frequency(F.col("lang_n"), F.col("lang_total"), F.col("terms"))})

    over = posted.filter("p > q").select(*group, F.lit("term").alias("part"), F.col("term").alias("item"),
                                         (F.col("p") - F.col("q")).alias("value"))
    best = Window.partitionBy(*group, "part").orderBy(F.col("value").desc(), "item")
    over = over.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top_terms)

    columns = ["lang", "block", "gid", "term", "p", "terms"]
    postings = posted.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks"))).select(*columns)
    bases = groups.withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1))).select(
        "lang", "block", "gid", F.lit(None).cast("string").alias("term"),
        F.coalesce(frequency(zero, F.col("total"), F.col("terms")), zero).alias("p"), "terms")
    acc = postings.unionByName(bases).groupBy("lang", "block").applyInArrow(_accumulated, "lang string, gid long, acc binary")
    rows = acc.groupBy("lang", "gid").applyInArrow(_added, "lang string, gid long, row array<long>")
    names = groups.select("lang", "gid", "source")
    pairs = (rows.select("lang", "gid", F.posexplode("row").alias("peer", "value")).filter("peer != gid")
             .join(broadcast_if_small(names, 100), ["lang", "gid"])
             .join(broadcast_if_small(names.select("lang", F.col("gid").alias("peer"), F.col("source").alias("item")), 100),
                   ["lang", "peer"])
             .select(*group, F.lit("pair").alias("part"), "item", "value"))
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    return pairs.unionByName(over)


ORACLE_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
tokens AS (
  SELECT doc_id, lang, source,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM tokens GROUP BY ALL HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}),
langs AS (SELECT lang, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS terms FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM tokens GROUP BY ALL),
full_counts AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n::HUGEINT AS lang_n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
freq AS (
  SELECT lang, source, term, n,
    1 + ({SCALE}::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * terms)::HUGEINT AS p,
    1 + ({SCALE}::HUGEINT * (lang_n + 5)) // (total + 5 * terms) AS q
  FROM full_counts JOIN langs USING (lang)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
             FROM freq x JOIN freq y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) d
    ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM freq WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
