"""Operator 1, quality rules with cross-document line frequency: Spark expressions only.

Lines are normalised (digits, case, white space) and hashed; for each host the
distinct documents of each line hash are counted; lines above the limit are
boilerplate and removed; a document of which too little is left is depleted
and rejected.  Basic rules (length, repeated words) are counted per text.

The lines of a text are taken once per host and distinct text: copies on one
host are one document when lines are counted, and share one verdict.  That
table of line hashes (not of texts) is written to the checkpoint folder.  Hot
lines and hosts are pre-aggregated before they are shuffled, and the join that
finds removed lines is left to Spark's skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import WS, checkpointed, let, word_array

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A line is boilerplate of a host above this share of the host's distinct
#: documents, whatever the host's size; LINE_DOCS only keeps a line of one or two
#: documents out (at least 3 are needed), so it decides for hosts under 150.
LINE_DOCS, LINE_SHARE = 2, 0.02
#: A document is depleted when a smaller share of its words is left.
MIN_LEFT = 0.3


def normal_line(line: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(F.regexp_replace(line, "[0-9]+", "0"), WS, " ")))


def repeated_words(words: Column, n: int = 3) -> Column:
    """Words lying in ``n``-word windows found twice or more, first included.

    Windows are compared by 64-bit hash within one text.  Texts without a
    repeat skip the sort; positions are merged in one left-to-right pass.
    """
    def hashes(w):
        return F.when(F.size(w) >= n, F.transform(
            F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)])
        )).otherwise(F.array().cast("array<bigint>"))

    def twice(sorted_pairs):
        return F.array_sort(F.transform(F.filter(sorted_pairs, lambda p, i: (
            F.coalesce(p["h"] == F.get(sorted_pairs, i - 1)["h"], F.lit(False))
            | F.coalesce(p["h"] == F.get(sorted_pairs, i + 1)["h"], F.lit(False)))), lambda p: p["i"]))

    def covered(positions):
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(positions, start, lambda a, p: F.struct(
            (a["n"] + p + n - F.greatest(p, a["end"])).cast("long").alias("n"), (p + n).alias("end")))["n"]

    def count(h):
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(pairs, lambda s: covered(twice(s)))
                      ).otherwise(F.lit(0).cast("long"))

    return let(words, lambda w: let(hashes(w), count))


def base_rules(text: Column) -> Column:
    """struct<n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words> of a text."""
    def duplicates(lines):
        return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    return let(word_array(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, WS, "")).cast("long").alias("word_chars"),
        F.size(F.regexp_extract_all(text, F.lit(SYMBOLS), F.lit(0))).cast("long").alias("n_symbols"),
        let(lines, duplicates).alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words")))


def _line_hashes(text: Column) -> Column:
    """array<struct<h, words>> of the lines that have a word."""
    return F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.struct(
        F.xxhash64(normal_line(x)).alias("h"), F.size(word_array(x)).alias("words"))), lambda s: s["words"] > 0)


def boilerplate_lines(contents: DataFrame, line_docs: int, line_share: float) -> DataFrame:
    """(_host, h): lines found in too many distinct documents of a host."""
    counts = (contents.select("_host", F.explode(F.array_distinct(F.transform("_lines", lambda s: s["h"]))).alias("h"))
              .groupBy("_host", "h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > line_docs))
    hosts = contents.groupBy("_host").agg(F.count(F.lit(1)).alias("host_docs"))
    c, d = counts.alias("c"), hosts.alias("d")
    return (c.join(d, F.col("c._host").eqNullSafe(F.col("d._host")))
            .filter(F.col("n") > line_share * F.col("host_docs")).select("c._host", "h"))


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
                  line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE,
                  min_left: float = MIN_LEFT) -> DataFrame:
    """One row per input row: doc_id, the basic counts, base_failed, n_line_words
    (words of removed lines), kept, clean_text (the text without removed lines).

    ``kept`` is false when the basic rules fail or fewer than ``min_left`` of
    the words are left.  A null or blank text has no words and fails.  A null
    host is a host.  Repeated rows get equal rows.  An empty table gives no
    rows.  Other columns are ignored, whatever their names.  ``clean_text`` is
    only computed where it is selected.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(host).alias("_host"), body.alias("_text"),
                       F.md5(body).alias("_digest"))
    contents = checkpointed(rows.select("_host", "_digest", _line_hashes(F.col("_text")).alias("_lines"))
                            .groupBy("_host", "_digest").agg(F.first("_lines").alias("_lines")))
    bad = boilerplate_lines(contents, line_docs, line_share).alias("b")
    lines = contents.select("_host", "_digest", F.inline("_lines")).alias("l")
    removed = (lines.join(bad, F.col("l._host").eqNullSafe(F.col("b._host")) & (F.col("l.h") == F.col("b.h")))
               .groupBy("l._host", "l._digest")
               .agg(F.sum("words").cast("long").alias("_gone"), F.collect_set("l.h").alias("_bad"))).alias("g")
    base = rows.select("_id", "_host", "_digest", "_text", base_rules(F.col("_text")).alias("_b")).alias("r")
    out = base.join(removed, F.col("r._host").eqNullSafe(F.col("g._host"))
                    & (F.col("r._digest") == F.col("g._digest")), "left")
    b = F.col("_b")
    failed = (b["n_words"] < MIN_WORDS) | (100 * b["n_repeat_words"] > MAX_REPEAT_PERCENT * b["n_words"])
    gone = F.coalesce(F.col("_gone"), F.lit(0).cast("long"))
    clean = F.when(F.col("_bad").isNull(), F.col("_text")).otherwise(F.array_join(F.filter(
        F.split("_text", "\n", -1), lambda x: ~F.array_contains(F.col("_bad"), F.xxhash64(normal_line(x)))), "\n"))
    return out.select(
        F.col("_id").alias(doc_id), *[b[c].alias(c) for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"), gone.alias("n_line_words"),
        (~failed & (b["n_words"] - gone >= min_left * b["n_words"])).alias("kept"), clean.alias("clean_text"))


_WS = r"[ \t\n\x0B\f\r]+"
_NORM = rf"trim(lower(regexp_replace(regexp_replace(line, '[0-9]+', '0', 'g'), '{_WS}', ' ', 'g')))"
ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
a AS (SELECT *, list_filter(regexp_split_to_array(text, '{_WS}'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines FROM d),
w AS (SELECT rid, unnest(words) AS w0, generate_subscripts(words, 1) AS pos FROM a),
t AS (SELECT rid, pos, w0, lead(w0, 1) OVER o AS w1, lead(w0, 2) OVER o AS w2 FROM w WINDOW o AS (PARTITION BY rid ORDER BY pos)),
r AS (SELECT rid, pos, count(*) OVER (PARTITION BY rid, w0, w1, w2) AS n FROM t WHERE w2 IS NOT NULL),
p AS (SELECT DISTINCT rid, unnest([pos, pos + 1, pos + 2]) AS pos FROM r WHERE n > 1),
q AS (SELECT rid, count(*) AS n_repeat_words FROM p GROUP BY rid),
l0 AS (SELECT rid, unnest(lines) AS line FROM a),
l AS (SELECT l0.rid, d.source, md5(d.text) AS digest, {_NORM} AS line,
        len(list_filter(regexp_split_to_array(line, '{_WS}'), lambda x: x <> '')) AS words FROM l0 JOIN d USING (rid)),
f AS (SELECT source, line, count(DISTINCT digest) AS n FROM l GROUP BY source, line),
h AS (SELECT source, count(DISTINCT md5(text)) AS host_docs FROM d GROUP BY source),
b AS (SELECT f.source, f.line FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source
      WHERE n > {LINE_DOCS} AND n > {LINE_SHARE} * host_docs),
g AS (SELECT l.rid, CAST(sum(words) AS BIGINT) AS gone FROM l JOIN b
      ON l.source IS NOT DISTINCT FROM b.source AND l.line = b.line GROUP BY l.rid),
z AS (SELECT a.rid, doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '{_WS}', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(gone, 0) AS n_line_words
      FROM a LEFT JOIN q USING (rid) LEFT JOIN g USING (rid)),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM z)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_line_words,
  NOT base_failed AND n_words - n_line_words >= {MIN_LEFT} * n_words AS kept FROM v
"""
