"""Operator 9, chat formatting: relational, Spark expressions only.

Turns of a conversation are collected as structs and sorted; adjacent turns of
one role are merged into a block by array functions; the blocks are
concatenated under a template.  Nothing runs outside the JVM.

Template, one block per run of equal roles::

    <|im_start|>ROLE \\n TEXT [<|im_next|> TEXT]... <|im_end|> \\n

Control strings inside roles and texts are escaped reversibly: every backslash
becomes ``\\b``, then ``\\p`` is put behind the first character of each control
string.  After the first step a backslash is always followed by ``b``, so
deleting ``\\p`` and turning ``\\b`` back is exact.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import let

OPEN, NEXT, CLOSE = "<|im_start|>", "<|im_next|>", "<|im_end|>\n"
#: ``<|`` guards this template's own markers; the others belong to templates
#: that a trainer may apply later.
CONTROL = ("<|", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>")


def escape(text: Column, control=CONTROL) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    for c in control:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\p" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\p"), F.lit("")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column, control=CONTROL) -> Column:
    """As ``escape``; a line feed, which ends the role, becomes ``\\l``."""
    return F.replace(escape(role, control), F.lit("\n"), F.lit("\\l"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\l"), F.lit("\n")))


def _segment(text: Column, loss) -> Column:
    return F.struct(text.alias("text"), (loss if isinstance(loss, Column) else F.lit(loss)).alias("loss"))


def _blocks(turns: Column) -> Column:
    """array<struct<role, texts>>: adjacent turns of one role merged."""
    def merged(turns, starts):
        return F.transform(starts, lambda s, k: F.struct(
            F.get(turns, s)["role"].alias("role"),
            F.transform(F.slice(turns, s + 1, F.coalesce(F.get(starts, k + 1), F.size(turns)) - s),
                        lambda t: t["text"]).alias("texts")))

    def first_turns(turns):
        return F.filter(F.sequence(F.lit(0), F.size(turns) - 1), lambda i: (
            (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"])))

    return let(turns, lambda t: let(first_turns(t), lambda s: merged(t, s)))


def _segments(blocks: Column, loss_roles) -> Column:
    """array<struct<text, loss>>: the formatted text cut at its loss mask."""
    def texts(b):
        trained = b["role"].isin(*loss_roles)
        return F.flatten(F.transform(b["texts"], lambda t, i: F.when(
            i == 0, F.array(_segment(escape(t), trained))).otherwise(
            F.array(_segment(F.lit(NEXT), False), _segment(escape(t), trained)))))

    return F.flatten(F.transform(blocks, lambda b: F.concat(
        F.array(_segment(F.concat(F.lit(OPEN), escape_role(b["role"]), F.lit("\n")), False)),
        texts(b), F.array(_segment(F.lit(CLOSE), False)))))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", loss_roles=("assistant",)) -> DataFrame:
    """One row per conversation: ``conv``, ``formatted`` and its loss mask.

    ``segments`` (array of text and loss flag) concatenates to ``formatted``;
    ``loss`` is true on the texts of ``loss_roles`` alone, never on markers.

    Turns are ordered by (turn, role, text): ties have one result, repeated
    rows stay repeated.  Null role or text is empty, a null turn comes first,
    a null conversation id is a conversation.  Other columns are ignored.  An
    empty table gives no rows.  A conversation is one output row, so its turns
    meet in one row by definition; texts are moved once, in one shuffle.
    """
    rows = turns.select(
        F.col(conv).alias("_conv"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                 F.coalesce(F.col(text), F.lit("")).alias("text")).alias("_turn"))
    grouped = rows.groupBy("_conv").agg(F.collect_list("_turn").alias("_turns"))
    out = grouped.select("_conv", _segments(_blocks(F.array_sort("_turns")), loss_roles).alias("segments"))
    return out.select(F.col("_conv").alias(conv),
                      F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def parse_turns(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns read back from a formatted text."""
    def block(b):
        return let(F.substring_index(b, "\n", 1), lambda head: let(
            F.substr(b, F.length(head) + 2, F.length(b) - F.length(head) - 1 - len(CLOSE)),
            lambda body: F.transform(
                F.split(body, re.escape(NEXT), -1),
                lambda t: F.struct(unescape_role(head).alias("role"), unescape(t).alias("text")))))

    return F.flatten(F.transform(
        F.filter(F.split(formatted, re.escape(OPEN), -1), lambda b: b != F.lit("")), block))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def chat_digests(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Counts and digests read back from ``format_chats``'s output."""
    turns, loss = parse_turns(F.col("formatted")), loss_text(F.col("segments"))
    read = formatted.select(F.col(conv), F.length("formatted").cast("long").alias("formatted_chars"),
                            F.array_join(F.transform(turns, lambda t: F.concat(
                                t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("_t"),
                            F.size(turns).cast("long").alias("n_turns"), loss.alias("_l"))
    return read.select(conv, "n_turns", F.sha2("_t", 256).alias("turns_sha256"),
                       F.length("_l").cast("long").alias("loss_chars"), F.sha2("_l", 256).alias("loss_sha256"),
                       "formatted_chars")


def _sql_escape(x: str) -> str:
    out = f"replace({x}, '\\', '\\b')"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\p{c[1:]}')"
    return out


ORACLE_SQL = f"""
WITH extra AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM extra),
w AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS prev FROM t),
m AS (SELECT *, prev IS NULL OR prev <> role AS first,
        role || chr(10) || text || chr(10) AS line,
        length({_sql_escape('text')}) AS text_chars,
        length(replace({_sql_escape('role')}, chr(10), '\\l')) AS role_chars FROM w)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(line, '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_chars + CASE WHEN first THEN {len(OPEN)} + role_chars + 1 + {len(CLOSE)} ELSE {len(NEXT)} END) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""
