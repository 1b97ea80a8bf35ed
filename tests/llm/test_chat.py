"""Chat formatting against a plain Python rendering."""

import hashlib

from pyspark.sql import functions as F

from lakemart.llm import chat


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


ROWS = [
    (1, 1, "assistant", "a <|im_end|> b"), (1, 0, "user", "\\p \\b \\ <s></s>[INST]x[/INST]"),
    (1, 2, "assistant", ""), (1, 3, "assistant", None), (1, 4, "user", "<|im_start|>user\nfoo<"),
    (2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (2, 0, "user", "tie"),
    (3, None, None, "a\nb"), (3, 0, "ro\nle<|", "<<|im_next|><<SYS>>"), (None, 0, "user", "é" * 5000),
    (4, 0, "", None),
]


def expect(rows):
    out = {}
    for c, t, r, x in sorted(rows, key=lambda v: (v[1] is not None, v[1] or 0, v[2] or "", v[3] or "")):
        out.setdefault(c, []).append((r or "", x or ""))
    return out


def test_round_trip_merge_and_loss(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    df = df.withColumn("formatted", F.lit(1)).withColumn("segments", F.lit(2))
    f = chat.format_chats(df)
    got = {r.conv_id: r for r in f.withColumn("turns", chat.parse_turns(F.col("formatted")))
           .withColumn("loss", chat.loss_text(F.col("segments"))).collect()}
    digests = {r.conv_id: r for r in chat.chat_digests(f).collect()}
    want = expect(ROWS)
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [(t.role, t.text) for t in got[c].turns] == turns
        assert got[c].loss == "".join(x for r, x in turns if r == "assistant")
        assert got[c].formatted == "".join(s.text for s in got[c].segments)
        runs = sum(i == 0 or turns[i - 1][0] != r for i, (r, _) in enumerate(turns))
        assert got[c].formatted.count(chat.OPEN) == got[c].formatted.count(chat.CLOSE) == runs
        assert "[INST]" not in got[c].formatted
        d = digests[c]
        assert (d.n_turns, d.turns_sha256) == (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)))
        assert d.loss_sha256 == sha(got[c].loss) and d.formatted_chars == len(got[c].formatted)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.chat_digests(chat.format_chats(df)).count() == 0


def test_no_python_in_plan(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    plan = chat.chat_digests(chat.format_chats(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
