"""Quality rules against plain Python, line removal on a small host."""

import random
import re

from lakemart.llm import quality_rules as qr

SCHEMA = "doc_id long, text string, source string, kept int, _bad string"


def words(t):
    return re.findall(r"[^ \t\n\x0B\f\r]+", t or "")


def brute(t):
    w = words(t)
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    cover = {p + k for v in seen.values() if len(v) > 1 for p in v for k in range(3)}
    lines = [x for x in (t or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(cover))


def test_counts_by_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", " \t\n", "a", "a b", "a b c", "a b c a b c a", "é é é é", "x y z\x0bq\x0cw",
             "l\nl\n\n \nl x\n", "#*$%&|<>", "\ta b\r\n", "w " * 30_000, " ".join(map(str, range(20_000)))]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    rows = [(i, t, None if i % 5 == 0 else "h", 0, "") for i, t in enumerate(texts)] + [(3, "a", "h", 0, "")]
    out = qr.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    for r in out:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed)


def test_line_frequency_removes_and_rejects(spark):
    letter = "abcdefghijklmnopqrst"
    body = [" ".join(f"w{letter[i]}x{letter[k % 20]}{letter[k // 20]}" for k in range(60)) for i in range(12)]
    banner = " ".join(f"menu{letter[k % 20]}{letter[k // 20]}" for k in range(200))
    rows = [(i, f"{b}\n{banner.upper()}  {i}", "h", 0, "") for i, b in enumerate(body)]       # mostly banner
    rows += [(100 + i, f"{b}\nsmall   Print", "h", 0, "") for i, b in enumerate(body)]
    rows += [(200 + i, f"{body[0]}\ncopied line", "h", 0, "") for i in range(20)]             # one distinct document
    rows += [(300, f"{body[1]}\n{banner} 7", "other", 0, "")]
    out = {r.doc_id: r for r in qr.quality_rules(spark.createDataFrame(rows, SCHEMA), line_docs=5, line_share=0.1).collect()}
    assert not any(out[i].kept for i in range(12)) and not any(out[i].base_failed for i in range(12))
    assert all(out[100 + i].kept and out[100 + i].clean_text == b for i, b in enumerate(body))
    assert all(out[200 + i].kept and out[200 + i].n_line_words == 0 for i in range(20))
    assert out[300].kept and out[300].n_line_words == 0


def test_production_limits_fire_at_every_size(spark):
    """The same share of a small and a larger host loses its line; two documents are too few."""
    def host(name, at, n, n_banner):
        body = ["\n".join(" ".join(f"{name}{chr(97 + i // 26)}{chr(97 + i % 26)}q{chr(97 + k // 26)}{chr(97 + k % 26)}"
                                   for k in range(r, r + 20)) for r in (0, 20, 40)) for i in range(n)]
        return [(at + i, b + ("\nRead more: page 7" if i < n_banner else ""), name, 0, "") for i, b in enumerate(body)]

    rows = host("small", 0, 20, 3) + host("large", 1000, 200, 30) + host("two", 2000, 20, 2)
    out = {r.doc_id: r for r in qr.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i for i, r in out.items() if r.n_line_words} == {*range(3), *range(1000, 1030)}
    assert out[0].n_line_words == 4 and out[0].clean_text == rows[0][1].rsplit("\n", 1)[0]
    assert all(r.kept for r in out.values())


def test_empty_table(spark):
    assert qr.quality_rules(spark.createDataFrame([], SCHEMA)).count() == 0
