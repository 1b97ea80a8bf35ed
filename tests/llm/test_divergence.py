"""Source divergence against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from lakemart.llm import divergence

SCHEMA = "doc_id long, lang string, source string, text string, term int, rank string"
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, least=3, top=5):
    in_docs, counts = defaultdict(Counter), defaultdict(Counter)
    for _, lang, source, text in rows:
        t = terms_of(text)
        counts[lang or "", source or ""].update(t)
        in_docs[lang or ""].update(set(t))
    kept = {a: sorted(t for t in c if c[t] >= least) for a, c in in_docs.items()}

    def freq(c, lang):
        v, n = len(kept[lang]), sum(c[t] for t in kept[lang])
        return {t: 1 + 1_000_000_000 * (c[t] + 5) // (n + 5 * v) for t in kept[lang]}

    out = []
    for (lang, source), c in counts.items():
        p, q = freq(c, lang), freq(sum((x for (a, _), x in counts.items() if a == lang), Counter()), lang)
        pairs = [(b, sum(abs(p[t] - r[t]) for t in p)) for (a, b), x in counts.items() if a == lang and b != source
                 for r in [freq(x, lang)]]
        terms = [(t, p[t] - q[t]) for t in p if c[t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, *x, i + 1) for i, x in enumerate(found[:most])]
    return sorted(out)


def corpus(n=150, seed=3):
    rng = random.Random(seed)
    vocab = ["the", "The", "äb", "b", "c-d", "éé", "x1y", "日本", "zq"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(i, rng.choice(["en", "en", "fr", None]), rng.choice(["hot", "hot", "hot", "s1", "s2", None]),
             " ".join(rng.choice(vocab[k % 4:]) for k in range(rng.randint(0, 40)))) for i in range(n)]
    rows += [(1, "en", "hot", "the the the b")] * 12             # repeated rows count each
    rows += [(900, "de", "one", "kurz"), (901, "de", "two", None), (902, "de", None, ""), (903, "xx", "alone", "word")]
    return rows + [(904, "en", "s1", "the " * 5000), (905, "en", "empty", "1 2 3")]


def result(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in divergence.source_divergence(df, **kw).select(
        "lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("block_postings", [(1, 7), (50_000, 2_000_000)])
def test_matches_brute_force(spark, block_postings):
    """One block a language, and many; groups without terms and languages without kept terms stay."""
    rows = corpus()
    got = result(spark, rows, least_docs=3, top_terms=5, block_postings=block_postings)
    assert got == brute(rows)
    assert ("de", "", "pair", "one", 0, 1) in got


def test_scatter_in_pieces(monkeypatch):
    """The index is scattered bit by bit when a group's terms reach many postings."""
    import numpy as np
    rng = np.random.default_rng(1)
    own, term = np.divmod(np.flatnonzero(rng.random(6 * 50) < 0.5), 50)
    p, base = rng.integers(100, 2000, len(own)), rng.integers(1, 100, 6)
    dense = np.repeat(base[:, None], 50, axis=1)
    dense[own, term] = p
    expected = np.abs(dense[:, None] - dense[None]).sum(-1)
    for size in (1, 7, 1 << 21):
        monkeypatch.setattr(divergence, "SCATTER", size)
        assert (np.array(list(divergence._rows_of(base, 50, own, term, p))) == expected).all()


def test_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 10)
    text = "Ünïcode, words; and MORE-words " * 20
    got = [t.decode() for piece in divergence._pieces(text.encode()) for t in piece]
    assert got == terms_of(text)


def test_empty_table(spark):
    assert result(spark, []) == []
