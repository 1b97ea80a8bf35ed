"""Token files: exact round trips, and the tokenizers library on whole texts."""

import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakemart.llm import token_files as tf
from lakemart.session import scratch_path

FILE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start int, ids string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def brute(rows, tokenizer):
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def digests(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    out = tf.token_file_digests(df, FILE, **kw).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    return sorted((tuple(r) for r in out), key=lambda r: r[1])


def texts():
    odd = ["", None, " \n\t", "don't we'll 's", "<|endoftext|> a<|startoftext|>b", "é ́x", "a\x01b \x01 \x01\x01", "\x00 z\x1f",
           "ΣΑΣ İstanbul", "日本語 テキスト", "a b c\x85d", "x." * 50, "...!? «ok»", "﻿bom", "🙂🙂 👍🏽"]
    return [(i * 3, t) for i, t in enumerate(odd)]


@pytest.mark.parametrize("options", [{}, {"shard_ids": 40, "grammar_ids": 16}, {"by_word": False}])
def test_matches_the_library(spark, tokenizer, options):
    """Odd texts, null ids and texts, a text over many grammars, tiny shards."""
    rng = random.Random(1)
    rows = texts() + [(1, " ".join(rng.choice(["aa", "bb", "cc dd", "Eé."]) for _ in range(400))), (None, "no id")]
    assert digests(spark, rows, **options) == brute(rows, tokenizer)


def test_repeated_ids_and_rows(spark, tokenizer):
    rows = [(5, "same text")] * 40 + [(5, "other"), (4, "before"), (6, "after")]
    got = digests(spark, rows)
    assert sorted(r[0::2] for r in got) == sorted(r[0::2] for r in brute(rows, tokenizer))
    assert [r[0] for r in got] == sorted(r[0] for r in got)
    assert [r[1] for r in got] == [sum(x[2] for x in got[:i]) for i in range(len(got))]


def test_empty_table(spark):
    assert digests(spark, []) == []


def test_words_agree_with_whole_texts(tokenizer, monkeypatch, sf):
    """Real texts, cut in pieces, with a memory of few words."""
    monkeypatch.setattr(tf, "PIECE", 700)
    words = tf.WordIds(open(FILE).read(), bound=3000)
    docs = duckdb.sql(f"SELECT text FROM '{sf}/documents.parquet' WHERE text IS NOT NULL").fetchall()
    some = [t.encode() for t, in docs[:50]]
    assert [x.tolist() for x in words.many(some)] == [tokenizer.encode(t.decode(), add_special_tokens=False).ids for t in some]
    for t in [t for t, in docs] + [t for _, t in texts() if t]:
        got = np.concatenate([np.empty(0, np.uint32), *words.pieces(t.encode())])
        assert got.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


ODD = ["H\u0331 h\u0331 J\u030c T\u0308x W\u030a A\u0301B É e\u0301 E\u0301", "<|EndOfText|> x<|ENDOFTEXT|>y <|endoftext|> A<|startoftext|>B",
       "\u212aelvin Œuvre ŒUVRE Ÿ ÿ. ǅ ǆ Ⱥ ⱥ Ƀ Ɓ İx iİ ı SS ß ẞ Σας ΟΔΟΣ", "don't DON'T, it'S's 'S 'Tis x.'t a'LL.", "a’, a’ a», «A a&&& a&. a.### A..% $$$ ... a|| a>b <",
       "x" + "".join(f"{chr(c)}Y" for c in range(1, 128)), "A\x85b a\xa0B \u3000c\u2028D", "ªº ŉ ǰ ſ ﬁ ﬀ ℃ Å", "１２ 3² x2 Ⅷ ⅷ", "日本 Ж ж, ЖЖ. ǆ! " * 3]


@pytest.mark.parametrize("bound", [3, 600_000])
def test_letters_without_the_split(tokenizer, bound):
    """Case, marks, punctuation and added tokens beside letters; a memory that is always full."""
    words = tf.WordIds(open(FILE).read(), bound=bound)
    assert words.model and words.lower
    for texts in [[t] for t in ODD] + [ODD, [t.swapcase() for t in ODD], []]:
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in words.many([t.encode() for t in texts])] == want


def test_letters_are_encoded_once(tokenizer):
    """Words that differ in case of A-Z or punctuation cost one call of the model."""
    words, calls = tf.WordIds(open(FILE).read()), []

    class Model:
        def tokenize(self, run, model=words.model):
            calls.append(run)
            return model.tokenize(run)

    words.model = Model()
    texts = ["Grammar grammar, GRAMMAR. grammar", "grammar### gRammar&&& été été. éTé,"]
    assert [x.tolist() for x in words.many([t.encode() for t in texts])] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(calls) == 2


@pytest.mark.parametrize("change", [
    lambda m: m.update(normalizer={"type": "NFC"}),
    lambda m: m["normalizer"]["normalizers"].append({"type": "Replace", "pattern": {"String": "a"}, "content": "b"}),
    lambda m: m["pre_tokenizer"]["pretokenizers"][0].update(pattern={"Regex": "[^\\s,]+|,"}),
    lambda m: m["added_tokens"].append({**m["added_tokens"][0], "id": 49408, "content": "Abc.", "special": False})])
def test_words_of_other_tokenizers(change):
    """Case kept, letters replaced, punctuation kept with letters, an added token of letters."""
    import json
    model = json.load(open(FILE))
    change(model)
    model = json.dumps(model)
    whole, words = Tokenizer.from_str(model), tf.WordIds(model)
    for t in ["Abc abc, ABC. a,b xAbc.x", *[t for t in ODD if "\xa0" not in t]]:
        assert words.many([t.encode()])[0].tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_sorted_with_and_without_room_for_places():
    key = np.random.default_rng(1).integers(0, 50, 1000)
    for bits in (6, 60):
        ordered, order = tf._sorted(key, bits)
        assert ordered.tolist() == sorted(key.tolist()) and order.tolist() == np.argsort(key, kind="stable").tolist()


@pytest.mark.parametrize("ids", [[], [7], [7, 7], [7] * 1001, list(range(500)), [1, 2, 3] * 300 + [2, 3, 4] * 200,
                                 np.random.default_rng(0).zipf(1.5, 20_000).clip(max=900).tolist()])
def test_grammar_round_trip(ids):
    ids = np.array(ids, np.uint32)
    grammar = tf.Grammar(tf.grammar_blob(ids, 1000))
    assert grammar.ids().tolist() == ids.tolist()
    for start in range(0, len(ids), 97):
        assert grammar.ids(start, start + 131).tolist() == ids[start:start + 131].tolist()


def test_frequent_pairs_become_rules():
    """A repeated phrase shrinks to few symbols; rules expand to their stated lengths."""
    ids = np.tile(np.arange(1, 9, dtype=np.uint32), 500)
    left, right, seq = tf.re_pair(ids, 100)
    assert len(seq) < len(ids) / 7 and len(left) == len(right) >= 7
    grammar = tf.Grammar(tf.grammar_blob(ids, 100))
    assert max(grammar.size) >= 8 and grammar.size[grammar.seq].sum() == len(ids)


@pytest.mark.parametrize("ids", [[7] * 1001, [7, 7, 7, 7], list(range(300)) * 2, [1, 2, 9, 1, 2, 8, 1, 2],
                                 np.random.default_rng(3).zipf(1.4, 30_000).clip(max=5000).tolist()])
def test_rounds_go_on_until_no_pair_repeats(ids):
    """No pair of the remaining sequence has two places that don't overlap."""
    left, right, seq = tf.re_pair(np.array(ids, np.uint32), 6000)
    last, places = {}, {}
    for i, pair in enumerate(zip(seq.tolist()[:-1], seq.tolist()[1:], strict=True)):
        if i > last.get(pair, -2) + 1:
            last[pair] = i
            places[pair] = places.get(pair, 0) + 1
    assert max(places.values(), default=1) == 1
    grammar = tf.Grammar(tf.grammar_blob(np.array(ids, np.uint32), 6000))
    assert grammar.ids().tolist() == ids


def test_random_access_by_document(spark, tokenizer):
    """A document is read from its shard without the documents around it."""
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(60)]
    path = scratch_path(spark, "tokens")
    tf.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), path, FILE, shard_ids=100, grammar_ids=32)
    shards = [tf.Shard(bytes(r.data)) for r in spark.read.parquet(path).collect()]
    found = {d: s.doc(i).tolist() for s in shards for i, d in enumerate(s.doc_ids)}
    assert found == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in rows}
    with pytest.raises(ValueError):
        tf.Shard(b"????")
