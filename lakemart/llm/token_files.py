"""Operator 11, token ids in files, compressed by Re-Pair grammars.

Texts are dealt to shards by ranges of doc_id, encoded in the tasks and written
in order.  A shard is cut into grammars of a bounded number of ids.  A grammar
repeatedly replaces the frequent pairs of neighbouring ids by new ids
(nonterminals); it stores its rules, how many ids each symbol of the remaining
sequence expands to, and that sequence.  Sums of the expansion lengths find the
symbols of any range of ids, so one document is read without expanding others.

The shards travel as one binary value a row in Parquet files that Spark writes
and commits, on any file system that Spark knows; lost tasks are written anew.

Layout of a shard (integers little-endian): ``LMTK``, then a ``pack`` of
  doc ids (int64) | 1 where the id is null (uint8) | ids per document (int64) |
  end of each grammar in the shard, in ids (int64) | width of ids (int64) | one pack for each grammar:
    left parts of the rules (uint32) | right parts (uint32) | sequence (uint32) | first new id (int64)
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.llm.common import pack, partitions_for, unpack, utf8

MAGIC = b"LMTK"
END_ID = 1
GRAMMAR_IDS = 1 << 20           # ids of one grammar
SHARD_IDS = 1 << 20             # a shard ends with the document that reaches so many
LEAST_PAIRS = 2                 # a pair found less often makes no rule
HELD_WORDS = 600_000            # runs of letters that a worker remembers, twice, and other words
PIECE = 1 << 20                 # bytes of a text encoded at once

SHARD = "part int, shard long, docs long, ids long, data binary"


# ---- Re-Pair ------------------------------------------------------------------

def _sorted(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys below 2 ** ``bits`` ascending, their places): place and key are sorted as one number if they fit."""
    low = max(len(key) - 1, 0).bit_length()
    if bits + low > 63:
        order = np.argsort(key, kind="stable")
        return key[order], order
    both = np.sort(key << low | np.arange(len(key)))
    return both >> low, both & ((1 << low) - 1)


def _frequent_pairs(key: np.ndarray, bits: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, rank): pairs that occur ``least`` times or more, most frequent first,
    and for each key, below 2 ** ``bits``, the rank of its pair (their number: not frequent)."""
    ordered, order = _sorted(key, bits)
    cut = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    counts = np.diff(np.r_[cut, len(key)])
    often = np.flatnonzero(counts >= least)
    often = often[_sorted(len(key) - counts[often], len(key).bit_length())[1]]     # of equal ones the smaller pair first
    to = np.full(len(counts), len(often), np.int32)
    to[often] = np.arange(len(often), dtype=np.int32)
    rank = np.empty(len(key), np.int32)
    rank[order] = np.repeat(to, counts)
    return ordered[cut[often]], rank


def _places(near: np.ndarray, rank: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(which, used) of the pairs to replace, of some that follow each other and are
    ranked below ``n``; ``near``: whether each overlaps the one before it.  No two of
    them overlap, and each pair that is used has two places or more.  None at all only
    if no pair has two places."""
    which = None                        # all
    while True:
        left, right = np.full((2, len(rank)), n, rank.dtype)
        np.copyto(left[1:], rank[:-1], where=near[1:])
        np.copyto(right[:-1], rank[1:], where=near[1:])
        hit = rank < left
        run = np.flatnonzero(rank == left)      # a pair after itself: one symbol, repeated
        if len(run):                    # every second place of a run
            first = np.cumsum(np.r_[True, np.diff(run) > 1]) - 1
            hit[run[(run - run[np.searchsorted(first, first)]) % 2 == 1]] = True
        hit &= rank <= right
        won = rank[hit]
        used = np.bincount(won, minlength=n) >= 2
        if not len(won) or used.any():
            hit = np.flatnonzero(hit)[used[won]]
            return hit if which is None else which[hit], used
        # what won one place and lost none to another can't be replaced twice: the pairs beside it may
        lost, beaten = np.zeros(n, bool), rank[(left < rank) | (right < rank)]
        lost[won] = True
        lost[beaten] = False
        stay = np.flatnonzero(~lost[rank])
        near = np.r_[False, near[stay[1:]] & (np.diff(stay) == 1)] if len(stay) else near[stay]
        which, rank = stay if which is None else which[stay], rank[stay]


def re_pair(ids: np.ndarray, first: int, least: int = LEAST_PAIRS):
    """(left, right, sequence): rules of the symbols ``first``, ``first`` + 1, ...

    A round takes all frequent pairs at once; where occurrences overlap, the
    more frequent pair wins, the first of equal ones.  Rounds end when no pair
    is left that occurs ``least`` times and can be replaced twice.  After the
    first, a round counts the pairs that were frequent and those of a new symbol:
    no other can have become frequent.  Symbols stay where they are, each knows
    the one before and after it, so a round costs what it counts."""
    n = len(ids)
    seq, left, right = ids.astype(np.int64), [], []
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    new, at, again, stays = first, np.arange(max(n - 1, 0), dtype=np.int32), np.zeros(n + 1, bool), np.ones(n, bool)
    bits = max(first + n, int(seq.max(initial=0)) + 1).bit_length()
    while len(at):
        pairs, rank = _frequent_pairs((seq[at] << bits) | seq[after[at]], 2 * bits, least)
        often = rank < len(pairs)
        at, rank = at[often], rank[often]
        hit, used = _places(np.r_[False, after[at[:-1]] == at[1:]][:len(at)], rank, len(pairs))
        if not len(hit):
            break
        place = at[hit]
        left.append(pairs[used] >> bits)
        right.append(pairs[used] & ((1 << bits) - 1))
        seq[place] = (np.cumsum(used) - 1 + new)[rank[hit]]
        new += int(used.sum())
        gone = after[place]
        stays[gone] = False
        after[place] = after[gone]
        before[after[place]] = place
        found = [at, place, np.maximum(before[place], 0)]
        if len(at) > n >> 5:
            for some in found:
                again[some] = True
            found = np.flatnonzero(again).astype(np.int32)
            again[found] = False
        else:
            found = np.unique(np.concatenate(found))
        at = found[stays[found] & (after[found] < n)]
    rules = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right)]
    return rules[0].astype(np.uint32), rules[1].astype(np.uint32), seq[stays].astype(np.uint32)


def _joined(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The stretches ``which`` of ``flat`` one after the other; ``begin`` and ``size`` of all stretches."""
    n = size[which]
    place = np.repeat(begin[which] - (np.cumsum(n) - n), n)
    place += np.arange(len(place))
    return flat[place]


class Grammar:
    """A sequence of ids behind its rules, read by ranges."""

    def __init__(self, blob: bytes):
        left, right, seq, first = unpack(blob)
        self.first = int(np.frombuffer(first, np.int64)[0])
        self.left, self.right = (np.frombuffer(x, np.uint32).astype(np.int64) for x in (left, right))
        self.seq = np.frombuffer(seq, np.uint32).astype(np.int64)
        # all symbols' expansions one after the other: an id is its own
        size, rounds = np.ones(self.first + len(self.left), np.int64), list(self._rounds())
        for lo, hi in rounds:
            size[self.first + lo:self.first + hi] = size[self.left[lo:hi]] + size[self.right[lo:hi]]
        self.size, self.begin = size, np.cumsum(size) - size
        self.flat = np.empty(int(size.sum()), np.uint32)
        self.flat[:self.first] = np.arange(self.first)
        for lo, hi in rounds:           # a rule's expansion: those of its parts
            to = int(self.begin[self.first + lo])
            flat = self._expanded(np.stack([self.left[lo:hi], self.right[lo:hi]], 1).ravel())
            self.flat[to:to + len(flat)] = flat
        self.ends = np.cumsum(size[self.seq])

    def _rounds(self) -> Iterator[tuple[int, int]]:
        """Runs of rules that use no rule of their own run."""
        newest, at = np.maximum(self.left, self.right) - self.first, 0
        while at < len(newest):
            late = np.flatnonzero(newest[at:] >= at)
            to = at + int(late[0]) if len(late) else len(newest)
            yield at, to
            at = to

    def _expanded(self, symbols: np.ndarray) -> np.ndarray:
        return _joined(self.flat, self.begin, self.size, symbols)

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids from ``start`` to ``stop``: only the symbols that cover them are expanded."""
        stop = len(self) if stop is None else min(stop, len(self))
        if start >= stop:
            return np.empty(0, np.uint32)
        a, b = np.searchsorted(self.ends, [start, stop - 1], side="right")
        skipped = int(self.ends[a - 1]) if a else 0
        return self._expanded(self.seq[a:b + 1])[start - skipped:stop - skipped]


def grammar_blob(ids: np.ndarray, first: int) -> bytes:
    left, right, seq = re_pair(ids, first)
    return pack(left, right, seq, np.array([first], np.int64))


# ---- shards -------------------------------------------------------------------

class Shard:
    """A shard's bytes, read document by document."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a shard of token ids")
        doc_id, null, sizes, ends, width, *grammars = unpack(data[4:])
        self.doc_ids = [None if n else int(d) for d, n in zip(
            np.frombuffer(doc_id, np.int64), np.frombuffer(null, np.uint8), strict=True)]
        self.sizes = np.frombuffer(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ends, self.blobs, self.at = np.frombuffer(ends, np.int64), grammars, -1

    def parts(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """Ids from ``start`` to ``stop`` of the shard, grammar by grammar; the last one used stays open."""
        k = int(np.searchsorted(self.ends, start, side="right"))
        while start < stop:
            if self.at != k:
                self.at, self.grammar = k, Grammar(self.blobs[k])
            low = int(self.ends[k - 1]) if k else 0
            yield self.grammar.ids(start - low, stop - low)
            start, k = int(self.ends[k]), k + 1

    def doc(self, i: int) -> np.ndarray:
        """Ids of the shard's document ``i``."""
        start = int(self.starts[i])
        return np.concatenate([np.empty(0, np.uint32), *self.parts(start, start + int(self.sizes[i]))])


class _Writer:
    """Documents collected to shards of one partition."""

    def __init__(self, first: int, shard_ids: int, grammar_ids: int):
        self.first, self.shard_ids, self.grammar_ids = first, shard_ids, grammar_ids
        self.count = 0
        self._clear()

    def _clear(self):
        self.docs, self.sizes, self.ends, self.grammars = [], [], [], []
        self.held, self.n_held, self.total = [], 0, 0

    def _grammar(self):
        if self.n_held:
            self.grammars.append(grammar_blob(np.concatenate(self.held), self.first))
            self.held, self.n_held = [], 0
            self.ends.append(self.total)

    def add(self, doc_id: int | None, pieces: Iterator[np.ndarray]) -> Iterator[tuple]:
        """Takes a document's ids; yields a shard if it is full."""
        size = 0
        for piece in pieces:
            size += len(piece)
            while len(piece):
                part, piece = np.split(piece, [self.grammar_ids - self.n_held])
                self.held.append(part)
                self.n_held += len(part)
                self.total += len(part)
                if self.n_held == self.grammar_ids:
                    self._grammar()
        self.docs.append(doc_id)
        self.sizes.append(size)
        if self.total >= self.shard_ids:
            yield from self.shard()

    def shard(self) -> Iterator[tuple]:
        if self.docs:
            self._grammar()
            data = MAGIC + pack(np.array([d or 0 for d in self.docs], np.int64), np.array([d is None for d in self.docs], np.uint8),
                                np.array(self.sizes, np.int64), np.array(self.ends, np.int64), np.array([4], np.int64),
                                *self.grammars)
            yield self.count, len(self.docs), self.total, data
            self.count += 1
            self._clear()


PUNCTUATION = ".,;:!?&%$*#"


def _bytes(strings: pa.Array) -> list[bytes]:
    return strings.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def _letters_alone(tokenizer: str) -> bool | None:
    """Whether the tokenizer lower-cases, if its model may get a run of letters by itself:
    its split (a regular expression) keeps runs of letters and runs of punctuation apart
    and whole, it changes nothing else of letters, and none of its added tokens is made of these."""
    import json

    from tokenizers import Tokenizer
    t, spec = Tokenizer.from_str(tokenizer), json.loads(tokenizer)
    steps, norm = (spec.get("pre_tokenizer") or {}).get("pretokenizers", []), spec.get("normalizer") or {}
    if [p["type"] for p in steps] != ["Split", "ByteLevel"] or steps[1]["use_regex"] or steps[1]["add_prefix_space"]:
        return None
    norm = norm.get("normalizers", [norm] if norm else [])
    if any(n["type"] not in ("NFC", "Lowercase") and (n["type"], n.get("pattern")) != ("Replace", {"Regex": "\\s+"}) for n in norm):
        return None
    if spec["model"].get("dropout") or any(all(c.isalpha() or c in PUNCTUATION for c in a["content"]) for a in spec["added_tokens"]):
        return None
    probe = "abcdéßжй日本" + PUNCTUATION
    if [span for _, span in t.pre_tokenizer.pre_tokenize_str(probe)] != [(0, 10), (10, len(probe))]:
        return None
    return any(n["type"] == "Lowercase" for n in norm)


class WordIds:
    """For tokenizers that drop white space: a text's ids are those of its words,
    one after the other.

    Latin letters followed by punctuation are two pieces already: the letters go to the
    tokenizer's model without its slow normalizer and split (``_letters_alone``), once
    for all words that differ in case of A-Z or punctuation.  Their ids are remembered in
    two generations of ``bound`` runs: a full one becomes the old one, runs found there
    are kept on.  Any other word is encoded by the whole tokenizer, many in one call
    between a mark that no other word has, and remembered with up to ``bound`` others.
    """

    MARK = "\x01"
    LATIN = 0x250                   # letters below compose with no other letter
    latin = staticmethod(re.compile(f"[\0-{chr(LATIN - 1)}]*").fullmatch)

    def __init__(self, tokenizer: str, bound: int = HELD_WORDS):
        import json

        from tokenizers import Tokenizer, pre_tokenizers
        self.whole, self.bound = Tokenizer.from_str(tokenizer), bound
        lower = _letters_alone(tokenizer)
        self.model, self.lower = None if lower is None else self.whole.model, bool(lower)
        self.added = [a["content"].lower().encode() for a in json.loads(tokenizer)["added_tokens"]]
        self.runs: dict[bytes, bytes] = {}
        self.old_runs: dict[bytes, bytes] = {}
        bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.seen_as = {c: bytes_of(chr(c))[0][0] for c in range(0x80, self.LATIN)}     # by the model
        self.mark = self._encode(self.whole, self.MARK)
        self.words: dict[bytes, bytes] = {}         # no letters, or not by themselves

    @staticmethod
    def _encode(tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _raw(self, tokenizer, words: list[str]) -> list[bytes]:
        """Ids of some words, encoded together where the mark tells them apart."""
        out: list[bytes] = []
        for some in (words[i:i + 500] for i in range(0, len(words), 500)):
            text = f" {self.MARK} ".join(some)
            if len(self.mark) != 1 or text.count(self.MARK) != len(some) - 1:
                out += [self._encode(tokenizer, w).tobytes() for w in some]
                continue
            ids = self._encode(tokenizer, text)
            raw, cuts = ids.tobytes(), (4 * np.flatnonzero(ids == self.mark[0])).tolist()
            out += [raw[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], [*cuts, len(raw)], strict=True)]
        return out

    def _for_model(self, run: bytes) -> str | None:
        """What the model sees of a run of Latin letters; of all else None."""
        if run.isalpha():
            return (run.lower() if self.lower else run).decode()
        text = run.decode("utf-8", "replace")
        if run.isascii() or not text.isalpha():
            return None
        seen = text.lower() if self.lower else text
        # lower case of a letter may be a letter and a mark: that word is no single run
        alone = seen.isalpha() and self.latin(text) and self.latin(seen)
        return seen.translate(self.seen_as) if alone else None

    def _of_runs(self, runs: list[bytes]) -> list[bytes | None]:
        """Ids of different runs of Latin letters; of all else None."""
        ids = list(map(self.runs.get, runs))
        new = [r for r, v in zip(runs, ids, strict=True) if v is None]
        kept = {r: v for r in new if (v := self.old_runs.get(r)) is not None}
        if len(self.runs) + len(new) > self.bound:
            self.old_runs, self.runs = self.runs, {r: v for r, v in zip(runs, ids, strict=True) if v is not None}
        self.runs.update(kept)
        new = [r for r in new if r not in kept]
        seen = list(map(self._for_model, new))
        tokens = map(self.model.tokenize, [s for s in seen if s is not None])
        self.runs.update(zip([r for r, s in zip(new, seen, strict=True) if s is not None],
                             [array("I", [x.id for x in found]).tobytes() for found in tokens], strict=True))
        return [self.runs.get(r) if v is None else v for r, v in zip(runs, ids, strict=True)]

    def _of_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of any words, by the whole tokenizer."""
        new = set(words).difference(self.words)
        if len(self.words) + len(new) > self.bound:
            self.words, new = {}, set(words)
        texts = [w.decode("utf-8", "replace") for w in new]
        self.words.update(zip(new, self._raw(self.whole, texts), strict=True))
        return [self.words[w] for w in words]

    def _folded(self, text: bytes) -> bytes:
        """A-Z lower-cased if the tokenizer does so too, whatever stands next to them: marks that
        compose with a letter of one case only and added tokens leave a text as it is."""
        low = text.lower() if self.lower else text
        return text if b"\xcc" in text or b"\xcd" in text or any(a in low for a in self.added) else low

    def many(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of some texts; their new words are encoded together."""
        split = pc.ascii_split_whitespace(pa.array([self._folded(t) for t in texts], pa.binary()).view(pa.string()))
        coded = split.values.dictionary_encode()
        words = coded.dictionary                # each is a run and a tail of punctuation, or encoded whole
        cut = pc.ascii_rtrim(words, characters=PUNCTUATION) if self.model else words
        runs = cut.dictionary_encode()
        ids = self._of_runs(_bytes(runs.dictionary)) if self.model else [None] * len(words)
        run = runs.indices.to_numpy()
        alone = np.fromiter((v is not None for v in ids), bool, len(ids))[run]
        tail = (pc.binary_length(words).to_numpy() - pc.binary_length(cut).to_numpy()) * alone
        tailed, rest = np.flatnonzero(tail), np.flatnonzero(~alone)
        tails = [w[-k:] for w, k in zip(_bytes(words.take(pa.array(tailed))), tail[tailed].tolist(), strict=True)]
        raw = [b"", *(v or b"" for v in ids), *self._of_words(tails + _bytes(words.take(pa.array(rest))))]
        parts = np.stack([run + 1, np.zeros(len(run), run.dtype)], 1)
        parts[tailed, 1] = np.arange(len(tailed)) + 1 + len(ids)
        parts[rest, 0] = np.arange(len(rest)) + 1 + len(ids) + len(tailed)
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        flat = _joined(np.frombuffer(b"".join(raw), np.uint32), np.cumsum(size) - size, size, parts.ravel())
        size, code = size[parts].sum(1), coded.indices.to_numpy()
        ends = np.r_[0, np.cumsum(size[code])][split.offsets.to_numpy()]
        return np.split(_joined(flat, np.cumsum(size) - size, size, code), ends[1:-1]) if texts else []

    def pieces(self, text: bytes) -> Iterator[np.ndarray]:
        """Ids of a long text, piece by piece; a piece ends before white space."""
        at = 0
        while at < len(text):
            end = len(text)
            if at + PIECE < end:
                end = min((e for e in (text.find(s, at + PIECE) for s in (b" ", b"\n", b"\t")) if e >= 0), default=end)
            yield self.many([text[at:end]])[0]
            at = end


class WholeTexts:
    """For any tokenizer: a text is encoded in one call."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer)

    def many(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(f.ids, np.uint32) for f in found]

    def pieces(self, text: bytes) -> Iterator[np.ndarray]:
        yield self.many([text])[0]


_ENCODERS: dict = {}            # by tokenizer: encoders outlive a task in reused workers


def _encoder(tokenizer: str, by_word: bool) -> WordIds | WholeTexts:
    key = (hash(tokenizer), by_word)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordIds(tokenizer) if by_word else WholeTexts(tokenizer)
    return _ENCODERS[key]


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text",
                      end_id: int = END_ID, by_word: bool = True, shard_ids: int = SHARD_IDS,
                      grammar_ids: int = GRAMMAR_IDS) -> None:
    """All texts as ids in shards below ``path``, in ascending order of doc_id.

    Every document ends with ``end_id``; a null or empty text is that id alone.
    Null ids come first; rows that repeat an id follow each other by text hash,
    equal rows are kept.  Other columns are ignored; an empty table gives no
    shard.  Texts are sorted by ranges, so an id that a third of all rows bear
    is spread.  ``by_word``: see ``WordIds``; set it only for tokenizers that
    drop white space.
    """
    from tokenizers import Tokenizer
    with open(tokenizer_file, encoding="utf-8") as f:
        model = f.read()
    first = max(Tokenizer.from_str(model).get_vocab_size(True), end_id + 1)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"),
                       F.monotonically_increasing_id().alias("tie"), F.col(text).alias("text"))
    keys = ["doc_id", "h", "tie"]
    rows = rows.repartitionByRange(partitions_for(rows), *keys).sortWithinPartitions(*keys)
    last = np.array([end_id], np.uint32)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(model, by_word)
        writer = _Writer(first, shard_ids, grammar_ids)

        held: list[tuple[int | None, bytes]] = []

        def encoded() -> Iterator[tuple]:
            """The held documents' ids, into shards."""
            for (d, _), ids in zip(held, encode.many([t for _, t in held]), strict=True):
                yield from writer.add(d, iter((ids, last)))
            held.clear()

        def row(part: int, *shard) -> pa.RecordBatch:
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((part, *shard), types, strict=True)],
                                              names=["part", "shard", "docs", "ids", "data"])

        part, size = None, 0            # part: the number of the range, the same for all its rows
        for batch in batches:
            for p, d, t in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2), strict=True):
                part = p.as_py() if part is None else part
                body = utf8(t.as_py())
                size += len(body)
                if size > PIECE:        # texts are encoded some at a time, a long one by itself
                    yield from (row(part, *s) for s in encoded())
                    size = len(body)
                if len(body) > PIECE:
                    yield from (row(part, *s) for s in writer.add(d, chain(encode.pieces(body), [last])))
                    size = 0
                else:
                    held.append((d, body))
        for shard in chain(encoded(), writer.shard()):
            yield row(part, *shard)

    (rows.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(of, SHARD)
     .write.option("compression", "uncompressed").parquet(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, read from the files: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32 (of the ids as little-endian uint32)."""
    shards = spark.read.schema(SHARD).parquet(path)
    # shards are summed within their partition, partitions among themselves
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    among = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("ids").alias("all_ids")).select(
        "part", F.coalesce(F.sum("all_ids").over(among), F.lit(0)).alias("part_start"))
    starts = shards.select("part", "shard", F.coalesce(F.sum("ids").over(within), F.lit(0)).alias("shard_start")).join(
        parts, "part").select("part", "shard", (F.col("part_start") + F.col("shard_start")).alias("base"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, data in zip(*batch.columns, strict=True):
                shard = Shard(data.as_py())
                crcs = []
                for s, n in zip(shard.starts.tolist(), shard.sizes.tolist(), strict=True):
                    crc = 0
                    for ids in shard.parts(s, s + n):
                        crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                    crcs.append(crc)
                k = len(crcs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * k, pa.int32()), pa.array([number.as_py()] * k, pa.int64()),
                     pa.array(shard.doc_ids, pa.int64()), pa.array(shard.starts, pa.int64()),
                     pa.array(shard.sizes, pa.int64()), pa.array(crcs, pa.int64())],
                    names=["part", "shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    found = shards.select("part", "shard", "data").mapInArrow(
        of, "part int, shard long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_file_digests(docs: DataFrame, tokenizer_file: str, path: str | None = None, **options) -> DataFrame:
    """Writes the files (below the shared checkpoint folder if ``path`` is None,
    then removed when the application ends) and reads every document back."""
    import uuid

    from lakemart.session import checkpoint_root
    spark = docs.sparkSession
    if path is None:
        path = f"{checkpoint_root(spark)}/llm/token-files-{uuid.uuid4().hex[:12]}"
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    write_token_files(docs, path, tokenizer_file, **options)
    return read_token_files(spark, path)
