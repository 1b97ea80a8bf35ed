"""Operator 7, HTML extraction: a recurrent block labeller.

A page is cut at block-level tags into leaf text blocks.  Each block has a
hashed tag-path vector (tags, classes, ids), a hashed word vector and a few
counts.  A bidirectional LSTM in numpy reads the whole sequence of blocks and
classifies every block with the document around it; accepted blocks are the
main text.

There are no labelled pages: the network learns from weak labels (what the
page's own markup says: inside ``article`` or ``main``, not inside ``nav``,
``aside``, ...) on a bounded sample of the given pages, and from pages made of
the sample's texts: articles of paragraphs, lists, quotes, code, tables and
headings in containers with telling, made-up or no names, between boilerplate.
Names alone can't tell them apart, so text, links and neighbours must.

A page is scanned once, left to right, whatever it holds; a place in its tree
is a node that shares its parent's sums, and pages are labelled together up to
a budget of blocks, so long, deep or broken pages cost what their length does.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES, SAMPLE_CHARS = 240, 200_000
PATH_DIM, WORD_DIM, COUNTS, HIDDEN = 32, 16, 5, 16
MADE_PAGES, EPOCHS, BATCH, RATE = 1800, 10, 16, 0.01
CELLS = 1 << 14             # blocks labelled at once, padding included

_TAG_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_SPECIAL = re.compile("[\"'<>]")
_HIDDEN = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "template", "noscript")}
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i img ins kbd mark q s samp small span strike strong sub sup "
                    "time tt u var wbr label".split())
_VOID = frozenset("area base br col embed hr input link meta param source track".split())
_ENDS_ITSELF = {"p": "p", "li": "li", "td": "td", "th": "th", "tr": "tr", "dt": "dt", "dd": "dd", "option": "option"}
_ELEMENTS = frozenset("html body div section p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote table tr td".split())
_MAIN = frozenset("article main content post entry story".split())
_OTHER = frozenset("nav menu header footer aside sidebar form ad ads advert banner cookie notice comments comment head title "
                   "button select".split())


class Node:
    """A place in the page's tree: the names (tag, classes, id, role) of an element,
    and its parent.  Equal elements of one parent are one node, and a node knows
    the sum of the signs of all names above it, so that depth costs nothing."""

    __slots__ = ("parent", "names", "children", "signs", "count")

    def __init__(self, parent: Node | None = None, names: tuple[str, ...] = (), signs: NameSigns | None = None):
        self.parent, self.names, self.children = parent, names, {}
        self.count = parent.count if parent else 0
        self.signs = parent.signs if parent else np.zeros(PATH_DIM, np.int32)
        if signs is not None:
            for name in names:
                vector, known = signs[name]
                self.signs, self.count = self.signs + vector, self.count + known

    def child(self, names: tuple[str, ...], signs: NameSigns | None) -> Node:
        at = self.children.get(names)
        if at is None:
            at = self.children[names] = Node(self, names, signs)
        return at

    def path(self) -> tuple[str, ...]:
        out, node = [], self
        while node is not None:
            out.append(node.names)
            node = node.parent
        return tuple(n for names in reversed(out) for n in names)


@dataclass
class Block:
    node: Node                  # the elements around the text
    text: str
    linked: int                 # characters inside links

    @property
    def path(self) -> tuple[str, ...]:
        return self.node.path()


def tokens(page: str) -> Iterator[tuple[str, bool, str]]:
    """The page in one pass: (tag, closing, attributes), or ("", False, text).

    Scripts, styles, templates and comments are left out.  A ``>`` inside quotes
    doesn't end a tag; a quote that never closes is an ordinary character.  What
    begins like a tag but meets another ``<`` first, or the end, is text, and the
    scan goes on from there: no character is looked at again.
    """
    at, last = 0, {q: page.rfind(q) for q in "\"'>"}
    while at < len(page):
        low = page.find("<", at)
        if low < 0 or low > last[">"]:
            yield "", False, page[at:]
            return
        if low > at:
            yield "", False, page[at:low]
        if page.startswith("<!--", low):
            end = page.find("-->", low + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if page[low + 1:low + 2] in ("!", "?"):
            at = page.find(">", low) + 1
            continue
        name = _TAG_NAME.match(page, low)
        if not name:
            yield "", False, "<"
            at = low + 1
            continue
        at = name.end()
        while (m := _SPECIAL.search(page, at)) and m[0] in "\"'":
            # the closing quote, if there is one; else the quote stands for itself
            at = page.find(m[0], m.end()) + 1 if m.start() < last[m[0]] else m.end()
        at = m.start() if m else len(page)
        if not m or m[0] == "<":
            yield "", False, page[low:at]
            continue
        tag, attributes, closing = name[1].lower(), page[name.end():at], page[low + 1] == "/"
        at += 1
        if tag in _HIDDEN and not closing:
            end = _HIDDEN[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        yield tag, closing, attributes


def blocks_of(page: str | None, signs: NameSigns | None = None) -> list[Block]:
    """Leaf text blocks in page order; markup, scripts, styles and comments gone."""
    out: list[Block] = []
    root = Node()
    stack: list[tuple[str, Node]] = [("", root)]
    opened: Counter = Counter()
    pieces: list[str] = []
    state = {"link": 0, "linked": 0}

    def end():
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            out.append(Block(stack[-1][1], text, state["linked"]))
        pieces.clear()
        state["linked"] = 0

    def pop() -> str:
        tag = stack.pop()[0]
        opened[tag] -= 1
        return tag

    for tag, closing, raw in tokens(page or ""):
        if not tag:
            pieces.append(raw)
            state["linked"] += len(raw) if state["link"] else 0
        elif tag == "br":
            pieces.append(" ")
        elif tag == "a":
            state["link"] = 0 if closing else 1
        elif tag in _INLINE:
            pass
        elif closing:
            end()
            if opened[tag]:
                while pop() != tag:
                    pass
        else:
            end()
            top = stack[-1][0]
            if top and top in ("p", _ENDS_ITSELF.get(tag)) and (top != "p" or tag not in _VOID):
                pop()
            if tag not in _VOID and not raw.endswith("/"):
                names = " ".join(x for t in _NAMES.findall(raw) for x in t).lower()
                stack.append((tag, stack[-1][1].child((tag, *re.findall(r"[a-z]+", names)), signs)))
                opened[tag] += 1
    end()
    return out


def weak_label(block: Block) -> bool:
    return bool(_MAIN & set(block.path)) and not _OTHER & set(block.path)


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 7)


class NameSigns(dict):
    """Name -> (PATH_DIM hashed signs, 1), memoised; emptied when it grows too far.

    Names that the labeller hasn't learned from say nothing: no signs, 0."""

    def __init__(self, known: frozenset[str] | None = None):
        super().__init__()
        self.known = known

    def __missing__(self, name: str) -> tuple[np.ndarray, int]:
        if len(self) > 50_000:
            self.clear()
        known = self.known is None or name in self.known
        bits = _hash(name)
        signs = np.array([(2 * (bits >> k & 1) - 1) * known for k in range(PATH_DIM)], np.int32)
        at = self[name] = (signs, int(known))
        return at


class WordSigns(dict):
    """Word -> WORD_DIM hashed signs as the bits of a number, memoised likewise."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        at = self[word] = _hash(word) >> 40 & 0xFFFF
        return at


def features(blocks: list[Block], words: WordSigns) -> np.ndarray:
    """One row per block: its path (``blocks_of`` was given the signs), its words, its shape."""
    x = np.zeros((len(blocks), PATH_DIM + WORD_DIM + COUNTS))
    if not blocks:
        return x
    tokens = [b.text.lower().split() for b in blocks]
    sizes = np.array([len(t) for t in tokens])
    signs = np.fromiter((words[w] for t in tokens for w in t), np.uint16, sizes.sum())
    bits = np.unpackbits(signs.view(np.uint8).reshape(-1, 2), axis=1)
    ones = np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int64)
    x[:, :PATH_DIM] = np.array([b.node.signs for b in blocks]) / np.sqrt([[max(1, b.node.count)] for b in blocks])
    x[:, PATH_DIM:PATH_DIM + WORD_DIM] = 2 * ones / sizes[:, None] - 1
    x[:, PATH_DIM + WORD_DIM:] = [(np.log1p(n) / 3, min(1.0, b.linked / len(b.text)), i / len(blocks), 1.0, b.text[-1] in ".!?")
                                  for i, (b, n) in enumerate(zip(blocks, sizes.tolist(), strict=True))]
    return x


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM and a logistic output for every block."""

    def __init__(self, seed: int = 7, names: frozenset[str] | None = None):
        self.names = names          # of elements, classes and ids that mean something to it
        rng = np.random.default_rng(seed)
        dim = PATH_DIM + WORD_DIM + COUNTS
        self.p = {}
        for d in "fb":
            self.p["w" + d] = rng.normal(0, (dim + HIDDEN) ** -0.5, (dim + HIDDEN, 4 * HIDDEN))
            self.p["c" + d] = np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]
        self.p["wo"], self.p["co"] = rng.normal(0, 0.1, (2 * HIDDEN, 1)), np.zeros(1)

    def _run(self, x, mask, d, keep):
        """Hidden states (time, page, hidden); a masked step leaves the state."""
        w, c0 = self.p["w" + d], self.p["c" + d]
        steps, n, _ = x.shape
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        out, tape = np.zeros((steps, n, HIDDEN)), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = np.concatenate([x[t], h], axis=1)
            g = z @ w + c0
            i, f, o = (_sigmoid(g[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in (0, 1, 2))
            u, m = np.tanh(g[:, 3 * HIDDEN:]), mask[t][:, None]
            fresh = f * c + i * u
            th = np.tanh(fresh)
            if keep:
                tape.append((t, z, i, f, o, u, m, c, th))
            c, h = m * fresh + (1 - m) * c, m * o * th + (1 - m) * h
            out[t] = h
        return out, tape

    def forward(self, x, mask, keep=False):
        (a, ta), (b, tb) = self._run(x, mask, "f", keep), self._run(x, mask, "b", keep)
        both = np.concatenate([a, b], axis=2)
        return _sigmoid((both @ self.p["wo"])[..., 0] + self.p["co"]), both, ta, tb

    def _back(self, tape, dout, d, grads):
        w = self.p["w" + d]
        dh_next, dc_next = 0.0, 0.0
        for t, z, i, f, o, u, m, c, th in reversed(tape):
            dh = dout[t] + dh_next
            fresh = m * dh
            do, dc = fresh * th, fresh * o * (1 - th * th) + m * dc_next
            dg = np.concatenate([dc * u * i * (1 - i), dc * c * f * (1 - f), do * o * (1 - o), dc * i * (1 - u * u)], axis=1)
            grads["w" + d] += z.T @ dg
            grads["c" + d] += dg.sum(axis=0)
            dh_next = dg @ w[-HIDDEN:].T + (1 - m) * dh
            dc_next = dc * f + (1 - m) * dc_next

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]]) -> None:
        rng = np.random.default_rng(70)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        pages = sorted(pages, key=lambda p: len(p[1]))
        groups = [pages[i:i + BATCH] for i in range(0, len(pages), BATCH)]
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - 0.9 * epoch / EPOCHS)
            for k in rng.permutation(len(groups)):
                x, mask, y = padded(groups[k])
                p, both, ta, tb = self.forward(x, mask, keep=True)
                error = (p - y) * mask / mask.sum()
                grads = {n: np.zeros_like(v) for n, v in self.p.items()}
                grads["wo"] += np.einsum("tnh,tn->h", both, error)[:, None]
                grads["co"] += error.sum()
                dboth = error[..., None] * self.p["wo"][:, 0]
                self._back(ta, dboth[..., :HIDDEN], "f", grads)
                self._back(tb, dboth[..., HIDDEN:], "b", grads)
                step += 1
                for n, g in grads.items():
                    first[n] += 0.1 * (g - first[n])
                    second[n] += 0.001 * (g * g - second[n])
                    self.p[n] -= rate * (first[n] / (1 - 0.9 ** step)) / (np.sqrt(second[n] / (1 - 0.999 ** step)) + 1e-8)

    def accept(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Which blocks of each page are main text."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        a = 0
        while a < len(order):
            # pages of like length, as many as fit the budget when padded to the longest
            k = 1
            while a + k < len(order) and k < 64 and (k + 1) * len(pages[order[a + k]]) <= CELLS:
                k += 1
            part, a = order[a:a + k], a + k
            x, mask, _ = padded([(pages[i], np.zeros(len(pages[i]))) for i in part])
            p = self.forward(x, mask)[0]
            for k, i in enumerate(part):
                out[i] = p[:len(pages[i]), k] >= 0.5
        return out


def padded(pages):
    steps = max(len(y) for _, y in pages)
    x = np.zeros((steps, len(pages), PATH_DIM + WORD_DIM + COUNTS))
    mask, y = np.zeros((steps, len(pages))), np.zeros((steps, len(pages)))
    for k, (a, b) in enumerate(pages):
        x[:len(b), k], mask[:len(b), k], y[:len(b), k] = a, 1, b
    return x, mask, y


def _name(rng) -> str:
    return "".join(chr(97 + k) for k in rng.integers(0, 26, rng.integers(1, 8)))


def _page(rng, main: list[str], heads: list[str], other: list[str], signs: NameSigns) -> tuple[list[Block], list[bool]]:
    """A training page: an article of real paragraphs in some container, and boilerplate around it.

    Containers bear telling names, made-up ones or none; an article has headings,
    lists, quotes, code, tables; boilerplate is short, linked, repeated or set
    apart by its element.  So text, links and neighbours must decide together
    with names, not names alone."""
    root = Node()
    for name in ("html", "body") if rng.random() < 0.8 else ("body",) if rng.random() < 0.5 else ():
        root = root.child((name,), signs)
    blocks: list[Block] = []
    marks: list[bool] = []

    def pick(texts: list[str]) -> str:
        return texts[rng.integers(len(texts))]

    def few(low: int, high: int) -> str:
        words = pick(main).split()
        at = int(rng.integers(max(1, len(words))))
        return " ".join(words[at:at + int(rng.integers(low, high))]) or "word"

    def add(node: Node, text: str, linked: int, mark: bool):
        blocks.append(Block(node, text, linked))
        marks.append(mark)

    def under(node: Node, *chain) -> Node:
        for names in chain:
            node = node.child(names if isinstance(names, tuple) else (names,), signs)
        return node

    def telling(names: tuple[str, ...]) -> tuple[str, ...]:
        """An element whose name tells its role, a made-up name, or no name."""
        kind = rng.integers(3)
        return names if kind == 0 else ("div", _name(rng)) if kind == 1 else ("div",)

    def menu(node: Node):
        item = ("ul", "li") if rng.random() < 0.7 else ("p",) if rng.random() < 0.5 else ()
        for _ in range(rng.integers(2, 9)):
            text = few(1, 4)
            add(under(node, *item), text, len(text), False)

    def aside(node: Node):
        """Boilerplate told by its element or class: its text may read like an article's."""
        names = [("header",), ("footer",), ("aside",), ("form",), ("nav",), ("section", "comments"), ("div", "comment"),
                 ("div", "ad"), ("div", "sidebar"), ("div", "cookie", "notice"), ("div", "banner"), ("div", "menu")]
        place = under(node, names[rng.integers(len(names))], *(["p"] if rng.random() < 0.7 else []))
        for _ in range(rng.integers(1, 4)):
            text = pick(other if rng.random() < 0.5 else main) if rng.random() < 0.7 else few(2, 12)
            add(place, text, 0 if rng.random() < 0.8 else len(text), False)

    told = [[("article",)], [("main",)], [("div", "content")], [("div", "post")], [("section", "article", "entry")], [("div", "story")]]
    named = [[("div", *(_name(rng) for _ in range(rng.integers(1, 4))))], [("section", _name(rng))],
             [("div", _name(rng)), ("div", _name(rng))], [("div", "wrap", _name(rng)), ("div", _name(rng), "body")],
             [("div", "text")], [("table", _name(rng)), ("tr",), ("td", _name(rng))]]
    plain = [[("section",)], [("div",)], [("div",), ("div",)], [("table",), ("tr",), ("td",)], []]
    holders = (told, named, named, plain)[rng.integers(4)]
    # a few short sentences are an article only where a name says so
    short = rng.random() < 0.25
    holders = told if short else holders
    holder = under(root, *holders[rng.integers(len(holders))])
    if rng.random() < 0.5:
        add((root.parent or root).child(("head",), signs).child(("title",), signs), pick(heads), 0, False)
    for _ in range(rng.integers(0, 3)):
        (menu if rng.random() < 0.5 else aside)(under(root, telling(("nav",))) if rng.random() < 0.6 else root)
    kinds = ["p"] * 6 + ["li", "quote", "code", "table", "bare", "dl"]
    only = "p" if short else kinds[rng.integers(len(kinds))] if rng.random() < 0.35 else None
    if rng.random() < 0.7:
        add(under(holder, "h1"), pick(heads), 0, True)
    for _ in range(int(rng.integers(1, 5 if short else 12)) if short or rng.random() < 0.9 else 60):
        kind = only or kinds[rng.integers(len(kinds))]
        if rng.random() < 0.12:
            add(under(holder, ("h2", "h3", "h4")[rng.integers(3)]), few(1, 8), 0, True)
        if kind in ("li", "code", "table", "dl"):
            place = {"li": ("ul" if rng.random() < 0.7 else "ol", "li"), "code": ("pre",), "table": ("table", "tr", "td"),
                     "dl": ("dl", "dd")}[kind]
            for _ in range(rng.integers(1, 9)):
                text = few(1, 25) if rng.random() < 0.8 else pick(main)
                add(under(holder, *place), text, 0 if rng.random() < 0.9 else len(text) // 2, True)
        else:
            text = few(2, 8) + "." if short else pick(main) if rng.random() < 0.85 else few(1, 6)
            place = under(holder, *{"p": ("p",), "quote": ("blockquote",) if rng.random() < 0.5 else ("blockquote", "p"), "bare": ()}[kind])
            add(place, text, 0 if rng.random() < 0.9 else min(len(text), 20), True)
        if rng.random() < 0.05:
            aside(holder)
    for _ in range(rng.integers(0, 4)):
        (menu if rng.random() < 0.4 else aside)(under(root, telling(("footer",))) if rng.random() < 0.5 else root)
    return blocks, marks


def fit(pages: DataFrame, html_column: str = "html", sample: int = SAMPLE_PAGES) -> Labeller:
    """A labeller from at most ``sample`` different pages of bounded length, the first by hash.

    Hashes are chosen first, so that no task sends pages that are not taken.
    """
    small = pages.select(F.col(html_column).alias("h"), F.xxhash64(html_column).alias("k")).filter(F.length("h") <= SAMPLE_CHARS)
    keys = [r.k for r in small.select("k").distinct().orderBy("k").limit(sample).collect()]
    rows = [r.h for r in small.filter(F.col("k").isin(keys)).groupBy("k").agg(F.min("h").alias("h")).orderBy("k").collect()]
    return train(rows)


def train(rows: list[str]) -> Labeller:
    """A labeller from sampled pages: their own markup's labels, and pages made of their texts."""
    rng = np.random.default_rng(71)
    names = frozenset(n for r in rows for b in blocks_of(r) for n in b.path) | _MAIN | _OTHER | _ELEMENTS
    signs, words = NameSigns(names), WordSigns()
    parsed = [b for b in (blocks_of(r, signs) for r in rows) if b]
    model = Labeller(names=names)
    if not parsed:
        return model
    labelled = [(blocks, [weak_label(b) for b in blocks]) for blocks in parsed]
    heading = ("h1", "h2", "title")
    main = [b.text for blocks, marks in labelled for b, y in zip(blocks, marks, strict=True) if y and b.node.names[0] not in heading]
    heads = [b.text for blocks in parsed for b in blocks if b.node.names and b.node.names[0] in heading]
    other = [b.text for blocks, marks in labelled for b, y in zip(blocks, marks, strict=True) if not y]
    texts = [b.text for blocks in parsed for b in blocks]
    made = [_page(rng, main or texts, heads or texts, other or texts, signs) for _ in range(MADE_PAGES)]
    model.train([(features(b, words), np.array(y, float)) for b, y in labelled + made])
    return model


def extract_main_text(pages: DataFrame, html_column: str = "html", keep: tuple = ("page_id", "url"),
                      model: Labeller | None = None) -> DataFrame:
    """One row per page: the ``keep`` columns, text, n_chars (code points).

    Character references are decoded, white space inside a block is one space,
    blocks are joined by two line feeds.  A null, empty or textless page has the
    text "".  Repeated rows give equal rows; nothing depends on ids, which may
    be null.  An empty table gives no rows.  Other columns are ignored.
    """
    model = pages.sparkSession.sparkContext.broadcast(model or fit(pages, html_column))
    rows = pages.select(F.struct(*keep).alias("_keep"), F.col(html_column).alias("_html"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs, words = NameSigns(model.value.names), WordSigns()
        for batch in batches:
            texts = []
            for at in range(0, batch.num_rows, 256):
                parsed = [blocks_of(h.as_py(), signs) for h in batch.column(1)[at:at + 256]]
                accepted = model.value.accept([features(b, words) for b in parsed])
                texts += ["\n\n".join(x.text for x, y in zip(b, a, strict=True) if y) for b, a in zip(parsed, accepted, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["_keep", "text", "n_chars"])

    out = rows.mapInArrow(of, f"_keep {rows.schema['_keep'].dataType.simpleString()}, text string, n_chars long")
    return out.select("_keep.*", "text", "n_chars")
