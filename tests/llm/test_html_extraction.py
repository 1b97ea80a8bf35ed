"""HTML extraction: blocks, gradient, accuracy against the pages' own markup."""

import html
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import html_extraction as hx

SF = "/root/testdata/sf0.01"


def test_blocks():
    page = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><!-- <p>no</p> -->
    <nav class='top Menu'><a href=x>one</a> two</nav><article><h1>A &amp; B</h1><p><b>first<br>line <i>x</i><p>sec&nbsp;ond&#33;</p>
    <div id="ad-1">buy</div></article>tail <script>never closed"""
    got = [(b.path, b.text) for b in hx.blocks_of(page)]
    assert [t for _, t in got] == ["T", "one two", "A & B", "first line x", "sec ond!", "buy", "tail"]
    assert got[1][0] == ("html", "body", "nav", "top", "menu") and got[5][0][-2:] == ("div", "ad")
    assert hx.blocks_of(None) == hx.blocks_of("") == hx.blocks_of("<p> <br>") == []


def test_gradient_by_differences():
    model = hx.Labeller()
    rng = np.random.default_rng(1)
    pages = [(rng.normal(size=(n, hx.PATH_DIM + hx.WORD_DIM + hx.COUNTS)), rng.integers(0, 2, n).astype(float)) for n in (3, 5)]
    x, mask, y = hx.padded(pages)

    def loss():
        p = model.forward(x, mask)[0]
        return -np.sum(mask * np.where(y == 1, np.log(p), np.log(1 - p))) / mask.sum()
    p, both, ta, tb = model.forward(x, mask, keep=True)
    error = (p - y) * mask / mask.sum()
    grads = {n: np.zeros_like(v) for n, v in model.p.items()}
    d = error[..., None] * model.p["wo"][:, 0]
    model._back(ta, d[..., :hx.HIDDEN], "f", grads)
    model._back(tb, d[..., hx.HIDDEN:], "b", grads)
    for name in ("wf", "wb", "cf", "cb"):
        for at in [tuple(rng.integers(0, s) for s in model.p[name].shape) for _ in range(6)]:
            model.p[name][at] += 1e-5
            up = loss()
            model.p[name][at] -= 2e-5
            down = loss()
            model.p[name][at] += 1e-5
            assert grads[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def wanted(page):
    """The article's paragraphs, by their markup alone."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", body)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br>" in p else "", p)).split()) for p in parts]
    return "\n\n".join(p for p in parts if p)


@pytest.fixture(scope="module")
def model(spark):
    return hx.fit(spark.read.parquet(f"{SF}/pages.parquet").filter("page_id % 2 = 0"))


def extracted(model, pages):
    signs, words = hx.NameSigns(model.names), hx.WordSigns()
    parsed = [hx.blocks_of(p, signs) for p in pages]
    marks = model.accept([hx.features(b, words) for b in parsed])
    return [[x.text for x, y in zip(b, m, strict=True) if y] for b, m in zip(parsed, marks, strict=True)]


HOLDERS = ["<article>", "<main>", "<section>", "", "<div id='c1'>", "<div class='text'>", "<div class='xq-body'>", "<div class='page-wrap texte'>", "<div class='lorem'>", "<div class='inhalt'>", "<table><tr><td>", "<div>"]


@pytest.fixture(scope="module")
def prose(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").filter("page_id % 2 = 1").orderBy("page_id").limit(100).collect()
    texts = [t for p in pages for t in wanted(p.html).split("\n\n")]
    return [t for t in texts if len(t.split()) > 8]


def built(prose, rng, holder, tags):
    """(page, article blocks): blocks of the given tags in a container, with a menu, an advert and a footer."""
    def few(n):
        return " ".join(prose[rng.integers(len(prose))].split()[:n])
    blocks = [(t, prose[rng.integers(len(prose))] if t != "li" or len(set(tags)) == 1 else few(rng.integers(2, 10))) for t in tags]
    close = f"</{re.match(r'<([a-z]+)', holder)[1]}>" if holder else ""
    menu = "".join(f"<li><a href='/x'>{html.escape(few(2))}</a></li>" for _ in range(6))
    body = "".join(f"<{t}>{html.escape(x)}</{t}>" for t, x in blocks)
    return (f"<html><head><title>{html.escape(few(5))}</title></head><body><nav><ul>{menu}</ul></nav><div class='ad'>{html.escape(few(8))}</div>"
            f"{holder}{body}{close}<footer>&copy; {html.escape(few(4))}</footer></body></html>"), [x for _, x in blocks]


@pytest.mark.parametrize("holder", HOLDERS)
def test_containers_never_seen(model, prose, holder):
    """Paragraphs are found whole in any container, and nothing else, in at least 19 of 20 pages."""
    rng = np.random.default_rng(5)
    pages = [built(prose, rng, holder, ["p"] * int(rng.integers(3, 20))) for _ in range(20)]
    got = extracted(model, [p for p, _ in pages])
    assert sum(g == w for g, (_, w) in zip(got, pages, strict=True)) >= 19
    assert all(set(w) <= set(g) for g, (_, w) in zip(got, pages, strict=True))


@pytest.mark.parametrize("tags", [["li"] * 12, ["pre"] * 12, ["blockquote"] * 12, ["p"] * 4 + ["li"] * 8 + ["p"] * 4])
@pytest.mark.parametrize("holder", ["<article>", "<div id='c1'>"])
def test_lists_quotes_and_code_are_kept(model, prose, tags, holder):
    rng = np.random.default_rng(6)
    pages = [built(prose, rng, holder, tags) for _ in range(20)]
    got = extracted(model, [p for p, _ in pages])
    assert all(set(w) <= set(g) for g, (_, w) in zip(got, pages, strict=True))
    assert sum(g == w for g, (_, w) in zip(got, pages, strict=True)) >= 19


@pytest.mark.parametrize("unit", ["<a ", '<p a="', "<a <b '", "<!-- <", "<div>x", "</x>", "<script ", "<a \"<a' ", "<", "<p>x", "&amp"])
def test_broken_pages_take_linear_time(unit):
    started = time.process_time()
    hx.blocks_of(unit * (500_000 // len(unit)))
    assert time.process_time() - started < 4


def test_unclosed_tags_are_text_once():
    def texts(page):
        return [b.text for b in hx.blocks_of(page)]
    assert texts("a < b <c d <p>e</p>") == ["a < b <c d", "e"]
    assert texts('<p title="x > y">in</p><p title="z>out</p>') == ["in", "out"]
    assert texts("<p a='1>2'>q</p>5 > 4") == ["q", "5 > 4"]
    assert texts("<p>x</p><p") == ["x", "<p"]


def test_depth_and_long_pages_share_their_nodes():
    blocks = hx.blocks_of("<div class=c>x" * 20_000, hx.NameSigns())
    assert len(blocks) == 20_000 and blocks[-1].node.count == 40_000 and blocks[2].path == ("div", "c") * 3
    same = hx.blocks_of("<ul>" + "<li>x</li>" * 1000 + "</ul>")
    assert len({id(b.node) for b in same}) == 1


def test_batches_keep_to_their_budget(monkeypatch):
    seen = []
    real = hx.padded
    monkeypatch.setattr(hx, "padded", lambda pages: (seen.append(len(pages) * max(len(y) for _, y in pages)), real(pages))[1])
    sizes = [3, 5000, 40, 7, 20_000, 1, 300, 12, 0] * 10
    rng = np.random.default_rng(0)
    marks = hx.Labeller().accept([rng.normal(size=(n, hx.PATH_DIM + hx.WORD_DIM + hx.COUNTS)) for n in sizes])
    assert [len(m) for m in marks] == sizes and max(seen) <= max(hx.CELLS, max(sizes))


def test_accuracy_and_edges(spark, model):
    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumn("text", F.lit("clash"))
    out = {r.page_id: r for r in hx.extract_main_text(pages, model=model).collect()}
    held = [r for r in pages.filter("page_id % 2 = 1").collect()]
    assert len(out) == pages.count()
    assert [r.page_id for r in held if out[r.page_id].text != wanted(r.html)] == []
    long = "<article>" + "<p>word word.</p>" * 20_000 + "</article>"
    odd = spark.createDataFrame([(1, None, None), (1, "u", ""), (None, "u", "<p"), (2, "u", long),
                                 (3, "u", "<body><header><p>Top line.</p></header><main><p>One two three.</p><p>Four five.</p></main>"
                                          "<aside><p>Side.</p></aside><section class=comments><p>I agree with it.</p></section>")],
                                "page_id long, url string, html string")
    got = hx.extract_main_text(odd, model=model).collect()
    assert len(got) == 5 and [r.text for r in got if r.page_id == 1] == ["", ""]
    assert next(r for r in got if r.page_id == 2).text == "\n\n".join(["word word."] * 20_000)
    assert next(r for r in got if r.page_id == 3).text == "One two three.\n\nFour five."
    assert hx.extract_main_text(odd.limit(0)).count() == 0
