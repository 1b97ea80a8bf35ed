"""The corpus pipeline against brute force, stage by stage, and its edges."""

import pytest

from tests.llm.test_decontamination import brute as contained
from tests.llm.test_simhash import components, slow_fingerprint
from tests.llm.test_substring_dedup import brute as kept_words

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in cp.STAGES:
        rows = stage(spark, spark.createDataFrame(list(before.values()), docs.schema), SF).collect()
        after = {r.doc_id: r for r in rows}
        assert len(after) == len(rows) and set(after) <= set(before)
        if name != "mixing_sources":
            assert rows[0].__fields__ == columns
        if name == "quality_classifier":
            good = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()
            assert all(r.doc_id in after for r in good if r.doc_id in before)
            assert len(after) < len(before)
        elif name == "simhash":
            ids = sorted(before)
            fps = [slow_fingerprint(before[i].text) for i in ids]
            assert sorted(after) == sorted(components(ids, fps, roots=True))
        elif name == "substring_dedup":
            want = {int(d): (n, gone, text) for d, n, gone, _, text in kept_words([(i, r.text) for i, r in before.items()])}
            assert set(after) == {i for i, (n, gone, _) in want.items() if not n or gone < n}
            for i, r in after.items():
                n, gone, text = want[i]
                assert r.text == (text if gone else before[i].text) and r.n_chars == len(r.text)
        elif name == "benchmark_decontamination":
            bad = {int(d) for d, *_ in contained([(i, r.text) for i, r in before.items()], items)}
            assert bad and set(after) == set(before) - bad
        else:
            assert set(after) == set(before) and all(0 <= r.taken <= 3 * r["size"] for r in rows)
            assert sum(r.taken for r in rows) == pytest.approx(sum(r["size"] for r in rows), rel=0.02)
        before = after


def test_runs_whole(spark):
    rows = cp.run(spark, SF).collect()
    assert rows and {"doc_id", "text", "taken", "target"} <= set(rows[0].__fields__)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = spark.createDataFrame([], stage(spark, docs, SF).schema)
        assert docs.count() == 0


def test_odd_rows(spark):
    odd = [(1, None, "en", None, None), (None, "a few words", None, "s", 11), (2, "", "en", "s", 0), (2, "", "en", "s", 0)]
    docs = spark.createDataFrame(odd, spark.read.parquet(f"{SF}/documents.parquet").schema)
    for _, stage in cp.STAGES[1:]:
        out = stage(spark, docs, SF)
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert docs.count() == 2
