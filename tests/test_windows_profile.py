"""Hierarchy (cycle, orphan), latest-per-key, rolling, quantiles, describe."""

import numpy as np
from pyspark.sql import functions as F

from lakemart.operators import profile as pf
from lakemart.operators import windows as win


def test_hierarchy_cycle_and_orphan(spark):
    nodes = spark.createDataFrame(
        [("a", None, "A"), ("b", "a", "B"), ("c", "b", "C"), ("x", "y", "X"), ("y", "x", "Y"), ("o", "zz", "O")],
        "id string, parent_id string, name string")
    got = {r.id: (r.level, r.path) for r in win.hierarchy(spark, nodes).collect()}
    assert got == {"a": (1, "A"), "b": (2, "A -> B"), "c": (3, "A -> B -> C")}


def test_latest_per_key_keeps_users_without_orders(spark):
    users = spark.createDataFrame([(1, "u1"), (2, "u2")], "user_id int, username string")
    orders = spark.createDataFrame([(1, 10, "d1"), (1, 12, "d2"), (1, 11, "d3")],
                                   "user_id int, order_id int, order_date string")
    got = sorted(tuple(r) for r in win.latest_per_key(users, orders, "user_id", "order_id", ["order_date"]).collect())
    assert got == [(1, "u1", 12, "d2"), (2, "u2", None, None)]


def test_rolling_min_periods(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 10)], "d int, v double")
    got = [r.rolling_7 for r in win.rolling_mean(df, "d", "v", 7).orderBy("d").collect()]
    assert got[0] == 1.0 and got[1] == 1.5 and got[6] == 4.0 and got[8] == 6.0


def test_exact_quantiles_with_hot_value(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), rng.integers(0, 5, 1000)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = pf.exact_quantiles(df, "x", probs, buckets=16)
    want = np.quantile(vals, probs)
    assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_categorical_describe_ties_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    r = pf.categorical_describe(df, ["s"]).first()
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (4, 2, "a", 2)


def test_null_profile_one_pass(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    got = {r.column_name: (r.null_count, r.null_pct) for r in pf.null_profile(df).collect()}
    assert got == {"a": (1, 50.0), "b": (2, 100.0)}


def test_exact_quantiles_refinement_rounds(spark):
    rng = np.random.default_rng(11)
    a = np.concatenate([rng.normal(size=4000), np.full(1500, -0.5)])
    b = rng.exponential(size=a.size)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    probs = [0.01, 0.25, 0.5, 0.9, 1.0]
    got = pf.exact_quantiles_multi(df, ["a", "b"], probs, buckets=8, max_exact=50)
    assert np.allclose(got["a"], np.quantile(a, probs), rtol=0, atol=1e-12)
    assert np.allclose(got["b"], np.quantile(b, probs), rtol=0, atol=1e-12)


def test_hierarchy_reachable_cycle_terminates(spark):
    # "b" appears twice (parent "a" and parent "c"): b -> c -> b is reachable from the root
    nodes = spark.createDataFrame([("a", None, "A"), ("b", "a", "B"), ("c", "b", "C"), ("b", "c", "B2")],
                                  "id string, parent_id string, name string")
    paths = sorted(r.path for r in win.hierarchy(spark, nodes).collect())
    assert paths == ["A", "A -> B", "A -> B -> C"]
