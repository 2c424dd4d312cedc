"""Hand-computed checks of the pandas/sklearn vs Spark semantics."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.functions.columns import coerce_numeric, cut, is_value
from churnlab.functions.prefix import exact_quantiles, ordered_prefix
from churnlab.operators import explore as E
from churnlab.operators import profile as P


def test_coerce_numeric_edge_cases(spark):
    vals = [" ", "12 ", "1e3", "1d", "1f", "inf", "nan", "", "1,000", None, "-3.5", ".5"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(coerce_numeric("s")).collect()]
    assert got == [None, 12.0, 1000.0, None, None, None, None, None, None, None, -3.5, 0.5]


def test_null_safe_equality_encodes_null_as_zero(spark):
    df = spark.createDataFrame([("Yes",), ("No",), (None,)], "s string")
    assert [r[0] for r in df.select(is_value("s", "Yes")).collect()] == [1, 0, 0]


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 6, 7, 12, 72, 73]] + [(None,)], "x double")
    edges, labels = (0, 6, 12, 72), ("a", "b", "c")
    got = [r[0] for r in df.select(cut("x", edges, labels)).collect()]
    assert got == [None, "a", "b", "b", "c", None, None]
    low = [r[0] for r in df.select(cut("x", edges, labels, include_lowest=True)).collect()]
    assert low[0] == "a"


def test_histogram_last_bin_closed_and_degenerate(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 1.0), ("a", 10.0), ("b", 5.0), ("b", 5.0)], "g string, x double")
    h = {(r["g"], r["bin"]): r for r in E.histogram(df, "x", by="g", bins=10).collect()}
    assert h[("a", 9)]["n"] == 1 and h[("a", 0)]["n"] == 1 and h[("a", 1)]["n"] == 1
    assert sum(r["n"] for k, r in h.items() if k[0] == "b") == 2
    # degenerate group widened to [x - .5, x + .5]; densities integrate to 1
    for g in ("a", "b"):
        rows = [r for k, r in h.items() if k[0] == g]
        assert math.isclose(sum(r["density"] * (r["bin_hi"] - r["bin_lo"]) for r in rows), 1.0, rel_tol=1e-5)


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0), (None, 1.0, 5.0)],
                               "a double, b double, c double")
    r = {(x["a"], x["b"]): x["r"] for x in E.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert r[("b", "a")] == 1.0
    assert r[("c", "a")] is None and r[("c", "b")] is None


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x"), (2, "x"), (3, "y")], "a int, b string")
    row = P.duplicate_count(df).first()
    assert row["n_duplicates"] == 3 and row["n_distinct_rows"] == 3


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.integers(0, 50, 300), np.full(200, 7)]).astype(float)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    q = exact_quantiles(df, "x", [0.1, 0.25, 0.5, 0.75, 0.99]).first()
    expect = np.quantile(vals, [0.1, 0.25, 0.5, 0.75, 0.99])
    for i, e in enumerate(expect):
        assert math.isclose(q[f"q_{i}"], e, rel_tol=1e-12)
    one = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert exact_quantiles(one, "x", [0.75]).first()["q_0"] == 4.75


def test_ordered_prefix_matches_brute_force(spark):
    rows = [(g, i, (i * 7919) % 13) for g in ("a", "b", "c") for i in range(200)]
    df = spark.createDataFrame(rows, "g string, k int, w int")
    got = {(r["g"], r["k"]): r["before_w"] for r in ordered_prefix(df, ["k"], ["w"], ["g"], num_buckets=5).collect()}
    for g in ("a", "b", "c"):
        run = 0
        for i in range(200):
            assert got[(g, i)] == run
            run += (i * 7919) % 13


def test_group_by_drops_null_category(spark):
    from churnlab.spec import FeatureSpec
    sp = FeatureSpec(id_col="id", target="y", positive="Yes")
    df = spark.createDataFrame([(1, "Yes", "a"), (2, "No", None), (3, "No", "a")], "id int, y string, c string")
    out = E.target_rate_by(df, sp, ["c"]).collect()
    assert len(out) == 1 and out[0]["value"] == "a" and out[0]["n"] == 2


def test_describe_approx_close_to_exact(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(50, 10, 2000)], "x double")
    ex = P.describe_numeric(df, ["x"]).first()
    ap = P.describe_numeric(df, ["x"], exact=False).first()
    assert ex["count"] == ap["count"] == 2000 and ex["mean"] == ap["mean"]
    for c in ("p25", "p50", "p75"):
        assert abs(ex[c] - ap[c]) < 0.5


def test_group_row_number_orders_and_nulls(spark):
    from churnlab.functions.ranking import group_row_number
    rows = [(g, i, (i * 37) % 11) for g in ("a", "b") for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v int, n int")
    out = group_row_number(df, ["g"], [("n", True), ("v", False)], "k")
    assert out.schema["k"].dataType.simpleString() == "bigint"
    got = {(r["g"], r["v"]): r["k"] for r in out.collect()}
    a = sorted((r for r in rows if r[0] == "a"), key=lambda r: (-r[2], r[1]))
    assert [got[("a", r[1])] for r in a] == list(range(1, 301))
    odd = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "v string, n int")
    desc = {r.v: r.k for r in group_row_number(odd, [], [("n", True), ("v", False)], "k").collect()}
    asc = {r.v: r.k for r in group_row_number(odd, [], [("n", False), ("v", False)], "k").collect()}
    assert desc == {"c": 1, "a": 2, "b": 3} and asc == {"b": 1, "a": 2, "c": 3}


def test_encoding_gate_counts_what_is_not_a_number(spark):
    df = spark.createDataFrame([("1d",), ("NaN",), ("inf",), ("x",), ("2",), (None,)], "c string")
    assert [tuple(r) for r in P.encoding_gate(df, ["c"]).collect()] == [("c", 5)]


def test_density_integrates_to_one_for_any_range(spark):
    for scale in (1e-6, 1.0, 1e9):
        df = spark.createDataFrame([(("a" if i % 3 else "b"), i * i * scale) for i in range(200)], "g string, x double")
        for shared in (False, True):
            rows = E.histogram(df, "x", by="g", bins=7, shared_edges=shared).collect()
            for g in ("a", "b"):
                area = sum(r.density * (r.bin_hi - r.bin_lo) for r in rows if r.g == g)
                assert abs(area - 1) < 1e-9


def test_rare_shares_are_not_rounded_away(spark):
    df = spark.range(3_000_000).select(F.when(F.col("id") == 0, "rare").otherwise("common").alias("v"))
    got = {r.value: r.share for r in P.value_counts(df, "v").collect()}
    assert got["rare"] == 1 / 3_000_000
