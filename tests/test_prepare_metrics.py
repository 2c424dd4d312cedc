"""Split, scaler and metric operators: golden values, invariants, cross-checks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.operators import metrics as M
from churnlab.operators import prepare as D
from churnlab.spec import FeatureSpec


def _labelled(spark, n0, n1):
    return spark.range(n0 + n1).select(F.col("id").alias("key"), (F.col("id") >= n0).cast("int").alias("label"))


def test_largest_remainder_golden(spark):
    counts = spark.createDataFrame([(0, 5174), (1, 1869)], "class int, n long")
    got = {r["class"]: r.drawn for r in D.largest_remainder(counts, 7043, 7043 - math.ceil(0.2 * 7043)).collect()}
    assert got == {0: 4139, 1: 1495}


def test_split_is_a_projection_and_takes_null_labels(spark):
    rows = [(i, None if i % 5 == 0 else i % 2) for i in range(500)] + [(1000, 7)]
    df = spark.createDataFrame(rows, "key long, label int")
    out = D.stratified_split(df, "label", "key")
    n = {(r.label, r.split): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert sum(v for (_, s), v in n.items() if s == "test") == math.ceil(0.2 * 501)
    assert abs(n[(None, "test")] - 20) <= 1 and sum(n.values()) == 501
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    empty = D.stratified_split(df.limit(0), "label", "key")
    assert empty.columns == ["key", "label", "split"] and empty.count() == 0


def test_many_categories_and_colliding_names(spark):
    rows = [(i, f"v{i % 1500}", "a b" if i % 2 else "a-b") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, wide string, g string")
    cats = D.fit_one_hot(df, ["wide", "g"])
    assert len(cats["wide"]) == 1500
    names = D.one_hot_names({"g": cats["g"]}, ["x"])
    assert names == {("g", "a b"): "g_a_b", ("g", "a-b"): "g_a_b__2"}
    enc = df.select("id", *D.one_hot_columns({"g": cats["g"]})).orderBy("id").limit(2).collect()
    assert [(r.g_a_b, r.g_a_b__2) for r in enc] == [(0.0, 1.0), (1.0, 0.0)]
    table = D.category_table(df, ["wide", "g"])
    assert table.count() == 1502 and {r["index"] for r in table.collect()} == set(range(1502))
    sparse = D.encode_sparse(df, ["wide", "g"], table, "id")
    assert sparse.count() == 3000 and {len(r.indices) for r in sparse.collect()} == {2}
    model = D.fit_prepare(df.withColumn("churn", F.lit("Yes")), FeatureSpec(
        id_col="id", target="churn", numeric=(), nominal=("g",), column_order=("id", "churn", "g")), scale=())
    assert model.transform(df).columns == ["id", "g_a_b", "g_a_b__2"]


def test_binary_encoder_rules(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("Maybe",), (None,)], "c string")
    assert [r[0] for r in df.select(D.encode_binary("c", "Yes")).collect()] == [1, 0, 0, 0]
    assert [r[0] for r in df.select(D.encode_binary("c", "Yes", "No", "null")).collect()] == [1, 0, None, None]
    with pytest.raises(Exception, match="unknown value"):
        df.select(D.encode_binary("c", "Yes", "No", "error")).collect()
    assert tuple(D.binary_values(df, {"c": ("Yes", "No")}).first()) == ("c", 4, 1, 1)


def test_any_number_of_centres(spark):
    from churnlab.operators import cluster as K
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5000, 3))
    points = rng.normal(size=(40, 3))
    cdf = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)], "cid int, cv array<double>")
    pdf = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id int, v array<double>")
    got = {r.id: r.cluster for r in K.nearest_center(pdf, "v", cdf).collect()}
    want = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert got == {i: int(c) for i, c in enumerate(want)}


def test_auc_of_billions_of_rows_does_not_overflow(spark, monkeypatch):
    units = spark.createDataFrame([(0.1, 3_500_000_000, 500_000_000), (0.9, 500_000_000, 3_500_000_000)],
                                  "threshold double, n0 long, n1 long")
    monkeypatch.setattr(M, "_score_units", lambda *a: units)
    got = M.roc_auc(units).first()["auc"]
    assert abs(got - (7 / 8 * 7 / 8 + 0.5 * (2 * 7 / 64))) < 1e-12


def test_stratified_split_golden_counts(spark):
    df = _labelled(spark, 5174, 1869)
    out = D.stratified_split(df, "label", "key")
    counts = {(r["split"], r["label"]): r["count"] for r in out.groupBy("split", "label").count().collect()}
    assert counts == {("train", 0): 4139, ("train", 1): 1495, ("test", 0): 1035, ("test", 1): 374}
    assert out.select("key").distinct().count() == 7043


def test_split_independent_of_partitioning(spark):
    df = _labelled(spark, 300, 100)
    a = {r["key"]: r["split"] for r in D.stratified_split(df.repartition(3), "label", "key").collect()}
    b = {r["key"]: r["split"] for r in D.stratified_split(df.repartition(7), "label", "key").collect()}
    assert a == b


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0)], "a double, c double")
    st = D.fit_scaler(df, ["a", "c"])
    assert math.isclose(st["a"][1], np.std([1, 2, 3, 4]))
    assert st["c"] == (5.0, 1.0)
    exprs = D.scale_columns(st)
    out = df.select(exprs["a"].alias("a"), exprs["c"].alias("c")).collect()
    assert math.isclose(sum(r["a"] for r in out), 0.0, abs_tol=1e-12)
    assert all(r["c"] == 0.0 for r in out)


def _scores(spark, rows):
    return spark.createDataFrame(rows, "label int, score double").withColumn("pred", M.predict_at())


def test_auc_ties_count_half_and_one_class_is_null(spark):
    df = _scores(spark, [(0, 0.1), (0, 0.5), (1, 0.5), (1, 0.9)])
    # pairs (pos, neg): (0.5,0.1)=1, (0.5,0.5)=.5, (0.9,0.1)=1, (0.9,0.5)=1 -> 3.5/4
    assert M.roc_auc(df).first()["auc"] == 0.875
    assert M.roc_auc(_scores(spark, [(1, 0.2), (1, 0.3)])).first()["auc"] is None


def test_auc_matches_spark_exact_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rng = np.random.default_rng(1)
    rows = [(int(y), float(round(s, 2))) for y, s in zip(rng.integers(0, 2, 500), rng.random(500))]
    df = _scores(spark, rows)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    ref = ev.evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert math.isclose(M.roc_auc(df).first()["auc"], ref, abs_tol=1e-6)
    neg = df.withColumn("score", -F.col("score"))
    assert math.isclose(M.roc_auc(neg).first()["auc"], 1 - M.roc_auc(df).first()["auc"], abs_tol=1e-6)


def test_f1_without_predicted_positives_is_zero(spark):
    df = _scores(spark, [(0, 0.1), (1, 0.2)])
    assert M.f1_score(df).first()["f1"] == 0.0
    c = M.confusion(df).first()
    assert c["tn"] + c["fp"] + c["fn"] + c["tp"] == 2


def test_roc_starts_at_infinity_and_ends_at_one(spark):
    df = _scores(spark, [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)])
    pts = sorted(M.roc_curve(df, drop_collinear=False).collect(), key=lambda r: -r["threshold"])
    assert pts[0]["threshold"] == float("inf") and pts[0]["fpr"] == 0.0
    assert pts[-1]["fpr"] == 1.0 and pts[-1]["tpr"] == 1.0


def test_prepare_model_freezes_categories(spark):
    from churnlab.spec import FeatureSpec
    sp = FeatureSpec(id_col="id", target="y", nominal=("c",), column_order=("id", "y", "c"))
    fit = spark.createDataFrame([(1, "Yes", "a"), (2, "No", "b")], "id int, y string, c string")
    model = D.fit_prepare(fit, sp, scale=())
    new = spark.createDataFrame([(3, "No", "z"), (4, "No", None)], "id int, y string, c string")
    out = model.encode(new).collect()
    assert [c for c in model.feature_names] == ["c_a", "c_b"]
    assert all(r["c_a"] == 0.0 and r["c_b"] == 0.0 for r in out)


def test_f1_matches_spark_evaluator_for_label_one(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rng = np.random.default_rng(3)
    rows = [(int(y), float(s)) for y, s in zip(rng.integers(0, 2, 400), rng.random(400))]
    df = _scores(spark, rows).select(F.col("label").cast("double").alias("label"),
                                     F.col("pred").cast("double").alias("pred"), "score")
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="pred", metricName="fMeasureByLabel",
                                           metricLabel=1.0)
    assert math.isclose(M.f1_score(df).first()["f1"], ev.evaluate(df), abs_tol=1e-6)


def test_nearest_centre_tie_goes_to_lowest_id(spark):
    from churnlab.operators.cluster import nearest_center
    pts = spark.createDataFrame([(1, [0.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0])], "id int, v array<double>")
    cen = spark.createDataFrame([(7, [0.0, 0.0]), (5, [2.0, 0.0])], "cid int, cv array<double>")
    got = {r["id"]: r["cluster"] for r in nearest_center(pts, "v", cen).collect()}
    assert got == {1: 7, 2: 5, 3: 5}


def test_documents_duplicate_golden(spark):
    from churnlab.operators.profile import duplicate_count
    from churnlab.sources.tables import load
    docs = load(spark, "/root/testdata/sf0.001", "documents")
    assert duplicate_count(docs, ["text"]).first()["n_duplicates"] == 11


def test_batch_key_numbers_rows_within_month(spark):
    from churnlab.operators.drift import batch_key
    df = spark.createDataFrame([(k, k % 2 + 1) for k in range(10)], "id long, m long")
    got = {r["id"]: r["batch_key"] for r in batch_key(df, "m", "id").collect()}
    assert got[0] == "NEW-M01-0000" and got[8] == "NEW-M01-0004" and got[9] == "NEW-M02-0004"


def test_unseen_categories_are_counted(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,), ("z",)], "c string")
    r = D.unseen_categories(df, {"c": ["a", "b"]}).first()
    assert r["column"] == "c" and r["n_rows"] == 4 and r["n_unseen"] == 2


def test_clip_round_is_half_to_even(spark):
    from churnlab.operators.drift import clip_round
    df = spark.createDataFrame([(0.125,), (0.135,), (150.0,), (-3.0,)], "x double")
    got = [r[0] for r in df.select(clip_round("x", 0.0, 120.0, 2)).collect()]
    assert got == [0.12, 0.14, 120.0, 0.0]
    ints = [r[0] for r in spark.createDataFrame([(71.9,), (80.0,)], "x double")
            .select(clip_round("x", 0, 72, truncate_int=True)).collect()]
    assert ints == [71, 72]


def test_balanced_weights(spark):
    df = spark.createDataFrame([(i, 0 if i < 3 else 1) for i in range(4)], "id int, label int")
    w = {r["id"]: r["weight"] for r in M.balanced_weights(df, "label").collect()}
    assert math.isclose(w[0], 4 / 6) and math.isclose(w[3], 2.0)


def test_documents_duplicate_golden_sf001(spark):
    from churnlab.operators.profile import duplicate_count
    from churnlab.sources.tables import load
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    assert duplicate_count(docs, ["text"]).first()["n_duplicates"] == 73
