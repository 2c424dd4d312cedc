"""Registry entries that depend on a fitted forest (F2, F3, F10, A5, H4,
H7) -- rows-only -- and the batch preparation H1, which has a SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.functions.columns import r6
from churnlab.operators import metrics as M
from churnlab.operators import model as ML
from churnlab.operators import retrain as H
from churnlab.plans.q_prepare import FEATURES, NUMERIC, _r6_features, _scaled_sql, fitted, split_subs
from churnlab.plans.q_evaluate import history_split
from churnlab.plans.registry import SPEC, W, query
from churnlab.plans.sql import HISTORY_CTE, RAW_SPLIT_CTE
from churnlab.session import work_path
from churnlab.sources.models import ModelRegistry, SchemaMismatch


def _forest(spark, d):
    sp = split_subs(spark, d)
    return sp, *ML.fit_models(sp.where(F.col("split") == "train"), SPEC)


def _test_predictions(spark, d):
    sp, prep, forest = _forest(spark, d)
    test = prep.transform(sp.where(F.col("split") == "test"), keep=["batch_month"])
    return ML.predict(forest, test), (sp, prep, forest)


@query("f2_forest")
def f2_forest(spark, d):
    return ML.forest_summary(_forest(spark, d)[2])


@query("f3_predict")
def f3_predict(spark, d):
    pred, _ = _test_predictions(spark, d)
    return pred.select("c_custkey", "label", r6("score").alias("score"), "pred")


@query("f10_importance")
def f10_importance(spark, d):
    _, prep, forest = _forest(spark, d)
    return ML.feature_importance(forest, prep.feature_names, top=S.TOP_K_LONG)


@query("h2_evaluate_forest")
def h2_evaluate_forest(spark, d):
    pred, _ = _test_predictions(spark, d)
    return M.evaluate(pred, "forest")


@query("f13_predictions_forest")
def f13_predictions_forest(spark, d):
    pred, _ = _test_predictions(spark, d)
    return M.prediction_table(pred, "c_custkey", keep=("batch_month",))


def _raw_split(spark, d):
    sp = split_subs(spark, d)
    return sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")


def _round_trip(spark, model, rows, name):
    """Scores by the fitted pipeline and by its saved and reloaded copy, side by side."""
    from pyspark.ml import PipelineModel
    path = work_path(spark, name)
    model.write().overwrite().save(path)
    a = ML.predict(model, rows).select("c_custkey", "score", "pred")
    b = ML.predict(PipelineModel.load(path), rows).select("c_custkey", F.col("score").alias("score_loaded"))
    return a.join(b, "c_custkey").withColumn("same", F.col("score") == F.col("score_loaded"))


@query("a5_model_roundtrip")
def a5_model_roundtrip(spark, d):
    """Preparation + assembler + forest fitted as one Spark ML pipeline on the
    train split, saved to the shared folder, loaded back, and both models
    score the test split: scores must be identical."""
    train, test = _raw_split(spark, d)
    out = _round_trip(spark, ML.stored_pipeline(train, SPEC), test, "a5-pipeline")
    return out.select("c_custkey", r6("score").alias("score"), r6("score_loaded").alias("score_loaded"), "same")


@query("a5_model_check", W(RAW_SPLIT_CTE, "SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_different FROM split WHERE split = 'test'"))
def a5_model_check(spark, d):
    train, test = _raw_split(spark, d)
    out = _round_trip(spark, ML.stored_pipeline(train, SPEC), test, "a5-check")
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("same")).alias("n_different"))


@query("k8_cluster_forest", W(RAW_SPLIT_CTE, f"""
SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_different, {len(FEATURES) + 1} AS n_features, true AS uses_cluster
FROM split WHERE batch_month = 6"""))
def k8_cluster_forest(spark, d):
    """Prepare, cluster and classify as one pipeline: the cluster is a feature
    of the forest, and the saved pipeline assigns it to raw rows of a new batch."""
    sp = split_subs(spark, d)
    model = ML.stored_pipeline(sp.where(F.col("split") == "train"), SPEC, clusters=4)
    out = _round_trip(spark, model, sp.where(F.col("batch_month") == 6).drop("split"), "k8-pipeline")
    names = ML.pipeline_features(model)
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("same")).alias("n_different"),
                   F.lit(len(names)).alias("n_features"), F.lit("cluster" in names).alias("uses_cluster"))


@query("f10_importance_cluster")
def f10_importance_cluster(spark, d):
    """Importances of the forest that has the cluster as a feature."""
    model = ML.stored_pipeline(_raw_split(spark, d)[0], SPEC, clusters=4)
    return ML.feature_importance(model, ML.pipeline_features(model))


@query("f10_importance_check", "\nUNION ALL\n".join(
    f"SELECT '{f}' AS feature, true AS in_range, true AS sums_to_one" for f in FEATURES))
def f10_importance_check(spark, d):
    """One importance per feature, between 0 and 1, summing to 1."""
    _, prep, forest = _forest(spark, d)
    imp = ML.feature_importance(forest, prep.feature_names)
    total = imp.agg(F.sum("importance")).scalar()
    return imp.select("feature", F.col("importance").between(0, 1).alias("in_range"),
                      (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


@query("f3_predict_check", W(RAW_SPLIT_CTE, """
SELECT c_custkey, label, true AS score_in_range, true AS follows_rule FROM split WHERE split = 'test'"""))
def f3_predict_check(spark, d):
    """Every test row once, its score a probability, its class the side of 0.5 it lies on."""
    pred, _ = _test_predictions(spark, d)
    return pred.select("c_custkey", "label", F.col("score").between(0, 1).alias("score_in_range"),
                       (F.col("pred") == (F.col("score") > 0.5).cast("int")).alias("follows_rule"))


@query("h1_prepare_batch", _scaled_sql(NUMERIC, "c_custkey, label, split") + " WHERE batch_month = 6")
def h1_prepare_batch(spark, d):
    sp, prep = fitted(spark, d)
    out = prep.transform(sp.where(F.col("batch_month") == 6), keep=["split"])
    return _r6_features(out, NUMERIC).select("c_custkey", "label", "split", *FEATURES)


def _rounds(spark, d, split=None):
    return ML.retrain_rounds(*(split or history_split(spark, d)), SPEC, "batch_month", range(S.N_BATCHES + 1))


@query("h4_rounds")
def h4_rounds(spark, d):
    return _rounds(spark, d)[0]


@query("h4_rounds_check", W(HISTORY_CTE, f"""
SELECT CAST(r.month AS INTEGER) AS month, count(*) AS data_size, r.month >= {S.N_BATCHES} AS latest_seen,
       (SELECT count(*) FROM hsplit t WHERE t.split = 'test' AND t.batch_month = r.month + 1) > 0 AS has_new,
       true AS in_range
FROM hsplit s JOIN (SELECT unnest(range(0, {S.N_BATCHES + 1})) AS month) r ON s.batch_month <= r.month
WHERE s.split = 'train' GROUP BY r.month"""))
def h4_rounds_check(spark, d):
    """Sizes and flags of every round, metrics between 0 and 1."""
    hist, _ = _rounds(spark, d)
    metrics = ("f1_test", "auc_test", "f1_latest", "auc_latest", "accuracy_latest")
    in_range = F.lit(True)
    for m in metrics:
        in_range = in_range & F.coalesce(F.col(m).between(0, 1), F.lit(True))  # null: one class only
    return hist.select("month", "data_size", "latest_seen", F.col("f1_on_new").isNotNull().alias("has_new"),
                       in_range.alias("in_range"))


@query("h6_select_forest")
def h6_select_forest(spark, d):
    """The choice between the rounds; the chosen models and the history are
    saved, and the saved models score the test rows again."""
    split = history_split(spark, d)
    hist, models = _rounds(spark, d, split)
    test = split[1].where(F.col("batch_month") == 0)
    version = ML.deploy(hist, models, work_path(spark, "deployed"), test, SPEC)
    month = version.info["month"]
    prep, forest = ML.load_models(version.path, SPEC)
    again = M.f1_score(ML.predict(forest, prep.transform(test))).scalar()
    saved = spark.read.parquet(f"{version.path}/history").where(F.col("month") == month).select("f1_test").scalar()
    return H.select_model(hist).select("*", F.lit(month).alias("deployed_month"),
                                       (F.abs(again - saved) < 1e-9).alias("deployed_scores_alike"))


@query("h6_deploy_check", W(HISTORY_CTE, f"""
SELECT CAST(v AS INTEGER) AS version, v = 2 AS in_force, true AS is_chosen_round, true AS refuses_other_types,
       (SELECT count(*) FROM hsplit WHERE split = 'test' AND batch_month = 0) AS n_scored, CAST(0 AS BIGINT) AS n_different
FROM (VALUES (1), (2)) AS t(v)"""))
def h6_deploy_check(spark, d):
    """The baseline is deployed, then the chosen round: each version, read back from the registry, scores
    the original test rows as the models it was made of; rows of another schema are refused."""
    split = history_split(spark, d)
    hist, models = _rounds(spark, d, split)
    test = split[1].where(F.col("batch_month") == 0)
    root = work_path(spark, "registry")
    choice = H.select_model(hist).first()
    chosen = choice["best_month"] if choice["deploy"] else 0
    wanted = {1: 0, 2: chosen}
    ML.deploy(hist.where(F.col("month") == 0).unionByName(hist.withColumn("f1_test", F.lit(-1.0)).where(F.col("month") > 0)),
              models, root, test, SPEC)
    ML.deploy(hist, models, root, test, SPEC)
    registry, out = ModelRegistry(spark, root), None
    for n, month in wanted.items():
        version = registry.version(n)
        a, b = (ML.predict(f, p.transform(test)).select("c_custkey", "score") for p, f in (
            ML.load_models(version.path, SPEC), models[month]))
        try:
            version.check(test.withColumn("tenure", F.col("tenure").cast("string")))
            refuses = False
        except SchemaMismatch:
            refuses = True
        same = a.join(b.withColumnRenamed("score", "other"), "c_custkey").agg(
            F.count(F.lit(1)).alias("n_scored"), F.count_if(F.col("score") != F.col("other")).alias("n_different"))
        row = same.select(F.lit(n).alias("version"), F.lit(registry.current().number == n).alias("in_force"),
                          F.lit(version.info["month"] == month).alias("is_chosen_round"),
                          F.lit(refuses).alias("refuses_other_types"), "n_scored", "n_different")
        out = row if out is None else out.unionByName(row)
    return out


@query("h7_importance_diff")
def h7_importance_diff(spark, d):
    """The baseline's importances next to those of the best later round."""
    hist, models = _rounds(spark, d)
    best = H.select_model(hist).first()["best_month"]
    (p0, f0), (p1, f1) = models[0], models[best]
    return H.compare_importance(ML.feature_importance(f0, p0.feature_names), ML.feature_importance(f1, p1.feature_names))


@query("h7_importance_check", "\nUNION ALL\n".join(f"SELECT '{f}' AS feature, true AS ranked" for f in FEATURES))
def h7_importance_check(spark, d):
    """With room for all, every feature has a rank on both sides."""
    _, models = _rounds(spark, d)
    a, b = (ML.feature_importance(f, p.feature_names) for p, f in (models[0], models[S.N_BATCHES]))
    out = H.compare_importance(a, b, top=len(FEATURES))
    n = len(FEATURES)
    return out.select("feature", (F.col("rank_before").between(1, n) & F.col("rank_after").between(1, n)).alias("ranked"))
