"""Shared fits, the model registry, deterministic k-means, sketches and the round quantiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.functions.prefix import exact_quantiles, ordered_prefix
from churnlab.operators import drift as G
from churnlab.operators import explore as E
from churnlab.operators import lloyd as L
from churnlab.operators import metrics as M
from churnlab.operators import model as ML
from churnlab.operators import prepare as D
from churnlab.operators import profile as P
from churnlab.operators import retrain as H
from churnlab.session import work_path
from churnlab.sources import models as R
from churnlab.streaming import monthly as ST

SPEC = S.FeatureSpec("id", "churn", numeric=("a", "b"), column_order=("id", "churn", "a", "b"))
FOREST = dict(numTrees=8, maxDepth=4, minInstancesPerNode=5)


def rows(spark, n=300, months=3, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    data = [(i, "Yes" if x[i, 0] > 0.4 else "No", float(x[i, 0]), float(x[i, 1]), i % (months + 1)) for i in range(n)]
    df = spark.createDataFrame(data, "id long, churn string, a double, b double, batch_month bigint")
    return df.withColumn("label", D.encode_target(SPEC))


# ---------------------------------------------------------------------- fits
def test_digests_know_rows_but_not_their_order(spark):
    df = rows(spark, 50)
    one = R.rows_digest(df)
    assert one == R.rows_digest(df.repartition(7).orderBy(F.col("b").desc()))
    assert one != R.rows_digest(df.where("id > 0")) and one != R.rows_digest(df.unionByName(df.limit(1)))
    assert one != R.rows_digest(df.withColumn("a", F.when(F.col("id") == 3, 0.0).otherwise(F.col("a"))))
    assert one != R.rows_digest(df.withColumnRenamed("a", "c"))
    assert R.rows_digest(df.limit(0)) == "empty"
    by = R.digests_by(df, "batch_month")
    assert by[2] == (12, by[2][1]) and len({d for _, d in by.values()}) == 4


def test_a_fit_is_made_once(spark, monkeypatch):
    df, store = rows(spark), R.FitStore(spark, work_path(spark, "t-store"))
    fitted = []
    real = ML.train_forest
    monkeypatch.setattr(ML, "train_forest", lambda *a, **k: fitted.append(1) or real(*a, **k))
    _, f1 = ML.fit_models(df, SPEC, FOREST, store)
    prep, f2 = ML.fit_models(df.repartition(3), SPEC, FOREST, store)
    assert len(fitted) == 1
    scores = [{r.id: r.score for r in ML.predict(f, prep.transform(df)).collect()} for f in (f1, f2)]
    assert scores[0] == scores[1]
    ML.fit_models(df.where("id > 5"), SPEC, FOREST, store)
    ML.fit_models(df, SPEC, dict(FOREST, maxDepth=3), store)
    assert len(fitted) == 3


def test_rounds_share_fits_and_a_lost_fit_leaves_nothing(spark, monkeypatch):
    df, store = rows(spark), R.FitStore(spark, work_path(spark, "t-rounds"))
    train, test = df.where("id % 5 <> 0"), df.where("id % 5 = 0")
    real = ML.train_forest

    def lost(*a, **k):
        raise RuntimeError("executors lost")

    monkeypatch.setattr(ML, "train_forest", lost)
    with pytest.raises(RuntimeError, match="executors lost"):
        ML.retrain_rounds(train, test, SPEC, "batch_month", range(4), FOREST, 3, store)
    fitted = []
    monkeypatch.setattr(ML, "train_forest", lambda *a, **k: fitted.append(1) or real(*a, **k))
    hist, models = ML.retrain_rounds(train, test, SPEC, "batch_month", range(4), FOREST, 3, store)
    want = sorted(map(tuple, hist.collect()))
    assert len(fitted) == 4 and len(models) == 4 and [w[0] for w in want] == [0, 1, 2, 3]
    again, _ = ML.retrain_rounds(train, test, SPEC, "batch_month", range(4), FOREST, 3, store)
    assert sorted(map(tuple, again.collect())) == want and len(fitted) == 4
    # a round on its own gives the same models
    prep, forest = models[2]
    alone = ML.train_forest(prep.transform(train.where("batch_month <= 2")), prep.feature_names, FOREST, key="id")
    a, b = ({r.id: r.score for r in ML.predict(f, prep.transform(test)).collect()} for f in (forest, alone))
    assert a == b


def test_a_round_scores_its_rows_once(spark, monkeypatch):
    """The evaluation reads the scores several times; the trees run over a row once."""
    df, store = rows(spark), R.FitStore(spark, work_path(spark, "t-scores"))
    real, plans = M.grouped_evaluate, []
    monkeypatch.setattr(M, "grouped_evaluate", lambda scored, *a: plans.append(
        scored._jdf.queryExecution().optimizedPlan().toString()) or real(scored, *a))
    hist, _ = ML.retrain_rounds(df.where("id % 5 <> 0"), df.where("id % 5 = 0"), SPEC, "batch_month", range(2), FOREST, 3, store)
    assert hist.count() == 2 and len(plans) == 2
    assert not any("UDF" in p for p in plans)


# ------------------------------------------------------------------ registry
def test_registry_switches_in_one_step(spark):
    df = rows(spark)
    root = work_path(spark, "t-registry")
    registry = R.ModelRegistry(spark, root)
    with pytest.raises(LookupError):
        registry.current()
    prep, forest = ML.fit_models(df, SPEC, FOREST)
    inputs = R.input_columns(df, ["id", "a", "b"])
    first = registry.deploy(lambda p: ML.save_models(prep, forest, p, spark), inputs, {"month": 0})
    assert registry.current() == first and first.number == 1

    def crash(path):
        ML.save_models(prep, forest, path, spark)
        raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError):  # lost after the files, before the entry
        registry.deploy(crash, inputs)
    assert registry.current() == first
    want = {r.id: r.score for r in ML.predict(forest, prep.transform(df)).collect()}
    p2, f2 = ML.load_models(registry.current().path, SPEC)
    assert {r.id: r.score for r in ML.predict(f2, p2.transform(df)).collect()} == want
    second = registry.deploy(lambda p: ML.save_models(prep, forest, p, spark), inputs)
    assert registry.current() == second and registry.version(1) == first
    assert [r.number for r in registry.versions().orderBy("number").collect()] == [1, 2]


def test_rows_of_another_schema_are_refused(spark):
    df = rows(spark, 40)
    registry = R.ModelRegistry(spark, work_path(spark, "t-schema"))
    v = registry.deploy(lambda p: df.limit(1).write.parquet(p), R.input_columns(df, ["id", "a", "b"]))
    v.check(df.select("b", "a", "id", "churn"))
    for bad in (df.drop("a"), df.withColumn("a", F.col("a").cast("string"))):
        with pytest.raises(R.SchemaMismatch, match="a: needs double"):
            v.check(bad)


def test_stream_scores_by_the_version_in_force(spark):
    df = rows(spark)
    registry = R.ModelRegistry(spark, work_path(spark, "t-stream-registry"))
    inputs = R.input_columns(df, ["id", "churn", "a", "b"])
    landing, sink, ckpt = (work_path(spark, f"t-stream-{n}") for n in ("in", "sink", "ckpt"))
    scorer = ML.current_scorer(registry, SPEC, ["batch_month", ST.DELIVERY])
    want = {}
    for number, month in ((1, 1), (2, 2)):
        prep, forest = ML.fit_models(df.where(F.col("batch_month") < month), SPEC, FOREST)
        registry.deploy(lambda p, a=prep, b=forest: ML.save_models(a, b, p, spark), inputs)
        mine = df.where(F.col("batch_month") == month)
        mine.select("id", "churn", "a", "b").write.parquet(f"{landing}/month_{month:02d}")
        out = ST.stream_score(spark, landing, "id long, churn string, a double, b double", sink, ckpt, scorer)
        want |= {r.id: (number, r.score) for r in ML.predict(forest, prep.transform(mine)).collect()}
    assert {r.id: (r.model_version, r.score) for r in out.collect()} == want


# ------------------------------------------------------------------- k-means
def lloyd_by_numpy(x, centres, steps):
    for _ in range(steps + 1):
        d = ((x[:, None, :] - centres[None]) ** 2).sum(2).round(9)
        label = d.argmin(1)
        inertia, used = d.min(1).sum(), centres
        centres = np.array([x[label == k].mean(0).round(9) if (label == k).any() else c for k, c in enumerate(centres)])
    return used, label, inertia


def test_lloyd_and_silhouette_against_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([c + rng.normal(size=(40, 2)) for c in ((0, 0), (6, 6), (-6, 5))])
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)] + [(900, None), (901, [1.0])],
                               "id long, v array<double>")
    starts = {2: x[[0, 1]], 3: np.vstack([x[[0, 50]], [[500.0, 500.0]]]), 1: x[[5]]}  # one centre that nothing is near
    centres = spark.createDataFrame([(k, i, [float(v) for v in c]) for k, cs in starts.items() for i, c in enumerate(cs)],
                                    "run int, cid int, cv array<double>")
    fit = L.lloyd(df, "v", 2, centres, max_steps=4, tolerance=-1.0)
    sil = {r.run: (r.n, r.silhouette) for r in L.silhouette(df, "v", 2, fit.centres).collect()}
    for k, cs in starts.items():
        used, label, inertia = lloyd_by_numpy(x, cs, 4)
        last = fit.steps.where((F.col("run") == k) & (F.col("step") == 4)).collect()
        assert sum(r.inertia for r in last) == pytest.approx(inertia, rel=1e-9)
        assert {r.cid: r.n for r in last} == {i: int((label == i).sum()) for i in range(k)}
        got = {r.cid: r.cv for r in fit.centres.where(F.col("run") == k).collect()}
        assert all(got[i] == pytest.approx(list(used[i]), abs=1e-8) for i in range(k))
        d2 = ((x[:, None] - x[None]) ** 2).sum(2)
        scores = []
        for i in range(len(x)):
            means = {c: d2[i, label == c].sum() / ((label == c).sum() - (c == label[i])) for c in set(label)
                     if (label == c).sum() > (c == label[i])}
            others = [m for c, m in means.items() if c != label[i]]
            scores.append(0.0 if not others or label[i] not in means else (min(others) - means[label[i]]) / max(min(others), means[label[i]]))
        assert sil[k] == (len(x), pytest.approx(np.mean(scores), abs=1e-9))


def test_lloyd_stops_when_nothing_moves_and_takes_empty_tables(spark):
    df = spark.createDataFrame([(0, [0.0]), (1, [1.0]), (2, [10.0])], "id int, v array<double>")
    centres = spark.createDataFrame([(2, 0, [0.0]), (2, 1, [9.0])], "run int, cid int, cv array<double>")
    fit = L.lloyd(df, "v", 1, centres)
    assert {(r.cid, tuple(r.cv)) for r in fit.centres.collect()} == {(0, (0.5,)), (1, (10.0,))}
    assert fit.steps.agg(F.max("step")).first()[0] == 1
    none = L.lloyd(df.limit(0), "v", 1, centres)
    assert [(r.n, r.inertia) for r in none.steps.collect()] == [(0, 0.0)] * 2
    assert L.silhouette(df.limit(0), "v", 1, centres).collect() == []


# ------------------------------------------------------ sketches and quantiles
def test_sketches_of_parts_merge_to_the_whole(spark):
    n = 40_000
    df = spark.range(n).select((F.col("id") % 6).alias("part"), F.col("id").cast("string").alias("many"), (F.col("id") % 37).alias("few"),
                               F.lit(None).cast("string").alias("none"), ((F.col("id") * 7919) % n).cast("double").alias("x"))
    got = {r.column: (r.non_null, r.n_distinct) for r in P.merged_distinct(P.distinct_sketches(df, ["many", "few", "none"], ["part"])).collect()}
    assert got["many"][0] == n and abs(got["many"][1] - n) < 0.033 * n
    assert got["few"] == (n, 37) and got["none"] == (0, 0)
    exact = {r.position: (r.non_null, r.n_distinct) for r in P.distinct_counts(df, ["many", "few", "none"]).collect()}
    assert exact == {0: (n, n), 1: (n, 37), 2: (0, 0)}
    qs = P.merged_quantiles(P.quantile_sketches(df, ["x"], ["part"]), [0.1, 0.5, 0.99])
    assert all(abs(r.value - r.q * n) <= 2 * P.rank_error() * n + 1 for r in qs.collect())


def test_distinct_counts_make_no_expand(spark):
    df = rows(spark, 20)
    plan = P.distinct_counts(df, df.columns)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_round_quantiles_equal_quantiles_of_each_round(spark):
    rng = np.random.default_rng(5)
    data = [(int(m), float(np.round(x, 1)), int(w)) for m, x, w in zip(rng.integers(0, 5, 900), rng.normal(size=900) * 3, rng.integers(1, 4, 900))]
    df = spark.createDataFrame(data + [(1, None, 5)], "m int, x double, w int")
    for q in (0.0, 0.25, 0.75, 1.0):
        got = {r["round"]: (round(r["q_0"], 9), r["n"]) for r in H.cumulative_quantiles(df, "m", "x", "w", q, 6).collect()}
        for r in range(7):
            one = exact_quantiles(df.where(F.col("m") <= r), "x", [q], weight_col="w").first()
            assert got[r] == (round(one["q_0"], 9), one["n"])
    # a first round without rows has no quantile
    late = H.cumulative_quantiles(df.where("m > 1"), "m", "x", "w", 0.5, 3).collect()
    assert {r["round"] for r in late} == {2, 3}


# ---------------------------------------------------------------- null groups
def test_null_groups_are_groups(spark):
    df = spark.createDataFrame([("p", 1.0), ("p", 2.0), (None, 5.0), (None, 7.0), (None, 7.0), (None, None)], "g string, x double")
    hist = {(r.g, r.bin): r.n for r in E.histogram(df, "x", by="g", bins=2).collect()}
    assert hist == {("p", 0): 1, ("p", 1): 1, (None, 0): 1, (None, 1): 2}
    assert {r.g: r["median"] for r in E.box_stats(df, "x", "g").collect()} == {"p": 1.5, None: 7.0}
    pref = ordered_prefix(df.where("x is not null").distinct().withColumn("w", F.lit(1)), ["x"], ["w"], ["g"])
    assert {(r.g, r.x): r.before_w for r in pref.collect()} == {("p", 1.0): 0, ("p", 2.0): 1, (None, 5.0): 0, (None, 7.0): 1}
    scored = spark.createDataFrame([(None, 1, 0.9, 1), (None, 0, 0.1, 0), ("p", 0, 0.2, 0)], "g string, label int, score double, pred int")
    assert {r.g: r.auc for r in M.grouped_evaluate(scored, "g").collect()} == {None: 1.0, "p": None}
    keyed = G.batch_key(spark.createDataFrame([(None, 1), (None, 2), (3, 9)], "month int, id int"), "month", "id")
    assert keyed.count() == 3


def test_rows_without_a_score_are_left_out_and_counted(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (0, None), (None, 0.5)], "label int, score double")
    assert M.roc_auc(df).first()["auc"] == 1.0
    assert all(r.threshold is not None for r in M.roc_curve(df).collect() + M.pr_curve(df).collect())
    assert tuple(M.unscored(df).first()) == (5, 2, 1)


def test_lloyd_reads_points_once_and_sums_batches(spark):
    """Points with nulls, of another length, alone in a cluster; many points of many parts."""
    rows = [([float(i % 7), float(i % 5)],) for i in range(300)] + [([1.0],), (None,), ([None, 1.0],), ([1e6, 1e6],)]
    made = spark.sparkContext.accumulator(0)
    schema = "v array<double>"
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3).map(lambda r: (made.add(1), r)[1]), schema)
    centres = spark.createDataFrame([(2, 0, [0.0, 0.0]), (2, 1, [1e6, 1e6]), (1, 0, [0.0, 0.0])], "run int, cid int, cv array<double>")
    fit = L.lloyd(df, "v", 2, centres, max_steps=3, tolerance=-1.0)
    assert made.value <= 2 * len(rows)  # counted and written, not made again at every step
    last = {(r.run, r.cid): (r.n, r.inertia) for r in fit.steps.where("step = 3").collect()}
    assert {k: n for k, (n, _) in last.items()} == {(1, 0): 302, (2, 0): 301, (2, 1): 1} and last[2, 1][1] == 0
    cv = {(r.run, r.cid): r.cv for r in fit.centres.collect()}
    assert cv[2, 0] == [round(sum(i % 7 for i in range(300)) / 300, 9), round((sum(i % 5 for i in range(300)) + 1) / 301, 9)]
    sil = {r.run: (r.n, r.silhouette) for r in L.silhouette(df, "v", 2, fit.centres).collect()}
    assert sil[1] == (302, 0.0) and sil[2][0] == 302 and 0.99 < sil[2][1] < 1


def test_rounds_beside_each_other_follow_their_rows():
    from churnlab.operators import model as ML
    assert [ML.rounds_at_a_time(n) for n in (0, 10, 750_000, 1_000_000, 4_300_000)] == [4, 4, 4, 3, 1]


def test_split_reads_the_rows_written_once(spark, monkeypatch):
    from churnlab.plans import q_prepare as Q
    seen, split = [], D.stratified_split
    monkeypatch.setattr(D, "stratified_split", lambda df, *a: seen.append(df) or split(df, *a))
    want = Q.labelled(spark, "/root/testdata/sf0.001")
    got = Q.split_subs(spark, "/root/testdata/sf0.001")
    assert not any("orders.parquet" in f for f in seen[0].inputFiles())  # not the joins that make the rows
    assert sorted(map(str, got.drop("split").collect())) == sorted(map(str, want.collect()))
