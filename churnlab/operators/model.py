"""Classification model (F2, F3, F10), persistence (A5) and the retrain
loop (H1, H4).

The forest is Spark ML's ``RandomForestClassifier`` with a class-weight
column; trees are built in parallel on the executors.  The retrain loop is a
short driver loop over months; each round is a filter of one persisted,
encoded base (no growing union lineage) followed by distributed fits.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.operators import metrics as M
from churnlab.operators import prepare as D
from churnlab.operators.retrain import as_history, evaluation_sets, select_model
from churnlab.session import materialize
from churnlab.sources.models import FitStore, ModelRegistry, Version, digests_by, input_columns, rows_digest


def forest_pipeline(feature_names: Sequence[str], params: dict | None = None,
                    weight_col: str | None = "weight") -> Pipeline:
    """assembler + random forest (200 trees, depth 10, leaf >= 20,
    square-root feature subsets, seed 42 unless overridden)."""
    # execution settings (no effect on the model): cache each row's node id
    # between levels instead of shipping trees to executors -- faster for
    # deep trees; the cache is checkpointed to the shared folder every 10
    # iterations, which also bounds lineage
    p = dict(cacheNodeIds=True, checkpointInterval=10)
    p.update(S.FOREST)
    p.update(params or {})
    rf = RandomForestClassifier(labelCol="label", featuresCol="features", probabilityCol="probability",
                                rawPredictionCol="raw", predictionCol="prediction", **p)
    if weight_col:
        rf.setWeightCol(weight_col)
    return Pipeline(stages=[VectorAssembler(inputCols=list(feature_names), outputCol="features",
                                            handleInvalid="error"), rf])


# rows of a partition of the training data, and the fewest partitions: a setting of
# the fit, the same on every cluster, because sampling depends on the partitions
FIT_ROWS, FIT_PARTITIONS = 50_000, 8


def fit_order(df: DataFrame, key: str, rows: int = FIT_ROWS) -> DataFrame:
    """Rows in a fixed partitioning by key and a fixed order inside each
    partition (a shuffle delivers rows in fetch order).  The number of
    partitions follows the number of rows, not the cluster, so a seed gives
    the same model anywhere."""
    n = max(FIT_PARTITIONS, -(-df.count() // rows))
    return df.repartition(n, key).sortWithinPartitions(key)


def train_forest(train: DataFrame, feature_names: Sequence[str], params: dict | None = None,
                 balanced: bool = True, key: str | None = None) -> PipelineModel:
    """F2 with F1: balanced class weights n / (k * n_class) as ``weightCol``,
    on rows in :func:`fit_order`."""
    if balanced:
        train = M.balanced_weights(train, "label")
    data = fit_order(train, key or train.columns[0])
    return forest_pipeline(feature_names, params, "weight" if balanced else None).fit(data)


def fit_churn_pipeline(train: DataFrame, spec: S.FeatureSpec, params: dict | None = None, keep: Sequence[str] = (),
                       clusters: int | None = None, key: str | None = None) -> PipelineModel:
    """A5/D14/F2 as ONE Spark ML pipeline model: preparation, assembler and
    forest, each fitted once on the raw ``train`` rows (with ``label``).

    With ``clusters`` all features are standardised, KMeans is fitted on the
    train rows, and the cluster is one more feature of the forest (K3 -> K8
    -> F2); scoring assigns the cluster again from the raw row."""
    key = key or spec.id_col
    data = fit_order(M.balanced_weights(train, "label"), key).persist()
    try:
        prep = D.ChurnPrepare(specJson=D.spec_to_json(spec), scaleAll=bool(clusters), keepCols=[*keep, "weight"]).fit(data)
        names, stages = list(prep.feature_names), []
        if clusters:
            stages = [VectorAssembler(inputCols=names, outputCol="scaled", handleInvalid="error"),
                      KMeans(k=clusters, seed=S.SEED, featuresCol="scaled", predictionCol="cluster")]
            names = [*names, "cluster"]
        stages += forest_pipeline(names, params, "weight").getStages()
        fitted = Pipeline(stages=stages).fit(prep.transform(data))
    finally:
        data.unpersist()
    return PipelineModel(stages=[prep, *fitted.stages])


def pipeline_features(model: PipelineModel) -> list[str]:
    """The forest's input columns, in the order of its importances."""
    return list(model.stages[-2].getInputCols())


def predict(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """probability of class 1 as ``score`` and the 0/1 decision
    (class 1 only above the threshold; a tie goes to class 0)."""
    out = model.transform(df)
    out = out.withColumn("score", vector_to_array(F.col("probability"))[1])
    return out.drop("scaled", "features", "raw", "probability", "prediction").withColumn("pred", M.predict_at("score", threshold))


def feature_importance(model: PipelineModel, feature_names: Sequence[str], top: int | None = None) -> DataFrame:
    """mean decrease in impurity per feature, ranked.  The importance
    vector has one entry per feature, so it is read on the driver."""
    imp = model.stages[-1].featureImportances.toArray()
    rows = sorted(((str(f), float(v)) for f, v in zip(feature_names, imp)), key=lambda t: (-t[1], t[0]))
    if top:
        rows = rows[:top]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([(i + 1, f, v) for i, (f, v) in enumerate(rows)],
                                 "rank int, feature string, importance double")


def forest_summary(model: PipelineModel) -> DataFrame:
    """F2 result: size of the fitted forest."""
    rf = model.stages[-1]
    spark = SparkSession.getActiveSession()
    depth = max(t.depth for t in rf.trees)
    return spark.createDataFrame([(rf.getNumTrees, int(depth), int(rf.totalNumNodes), int(rf.numFeatures))],
                                 "num_trees int, max_depth int, total_nodes int, n_features int")


def save_models(prep: D.PrepareModel, forest: PipelineModel, path: str, spark: SparkSession | None = None) -> str:
    """A5: preparation constants + forest below one folder on shared storage."""
    prep.save(spark or SparkSession.getActiveSession(), f"{path}/prepare")
    forest.write().overwrite().save(f"{path}/forest")
    return path


def load_models(path: str, spec: S.FeatureSpec, spark: SparkSession | None = None):
    prep = D.PrepareModel.load(spark or SparkSession.getActiveSession(), f"{path}/prepare", spec)
    return prep, PipelineModel.load(f"{path}/forest")


def fit_models(train: DataFrame, spec: S.FeatureSpec, params: dict | None = None, store: FitStore | None = None,
               digest=None):
    """D14 + F2 on the raw ``train`` rows (with ``label``), fitted once per rows and parameters:
    (preparation, forest) from the store, where another report has fitted them before.
    ``digest`` stands for the rows where the caller has it already."""
    spark = train.sparkSession
    store = store or FitStore(spark)
    return load_models(models_path(train, spec, params, store, digest), spec, spark)


def models_path(train: DataFrame, spec: S.FeatureSpec, params: dict | None, store: FitStore, digest=None) -> str:
    """Where the models of :func:`fit_models` lie, fitted if need be."""
    path = store.path("models", digest or rows_digest(train), D.spec_to_json(spec), S.FOREST, params)

    def fit(place: str) -> None:
        prep = D.fit_prepare(train, spec)
        save_models(prep, train_forest(prep.transform(train), prep.feature_names, params, key=spec.id_col), place, train.sparkSession)

    return store.make(path, fit)


class Models(Mapping):
    """{round: (preparation, forest)}, read from the store when asked for."""

    def __init__(self, paths: dict[int, str], spec: S.FeatureSpec, spark: SparkSession):
        self.paths, self.spec, self.spark, self.read = paths, spec, spark, {}

    def __getitem__(self, m):
        if m not in self.read:
            self.read[m] = load_models(self.paths[m], self.spec, self.spark)
        return self.read[m]

    def __iter__(self):
        return iter(self.paths)

    def __len__(self):
        return len(self.paths)


def stored_pipeline(train: DataFrame, spec: S.FeatureSpec, params: dict | None = None, keep: Sequence[str] = (),
                    clusters: int | None = None, store: FitStore | None = None) -> PipelineModel:
    """:func:`fit_churn_pipeline`, fitted once per rows and parameters."""
    store = store or FitStore(train.sparkSession)
    path = store.path("pipeline", rows_digest(train), D.spec_to_json(spec), S.FOREST, params, list(keep), clusters)
    return PipelineModel.load(store.make(path, lambda place: fit_churn_pipeline(
        train, spec, params, keep, clusters).write().save(place)))


#: Rounds fitted at a time on small tables, where each is a chain of small jobs that leaves most of a cluster idle,
#: and the rows that rounds under way may hold together: a fit keeps about 2.5 KB a row (200 sample counts, and 200 node ids twice).
ROUNDS_AT_A_TIME, ROWS_AT_A_TIME = 4, 3_000_000


def rounds_at_a_time(rows: int) -> int:
    """How many rounds of up to ``rows`` rows are fitted beside each other: rounds that do not fit
    into storage memory together would write and read each other's cached rows at every level of the trees."""
    return max(1, min(ROUNDS_AT_A_TIME, ROWS_AT_A_TIME // max(rows, 1)))


def retrain_rounds(train: DataFrame, test: DataFrame, spec: S.FeatureSpec, month_col: str,
                   months: Sequence[int], params: dict | None = None, last_month: int = S.N_BATCHES,
                   store: FitStore | None = None):
    """H4: per round m refit preparation + forest on train rows of months
    <= m (month 0 is the original table, round 0 the baseline) and evaluate
    on the sets of :func:`evaluation_sets`; test rows are kept raw and
    prepared with the round's own fitted constants.

    Returns (history DataFrame, :class:`Models`).  ``train`` is
    persisted once and unpersisted at the end; every round is a filter of it.
    Sizes and digests of all months come from one pass.  A round's models and
    metrics are kept in the store under the digests of its months, so that reports
    on the same rounds fit them once; rounds run beside each other.
    """
    train = train.persist()
    spark = train.sparkSession
    store = store or FitStore(spark)
    try:
        found = {int(k): v for k, v in digests_by(train, month_col).items() if k is not None}
        tested = rows_digest(test)

        def one(m: int):
            seen = sorted((k, *v) for k, v in found.items() if k <= m)
            models = models_path(train.where(F.col(month_col) <= m), spec, params, store, seen)

            def evaluate(place: str) -> None:
                mine = test.select("*", F.lit(m).alias("round"))
                mine = mine.select("*", F.explode(evaluation_sets(month_col, "round", last_month)).alias("part"))
                prep, forest = load_models(models, spec, spark)
                scored = predict(forest, prep.transform(mine, keep=["round", "part"])).select("round", "part", "label", "score", "pred")
                scored = materialize(scored, "round-scores")  # the evaluation reads them twice
                M.grouped_evaluate(scored, ["round", "part"]).write.parquet(place)

            path = store.path("round", seen, tested, D.spec_to_json(spec), S.FOREST, params, m, last_month)
            return m, sum(v[1] for v in seen), models, store.make(path, evaluate)

        with ThreadPoolExecutor(rounds_at_a_time(sum(v[0] for v in found.values()))) as pool:
            done = list(pool.map(inheritable_thread_target(spark)(one), months))
    finally:
        train.unpersist()
    sizes = spark.createDataFrame([(int(m), int(n)) for m, n, *_ in done], "round int, data_size bigint")
    evaluated = spark.read.parquet(*[path for *_, path in done])
    return as_history(sizes, evaluated, last_month), Models({m: path for m, _, path, _ in done}, spec, spark)


def deploy(history: DataFrame, models: dict, path: str, rows: DataFrame, spec: S.FeatureSpec) -> Version:
    """H6: publish the chosen round's models (the best one if it is strictly
    better than the baseline, else the baseline) with the history as a new version
    of the registry at ``path``; ``info`` has the chosen month.  ``rows`` shows the raw input columns."""
    choice = select_model(history).first()
    month = choice["best_month"] if choice["deploy"] else 0
    spark = history.sparkSession

    def save(place: str) -> None:
        save_models(*models[month], place, spark)
        history.write.parquet(f"{place}/history")

    inputs = input_columns(rows, [spec.id_col, *[c for c in spec.raw_features if c in rows.columns]])
    return ModelRegistry(spark, path).deploy(save, inputs, {"month": int(month)})


def current_scorer(registry: ModelRegistry, spec: S.FeatureSpec, keep: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """S3: scores rows by the version in force when it is called, for
    :func:`churnlab.streaming.monthly.stream_score`, which calls it for every micro-batch.  Rows without the
    version's input columns are refused.  Returns key, ``keep``, score, pred, risk_level and model_version."""
    loaded: dict[int, tuple] = {}

    def score(rows: DataFrame) -> DataFrame:
        version = registry.current()
        version.check(rows)
        if version.number not in loaded:
            loaded.clear()
            loaded[version.number] = load_models(version.path, spec, registry.spark)
        prep, forest = loaded[version.number]
        out = predict(forest, prep.transform(rows, keep=list(keep)))
        return out.select(spec.id_col, *keep, "score", "pred", M.risk_level().alias("risk_level"),
                          F.lit(version.number).alias("model_version"))

    return score
