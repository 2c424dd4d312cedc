"""Wide one-hot: many categories through fit, save, load and a stream."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.operators import prepare as D
from churnlab.operators import wide as X
from churnlab.session import work_path
from churnlab.streaming import monthly as ST

SPEC = S.FeatureSpec("id", "churn", numeric=("age",), flags=("f",), column_order=("id", "churn", "age", "f"))


def test_a_million_categories(spark):
    """Nothing but sizes reaches the driver; every value finds its index again after saving and loading."""
    n = 1_000_000
    df = spark.range(n).select("id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("wide"))
    model = X.WideOneHot(["wide"]).fit(df)
    assert model.size_of() == {"wide": n}
    path = work_path(spark, "t-wide")
    model.save(path)
    loaded = X.WideOneHotModel.load(path)
    assert loaded.size_of() == {"wide": n} and loaded.path != model.path
    out = loaded.transform(df.unionByName(spark.createDataFrame([(-1, "new"), (-2, None)], "id long, wide string")))
    got = out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("wide_ix").alias("d"), F.max("wide_ix").alias("m"),
                  F.count_if((F.col("id") < 0) & (F.col("wide_ix") == n)).alias("unknown")).first()
    assert (got.n, got.d, got.m, got.unknown) == (n + 2, n + 1, n, 2)


def test_sparse_pipeline_scores_batch_and_stream_alike(spark):
    rows = [(i, "Yes" if i % 7 < 3 else "No", float(i % 50), i % 2, f"shop {i % 7}", f"c{i % 400}", i % 3 + 1) for i in range(2000)]
    schema = "id long, churn string, age double, f int, shop string, code string"
    df = spark.createDataFrame(rows, schema + ", batch_month bigint")
    train = df.where("id % 5 <> 0").withColumn("label", D.encode_target(SPEC))
    model = X.fit_wide_pipeline(train, SPEC, ["shop", "code"], LogisticRegression(maxIter=8, weightCol="weight"),
                                keep=["batch_month", ST.DELIVERY])
    path = work_path(spark, "t-wide-pipeline")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    scored = model.transform(df)
    vector = scored.select("features").first()[0]
    assert isinstance(vector, SparseVector) and vector.size == 2 + 7 + 320  # codes of the train rows
    want = {r.id: r.prediction for r in scored.select("id", "prediction").collect()}
    assert sum(want[i] == float(i % 7 < 3) for i in want) == len(want)  # the shop decides
    assert {r.id: r.prediction for r in loaded.transform(df).select("id", "prediction").collect()} == want

    root = work_path(spark, "t-wide-in")
    for m in (1, 2, 3):
        df.where(F.col("batch_month") == m).drop("batch_month").write.parquet(f"{root}/month_{m:02d}")

    def score(src):
        return loaded.transform(src).select("id", "prediction", "batch_month", ST.DELIVERY)

    out = ST.stream_score(spark, root, schema, work_path(spark, "t-wide-sink"), work_path(spark, "t-wide-ckpt"), score,
                          max_files_per_trigger=1)
    assert {r.id: r.prediction for r in out.collect()} == want


def test_nulls_unseen_values_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "b", None), (2, "a", None), (3, None, None), (4, "a", None)], "id int, x string, y string")
    model = X.WideOneHot(["x", "y"]).fit(df)
    assert model.size_of() == {"x": 2, "y": 0}
    got = {r.id: (r.x_ix, r.y_ix) for r in model.transform(df).collect()}
    assert got == {1: (1.0, 0.0), 2: (0.0, 0.0), 3: (2.0, 0.0), 4: (0.0, 0.0)}
    new = spark.createDataFrame([(9, "zzz", "q")], "id int, x string, y string")
    assert [(r.x_ix, r.y_ix) for r in model.transform(new).collect()] == [(2.0, 0.0)]
    assert model.transform(df.limit(0)).collect() == []


def test_a_dense_one_hot_refuses_to_collect_wide_columns(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("x"))
    with pytest.raises(ValueError, match="more than 20 categories in x"):
        D.fit_one_hot(df, ["x"], limit=20)
    assert len(D.fit_one_hot(df, ["x"], limit=30)["x"]) == 30


def test_fitted_preparation_keeps_or_refuses_unknown_binary_values(spark):
    spec = S.FeatureSpec("id", "churn", binary={"b": "Y"}, binary_negative={"b": "N"}, column_order=("id", "churn", "b"))
    train = spark.createDataFrame([(1, "Yes", "Y"), (2, "No", "N")], "id int, churn string, b string")
    new = spark.createDataFrame([(3, "No", "maybe"), (4, "No", None), (5, "No", "N")], "id int, churn string, b string")

    def codes(how):
        stage = D.ChurnPrepare(specJson=D.spec_to_json(spec), handleUnknown=how).fit(train)
        return [r.b for r in stage.transform(new).orderBy("id").collect()]

    assert codes("null") == [None, None, 0.0] and codes("zero") == [0.0, 0.0, 0.0]
    with pytest.raises(Exception, match="unknown value in b: maybe"):
        codes("error")
    with pytest.raises(ValueError, match="no declared negative"):
        D.fit_prepare(train, S.FeatureSpec("id", "churn", binary={"b": "Y"}, column_order=("id", "churn", "b")),
                      handle_unknown="null").encode(new)
