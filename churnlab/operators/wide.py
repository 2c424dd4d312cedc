"""D6/D14 for columns of any number of categories: a sparse one-hot whose category table is Parquet.

``WideOneHot`` is a Spark ML estimator.  Its fit writes a table (column, value,
index) to the shared folder; the model joins that table to the rows, column by
column, and nothing of it passes through the driver or one task but the number
of categories per column.  Spark's ``OneHotEncoder`` turns the indices into sparse
vectors.  The join is a left join with a static table, so the model also runs
on streaming DataFrames; saving a model copies its table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.functions.ranking import group_row_number
from churnlab.operators import metrics as M
from churnlab.operators import prepare as D
from churnlab.session import work_path

TABLE = "column string, value string, index bigint"
INDEX = "_ix"


def wide_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, index): every non-null category, numbered from 0 within its column in value order."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])))
    cats = long.where(F.col("value").isNotNull()).distinct()
    return group_row_number(cats, ["column"], [("value", False)], "_k").select("column", "value", (F.col("_k") - 1).alias("index"))


class _WideParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "wide nominal columns", typeConverter=TypeConverters.toListString)


class WideOneHot(Estimator, _WideParams, DefaultParamsReadable, DefaultParamsWritable):
    """Numbers the categories of ``inputCols`` (of the rows it is fitted on)."""

    def __init__(self, inputCols: Sequence[str] | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _fit(self, dataset: DataFrame) -> "WideOneHotModel":
        cols, spark = self.getOrDefault(self.inputCols), dataset.sparkSession
        path = work_path(spark, "wide-categories")
        wide_table(dataset, cols).write.partitionBy("column").parquet(path)
        return WideOneHotModel(cols, path, _sizes(spark, path, cols))


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TABLE).parquet(path)


def _sizes(spark: SparkSession, path: str, cols: Sequence[str]) -> dict[str, int]:
    """Categories per column: one small row per column reaches the driver."""
    found = {r["column"]: r["n"] for r in _read(spark, path).groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {c: int(found.get(c, 0)) for c in cols}


class WideOneHotModel(Model, _WideParams, MLWritable, MLReadable):
    """Adds ``<column>_ix`` (double) for every wide column: the category's index, or the number of
    categories for nulls and values that the fit has not seen."""

    sizes = Param(Params._dummy(), "sizes", "categories per column (JSON)", typeConverter=TypeConverters.toString)

    def __init__(self, inputCols: Sequence[str] | None = None, path: str | None = None, sizes: dict | None = None):
        super().__init__()
        self.path = path
        if inputCols is not None:
            self._set(inputCols=list(inputCols), sizes=json.dumps(sizes))

    def size_of(self) -> dict[str, int]:
        return json.loads(self.getOrDefault(self.sizes))

    def table(self, spark: SparkSession) -> DataFrame:
        return _read(spark, self.path)

    def encoder(self) -> OneHotEncoder:
        """The stage that turns the indices into sparse vectors ``<column>_vec``; nulls and
        unseen values, the last index, have no 1."""
        cols = self.getOrDefault(self.inputCols)
        return OneHotEncoder(inputCols=[c + INDEX for c in cols], outputCols=[c + "_vec" for c in cols], dropLast=True)

    def encoder_rows(self, spark: SparkSession) -> DataFrame:
        """One row with the last index of every column: all that the encoder's fit needs."""
        return spark.range(1).select(*[F.lit(float(n)).alias(c + INDEX) for c, n in self.size_of().items()])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, table, sizes = dataset, self.table(dataset.sparkSession), self.size_of()
        for i, c in enumerate(self.getOrDefault(self.inputCols)):
            mine = table.where(F.col("column") == c).select(F.col("value").alias(f"_v{i}"), F.col("index").alias(f"_i{i}"))
            out = out.join(mine, F.col(c).cast("string") == F.col(f"_v{i}"), "left").drop(f"_v{i}")
            out = out.withColumn(c + INDEX, F.coalesce(F.col(f"_i{i}"), F.lit(sizes[c])).cast("double")).drop(f"_i{i}")
        return out

    def write(self) -> MLWriter:
        return _WideWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _WideReader(cls)


class _WideWriter(MLWriter):
    def __init__(self, model: WideOneHotModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark)
        self.model.table(spark).write.partitionBy("column").parquet(f"{path}/table")


class _WideReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> WideOneHotModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(path=f"{path}/table")
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


def fit_wide_pipeline(train: DataFrame, spec: S.FeatureSpec, wide: Sequence[str], classifier, key: str | None = None,
                      keep: Sequence[str] = ()) -> PipelineModel:
    """D14 with wide columns: :class:`churnlab.operators.prepare.ChurnPrepare` for the roles of
    ``spec``, the sparse one-hot for ``wide``, both assembled to ``features`` (sparse) for
    ``classifier``, any Spark ML estimator that takes label, weight and features.  ``train`` has ``label``."""
    data = M.balanced_weights(train, "label")
    prep = D.ChurnPrepare(specJson=D.spec_to_json(spec), keepCols=[*keep, *wide, "weight"]).fit(data)
    prepared = prep.transform(data)
    indexer = WideOneHot(wide).fit(prepared)
    encoder = indexer.encoder().fit(indexer.encoder_rows(train.sparkSession))
    assembler = VectorAssembler(inputCols=[*prep.feature_names, *[c + "_vec" for c in wide]], outputCol="features", handleInvalid="error")
    rows = encoder.transform(indexer.transform(prepared))
    key = key or spec.id_col
    rows = rows.repartition(key).sortWithinPartitions(key)
    fitted = Pipeline(stages=[assembler, classifier]).fit(rows)
    return PipelineModel(stages=[prep, indexer, encoder, *fitted.stages])
