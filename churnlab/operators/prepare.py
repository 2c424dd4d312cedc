"""Feature preparation.

Fit steps produce a handful of constants (category lists, means, standard
deviations, class sizes) from one small aggregation each; transform steps
are pure column projections, so a fitted :class:`PrepareModel` applies
unchanged to new batches and to streaming DataFrames.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.functions.columns import coerce_numeric, is_value, full
from churnlab.functions.ranking import group_row_number
from churnlab.operators.profile import attach_scalars
from churnlab.session import materialize


def drop_identifiers(df: DataFrame, spec: S.FeatureSpec) -> DataFrame:
    """The id stays as the row key but is not a feature."""
    keep = [spec.id_col, *spec.raw_features, spec.target]
    return df.select(*[c for c in keep if c in df.columns])


def fill_missing(df: DataFrame, cols: Sequence[str], value: float = 0.0, coerce: bool = True) -> DataFrame:
    """Structural nulls (e.g. no spend yet) become ``value``."""
    out = df
    for c in cols:
        x = coerce_numeric(c) if coerce else F.col(c)
        out = out.withColumn(c, F.coalesce(x, F.lit(value)))
    return out


def encode_target(spec: S.FeatureSpec) -> Column:
    """D3: 1 for the positive value, 0 otherwise (null counts as 0)."""
    return is_value(spec.target, spec.positive)


def encode_binary(c: str, positive: str, negative: str | None = None, handle_unknown: str = "zero") -> Column:
    """The positive value is 1, the negative 0.  Other values and nulls
    are 0 ('zero'), null ('null': a new batch keeps what it does not know
    apart) or, other than null, a runtime error ('error').  Without a
    declared negative value everything but the positive one counts as such."""
    if handle_unknown == "zero" or negative is None:
        return is_value(c, positive)
    out = F.when(F.col(c) == positive, F.lit(1)).when(F.col(c) == negative, F.lit(0))
    if handle_unknown == "error":
        bad = F.raise_error(F.concat(F.lit(f"unknown value in {c}: "), F.col(c).cast("string"))).cast("int")
        return out.when(F.col(c).isNotNull(), bad)
    return out


def binary_values(df: DataFrame, binary: dict) -> DataFrame:
    """D4 check before encoding: per column ``binary`` (column -> (positive,
    negative)) the rows, nulls and rows with any other value, in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[x for i, (c, (p, n)) in enumerate(binary.items()) for x in (
        F.count_if(F.col(c).isNull()).alias(f"z{i}"), F.count_if(~F.col(c).isin(p, n)).alias(f"o{i}"))])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("_n").alias("n_rows"), F.col(f"z{i}").alias("n_null"),
                 F.col(f"o{i}").alias("n_other")) for i, c in enumerate(binary)])))


def encode_ordinal(c: str, levels: Sequence[str], handle_unknown: str = "zero") -> Column:
    """Level -> rank 0..k-1.  Unknown/null: 0 ('zero'), null ('null') or
    a runtime error ('error')."""
    out = None
    for i, lv in enumerate(levels):
        out = F.when(F.col(c) == lv, F.lit(i)) if out is None else out.when(F.col(c) == lv, F.lit(i))
    if handle_unknown == "zero":
        return out.otherwise(F.lit(0))
    if handle_unknown == "error":
        return out.otherwise(F.raise_error(F.concat(F.lit(f"unknown level in {c}: "), F.col(c).cast("string"))))
    return out


def safe_name(s: str) -> str:
    return re.sub(r"[^0-9A-Za-z_]", "_", s)


def category_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D6 fit for columns of any width: (column, value, index), one row per
    non-null category; indices count on from 0 over all columns, in column
    and value order, and never pass through one task or the driver."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("_c"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for i, c in enumerate(cols)])))
    cats = long.where(F.col("value").isNotNull()).distinct()
    return group_row_number(cats, [], [("_c", False), ("value", False)], "_k").select(
        "column", "value", (F.col("_k") - 1).alias("index"))


def encode_sparse(df: DataFrame, cols: Sequence[str], table: DataFrame, key: str) -> DataFrame:
    """D6 transform for wide columns: (key, indices), the sorted indices of
    the indicators that are 1; null and unseen values have none.  Keyed join
    instead of one output column per category."""
    long = df.select(key, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])))
    hit = long.join(table, ["column", "value"], "left")
    return hit.groupBy(key).agg(F.sort_array(F.collect_list("index")).alias("indices"))


#: Indicator columns that a dense one-hot may have in all.
MAX_INDICATORS = 10_000


def fit_one_hot(df: DataFrame, cols: Sequence[str], limit: int = MAX_INDICATORS) -> dict:
    """D6 fit: sorted non-null categories of every nominal column in ONE pass
    (unpivot + distinct).  They become output columns, so they are read on
    the driver; with more than ``limit`` of them the fit fails and names the way
    for wide columns, :mod:`churnlab.operators.wide`."""
    if not cols:
        return {}
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                         for c in cols])))
    cats: dict[str, list] = {c: [] for c in cols}
    rows = long.where(F.col("value").isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} categories in {', '.join(cols)}: use WideOneHot for wide columns")
    for r in rows:
        cats[r["column"]].append(r["value"])
    for v in cats.values():
        v.sort()
    return cats


def one_hot_names(categories: dict, taken: Sequence[str] = ()) -> dict:
    """(column, value) -> indicator name: ``col_value`` with other characters
    than letters, digits and ``_`` as ``_``; where that name is taken (in any
    case), the first free one of ``name__2``, ``name__3``, ..."""
    used, names = {t.lower() for t in taken}, {}
    for c, vals in categories.items():
        for v in vals:
            plain = name = safe_name(f"{c}_{v}")
            n = 1
            while name.lower() in used:
                n += 1
                name = f"{plain}__{n}"
            used.add(name.lower())
            names[c, v] = name
    return names


def one_hot_columns(categories: dict, taken: Sequence[str] = ()) -> list[Column]:
    """D6 transform: 0/1 indicator per fitted category, null -> all zeros."""
    return [is_value(c, v).cast("double").alias(name) for (c, v), name in one_hot_names(categories, taken).items()]


def collapse_service(c: str, positive: str = "Yes") -> Column:
    """D7: 'No <service>' and 'No' both become 0, the positive value 1."""
    return is_value(c, positive)


def align_to_schema(df: DataFrame, feature_names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Model feature order; absent columns become 0, extra columns are dropped."""
    have = set(df.columns)
    return df.select(*keep, *[(F.col(f).cast("double") if f in have else F.lit(0.0)).alias(f)
                              for f in feature_names])


def unseen_categories(df: DataFrame, categories: dict) -> DataFrame:
    """D8 report: per nominal column, rows of a new batch whose (non-null)
    value was not seen at fit time -- they encode as all zeros, so they are
    counted instead of silently widening the feature list.  One pass."""
    cols = list(categories)
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[
        F.count_if(F.col(c).isNotNull() & ~F.col(c).cast("string").isin(*categories[c])).alias(f"u{i}")
        for i, c in enumerate(cols)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("_n").alias("n_rows"), F.col(f"u{i}").alias("n_unseen"))
        for i, c in enumerate(cols)])))


def largest_remainder(counts: DataFrame, n: int, n_draws: int) -> DataFrame:
    """(class, n, drawn): integer allocation of ``n_draws`` proportional to
    the class sizes (floor, then one extra for the largest remainders; ties
    by class order, null first).  ``counts`` has (class, n)."""
    share = F.col("n") / F.lit(float(n)) * F.lit(float(n_draws))
    base = counts.select("class", "n", F.floor(share).alias("base"), (share - F.floor(share)).alias("rest"))
    base = materialize(base, "split-shares")
    need = n_draws - (base.agg(F.sum("base")).first()[0] or 0)
    extra = base.orderBy(F.col("rest").desc(), F.col("class").asc_nulls_first()).limit(need).select(
        F.col("class").alias("more"), F.lit(1).alias("one"))
    return base.join(extra, F.col("class").eqNullSafe(F.col("more")), "left").select(
        "class", "n", (F.col("base") + F.coalesce("one", F.lit(0))).alias("drawn"))


def stratified_split(df: DataFrame, label_col: str, id_col: str, test_size: float = S.TEST_SIZE,
                     seed: int = S.SEED, split_col: str = "split") -> DataFrame:
    """Exact stratified split.  n_test = ceil(test_size * n); the train
    size of each class follows the largest-remainder allocation of the train
    total, the rest of the class is test.  Inside a class, rows are ordered
    by md5('<seed>|<id>') and the first ones go to test -- reproducible and
    independent of partitioning.  A null label is a class of its own; rows
    that share an id lie together on one side of the cut.

    md5 is uniform: its first four hex digits are 65,536 equal buckets in
    the order of the rows.  One aggregation counts the buckets of each class,
    which gives the bucket that holds the class's last test row; only that
    bucket is sorted.  The split itself compares each row with its class's
    cut: a projection, no shuffle of the rows."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))
    bucket = F.conv(F.substring(h, 1, 4), 16, 10).cast("int")
    cells = materialize(df.groupBy(F.col(label_col).alias("class"), bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")), "split-cells")
    counts = cells.groupBy("class").agg(F.sum("n").alias("n"))
    n = cells.agg(F.sum("n")).first()[0] or 0
    if not n:
        return df.withColumn(split_col, F.lit("train"))
    drawn = largest_remainder(counts, n, n - math.ceil(test_size * n)).select(
        F.col("class").alias("of"), (F.col("n") - F.col("drawn")).alias("n_test"))
    upto = Window.partitionBy("class").orderBy("bucket")  # at most 65,536 buckets a class
    cells = cells.withColumn("upto", F.sum("n").over(upto)).join(drawn, F.col("class").eqNullSafe(F.col("of")))
    edge = cells.where((F.col("upto") >= F.col("n_test")) & (F.col("upto") - F.col("n") < F.col("n_test"))).select(
        F.col("class").alias("of"), F.col("bucket").alias("at"),
        (F.col("n_test") - F.col("upto") + F.col("n")).alias("place"))
    edge = materialize(edge, "split-edges")
    near = df.select(F.col(label_col).alias("class"), F.col(id_col).alias("id"), h.alias("h"), bucket.alias("bucket"))
    near = near.join(edge, F.col("class").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at")))
    order = Window.partitionBy("class").orderBy("h", "id")  # one bucket a class
    cuts = near.withColumn("k", F.row_number().over(order)).where("k = place").select(
        F.col("class").alias("_class"), F.struct("h", "id").alias("_cut"))
    cuts = materialize(cuts, "split-cuts")
    row = F.struct(h.alias("h"), F.col(id_col).alias("id"))
    test = F.coalesce(row <= F.col("_cut"), F.lit(False))
    return df.join(cuts, F.col(label_col).eqNullSafe(F.col("_class")), "left").select(
        *df.columns, F.when(test, "test").otherwise("train").alias(split_col))


def split_report(df: DataFrame, label_col: str, split_col: str = "split") -> DataFrame:
    """Size and positive rate (%) per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"), F.sum(label_col).cast("long").alias("n_positive"),
                                     full(F.avg(F.col(label_col).cast("double")) * 100.0).alias("positive_pct"))


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> dict:
    """D11 fit: mean and population std per column from one aggregation
    (collected: two numbers per column).  std 0 -> divisor 1."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        s = row[f"s{i}"]
        out[c] = (row[f"m{i}"], 1.0 if (s is None or s == 0.0) else s)
    return out


def scale_columns(stats: dict) -> dict:
    """D11 transform: column expressions ``(x - mean) / std``."""
    return {c: ((F.col(c).cast("double") - F.lit(m)) / F.lit(s)) for c, (m, s) in stats.items()}


def scaling_report(before: DataFrame, after: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and sample std before and after scaling, per column."""
    b = before.agg(*[F.avg(c).alias(f"mb{i}") for i, c in enumerate(cols)],
                   *[F.stddev_samp(c).alias(f"sb{i}") for i, c in enumerate(cols)])
    a = after.agg(*[F.avg(c).alias(f"ma{i}") for i, c in enumerate(cols)],
                  *[F.stddev_samp(c).alias(f"sa{i}") for i, c in enumerate(cols)])
    one = attach_scalars(b, a)  # two one-row aggregates
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), full(F.col(f"mb{i}")).alias("mean_before"), full(F.col(f"sb{i}")).alias("std_before"),
        full(F.col(f"ma{i}")).alias("mean_after"), full(F.col(f"sa{i}")).alias("std_after"))
        for i, c in enumerate(cols)])))


@dataclass
class PrepareModel:
    """Fitted preparation.  ``encode`` = D1-D8, ``transform`` adds D11."""

    spec: S.FeatureSpec
    categories: dict
    feature_names: list
    scale_stats: dict = field(default_factory=dict)
    #: what binary values other than the declared two become (see :func:`encode_binary`)
    handle_unknown: str = "zero"

    def encoded_columns(self, df: DataFrame) -> list[Column]:
        sp = self.spec
        cols = []
        for c in sp.single_features:
            if c in sp.numeric:
                x = coerce_numeric(c) if c in sp.numeric_text else F.col(c).cast("double")
                if c in sp.fill_zero:
                    x = F.coalesce(x, F.lit(0.0))
                cols.append(x.cast("double").alias(c))
            elif c in sp.flags:
                cols.append(F.col(c).cast("double").alias(c))
            elif c in sp.binary:
                cols.append(self._binary(c).cast("double").alias(c))
            elif c in sp.ordinal:
                cols.append(encode_ordinal(c, sp.ordinal[c]).cast("double").alias(c))
            elif c in sp.tristate:
                cols.append(collapse_service(c, sp.tristate[c]).cast("double").alias(c))
        return cols + one_hot_columns(self.categories, self._taken())

    def _binary(self, c: str) -> Column:
        positive, negative = self.spec.binary[c], self.spec.binary_negative.get(c)
        if self.handle_unknown != "zero" and negative is None:
            raise ValueError(f"binary column {c} has no declared negative value")
        return encode_binary(c, positive, negative, self.handle_unknown)

    def _taken(self) -> list[str]:
        """Names the indicators must not take."""
        return [self.spec.id_col, "label", *self.spec.single_features]

    def encode(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        sp = self.spec
        extra = [F.col(k) for k in keep if k in df.columns]
        label = [encode_target(sp).alias("label")] if sp.target in df.columns else []
        enc = df.select(F.col(sp.id_col), *label, *extra, *self.encoded_columns(df))
        return align_to_schema(enc, self.feature_names, [sp.id_col, *(["label"] if label else []),
                                                         *[k for k in keep if k in df.columns]])

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        enc = self.encode(df, keep)
        exprs = scale_columns(self.scale_stats)
        return enc.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in enc.columns])

    def to_json(self) -> str:
        return json.dumps({"categories": self.categories, "feature_names": self.feature_names,
                           "scale_stats": {k: list(v) for k, v in self.scale_stats.items()},
                           "handle_unknown": self.handle_unknown})

    def save(self, spark: SparkSession, path: str) -> str:
        """A5: stored as one JSON text file through Spark, so any shared FS works."""
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str, spec: S.FeatureSpec) -> "PrepareModel":
        return cls.from_json(spec, spark.read.text(path).first()[0])

    @classmethod
    def from_json(cls, spec: S.FeatureSpec, text: str) -> "PrepareModel":
        d = json.loads(text)
        return cls(spec, d["categories"], d["feature_names"], {k: tuple(v) for k, v in d["scale_stats"].items()},
                   d.get("handle_unknown", "zero"))


def fit_prepare(df: DataFrame, spec: S.FeatureSpec, scale: Sequence[str] | None = None,
                scale_all: bool = False, handle_unknown: str = "zero") -> PrepareModel:
    """D14 fit on the (training) rows: categories, feature list, scaler.
    ``handle_unknown`` is kept by the model for its binary columns (D4)."""
    cats = fit_one_hot(df, spec.nominal)
    model = PrepareModel(spec, cats, [], handle_unknown=handle_unknown)
    model.feature_names = names = [*spec.single_features, *one_hot_names(cats, model._taken()).values()]
    cols = names if scale_all else list(scale if scale is not None else spec.numeric)
    if cols:
        model.scale_stats = fit_scaler(model.encode(df), cols)
    return model


# ---------------------------------------------------------------- Spark ML stage
def spec_to_json(spec: S.FeatureSpec) -> str:
    from dataclasses import asdict
    return json.dumps(asdict(spec))


def spec_from_json(text: str) -> S.FeatureSpec:
    d = json.loads(text)
    tuples = ("numeric", "numeric_text", "fill_zero", "flags", "nominal", "column_order")
    kw = {k: (tuple(v) if k in tuples else v) for k, v in d.items()}
    kw["ordinal"] = {k: tuple(v) for k, v in kw.get("ordinal", {}).items()}
    return S.FeatureSpec(**kw)


from pyspark.ml import Estimator, Model  # noqa: E402
from pyspark.ml.param import Param, Params, TypeConverters  # noqa: E402
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable  # noqa: E402


class _PrepareParams(Params):
    specJson = Param(Params._dummy(), "specJson", "column roles (FeatureSpec as JSON)",
                     typeConverter=TypeConverters.toString)
    scaleAll = Param(Params._dummy(), "scaleAll", "standardise every feature, not only numeric ones",
                     typeConverter=TypeConverters.toBoolean)
    keepCols = Param(Params._dummy(), "keepCols", "extra input columns passed through",
                     typeConverter=TypeConverters.toListString)
    handleUnknown = Param(Params._dummy(), "handleUnknown", "what other values of binary columns become: zero, null or error",
                          typeConverter=TypeConverters.toString)


class ChurnPrepare(Estimator, _PrepareParams, DefaultParamsReadable, DefaultParamsWritable):
    """D14 as a Spark ML Estimator: fit = :func:`fit_prepare` on the rows it
    is given (the training split), producing a :class:`ChurnPrepareModel`."""

    def __init__(self, specJson: str | None = None, scaleAll: bool = False, keepCols: list | None = None,
                 handleUnknown: str = "zero"):
        super().__init__()
        self._setDefault(scaleAll=False, keepCols=[], handleUnknown="zero")
        if specJson is not None:
            self._set(specJson=specJson)
        self._set(scaleAll=scaleAll, keepCols=list(keepCols or []), handleUnknown=handleUnknown)

    def _fit(self, dataset: DataFrame) -> "ChurnPrepareModel":
        spec = spec_from_json(self.getOrDefault(self.specJson))
        fitted = fit_prepare(dataset, spec, scale_all=self.getOrDefault(self.scaleAll),
                             handle_unknown=self.getOrDefault(self.handleUnknown))
        return ChurnPrepareModel(specJson=self.getOrDefault(self.specJson), modelJson=fitted.to_json(),
                                 keepCols=self.getOrDefault(self.keepCols))


class ChurnPrepareModel(Model, _PrepareParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted D14 stage: encodes, aligns and scales with the frozen constants.
    A pure projection, so it also runs on streaming DataFrames."""

    modelJson = Param(Params._dummy(), "modelJson", "fitted constants (categories, features, scaler)",
                      typeConverter=TypeConverters.toString)

    def __init__(self, specJson: str | None = None, modelJson: str | None = None, keepCols: list | None = None):
        super().__init__()
        self._setDefault(scaleAll=False, keepCols=[])
        if specJson is not None:
            self._set(specJson=specJson)
        if modelJson is not None:
            self._set(modelJson=modelJson)
        self._set(keepCols=list(keepCols or []))

    def prepare_model(self) -> PrepareModel:
        spec = spec_from_json(self.getOrDefault(self.specJson))
        return PrepareModel.from_json(spec, self.getOrDefault(self.modelJson))

    @property
    def feature_names(self) -> list:
        return list(json.loads(self.getOrDefault(self.modelJson))["feature_names"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.prepare_model().transform(dataset, keep=self.getOrDefault(self.keepCols))
