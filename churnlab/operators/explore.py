"""Distributions and segment analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.functions.columns import bands, cut, full, join_groups
from churnlab.functions.prefix import exact_quantiles
from churnlab.functions.ranking import group_row_number
from churnlab.operators.profile import attach_scalars
from churnlab.session import materialize


_ALL = "\u0000all"  # sentinel group name; cannot collide with a column name


def _is_pos(spec: S.FeatureSpec):
    return F.col(spec.target).eqNullSafe(spec.positive).cast("int")


def histogram(df: DataFrame, col: str, by: str | None = None, bins: int = S.FEATURE_BINS,
              density: bool = True, shared_edges: bool = False) -> DataFrame:
    """Equal-width histogram per group on the group's own [min, max]
    (or one shared range), last bin right-closed, every bin emitted.

    Bin of x = min(floor((x - lo) / (hi - lo) * bins), bins - 1).  A group
    with a single distinct value uses [x - 0.5, x + 0.5].  Density is
    n / (N * width).  A null group is a group; null values are left out.  Pass 1 aggregates the ranges (one row per group), pass 2
    bins with plain arithmetic and aggregates per (group, bin).
    """
    g = [by] if by else []
    x = F.col(col).cast("double")
    data = df.select(*[F.col(c) for c in g], x.alias("_x")).where(F.col("_x").isNotNull())
    rng = data.groupBy(*g).agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"),
                               F.count(F.lit(1)).alias("_N"))
    if shared_edges and g:
        whole = data.agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
        rng = attach_scalars(rng.select(*g, "_N"), whole).select(*g, "_mn", "_mx", "_N")
    same = F.col("_mn") == F.col("_mx")
    rng = rng.select(*g, "_N",
                     F.when(same, F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
                     F.when(same, F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"))
    # one row per group: Spark broadcasts the group table when it is small and
    # splits skewed groups when it is not
    rng = materialize(rng, "histogram-ranges")
    binned = join_groups(data, rng, g) if g else attach_scalars(data, rng)
    b = F.least(F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins),
                F.lit(bins - 1)).cast("int")
    counts = binned.groupBy(*g, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select(*g, "_N", "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = join_groups(grid, counts, g, ["bin"], "left").fillna(0, subset=["n"])
    width = (F.col("_hi") - F.col("_lo")) / bins
    cols = [*g, "bin", full(F.col("_lo") + F.col("bin") * width).alias("bin_lo"),
            full(F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_hi"), F.col("n").cast("long").alias("n")]
    if density:
        cols.append(full(F.col("n") / (F.col("_N") * width)).alias("density"))
    return out.select(*cols)


def box_stats(df: DataFrame, col: str, by: str) -> DataFrame:
    """Quartiles, whiskers (most extreme value within 1.5 IQR) and outlier count per group."""
    long = df.select(F.col(by), F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    q = exact_quantiles(long, "x", [0.25, 0.5, 0.75], [by]).select(
        by, F.col("q_0").alias("q1"), F.col("q_1").alias("median"), F.col("q_2").alias("q3"))
    q = q.select("*", (F.col("q3") - F.col("q1")).alias("iqr"))
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    # one row per group: broadcast when small, skewed groups split when not
    j = join_groups(long, materialize(q, "box-quartiles"), [by])
    return j.groupBy(by).agg(
        *[full(F.first(c)).alias(c) for c in ("q1", "median", "q3", "iqr")],
        full(F.min(F.when(F.col("x") >= lo_f, F.col("x")))).alias("whisker_low"),
        full(F.max(F.when(F.col("x") <= hi_f, F.col("x")))).alias("whisker_high"),
        F.count_if((F.col("x") < lo_f) | (F.col("x") > hi_f)).alias("n_outliers"))


def class_mean_contrast(df: DataFrame, spec: S.FeatureSpec, cols: Sequence[str]) -> DataFrame:
    """Mean per class, % difference of positives vs negatives, direction."""
    pos = _is_pos(spec)
    long = df.select(pos.alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])))
    g = long.groupBy("column").agg(F.avg(F.when(F.col("_y") == 0, F.col("x"))).alias("mean_neg"),
                                   F.avg(F.when(F.col("_y") == 1, F.col("x"))).alias("mean_pos"))
    diff = F.try_divide(F.col("mean_pos") - F.col("mean_neg"), F.col("mean_neg")) * 100.0
    return g.select("column", full("mean_neg").alias("mean_neg"), full("mean_pos").alias("mean_pos"),
                    full(diff).alias("diff_pct"),
                    F.when(diff > 0, "higher").when(diff < 0, "lower").otherwise("equal").alias("direction"))


def target_rate_by(df: DataFrame, spec: S.FeatureSpec, features: Sequence[str],
                   band: tuple[float, float] = S.RATE_BANDS) -> DataFrame:
    """Per feature and category: rows, positive rate (%), overall rate,
    band, and position in ascending-rate order.  One unpivot, one shuffle
    whose size is the number of categories; null categories are dropped."""
    pos = _is_pos(spec)
    # the overall rate rides along as one more (sentinel) group of the same
    # aggregation, so the input is scanned once
    long = df.select(pos.alias("_y"), F.inline(F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in features],
        F.struct(F.lit(_ALL).alias("feature"), F.lit(_ALL).alias("value")))))
    g = (long.where(F.col("value").isNotNull()).groupBy("feature", "value")
         .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("_pos")))
    g = g.select("*", (F.col("_pos") * F.lit(100.0) / F.col("n")).alias("_rate"))
    # position in ascending-rate order per feature: exact for any number of categories
    ranked = group_row_number(g, ["feature"], [("_rate", False), ("value", False)], "rate_order")
    overall = ranked.where(F.col("feature") == _ALL).select("_rate").scalar()
    rate = F.col("_rate")
    out = ranked.where(F.col("feature") != _ALL)
    return out.select("feature", "value", "n", full(rate).alias("churn_rate"), full(overall).alias("overall_rate"),
                      bands(rate, *band).alias("band"), "rate_order")


def category_spread(rates: DataFrame, min_spread: float = S.MIN_SPREAD) -> DataFrame:
    """E5: highest and lowest category per feature (ties: smallest value),
    kept when the spread exceeds ``min_spread`` points."""
    g = rates.groupBy("feature").agg(
        F.min_by("value", F.struct(-F.col("churn_rate"), F.col("value"))).alias("max_value"),
        F.max("churn_rate").alias("max_rate"),
        F.min_by("value", F.struct(F.col("churn_rate"), F.col("value"))).alias("min_value"),
        F.min("churn_rate").alias("min_rate"))
    spread = F.col("max_rate") - F.col("min_rate")
    return g.select("*", full(spread).alias("spread")).where(spread > min_spread)


def dict_encode(c: str, mapping: dict):
    """Value -> code via a literal mapping; unmapped values give null."""
    out = None
    for k, v in mapping.items():
        out = F.when(F.col(c) == k, F.lit(v)) if out is None else out.when(F.col(c) == k, F.lit(v))
    return out


def _pair_correlation(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson r of the listed column pairs in one scan: every row is unpivoted
    into its pairs, which collapse to a row per pair before the shuffle.
    Pairwise-complete; null when a column is constant on the complete pairs."""
    def pair(k, a, b):
        xa, xb = F.col(a).cast("double"), F.col(b).cast("double")
        both = xa.isNotNull() & xb.isNotNull()
        return F.struct(F.lit(k).alias("k"), F.when(both, xa).alias("x"), F.when(both, xb).alias("y"))

    long = df.select(F.inline(F.array(*[pair(k, a, b) for k, (a, b) in enumerate(pairs)])))
    r = long.groupBy("k").agg(full(F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))).alias("r"))
    names = df.sparkSession.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    return names.join(r, "k", "left").select("a", "b", "r")


def correlation_matrix(df: DataFrame, cols: Sequence[str], lower_only: bool = True) -> DataFrame:
    """Pearson r for every pair of columns."""
    out = _pair_correlation(df, [(a, b) for i, a in enumerate(cols) for b in cols[:i]])
    if lower_only:
        return out
    return out.unionByName(out.select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))


def target_correlation(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """R of every feature with the target, by |r| descending.  Only these pairs are computed."""
    t = _pair_correlation(df, [(f, target) for f in features]).select(F.col("a").alias("feature"), "r")
    w = Window.orderBy(F.abs(F.col("r")).desc_nulls_last(), F.col("feature"))  # one row per feature
    return t.select("feature", "r", F.when(F.col("r") > 0, "+").when(F.col("r") < 0, "-").otherwise("0").alias("sign"),
                    F.row_number().over(w).alias("abs_rank"))


def segment_rate(df: DataFrame, spec: S.FeatureSpec, col: str, edges, labels,
                 band: tuple[float, float] = S.SEGMENT_BANDS, alert: float = S.SEGMENT_ALERT,
                 include_lowest: bool = False) -> DataFrame:
    """Positive rate per right-closed segment in bin order, colour band and alert."""
    seg = cut(col, edges, as_ordinal=True, include_lowest=include_lowest)
    lab = cut(col, edges, labels, include_lowest=include_lowest)
    g = (df.select(seg.alias("segment_order"), lab.alias("segment"), _is_pos(spec).alias("_y"))
         .where(F.col("segment_order").isNotNull())
         .groupBy("segment_order", "segment").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("_pos")))
    rate = F.col("_pos") * F.lit(100.0) / F.col("n")
    return g.select("segment_order", "segment", "n", full(rate).alias("churn_rate"),
                    bands(rate, *band).alias("band"), (rate > alert).alias("alert"))
