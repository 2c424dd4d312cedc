"""Batch monitoring and drift (G1-G11), re-aimed from the batch generator.

The reference learns marginals, moments and a rule-based churn probability
from the original table and compares monthly batches with it.  Here the
learning steps are aggregates, the rule score is a deterministic column
expression, and the comparisons are joins of small per-batch reports.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.functions.columns import full, join_groups
from churnlab.functions.prefix import exact_quantiles, ordered_prefix
from churnlab.functions.ranking import group_row_number
from churnlab.operators.explore import histogram
from churnlab.operators.profile import attach_scalars
from churnlab.session import materialize


def marginals(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """G1: share of every category of every categorical column (one shuffle)."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                         for c in cols])))
    g = (long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
         .checkpoint(eager=True))
    # one row per listed column: broadcast, so no column's categories meet in one task
    tot = g.groupBy(F.col("column").alias("_c")).agg(F.sum("n").alias("_t"))
    j = g.join(F.broadcast(tot), g["column"] == tot["_c"])
    return j.select("column", "value", "n", full(F.col("n") / F.col("_t")).alias("share"))


def moment_drift(df: DataFrame, month_col: str, cols: Sequence[str], base_month: int = 0) -> DataFrame:
    """Per batch and numeric column the mean and sample standard deviation
    next to those of the original table (``base_month``), and how far the
    mean has moved in units of the original standard deviation."""
    long = df.select(F.col(month_col).cast("int").alias("month"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])))
    per = materialize(long.groupBy("month", "column").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std")), "moments")
    base = per.where(F.col("month") == base_month).select(
        F.col("column").alias("of"), F.col("mean").alias("base_mean"), F.col("std").alias("base_std"))
    j = per.where(F.col("month") != base_month).join(base, F.col("column") == F.col("of"), "left")
    shift = F.try_divide(F.col("mean") - F.col("base_mean"), F.when(F.col("base_std") > 0, F.col("base_std")))
    return j.select("month", "column", "n", full("mean").alias("mean"), full("std").alias("std"),
                    full("base_mean").alias("base_mean"), full("base_std").alias("base_std"), full(shift).alias("shift"))


def quantile_value(df: DataFrame, col: str, q: float) -> float | None:
    """Exact quantile of one column as a fit-time constant."""
    r = exact_quantiles(df.select(F.col(col).cast("double").alias("x")), "x", [q]).first()
    return None if r is None else r["q_0"]


def quantile_flag(df: DataFrame, col: str, reference: DataFrame, q: float = 0.75, name: str = "high_value") -> DataFrame:
    """1 when the value is above the reference table's q-quantile."""
    thr = exact_quantiles(reference.select(F.col(col).cast("double").alias("x")), "x", [q]).select(
        F.col("q_0").alias("_thr"))
    return attach_scalars(df, thr).withColumn(name, (F.col(col) > F.col("_thr")).cast("int")).drop("_thr")


@dataclass
class Scorecard:
    """Additive rule points, plus a per-month drift term, clipped."""

    rules: list  # (Column predicate, float points) in evaluation order
    month_col: str | None = None
    drift: float = S.MONTH_DRIFT
    clip: tuple = S.SCORE_CLIP

    def score(self) -> Column:
        terms = [F.when(pred, F.lit(float(pts))).otherwise(F.lit(0.0)) for pred, pts in self.rules]
        if self.month_col:
            terms.append(F.col(self.month_col) * F.lit(float(self.drift)))
        total = reduce(lambda a, b: a + b, terms)
        return F.least(F.greatest(total, F.lit(float(self.clip[0]))), F.lit(float(self.clip[1])))


def subs_scorecard(high_spend: float) -> Scorecard:
    """The reference's churn rules mapped onto the subscriber fixture.

    Fixed values: short tenure below 48 months +0.35, below 54 +0.15, long
    tenure above 64 -0.15; Low commitment (month-to-month) +0.25, High
    commitment (two-year) -0.20; spend above the 75th percentile +0.15; no
    urgent orders (no support) +0.10; no bulk orders (no security) +0.10; in
    debt (fibre) +0.10; +0.015 per batch month; clip to [0.05, 0.85].
    """
    c = F.col
    return Scorecard(rules=[
        (c("tenure") < 48, 0.35), (c("tenure") < 54, 0.15), (c("tenure") > 64, -0.15),
        (c("commitment") == "Low", 0.25), (c("commitment") == "High", -0.20),
        (c("monthly_spend") > F.lit(high_spend), 0.15),
        (c("urgent_user") == "No", 0.10), (c("bulk_buyer") == "No", 0.10), (c("in_debt") == "Yes", 0.10),
    ], month_col="batch_month")


def clip_round(c: str, lo: float, hi: float, decimals: int | None = 2, truncate_int: bool = False) -> Column:
    """Bound then round half-to-even (or truncate to int)."""
    x = F.least(F.greatest(F.col(c).cast("double"), F.lit(float(lo))), F.lit(float(hi)))
    if truncate_int:
        return x.cast("int")
    return F.bround(x, decimals)


def winsorized(df: DataFrame, cols: Sequence[str], lo: float = 0.05, hi: float = 0.95, decimals: int = 2) -> DataFrame:
    """G5 on data: every column bounded by its own exact ``lo`` and ``hi`` quantile, then rounded half to
    even.  All bounds come from one prefix pass; nulls stay null."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])))
    q = exact_quantiles(long, "x", [lo, hi], ["column"])
    bounds = q.agg(*[F.max(F.when(F.col("column") == c, F.col(f"q_{i}"))).alias(f"_b{j}_{i}")
                     for j, c in enumerate(cols) for i in (0, 1)])
    out = attach_scalars(df, bounds)
    clipped = {c: F.when(F.col(c).isNotNull(), F.bround(F.least(F.greatest(
        F.col(c).cast("double"), F.col(f"_b{j}_0")), F.col(f"_b{j}_1")), decimals)) for j, c in enumerate(cols)}
    return out.select(*[clipped[c].alias(c) if c in clipped else F.col(c) for c in df.columns])


def batch_position(df: DataFrame, month_col: str, id_col: str) -> DataFrame:
    """Every row's 1-based position in its batch in key order and the batch's size (distributed
    prefix, exact for batches of any size; rows without a month are one batch)."""
    pref = ordered_prefix(df.withColumn("_one", F.lit(1).cast("long")), [id_col], ["_one"], [month_col])
    sizes = materialize(df.groupBy(month_col).agg(F.count(F.lit(1)).alias("batch_size")), "batch-sizes")
    return join_groups(pref.select(*df.columns, (F.col("before__one") + 1).alias("position")), sizes, [month_col])


def batch_key(df: DataFrame, month_col: str, id_col: str, fmt: str = "NEW-M%02d-%04d",
              name: str = "batch_key") -> DataFrame:
    """Id '<month>-<i>' with i the 0-based position of the row inside its
    batch in key order (distributed prefix, exact for batches of any size)."""
    units = df.withColumn("_one", F.lit(1))
    pref = ordered_prefix(units, [id_col], ["_one"], [month_col])
    return pref.select(*df.columns, F.format_string(fmt, F.col(month_col).cast("int"),
                                                    F.col("before__one")).alias(name))


def batch_summary(df: DataFrame, month_col: str, label_col: str) -> DataFrame:
    """Per month rows, positive rate (%), and the landing file name."""
    return df.groupBy(month_col).agg(
        F.count(F.lit(1)).alias("n_customers"),
        full(F.avg(F.col(label_col).cast("double")) * 100.0).alias("churn_rate"),
    ).select(F.col(month_col).cast("int").alias("month"), "n_customers", "churn_rate",
             F.format_string("month_%02d.csv", F.col(month_col).cast("int")).alias("file"))


def rate_drift(df: DataFrame, month_col: str, label_col: str, reference: DataFrame) -> DataFrame:
    """Per month rate vs the reference rate, and last-minus-first month."""
    per = df.groupBy(F.col(month_col).cast("int").alias("month")).agg(
        (F.avg(F.col(label_col).cast("double")) * 100.0).alias("_rate"))
    base = reference.agg((F.avg(F.col(label_col).cast("double")) * 100.0).alias("_orig"))
    span = per.agg((F.max_by("_rate", "month") - F.min_by("_rate", "month")).alias("_span"))
    return attach_scalars(attach_scalars(per, base), span).select(
        "month", full("_rate").alias("churn_rate"), full("_orig").alias("original_rate"),
        full(F.col("_rate") - F.col("_orig")).alias("diff_vs_original"), full("_span").alias("drift_last_first"))


def numeric_drift(a: DataFrame, b: DataFrame, col: str, bins: int = S.FEATURE_BINS, names=("a", "b"),
                  density: bool = False, shared_edges: bool = False) -> DataFrame:
    """Histogram of ``col`` in two tables side by side (tagged union + E1)."""
    tagged = (a.select(F.lit(names[0]).alias("source"), F.col(col))
              .unionByName(b.select(F.lit(names[1]).alias("source"), F.col(col))))
    return histogram(tagged, col, by="source", bins=bins, density=density, shared_edges=shared_edges)


def category_drift(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Category shares in ``a`` vs ``b``; categories absent from ``b``
    get 0, rows keep ``a``'s frequency order."""
    def shares(df, tag):
        g = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("value"))
             .agg(F.count(F.lit(1)).alias(f"_n_{tag}")).checkpoint(eager=True))
        total = g.agg(F.sum(f"_n_{tag}")).scalar()
        return g.select("value", (F.col(f"_n_{tag}") * 100.0 / total).alias(f"_s_{tag}"), F.col(f"_n_{tag}"))
    sa, sb = shares(a, "a"), shares(b, "b")
    j = sa.join(sb.drop("_n_b"), on="value", how="left")
    ranked = group_row_number(j, [], [("_n_a", True), ("value", False)], "order_a")
    return ranked.select("value", full("_s_a").alias("share_a"),
                         full(F.coalesce(F.col("_s_b"), F.lit(0.0))).alias("share_b"), "order_a")


def union_batches(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack same-schema batches by column name."""
    return reduce(lambda x, y: x.unionByName(y), frames)
