"""Profiling (B1-B6) and data quality.

Every report is one aggregation pass that computes all columns at once and
is unpivoted afterwards -- never one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.functions.columns import coerce_numeric, full
from churnlab.functions.prefix import exact_quantiles
from churnlab.functions.ranking import group_row_number


def _rows(*structs):
    return F.inline(F.array(*structs))


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a global aggregate to every row.

    The aggregate becomes ONE scalar subquery (a struct): Spark runs it once,
    inlines the value into the projection and raises an error if it ever
    returns more than one row -- no join, and a size bound Spark enforces."""
    packed = one_row.select(F.struct(*one_row.columns).alias("_s")).scalar()
    return df.select("*", *[packed[c].alias(c) for c in one_row.columns])


def table_shape(df: DataFrame, spec: S.FeatureSpec) -> DataFrame:
    """B1: rows, columns and the number of numeric / categorical / target columns."""
    n_num = len([c for c in df.columns if spec.role(c) in ("numeric", "flag")])
    n_cat = len([c for c in df.columns if spec.role(c) in ("binary", "ordinal", "nominal", "tristate")])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"), F.lit(n_num).alias("n_numeric"),
        F.lit(n_cat).alias("n_categorical"), F.lit(1 if spec.target in df.columns else 0).alias("n_target"))


def _as_key(c: str) -> Column:
    """A value as text that tells distinct values apart; long ones by their digest."""
    text = F.col(c).cast("string")
    return F.when(F.length(text) > 64, F.concat(F.lit("#"), F.sha2(text, 256))).otherwise(F.concat(F.lit("="), text))


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(position, non_null, n_distinct) per column, exact, on two levels.

    Values are unpivoted and counted per (column, value), which collapses
    repeats before the shuffle and spreads a column over all tasks; the counts
    are then counted per column.  No row is expanded once per column in one aggregate.
    """
    long = df.select(_rows(*[F.struct(F.lit(i).alias("position"), _as_key(c).alias("value")) for i, c in enumerate(cols)]))
    per_value = long.where(F.col("value").isNotNull()).groupBy("position", "value").agg(F.count(F.lit(1)).alias("n"))
    found = per_value.groupBy(F.col("position").alias("p")).agg(F.sum("n").alias("nn"), F.count(F.lit(1)).alias("nd"))
    every = df.sparkSession.range(len(cols)).select(F.col("id").cast("int").alias("position"))
    return every.join(found, F.col("position") == F.col("p"), "left").select(
        "position", F.coalesce("nn", F.lit(0)).alias("non_null"), F.coalesce("nd", F.lit(0)).alias("n_distinct"))


def distinct_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), log2k: int = 14) -> DataFrame:
    """(by..., column, non_null, sketch): HyperLogLog sketches that can be kept per batch
    and merged later; 2**log2k registers, standard error about 1.04 / sqrt(2**log2k)."""
    long = df.select(*by, _rows(*[F.struct(F.lit(c).alias("column"), _as_key(c).alias("value")) for c in cols]))
    return long.groupBy(*by, "column").agg(F.count("value").alias("non_null"), F.hll_sketch_agg("value", log2k).alias("sketch"))


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """(column, non_null, n_distinct) from the sketches of any number of batches."""
    return sketches.groupBy("column").agg(F.sum("non_null").alias("non_null"),
                                          F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def column_report(df: DataFrame, spec: S.FeatureSpec, exact: bool = True) -> DataFrame:
    """B2: per column its type, role, non-null count and distinct count (exact
    by :func:`distinct_counts`, else estimated by one sketch per column)."""
    facts = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                               F.lit(spec.role(c)).alias("role")) for c in df.columns])
    if exact:
        counts = distinct_counts(df, df.columns)
    else:
        at = F.create_map(*[x for i, c in enumerate(df.columns) for x in (F.lit(c), F.lit(i))])
        counts = merged_distinct(distinct_sketches(df, df.columns)).withColumn("position", at[F.col("column")])
    return counts.select("position", F.get(facts, F.col("position")).alias("f"), "non_null", "n_distinct").select(
        "position", "f.column", "f.dtype", "f.role", "non_null", "n_distinct")


def preview(df: DataFrame, spec: S.FeatureSpec, n: int = 5) -> DataFrame:
    """First n rows in key order (file order is not defined in Spark)."""
    return df.orderBy(spec.id_col).limit(n)


def describe_numeric(df: DataFrame, cols: Sequence[str], decimals: int = 6, exact: bool = True,
                     accuracy: int = 10000) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per numeric column.

    Quartiles are exact (linear interpolation, distributed prefix) by
    default; ``exact=False`` takes them from ``percentile_approx`` in the
    same single aggregation (relative rank error 1/accuracy)."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])))
    stats = [F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
             F.min("x").alias("min"), F.max("x").alias("max")]
    if not exact:
        qs = F.percentile_approx("x", [0.25, 0.5, 0.75], accuracy)
        out = long.groupBy("column").agg(*stats, qs.alias("_q")).select(
            "*", *[F.col("_q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))])
    else:
        basic = long.groupBy("column").agg(*stats)
        q = exact_quantiles(long, "x", [0.25, 0.5, 0.75], ["column"])
        out = basic.join(q.select("column", F.col("q_0").alias("p25"), F.col("q_1").alias("p50"),
                                  F.col("q_2").alias("p75")), "column", "left")
    rnd = (lambda c: F.round(F.col(c), decimals) + F.lit(0.0))
    return out.select("column", "count", *[rnd(c).alias(c) for c in
                                           ("mean", "std", "min", "p25", "p50", "p75", "max")])


def quantile_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: int = 4000) -> DataFrame:
    """(by..., column, count, sketch): KLL sketches of numeric columns that can be
    kept per batch and merged later.  Larger ``k`` means a smaller rank error, see
    :func:`rank_error`.  Nulls and NaN are left out; a column without values has no row."""
    long = df.select(*by, _rows(*[F.struct(F.lit(c).alias("column"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("x"))
                                  for c in cols]))
    return long.where(F.col("x").isNotNull()).groupBy(*by, "column").agg(
        F.count("x").alias("count"), F.kll_sketch_agg_double("x", k).alias("sketch"))


def rank_error(k: int = 4000) -> float:
    """A bound on the rank error of a merged KLL sketch, as a share of all rows, that one quantile
    exceeds about once in a hundred: 2.296 / k^0.9021 (the sketch library's fitted constant)."""
    return 2.296 / k ** 0.9021


def merged_quantiles(sketches: DataFrame, probs: Sequence[float], k: int = 4000) -> DataFrame:
    """(column, count, q, value) from the sketches of any number of batches."""
    merged = sketches.groupBy("column").agg(F.sum("count").alias("count"), F.kll_merge_agg_double("sketch", k).alias("sketch"))
    return merged.select("column", "count", _rows(*[F.struct(
        F.lit(float(p)).alias("q"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probs]))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency of each non-null value, its share of non-null rows and its
    position in frequency order (ties by value)."""
    g = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    ranked = group_row_number(g, [], [("n", True), ("value", False)], "freq_rank")
    total = ranked.agg(F.sum("n")).scalar()
    return ranked.select("value", "n", full(F.col("n") / total).alias("share"), "freq_rank")


def imbalance_check(df: DataFrame, spec: S.FeatureSpec, threshold: float = S.IMBALANCE_THRESHOLD) -> DataFrame:
    """Positive share in percent and whether it is below the threshold."""
    pos = F.col(spec.target).eqNullSafe(spec.positive)
    one = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(pos).alias("n_positive"))
    pct = F.col("n_positive") * F.lit(100.0) / F.col("n")
    return one.select("n", "n_positive", full(pct).alias("positive_pct"), (pct < threshold).alias("imbalanced"))


def null_report(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Null count and percentage per column (one pass)."""
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"z{i}") for i, c in enumerate(df.columns)])
    out = one.select(_rows(*[
        F.struct(F.lit(c).alias("column"), F.col(f"z{i}").alias("n_null"),
                 full(F.col(f"z{i}") * F.lit(100.0) / F.col("_n")).alias("pct_null"))
        for i, c in enumerate(df.columns)]))
    return out.where(F.col("n_null") > 0) if only_missing else out


def missing_pattern(df: DataFrame, col: str, by: str) -> DataFrame:
    """How many rows miss ``col`` and the mean of ``by`` on those rows."""
    miss = F.col(col).isNull()
    return df.agg(F.count_if(miss).alias("n_missing"),
                  full(F.avg(F.when(miss, F.col(by).cast("double")))).alias(f"mean_{by}_when_missing"))


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None, digest: bool = True) -> DataFrame:
    """Rows that repeat an earlier row (nulls compare equal).

    With ``digest`` the grouping key is the SHA-256 of the whole row, so the
    shuffle carries 32 bytes per distinct row instead of the full text; a
    row held by a third of the table collapses in the map-side partial
    aggregation.
    """
    cols = list(cols or df.columns)
    if digest:
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols]
        lens = [F.coalesce(F.length(F.col(c).cast("string")), F.lit(-1)).cast("string") for c in cols]
        key = [F.unhex(F.sha2(F.concat_ws("\u0001", *lens, *parts), 256)).alias("_k")]
    else:
        key = [F.col(c) for c in cols]
    g = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n_duplicates"),
                 F.count(F.lit(1)).alias("n_distinct_rows"))


def encoding_gate(df: DataFrame, cols: Sequence[str], only_failing: bool = True) -> DataFrame:
    """C4: after encoding, rows per column that are null or not numeric (by
    the rule of A2: '1d', 'NaN' and 'inf' are not numbers)."""
    one = df.agg(*[F.count_if(coerce_numeric(c).isNull()).alias(f"b{i}")
                   for i, c in enumerate(cols)])
    out = one.select(_rows(*[F.struct(F.lit(c).alias("column"), F.col(f"b{i}").alias("n_bad"))
                             for i, c in enumerate(cols)]))
    return out.where(F.col("n_bad") > 0) if only_failing else out
