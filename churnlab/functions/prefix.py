"""Exact ordered prefix sums without a single-task sort.

Exact AUC, ROC/PR curves, exact quantiles, the exact stratified split and
batch row numbers all need "how much weight lies strictly before this row in
sort order".  A window with no (or a low-cardinality) partition would put the
whole table in one task.  Instead:

1. range-partition the units on (group, order) -- Spark samples the keys, so
   the buckets hold about the same number of units even when values crowd
   into a narrow range; identical values are collapsed by the caller first;
2. freeze the bucket id (``spark_partition_id``) with a reliable checkpoint
   so every later use sees the same assignment (also after executor loss);
3. sum each bucket (a table of about ``P`` rows), turn those sums into
   offsets with a small window, and add a window sum computed inside each
   bucket.

The only single-partition step runs over the bucket table, whose size is the
number of range partitions, not the data size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.functions.columns import join_groups
from churnlab.session import ensure_checkpoint_dir


def ordered_prefix(units: DataFrame, order_cols: Sequence[str], sum_cols: Sequence[str],
                   group_cols: Sequence[str] = (), num_buckets: int | None = None,
                   prefix: str = "before_", keep_bucket: bool = False,
                   bucket: Column | None = None) -> DataFrame:
    """Add ``before_<c>``: sum of ``c`` over earlier rows of the same group.

    Rows must be unique in (group, order) for a strict order; ties in the
    order columns are broken arbitrarily but consistently; a null group is a
    group like any other.  ``keep_bucket``
    also returns the bucket ``_bucket`` of every row.

    ``bucket`` may give the bucket as a deterministic expression that is
    non-decreasing in the order columns (e.g. the leading hex digits of a
    hash the rows are ordered by).  Then no range sampling and no checkpoint
    are needed: the bucket is a pure function of the row.
    """
    spark = units.sparkSession
    group_cols, order_cols, sum_cols = list(group_cols), list(order_cols), list(sum_cols)
    if bucket is not None:
        bucketed = units.withColumn("_bucket", bucket)
    else:
        ensure_checkpoint_dir(spark)
        n_buckets = num_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        keys = [F.col(k).asc_nulls_first() for k in group_cols + order_cols]
        bucketed = (units.repartitionByRange(n_buckets, *keys)
                    .withColumn("_bucket", F.spark_partition_id())
                    .checkpoint(eager=True))
    totals = bucketed.groupBy(*group_cols, "_bucket").agg(*[F.sum(c).alias(c) for c in sum_cols])
    w_small = (Window.partitionBy(*group_cols).orderBy("_bucket")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*group_cols, "_bucket",
                            *[F.coalesce(F.sum(c).over(w_small), F.lit(0)).alias(f"_off_{c}")
                              for c in sum_cols])
    w_in = (Window.partitionBy(*group_cols, "_bucket").orderBy(*order_cols)
            .rowsBetween(Window.unboundedPreceding, -1))
    joined = join_groups(bucketed, offsets, group_cols, ["_bucket"])
    return joined.select(
        *units.columns, *(["_bucket"] if keep_bucket else []),
        *[(F.col(f"_off_{c}") + F.coalesce(F.sum(c).over(w_in), F.lit(0))).alias(prefix + c)
          for c in sum_cols])


def exact_quantiles(long: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), weight_col: str | None = None) -> DataFrame:
    """Linear-interpolation quantiles (numpy 'linear', SQL percentile_cont).

    ``long`` holds one value per row (or, with ``weight_col``, a value and
    its integer multiplicity); nulls are ignored.  Returns one row per group
    with columns ``q_<i>`` for each requested probability and ``n``.
    Identical values are collapsed first, so a value held by a third of all
    rows is one unit; the rest is :func:`ordered_prefix`.
    """
    group_cols = list(group_cols)
    w = F.sum(F.col(weight_col)).cast("long") if weight_col else F.count(F.lit(1))
    units = (long.where(F.col(value_col).isNotNull())
             .groupBy(*group_cols, value_col).agg(w.alias("_c")))
    pref = ordered_prefix(units, [value_col], ["_c"], group_cols, keep_bucket=True)
    # first position and size of every (group, bucket): about groups x P rows
    spans = pref.groupBy(*group_cols, "_bucket").agg(F.min("before__c").alias("_start"),
                                                      F.sum("_c").alias("_cnt"))
    sizes = spans.groupBy(*group_cols).agg(F.sum("_cnt").alias("n"))
    # one row per (group, probability): the probabilities are a short fixed list
    p_arr = F.array(*[F.struct(F.lit(i).alias("_qi"), F.lit(float(p)).alias("_p"))
                      for i, p in enumerate(probs)])
    targets = sizes.select(*group_cols, "n", F.inline(p_arr))
    pos = F.col("_p") * (F.col("n") - 1)
    targets = targets.select(*group_cols, "n", "_qi",
                             F.floor(pos).cast("long").alias("_lo"),
                             F.ceil(pos).cast("long").alias("_hi"),
                             (pos - F.floor(pos)).alias("_frac"))
    # rename the small sides so joins never resolve columns across a shared lineage
    t_names = {g: f"_t{i}" for i, g in enumerate(group_cols)}
    s_names = {g: f"_s{i}" for i, g in enumerate(group_cols)}
    targets = targets.select(*[F.col(g).alias(t_names[g]) for g in group_cols],
                             "n", "_qi", "_lo", "_hi", "_frac")
    spans = spans.select(*[F.col(g).alias(s_names[g]) for g in group_cols], F.col("_bucket").alias("_sb"),
                         "_start", "_cnt")

    def all_of(conds):
        out = F.lit(True)
        for c in conds:
            out = out & c
        return out

    picks = []
    for side in ("_lo", "_hi"):
        # locate the bucket holding each target position (small x small), then
        # join the units on (group, bucket): equi-keys with about P distinct
        # values per group, so no task receives a whole group
        loc = targets.join(spans, all_of(
            [F.col(t_names[g]).eqNullSafe(F.col(s_names[g])) for g in group_cols] +
            [F.col("_start") <= F.col(side), F.col(side) < F.col("_start") + F.col("_cnt")]))
        loc = loc.select(*[t_names[g] for g in group_cols], "_qi", "_frac", "n",
                         F.col(side).alias("_pos"), F.col("_sb"))
        j = pref.join(loc, all_of(
            [F.col(g).eqNullSafe(F.col(t_names[g])) for g in group_cols] +
            [F.col("_bucket") == F.col("_sb"),
             F.col("before__c") <= F.col("_pos"), F.col("_pos") < F.col("before__c") + F.col("_c")]))
        picks.append(j.select(*[F.col(t_names[g]).alias(g) for g in group_cols], "_qi", "_frac", "n",
                              F.col(value_col).alias("_v" + side)))
    both = join_groups(picks[0], picks[1].drop("_frac", "n"), group_cols, ["_qi"])
    q = both.select(*group_cols, "n", "_qi",
                    (F.col("_v_lo") + (F.col("_v_hi") - F.col("_v_lo")) * F.col("_frac")).alias("_q"))
    return q.groupBy(*group_cols).agg(
        F.first("n").alias("n"),
        *[F.max(F.when(F.col("_qi") == i, F.col("_q"))).alias(f"q_{i}") for i in range(len(probs))])
