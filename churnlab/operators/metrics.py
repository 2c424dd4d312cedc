"""Evaluation and risk operators.

All metrics are aggregates over (label, score, prediction).  The ranking
metrics (AUC, ROC, PR) first collapse rows to one unit per distinct score
and then use the distributed prefix, so they are exact (ties count half)
and never sort the table in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.functions.columns import cut, full, join_groups
from churnlab.functions.prefix import ordered_prefix
from churnlab.operators.explore import histogram
from churnlab.operators.profile import attach_scalars
from churnlab.session import materialize


def balanced_weights(df: DataFrame, label_col: str, weight_col: str = "weight") -> DataFrame:
    """weight n / (k * n_class) per row.  The class table (one row per
    class) is broadcast when small; skewed classes are split when not."""
    cls = df.groupBy(F.col(label_col).alias("_class")).agg(F.count(F.lit(1)).alias("_nc"))
    total = cls.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = attach_scalars(cls, total).select("_class", (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(weight_col))
    w = materialize(w, "class-weights")
    return df.join(w, F.col(label_col).eqNullSafe(F.col("_class")), how="left").drop("_class")


def predict_at(score: str = "score", threshold: float = 0.5):
    """F3 decision: class 1 only when the score is strictly above the
    threshold (argmax of (1-p, p) with ties to class 0)."""
    return (F.col(score) > threshold).cast("int")


def confusion(df: DataFrame, label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """F8: tn, fp, fn, tp in one pass."""
    y, p = F.col(label_col), F.col(pred_col)
    return df.agg(F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def _f1(tp, fp, fn):
    den = 2 * tp + fp + fn
    return F.when(den == 0, F.lit(0.0)).otherwise(2.0 * tp / den)


def accuracy(df: DataFrame, label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """share of rows where prediction equals the label."""
    return df.agg(full(F.avg((F.col(label_col) == F.col(pred_col)).cast("double"))).alias("accuracy"))


def f1_score(df: DataFrame, label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """positive-class F1; 0 when there are no positives at all."""
    c = confusion(df, label_col, pred_col)
    return c.select(full(_f1(F.col("tp"), F.col("fp"), F.col("fn"))).alias("f1"))


def classification_report(df: DataFrame, label_col: str = "label", pred_col: str = "pred",
                          names=("0", "1")) -> DataFrame:
    """precision/recall/F1/support per class, accuracy, macro and weighted averages."""
    c = confusion(df, label_col, pred_col)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))

    def ratio(a, b):
        return F.when(b == 0, F.lit(0.0)).otherwise(a / b)

    p1, r1 = ratio(tp, tp + fp), ratio(tp, tp + fn)
    p0, r0 = ratio(tn, tn + fn), ratio(tn, tn + fp)
    f1_1, f1_0 = ratio(2 * p1 * r1, p1 + r1), ratio(2 * p0 * r0, p0 + r0)
    s0, s1 = tn + fp, fn + tp
    n = s0 + s1
    acc = ratio(tp + tn, n)

    def row(label, p, r, f, s):
        return F.struct(F.lit(label).alias("row_label"), full(p).alias("precision"), full(r).alias("recall"),
                        full(f).alias("f1_score"), s.cast("long").alias("support"))

    nul = F.lit(None).cast("double")
    return c.select(F.inline(F.array(
        row(names[0], p0, r0, f1_0, s0), row(names[1], p1, r1, f1_1, s1),
        row("accuracy", nul, nul, acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        row("weighted avg", ratio(p0 * s0 + p1 * s1, n), ratio(r0 * s0 + r1 * s1, n),
            ratio(f1_0 * s0 + f1_1 * s1, n), n))))


def unscored(df: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """One row: rows in all, and rows without a score or without a 0/1 label, which the ranking
    measures (AUC, ROC, precision-recall) leave out."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(score_col).isNull()).alias("n_no_score"),
                  F.count_if(~F.coalesce(F.col(label_col).isin(0, 1), F.lit(False))).alias("n_no_label"))


def _ranked_rows(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    return df.where(F.col(score_col).isNotNull() & F.col(label_col).isin(0, 1))


def _score_units(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    y = F.col(label_col)
    return _ranked_rows(df, label_col, score_col).groupBy(F.col(score_col).cast("double").alias("threshold")).agg(
        F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1"), F.lit(1).alias("one"))


def roc_auc(df: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """exact ROC AUC = P(score_pos > score_neg) + 0.5 P(equal), of the rows that have a
    score and a label (:func:`unscored` counts the others)."""
    pref = ordered_prefix(_score_units(df, label_col, score_col), ["threshold"], ["n0"])
    agg = pref.agg(F.sum(F.col("n1") * (F.col("before_n0").cast("double") + 0.5 * F.col("n0"))).alias("_s"),
                   F.sum("n0").alias("_n0"), F.sum("n1").alias("_n1"))
    den = F.col("_n0").cast("double") * F.col("_n1")  # the product of two counts may pass 2^63
    return agg.select(full(F.when(den > 0, F.col("_s") / den)).alias("auc"))


def _curve_base(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    units = _score_units(df, label_col, score_col)
    pref = ordered_prefix(units, ["threshold"], ["n0", "n1", "one"])
    # totals named apart from n0/n1: column resolution is case-insensitive
    tot = pref.agg(F.sum("n0").alias("total_neg"), F.sum("n1").alias("total_pos"),
                    F.count(F.lit(1)).alias("n_units"))
    # at threshold t: rows with score >= t are predicted positive
    return attach_scalars(pref, tot).select(
        "threshold", "n0", "n1", F.col("before_one").alias("rank_asc"), "n_units", "total_neg", "total_pos",
        (F.col("total_neg") - F.col("before_n0")).alias("fp"), (F.col("total_pos") - F.col("before_n1")).alias("tp"))


def roc_curve(df: DataFrame, label_col: str = "label", score_col: str = "score",
              drop_collinear: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, descending, plus the
    start point (+inf, 0, 0).  ``drop_collinear`` drops points on a straight
    segment (a point is kept when the next lower score adds a different
    (negatives, positives) pair; the first and last are always kept)."""
    base = _curve_base(df, label_col, score_col)
    if drop_collinear:
        nxt = base.select((F.col("rank_asc") + 1).alias("rank_asc"), F.col("n0").alias("_ln0"),
                          F.col("n1").alias("_ln1"))
        base = base.join(nxt, on="rank_asc", how="left").where(
            (F.col("rank_asc") == 0) | (F.col("rank_asc") == F.col("n_units") - 1) |
            (F.col("_ln0") != F.col("n0")) | (F.col("_ln1") != F.col("n1")))
    pts = base.select("threshold", full(F.try_divide(F.col("fp"), F.col("total_neg"))).alias("fpr"),
                      full(F.try_divide(F.col("tp"), F.col("total_pos"))).alias("tpr"))
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(pts)


def pr_curve(df: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """(threshold, precision, recall) for every distinct score."""
    base = _curve_base(df, label_col, score_col)
    return base.select("threshold", full(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))).alias("precision"),
                       full(F.try_divide(F.col("tp"), F.col("total_pos"))).alias("recall"))


def risk_level(score_col: str = "score", edges=S.RISK_EDGES, labels=S.RISK_LABELS):
    """right-closed probability bands; 0.0 falls outside like the reference cut."""
    return cut(score_col, edges, labels)


def risk_summary(df: DataFrame, label_col: str = "label", score_col: str = "score",
                 edges=S.RISK_EDGES, labels=S.RISK_LABELS) -> DataFrame:
    """rows and actual positive rate (%) per risk level, in level order."""
    g = (df.select(cut(score_col, edges, as_ordinal=True).alias("level_order"),
                   cut(score_col, edges, labels).alias("risk_level"), F.col(label_col).alias("_y"))
         .where(F.col("level_order").isNotNull())
         .groupBy("level_order", "risk_level")
         .agg(F.count(F.lit(1)).alias("count"), F.avg(F.col("_y").cast("double")).alias("_r")))
    return g.select("level_order", "risk_level", "count", full(F.col("_r") * 100.0).alias("actual_churn_rate"))


def score_histogram(df: DataFrame, label_col: str = "label", score_col: str = "score",
                    bins: int = S.SCORE_BINS) -> DataFrame:
    """density histogram of scores per actual class."""
    return histogram(df, score_col, by=label_col, bins=bins, density=True)


def evaluate(df: DataFrame, name: str, label_col: str = "label", score_col: str = "score",
             pred_col: str = "pred") -> DataFrame:
    """H2: {label, f1, auc, accuracy} as one row."""
    c = confusion(df, label_col, pred_col)
    acc = c.select(((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")))
                   .alias("_acc"), _f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("_f1"))
    auc = roc_auc(df, label_col, score_col)
    return attach_scalars(acc, auc).select(F.lit(name).alias("label"), full("_f1").alias("f1"), "auc",
                                             full("_acc").alias("accuracy"))


def grouped_evaluate(df: DataFrame, group_cols, label_col: str = "label", score_col: str = "score",
                     pred_col: str = "pred") -> DataFrame:
    """F1/AUC/accuracy for many groups at once (one prefix pass for all groups)."""
    y, p = F.col(label_col), F.col(pred_col)
    groups = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    conf = df.groupBy(*groups).agg(F.count_if((y == 0) & (p == 0)).alias("tn"),
                                     F.count_if((y == 0) & (p == 1)).alias("fp"),
                                     F.count_if((y == 1) & (p == 0)).alias("fn"),
                                     F.count_if((y == 1) & (p == 1)).alias("tp"))
    units = _ranked_rows(df, label_col, score_col).groupBy(*groups, F.col(score_col).cast("double").alias("threshold")).agg(
        F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1"))
    pref = ordered_prefix(units, ["threshold"], ["n0"], groups)
    auc = pref.groupBy(*groups).agg(
        F.sum(F.col("n1") * (F.col("before_n0").cast("double") + 0.5 * F.col("n0"))).alias("_s"),
        F.sum("n0").alias("_n0"), F.sum("n1").alias("_n1"))
    den = F.col("_n0").cast("double") * F.col("_n1")
    n = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    return join_groups(conf, auc, groups, how="left").select(
        *groups, full(_f1(F.col("tp"), F.col("fp"), F.col("fn"))).alias("f1"),
        full(F.when(den > 0, F.col("_s") / den)).alias("auc"), full((F.col("tp") + F.col("tn")) / n).alias("accuracy"))


def prediction_table(df: DataFrame, id_col: str, label_col: str = "label", score_col: str = "score",
                     pred_col: str = "pred", keep=()) -> DataFrame:
    """keyed rows with actual label, probability, decision and risk level
    (all on the same row -- nothing is attached by position)."""
    return df.select(id_col, *keep, F.col(label_col).alias("actual_churn"), full(score_col).alias("churn_prob"),
                     F.col(pred_col).alias("predicted_churn"), risk_level(score_col).alias("risk_level"))
