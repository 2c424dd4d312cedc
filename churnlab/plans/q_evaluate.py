"""Registry entries for evaluation and risk (F1, F4-F9, F11-F15), the
scorecard evaluation (H2) and the scorecard retrain rounds (H3, H5, H6).

The score is the deterministic scorecard (G4), so every metric has an exact
SQL twin; model-based keys live in :mod:`churnlab.plans.q_model`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.functions.columns import r6
from churnlab.functions.prefix import exact_quantiles
from churnlab.operators import drift as G
from churnlab.operators import metrics as M
from churnlab.operators import prepare as D
from churnlab.operators import retrain as H
from churnlab.operators.profile import attach_scalars
from churnlab.plans.q_prepare import labelled, split_subs
from churnlab.plans.registry import SPEC, R, W, _hist_sql, null_group_sql, query, subs, with_null_group
from churnlab.plans.sql import HISTORY_CTE, RAW_SPLIT_CTE, SCORE_CTE, score_expr
from churnlab.sources import tables as T


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Subscriber rows + label + scorecard score + 0/1 decision.  The
    high-spend cut (75th percentile) is attached as a one-row aggregate, so
    the plan stays lazy and nothing passes through the driver."""
    s = subs(spark, d)
    cut = exact_quantiles(s.select(F.col("monthly_spend").alias("x")), "x", [0.75]).select(
        F.col("q_0").alias("_hs"))
    card = G.subs_scorecard(F.col("_hs"))
    out = attach_scalars(s, cut).select(*s.columns, D.encode_target(SPEC).alias("label"),
                                        card.score().alias("score"))
    return out.withColumn("pred", M.predict_at())


def _conf_sql(src: str = "pred", group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return (f"SELECT {g}count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn, "
            f"count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp, "
            f"count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn, "
            f"count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp FROM {src}{gb}")


def _f1_sql(tp="tp", fp="fp", fn="fn") -> str:
    return f"CASE WHEN 2 * {tp} + {fp} + {fn} = 0 THEN 0.0 ELSE 2.0 * {tp} / (2 * {tp} + {fp} + {fn}) END"


_AUC_UNITS = """
u AS (SELECT score AS t, count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1
      FROM pred GROUP BY score),
pu AS (SELECT *, coalesce(sum(n0) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b0
       FROM u),
auc AS (SELECT CASE WHEN sum(n0) * sum(n1) > 0 THEN sum(n1 * (b0 + 0.5 * n0)) / (sum(n0) * sum(n1)) END AS auc
        FROM pu)"""


# ------------------------------------------------------------------ F
@query("f1_weights", W(RAW_SPLIT_CTE.split(",\ncls AS")[0] + """,
c AS (SELECT label, count(*) AS n_c FROM lab GROUP BY label),
t AS (SELECT sum(n_c) AS n, count(*) AS k FROM c)""", f"""
SELECT l.c_custkey, l.label, {R('t.n / (t.k * c.n_c)')} AS weight FROM lab l JOIN c ON l.label = c.label, t"""))
def f1_weights(spark, d):
    w = M.balanced_weights(labelled(spark, d), "label")
    return w.select("c_custkey", "label", r6("weight").alias("weight"))


@query("f4_accuracy", W(SCORE_CTE, f"SELECT {R('avg(CAST(label = pred AS DOUBLE))')} AS accuracy FROM pred"))
def f4_accuracy(spark, d):
    return M.accuracy(scored(spark, d))


@query("f5_auc", W(SCORE_CTE + "," + _AUC_UNITS, f"SELECT {R('auc')} AS auc FROM auc"))
def f5_auc(spark, d):
    return M.roc_auc(scored(spark, d))


@query("f6_f1", W(SCORE_CTE + f",\nc AS ({_conf_sql()})", f"SELECT {R(_f1_sql())} AS f1 FROM c"))
def f6_f1(spark, d):
    return M.f1_score(scored(spark, d))


def _f7_sql() -> str:
    def ratio(a, b):
        return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"
    m = f"""m AS (SELECT *, {ratio('tp', 'tp + fp')} AS p1, {ratio('tp', 'tp + fn')} AS r1,
                       {ratio('tn', 'tn + fn')} AS p0, {ratio('tn', 'tn + fp')} AS r0,
                       tn + fp AS s0, fn + tp AS s1, tn + fp + fn + tp AS n FROM c),
mm AS (SELECT *, {ratio('2 * p1 * r1', 'p1 + r1')} AS f1_1, {ratio('2 * p0 * r0', 'p0 + r0')} AS f1_0 FROM m)"""

    def row(lbl, p, r, f, s):
        return (f"SELECT '{lbl}' AS row_label, {R(p)} AS precision, {R(r)} AS recall, {R(f)} AS f1_score, "
                f"CAST({s} AS BIGINT) AS support FROM mm")
    body = "\nUNION ALL\n".join([
        row("0", "p0", "r0", "f1_0", "s0"), row("1", "p1", "r1", "f1_1", "s1"),
        row("accuracy", "NULL", "NULL", ratio("tp + tn", "n"), "n"),
        row("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f1_0 + f1_1) / 2", "n"),
        row("weighted avg", ratio("p0 * s0 + p1 * s1", "n"), ratio("r0 * s0 + r1 * s1", "n"),
            ratio("f1_0 * s0 + f1_1 * s1", "n"), "n")])
    return W(SCORE_CTE + f",\nc AS ({_conf_sql()}),\n" + m, body)


@query("f7_report", _f7_sql())
def f7_report(spark, d):
    return M.classification_report(scored(spark, d))


@query("f8_confusion", W(SCORE_CTE, _conf_sql()))
def f8_confusion(spark, d):
    return M.confusion(scored(spark, d))


_CURVE = """
u AS (SELECT score AS t, count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1
      FROM pred GROUP BY score),
tot AS (SELECT sum(n0) AS total_neg, sum(n1) AS total_pos, count(*) AS n_units FROM u),
c AS (SELECT t, n0, n1, sum(n0) OVER (ORDER BY t DESC) AS fp, sum(n1) OVER (ORDER BY t DESC) AS tp,
             lead(n0) OVER (ORDER BY t DESC) AS ln0, lead(n1) OVER (ORDER BY t DESC) AS ln1,
             row_number() OVER (ORDER BY t DESC) AS rn FROM u)"""


@query("f9_roc", W(SCORE_CTE + "," + _CURVE, f"""
SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL
SELECT t AS threshold, {R('CAST(fp AS DOUBLE) / total_neg')} AS fpr, {R('CAST(tp AS DOUBLE) / total_pos')} AS tpr
FROM c, tot WHERE rn = 1 OR rn = n_units OR ln0 <> n0 OR ln1 <> n1"""))
def f9_roc(spark, d):
    return M.roc_curve(scored(spark, d))


@query("f9_roc_all_points", W(SCORE_CTE + "," + _CURVE, f"""
SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL
SELECT t AS threshold, {R('CAST(fp AS DOUBLE) / total_neg')} AS fpr, {R('CAST(tp AS DOUBLE) / total_pos')} AS tpr FROM c, tot"""))
def f9_roc_all_points(spark, d):
    return M.roc_curve(scored(spark, d), drop_collinear=False)


def _risk_case(x: str, ordinal: bool) -> str:
    e, lab = S.RISK_EDGES, S.RISK_LABELS
    arms = " ".join(f"WHEN {x} > {e[i]} AND {x} <= {e[i + 1]} THEN {i if ordinal else repr(lab[i])}"
                    for i in range(len(e) - 1))
    return f"CASE {arms} END"


@query("f11_risk_level", W(SCORE_CTE, f"""
SELECT c_custkey, {R('score')} AS score, {_risk_case('score', False)} AS risk_level FROM pred"""))
def f11_risk_level(spark, d):
    return scored(spark, d).select("c_custkey", r6("score").alias("score"), M.risk_level().alias("risk_level"))


@query("f12_risk_summary", W(SCORE_CTE, f"""
SELECT {_risk_case('score', True)} AS level_order, {_risk_case('score', False)} AS risk_level, count(*) AS count,
       {R('avg(CAST(label AS DOUBLE)) * 100.0')} AS actual_churn_rate
FROM pred WHERE {_risk_case('score', True)} IS NOT NULL GROUP BY 1, 2"""))
def f12_risk_summary(spark, d):
    return M.risk_summary(scored(spark, d))


@query("f13_predictions", W(SCORE_CTE, f"""
SELECT c_custkey, tenure, commitment, monthly_spend, segment, region, batch_month, label AS actual_churn,
       {R('score')} AS churn_prob, pred AS predicted_churn, {_risk_case('score', False)} AS risk_level FROM pred"""))
def f13_predictions(spark, d):
    return M.prediction_table(scored(spark, d), "c_custkey",
                              keep=("tenure", "commitment", "monthly_spend", "segment", "region", "batch_month"))


@query("f14_pr_curve", W(SCORE_CTE + "," + _CURVE, f"""
SELECT t AS threshold, {R('CAST(tp AS DOUBLE) / (tp + fp)')} AS precision, {R('CAST(tp AS DOUBLE) / total_pos')} AS recall
FROM c, tot"""))
def f14_pr_curve(spark, d):
    return M.pr_curve(scored(spark, d))


@query("f15_score_hist", W(SCORE_CTE + "," + _hist_sql("pred", "score", "label", S.SCORE_BINS), ""))
def f15_score_hist(spark, d):
    return M.score_histogram(scored(spark, d))


# ------------------------------------------------------------------ H2
@query("h2_evaluate", W(SCORE_CTE + f",\nc AS ({_conf_sql()}),\n" + _AUC_UNITS.lstrip(), f"""
SELECT 'scorecard' AS label, {R(_f1_sql())} AS f1, {R('auc')} AS auc,
       {R('CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn)')} AS accuracy FROM c, auc"""))
def h2_evaluate(spark, d):
    return M.evaluate(scored(spark, d), "scorecard")


@query("h2_evaluate_by_month", W(SCORE_CTE + f""",
c AS ({_conf_sql(group='batch_month')}),
u AS (SELECT batch_month, score AS t, count(*) FILTER (WHERE label = 0) AS n0,
             count(*) FILTER (WHERE label = 1) AS n1 FROM pred GROUP BY batch_month, score),
pu AS (SELECT *, coalesce(sum(n0) OVER (PARTITION BY batch_month ORDER BY t
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b0 FROM u),
auc AS (SELECT batch_month, CASE WHEN sum(n0) * sum(n1) > 0
                                 THEN sum(n1 * (b0 + 0.5 * n0)) / (sum(n0) * sum(n1)) END AS auc
        FROM pu GROUP BY batch_month)""", f"""
SELECT c.batch_month, {R(_f1_sql())} AS f1, {R('auc')} AS auc,
       {R('CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn)')} AS accuracy
FROM c LEFT JOIN auc ON c.batch_month = auc.batch_month"""))
def h2_evaluate_by_month(spark, d):
    return M.grouped_evaluate(scored(spark, d), "batch_month")


# ------------------------------------------------------------------ null scores and groups
_SCORED_ONLY = "FROM (SELECT * FROM pred WHERE segment <> 'BUILDING') AS pred"


def _some_unscored(spark, d):
    """Scored rows, those of one segment without a score."""
    return scored(spark, d).withColumn("score", F.when(F.col("segment") != "BUILDING", F.col("score")))


@query("f5_auc_null_scores", W(SCORE_CTE + "," + _AUC_UNITS.replace("FROM pred", _SCORED_ONLY), f"""
SELECT {R('auc')} AS auc, (SELECT count(*) FROM pred) AS n,
       (SELECT count(*) FROM pred WHERE segment = 'BUILDING') AS n_no_score, CAST(0 AS BIGINT) AS n_no_label FROM auc"""))
def f5_auc_null_scores(spark, d):
    """Rows without a score take no part and are counted."""
    rows = _some_unscored(spark, d)
    return attach_scalars(M.roc_auc(rows), M.unscored(rows))


@query("f9_roc_null_scores", W(SCORE_CTE + "," + _CURVE.replace("FROM pred", _SCORED_ONLY), f"""
SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL
SELECT {R('t')} AS threshold, {R('CAST(fp AS DOUBLE) / total_neg')} AS fpr, {R('CAST(tp AS DOUBLE) / total_pos')} AS tpr
FROM c, tot WHERE rn = 1 OR rn = n_units OR ln0 <> n0 OR ln1 <> n1"""))
def f9_roc_null_scores(spark, d):
    return M.roc_curve(_some_unscored(spark, d))


@query("f14_pr_null_scores", W(SCORE_CTE + "," + _CURVE.replace("FROM pred", _SCORED_ONLY), f"""
SELECT {R('t')} AS threshold, {R('CAST(tp AS DOUBLE) / (tp + fp)')} AS precision, {R('CAST(tp AS DOUBLE) / total_pos')} AS recall
FROM c, tot"""))
def f14_pr_null_scores(spark, d):
    return M.pr_curve(_some_unscored(spark, d))


_H2_NULL = SCORE_CTE + f""",
odd AS (SELECT * REPLACE (CASE WHEN region = 'ASIA' OR region IS NULL THEN '~none' ELSE region END AS region) FROM pred),
c AS ({_conf_sql(group='region').replace('FROM pred', 'FROM odd')}),
u AS (SELECT region, score AS t, count(*) FILTER (WHERE label = 0) AS n0,
             count(*) FILTER (WHERE label = 1) AS n1 FROM odd GROUP BY region, score),
pu AS (SELECT *, coalesce(sum(n0) OVER (PARTITION BY region ORDER BY t
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b0 FROM u),
auc AS (SELECT region, CASE WHEN sum(n0) * sum(n1) > 0
                            THEN sum(n1 * (b0 + 0.5 * n0)) / (sum(n0) * sum(n1)) END AS auc FROM pu GROUP BY region)"""


@query("h2_evaluate_null_group", null_group_sql(W(_H2_NULL, f"""
SELECT c.region, {R(_f1_sql())} AS f1, {R('auc')} AS auc,
       {R('CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn)')} AS accuracy
FROM c LEFT JOIN auc ON c.region = auc.region"""), "region"))
def h2_evaluate_null_group(spark, d):
    """A null region is evaluated like any other."""
    return M.grouped_evaluate(with_null_group(scored(spark, d), "region", "ASIA"), "region")


# ------------------------------------------------------------------ H3, H5, H6
def history_split(spark: SparkSession, d: str):
    """(train, test) rows with month 0 for the original table."""
    sp = T.with_original(split_subs(spark, d))
    return sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")


@query("h3_accumulate", W(HISTORY_CTE, """
SELECT CAST(batch_month AS INTEGER) AS month, count(*) AS n_new,
       CAST(sum(count(*)) OVER (ORDER BY batch_month) AS BIGINT) AS data_size
FROM hsplit WHERE split = 'train' GROUP BY batch_month"""))
def h3_accumulate(spark, d):
    """The original table first, then the batches."""
    return H.accumulate(history_split(spark, d)[0], "batch_month")


_HIST_CTE = HISTORY_CTE + f""",
rounds AS (SELECT unnest(range(0, {S.N_BATCHES + 1})) AS round),
cuts AS (SELECT r.round, count(*) AS data_size, quantile_cont(s.monthly_spend, 0.75) AS cut
         FROM hsplit s JOIN rounds r ON s.batch_month <= r.round WHERE s.split = 'train' GROUP BY r.round),
parts AS (SELECT unnest(['test', 'new', 'latest']) AS part),
t AS (SELECT c.round, p.part, s.label, {score_expr('c.cut', 's.')} AS score
      FROM hsplit s, cuts c, parts p WHERE s.split = 'test' AND s.batch_month =
        CASE p.part WHEN 'test' THEN 0 WHEN 'new' THEN c.round + 1 ELSE {S.N_BATCHES} END),
pred AS (SELECT *, CAST(score > 0.5 AS INTEGER) AS pred FROM t),
conf AS ({_conf_sql('pred', 'round, part')}),
u AS (SELECT round, part, score AS t, count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1
      FROM pred GROUP BY round, part, score),
pu AS (SELECT *, coalesce(sum(n0) OVER (PARTITION BY round, part ORDER BY t
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b0 FROM u),
auc AS (SELECT round, part, CASE WHEN sum(n0) * sum(n1) > 0 THEN sum(n1 * (b0 + 0.5 * n0)) / (sum(n0) * sum(n1)) END AS auc
        FROM pu GROUP BY round, part),
ev AS (SELECT conf.round, conf.part, {_f1_sql()} AS f1, auc.auc, CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy
       FROM conf LEFT JOIN auc ON conf.round = auc.round AND conf.part = auc.part),
hist0 AS (SELECT CAST(cuts.round AS INTEGER) AS month, cuts.data_size,
                 max(f1) FILTER (WHERE part = 'test') AS f1_test, max(auc) FILTER (WHERE part = 'test') AS auc_test,
                 max(f1) FILTER (WHERE part = 'new') AS f1_on_new, max(f1) FILTER (WHERE part = 'latest') AS f1_latest,
                 max(auc) FILTER (WHERE part = 'latest') AS auc_latest,
                 max(accuracy) FILTER (WHERE part = 'latest') AS accuracy_latest, cuts.round >= {S.N_BATCHES} AS latest_seen
          FROM cuts JOIN ev ON cuts.round = ev.round GROUP BY cuts.round, cuts.data_size),
history AS (SELECT h.*, h.f1_test - b.f1_test AS delta_f1 FROM hist0 h, (SELECT f1_test FROM hist0 WHERE month = 0) b)"""


def _history(spark, d):
    return H.scorecard_history(*history_split(spark, d), "batch_month", "monthly_spend", G.subs_scorecard)


_HIST_METRICS = ("f1_test", "auc_test", "f1_on_new", "f1_latest", "auc_latest", "accuracy_latest", "delta_f1")


@query("h5_history", W(_HIST_CTE, f"SELECT month, data_size, latest_seen, {', '.join(f'{R(c)} AS {c}' for c in _HIST_METRICS)} "
                                  "FROM history"))
def h5_history(spark, d):
    return _history(spark, d)


@query("h6_select", W(_HIST_CTE + """,
best AS (SELECT month AS best_month, f1_test AS best_f1 FROM history WHERE month <> 0
         ORDER BY f1_test DESC, month LIMIT 1)""", f"""
SELECT CAST(best_month AS INTEGER) AS best_month, {R('best_f1')} AS best_f1, {R('b.f1_test')} AS baseline_f1,
       best_f1 > b.f1_test AS deploy
FROM best, (SELECT f1_test FROM history WHERE month = 0) b"""))
def h6_select(spark, d):
    return H.select_model(_history(spark, d))
