"""Registry entries for batch monitoring and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.functions.columns import r6
from churnlab.operators import drift as G
from churnlab.plans.q_evaluate import scored
from churnlab.plans.q_prepare import labelled
from churnlab.plans.registry import SPEC, SUBS_CTE, R, W, _hist_sql, query, subs
from churnlab.plans.sql import HSUBS_CTE, SCORE_CTE
from churnlab.sources import tables as T

_CAT = S.SUBS_CATEGORY_FEATURES


@query("g1_marginals", W(SUBS_CTE + ",\nlong AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, CAST({c} AS VARCHAR) AS value FROM subs" for c in _CAT) + """),
g AS (SELECT "column", value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY 1, 2)""", f"""
SELECT "column", value, n, {R('n / sum(n) OVER (PARTITION BY "column")')} AS share FROM g"""))
def g1_marginals(spark, d):
    return G.marginals(subs(spark, d), _CAT)


_MOMENTS = ("tenure", "monthly_spend", "high_balance")


@query("g2_moments", W(HSUBS_CTE + ",\nper AS (" + "\nUNION ALL\n".join(
    f"SELECT CAST(batch_month AS INTEGER) AS month, '{c}' AS \"column\", count({c}) AS n, avg(CAST({c} AS DOUBLE)) AS mean, "
    f"stddev_samp(CAST({c} AS DOUBLE)) AS std FROM hsubs GROUP BY batch_month" for c in _MOMENTS) + ")", f"""
SELECT p.month, p."column", p.n, {R('p.mean')} AS mean, {R('p.std')} AS std, {R('b.mean')} AS base_mean,
       {R('b.std')} AS base_std, {R('(p.mean - b.mean) / CASE WHEN b.std > 0 THEN b.std END')} AS shift
FROM per p JOIN per b ON p."column" = b."column" AND b.month = 0 WHERE p.month <> 0"""))
def g2_moments(spark, d):
    """Mean and standard deviation of every batch against the original table."""
    return G.moment_drift(T.with_original(subs(spark, d)), "batch_month", _MOMENTS)


@query("g3_high_value", W(SUBS_CTE + """,
q AS (SELECT quantile_cont(monthly_spend, 0.75) AS q FROM subs WHERE batch_month = 1)""", """
SELECT c_custkey, CAST(monthly_spend > q AS INTEGER) AS high_value FROM subs, q"""))
def g3_high_value(spark, d):
    s = subs(spark, d)
    return G.quantile_flag(s, "monthly_spend", s.where(F.col("batch_month") == 1)).select("c_custkey", "high_value")


@query("g4_scorecard", W(SCORE_CTE, f"SELECT c_custkey, {R('score')} AS score FROM pred"))
def g4_scorecard(spark, d):
    return scored(spark, d).select("c_custkey", r6("score").alias("score"))


@query("g5_clip", W(SUBS_CTE, f"""
SELECT c_custkey,
       {R('round_even(least(greatest(monthly_spend * (1 + batch_month * 0.005), 1000.0), 100000.0), 2)')}
           AS spend_next,
       CAST(trunc(least(greatest(CAST(tenure + batch_month AS DOUBLE), 0.0), 72.0)) AS INTEGER) AS tenure_next
FROM subs"""))
def g5_clip(spark, d):
    s = subs(spark, d).select("c_custkey", (F.col("monthly_spend") * (1 + F.col("batch_month") * 0.005)).alias("sp"),
                              (F.col("tenure") + F.col("batch_month")).alias("tn"))
    return s.select("c_custkey", r6(G.clip_round("sp", 1000.0, 100000.0, 2)).alias("spend_next"),
                    G.clip_round("tn", 0, 72, truncate_int=True).alias("tenure_next"))


@query("g5_winsor", W(SUBS_CTE + """,
b AS (SELECT quantile_cont(monthly_spend, 0.05) AS l1, quantile_cont(monthly_spend, 0.95) AS h1,
             quantile_cont(CAST(tenure AS DOUBLE), 0.05) AS l2, quantile_cont(CAST(tenure AS DOUBLE), 0.95) AS h2 FROM subs)""", f"""
SELECT c_custkey, {R('round_even(least(greatest(monthly_spend, l1), h1), 2)')} AS monthly_spend,
       {R('round_even(least(greatest(CAST(tenure AS DOUBLE), l2), h2), 2)')} AS tenure FROM subs, b"""))
def g5_winsor(spark, d):
    """Spend and tenure bounded by their own 5th and 95th percentile."""
    return G.winsorized(subs(spark, d).select("c_custkey", "monthly_spend", "tenure"), ["monthly_spend", "tenure"])


@query("g6_position", W(SUBS_CTE + """,
odd AS (SELECT c_custkey, CASE WHEN batch_month <> 3 THEN batch_month END AS batch_month FROM subs)""", """
SELECT c_custkey, batch_month, row_number() OVER (PARTITION BY batch_month ORDER BY c_custkey) AS position,
       count(*) OVER (PARTITION BY batch_month) AS batch_size FROM odd"""))
def g6_position(spark, d):
    """Position and batch size; the rows of one month have lost it and are a batch of their own."""
    s = subs(spark, d).select("c_custkey", F.when(F.col("batch_month") != 3, F.col("batch_month")).alias("batch_month"))
    return G.batch_position(s, "batch_month", "c_custkey")


@query("g6_batch_key", W(SUBS_CTE, """
SELECT c_custkey, batch_month,
       printf('NEW-M%02d-%04d', CAST(batch_month AS INTEGER),
              row_number() OVER (PARTITION BY batch_month ORDER BY c_custkey) - 1) AS batch_key
FROM subs"""))
def g6_batch_key(spark, d):
    return G.batch_key(subs(spark, d), "batch_month", "c_custkey").select("c_custkey", "batch_month", "batch_key")


@query("g7_batch_summary", W(SUBS_CTE, f"""
SELECT CAST(batch_month AS INTEGER) AS month, count(*) AS n_customers,
       {R("avg(CAST(churn = 'Yes' AS DOUBLE)) * 100.0")} AS churn_rate,
       printf('month_%02d.csv', CAST(batch_month AS INTEGER)) AS file
FROM subs GROUP BY batch_month"""))
def g7_batch_summary(spark, d):
    return G.batch_summary(labelled(spark, d), "batch_month", "label")


@query("g8_rate_drift", W(HSUBS_CTE + """,
per AS (SELECT CAST(batch_month AS INTEGER) AS month, avg(CAST(churn = 'Yes' AS DOUBLE)) * 100.0 AS rate
        FROM hsubs WHERE batch_month <> 0 GROUP BY batch_month),
o AS (SELECT avg(CAST(churn = 'Yes' AS DOUBLE)) * 100.0 AS orig FROM hsubs WHERE batch_month = 0),
sp AS (SELECT max_by(rate, month) - min_by(rate, month) AS span FROM per)""", f"""
SELECT month, {R('rate')} AS churn_rate, {R('orig')} AS original_rate, {R('rate - orig')} AS diff_vs_original,
       {R('span')} AS drift_last_first
FROM per, o, sp"""))
def g8_rate_drift(spark, d):
    """Every batch against the original table, which the batches are not part of."""
    lab = T.with_original(labelled(spark, d))
    return G.rate_drift(lab.where(F.col("batch_month") != 0), "batch_month", "label", lab.where(F.col("batch_month") == 0))


_G9_SRC = SUBS_CTE + """,
tagged AS (SELECT CASE WHEN batch_month = 1 THEN 'month_01' ELSE 'month_06' END AS source, monthly_spend
           FROM subs WHERE batch_month IN (1, 6))"""


@query("g9_numeric_drift", W(_G9_SRC + "," + _hist_sql("tagged", "monthly_spend", "source", S.FEATURE_BINS), ""))
def g9_numeric_drift(spark, d):
    s = subs(spark, d)
    return G.numeric_drift(s.where(F.col("batch_month") == 1), s.where(F.col("batch_month") == 6), "monthly_spend",
                           names=("month_01", "month_06"), density=True)


@query("g9_original_vs_new", W(HSUBS_CTE + """,
tagged AS (SELECT CASE WHEN batch_month = 0 THEN 'original' ELSE 'new' END AS source, tenure FROM hsubs)""" + "," +
    _hist_sql("tagged", "tenure", "source", S.FEATURE_BINS), ""))
def g9_original_vs_new(spark, d):
    """Density of tenure in the original table and in all batches together."""
    s = T.with_original(subs(spark, d))
    return G.numeric_drift(s.where(F.col("batch_month") == 0), s.where(F.col("batch_month") != 0), "tenure",
                           names=("original", "new"), density=True)


@query("g10_category_drift", W(HSUBS_CTE + """,
a AS (SELECT commitment AS value, count(*) AS n_a, count(*) * 100.0 / sum(count(*)) OVER () AS s_a
      FROM hsubs WHERE commitment IS NOT NULL AND batch_month = 0 GROUP BY commitment),
b AS (SELECT commitment AS value, count(*) * 100.0 / sum(count(*)) OVER () AS s_b
      FROM hsubs WHERE commitment IS NOT NULL AND batch_month <> 0 GROUP BY commitment)""", f"""
SELECT a.value, {R('s_a')} AS share_a, {R('coalesce(s_b, 0.0)')} AS share_b,
       row_number() OVER (ORDER BY n_a DESC, a.value) AS order_a
FROM a LEFT JOIN b ON a.value = b.value"""))
def g10_category_drift(spark, d):
    """Category shares of the original table against all batches."""
    s = T.with_original(subs(spark, d))
    return G.category_drift(s.where(F.col("batch_month") == 0), s.where(F.col("batch_month") != 0), "commitment")


@query("g11_union", W(SUBS_CTE, "SELECT * FROM subs"))
def g11_union(spark, d):
    """Monthly deliveries land as separate folders; each is read on its own
    and the months are stacked by column name."""
    from churnlab.session import work_path
    root = T.write_batch_files(subs(spark, d), work_path(spark, "g11"), "batch_month", fmt="parquet")
    schema = ", ".join(x for x in T.SUBS_SCHEMA.split(", ") if not x.startswith("batch_month"))
    frames = [T.read_table(spark, f"{root}/_month_dir=month_{m:02d}", schema=schema)
              .withColumn("batch_month", F.lit(m).cast("bigint")) for m in range(1, S.N_BATCHES + 1)]
    return G.union_batches(frames).select(*SPEC.column_order)
