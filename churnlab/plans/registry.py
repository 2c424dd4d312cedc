"""Query registry: key -> Spark DataFrame builder, key -> DuckDB oracle SQL.

Each builder takes ``(spark, sf_dir)`` and reads the test tables itself, so
its work grows with the data.  Oracle SQL recomputes the same result from
the raw tables (views pre-registered by the checker) without library code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.functions.columns import coerce_numeric, cut, r6
from churnlab.functions.prefix import exact_quantiles
from churnlab.operators import explore as E
from churnlab.operators import profile as P
from churnlab.plans.sql import NUM_RE, SUBS_CTE
from churnlab.session import materialize
from churnlab.sources import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Reported doubles to 6 decimals (densities to 12, they may be tiny), as the SQL twins do."""
    digits = {c: 12 if c == "density" else 6 for c, t in df.dtypes if t == "double"}
    return df.select(*[(F.round(c, digits[c]) + F.lit(0.0)).alias(c) if c in digits else F.col(c) for c in df.columns])


def query(key: str, sql: str | None = None):
    """Register a query.  Operators work at full precision; where the SQL twin
    rounds what it reports, so does the query."""
    def deco(fn):
        if sql is not None and "round(CAST(" in sql:
            def reported(spark, d, fn=fn):
                return rounded(fn(spark, d))
            reported.__name__, reported.__doc__ = fn.__name__, fn.__doc__
            QUERIES[key] = reported
        else:
            QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


SPEC = S.SUBS_SPEC


def subs(spark: SparkSession, d: str) -> DataFrame:
    return T.subscribers(spark, d)


def subs_num(spark: SparkSession, d: str) -> DataFrame:
    """A2 applied: numeric text coerced to double."""
    return subs(spark, d).withColumn("total_spend", coerce_numeric("total_spend"))


SUBS_NUM_CTE = SUBS_CTE + """,
subs_num AS (
  SELECT * REPLACE (CASE WHEN regexp_matches(trim(total_spend), '""" + NUM_RE + """')
                         THEN TRY_CAST(trim(total_spend) AS DOUBLE) END AS total_spend)
  FROM subs
)"""


def W(cte: str, body: str) -> str:
    return "WITH " + cte + "\n" + body


def R(x: str) -> str:
    """Oracle twin of ``r6``: round to 6 decimals, fold -0.0."""
    return f"(round(CAST({x} AS DOUBLE), 6) + CAST(0.0 AS DOUBLE))"


# ---------------------------------------------------------------- 2.1 sources
@query("a1_scan", W(SUBS_CTE, "SELECT * FROM subs"))
def a1_scan(spark, d):
    return subs(spark, d)


@query("a2_coerce", W(SUBS_NUM_CTE, "SELECT c_custkey, total_spend FROM subs_num"))
def a2_coerce(spark, d):
    return subs(spark, d).select("c_custkey", coerce_numeric("total_spend").alias("total_spend"))


@query("a3_roundtrip", W(SUBS_CTE, "SELECT * FROM subs"))
def a3_roundtrip(spark, d):
    from churnlab.session import work_path
    path = T.write_table(subs(spark, d), work_path(spark, "a3"), partition_by=("batch_month",))
    back = T.read_table(spark, path, schema=T.SUBS_SCHEMA)
    return back.select(*SPEC.column_order)


@query("a1_scan_csv", W(SUBS_CTE, "SELECT * FROM subs"))
def a1_scan_csv(spark, d):
    """The subscriber table as header CSV (the original delivery format), read
    back with the declared schema in PERMISSIVE mode; blanks stay text."""
    from churnlab.session import work_path
    path = T.write_table(subs(spark, d), work_path(spark, "a1csv"), fmt="csv")
    return T.read_table(spark, path, schema=T.SUBS_SCHEMA, fmt="csv").select(*SPEC.column_order)


@query("a4_batches", W(SUBS_CTE, "SELECT c_custkey, churn, CAST(batch_month AS INTEGER) AS batch_month FROM subs"))
def a4_batches(spark, d):
    from churnlab.session import work_path
    root = T.write_batch_files(subs(spark, d).select("c_custkey", "churn", "batch_month"),
                               work_path(spark, "a4"), "batch_month")
    return T.read_batches(spark, root, "c_custkey bigint, churn string").select("c_custkey", "churn", "batch_month")


# -------------------------------------------------------------- 2.2 profiling
@query("b1_shape", W(SUBS_CTE, """
SELECT count(*) AS n_rows, 13 AS n_columns, 4 AS n_numeric, 6 AS n_categorical, 1 AS n_target FROM subs"""))
def b1_shape(spark, d):
    return P.table_shape(subs(spark, d), SPEC)


def _b2_sql() -> str:
    types = dict(c_custkey="bigint", churn="string", tenure="int", total_spend="string", monthly_spend="double",
                 high_balance="int", in_debt="string", commitment="string", segment="string", region="string",
                 urgent_user="string", bulk_buyer="string", batch_month="bigint")
    parts = []
    for i, c in enumerate(SPEC.column_order):
        parts.append(f"SELECT {i} AS position, '{c}' AS column, '{types[c]}' AS dtype, '{SPEC.role(c)}' AS role, "
                     f"count({c}) AS non_null, count(DISTINCT {c}) AS n_distinct FROM subs")
    return W(SUBS_CTE, "\nUNION ALL\n".join(parts))


@query("b2_columns", _b2_sql())
def b2_columns(spark, d):
    return P.column_report(subs(spark, d), SPEC)


#: Columns with few and with many values.
_SKETCHED = ("c_custkey", "tenure", "total_spend", "monthly_spend", "commitment", "segment")


@query("b2_sketch_merge", W(SUBS_CTE, "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, count({c}) AS non_null, count(DISTINCT {c}) AS n_distinct, true AS within_bound FROM subs"
    for c in _SKETCHED)))
def b2_sketch_merge(spark, d):
    """Distinct counts from sketches kept per month and merged, beside the exact ones: within four
    standard errors of 1.04 / 2**7."""
    s = subs(spark, d)
    kept = materialize(P.distinct_sketches(s, _SKETCHED, ["batch_month"]), "distinct-sketches")
    merged = P.merged_distinct(kept).select(F.col("column").alias("c"), "non_null", F.col("n_distinct").alias("estimate"))
    exact = P.column_report(s.select(*_SKETCHED), SPEC).select("column", "n_distinct")
    return exact.join(merged, F.col("column") == F.col("c")).select("column", "non_null", "n_distinct", (
        F.abs(F.col("estimate") - F.col("n_distinct")) <= 4 * 1.04 / 2 ** 7 * F.col("n_distinct")).alias("within_bound"))


@query("b3_preview", W(SUBS_CTE, "SELECT * FROM subs ORDER BY c_custkey LIMIT 5"))
def b3_preview(spark, d):
    return P.preview(subs(spark, d), SPEC)


_NUM = ("tenure", "total_spend", "monthly_spend")


def _b4_sql() -> str:
    parts = [f"""SELECT '{c}' AS column, count({c}) AS count, {R(f'avg({c})')} AS mean,
  {R(f'stddev_samp({c})')} AS std, {R(f'min({c})')} AS min, {R(f'quantile_cont({c}, 0.25)')} AS p25,
  {R(f'quantile_cont({c}, 0.5)')} AS p50, {R(f'quantile_cont({c}, 0.75)')} AS p75, {R(f'max({c})')} AS max
FROM subs_num""" for c in _NUM]
    return W(SUBS_NUM_CTE, "\nUNION ALL\n".join(parts))


@query("b4_describe", _b4_sql())
def b4_describe(spark, d):
    return P.describe_numeric(subs_num(spark, d), _NUM)


_PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)


@query("b4_sketch_merge", W(SUBS_NUM_CTE, "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, CAST({q} AS DOUBLE) AS q, count({c}) AS count, {R(f'quantile_cont({c}, {q})')} AS exact, "
    "true AS within_bound FROM subs_num" for c in _NUM for q in _PROBS)))
def b4_sketch_merge(spark, d):
    """Quantiles from sketches kept per month and merged, beside the exact ones: the rank of the
    sketch's value lies within the stated error (doubled) of the rank asked for."""
    s = materialize(subs_num(spark, d).select(*_NUM, "batch_month"), "sketched")
    kept = materialize(P.quantile_sketches(s, _NUM, ["batch_month"]), "quantile-sketches")
    merged = materialize(P.merged_quantiles(kept, _PROBS), "merged-quantiles")
    long = s.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in _NUM])))
    held = long.groupBy("column", "x").agg(F.count(F.lit(1)).alias("n")).where("x is not null")
    at = merged.select(F.col("column").alias("c"), "q", "count", "value")
    rank = held.join(at, F.col("column") == F.col("c")).groupBy("c", "q", "count").agg(
        (F.sum(F.when(F.col("x") < F.col("value"), F.col("n")).otherwise(0)) / F.col("count")).alias("below"),
        (F.sum(F.when(F.col("x") <= F.col("value"), F.col("n")).otherwise(0)) / F.col("count")).alias("upto"))
    error = 2 * P.rank_error()
    exact = exact_quantiles(long, "x", _PROBS, ["column"]).select("column", F.inline(F.array(*[
        F.struct(F.lit(p).alias("p"), F.col(f"q_{i}").alias("exact")) for i, p in enumerate(_PROBS)])))
    return rank.join(exact, (F.col("column") == F.col("c")) & (F.col("q") == F.col("p"))).select(
        "column", "q", "count", r6("exact").alias("exact"),
        ((F.col("below") <= F.col("q") + error) & (F.col("upto") >= F.col("q") - error)).alias("within_bound"))


@query("b5_value_counts", W(SUBS_CTE, f"""
SELECT commitment AS value, count(*) AS n, {R('count(*) / sum(count(*)) OVER ()')} AS share,
       row_number() OVER (ORDER BY count(*) DESC, commitment) AS freq_rank
FROM subs WHERE commitment IS NOT NULL GROUP BY commitment"""))
def b5_value_counts(spark, d):
    return P.value_counts(subs(spark, d), "commitment")


@query("b6_imbalance", W(SUBS_CTE, f"""
SELECT count(*) AS n, count(*) FILTER (WHERE churn = 'Yes') AS n_positive,
       {R("count(*) FILTER (WHERE churn = 'Yes') * 100.0 / count(*)")} AS positive_pct,
       (count(*) FILTER (WHERE churn = 'Yes') * 100.0 / count(*)) < 35 AS imbalanced
FROM subs"""))
def b6_imbalance(spark, d):
    return P.imbalance_check(subs(spark, d), SPEC)


# ------------------------------------------------------------ 2.3 data quality
def _c1_sql() -> str:
    parts = [f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
             f"{R(f'count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*)')} AS pct_null FROM subs_num"
             for c in SPEC.column_order]
    return W(SUBS_NUM_CTE, "SELECT * FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) WHERE n_null > 0")


@query("c1_nulls", _c1_sql())
def c1_nulls(spark, d):
    return P.null_report(subs_num(spark, d))


@query("c2_missing_pattern", W(SUBS_NUM_CTE, f"""
SELECT count(*) FILTER (WHERE total_spend IS NULL) AS n_missing,
       {R('avg(CAST(tenure AS DOUBLE)) FILTER (WHERE total_spend IS NULL)')} AS mean_tenure_when_missing
FROM subs_num"""))
def c2_missing_pattern(spark, d):
    return P.missing_pattern(subs_num(spark, d), "total_spend", "tenure")


@query("c3_duplicates", """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates, count(*) AS n_distinct_rows
FROM (SELECT text, count(*) AS n FROM documents GROUP BY text)""")
def c3_duplicates(spark, d):
    return P.duplicate_count(T.load(spark, d, "documents"), ["text"])


@query("c3_duplicates_rows", """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates, count(*) AS n_distinct_rows
FROM (SELECT event_id, ts, user_id, event_type, value, props, count(*) AS n FROM events GROUP BY ALL)""")
def c3_duplicates_rows(spark, d):
    """Whole rows, every column."""
    return P.duplicate_count(T.load(spark, d, "events"))


@query("c3_duplicates_events", """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates, count(*) AS n_distinct_rows
FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type)""")
def c3_duplicates_events(spark, d):
    return P.duplicate_count(T.load(spark, d, "events"), ["user_id", "event_type"])


# ------------------------------------------------------------- 2.4 explore
def _hist_sql(src: str, col: str, by: str | None, bins: int, density: bool = True, where: str = "") -> str:
    g = f"{by}, " if by else ""
    gsel = f"{by}" if by else "1"
    jn = f"USING ({by})" if by else "ON TRUE"
    w = f"WHERE {col} IS NOT NULL" + (f" AND {where}" if where else "")
    dens = (f", round(coalesce(c.n, 0) / (r._N * ((r._hi - r._lo) / {bins})), 12) + CAST(0.0 AS DOUBLE) AS density"
            if density else "")
    gsel_out = f"r.{by}, " if by else ""
    cjoin = f"c.{by} = r.{by} AND " if by else ""
    return f"""
data AS (SELECT {g}CAST({col} AS DOUBLE) AS _x FROM {src} {w}),
rng0 AS (SELECT {g}min(_x) AS _mn, max(_x) AS _mx, count(*) AS _N FROM data GROUP BY {gsel}),
rng AS (SELECT {g}_N, CASE WHEN _mn = _mx THEN _mn - 0.5 ELSE _mn END AS _lo,
               CASE WHEN _mn = _mx THEN _mx + 0.5 ELSE _mx END AS _hi FROM rng0),
cnt AS (SELECT {g}CAST(least(floor((d._x - r._lo) / (r._hi - r._lo) * {bins}), {bins - 1}) AS INTEGER) AS bin,
               count(*) AS n
        FROM data d JOIN rng r {jn} GROUP BY ALL)
SELECT {gsel_out}CAST(b.bin AS INTEGER) AS bin, {R(f'r._lo + b.bin * ((r._hi - r._lo) / {bins})')} AS bin_lo,
       {R(f'r._lo + (b.bin + 1) * ((r._hi - r._lo) / {bins})')} AS bin_hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n{dens}
FROM rng r CROSS JOIN (SELECT unnest(range(0, {bins})) AS bin) b
LEFT JOIN cnt c ON {cjoin}c.bin = b.bin"""


@query("e1_histogram", W(SUBS_CTE + "," + _hist_sql("subs", "monthly_spend", "churn", 30), ""))
def e1_histogram(spark, d):
    return E.histogram(subs(spark, d), "monthly_spend", by="churn", bins=S.FEATURE_BINS)


def with_null_group(df: DataFrame, col: str, value: str) -> DataFrame:
    """One value of a column set to null: input of the keys on null groups."""
    return df.withColumn(col, F.when(F.col(col) != value, F.col(col)))


def null_group_sql(sql: str, col: str) -> str:
    """A twin on rows whose null group is called '~none'; its result with the null."""
    return f"SELECT * REPLACE (nullif({col}, '~none') AS {col}) FROM (\n{sql}\n)"


_NO_ASIA = SUBS_NUM_CTE + """,
odd AS (SELECT * REPLACE (CASE WHEN region = 'ASIA' OR region IS NULL THEN '~none' ELSE region END AS region) FROM subs_num)"""


@query("e1_histogram_null_group", null_group_sql(W(_NO_ASIA + "," + _hist_sql("odd", "monthly_spend", "region", 30), ""), "region"))
def e1_histogram_null_group(spark, d):
    """A null region has its own range and bins."""
    return E.histogram(with_null_group(subs_num(spark, d), "region", "ASIA"), "monthly_spend", by="region", bins=S.FEATURE_BINS)


@query("e2_box_null_group", null_group_sql(W(_NO_ASIA + """,
q AS (SELECT region, quantile_cont(total_spend, 0.25) AS q1, quantile_cont(total_spend, 0.5) AS median,
             quantile_cont(total_spend, 0.75) AS q3 FROM odd WHERE total_spend IS NOT NULL GROUP BY region)""", f"""
SELECT q.region, {R('q.q1')} AS q1, {R('q.median')} AS median, {R('q.q3')} AS q3, {R('q.q3 - q.q1')} AS iqr,
       {R('min(s.total_spend) FILTER (WHERE s.total_spend >= q.q1 - 1.5 * (q.q3 - q.q1))')} AS whisker_low,
       {R('max(s.total_spend) FILTER (WHERE s.total_spend <= q.q3 + 1.5 * (q.q3 - q.q1))')} AS whisker_high,
       count(*) FILTER (WHERE s.total_spend < q.q1 - 1.5 * (q.q3 - q.q1)
                           OR s.total_spend > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers
FROM odd s JOIN q ON s.region = q.region WHERE s.total_spend IS NOT NULL
GROUP BY q.region, q.q1, q.median, q.q3"""), "region"))
def e2_box_null_group(spark, d):
    """A null region has its own quartiles."""
    return E.box_stats(with_null_group(subs_num(spark, d), "region", "ASIA"), "total_spend", "region")


@query("e2_box_stats", W(SUBS_NUM_CTE + """,
q AS (SELECT churn, quantile_cont(total_spend, 0.25) AS q1, quantile_cont(total_spend, 0.5) AS median,
             quantile_cont(total_spend, 0.75) AS q3 FROM subs_num WHERE total_spend IS NOT NULL GROUP BY churn)""", f"""
SELECT q.churn, {R('q.q1')} AS q1, {R('q.median')} AS median, {R('q.q3')} AS q3, {R('q.q3 - q.q1')} AS iqr,
       {R('min(s.total_spend) FILTER (WHERE s.total_spend >= q.q1 - 1.5 * (q.q3 - q.q1))')} AS whisker_low,
       {R('max(s.total_spend) FILTER (WHERE s.total_spend <= q.q3 + 1.5 * (q.q3 - q.q1))')} AS whisker_high,
       count(*) FILTER (WHERE s.total_spend < q.q1 - 1.5 * (q.q3 - q.q1)
                           OR s.total_spend > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers
FROM subs_num s JOIN q ON s.churn = q.churn WHERE s.total_spend IS NOT NULL
GROUP BY q.churn, q.q1, q.median, q.q3"""))
def e2_box_stats(spark, d):
    return E.box_stats(subs_num(spark, d), "total_spend", "churn")


def _e3_sql() -> str:
    parts = []
    for c in _NUM + ("high_balance",):
        mn, mp = f"avg(CAST({c} AS DOUBLE)) FILTER (WHERE churn <> 'Yes' OR churn IS NULL)", \
                 f"avg(CAST({c} AS DOUBLE)) FILTER (WHERE churn = 'Yes')"
        diff = f"(({mp}) - ({mn})) / nullif({mn}, 0) * 100.0"
        parts.append(f"SELECT '{c}' AS column, {R(mn)} AS mean_neg, {R(mp)} AS mean_pos, {R(diff)} AS diff_pct, "
                     f"CASE WHEN {diff} > 0 THEN 'higher' WHEN {diff} < 0 THEN 'lower' ELSE 'equal' END AS direction "
                     f"FROM subs_num")
    return W(SUBS_NUM_CTE, "\nUNION ALL\n".join(parts))


@query("e3_class_contrast", _e3_sql())
def e3_class_contrast(spark, d):
    return E.class_mean_contrast(subs_num(spark, d), SPEC, _NUM + ("high_balance",))


_E4_CTE = SUBS_CTE + """,
long AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, CAST(churn = 'Yes' AS INTEGER) AS y FROM subs"
    for c in S.SUBS_CATEGORY_FEATURES) + """),
ov AS (SELECT sum(CAST(churn = 'Yes' AS INTEGER)) * 100.0 / count(*) AS o FROM subs),
g AS (SELECT feature, value, count(*) AS n, sum(y) * 100.0 / count(*) AS rate
      FROM long WHERE value IS NOT NULL GROUP BY 1, 2)"""


def _e4_sql() -> str:
    return W(_E4_CTE, f"""
SELECT feature, value, n, {R('rate')} AS churn_rate, {R('o')} AS overall_rate,
       CASE WHEN rate > 40 THEN 'high' WHEN rate > 25 THEN 'mid' ELSE 'low' END AS band,
       row_number() OVER (PARTITION BY feature ORDER BY rate, value) AS rate_order
FROM g, ov""")


@query("e4_target_rate", _e4_sql())
def e4_target_rate(spark, d):
    return E.target_rate_by(subs(spark, d), SPEC, S.SUBS_CATEGORY_FEATURES)


@query("e5_spread", W(_E4_CTE + f""",
e4 AS (SELECT feature, value, rate AS churn_rate FROM g),
mx AS (SELECT feature, value, churn_rate, row_number() OVER (PARTITION BY feature ORDER BY churn_rate DESC, value) AS k
       FROM e4),
mn AS (SELECT feature, value, churn_rate, row_number() OVER (PARTITION BY feature ORDER BY churn_rate, value) AS k
       FROM e4)""", f"""
SELECT mx.feature, mx.value AS max_value, {R('mx.churn_rate')} AS max_rate, mn.value AS min_value,
       {R('mn.churn_rate')} AS min_rate,
       {R('mx.churn_rate - mn.churn_rate')} AS spread
FROM mx JOIN mn ON mx.feature = mn.feature AND mx.k = 1 AND mn.k = 1
WHERE mx.churn_rate - mn.churn_rate > 20"""))
def e5_spread(spark, d):
    return E.category_spread(E.target_rate_by(subs(spark, d), SPEC, S.SUBS_CATEGORY_FEATURES), S.MIN_SPREAD)


@query("e6_dict_encode", W(SUBS_CTE, """
SELECT c_custkey, CASE commitment WHEN 'Low' THEN 0 WHEN 'Mid' THEN 1 WHEN 'High' THEN 2 END AS commitment_code,
       CASE urgent_user WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No orders' THEN 0 END AS urgent_code
FROM subs"""))
def e6_dict_encode(spark, d):
    return subs(spark, d).select(
        "c_custkey",
        E.dict_encode("commitment", {"Low": 0, "Mid": 1, "High": 2}).alias("commitment_code"),
        E.dict_encode("urgent_user", {"Yes": 1, "No": 0, "No orders": 0}).alias("urgent_code"))


_CORR_COLS = ("tenure", "total_spend", "monthly_spend", "high_balance", "in_debt", "commitment",
              "urgent_user", "bulk_buyer", "churn_bin")


def _corr_frame(spark, d):
    s = subs_num(spark, d)
    return s.select(
        F.col("tenure").cast("double").alias("tenure"), "total_spend", "monthly_spend",
        F.col("high_balance").cast("double").alias("high_balance"),
        E.dict_encode("in_debt", {"Yes": 1, "No": 0}).alias("in_debt"),
        E.dict_encode("commitment", {"Low": 0, "Mid": 1, "High": 2}).alias("commitment"),
        E.dict_encode("urgent_user", {"Yes": 1, "No": 0, "No orders": 0}).alias("urgent_user"),
        E.dict_encode("bulk_buyer", {"Yes": 1, "No": 0, "No orders": 0}).alias("bulk_buyer"),
        F.col("churn").eqNullSafe("Yes").cast("int").alias("churn_bin"))


_CORR_CTE = SUBS_NUM_CTE + """,
cf AS (
  SELECT CAST(tenure AS DOUBLE) AS tenure, total_spend, monthly_spend, CAST(high_balance AS DOUBLE) AS high_balance,
         CASE in_debt WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS in_debt,
         CASE commitment WHEN 'Low' THEN 0 WHEN 'Mid' THEN 1 WHEN 'High' THEN 2 END AS commitment,
         CASE urgent_user WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No orders' THEN 0 END AS urgent_user,
         CASE bulk_buyer WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No orders' THEN 0 END AS bulk_buyer,
         CAST(coalesce(churn = 'Yes', false) AS INTEGER) AS churn_bin
  FROM subs_num
)"""


def _pair_r(a: str, b: str) -> str:
    xa = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
    xb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
    return f"covar_pop({xa}, {xb}) / nullif(stddev_pop({xa}) * stddev_pop({xb}), 0)"


def _e7_sql() -> str:
    parts = []
    for i, a in enumerate(_CORR_COLS):
        for j, b in enumerate(_CORR_COLS):
            if j < i:
                parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {R(_pair_r(a, b))} AS r FROM cf")
    return W(_CORR_CTE, "\nUNION ALL\n".join(parts))


@query("e7_corr_matrix", _e7_sql())
def e7_corr_matrix(spark, d):
    return E.correlation_matrix(_corr_frame(spark, d), _CORR_COLS)


@query("e8_target_corr", W(_CORR_CTE + ",\nt AS (" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS feature, {_pair_r('churn_bin', a)} AS r FROM cf" for a in _CORR_COLS[:-1]) + ")", f"""
SELECT feature, {R('r')} AS r, CASE WHEN r > 0 THEN '+' WHEN r < 0 THEN '-' ELSE '0' END AS sign,
       CAST(row_number() OVER (ORDER BY abs(r) DESC NULLS LAST, feature) AS INTEGER) AS abs_rank
FROM t"""))
def e8_target_corr(spark, d):
    return E.target_correlation(_corr_frame(spark, d), _CORR_COLS[:-1], "churn_bin")


@query("e9_cut", W(SUBS_CTE, """
SELECT c_custkey, tenure,
       CASE WHEN tenure > 0 AND tenure <= 48 THEN '0-48' WHEN tenure > 48 AND tenure <= 60 THEN '49-60'
            WHEN tenure > 60 AND tenure <= 72 THEN '61-72' END AS tenure_group
FROM subs"""))
def e9_cut(spark, d):
    return subs(spark, d).select("c_custkey", "tenure",
                                 cut("tenure", S.SUBS_TENURE_EDGES, S.SUBS_TENURE_LABELS).alias("tenure_group"))


@query("e10_segments", W(SUBS_CTE + """,
seg AS (SELECT CASE WHEN tenure > 0 AND tenure <= 48 THEN 0 WHEN tenure > 48 AND tenure <= 60 THEN 1
                    WHEN tenure > 60 AND tenure <= 72 THEN 2 END AS segment_order,
               CASE WHEN tenure > 0 AND tenure <= 48 THEN '0-48' WHEN tenure > 48 AND tenure <= 60 THEN '49-60'
                    WHEN tenure > 60 AND tenure <= 72 THEN '61-72' END AS segment,
               CAST(churn = 'Yes' AS INTEGER) AS y FROM subs),
g AS (SELECT segment_order, segment, count(*) AS n, sum(y) * 100.0 / count(*) AS rate
      FROM seg WHERE segment_order IS NOT NULL GROUP BY 1, 2)""", f"""
SELECT segment_order, segment, n, {R('rate')} AS churn_rate,
       CASE WHEN rate > 35 THEN 'high' WHEN rate > 20 THEN 'mid' ELSE 'low' END AS band, rate > 40 AS alert
FROM g"""))
def e10_segments(spark, d):
    return E.segment_rate(subs(spark, d), SPEC, "tenure", S.SUBS_TENURE_EDGES, S.SUBS_TENURE_LABELS)

