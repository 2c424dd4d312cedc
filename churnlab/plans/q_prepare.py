"""Registry entries for the encoding gate (C4) and feature preparation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.functions.columns import r6
from churnlab.operators import prepare as D
from churnlab.operators import profile as P
from churnlab.operators import wide as X
from churnlab.plans.registry import NUM_RE, SPEC, SUBS_CTE, R, W, query, subs
from churnlab.plans.sql import ENC_CTE, RAW_SPLIT_CTE, SPLIT_CTE
from churnlab.session import materialize, work_path
from churnlab.sources import tables as T
from churnlab.streaming import monthly as ST

FEATURES = ("tenure", "total_spend", "monthly_spend", "high_balance", "in_debt", "commitment", "urgent_user",
            "bulk_buyer", "segment_AUTOMOBILE", "segment_BUILDING", "segment_FURNITURE", "segment_HOUSEHOLD",
            "segment_MACHINERY", "region_AFRICA", "region_AMERICA", "region_ASIA", "region_EUROPE",
            "region_MIDDLE_EAST")
NUMERIC = ("tenure", "total_spend", "monthly_spend")


def labelled(spark: SparkSession, d: str) -> DataFrame:
    return subs(spark, d).withColumn("label", D.encode_target(SPEC))


def split_subs(spark: SparkSession, d: str) -> DataFrame:
    """Raw subscriber rows + label + exact stratified ``split``, written once
    to the shared checkpoint folder: the fit steps (categories, scaler,
    forest) and the transform all read it instead of re-deriving it from
    the orders table, and the lineage is cut."""
    rows = materialize(labelled(spark, d), "subs")  # the split reads them three times
    return D.stratified_split(rows, "label", "c_custkey").checkpoint(eager=True)


def fitted(spark: SparkSession, d: str, scale_all: bool = False):
    """(split rows, preparation model fitted on the train rows only)."""
    sp = split_subs(spark, d)
    return sp, D.fit_prepare(sp.where(F.col("split") == "train"), SPEC, scale_all=scale_all)


def _scaled_sql(cols, select_extra: str) -> str:
    """Scale ``cols`` of the encoded split by train mean / population std (std 0 -> 1)."""
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    outs = []
    for c in FEATURES:
        if c in cols:
            outs.append(f"{R(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END')} AS {c}")
        else:
            outs.append(c)
    return W(SPLIT_CTE + f",\nst AS (SELECT {stats} FROM split WHERE split = 'train')",
             f"SELECT {select_extra}, {', '.join(outs)} FROM split, st")


def _r6_features(df: DataFrame, cols) -> DataFrame:
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# ----------------------------------------------------------------- C4
def _c4_sql() -> str:
    return W(SUBS_CTE, _gate_sql("subs", SPEC.column_order))


def _gate_sql(src: str, cols) -> str:
    """Columns with rows that are null or not a plain number, from the data."""
    parts = [f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL OR NOT "
             f"regexp_matches(trim(CAST({c} AS VARCHAR)), '{NUM_RE}')) AS n_bad FROM {src}" for c in cols]
    return "SELECT * FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) WHERE n_bad > 0"


@query("c4_encoding_gate", _c4_sql())
def c4_encoding_gate(spark, d):
    return P.encoding_gate(subs(spark, d), SPEC.column_order)


@query("c4_encoding_gate_encoded", W(SPLIT_CTE, _gate_sql("split", FEATURES)))
def c4_encoding_gate_encoded(spark, d):
    sp, model = fitted(spark, d)
    return P.encoding_gate(model.transform(sp), FEATURES)


# ----------------------------------------------------------------- D1-D8
@query("d1_project", W(SUBS_CTE, "SELECT * EXCLUDE (batch_month) FROM subs"))
def d1_project(spark, d):
    return D.drop_identifiers(subs(spark, d), SPEC)


@query("d2_fill", W(SUBS_CTE, f"""
SELECT c_custkey, coalesce(CASE WHEN regexp_matches(trim(total_spend), '{NUM_RE}')
                                THEN TRY_CAST(trim(total_spend) AS DOUBLE) END, 0.0) AS total_spend
FROM subs"""))
def d2_fill(spark, d):
    return D.fill_missing(subs(spark, d), ["total_spend"]).select("c_custkey", "total_spend")


@query("d3_target", W(SUBS_CTE, "SELECT c_custkey, CAST(coalesce(churn = 'Yes', false) AS INTEGER) AS label FROM subs"))
def d3_target(spark, d):
    return subs(spark, d).select("c_custkey", D.encode_target(SPEC).alias("label"))


@query("d4_binary", W(SUBS_CTE, "SELECT c_custkey, CAST(coalesce(in_debt = 'Yes', false) AS INTEGER) AS in_debt FROM subs"))
def d4_binary(spark, d):
    return subs(spark, d).select("c_custkey", D.encode_binary("in_debt", "Yes").alias("in_debt"))


@query("d4_binary_values", W(SUBS_CTE, """
SELECT 'in_debt' AS column, count(*) AS n_rows, count(*) FILTER (WHERE in_debt IS NULL) AS n_null,
       count(*) FILTER (WHERE in_debt NOT IN ('Yes', 'No')) AS n_other FROM subs
UNION ALL
SELECT 'urgent_user', count(*), count(*) FILTER (WHERE urgent_user IS NULL),
       count(*) FILTER (WHERE urgent_user NOT IN ('Yes', 'No')) FROM subs"""))
def d4_binary_values(spark, d):
    """Values of the yes/no columns; ``urgent_user`` has a third one."""
    return D.binary_values(subs(spark, d), {"in_debt": ("Yes", "No"), "urgent_user": ("Yes", "No")})


@query("d4_binary_unknown", W(SUBS_CTE, """
SELECT c_custkey, CASE urgent_user WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS urgent_user FROM subs"""))
def d4_binary_unknown(spark, d):
    """On new batches a value that is neither stays null."""
    return subs(spark, d).select("c_custkey", D.encode_binary("urgent_user", "Yes", "No", "null").alias("urgent_user"))


@query("d4_prepared_unknown", W(SUBS_CTE, """
SELECT c_custkey, CAST(CASE urgent_user WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS DOUBLE) AS urgent_user,
       CAST(CASE in_debt WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS DOUBLE) AS in_debt FROM subs"""))
def d4_prepared_unknown(spark, d):
    """A fitted preparation, saved and loaded, that keeps what it does not know apart."""
    spec = replace(SPEC, binary={"in_debt": "Yes", "urgent_user": "Yes"}, binary_negative={"in_debt": "No", "urgent_user": "No"},
                   tristate={"bulk_buyer": "Yes"})
    s = subs(spark, d)
    path = D.fit_prepare(s, spec, scale=(), handle_unknown="null").save(spark, work_path(spark, "d4-prepare"))
    return D.PrepareModel.load(spark, path, spec).encode(s).select("c_custkey", "urgent_user", "in_debt")


@query("d5_ordinal", W(SUBS_CTE, """
SELECT c_custkey, CASE commitment WHEN 'Low' THEN 0 WHEN 'Mid' THEN 1 WHEN 'High' THEN 2 ELSE 0 END AS commitment
FROM subs"""))
def d5_ordinal(spark, d):
    return subs(spark, d).select("c_custkey", D.encode_ordinal("commitment", SPEC.ordinal["commitment"])
                                 .alias("commitment"))


_ONE_HOT = [f for f in FEATURES if f.startswith(("segment_", "region_"))]


@query("d6_one_hot", W(ENC_CTE, f"SELECT c_custkey, {', '.join(_ONE_HOT)} FROM enc"))
def d6_one_hot(spark, d):
    s = subs(spark, d)
    cats = D.fit_one_hot(s, SPEC.nominal)
    return s.select("c_custkey", *D.one_hot_columns(cats))


@query("d6_sparse", W(SUBS_CTE + """,
cat AS (SELECT c, v, row_number() OVER (ORDER BY k, v) - 1 AS i FROM (
          SELECT DISTINCT 0 AS k, 'segment' AS c, segment AS v FROM subs WHERE segment IS NOT NULL
          UNION ALL SELECT DISTINCT 1, 'region', region FROM subs WHERE region IS NOT NULL))""", """
SELECT s.c_custkey, coalesce(string_agg(CAST(cat.i AS VARCHAR), ',' ORDER BY cat.i), '') AS indices
FROM subs s LEFT JOIN cat ON (cat.c = 'segment' AND cat.v = s.segment) OR (cat.c = 'region' AND cat.v = s.region)
GROUP BY s.c_custkey"""))
def d6_sparse(spark, d):
    """The indicators as sparse indices, for columns of any number of categories."""
    s = subs(spark, d)
    wide = D.encode_sparse(s, SPEC.nominal, D.category_table(s, SPEC.nominal), "c_custkey")
    return wide.select("c_custkey", F.array_join(F.transform("indices", lambda i: i.cast("string")), ",").alias("indices"))


_WIDE = ("total_spend", "segment")


@query("d6_wide_stream", W(RAW_SPLIT_CTE + "".join(f""",
w_{c} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (
  SELECT DISTINCT {c} AS v FROM split WHERE split = 'train' AND {c} IS NOT NULL))""" for c in _WIDE),
    "SELECT s.c_custkey, " + ", ".join(f"coalesce(w_{c}.i, (SELECT count(*) FROM w_{c})) AS {c}_index" for c in _WIDE)
    + " FROM split s " + " ".join(f"LEFT JOIN w_{c} ON w_{c}.v = s.{c}" for c in _WIDE)))
def d6_wide_stream(spark, d):
    """Wide columns (a category per amount spent): fitted on the train rows, saved, loaded and applied to
    the stream of monthly deliveries."""
    model = X.WideOneHot(_WIDE).fit(split_subs(spark, d).where(F.col("split") == "train"))
    path = work_path(spark, "d6-wide")
    model.save(path)
    loaded = X.WideOneHotModel.load(path)
    landing = T.write_batch_files(subs(spark, d), work_path(spark, "d6-landing"), "batch_month", fmt="parquet")
    schema = ", ".join(x for x in T.SUBS_SCHEMA.split(", ") if not x.startswith("batch_month"))
    out = ST.stream_batches(spark, landing, schema, work_path(spark, "d6-sink"), work_path(spark, "d6-ckpt"),
                            transform=loaded.transform, max_files_per_trigger=4)
    return out.select("c_custkey", *[F.col(c + X.INDEX).cast("long").alias(f"{c}_index") for c in _WIDE])


@query("d7_collapse", W(SUBS_CTE, """
SELECT c_custkey, CAST(coalesce(urgent_user = 'Yes', false) AS INTEGER) AS urgent_user,
       CAST(coalesce(bulk_buyer = 'Yes', false) AS INTEGER) AS bulk_buyer FROM subs"""))
def d7_collapse(spark, d):
    return subs(spark, d).select("c_custkey", D.collapse_service("urgent_user").alias("urgent_user"),
                                 D.collapse_service("bulk_buyer").alias("bulk_buyer"))


@query("d8_align", W(ENC_CTE, f"""
SELECT c_custkey, {', '.join('CAST(0.0 AS DOUBLE) AS region_ASIA' if f == 'region_ASIA' else f for f in FEATURES)}
FROM enc"""))
def d8_align(spark, d):
    """A batch whose encoding lacks one fitted category and carries an extra
    column is re-imposed on the model's feature list."""
    s = subs(spark, d)
    model = D.fit_prepare(s, SPEC, scale=())
    enc = model.encode(s).drop("region_ASIA", "label").withColumn("extra_col", F.lit(1.0))
    return D.align_to_schema(enc, model.feature_names, ["c_custkey"])


@query("d8_unseen", W(SUBS_CTE + """,
fit AS (SELECT * FROM subs WHERE batch_month <= 3),
new AS (SELECT * FROM subs WHERE batch_month > 3)""", """
SELECT 'segment' AS column, count(*) AS n_rows,
       count(*) FILTER (WHERE segment IS NOT NULL AND segment NOT IN (SELECT DISTINCT segment FROM fit
                                                                     WHERE segment IS NOT NULL)) AS n_unseen
FROM new
UNION ALL
SELECT 'region' AS column, count(*) AS n_rows,
       count(*) FILTER (WHERE region IS NOT NULL AND region NOT IN (SELECT DISTINCT region FROM fit
                                                                   WHERE region IS NOT NULL)) AS n_unseen
FROM new"""))
def d8_unseen(spark, d):
    """Categories fitted on the first three months, checked on the later ones."""
    s = subs(spark, d)
    cats = D.fit_one_hot(s.where(F.col("batch_month") <= 3), SPEC.nominal)
    return D.unseen_categories(s.where(F.col("batch_month") > 3), cats)


# ----------------------------------------------------------------- D9-D14
@query("d9_split", W(RAW_SPLIT_CTE, "SELECT c_custkey, label, split FROM split"))
def d9_split(spark, d):
    return split_subs(spark, d).select("c_custkey", "label", "split")


@query("d10_split_report", W(RAW_SPLIT_CTE, f"""
SELECT split, count(*) AS n, CAST(sum(label) AS BIGINT) AS n_positive, {R('avg(label) * 100.0')} AS positive_pct
FROM split GROUP BY split"""))
def d10_split_report(spark, d):
    return D.split_report(split_subs(spark, d), "label")


@query("d11_scale", _scaled_sql(NUMERIC, "c_custkey, split"))
def d11_scale(spark, d):
    sp, model = fitted(spark, d)
    out = model.transform(sp, keep=["split"])
    return _r6_features(out, NUMERIC).select("c_custkey", "split", *FEATURES)


@query("d12_scaling_report", W(SPLIT_CTE + ",\nst AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC) + " FROM split WHERE split = 'train'),\n"
    "sc AS (SELECT " + ", ".join(
        f"{c} AS b_{c}, ({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END AS a_{c}"
        for c in NUMERIC) + " FROM split, st WHERE split = 'train')", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, {R(f'avg(b_{c})')} AS mean_before, {R(f'stddev_samp(b_{c})')} AS std_before, "
    f"{R(f'avg(a_{c})')} AS mean_after, {R(f'stddev_samp(a_{c})')} AS std_after FROM sc" for c in NUMERIC)))
def d12_scaling_report(spark, d):
    sp, model = fitted(spark, d)
    train = sp.where(F.col("split") == "train")
    return D.scaling_report(model.encode(train), model.transform(train), NUMERIC)


@query("d13_scale_all", _scaled_sql(FEATURES, "c_custkey, split"))
def d13_scale_all(spark, d):
    sp, model = fitted(spark, d, scale_all=True)
    out = model.transform(sp, keep=["split"])
    return _r6_features(out, FEATURES).select("c_custkey", "split", *FEATURES)


@query("d14_prepare", _scaled_sql(NUMERIC, "c_custkey, label, split"))
def d14_prepare(spark, d):
    sp, model = fitted(spark, d)
    out = model.transform(sp, keep=["split"])
    return _r6_features(out, NUMERIC).select("c_custkey", "label", "split", *FEATURES)
