"""Registry entries for the streaming operators.

Each query lands the whole input table as files (the monthly deliveries),
runs the stream to completion with Trigger.AvailableNow and returns the
sink; the SQL twin is the equivalent batch query.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.functions.columns import r6
from churnlab.operators import drift as G
from churnlab.operators import metrics as M
from churnlab.operators import model as ML
from churnlab.operators import prepare as D
from churnlab.plans.q_evaluate import _risk_case, history_split
from churnlab.plans.registry import SPEC, SUBS_CTE, R, W, query, subs
from churnlab.plans.sql import SCORE_CTE
from churnlab.session import work_path
from churnlab.sources import tables as T
from churnlab.sources.models import ModelRegistry, input_columns
from churnlab.streaming import monthly as ST

_LANDED_SCHEMA = ", ".join(x for x in T.SUBS_SCHEMA.split(", ") if not x.startswith("batch_month"))


def _land_subs(spark, d) -> str:
    return T.write_batch_files(subs(spark, d), work_path(spark, "landing"), "batch_month", fmt="parquet")


@query("s1_stream_ingest", W(SUBS_CTE, "SELECT * FROM subs"))
def s1_stream_ingest(spark, d):
    landing = _land_subs(spark, d)
    out = ST.stream_batches(spark, landing, _LANDED_SCHEMA, work_path(spark, "s1-sink"),
                            work_path(spark, "s1-ckpt"))
    return out.select(*SPEC.column_order)


@query("s1_stream_recovery", W(SUBS_CTE, "SELECT * FROM subs"))
def s1_stream_recovery(spark, d):
    """Months in two files each, two of them delivered again.  The stream runs over a part of
    the files, loses its checkpoint, runs again with another batch size, the sink is compacted, and the stream
    loses its checkpoint once more: every row is there once."""
    landing = _land_twice(spark, d)
    sink = work_path(spark, "s1c-sink")
    for files in (5, 2):
        out = ST.stream_batches(spark, landing, _LANDED_SCHEMA, sink, work_path(spark, "s1c-ckpt"), max_files_per_trigger=files)
    ST.compact_batches(spark, sink, T.StructType.fromDDL(f"{T.SUBS_SCHEMA}, {ST.DELIVERY} string"), key="c_custkey")
    out = ST.stream_batches(spark, landing, _LANDED_SCHEMA, sink, work_path(spark, "s1c-ckpt"))
    return out.select(*SPEC.column_order)


def _deliver(df, root: str, delivery: int, files: int = 2) -> None:
    """Land ``files`` files for each month, one month after another."""
    for month in range(1, S.N_BATCHES + 1):
        (df.where(F.col("batch_month") == month).drop("batch_month").repartition(files, "c_custkey")
         .write.mode("append").parquet(f"{root}/delivery_{delivery}/month_{month:02d}"))


def _land_twice(spark, d) -> str:
    """All months in two files each; months 2 and 5 first with wrong rows, then again as delivery 2."""
    s = subs(spark, d).persist()
    root = work_path(spark, "landing-twice")
    again = F.col("batch_month").isin(2, 5)
    wrong = s.where(F.col("tenure") % 2 == 0).withColumn("churn", F.lit("Yes"))
    _deliver(s.where(~again).unionByName(wrong.where(again)), root, 1)
    for month in (2, 5):
        (s.where(F.col("batch_month") == month).drop("batch_month").repartition(2, "c_custkey")
         .write.parquet(f"{root}/delivery_2/month_{month:02d}"))
    s.unpersist()
    return root


@query("s1_stream_redelivery", W(SUBS_CTE, "SELECT * FROM subs"))
def s1_stream_redelivery(spark, d):
    """Two files a month, three files a micro-batch, two months delivered again:
    the stream stops after a first run and goes on from its checkpoint."""
    landing = _land_twice(spark, d)
    sink, ckpt = work_path(spark, "s1r-sink"), work_path(spark, "s1r-ckpt")
    for _ in range(2):
        out = ST.stream_batches(spark, landing, _LANDED_SCHEMA, sink, ckpt, max_files_per_trigger=3)
    return out.select(*SPEC.column_order)


@query("s2_stream_drift", W("x AS (SELECT 1)", f"""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS n_events,
       count(*) FILTER (WHERE event_type = 'error') AS n_flagged,
       {R("count(*) FILTER (WHERE event_type = 'error') / count(*)")} AS rate
FROM events GROUP BY 1"""))
def s2_stream_drift(spark, d):
    ev = T.load(spark, d, "events")
    landing = work_path(spark, "events-landing")
    ev.write.parquet(landing)
    out = ST.stream_window_rates(spark, landing, ev.schema, work_path(spark, "s2-sink"), work_path(spark, "s2-ckpt"),
                                 "ts", F.col("event_type") == "error")
    return out.select("window_start", "n_events", "n_flagged", "rate")


#: Events of a landed file, where several may make up a slice of time.
LAND_ROWS = 1_000_000


def _land_in_order(spark, d, files: int = 6, latest_first: bool = False, whole: bool = True):
    """The events in ``files`` slices of increasing time, landed one after another, each as one file or, unless
    ``whole``, as one file for every ``LAND_ROWS`` events of an average slice; and how many that is."""
    ev = T.load(spark, d, "events")
    first, last, n = ev.agg(F.min("ts"), F.max("ts"), F.count("ts")).select(
        *[F.unix_seconds(ST.utc_instant(F.col(c))).alias(c[:3]) for c in ("min(ts)", "max(ts)")], "count(ts)").first()
    span, each = last - first + 1, 1 if whole else max(1, -(-n // (files * LAND_ROWS)))
    # a slice's first second; times are held against whole seconds as they are stored
    edges = [F.lit(str(dt.datetime(1970, 1, 1) + dt.timedelta(seconds=first - (-i * span // files)))).cast("timestamp_ntz")
             for i in range(files)]
    landing = work_path(spark, "events-in-order")
    for i in sorted(range(files), reverse=latest_first):
        mine = (F.col("ts") >= edges[i]) & (F.col("ts") < edges[i + 1] if i + 1 < files else F.lit(True))
        ev.where(mine).repartition(each).write.mode("append").parquet(landing)
    return ev, landing, each


def _ordered_rates(spark, d):
    ev, landing, _ = _land_in_order(spark, d)
    return ev, ST.stream_window_rates(spark, landing, ev.schema, work_path(spark, "s2o-sink"),
                                      work_path(spark, "s2o-ckpt"), "ts", F.col("event_type") == "error",
                                      max_files_per_trigger=1)


@query("s2_stream_ordered", W("x AS (SELECT 1)", f"""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS n_events,
       count(*) FILTER (WHERE event_type = 'error') AS n_flagged,
       {R("count(*) FILTER (WHERE event_type = 'error') / count(*)")} AS rate
FROM events WHERE ts IS NOT NULL GROUP BY 1"""))
def s2_stream_ordered(spark, d):
    """One file a micro-batch, files in event-time order."""
    return _ordered_rates(spark, d)[1].select("window_start", "n_events", "n_flagged", "rate")


@query("s2_stream_deltas", W("x AS (SELECT 1)", f"""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS n_events,
       count(*) FILTER (WHERE event_type = 'error') AS n_flagged,
       {R("count(*) FILTER (WHERE event_type = 'error') / count(*)")} AS rate
FROM events WHERE ts IS NOT NULL GROUP BY 1"""))
def s2_stream_deltas(spark, d):
    """The latest events first, two slices a micro-batch, then compacted, then all again from a lost checkpoint."""
    ev, landing, each = _land_in_order(spark, d, latest_first=True, whole=False)
    sink, flag = work_path(spark, "s2d-sink"), F.col("event_type") == "error"
    ST.stream_window_deltas(spark, landing, ev.schema, sink, work_path(spark, "s2d-ckpt"), "ts", flag,
                            max_files_per_trigger=2 * each)
    ST.compact_deltas(spark, sink)
    return ST.stream_window_deltas(spark, landing, ev.schema, sink, work_path(spark, "s2d-ckpt"), "ts", flag)


@query("s2_stream_dropped", "SELECT count(*) AS landed, count(*) AS counted, CAST(0 AS BIGINT) AS dropped "
                            "FROM events WHERE ts IS NOT NULL")
def s2_stream_dropped(spark, d):
    """What the watermark drops when the files come in order: nothing."""
    ev, rates = _ordered_rates(spark, d)
    return ST.dropped_rows(ev.where(F.col("ts").isNotNull()), rates)


@query("s3_stream_score", W(SCORE_CTE, f"""
SELECT c_custkey, batch_month, {R('score')} AS score, pred, {_risk_case('score', False)} AS risk_level FROM pred"""))
def s3_stream_score(spark, d):
    return _scored(spark, d, _land_subs(spark, d))


@query("s3_stream_redelivery", W(SCORE_CTE, f"""
SELECT c_custkey, batch_month, {R('score')} AS score, pred, {_risk_case('score', False)} AS risk_level FROM pred"""))
def s3_stream_redelivery(spark, d):
    """Two months delivered twice, three files a micro-batch: every row has one score, of the last delivery."""
    return _scored(spark, d, _land_twice(spark, d), max_files_per_trigger=3)


def _scored(spark, d, landing, **options):
    cut = G.quantile_value(subs(spark, d), "monthly_spend", 0.75)  # fit-time constant
    card = G.subs_scorecard(cut)

    def score_fn(src):
        out = src.select("c_custkey", "batch_month", ST.DELIVERY, D.encode_target(SPEC).alias("label"),
                         card.score().alias("score"))
        return out.select("c_custkey", "batch_month", ST.DELIVERY, r6("score").alias("score"),
                          M.predict_at().alias("pred"), M.risk_level().alias("risk_level"))

    return ST.stream_score(spark, landing, _LANDED_SCHEMA, work_path(spark, "s3-sink"), work_path(spark, "s3-ckpt"),
                           score_fn, **options).select("c_custkey", "batch_month", "score", "pred", "risk_level")


@query("s3_stream_model", W(SUBS_CTE, """
SELECT c_custkey, batch_month, CAST(CASE WHEN batch_month <= 3 THEN 1 ELSE 2 END AS INTEGER) AS model_version,
       true AS scored_as_in_batch FROM subs"""))
def s3_stream_model(spark, d):
    """The stream scores by the model version in force: months 1 to 3 by the first, the others by the one
    deployed meanwhile; every score is that of the same version over the same rows at rest."""
    train, _ = history_split(spark, d)
    registry = ModelRegistry(spark, work_path(spark, "s3-registry"))
    inputs = input_columns(train, [SPEC.id_col, *SPEC.raw_features])
    landing = work_path(spark, "s3m-landing")
    sink, ckpt = work_path(spark, "s3m-sink"), work_path(spark, "s3m-ckpt")
    scorer = ML.current_scorer(registry, SPEC, ["batch_month", ST.DELIVERY])
    rows, at_rest = subs(spark, d), None
    for last, months in ((0, (1, 2, 3)), (S.N_BATCHES, (4, 5, 6))):
        prep, forest = ML.fit_models(train.where(F.col("batch_month") <= last), SPEC)
        version = registry.deploy(lambda place, p=prep, f=forest: ML.save_models(p, f, place, spark), inputs, {"month": last})
        mine = rows.where(F.col("batch_month").isin(*months))
        for month in months:
            mine.where(F.col("batch_month") == month).drop("batch_month").write.parquet(f"{landing}/month_{month:02d}")
        out = ST.stream_score(spark, landing, _LANDED_SCHEMA, sink, ckpt, scorer, max_files_per_trigger=2)
        batch = ML.predict(forest, prep.transform(mine)).select("c_custkey", F.col("score").alias("want"), F.lit(version.number).alias("v"))
        at_rest = batch if at_rest is None else at_rest.unionByName(batch)
    return out.join(at_rest, "c_custkey", "left").select(
        "c_custkey", "batch_month", "model_version",
        (F.col("score").eqNullSafe(F.col("want")) & (F.col("model_version") == F.col("v"))).alias("scored_as_in_batch"))
