"""Streaming: stream = batch, restart adds nothing, late rows are dropped."""

import datetime as dt

from pyspark.sql import functions as F

from churnlab.session import work_path
from churnlab.sources import tables as T
from churnlab.streaming import monthly as ST


def test_stream_ingest_is_idempotent_on_restart(spark):
    df = spark.createDataFrame([(i, "Yes" if i % 3 else "No", i % 4 + 1) for i in range(40)],
                               "c_custkey bigint, churn string, batch_month bigint")
    landing = T.write_batch_files(df, work_path(spark, "t-landing"), "batch_month", fmt="parquet")
    sink, ckpt = work_path(spark, "t-sink"), work_path(spark, "t-ckpt")
    out = ST.stream_batches(spark, landing, "c_custkey bigint, churn string", sink, ckpt)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.select(*out.columns).collect()))
    again = ST.stream_batches(spark, landing, "c_custkey bigint, churn string", sink, ckpt)
    assert again.count() == 40


def test_window_rates_drop_late_rows(spark):
    schema = "ts timestamp_ntz, kind string"
    base = dt.datetime(2024, 1, 1)
    landing = work_path(spark, "t-events")
    first = [(base + dt.timedelta(days=d, hours=1), "error" if d % 2 else "ok") for d in range(3)]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(landing)
    sink, ckpt = work_path(spark, "t-wsink"), work_path(spark, "t-wckpt")
    ST.stream_window_rates(spark, landing, schema, sink, ckpt, "ts", F.col("kind") == "error")
    # second delivery: one row for day 0, far behind the watermark -> dropped; one for day 2 -> counted
    late = [(base + dt.timedelta(hours=5), "error"), (base + dt.timedelta(days=2, hours=3), "error")]
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(landing)
    out = {r["window_start"]: r for r in
           ST.stream_window_rates(spark, landing, schema, sink, ckpt, "ts", F.col("kind") == "error").collect()}
    assert out["2024-01-01 00:00"]["n_events"] == 1
    assert out["2024-01-03 00:00"]["n_events"] == 2


def test_window_rates_do_not_depend_on_session_zone(spark):
    rows = [(dt.datetime(2024, 1, 1, 23, 30), "error"), (dt.datetime(2024, 1, 2, 0, 30), "ok"),
            (dt.datetime(2024, 1, 2, 12, 0), "error")]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, kind string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        out = {}
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            out[tz] = sorted(map(tuple, ST.window_rates(df, "ts", F.col("kind") == "error").collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert out["UTC"] == out["America/Los_Angeles"] == out["Asia/Kolkata"]
    assert out["UTC"][0][:3] == ("2024-01-01 00:00", 1, 1)


def test_stream_ingest_reads_csv_deliveries(spark):
    df = spark.createDataFrame([(i, " " if i % 5 == 0 else f"{i}.50", i % 3 + 1) for i in range(30)],
                               "c_custkey bigint, total_spend string, batch_month bigint")
    root = work_path(spark, "t-csv-landing")
    T.write_batch_files(df, root, "batch_month", fmt="csv")
    out = ST.stream_batches(spark, root, "c_custkey bigint, total_spend string", work_path(spark, "t-csv-sink"),
                            work_path(spark, "t-csv-ckpt"), fmt="csv")
    got = sorted(map(tuple, out.select("c_custkey", "total_spend", "batch_month").collect()))
    assert len(got) == 30 and {r[2] for r in got} == {1, 2, 3}
    assert got[0] == (0, " ", 1) and got[1] == (1, "1.50", 2)


def test_months_in_many_files_and_micro_batches_keep_every_row(spark):
    schema = "c_custkey bigint, churn string"
    rows = [(i, "Yes" if i % 3 else "No", i % 2 + 1) for i in range(40)]
    df = spark.createDataFrame(rows, schema + ", batch_month bigint")
    root = work_path(spark, "t-month_9-in")  # a folder above that looks like a month
    for m in (1, 2):
        df.where(F.col("batch_month") == m).drop("batch_month").repartition(4).write.parquet(f"{root}/month_{m:02d}")
    sink, ckpt = work_path(spark, "t-msink"), work_path(spark, "t-mckpt")
    out = ST.stream_batches(spark, root, schema, sink, ckpt, max_files_per_trigger=1)
    assert sorted(map(tuple, out.collect())) == rows
    # a further file of the same delivery adds to the month
    spark.createDataFrame([(100, "No")], schema).write.parquet(f"{root}/month_02/late")
    out = ST.stream_batches(spark, root, schema, sink, ckpt, max_files_per_trigger=1)
    assert out.count() == 41 and out.where("batch_month = 2").count() == 21
    # a higher delivery replaces the month
    spark.createDataFrame([(7, "No")], schema).write.parquet(f"{root}/delivery_1/month_02")
    out = ST.stream_batches(spark, root, schema, sink, ckpt, max_files_per_trigger=1)
    assert sorted(map(tuple, out.where("batch_month = 2").collect())) == [(7, "No", 2)]
    assert out.where("batch_month = 1").count() == 20


def test_scoring_a_redelivered_month_replaces_its_scores(spark):
    schema = "c_custkey bigint, x double"
    root = work_path(spark, "t-score-in")
    spark.createDataFrame([(i, float(i)) for i in range(10)], schema).write.parquet(f"{root}/month_01")
    sink, ckpt = work_path(spark, "t-ssink"), work_path(spark, "t-sckpt")

    def score(src):
        return src.select("c_custkey", "batch_month", ST.DELIVERY, (F.col("x") * 2).alias("score"))

    assert ST.stream_score(spark, root, schema, sink, ckpt, score).count() == 10
    spark.createDataFrame([(i, float(i + 1)) for i in range(10)], schema).write.parquet(f"{root}/delivery_1/month_01")
    again = ST.stream_score(spark, root, schema, sink, ckpt, score)
    assert sorted(r.score for r in again.collect()) == [2.0 * (i + 1) for i in range(10)]


def test_dropped_rows_are_reported(spark):
    schema = "ts timestamp_ntz, kind string"
    day = dt.datetime(2024, 1, 1)
    landing = work_path(spark, "t-late")
    for d in (0, 5, 6, 1):  # the last file is days behind the watermark
        spark.createDataFrame([(day + dt.timedelta(days=d), "ok")], schema).coalesce(1).write.mode("append").parquet(landing)
    rates = ST.stream_window_rates(spark, landing, schema, work_path(spark, "t-lsink"), work_path(spark, "t-lckpt"),
                                   "ts", F.col("kind") == "error", max_files_per_trigger=1)
    got = ST.dropped_rows(spark.read.parquet(landing), rates).first()
    assert (got.landed, got.counted, got.dropped) == (4, 3, 1)


def test_window_deltas_read_two_columns_and_compute_nothing_about_files_per_row(spark, monkeypatch):
    schema = "ts timestamp_ntz, kind string, note string"
    rows = [(dt.datetime(2024, 1, 1 + i % 3, 23, 59, 59, 999999), "error" if i % 2 else "ok", "n") for i in range(12)]
    landing = work_path(spark, "t-thin")
    spark.createDataFrame([*rows, (None, "error", "n")], schema).repartition(2).write.parquet(f"{landing}/delivery_1/month_02")
    seen, add = [], ST.Ledger.add

    def spied(self, batch, *args):
        seen.append((batch.columns, batch._jdf.queryExecution().toString()))
        return add(self, batch, *args)

    monkeypatch.setattr(ST.Ledger, "add", spied)
    sink = work_path(spark, "t-thin-sink")
    out = ST.stream_window_deltas(spark, landing, schema, sink, work_path(spark, "t-thin-ckpt"), "ts", F.col("kind") == "error")
    assert sorted((r.window_start, r.n_events, r.n_flagged) for r in out.collect()) == [
        ("2024-01-01 00:00", 4, 2), ("2024-01-02 00:00", 4, 2), ("2024-01-03 00:00", 4, 2)]
    assert [c for c, _ in seen] == [["_ts", "_flagged", "_path", "_length", "_modified"]]
    assert not any(f in plan for _, plan in seen for f in ("sha2", "regexp_extract"))
    entries = ST.Ledger(spark, sink, ST.ENTRY).entries().select("_month", "_delivery").collect()
    assert {tuple(r) for r in entries} == {(2, 1)}


def test_slices_of_time_land_in_several_files(spark, monkeypatch, tmp_path):
    from churnlab.plans import q_stream as Q
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(seconds=7 * i, microseconds=i), "error") for i in range(600)]
    spark.createDataFrame([*rows, (600, None, "error")], "event_id bigint, ts timestamp_ntz, event_type string").write.parquet(
        f"{tmp_path}/events.parquet")
    monkeypatch.setattr(Q, "LAND_ROWS", 50)
    _, landing, each = Q._land_in_order(spark, str(tmp_path), whole=False)
    landed = spark.read.parquet(landing)
    assert each == 2 and len(landed.inputFiles()) == 12
    span = (rows[-1][1] - rows[0][1]).seconds + 1
    slices = landed.select("event_id", F.input_file_name().alias("f")).collect()
    assert sorted(r.event_id for r in slices) == list(range(600))
    of = {}
    for r in slices:
        of.setdefault(r.f, set()).add(min(7 * r.event_id * 6 // span, 5))
    assert sorted(min(s) for s in of.values()) == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5] and all(len(s) == 1 for s in of.values())
    _, landing, each = Q._land_in_order(spark, str(tmp_path))
    assert each == 1 and len(spark.read.parquet(landing).inputFiles()) == 6
