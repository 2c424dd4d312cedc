"""The ledger of source files: each file's rows once, whatever happens to checkpoints, batches and commits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnlab.session import work_path
from churnlab.sources import ledger as L
from churnlab.streaming import monthly as ST

SCHEMA = "c_custkey bigint, churn string"


def land(spark, root, month, keys, name):
    path = f"{root}/month_{month:02d}/{name}"
    spark.createDataFrame([(k, "No") for k in keys], SCHEMA).coalesce(1).write.parquet(path)
    return path


def keys(df):
    return sorted(r.c_custkey for r in df.collect())


def test_lost_checkpoints_and_other_batch_sizes_add_nothing(spark):
    root, sink = work_path(spark, "l-in"), work_path(spark, "l-sink")
    for i in range(6):
        land(spark, root, i % 2 + 1, range(10 * i, 10 * i + 5), f"f{i}")
    want = sorted(k for i in range(6) for k in range(10 * i, 10 * i + 5))
    for files in (1, 4, None, 2):
        out = ST.stream_batches(spark, root, SCHEMA, sink, work_path(spark, "l-ckpt"), max_files_per_trigger=files)
        assert keys(out) == want
    land(spark, root, 2, [99], "late")
    out = ST.stream_batches(spark, root, SCHEMA, sink, work_path(spark, "l-ckpt"), max_files_per_trigger=3)
    assert keys(out) == sorted([*want, 99])


def test_compaction_keeps_rows_and_drops_replaced_ones(spark):
    root, sink = work_path(spark, "c-in"), work_path(spark, "c-sink")
    for i in range(4):
        land(spark, root, i % 2 + 1, range(10 * i, 10 * i + 5), f"f{i}")
    ckpt = work_path(spark, "c-ckpt")
    out = ST.stream_batches(spark, root, SCHEMA, sink, ckpt, max_files_per_trigger=1)
    land(spark, f"{root}/delivery_1", 2, [7], "f")
    out = ST.stream_batches(spark, root, SCHEMA, sink, ckpt)
    want = sorted([7, *range(5), *range(20, 25)])
    assert keys(out) == want
    book = L.Ledger(spark, sink, ST.ENTRY)
    assert book.unused() == []
    before = {r.part for r in book.entries().collect()}
    stored = out.schema.add(ST.DELIVERY, "string")
    ST.compact_batches(spark, sink, stored, key="c_custkey")
    assert keys(ST.last_deliveries(spark, sink, stored)) == want
    assert set(book.unused()) == before and len({r.part for r in book.entries().collect()}) == 1
    # what was replaced is not taken again, what is new is
    land(spark, root, 1, [50], "new")
    assert keys(ST.stream_batches(spark, root, SCHEMA, sink, work_path(spark, "c-ckpt"))) == sorted([*want, 50])


def test_a_failed_attempt_is_not_seen(spark):
    root, sink = work_path(spark, "a-in"), work_path(spark, "a-sink")
    land(spark, root, 1, range(5), "f")
    batch = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(root).select("*", *L.file_columns())
    book = L.Ledger(spark, sink)
    names = [c for c in book.names if c != L.FILE]

    class Lost(L.Ledger):
        def _publish(self, entries, name):
            raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError, match="driver lost"):
        Lost(spark, sink).add(batch, lambda rows: rows.drop(*names))
    stored = batch.drop(*names).schema
    assert book.rows(stored).count() == 0 and len(book.unused()) == 1
    assert book.add(batch, lambda rows: rows.drop(*names)) == 1
    assert keys(book.rows(stored)) == [0, 1, 2, 3, 4]
    assert book.add(batch, lambda rows: rows.drop(*names)) == 0


def test_two_writers_of_one_file(spark):
    """A commit that comes between reading the log and publishing makes the other start again."""
    root, sink = work_path(spark, "w-in"), work_path(spark, "w-sink")
    land(spark, root, 1, range(5), "f")
    land(spark, root, 1, range(10, 13), "g")
    batch = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(root).select("*", *L.file_columns())
    book = L.Ledger(spark, sink)
    names = [c for c in book.names if c != L.FILE]
    first = batch.where(F.col("_path").contains("/f/"))

    class Slow(L.Ledger):
        def _publish(self, entries, name):
            if name == f"{1:012d}" and not book._numbers()[0]:
                book.add(first, lambda rows: rows.drop(*names))
            super()._publish(entries, name)

    assert Slow(spark, sink).add(batch, lambda rows: rows.drop(*names)) == 2
    assert keys(book.rows(batch.drop(*names).schema)) == [0, 1, 2, 3, 4, 10, 11, 12]


def test_the_log_is_rolled_up(spark, monkeypatch):
    monkeypatch.setattr(L, "LOG_RUN", 3)
    root, sink = work_path(spark, "r-in"), work_path(spark, "r-sink")
    for i in range(7):
        land(spark, root, 1, [i], f"f{i}")
    out = ST.stream_batches(spark, root, SCHEMA, sink, work_path(spark, "r-ckpt"), max_files_per_trigger=1)
    assert keys(out) == list(range(7))
    assert L.Ledger(spark, sink, ST.ENTRY)._numbers() == (7, 6)


def test_a_rewritten_file_replaces_its_rows(spark):
    root, sink = work_path(spark, "x-in"), work_path(spark, "x-sink")
    path = land(spark, root, 1, range(5), "f")
    batch = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(path).select("*", *L.file_columns())
    book = L.Ledger(spark, sink)
    names = [c for c in book.names if c != L.FILE]
    book.add(batch, lambda rows: rows.drop(*names))
    later = F.col("_modified") + F.expr("interval 1 hour")
    again = batch.where("c_custkey < 2").withColumn("_modified", later).withColumn(
        L.FILE, F.substring(F.sha2(F.concat_ws("|", "_path", later.cast("string")), 256), 1, 32))
    book.add(again, lambda rows: rows.drop(*names))
    assert keys(book.rows(batch.drop(*names).schema)) == [0, 1]


def test_late_rows_correct_their_window(spark):
    schema = "ts timestamp_ntz, kind string"
    day, root = dt.datetime(2024, 1, 1), work_path(spark, "d-in")
    rows = {0: "ok", 9: "error", 5: "ok", 1: "error"}
    for d, kind in rows.items():
        spark.createDataFrame([(day + dt.timedelta(days=d), kind), (day + dt.timedelta(days=d % 2), "ok"), (None, "error")],
                              schema).coalesce(1).write.mode("append").parquet(root)
    sink, flag = work_path(spark, "d-sink"), F.col("kind") == "error"
    for files in (1, 3):
        got = ST.stream_window_deltas(spark, root, schema, sink, work_path(spark, "d-ckpt"), "ts", flag, max_files_per_trigger=files)
        assert sorted((r.window_start[:10], r.n_events, r.n_flagged) for r in got.collect()) == [
            ("2024-01-01", 2, 0), ("2024-01-02", 4, 1), ("2024-01-06", 1, 0), ("2024-01-10", 1, 1)]
        ST.compact_deltas(spark, sink)


def test_an_empty_landing(spark):
    root = work_path(spark, "e-in")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{root}/month_01")
    out = ST.stream_batches(spark, root, SCHEMA, work_path(spark, "e-sink"), work_path(spark, "e-ckpt"))
    assert out.collect() == [] and out.columns == ["c_custkey", "churn", "batch_month"]
