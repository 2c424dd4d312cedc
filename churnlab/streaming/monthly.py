"""Structured Streaming operators.

New monthly deliveries arrive as files in a landing folder.  Each stream
uses a checkpoint below the shared checkpoint folder, so a restarted query
picks up exactly the files it has not committed yet.

Sinks are ledgers (:mod:`churnlab.sources.ledger`): what is in a sink is known
by source file, not by micro-batch.  A month may arrive in any number of files
and micro-batches; a replayed micro-batch, a lost checkpoint and another batch
size add nothing twice.  Replacing a month is a statement of the sender, not a
side effect: a month that is delivered again lies under a ``delivery_N``
folder, and reading takes each month from its highest delivery.  Files without
such a folder are delivery 0.  A file rewritten under its path replaces its rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnlab.sources.ledger import FILE, PLACE, Ledger, file_key, latest, place_columns
from churnlab.sources.tables import month_of_path

#: The column that tells a row's source file, hence its delivery; transforms must keep it.
DELIVERY = FILE
ENTRY = (("_month", "bigint"), ("_delivery", "bigint"))


def _overwrite_partitions(df: DataFrame, path: str, *partition_cols: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def _file_source(spark: SparkSession, landing: str, schema: StructType | str, fmt: str,
                 max_files_per_trigger: int | None) -> DataFrame:
    """Landed rows with the place of their file; :func:`_described` tells the rest once per file."""
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true")
    if fmt == "csv":
        reader = (reader.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
                  .option("ignoreTrailingWhiteSpace", "false"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing).select("*", *place_columns())


def _described(files: DataFrame) -> DataFrame:
    """Files with their key, month and delivery."""
    path = F.col("_path")
    delivery = F.coalesce(F.regexp_extract(path, r"^.*delivery_(\d+)", 1).try_cast("bigint"), F.lit(0))
    return files.select("*", file_key(*map(F.col, PLACE)), month_of_path(path).cast("bigint").alias("_month"),
                        delivery.cast("bigint").alias("_delivery"))


def _last_of_month(entries: DataFrame) -> DataFrame:
    """The files of each month's highest delivery; without a month, of the highest of those."""
    files = latest(entries)
    last = files.groupBy(F.col("_month").alias("_m")).agg(F.max("_delivery").alias("_last"))
    return files.join(last, F.col("_month").eqNullSafe(F.col("_m")) & (F.col("_delivery") == F.col("_last")))


def _into_ledger(src: DataFrame, ledger: Ledger, checkpoint: str, make: Callable[[DataFrame], DataFrame],
                 partition_by: tuple[str, ...] = ()) -> StructType:
    """Run ``src`` to its end, ``make`` of every micro-batch (its rows with ``batch_month`` and
    the key of their file) into the ledger; the rows' schema."""
    data = [c for c in src.columns if c not in PLACE]

    def put(batch: DataFrame, batch_id: int) -> None:
        ledger.add(batch, lambda rows: make(rows.select(*data, F.col("_month").alias("batch_month"), FILE)), partition_by, _described)

    q = (src.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return make(src.select(*data, F.lit(None).cast("bigint").alias("batch_month"), F.lit(None).cast("string").alias(FILE))).schema


def last_deliveries(spark: SparkSession, sink: str, schema: StructType) -> DataFrame:
    """The sink as a batch table: each month from its highest delivery.  The
    deliveries are known from the ledger alone."""
    rows = Ledger(spark, sink, ENTRY).rows(schema, _last_of_month)
    return rows.select(*[c for c in schema.names if c != DELIVERY])


def stream_batches(spark: SparkSession, landing: str, schema: StructType | str, sink: str, checkpoint: str,
                   fmt: str = "parquet", month_col: str = "batch_month", max_files_per_trigger: int | None = None,
                   transform=None) -> DataFrame:
    """Ingest every month file once (Trigger.AvailableNow).  The month
    comes from the last ``month_MM`` of the file path, the delivery from the
    last ``delivery_N`` (0 without).  However the files are spread over
    micro-batches and checkpoints, every row of a month's last delivery is in
    the sink once.  Returns the sink as a batch table."""
    src = _file_source(spark, landing, schema, fmt, max_files_per_trigger)

    def make(rows):
        rows = rows if month_col == "batch_month" else rows.withColumnRenamed("batch_month", month_col)
        return rows if transform is None else transform(rows)

    stored = _into_ledger(src, Ledger(spark, sink, ENTRY), checkpoint, make, (month_col,))
    return last_deliveries(spark, sink, stored)


def compact_batches(spark: SparkSession, sink: str, schema: StructType, month_col: str = "batch_month",
                    key: str | None = None) -> int:
    """Rewrite a sink of S1 or S3 (``schema`` as stored, with ``DELIVERY``) as
    one part without replaced rows, within months sorted by ``key``."""
    return Ledger(spark, sink, ENTRY).compact(schema, (month_col,), [month_col, *([key] if key else [])], _last_of_month)


def utc_instant(c: Column) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP, reading the wall clock as UTC whatever the
    session time zone is (watermarks need TIMESTAMP; a plain cast would go
    through the session zone)."""
    secs = F.date_format(c, "ss.SSSSSS").cast("decimal(8,6)")
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), secs, F.lit("UTC"))


def utc_label(ts: Column) -> Column:
    """'yyyy-MM-dd HH:mm' of an instant in UTC, by date arithmetic on epoch
    seconds (no session-zone formatting)."""
    s = F.unix_seconds(ts)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(s / 86400).cast("int")).cast("string")
    hm = F.format_string("%02d:%02d", F.floor(F.pmod(s, F.lit(86400)) / 3600).cast("int"),
                         F.floor(F.pmod(s, F.lit(3600)) / 60).cast("int"))
    return F.concat_ws(" ", day, hm)


def window_rates(events: DataFrame, ts_col: str, flag: Column, window: str = "1 day",
                 watermark: str = "1 hour") -> DataFrame:
    """S2 plan: per tumbling event-time window the number of rows, flagged
    rows and their rate.  Rows later than the watermark are dropped."""
    c = F.col(ts_col)
    ts = utc_instant(c) if events.schema[ts_col].dataType.typeName() == "timestamp_ntz" else c
    e = events.withColumn("_ts", ts).withWatermark("_ts", watermark)
    g = e.groupBy(F.window("_ts", window).alias("w")).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(flag).alias("n_flagged"))
    return g.select(utc_label(F.col("w.start")).alias("window_start"), "n_events",
                    "n_flagged", (F.round(F.col("n_flagged") / F.col("n_events"), 6) + F.lit(0.0)).alias("rate"))


def stream_window_rates(spark: SparkSession, landing: str, schema: StructType | str, sink: str, checkpoint: str,
                        ts_col: str, flag: Column, window: str = "1 day", watermark: str = "1 hour",
                        max_files_per_trigger: int | None = None, state_partitions: int = 16) -> DataFrame:
    """Windowed rates from a file stream in update mode; each micro-batch
    upserts the windows it changed (partition overwrite keyed by window),
    so the sink always holds the latest value of every window.

    The source must deliver files in event-time order up to the watermark:
    files are taken oldest first, and rows older than the watermark of the
    micro-batches before are dropped.  :func:`dropped_rows` counts them.

    The state is one row per window and the input is partially aggregated
    before the shuffle, so a few state partitions suffice at any input
    volume; the number is fixed when the query first starts (it is stored
    in the checkpoint), not taken from the batch-sized shuffle setting."""
    reader = spark.readStream.format("parquet").schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rates = window_rates(reader.load(landing), ts_col, flag, window, watermark)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        _overwrite_partitions(batch, sink, "window_start")

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))  # captured by the stream at start
    try:
        q = (rates.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    finally:
        spark.conf.set(key, before)
    q.awaitTermination()
    return spark.read.schema(rates.schema).parquet(sink)


def dropped_rows(landed: DataFrame, rates: DataFrame) -> DataFrame:
    """One row: rows landed, rows counted in windows, and rows that the
    watermark dropped (rows without a time are not counted as landed)."""
    n = rates.agg(F.coalesce(F.sum("n_events"), F.lit(0)).alias("counted"))
    return landed.agg(F.count(F.lit(1)).alias("landed")).select(
        "landed", n.scalar().alias("counted"), (F.col("landed") - n.scalar()).alias("dropped"))


# --------------------------------------------------- windowed rates, late rows
DELTA = "window_start string, n_events bigint, n_flagged bigint"


def stream_window_deltas(spark: SparkSession, landing: str, schema: StructType | str, sink: str, checkpoint: str,
                         ts_col: str, flag: Column, window: str = "1 day", fmt: str = "parquet",
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """S2 without a watermark: windowed rates that late rows correct.

    A micro-batch leaves what its files add to each window, one delta per (file,
    window), in a ledger; the rates are sums over the deltas of the files that
    count.  There is no state and nothing is late: files may come in any order,
    in any number of micro-batches, and a file that is rewritten replaces its
    deltas.  Rows without a time belong to no window.  Returns the rates.

    Only the time and the flag are read.  Windows of times without a zone are cut
    on the wall clock, which is that of UTC; their starts alone become instants.
    """
    src = _file_source(spark, landing, schema, fmt, max_files_per_trigger)
    src = src.select(F.col(ts_col).alias("_ts"), flag.alias("_flagged"), *PLACE)
    start = F.col("w.start")
    start = utc_instant(start) if src.schema["_ts"].dataType.typeName() == "timestamp_ntz" else start

    def make(rows):
        return rows.where("_ts is not null").groupBy(FILE, F.window("_ts", window).alias("w")).agg(
            F.count(F.lit(1)).alias("n_events"), F.count_if("_flagged").alias("n_flagged")).select(
            utc_label(start).alias("window_start"), "n_events", "n_flagged", FILE)

    _into_ledger(src, Ledger(spark, sink, ENTRY), checkpoint, make)
    return window_totals(spark, sink)


def window_totals(spark: SparkSession, sink: str) -> DataFrame:
    """The rates that the deltas add up to."""
    stored = StructType.fromDDL(f"{DELTA}, {FILE} string")
    deltas = Ledger(spark, sink, ENTRY).rows(stored)
    sums = deltas.groupBy("window_start").agg(F.sum("n_events").alias("n_events"), F.sum("n_flagged").alias("n_flagged"))
    return sums.select("*", (F.round(F.col("n_flagged") / F.col("n_events"), 6) + F.lit(0.0)).alias("rate"))


def compact_deltas(spark: SparkSession, sink: str) -> int:
    """Rewrite the deltas that count as one part sorted by window."""
    stored = StructType.fromDDL(f"{DELTA}, {FILE} string")
    return Ledger(spark, sink, ENTRY).compact(stored, sort_by=["window_start"])


def stream_score(spark: SparkSession, landing: str, schema: StructType | str, sink: str, checkpoint: str,
                 score_fn, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """S3: stateless preparation + scoring of every delivered row, into the
    same kind of sink as S1: a month that is delivered again replaces its
    earlier scores instead of adding to them.

    ``score_fn`` is called for every micro-batch, so what it looks up (the
    model in force, say) may change between micro-batches; its columns may not.
    """
    src = _file_source(spark, landing, schema, fmt, max_files_per_trigger)

    def make(rows):
        scored = score_fn(rows)
        if DELIVERY not in scored.columns or "batch_month" not in scored.columns:
            raise ValueError(f"score_fn must keep {DELIVERY} and batch_month")
        return scored

    stored = _into_ledger(src, Ledger(spark, sink, ENTRY), checkpoint, make, ("batch_month",))
    return last_deliveries(spark, sink, stored)
