"""Scans and sinks (A1, A3, A4) and the subscriber fixture over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnlab import spec as S


CORRUPT_COL = "_corrupt_record"


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               fmt: str = "parquet", header: bool = True, keep_corrupt: bool = False) -> DataFrame:
    """A1: typed scan.  CSV is read with a declared schema (no inference) in
    PERMISSIVE mode; a malformed line becomes nulls instead of failing the
    job, and with ``keep_corrupt`` its raw text is kept in ``_corrupt_record``
    so bad input can be reported rather than silently lost."""
    reader = spark.read.format(fmt)
    if schema is not None:
        if keep_corrupt and fmt == "csv":
            st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
            schema = st.add(CORRUPT_COL, "string")
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = (reader.option("header", str(header).lower()).option("mode", "PERMISSIVE")
                  .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))
        if keep_corrupt:
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    return reader.load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=(),
                mode: str = "overwrite") -> str:
    """A3: persist a table.  With ``partition_by`` only the partitions present
    in ``df`` are replaced (dynamic partition overwrite), so re-delivering one
    batch is idempotent."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        # keep blank text (' ') as written: it is data for the numeric coercion
        w = (w.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
             .option("ignoreTrailingWhiteSpace", "false"))
    w.save(path)
    return path


def write_batch_files(df: DataFrame, root: str, month_col: str, fmt: str = "csv") -> str:
    """Land one folder per month, named ``month_MM`` like monthly delivery files."""
    staged = df.withColumn("_month_dir", F.format_string("month_%02d", F.col(month_col).cast("int")))
    w = staged.drop(month_col).write.mode("overwrite").format(fmt).partitionBy("_month_dir")
    if fmt == "csv":
        w = (w.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
             .option("ignoreTrailingWhiteSpace", "false"))
    w.save(root)
    return root


def month_of_path(path: Column) -> Column:
    """The month of the last ``month_N`` in a path (folders above may match too); null without one."""
    return F.regexp_extract(path, r"^.*month_(\d+)", 1).try_cast("int")


def read_batches(spark: SparkSession, root: str, schema: StructType | str, fmt: str = "csv",
                 month_col: str = "batch_month") -> DataFrame:
    """A4: read every delivered month; the month comes from the file path
    (its last ``month_MM``), never from list position, so a gap does not shift months."""
    df = (spark.read.format(fmt).schema(schema).option("header", "true")
          .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
          .option("recursiveFileLookup", "true").load(root))
    return df.withColumn(month_col, month_of_path(F.col("_metadata.file_path")))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw customer table used by every churn operator.

    customer ⟕ (orders aggregated per customer) ⟕ nation ⟕ region.  Features
    use only orders before the snapshot date, the label only orders on or
    after it.  One conditional aggregation pass over orders (partial
    aggregation on ``o_custkey`` absorbs a customer holding many orders); the
    aggregate is already hash-partitioned on the key, so the join with
    customer shuffles customer only; nation and region are dimension tables
    that Spark broadcasts after its own size check.
    """
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate",
                                                  "o_orderpriority")
    snap = F.lit(S.SNAPSHOT).cast(orders.schema["o_orderdate"].dataType)
    pre = F.col("o_orderdate") < snap
    per_cust = orders.groupBy("o_custkey").agg(
        F.count_if(pre).alias("n_pre"),
        F.count_if(~pre).alias("n_post"),
        F.min(F.when(pre, F.col("o_orderdate"))).alias("first_pre"),
        F.sum(F.when(pre, F.col("o_totalprice").cast("decimal(18,2)"))).alias("spend_pre"),
        F.max(F.when(pre, (F.col("o_orderpriority") == "1-URGENT").cast("int"))).alias("any_urgent"),
        F.max(F.when(pre, (F.col("o_totalprice") >= S.BULK_ORDER).cast("int"))).alias("any_bulk"),
    )
    cust = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (cust.join(per_cust, cust.c_custkey == per_cust.o_custkey, "left")
         .join(nation, cust.c_nationkey == nation.n_nationkey, "left")
         .join(region, nation.n_regionkey == region.r_regionkey, "left"))
    n_pre = F.coalesce(F.col("n_pre"), F.lit(0))
    has_pre = n_pre > 0
    tenure = F.when(has_pre, (2000 - F.year("first_pre")) * 12 + 8 - F.month("first_pre")).otherwise(0)
    spend = F.col("spend_pre").cast("decimal(18,2)")
    low, high = S.COMMITMENT_CUTS

    def tri(flag):
        return F.when(~has_pre, "No orders").when(F.col(flag) == 1, "Yes").otherwise("No")

    return j.select(
        F.col("c_custkey"),
        F.when(F.coalesce(F.col("n_post"), F.lit(0)) > 0, "No").otherwise("Yes").alias("churn"),
        tenure.cast("int").alias("tenure"),
        F.when(has_pre, spend.cast("string")).otherwise(" ").alias("total_spend"),
        F.when(has_pre, spend.cast("double") / F.greatest(tenure, F.lit(1))).otherwise(0.0).alias("monthly_spend"),
        (F.col("c_acctbal") >= S.HIGH_BALANCE).cast("int").alias("high_balance"),
        F.when(F.col("c_acctbal") < 0, "Yes").otherwise("No").alias("in_debt"),
        F.when(n_pre < low, "Low").when(n_pre < high, "Mid").otherwise("High").alias("commitment"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("region"),
        tri("any_urgent").alias("urgent_user"),
        tri("any_bulk").alias("bulk_buyer"),
        (F.col("c_custkey") % S.N_BATCHES + 1).alias("batch_month"),
    )


def with_original(df: DataFrame) -> DataFrame:
    """Month 0, the original table, for three quarters of the customers (by
    blocks of six keys); the others are the monthly batches."""
    original = F.floor(F.col("c_custkey") / 6) % 4 != 0
    return df.withColumn("batch_month", F.when(original, F.lit(0).cast("bigint")).otherwise(F.col("batch_month")))


SUBS_SCHEMA = ("c_custkey bigint, churn string, tenure int, total_spend string, monthly_spend double, "
               "high_balance int, in_debt string, commitment string, segment string, region string, "
               "urgent_user string, bulk_buyer string, batch_month bigint")
