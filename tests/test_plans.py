"""Plan checks: column pruning and join elimination reach the parquet scans."""

import re

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_customer_only_report_skips_orders(spark):
    plan = _plan(entry.queries()["d4_binary"](spark, SF))
    assert "orders.parquet" not in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", entry.queries()["d4_binary"](spark, SF)
                         ._jdf.queryExecution().executedPlan().toString())
    assert all("c_comment" not in s and "c_name" not in s for s in schemas)


def test_orders_scan_reads_only_needed_columns(spark):
    df = entry.queries()["b6_imbalance"](spark, SF)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan parquet" in line and "o_custkey" in line]
    assert scans, "orders must be read"
    for line in scans:
        cols = re.search(r"FileScan parquet \[([^\]]*)\]", line).group(1)
        assert "o_orderkey" not in cols and "o_orderstatus" not in cols


def test_flagship_has_no_python_or_cartesian(spark):
    plan = _plan(entry.entry(spark))
    for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_correlations_take_one_scan(spark, tmp_path):
    from churnlab.operators import explore as E
    path = str(tmp_path / "t")
    cols = [f"c{i}" for i in range(8)]
    spark.range(50).selectExpr(*[f"cast(id * {i + 1} % 7 as double) as {c}" for i, c in enumerate(cols)]).write.parquet(path)
    df = spark.read.parquet(path)
    matrix = E.correlation_matrix(df, cols)
    assert matrix.count() == 28 and _plan(matrix).count("FileScan parquet") == 1
    assert _plan(E.target_correlation(df, cols[1:], "c0")).count("FileScan parquet") == 1
