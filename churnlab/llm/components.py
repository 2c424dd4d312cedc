"""Connected components by label passing with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the smallest node that
    links lead to.

    Every round each node takes the smallest label among its neighbours and
    itself, then the label of that label; the reach of a label doubles, so
    chains need a logarithmic number of rounds.  Labels are written to the
    shared folder each round; only the count of changes reaches the driver.
    """
    both = saved(links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                              .alias("e")).select("e.a", "e.b").distinct(), "links")
    labels = saved(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
                   .withColumnRenamed("a", "node"), "labels")
    while True:
        seen = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        hooked = labels.join(seen, F.col("node") == F.col("a")).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        hooked = saved(hooked, "hooked")
        target = hooked.select(F.col("node").alias("n2"), F.col("root").alias("r2"))
        jumped = hooked.join(target, F.col("root") == F.col("n2")).select(
            "node", F.least("root", "r2").alias("root"), (F.least("root", "r2") != F.col("old")).alias("moved"))
        jumped = saved(jumped, "labels")
        labels = jumped.select("node", "root")
        if jumped.where("moved").isEmpty():
            return labels
