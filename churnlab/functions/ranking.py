"""Exact row numbers within groups, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from churnlab.functions.prefix import ordered_prefix


def group_row_number(df: DataFrame, group_cols: Sequence[str], order: Sequence[tuple[str, bool]],
                     name: str) -> DataFrame:
    """``name`` = 1-based position (bigint) of each row inside its group in
    ``order``, a list of (column, descending) pairs; descending only for
    numeric columns; rows must be unique in that order.

    Nulls come first in ascending and last in descending order.  The
    distributed prefix is used for every input: no group is ever sorted in
    one task, and the input is written once to the shared checkpoint folder.
    """
    keys, names = [], []
    for i, (c, desc) in enumerate(order):
        if not desc:
            names.append(c)
            continue
        if not isinstance(df.schema[c].dataType, NumericType):
            raise ValueError(f"descending order needs a numeric column, got {c}: {df.schema[c].dataType}")
        # ascending keys that put nulls last and the largest value first
        keys += [F.col(c).isNull().cast("int").alias(f"_null{i}"), (-F.col(c)).alias(f"_neg{i}")]
        names += [f"_null{i}", f"_neg{i}"]
    units = df.select("*", *keys, F.lit(1).cast("long").alias("_one"))
    pref = ordered_prefix(units, names, ["_one"], list(group_cols))
    return pref.select(*df.columns, (F.col("before__one") + 1).alias(name))
