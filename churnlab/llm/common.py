"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.session import work_path

#: The white space that separates words: tab to carriage return, and space.
WORD_GAP = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: what follows reads files that every executor sees, so
    a lost executor costs the tasks it was running and nothing before them.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, replaced: Iterable[str] = ()) -> DataFrame:
    """All input columns in one struct ``row``, so that working columns cannot
    clash with them; columns named in ``replaced`` (any case) are left out."""
    out = {c.lower() for c in replaced}
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in out]
    return df.select(F.struct(*keep, F.lit(None).cast("int").alias("__pad")).alias("row"))


def unpacked(df: DataFrame, *extra: Column | str) -> DataFrame:
    """The columns of ``row`` again, then ``extra``."""
    cols = [f for f in df.schema["row"].dataType.names if f != "__pad"]
    return df.select(*[F.col("row").getField(c).alias(c) for c in cols], *extra)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a name inside one expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(sizes: Column, start: Column) -> Column:
    state = F.struct(start.cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(sizes, state, lambda acc, n: F.struct(
        (acc.at + n).alias("at"), F.array_append(acc.out, acc.at).alias("out"))).out


def running_sum(sizes: Column, block: int = 256) -> Column:
    """The sum of the elements before each element of an array of longs.

    Appending to an array copies it, so sums are taken within blocks of
    ``block`` elements and over the blocks' totals: arrays of millions of
    elements stay cheap.
    """
    def of_blocks(blocks):
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, n: a + n))
        return let(_scan(totals, F.lit(0)), lambda starts: F.flatten(
            F.transform(blocks, lambda b, i: _scan(b, F.get(starts, i)))))

    def of(bound):
        cut = F.transform(F.sequence(F.lit(0), F.size(bound) - 1, F.lit(block)),
                          lambda i: F.slice(bound, i + 1, F.lit(block)))
        return F.when(F.size(bound) > 0, let(cut, of_blocks)).otherwise(F.array().cast("array<bigint>"))

    return let(sizes, of)


def unit(hashed: Column) -> Column:
    """A 64-bit hash as a number in [0, 1)."""
    return F.shiftrightunsigned(hashed, 11).cast("double") * F.lit(2.0 ** -53)


def words(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)
