"""Mixing sources to target weights: temperature, bisected; block permutations.

A source's weight is its share of the corpus' tokens to the power alpha,
normalised.  Alpha is bisected until the weights' entropy, or the number of
times the most repeated source runs through, meets its target.  The weights
share out a token budget.  A source with budget for ``k`` whole runs and a
rest gives every document ``k`` times, in ``k`` permutations, and of one more
permutation the documents before the point where the rest is spent.

A permutation is the order of a hash.  A source's rows are cut into blocks by
that hash; block totals tell in which block the point lies, so that only that
one block per source is sorted.  What the rows need to know is one row per
source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.llm.common import WORD, packed, saved, unit, unpacked

#: Parts that a step of the search cuts the interval into, and steps.
PARTS, STEPS = 16, 10
#: Tables of at most so many rows are broadcast (some tens of bytes a row); larger ones are joined by shuffle.
SMALL = 50_000


def word_tokens(text: Column) -> Column:
    """Words as tokens; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _at(shares: DataFrame, alphas: list[float], budget_ratio: float) -> list[tuple[float, float]]:
    """(entropy, most repeated) of the weights for each exponent, in one pass over the shares."""
    cols = []
    for i, a in enumerate(alphas):
        w = F.exp(F.lit(a) * F.col("log"))
        cols += [F.sum(w).alias(f"z{i}"), F.sum(w * F.col("log")).alias(f"l{i}"),
                 F.max(F.exp(F.lit(a - 1) * F.col("log"))).alias(f"r{i}")]
    x = shares.agg(*cols).first()
    return [(math.log(x[f"z{i}"]) - a * x[f"l{i}"] / x[f"z{i}"], budget_ratio * x[f"r{i}"] / x[f"z{i}"])
            for i, a in enumerate(alphas)]


def exponent(shares: DataFrame, entropy: float | None, repetition: float | None, budget_ratio: float) -> float:
    """The exponent in [0, 1] that meets the targets.

    ``shares`` has ``log``, the logarithm of each source's share.
    ``entropy`` is a share of the greatest entropy possible (that of equal
    weights): the largest exponent whose weights reach it.  ``repetition``
    is the greatest number of runs through any source: the smallest exponent
    that keeps to it, which wins where both are given and disagree.  Targets
    out of reach give the end of the interval that comes nearest.
    """
    def search(holds) -> float:
        lo, hi = 0.0, 1.0  # holds(lo) and not holds(hi)
        for _ in range(STEPS):
            grid = [lo + (hi - lo) * i / PARTS for i in range(1, PARTS)]
            ok = [holds(*x) for x in _at(shares, grid, budget_ratio)]
            k = ok.index(False) if False in ok else len(ok)
            lo, hi = ([lo, *grid, hi])[k], ([lo, *grid, hi])[k + 1]
        return round((lo + hi) / 2, 9)

    (h0, r0), (h1, r1) = _at(shares, [0.0, 1.0], budget_ratio)
    alpha = 0.0 if repetition is not None and entropy is None else 1.0
    if entropy is not None:
        aim = entropy * h0
        alpha = 1.0 if h1 >= aim else 0.0 if h0 <= aim else search(lambda h, r: h >= aim)
    if repetition is not None:
        least = 0.0 if r0 <= repetition else 1.0 if r1 > repetition else search(lambda h, r: r > repetition)
        alpha = max(alpha, least)
    return alpha


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a written table if it is small; else leave the join to shuffle."""
    return F.broadcast(df) if df.count() <= SMALL else df


def mix_sources(df: DataFrame, source_col: str = "source", text_col: str = "text", entropy: float | None = 0.98,
                repetition: float | None = 4.0, budget: float = 1.0, seed: int = 42,
                block_rows: int = 2_048) -> DataFrame:
    """The mixed corpus: every chosen row once per run, with ``epoch`` (the
    number of the run, from 0) and ``mix_order`` (the order within a run).

    ``budget`` is in tokens of the input.  A null source is a source of its
    own.  A document without tokens costs nothing: it is in every whole run,
    and in the rest where its place comes before the point; a source without
    any token has no weight and gives nothing.  Rows equal in all columns tie
    and are taken as they come.  Input columns named ``epoch`` or
    ``mix_order`` are replaced.
    """
    rows = packed(df, ("epoch", "mix_order"))
    source = F.col("row").getField(source_col)
    rows = rows.select("row", source.alias("source"), F.xxhash64(F.lit(seed), "row").alias("h"),
                       word_tokens(F.col("row").getField(text_col)).alias("tokens"))
    sizes = saved(df.groupBy(F.col(f"`{source_col}`").alias("s")).agg(
        F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")), "mix-sizes")
    rows = rows.join(_small(sizes), F.col("source").eqNullSafe(F.col("s"))).withColumn(
        "block", F.floor(unit(F.col("h")) * F.col("blocks")).cast("int")).drop("s", "blocks")
    blocks = saved(rows.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "mix-blocks")
    totals = saved(blocks.groupBy("source").agg(F.sum("tokens").alias("n")).where("n > 0"), "mix-sources")
    corpus = totals.agg(F.sum("n")).first()[0]
    if not corpus:
        return unpacked(rows.where(F.lit(False)), F.lit(0).alias("epoch"), F.lit(0).cast("long").alias("mix_order"))
    shares = saved(totals.select("source", "n", F.log(F.col("n") / F.lit(corpus)).alias("log")), "mix-shares")
    alpha = exponent(shares, entropy, repetition, budget)
    z = shares.agg(F.sum(F.exp(F.lit(alpha) * F.col("log")))).first()[0]
    due = F.floor(F.lit(budget * corpus / z) * F.exp(F.lit(alpha) * F.col("log"))).cast("long")
    shares = saved(shares.withColumn("due", due).select(
        F.col("source").alias("of"), F.floor(F.col("due") / F.col("n")).cast("int").alias("runs"),
        (F.col("due") % F.col("n")).alias("rest")), "mix-due")
    upto = Window.partitionBy("source").orderBy("block")
    reached = blocks.withColumn("upto", F.sum("tokens").over(upto)).join(
        _small(shares), F.col("source").eqNullSafe(F.col("of")))
    # blocks up to the rest are in it; the next one that has tokens is cut at the point
    inside, cut = F.col("upto") <= F.col("rest"), F.col("upto") - F.col("tokens") < F.col("rest")
    plan = reached.groupBy("of", "runs", "rest").agg(
        F.coalesce(F.max(F.when(inside & (F.col("rest") > 0), F.col("block"))), F.lit(-1)).alias("last"),
        F.max(F.when(cut & ~inside, F.col("block"))).alias("point"),
        F.max(F.when(cut & ~inside, F.col("upto") - F.col("tokens"))).alias("before"))
    plan = saved(plan, "mix-plan")
    rows = rows.join(_small(plan), F.col("source").eqNullSafe(F.col("of")))
    at_point = F.coalesce(F.col("block") == F.col("point"), F.lit(False))
    spent = Window.partitionBy("source").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    whole = (F.col("block") <= F.col("last")).cast("int")
    sure = rows.where(~at_point).select("row", "h", (F.col("runs") + whole).alias("copies"))
    split = rows.where(at_point).withColumn(
        "spent", F.col("before") + F.coalesce(F.sum("tokens").over(spent), F.lit(0))).select(
        "row", "h", (F.col("runs") + (F.col("spent") < F.col("rest")).cast("int")).alias("copies"))
    copies = sure.unionByName(split).where("copies > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return unpacked(copies, "epoch", F.xxhash64("h", "epoch").alias("mix_order"))
