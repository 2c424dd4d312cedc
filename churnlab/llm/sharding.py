"""Sharding: a uniform shuffle into shards of exact size.

The rows lie in blocks (by a hash of the whole row, ``block_rows`` each or
fewer on average).  How many rows of each block go to each shard is drawn first, from the
distribution that a uniform shuffle would give: the block x shard matrix is
multivariate hypergeometric, drawn by halving the list of blocks again and
again and splitting every shard's places between the halves.  Then each block
permutes its rows and deals them out by its matrix row, the rows are
exchanged, and each shard permutes what it received.

A shard is never sorted in one task: its rows fall into cells by their second
permutation key, cells are sorted on their own, and the cells' row counts
give the offsets of the gapless slots.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.llm.common import let, packed, saved, unit, unpacked


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Marked items among ``drawn`` of ``total`` items of which ``marked`` are
    marked, by inversion at ``u`` in [0, 1).

    The probabilities follow from one another by their ratios; those more
    than 12 standard deviations from the mode lie below the precision of a
    double and are left out.
    """
    t, m, n = (c.cast("double") for c in (total, marked, drawn))

    def bounds(v):
        spread = F.ceil(F.lit(12.0) * F.sqrt(
            v.n * (v.m / F.greatest(v.t, F.lit(1.0))) * (F.lit(1.0) - v.m / F.greatest(v.t, F.lit(1.0)))
            * (v.t - v.n) / F.greatest(v.t - 1, F.lit(1.0)))) + 12
        mode = F.floor((v.n + 1) * (v.m + 1) / (v.t + 2))
        least, most = F.greatest(F.lit(0.0), v.n - (v.t - v.m)), F.least(v.n, v.m)
        lo = F.greatest(least, F.least(mode, most) - spread).cast("long")
        hi = F.least(most, F.greatest(mode, least) + spread).cast("long")
        return F.struct(v.t.alias("t"), v.m.alias("m"), v.n.alias("n"), lo.alias("lo"), hi.alias("hi"))

    def draw(v):
        def ratio(k):
            return (v.m - k + 1) * (v.n - k + 1) / (k * (v.t - v.m - v.n + k))

        steps = F.sequence(v.lo + 1, v.hi)
        one = F.lit(1.0)
        whole = F.aggregate(steps, F.struct(one.alias("f"), one.alias("s")), lambda a, k: F.struct(
            (a.f * ratio(k)).alias("f"), (a.s + a.f * ratio(k)).alias("s"))).s
        picked = let(whole * u, lambda aim: F.aggregate(
            steps, F.struct(one.alias("f"), one.alias("s"), v.lo.alias("k")), lambda a, k: F.struct(
                (a.f * ratio(k)).alias("f"), (a.s + a.f * ratio(k)).alias("s"),
                F.when(a.s <= aim, k).otherwise(a.k).alias("k"))).k)
        return F.when(v.hi > v.lo, picked).otherwise(v.lo)

    return let(let(F.struct(t.alias("t"), m.alias("m"), n.alias("n")), bounds), draw)


def communication_matrix(sizes: DataFrame, n_shards: int, total: int, seed: int) -> DataFrame:
    """(block, counts): how many rows of each block go to each shard.

    ``sizes`` has (block, n).  Row sums are the block sizes, column sums the
    shard sizes, which differ by one at most.  One row of metadata (a number
    per block) is halved level by level; after six levels the halves are
    spread over the cluster.
    """
    caps = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: (
        F.lit(total // n_shards) + F.when(s < total % n_shards, 1).otherwise(0)).cast("long"))
    node = sizes.groupBy().agg(F.array_sort(F.collect_list(F.struct("block", "n"))).alias("blocks")).select(
        F.lit(0).cast("long").alias("first"), "blocks", caps.alias("caps"))
    n_blocks = sizes.count()

    def rows_in(blocks):
        return F.aggregate(blocks, F.lit(0).cast("long"), lambda a, b: a + b.n)

    level = 0
    while (1 << level) < n_blocks:
        half = F.floor(F.size("blocks") / 2).cast("int")
        left = node.withColumn("left", F.slice("blocks", 1, half)).withColumn("half", half)

        def deal(acc, s):
            u = unit(F.xxhash64(F.lit(seed), F.lit(level), F.col("first"), s))
            cap = F.get("caps", s)
            return let(hypergeometric(acc.total, cap, acc.rest, u), lambda x: F.struct(
                F.array_append(acc.out, x).alias("out"), (acc.total - cap).alias("total"),
                (acc.rest - x).alias("rest")))

        start = F.struct(F.array().cast("array<bigint>").alias("out"), rows_in(F.col("blocks")).alias("total"),
                         rows_in(F.col("left")).alias("rest"))
        dealt = F.aggregate(F.sequence(F.lit(0), F.lit(n_shards - 1)), start, deal).out
        left = left.withColumn("got", F.when(F.size("left") > 0, dealt).otherwise(
            F.array_repeat(F.lit(0).cast("long"), n_shards)))
        right = F.slice("blocks", F.col("half") + 1, F.greatest(F.size("blocks") - F.col("half"), F.lit(0)))
        kept = F.zip_with("caps", "got", lambda c, g: c - g)
        node = left.select(F.inline(F.array(
            F.struct("first", F.col("left").alias("blocks"), F.col("got").alias("caps")),
            F.struct((F.col("first") + F.col("half")).alias("first"), right.alias("blocks"), kept.alias("caps")),
        ))).where(F.size("blocks") > 0)
        level += 1
        if level == 6:
            node = node.repartition("first")
    return node.select(F.get("blocks", F.lit(0)).block.alias("block"), F.col("caps").alias("counts"))


#: Blocks, and cells of a shard, that even a small table is cut into.
MIN_BLOCKS, MIN_CELLS = 256, 16


def uniform_shards(df: DataFrame, n_shards: int = 24, seed: int = 42, block_rows: int = 65_536) -> DataFrame:
    """Add ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (gapless from 0).

    Every arrangement of the rows is equally likely as far as the 64-bit
    hash of a row is random; shard sizes differ by one at most.  The result
    depends on the rows, the seed and ``block_rows``, not on partitioning,
    and is the same when a task runs again.  Rows equal in all columns are
    numbered in their block and shuffled by that number too, so that they
    spread like others; each gets its own slot.  Null values hash as such.  An
    empty table stays empty; input columns named ``shard`` or ``slot`` are
    replaced.
    """
    rows = packed(df, ("shard", "slot")).withColumn("h", F.xxhash64("row"))
    total = rows.count()
    n_blocks = max(MIN_BLOCKS, math.ceil(total / block_rows))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "h"), F.lit(n_blocks)).cast("int"))
    sizes = saved(rows.groupBy("block").agg(F.count(F.lit(1)).alias("n")), "shard-blocks")
    matrix = communication_matrix(sizes, n_shards, total, seed)
    upto = F.transform(F.sequence(F.lit(1), F.lit(n_shards)), lambda s: F.aggregate(
        F.slice("counts", 1, s), F.lit(0).cast("long"), lambda a, x: a + x))
    matrix = saved(matrix.select("block", upto.alias("upto")), "shard-matrix")
    n_cells = max(MIN_CELLS, math.ceil(total / n_shards / block_rows))

    def deal(some):
        """Shard and cell of each row; a function of the hashes alone, whatever columns come along."""
        equal = Window.partitionBy("block").orderBy("h")
        some = some.withColumn("h", F.xxhash64("h", F.row_number().over(equal) - F.rank().over(equal)))
        local = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 1), "h"), "h")
        some = some.withColumn("rank", F.row_number().over(local)).join(matrix, "block")
        some = some.withColumns({"shard": F.size(F.filter("upto", lambda c: c < F.col("rank"))),
                                 "order": F.xxhash64(F.lit(seed + 2), "h")})
        return some.withColumn("cell", F.floor(unit(F.col("order")) * n_cells).cast("int")).drop("upto", "rank")

    # the cells are counted on the hashes first, so that whole rows move twice and are not written in between
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = deal(rows.select("h", "block")).groupBy("shard", "cell").count().select(
        "shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    cells = saved(cells, "shard-cells")
    within = Window.partitionBy("shard", "cell").orderBy("order", "h")
    placed = deal(rows).withColumn("place", F.row_number().over(within)).join(cells, ["shard", "cell"])
    return unpacked(placed, "shard", (F.col("offset") + F.col("place") - 1).alias("slot"))
