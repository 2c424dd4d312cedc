"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links.

A document's fingerprint is the majority vote, bit by bit, of its shingles'
hashes.  Fingerprints within ``RADIUS`` bits are linked.  Two such
fingerprints agree on all but at most ``RADIUS`` of the blocks that the 64
bits are split into, so every pair meets under a key that leaves out some
``RADIUS`` blocks; pairs under a key are verified by their bit distance.

Few wide blocks give few keys, but many fingerprints may meet under one of
them.  Keys that hold more than ``CROWD`` fingerprints emit no pairs;
their fingerprints are split again into more, narrower blocks.  At the last
level a key leaves at most nine bits open, so that it holds at most 512
fingerprints whatever the data.  No link is lost on the way: every level on
its own guarantees that close pairs meet.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import packed, saved, unpacked
from churnlab.llm.components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
LEVELS = (6, 12, 24)
CROWD = 64
#: Bytes of text whose words are held at a time.
PIECE = 1 << 20


def _word_lists(data: bytes):
    """The words of ``data`` in lists of bounded size."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[at:end].split()
        at = end


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number; zero for a text without words."""
    votes, total, last = np.zeros(64, np.int64), 0, []
    for words in _word_lists((text or "").encode("utf-8", "replace").lower()):
        words = last + words
        if len(words) >= shingle:
            grams = zip(*(words[i:] for i in range(shingle)), strict=False)
            n = len(words) - shingle + 1
            hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams), np.uint64, n)
            for i in range(0, n, 1 << 15):
                part = hashes[i:i + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
                votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += n
            words = words[len(words) - shingle + 1:]
        last = words
    if not total and last:
        return xxhash.xxh64_intdigest(b" ".join(last), SEED)
    return int(np.packbits(votes * 2 > total, bitorder="little").view("<u8")[0])


def add_fingerprint(df: DataFrame, text_col: str = "text", shingle: int = SHINGLE,
                    name: str = "fingerprint") -> DataFrame:
    """Add the fingerprint as a long (the unsigned number's 64 bits).

    Words are what white space separates, A-Z lower-cased; repeated shingles
    vote each time.  A text with fewer words than a shingle is one shingle;
    null, empty and blank texts have fingerprint zero.
    """
    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        prints = np.fromiter((simhash(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
        return pa.array(prints.view(np.int64))

    return df.withColumn(name, fingerprint(F.col(f"`{text_col}`").cast("string")))


def _masks(n_blocks: int, radius: int) -> list[int]:
    """For each choice of ``radius`` blocks, all bits but theirs, as signed longs."""
    edges = [round(i * 64 / n_blocks) for i in range(n_blocks + 1)]
    block = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(n_blocks)]
    every = (1 << 64) - 1
    masks = [every ^ sum(chosen) for chosen in combinations(block, radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _apart():
    return F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2")))


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs (a, b), a < b, of the distinct longs in column ``fp`` that are
    at most ``radius`` bits apart.  May repeat a pair."""
    found = None
    left = prints.select("fp").where(F.col("fp").isNotNull())
    for n_blocks in LEVELS:
        masks = F.lit(_masks(n_blocks, radius))
        keyed = left.select("fp", F.posexplode(masks).alias("k", "mask")).select(
            "fp", F.col("k").cast("short").alias("k"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        sizes = keyed.groupBy("k", "key").agg(
            F.count(F.lit(1)).alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("n > 1")
        sizes = saved(sizes, "simhash-keys")
        # two under a key are their own smallest and largest; only larger groups are fetched again
        twos = sizes.where("n = 2").select(F.col("lo").alias("fp"), F.col("hi").alias("fp2"))
        more = sizes.where("n > 2").select("k", "key", "n")
        members = saved(keyed.join(more, ["k", "key"]), "simhash-members")
        crowd = F.col("n") > CROWD if n_blocks != LEVELS[-1] else F.lit(False)
        few = members.where(~crowd).select("k", "key", "fp")
        pairs = few.join(few.withColumnRenamed("fp", "fp2"), ["k", "key"]).where(
            (F.col("fp") < F.col("fp2")) & (_apart() <= radius)).select("fp", "fp2")
        pairs = twos.where(_apart() <= radius).unionByName(pairs)
        found = pairs if found is None else found.unionByName(pairs)
        left = saved(members.where(crowd).select("fp").distinct(), "simhash-crowd")
        if left.isEmpty():
            break
    return found.select(F.col("fp").alias("a"), F.col("fp2").alias("b"))


def component_table(prints: DataFrame, id_col: str = "doc_id", print_col: str = "fingerprint",
                    radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint.

    ``root`` is one of the fingerprints that links reach from it;
    ``component_id`` the smallest id of the documents that hold any of them,
    null when none has an id.  Copies share a fingerprint and are linked once.
    """
    owners = saved(prints.groupBy(F.col(print_col).alias("fp")).agg(F.min(id_col).alias("first")), "simhash-prints")
    roots = components(links(owners, radius))
    rooted = saved(owners.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return saved(rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-components")


def add_component(df: DataFrame, id_col: str = "doc_id", print_col: str = "fingerprint",
                  radius: int = RADIUS) -> DataFrame:
    """Add ``component_id`` to every row of ``df`` (which is read twice); a
    column of that name is replaced."""
    df = df.drop("component_id")
    groups = component_table(df, id_col, print_col, radius).select(F.col("fp").alias("__fp"), "component_id")
    return df.join(groups, F.col(print_col) == F.col("__fp")).drop("__fp")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``df`` that stay when each group keeps one row.

    The row with the smallest id stays (null ids after all others); rows that
    repeat the same id are told apart by their texts' hashes, and of rows
    that repeat both, one stays.  Fingerprints are linked as in
    :func:`links`; texts without words form one group with each other.
    """
    rows = packed(df)
    names = {"id": F.col("row").getField(id_col), "text": F.col("row").getField(text_col)}
    text_hash = F.xxhash64(F.col("row").getField(text_col))
    slim = add_fingerprint(rows.select(names["id"].alias("id"), names["text"].alias("text"), text_hash.alias("hash")),
                           "text", shingle).drop("text")
    slim = saved(slim, "simhash-rows")
    groups = component_table(slim, "id", "fingerprint", radius).select("fp", "root")
    owners = slim.groupBy("id", "hash", "fingerprint").agg(F.count(F.lit(1)).alias("n"))
    grouped = owners.join(groups, F.col("fingerprint") == F.col("fp"))
    order = F.struct(F.col("id").isNull(), "id", "hash")
    stays = saved(grouped.groupBy("root").agg(F.min_by(F.struct("id", "hash", "n"), order).alias("s")).select(
        F.col("s.id").alias("id"), F.col("s.hash").alias("hash"), F.col("s.n").alias("n")), "simhash-stays")
    kept = rows.join(stays, names["id"].eqNullSafe(F.col("id")) & (text_hash == F.col("hash")))
    once = kept.where("n = 1").select("row")
    again = kept.where("n > 1").dropDuplicates(["id", "hash"]).select("row")
    return unpacked(once.unionByName(again))
