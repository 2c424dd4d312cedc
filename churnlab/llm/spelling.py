"""Spelling variant grouping: words one edit apart, by dense prefix-suffix tiling.

Words are rows of padded code-point matrices, once aligned left and once
right.  Two blocks of words are compared cell by cell; a pair's common prefix
and common suffix follow from the first cells that differ.  Where their sum
(at most the shorter word's length) reaches the longer word's length minus
one, the words are one insertion, deletion or replacement apart.

Which blocks meet: cut the longer word of such a pair into segments; all but
one of them are the same in both words, counted from the front before the edit
and from the back behind it.  A word is therefore filed, as the longer and as the
shorter word of a pair, under all that remains when one segment is left out,
and every close pair shares a key.  Words under a key lie next to each other
and are compared in tiles.  A key that holds more than ``CROWD`` words is
filed again with more, shorter segments; at the last level such a key's
words are dealt into blocks, and every pair of blocks is compared on its own.
No pair is lost on the way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import LOWER, UPPER, saved

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A word's form is this many times as frequent, at least.
FACTOR = 2
#: Segments of a word at each level.
LEVELS = (2, 6, 16)
CROWD = 512
#: Rows of a tile, and the cells compared at a time.
TILE, CELLS = 256, 1 << 23


# ---------------------------------------------------------------------- words
def count_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip: int = 97,
                least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of all texts.

    A word is a run of letters, A-Z lower-cased.  With ``slip``, one run in so
    many (by the checksum of id and run) loses a code point.  Words shorter
    than ``least_length`` or rarer than ``least_count`` are left out; a null
    text has no words, a null id is an empty one.
    """
    text = F.translate(F.col(f"`{text_col}`").cast("string"), UPPER, LOWER)
    runs = df.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                     F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= least_length)
    word = F.col("run")
    if slip:
        runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "id", "run")))
        cut = (F.col("h") % F.length("run")).cast("int")
        word = F.when(F.col("h") % slip == 0, F.concat(F.substring("run", F.lit(1), cut), F.substring(
            F.col("run"), cut + 2, F.length("run")))).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


# ----------------------------------------------------------------------- tiles
def _table(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * 4
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                      names=["word", "n", "near", "near_n"])


def _matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and the code points aligned left and aligned right; zeros pad."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = int(lengths.max(initial=1))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    column = np.arange(width)
    left = np.zeros((len(words), width), np.uint32)
    right = np.zeros((len(words), width), np.uint32)
    left[column < lengths[:, None]] = points
    right[column >= width - lengths[:, None]] = points
    return lengths, left, right[:, ::-1]


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For every row of ``a`` with every row of ``b``, the leading cells that are equal."""
    width = min(a.shape[1], b.shape[1])
    differ = np.ones((len(a), len(b), width + 1), bool)
    np.not_equal(a[:, None, :width], b[None, :, :width], out=differ[:, :, :width])
    return differ.argmax(axis=2)


def close_pairs(a: list[str], b: list[str]) -> Iterator[tuple[int, int]]:
    """Positions (i, j) of the words of two blocks that are one edit apart."""
    la, left_a, right_a = _matrices(a)
    lb, left_b, right_b = _matrices(b)
    step = max(1, CELLS // (len(b) * (min(left_a.shape[1], left_b.shape[1]) + 1)))
    for at in range(0, len(a), step):
        part = slice(at, at + step)
        shorter = np.minimum(la[part, None], lb[None, :])
        longer = np.maximum(la[part, None], lb[None, :])
        prefix = np.minimum(_common(left_a[part], left_b), shorter)
        suffix = np.minimum(_common(right_a[part], right_b), shorter)
        same = (prefix == longer) & (shorter == longer)
        close = (np.minimum(prefix + suffix, shorter) >= longer - 1) & ~same
        for i, j in zip(*np.nonzero(close), strict=True):
            yield at + int(i), int(j)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the rows (key, word, n) of a partition, sorted by key, in tiles.

    Rows of a key follow each other; a tile is compared with itself and with
    what follows it under its last key.  A key holds ``CROWD`` rows at most.
    """
    keys, words, counts = [], [], []
    out = []

    def compare(last: bool):
        """Tiles at the front of what is held, as long as their last key is complete."""
        at = 0
        while at < len(keys):
            end, width = at + 1, len(words[at])
            while end < min(at + TILE, len(keys)) and (end + 1 - at) * max(width, len(words[end])) <= CELLS:
                width = max(width, len(words[end]))
                end += 1
            reach = end
            while reach < len(keys) and keys[reach] == keys[end - 1]:
                reach += 1
            if reach == len(keys) and not last:
                break
            if len(set(keys[at:reach])) < reach - at:
                for i, j in close_pairs(words[at:end], words[at:reach]):
                    if j >= end - at or i < j:
                        out.append((words[at + i], counts[at + i], words[at + j], counts[at + j]))
            at = end
        del keys[:at], words[:at], counts[:at]

    for batch in batches:
        keys += batch.column(0).to_pylist()
        words += batch.column(1).to_pylist()
        counts += batch.column(2).to_pylist()
        compare(False)
        if len(out) >= 1 << 16:
            yield _table(out)
            out.clear()
    compare(True)
    yield _table(out)


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares two blocks of words per row (word, n, other block's words and counts)."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            a, b = row["a"], row["b"]
            for i, j in close_pairs([x["word"] for x in a], [x["word"] for x in b]):
                if row["i"] != row["j"] or i < j:
                    rows.append((a[i]["word"], a[i]["n"], b[j]["word"], b[j]["n"]))
        yield _table(rows)


PAIRS = "word string, n long, near string, near_n long"


# ------------------------------------------------------------------ candidates
def _keys(word: Column, segments: int) -> Column:
    """(length, key) of a word, as the longer and as the shorter of a pair, for every segment left out."""
    def of(longer):
        def one(j):
            begin = F.floor(j * longer / segments).cast("int")
            end = F.floor((j + 1) * longer / segments).cast("int")
            rest = F.concat_ws("\0", F.substring(word, F.lit(1), begin), F.right(word, longer - end))
            return F.struct(longer.alias("length"), (end > begin).alias("any"),
                            F.xxhash64(longer, j, rest).alias("key"))
        return F.transform(F.sequence(F.lit(0), F.lit(segments - 1)), one)

    both = F.flatten(F.transform(F.array(F.length(word), F.length(word) + 1), of))
    return F.filter(both, lambda k: k["any"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n), each pair of words of (word, n) that are one
    edit apart once, ``word`` before ``near``; ``words`` holds each word once."""
    found, left, members, crowd = None, words, None, None
    for level in LEVELS:
        keyed = left.select("word", "n", F.explode(_keys(F.col("word"), level)).alias("k")).select(
            "word", "n", "k.length", "k.key")
        sizes = saved(keyed.groupBy("length", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "spelling-keys")
        members = saved(keyed.join(sizes, ["length", "key"]), "spelling-members")
        crowd = (F.col("size") > CROWD) | (F.col("size") * F.col("length") > CELLS)
        few = members.where(~crowd).repartition("key").sortWithinPartitions("length", "key", "word")
        pairs = few.select("key", "word", "n").mapInArrow(_tiles, PAIRS)
        found = pairs if found is None else found.unionByName(pairs)
        left = saved(members.where(crowd).select("word", "n").distinct(), "spelling-crowd")
        if left.isEmpty():
            break
    else:
        found = found.unionByName(_by_blocks(members.where(crowd)))
    first, second = F.least("word", "near"), F.greatest("word", "near")
    counts = F.when(F.col("word") < F.col("near"), F.struct(F.col("n").alias("a"), F.col("near_n").alias("b"))).otherwise(
        F.struct(F.col("near_n").alias("a"), F.col("n").alias("b")))
    return found.select(first.alias("word"), second.alias("near"), counts.alias("c")).select(
        "word", F.col("c.a").alias("n"), "near", F.col("c.b").alias("near_n")).distinct()


def _by_blocks(members: DataFrame) -> DataFrame:
    """The pairs under keys of any size: words dealt into blocks, every pair of blocks a row."""
    fit = F.least(F.lit(CROWD), F.greatest(F.lit(1), F.floor(F.lit(CELLS) / F.col("length"))))
    blocks = F.ceil(F.col("size") / fit).cast("int")
    dealt = members.select("length", "key", "word", "n", blocks.alias("blocks"), F.pmod(
        F.xxhash64("word", F.lit(1)), blocks.cast("long")).cast("int").alias("block"))
    met = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    word = F.struct("word", "n")
    tiles = met.groupBy("length", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).agg(
        F.collect_list(F.when(F.col("block") <= F.col("other"), word)).alias("a"),
        F.collect_list(F.when(F.col("block") >= F.col("other"), word)).alias("b"))
    return tiles.select("i", "j", "a", "b").mapInArrow(_block_pairs, PAIRS)


# ----------------------------------------------------------------------- roots
def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every (word, form): where following forms leads.  A
    form is more frequent than its word, so there are no rings; the reach of a
    step doubles every round."""
    steps = saved(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = steps.select(F.col("word").alias("at"), F.col("root").alias("next"))
        steps = saved(steps.join(ahead, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.select("word", "root")


def group_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """Add ``n_near``, ``form``, ``form_n`` and ``root`` to (word, n).

    ``form`` is the most frequent word one edit away (of equally frequent ones
    the first in code-point order) if it is ``factor`` times as frequent as the
    word, else null; ``root`` follows forms to the last and is the word itself
    where there is none.  An empty table gives an empty one.
    """
    words = saved(words.select("word", "n"), "spelling-words")
    pairs = saved(near_words(words), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), "near"))
    found = both.groupBy(F.col("word").alias("w")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    strong = F.col("best.near_n") >= factor * F.col("n")
    judged = saved(words.join(found, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, F.col("best.near_n")).alias("form_n")),
        "spelling-forms")
    roots = _roots(judged.where("form is not null")).withColumnRenamed("word", "w")
    return judged.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
