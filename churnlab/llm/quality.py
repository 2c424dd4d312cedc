"""Quality rules: text statistics and n-gram perplexity bands.

The language model is a modified Kneser-Ney model over characters, one per
language, counted by Spark over all documents: the tasks count the
``ORDER``-grams of their texts (packed into 64 bits, 16 per character), Spark
sums the counts, and joins and groupings give the continuation counts,
discounts and interpolated probabilities of all orders.  For scoring, the
highest order is a pair of arrays per language, sorted by packed n-gram.

Characters beyond U+FFFE share one code; runs of white space count as one
space.  A document's score is the mean negative log-probability of its
characters.  Per language, the median and the median absolute deviation over
the documents that pass the base rules give a band; documents above it
(garbled) or below it (boilerplate) are rejected.  A mean over few characters
strays further, so the band is never narrower than ``SHORT`` over the square
root of the number of characters: this widens it for short texts only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.llm.common import packed, saved, unpacked

ORDER = 4
BITS = 16
BEGIN, END, OTHER = 1, 3, 0xFFFF
#: N-grams that one broadcast holds (12 bytes each); larger models are scored in several passes.
SLICE = 2_000_000
#: Keys gathered in a task before they are counted, and distinct keys kept before they are handed on.
GATHER, HOLD = 1 << 21, 1 << 21
#: Code points or bytes of a text that are worked on at a time.
PIECE = 1 << 20
#: Score bins per unit, for exact medians of the binned scores.
BINS = 1000
#: Nats times the square root of the characters; clean texts of 150 to 2,400 characters stray by 1.0 to 1.3.
SHORT = 2.5

MIN_WORDS, WINDOW, MAX_REPEAT = 20, 8, 30
_GAPS = " \t\n\x0b\x0c\r"
_SYMBOL = np.zeros(128, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


# ------------------------------------------------------------ one text at a time
def _pieces(text: str) -> Iterator[np.ndarray]:
    """The code points of a text, ``PIECE`` at a time."""
    for i in range(0, len(text), PIECE):
        yield np.frombuffer(text[i:i + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)


def _gap(codes: np.ndarray) -> np.ndarray:
    return (codes == 32) | ((codes >= 9) & (codes <= 13))


def _grams_of(line: np.ndarray) -> np.ndarray:
    n = len(line) - ORDER + 1
    keys = line[:n].copy()
    for i in range(1, ORDER):
        keys = (keys << np.uint64(BITS)) | line[i:i + n]
    return keys.view(np.int64)


def packed_grams(text: str | None) -> Iterator[np.ndarray]:
    """A key for each character and one for the end, in arrays of bounded
    size; none for a text without words."""
    text = text or ""
    last, begun, waiting = np.full(ORDER - 1, BEGIN, np.uint64), False, False
    for nr, codes in enumerate(_pieces(text), 1):
        gap = _gap(codes)
        keep = ~gap
        at = int(keep.argmax()) if keep.any() else len(keep)
        # of white space before a word, the last stays, as a space; none before the first word
        keep[:-1] |= gap[:-1] & ~gap[1:]
        if not begun:
            keep[:at] = False
        line = np.minimum(np.where(gap, 32, codes)[keep], OTHER).astype(np.uint64)
        if begun and waiting and at == 0:
            line = np.concatenate([np.array([32], np.uint64), line])
        waiting = bool(gap[-1])
        begun = begun or at < len(gap)
        if begun and nr * PIECE >= len(text):
            line = np.concatenate([line, np.array([END], np.uint64)])
        if len(line):
            line = np.concatenate([last, line])
            yield _grams_of(line)
            last = line[1 - ORDER:]


def _word_lists(text: str) -> Iterator[list[bytes]]:
    """The words of a text, split ``PIECE`` bytes at a time."""
    data, at = text.encode("utf-8", "surrogatepass"), 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[at:end].split()
        at = end


def _repeated_words(rank: np.ndarray) -> int:
    """Words in windows of WINDOW words that occur twice or more; words come as numbers."""
    words, width = len(rank), 1
    if words < WINDOW + 1:
        return 0
    while width < WINDOW:
        # windows of twice the width, numbered by the pair of their halves
        pair = rank[:-width] * (int(rank.max()) + 1) + rank[width:]
        found, rank = np.unique(pair, return_inverse=True)
        if len(found) == len(pair):
            return 0
        width *= 2
    again = np.bincount(rank)[rank] > 1
    edge = np.zeros(words + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def text_statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    word_chars = symbols = 0
    for codes in _pieces(text):
        word_chars += len(codes) - int(_gap(codes).sum())
        symbols += int(_SYMBOL[codes[codes < 128]].sum())
    if not word_chars:
        return 0, 0, 0, 0, 0
    ids: dict[bytes, int] = {}
    words = np.concatenate([np.fromiter((ids.setdefault(w, len(ids)) for w in part), np.int64, len(part))
                            for part in _word_lists(text)])
    lines = [x for x in text.split("\n") if x.strip(_GAPS)]
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), _repeated_words(words)


# --------------------------------------------------------------- counting and model
def count_grams(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n) over all texts; a null language is the empty one."""
    def counted(batches):
        held: dict[str, list[np.ndarray]] = {}
        counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        gathered = 0

        def merge():
            for lang, parts in held.items():
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                if lang in counts:
                    old, m = counts[lang]
                    keys, where = np.unique(np.concatenate([old, keys]), return_inverse=True)
                    n = np.bincount(where, np.concatenate([m, n])).astype(np.int64)
                counts[lang] = keys, n.astype(np.int64)
            held.clear()

        def rows():
            for lang, (keys, n) in counts.items():
                for i in range(0, len(keys), 1 << 16):
                    k = keys[i:i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(k), pa.string()), pa.array(k), pa.array(n[i:i + (1 << 16)])],
                        names=["lang", "gram", "n"])
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                for keys in packed_grams(text.as_py()):
                    held.setdefault(lang.as_py(), []).append(keys)
                    gathered += len(keys)
                    if gathered >= GATHER:
                        merge()
                        gathered = 0
                        if sum(len(k) for k, _ in counts.values()) > HOLD:
                            yield from rows()
        merge()
        yield from rows()

    slim = df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))
    part = slim.mapInArrow(counted, "lang string, gram long, n long")
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, gram, logp) of the highest order: natural logarithms of the
    interpolated modified Kneser-Ney probabilities.

    Lower orders count the distinct characters before an n-gram; below the
    first order all characters of a language are equally likely.  Where the
    counts of counts are too few for the three discounts, a half is taken.
    """
    mask = {k: (1 << (BITS * k)) - 1 for k in range(1, ORDER)}
    types = {ORDER: saved(counts, "lm-grams")}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit(mask[k]))
        types[k] = saved(types[k + 1].groupBy("lang", suffix.alias("gram")).agg(F.count(F.lit(1)).alias("n")), "lm-types")
    below = types[1].groupBy("lang").agg((1 / F.count(F.lit(1))).alias("p")).select(
        F.col("lang").alias("below_lang"), F.lit(0).cast("long").alias("below_gram"), "p")
    for k in range(1, ORDER + 1):
        t = types[k]
        of = {i: F.sum(F.when(F.col("n") == i, 1).otherwise(0)) for i in (1, 2, 3, 4)}
        seen = t.groupBy("lang").agg(*[of[i].cast("double").alias(f"n{i}") for i in of])
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        enough = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0)

        def discount(i, y=y, enough=enough):
            d = i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")
            return F.when(enough, F.greatest(F.lit(0.0), F.least(F.lit(float(i)), d))).otherwise(0.5).alias(f"d{i}")

        # a row per language: written, so that its size is known and n-grams are not dealt by language
        cuts = saved(seen.select(F.col("lang").alias("cut_lang"), *[discount(i) for i in (1, 2, 3)]), "lm-cuts")
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        context = F.shiftrightunsigned("gram", BITS) if k > 1 else F.lit(0).cast("long")
        suffix = F.col("gram").bitwiseAND(F.lit(mask[k - 1])) if k > 1 else F.lit(0).cast("long")
        t = t.join(cuts, F.col("lang") == F.col("cut_lang")).select(
            "lang", "gram", "n", context.alias("context"), suffix.alias("suffix"), cut.alias("cut"))
        heads = t.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("cut").alias("freed")).select(
            F.col("lang").alias("head_lang"), F.col("context").alias("head"), "total", "freed")
        p = (F.col("n") - F.col("cut") + F.col("freed") * F.col("p")) / F.col("total")
        t = (t.join(heads, (F.col("lang") == F.col("head_lang")) & (F.col("context") == F.col("head")))
             .join(below, (F.col("lang") == F.col("below_lang")) & (F.col("suffix") == F.col("below_gram")))
             .select("lang", "gram", p.alias("p")))
        t = saved(t, "lm-model")
        below = t.select(F.col("lang").alias("below_lang"), F.col("gram").alias("below_gram"), "p")
    return t.select("lang", "gram", F.log("p").alias("logp"))


def _scorer(sent):
    """The sum of log-probabilities of a text, from a broadcast slice of the model."""
    @F.arrow_udf("double")
    def score(langs: pa.Array, texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts))
        for j, (lang, text) in enumerate(zip(langs, texts, strict=True)):
            grams, logs = sent.value.get(lang.as_py(), (None, None))
            if grams is None:
                continue
            for part in packed_grams(text.as_py()):
                keys, n = np.unique(part, return_counts=True)
                at = np.minimum(np.searchsorted(grams, keys), len(grams) - 1)
                out[j] += float((np.where(grams[at] == keys, logs[at], 0) * n).sum(dtype=np.float64))
        return pa.array(out)

    return score.asNondeterministic()


def add_score(df: DataFrame, model: DataFrame, text_col: str, lang_col: str, name: str) -> DataFrame:
    """Add the sum of log-probabilities of a text's characters.

    The model goes to the workers as sorted arrays, at most ``SLICE``
    n-grams at a time: a larger model is cut by hash and each slice adds its
    share in a pass of its own.
    """
    spark = df.sparkSession
    passes = max(1, -(-model.count() // SLICE))
    out = df.withColumn(name, F.lit(0.0))
    for i in range(passes):
        part = model.where(F.pmod(F.xxhash64("lang", "gram"), F.lit(passes)) == i) if passes > 1 else model
        rows = part.select("lang", "gram", F.col("logp").cast("float").alias("logp")).toArrow()
        arrays = {}
        lang_codes = rows["lang"].combine_chunks().dictionary_encode()
        codes, grams, logs = (np.asarray(x) for x in (lang_codes.indices, rows["gram"], rows["logp"]))
        for j, lang in enumerate(lang_codes.dictionary.to_pylist()):
            mine = codes == j
            order = np.argsort(grams[mine])
            arrays[lang] = grams[mine][order], logs[mine][order]
        sent = spark.sparkContext.broadcast(arrays)
        del rows, arrays, grams, logs, codes

        score = _scorer(sent)
        lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(""))
        out = out.withColumn(name, F.col(name) + score(lang, F.col(f"`{text_col}`").cast("string")))
        if passes > 1:
            out = saved(out, "lm-scores")
    return out


def add_statistics(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """Add the struct of :func:`text_statistics`."""
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    @F.arrow_udf("struct<" + ", ".join(f"{f}: bigint" for f in fields) + ">")
    def statistics(texts: pa.Array) -> pa.Array:
        rows = np.array([text_statistics(t.as_py()) for t in texts], np.int64).reshape(-1, len(fields))
        return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(fields))], names=list(fields))

    # marked so that a filter on the result does not make Spark take the statistics twice
    return df.withColumn(name, statistics.asNondeterministic()(F.col(f"`{text_col}`").cast("string")))


def _median(binned: DataFrame, value: str) -> DataFrame:
    """Per language, the smallest bin at which more than half of the documents are reached."""
    upto = Window.partitionBy("lang").orderBy(value)
    total = Window.partitionBy("lang")
    return (binned.groupBy("lang", value).agg(F.sum("n").alias("n"))
            .withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(total))
            .where(F.col("upto") * 2 > F.col("all"))
            .groupBy("lang").agg(F.min(value).alias("mid")))


def bands(scores: DataFrame, width: float) -> DataFrame:
    """(lang, mid, reach): the median score and how far from it the score of a
    long text may lie, ``width`` scaled median absolute deviations.

    ``scores`` has (lang, score); the work beyond one grouping is on bins.
    """
    binned = saved(scores.groupBy("lang", F.floor(F.col("score") * BINS).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")), "lm-bins")
    mid = saved(_median(binned, "bin").select(F.col("lang").alias("l"), F.col("mid").alias("m")), "lm-mid")
    off = binned.join(mid, F.col("lang") == F.col("l")).select("lang", "n", F.abs(F.col("bin") - F.col("m")).alias("off"))
    spread = _median(off, "off").join(mid, F.col("lang") == F.col("l"))
    reach = F.col("mid") * 1.4826 * width / BINS
    return spread.select("lang", ((F.col("m") + 0.5) / BINS).alias("mid"), reach.alias("reach"))


NEW = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def judge_quality(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  carry_text: bool = True, width: float = 8.0, short: float = SHORT) -> DataFrame:
    """Add the text statistics, ``base_failed``, ``score`` and ``kept``.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in
    repeated 8-word windows.  ``kept``: not failed, and the score within its
    language's band (see :func:`bands`) or within ``short`` / sqrt(characters)
    of the median; a language of which no document
    passes the base rules has no band and rejects none beyond them.  ``score``
    is null for texts without words.  Every row comes back once; null texts
    have no words, a null language is a language of its own; input columns
    named like a result column are replaced.  With ``carry_text`` the texts
    are scored twice, for the bands and for the verdicts, rather than
    written in between; without it the text is left out of the result, and
    the scored rows are written.
    """
    model = saved(kneser_ney(count_grams(df, text_col, lang_col)), "lm-scoring")
    rows = packed(df, NEW).withColumns({
        "text": F.col("row").getField(text_col),
        "lang": F.coalesce(F.col("row").getField(lang_col).cast("string"), F.lit(""))})
    if not carry_text:
        rows = rows.withColumn("row", F.col("row").dropFields(text_col))
    rows = add_score(add_statistics(rows, "text", "s"), model, "text", "lang", "logp")
    # one more character than the text has: the end
    chars = F.col("chars")
    rows = rows.withColumn("chars", F.length(F.trim(F.regexp_replace("text", "[\\x20\\x09-\\x0D]+", " "))) + 1)
    rows = rows.select("row", "lang", "s.*", "chars", F.when(F.col("s.n_words") > 0, -F.col("logp") / chars).alias("score"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT)
    rows = rows.withColumn("base_failed", failed)
    if not carry_text:
        rows = saved(rows, "quality")
    passed = rows.where(~F.col("base_failed")).select("lang", "score")
    band = saved(bands(passed, width), "lm-bands").withColumnRenamed("lang", "l")
    inside = F.abs(F.col("score") - F.col("mid")) <= F.greatest("reach", F.lit(float(short)) / F.sqrt("chars"))
    judged = rows.join(band, F.col("lang") == F.col("l"), "left").withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
    return unpacked(judged, *NEW)
