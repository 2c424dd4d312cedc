"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

A byte-level BPE (A) reads space + text, a sentencepiece model (B) reads the
text and adds the space itself.  The character offsets of A's tokens and the
spans of B's pieces (those of its immutable proto, which the installed library
hands out as an offset mapping) cut the text coarsely; tokens between two cuts, that is
those that share a multibyte character and byte-fallback pieces, are laid out
by their decoded bytes.  All tokens' bytes together must be the text's.

Neither tokenizer joins a character with the space that follows it (A's
pattern ends a token there, no piece of B holds such a pair; the latter is
tested).  A text is therefore cut before those spaces, and a worker keeps the
alignment of short pieces of text that it has seen.  For the same reason pieces not seen before
are given to the tokenizers many in a row, as one line.

What a text holds is written as a list of (token pair, number).  Counting a pair's
links and rating each text's links by them are joins and sums in Spark.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import packed, saved, unpacked

#: Pieces of text that a worker keeps (up to twice as many for a time), the longest of them, and how many are aligned at a time.
KNOWN, KNOWN_LENGTH, AT_A_TIME = 150_000, 64, 20_000
#: Pieces of a line.
TOGETHER = 64
#: Before a space that follows other than white space.
CUT = re.compile(r"(?<=\S)(?= )")
END = itemgetter(1)
#: Ids of B are the lower bits of a pair's code.
SHIFT = 32


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 characters stand for themselves, the other bytes for U+0100 and on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in plain}
    table |= {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    return table


class Aligner:
    """Aligns texts of two tokenizer files.

    An alignment of a piece of text is (tokens of A, tokens of B, groups, codes of
    its links as bytes, groups as text in bytes, each with a semicolon behind it).  Pieces are aligned
    many at a time, as one string of bytes in which every token has a place.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker per core
        import sentencepiece
        import tokenizers
        self.a = tokenizers.Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        table = byte_of_char()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(table[c] for c in token)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(names)]
        self.sizes_a, self.sizes_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # every id's digits with each of the marks that can follow them, padded by zeros
        said = np.array([f"{i}{m}".encode() for i in range(max(len(self.bytes_a), len(names))) for m in ",|;"])
        self.said = said.view(np.uint8).reshape(len(said), -1)
        self.cuts = not any(re.search("[^▁]▁", p) for p in names)
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def pieces(self, text: str) -> list[str]:
        """Space + text, cut before every space that follows other than white space and
        has such characters after it."""
        line = " " + text
        if not self.cuts:
            return [line]
        body = line.rstrip()
        parts = CUT.split(body) if body else [""]
        parts[-1] += line[len(body):]
        return parts

    def lines(self, pieces: list[str], together: int) -> Iterator[list[str]]:
        """The pieces in lines: the next piece starts where a text would be cut, unless white space comes before it."""
        if not self.cuts:
            together = 1
        line: list[str] = []
        for p in pieces:
            alone = p[-1].isspace()
            if line and (alone or len(line) >= together):
                yield line
                line = []
            line.append(p)
            if alone:
                yield line
                line = []
        if line:
            yield line

    def align(self, pieces: list[str], together: int = TOGETHER) -> list[tuple | None]:
        """The alignment of each piece; none where a tokenizer's bytes differ from it."""
        lines = list(self.lines(pieces, together))
        texts = ["".join(x) for x in lines]
        of_a = self.a.encode_batch(texts, add_special_tokens=False)
        of_b = self.b.encode([x[1:] for x in texts], return_type="offset_mapping", num_threads=1)
        # B's spans are those of the line without the space that it adds
        found_a = [(x.ids, x.offsets) for x in of_a]
        found_b = [(x["ids"], x["offsets"]) for x in of_b]
        data = [x.encode() for x in texts]
        a, b = _Side(found_a, 0, self.bytes_a, self.sizes_a), _Side(found_b, 1, self.bytes_b, self.sizes_b)
        if a.same(data) and b.same(data):
            return list(_aligned_pieces(lines, data, a, b, self.said))
        # some line does not come back: the others without it, then its pieces one by one
        fits = [_same(d, x, self.bytes_a) and _same(d, y, self.bytes_b) for d, (x, _), (y, _) in zip(data, found_a, found_b, strict=True)]
        good = [i for i, ok in enumerate(fits) if ok]
        kept, data, found_a, found_b = ([xs[i] for i in good] for xs in (lines, data, found_a, found_b))
        made = _aligned_pieces(kept, data, _Side(found_a, 0, self.bytes_a, self.sizes_a),
                               _Side(found_b, 1, self.bytes_b, self.sizes_b), self.said)
        parted = [p for x, ok in zip(lines, fits, strict=True) if not ok and len(x) > 1 for p in x]
        single = iter(self.align(parted, 1) if parted else ())
        out: list[tuple | None] = []
        for x, ok in zip(lines, fits, strict=True):
            out += islice(made, len(x)) if ok else islice(single, len(x)) if len(x) > 1 else [None]
        return out

    def texts(self, texts: list[str | None]) -> Iterator[list[tuple]]:
        """The alignments of each text's pieces; none for null and empty texts and those that do not fit."""
        parts = [self.pieces(t) if t else [] for t in texts]
        now, fresh, young, old = {}, [], self.young, self.old
        for p in set().union(*parts):
            if p in young:
                now[p] = young[p]
            elif p in old:
                now[p] = young[p] = old[p]
            else:
                fresh.append(p)
        for at in range(0, len(fresh), AT_A_TIME):
            some = fresh[at:at + AT_A_TIME]
            now.update(zip(some, self.align(some), strict=True))
        young.update((p, now[p]) for p in fresh if len(p) <= KNOWN_LENGTH)
        if len(young) > KNOWN:
            self.young, self.old = {}, young
        for ps in parts:
            found = list(map(now.__getitem__, ps))
            yield [] if None in found else found


def _same(data: bytes, ids: list[int], table: list[bytes]) -> bool:
    return b"".join([table[i] for i in ids]) == data


class _Side:
    """One tokenizer's tokens of many lines, (ids, offsets) of each: ids, coarse ends (``shift``
    characters on) and sizes, all in a row."""

    def __init__(self, found: list[tuple], shift: int, table: list[bytes], sizes: np.ndarray):
        ids = list(chain.from_iterable([x for x, _ in found]))
        self.table, self.count = table, np.fromiter([len(x) for x, _ in found], np.int64, len(found))
        self.ids = np.array(ids, np.int64)
        self.coarse = np.fromiter(map(END, chain.from_iterable([x for _, x in found])), np.int64, len(ids)) + shift
        self.sizes = sizes[self.ids]
        self.text = b"".join(map(table.__getitem__, ids))

    def same(self, data: list[bytes]) -> bool:
        """Whether the tokens' bytes are those of the lines, each line for itself."""
        totals = np.diff(np.concatenate([[0], np.cumsum(self.sizes)])[np.concatenate([[0], np.cumsum(self.count)])])
        return self.text == b"".join(data) and totals.tolist() == list(map(len, data))

    def ends(self, coarse: np.ndarray) -> np.ndarray:
        """Where tokens end in the bytes of all lines.  ``coarse`` are the ends that the tokenizer
        tells, of whole characters; a token that ends inside a character is told that character's end
        (A) or start (B) and is laid out by its decoded bytes."""
        decoded = np.cumsum(self.sizes)
        inside = decoded != coarse
        return np.where(inside, decoded, coarse)


def _aligned_pieces(lines: list[list[str]], data: list[bytes], a: _Side, b: _Side, said: np.ndarray) -> Iterator[tuple]:
    """Alignments of the pieces of lines whose tokens' bytes are theirs."""
    if not lines:
        return
    row = np.frombuffer(b"".join(data), np.uint8)
    # coarse ends are characters: the byte at which each character of the row starts, and the row's end
    of_char = np.append(np.flatnonzero((row & 0xC0) != 0x80), len(row))
    piece_chars = np.cumsum(np.fromiter(map(len, chain.from_iterable(lines)), np.int64))
    piece_ends = of_char[piece_chars]
    first = np.append(0, piece_chars[np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines))) - 1])[:-1]
    ends_a = a.ends(of_char[np.repeat(first, a.count) + a.coarse])
    ends_b = b.ends(of_char[np.repeat(first, b.count) + b.coarse])

    # between two neighbouring ends lies one token of A and one of B: a link
    ends = np.concatenate([ends_a, ends_b])
    ends.sort(kind="stable")
    ends = ends[np.append(ends[1:] != ends[:-1], True)]
    at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    codes = (a.ids[at_a] << SHIFT | b.ids[at_b]).tobytes()
    links = np.searchsorted(ends, piece_ends, side="right")
    n_a, n_b = at_a[links - 1] + 1, at_b[links - 1] + 1
    # groups end where tokens of both end
    cut = (ends_a[at_a] == ends) & (ends_b[at_b] == ends)
    cut_a, cut_b = at_a[cut] + 1, at_b[cut] + 1
    groups = np.searchsorted(ends[cut], piece_ends, side="right")
    # a group's tokens of A with a comma between and a bar behind them, then those of B and a semicolon
    of_a, of_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    shown = np.empty(len(a.ids) + len(b.ids), np.int64)
    shown[np.arange(len(a.ids)) + np.repeat(cut_b - of_b, of_a)] = 3 * a.ids
    shown[np.arange(len(b.ids)) + np.repeat(cut_a, of_b)] = 3 * b.ids
    shown[cut_a + cut_b - of_b - 1] += 1
    shown[cut_a + cut_b - 1] += 2
    digits = said[shown]
    there = digits != 0
    text, text_ends = digits[there].tobytes(), np.cumsum(there.sum(1))[n_a + n_b - 1]
    link = at = 0
    for a_n, b_n, n, to_link, to in zip(*(np.diff(x, prepend=0).tolist() for x in (n_a, n_b, groups)),
                                        (8 * links).tolist(), text_ends.tolist(), strict=True):
        yield a_n, b_n, n, codes[link:to_link], text[at:to]
        link, at = to_link, to


def _aligned(aligner: Aligner, texts: list[str | None]) -> pa.StructArray:
    numbers, digests, codes, ends = [], [], [], [0]
    for pieces in aligner.texts(texts):
        n_a, n_b, groups, links, shown = zip(*pieces, strict=True) if pieces else ((), (), (), (), ())
        digests.append(hashlib.sha256(b"".join(shown)[:-1]).hexdigest() if pieces else "")
        code, times = np.unique(np.frombuffer(b"".join(links), np.int64), return_counts=True)
        codes.append((code, times))
        ends.append(ends[-1] + len(code))
        numbers.append((sum(n_a), sum(n_b), sum(groups), int(times.sum())))
    cols = [pa.array(c, pa.int64()) for c in zip(*numbers, strict=True)] if numbers else [pa.array([], pa.int64())] * 4
    pair = pa.StructArray.from_arrays(
        [pa.array(np.concatenate([c[k] for c in codes]) if codes else [], pa.int64()) for k in (0, 1)], names=["pair", "n"])
    links = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pair)
    return pa.StructArray.from_arrays([*cols, pa.array(digests, pa.string()), links],
                                      names=["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])


ALIGNED = "struct<n_a:long,n_b:long,n_groups:long,n_links:long,groups_sha256:string,links:array<struct<pair:long,n:long>>>"


def align_tokens(df: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """Add ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256`` and
    ``links``, the number of links of each token pair, to every row.

    A pair is A's id times 2**32 plus B's id.  Null and empty texts, and texts that
    either tokenizer does not give back byte by byte, have no tokens: zeros, an
    empty digest and no links.  The tokenizer files' paths must be readable on every executor.
    Input columns named like a result column are replaced.
    """
    held = []

    @F.arrow_udf(ALIGNED)
    def aligned(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Aligner(path_a, path_b))
        gc.disable()  # millions of short-lived lists and no cycles: the collector would only count them
        try:
            out = [_aligned(held[0], texts.slice(i, 256).to_pylist()) for i in range(0, len(texts), 256)]
        finally:
            gc.enable()
        return pa.concat_arrays(out) if out else _aligned(held[0], [])

    new = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in new]
    made = df.select(*keep, aligned(F.col(f"`{text_col}`").cast("string")).alias("__aligned"))
    return made.select(*keep, *[F.col(f"__aligned.{c}").alias(c) for c in new])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best) of all rows' ``links``: how many links hold a pair,
    and whether no pair with the same id of B has more."""
    links = aligned.select(F.explode("links").alias("l"))
    counts = saved(links.groupBy(F.col("l.pair").alias("pair")).agg(F.sum("l.n").alias("count")), "token-pairs")
    b = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return saved(counts.withColumn("b", b).join(most, "b").select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best")), "token-pairs")


def rate_links(df: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """:func:`align_tokens` without ``links``, with ``n_best`` and ``count_sum``.

    ``count_sum`` adds up the corpus-wide counts of a row's links, ``n_best``
    counts the links whose pair is (among) the most frequent of its id of B.  The text
    is not carried.  An empty table gives an empty one.
    """
    new = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    rows = packed(df, new).withColumn("text", F.col("row").getField(text_col))
    rows = align_tokens(rows.withColumn("row", F.col("row").dropFields(text_col)), path_a, path_b).drop("text")
    rows = saved(rows.withColumn("id", F.monotonically_increasing_id()), "token-links")
    counts = pair_counts(rows)
    links = rows.select("id", F.explode("links").alias("l")).select("id", "l.pair", "l.n")
    # by shuffle at every size: the table of pairs has no bound but the vocabularies' product
    sums = links.join(counts.hint("shuffle_merge"), "pair").groupBy("id").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    out = rows.join(sums.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left")
    return unpacked(out, *new[:5], *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in new[5:]])
