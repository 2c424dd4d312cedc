"""Token counts: count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary's pieces in a text; the
dynamic programme keeps, per position, the best score and the number of pieces
on the way there, and no way back.  Ties follow the tokenizer: of equally good
pieces that end at a position the longest (the one that starts first) stays,
and the unknown piece, which stands in where no piece is the single
character, is tried last and wins only if strictly better.

No piece of the usual vocabularies reaches from a word into the space mark
that follows, so that a text's best path is the best paths of its words; words
are looked up in a table of words already counted.  Where a vocabulary has
such pieces, whole texts are counted in one go.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Words kept in a worker's table; it is emptied beyond that.
KNOWN = 400_000


def read_vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """Pieces with their scores, and the unknown piece's id, of a sentencepiece model file."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], model.unk_id()


class PieceCounter:
    """Counts the pieces of the best segmentation, and its score."""

    def __init__(self, pieces: Sequence[tuple[str, float]]):
        import ahocorasick
        self.found = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.found.add_word(piece, (len(piece), score))
        self.found.make_automaton()
        self.longest = max(len(p) for p, _ in pieces)
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        names = {p for p, _ in pieces}
        self.bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        crosses = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in names)
        self.lines = not any("\n" in p for p in names)
        # without byte pieces, neighbouring unknown characters are one piece, across words too
        self.by_word = self.bytes and not crosses
        cut = "\n" if self.lines else ""
        self.words = re.compile(f"{SPACE}*[^{SPACE}{cut}]+|{SPACE}+" + (f"|{cut}" if cut else ""))
        self.known: dict[str, tuple[float, int]] = {}

    def _best(self, chunk: str) -> tuple[float, int]:
        n, size = len(chunk), min(len(chunk), self.longest) + 1
        score, count, open_ = [0.0] * size, [0] * size, [False] * size
        matches = self.found.iter(chunk)
        at, match = next(matches, (n, None))
        best, pieces, unknown = 0.0, 0, False
        for end in range(1, n + 1):
            last, last_pieces, last_unknown = best, pieces, unknown
            best, single, unknown = None, False, False
            while at == end - 1:
                length, s = match
                start = (end - length) % size
                s += score[start]
                if best is None or s > best:
                    best, pieces = s, count[start] + 1
                single = single or length == 1
                at, match = next(matches, (n, None))
            if not single and (best is None or last + self.unknown > best):
                best, unknown = last + self.unknown, True
                cost = len(chunk[end - 1].encode("utf-8", "replace")) if self.bytes else int(not last_unknown)
                pieces = last_pieces + cost
            score[end % size], count[end % size], open_[end % size] = best, pieces, unknown
        return best, pieces

    def count(self, text: str | None) -> tuple[int, float]:
        """Tokens and score; none and zero for a null or empty text."""
        if not text:
            return 0, 0.0
        line = SPACE + text.replace(" ", SPACE)
        if not self.by_word:
            score, pieces = self._best(line)
            return pieces, score
        total, tokens, known = 0.0, 0, self.known
        for word in self.words.findall(line):
            got = known.get(word)
            if got is None:
                got = self._best(word)
                if len(known) >= KNOWN:
                    known.clear()
                if len(word) <= 64:
                    known[word] = got
            total += got[0]
            tokens += got[1]
        return tokens, total


def add_token_count(df: DataFrame, pieces: Sequence[tuple[str, float]], text_col: str = "text") -> DataFrame:
    """Add ``n_tokens`` (long) and ``token_score`` (double) to every row.

    ``pieces`` is a tokenizer's vocabulary (tens of thousands of entries,
    sent to the workers once).  Null and empty texts have no tokens; a text of
    spaces has those of the space marks.  Input columns named like a result
    column are replaced.
    """
    sent = df.sparkSession.sparkContext.broadcast(list(pieces))
    held = []

    @F.arrow_udf("struct<n_tokens: bigint, token_score: double>")
    def tokens(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(PieceCounter(sent.value))
        rows = [held[0].count(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([n for n, _ in rows], pa.int64()),
                                           pa.array([s for _, s in rows], pa.float64())],
                                          names=["n_tokens", "token_score"])

    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("n_tokens", "token_score")]
    counted = df.select(*keep, tokens(F.col(f"`{text_col}`").cast("string")).alias("__tokens"))
    return counted.select(*keep, F.col("__tokens.n_tokens"), F.col("__tokens.token_score"))
