"""Secret scans: plain patterns, and credentials whose parts lie apart.

The base kinds are patterns of their own (``BASE``).  Multipart credentials
have weak parts, each too common to report alone: access identifiers, secret
strings and endpoints.  A weak part is reported only when a complementary part
lies in the same scope, that is, within ``SCOPE`` code points: an identifier
with a secret, or an endpoint with a secret.  Base spans are parts too: an
``access`` key is an identifier, ``assign`` and ``hex`` are secrets.

Spans come from the match strings and the pieces between them, whose lengths
add up to the positions.  Linking is an interval join: parts are filed under
the scope-wide bins they reach into, parts of different kinds meet in a bin,
and their distance decides.  A bin holds a bounded number of parts (matches of
a kind do not overlap and have a least length), so no pair list grows with
the length of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import let, packed, running_sum, saved, unpacked

#: kind, pattern, group that must have the least length, least length.  Where the pattern itself demands the
#: length, matches are the same as those of the open pattern with short ones dropped.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", "[0-9a-f]{16,}", 0, 16),
)
#: Weak parts: kind, pattern.  An identifier or secret is a whole run of its characters.
PARTS = (
    ("identifier", "(?<![A-Za-z0-9])(?=[A-Z0-9]{0,31}[0-9])(?=[A-Z0-9]{0,31}[A-Z])[A-Z0-9]{16,32}(?![A-Za-z0-9])"),
    # of any length: the looks ahead and the run are possessive, so each passes over a run once
    ("secret", "(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*+[0-9])(?=[0-9+/]*+[A-Za-z])"
               "[A-Za-z0-9+/]{32,}+={0,2}(?![A-Za-z0-9+/=])"),
    ("endpoint", r"https?://[A-Za-z0-9](?:[A-Za-z0-9.-]{0,252}[A-Za-z0-9])?(?::[0-9]{1,5})?"),
)
SCOPE = 200
ORDER = [k for k, *_ in BASE] + [k for k, _ in PARTS]
#: Kinds that stand for the secret; all others complement it.
SECRETS = [ORDER.index(k) for k in ("assign", "hex", "secret")]


def _spans(text: Column, kind: str, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Array of (start, end, kind) of the pattern's matches, code points, end exclusive.

    The text is matched and cut once; positions are the running sum of the lengths of the pieces between
    matches and of the matches, so that the work is in proportion to the text's length."""
    regex = F.lit(pattern)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    tested = F.regexp_extract_all(text, regex, F.lit(group)) if group and least else F.lit(None).cast("array<string>")
    between = F.split(text, pattern, -1)

    def sizes(x):
        return F.struct(F.transform(x.whole, lambda m: F.length(m).cast("long")).alias("whole"),
                        F.transform(x.gaps, lambda p: F.length(p).cast("long")).alias("gaps"), x.tested.alias("tested"))

    def placed(x):
        steps = F.zip_with(x.whole, F.slice(x.gaps, 1, F.size(x.whole)), lambda m, p: m + p)

        def spans(before):
            every = F.transform(x.whole, lambda n, i: F.struct(
                (F.get(before, i) + F.get(x.gaps, i)).cast("int").alias("start"),
                (F.get(before, i) + F.get(x.gaps, i) + n).cast("int").alias("end"),
                F.lit(ORDER.index(kind)).alias("kind")))
            if not (group and least):
                return every
            return F.filter(every, lambda s, i: F.length(F.get(x.tested, i)) >= least)

        return let(running_sum(steps), spans)

    found = let(F.struct(whole.alias("whole"), between.alias("gaps"), tested.alias("tested")), lambda x: let(sizes(x), placed))
    empty = F.array().cast("array<struct<start:int,end:int,kind:int>>")
    return F.when(F.regexp_like(text, regex), found).otherwise(empty)


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.lit(ORDER)
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")


def linked_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts among ``parts`` (key, start, end, kind) with a
    complementary part within ``scope``.

    ``kind`` indexes ``ORDER``; a secret complements identifiers and
    endpoints.  Distance is that between the nearest ends, zero where spans
    overlap.  Of parts in one place the first kind stays, a base kind before a weak one.
    """
    parts = parts.groupBy("key", "start", "end").agg(F.min("kind").alias("kind"))
    binned = parts.select("*", F.explode(F.sequence(
        F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))).alias("bin"))
    secrets = binned.where(F.col("kind").isin(SECRETS))
    others = parts.where(~F.col("kind").isin(SECRETS)).select(
        F.col("key").alias("key2"), F.col("start").alias("start2"), F.col("end").alias("end2"),
        F.col("kind").alias("kind2"), F.floor(F.col("start") / scope).alias("bin2"))
    near = (F.col("start2") <= F.col("end") + scope) & (F.col("start") <= F.col("end2") + scope)
    # the start of a part that is near lies within the bins that the secret reaches, or up to a part's length before
    reach = F.floor((F.col("end2") - F.col("start2") + scope) / scope)
    others = others.withColumn("bin2", F.explode(F.sequence(F.col("bin2"), F.col("bin2") + reach)))
    met = secrets.join(others, (F.col("key") == F.col("key2")) & (F.col("bin") == F.col("bin2")) & near)
    both = F.array(F.struct("start", "end", "kind"),
                   F.struct(F.col("start2").alias("start"), F.col("end2").alias("end"), F.col("kind2").alias("kind")))
    weak = F.filter(both, lambda s: s.kind >= len(BASE))
    return met.select("key", F.explode(weak).alias("s")).select("key", "s.*").distinct()


def scan_secrets(df: DataFrame, text_col: str = "text", scope: int = SCOPE, carry_text: bool = True) -> DataFrame:
    """Add ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans``.

    A null text is empty.  Parts that equal a base span in place are not
    reported again.  Every row comes back once; copies of a text are linked
    once.  Input columns named like a result column are replaced.
    ``carry_text=False`` leaves the text out of what is written in between
    and of the result.
    """
    new = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    text = F.coalesce(F.col("row").getField(text_col), F.lit(""))
    rows = packed(df, new).withColumn("text", text)
    if not carry_text:
        rows = rows.withColumn("row", F.col("row").dropFields(text_col))
    rows = rows.select("row", "text", *[_spans(F.col("text"), *b).alias(b[0]) for b in BASE],
                       *[_spans(F.col("text"), *p).alias(f"w_{p[0]}") for p in PARTS])
    base = F.concat(*[F.col(b[0]) for b in BASE])
    rows = rows.withColumn("base", base).withColumn("weak", F.concat(*[F.col(f"w_{p[0]}") for p in PARTS]))
    parts = F.concat("base", "weak")
    pair = (F.size("weak") > 0) & F.exists(parts, lambda s: s.kind.isin(SECRETS)) & F.exists(
        parts, lambda s: ~s.kind.isin(SECRETS))
    # rows that cannot link get a key of their own, so that none of them share a partition
    key = F.when(pair, F.sha2("text", 256)).otherwise(F.concat(F.lit("-"), F.hex(F.xxhash64("row", "text"))))
    rows = saved(rows.select("row", "base", key.alias("key"), F.when(pair, parts).alias("parts"),
                             *[F.size(b[0]).cast("long").alias(f"n_{b[0]}") for b in BASE]), "secret-spans")
    parts = rows.where("parts is not null").select("key", F.explode("parts").alias("s")).select("key", "s.*")
    links = linked_parts(parts, scope).groupBy("key").agg(
        F.collect_list(F.struct("start", "end", "kind")).alias("linked")).withColumnRenamed("key", "k")
    out = rows.join(links, F.col("key") == F.col("k"), "left")
    both = F.when(F.col("linked").isNull(), F.col("base")).otherwise(F.concat("base", "linked"))
    return unpacked(out, "n_assign", "n_access", "n_hex", F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                    joined(both).alias("spans"))
