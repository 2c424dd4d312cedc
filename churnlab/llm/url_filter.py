"""URL filters: pattern rules indexed by their rarest literal token.

A rule is ``host/path`` with an action.  It fits its host and all subdomains
when the URL's path starts with the rule's path; ``*`` in a rule stands for
any characters, and a rule without a path fits its host up to the host's end.  A rule ``~word`` fits the hosts that hold the word between
characters other than letters and digits; such rules decide only where no
host rule fits.  A rule's literal tokens are its complete host labels and its
complete path segments (or its word), that is, the pieces any fitting URL must
hold as whole pieces too.  Each rule is filed under the one of its tokens that the
fewest URLs hold; a URL's tokens fetch candidate rules, and only those run
their regular expression.  Rules without a complete token are filed under the
empty token, which every URL holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.llm.common import ascii_lower, packed, saved, unpacked

#: Everything from the first "://": the host, then the path.
URL_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules from a list of (action, rule)."""
    return spark.createDataFrame(list(rules), "action string, rule string")


def _tokens(host: Column, segments: Column) -> Column:
    labels = F.transform(F.split(host, "\\."), lambda x: F.concat(F.lit("h:"), x))
    parts = F.transform(segments, lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(labels, parts))


def _host_words(host: Column) -> Column:
    return F.transform(F.split(host, "[^a-z0-9]+"), lambda x: F.concat(F.lit("w:"), x))


def _compiled(rules: DataFrame) -> DataFrame:
    """Rules with their regular expression and complete literal tokens."""
    host = ascii_lower(F.regexp_extract("rule", "(?s)^([^/]*)(.*)$", 1))
    path = F.regexp_extract("rule", "(?s)^([^/]*)(.*)$", 2)
    quoted = F.concat(F.lit("\\Q"), F.replace(F.concat(host, path), F.lit("*"), F.lit("\\E.*\\Q")), F.lit("\\E"))
    # a rule that is a host alone fits up to that host's end
    quoted = F.when(path == "", F.concat(quoted, F.lit("(?:/|$)"))).otherwise(quoted)
    pieces = F.split(path, "/", -1)
    whole = F.slice(pieces, 2, F.greatest(F.size(pieces) - 2, F.lit(0)))
    literal = F.filter(_tokens(host, whole), lambda t: (F.length(t) > 2) & ~t.contains("*"))
    word = F.when(F.col("rule").startswith("~"), ascii_lower(F.substr("rule", F.lit(2))))
    regex = F.when(word.isNotNull(), F.concat(F.lit("^(?:[^/]*[^a-z0-9/])?\\Q"), word, F.lit("\\E(?:[^a-z0-9]|$)"))).otherwise(
        F.concat(F.lit("(?s)^(?:[^/]*\\.)?"), quoted))
    tokens = F.when(word.rlike("^[a-z0-9]+$"), F.array(F.concat(F.lit("w:"), word))).when(
        word.isNull() & (F.size(literal) > 0), literal).otherwise(F.array(F.lit("")))
    return rules.where(F.col("rule").isNotNull()).dropDuplicates(["rule", "action"]).select(
        "rule", "action", regex.alias("regex"), tokens.alias("tokens"))


def judge_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``df``.

    ``rules`` has ``rule`` and ``action``.  Of the rules that fit, the longest
    wins (of equally long ones, the first in text order).  A row that only
    ``~word`` rules fit has a null rule and the verdict of the longest of them,
    a row that no rule fits a null rule and the verdict ``default``.  A null URL, or one
    without ``://``, has empty host and path.  Every row comes back once,
    repeated rows included; input columns with the name of a result column
    are replaced.  Equal URLs are judged once.
    """
    new = ("host", "path", "rule", "verdict")
    url = F.col(f"`{url_col}`")
    rows = packed(df.withColumns({"__host": host_of(url), "__path": path_of(url)}), new).select(
        "row", F.col("row.__host").alias("host"), F.col("row.__path").alias("path"))
    rows = rows.withColumn("row", F.col("row").dropFields("__host", "__path"))
    urls = rows.select("host", "path").distinct()
    tokens = urls.select("host", "path", F.explode(F.array_append(
        F.filter(F.array_union(_tokens(F.col("host"), F.split("path", "/")), _host_words(F.col("host"))),
                 lambda t: F.length(t) > 2), F.lit(""))).alias("token"))

    compiled = _compiled(rules)
    known = compiled.select(F.explode("tokens").alias("token")).distinct()
    held = tokens.join(known, "token").groupBy("token").count()
    index = (compiled.withColumn("token", F.explode("tokens")).join(held, "token", "left")
             .groupBy("rule", "action", "regex")
             .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token"))["token"].alias("token")))
    index = saved(index, "url-rules")

    by_word = F.col("rule").startswith("~")
    best = F.min_by(F.struct(F.when(~by_word, F.col("rule")).alias("rule"), "action"),
                    F.struct(by_word, -F.length("rule"), "rule", "action"))
    found = (tokens.join(index, "token")
             .where(F.regexp_like(F.concat("host", "path"), F.col("regex")))
             .groupBy("host", "path").agg(best.alias("best"))
             .select(F.col("host").alias("__h"), F.col("path").alias("__p"), "best"))
    judged = rows.join(found, (F.col("host") == F.col("__h")) & (F.col("path") == F.col("__p")), "left")
    return unpacked(judged, "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.action", F.lit(default)).alias("verdict"))
