"""License scans: TF-IDF cosine to templates, then inheritance down the tree.

Every line of every file is a possible licence header; files with a licence
file's name are compared as a whole as well.  Terms are the templates' words;
a word that no template has weighs as much as a term found in one file.
Document frequencies are counted over all files.

Most lines never come to the cosine: each template's heaviest terms are its
anchors, as many as it takes for the others together to stay below the
threshold, so a line without an anchor cannot reach it.

A file without a licence of its own inherits that of the licence file in the
nearest directory above it (its own included).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.llm.common import packed, saved, unpacked

#: Short wordings of common licences, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
)
THRESHOLD = 0.75
LICENSE_FILE = "(?i)^(licen[sc]e|copying|notice)([._-].*)?$"
_TERM = "[^\\p{L}\\p{N}]+"


def terms(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), _TERM), "")


def _vector(spark, templates):
    rows = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(templates)], "t int, name string, text string")
    return [(r.t, r.name, r.w) for r in rows.select("t", "name", terms(F.col("text")).alias("w")).collect()]


def _weights(files: DataFrame, templates: Sequence[tuple[str, str]], threshold: float):
    """Term weights, the weight of any other word, the templates' unit vectors, and the anchors."""
    wordings = _vector(files.sparkSession, templates)
    vocabulary = sorted({w for _, _, ws in wordings for w in ws})
    held = F.array_intersect(terms(F.coalesce("text", F.lit(""))), F.lit(vocabulary))
    n_files = files.count()
    df = {r.term: r["count"] for r in files.select(F.explode(held).alias("term")).groupBy("term").count().collect()}
    weight = {w: math.log((1 + n_files) / (1 + df.get(w, 0))) + 1 for w in vocabulary}
    vectors, anchors = [], set()
    for _, name, ws in wordings:
        v = {w: ws.count(w) * weight[w] for w in set(ws)}
        norm = math.sqrt(sum(x * x for x in v.values()))
        v = {w: x / norm for w, x in v.items()}
        rest = 1.0
        for w, x in sorted(v.items(), key=lambda e: (-e[1], e[0])):
            if math.sqrt(max(0.0, rest)) < threshold:
                break
            anchors.add(w)
            rest -= x * x
        vectors.append((name, v))
    return weight, math.log((1 + n_files) / 2) + 1, vectors, sorted(anchors)


def best_license(text: Column, weight: dict, other: float, vectors: list) -> Column:
    """(score, name) of the template nearest to ``text``; of equals, the first name."""
    words = terms(text)
    known = sorted(weight)
    table = F.create_map(*[x for w in known for x in (F.lit(w), F.lit(weight[w]))])
    # (term, tf x idf) for each different word of the text
    scaled = F.transform(F.array_distinct(words), lambda w: F.struct(w.alias("w"), (
        F.size(F.filter(words, lambda x: x == w)) * F.coalesce(F.element_at(table, w), F.lit(other))).alias("x")))
    norm = F.sqrt(F.aggregate(scaled, F.lit(0.0), lambda a, e: a + e.x * e.x))

    def cosine(v):
        unit = F.create_map(*[x for w in sorted(v) for x in (F.lit(w), F.lit(v[w]))])
        dot = F.aggregate(scaled, F.lit(0.0), lambda a, e: a + e.x * F.coalesce(F.element_at(unit, e.w), F.lit(0.0)))
        return F.round(F.coalesce(F.try_divide(dot, norm), F.lit(0.0)), 9)

    nearest = F.array_sort(F.array(*[F.struct((-cosine(v)).alias("s"), F.lit(name).alias("name")) for name, v in vectors]))
    return F.struct((-F.get(nearest, F.lit(0)).s).alias("score"), F.get(nearest, F.lit(0)).getField("name").alias("name"))


def directory(path: Column) -> Column:
    """Everything before the last slash; empty at the top."""
    return F.regexp_extract(F.coalesce(path, F.lit("")), "(?s)^(.*)/[^/]*$", 1)


def scan_licenses(df: DataFrame, path_col: str = "path", text_col: str = "text",
                  templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``license``, ``score``, ``basis`` and ``license_dir`` to every file.

    ``basis`` is ``file`` (a licence file), ``header``, ``inherited`` or null
    with a null ``license``.  ``license_dir`` is the directory whose licence file an
    inherited licence comes from.  Of several lines the best counts, of
    equals the first name; the same holds for several licence files of a
    directory.  A null text has no lines, a null path lies at the top; files
    with equal path and text are judged alike.  Input columns named like a
    result column are replaced.
    """
    new = ("license", "score", "basis", "license_dir")
    rows = packed(df, new)
    path, text = (F.col("row").getField(c).cast("string") for c in (path_col, text_col))
    files = df.select(F.col(f"`{path_col}`").cast("string").alias("path"), F.col(f"`{text_col}`").cast("string").alias("text"))
    weight, other, vectors, anchors = _weights(files, templates, threshold)

    named = F.regexp_like(F.regexp_extract(F.coalesce("path", F.lit("")), "(?s)([^/]*)$", 1), F.lit(LICENSE_FILE))
    held = files.select("path", F.xxhash64("text").alias("hash"), named.alias("named"), "text").where(
        F.arrays_overlap(terms(F.col("text")), F.lit(anchors)))
    lines = held.select("path", "hash", "named", F.explode(
        F.array_union(F.split("text", "\n"), F.when(F.col("named"), F.array("text")).otherwise(
            F.array().cast("array<string>")))).alias("line"))
    lines = saved(lines.where(F.arrays_overlap(terms(F.col("line")), F.lit(anchors))), "license-lines")
    scored = lines.select("line").distinct().select(F.col("line").alias("l"), best_license(
        F.col("line"), weight, other, vectors).alias("best")).where(F.col("best.score") >= threshold)
    own = (lines.join(scored, F.col("line") == F.col("l")).groupBy("path", "hash", "named")
           .agg(F.min(F.struct((-F.col("best.score")).alias("s"), F.col("best.name").alias("name"))).alias("b")))
    own = saved(own.select(F.col("path").alias("p"), F.col("hash").alias("h"), "named", F.col("b.name").alias("own"),
                           (-F.col("b.s")).alias("own_score")), "license-own")

    granted = own.where("named").groupBy(directory(F.col("p")).alias("top")).agg(
        F.min(F.struct((-F.col("own_score")).alias("s"), F.col("own").alias("name"))).alias("b")).select(
        "top", F.col("b.name").alias("granted"), (-F.col("b.s")).alias("granted_score"))
    dirs = files.select(directory(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.array_append(
        F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")),
        F.lit("")))).alias("above"))
    nearest = above.join(granted, F.col("above") == F.col("top")).groupBy("dir").agg(
        F.max_by(F.struct("top", "granted", "granted_score"), F.length("top")).alias("g"))
    nearest = saved(nearest.select("dir", "g.*"), "license-dirs")

    mine = path.eqNullSafe(F.col("p")) & (F.xxhash64(text) == F.col("h"))
    judged = rows.join(own, mine, "left").join(nearest, directory(path) == F.col("dir"), "left")
    basis = F.when(F.col("own").isNotNull(), F.when(F.col("named"), "file").otherwise("header")).when(
        F.col("granted").isNotNull(), "inherited")
    return unpacked(judged, F.coalesce("own", "granted").alias("license"),
                    F.coalesce("own_score", "granted_score").alias("score"), basis.alias("basis"),
                    F.when(F.col("own").isNull(), F.col("top")).alias("license_dir"))
