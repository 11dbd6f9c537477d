"""Licence scan in DataFrame functions alone: sparse TF-IDF cosine of lines, blocks and texts to templates, then inheritance.

The scored units are every line, every block (adjoining lines joined; a line without a letter or digit ends a block) and
the whole text.  A unit's vector is the count of each term times the term's inverse document frequency among the
templates, ln((1 + T) / (1 + df)) + 1, where terms that no template holds have df 0; it is scored by cosine against each
template.  Units are scored once however often they are repeated.

Only units that can reach the threshold are scored, by two bounds that lose none.  The cosine is at most the root of the
sum of squared template weights of the shared terms, so one of the terms must be there that are left when terms whose
squares sum to less than the squared threshold are taken away.  And n words outside the templates, d of them different,
add at least n * n / d times their squared weight to the squared norm.

A file with a licence of its own stands for its directory when its name marks it as a licence file, when its licence
lines make at least a fifth of its words, or when its whole text reaches the threshold.  A block that scores higher than
each of its lines counts as licence lines.  A file without a licence of its own inherits that of the nearest directory
above it that has one; this is decided once per directory, by joins on the paths of its ancestors.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_audit.llm.common import stash

#: Licence id and its notice.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "proprietary": "All rights reserved.",
}
#: The lines that the SQL looks at; the operator looks at all.
MARKERS = ("cc0", "licence", "licenced", "license", "licensed", "redistribution", "reserved")
MARKER = rf"\b({'|'.join(MARKERS)})\b"
THRESHOLD, FILE_SHARE, SALTS = 0.6, 5, 16
#: Names of licence files: any beginning in capitals; otherwise the word alone or with the ending of a text.
LICENCE_FILE = r"(?:^|/)(?:(?:LICEN[CS]E|COPYING|NOTICE)[^/]*|(?i:licen[cs]es?|copying|notices?)(?i:\.(?:txt|md|rst|html?))?)$"
#: The bounds stay below the threshold by more than the rounding of a score.
SLACK = 1e-5
#: Between blocks: a line end, lines without a letter or digit, a line end.
_BETWEEN = "\\n[^A-Za-z0-9]*\\n"

#: Terms of a line in SQL; both engines read it alike.
_TERMS = "regexp_replace(lower({0}), '[^a-z0-9]+', ' ')"


def template_vectors(templates: dict[str, str]) -> tuple[dict[str, dict[str, float]], dict[str, float]]:
    """Unit vector of each template and the inverse document frequency of each term, worked out once from the parameter."""
    counts = {k: Counter(re.sub("[^a-z0-9]+", " ", v.lower()).split()) for k, v in templates.items()}
    df = Counter(t for c in counts.values() for t in c)
    idf = {t: math.log((1 + len(templates)) / (1 + n)) + 1 for t, n in df.items()}
    norms = {k: math.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items())) for k, c in counts.items()}
    return {k: {t: n * idf[t] / norms[k] for t, n in sorted(c.items())} for k, c in sorted(counts.items())}, idf


def template_weights(spark: SparkSession, templates: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(license, term, weight) and (term, idf)."""
    values = lambda rows, names: spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({names})")
    vectors, idf = template_vectors(templates)
    rows = []
    for name, vector in vectors.items():
        named = name.replace("\\", "\\\\").replace("'", "\\'")
        rows += [f"('{named}', '{t}', {w!r}D)" for t, w in vector.items()]
    return values(rows, "license, term, weight"), values([f"('{t}', {v!r}D)" for t, v in sorted(idf.items())], "term, idf")


def needed_terms(vectors: dict[str, dict[str, float]], threshold: float) -> list[str]:
    """Terms of which every unit of at least ``threshold`` holds one; short ones, which texts hold most, are left away first."""
    needed = set()
    for vector in vectors.values():
        left = 0.0
        for t in sorted(vector, key=lambda t: (len(t), t)):
            if left + vector[t] ** 2 < max(threshold - SLACK, 0.0) ** 2:
                left += vector[t] ** 2
            else:
                needed.add(t)
    return sorted(needed)


def candidates(units: DataFrame, templates: dict[str, str], threshold: float) -> DataFrame:
    """The rows of ``units`` whose ``line`` can reach ``threshold``; a superset of those that do."""
    vectors, idf = template_vectors(templates)
    known, rare = sorted(idf), math.log(1 + len(templates)) + 1
    # explode of one element: a filter on the value is not moved below it, so the value is worked out once
    held = lambda df, name, c: df.select("*", F.explode(F.array(c)).alias(name))
    rows = held(units, "_s", F.concat(F.lit(" "), F.trim(F.expr(_TERMS.format("line"))), F.lit(" ")))
    rows = rows.where(F.col("_s").rlike(f" (?:{'|'.join(needed_terms(vectors, threshold))}) "))
    shared = F.regexp_replace("_s", f" (?!(?:{'|'.join(known)}) )[a-z0-9]+", "")
    rows = held(rows, "_shared", F.split(F.trim(shared), " "))
    count = lambda t: F.size("_shared") - F.size(F.array_remove("_shared", t))
    rows = held(rows, "_tf", F.transform(F.array(*[F.lit(t) for t in known]), count))
    tf = {t: F.col("_tf")[k].cast("double") for k, t in enumerate(known)}
    total = lambda parts: reduce(lambda a, b: a + b, parts)
    dots = [total([tf[t] * (idf[t] * w) for t, w in vector.items()]) for vector in vectors.values()]
    inside = total([tf[t] * tf[t] * idf[t] ** 2 for t in known])
    others = F.length("_s") - F.length(F.replace("_s", F.lit(" "), F.lit(""))) - 1 - F.size("_shared")
    values = F.struct(F.greatest(*dots, F.lit(0.0)).alias("dot"), inside.alias("inside"), F.greatest(others, F.lit(0)).cast("double").alias("n"))
    rows = held(rows, "_v", values)
    reach = lambda outside: F.col("_v.dot") >= (threshold - SLACK) * F.sqrt(F.col("_v.inside") + outside * rare**2)
    rows = held(rows.where(reach(F.col("_v.n"))), "_d", F.size(F.array_distinct(F.split(F.trim("_s"), " "))) - F.size(F.array_distinct("_shared")))
    return rows.where(reach(F.col("_v.n") * F.col("_v.n") / F.greatest(F.col("_d"), F.lit(1)))).select(*units.columns)


def line_licenses(lines: DataFrame, templates: dict[str, str], threshold: float) -> DataFrame:
    """(line, license, score) of the distinct lines of at least ``threshold``; ties go to the smaller licence id."""
    spark = lines.sparkSession
    weights, idf = template_weights(spark, templates)
    rare = F.log(F.lit(1.0 + len(templates))) + 1
    terms = F.explode(F.split(F.trim(F.expr(_TERMS.format("line"))), " "))
    counted = lines.select("line").distinct().select("line", terms.alias("term")).groupBy("line", "term").agg(F.count(F.lit(1)).alias("tf"))
    vector = counted.join(F.broadcast(idf), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", rare)).drop("idf", "tf")
    norm = vector.groupBy("line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = vector.join(F.broadcast(weights), "term").groupBy("line", "license").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(norm, "line").withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
    best = F.max_by(F.struct("license", "score"), F.struct("score", F.col("rank")))
    # ties in score go to the smaller licence id
    names = F.array(*[F.lit(k) for k in sorted(templates, reverse=True)])
    ranked = scored.where(F.col("score") >= threshold).withColumn("rank", F.array_position(names, F.col("license")))
    return ranked.groupBy("line").agg(best.alias("b")).select("line", "b.license", "b.score")


def scan(
    files: DataFrame,
    key: str = "doc_id",
    path: str = "path",
    text: str = "text",
    templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    file_share: int = FILE_SHARE,
) -> DataFrame:
    """doc_id, path, license, score, basis and from_path for every row of ``files``.

    ``basis`` is "own" (the best of the file's lines, blocks and whole text; ties to the smaller licence id), "inherited" (``from_path``
    is the licence file: of one directory the best score, then the smallest licence and path) or "none" with nulls.
    Null and empty texts have no line; a null path inherits nothing; a path without a slash lies in the directory "".
    Repeated rows are returned each; rows that share id and path count as one file.  Other columns are ignored.
    """
    rows = files.select(F.col(key).cast("long").alias("doc_id"), F.col(path).cast("string").alias("path"), F.col(text).cast("string").alias("text"))
    n_words = lambda c: F.size(F.split(F.trim(F.regexp_replace(c, "[ \\t\\n]+", " ")), " "))
    blocks = rows.where(F.col("text").isNotNull()).select("doc_id", "path", "text", F.posexplode(F.split("text", _BETWEEN)).alias("block", "body"))
    # a block with its lines; the whole text, where it has more than one block, goes with the first one
    several = F.split("body", "\n")
    unit = lambda kind, c: F.transform(c, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("line")))
    joined = F.when(F.size(several) > 1, F.array("body")).otherwise(F.array().cast("array<string>"))
    whole = F.when((F.col("block") == 0) & F.col("text").rlike(_BETWEEN), F.array("text")).otherwise(F.array().cast("array<string>"))
    units = blocks.select("doc_id", "path", "text", "block", F.posexplode(F.concat(unit("line", several), unit("block", joined), unit("text", whole))).alias("at", "u"))
    units = units.select("doc_id", "path", "text", "block", "at", "u.kind", "u.line")
    held = candidates(units, templates, threshold).withColumn("n_words", n_words("text")).drop("text")
    lines = stash(held.distinct(), "licence-lines")
    found = lines.join(line_licenses(lines, templates, threshold), "line")
    best = F.min(F.struct((-F.col("score")).alias("s"), "license"))
    of = lambda kind, c: F.when(F.col("kind") == kind, c)
    by_block = found.withColumn("size", n_words("line")).groupBy("doc_id", "path", "n_words", "block").agg(
        best.alias("b"),
        F.max(of("line", F.col("score"))).alias("line_score"), F.coalesce(F.sum(of("line", F.col("size"))), F.lit(0)).alias("n_lines"),
        F.max(of("block", F.col("score"))).alias("block_score"), F.max(of("block", F.col("size"))).alias("n_block"),
        F.max(F.col("kind") == "text").alias("whole"),
    )
    size = F.when(F.col("block_score") > F.coalesce("line_score", F.lit(0.0)), F.col("n_block")).otherwise(F.col("n_lines"))
    own = stash(
        by_block.groupBy("doc_id", "path").agg(F.min("b").alias("b"), F.sum(size).alias("n_licence"), F.max("n_words").alias("n_words"), F.max("whole").alias("whole"))
        .select("doc_id", "path", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"), "n_licence", "n_words", "whole"),
        "licences",
    )
    folder = F.regexp_replace("path", "/?[^/]*$", "")
    standing = own.where((F.col("whole") | F.col("path").rlike(LICENCE_FILE) | (F.col("n_licence") * file_share >= F.col("n_words"))) & F.col("path").isNotNull())
    chosen = F.min(F.struct((-F.col("score")).alias("s"), "license", "path"))
    of_folder = standing.groupBy(folder.alias("above")).agg(chosen.alias("c")).select("above", "c.license", F.col("c.path").alias("from_path"), (-F.col("c.s")).alias("score"))
    folders = rows.where(F.col("path").isNotNull()).select(folder.alias("folder")).distinct()
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    ancestors = folders.select("folder", F.posexplode(F.array_distinct(above)).alias("depth", "above"))
    nearest = ancestors.join(of_folder, "above").groupBy("folder").agg(F.max_by(F.struct("license", "score", "from_path"), "depth").alias("i"))
    # a folder may hold a third of all files: its row is laid out for each salt
    salted = nearest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    mine = own.select(F.col("doc_id").alias("_id"), F.col("path").alias("_path"), F.struct("license", "score").alias("o"))
    out = rows.select("doc_id", "path", folder.alias("folder")).withColumn("salt", F.pmod(F.xxhash64("doc_id", "path"), F.lit(SALTS)).cast("int"))
    out = out.join(mine, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("path").eqNullSafe(F.col("_path")), "left")
    out = out.join(salted, ["folder", "salt"], "left")
    return out.select(
        "doc_id",
        "path",
        F.coalesce("o.license", "i.license").alias("license"),
        F.coalesce("o.score", "i.score").alias("score"),
        F.when(F.col("o").isNotNull(), "own").when(F.col("i").isNotNull(), "inherited").otherwise("none").alias("basis"),
        F.when(F.col("o").isNull(), F.col("i.from_path")).alias("from_path"),
    )


def document_path(key: str = "doc_id") -> str:
    """SQL of the path a document gets in the query: three kinds of depth below its source."""
    return (
        f"CASE {key} % 3 WHEN 0 THEN concat(source, '/', {key}, '.txt') WHEN 1 THEN concat(source, '/', lang, '/', {key}, '.txt') "
        f"ELSE concat(source, '/', lang, '/', CAST(floor({key} / 100) AS BIGINT), '/', {key}, '.txt') END"
    )


def oracle() -> str:
    """The scan of ``documents`` in SQL, with the default parameters."""
    notices = ", ".join(f"('{k}', '{v}')" for k, v in sorted(TEMPLATES.items()))
    terms = "string_split(trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g')), ' ')"
    n_words = "len(string_split(trim(regexp_replace({0}, '[ \\t\\n]+', ' ', 'g')), ' '))"
    return rf"""
    WITH files AS (SELECT doc_id, {document_path()} AS path, text FROM documents),
    f AS (SELECT *, regexp_replace(path, '/?[^/]*$', '') AS folder FROM files),
    notice(license, body) AS (VALUES {notices}),
    tf AS (SELECT license, term, count(*) AS tf FROM (SELECT license, unnest({terms.format('body')}) AS term FROM notice) GROUP BY ALL),
    idf AS (SELECT term, ln({len(TEMPLATES) + 1}.0 / (1 + count(*))) + 1 AS idf FROM tf GROUP BY term),
    tw AS (SELECT license, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY license)) AS weight FROM tf JOIN idf USING (term)),
    l0 AS (SELECT doc_id, path, {n_words.format('text')} AS n_words, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS at FROM files WHERE text IS NOT NULL),
    l AS (SELECT * FROM l0 WHERE regexp_matches(lower(line), '{MARKER}')),
    v0 AS (SELECT line, term, count(*) AS n FROM (SELECT line, unnest({terms.format('line')}) AS term FROM (SELECT DISTINCT line FROM l)) GROUP BY ALL),
    v AS (SELECT line, term, n * coalesce(idf, ln({len(TEMPLATES) + 1}.0) + 1) AS w FROM v0 LEFT JOIN idf USING (term)),
    nrm AS (SELECT line, sqrt(sum(w * w)) AS norm FROM v GROUP BY line),
    sc AS (SELECT line, license, round(sum(w * weight) / any_value(norm), 6) AS score FROM v JOIN tw USING (term) JOIN nrm USING (line) GROUP BY line, license),
    ll AS (SELECT line, license, score FROM sc WHERE score >= {THRESHOLD}
           QUALIFY row_number() OVER (PARTITION BY line ORDER BY score DESC, license) = 1),
    hit AS (SELECT l.*, license, score, {n_words.format('l.line')} AS n_line FROM l JOIN ll USING (line)),
    tot AS (SELECT doc_id, path, sum(n_line) AS n_licence FROM hit GROUP BY ALL),
    own AS (SELECT doc_id, path, license, score, n_words, n_licence FROM hit JOIN tot USING (doc_id, path)
            QUALIFY row_number() OVER (PARTITION BY doc_id, path ORDER BY score DESC, license) = 1),
    fold AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS above, license, score, path AS from_path FROM own WHERE n_licence * {FILE_SHARE} >= n_words
             QUALIFY row_number() OVER (PARTITION BY regexp_replace(path, '/?[^/]*$', '') ORDER BY score DESC, license, path) = 1),
    near AS (SELECT f.folder, fold.* FROM (SELECT DISTINCT folder FROM f) f JOIN fold ON f.folder = fold.above OR starts_with(f.folder, fold.above || '/')
             QUALIFY row_number() OVER (PARTITION BY f.folder ORDER BY length(above) DESC) = 1)
    SELECT f.doc_id, f.path, coalesce(own.license, near.license) AS license, coalesce(own.score, near.score) AS score,
           CASE WHEN own.license IS NOT NULL THEN 'own' WHEN near.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS basis,
           CASE WHEN own.license IS NULL THEN near.from_path END AS from_path
    FROM f LEFT JOIN own ON f.doc_id = own.doc_id AND f.path = own.path LEFT JOIN near USING (folder)
    """
