"""Licence scan on DataFrame functions alone: TF-IDF cosine of lines to templates, then inheritance by path.

Every line of every text is a unit (headers, footers, notices anywhere); a file whose name
marks a licence file is also one unit as a whole.  Terms are runs of a-z and 0-9 after
lower-casing.  A term's idf is ln((1 + N) / (1 + df)) + 1 with df counted over all documents for
the terms of the templates; other terms have the idf of a term never seen (df = 0).  A unit takes the template
with the highest cosine from ``THRESHOLD`` on; a file takes its best unit.

Only units that hold a heavy term of some template are scored.  That loses nothing: a template's light
terms are those whose weights together have a norm under ``THRESHOLD`` of the template's, so a
unit with light terms only stays under the threshold.

A directory's licence is declared by the licence files in it: files with such a name, or, with
``by_edge_line`` (for corpora without file names), texts whose notice is their first or last line.  Of several, the most
frequent licence counts, then the first by name.  Files without a licence of their own inherit from the
nearest directory above, found by joining the distinct directories' ancestors to the declaring ones.

Edge cases: null and empty texts have no unit; a null path is ``''`` and has the root as its directory; repeated rows are
files of their own; ties go to the higher score, the earlier line, the first name; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import materialize

THRESHOLD = 0.6

#: FIXED VALUES: notices of public licences, by SPDX name.
TEMPLATES = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]
LICENCE_NAME = r"(?i)^(licen[cs]e|copying|notice|unlicense)([-._].*)?$"
_TERM = re.compile("[a-z0-9]+")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda x: x != "")


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({t for _, text in templates for t in terms(text)})


def weights(idf: dict[str, float], templates=TEMPLATES) -> tuple[list[tuple], set[str]]:
    """(template, licence, term, weight over the template's norm) and the heavy terms."""
    rows, heavy = [], set()
    for i, (name, text) in enumerate(templates):
        w = {t: n * idf[t] for t, n in Counter(terms(text)).items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        light = 0.0
        for t, x in sorted(w.items(), key=lambda p: (p[1], p[0])):
            light += x * x
            if math.sqrt(light) >= (THRESHOLD - 1e-6) * norm:
                heavy.add(t)
        rows += [(i, name, t, x / norm) for t, x in sorted(w.items())]
    return rows, heavy


def document_frequency(files: DataFrame, vocab: list[str]) -> tuple[int, dict[str, int]]:
    """Files in all, and those that hold each term of the vocabulary."""
    held = F.array_intersect(F.split(F.lower("text"), "[^a-z0-9]+"), F.array(*map(F.lit, vocab)))
    counts = (files.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("t"))
              .groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect())  # one row per template term
    found = {r.t: r.n for r in counts}
    return found.get("", 0), {t: found.get(t, 0) for t in vocab}


def scan(files: DataFrame, by_edge_line: bool = False, templates=TEMPLATES) -> DataFrame:
    """``files``: path, text, id -> path, id, licence, evidence (own, inherited or null), score, from_dir."""
    spark: SparkSession = files.sparkSession
    files = files.select(F.coalesce("path", F.lit("")).alias("path"), "id", F.coalesce("text", F.lit("")).alias("text"))
    vocab = vocabulary(templates)
    n, df = document_frequency(files, vocab)
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in vocab}
    rows, heavy = weights(idf, templates)
    template = spark.createDataFrame(rows, "template int, name string, term string, w double")
    any_heavy = "(?<![a-z0-9])(" + "|".join(sorted(heavy)) + ")(?![a-z0-9])"
    named = F.regexp_extract("path", "([^/]*)$", 1).rlike(LICENCE_NAME)
    lines = F.filter(
        F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("pos"), x.alias("unit"))),
        lambda u: F.lower(u.unit).rlike(any_heavy))
    whole = F.array(F.struct(F.lit(-1).alias("pos"), F.col("text").alias("unit")))
    units = F.when(F.lower("text").rlike(any_heavy), F.when(named, F.concat(whole, lines)).otherwise(lines))
    base = materialize(
        files.select(F.monotonically_increasing_id().alias("row"), "path", "id",
                     F.regexp_replace("path", "/?[^/]*$", "").alias("dir"), named.alias("named"), units.alias("units"),
                     F.when(F.lower("text").rlike(any_heavy), F.size(F.split("text", "\n")) - 1).alias("last")),
        "licence-units")
    unseen = math.log(1 + n) + 1
    idf_of = spark.createDataFrame([(t, x) for t, x in idf.items()], "term string, idf double")
    tf = (base.select("row", F.explode("units").alias("u"))
          .select("row", F.col("u.pos").alias("pos"), F.explode(_terms(F.col("u.unit"))).alias("term"))
          .groupBy("row", "pos", "term").agg(F.count(F.lit(1)).alias("tf"))
          .join(F.broadcast(idf_of), "term", "left")  # terms of the templates only
          .withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(unseen))))
    norm = tf.groupBy("row", "pos").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dot = (tf.join(F.broadcast(template), "term")  # fixed templates
           .groupBy("row", "pos", "template", "name").agg(F.sum(F.col("x") * F.col("w")).alias("dot")))
    hit = (dot.join(norm, ["row", "pos"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
           .where(F.col("score") >= THRESHOLD)
           .groupBy("row").agg(F.min(F.struct((-F.col("score")).alias("s"), "pos", "name")).alias("best")))
    own = materialize(
        base.select("row", "path", "id", "dir", "named", "last").join(
            hit.select("row", F.col("best.name").alias("own"), (-F.col("best.s")).alias("score"),
                       F.col("best.pos").alias("pos")), "row", "left"), "licence-own")
    edge = (F.col("pos") == 0) | (F.col("pos") == F.col("last"))
    declares = F.col("named") | edge if by_edge_line else F.col("named")
    declared = (own.where(F.col("own").isNotNull() & declares).groupBy("dir", "own").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("dir").agg(F.min(F.struct((-F.col("n")).alias("n"), "own")).alias("d"))
                .select(F.col("dir").alias("above"), F.col("d.own").alias("dir_licence")))
    parts = F.split("dir", "/")
    above = (own.where(F.col("own").isNull()).select("dir").distinct()
             .select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.when(k == 0, F.lit(""))
                                                  .otherwise(F.array_join(F.slice(parts, 1, k), "/")))).alias("above")))
    nearest = (above.distinct().join(declared, "above")
               .groupBy("dir").agg(F.max(F.struct(F.length("above").alias("l"), "above", "dir_licence")).alias("n"))
               .select("dir", F.col("n.above").alias("from_dir"), F.col("n.dir_licence").alias("inherited")))
    out = own.join(nearest, "dir", "left")
    mine = F.col("own").isNotNull()
    return out.select(
        "path", "id", F.coalesce("own", "inherited").alias("licence"),
        F.when(mine, F.lit("own")).when(F.col("inherited").isNotNull(), F.lit("inherited")).alias("evidence"),
        "score", F.when(~mine, F.col("from_dir")).alias("from_dir"))


def document_path() -> Column:
    """Path of a test document, which has none: source, lang and shard folders, as deep as the id says."""
    id_ = F.coalesce(F.col("doc_id"), F.lit(0))
    deep = F.pmod(id_, F.lit(3))
    return F.concat(
        F.coalesce("source", F.lit("")),
        F.when(deep > 0, F.concat(F.lit("/"), F.coalesce("lang", F.lit("")))).otherwise(F.lit("")),
        F.when(deep > 1, F.concat(F.lit("/"), F.floor(id_ / 256).cast("string"))).otherwise(F.lit("")),
        F.lit("/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(".txt"))


def op1(docs: DataFrame) -> DataFrame:
    """doc_id, path, licence, evidence, score, from_dir."""
    files = docs.select(document_path().alias("path"), F.col("doc_id").alias("id"), "text")
    return scan(files, by_edge_line=True).withColumnRenamed("id", "doc_id")


def oracle(templates=TEMPLATES) -> str:
    """DuckDB SQL for ``op1``, without the heavy-term shortcut."""
    values = ", ".join(f"({i}, '{n}', '{t}', {c})" for i, (n, text) in enumerate(templates)
                       for t, c in sorted(Counter(terms(text)).items()))
    split = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rw, doc_id, coalesce(text, '') AS text,
    coalesce(source, '') || CASE WHEN coalesce(doc_id, 0) % 3 > 0 THEN '/' || coalesce(lang, '') ELSE '' END
      || CASE WHEN coalesce(doc_id, 0) % 3 > 1 THEN '/' || (coalesce(doc_id, 0) // 256)::VARCHAR ELSE '' END
      || '/' || coalesce(doc_id::VARCHAR, 'null') || '.txt' AS path
  FROM documents),
t AS (SELECT * FROM (VALUES {values}) v(template, name, term, tf)),
df AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT d.rw, u.term FROM d, unnest({split.format('d.text')}) u(term)) GROUP BY 1),
idf AS (SELECT DISTINCT t.term, ln((1 + (SELECT count(*) FROM d)) / (1 + coalesce(df.df, 0))::DOUBLE) + 1 AS idf FROM t LEFT JOIN df USING (term)),
tw AS (SELECT t.template, t.name, t.term, t.tf * i.idf AS w FROM t JOIN idf i USING (term)),
tn AS (SELECT template, sqrt(sum(w * w)) AS norm FROM tw GROUP BY 1),
lines AS (SELECT rw, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM d),
tf AS (SELECT rw, pos, u.term, count(*) AS tf FROM lines, unnest({split.format('line')}) u(term) GROUP BY ALL),
x AS (SELECT tf.*, tf.tf * coalesce(i.idf, ln(1 + (SELECT count(*) FROM d)) + 1) AS x FROM tf LEFT JOIN idf i USING (term)),
un AS (SELECT rw, pos, sqrt(sum(x * x)) AS norm FROM x GROUP BY 1, 2),
dot AS (SELECT x.rw, x.pos, tw.template, tw.name, sum(x.x * tw.w) AS dot FROM x JOIN tw USING (term) GROUP BY ALL),
hit AS (SELECT dot.rw, dot.pos, dot.name, round(dot.dot / un.norm / tn.norm, 6) AS score
  FROM dot JOIN un USING (rw, pos) JOIN tn USING (template)),
own AS (SELECT * FROM hit WHERE score >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY rw ORDER BY score DESC, pos, name) = 1),
f AS (SELECT d.rw, d.doc_id, d.path, regexp_replace(d.path, '/?[^/]*$', '') AS dir, o.name AS own, o.score, o.pos,
    len(string_split(d.text, chr(10))) - 1 AS last FROM d LEFT JOIN own o USING (rw)),
dec AS (SELECT dir AS above, own AS dir_licence FROM (SELECT dir, own, count(*) AS n FROM f WHERE own IS NOT NULL AND (pos = 0 OR pos = last) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY n DESC, own) = 1),
near AS (SELECT f.dir, dec.above, dec.dir_licence FROM (SELECT DISTINCT dir FROM f) f
  JOIN dec ON f.dir = dec.above OR starts_with(f.dir, dec.above || '/') OR dec.above = ''
  QUALIFY row_number() OVER (PARTITION BY f.dir ORDER BY length(dec.above) DESC) = 1)
SELECT f.path, f.doc_id, coalesce(f.own, near.dir_licence) AS licence,
  CASE WHEN f.own IS NOT NULL THEN 'own' WHEN near.dir_licence IS NOT NULL THEN 'inherited' END AS evidence,
  f.score, CASE WHEN f.own IS NULL THEN near.above END AS from_dir
FROM f LEFT JOIN near USING (dir)
"""
