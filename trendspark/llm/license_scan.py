"""License scan: TF-IDF cosine of header lines to templates, inherited along directories.

*Lines.* Every line of every file is a bag of lower-case ASCII words. A word's weight is
its count times ``ln((1 + N) / (1 + df))`` with N lines in the corpus, of which df hold the
word; df is counted over all lines for the words of the templates, and any other word
weighs as if it were in no line. A line's license is the template with the largest
cosine (rounded to 6 places, ties by name) of at least ``min_cosine``.

*Pruning without loss.* By Cauchy-Schwarz a line's cosine to any template is at most the
norm of its part inside the template vocabulary over its whole norm, so only lines whose
ratio reaches ``min_cosine`` are joined with the templates.

*Files.* A file's own license is that of its best line (ties: first line). A file whose
licensed lines hold at least half of its words is a license file and speaks for its
directory (best cosine, ties by path). Files without their own license take that of the
nearest ancestor directory that has one, by joins of directories with their ancestors.

Everything is DataFrame or SQL functions. The templates are a small fixed list, so their
vocabulary and weights are literals; document-side aggregates are combined before each shuffle.

Defined cases: null and empty texts have no license of their own but may inherit; null
parts of a path are left out of it; a file without a path has no directory; repeated rows repeat their result; a corpus without
licenses gives nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.llm.common import Scratch, table
from trendspark.operators.joins import join_null_safe

MIN_COSINE = 0.6

# One-line notices of common licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "Proprietary": "All rights reserved.",
}


def _words(text: str) -> list[str]:
    out, word = [], ""
    for c in text.lower() + " ":
        if c.isascii() and c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def template_counts(templates: dict[str, str] = TEMPLATES) -> list[tuple[str, str, int]]:
    """(template, word, count)."""
    return [(name, w, _words(text).count(w)) for name, text in templates.items() for w in sorted(set(_words(text)))]


def _once(df: DataFrame, value: F.Column, name: str) -> DataFrame:
    """A column computed once per row: later filters are not pushed below a generator."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def scan_licenses(files: DataFrame, path: str, text: str, templates: dict[str, str] = TEMPLATES,
                  min_cosine: float = MIN_COSINE) -> DataFrame:
    """``path`` with own license, its cosine, and the resulting license and where it is from.

    Columns: path, own_license, own_cosine, is_license_file, license, license_source
    (``header``, ``ancestor`` or ``none``) and license_dir. One row per distinct path and text.
    """
    spark = files.sparkSession
    scratch = Scratch(spark, "licenses")
    counts = template_counts(templates)
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for _, w, _ in counts})])
    body = F.col("body")
    lines = (files.select(F.col(path).alias("path"), F.col(text).cast("string").alias("body"))
             .withColumn("key", F.xxhash64("body"))
             .select("path", "key", F.posexplode(F.split(F.coalesce(body, F.lit("")), "\n")).alias("line", "t")))
    # ASCII lower case only, so that the words do not depend on a locale
    folded = F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(folded, "[^a-z0-9]+"), lambda w: w != "")
    lines = _once(_once(lines, words, "words").drop("t"), F.array_intersect("words", vocabulary), "known")
    df = {r["w"]: r["c"] for r in lines.select(F.explode(F.concat("known", F.array(F.lit("")))).alias("w"))
          .groupBy("w").agg(F.count("*").alias("c")).collect()}      # one row per template word
    total = df.pop("", 0)
    idf = {w: _idf(total, df.get(w, 0)) for _, w, _ in counts}
    rare = _idf(total, 0)
    weights = F.create_map(*[F.lit(x) for w in sorted(idf) for x in (w, idf[w])])

    def count(array: str, w: F.Column) -> F.Column:
        return F.size(F.filter(array, lambda x: x == w))
    # Lossless bounds from cheap to exact. Inside words occur at most n - (distinct outside
    # words) times, none weighs more than the heaviest one present, and each distinct outside
    # word adds at least rare^2 to the norm.
    heaviest = F.array_max(F.transform("known", lambda w: F.element_at(weights, w)))
    outside = F.size(F.array_except("words", vocabulary))
    least = F.col("out") * (rare * rare * min_cosine ** 2 * (1 - 1e-9))
    room = F.size("words") - F.col("out")
    scored = _once(lines.where(F.size("known") > 0), F.struct(outside.alias("out"), heaviest.alias("top")), "b")
    scored = (scored.select("path", "key", "line", "words", "known", "b.out", "b.top")
              .where(F.col("top") * F.col("top") * room * room * (1 - min_cosine ** 2) >= least))
    inside2 = F.aggregate("known", F.lit(0.0), lambda acc, w: acc + F.pow(
        count("words", w) * F.element_at(weights, w), F.lit(2.0)))
    scored = _once(scored, inside2, "in2").where((F.col("in2") > 0) & (F.col("in2") * (1 - min_cosine ** 2) >= least))
    strange = F.array_except("words", vocabulary)
    outside2 = F.aggregate(strange, F.lit(0.0), lambda acc, w: acc + F.pow(count("words", w) * F.lit(rare), F.lit(2.0)))
    scored = (_once(scored, outside2, "out2")
              .where(F.col("in2") >= (min_cosine - 1e-6) ** 2 * (F.col("in2") + F.col("out2")))
              .select("path", "key", "line", F.size("words").alias("n"), "in2", "out2",
                      F.filter("words", lambda w: F.array_contains(vocabulary, w)).alias("inside")))
    norms = {name: sum((c * idf[w]) ** 2 for n, w, c in counts if n == name) ** 0.5 for name in templates}
    rows = [(n, w, c * idf[w], norms[n]) for n, w, c in counts if norms[n] > 0]
    vectors = F.broadcast(spark.createDataFrame(rows, "template string, w string, tw double, tn double"))
    dots = (scored.select("path", "key", "line", "n", F.sqrt(F.col("in2") + F.col("out2")).alias("norm"),
                          F.explode("inside").alias("w"))
            .join(vectors, "w")
            .groupBy("path", "key", "line", "n", "norm", "template", "tn")
            .agg(F.sum(F.col("tw") * F.element_at(weights, F.col("w"))).alias("dot"))
            .withColumn("cosine", F.round(F.col("dot") / (F.col("norm") * F.col("tn")), 6))
            .where(F.col("cosine") >= min_cosine))
    best_line = dots.groupBy("path", "key", "line", "n").agg(
        F.min(F.struct((-F.col("cosine")).alias("c"), "template")).alias("b"))
    own = scratch.keep(best_line.groupBy("path", "key").agg(
        F.min(F.struct("b.c", "line", "b.template")).alias("b"), F.sum("n").alias("licensed"))
        .select("path", "key", F.col("b.template").alias("own_license"), (-F.col("b.c")).alias("own_cosine"), "licensed"),
        "own")
    distinct = (files.select(F.col(path).alias("path"), F.col(text).cast("string").alias("body"))
                .withColumn("key", F.xxhash64("body")))
    flat = F.translate(F.coalesce(body, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    size = F.size(F.filter(F.split(flat, "[^a-z0-9]+"), lambda w: w != ""))
    whole = scratch.keep(
        join_null_safe(distinct.select("path", "key", size.alias("words")).distinct(), own, ["path", "key"], "left")
        .withColumn("is_license_file", F.coalesce(F.col("licensed") * 2 >= F.col("words"), F.lit(False)))
        .withColumn("dir", F.regexp_replace("path", "/?[^/]*$", "")), "files")
    speaks = (whole.where("is_license_file").groupBy("dir").agg(
        F.min(F.struct((-F.col("own_cosine")).alias("c"), "path", "own_license")).alias("b"))
        .select("dir", F.col("b.own_license").alias("dir_license")))
    # each directory asks itself and its ancestors, the root is the empty path
    parts = F.split("dir", "/")
    depths = F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts)))
    asks = (whole.select("dir").where("dir is not null").distinct()
            .select("dir", F.explode(depths).alias("depth"))
            .withColumn("up", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/")))
    nearest = (asks.join(speaks.withColumnRenamed("dir", "up"), "up").groupBy("dir")
               .agg(F.max(F.struct("depth", "up", "dir_license")).alias("b"))
               .select("dir", F.col("b.up").alias("near_dir"), F.col("b.dir_license").alias("near")))
    has = F.col("own_license").isNotNull()
    return (whole.join(nearest, "dir", "left").select(
        "path", "key", "own_license", "own_cosine", "is_license_file",
        F.coalesce("own_license", "near").alias("license"),
        F.when(has, "header").when(F.col("near").isNotNull(), "ancestor").otherwise("none").alias("license_source"),
        F.when(~has, F.col("near_dir")).alias("license_dir")))


def _idf(total: int, df: int) -> float:
    import math
    return math.log((1 + total) / (1 + df))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of all documents, filed as source/lang/id.txt."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"))
    found = scan_licenses(docs, "path", "text")
    rows = docs.select("doc_id", F.col("path").alias("p"), F.xxhash64(F.col("text").cast("string")).alias("k"))
    return rows.join(found, (F.col("p") == F.col("path")) & F.col("k").eqNullSafe(F.col("key"))).select(
        "doc_id", "path", "own_license", "own_cosine", "is_license_file", "license", "license_source", "license_dir")


def _template_values() -> str:
    return ", ".join(f"('{n}', '{w}', {c})" for n, w, c in template_counts())


OP6_SQL = f"""
WITH t(template, w, c) AS (VALUES {_template_values()}),
f AS (SELECT doc_id, coalesce(text, '') AS body, concat_ws('/', source, lang, CAST(doc_id AS VARCHAR) || '.txt') AS path FROM documents),
l AS (SELECT doc_id, path, unnest(string_split(body, chr(10))) AS s, generate_subscripts(string_split(body, chr(10)), 1) AS line FROM f),
n AS (SELECT count(*) AS total FROM l),
lw AS (
  SELECT doc_id, path, line, w, count(*) AS c FROM (
    SELECT doc_id, path, line, unnest(regexp_extract_all(
      translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+')) AS w FROM l)
  GROUP BY 1, 2, 3, 4),
idf AS (
  SELECT v.w, ln((1 + any_value(total)) / (1 + count(lw.w))) AS i
  FROM (SELECT DISTINCT w FROM t) v CROSS JOIN n LEFT JOIN lw ON lw.w = v.w GROUP BY v.w),
weighed AS (
  SELECT doc_id, path, line, lw.w, lw.c, lw.c * coalesce(idf.i, ln(1 + total)) AS x, idf.w IS NOT NULL AS known
  FROM lw CROSS JOIN n LEFT JOIN idf ON lw.w = idf.w),
norm AS (SELECT doc_id, path, line, sqrt(sum(x * x)) AS norm, sum(c) AS n FROM weighed GROUP BY 1, 2, 3),
tn AS (SELECT template, sqrt(sum(c * i * c * i)) AS tn FROM t JOIN idf USING (w) GROUP BY 1),
dot AS (
  SELECT doc_id, path, line, template, sum(x * t.c * i) AS d
  FROM weighed JOIN t ON weighed.w = t.w JOIN idf ON idf.w = t.w WHERE known GROUP BY 1, 2, 3, 4),
cosines AS (
  SELECT doc_id, path, line, n, template, round(d / (norm * tn), 6) AS cosine
  FROM dot JOIN norm USING (doc_id, path, line) JOIN tn USING (template) WHERE norm > 0 AND tn > 0),
bestline AS (
  SELECT * FROM cosines WHERE cosine >= {MIN_COSINE}
  QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY cosine DESC, template) = 1),
own AS (
  SELECT doc_id, first(template ORDER BY cosine DESC, line, template) AS own_license, max(cosine) AS own_cosine, sum(n) AS licensed
  FROM bestline GROUP BY 1),
files AS (
  SELECT f.doc_id, f.path, own_license, own_cosine, regexp_replace(f.path, '/?[^/]*$', '') AS dir,
    coalesce(licensed * 2 >= len(regexp_extract_all(
      translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+')), false) AS is_license_file
  FROM f LEFT JOIN own USING (doc_id)),
speaks AS (
  SELECT dir, own_license AS near FROM files WHERE is_license_file
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY own_cosine DESC, path) = 1),
asks AS (
  SELECT dir, depth, array_to_string(string_split(dir, '/')[1:depth], '/') AS up
  FROM (SELECT DISTINCT dir FROM files) q, unnest(range(0, CASE WHEN dir = '' THEN 1 ELSE len(string_split(dir, '/')) + 1 END)) AS r(depth)),
nearest AS (
  SELECT asks.dir, up, near FROM asks JOIN speaks ON asks.up = speaks.dir
  QUALIFY row_number() OVER (PARTITION BY asks.dir ORDER BY depth DESC) = 1)
SELECT doc_id, path, own_license, own_cosine, is_license_file, coalesce(own_license, near) AS license,
  CASE WHEN own_license IS NOT NULL THEN 'header' WHEN near IS NOT NULL THEN 'ancestor' ELSE 'none' END AS license_source,
  CASE WHEN own_license IS NULL THEN up END AS license_dir
FROM files LEFT JOIN nearest USING (dir)
"""
