"""Phrase collocations of two and three words by marginalising the longest windows.

*Words.* ``A-Z`` lower-cased; ``SEPARATORS`` cut a text into pieces, spaces and tabs a
piece into words. Every word leads one window: itself and the next two words of its
piece, padded with '' at the piece's end. Only these longest windows are counted, first
within a slice of a task, then per language by a shuffle.

*Marginals.* The occurrences of a phrase are the sum over the windows it begins, so a
ROLLUP over (language, first, second, third word) gives every shorter count, down to the
words of a language. Before it, windows lose the suffixes that cannot matter: the third
word of a window that occurs fewer than ``least`` times, then the second word of a pair
that does. Their counts stay with the prefix, so all marginals of ``least`` and more are
exact. Both cuts need no further shuffle, because rows are dealt by the first word; words
that lead much of all windows are dealt by the other two words, too, and their pairs are
cut after the sums. A block's windows of one first word travel as one row.

*Scores.* floor(10^6 a a / (l r)) of the worse cut in decimals of 38 digits (counts below
10^14). Pairs inside a counted triple with at least half of their occurrences go.

Defined cases: null texts are empty; a null language is ``und``; equal rows each count;
other columns are ignored; an empty table gives no rows; ties go by count, then by the
bytes of the phrase. Memory follows ``SLICE_BYTES`` or the longest text, in blocks of
``BLOCK`` words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendspark.llm.common import Scratch, table
from trendspark.llm.textscan import text_slices

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
LEAST = 10           # occurrences of a candidate
INSIDE = (100, 50)   # a pair goes where 100 x triple >= 50 x pair
TOP = 2000           # candidates reported per language
BLOCK = 1 << 19      # windows counted at once
SLICE_BYTES = 4 << 20
HOT_SHARE = 64       # words that lead more than 1 / HOT_SHARE of all windows are spread
SPREAD = 64          # parts of a hot word, and of a language when ranked
_KEYS = ("lang", "w1", "w2", "w3")


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each word, its end, whether the next word follows it in the same piece)."""
    kind = np.ones(256, np.uint8)
    kind[[0x20, 0x09]] = 0
    kind[list(SEPARATORS)] = 2
    own = kind[data]
    is_word = np.zeros(len(data) + 2, bool)
    is_word[1:-1] = own == 1
    edge = is_word[1:] != is_word[:-1]
    edge[offsets] = True
    starts = np.flatnonzero(edge & is_word[1:])
    ends = np.flatnonzero(edge & is_word[:-1])
    cuts = np.append(0, np.cumsum(own == 2))
    row = np.searchsorted(offsets, starts, "right")
    joined = np.zeros(len(starts), bool)
    joined[:-1] = (cuts[ends[:-1]] == cuts[starts[1:]]) & (row[:-1] == row[1:])
    return starts, ends, joined


def _count_block(words: pa.Array, follows: np.ndarray, lead: int) -> tuple:
    """Counted windows of the first ``lead`` words of a run: (dictionary with the pad first,
    first, second and third word of each distinct window, its count)."""
    coded = words.dictionary_encode()
    ids, size = coded.indices.to_numpy().astype(np.int64) + 1, len(coded.dictionary) + 1      # 0 is the pad
    padded, chain = np.append(ids, [0, 0]), np.append(follows, [False, False])
    second = np.where(chain[:lead], padded[1:lead + 1], 0)
    third = np.where(chain[:lead] & chain[1:lead + 1], padded[2:lead + 2], 0)
    keys, seen = np.unique((padded[:lead] * size + second) * size + third, return_counts=True)
    pair, third = np.divmod(keys, size)
    first, second = np.divmod(pair, size)
    return pa.concat_arrays([pa.array([""]), coded.dictionary.cast(pa.string())]), first, second, third, seen


def _blocks(batches: Iterator[pa.RecordBatch], sized: int, bound: int) -> Iterator[tuple]:
    """(language, *counted windows) of the blocks of a task's rows (language, text)."""
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    for batch in batches:
        langs = batch.column(0).to_numpy(zero_copy_only=False).astype(str)
        for part in text_slices(batch.column(1), bound):
            names, code = np.unique(langs[part.lo:part.hi], return_inverse=True)
            starts, ends, joined = _words(part.data, part.offsets)
            if not len(starts):
                continue
            sizes = ends - starts
            at = np.append(0, np.cumsum(sizes))
            body = low[part.data[np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])]]
            words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(body)])
            own = code[np.searchsorted(part.offsets, starts, "right") - 1]
            for k, name in enumerate(names):
                mine = np.flatnonzero(own == k)      # words that follow one another stay neighbours
                for lo in range(0, len(mine), sized):
                    some = mine[lo:lo + sized + 2]
                    yield str(name), *_count_block(words.take(pa.array(some)), joined[some], min(sized, len(mine) - lo))


def hot_words(rows: DataFrame) -> set[tuple[str, str]]:
    """The (language, word) pairs, ``2 * HOT_SHARE`` at most, that lead much of all counted windows.

    A block names the words that lead 1 / (2 HOT_SHARE) of it, so every word that leads
    1 / HOT_SHARE of all is among them.
    """
    sized, bound, share = BLOCK, SLICE_BYTES, 2 * HOT_SHARE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, names, first, _, _, _ in _blocks(batches, sized, bound):
            lead = np.bincount(first, minlength=len(names))
            wide = np.flatnonzero(lead * share >= len(first))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(wide) + 1)), pa.concat_arrays([names.take(pa.array(wide)), pa.array([""])]),
                 pa.array(np.append(lead[wide], len(first)))], names=["lang", "w1", "r"])
    led = rows.mapInArrow(run, "lang string, w1 string, r long").groupBy("lang", "w1").agg(F.sum("r").alias("r"))
    found = led.groupBy().agg(F.sum(F.when(F.col("w1") == "", F.col("r"))).alias("total")).first()["total"]
    return {(r["lang"], r["w1"]) for r in led.where((F.col("w1") != "") & (F.col("r") * share >= (found or 1))).collect()}


def windows(rows: DataFrame, hot: set[tuple[str, str]]) -> DataFrame:
    """(lang, w1, salt, next): the counted windows of a block by their first word; ``next``
    has a line ``w2 w3 count`` for each. Hot words are spread by the other two words."""
    sized, bound, spread = BLOCK, SLICE_BYTES, SPREAD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, names, first, second, third, seen in _blocks(batches, sized, bound):
            salt = np.zeros(len(first), np.int64)
            mine = pc.index_in(pa.array([w for k, w in hot if k == lang], pa.string()), names).drop_null().to_numpy()
            if len(mine):
                mark = np.array([zlib.crc32(w.encode()) for w in names.to_pylist()], np.int64)
                salt = np.where(np.isin(first, mine), 1 + (mark[second] * 31 + mark[third]) % spread, 0)
                order = np.lexsort((salt, first))
                first, second, third, seen, salt = first[order], second[order], third[order], seen[order], salt[order]
            lines = pc.binary_join_element_wise(names.take(pa.array(second)), names.take(pa.array(third)), pa.array(seen).cast(pa.string()), " ")
            new = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (salt[1:] != salt[:-1])))
            packed = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(new, len(first)), pa.int32()), lines), "\n")
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]).take(pa.array(np.zeros(len(new), np.int64))), names.take(pa.array(first[new])),
                 pa.array(salt[new], pa.int32()), packed], names=["lang", "w1", "salt", "next"])
    return rows.mapInArrow(run, "lang string, w1 string, salt int, next string")


def phrase_counts(docs: DataFrame, scratch: Scratch, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """(level, lang, w1, w2, w3, c): exact counts of all phrases of up to three words with at
    least ``least`` occurrences (``level`` words), and of each language's words (level 0)."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("l"), F.col(text).cast("string").alias("t"))
    dealt = windows(rows, hot_words(rows)).repartition("lang", "w1", "salt")     # few words a row: unpacked after the shuffle
    line = dealt.select("lang", "w1", "salt", F.explode(F.split("next", "\n")).alias("line"))
    triples = (line.groupBy("lang", "w1", "salt", F.substring_index("line", " ", 2).alias("rest"))
               .agg(F.sum(F.substring_index("line", " ", -1).cast("long")).alias("c")))
    parts = F.split("rest", " ")
    cut = (triples.withColumn("w2", parts[0]).withColumn("w3", F.when(F.col("c") >= least, parts[1]).otherwise(""))
           .groupBy("lang", "w1", "salt", "w2", "w3").agg(F.sum("c").alias("c")))
    pair = F.sum("c").over(Window.partitionBy("lang", "w1", "salt", "w2"))
    cut = cut.withColumn("w2", F.when((F.col("salt") > 0) | (pair >= least), F.col("w2")).otherwise(""))
    longest = scratch.keep(cut.groupBy(*_KEYS).agg(F.sum("c").alias("c")), "longest")
    rolled = longest.rollup(*_KEYS).agg(F.grouping_id().alias("g"), F.sum("c").alias("c"))
    level = F.when(F.col("g") == 0, 3).when(F.col("g") == 1, 2).when(F.col("g") == 3, 1).when(F.col("g") == 7, 0)
    last = F.element_at(F.array("w1", "w2", "w3"), F.greatest("level", F.lit(1)))     # the last word of the prefix
    counts = (rolled.withColumn("level", level).where("level is not null")
              .where((F.col("level") == 0) | ((last != "") & (F.col("c") >= least))))
    kept = scratch.keep(counts.select("level", *_KEYS, "c"), "counts")
    scratch.drop(longest)
    return kept


def _score(a: str, left: str, right: str) -> F.Column:
    """floor(10^6 a a / (l r)), exactly: at most 10^6, from products of up to 37 digits."""
    wide = [F.col(c).cast("decimal(14,0)") for c in (a, left, right)]
    above = (wide[0] * wide[0]).cast("decimal(28,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    above, below = above.cast("decimal(38,0)"), (wide[1] * wide[2]).cast("decimal(38,0)")
    return ((above - above % below) / below).cast("long")


def collocations(counts: DataFrame, top: int = TOP, inside: tuple[int, int] = INSIDE) -> DataFrame:
    """Ranked phrases of ``phrase_counts``: lang, rank, phrase, a, l, r, n, score."""
    total = counts.where("level = 0").select("lang", F.col("c").alias("n"))
    word = counts.where("level = 1").select("lang", F.col("w1").alias("w"), F.col("c").alias("f"))
    pairs = counts.where("level = 2").select("lang", "w1", "w2", F.col("c").alias("a"))
    triples = counts.where("level = 3").select("lang", "w1", "w2", "w3", F.col("c").alias("a"))

    def with_word(df: DataFrame, column: str, out: str) -> DataFrame:
        return df.join(word.select("lang", F.col("w").alias(column), F.col("f").alias(out)), ["lang", column])

    def with_pair(df: DataFrame, one: str, two: str, out: str) -> DataFrame:
        return df.join(pairs.select("lang", F.col("w1").alias(one), F.col("w2").alias(two), F.col("a").alias(out)), ["lang", one, two])
    longer = (triples.select("lang", F.inline(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))), "a")
              .groupBy("lang", "w1", "w2").agg(F.max("a").alias("most")))
    free = pairs.join(longer, ["lang", "w1", "w2"], "left").where(
        F.col("most").isNull() | (F.col("most") * inside[0] < F.col("a") * inside[1])).drop("most")
    two = with_word(with_word(free, "w1", "l"), "w2", "r").select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    three = with_pair(with_word(triples, "w1", "l1"), "w2", "w3", "r1")
    three = with_word(with_pair(three, "w1", "w2", "l2"), "w3", "r2")
    three = three.withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2"))
    early = F.col("s1") <= F.col("s2")
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                         F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    best = (two.unionByName(three)                # the best of each part first: no task sorts a whole language
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top))
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language over all documents."""
    docs = table(spark, sf_dir, "documents").select("text", "lang")
    return collocations(phrase_counts(docs, Scratch(spark, "phrases")))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\x0c\r]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
leads AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words)),
f0 AS (SELECT lang, count(*) AS n FROM leads GROUP BY lang),
f1 AS (SELECT lang, w1, count(*) AS f FROM leads GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM leads WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM leads WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, a, b, max(f) AS most FROM (
    SELECT lang, w1 AS a, w2 AS b, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
cuts AS (
  SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, 1 AS k, p.f AS a, x.f AS l, y.f AS r
  FROM f2 p JOIN f1 x ON x.lang = p.lang AND x.w1 = p.w1 JOIN f1 y ON y.lang = p.lang AND y.w1 = p.w2
  LEFT JOIN longer g ON g.lang = p.lang AND g.a = p.w1 AND g.b = p.w2
  WHERE p.f >= 10 AND (g.most IS NULL OR 100 * g.most < 50 * p.f)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 1, t.f, x.f, y.f
  FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.w1 = t.w1
  JOIN f2 y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 2, t.f, x.f, y.f
  FROM f3 t JOIN f2 x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2
  JOIN f1 y ON y.lang = t.lang AND y.w1 = t.w3),
scored AS (
  SELECT *, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, f0.n, score
FROM worst w JOIN f0 ON f0.lang = w.lang
QUALIFY rank <= 2000
"""
