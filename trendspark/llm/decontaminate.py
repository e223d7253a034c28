"""Benchmark decontamination by winnowing.

Words are lower-cased (A-Z only) runs of bytes outside ASCII punctuation, space and
control characters. Every ``span`` consecutive words of a benchmark item form a window;
an item of fewer words (but at least one) is a single window of all its words.

*Fingerprints.* For each window of ``span`` words the smallest of its ``gram``-word
hashes is its fingerprint (winnowing). Equal windows have equal fingerprints at the same
place, so joining document fingerprints with benchmark fingerprints finds every shared
span of ``span`` words. Joined places are extended to whole windows and checked against
the windows of the benchmark; windows of short items are looked up by their length.

The benchmark's windows travel to the tasks in blocks of at most ``BLOCK_WINDOWS``
entries (16 bytes each), so what is broadcast is bounded whatever the benchmark's size;
the documents pass once per block and are never shuffled.

Defined cases: null or wordless texts have no words and no hits; benchmark rows with a
null item_id or no words take no part; rows repeated in either table give the same
answer for each copy; other columns of the documents are passed through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.llm.common import Scratch, fresh, map_batches, table
from trendspark.llm.textscan import (
    Powers, Words, byte_codes, gram_hashes, sliding_min, text_slices)

SPAN = 10
GRAM = 5
BLOCK_WINDOWS = 2_000_000

_HIT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.LongType())),
    T.StructField("span_starts", T.ArrayType(T.IntegerType())),
    T.StructField("span_ends", T.ArrayType(T.IntegerType())),
])


def word_bytes() -> np.ndarray:
    """True for bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z."""
    ok = np.zeros(256, bool)
    ok[48:58] = ok[65:91] = ok[97:123] = ok[128:] = True
    return ok


def scan_words(column: pa.Array) -> Iterator[tuple]:
    """(slice, words) for each bounded slice of a text column."""
    powers, mask, codes = Powers(), word_bytes(), byte_codes(True)
    for part in text_slices(column):
        yield part, Words(part, mask, codes, powers)


def fingerprints(grams: np.ndarray, span: int, gram: int) -> np.ndarray:
    """The smallest gram hash of every ``span``-word window."""
    return sliding_min(grams, span - gram + 1)


def benchmark_windows(benchmark: DataFrame, text: str, item: str, span: int = SPAN,
                      gram: int = GRAM) -> DataFrame:
    """(length, window, fingerprint, item) for every window of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), np.int64)
            for part, w in scan_words(batch.column(0)):
                lengths, windows, prints, owner = [], [], [], []
                full = gram_hashes(w.hashes, span)
                fp = fingerprints(gram_hashes(w.hashes, gram), span, gram)
                at = np.flatnonzero(w.row[:len(full)] == w.row[span - 1:]) if len(full) else np.zeros(0, int)
                lengths.append(np.full(len(at), span, np.int32))
                windows.append(full[at])
                prints.append(fp[at])
                owner.append(ids[part.lo + w.row[at]])
                for r in np.flatnonzero((w.counts > 0) & (w.counts < span)):
                    n, s = int(w.counts[r]), int(w.first[r])
                    h = gram_hashes(w.hashes[s:s + n], n)
                    lengths.append(np.full(1, n, np.int32))
                    windows.append(h)
                    prints.append(h)
                    owner.append(ids[part.lo + r:part.lo + r + 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(lengths)), pa.array(np.concatenate(windows).view(np.int64)),
                     pa.array(np.concatenate(prints).view(np.int64)), pa.array(np.concatenate(owner))],
                    names=["length", "win", "print", "item"])
    rows = benchmark.where(F.col(item).isNotNull()).select(
        F.col(text).cast("string").alias("t"), F.col(item).cast("long").alias("i"))
    return rows.mapInArrow(run, "length int, win long, print long, item long").distinct()


def _block_arrays(rows: list, span: int) -> dict:
    """Sorted lookup arrays of one block: by length, windows and their items."""
    out: dict = {}
    length = np.array([r[0] for r in rows], np.int32)
    win = np.array([r[1] for r in rows], np.int64).view(np.uint64)
    fp = np.array([r[2] for r in rows], np.int64).view(np.uint64)
    item = np.array([r[3] for r in rows], np.int64)
    for n in np.unique(length):
        m = length == n
        order = np.lexsort((item[m], win[m]))
        keys, first = np.unique(win[m][order], return_index=True)
        out[int(n)] = (keys, np.append(first, m.sum()), item[m][order],
                       np.unique(fp[m]) if n == span else None)
    return out


def _find(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each value in sorted ``keys``, or -1."""
    if not len(keys):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, -1)


def find_hits(w: Words, block: dict, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hit mask over words, row of each found item, found item) for one slice."""
    n = len(w.hashes)
    delta = np.zeros(n + 1, np.int64)
    rows, items = [], []
    for length, (keys, first, owner, prints) in block.items():
        if n < length:
            continue
        if prints is None:
            at = np.flatnonzero(w.row[:n - length + 1] == w.row[length - 1:])
            where = _find(gram_hashes(w.hashes, length)[at], keys)
        else:
            fp = fingerprints(gram_hashes(w.hashes, gram), span, gram)
            # consecutive windows mostly share their fingerprint: look each run up once
            new = np.flatnonzero(np.append(True, fp[1:] != fp[:-1]))
            joined = np.repeat(_find(fp[new], prints) >= 0, np.diff(np.append(new, len(fp))))
            at = np.flatnonzero(joined & (w.row[:len(fp)] == w.row[span - 1:]))
            whole = np.empty((len(at), span), np.uint64)
            for j in range(span):
                whole[:, j] = w.hashes[at + j]
            where = _find(_row_gram(whole), keys)
        found = where >= 0
        at, where = at[found], where[found]
        np.add.at(delta, at, 1)
        np.add.at(delta, at + length, -1)
        size = first[where + 1] - first[where]
        rows.append(np.repeat(w.row[at], size))
        start = np.repeat(first[where], size)
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        items.append(owner[start + inner])
    cat = (lambda x: np.concatenate(x) if x else np.zeros(0, np.int64))
    return np.cumsum(delta[:-1]) > 0, cat(rows), cat(items)


def _row_gram(whole: np.ndarray) -> np.ndarray:
    """gram_hashes() of each row of a (n, k) matrix."""
    n, k = whole.shape
    if not n:
        return np.zeros(0, np.uint64)
    flat = gram_hashes(whole.ravel(), k)
    return flat[::k]


def find_contamination(docs: DataFrame, windows: DataFrame, text: str, out: str,
                       span: int = SPAN, gram: int = GRAM,
                       block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, n_hit, items, hit word spans.

    ``span_starts``/``span_ends`` are word positions (end exclusive) of the maximal hit
    runs; ``items`` the ids of the items with occurring windows, ascending.
    """
    spark = docs.sparkSession
    blocks = max(1, -(-windows.count() // block_windows))
    cut = F.pmod(F.xxhash64("win", "length"), F.lit(blocks))
    result, key = docs, fresh("acc")
    schema = T.StructType([*docs.schema.fields, T.StructField(key, _HIT)])
    for b in range(blocks):
        rows = windows.where(cut == b).collect() if blocks > 1 else windows.collect()
        sent = spark.sparkContext.broadcast(_block_arrays(rows, span))
        column = docs.columns.index(text)
        merge = b > 0

        def run(batches: Iterator[pa.RecordBatch], sent=sent, merge=merge) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for batch in batches:
                made: list = []
                old = batch.column(batch.num_columns - 1).to_pylist() if merge else None
                for part, w in scan_words(batch.column(column)):
                    hit, rows, items = find_hits(w, block, span, gram)
                    made.extend(_row_results(part, w, hit, rows, items, old))
                arrays = list(batch.columns[:-1] if merge else batch.columns)
                names = list(batch.schema.names[:-1] if merge else batch.schema.names)
                kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()),
                                  ("items", pa.list_(pa.int64())), ("span_starts", pa.list_(pa.int32())),
                                  ("span_ends", pa.list_(pa.int32()))])
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(made, kind)], names=[*names, key])

        result = map_batches(result, run, schema)
    return result.withColumnRenamed(key, out)


def _row_results(part, w: Words, hit: np.ndarray, rows: np.ndarray, items: np.ndarray, old) -> list[dict]:
    """One result per row of a slice, merged with what earlier blocks found."""
    by_row: dict[int, set] = {}
    for r, i in zip(rows.tolist(), items.tolist()):
        by_row.setdefault(r, set()).add(i)
    out = []
    for r in range(part.rows):
        n, s = int(w.counts[r]), int(w.first[r])
        mine = by_row.get(r, set())
        before = old[part.lo + r] if old else None
        if not mine and before is None:
            out.append({"n_words": n, "n_hit": 0, "items": [], "span_starts": [], "span_ends": []})
            continue
        mask = hit[s:s + n].copy()
        if before is not None:
            mine = mine | set(before["items"])
            for a, e in zip(before["span_starts"], before["span_ends"]):
                mask[a:e] = True
        change = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
        out.append({"n_words": n, "n_hit": int(mask.sum()), "items": sorted(mine),
                    "span_starts": np.flatnonzero(change == 1).tolist(),
                    "span_ends": np.flatnonzero(change == -1).tolist()})
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, doc_text: str = "text",
                  bench_text: str = "text", item: str = "item_id", out: str = "contamination",
                  span: int = SPAN, gram: int = GRAM, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Every document row with what it shares with the benchmark (see the module text)."""
    windows = Scratch(docs.sparkSession, "decontaminate").keep(
        benchmark_windows(benchmark, bench_text, item, span, gram), "windows")
    return find_contamination(docs, windows, doc_text, out, span, gram, block_windows)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_text: str = "text") -> DataFrame:
    """The documents that share no window with the benchmark, columns unchanged."""
    tag = fresh("hit")
    found = contamination(docs, benchmark, doc_text, out=tag)
    return found.where(F.col(f"{tag}.n_hit") == 0).drop(tag)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every whole document by the whole benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = F.col("contamination")
    ids = F.array_sort(F.transform(hit["items"], lambda x: x.cast("string")))
    return found.select(
        "doc_id", hit["n_words"].alias("n_words"), hit["n_hit"].alias("n_hit"),
        F.size(hit["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (hit["n_hit"] > 0).alias("contaminated"))


OP1_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS s
  FROM bw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM win),
dwin AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n) t),
hits AS (SELECT d.doc_id, d.n, d.i, b.item_id FROM dwin d JOIN win b ON d.n = b.n AND d.s = b.s),
hitwords AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS r(p) GROUP BY 1),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY 1)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hitwords USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
