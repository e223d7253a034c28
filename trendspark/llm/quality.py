"""Quality scores from random-indexing word vectors and a two-layer network.

*Word vectors.* Tokens are runs of letters and digits, or of other printable characters,
hashed into ``BUCKETS`` buckets. Each bucket owns a sparse ternary index vector drawn from a
fixed seed; a bucket's context vector is the sum of the index vectors of its neighbours
at up to ``REACH`` tokens over the whole corpus (all documents). Each task keeps one dense table
(``BUCKETS * DIMS`` counts, a fixed size), and the tables are summed in two levels.

*Pooling.* A document is the mean and the spread of its tokens' unit vectors, the mean
over its distinct tokens, the mean agreement of neighbours, and its length on a log scale.

*Network.* One hidden layer of tanh units and a logistic output, trained by Adam with
numpy on at most ``SAMPLE`` labelled rows (the smallest hashes of the id), of which a fifth is
set aside to calibrate the probabilities with one temperature. Only rows that are not held
out teach labels; labels, lang, source and ids are never inputs.

Defined cases: null and empty texts pool to zeros and get the network's answer for them;
null labels and labels without a document teach nothing; rows repeated in either table
count each time; if only one class, or none, is labelled the score is the share of label
1 (0.5 without labels); rows with a null id are held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.llm.common import Scratch, held_out, table
from trendspark.llm.textscan import U64, Powers, Words, byte_codes, splitmix, text_slices

BUCKETS = 1 << 14
DIMS = 32
NONZERO = 2
REACH = 2
HIDDEN = 24
SAMPLE = 20_000
STEPS = 600
THRESHOLD = 0.3
_BLOCK = 512           # buckets per shuffled row
_SALTS = 16


def token_classes() -> np.ndarray:
    """0 for space and control bytes, 1 for letters, digits and non-ASCII, 2 for the rest."""
    kind = np.full(256, 2, np.uint8)
    kind[:33] = kind[127] = 0
    kind[48:58] = kind[65:91] = kind[97:123] = kind[128:] = 1
    return kind


def scan_tokens(column: pa.Array, bound: int = 1 << 19) -> Iterator[tuple]:
    """(slice, words, buckets) for bounded slices of a text column."""
    powers, kinds, codes = Powers(), token_classes(), byte_codes(False)
    for part in text_slices(column, bound):
        w = Words(part, kinds, codes, powers)
        yield part, w, (w.hashes % U64(BUCKETS)).astype(np.int64)


def index_vectors(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero components of each bucket's index vector."""
    draw = splitmix(np.arange(BUCKETS * NONZERO, dtype=np.uint64) + U64(seed * 1_000_003 + 1))
    return ((draw >> U64(8)) % U64(DIMS)).astype(np.int64).reshape(BUCKETS, NONZERO), \
        np.where(draw & U64(1), 1, -1).reshape(BUCKETS, NONZERO)


def context_vectors(docs: DataFrame, text: str, seed: int) -> np.ndarray:
    """The context vectors of all buckets; 2 MB whatever the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors(seed)
        total = np.zeros(BUCKETS * DIMS, np.int64)
        for batch in batches:
            for _, w, bucket in scan_tokens(batch.column(0)):
                for gap in range(1, REACH + 1):
                    same = np.flatnonzero(w.row[gap:] == w.row[:-gap])
                    left, right = bucket[same], bucket[same + gap]
                    for a, b in ((left, right), (right, left)):
                        for j in range(NONZERO):
                            flat = a * DIMS + places[b, j]
                            up = signs[b, j] > 0
                            total += np.bincount(flat[up], minlength=len(total))
                            total -= np.bincount(flat[~up], minlength=len(total))
        blocks = total.reshape(-1, _BLOCK * DIMS)
        used = np.flatnonzero(blocks.any(axis=1))
        salt = TaskContext.get().partitionId() % _SALTS     # spreads the first sums; a rerun task gets its own again
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(np.full(len(used), salt), pa.int64()),
             pa.array([blocks[i].tobytes() for i in used], pa.binary())], names=["block", "salt", "v"])

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        v = sum(np.frombuffer(b, np.int64) for b in frame["v"])
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "salt": [0], "v": [v.tobytes()]})

    kind = "block long, salt long, v binary"
    parts = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, kind)
    rows = (parts.groupBy("block", "salt").applyInPandas(total, kind)
            .groupBy("block").applyInPandas(total, kind).collect())
    out = np.zeros((BUCKETS // _BLOCK, _BLOCK * DIMS))
    for r in rows:
        out[r["block"]] = np.frombuffer(bytes(r["v"]), np.int64)
    out = out.reshape(BUCKETS, DIMS)
    out = np.sign(out) * np.log1p(np.abs(out))           # keeps frequent neighbours from ruling
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norm > 0, norm, 1)).astype(np.float32)


FEATURES = 3 * DIMS + 3


def pool(vectors: np.ndarray, part, w: Words, bucket: np.ndarray) -> np.ndarray:
    """The pooled features of each row of a slice."""
    rows, n = part.rows, np.maximum(w.counts, 1)[:, None].astype(np.float32)
    first = np.append(w.first, len(bucket))

    def sums(values: np.ndarray) -> np.ndarray:
        run = np.zeros((len(values) + 1, values.shape[1]))
        np.cumsum(values, axis=0, out=run[1:])
        return run[first[1:]] - run[first[:-1]]
    v = vectors[bucket]
    mean = sums(v) / n
    spread = np.sqrt(np.maximum(sums(v * v) / n - mean ** 2, 0))
    key = np.unique(w.row * BUCKETS + bucket)
    row, kinds = key // BUCKETS, np.bincount(key // BUCKETS, minlength=rows)
    each = np.stack([np.bincount(row, weights=vectors[key % BUCKETS, d], minlength=rows) for d in range(DIMS)], axis=1)
    distinct = each / np.maximum(kinds, 1)[:, None]
    near = np.zeros(rows)
    if len(bucket) > 1:
        same = w.row[1:] == w.row[:-1]
        agree = (v[1:] * v[:-1]).sum(axis=1) * same
        near = np.bincount(w.row[1:], weights=agree, minlength=rows) / np.maximum(w.counts - 1, 1)
    return np.column_stack([mean, spread, distinct, near, np.log1p(w.counts), kinds / n[:, 0]]).astype(np.float32)


def pooled(docs: DataFrame, doc_id: str, text: str, vectors: np.ndarray) -> DataFrame:
    """(id, features) of every row; features are float32 bytes."""
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = sent.value
        for batch in batches:
            for part, w, bucket in scan_tokens(batch.column(1)):
                made = pool(table_, part, w, bucket)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.lo, part.rows), pa.array([r.tobytes() for r in made], pa.binary())],
                    names=["id", "features"])
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("t")) \
        .mapInArrow(run, "id long, features binary")


def train(x: np.ndarray, y: np.ndarray, seed: int) -> dict:
    """A calibrated network for 0/1 labels; a constant if there is only one class."""
    share = float(y.mean()) if len(y) else 0.5
    if len(y) < 10 or share in (0.0, 1.0):
        return {"share": share}
    rng = np.random.default_rng(seed)
    turn = rng.permutation(len(y))
    x, y = x[turn].astype(np.float64), y[turn].astype(np.float64)
    cut = max(1, len(y) // 5)
    mean, scale = x[cut:].mean(axis=0), x[cut:].std(axis=0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    p = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN),
         rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    own, target = z[cut:], y[cut:]
    for step in range(1, STEPS + 1):
        at = rng.integers(0, len(own), min(512, len(own)))
        a, t = own[at], target[at]
        h = np.tanh(a @ p[0] + p[1])
        d = (_logistic(h @ p[2] + p[3]) - t) / len(t)
        back = d[:, None] * p[2] * (1 - h * h)
        grads = [a.T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ d + 1e-4 * p[2], np.array([d.sum()])]
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            p[k] = p[k] - 0.01 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    logit = np.tanh(z[:cut] @ p[0] + p[1]) @ p[2] + p[3]
    heats = np.geomspace(0.25, 8, 41)
    loss = [_loss(logit / t, y[:cut]) for t in heats]
    return {"share": share, "mean": mean, "scale": scale, "p": p, "heat": float(heats[int(np.argmin(loss))])}


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _loss(logit: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(_logistic(logit), 1e-9, 1 - 1e-9)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    if "p" not in model:
        return np.full(len(x), model["share"])
    z = np.clip((x - model["mean"]) / model["scale"], -8, 8)
    p = model["p"]
    return _logistic((np.tanh(z @ p[0] + p[1]) @ p[2] + p[3]) / model["heat"])


def smallest_hashes(rows: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` of ``rows`` (id, y, features), those with the smallest hashes of the id.

    A hash threshold from the count goes first, so that all tasks together send about
    ``sample`` rows to the driver and not ``sample`` each; if it leaves too few, it is doubled.
    """
    place = F.shiftrightunsigned(F.xxhash64("id"), 1)
    total = rows.count()
    share = min(1.0, 1.1 * sample / max(total, 1))
    near = rows
    while share < 1:
        near = rows.where(place < int(share * (1 << 63)))
        if near.count() >= sample:
            break
        near, share = rows, 2 * share
    return near.orderBy(place, "y", "features").limit(sample)


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   label: str = "quality", sample: int = SAMPLE, seed: int = 7) -> DataFrame:
    """(id, score) of every document row."""
    scratch = Scratch(docs.sparkSession, "quality")
    vectors = context_vectors(docs, text, seed)
    rows = scratch.keep(pooled(docs, doc_id, text, vectors), "features")
    known = labels.where(F.col(label).isin(0, 1)).select(
        F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
    taught = smallest_hashes(rows.join(known, "id").where(~held_out("id")), sample).select("features", "y").collect()
    x = np.array([np.frombuffer(bytes(r[0]), np.float32) for r in taught], np.float32).reshape(-1, FEATURES)
    model = train(x, np.array([r[1] for r in taught], np.int64), seed)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(predict(sent.value, x))], names=["id", "score"])
    return rows.mapInArrow(run, "id long, score double")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_scores(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return scored.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
