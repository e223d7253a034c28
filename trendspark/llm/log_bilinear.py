"""Language-model scores of a log-bilinear model trained by noise-contrastive estimation.

*Tokens.* ``A-Z`` lower-cased, words without white space, then one end. Every token of
every training text is counted; the counts grow with the corpus.

*Model.* ``P(w | h) = P(class of w | h) P(w | class)``. Classes are the end, each of the
``SHORT`` commonest words, and ``RARE`` classes of all other words by their last two
characters. The class follows a log-bilinear model: the vectors of the classes of the two
tokens before, each weighted by its place, add up to a predicted vector, whose products
with all classes' vectors and biases are normalised exactly. Within a class of rarer
words ``P(w | class)`` is the smoothed share of the word's count, with one place for
words never seen, so the probabilities of all words and one unknown word a class are 1.

*Training.* Every task runs one epoch of minibatches over its training texts in numpy,
from the same start (unigram biases): noise-contrastive estimation with ``NOISE`` classes
drawn from the unigram distribution for a batch, by matrix products. The tasks' parameters are averaged
by their numbers of tokens, one row per class.

*Scoring.* The normalisers of all pairs of context classes come from batched matrix
products, one row of pairs a task's turn; a token then costs one product of short vectors.
Counts of the ``HOT`` commonest words go to all tasks; the rest of a text's words are
joined with theirs by the word itself.

Defined cases: null texts are empty (one end token); rows with a null id count as held
out; repeated rows repeat their result; without training rows all base scores are 0 and
every class is equally likely; other columns pass through; an empty table gives none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.llm.common import Scratch, common_from, fresh, map_batches, table
from trendspark.llm.textscan import text_slices

SHORT = 383          # words that are classes of their own
RARE = 128           # classes of all other words
DIM = 24             # entries of a class's vectors
NOISE = 64           # noise classes of a batch
BATCH = 1024         # tokens of a batch
RATE = 0.3
ALPHA = 0.1          # added to each count
HOT = 1 << 19        # words whose counts are sent to all tasks
SLICE_BYTES = 1 << 20
END = "\n"           # the end token; no word holds a line feed
CLASSES = 1 + SHORT + RARE


def training(doc_id: str) -> F.Column:
    """crc32 of the id as text, mod 10, is not 0; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 10 != 0, F.lit(False))


def _tokens(column: pa.Array, bound: int) -> Iterator[tuple]:
    """(slice, distinct words, number of each token's word (-1: end), row of each token) of bounded slices."""
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    inside = np.ones(256, bool)
    inside[[0x20, *range(0x09, 0x0E)]] = False
    for part in text_slices(column, bound):
        is_word = np.zeros(len(part.data) + 2, bool)
        is_word[1:-1] = inside[part.data]
        edge = is_word[1:] != is_word[:-1]
        edge[part.offsets] = True
        starts, ends = np.flatnonzero(edge & is_word[1:]), np.flatnonzero(edge & is_word[:-1])
        sizes = ends - starts
        at = np.append(0, np.cumsum(sizes))
        body = low[part.data[np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])]]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(body)]).dictionary_encode()
        row = np.searchsorted(part.offsets, starts, "right") - 1
        after = row + np.arange(len(row))                    # each row before has its end
        last = np.searchsorted(row, np.arange(part.rows), "right") + np.arange(part.rows)
        ids, rows = np.full(len(row) + part.rows, -1), np.empty(len(row) + part.rows, np.int64)
        ids[after] = words.indices.to_numpy()
        rows[after], rows[last] = row, np.arange(part.rows)
        yield part, words.dictionary.cast(pa.string()), ids, rows


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, c) over all rows, the end among them; summed within a slice before the shuffle."""
    bound, end = SLICE_BYTES, END

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words, ids, _ in _tokens(batch.column(0), bound):
                seen = np.bincount(ids[ids >= 0], minlength=len(words))
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([words, pa.array([end])]), pa.array(np.append(seen, part.rows))],
                                                 names=["word", "c"])
    found = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "word string, c long")
    return found.groupBy("word").agg(F.sum("c").alias("c"))


def rare_class(word: F.Column) -> F.Column:
    """Class of a word outside the short list (``rare_class_of`` for columns)."""
    return (F.lit(1 + SHORT) + F.crc32(F.right(word, F.lit(2))) % RARE).cast("int")


def rare_class_of(word: str) -> int:
    return 1 + SHORT + zlib.crc32(word[-2:].encode()) % RARE


class Vocabulary:
    """What tasks need of the counts: plain arrays of bounded size."""

    def __init__(self, counts: DataFrame, hot: int = HOT) -> None:
        words = counts.where(F.col("word") != END)
        self.short = [r["word"] for r in words.orderBy(F.desc("c"), "word").limit(SHORT).collect()]
        self.least = common_from(words, hot)
        common = words.where((F.col("c") >= self.least) | F.col("word").isin(self.short)).toArrow()
        self.words, self.counts = common["word"].combine_chunks(), common["c"].to_numpy()
        kinds = {w: k + 1 for k, w in enumerate(self.short)}
        total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
        self.tokens, self.distinct = total["n"], total["v"]
        self.end = sum(r["c"] for r in counts.where(F.col("word") == END).collect())
        mass, sizes = np.zeros(CLASSES), np.zeros(CLASSES)          # tokens and words of each class
        mass[0], sizes[0] = self.end, 1
        rare = words.where(~F.col("word").isin(self.short)) if self.short else words
        for r in rare.groupBy(rare_class(F.col("word")).alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
            mass[r["k"]], sizes[r["k"]] = r["n"], r["v"]
        for r in words.where(F.col("word").isin(self.short)).collect() if self.short else []:
            mass[kinds[r["word"]]], sizes[kinds[r["word"]]] = r["c"], 1
        self.mass = mass
        #: log10 of the denominator within each class: the short list's words are alone in theirs
        self.inner = np.where(np.arange(CLASSES) > SHORT, np.log10(mass + ALPHA * (sizes + 1)), np.nan)
        self.noise = (mass + 1) / (mass + 1).sum()

    def classes(self, words: pa.Array) -> np.ndarray:
        own = pc.index_in(words, pa.array(self.short, pa.string())).fill_null(-1).to_numpy() + 1
        for i in np.flatnonzero(own == 0):
            own[i] = rare_class_of(words[int(i)].as_py())
        return own

    def known(self, words: pa.Array) -> np.ndarray:
        """Count of each word, -1 where it is not among the commonest."""
        at = pc.index_in(words, self.words).fill_null(-1).to_numpy()
        return np.where(at >= 0, np.append(self.counts, 0)[at], -1)


def _contexts(kinds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the token before and of the one before that; the end's class before a text."""
    def back(n: int) -> np.ndarray:
        out = np.zeros(len(kinds), np.int64)
        if len(kinds) > n:
            out[n:] = np.where(rows[n:] == rows[:-n], kinds[:-n], 0)
        return out
    return back(1), back(2)


def start_parameters(noise: np.ndarray) -> dict[str, np.ndarray]:
    """Small context vectors, no output vectors, unigram biases; the same in every task."""
    rng = np.random.default_rng(13)
    return {"context": rng.normal(0, 0.5, (len(noise), DIM)).astype(np.float32), "output": np.zeros((len(noise), DIM), np.float32),
            "bias": np.log(noise).astype(np.float32)[:, None], "place": np.array([[1.0] * DIM, [0.5] * DIM], np.float32)}


def _scatter(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``values`` by row number."""
    order = np.argsort(rows, kind="stable")
    some = rows[order]
    new = np.flatnonzero(np.append(True, some[1:] != some[:-1]))
    out = np.zeros((size, values.shape[1]), np.float32)
    out[some[new]] = np.add.reduceat(values[order], new, axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Trainer:
    """Noise-contrastive estimation on minibatches, with per-entry adaptive steps."""

    def __init__(self, noise: np.ndarray, seed: int) -> None:
        self.p = start_parameters(noise)
        self.squares = {k: np.full_like(v, 1e-6) for k, v in self.p.items()}
        self.log_noise = (np.log(noise) + np.log(NOISE)).astype(np.float32)
        self.cumulative = np.cumsum(noise)
        self.rng = np.random.default_rng(seed)
        self.tokens = 0

    def gradients(self, target: np.ndarray, one: np.ndarray, two: np.ndarray, drawn: np.ndarray) -> dict[str, np.ndarray]:
        """Ascent direction of the mean objective of a batch (classes of targets and contexts, noise classes)."""
        p, n = self.p, np.float32(len(target))
        a, b = p["context"][one], p["context"][two]
        predicted = a * p["place"][0] + b * p["place"][1]
        out, far = p["output"][target], p["output"][drawn]
        real = (predicted * out).sum(1) + p["bias"][target, 0] - self.log_noise[target]
        fake = predicted @ far.T + p["bias"][drawn, 0] - self.log_noise[drawn]
        up = ((1 - _sigmoid(real)) / n)[:, None]
        down = -_sigmoid(fake) / n
        d = up * out + down @ far
        size = len(p["output"])
        return {"output": _scatter(target, up * predicted, size) + _scatter(drawn, down.T @ predicted, size),
                "bias": _scatter(target, up, size) + _scatter(drawn, down.sum(0)[:, None], size),
                "context": _scatter(one, d * p["place"][0], size) + _scatter(two, d * p["place"][1], size),
                "place": np.stack([(d * a).sum(0), (d * b).sum(0)])}

    def objective(self, target: np.ndarray, one: np.ndarray, two: np.ndarray, drawn: np.ndarray) -> float:
        p = self.p
        predicted = p["context"][one] * p["place"][0] + p["context"][two] * p["place"][1]
        real = (predicted * p["output"][target]).sum(1) + p["bias"][target, 0] - self.log_noise[target]
        fake = predicted @ p["output"][drawn].T + p["bias"][drawn, 0] - self.log_noise[drawn]
        return float((np.log(_sigmoid(real)) + np.log(1 - _sigmoid(fake)).sum(1)).mean())

    def learn(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        drawn = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), len(self.cumulative) - 1)
        for name, g in self.gradients(target, one, two, drawn).items():
            self.squares[name] += g * g
            self.p[name] += np.float32(RATE) * g / np.sqrt(self.squares[name])
        self.tokens += len(target)


def train(docs: DataFrame, text: str, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Parameters averaged over the tasks' epochs, weighted by tokens."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(vocabulary)
    width, bound, size = 2 * DIM + 1, SLICE_BYTES, BATCH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        trainer = Trainer(known.noise, TaskContext.get().partitionId())
        left = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            for _, words, ids, rows in _tokens(batch.column(0), bound):
                kinds = np.append(known.classes(words), 0)[ids]
                more = (kinds, *_contexts(kinds, rows))
                left = [np.concatenate(x) for x in zip(left, more)]
                while len(left[0]) >= size:
                    trainer.learn(*[x[:size] for x in left])
                    left = [x[size:] for x in left]
        if len(left[0]):
            trainer.learn(*left)
        if trainer.tokens:
            p = trainer.p
            every = np.concatenate([np.hstack([p["context"], p["output"], p["bias"]]),
                                    np.pad(p["place"], ((0, 0), (0, width - DIM)))]).astype(np.float64) * trainer.tokens
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(every), dtype=np.int32)), pa.array([trainer.tokens] * len(every), pa.int64()),
                 *[pa.array(every[:, j]) for j in range(width)]], names=["k", "n", *[f"v{j}" for j in range(width)]])
    schema = "k int, n long, " + ", ".join(f"v{j} double" for j in range(width))
    sums = (docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, schema).groupBy("k")
            .agg(F.sum("n").alias("n"), *[F.sum(f"v{j}").alias(f"v{j}") for j in range(width)]).toArrow().sort_by("k"))
    if not sums.num_rows:
        return start_parameters(vocabulary.noise)
    mean = np.stack([sums[f"v{j}"].to_numpy() for j in range(width)], axis=1) / sums["n"].to_numpy()[:, None]
    own = mean[:CLASSES].astype(np.float32)
    return {"context": own[:, :DIM], "output": own[:, DIM:2 * DIM], "bias": own[:, 2 * DIM:], "place": mean[CLASSES:, :DIM].astype(np.float32)}


def normalisers(spark: SparkSession, p: dict[str, np.ndarray]) -> np.ndarray:
    """log of the sum over all classes, for each pair of context classes (one row of pairs at a time)."""
    sent = spark.sparkContext.broadcast(p)
    size = len(p["output"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = sent.value
        for batch in batches:
            for one in batch.column(0).to_pylist():
                predicted = q["context"][one] * q["place"][0] + q["context"] * q["place"][1]
                s = predicted @ q["output"].T + q["bias"][:, 0]
                top = s.max(1, keepdims=True)
                z = (np.log(np.exp(s - top).sum(1, dtype=np.float64)) + top[:, 0]).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([one], pa.int64()), pa.array([z.tobytes()], pa.binary())], names=["id", "z"])
    rows = spark.range(size).repartition(8).mapInArrow(run, "id long, z binary").collect()      # size x size floats
    out = np.zeros((size, size), np.float32)
    for r in rows:
        out[r["id"]] = np.frombuffer(r["z"], np.float32)
    return out


def class_scores(p: dict, z: np.ndarray, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """log10 of the normalised probability of each target class."""
    predicted = p["context"][one] * p["place"][0] + p["context"][two] * p["place"][1]
    s = (predicted * p["output"][target]).sum(1) + p["bias"][target, 0]
    return (s - z[one, two]).astype(np.float64) / np.log(10)


def score_texts(docs: DataFrame, counts: DataFrame, vocabulary: Vocabulary, p: dict[str, np.ndarray], scratch: Scratch,
                text: str = "text", out: str = "scored") -> DataFrame:
    """``docs`` with a struct column ``out``: n_tokens, n_known, base_score, score (log10)."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((vocabulary, p, normalisers(spark, p)))
    names, column, bound, end = docs.columns, docs.columns.index(text), SLICE_BYTES, END
    row_id, rest = fresh("row"), fresh("rest")
    kind = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                         T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    rare_kind = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField(row_id, T.LongType()), T.StructField(out, kind), T.StructField(rest, rare_kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, q, z = sent.value
        below = np.log10(known.tokens + ALPHA * (known.distinct + 1))
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part, words, ids, rows in _tokens(batch.column(column), bound):
                n = part.rows
                kinds_of, seen = np.append(known.classes(words), 0), np.append(known.known(words), known.end)
                kinds, c = kinds_of[ids], seen[ids]
                found = c >= 0
                share = np.where(found, np.log10(np.maximum(c, 0) + ALPHA), 0.0)      # the others' come by the join
                base = np.bincount(rows, share - below, n)
                token = class_scores(q, z, kinds, *_contexts(kinds, rows)) + np.where(kinds > SHORT, share - known.inner[kinds], 0.0)
                pairs, times = np.unique(rows[~found] * len(words) + ids[~found], return_counts=True)
                row, word = np.divmod(pairs, max(len(words), 1))
                scored = pa.StructArray.from_arrays(
                    [pa.array(np.bincount(rows, minlength=n)), pa.array(np.bincount(rows[c > 0], minlength=n)),
                     pa.array(base), pa.array(np.bincount(rows, token, n))], names=kind.names)
                others = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=n))), pa.int32()),
                    pa.StructArray.from_arrays([words.take(pa.array(word)), pa.array(times)], names=["word", "n"]))
                yield pa.RecordBatch.from_arrays([*batch.slice(part.lo, n).columns, pa.array(first + np.arange(n)), scored, others],
                                                 names=[*names, row_id, out, rest])
                first += n
    made = scratch.keep(map_batches(docs, run, schema), "scored")
    word = made.select(row_id, F.inline(rest)).join(counts.where(F.col("c") < vocabulary.least), "word", "left")
    extra, known = fresh("extra"), fresh("known")
    late = word.groupBy(row_id).agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + ALPHA)).alias(extra),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias(known))
    more = F.coalesce(F.col(extra), F.lit(0.0))
    return made.join(late, row_id, "left").select(*[F.col(f"`{c}`") for c in names], F.struct(
        F.col(f"{out}.n_tokens").alias("n_tokens"), (F.col(f"{out}.n_known") + F.coalesce(F.col(known), F.lit(0))).alias("n_known"),
        (F.col(f"{out}.base_score") + more).alias("base_score"), (F.col(f"{out}.score") + more).alias("score")).alias(out))


def language_model_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", out: str = "scored", hot: int = HOT) -> tuple[DataFrame, int]:
    """(``docs`` with the struct column ``out``, tokens learned from)."""
    scratch = Scratch(docs.sparkSession, "log-bilinear")
    learn = docs.where(training(doc_id))
    counts = scratch.keep(word_counts(learn, text), "counts")
    vocabulary = Vocabulary(counts, hot)
    return score_texts(docs, counts, vocabulary, train(learn, text, vocabulary), scratch, text, out), vocabulary.tokens


def op13_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every whole document, beside a unigram model's."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, tokens = language_model_scores(docs)
    return found.select("doc_id", (~training("doc_id")).alias("held_out"), F.col("scored.n_tokens").alias("n_tokens"),
                        F.col("scored.n_known").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
                        F.col("scored.base_score").alias("base_score"), F.col("scored.score").alias("score"))
