"""Exact top-k inner-product search by tiled matrix products.

Vectors are packed into shards (the stored side) and query blocks, each a row with one
matrix of at most ``SHARD`` or ``BLOCK`` vectors. Every shard meets every query block of
its length on the block's number and the shard's group (a stated query set against all
rows, in blocks); a task multiplies
the two matrices, selects each query's best ``k`` of the tile and merges them with its
earlier tiles of the same block. The per-query lists are then merged in two levels.

Scores are integers. A product runs in double precision while the largest possible sum
stays below 2**53, else in Python integers, so scores are exact; a score outside 64 bits
fails the job. Ties go to the smaller vec_id.

Defined cases: vectors that are null, or hold null or non-finite components, take no
part; vectors of different lengths only meet their own length; a null id takes no part;
a row is not its own candidate, so of rows sharing an id none meets another; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendspark.llm.common import Scratch, table

SHARD = 8192
BLOCK = 1024
MERGE_FAN = 64


def _quantised(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(vec_id, dim, v): floor(scale * x) as doubles, for vectors that take part."""
    x = F.transform(F.col(embedding), lambda e: F.floor(e.cast("double") * scale).cast("double"))
    bad = F.exists(F.col(embedding), lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    return (vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & ~F.coalesce(bad, F.lit(True)))
            .select(F.col(vec_id).cast("long").alias("vec_id"),
                    F.size(embedding).alias("dim"), x.alias("v")).where("dim > 0"))


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows of one matrix each: dim, ids and components, at most ``size`` vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def pack(dim: int) -> pa.RecordBatch:
            ids, values = zip(*held.pop(dim))
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([np.concatenate(ids).astype(np.int64).tobytes()]),
                 pa.array([np.concatenate(values).astype(np.float64).tobytes()])], names=["dim", "ids", "mat"])

        for batch in batches:
            ids, dims = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            flat = batch.column(2).flatten().to_numpy()
            start = np.cumsum(dims) - dims
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                while len(at):
                    have = sum(len(i) for i, _ in held.get(dim, []))
                    now, at = at[:size - have], at[size - have:]
                    take = (start[now][:, None] + np.arange(dim)).ravel()
                    held.setdefault(dim, []).append((ids[now], flat[take]))
                    if have + len(now) == size:
                        yield pack(dim)
        for dim in list(held):
            yield pack(dim)
    return rows.select("vec_id", "dim", "v").mapInArrow(run, "dim int, ids binary, mat binary")


def tile_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of two integer-valued matrices."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(q.shape[1], 1)
    if top < 2.0 ** 53:
        return (q @ c.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in q], object) @ np.array([[int(x) for x in r] for r in c], object).T
    return exact.astype(np.int64)  # raises if a score leaves 64 bits


def tile_top(q_ids: np.ndarray, c_ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query position, vec_id, score) of each query's best k in one tile; own ids excluded."""
    own = c_ids[None, :] == q_ids[:, None]
    n = scores.shape[1]
    low = np.iinfo(np.int64).min
    ranked = np.where(own, low, scores)
    kth = np.partition(ranked, n - k, axis=1)[:, n - k] if n > k else np.full(len(q_ids), low)
    rows, cols = np.nonzero((ranked >= kth[:, None]) & ~own)  # ties at the k-th included
    order = np.lexsort((c_ids[cols], ~scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    at, cand = rows[place < k], cols[place < k]
    return at, c_ids[cand], scores[at, cand]


def exact_top_k(vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                k: int = 20, scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows of ``vectors`` by score."""
    scratch = Scratch(vectors.sparkSession, "top-k")
    shards = scratch.keep(_packed(_quantised(vectors, vec_id, embedding, scale), SHARD), "shards")
    blocks = scratch.keep(_packed(_quantised(queries, vec_id, embedding, scale), BLOCK)
                          .withColumn("id", F.monotonically_increasing_id()), "blocks")
    # number the blocks of each vector length: one small row per block
    order = Window.partitionBy("dim").orderBy("id")
    numbers = scratch.keep(blocks.select("dim", "id").withColumn("block", F.row_number().over(order)), "numbers")
    per_dim = {r["dim"]: r["n"] for r in numbers.groupBy("dim").agg(F.max("block").alias("n")).collect()}
    if not per_dim:
        per_dim = {0: 0}
    # each block meets the shards in several groups, so few blocks still make many tasks
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    groups = max(1, -(-parts // max(1, sum(per_dim.values()))))
    last = F.element_at(F.create_map(*[F.lit(x) for d in per_dim for x in (d, per_dim[d])]), F.col("dim"))
    tiles = (shards.withColumnRenamed("ids", "c_ids").withColumnRenamed("mat", "c_mat")
             .where(F.col("dim").isin(list(per_dim)) & (last > 0))
             .withColumn("g", F.pmod(F.xxhash64("c_ids"), F.lit(groups)))
             .withColumn("block", F.explode(F.sequence(F.lit(1), last)))
             .join(blocks.join(numbers.drop("dim"), "id").drop("id")
                   .withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))),
                   ["dim", "block", "g"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, pd.DataFrame] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                block, dim, c_ids, c_mat, q_ids, q_mat = (batch.column(j)[i].as_py() for j in range(6))
                qi, ci = np.frombuffer(q_ids, np.int64), np.frombuffer(c_ids, np.int64)
                q = np.frombuffer(q_mat).reshape(-1, dim)
                c = np.frombuffer(c_mat).reshape(-1, dim)
                at, vec, score = tile_top(qi, ci, tile_scores(q, c), k)
                new = pd.DataFrame({"at": at, "query_id": qi[at], "vec_id": vec, "score": score})
                key = (dim, block)
                if key in best:
                    new = pd.concat([best[key], new])
                    new = new.sort_values(["at", "score", "vec_id"], ascending=[True, False, True], kind="stable")
                    new = new[new.groupby("at").cumcount() < k]
                best[key] = new
                if len(best) > 16:  # keep few blocks open; what leaves is merged later
                    gone = next(iter(best))
                    yield _rows(gone, best.pop(gone))
        for key, frame in best.items():
            yield _rows(key, frame)

    def _rows(key: tuple, frame: pd.DataFrame) -> pa.RecordBatch:
        whole = frame[["at", "query_id", "vec_id", "score"]].assign(dim=np.int32(key[0]), block=np.int32(key[1]))
        return pa.RecordBatch.from_pandas(whole[["dim", "block", "at", "query_id", "vec_id", "score"]], preserve_index=False)

    lists = tiles.select("block", "dim", "c_ids", "c_mat", "ids", "mat") \
        .mapInArrow(run, "dim int, block int, at long, query_id long, vec_id long, score long")
    ranked = [F.desc("score"), F.asc("vec_id")]
    branch = F.pmod(F.xxhash64("vec_id"), F.lit(MERGE_FAN))
    row = ["dim", "block", "at"]           # a query row's place: rows that share an id keep lists of their own
    first = Window.partitionBy(*row, "branch").orderBy(*ranked)
    last = Window.partitionBy(*row).orderBy(*ranked)
    merged = (lists.withColumn("branch", branch).withColumn("r", F.row_number().over(first)).where(F.col("r") <= k)
              .withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k))
    return merged.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all vectors for each row whose vec_id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return exact_top_k(vectors, vectors.where("vec_id % 20 = 0"))


OP4_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
