"""Sharding by a Hilbert curve over quantised metadata (DataFrame functions only).

Each dimension is quantised to ``BITS`` bits: numbers by their order of magnitude in
steps of a quarter, everything else by a hash. The curve index of the cell orders the
rows (then text checksum and id, so copies stay together), and the order is cut into
runs of equal row counts: law ``rows``, counts at most one apart. Rows of a shard hence
come from few neighbouring cells, and per-file statistics prune on any dimension.

The order is a range partitioning with a sort inside each partition, written once; a
row's rank is its place in the partition plus the sizes of the partitions before it (one
row per partition). No key has to fit one task: ties are spread by a random number.

Defined cases: a null text has size 16 and checksum 0; null dimensions share a cell;
repeated rows get places of their own; an empty table gives an empty result; shards may
be empty when there are fewer rows than shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.llm.common import Scratch, fresh, table

BITS = 5
SHARDS = 40


def quantise(df: DataFrame, column: str, bits: int = BITS) -> F.Column:
    """A cell number below ``2 ** bits``: quarter powers of two of a number, else a hash."""
    top = (1 << bits) - 1
    if isinstance(df.schema[column].dataType, T.NumericType):
        size = F.greatest(F.col(column).cast("double"), F.lit(1.0))
        cell = F.least(F.floor(F.log2(size) * 2), F.lit(top))
    else:
        cell = F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(top + 1))
    return F.coalesce(cell, F.lit(0)).cast("int")


def hilbert_index(cells: list[F.Column], bits: int = BITS) -> F.Column:
    """Place of a cell on the Hilbert curve through the cube of ``2 ** bits`` per side.

    The transposed form is computed by folding over (bit, dimension) steps: undo the
    rotations from the highest bit down, Gray-encode, then interleave the bits.
    """
    dims = len(cells)
    start = F.array(*[c.cast("int") for c in cells])
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(dims)])

    def turn(x: F.Column, step: F.Column) -> F.Column:
        q, i = step["q"], step["i"]
        low = q - 1
        first, mine = F.get(x, F.lit(0)), F.get(x, i)
        swap = first.bitwiseXOR(mine).bitwiseAND(low)
        set_bit = mine.bitwiseAND(q) != 0

        def change(value: F.Column, k: F.Column) -> F.Column:
            return (F.when(set_bit & (k == 0), value.bitwiseXOR(low))
                    .when(~set_bit & (i != 0) & ((k == 0) | (k == i)), value.bitwiseXOR(swap))
                    .otherwise(value))
        return F.transform(x, change)

    turned = F.aggregate(steps, start, turn)
    gray = F.aggregate(
        turned, F.expr("cast(array() as array<int>)"),
        lambda acc, v: F.concat(acc, F.array(v.bitwiseXOR(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0))))))
    powers = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])
    flip = lambda x: F.aggregate(
        powers, F.lit(0), lambda acc, q: F.when(F.element_at(x, -1).bitwiseAND(q) != 0, acc.bitwiseXOR(q - 1)).otherwise(acc))
    done = F.transform(F.array(gray), lambda x: F.transform(x, lambda v: v.bitwiseXOR(flip(x))))[0]
    places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i"))
                       for b in range(bits - 1, -1, -1) for i in range(dims)])
    bit = lambda x, p: F.call_function("shiftright", F.get(x, p["i"]), p["b"]).bitwiseAND(1)
    index = F.transform(F.array(done), lambda x: F.aggregate(
        places, F.lit(0).cast("long"), lambda acc, p: acc * 2 + bit(x, p)))
    return index[0]


def shard_rows(docs: DataFrame, doc_id: str, text: str, dimensions: list[str], shards: int = SHARDS,
               bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, curve, shard and slot of every row (law ``rows``).

    ``dimensions`` name columns of ``docs``; the text's size is always the first one.
    """
    scratch = Scratch(docs.sparkSession, "sharding")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    size = (F.octet_length(body) + 16).cast("long")
    # renamed by place, so that no column of the caller clashes
    flat = docs.select(F.col(doc_id).alias("id"), size.alias("size"), F.crc32(body).alias("crc"),
                       *[F.col(c).alias(f"d{i}") for i, c in enumerate(dimensions)])
    cells = [quantise(flat, "size", bits), *[quantise(flat, f"d{i}", bits) for i in range(len(dimensions))]]
    rows = flat.select("id", "size", "crc", hilbert_index(cells, bits).alias("curve"), F.rand(0).alias("tie"))
    order = ["curve", "crc", "id", "tie"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    mid = F.monotonically_increasing_id()
    placed = scratch.keep(
        rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie")
        .withColumn("part", F.shiftrightunsigned(mid, 33)).withColumn("place", mid.bitwiseAND((1 << 33) - 1)), "placed")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
                           F.sum("n").over(everything).alias("total"))  # one row per partition
    rank = F.col("offset") + F.col("place")
    shard = F.expr(f"(offset + place) * {shards} div total")
    return (placed.join(F.broadcast(offsets), "part")
            .withColumn("rank", rank).withColumn("shard", shard)
            .select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), "curve",
                    F.col("shard").cast("int").alias("shard"),
                    (F.col("rank") - F.expr(f"(shard * total + {shards - 1}) div {shards}")).cast("long").alias("slot")))


def write_shards(docs: DataFrame, path: str, doc_id: str, text: str, dimensions: list[str],
                 shards: int = SHARDS) -> None:
    """Write ``docs`` as one folder per shard, rows in curve order (ids must be unique)."""
    shard, slot, key = fresh("shard"), fresh("slot"), fresh("id")
    placed = shard_rows(docs, doc_id, text, dimensions, shards).select(
        F.col("doc_id").alias(key), F.col("shard").alias(shard), F.col("slot").alias(slot))
    (docs.join(placed, docs[doc_id].eqNullSafe(F.col(key))).drop(key)
     .repartitionByRange(shards, shard).sortWithinPartitions(shard, slot).drop(slot)
     .withColumnRenamed(shard, "shard").write.partitionBy("shard").parquet(path))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards along the curve over size, language and source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    placed = shard_rows(docs, "doc_id", "text", ["lang", "source"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")
