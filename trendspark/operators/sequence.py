"""Per-entity ordered sequences (row numbering) that survive a hot entity.

A plain ``row_number() over (partition by entity order by ts)`` puts each entity in
one task; one entity holding a third of all rows would then be one task. Here the
numbering is built from a global range partitioning instead:

0. Group sizes are measured; groups up to ``chunk_rows`` (nearly always all of them)
   use a plain window - bounded, one shuffle. Only larger groups take steps 1-3.
1. ``repartitionByRange(entity, order...)`` splits every entity, however large, over
   several ordered partitions (Spark samples the key distribution).
2. Inside each partition rows are sorted; ``monotonically_increasing_id`` then gives
   each row its position inside the partition. Partition id and position are
   written to the shared checkpoint folder, which freezes them (a retried or lost
   task can never renumber) and cuts the lineage.
3. Per (entity, partition) counts are aggregated (at most one row per entity and
   partition), an exclusive running sum over an entity's partitions gives the
   offset, and a join on (entity, partition) - never on the entity alone - adds
   it back: ``seq = offset + position - first position + 1``.

No step holds more than one partition's rows of an entity in a task.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.operators.joins import broadcast_if_small, join_null_safe, parts_for, spread
from trendspark.session import discard, materialize, shuffle_partitions

_POS_MASK = (1 << 33) - 1


def _sort_expr(c: str | Column) -> Column:
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c


# Default rows of one group a single task may hold before it is split.
DEFAULT_CHUNK_ROWS = 1_000_000


def _running(df: DataFrame, flag: str, out: str) -> DataFrame:
    """``df`` with the running sum of ``flag`` from each partition's first row on (``out``)."""
    at, names = df.columns.index(flag), [*df.columns, out]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        before = 0
        for batch in batches:
            if batch.num_rows:
                total = before + np.cumsum(batch.column(at).to_numpy(zero_copy_only=False).astype("int64"))
                before = int(total[-1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total)], names=names)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.LongType())]))


def range_number_rows(df: DataFrame, keys: list[str], order: list[str | Column], *,
                      out: str = "seq", total_out: str | None = None,
                      partitions: int | None = None, label: str = "seq",
                      flag: str | None = None, flag_out: str = "flagged") -> DataFrame:
    """Exact numbering through a range partitioning (any group size, split across tasks).

    ``flag_out`` optionally counts the group's rows up to and with this one whose ``flag``
    (0 or 1) is 1.
    """
    spark = df.sparkSession
    n_parts = partitions or shuffle_partitions(spark)
    sort_cols = [F.col(k).asc_nulls_last() for k in keys] + [_sort_expr(o) for o in order]
    ranged = (df.repartitionByRange(n_parts, *sort_cols)
              .sortWithinPartitions(*sort_cols)
              .withColumn("_rp", F.spark_partition_id())
              .withColumn("_ri", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK))))
    ranged = materialize(_running(ranged, flag, "_rf") if flag else ranged, label)

    flags = [F.sum(flag).alias("_fn"), F.min(F.col("_rf") - F.col(flag)).alias("_f0")] if flag else []
    stats = ranged.groupBy(*keys, "_rp").agg(F.count(F.lit(1)).alias("_n"),
                                              F.min("_ri").alias("_r0"), *flags)
    before = Window.partitionBy(*keys).orderBy("_rp").rowsBetween(Window.unboundedPreceding, -1)
    stat_cols = [*keys, "_rp", "_r0",
                 F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")]
    if total_out:
        stat_cols.append(F.sum("_n").over(Window.partitionBy(*keys)).alias(total_out))
    if flag:
        stat_cols += ["_f0", F.coalesce(F.sum("_fn").over(before), F.lit(0)).alias("_foff")]
    stats = stats.select(*stat_cols)

    joined = join_null_safe(ranged, broadcast_if_small(stats), [*keys, "_rp"])
    seq = (F.col("_off") + F.col("_ri") - F.col("_r0") + F.lit(1)).cast("long")
    joined = joined.withColumn(out, seq)
    if flag:
        joined = joined.withColumn(flag_out, (F.col("_foff") + F.col("_rf") - F.col("_f0")).cast("long"))
    return joined.drop("_rp", "_ri", "_r0", "_off", "_rf", "_f0", "_foff")


def number_rows(df: DataFrame, keys: list[str], order: list[str | Column], *,
                out: str = "seq", total_out: str | None = None,
                chunk_rows: int = DEFAULT_CHUNK_ROWS,
                partitions: int | None = None, label: str = "seq") -> DataFrame:
    """Add ``out`` = 1..n within each ``keys`` group following ``order``.

    ``order`` must make rows unique within a group (end it with an id) for a
    deterministic result. ``total_out`` optionally adds the group's row count.

    Group sizes are measured first (a partial aggregate). Groups of at most
    ``chunk_rows`` rows - normally all of them - are numbered with a plain window
    (one task holds at most ``chunk_rows`` rows of a group). Larger groups are
    numbered through ``range_number_rows`` and the two parts are unioned.
    """
    # One row per group; kept (memory, then disk) between the decision and the
    # hot-key write so the input is aggregated once.
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")).persist(StorageLevel.MEMORY_AND_DISK)
    stats = sizes.agg(F.max("_size").alias("largest"),
                      F.count_if(F.col("_size") > F.lit(chunk_rows)).alias("n_hot")).first()
    if stats is None or stats["largest"] is None or stats["n_hot"] == 0:
        sizes.unpersist()
        return window_number_rows(df, keys, order, out=out, total_out=total_out)
    # Written once, so its size is known; broadcast only under the session's threshold.
    hot = materialize(sizes.where(F.col("_size") > F.lit(chunk_rows)).select(*keys), f"{label}-hot")
    sizes.unpersist()
    hot_keys = broadcast_if_small(hot)
    cold = window_number_rows(join_null_safe_semi(df, hot_keys, keys, anti=True), keys, order,
                              out=out, total_out=total_out)
    warm = range_number_rows(join_null_safe_semi(df, hot_keys, keys, anti=False), keys, order,
                             out=out, total_out=total_out, partitions=partitions, label=label)
    return cold.unionByName(warm)


def join_null_safe_semi(df: DataFrame, keys_df: DataFrame, keys: list[str], anti: bool) -> DataFrame:
    """Semi / anti join on ``keys`` where null keys match each other."""
    from functools import reduce
    r = keys_df.select(*[F.col(k).alias(f"__k_{k}") for k in keys])
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(r[f"__k_{k}"]) for k in keys])
    return df.join(r, cond, "left_anti" if anti else "left_semi")


def window_number_rows(df: DataFrame, keys: list[str], order: list[str | Column], *,
                       out: str = "seq", total_out: str | None = None) -> DataFrame:
    """Plain windows, one task per entity: the path when no group exceeds one chunk."""
    w = Window.partitionBy(*keys).orderBy(*[_sort_expr(o) for o in order])
    res = df.withColumn(out, F.row_number().over(w).cast("long"))
    if total_out:
        res = res.withColumn(total_out, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return res


def sequence(df: DataFrame, entity: list[str], order: list[str | Column], *,
             group: list[str] | None = None,
             seq_out: str = "match_sequence_number",
             count_out: str = "player_match_count",
             group_seq_out: str = "champion_match_sequence_number",
             group_count_out: str = "player_champion_match_count",
             chunk_rows: int = DEFAULT_CHUNK_ROWS,
             label: str = "sequence", store_input: bool = True, parts: int = 0) -> DataFrame:
    """Number an entity's rows 1..n (and, with ``group``, within entity x group).

    The result is written once to the checkpoint folder: it is the shared input
    of several marts, and its lineage (joins, numbering) is cut there. The input
    is written first as well, because group sizes are measured before numbering and the
    input (often a join) should not be computed twice; that copy is deleted at the end.
    An input over stored tables needs no copy (``store_input``). The windows run in as many
    partitions as the stored rows need (``parts`` of an input that is not copied).
    """
    source = materialize(df, f"{label}-input") if store_input else df
    parts = parts_for(source) if store_input else parts
    res = number_rows(spread(source, parts, *entity), entity, order, out=seq_out, total_out=count_out,
                      chunk_rows=chunk_rows, label=label)
    if group:
        res = number_rows(res, [*entity, *group], order, out=group_seq_out,
                          total_out=group_count_out, chunk_rows=chunk_rows, label=f"{label}-group")
    done = materialize(res, label)
    if store_input:
        discard(source)
    return done
