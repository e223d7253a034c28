"""Rolling, expanding and percent-rank windows over numbered sequences.

Windows are partitioned by (entity, chunk) where ``chunk = (seq - 1) div C``, so a
task never holds more than ``C`` rows of one entity (plus a small halo):

* bounded frames (``ROWS n-1 PRECEDING``): the last ``n - 1`` rows of each chunk are
  copied into the next chunk as a halo, so every frame is complete inside its chunk;
* expanding frames: a running sum / count inside the chunk plus the totals of all
  earlier chunks (an aggregate of at most one row per entity and chunk);
* percent_rank over the whole entity: a window inside the chunk when the entity has
  one chunk (the usual case); longer entities are ranked with a range-partitioned
  numbering of their values (``sequence.number_rows``), also split across tasks.

For entities shorter than ``C`` (every entity at test scale) the results are exactly
those of the plain SQL windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendspark.operators.joins import broadcast_if_small, join_null_safe, parts_for, spread, spread_by_range
from trendspark.operators.sequence import number_rows


RUN_SALTS = 64


def chunk_of(seq_col: str, chunk_rows: int) -> Column:
    return F.floor((F.col(seq_col) - F.lit(1)) / F.lit(chunk_rows)).cast("long")


def _chunk_offsets(base: DataFrame, keys: list[str], metrics: Sequence[str]) -> DataFrame:
    """Sum and non-null count of each metric over all earlier chunks of the entity."""
    aggs = []
    for m in metrics:
        aggs += [F.sum(F.col(m).cast("double")).alias(f"_cs_{m}"), F.count(F.col(m)).alias(f"_cc_{m}")]
    per_chunk = base.groupBy(*keys, "_chunk").agg(*aggs)
    prior = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    cols = [*keys, "_chunk"]
    for m in metrics:
        cols += [F.coalesce(F.sum(f"_cs_{m}").over(prior), F.lit(0.0)).alias(f"_os_{m}"),
                 F.coalesce(F.sum(f"_cc_{m}").over(prior), F.lit(0)).alias(f"_oc_{m}")]
    return per_chunk.select(*cols)


def _hot_percent_ranks(rows: DataFrame, keys: list[str], seq_col: str, total_col: str,
                       metrics: Sequence[str], suffix: str, chunk_rows: int) -> DataFrame:
    """percent_rank per metric for entities longer than one chunk.

    rank = position of the first row with an equal value in (value asc nulls last)
    order; percent_rank = (rank - 1) / (n - 1).
    """
    out = None
    for m in metrics:
        vals = rows.select(*keys, seq_col, total_col, m)
        pos = number_rows(vals, keys, [F.col(m).asc_nulls_last(), F.col(seq_col).asc()],
                          out="_pos", chunk_rows=chunk_rows, label=f"rank-{m}")
        # Equal values lie in one run of positions; the run's first position is joined back
        # per residue class of the position, so a very common value is not one join key.
        first = (pos.groupBy(*keys, m).agg(F.min("_pos").alias("_rank"), F.count(F.lit(1)).alias("_c"))
                 .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("_c"), F.lit(RUN_SALTS)) - 1)))
                 .withColumn("_salt", F.pmod(F.col("_rank") + F.col("_salt"), F.lit(RUN_SALTS))).drop("_c"))
        pos = pos.withColumn("_salt", F.pmod("_pos", F.lit(RUN_SALTS)))
        ranked = join_null_safe(pos, first, [*keys, m, "_salt"])
        pr = F.when(F.col(total_col) > 1,
                    (F.col("_rank") - 1).cast("double") / (F.col(total_col) - 1).cast("double")
                    ).otherwise(F.lit(0.0))
        one = ranked.select(*keys, seq_col, pr.alias(f"{m}_{suffix}"))
        out = one if out is None else join_null_safe(out, one, [*keys, seq_col])
    return out


def rolling_trends(df: DataFrame, keys: list[str], seq_col: str, total_col: str,
                   metrics: Sequence[str], *, window: int = 10, win_col: str | None = "is_win",
                   rolling_suffix: str = "rolling_avg", expanding_suffix: str = "career_avg",
                   percentile_suffix: str = "career_percentile",
                   chunk_rows: int = 1_000_000, ranged: bool = False) -> DataFrame:
    """Rolling / expanding averages, percent ranks, rolling win rate and window count.

    Adds per metric ``<m>_<rolling_suffix>``, ``<m>_<expanding_suffix>``,
    ``<m>_<percentile_suffix>``, plus ``win_rate_rolling``, ``matches_in_window``,
    ``rolling_window_matches`` and ``is_full_window``. ``ranged``: where every entity fits one
    task, rows are dealt by ranges of the first key.
    """
    if window < 1:
        raise ValueError("window must be >= 1")
    C = max(int(chunk_rows), window)
    metrics = list(metrics)
    hot = F.col(total_col) > F.lit(C)
    if df.where(hot).isEmpty():
        # Every entity fits one task: the plain windows, one shuffle on the entity, in as
        # many partitions as the rows need, since each sort order holds a task's rows anew.
        parts = parts_for(df)
        dealt = spread_by_range(df, parts, keys[0]) if ranged else spread(df, parts, *keys)
        return window_rolling_trends(dealt, keys, seq_col, metrics, window=window, win_col=win_col,
                                     rolling_suffix=rolling_suffix, expanding_suffix=expanding_suffix,
                                     percentile_suffix=percentile_suffix)
    base = df.withColumn("_chunk", chunk_of(seq_col, C)).withColumn("_halo", F.lit(False))
    ext = base
    if window > 1:
        pos_in_chunk = F.col(seq_col) - F.lit(1) - F.col("_chunk") * F.lit(C)
        halo = (base.where(pos_in_chunk >= F.lit(C - (window - 1)))
                .withColumn("_chunk", F.col("_chunk") + 1).withColumn("_halo", F.lit(True)))
        ext = base.unionByName(halo)

    offsets = _chunk_offsets(base, keys, metrics)
    ext = join_null_safe(ext, broadcast_if_small(offsets), [*keys, "_chunk"], how="left")

    part = Window.partitionBy(*keys, "_chunk")
    ordered = part.orderBy(F.col(seq_col).asc())
    rolling = ordered.rowsBetween(-(window - 1), 0)
    running = ordered.rowsBetween(Window.unboundedPreceding, 0)

    cols: list[Column] = []
    real = ~F.col("_halo")
    for m in metrics:
        v = F.col(m).cast("double")
        cols.append(F.avg(v).over(rolling).alias(f"{m}_{rolling_suffix}"))
        run_s = F.sum(F.when(real, v)).over(running)
        run_c = F.count(F.when(real, v)).over(running)
        tot_c = run_c + F.col(f"_oc_{m}")
        cols.append(F.when(tot_c > 0, (F.coalesce(run_s, F.lit(0.0)) + F.col(f"_os_{m}")) / tot_c)
                    .alias(f"{m}_{expanding_suffix}"))
        cols.append(F.percent_rank().over(part.orderBy(F.col(m).asc_nulls_last()))
                    .alias(f"{m}_{percentile_suffix}"))
    if win_col:
        cols.append(F.avg(F.when(F.col(win_col), F.lit(1.0)).otherwise(F.lit(0.0))).over(rolling)
                    .alias("win_rate_rolling"))
    cols.append(F.count(F.lit(1)).over(rolling).alias("matches_in_window"))

    keep = [c for c in df.columns]
    res = ext.select(*keep, "_halo", *cols).where(~F.col("_halo")).drop("_halo")
    res = res.withColumn("rolling_window_matches", F.lit(window)) \
             .withColumn("is_full_window", F.col("matches_in_window") == F.lit(window))

    # Entities longer than one chunk: replace the chunk-local percent ranks.
    pct_cols = [f"{m}_{percentile_suffix}" for m in metrics]
    hot_ranks = _hot_percent_ranks(df.where(hot), keys, seq_col, total_col, metrics,
                                   percentile_suffix, C)
    cold = res.where(~hot)
    hot_rows = join_null_safe(res.where(hot).drop(*pct_cols), hot_ranks, [*keys, seq_col])
    return cold.unionByName(hot_rows.select(*cold.columns))


def window_rolling_trends(df: DataFrame, keys: list[str], seq_col: str, metrics: Sequence[str], *,
                          window: int = 10, win_col: str | None = "is_win",
                          rolling_suffix: str = "rolling_avg", expanding_suffix: str = "career_avg",
                          percentile_suffix: str = "career_percentile") -> DataFrame:
    """Plain windows partitioned by the entity: the path when no entity exceeds one chunk."""
    part = Window.partitionBy(*keys)
    ordered = part.orderBy(F.col(seq_col).asc())
    rolling = ordered.rowsBetween(-(window - 1), 0)
    running = ordered.rowsBetween(Window.unboundedPreceding, 0)
    cols = []
    for m in metrics:
        v = F.col(m).cast("double")
        cols += [F.avg(v).over(rolling).alias(f"{m}_{rolling_suffix}"),
                 F.avg(v).over(running).alias(f"{m}_{expanding_suffix}"),
                 F.percent_rank().over(part.orderBy(F.col(m).asc_nulls_last()))
                 .alias(f"{m}_{percentile_suffix}")]
    if win_col:
        cols.append(F.avg(F.when(F.col(win_col), 1.0).otherwise(0.0)).over(rolling)
                    .alias("win_rate_rolling"))
    cols.append(F.count(F.lit(1)).over(rolling).alias("matches_in_window"))
    return (df.select("*", *cols)
            .withColumn("rolling_window_matches", F.lit(window))
            .withColumn("is_full_window", F.col("matches_in_window") == F.lit(window)))
