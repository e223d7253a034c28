"""Trend-view datasets: the data behind the per-player trend page, for every player.

The page itself (HTML / SVG) is not built; these are the tables it would draw:
series per metric, the champion groups worth a view, range options, last-N slices
taken *after* the rolling calculation, axis bounds and latest values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.config import AXIS_PAD_FRACTION, MIN_GROUP_GAMES, RANGE_OPTIONS, VIEW_METRICS

PLACEHOLDER = "—"   # shown for a missing champion name


def select_metrics(requested: Sequence[str] | None = None) -> list[str]:
    """Known metrics in catalogue order; unknown names ignored; error when none is left.

    Default: the first six catalogue metrics.
    """
    catalogue = list(VIEW_METRICS)
    if requested is None:
        return catalogue[:6]
    wanted = set(requested)
    chosen = [m for m in catalogue if m in wanted]
    if not chosen:
        raise ValueError(f"none of the requested metrics is known: {list(requested)}")
    return chosen


def champion_label(name_col: str = "champion_name"):
    return F.coalesce(F.nullif(F.col(name_col), F.lit("")), F.lit(PLACEHOLDER))


def trend_rows(overall: DataFrame, per_champion: DataFrame, metrics: Sequence[str],
               entity: str = "puuid") -> DataFrame:
    """Both views as one table: view 'all' from the overall mart and one view per
    champion name from the per-champion mart (never a filter of the overall one)."""
    def project(df: DataFrame, view, seq: str) -> DataFrame:
        cols = [F.col(entity), view.alias("view"), F.col(seq).alias("seq"),
                "match_sequence_number", "champion_name",
                F.col("game_start_at").cast("date").alias("game_date"), "is_win",
                "rolling_window_matches"]
        for m in metrics:
            cols += [F.col(m).cast("double").alias(m),
                     F.col(f"{m}_rolling_avg").cast("double").alias(f"{m}_rolling_avg")]
        return df.select(*cols)
    return (project(overall, F.lit("all"), "match_sequence_number")
            .unionByName(project(per_champion, champion_label(), "champion_match_sequence_number")))


def series_points(rows: DataFrame, metrics: Sequence[str], entity: str = "puuid") -> DataFrame:
    """Long points (entity, view, metric, x, raw, roll): null raw dropped, null roll
    kept; a series is kept only with at least two points.

    Points are counted on the wide rows, one count per metric, so the rows meet their
    counts once and become long after that. A null entity has no series."""
    counts = rows.groupBy(entity, "view").agg(*[F.count(F.col(m)).alias(f"_n_{m}") for m in metrics])
    held = [F.when(F.col(f"_n_{m}") >= 2, F.col(m)) for m in metrics]
    packed = F.array(*[F.struct(F.lit(m).alias("metric"), raw.alias("raw"),
                                F.col(f"{m}_rolling_avg").alias("roll")) for m, raw in zip(metrics, held)])
    wide = rows.select(entity, "view", "seq", *metrics, *[f"{m}_rolling_avg" for m in metrics])
    return (wide.join(counts, [entity, "view"]).select(entity, "view", F.col("seq").alias("x"), F.inline(packed))
            .where(F.col("raw").isNotNull()).select(entity, "view", "metric", "x", "raw", "roll"))


def point_metadata(rows: DataFrame, entity: str = "puuid") -> DataFrame:
    """Per point: x, overall sequence, date, champion label and result label."""
    return rows.select(entity, "view", F.col("seq").alias("x"),
                       F.col("match_sequence_number").alias("seq"),
                       F.col("game_date").cast("string").alias("date"),
                       champion_label().alias("champion"),
                       F.when(F.col("is_win"), F.lit("Win")).otherwise(F.lit("Loss")).alias("result"))


def champion_groups(per_champion: DataFrame, entity: str = "puuid",
                    min_games: int = MIN_GROUP_GAMES) -> DataFrame:
    """Champion views worth offering: grouped by *name* (null -> placeholder), at least
    ``min_games`` rows, with an order (games desc, label asc) per entity."""
    groups = (per_champion.groupBy(entity, champion_label().alias("label"))
              .agg(F.count(F.lit(1)).alias("games"))
              .where(F.col("games") >= min_games))
    order = Window.partitionBy(entity).orderBy(F.desc("games"), F.asc("label"))
    return groups.withColumn("option_order", F.row_number().over(order).cast("long"))


def range_options(totals: DataFrame, total_col: str = "total") -> DataFrame:
    """Range choices N with N < total for each row of ``totals`` (no join: an explode
    of the fixed option list)."""
    opts = F.array(*[F.lit(n) for n in RANGE_OPTIONS])
    return (totals.select("*", F.explode(opts).alias("range_n"))
            .where(F.col("range_n") < F.col(total_col)))


def last_n(rows: DataFrame, n: int, keys: Sequence[str] = ("puuid", "view"),
           order: Sequence[str] = ("seq", "match_sequence_number")) -> DataFrame:
    """The last ``n`` rows of each view, taken after the rolling calculation.

    A view groups by label while sequences count per id, so rows are ranked within the
    view (newest first) rather than compared with a count; the rank limit is applied in
    each task before the shuffle.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= n).drop("_rank")


def range_points(points: DataFrame, ranges: Sequence[int] = RANGE_OPTIONS,
                 keys: Sequence[str] = ("puuid", "view", "metric")) -> DataFrame:
    """Points of each chosen range: the last N points of every series (``range_n`` = N),
    and all of them (``range_n`` = 0). Nulls are out already, so N counts drawn points."""
    newest = Window.partitionBy(*keys).orderBy(F.desc("x"), F.desc_nulls_last("raw"), F.desc_nulls_last("roll"))
    options = F.array(F.lit(0), *[F.lit(n) for n in ranges])
    return (points.withColumn("_rank", F.row_number().over(newest))
            .withColumn("range_n", F.explode(F.filter(options, lambda n: (n == 0) | (F.col("_rank") <= n))))
            .drop("_rank"))


def with_totals(rows: DataFrame, keys: Sequence[str] = ("puuid", "view")) -> DataFrame:
    """Rows plus the row count of their view (aggregate joined back on the keys)."""
    totals = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"))
    return rows.join(totals, list(keys), "inner")


def range_summary(sliced: DataFrame, keys: Sequence[str] = ("puuid", "view")) -> DataFrame:
    """Shown count, total, first and last date of a slice."""
    return sliced.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("shown"), F.max("total").alias("total"),
        F.min_by("game_date", "seq").cast("string").alias("first_date"),
        F.max_by("game_date", "seq").cast("string").alias("last_date"))


def axis_bounds(points: DataFrame, keys: Sequence[str] = ("puuid", "view", "metric"),
                pad: float = AXIS_PAD_FRACTION) -> DataFrame:
    """Per series: [lo, hi] over raw and non-null rolling values; equal ends widen
    to lo + 1; padded by ``pad`` of the span and floored at 0."""
    b = points.groupBy(*keys).agg(
        F.least(F.min("raw"), F.min("roll")).alias("_lo"),
        F.greatest(F.max("raw"), F.max("roll")).alias("_hi"))
    hi = F.when(F.col("_hi") == F.col("_lo"), F.col("_lo") + 1.0).otherwise(F.col("_hi"))
    b = b.select(*keys, F.col("_lo").alias("lo"), hi.alias("hi"))
    span = (F.col("hi") - F.col("lo")) * F.lit(pad)
    return b.select(*keys, F.greatest(F.lit(0.0), F.col("lo") - span).alias("axis_lo"),
                    (F.col("hi") + span).alias("axis_hi"))


def latest_rolling(points: DataFrame, keys: Sequence[str] = ("puuid", "view", "metric")) -> DataFrame:
    """Latest non-null rolling value per series (max_by over x, an aggregate)."""
    return (points.where(F.col("roll").isNotNull()).groupBy(*keys)
            .agg(F.max_by("roll", "x").alias("latest_roll"), F.max("x").alias("latest_x")))


def top_entity(players: DataFrame, count_col: str = "matches_extracted",
               entity: str = "puuid") -> DataFrame:
    """The entity with most rows (ties: smallest id). A top-1 report: the limit is the feature."""
    return players.orderBy(F.desc(count_col), F.asc(entity)).limit(1)


def display_label(df: DataFrame, players: DataFrame, entity: str = "puuid",
                  label_col: str = "riot_id", width: int = 12) -> DataFrame:
    """Label per entity: its display id, else the first ``width`` characters of the key."""
    names = players.select(entity, label_col)
    return df.join(names, entity, "left").withColumn(
        "label", F.coalesce(F.col(label_col), F.substring(F.col(entity).cast("string"), 1, width)))


def entity_slice(overall: DataFrame, per_champion: DataFrame, entity_value, n: int | None = None,
                 metrics: Sequence[str] | None = None, entity: str = "puuid") -> DataFrame:
    """One entity's rows of all its views with their totals: the last ``n`` of each (all by default).

    The entity is chosen before anything else, so stored marts are read for it alone; the
    windows were computed over its whole history, so the slice does not change them.
    """
    def mine(mart: DataFrame) -> DataFrame:
        return mart.where(F.col(entity) == F.lit(entity_value))
    rows = with_totals(trend_rows(mine(overall), mine(per_champion), select_metrics(metrics), entity), (entity, "view"))
    return rows if n is None else last_n(rows, n, (entity, "view"))


def entity_rows(mart: DataFrame, entity_value, columns: Sequence[str], entity: str = "puuid",
                order: Sequence[str] = ("champion_name", "match_sequence_number")) -> DataFrame:
    """One entity's rows of a mart, ordered for display (the equality predicate is
    pushed into the parquet scan when the mart is read from files)."""
    cols = list(dict.fromkeys([entity, *columns, *order]))
    return (mart.where(F.col(entity) == F.lit(entity_value)).select(*cols)
            .orderBy(*[F.col(c).asc_nulls_last() for c in order]))
