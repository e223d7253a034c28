"""Mart builders: sequence filter, trend marts, deltas, meta rollup, dimensions.

Each is a function of DataFrames; parameters come from ``TrendConfig``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.config import DEFAULT, TrendConfig
from trendspark.functions.scalars import queue_name, safe_divide, surrogate_key, win_label
from trendspark.operators.baseline import match_deltas
from trendspark.operators.joins import broadcast_if_small, parts_for, spread
from trendspark.operators.sequence import sequence
from trendspark.operators.trends import rolling_trends

def match_order():
    """Match order inside a player: start time, then match id (nulls last)."""
    return [F.col("game_start_at").asc_nulls_last(), F.col("match_id").asc_nulls_last()]


def eligible_matches(metrics: DataFrame, cfg: TrendConfig = DEFAULT) -> DataFrame:
    """Included queues, no probable remakes, no early surrenders.

    A null surrender flag fails ``not flag`` and drops the row, as in SQL.
    """
    return metrics.where(
        F.col("queue_id").isin(list(cfg.included_queues))
        & (F.col("game_duration_seconds") >= cfg.remake_seconds)
        & ~F.col("ended_in_early_surrender"))


def player_match_sequence(metrics: DataFrame, tracked: DataFrame,
                          cfg: TrendConfig = DEFAULT, stored: bool = False) -> DataFrame:
    """Tracked players' eligible matches numbered overall and per champion.

    ``stored``: the metrics are a stored table, which is read again rather than copied."""
    tracked_ids = broadcast_if_small(tracked.select("puuid").where(F.col("puuid").isNotNull()).distinct())
    kept = eligible_matches(metrics, cfg).join(tracked_ids, "puuid", "left_semi")
    return sequence(kept, ["puuid"], match_order(), group=["champion_id"], store_input=not stored,
                    parts=parts_for(metrics) if stored else 0)


_TREND_IDS = ["participant_key", "match_id", "puuid", "champion_id", "champion_name",
              "team_position", "queue_id", "patch", "game_start_at",
              "match_sequence_number"]
# what the filters of the sequence and the trend marts read of the metrics
SEQUENCE_COLUMNS = [*[c for c in _TREND_IDS if c != "match_sequence_number"], "is_win",
                    "game_duration_seconds", "ended_in_early_surrender", *DEFAULT.metrics]


def player_rolling_trends(seq: DataFrame, cfg: TrendConfig = DEFAULT, ranged: bool = False) -> DataFrame:
    """Rolling, career average and career percentile per player (all champions)."""
    cols = [*_TREND_IDS, "player_match_count", "is_win", *cfg.metrics]
    return rolling_trends(seq.select(*cols), ["puuid"], "match_sequence_number",
                          "player_match_count", cfg.metrics, window=cfg.rolling_window,
                          expanding_suffix="career_avg", percentile_suffix="career_percentile",
                          chunk_rows=cfg.chunk_rows, ranged=ranged)


def player_champion_trends(seq: DataFrame, cfg: TrendConfig = DEFAULT, ranged: bool = False) -> DataFrame:
    """Same windows partitioned by (player, champion), ordered by champion sequence."""
    cols = [*_TREND_IDS, "champion_match_sequence_number", "player_champion_match_count",
            "is_win", *cfg.metrics]
    return rolling_trends(seq.select(*cols), ["puuid", "champion_id"],
                          "champion_match_sequence_number", "player_champion_match_count",
                          cfg.metrics, window=cfg.rolling_window,
                          expanding_suffix="champion_avg", percentile_suffix="champion_percentile",
                          chunk_rows=cfg.chunk_rows, ranged=ranged)


def player_match_deltas(seq: DataFrame, cfg: TrendConfig = DEFAULT, ranged: bool = False) -> DataFrame:
    """One row per participant and metric against the player's own prior matches."""
    ids = [*_TREND_IDS, "is_win"]
    cols = [*ids, "player_match_count", *cfg.metrics]
    return match_deltas(seq.select(*cols), ["puuid"], "match_sequence_number",
                        "player_match_count", cfg.metrics, ids,
                        min_baseline=cfg.min_baseline, chunk_rows=cfg.chunk_rows, ranged=ranged)


def champion_appearances(participants: DataFrame, bans: DataFrame, matches: DataFrame) -> DataFrame:
    """Picks and bans as one event table (union first, then one join to matches)."""
    picks = participants.select("match_id", "champion_id", "team_id",
                                F.lit(True).alias("was_picked"), F.lit(False).alias("was_banned"),
                                F.col("is_win").cast("boolean").alias("is_win"))
    banned = bans.select("match_id", "champion_id", "team_id",
                         F.lit(False).alias("was_picked"), F.lit(True).alias("was_banned"),
                         F.lit(None).cast("boolean").alias("is_win"))
    events = picks.unionByName(banned)
    m = matches.select("match_id", "patch", "queue_id")
    return events.join(m, "match_id", "inner").select(
        "match_id", "patch", "queue_id", "champion_id", "team_id",
        "was_picked", "was_banned", "is_win")


def champion_meta(appearances: DataFrame, champions: DataFrame) -> DataFrame:
    """Pick / ban / presence / win rates per (patch, queue, champion).

    Distinct matches are counted in two levels, so the counts need no expand per flag: one
    grouping sets aggregate gives a row per (patch, queue, champion, match) and one per
    (patch, queue, match), combined in the tasks before the shuffle, so a hot champion or
    match collapses; the second level counts both. The appearances are read once and
    nothing is stored; a patch's number of matches reaches its champions by a window over
    the few rows of the second level.
    """
    keys = ["patch", "queue_id"]
    c = {n: F.col(n) for n in (*keys, "champion_id", "match_id")}
    per_match = appearances.groupingSets([list(c.values()), [c[k] for k in (*keys, "match_id")]], *c.values()).agg(
        F.grouping_id().alias("_match_only"),
        F.max(F.col("was_picked").cast("int")).alias("_p"), F.max(F.col("was_banned").cast("int")).alias("_b"),
        F.count_if(F.col("was_picked") & F.col("is_win")).alias("_w"),
        F.count_if(F.col("was_picked") & ~F.col("is_win")).alias("_l"))
    counted = per_match.groupBy(*keys, "champion_id", "_match_only").agg(
        F.count("*").alias("_n"), F.sum("_p").cast("long").alias("matches_picked"), F.sum("_b").cast("long").alias("matches_banned"),
        F.sum("_w").cast("long").alias("wins"), F.sum("_l").cast("long").alias("losses"))
    matches = F.max(F.when(F.col("_match_only") > 0, F.col("_n"))).over(Window.partitionBy(*keys))
    flagged = counted.withColumn("matches_on_patch", matches).where(
        (F.col("_match_only") == 0) & F.col("patch").isNotNull() & F.col("queue_id").isNotNull())
    dim = broadcast_if_small(champions.select("champion_id", "champion_name", "primary_role"))
    joined = flagged.join(dim, "champion_id", "left")
    total = F.nullif(F.col("matches_on_patch"), F.lit(0))
    return joined.select(
        surrogate_key("patch", "queue_id", "champion_id").alias("champion_meta_key"),
        "patch", "queue_id", queue_name("queue_id").alias("queue_name"),
        "champion_id", "champion_name", "primary_role",
        "matches_on_patch", "matches_picked", "matches_banned", "wins", "losses",
        safe_divide("matches_picked", total).alias("pick_rate"),
        safe_divide("matches_banned", total).alias("ban_rate"),
        safe_divide(F.col("matches_picked") + F.col("matches_banned"), total).alias("presence_rate"),
        safe_divide("wins", F.nullif(F.col("wins") + F.col("losses"), F.lit(0))).alias("win_rate"),
    )


def dim_matches(matches: DataFrame, teams: DataFrame, cfg: TrendConfig = DEFAULT) -> DataFrame:
    parts = parts_for(matches, teams)
    winners = spread(teams.select("match_id", "team_id", "is_win"), parts, "match_id").groupBy("match_id").agg(
        F.max(F.when(F.col("is_win"), F.col("team_id"))).alias("winning_team_id"))
    return spread(matches, parts, "match_id").join(winners, "match_id", "left").select(
        "match_id", "platform", "queue_id", queue_name("queue_id").alias("queue_name"),
        "game_mode", "game_type", "map_id", "game_version", "patch",
        "game_creation_at", "game_start_at", "game_end_at",
        F.col("game_start_at").cast("date").alias("game_date"),
        "game_duration_seconds", "game_duration_minutes",
        (F.col("game_duration_seconds") < cfg.remake_seconds).alias("is_probable_remake"),
        "winning_team_id", "_extracted_at")


def dim_players(summoners: DataFrame, mastery: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row per tracked player; activity counts every extracted match (no filter)."""
    m = mastery.groupBy("puuid").agg(
        F.count(F.lit(1)).alias("champions_with_mastery"),
        F.sum("mastery_points").cast("long").alias("total_mastery_points"),
        F.max("last_played_at").alias("last_mastery_play_at"))
    a = metrics.groupBy("puuid").agg(
        F.count(F.lit(1)).alias("matches_extracted"),
        F.min("game_start_at").alias("first_match_at"),
        F.max("game_start_at").alias("last_match_at"))
    return (summoners.join(m, "puuid", "left").join(a, "puuid", "left").select(
        "puuid", "riot_id", "riot_id_game_name", "riot_id_tagline", "platform",
        "summoner_level", "profile_icon_id",
        F.coalesce("matches_extracted", F.lit(0)).alias("matches_extracted"),
        "first_match_at", "last_match_at",
        F.coalesce("champions_with_mastery", F.lit(0)).alias("champions_with_mastery"),
        F.coalesce("total_mastery_points", F.lit(0)).alias("total_mastery_points"),
        "_extracted_at"))


def participant_performance(metrics: DataFrame, players: DataFrame,
                            cfg: TrendConfig = DEFAULT) -> DataFrame:
    """The player x match fact for included queues, with the player's display id."""
    names = broadcast_if_small(players.select("puuid", "riot_id"))
    kept = metrics.where(F.col("queue_id").isin(list(cfg.included_queues)))
    return kept.join(names, "puuid", "left").select(
        "participant_key", "match_id", "puuid", "riot_id", "team_id", "team_position",
        "champion_id", "champion_name", "champion_level", "queue_id", "patch",
        "game_start_at", F.col("game_start_at").cast("date").alias("game_date"),
        "game_duration_seconds", "game_duration_minutes",
        "kills", "deaths", "assists", "creep_score", "gold_earned", "gold_spent",
        "damage_to_champions", "damage_taken", "damage_to_objectives", "vision_score",
        "wards_placed", "wards_killed", "control_wards_bought",
        "kda_ratio", "kda_ratio_perfect_adjusted", "cs_per_minute", "gold_per_minute",
        "damage_per_minute", "vision_score_per_minute",
        "damage_share", "gold_share", "vision_share", "kill_participation",
        "damage_per_gold", "gold_spent_share",
        "is_win", win_label("is_win").alias("match_result"), "ended_in_early_surrender",
        "_extracted_at")
