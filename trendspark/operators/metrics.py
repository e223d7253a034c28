"""Team totals and per-participant rates and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.functions.scalars import kda_adjusted, kda_strict, per_minute, safe_divide
from trendspark.operators.joins import parts_for, spread

TEAM_SUMS = {
    "team_kills": "kills",
    "team_deaths": "deaths",
    "team_assists": "assists",
    "team_damage_to_champions": "damage_to_champions",
    "team_damage_taken": "damage_taken",
    "team_gold_earned": "gold_earned",
    "team_creep_score": "creep_score",
    "team_vision_score": "vision_score",
}


def team_totals(participants: DataFrame, match_col: str = "match_id",
                team_col: str = "team_id") -> DataFrame:
    """Sums of the participant counts and the participant count per (match, team).

    A grouped aggregate: partial sums are combined map-side before the shuffle,
    so a match with very many participants never reaches one task whole.
    """
    aggs = [F.sum(src).cast("long").alias(name) for name, src in TEAM_SUMS.items()]
    aggs.append(F.count(F.lit(1)).alias("team_participant_count"))
    return participants.groupBy(match_col, team_col).agg(*aggs)


def participant_metrics(participants: DataFrame, matches: DataFrame,
                        totals: DataFrame | None = None) -> DataFrame:
    """Participants joined to match and team context, with derived rates.

    Inner joins: a participant without its match or team total drops out. They run in as
    many partitions as the stored participants and matches need. A team's totals meet its
    match first, by the match that their narrow rows are dealt by, so the wide rows of the
    participants are exchanged once, by match and team.
    """
    parts = parts_for(participants, matches)
    if totals is None:
        by_match = spread(participants, parts, "match_id")
        totals = team_totals(by_match if by_match is not participants else participants.repartition("match_id"))
    m = matches.select("match_id", "queue_id", "patch", "platform", "game_start_at",
                       "game_duration_seconds", "game_duration_minutes")
    t = totals.select("match_id", "team_id", "team_kills", "team_damage_to_champions",
                      "team_gold_earned", "team_vision_score")
    p = participants.select(
        "participant_key", "match_id", "puuid", "participant_id", "team_id",
        "champion_id", "champion_name", "champion_level",
        F.coalesce(F.nullif(F.col("team_position"), F.lit("")),
                   F.col("individual_position")).alias("team_position"),
        "kills", "deaths", "assists", "damage_to_champions", "damage_taken",
        "damage_to_objectives", "gold_earned", "gold_spent", "creep_score", "vision_score",
        "wards_placed", "wards_killed", "control_wards_bought", "is_win",
        "ended_in_early_surrender", "_extracted_at")
    teams = t.join(spread(m, parts, "match_id"), "match_id", "inner")
    joined = spread(p, parts, "match_id", "team_id").join(
        spread(teams, parts, "match_id", "team_id"), ["match_id", "team_id"], "inner")
    minutes = F.col("game_duration_minutes")
    ka = F.col("kills") + F.col("assists")
    return joined.select(
        "participant_key", "match_id", "puuid", "participant_id", "team_id",
        "champion_id", "champion_name", "champion_level", "team_position",
        "queue_id", "patch", "platform", "game_start_at", "game_duration_seconds",
        "game_duration_minutes",
        "kills", "deaths", "assists", "damage_to_champions", "damage_taken",
        "damage_to_objectives", "gold_earned", "gold_spent", "creep_score", "vision_score",
        "wards_placed", "wards_killed", "control_wards_bought", "is_win",
        "ended_in_early_surrender",
        "team_kills", "team_damage_to_champions", "team_gold_earned", "team_vision_score",
        "_extracted_at",
        kda_strict("kills", "deaths", "assists").alias("kda_ratio"),
        kda_adjusted("kills", "deaths", "assists").alias("kda_ratio_perfect_adjusted"),
        per_minute("creep_score", minutes).alias("cs_per_minute"),
        per_minute("gold_earned", minutes).alias("gold_per_minute"),
        per_minute("damage_to_champions", minutes).alias("damage_per_minute"),
        per_minute("vision_score", minutes).alias("vision_score_per_minute"),
        safe_divide("damage_to_champions", "team_damage_to_champions").alias("damage_share"),
        safe_divide("gold_earned", "team_gold_earned").alias("gold_share"),
        safe_divide("vision_score", "team_vision_score").alias("vision_share"),
        safe_divide(ka, "team_kills").alias("kill_participation"),
        safe_divide("damage_to_champions", "gold_earned").alias("damage_per_gold"),
        safe_divide("gold_spent", "gold_earned").alias("gold_spent_share"),
    )
