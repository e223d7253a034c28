"""Typed staging: casts and renames of the raw tables (one function per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.functions.scalars import (
    epoch_ms_to_timestamp, patch_from_version, seconds_to_minutes, surrogate_key,
)


def _int(c: str):
    return F.col(c).cast("int")


def stage_matches(raw: DataFrame) -> DataFrame:
    return raw.select(
        "match_id", "data_version",
        F.col("platform_id").alias("platform"),
        _int("queue_id").alias("queue_id"),
        "game_mode", "game_type",
        _int("map_id").alias("map_id"),
        "game_version",
        patch_from_version("game_version").alias("patch"),
        epoch_ms_to_timestamp("game_creation").alias("game_creation_at"),
        epoch_ms_to_timestamp("game_start_timestamp").alias("game_start_at"),
        epoch_ms_to_timestamp("game_end_timestamp").alias("game_end_at"),
        _int("game_duration").alias("game_duration_seconds"),
        seconds_to_minutes("game_duration").alias("game_duration_minutes"),
        "_extracted_at",
    )


def stage_participants(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("match_id", "puuid").alias("participant_key"),
        "match_id", "puuid",
        _int("participant_id").alias("participant_id"),
        _int("team_id").alias("team_id"),
        "riot_id_game_name", "riot_id_tagline",
        _int("champion_id").alias("champion_id"),
        "champion_name",
        _int("champ_level").alias("champion_level"),
        "team_position", "individual_position", "lane", "role",
        _int("kills").alias("kills"),
        _int("deaths").alias("deaths"),
        _int("assists").alias("assists"),
        _int("total_damage_dealt_to_champions").alias("damage_to_champions"),
        _int("total_damage_taken").alias("damage_taken"),
        _int("damage_dealt_to_objectives").alias("damage_to_objectives"),
        _int("total_heal").alias("total_heal"),
        _int("gold_earned").alias("gold_earned"),
        _int("gold_spent").alias("gold_spent"),
        (_int("total_minions_killed") + _int("neutral_minions_killed")).alias("creep_score"),
        _int("total_minions_killed").alias("minions_killed"),
        _int("neutral_minions_killed").alias("neutral_minions_killed"),
        _int("vision_score").alias("vision_score"),
        _int("wards_placed").alias("wards_placed"),
        _int("wards_killed").alias("wards_killed"),
        _int("vision_wards_bought_in_game").alias("control_wards_bought"),
        _int("turret_takedowns").alias("turret_takedowns"),
        _int("dragon_kills").alias("dragon_kills"),
        _int("baron_kills").alias("baron_kills"),
        _int("time_played").alias("time_played_seconds"),
        F.col("win").cast("boolean").alias("is_win"),
        F.col("game_ended_in_early_surrender").cast("boolean").alias("ended_in_early_surrender"),
        F.col("game_ended_in_surrender").cast("boolean").alias("ended_in_surrender"),
        "_extracted_at",
    )


def stage_teams(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("match_id", "team_id").alias("team_key"),
        "match_id",
        _int("team_id").alias("team_id"),
        F.col("win").cast("boolean").alias("is_win"),
        _int("baron_kills").alias("baron_kills"),
        _int("dragon_kills").alias("dragon_kills"),
        _int("herald_kills").alias("herald_kills"),
        _int("tower_kills").alias("tower_kills"),
        _int("inhibitor_kills").alias("inhibitor_kills"),
        _int("champion_kills").alias("champion_kills"),
        F.col("first_blood").cast("boolean").alias("took_first_blood"),
        F.col("first_tower").cast("boolean").alias("took_first_tower"),
        "_extracted_at",
    )


def valid_ban(champion_id: str = "champion_id"):
    """A real ban: champion id present and positive (-1 marks a declined ban)."""
    return F.col(champion_id).isNotNull() & (F.col(champion_id).cast("int") > 0)


def stage_bans(raw: DataFrame) -> DataFrame:
    return raw.where(valid_ban()).select(
        "match_id",
        _int("team_id").alias("team_id"),
        _int("champion_id").alias("champion_id"),
        _int("pick_turn").alias("pick_turn"),
        "_extracted_at",
    )


def stage_summoners(raw: DataFrame) -> DataFrame:
    return raw.select(
        "puuid",
        F.col("game_name").alias("riot_id_game_name"),
        F.col("tag_line").alias("riot_id_tagline"),
        # Null-propagating concatenation: a missing part gives a null id.
        F.concat(F.col("game_name"), F.lit("#"), F.col("tag_line")).alias("riot_id"),
        "platform",
        _int("summoner_level").alias("summoner_level"),
        "profile_icon_id",
        epoch_ms_to_timestamp("revision_date").alias("profile_revised_at"),
        "_extracted_at",
    )


def stage_mastery(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("puuid", "champion_id").alias("mastery_key"),
        "puuid",
        _int("champion_id").alias("champion_id"),
        _int("champion_level").alias("mastery_level"),
        _int("champion_points").alias("mastery_points"),
        _int("tokens_earned").alias("tokens_earned"),
        epoch_ms_to_timestamp("last_play_time").alias("last_played_at"),
        "_extracted_at",
    )


def stage_champions(seed: DataFrame) -> DataFrame:
    """Seed -> staging / dimension: id as int, version column dropped."""
    return seed.select(
        _int("champion_id").alias("champion_id"),
        "champion_key", "champion_name", "champion_title",
        "primary_role", "secondary_role", "resource_type",
    )
