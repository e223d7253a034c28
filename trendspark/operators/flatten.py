"""Nested match / profile documents -> the six flat raw tables.

``flatten_documents`` parses each landed document once, stores the parse, and makes
every raw table a projection of it: explode participants, explode teams,
explode teams then bans. Missing keys become null; the count columns listed in
``PARTICIPANT_COUNT_DEFAULTS`` become 0, like the extraction defaults.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.config import PARTICIPANT_COUNT_DEFAULTS
from trendspark.session import materialize
from trendspark.sources.io import REJECT_SCHEMA, empty_frame, parse_tagged, rejected_lines, rows_that_fit
from trendspark.sources.schemas import (
    ACCOUNT_DOCUMENT, MASTERY_DOCUMENT, MATCH_DOCUMENT, PARTICIPANT_FIELDS, SUMMONER_DOCUMENT)


def _stamp(extracted_at: str | Column | None) -> Column:
    if extracted_at is None:
        extracted_at = datetime.now(timezone.utc).isoformat(timespec="microseconds")
    return F.lit(extracted_at) if isinstance(extracted_at, str) else extracted_at


def match_rows(docs: DataFrame, extracted_at: str | Column | None = None) -> DataFrame:
    """One row per document for raw_matches (header fields, snake_case)."""
    return docs.select(
        F.col("metadata.matchId").alias("match_id"),
        F.col("metadata.dataVersion").alias("data_version"),
        F.col("info.platformId").alias("platform_id"),
        F.col("info.queueId").alias("queue_id"),
        F.col("info.gameMode").alias("game_mode"),
        F.col("info.gameType").alias("game_type"),
        F.col("info.mapId").alias("map_id"),
        F.col("info.gameVersion").alias("game_version"),
        F.col("info.gameCreation").alias("game_creation"),
        F.col("info.gameStartTimestamp").alias("game_start_timestamp"),
        F.col("info.gameEndTimestamp").alias("game_end_timestamp"),
        F.col("info.gameDuration").alias("game_duration"),
        _stamp(extracted_at).alias("_extracted_at"),
    )


def participant_rows(docs: DataFrame, extracted_at: str | Column | None = None) -> DataFrame:
    """One row per participant; a missing or empty participant array gives no rows."""
    exploded = docs.select(F.col("metadata.matchId").alias("match_id"),
                           F.explode("info.participants").alias("p"))
    cols = [F.col("match_id")]
    for key, column in PARTICIPANT_FIELDS:
        value = F.col(f"p.{key}")
        if column in PARTICIPANT_COUNT_DEFAULTS:
            value = F.coalesce(value, F.lit(0))
        cols.append(value.alias(column))
    cols.append(_stamp(extracted_at).alias("_extracted_at"))
    return exploded.select(*cols)


def _objective(name: str, field: str, default) -> Column:
    found = F.try_element_at(F.col("t.objectives"), F.lit(name))
    return F.coalesce(found[field], F.lit(default))


def team_rows(docs: DataFrame, extracted_at: str | Column | None = None) -> DataFrame:
    """One row per team with objectives looked up by name (kills default 0, first false)."""
    exploded = docs.select(F.col("metadata.matchId").alias("match_id"),
                           F.explode("info.teams").alias("t"))
    return exploded.select(
        "match_id",
        F.col("t.teamId").alias("team_id"),
        F.col("t.win").alias("win"),
        _objective("baron", "kills", 0).alias("baron_kills"),
        _objective("dragon", "kills", 0).alias("dragon_kills"),
        _objective("riftHerald", "kills", 0).alias("herald_kills"),
        _objective("tower", "kills", 0).alias("tower_kills"),
        _objective("inhibitor", "kills", 0).alias("inhibitor_kills"),
        _objective("champion", "kills", 0).alias("champion_kills"),
        _objective("champion", "first", False).alias("first_blood"),
        _objective("tower", "first", False).alias("first_tower"),
        _stamp(extracted_at).alias("_extracted_at"),
    )


def ban_rows(docs: DataFrame, extracted_at: str | Column | None = None) -> DataFrame:
    """One row per ban (teams then bans); declined bans (-1) are kept here."""
    teams = docs.select(F.col("metadata.matchId").alias("match_id"),
                        F.explode("info.teams").alias("t"))
    bans = teams.select("match_id", F.col("t.teamId").alias("team_id"),
                        F.explode("t.bans").alias("b"))
    return bans.select(
        "match_id", "team_id",
        F.col("b.championId").alias("champion_id"),
        F.col("b.pickTurn").alias("pick_turn"),
        _stamp(extracted_at).alias("_extracted_at"),
    )


def summoner_rows(accounts: DataFrame, summoners: DataFrame, platform: str | Column,
                  extracted_at: str | Column | None = None,
                  account_key: str = "puuid", summoner_key: str = "puuid") -> DataFrame:
    """Account and profile documents combined; puuid = first non-empty of the two."""
    a = accounts.select(F.col(account_key).alias("_ak"), "gameName", "tagLine",
                        F.col("puuid").alias("_a_puuid"))
    s = summoners.select(F.col(summoner_key).alias("_sk"), F.col("puuid").alias("_s_puuid"),
                         "summonerLevel", "profileIconId", "revisionDate")
    joined = a.join(s, a["_ak"] == s["_sk"], "full_outer")
    plat = F.lit(platform) if isinstance(platform, str) else platform
    return joined.select(
        F.coalesce(F.nullif(F.col("_a_puuid"), F.lit("")), F.col("_s_puuid")).alias("puuid"),
        F.col("gameName").alias("game_name"),
        F.col("tagLine").alias("tag_line"),
        plat.alias("platform"),
        F.col("summonerLevel").alias("summoner_level"),
        F.col("profileIconId").alias("profile_icon_id"),
        F.col("revisionDate").alias("revision_date"),
        _stamp(extracted_at).alias("_extracted_at"),
    )


def mastery_rows(entries: DataFrame, extracted_at: str | Column | None = None) -> DataFrame:
    """One row per (player, champion) mastery entry; tokens default to 0."""
    return entries.select(
        "puuid",
        F.col("championId").alias("champion_id"),
        F.col("championLevel").alias("champion_level"),
        F.col("championPoints").alias("champion_points"),
        F.coalesce(F.col("tokensEarned"), F.lit(0)).alias("tokens_earned"),
        F.col("lastPlayTime").alias("last_play_time"),
        _stamp(extracted_at).alias("_extracted_at"),
    )


def static_champion_rows(doc: DataFrame, version: str | Column | None = None) -> DataFrame:
    """Map-of-struct static document -> seed rows: id as int, first two tags as roles."""
    ver = F.col("version") if version is None else (
        F.lit(version) if isinstance(version, str) else version)
    entries = doc.select(ver.alias("_ver"), F.explode("data").alias("_name", "c"))
    return entries.select(
        F.col("c.key").cast("int").alias("champion_id"),
        F.col("c.id").alias("champion_key"),
        F.col("c.name").alias("champion_name"),
        F.coalesce(F.col("c.title"), F.lit("")).alias("champion_title"),
        F.coalesce(F.get(F.col("c.tags"), 0), F.lit("")).alias("primary_role"),
        F.coalesce(F.get(F.col("c.tags"), 1), F.lit("")).alias("secondary_role"),
        F.coalesce(F.col("c.partype"), F.lit("")).alias("resource_type"),
        F.col("_ver").alias("data_dragon_version"),
    )


def flatten_matches(docs: DataFrame, extracted_at: str | Column | None = None) -> dict[str, DataFrame]:
    """Fan one parsed document set out to the four match raw tables, with one stamp."""
    extracted_at = extracted_at or datetime.now(timezone.utc).isoformat(timespec="microseconds")
    return {
        "raw_matches": match_rows(docs, extracted_at),
        "raw_match_participants": participant_rows(docs, extracted_at),
        "raw_match_teams": team_rows(docs, extracted_at),
        "raw_match_bans": ban_rows(docs, extracted_at),
    }


DOCUMENTS = {"match": MATCH_DOCUMENT, "account": ACCOUNT_DOCUMENT,
             "summoner": SUMMONER_DOCUMENT, "mastery": MASTERY_DOCUMENT}


def parse_documents(lines: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Landed documents of one kind -> their stored parse and their rejects (line, reason,
    file, kind), both out of one parse of the lines."""
    schema = DOCUMENTS[kind]
    tagged = parse_tagged(lines, schema)
    file = ["_file"] if "_file" in tagged.columns else []
    stored = materialize(tagged.select(*schema.fieldNames(), *file, "_reject"), f"documents-{kind}")
    return (rows_that_fit(stored).select(*schema.fieldNames()),
            rejected_lines(stored).withColumn("kind", F.lit(kind)))


def flatten_documents(spark: SparkSession, lines: dict[str, DataFrame], platform: str,
                      extracted_at: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Landed documents (a ``value`` column of JSON per kind) -> the six raw tables and the rejects.

    Kinds are ``match``, ``account``, ``summoner`` and ``mastery`` (one entry per line);
    missing kinds give empty tables. Each kind is parsed once into a stored table; the
    whole load carries one UTC stamp. Rejects have line, reason, file and kind.
    """
    stamp = extracted_at or datetime.now(timezone.utc).isoformat(timespec="microseconds")
    parsed, rejects = {}, empty_frame(spark, REJECT_SCHEMA).withColumn("kind", F.lit("").cast("string"))
    for kind, schema in DOCUMENTS.items():
        if kind not in lines:
            parsed[kind] = empty_frame(spark, schema)
            continue
        parsed[kind], bad = parse_documents(lines[kind], kind)
        rejects = rejects.unionByName(bad)
    tables = flatten_matches(parsed["match"], stamp)
    tables["raw_summoners"] = summoner_rows(parsed["account"], parsed["summoner"], platform, stamp)
    tables["raw_champion_mastery"] = mastery_rows(parsed["mastery"], stamp)
    return tables, rejects
