"""Raw match tables derived from the driver's TPC-H-like tables.

The mapping (so the match models run unchanged on the driver data):

* match          = order (``o_orderkey``); start = order date; duration (s) =
  round(o_totalprice / 100); queue id = 380 + 20 * priority digit; version =
  'year.month.day.custkey' (so the patch is 'year.month'); status 'P' etc. as text.
* participant    = the non-returned ('R') lines of one (order, supplier); counts are
  sums / conditional counts of integer-valued line expressions.
* team           = the supplier's region (nation -> region).
* ban            = a returned line; champion -1 (declined) when its discount is 0.
* champion       = part brand number (``Brand#N`` -> N).
* player         = supplier; summoner row per supplier; mastery per (supplier, brand).
* seed champions = one row per brand from ``part``.

Small dimensions (nation) are broadcast behind a size check; supplier and part are
joined with the planner's choice (broadcast only under the session threshold).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.operators.joins import broadcast_if_small, estimated_bytes, parts_for, session_limit, spread


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ms(c) -> F.Column:
    return F.unix_millis(F.col(c).cast("timestamp")) if isinstance(c, str) else F.unix_millis(c.cast("timestamp"))


def _iround(c) -> F.Column:
    """Nearest integer, halves up: floor(x + 0.5) (plain arithmetic, no decimal round)."""
    return F.floor(c + F.lit(0.5)).cast("int")


def brand_number(col: str = "p_brand") -> F.Column:
    return F.split_part(F.col(col), F.lit("#"), F.lit(2)).cast("int")


def raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    start = _ms("o_orderdate")
    duration = _iround(F.col("o_totalprice") / 100.0)
    version = F.concat_ws(".", F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string"),
                          F.dayofmonth("o_orderdate").cast("string"), F.col("o_custkey").cast("string"))
    return o.select(
        F.col("o_orderkey").alias("match_id"),
        F.col("o_orderstatus").alias("data_version"),
        F.col("o_orderstatus").alias("platform_id"),
        (F.lit(380) + F.lit(20) * F.substring("o_orderpriority", 1, 1).cast("int")).alias("queue_id"),
        F.col("o_orderpriority").alias("game_mode"),
        F.lit("MATCHED_GAME").alias("game_type"),
        F.lit(11).alias("map_id"),
        version.alias("game_version"),
        (start - F.lit(60000)).alias("game_creation"),
        start.alias("game_start_timestamp"),
        (start + duration.cast("long") * F.lit(1000)).alias("game_end_timestamp"),
        duration.alias("game_duration"),
        F.lit("2024-01-01T00:00:00+00:00").alias("_extracted_at"),
    )


def lines_with_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the supplier's region (team) and the part's brand number; the joins
    run in as many partitions as the lines need."""
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    sup = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = broadcast_if_small(_t(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    teams = sup.join(nat, sup["s_nationkey"] == nat["n_nationkey"]).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_regionkey").alias("team_id"))
    part = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"),
                                            brand_number().alias("brand_no"))
    parts = parts_for(li)
    by_part = spread(li, parts, "l_partkey").join(spread(part, parts, "l_partkey"), "l_partkey")
    if estimated_bytes(sup) <= session_limit(sup):
        return by_part.join(F.broadcast(teams), "l_suppkey")
    return spread(by_part, parts, "l_suppkey").join(spread(teams, parts, "l_suppkey"), "l_suppkey")


def _lines_by(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """The lines dealt by a key, whose groups then need no second shuffle."""
    return spread(lines_with_team(spark, sf_dir), parts_for(_t(spark, sf_dir, "lineitem")), key)


def raw_participants(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lines = (lines if lines is not None else _lines_by(spark, sf_dir, "l_orderkey")).where(F.col("l_returnflag") != "R")
    n = F.count(F.lit(1))
    cnt = lambda cond: F.count_if(cond).cast("int")
    isum = lambda e: F.sum(e).cast("int")
    agg = lines.groupBy("l_orderkey", "l_suppkey", "team_id").agg(
        F.min("l_linenumber").alias("participant_id"),
        F.min("brand_no").alias("champion_id"),
        n.cast("int").alias("champ_level"),
        F.when(n > 1, F.lit("MULTI")).otherwise(F.lit("")).alias("team_position"),
        cnt(F.col("l_linestatus") == "F").alias("kills"),
        cnt(F.col("l_returnflag") == "A").alias("deaths"),
        cnt(F.col("l_linestatus") == "O").alias("assists"),
        isum(_iround(F.col("l_extendedprice"))).alias("total_damage_dealt_to_champions"),
        isum(F.col("l_quantity").cast("int")).alias("total_damage_taken"),
        isum(_iround(F.col("l_tax") * 100.0)).alias("damage_dealt_to_objectives"),
        n.cast("int").alias("total_heal"),
        isum(_iround(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("gold_earned"),
        isum(_iround(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 - F.col("l_tax")))).alias("gold_spent"),
        isum(F.col("l_quantity").cast("int")).alias("total_minions_killed"),
        n.cast("int").alias("neutral_minions_killed"),
        isum(_iround(F.col("l_discount") * 100.0)).alias("vision_score"),
        cnt(F.col("l_discount") > 0.05).alias("wards_placed"),
        cnt(F.col("l_tax") > 0.05).alias("wards_killed"),
        cnt(F.col("l_quantity") > 25).alias("vision_wards_bought_in_game"),
        cnt(F.col("l_quantity") >= 40).alias("turret_takedowns"),
        cnt(F.col("l_discount") == 0).alias("dragon_kills"),
        cnt(F.col("l_tax") == 0).alias("baron_kills"),
        (isum(F.col("l_quantity").cast("int")) * 10).alias("time_played"),
        F.bool_or(F.col("l_linestatus") == "F").alias("win"),
        F.bool_and(F.col("l_discount") >= 0.09).alias("game_ended_in_early_surrender"),
        F.bool_or(F.col("l_discount") >= 0.09).alias("game_ended_in_surrender"),
    )
    return agg.select(
        F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("puuid"),
        "participant_id", F.col("team_id").cast("int").alias("team_id"),
        F.lit(None).cast("string").alias("riot_id_game_name"),
        F.lit(None).cast("string").alias("riot_id_tagline"),
        "champion_id", F.concat(F.lit("Brand#"), F.col("champion_id").cast("string")).alias("champion_name"),
        "champ_level", "team_position", F.lit("SINGLE").alias("individual_position"),
        F.lit(None).cast("string").alias("lane"), F.lit(None).cast("string").alias("role"),
        "kills", "deaths", "assists", "total_damage_dealt_to_champions", "total_damage_taken",
        "damage_dealt_to_objectives", "total_heal", "gold_earned", "gold_spent",
        "total_minions_killed", "neutral_minions_killed", "vision_score", "wards_placed",
        "wards_killed", "vision_wards_bought_in_game", "turret_takedowns", "dragon_kills",
        "baron_kills", "time_played", "win", "game_ended_in_early_surrender",
        "game_ended_in_surrender",
        F.lit("2024-01-01T00:00:00+00:00").alias("_extracted_at"),
    )


def raw_teams(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lines = lines if lines is not None else _lines_by(spark, sf_dir, "l_orderkey")
    cnt = lambda cond: F.count_if(cond).cast("int")
    return lines.groupBy("l_orderkey", "team_id").agg(
        F.bool_or(F.col("l_linestatus") == "F").alias("win"),
        cnt(F.col("l_returnflag") == "R").alias("baron_kills"),
        cnt(F.col("l_tax") == 0).alias("dragon_kills"),
        cnt(F.col("l_quantity") >= 45).alias("herald_kills"),
        F.count(F.lit(1)).cast("int").alias("tower_kills"),
        cnt(F.col("l_discount") == 0).alias("inhibitor_kills"),
        cnt(F.col("l_linestatus") == "F").alias("champion_kills"),
        F.bool_or(F.col("l_linenumber") == 1).alias("first_blood"),
        F.bool_or(F.col("l_linenumber") == 2).alias("first_tower"),
    ).select(F.col("l_orderkey").alias("match_id"), F.col("team_id").cast("int").alias("team_id"),
             "win", "baron_kills", "dragon_kills", "herald_kills", "tower_kills",
             "inhibitor_kills", "champion_kills", "first_blood", "first_tower",
             F.lit("2024-01-01T00:00:00+00:00").alias("_extracted_at"))


def raw_bans(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lines = (lines if lines is not None else lines_with_team(spark, sf_dir)).where(F.col("l_returnflag") == "R")
    return lines.select(
        F.col("l_orderkey").alias("match_id"), F.col("team_id").cast("int").alias("team_id"),
        F.when(F.col("l_discount") == 0, F.lit(-1)).otherwise(F.col("brand_no")).alias("champion_id"),
        F.col("l_linenumber").alias("pick_turn"),
        F.lit("2024-01-01T00:00:00+00:00").alias("_extracted_at"))


def raw_summoners(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _t(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("puuid"), F.col("s_name").alias("game_name"),
        F.when(F.col("s_acctbal") >= 1000, F.col("s_nationkey").cast("string")).alias("tag_line"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("platform"),
        _iround(F.col("s_acctbal") / 100.0).alias("summoner_level"),
        F.col("s_nationkey").alias("profile_icon_id"),
        F.lit(None).cast("long").alias("revision_date"),
        F.lit("2024-01-01T00:00:00+00:00").alias("_extracted_at"))


def tracked_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracked accounts: suppliers with a non-negative balance."""
    s = _t(spark, sf_dir, "supplier")
    return s.where(F.col("s_acctbal") >= 0).select(F.col("s_suppkey").alias("puuid"))


def raw_mastery(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lines = (lines if lines is not None else _lines_by(spark, sf_dir, "l_suppkey")).where(F.col("l_returnflag") != "R")
    return lines.groupBy("l_suppkey", "brand_no").agg(
        F.count_distinct("l_orderkey").cast("int").alias("champion_level"),
        F.count(F.lit(1)).cast("int").alias("champion_points"),
        F.count_if(F.col("l_linestatus") == "F").cast("int").alias("tokens_earned"),
        F.max(_ms("l_shipdate")).alias("last_play_time"),
    ).select(F.col("l_suppkey").alias("puuid"), F.col("brand_no").alias("champion_id"),
             "champion_level", "champion_points", "tokens_earned", "last_play_time",
             F.lit("2024-01-01T00:00:00+00:00").alias("_extracted_at"))


def seed_champions(spark: SparkSession, sf_dir: str, size_max: int | None = None,
                   version: str = "1") -> DataFrame:
    """One row per brand; ``size_max`` derives an older version from fewer parts."""
    p = _t(spark, sf_dir, "part")
    if size_max is not None:
        p = p.where(F.col("p_size") <= size_max)
    return p.groupBy(brand_number().alias("champion_id")).agg(
        F.min("p_brand").alias("champion_key"),
        F.min("p_brand").alias("champion_name"),
        F.max("p_name").alias("champion_title"),
        F.min("p_type").alias("primary_role"),
        F.max("p_type").alias("secondary_role"),
        F.when(F.max("p_size") > 45, F.lit("Mana")).alias("resource_type"),
    ).withColumn("data_dragon_version", F.lit(version))
