"""The declared checks in one job equal the checks one by one, also on broken tables."""
from pyspark.sql import functions as F

from fixtures import raw_tables, seed_rows
from trendspark.operators import quality
from trendspark.plans import models, suite
from trendspark.sources.schemas import RAW_TABLES, SEED_CHAMPIONS


def _one_by_one(tables):
    out = {}
    for model, check, columns, args in suite.CHECKS:
        if model not in tables or args.get("to", model) not in tables:
            continue
        df = tables[model]
        failing = {
            "not_null": lambda: quality.not_null(df, columns[0]), "unique": lambda: quality.unique(df, columns[0]),
            "unique_combination": lambda: quality.unique_combination(df, list(columns)),
            "accepted_values": lambda: quality.accepted_values(df, columns[0], args["values"]),
            "accepted_range": lambda: quality.accepted_range(df, columns[0], args["low"], args["high"]),
            "relationships": lambda: quality.relationships(df, columns[0], tables[args["to"]], columns[0]),
            "group_size": lambda: quality.group_size(df, "match_id", 10), "no_negative": lambda: quality.no_negative(df, suite.COUNTS),
            "sequences_gapless": lambda: quality.sequences_gapless(df, ["puuid", "champion_id"], "champion_match_sequence_number"),
            "covered_by": lambda: quality.covered_by([tables[t] for t in suite.COVERING], df, "participant_key"),
        }.get(check, lambda: getattr(quality, check)(df))()
        out[model, suite.check_label(check, columns, args)] = (df.count(), failing.count())
    return out


def test_one_job_equals_single_checks(spark):
    raw = {t: spark.createDataFrame(rows, RAW_TABLES[t]) for t, rows in raw_tables().items()}
    seed = spark.createDataFrame(seed_rows(), SEED_CHAMPIONS)
    staged = models.stage(raw, seed)
    tables = {"champion_static": seed} | raw | models.staging_models(staged) | models.build(staged)
    broken = dict(tables)
    part = tables["stg_match_participants"]
    odd = F.col("participant_id") == 3
    broken["stg_match_participants"] = part.where("participant_id <> 10 OR match_id > 'm'").withColumn(
        "kills", F.when(odd, -1).otherwise(F.col("kills"))).withColumn("match_id", F.when(F.col("participant_id") == 5, None).otherwise(F.col("match_id"))) \
        .withColumn("participant_key", F.when(odd, F.lit("same")).otherwise(F.col("participant_key")))
    broken["champion_static"] = seed.unionByName(seed).withColumn("champion_key", F.lit(None).cast("string"))
    broken["fct_participant_performance"] = tables["fct_participant_performance"].where("kills > 3").withColumn("damage_share", F.lit(0.5))
    broken["fct_player_champion_trends"] = tables["fct_player_champion_trends"].withColumn("champion_match_sequence_number", F.lit(2))
    broken["fct_player_match_deltas"] = tables["fct_player_match_deltas"].withColumn("baseline_match_count", F.lit(1))
    broken["dim_players"] = tables["dim_players"].limit(0)
    kept = {k: v.cache() for k, v in broken.items()}
    got = suite.run_checks(kept)
    assert got._jdf.queryExecution().optimizedPlan().collectLeaves().size() == len(kept)        # each model once
    assert {(r["model"], r["check_name"]): (r["rows_checked"], r["rows_failing"]) for r in got.collect()} == _one_by_one(kept)
    assert sum(r["rows_failing"] > 0 for r in got.collect()) >= 10
    for v in kept.values():
        v.unpersist()


def test_long_keys_travel_as_digests(spark):
    """Keys of every length count as before; what is shuffled of a long one is 16 bytes."""
    keys = ["", "a", "x" * 15, "x" * 16, "x" * 17, "é" * 8, "y" * 40, "y" * 40, None, None, "a"]
    rows = [(k, "m", k, 1) for k in keys]
    p = spark.createDataFrame(rows, "participant_key string, match_id string, puuid string, champion_id int").select(
        "*", F.lit(100).alias("team_id"), F.lit(True).alias("is_win"), *[F.lit(1).alias(c) for c in ("kills", "deaths", "assists")])
    assert p.select(F.max(F.octet_length(suite._entry(0, F.col("participant_key"))["key"]))).first()[0] == 16
    tables = {"stg_match_participants": p}
    got = {(r["model"], r["check_name"]): (r["rows_checked"], r["rows_failing"]) for r in suite.run_checks(tables).collect()}
    assert got == _one_by_one(tables) and got["stg_match_participants", "unique participant_key"] == (11, 2)
