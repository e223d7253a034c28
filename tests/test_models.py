"""End-to-end: fixture raw tables -> staging -> marts, with the quality checks."""
import pytest
from pyspark.sql import functions as F

from fixtures import raw_tables, seed_rows
from trendspark.operators import quality as Q
from trendspark.plans import models
from trendspark.sources.schemas import RAW_TABLES, SEED_CHAMPIONS


@pytest.fixture(scope="module")
def marts(spark):
    raw = {t: spark.createDataFrame(rows, RAW_TABLES[t]) for t, rows in raw_tables().items()}
    staged = models.stage(raw, spark.createDataFrame(seed_rows(), SEED_CHAMPIONS))
    out = models.build(staged)
    out["staged"] = staged
    return out


def test_row_counts(marts):
    s = marts["staged"]
    assert s.matches.count() == 28
    assert s.participants.count() == 280
    assert s.teams.count() == 56
    assert s.bans.count() == 252                       # 28 declined bans filtered
    assert marts["fct_participant_performance"].count() == 240   # (28 - 4) x 10
    assert marts["fct_player_rolling_trends"].count() == 22      # 11 per player
    assert marts["fct_player_champion_trends"].count() == 22
    assert marts["fct_player_match_deltas"].count() == 198       # 22 x 9 metrics


def test_windows(marts):
    rt = marts["fct_player_rolling_trends"]
    full = rt.where("is_full_window").groupBy("puuid").count().collect()
    assert sorted(r["count"] for r in full) == [2, 2]            # sequence 10 and 11
    first = rt.where("match_sequence_number = 1").first()
    assert first["matches_in_window"] == 1 and first["rolling_window_matches"] == 10
    d = marts["fct_player_match_deltas"]
    assert d.where("has_sufficient_baseline").count() == 108     # seq >= 6, no null metric


def test_dims(marts):
    players = {r["puuid"]: r for r in marts["dim_players"].collect()}
    assert {p["matches_extracted"] for p in players.values()} == {14}
    assert {p["champions_with_mastery"] for p in players.values()} == {8}
    assert players["player-a"]["riot_id"] == "Player0#NA1"
    dm = marts["dim_matches"]
    assert dm.where("is_probable_remake").count() == 2
    assert dm.where("winning_team_id is null").count() == 0
    assert dm.select("queue_name").distinct().count() == 2


def test_meta(marts):
    meta = marts["fct_champion_meta"]
    garen = meta.where("champion_id = 86").first()
    assert garen["champion_name"] == "Garen" and garen["matches_on_patch"] > 0
    assert meta.where("win_rate < 0 or win_rate > 1 or pick_rate > 1").count() == 0
    assert meta.where("champion_name is null").count() > 0      # not in the seed -> left join null


def test_quality_checks_pass(marts):
    s = marts["staged"]
    perf, rt, ct = (marts["fct_participant_performance"], marts["fct_player_rolling_trends"],
                    marts["fct_player_champion_trends"])
    deltas, pm = marts["fct_player_match_deltas"], marts["int_participant_metrics"]
    assert Q.group_size(s.participants, "match_id", 10).count() == 0
    assert Q.no_negative(perf, ["kills", "deaths", "assists", "gold_earned", "creep_score",
                                "vision_score"]).count() == 0
    assert Q.shares_sum_to_one(pm).count() == 0
    assert Q.baseline_excludes_current(deltas).count() == 0
    assert Q.first_has_no_baseline(deltas).count() == 0
    assert Q.sequences_gapless(ct, ["puuid", "champion_id"], "champion_match_sequence_number").count() == 0
    assert Q.window_within_group(ct).count() == 0
    assert Q.covered_by([rt, ct], perf, "participant_key").count() == 0
    assert Q.accepted_range(pm, "kill_participation", 0, 1).count() == 0
    assert Q.unique(perf, "participant_key").count() == 0
    assert Q.unique_combination(s.participants, ["match_id", "puuid"]).count() == 0
    assert Q.not_null(perf, "participant_key").count() == 0
    assert Q.accepted_values(perf, "match_result", ["win", "loss"]).count() == 0
    assert Q.relationships(s.bans, "match_id", s.matches, "match_id").count() == 0


def test_quality_checks_catch_failures(spark, marts):
    s = marts["staged"]
    nine = s.participants.where("participant_id <> 10")
    assert Q.group_size(nine, "match_id", 10).count() == 28
    broken = marts["fct_player_match_deltas"].withColumn("baseline_match_count", F.lit(3))
    assert Q.baseline_excludes_current(broken).count() > 0
    summary = Q.summary(nine, Q.group_size(nine, "match_id", 10)).first()
    assert (summary["rows_checked"], summary["rows_failing"]) == (252, 28)


def test_write_marts(spark, marts, tmpdir_path):
    stored = {k: v for k, v in marts.items() if k != "staged"}
    paths = models.write_marts(stored, tmpdir_path, only=["dim_players", "fct_champion_meta"])
    assert set(paths) == {"dim_players", "fct_champion_meta"}
    assert spark.read.parquet(paths["dim_players"]).count() == 2


def test_split_path_matches_default(spark, marts):
    """Every mart built with 3-row chunks (all players split, two-column keys for the
    champion windows) equals the default build. Floats are compared with a relative
    1e-9: combining earlier-chunk moments sums in another association."""
    import math
    from trendspark.config import TrendConfig
    small = models.build(marts["staged"], cfg=TrendConfig(chunk_rows=3))
    for name, key in (("int_player_match_sequence", ["participant_key"]),
                      ("fct_player_rolling_trends", ["participant_key"]),
                      ("fct_player_champion_trends", ["participant_key"]),
                      ("fct_player_match_deltas", ["participant_key", "metric_name"])):
        a, b = marts[name], small[name]
        cols = sorted(a.columns)
        rows_a = {tuple(r[k] for k in key): r for r in a.select(*cols).collect()}
        rows_b = {tuple(r[k] for k in key): r for r in b.select(*cols).collect()}
        assert rows_a.keys() == rows_b.keys(), name
        for k, ra in rows_a.items():
            rb = rows_b[k]
            for c in cols:
                x, y = ra[c], rb[c]
                if isinstance(x, float) and isinstance(y, float):
                    assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12), (name, k, c, x, y)
                else:
                    assert x == y, (name, k, c, x, y)


def test_build_from_landing(spark, tmpdir_path):
    import os

    from fixtures import write_jsonl
    landing = os.path.join(tmpdir_path, "landing")
    for table, rows in raw_tables().items():
        os.makedirs(os.path.join(landing, table))
        write_jsonl(os.path.join(landing, table, "batch-1.jsonl"), rows)
    seed = os.path.join(tmpdir_path, "seed.csv")
    with open(seed, "w") as h:
        h.write("champion_id,champion_key,champion_name,champion_title,primary_role,secondary_role,"
                "resource_type,data_dragon_version\n")
        for r in seed_rows():
            h.write(",".join("" if r[k] is None else str(r[k]) for k in (
                "champion_id", "champion_key", "champion_name", "champion_title", "primary_role",
                "secondary_role", "resource_type", "data_dragon_version")) + "\n")
    out = os.path.join(tmpdir_path, "marts")
    models.build_from_landing(spark, landing, seed, out)
    assert spark.read.parquet(os.path.join(out, "fct_participant_performance")).count() == 240
    assert spark.read.parquet(os.path.join(out, "fct_player_match_deltas")).count() == 198
    assert spark.read.parquet(os.path.join(out, "dim_champions")).count() == 3
