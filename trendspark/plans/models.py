"""The model graph as function composition: raw -> staging -> intermediate -> marts.

``build`` stores two intermediates while it runs, because several marts read them: the
participant metrics and the player sequence (``operators.sequence``). The marts
themselves are lazily defined.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from trendspark.config import DEFAULT, TrendConfig
from trendspark.operators import marts, metrics, scd2, staging
from trendspark.session import discard, materialize
from trendspark.sources.files import delete_path, path_has_data


@dataclass
class Staged:
    matches: DataFrame
    participants: DataFrame
    teams: DataFrame
    bans: DataFrame
    summoners: DataFrame
    mastery: DataFrame
    champions: DataFrame


# model of Staged -> its raw table (or the seed) and its staging
STAGING = {
    "matches": ("raw_matches", staging.stage_matches), "participants": ("raw_match_participants", staging.stage_participants),
    "teams": ("raw_match_teams", staging.stage_teams), "bans": ("raw_match_bans", staging.stage_bans),
    "summoners": ("raw_summoners", staging.stage_summoners), "mastery": ("raw_champion_mastery", staging.stage_mastery),
    "champions": ("champion_static", staging.stage_champions),
}


def stage(raw: dict[str, DataFrame], seed: DataFrame) -> Staged:
    tables = raw | {"champion_static": seed}
    return Staged(**{name: staged(tables[table]) for name, (table, staged) in STAGING.items()})


def staging_models(s: Staged) -> dict[str, DataFrame]:
    """The staged tables by the names of their models."""
    return {"stg_matches": s.matches, "stg_match_participants": s.participants, "stg_match_teams": s.teams,
            "stg_team_bans": s.bans, "stg_summoners": s.summoners, "stg_champion_mastery": s.mastery,
            "stg_champions": s.champions}


def create_views(s: Staged) -> list[str]:
    """The staging models as named session views, for SQL."""
    models = staging_models(s)
    for name, df in models.items():
        df.createOrReplaceTempView(name)
    return list(models)


def participant_metrics(s: Staged) -> DataFrame:
    return metrics.participant_metrics(s.participants, s.matches)


# the marts of one row per player and match (or metric), which windows over the player's matches make
LAID_OUT = {"fct_player_rolling_trends": marts.player_rolling_trends, "fct_player_champion_trends": marts.player_champion_trends,
            "fct_player_match_deltas": marts.player_match_deltas}


def laid_out_marts(seq: DataFrame, cfg: TrendConfig = DEFAULT) -> dict[str, DataFrame]:
    """The marts of ``LAID_OUT`` with their rows in ranges of players, so that they are written
    by player as they are; none where a player has more rows than one task takes.

    Ranges are found on the stored sequence, before the windows, and the windows keep them."""
    if not seq.where(F.col("player_match_count") > cfg.chunk_rows).isEmpty():
        return {}
    return {name: mart(seq, cfg, ranged=True) for name, mart in LAID_OUT.items()}


def build(s: Staged, tracked: DataFrame | None = None, cfg: TrendConfig = DEFAULT) -> dict[str, DataFrame]:
    """All marts. ``tracked`` defaults to the staged summoners."""
    tracked = tracked if tracked is not None else s.summoners.select("puuid")
    pm = materialize(participant_metrics(s), "participant-metrics")
    players = marts.dim_players(s.summoners, s.mastery, pm)
    seq = marts.player_match_sequence(pm, tracked, cfg, stored=True)
    appearances = marts.champion_appearances(s.participants, s.bans, s.matches)
    return {
        "int_match_team_totals": metrics.team_totals(s.participants),
        "int_participant_metrics": pm,
        "int_player_match_sequence": seq,
        "int_champion_match_appearances": appearances,
        "dim_champions": s.champions,
        "dim_players": players,
        "dim_matches": marts.dim_matches(s.matches, s.teams, cfg),
        "fct_participant_performance": marts.participant_performance(pm, players, cfg),
        "fct_player_rolling_trends": marts.player_rolling_trends(seq, cfg),
        "fct_player_champion_trends": marts.player_champion_trends(seq, cfg),
        "fct_player_match_deltas": marts.player_match_deltas(seq, cfg),
        "fct_champion_meta": marts.champion_meta(appearances, s.champions),
    }


def write_marts(marts: dict[str, DataFrame], root: str, only: list[str] | None = None,
                dealt: tuple[str, ...] = ()) -> dict[str, str]:
    """Full rebuild of the stored marts as parquet under ``root`` (one folder each).

    Marts of one row per player and match are laid out by player, for reads of one
    player; ``dealt`` names those whose rows come so (``laid_out_marts``). Returns the paths written. Intermediate (``int_*``) models are not stored, as in
    the original project where they are inlined into their consumers.
    """
    from trendspark.sources.io import write_entity_table, write_table
    paths = {}
    for name, df in marts.items():
        if name.startswith("int_") or (only and name not in only):
            continue
        path = f"{root.rstrip('/')}/{name}"
        if "puuid" in df.columns and name.startswith("fct_"):
            write_entity_table(df, path, "puuid", ["game_start_at"] if "game_start_at" in df.columns else [], name in dealt)
        else:
            write_table(df, path)
        paths[name] = path
    return paths


def build_from_landing(spark, landing_root: str, seed_path: str, out_root: str | None = None,
                       cfg: TrendConfig = DEFAULT) -> dict[str, DataFrame]:
    """Landed JSON Lines (``<landing_root>/<raw table>/``) and the seed CSV -> all marts.

    The files of a raw table are upserted in landing order by its natural key, so a batch
    landed twice counts once. A raw table with nothing landed reads as an empty typed
    table. Each raw table is listed and parsed once; its rows and its rejects come from that
    one stored parse. With
    ``out_root`` the marts are also stored there (full rebuild), the snapshot of the
    champions is merged with the stored one, the declared checks are run and stored under
    ``checks``, and the lines that did not fit a schema under ``rejects/<raw table>``.
    """
    from trendspark.plans.suite import run_checks
    from trendspark.sources.io import newest_landed, read_landed, read_seed, rejected_lines, write_table
    from trendspark.sources.schemas import RAW_TABLES
    landed = {t: materialize(read_landed(spark, landing_root, t), f"landed-{t}") for t in RAW_TABLES}
    raw = {}
    for t in RAW_TABLES:
        raw[t] = materialize(newest_landed(landed[t], t), t)
        if out_root:
            write_table(rejected_lines(landed[t]), f"{out_root.rstrip('/')}/rejects/{t}")
        discard(landed[t])
    seed = read_seed(spark, seed_path)
    staged = stage(raw, seed)
    built = build(staged, cfg=cfg)
    if out_root:
        by_player = laid_out_marts(built["int_player_match_sequence"], cfg)
        paths = write_marts(built | by_player, out_root, dealt=tuple(by_player))
        stored = {name: spark.read.parquet(path) for name, path in paths.items()}      # no mart is made twice
        write_table(run_checks({"champion_static": seed} | raw | staging_models(staged) | built | stored), f"{out_root.rstrip('/')}/checks")
        update_snapshot(spark, out_root, built["dim_champions"])
    return built


SNAPSHOT = "snp_champion_balance"
_PART, _OPEN = "_closed", "open"


def stored_snapshot(spark, root: str) -> DataFrame | None:
    """The whole stored history; None before the first run."""
    return spark.read.parquet(root).drop(_PART) if path_has_data(spark, root) else None


def store_snapshot(spark, root: str, source: DataFrame, key: str, checked: list[str], now) -> DataFrame:
    """One run of a stored type-2 history; returns the whole history after it.

    The history is partitioned by the time its rows were closed, the open rows apart. A
    run reads the open rows only and writes two partitions in one job (dynamic overwrite):
    the rows it closes, and the open rows after it. The files of versions closed by earlier runs are
    neither read nor written again. ``now`` must grow from run to run.
    """
    stored = spark.read.parquet(root) if path_has_data(spark, root) else None
    before = None if stored is None else stored.where(F.col(_PART) == _OPEN).drop(_PART)
    merged = scd2.scd2_merge(before, source, key, checked, now)
    part = F.coalesce(F.date_format("dbt_valid_to", "yyyyMMdd-HHmmss-SSSSSS"), F.lit(_OPEN))
    seen = Observation()
    (merged.withColumn(_PART, part).observe(seen, F.count_if(F.col("dbt_valid_to").isNull()).alias("open"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_PART).parquet(root))
    if before is not None and not seen.get["open"]:     # every key was deleted: no open row replaced the old ones
        delete_path(spark, f"{root.rstrip('/')}/{_PART}={_OPEN}")
    return stored_snapshot(spark, root)


def update_snapshot(spark, out_root: str, champions: DataFrame, now: str | None = None) -> DataFrame:
    """Merge today's champions into the stored type-2 history.

    The first run opens a row per champion; later runs close changed rows and open new
    ones. A run that changes nothing leaves the same history.
    """
    checked = [c for c in champions.columns if c != "champion_id"]
    stamp = F.lit(now).cast("timestamp") if now else F.lit(datetime.now(timezone.utc).isoformat()).cast("timestamp")
    return store_snapshot(spark, f"{out_root.rstrip('/')}/{SNAPSHOT}", champions, "champion_id", checked, stamp)
