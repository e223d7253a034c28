"""DuckDB SQL for every registered query (the correctness oracle).

Written from the definitions of the results and not from the Spark plans: histories are
ordered lists per entity and every rolling, expanding and prior figure is an aggregate of
an explicit list slice; shares are windows over the team; rates come from one row per
champion and match. Constants are written out here, so a wrong one in the library does
not pass unnoticed. Doubles are rounded like on the Spark side.
"""

from __future__ import annotations

TS = "'2024-01-01T00:00:00+00:00'"
NINE = ["kda_ratio_perfect_adjusted", "cs_per_minute", "gold_per_minute", "damage_per_minute",
        "vision_score_per_minute", "damage_share", "gold_share", "kill_participation", "damage_per_gold"]
VIEW6 = ["cs_per_minute", "gold_per_minute", "damage_per_minute", "kda_ratio_perfect_adjusted",
         "kill_participation", "damage_share"]
QUEUES = ("MAP {400: 'Normal Draft', 420: 'Ranked Solo/Duo', 430: 'Normal Blind', 440: 'Ranked Flex', "
          "450: 'ARAM', 700: 'Clash', 1700: 'Arena'}")


def _key(*cols: str) -> str:
    parts = ", ".join(f"ifnull(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in cols)
    return f"md5(array_to_string([{parts}], '-'))"


def _ratio(top: str, bottom: str) -> str:
    """Quotient of doubles; null for a null or zero divisor."""
    return f"(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0.0))"


def _rate(x: str) -> str:
    """Per minute of the match, defined from one minute on."""
    return f"if(game_duration_minutes >= 1, CAST({x} AS DOUBLE) / game_duration_minutes, NULL)"


def _queue_label(c: str) -> str:
    return f"ifnull({QUEUES}[CAST({c} AS INTEGER)], 'Other')"


def _snap_round(c: str, snap: str, unit: str) -> str:
    return f"floor(floor({c} / {snap} + 0.5) * {snap} / {unit} + 0.5) * {unit}"


def _stable_round(c: str) -> str:
    """Same formula as the Spark side (about 9 significant digits, tie-stable)."""
    return (f"CASE WHEN abs({c}) < 1e3 THEN {_snap_round(c, '1e-9', '1e-6')} "
            f"WHEN abs({c}) < 1e6 THEN {_snap_round(c, '1e-6', '1e-3')} "
            f"ELSE round({c}, 0) END")


def _rounded(sql: str, cols: list[str]) -> str:
    if not cols:
        return sql
    rep = ", ".join(f"{_stable_round(c)} AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS q"


# ----------------------------------------------------------------- stand-ins
STANDINS = f"""
lines AS (
  SELECT l.*, n.n_regionkey AS team_id, CAST(split_part(p.p_brand, '#', 2) AS INTEGER) AS brand_no
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
raw_matches AS (
  SELECT o_orderkey AS match_id, o_orderstatus AS data_version, o_orderstatus AS platform_id,
    380 + 20 * CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS queue_id,
    o_orderpriority AS game_mode, 'MATCHED_GAME' AS game_type, 11 AS map_id,
    concat_ws('.', CAST(year(o_orderdate) AS VARCHAR), CAST(month(o_orderdate) AS VARCHAR),
              CAST(day(o_orderdate) AS VARCHAR), CAST(o_custkey AS VARCHAR)) AS game_version,
    epoch_ms(o_orderdate) - 60000 AS game_creation,
    epoch_ms(o_orderdate) AS game_start_timestamp,
    epoch_ms(o_orderdate) + CAST(CAST(floor(o_totalprice / 100.0 + 0.5) AS INTEGER) AS BIGINT) * 1000 AS game_end_timestamp,
    CAST(floor(o_totalprice / 100.0 + 0.5) AS INTEGER) AS game_duration,
    {TS} AS _extracted_at
  FROM orders
),
raw_participants AS (
  SELECT l_orderkey AS match_id, l_suppkey AS puuid, min(l_linenumber) AS participant_id,
    CAST(team_id AS INTEGER) AS team_id,
    CAST(NULL AS VARCHAR) AS riot_id_game_name, CAST(NULL AS VARCHAR) AS riot_id_tagline,
    min(brand_no) AS champion_id, 'Brand#' || CAST(min(brand_no) AS VARCHAR) AS champion_name,
    CAST(count(*) AS INTEGER) AS champ_level,
    CASE WHEN count(*) > 1 THEN 'MULTI' ELSE '' END AS team_position,
    'SINGLE' AS individual_position, CAST(NULL AS VARCHAR) AS lane, CAST(NULL AS VARCHAR) AS role,
    CAST(count_if(l_linestatus = 'F') AS INTEGER) AS kills,
    CAST(count_if(l_returnflag = 'A') AS INTEGER) AS deaths,
    CAST(count_if(l_linestatus = 'O') AS INTEGER) AS assists,
    CAST(sum(CAST(floor(l_extendedprice + 0.5) AS INTEGER)) AS INTEGER) AS total_damage_dealt_to_champions,
    CAST(sum(CAST(l_quantity AS INTEGER)) AS INTEGER) AS total_damage_taken,
    CAST(sum(CAST(floor(l_tax * 100.0 + 0.5) AS INTEGER)) AS INTEGER) AS damage_dealt_to_objectives,
    CAST(count(*) AS INTEGER) AS total_heal,
    CAST(sum(CAST(floor(l_extendedprice * (1 - l_discount) + 0.5) AS INTEGER)) AS INTEGER) AS gold_earned,
    CAST(sum(CAST(floor(l_extendedprice * (1 - l_discount) * (1 - l_tax) + 0.5) AS INTEGER)) AS INTEGER) AS gold_spent,
    CAST(sum(CAST(l_quantity AS INTEGER)) AS INTEGER) AS total_minions_killed,
    CAST(count(*) AS INTEGER) AS neutral_minions_killed,
    CAST(sum(CAST(floor(l_discount * 100.0 + 0.5) AS INTEGER)) AS INTEGER) AS vision_score,
    CAST(count_if(l_discount > 0.05) AS INTEGER) AS wards_placed,
    CAST(count_if(l_tax > 0.05) AS INTEGER) AS wards_killed,
    CAST(count_if(l_quantity > 25) AS INTEGER) AS vision_wards_bought_in_game,
    CAST(count_if(l_quantity >= 40) AS INTEGER) AS turret_takedowns,
    CAST(count_if(l_discount = 0) AS INTEGER) AS dragon_kills,
    CAST(count_if(l_tax = 0) AS INTEGER) AS baron_kills,
    CAST(sum(CAST(l_quantity AS INTEGER)) AS INTEGER) * 10 AS time_played,
    bool_or(l_linestatus = 'F') AS win,
    bool_and(l_discount >= 0.09) AS game_ended_in_early_surrender,
    bool_or(l_discount >= 0.09) AS game_ended_in_surrender,
    {TS} AS _extracted_at
  FROM lines WHERE l_returnflag <> 'R'
  GROUP BY l_orderkey, l_suppkey, team_id
),
raw_teams AS (
  SELECT l_orderkey AS match_id, CAST(team_id AS INTEGER) AS team_id,
    bool_or(l_linestatus = 'F') AS win,
    CAST(count_if(l_returnflag = 'R') AS INTEGER) AS baron_kills,
    CAST(count_if(l_tax = 0) AS INTEGER) AS dragon_kills,
    CAST(count_if(l_quantity >= 45) AS INTEGER) AS herald_kills,
    CAST(count(*) AS INTEGER) AS tower_kills,
    CAST(count_if(l_discount = 0) AS INTEGER) AS inhibitor_kills,
    CAST(count_if(l_linestatus = 'F') AS INTEGER) AS champion_kills,
    bool_or(l_linenumber = 1) AS first_blood,
    bool_or(l_linenumber = 2) AS first_tower,
    {TS} AS _extracted_at
  FROM lines GROUP BY l_orderkey, team_id
),
raw_bans AS (
  SELECT l_orderkey AS match_id, CAST(team_id AS INTEGER) AS team_id,
    CASE WHEN l_discount = 0 THEN -1 ELSE brand_no END AS champion_id,
    l_linenumber AS pick_turn, {TS} AS _extracted_at
  FROM lines WHERE l_returnflag = 'R'
),
raw_summoners AS (
  SELECT s_suppkey AS puuid, s_name AS game_name,
    CASE WHEN s_acctbal >= 1000 THEN CAST(s_nationkey AS VARCHAR) END AS tag_line,
    'N' || CAST(s_nationkey AS VARCHAR) AS platform,
    CAST(floor(s_acctbal / 100.0 + 0.5) AS INTEGER) AS summoner_level,
    s_nationkey AS profile_icon_id, CAST(NULL AS BIGINT) AS revision_date, {TS} AS _extracted_at
  FROM supplier
),
tracked AS (SELECT s_suppkey AS puuid FROM supplier WHERE s_acctbal >= 0),
raw_mastery AS (
  SELECT l_suppkey AS puuid, brand_no AS champion_id,
    CAST(count(DISTINCT l_orderkey) AS INTEGER) AS champion_level,
    CAST(count(*) AS INTEGER) AS champion_points,
    CAST(count_if(l_linestatus = 'F') AS INTEGER) AS tokens_earned,
    max(epoch_ms(l_shipdate)) AS last_play_time, {TS} AS _extracted_at
  FROM lines WHERE l_returnflag <> 'R' GROUP BY l_suppkey, brand_no
),
seed AS (
  SELECT CAST(split_part(p_brand, '#', 2) AS INTEGER) AS champion_id,
    min(p_brand) AS champion_key, min(p_brand) AS champion_name, max(p_name) AS champion_title,
    min(p_type) AS primary_role, max(p_type) AS secondary_role,
    CASE WHEN max(p_size) > 45 THEN 'Mana' END AS resource_type, '1' AS data_dragon_version
  FROM part GROUP BY 1
),
stg_matches AS (
  SELECT match_id, data_version, platform_id AS platform, CAST(queue_id AS INTEGER) AS queue_id,
    game_mode, game_type, CAST(map_id AS INTEGER) AS map_id, game_version,
    CASE WHEN game_version IS NULL THEN NULL
         ELSE split_part(game_version, '.', 1) || '.' || split_part(game_version, '.', 2) END AS patch,
    epoch_ms(game_creation) AS game_creation_at,
    epoch_ms(game_start_timestamp) AS game_start_at,
    epoch_ms(game_end_timestamp) AS game_end_at,
    CAST(game_duration AS INTEGER) AS game_duration_seconds,
    CAST(game_duration AS DOUBLE) / 60.0 AS game_duration_minutes,
    _extracted_at
  FROM raw_matches
),
stg_participants AS (
  SELECT {_key('match_id', 'puuid')} AS participant_key, match_id, puuid,
    CAST(participant_id AS INTEGER) AS participant_id, CAST(team_id AS INTEGER) AS team_id,
    riot_id_game_name, riot_id_tagline, CAST(champion_id AS INTEGER) AS champion_id, champion_name,
    CAST(champ_level AS INTEGER) AS champion_level, team_position, individual_position, lane, role,
    CAST(kills AS INTEGER) AS kills, CAST(deaths AS INTEGER) AS deaths, CAST(assists AS INTEGER) AS assists,
    CAST(total_damage_dealt_to_champions AS INTEGER) AS damage_to_champions,
    CAST(total_damage_taken AS INTEGER) AS damage_taken,
    CAST(damage_dealt_to_objectives AS INTEGER) AS damage_to_objectives,
    CAST(total_heal AS INTEGER) AS total_heal,
    CAST(gold_earned AS INTEGER) AS gold_earned, CAST(gold_spent AS INTEGER) AS gold_spent,
    CAST(total_minions_killed AS INTEGER) + CAST(neutral_minions_killed AS INTEGER) AS creep_score,
    CAST(total_minions_killed AS INTEGER) AS minions_killed,
    CAST(neutral_minions_killed AS INTEGER) AS neutral_minions_killed,
    CAST(vision_score AS INTEGER) AS vision_score, CAST(wards_placed AS INTEGER) AS wards_placed,
    CAST(wards_killed AS INTEGER) AS wards_killed,
    CAST(vision_wards_bought_in_game AS INTEGER) AS control_wards_bought,
    CAST(turret_takedowns AS INTEGER) AS turret_takedowns, CAST(dragon_kills AS INTEGER) AS dragon_kills,
    CAST(baron_kills AS INTEGER) AS baron_kills, CAST(time_played AS INTEGER) AS time_played_seconds,
    CAST(win AS BOOLEAN) AS is_win,
    CAST(game_ended_in_early_surrender AS BOOLEAN) AS ended_in_early_surrender,
    CAST(game_ended_in_surrender AS BOOLEAN) AS ended_in_surrender,
    _extracted_at
  FROM raw_participants
),
stg_teams AS (
  SELECT {_key('match_id', 'team_id')} AS team_key, match_id, CAST(team_id AS INTEGER) AS team_id,
    CAST(win AS BOOLEAN) AS is_win, CAST(baron_kills AS INTEGER) AS baron_kills,
    CAST(dragon_kills AS INTEGER) AS dragon_kills, CAST(herald_kills AS INTEGER) AS herald_kills,
    CAST(tower_kills AS INTEGER) AS tower_kills, CAST(inhibitor_kills AS INTEGER) AS inhibitor_kills,
    CAST(champion_kills AS INTEGER) AS champion_kills,
    CAST(first_blood AS BOOLEAN) AS took_first_blood, CAST(first_tower AS BOOLEAN) AS took_first_tower,
    _extracted_at
  FROM raw_teams
),
stg_bans AS (
  SELECT match_id, CAST(team_id AS INTEGER) AS team_id, CAST(champion_id AS INTEGER) AS champion_id,
    CAST(pick_turn AS INTEGER) AS pick_turn, _extracted_at
  FROM raw_bans WHERE champion_id IS NOT NULL AND CAST(champion_id AS INTEGER) > 0
),
stg_summoners AS (
  SELECT puuid, game_name AS riot_id_game_name, tag_line AS riot_id_tagline,
    game_name || '#' || tag_line AS riot_id, platform,
    CAST(summoner_level AS INTEGER) AS summoner_level, profile_icon_id,
    epoch_ms(revision_date) AS profile_revised_at, _extracted_at
  FROM raw_summoners
),
stg_mastery AS (
  SELECT {_key('puuid', 'champion_id')} AS mastery_key, puuid,
    CAST(champion_id AS INTEGER) AS champion_id, CAST(champion_level AS INTEGER) AS mastery_level,
    CAST(champion_points AS INTEGER) AS mastery_points, CAST(tokens_earned AS INTEGER) AS tokens_earned,
    epoch_ms(last_play_time) AS last_played_at, _extracted_at
  FROM raw_mastery
),
dim_champions AS (
  SELECT CAST(champion_id AS INTEGER) AS champion_id, champion_key, champion_name, champion_title,
    primary_role, secondary_role, resource_type
  FROM seed
),
team_totals AS (
  SELECT match_id, team_id,
    CAST(sum(kills) AS BIGINT) AS team_kills, CAST(sum(deaths) AS BIGINT) AS team_deaths,
    CAST(sum(assists) AS BIGINT) AS team_assists,
    CAST(sum(damage_to_champions) AS BIGINT) AS team_damage_to_champions,
    CAST(sum(damage_taken) AS BIGINT) AS team_damage_taken,
    CAST(sum(gold_earned) AS BIGINT) AS team_gold_earned,
    CAST(sum(creep_score) AS BIGINT) AS team_creep_score,
    CAST(sum(vision_score) AS BIGINT) AS team_vision_score,
    count(*) AS team_participant_count
  FROM stg_participants GROUP BY 1, 2
),
pm AS (
  SELECT p.* EXCLUDE (riot_id_game_name, riot_id_tagline, individual_position, lane, role, total_heal,
      minions_killed, neutral_minions_killed, turret_takedowns, dragon_kills, baron_kills,
      time_played_seconds, ended_in_surrender)
    REPLACE (if(team_position = '', individual_position, ifnull(team_position, individual_position)) AS team_position),
    m.* EXCLUDE (match_id),
    {_ratio('kills + assists', 'deaths')} AS kda_ratio,
    (kills + assists) / CAST(if(deaths < 1, 1, deaths) AS DOUBLE) AS kda_ratio_perfect_adjusted,
    {_rate('creep_score')} AS cs_per_minute, {_rate('gold_earned')} AS gold_per_minute,
    {_rate('damage_to_champions')} AS damage_per_minute, {_rate('vision_score')} AS vision_score_per_minute,
    {_ratio('damage_to_champions', 'team_damage_to_champions')} AS damage_share,
    {_ratio('gold_earned', 'team_gold_earned')} AS gold_share,
    {_ratio('vision_score', 'team_vision_score')} AS vision_share,
    {_ratio('kills + assists', 'team_kills')} AS kill_participation,
    {_ratio('damage_to_champions', 'gold_earned')} AS damage_per_gold,
    {_ratio('gold_spent', 'gold_earned')} AS gold_spent_share
  FROM (
    SELECT *, CAST(sum(kills) OVER side AS BIGINT) AS team_kills,
      CAST(sum(damage_to_champions) OVER side AS BIGINT) AS team_damage_to_champions,
      CAST(sum(gold_earned) OVER side AS BIGINT) AS team_gold_earned,
      CAST(sum(vision_score) OVER side AS BIGINT) AS team_vision_score
    FROM stg_participants WINDOW side AS (PARTITION BY match_id, team_id)
  ) p JOIN (
    SELECT match_id, queue_id, patch, platform, game_start_at, game_duration_seconds, game_duration_minutes
    FROM stg_matches
  ) m ON m.match_id = p.match_id
),
dim_players AS (
  SELECT s.* EXCLUDE (profile_revised_at),
    (SELECT count(*) FROM pm WHERE pm.puuid = s.puuid) AS matches_extracted,
    (SELECT min(game_start_at) FROM pm WHERE pm.puuid = s.puuid) AS first_match_at,
    (SELECT max(game_start_at) FROM pm WHERE pm.puuid = s.puuid) AS last_match_at,
    (SELECT count(*) FROM stg_mastery y WHERE y.puuid = s.puuid) AS champions_with_mastery,
    (SELECT CAST(ifnull(sum(mastery_points), 0) AS BIGINT) FROM stg_mastery y WHERE y.puuid = s.puuid) AS total_mastery_points
  FROM stg_summoners s
),
perf AS (
  SELECT pm.* EXCLUDE (participant_id, platform, team_kills, team_damage_to_champions, team_gold_earned, team_vision_score),
    (SELECT any_value(riot_id) FROM stg_summoners s WHERE s.puuid = pm.puuid) AS riot_id,
    CAST(game_start_at AS DATE) AS game_date, if(is_win, 'win', 'loss') AS match_result
  FROM pm WHERE list_contains([400, 420, 440], queue_id)
),
dim_matches AS (
  SELECT m.* EXCLUDE (data_version), {_queue_label('queue_id')} AS queue_name,
    CAST(game_start_at AS DATE) AS game_date, game_duration_seconds < 300 AS is_probable_remake,
    (SELECT max(team_id) FROM stg_teams t WHERE t.match_id = m.match_id AND t.is_win) AS winning_team_id
  FROM stg_matches m
),
appearances AS (
  SELECT e.match_id, m.patch, m.queue_id, e.champion_id, e.team_id,
    e.kind = 'pick' AS was_picked, e.kind = 'ban' AS was_banned, e.is_win
  FROM (
    SELECT match_id, champion_id, team_id, is_win, 'pick' AS kind FROM stg_participants
    UNION ALL BY NAME
    SELECT match_id, champion_id, team_id, 'ban' AS kind FROM stg_bans
  ) e JOIN stg_matches m USING (match_id)
),
seq AS (
  SELECT *, count(*) OVER (mine ROWS UNBOUNDED PRECEDING) AS match_sequence_number,
    count(*) OVER (PARTITION BY puuid) AS player_match_count,
    count(*) OVER (same ROWS UNBOUNDED PRECEDING) AS champion_match_sequence_number,
    count(*) OVER (PARTITION BY puuid, champion_id) AS player_champion_match_count
  FROM (
    SELECT * FROM pm SEMI JOIN tracked USING (puuid)
    WHERE list_contains([400, 420, 440], queue_id) AND game_duration_seconds >= 300
      AND ended_in_early_surrender = false
  ) e
  WINDOW mine AS (PARTITION BY puuid ORDER BY game_start_at, match_id),
    same AS (PARTITION BY puuid, champion_id ORDER BY game_start_at, match_id)
)"""

TREND_IDS = ("participant_key, match_id, puuid, champion_id, champion_name, team_position, "
             "queue_id, patch, game_start_at, match_sequence_number")


def _history(source: str, part: str, order: str, metrics) -> str:
    """One row per entity: the whole history of each metric as an ordered list."""
    lists = ", ".join(f"list({m} ORDER BY {order}) AS {m}" for m in metrics)
    return f"SELECT {part}, {lists}, list(if(is_win, 1.0, 0.0) ORDER BY {order}) AS wins FROM {source} GROUP BY {part}"


def _same(part: str) -> str:
    return " AND ".join(f"h.{p.strip()} IS NOT DISTINCT FROM s.{p.strip()}" for p in part.split(","))


def _trend_doubles(metrics, exp_suffix: str, pct_suffix: str, raw: bool = True) -> list[str]:
    out = list(metrics) if raw else []
    for m in metrics:
        out += [f"{m}_rolling_avg", f"{m}_{exp_suffix}", f"{m}_{pct_suffix}"]
    return out + ["win_rate_rolling"]


def _rolling_sql(source: str, ids: str, part: str, order: str, metrics, window: int,
                 exp_suffix: str, pct_suffix: str) -> str:
    """Averages of list slices; a percent rank is the share of smaller others."""
    recent = f"[greatest(s.{order} - {window - 1}, 1):s.{order}]"
    cols = []
    for m in metrics:
        below = f"if(s.{m} IS NULL, list_count(h.{m}), len([x FOR x IN h.{m} IF x < s.{m}]))"
        cols += [f"s.{m}", f"list_avg(h.{m}{recent}) AS {m}_rolling_avg",
                 f"list_avg(h.{m}[1:s.{order}]) AS {m}_{exp_suffix}",
                 f"if(len(h.{m}) = 1, 0.0, {below} / CAST(len(h.{m}) - 1 AS DOUBLE)) AS {m}_{pct_suffix}"]
    names = ", ".join(f"s.{c.strip()}" for c in ids.split(","))
    return (f"SELECT {names},\n  " + ",\n  ".join(cols) + f""",
  list_avg(h.wins{recent}) AS win_rate_rolling, least(s.{order}, {window}) AS matches_in_window,
  {window} AS rolling_window_matches, s.{order} >= {window} AS is_full_window
FROM {source} s JOIN ({_history(source, part, order, metrics)}) h ON {_same(part)}""")


def _deltas_sql(source: str, ids: str, part: str, order: str, metrics, min_baseline: int = 5) -> str:
    """Every row against the list of its entity's earlier values, one row per metric."""
    entries = ",\n    ".join(
        f"{{'metric_name': '{m}', 'v': CAST(s.{m} AS DOUBLE), "
        f"'earlier': CAST(h.{m}[1:s.{order} - 1] AS DOUBLE[])}}" for m in metrics)
    names = ", ".join(f"s.{c.strip()}" for c in ids.split(","))
    return f"""
SELECT * EXCLUDE (e, earlier), metric_value - baseline_mean AS delta_from_baseline,
  {_ratio('metric_value - baseline_mean', 'baseline_mean')} AS pct_change_from_baseline,
  {_ratio('metric_value - baseline_mean', 'baseline_stddev')} AS z_score,
  {_ratio('len([x FOR x IN earlier IF x <= metric_value])', 'baseline_match_count')} AS baseline_percentile_rank,
  baseline_match_count >= {min_baseline} AS has_sufficient_baseline
FROM (
  SELECT *, e.metric_name AS metric_name, e.v AS metric_value, e.earlier AS earlier, list_avg(e.earlier) AS baseline_mean,
    list_aggregate(e.earlier, 'stddev_samp') AS baseline_stddev, CAST(list_count(e.earlier) AS BIGINT) AS baseline_match_count
  FROM (
    SELECT {names}, unnest([
    {entries}]) AS e
    FROM {source} s JOIN ({_history(source, part, order, metrics).replace(", list(if(is_win, 1.0, 0.0) ORDER BY " + order + ") AS wins", "")}) h
      ON {_same(part)}
  ) u
) v"""


DELTA_DOUBLES = ["metric_value", "baseline_mean", "baseline_stddev", "delta_from_baseline",
                 "pct_change_from_baseline", "z_score", "baseline_percentile_rank"]

PM_DOUBLES = ["game_duration_minutes", "kda_ratio", "kda_ratio_perfect_adjusted", "cs_per_minute",
              "gold_per_minute", "damage_per_minute", "vision_score_per_minute", "damage_share",
              "gold_share", "vision_share", "kill_participation", "damage_per_gold", "gold_spent_share"]

EVENTS = """
ev AS (
  SELECT event_id, user_id, event_type, ts, value,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CASE WHEN event_type <> 'error' THEN value END AS value_nullable,
    event_type = 'purchase' AS is_win
  FROM events
),
evseq AS (
  SELECT *,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq,
    count(*) OVER (PARTITION BY user_id) AS user_count,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS type_seq,
    count(*) OVER (PARTITION BY user_id, event_type) AS user_type_count
  FROM ev
)"""


def _with(body: str, *extra: str) -> str:
    ctes = ",\n".join([STANDINS, *extra])
    return f"WITH {ctes}\n{body}"


def _ev(body: str, *extra: str) -> str:
    ctes = ",\n".join([EVENTS, *extra])
    return f"WITH {ctes}\n{body}"


def _dq(checked: str, failing: str, ctes: str = "std") -> str:
    body = (f"SELECT CAST((SELECT count(*) FROM ({checked}) c) AS BIGINT) AS rows_checked, "
            f"CAST((SELECT count(*) FROM ({failing}) f) AS BIGINT) AS rows_failing")
    return _with(body) if ctes == "std" else body


def _trend_rows_cte() -> list[str]:
    m6 = VIEW6
    ov = ", ".join(f"CAST({m} AS DOUBLE) AS {m}, {m}_rolling_avg" for m in m6)
    return [
        "rt AS (" + _rolling_sql("seq", TREND_IDS + ", player_match_count, is_win", "puuid",
                                 "match_sequence_number", NINE, 10, "career_avg",
                                 "career_percentile") + ")",
        "ct AS (" + _rolling_sql("seq", TREND_IDS + ", champion_match_sequence_number, "
                                 "player_champion_match_count, is_win", "puuid, champion_id",
                                 "champion_match_sequence_number", NINE, 10, "champion_avg",
                                 "champion_percentile") + ")",
        f"""trows AS (
  SELECT puuid, 'all' AS view, match_sequence_number AS seq, match_sequence_number, champion_name,
    CAST(game_start_at AS DATE) AS game_date, is_win, rolling_window_matches, {ov} FROM rt
  UNION ALL
  SELECT puuid, coalesce(nullif(champion_name, ''), '—') AS view, champion_match_sequence_number AS seq,
    match_sequence_number, champion_name, CAST(game_start_at AS DATE) AS game_date, is_win,
    rolling_window_matches, {ov} FROM ct
)""",
        "tpoints AS (SELECT * FROM (" + "\n  UNION ALL\n  ".join(
            f"SELECT puuid, view, seq AS x, '{m}' AS metric, {m} AS raw, {m}_rolling_avg AS roll FROM trows"
            for m in m6) + ") u WHERE raw IS NOT NULL)",
        """tseries AS (
  SELECT p.* FROM tpoints p
  JOIN (SELECT puuid, view, metric FROM tpoints GROUP BY ALL HAVING count(*) >= 2) k
  USING (puuid, view, metric)
)""",
        "ttot AS (SELECT r.*, t.total FROM trows r JOIN (SELECT puuid, view, count(*) AS total "
        "FROM trows GROUP BY ALL) t USING (puuid, view))",
    ]


def _snapshot_ctes() -> list[str]:
    """History as runs of equal states: each run lists the champions it saw and what they were."""
    seed_sql = """
  SELECT CAST(split_part(p_brand, '#', 2) AS INTEGER) AS champion_id,
    min(p_brand) AS champion_key, min(p_brand) AS champion_name, max(p_name) AS champion_title,
    min(p_type) AS primary_role, max(p_type) AS secondary_role,
    CASE WHEN max(p_size) > 45 THEN 'Mana' END AS resource_type, '{v}' AS data_dragon_version,
    {run} AS run, TIMESTAMP '{at}' AS seen_at
  FROM part {where} GROUP BY 1"""
    return [
        "runs AS (" + " UNION ALL ".join("SELECT * FROM (" + seed_sql.format(**r) + ") WHERE " + keep for r, keep in (
            ({"v": "1", "run": 1, "at": "1996-03-01", "where": "WHERE p_size <= 25"}, "champion_id % 10 <> 1"),
            ({"v": "2", "run": 2, "at": "1998-01-01", "where": ""}, "champion_id % 10 <> 2"),
            ({"v": "2", "run": 3, "at": "1999-06-01", "where": ""}, "true"))) + ")",
        """states AS (
  SELECT *, md5(concat_ws('~', ifnull(primary_role, '?'), ifnull(secondary_role, '?'), ifnull(resource_type, '?'),
    ifnull(champion_name, '?'), ifnull(champion_title, '?'))) AS state FROM runs
),
starts AS (
  SELECT *, lag(run) OVER w IS DISTINCT FROM run - 1 OR lag(state) OVER w <> state AS opens
  FROM states WINDOW w AS (PARTITION BY champion_id ORDER BY run)
),
versions AS (
  SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY champion_id ORDER BY run) AS version FROM starts
),
snap2 AS (
  SELECT champion_id, arg_min(champion_key, run) AS champion_key, arg_min(champion_name, run) AS champion_name,
    arg_min(champion_title, run) AS champion_title, arg_min(primary_role, run) AS primary_role,
    arg_min(secondary_role, run) AS secondary_role, list(resource_type ORDER BY run)[1] AS resource_type,
    arg_min(data_dragon_version, run) AS data_dragon_version,
    md5(CAST(champion_id AS VARCHAR) || '|' || CAST(min(seen_at) AS VARCHAR)) AS dbt_scd_id,
    min(seen_at) AS dbt_updated_at, min(seen_at) AS dbt_valid_from,
    CASE max(run) WHEN 1 THEN TIMESTAMP '1998-01-01' WHEN 2 THEN TIMESTAMP '1999-06-01' END AS dbt_valid_to
  FROM versions GROUP BY champion_id, version
)""",
    ]


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    simple = {
        "stg_matches": ("stg_matches", ["game_duration_minutes"]),
        "stg_participants": ("stg_participants", []),
        "stg_teams": ("stg_teams", []),
        "stg_bans": ("stg_bans", []),
        "stg_summoners": ("stg_summoners", []),
        "stg_mastery": ("stg_mastery", []),
        "dim_champions": ("dim_champions", []),
        "team_totals": ("team_totals", []),
        "participant_metrics": ("pm", PM_DOUBLES),
        "dim_players": ("dim_players", []),
        "dim_matches": ("dim_matches", ["game_duration_minutes"]),
        "participant_performance": ("perf", PM_DOUBLES),
        "champion_appearances": ("appearances", []),
    }
    for name, (cte, doubles) in simple.items():
        q[name] = _rounded(_with(f"SELECT * FROM {cte}"), doubles)

    q["surrogate_key"] = (f"SELECT l_orderkey, l_linenumber, l_suppkey, "
                          f"{_key('l_orderkey', 'l_linenumber', 'l_suppkey')} AS line_key FROM lineitem")

    meta = f"""
SELECT {_key('patch', 'queue_id', 'champion_id')} AS champion_meta_key, patch, queue_id,
  {_queue_label('queue_id')} AS queue_name, champion_id,
  (SELECT any_value(champion_name) FROM known c WHERE c.champion_id = r.champion_id) AS champion_name,
  (SELECT any_value(primary_role) FROM known c WHERE c.champion_id = r.champion_id) AS primary_role,
  matches_on_patch, matches_picked, matches_banned, wins, losses,
  {_ratio('matches_picked', 'matches_on_patch')} AS pick_rate,
  {_ratio('matches_banned', 'matches_on_patch')} AS ban_rate,
  {_ratio('matches_picked + matches_banned', 'matches_on_patch')} AS presence_rate,
  {_ratio('wins', 'wins + losses')} AS win_rate
FROM (
  SELECT patch, queue_id, champion_id, max(seen) AS matches_on_patch,
    CAST(sum(picked) AS BIGINT) AS matches_picked, CAST(sum(banned) AS BIGINT) AS matches_banned,
    CAST(sum(won) AS BIGINT) AS wins, CAST(sum(lost) AS BIGINT) AS losses
  FROM (
    SELECT *, count(DISTINCT match_id) OVER (PARTITION BY patch, queue_id) AS seen FROM (
      SELECT patch, queue_id, champion_id, match_id, CAST(bool_or(was_picked) AS INTEGER) AS picked,
        CAST(bool_or(was_banned) AS INTEGER) AS banned, count_if(was_picked AND is_win) AS won,
        count_if(was_picked AND NOT is_win) AS lost
      FROM appearances WHERE patch IS NOT NULL AND queue_id IS NOT NULL GROUP BY ALL) one
  ) counted GROUP BY ALL
) r"""
    q["champion_meta"] = _rounded(_with(meta, "known AS (SELECT * FROM dim_champions WHERE champion_id % 10 <> 3)"), ["pick_rate", "ban_rate", "presence_rate", "win_rate"])

    q["player_sequence"] = _with(
        "SELECT participant_key, match_id, puuid, champion_id, game_start_at, match_sequence_number, "
        "player_match_count, champion_match_sequence_number, player_champion_match_count FROM seq")

    q["rolling_trends"] = _rounded(_with(_rolling_sql(
        "seq", TREND_IDS + ", player_match_count, is_win", "puuid", "match_sequence_number",
        NINE, 10, "career_avg", "career_percentile")),
        _trend_doubles(NINE, "career_avg", "career_percentile"))
    q["champion_trends"] = _rounded(_with(_rolling_sql(
        "seq", TREND_IDS + ", champion_match_sequence_number, player_champion_match_count, is_win",
        "puuid, champion_id", "champion_match_sequence_number", NINE, 10,
        "champion_avg", "champion_percentile")),
        _trend_doubles(NINE, "champion_avg", "champion_percentile"))
    deltas = _deltas_sql("seq", TREND_IDS + ", is_win", "puuid", "match_sequence_number", NINE)
    q["match_deltas"] = _rounded(_with(deltas), DELTA_DOUBLES)

    q["events_sequence"] = _ev("SELECT event_id, user_id, event_type, seq, user_count, type_seq, "
                               "user_type_count FROM evseq")
    q["events_rolling_nullable"] = _rounded(_ev(_rolling_sql(
        "evseq", "event_id, user_id, seq, user_count, is_win", "user_id", "seq",
        ["value", "value_nullable", "k"], 10, "career_avg", "career_percentile")),
        _trend_doubles(["value", "value_nullable"], "career_avg", "career_percentile")
        + _trend_doubles(["k"], "career_avg", "career_percentile", raw=False)[:-1])
    q["events_type_trends"] = _rounded(_ev(_rolling_sql(
        "evseq", "event_id, user_id, event_type, type_seq, user_type_count, is_win",
        "user_id, event_type", "type_seq", ["value_nullable"], 5, "type_avg", "type_percentile")),
        _trend_doubles(["value_nullable"], "type_avg", "type_percentile"))
    q["events_rolling_split"] = _rounded(_ev(_rolling_sql(
        "evseq", "event_id, user_id, seq, user_count, is_win", "user_id", "seq",
        ["value", "value_nullable"], 10, "career_avg", "career_percentile")),
        _trend_doubles(["value", "value_nullable"], "career_avg", "career_percentile"))
    ev_deltas = _deltas_sql("evseq", "event_id, user_id, seq", "user_id", "seq",
                            ["value", "value_nullable", "k"])
    q["events_prior_percentile"] = _rounded(_ev(ev_deltas), DELTA_DOUBLES)
    ev_split = _deltas_sql("evseq", "event_id, user_id, seq", "user_id", "seq", ["value_nullable"])
    q["events_prior_split"] = _rounded(_ev(ev_split), DELTA_DOUBLES)

    q["props_flatten"] = ("SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS k, "
                          "coalesce(CAST(json_extract_string(props, '$.missing') AS INTEGER), 0) AS missing_or_zero, "
                          "substring(event_type, 1, 1) AS first_letter, "
                          "substring(event_type, 8, 1) AS eighth_letter FROM events")
    q["turn_explode"] = ("SELECT conv_id, turn, role, CAST(line_no AS INTEGER) AS line_no, "
                         "CAST(length(line) AS INTEGER) AS line_chars FROM ("
                         "SELECT conv_id, turn, role, unnest(range(1, len(parts) + 1)) AS line_no, "
                         "unnest(parts) AS line FROM (SELECT conv_id, turn, role, "
                         "string_split(text, chr(10)) AS parts FROM conversations WHERE text IS NOT NULL) s) u")
    q["split_identifier"] = """
SELECT c_custkey, CASE WHEN ok THEN nm END AS id_name, CASE WHEN ok THEN tg END AS id_tag, ok AS id_valid
FROM (
  SELECT c_custkey, nm, tg, coalesce(strpos(c_name, '#') > 0 AND length(nm) > 0 AND length(tg) > 0, false) AS ok
  FROM (SELECT c_custkey, c_name, trim(split_part(c_name, '#', 1), chr(32) || chr(9) || chr(10)) AS nm,
               CASE WHEN strpos(c_name, '#') > 0 THEN trim(substr(c_name, strpos(c_name, '#') + 1), chr(32) || chr(9) || chr(10)) ELSE '' END AS tg
        FROM (SELECT c_custkey, CASE c_custkey % 5
          WHEN 0 THEN replace(c_name, '#', '') WHEN 1 THEN chr(32) || chr(9) || '#' || c_name
          WHEN 2 THEN c_name || chr(10) WHEN 3 THEN split_part(c_name, '#', 1) || '#' || chr(9) || ' '
          ELSE chr(9) || ' ' || replace(c_name, '#', ' #' || chr(10)) || ' ' || chr(9) END AS c_name FROM customer) c) a
) b"""
    q["newest_n_matches"] = """
SELECT o_custkey, o_orderkey, o_orderdate, recency FROM (
  SELECT o_custkey, o_orderkey, o_orderdate,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS recency
  FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderdate >= TIMESTAMP '1996-01-01'
) r WHERE recency <= 5"""
    q["keyed_upsert"] = _rounded("""
WITH target AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders),
urgent AS (SELECT * FROM target WHERE o_orderpriority = '1-URGENT'),
changed AS (SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice + 1.0 AS o_totalprice FROM urgent),
fresh AS (SELECT o_orderkey + 10000000000 AS o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM urgent),
batch AS (SELECT * FROM changed UNION ALL SELECT * FROM changed UNION ALL SELECT * FROM fresh)
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.o_orderkey = t.o_orderkey)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM batch""",
                                 ["o_totalprice"])
    q["scd2_merge"] = _with("SELECT * FROM snap2", *_snapshot_ctes())
    q["scd2_asof"] = _with("""
SELECT f.participant_key, f.champion_id, f.game_start_at, s.primary_role, s.champion_title, s.dbt_scd_id
FROM (SELECT p.participant_key, p.champion_id, m.game_start_at
      FROM stg_participants p JOIN stg_matches m ON p.match_id = m.match_id) f
LEFT JOIN snap2 s ON f.champion_id = s.champion_id AND s.dbt_valid_from <= f.game_start_at
  AND (s.dbt_valid_to IS NULL OR f.game_start_at < s.dbt_valid_to)""", *_snapshot_ctes())
    q["tracked_semi"] = _with("SELECT participant_key, puuid, match_id FROM stg_participants "
                              "WHERE puuid IN (SELECT puuid FROM tracked)")

    # Quality checks: one-row (rows_checked, rows_failing) summaries.
    deltas_cte = ["deltas AS (" + deltas + ")"]
    rt_cte, ct_cte = _trend_rows_cte()[0], _trend_rows_cte()[1]
    dq = {
        "dq_not_null": ("SELECT * FROM stg_summoners", "SELECT * FROM stg_summoners WHERE riot_id IS NULL", []),
        "dq_unique": ("SELECT * FROM lineitem",
                      "SELECT concat_ws('-', l_orderkey, l_linenumber) AS line_id, count(*) FROM lineitem "
                      "GROUP BY 1 HAVING count(*) > 1", []),
        "dq_unique_combo": ("SELECT * FROM stg_bans",
                            "SELECT match_id, team_id, champion_id FROM stg_bans GROUP BY ALL HAVING count(*) > 1", []),
        "dq_accepted_values": ("SELECT * FROM dim_matches",
                               "SELECT * FROM dim_matches WHERE queue_name IS NOT NULL AND queue_name NOT IN "
                               "('Normal Draft', 'Ranked Solo/Duo', 'Ranked Flex')", []),
        "dq_range": ("SELECT * FROM pm", "SELECT * FROM pm WHERE kill_participation < 0 OR kill_participation > 1", []),
        "dq_group_size": ("SELECT * FROM stg_participants",
                          "SELECT match_id FROM stg_participants GROUP BY 1 HAVING count(*) <> 10", []),
        "dq_negative": ("SELECT * FROM perf",
                        "SELECT * FROM perf WHERE kills - deaths < 0 OR deaths < 0 OR assists < 0 OR gold_earned < 0 "
                        "OR creep_score < 0 OR vision_score < 0", []),
        "dq_shares_sum": ("SELECT * FROM perf",
                          "SELECT * FROM (SELECT match_id, team_id, sum(if(team_id = 0, damage_share * 1.5, damage_share)) AS s, count(*) AS n FROM perf "
                          "WHERE damage_share IS NOT NULL GROUP BY 1, 2) t WHERE n = 2 AND abs(s - 1.0) > 0.0001", []),
        "dq_baseline_excludes_current": ("SELECT * FROM deltas",
                                         "SELECT * FROM deltas WHERE baseline_match_count <> match_sequence_number - 1",
                                         deltas_cte),
        "dq_first_no_baseline": ("SELECT * FROM deltas",
                                 "SELECT * FROM deltas WHERE match_sequence_number = 2 AND (baseline_mean IS NOT NULL "
                                 "OR z_score IS NOT NULL OR delta_from_baseline IS NOT NULL)", deltas_cte),
        "dq_gapless": ("SELECT * FROM ct",
                       "SELECT * FROM (SELECT puuid, champion_id, count(*) AS n, "
                       "max(champion_match_sequence_number + if(champion_id % 5 = 0, 1, 0)) AS hi, "
                       "min(champion_match_sequence_number + if(champion_id % 5 = 0, 1, 0)) AS lo FROM ct GROUP BY 1, 2) b "
                       "WHERE lo <> 1 OR hi <> n", [ct_cte]),
        "dq_window_bound": ("SELECT * FROM ct",
                            "SELECT * FROM ct WHERE matches_in_window + 1 > champion_match_sequence_number "
                            "OR matches_in_window + 1 > player_champion_match_count", [ct_cte]),
        "dq_trend_coverage": ("SELECT * FROM rt",
                              "SELECT t.participant_key FROM (SELECT participant_key FROM rt UNION "
                              "SELECT participant_key FROM ct) t WHERE participant_key NOT IN "
                              "(SELECT participant_key FROM perf WHERE is_win)",
                              [rt_cte, ct_cte]),
        "orphan_anti": ("SELECT * FROM stg_bans",
                        "SELECT * FROM stg_bans b WHERE if(champion_id % 7 = 0, -match_id, match_id) NOT IN "
                        "(SELECT match_id FROM stg_matches)", []),
    }
    q["dq_failing_rows"] = _with("""
SELECT 'not_null' AS check_name, CAST(puuid AS VARCHAR) AS failing_key FROM stg_summoners WHERE riot_id IS NULL
UNION ALL SELECT 'relationships', array_to_string([match_id, team_id, champion_id, pick_turn], '-') FROM (
  SELECT if(champion_id % 7 = 0, -match_id, match_id) AS match_id, team_id, champion_id, pick_turn FROM stg_bans) b
  WHERE match_id NOT IN (SELECT match_id FROM stg_matches)
UNION ALL SELECT 'no_negative', participant_key FROM perf WHERE kills < deaths OR deaths < 0
UNION ALL SELECT 'first_has_no_baseline', participant_key || '-' || metric_name FROM deltas
  WHERE match_sequence_number = 2 AND coalesce(baseline_mean, z_score, delta_from_baseline) IS NOT NULL
UNION ALL SELECT 'window_within_group', participant_key FROM ct
  WHERE matches_in_window >= least(champion_match_sequence_number, player_champion_match_count)
UNION ALL SELECT 'covered_by', participant_key FROM (SELECT participant_key FROM rt UNION SELECT participant_key FROM ct) t
  WHERE participant_key NOT IN (SELECT participant_key FROM perf WHERE is_win)""", *deltas_cte, rt_cte, ct_cte)
    for name, (checked, failing, extra) in dq.items():
        body = (f"SELECT CAST((SELECT count(*) FROM ({checked}) c) AS BIGINT) AS rows_checked, "
                f"CAST((SELECT count(*) FROM ({failing}) f) AS BIGINT) AS rows_failing")
        q[name] = _with(body, *extra)

    views_ctes = _trend_rows_cte()
    q["trend_series"] = _rounded(_with("SELECT puuid, view, x, metric, raw, roll FROM tseries", *views_ctes),
                                 ["raw", "roll"])
    q["point_metadata"] = _with(
        "SELECT puuid, view, seq AS x, match_sequence_number AS seq, CAST(game_date AS VARCHAR) AS date, "
        "coalesce(nullif(champion_name, ''), '—') AS champion, "
        "CASE WHEN is_win THEN 'Win' ELSE 'Loss' END AS result FROM trows", *views_ctes)
    q["min_group_filter"] = _with("""
SELECT puuid, label, games, row_number() OVER (PARTITION BY puuid ORDER BY games DESC, label ASC) AS option_order
FROM (SELECT puuid, coalesce(nullif(champion_name, ''), '—') AS label, count(*) AS games FROM ct GROUP BY 1, 2) g
WHERE games >= 5""", ct_cte)
    q["range_options"] = _with(
        "SELECT puuid, view, total, range_n FROM (SELECT puuid, view, count(*) AS total FROM trows GROUP BY 1, 2) t, "
        "(SELECT unnest([10, 20, 50, 100]) AS range_n) o WHERE range_n < total", *views_ctes)
    newest = ("QUALIFY row_number() OVER (PARTITION BY puuid, view ORDER BY seq DESC, "
              "match_sequence_number DESC) <= 20")
    rolls = ", ".join(f"{m}_rolling_avg" for m in VIEW6)
    q["last_n_view"] = _rounded(_with(f"SELECT puuid, view, seq, total, {rolls} FROM ttot " + newest,
                                      *views_ctes), [f"{m}_rolling_avg" for m in VIEW6])
    q["range_summary"] = _with(
        "SELECT puuid, view, count(*) AS shown, max(total) AS total, "
        "CAST(arg_min(game_date, seq) AS VARCHAR) AS first_date, CAST(arg_max(game_date, seq) AS VARCHAR) AS last_date "
        f"FROM (SELECT * FROM ttot {newest}) n GROUP BY 1, 2", *views_ctes)
    q["axis_bounds"] = _rounded(_with("""
SELECT puuid, view, metric, range_n, greatest(0.0, lo - (hi - lo) * 0.12) AS axis_lo, hi + (hi - lo) * 0.12 AS axis_hi
FROM (SELECT puuid, view, metric, range_n, lo, CASE WHEN hi = lo THEN lo + 1.0 ELSE hi END AS hi
      FROM (SELECT puuid, view, metric, range_n, least(min(raw), min(roll)) AS lo, greatest(max(raw), max(roll)) AS hi
            FROM (SELECT *, row_number() OVER (PARTITION BY puuid, view, metric ORDER BY x DESC) AS place FROM tseries) p
            JOIN (SELECT unnest([0, 10, 20, 50, 100]) AS range_n) o ON range_n = 0 OR place <= range_n
            GROUP BY ALL) a) b""", *views_ctes), ["axis_lo", "axis_hi"])
    q["latest_value"] = _rounded(_with(
        "SELECT puuid, view, metric, arg_max(roll, x) AS latest_roll, max(x) AS latest_x FROM tseries "
        "WHERE roll IS NOT NULL GROUP BY 1, 2, 3", *views_ctes), ["latest_roll"])
    q["top_entity"] = _with("""
SELECT t.puuid, t.matches_extracted, coalesce(t.riot_id, substring(CAST(t.puuid AS VARCHAR), 1, 12)) AS label
FROM (SELECT puuid, matches_extracted, riot_id FROM dim_players ORDER BY matches_extracted DESC, puuid ASC LIMIT 1) t""")
    q["player_labels"] = _with(
        "SELECT puuid, coalesce(riot_id, substring(CAST(puuid AS VARCHAR), 1, 12)) AS label FROM dim_players")
    q["player_range_view"] = _rounded(_with(
        "SELECT puuid, view, seq, total, gold_per_minute_rolling_avg, kill_participation_rolling_avg FROM ttot "
        "WHERE puuid = (SELECT puuid FROM dim_players SEMI JOIN rt USING (puuid) ORDER BY matches_extracted DESC, puuid LIMIT 1) "
        + newest, *views_ctes), ["gold_per_minute_rolling_avg", "kill_participation_rolling_avg"])
    eligible = ("SELECT * FROM pm SEMI JOIN stg_summoners USING (puuid) WHERE queue_id IN (400, 420, 440) "
                "AND game_duration_seconds >= 300 AND NOT ended_in_early_surrender")

    def stored(item: str, rows: str, total: str = "0") -> str:
        return f"SELECT '{item}' AS item, count(*) AS n, coalesce(CAST(sum({total}) AS DOUBLE), 0) AS total FROM ({rows}) t"
    q["build_landing"] = _with("\nUNION ALL ".join([
        stored("dim_matches", "SELECT * FROM dim_matches", "game_duration_seconds"),
        stored("dim_players", "SELECT * FROM dim_players", "matches_extracted"),
        stored("dim_champions", "SELECT * FROM dim_champions", "champion_id"),
        stored("fct_participant_performance", "SELECT * FROM perf", "kills"),
        stored("fct_player_rolling_trends", f"SELECT row_number() OVER (PARTITION BY puuid) AS seq FROM ({eligible}) e", "seq"),
        stored("fct_player_champion_trends", f"SELECT row_number() OVER (PARTITION BY puuid, champion_id) AS seq FROM ({eligible}) e", "seq"),
        stored("fct_champion_meta", "SELECT * FROM meta", "matches_picked"),
        stored("rejects/raw_matches", "SELECT * FROM raw_matches"),
        stored("snp_champion_balance", "SELECT * FROM dim_champions", "champion_id")]),
        "known AS (SELECT * FROM dim_champions)", f"meta AS ({meta})")
    q |= _landing_sql()
    meta_cte = ["known AS (SELECT * FROM dim_champions WHERE champion_id % 10 <> 3)", f"meta AS ({meta})"]
    q["dq_suite"] = _with(_suite_sql(), *deltas_cte, rt_cte, ct_cte, *meta_cte)
    return q


def _suite_sql() -> str:
    """Failing rows of each declared check, counted one by one."""
    from trendspark.plans.suite import CHECKS, check_label
    at = {"champion_static": "seed", "raw_match_participants": "raw_participants", "stg_match_participants": "stg_participants", "stg_match_teams": "stg_teams", "stg_team_bans": "stg_bans",
          "stg_champion_mastery": "stg_mastery", "stg_champions": "dim_champions", "int_match_team_totals": "team_totals",
          "int_participant_metrics": "pm", "int_player_match_sequence": "seq",
          "int_champion_match_appearances": "appearances", "fct_participant_performance": "perf",
          "fct_player_rolling_trends": "rt", "fct_player_champion_trends": "ct", "fct_player_match_deltas": "deltas",
          "fct_champion_meta": "meta"}
    single = {
        "baseline_excludes_current": "SELECT 1 FROM deltas WHERE baseline_match_count <> match_sequence_number - 1",
        "first_has_no_baseline": "SELECT 1 FROM deltas WHERE match_sequence_number = 1 AND "
                                 "coalesce(baseline_mean, z_score, delta_from_baseline) IS NOT NULL",
        "sequences_gapless": "SELECT 1 FROM ct GROUP BY puuid, champion_id HAVING min(champion_match_sequence_number) <> 1 "
                             "OR max(champion_match_sequence_number) <> count(*)",
        "window_within_group": "SELECT 1 FROM ct WHERE matches_in_window > "
                               "least(champion_match_sequence_number, player_champion_match_count)",
        "group_size": "SELECT 1 FROM stg_participants GROUP BY match_id HAVING count(*) <> 10",
        "no_negative": "SELECT 1 FROM perf WHERE least(kills, deaths, assists, creep_score, gold_earned, "
                       "damage_to_champions, vision_score) < 0",
        "shares_sum_to_one": "SELECT 1 FROM perf WHERE damage_share IS NOT NULL GROUP BY match_id, team_id "
                             "HAVING count(*) = 5 AND abs(sum(damage_share) - 1) > 0.0001",
        "covered_by": "SELECT 1 FROM (SELECT participant_key FROM rt UNION SELECT participant_key FROM ct) t "
                      "WHERE participant_key NOT IN (SELECT participant_key FROM perf)",
    }
    parts = []
    for model, check, cols, args in CHECKS:
        t, c = at.get(model, model), cols[0] if cols else ""
        if check == "not_null":
            bad = f"SELECT 1 FROM {t} WHERE {c} IS NULL"
        elif check.startswith("unique"):
            keep = f"WHERE {c} IS NOT NULL" if check == "unique" else ""
            bad = f"SELECT 1 FROM {t} {keep} GROUP BY {', '.join(cols)} HAVING count(*) > 1"
        elif check == "accepted_values":
            values = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in args["values"])
            bad = f"SELECT 1 FROM {t} WHERE {c} NOT IN ({values})"
        elif check == "accepted_range":
            bad = f"SELECT 1 FROM {t} WHERE {c} NOT BETWEEN {args['low']} AND {args['high'] or '1e300'}"
        elif check == "relationships":
            bad = f"SELECT 1 FROM {t} ANTI JOIN {at.get(args['to'], args['to'])} USING ({c}) WHERE {c} IS NOT NULL"
        else:
            bad = single[check]
        parts.append(f"SELECT '{model}' AS model, '{check_label(check, cols, args)}' AS check_name, "
                     f"(SELECT count(*) FROM {t}) AS rows_checked, (SELECT count(*) FROM ({bad}) b) AS rows_failing")
    return "\nUNION ALL ".join(parts)


def _landing_sql() -> dict[str, str]:
    """The load path: what the documents say, straight from the tables."""
    q: dict[str, str] = {}
    stamp = f"{TS} AS _extracted_at"
    fits = "o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0"
    nulls = (lambda kind, *names: ", ".join(f"CAST(NULL AS {kind}) AS {n}" for n in names))
    q["doc_matches"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS match_id, if(o_orderkey % 3 > 0, '2', NULL) AS data_version,
  o_orderstatus AS platform_id, CAST(o_custkey % 500 AS INTEGER) AS queue_id,
  {nulls('VARCHAR', 'game_mode', 'game_type')}, {nulls('INTEGER', 'map_id', 'game_duration')},
  year(o_orderdate) || '.' || month(o_orderdate) AS game_version, {nulls('BIGINT', 'game_creation', 'game_end_timestamp')},
  epoch_ms(o_orderdate) AS game_start_timestamp, {stamp}
FROM orders WHERE {fits}"""
    zero = ["assists", "vision_score", "wards_placed", "turret_takedowns", "dragon_kills", "baron_kills"]
    empty = ["champ_level", "total_damage_dealt_to_champions", "total_damage_taken", "damage_dealt_to_objectives",
             "total_heal", "gold_earned", "gold_spent", "total_minions_killed", "neutral_minions_killed",
             "wards_killed", "vision_wards_bought_in_game", "time_played"]
    q["doc_participants"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS match_id, CAST(l_suppkey AS VARCHAR) AS puuid,
  CAST(l_linenumber AS INTEGER) AS participant_id, CAST(100 + 100 * (l_suppkey % 2) AS INTEGER) AS team_id,
  CAST(l_partkey % 50 AS INTEGER) AS champion_id, if(l_linestatus = 'F', CAST(l_quantity AS INTEGER), 0) AS kills,
  CAST(l_quantity AS INTEGER) % 7 AS deaths, l_linestatus = 'F' AS win,
  {", ".join(f"0 AS {n}" for n in zero)}, {nulls('INTEGER', *empty)},
  {nulls('VARCHAR', 'riot_id_game_name', 'riot_id_tagline', 'champion_name', 'team_position', 'individual_position', 'lane', 'role')},
  {nulls('BOOLEAN', 'game_ended_in_early_surrender', 'game_ended_in_surrender')}, {stamp}
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag <> 'R' AND {fits}"""
    q["doc_teams"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS match_id, CAST(team AS INTEGER) AS team_id, bool_or(l_linestatus = 'F') AS win,
  CAST(if(team = 100, count_if(l_returnflag = 'R'), 0) AS INTEGER) AS baron_kills,
  0 AS dragon_kills, 0 AS herald_kills, 0 AS inhibitor_kills,
  CAST(if(team = 100, count(*), 0) AS INTEGER) AS tower_kills, CAST(if(team = 100, count(*), 0) AS INTEGER) AS champion_kills,
  team = 100 AND count(*) > 1 AS first_blood, false AS first_tower, {stamp}
FROM (SELECT *, 100 + 100 * (l_suppkey % 2) AS team FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE {fits}) l
GROUP BY l_orderkey, team"""
    q["doc_bans"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS match_id, CAST(100 + 100 * (l_suppkey % 2) AS INTEGER) AS team_id,
  CAST(l_partkey % 50 - 1 AS INTEGER) AS champion_id, CAST(l_linenumber AS INTEGER) AS pick_turn, {stamp}
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' AND {fits}"""
    q["doc_summoners"] = f"""
SELECT CAST(s_suppkey AS VARCHAR) AS puuid, if(s_suppkey % 5 <> 0, s_name, NULL) AS game_name,
  if(s_suppkey % 5 <> 0 AND s_nationkey % 3 > 0, CAST(s_nationkey AS VARCHAR), NULL) AS tag_line, 'N1' AS platform,
  if(s_suppkey % 7 <> 0, CAST(floor(s_acctbal) AS INTEGER), NULL) AS summoner_level,
  if(s_suppkey % 7 <> 0, CAST(s_nationkey AS INTEGER), NULL) AS profile_icon_id, {nulls('BIGINT', 'revision_date')}, {stamp}
FROM supplier WHERE s_suppkey % 35 <> 0"""
    q["doc_mastery"] = f"""
SELECT CAST(l_suppkey AS VARCHAR) AS puuid, CAST(l_partkey % 50 AS INTEGER) AS champion_id, {nulls('INTEGER', 'champion_level')},
  CAST(count(*) AS INTEGER) AS champion_points, CAST(if(count(*) % 2 = 0, count(*), 0) AS INTEGER) AS tokens_earned,
  {nulls('BIGINT', 'last_play_time')}, {stamp}
FROM lineitem GROUP BY l_suppkey, l_partkey % 50"""
    q["doc_rejects"] = """
SELECT 'match' AS kind, if(o_orderkey % 97 = 0, 'not a JSON object', 'a field does not fit its type') AS reason,
  md5(substr('{"metadata":{"matchId":"' || o_orderkey || '"' || if(o_orderkey % 3 > 0, ',"dataVersion":"2"', '') || '},"info":{"platformId":', 1, 30)) AS line_md5
FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0"""
    q["doc_static"] = """
SELECT CAST(split_part(p_brand, '#', 2) AS INTEGER) AS champion_id, p_brand AS champion_key, p_brand AS champion_name,
  if(length(max(p_name)) % 2 = 0, max(p_name), '') AS champion_title, split_part(min(p_type), ' ', 1) AS primary_role,
  if(max(p_size) > 48, split_part(min(p_type), ' ', 2), '') AS secondary_role, '' AS resource_type, '9' AS data_dragon_version
FROM part GROUP BY p_brand"""
    landed = """
SELECT o_orderkey, o_custkey, if(o_custkey % 4 = 0, 'L', if(o_orderpriority = '1-URGENT', 'U', o_orderstatus)) AS o_orderstatus,
  o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, o_custkey, 'U', o_orderpriority FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_custkey % 4 <> 0"""
    q["landing_upsert"] = landed
    q["stream_upsert"] = """
SELECT o_orderkey, o_custkey, if(o_custkey % 4 = 0, 'L', if(o_orderpriority = '1-URGENT', 'U', o_orderstatus)) AS o_orderstatus,
  o_orderpriority FROM orders"""
    q["stored_snapshot"] = _with("SELECT * FROM snap2", *_snapshot_ctes())
    q["store_upsert"] = f"SELECT *, count(*) OVER () AS rows_stored FROM ({landed}) t"
    q["jsonl_rejects"] = """
SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'not a JSON object' WHEN o_orderkey % 13 = 0 THEN 'a field does not fit its type'
  ELSE 'good' END AS reason, o_orderkey AS k
FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 <> 0"""
    q["seed_roundtrip"] = _with("""SELECT * REPLACE (if(champion_title = '', champion_title,
  substr(champion_title, 1, 1) || ',"' || substr(champion_title, 2)) AS champion_title) FROM seed""")
    q["table_rebuild"] = "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment FROM customer WHERE c_nationkey < 10"
    q["entity_mart_read"] = _with("""
SELECT puuid, participant_key, kills, game_start_at, champion_name, match_id FROM perf
WHERE puuid = (SELECT puuid FROM dim_players ORDER BY matches_extracted DESC, puuid LIMIT 1)""")
    q["staging_views"] = _with("""
SELECT patch, count(*) AS n_teams, count_if(t.is_win) AS n_wins
FROM stg_teams t JOIN stg_matches m USING (match_id) GROUP BY patch""")
    return q
