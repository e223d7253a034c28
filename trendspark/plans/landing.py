"""Registered queries of the load path: documents, landed files, stored tables.

Documents are built from the driver tables as JSON lines with missing keys, empty and
missing arrays and absent objectives, some of them broken, and go through the library's
own parser and flattening. The IO queries write to the shared folder and read back.
"""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.operators import flatten, views
from trendspark.operators.joins import parts_for, spread
from trendspark.plans import driver, models, standins, suite
from trendspark.plans.driver import query
from trendspark.session import ensure_checkpoint_dir, shuffle_partitions
from trendspark.sources import io
from trendspark.sources.schemas import RAW_TABLES, STATIC_DOCUMENT
from trendspark.sources.upsert import load_batch, newest_per_key, read_table
from trendspark.streaming.ingest import start_ingest

STAMP = "2024-01-01T00:00:00+00:00"


def _folder(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "landing", f"{name}-{uuid.uuid4().hex}")


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def match_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON line per order; every 97th is cut short, every 89th has a text for a number.

    The lines of an order meet once, and its teams are made of them in its row."""
    lines = _table(spark, sf, "lineitem")
    parts = parts_for(lines)
    team = (F.lit(100) + 100 * (F.col("l_suppkey") % 2)).cast("int")
    returned = F.col("l_returnflag") == "R"
    player = F.when(~returned, F.struct(
        F.col("l_suppkey").cast("string").alias("puuid"), F.col("l_linenumber").alias("participantId"),
        team.alias("teamId"), (F.col("l_partkey") % 50).cast("int").alias("championId"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("int")).alias("kills"),
        (F.col("l_quantity").cast("int") % 7).alias("deaths"), (F.col("l_linestatus") == "F").alias("win")))
    ban = F.when(returned, F.struct((F.col("l_partkey") % 50 - 1).cast("int").alias("championId"),
                                    F.col("l_linenumber").alias("pickTurn")))
    dealt = spread(lines.select("l_orderkey", team.alias("team"), player.alias("player"), ban.alias("ban"),
                                (F.col("l_linestatus") == "F").alias("won"), returned.alias("returned")), parts, "l_orderkey")
    teams = dealt.groupBy("l_orderkey", "team").agg(
        F.collect_list("player").alias("players"), F.collect_list("ban").alias("bans"),
        F.count_if("returned").cast("int").alias("r"), F.count("*").cast("int").alias("n"),
        F.bool_or("won").alias("win"))
    none = F.lit(None).cast("boolean")
    objectives = F.map_from_entries(F.filter(F.array(
        F.when(F.col("r") > 0, F.struct(F.lit("baron"), F.struct(F.lit(True).alias("first"), F.col("r").alias("kills")))),
        F.struct(F.lit("tower"), F.struct(none.alias("first"), F.col("n").alias("kills"))),
        F.struct(F.lit("champion"), F.struct((F.col("n") > 1).alias("first"), F.col("n").alias("kills")))),
        lambda e: e.isNotNull()))
    team = F.struct(F.col("team").alias("teamId"), "win",
                    F.when(F.col("team") == 100, objectives).alias("objectives"), "bans")
    per_order = teams.groupBy("l_orderkey").agg(F.flatten(F.collect_list("players")).alias("p"),
                                                F.collect_list(team).alias("t"))
    o = spread(_table(spark, sf, "orders"), parts, "o_orderkey").join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    start = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    doc = F.struct(
        F.struct(F.col("o_orderkey").cast("string").alias("matchId"),
                 F.when(F.col("o_orderkey") % 3 > 0, F.lit("2")).alias("dataVersion")).alias("metadata"),
        F.struct(F.col("o_orderstatus").alias("platformId"), (F.col("o_custkey") % 500).cast("int").alias("queueId"),
                 F.concat_ws(".", F.year("o_orderdate"), F.month("o_orderdate")).alias("gameVersion"),
                 start.alias("gameStartTimestamp"), F.when(F.size("p") > 0, F.col("p")).alias("participants"),
                 F.col("t").alias("teams")).alias("info"))
    text = F.to_json(doc)
    broken = (F.when(F.col("o_orderkey") % 97 == 0, F.substring(text, 1, 30))
              .when(F.col("o_orderkey") % 89 == 0, F.regexp_replace(text, '"queueId":[0-9]+', '"queueId":"x"'))
              .otherwise(text))
    return o.select(broken.alias("value"))


def _accounts(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "supplier").where("s_suppkey % 5 <> 0").select(F.to_json(F.struct(
        F.col("s_suppkey").cast("string").alias("puuid"), F.col("s_name").alias("gameName"),
        F.when(F.col("s_nationkey") % 3 > 0, F.col("s_nationkey").cast("string")).alias("tagLine"))).alias("value"))


def _profiles(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "supplier").where("s_suppkey % 7 <> 0").select(F.to_json(F.struct(
        F.col("s_suppkey").cast("string").alias("puuid"), F.col("s_nationkey").cast("int").alias("profileIconId"),
        F.floor("s_acctbal").cast("int").alias("summonerLevel"))).alias("value"))


def _mastery(spark: SparkSession, sf: str) -> DataFrame:
    return (_table(spark, sf, "lineitem").groupBy("l_suppkey", (F.col("l_partkey") % 50).alias("c"))
            .agg(F.count("*").cast("int").alias("n"))
            .select(F.to_json(F.struct(
                F.col("l_suppkey").cast("string").alias("puuid"), F.col("c").cast("int").alias("championId"),
                F.col("n").alias("championPoints"),
                F.when(F.col("n") % 2 == 0, F.col("n")).alias("tokensEarned"))).alias("value")))


_DOCUMENT_LINES = {"match": match_documents, "account": _accounts, "summoner": _profiles, "mastery": _mastery}
_PLAYER = ("account", "summoner")


def _documents(spark: SparkSession, sf: str, *kinds: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables and rejects of some kinds of documents, parsed when a query first reads those kinds."""
    key = driver._key(spark, sf, f"documents-{kinds}")
    if key not in driver._CACHE:
        lines = {kind: _DOCUMENT_LINES[kind](spark, sf) for kind in kinds}
        driver._CACHE[key] = flatten.flatten_documents(spark, lines, "N1", STAMP)
    return driver._CACHE[key]


@query("doc_matches")
def q_doc_matches(spark, sf):
    """Match header rows of the documents."""
    return _documents(spark, sf, "match")[0]["raw_matches"]


@query("doc_participants")
def q_doc_participants(spark, sf):
    """Participants with count defaults; missing arrays give no rows."""
    return _documents(spark, sf, "match")[0]["raw_match_participants"]


@query("doc_teams")
def q_doc_teams(spark, sf):
    """Teams with objectives looked up by name, defaults where absent."""
    return _documents(spark, sf, "match")[0]["raw_match_teams"]


@query("doc_bans")
def q_doc_bans(spark, sf):
    """Bans, two levels deep; empty arrays give no rows."""
    return _documents(spark, sf, "match")[0]["raw_match_bans"]


@query("doc_summoners")
def q_doc_summoners(spark, sf):
    """Account and profile documents combined, either of them missing for some."""
    return _documents(spark, sf, *_PLAYER)[0]["raw_summoners"]


@query("doc_mastery")
def q_doc_mastery(spark, sf):
    """Mastery entries, tokens 0 where missing."""
    return _documents(spark, sf, "mastery")[0]["raw_champion_mastery"]


@query("doc_rejects")
def q_doc_rejects(spark, sf):
    """Document lines that are no JSON or do not fit, with their reasons."""
    rejects = [_documents(spark, sf, *kinds)[1] for kinds in (("match",), _PLAYER, ("mastery",))]
    return reduce(DataFrame.unionByName, rejects).select("kind", "reason", F.md5(F.substring("line", 1, 30)).alias("line_md5"))


@query("doc_static")
def q_doc_static(spark, sf):
    """The map-of-struct static document of all brands to seed rows."""
    p = _table(spark, sf, "part")
    brand = p.groupBy("p_brand").agg(F.max("p_name").alias("title"), F.max("p_size").alias("size"), F.min("p_type").alias("kind"))
    entry = F.struct(
        F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("key"), F.col("p_brand").alias("id"),
        F.col("p_brand").alias("name"), F.when(F.length("title") % 2 == 0, F.col("title")).alias("title"),
        F.when(F.col("size") > 48, F.split("kind", " ")).otherwise(F.slice(F.split("kind", " "), 1, 1)).alias("tags"))
    doc = brand.agg(F.to_json(F.struct(  # one entry per brand
        F.lit("9").alias("version"), F.map_from_entries(F.collect_list(F.struct("p_brand", entry))).alias("data"))).alias("value"))
    good, _ = io.parse_lines(doc, STATIC_DOCUMENT)
    return flatten.static_champion_rows(good)


def _order_batches(spark: SparkSession, sf: str) -> list[DataFrame]:
    o = _table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    urgent = o.where("o_orderpriority = '1-URGENT'").withColumn("o_orderstatus", F.lit("U"))
    late = o.where("o_custkey % 4 = 0").withColumn("o_orderstatus", F.lit("L"))
    return [o, urgent.unionByName(urgent), late]


@query("landing_upsert")
def q_landing_upsert(spark, sf):
    """Three batches landed as JSON Lines, the second with repeated rows and landed
    twice, read in landing order and upserted by key."""
    root = _folder(spark, "orders")
    batches = _order_batches(spark, sf)
    schema = batches[0].schema
    for i, batch in enumerate([batches[0], batches[1], batches[1], batches[2]]):
        io.write_jsonl(batch, f"{root}/batch={i}")
    rows = spark.read.text(f"{root}").select(
        "value", F.lit(0).alias("_landed"), F.col("_metadata.file_path").alias("_path"))
    # a batch is a folder here, so its number orders it
    good, _ = io.parse_lines(rows.withColumn("_file", F.regexp_extract("_path", "batch=([0-9]+)", 1)).drop("_path"), schema)
    return newest_per_key(good, ["o_orderkey"], ["_landed", "_file"]).drop("_landed", "_file")


@query("store_upsert")
def q_store_upsert(spark, sf):
    """The batches loaded one after another into the table of key buckets, the last with text keys."""
    root = _folder(spark, "store")
    batches = _order_batches(spark, sf)
    batches[2] = batches[2].withColumn("o_orderkey", F.format_string("%09d", "o_orderkey"))
    for batch in batches:
        rows = load_batch(spark, root, batch, ["o_orderkey"], buckets=8)
    return read_table(spark, root).withColumn("rows_stored", F.lit(rows).cast("long"))


class _Lost(RuntimeError):
    """A run that is lost before its micro-batch counts as done."""


@query("stored_snapshot")
def q_stored_snapshot(spark, sf):
    """Three runs of the stored history, closed versions apart from open ones."""
    root = _folder(spark, "snapshot")
    runs, key, checks = driver.snapshot_runs(spark, sf)
    for source, now in runs:
        history = models.store_snapshot(spark, root, source, key, checks, now)
    return history


@query("stream_upsert")
def q_stream_upsert(spark, sf):
    """§2.11: the batches landed as files and upserted by streams with one checkpoint; the second
    run is lost after its load, so the third replays its micro-batch and then takes the rest."""
    root = _folder(spark, "stream")
    batches = _order_batches(spark, sf)
    batches[1] = batches[1].distinct()      # a batch's files follow one another, so its keys are in one of them only

    def land(i: int) -> None:
        io.write_jsonl(batches[i], f"{root}/landing/batch={i}")

    def run(on_batch=None) -> None:
        # a file of a batch is a micro-batch's at least: batches land one after another
        start_ingest(spark, f"{root}/landing/*", f"{root}/table", batches[0].schema, ["o_orderkey"],
                     on_batch=on_batch).awaitTermination()

    def lost(batch_id: int, rows: int) -> None:
        raise _Lost(f"micro-batch {batch_id} of {rows} rows")
    land(0)
    run()
    land(1)
    try:
        run(lost)
    except Exception as failed:
        if "_Lost" not in str(failed):
            raise
    land(2)
    run()       # the replayed micro-batch
    run()       # nothing is left
    return read_table(spark, f"{root}/table")


@query("jsonl_rejects")
def q_jsonl_rejects(spark, sf):
    """Landed order lines, some broken; rows that fit and rejects by reason."""
    root = _folder(spark, "rejects")
    o = _table(spark, sf, "orders")
    text = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderpriority"))
    line = (F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("{"), text))
            .when(F.col("o_orderkey") % 13 == 0, F.regexp_replace(text, '"o_custkey":[0-9]+', '"o_custkey":"many"'))
            .when(F.col("o_orderkey") % 17 == 0, F.lit(" ")).otherwise(text))
    o.select(line.alias("value")).write.text(root)
    good, bad = io.read_jsonl(spark, root, o.select("o_orderkey", "o_custkey", "o_orderpriority").schema, with_rejects=True)
    none = io.read_jsonl(spark, root + "-nothing-landed", good.schema)
    kept = good.unionByName(none).select(F.lit("good").alias("reason"), F.col("o_orderkey").alias("k"))
    return kept.unionByName(bad.select("reason", F.regexp_extract("line", '"o_orderkey":([0-9]+)', 1).cast("long").alias("k")))


@query("seed_roundtrip")
def q_seed_roundtrip(spark, sf):
    """The seed written as ordered CSV files and read with its schema."""
    root = _folder(spark, "seed")
    io.write_seed(standins.seed_champions(spark, sf).withColumn("champion_title", F.regexp_replace("champion_title", "^(.)", '$1,"')), root)
    return io.read_seed(spark, root)


@query("table_rebuild")
def q_table_rebuild(spark, sf):
    """A partitioned table rebuilt from fewer rows keeps no old partition."""
    root = _folder(spark, "rebuild")
    c = _table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    io.write_table(c, root, ["c_nationkey"])
    io.write_table(c.where("c_nationkey < 10"), root, ["c_nationkey"])
    return spark.read.parquet(root).select("c_custkey", F.col("c_nationkey").cast("long").alias("c_nationkey"), "c_mktsegment")


@query("entity_mart_read")
def q_entity_mart_read(spark, sf):
    """The stored performance fact of the player with most matches, in display
    order; the mart is laid out by player."""
    root = _folder(spark, "performance")
    io.write_entity_table(driver.perf_mart(spark, sf), root, "puuid", ["game_start_at"])
    top = views.top_entity(driver.players_mart(spark, sf)).first()[0]
    return views.entity_rows(spark.read.parquet(root), top, ["participant_key", "kills", "game_start_at"],
                             order=["champion_name", "match_id"])


CHOSEN = ["kill_participation", "gold_per_minute", "no_such_metric"]


@query("player_range_view")
def q_player_range_view(spark, sf):
    """The last 20 rows of every view of one player, with a chosen list of metrics, from stored marts."""
    root = _folder(spark, "trends")
    made = {"fct_player_rolling_trends": driver.rolling_mart(spark, sf, store=False),
            "fct_player_champion_trends": driver.champion_mart(spark, sf, store=False)}
    by_player = {name: mart for name, mart in models.laid_out_marts(driver.player_sequence_table(spark, sf)).items() if name in made}
    stored = models.write_marts(made | by_player, root, dealt=tuple(by_player))
    rolling, per_champion = [spark.read.parquet(p) for p in stored.values()]
    top = views.top_entity(driver.players_mart(spark, sf).join(rolling, "puuid", "left_semi")).first()[0]
    found = views.entity_slice(rolling, per_champion, top, 20, CHOSEN)
    return found.select("puuid", "view", "seq", "total", *[f"{m}_rolling_avg" for m in views.select_metrics(CHOSEN)])


@query("build_landing")
def q_build_landing(spark, sf):
    """Raw tables landed as JSON Lines, one of them twice and with broken lines,
    and the seed CSV, built into stored marts; rows and sums of each, the rejects and the failing checks."""
    root = _folder(spark, "build")
    sources = driver.sources(spark, sf)
    for name in RAW_TABLES:
        # a key's rows lie in one file, which is what landing order compares
        whole = sources[name]
        if "match_id" in whole.columns:
            whole = whole.repartition(max(parts_for(whole), shuffle_partitions(spark)), "match_id")
        io.write_jsonl(whole, f"{root}/landing/{name}/batch=0", compression="gzip")
    again = sources["raw_matches"].select(F.to_json(F.struct("*")).alias("value"))
    again.unionByName(again.select(F.substring("value", 1, 20).alias("value"))).write.text(
        f"{root}/landing/raw_matches/batch=1", compression="gzip")
    io.write_seed(sources["champion_static"], f"{root}/seed")
    models.build_from_landing(spark, f"{root}/landing", f"{root}/seed", f"{root}/marts")

    def rows(name: str, *columns: str) -> DataFrame:
        stored = spark.read.parquet(f"{root}/marts/{name}")
        values = [F.sum(F.col(c).cast("double")) for c in columns]
        total = values[0] if values else F.lit(0.0)
        return stored.agg(F.count("*").alias("n"), F.coalesce(total, F.lit(0.0)).alias("total")).select(F.lit(name).alias("item"), "n", "total")
    out = [rows("dim_matches", "game_duration_seconds"), rows("dim_players", "matches_extracted"), rows("dim_champions", "champion_id"),
           rows("fct_participant_performance", "kills"), rows("fct_player_rolling_trends", "match_sequence_number"),
           rows("fct_player_champion_trends", "champion_match_sequence_number"), rows("fct_champion_meta", "matches_picked"),
           rows("rejects/raw_matches"), rows(models.SNAPSHOT, "champion_id")]
    return reduce(DataFrame.unionByName, out)


@query("staging_views")
def q_staging_views(spark, sf):
    """Staging models as named views, read by SQL."""
    models.create_views(driver.staged(spark, sf))
    return spark.sql("""
        SELECT m.patch, count(*) AS n_teams, count_if(t.is_win) AS n_wins
        FROM stg_matches m JOIN stg_match_teams t ON t.match_id = m.match_id GROUP BY m.patch""")


@query("dq_suite")
def q_dq_suite(spark, sf):
    """Q1-Q14: every declared check over the seed, raw tables, staging models, intermediates and marts, in one job."""
    s = driver.staged(spark, sf)
    driver.pm_mart(spark, sf)       # stored once, as the sequence, the players and two checked models read it
    sources = {name: df for name, df in driver.sources(spark, sf).items() if name in {m for m, *_ in suite.CHECKS}}
    tables = sources | models.staging_models(s) | {
        "int_match_team_totals": driver.q_team_totals(spark, sf),
        "int_participant_metrics": driver.pm_mart(spark, sf),
        "int_player_match_sequence": driver.player_sequence_table(spark, sf),
        "int_champion_match_appearances": driver.q_champion_appearances(spark, sf),
        "dim_champions": s.champions, "dim_players": driver.players_mart(spark, sf),
        "dim_matches": driver.q_dim_matches(spark, sf), "fct_participant_performance": driver.perf_mart(spark, sf),
        "fct_player_rolling_trends": driver.rolling_mart(spark, sf, store=False),
        "fct_player_champion_trends": driver.champion_mart(spark, sf, store=False),
        "fct_player_match_deltas": driver.deltas_mart(spark, sf, store=False), "fct_champion_meta": driver.q_champion_meta(spark, sf),
    }
    return suite.run_checks(tables)
