"""Only what a query reads is derived; large steps are dealt by their size; same rows either way."""
import re

import pytest
from pyspark.sql import functions as F

from trendspark.operators import flatten, joins, views
from trendspark.operators.sequence import sequence
from trendspark.operators.trends import rolling_trends
from trendspark.plans import driver, suite

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(df.toJSON().collect())


@pytest.fixture
def written(monkeypatch):
    """Labels of the tables stored while a query runs on an empty cache."""
    labels, keep = [], driver.materialize
    monkeypatch.setattr(driver, "_CACHE", {})
    monkeypatch.setattr(driver, "materialize", lambda df, label: labels.append(label) or keep(df, label))
    return labels


def test_only_the_tables_read_are_derived(spark, written):
    driver.QUERIES["dim_champions"](spark, SF).collect()
    assert written == ["champion_static"]
    driver.QUERIES["stg_teams"](spark, SF).count()
    driver.QUERIES["dim_matches"](spark, SF).count()
    assert sorted(written) == ["champion_static", "raw_match_teams", "raw_matches"]


def test_orphan_check_builds_no_mart(spark, written):
    driver.QUERIES["orphan_anti"](spark, SF).collect()
    assert sorted(written) == ["raw_match_bans", "raw_matches"]


def test_window_bound_check_builds_one_mart(spark, written):
    driver.QUERIES["dq_window_bound"](spark, SF).collect()
    assert [w for w in written if w.startswith("mart-")] == ["mart-champion"]


def _history(spark):
    rows = [(f"p{i % 7}", "c" if i % 2 else None, i, float(i * 37 % 11) if i % 5 else None, i % 3 == 0) for i in range(200)]
    return spark.createDataFrame(rows, "puuid string, champ string, t int, v double, is_win boolean")


def test_windows_take_partitions_of_the_size(spark, monkeypatch):
    def run():
        seq = sequence(_history(spark), ["puuid"], ["t"], group=["champ"], seq_out="seq", count_out="n",
                       group_seq_out="gs", group_count_out="gn")
        return rolling_trends(seq, ["puuid"], "seq", "n", ["v"])
    plain = _rows(run())
    monkeypatch.setattr(joins, "TASK_BYTES", 64)
    dealt = run()
    assert dealt.rdd.getNumPartitions() > joins.shuffle_partitions(spark)
    assert _rows(dealt) == plain


def test_series_rows_are_dealt_before_they_become_long(spark):
    rows = spark.createDataFrame(
        [("a", "all", 1, 1.0, 1.0, 2.0, None), ("a", "all", 2, 3.0, None, None, None), ("a", "x", 1, 1.0, 1.0, 5.0, 5.0),
         (None, "all", 1, 1.0, 1.0, 1.0, 1.0), (None, "all", 2, 1.0, 1.0, 1.0, 1.0)],
        "puuid string, view string, seq int, m double, m_rolling_avg double, k double, k_rolling_avg double")
    points = views.series_points(rows, ["m", "k"])
    assert {tuple(r) for r in points.collect()} == {("a", "all", "m", 1, 1.0, 1.0), ("a", "all", "m", 2, 3.0, None)}
    plan = points._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")      # the long rows are made above the join


def test_rejects_come_out_of_the_stored_parse(spark):
    lines = spark.createDataFrame([('{"metadata":{"matchId":"m1"}}',), ('{"metadata":',), (" ",), ('{"info":{"queueId":"x"}}',)], "value string")
    tables, rejects = flatten.flatten_documents(spark, {"match": lines}, "N1", "t")
    assert [r["match_id"] for r in tables["raw_matches"].collect()] == ["m1"]
    assert {(r["line"], r["reason"], r["kind"]) for r in rejects.collect()} == {
        ('{"metadata":', "not a JSON object", "match"), ('{"info":{"queueId":"x"}}', "a field does not fit its type", "match")}
    assert "from_json" not in rejects._jdf.queryExecution().optimizedPlan().toString()


def test_documents_of_other_kinds_are_not_parsed(spark, monkeypatch):
    from trendspark.plans import landing
    made, keep = [], flatten.materialize
    monkeypatch.setattr(driver, "_CACHE", {})
    monkeypatch.setattr(flatten, "materialize", lambda df, label: made.append(label) or keep(df, label))
    landing.q_doc_mastery(spark, SF).count()
    landing.q_doc_bans(spark, SF).count()
    landing.q_doc_participants(spark, SF).count()
    assert made == ["documents-mastery", "documents-match"]


def test_dealt_checks_equal_plain_ones(spark, monkeypatch, tmp_path):
    p = spark.range(300).select(F.concat(F.lit("k"), (F.col("id") % 290)).alias("participant_key"), (F.col("id") % 30).alias("match_id"),
                                F.when(F.col("id") % 9 > 0, F.col("id") % 11).alias("puuid"), F.lit(300).alias("team_id"),
                                (F.col("id") % 4).alias("champion_id"), F.lit(True).alias("is_win"), (F.col("id") - 3).alias("kills"),
                                F.lit(0).alias("deaths"), F.lit(0).alias("assists"))
    m = spark.range(25).select(F.col("id").alias("match_id"), F.lit(400).alias("queue_id"), F.lit("1.1").alias("patch"),
                               F.lit(1).alias("game_duration_seconds"))
    p.write.parquet(f"{tmp_path}/p")
    m.write.parquet(f"{tmp_path}/m")
    tables = {"stg_match_participants": spark.read.parquet(f"{tmp_path}/p"), "stg_matches": spark.read.parquet(f"{tmp_path}/m")}
    plain = _rows(suite.run_checks(tables))
    monkeypatch.setattr(joins, "TASK_BYTES", 16)
    dealt = suite.run_checks(tables)
    assert "RepartitionByExpression" in dealt._jdf.queryExecution().optimizedPlan().toString()
    assert _rows(dealt) == plain


@pytest.mark.parametrize("name", ["participant_performance", "match_deltas", "latest_value", "dq_negative", "dq_trend_coverage",
                                  "dq_failing_rows", "entity_mart_read", "player_range_view"])
def test_marts_read_in_one_pass_are_not_stored(spark, written, name):
    driver.QUERIES[name](spark, SF).count()
    assert {w for w in written if w.startswith("mart-")} <= {"mart-players"}


def test_suite_stores_only_what_several_models_read(spark, written):
    from trendspark.plans import landing
    landing.q_dq_suite(spark, SF).count()
    assert {w for w in written if w.startswith("mart-")} == {"mart-pm", "mart-players"}


def test_a_mart_that_is_stored_is_read(spark, written):
    driver.deltas_mart(spark, SF)
    driver.QUERIES["match_deltas"](spark, SF).count()
    plan = driver.QUERIES["match_deltas"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert written.count("mart-deltas") == 1 and "Window" not in plan


def test_stored_tables_leave_no_shuffle_files(spark):
    import time

    from trendspark.session import materialize
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = blocks.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}
    before, key = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    stored = materialize(spark.range(1000).selectExpr("id % 7 AS k").repartition(5, "k").groupBy("k").count(), "shuffled")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(key) == was
    assert stored.count() == 7


@pytest.mark.parametrize("task_bytes", [joins.TASK_BYTES, 64])
def test_metrics_meet_matches_and_totals_in_one_dealing(spark, monkeypatch, tmp_path, capsys, task_bytes):
    """Rows with a match, or a team, that is null or missing drop out; repeated matches repeat their participants."""
    from fixtures import raw_tables
    from trendspark.operators import metrics, staging
    from trendspark.sources.schemas import RAW_TABLES
    raw = {t: spark.createDataFrame(raw_tables()[t], RAW_TABLES[t]) for t in ("raw_matches", "raw_match_participants")}
    p, m = staging.stage_participants(raw["raw_match_participants"]), staging.stage_matches(raw["raw_matches"])
    odd = F.col("participant_id")
    p = (p.withColumn("team_id", F.when(odd != 3, F.col("team_id"))).withColumn("match_id", F.when(odd == 4, None).when(odd == 5, "none").otherwise(F.col("match_id"))))
    p.write.parquet(f"{tmp_path}/p")
    m.unionByName(m.limit(1)).write.parquet(f"{tmp_path}/m")
    p, m = spark.read.parquet(f"{tmp_path}/p"), spark.read.parquet(f"{tmp_path}/m")
    monkeypatch.setattr(joins, "TASK_BYTES", task_bytes)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = metrics.participant_metrics(p, m)
        rows, given = _rows(got), _rows(metrics.participant_metrics(p, m, metrics.team_totals(p)))
        got.explain("formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out.split("== Initial Plan ==")[-1]
    moved = [node for node in plan.split("\n\n") if re.match(r"\(\d+\) Exchange\n", node.lstrip("\n"))]
    assert moved and sum("participant_key#" in node for node in moved) == 1, moved      # the wide rows move once
    keep, twice = p.where("match_id IS NOT NULL AND team_id IS NOT NULL AND match_id <> 'none'"), m.groupBy("match_id").count()
    assert rows == given and len(rows) == keep.join(twice, "match_id").agg(F.sum("count")).first()[0]


def test_laid_out_marts_are_written_as_their_windows_left_them(spark, tmp_path):
    from trendspark.config import TrendConfig
    from trendspark.operators import marts
    from trendspark.plans import models
    seq = driver.player_sequence_table(spark, SF)
    by_player = models.laid_out_marts(seq)
    plain = {"fct_player_rolling_trends": marts.player_rolling_trends(seq), "fct_player_champion_trends": marts.player_champion_trends(seq),
             "fct_player_match_deltas": marts.player_match_deltas(seq)}
    assert models.laid_out_marts(seq, TrendConfig(chunk_rows=2)) == {} and list(by_player) == list(plain)
    paths = models.write_marts(by_player, str(tmp_path), dealt=tuple(by_player))
    for name, df in plain.items():
        stored = spark.read.parquet(paths[name])
        assert driver.normalise(stored).exceptAll(driver.normalise(df)).isEmpty() and stored.count() == df.count()
        files = stored.select("puuid", F.input_file_name().alias("f")).distinct()
        assert files.count() == files.select("puuid").distinct().count() and files.select("f").distinct().count() > 1
        runs = by_player[name].sortWithinPartitions("puuid")._jdf.queryExecution().executedPlan().toString()
        assert runs.count("Exchange") == 1 and "rangepartitioning" in runs
