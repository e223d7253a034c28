import pytest

from trendspark.operators import views


def test_select_metrics():
    assert views.select_metrics() == ["cs_per_minute", "gold_per_minute", "damage_per_minute",
                                      "kda_ratio_perfect_adjusted", "kill_participation", "damage_share"]
    assert views.select_metrics(["damage_share", "nope", "cs_per_minute"]) == ["cs_per_minute", "damage_share"]
    with pytest.raises(ValueError):
        views.select_metrics(["nope"])


def test_range_options(spark):
    totals = spark.createDataFrame([("u", 21), ("v", 10), ("w", 1000)], "view string, total long")
    got = {}
    for r in views.range_options(totals).collect():
        got.setdefault(r["view"], []).append(r["range_n"])
    assert got == {"u": [10, 20], "w": [10, 20, 50, 100]}


def test_champion_groups(spark):
    rows = [("p", "Brook")] * 7 + [("p", "Ember")] * 9 + [("p", "Quill")] * 9 + [("p", "Rook")] * 3 + [("p", "")] * 6
    df = spark.createDataFrame(rows, "puuid string, champion_name string")
    got = [(r["label"], r["games"]) for r in views.champion_groups(df).orderBy("option_order").collect()]
    assert got == [("Ember", 9), ("Quill", 9), ("Brook", 7), ("—", 6)]


def test_last_n_when_a_label_covers_two_ids(spark):
    # two ids, each numbered 1..10, share one label: the view has 20 rows
    rows = [("p", "x", i, k * 100 + i) for k in (1, 2) for i in range(1, 11)]
    df = spark.createDataFrame(rows, "puuid string, view string, seq long, match_sequence_number long")
    assert views.last_n(df, 30).count() == 20
    assert sorted(r["seq"] for r in views.last_n(df, 4).collect()) == [9, 9, 10, 10]


def test_axis_bounds_of_ranges(spark):
    pts = spark.createDataFrame([("p", "all", "m", i, float(100 - i), None) for i in range(1, 31)],
                                "puuid string, view string, metric string, x long, raw double, roll double")
    ranged = views.range_points(pts)
    keys = ["puuid", "view", "metric", "range_n"]
    got = {r["range_n"]: (r["axis_lo"], r["axis_hi"]) for r in views.axis_bounds(ranged, keys, pad=0.0).collect()}
    assert got == {0: (70.0, 99.0), 10: (70.0, 79.0), 20: (70.0, 89.0), 50: (70.0, 99.0), 100: (70.0, 99.0)}


def test_last_n_and_series(spark):
    rows = [("p", "all", i, 1.0 * i, None if i == 3 else 2.0 * i, f"2024-01-{i:02d}") for i in range(1, 31)]
    df = spark.createDataFrame(rows, "puuid string, view string, seq long, m double, m_rolling_avg double, d string")
    df = df.selectExpr("*", "cast(d as date) as game_date", "seq as match_sequence_number")
    sliced = views.last_n(views.with_totals(df), 10)
    assert sorted(r["seq"] for r in sliced.collect()) == list(range(21, 31))
    summary = views.range_summary(sliced).first()
    assert (summary["shown"], summary["total"], summary["first_date"], summary["last_date"]) == \
        (10, 30, "2024-01-21", "2024-01-30")
    pts = views.series_points(df, ["m"])
    assert pts.count() == 30 and pts.where("roll is null").count() == 1    # null rolling kept
    latest = views.latest_rolling(pts).first()
    assert (latest["latest_roll"], latest["latest_x"]) == (60.0, 30)
    b = views.axis_bounds(pts).first()
    assert b["axis_lo"] == 0.0 and abs(b["axis_hi"] - (60 + 59 * 0.12)) < 1e-9


def test_entity_rows_pushdown(spark, tmpdir_path):
    import os
    path = os.path.join(tmpdir_path, "mart")
    spark.createDataFrame([("p", "Zed", 2, 1.0), ("p", "Ahri", 1, 2.0), ("q", "Ahri", 1, 3.0)],
                          "puuid string, champion_name string, match_sequence_number long, m double") \
        .write.parquet(path)
    df = views.entity_rows(spark.read.parquet(path), "p", ["m"])
    assert [(r["champion_name"], r["m"]) for r in df.collect()] == [("Ahri", 2.0), ("Zed", 1.0)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(puuid,p)" in plan          # the predicate reaches the parquet scan


def test_one_player_is_read_from_few_row_groups(spark, tmpdir_path):
    """A mart laid out by player: a read of one player can skip all but one file; a player with very many rows spans several."""
    import glob
    import os

    import pyarrow.parquet as pq

    from trendspark.operators import views
    from trendspark.sources.io import write_entity_table
    rows = spark.range(6000).selectExpr("IF(id % 3 = 0, 'hot', concat('p', id % 200)) AS puuid", "id AS match_id", "'c' AS champion_name",
                                        "timestamp_seconds(id) AS game_start_at").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # small rows, several files
    try:
        write_entity_table(rows, os.path.join(tmpdir_path, "mart"), "puuid", ["game_start_at"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = glob.glob(os.path.join(tmpdir_path, "mart", "*.parquet"))

    def holding(player):
        stats = [pq.ParquetFile(f).metadata.row_group(g).column(0).statistics for f in files for g in range(pq.ParquetFile(f).num_row_groups)]
        return sum(s.min <= player <= s.max for s in stats)
    assert len(files) == 4 and holding("p77") == 1 and holding("p151") == 1 and 2 <= holding("hot") <= 3
    stored = spark.read.parquet(os.path.join(tmpdir_path, "mart"))
    found = views.entity_rows(stored, "p77", ["match_id"], order=["champion_name", "game_start_at"])
    assert "EqualTo(puuid,p77)" in found._jdf.queryExecution().executedPlan().toString()
    assert [r["match_id"] for r in found.collect()] == [i for i in range(6000) if i % 3 and i % 200 == 77]
