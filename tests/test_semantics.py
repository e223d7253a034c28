"""Semantic traps between SQL engines (survey appendix A), pinned on Spark."""
from pyspark.sql import functions as F

from trendspark.functions import scalars as S
from trendspark.operators import staging
from trendspark.operators.baseline import unpivot_metrics
from trendspark.sources.schemas import RAW_TABLES


def test_null_propagating_display_id(spark):
    raw = spark.createDataFrame([("p1", "Alpha", None, "NA1", 1, 1, 1_726_000_000_123, "t")],
                                RAW_TABLES["raw_summoners"])
    r = staging.stage_summoners(raw).first()
    assert r["riot_id"] is None                                   # not 'Alpha#'
    assert r["profile_revised_at"].microsecond == 123_000         # milliseconds kept


def test_greatest_skips_null_and_division_by_zero_is_null(spark):
    r = spark.range(1).select(
        S.kda_adjusted(F.lit(2), F.lit(None).cast("int"), F.lit(1)).alias("a"),
        S.safe_divide(F.lit(1.0), F.lit(0.0)).alias("b")).first()
    assert (r.a, r.b) == (3.0, None)


def test_unpivot_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "id int, a double, b double")
    rows = {r["metric_name"]: r["metric_value"] for r in unpivot_metrics(df, ["id"], ["a", "b"]).collect()}
    assert rows == {"a": 2.0, "b": None}


def test_minutes_are_double_and_patch_of_short_version(spark):
    raw = spark.createDataFrame([("m", "2", "NA1", 420, "C", "M", 11, "14", 1, 2, None, 90, "t")],
                                RAW_TABLES["raw_matches"])
    r = staging.stage_matches(raw).first()
    assert r["game_duration_minutes"] == 1.5 and r["patch"] == "14." and r["game_end_at"] is None
