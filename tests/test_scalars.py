import hashlib

from pyspark.sql import functions as F

from trendspark.config import SURROGATE_NULL_TOKEN
from trendspark.functions import scalars as S


def _one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_safe_divide_and_per_minute(spark):
    r = _one(spark, S.safe_divide(F.lit(3), F.lit(0)).alias("a"),
             S.safe_divide(F.lit(3), F.lit(None).cast("int")).alias("b"),
             S.safe_divide(F.lit(3), F.lit(2)).alias("c"),
             S.per_minute(F.lit(10), F.lit(0.5)).alias("d"),
             S.per_minute(F.lit(10), F.lit(2.0)).alias("e"))
    assert (r.a, r.b, r.c, r.d, r.e) == (None, None, 1.5, None, 5.0)


def test_patch_and_queue(spark):
    r = _one(spark, S.patch_from_version(F.lit("14.18.615.9137")).alias("a"),
             S.patch_from_version(F.lit("14")).alias("b"),
             S.patch_from_version(F.lit(None).cast("string")).alias("c"),
             S.queue_name(F.lit(420)).alias("d"), S.queue_name(F.lit(999)).alias("e"),
             S.queue_name(F.lit(None).cast("int")).alias("f"))
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == ("14.18", "14.", None, "Ranked Solo/Duo", "Other", "Other")


def test_surrogate_key_matches_md5_of_joined_text(spark):
    r = _one(spark, S.surrogate_key(F.lit("NA1_1"), F.lit("p1")).alias("a"),
             S.surrogate_key(F.lit("NA1_1"), F.lit(None).cast("string")).alias("b"))
    assert r.a == hashlib.md5(b"NA1_1-p1").hexdigest()
    assert r.b == hashlib.md5(f"NA1_1-{SURROGATE_NULL_TOKEN}".encode()).hexdigest()


def test_kda(spark):
    r = _one(spark, S.kda_strict(F.lit(5), F.lit(0), F.lit(3)).alias("a"),
             S.kda_adjusted(F.lit(5), F.lit(0), F.lit(3)).alias("b"),
             S.kda_adjusted(F.lit(5), F.lit(4), F.lit(3)).alias("c"))
    assert (r.a, r.b, r.c) == (None, 8.0, 2.0)


def test_split_identifier(spark):
    cases = ["Faker#KR1", "  Faker  #  KR1 ", "NoHash", "#KR1", "Faker#", "a#b#c", None]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    name, tag, ok = S.split_identifier("t")
    got = [(r.n, r.g, r.ok) for r in df.select(name.alias("n"), tag.alias("g"), ok.alias("ok")).collect()]
    assert got == [("Faker", "KR1", True), ("Faker", "KR1", True), (None, None, False),
                   (None, None, False), (None, None, False), ("a", "b#c", True), (None, None, False)]
