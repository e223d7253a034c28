import os

import pytest

from fixtures import write_jsonl
from trendspark.sources.io import read_jsonl, read_raw
from trendspark.sources.schemas import RAW_TABLES, TABLE_KEYS
from trendspark.sources.upsert import load_batch, read_table, upsert

SCHEMA = "k string, v int, note string"


def test_upsert_replaces_keys_and_keeps_batch_duplicates(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), (None, 3, "x")], SCHEMA)
    batch = spark.createDataFrame([("a", 10, "y"), ("a", 11, "y"), (None, 30, "y")], SCHEMA)
    out = sorted((tuple(r) for r in upsert(target, batch, ["k"]).collect()), key=repr)
    # 'a' replaced by both batch rows; the null key never matches, so both nulls stay
    assert out == sorted([("a", 10, "y"), ("a", 11, "y"), ("b", 2, "x"), (None, 3, "x"), (None, 30, "y")],
                         key=repr)


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x")], SCHEMA)
    batch = spark.createDataFrame([("b", 20, "y"), ("c", 30, "y")], SCHEMA)
    once = upsert(target, batch, ["k"])
    twice = upsert(once, batch, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_missing_column_null_extra_column_error(spark):
    target = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    narrow = spark.createDataFrame([("b", 2)], "k string, v int")
    assert upsert(target, narrow, ["k"]).where("k = 'b'").first()["note"] is None
    wide = spark.createDataFrame([("b", 2, "n", 9)], "k string, v int, note string, extra int")
    with pytest.raises(ValueError):
        upsert(target, wide, ["k"])
    assert "extra" in upsert(target, wide, ["k"], evolve=True).columns


def _buckets(root):
    return {d: sorted(f for f in os.listdir(os.path.join(base, d)) if f.endswith(".parquet"))
            for base, dirs, _ in os.walk(root) for d in dirs if d.startswith("_bucket=")}


def test_loads_one_after_another(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "table")
    b1 = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), (None, 3, "x")], SCHEMA)
    b2 = spark.createDataFrame([("b", 20, "y"), ("b", 21, "y")], SCHEMA)
    assert read_table(spark, root) is None
    assert load_batch(spark, root, spark.createDataFrame([], SCHEMA), ["k"], buckets=4) == 0 and read_table(spark, root) is None
    assert load_batch(spark, root, b1, ["k"], buckets=4) == 3
    assert load_batch(spark, root, b2, ["k"]) == 4
    assert load_batch(spark, root, b2, ["k"], buckets=9) == 4          # replay: same table, the table's own buckets
    assert sorted(map(tuple, read_table(spark, root).collect()), key=repr) == sorted(
        [("a", 1, "x"), ("b", 20, "y"), ("b", 21, "y"), (None, 3, "x")], key=repr)
    assert load_batch(spark, root, spark.createDataFrame([], SCHEMA), ["k"]) == 4
    assert set(_buckets(root)) <= {f"_bucket={i}" for i in range(4)}


def test_untouched_buckets_keep_their_files(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "table")
    load_batch(spark, root, spark.createDataFrame([(f"k{i}", i, "x") for i in range(200)], SCHEMA), ["k"], buckets=16)
    before = _buckets(root)
    assert load_batch(spark, root, spark.createDataFrame([("k7", 70, "y")], SCHEMA), ["k"]) == 200
    after = _buckets(root)
    assert len(before) == 16 and sum(before[b] != after[b] for b in before) == 1


def test_key_type_mismatch_loses_no_row(spark, tmpdir_path):
    """A batch whose keys have another type meets the stored rows' buckets."""
    root = os.path.join(tmpdir_path, "table")
    load_batch(spark, root, spark.range(200).selectExpr("id AS k", "id AS v"), ["k"], buckets=16)
    assert load_batch(spark, root, spark.createDataFrame([("007", 70)], "k string, v long"), ["k"]) == 200
    assert load_batch(spark, root, spark.createDataFrame([(8.0, 80)], "k double, v long"), ["k"]) == 200
    got = {r["k"]: r["v"] for r in read_table(spark, root).collect()}
    assert len(got) == 200 and got[7] == 70 and got[8] == 80 and all(got[i] == i for i in range(9, 200))


def test_new_columns_reach_all_buckets(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "table")
    load_batch(spark, root, spark.createDataFrame([(f"k{i}", i, "x") for i in range(40)], SCHEMA), ["k"], buckets=8)
    wide = spark.createDataFrame([("k1", 10, "y", 5)], SCHEMA + ", extra int")
    with pytest.raises(ValueError):
        load_batch(spark, root, wide, ["k"])
    assert load_batch(spark, root, wide, ["k"], evolve=True) == 40
    rows = {r["k"]: r for r in read_table(spark, root).collect()}
    assert rows["k1"]["extra"] == 5 and rows["k2"]["extra"] is None and len(rows) == 40
    assert load_batch(spark, root, spark.createDataFrame([("k2", 9)], "k string, v int"), ["k"]) == 40


def test_failed_load_leaves_the_table(spark, tmpdir_path):
    from pyspark.errors import PySparkException
    root = os.path.join(tmpdir_path, "table")
    load_batch(spark, root, spark.createDataFrame([("a", 1, "x"), ("b", 2, "x")], SCHEMA), ["k"])
    bad = spark.createDataFrame([("a", "1", "y"), ("c", "many", "y")], "k string, v string, note string")
    with pytest.raises(PySparkException):
        load_batch(spark, root, bad, ["k"])
    assert sorted(map(tuple, read_table(spark, root).collect())) == [("a", 1, "x"), ("b", 2, "x")]
    assert load_batch(spark, root, spark.createDataFrame([("c", 3, "y")], SCHEMA), ["k"]) == 3


def test_a_load_counts_what_it_writes(spark, tmpdir_path):
    """Of a batch that touches every bucket, nothing written is read again for the count."""
    root = os.path.join(tmpdir_path, "table")
    rows = spark.range(0, 500, 1, 2).selectExpr("cast(id AS string) AS k", "cast(id AS int) AS v", "'x' AS note")
    load_batch(spark, root, rows, ["k"], buckets=4)
    tracker = spark.sparkContext._jsc.sc().statusStore()
    before = tracker.jobsList(None).size()
    assert load_batch(spark, root, rows, ["k"]) == 500
    used = tracker.jobsList(None).size() - before
    assert used <= 8        # the schema, the stored bucket count, broadcasts and the write's own stages


def test_a_file_landing_meanwhile_is_in_neither(spark, tmpdir_path):
    """Rows and rejects come from one stored parse."""
    from trendspark.session import materialize
    from trendspark.sources.io import newest_landed, read_landed, rejected_lines
    path = os.path.join(tmpdir_path, "raw_summoners")
    os.makedirs(path)

    def land(name, key):
        with open(os.path.join(path, name), "w") as h:
            h.write('{"puuid": "%s"}\n{broken %s\n' % (key, key))
    land("a.jsonl", "p1")
    parsed = materialize(read_landed(spark, tmpdir_path, "raw_summoners"), "landed")
    assert [r["puuid"] for r in newest_landed(parsed, "raw_summoners").collect()] == ["p1"]
    land("b.jsonl", "p2")
    assert [(r["line"], r["reason"]) for r in rejected_lines(parsed).collect()] == [("{broken p1", "not a JSON object")]
    assert rejected_lines(read_landed(spark, tmpdir_path, "raw_summoners")).count() == 2


def test_row_set_does_not_depend_on_the_columns_read(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "raw_matches")
    os.makedirs(path)
    with open(os.path.join(path, "a.jsonl"), "w") as h:
        h.write('{"match_id": "good", "queue_id": 420}\n\n')
        h.write('{"match_id": "text", "queue_id": "abc"}\n')
        h.write('{"match_id": "large", "game_duration": 30000000000}\n')
        h.write("[1, 2]\n")
    df, bad = read_jsonl(spark, path, RAW_TABLES["raw_matches"], with_rejects=True)
    assert [r["match_id"] for r in df.collect()] == ["good"]
    assert [r["match_id"] for r in df.select("match_id").collect()] == ["good"] and df.count() == 1
    assert bad.count() == 3 and {r["reason"] for r in bad.collect()} == {
        "not a JSON object", "a field does not fit its type"}


def test_landing_twice_counts_once(spark, tmpdir_path):
    import time

    from fixtures import raw_tables, seed_rows
    from trendspark.plans.models import build_from_landing
    from trendspark.sources.io import write_seed
    from trendspark.sources.schemas import SEED_CHAMPIONS
    landing = os.path.join(tmpdir_path, "landing")
    for batch in ("a", "b"):
        for name, rows in raw_tables().items():
            os.makedirs(os.path.join(landing, name), exist_ok=True)
            write_jsonl(os.path.join(landing, name, f"{batch}.jsonl"), rows)
        time.sleep(0.05)
    with open(os.path.join(landing, "raw_matches", "b.jsonl"), "a") as h:
        h.write("{broken\n")
    seed = os.path.join(tmpdir_path, "seed")
    write_seed(spark.createDataFrame([tuple(r[f] for f in SEED_CHAMPIONS.fieldNames()) for r in seed_rows()], SEED_CHAMPIONS), seed)
    out = os.path.join(tmpdir_path, "marts")
    built = build_from_landing(spark, landing, seed, out)
    perf = spark.read.parquet(os.path.join(out, "fct_participant_performance"))
    assert perf.count() == 240 and perf.select("participant_key").distinct().count() == 240
    assert spark.read.parquet(os.path.join(out, "dim_matches")).count() == 28
    assert spark.read.parquet(os.path.join(out, "dim_players")).count() == 2
    assert spark.read.parquet(os.path.join(out, "rejects", "raw_matches")).count() == 1
    assert built["dim_champions"].count() == 3
    checks = {(r["model"], r["check_name"]): r["rows_failing"] for r in spark.read.parquet(os.path.join(out, "checks")).collect()}
    assert len(checks) > 90 and checks["raw_matches", "unique match_id"] == 0 and checks["stg_match_participants", "group_size"] == 0
    # the stored snapshot: unchanged on a second run, a changed champion opens a version
    from trendspark.plans.models import update_snapshot
    assert update_snapshot(spark, out, built["dim_champions"]).count() == 3
    changed = built["dim_champions"].selectExpr("* except (primary_role)", "if(champion_id = 86, 'Other', primary_role) as primary_role")
    assert update_snapshot(spark, out, changed.select(*built["dim_champions"].columns)).count() == 4


def test_jsonl_reader(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "raw_matches")
    os.makedirs(path)
    write_jsonl(os.path.join(path, "part.jsonl"), [{"match_id": "m1", "queue_id": 420}])
    with open(os.path.join(path, "part.jsonl"), "a") as h:
        h.write("{not json\n")
    good, bad = read_jsonl(spark, path, RAW_TABLES["raw_matches"], with_rejects=True)
    assert good.count() == 1 and bad.count() == 1
    assert good.first()["game_end_timestamp"] is None
    empty = read_raw(spark, tmpdir_path, "raw_match_bans")      # nothing landed
    assert empty.count() == 0 and empty.columns == RAW_TABLES["raw_match_bans"].fieldNames()
    assert TABLE_KEYS["raw_match_participants"] == ("match_id", "puuid")


def test_seed_csv_roundtrip(spark, tmpdir_path):
    from trendspark.sources.io import read_seed, write_seed
    from trendspark.sources.schemas import SEED_CHAMPIONS
    src = os.path.join(tmpdir_path, "seed.csv")
    with open(src, "w") as h:
        h.write("champion_id,champion_key,champion_name,champion_title,primary_role,secondary_role,"
                "resource_type,data_dragon_version\n")
        h.write("86,Garen,Garen,the Might,Fighter,,None,14.18.1\n")
        h.write("103,Ahri,Ahri,the Fox,Mage,Assassin,Mana,14.18.1\n")
    seed = read_seed(spark, src)
    garen = seed.where("champion_id = 86").first()
    assert garen["secondary_role"] is None and garen["resource_type"] == "None"
    out = os.path.join(tmpdir_path, "out")
    write_seed(seed, out)
    again = read_seed(spark, out, SEED_CHAMPIONS)
    assert sorted(r["champion_id"] for r in again.collect()) == [86, 103]
    files = sorted(f for f in os.listdir(out) if f.endswith(".csv"))
    ids = [r["champion_id"] for f in files for r in read_seed(spark, os.path.join(out, f), SEED_CHAMPIONS).collect()]
    assert ids == [86, 103]


def test_rebuild_keeps_no_old_partition(spark, tmpdir_path):
    from trendspark.sources.io import write_table
    root = os.path.join(tmpdir_path, "mart")
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], SCHEMA)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(df, root, ["note"])
        write_table(df.where("k = 'a'"), root, ["note"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r["k"] for r in spark.read.parquet(root).collect()] == ["a"]
