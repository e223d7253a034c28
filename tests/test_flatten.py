import json
import os

from pyspark.sql import functions as F

from fixtures import EMPTY_DOCUMENTS, MATCH_DOCUMENT
from trendspark.operators import flatten
from trendspark.sources import schemas


def _docs(spark, tmpdir_path, docs, schema=schemas.MATCH_DOCUMENT):
    path = os.path.join(tmpdir_path, "docs.jsonl")
    with open(path, "w") as h:
        for d in docs:
            h.write(json.dumps(d) + "\n")
    return spark.read.schema(schema).json(path)


def test_participant_row_golden(spark, tmpdir_path):
    rows = flatten.participant_rows(_docs(spark, tmpdir_path, [MATCH_DOCUMENT]), "t").collect()
    assert len(rows) == 1
    r = rows[0].asDict()
    assert (r["match_id"], r["kills"], r["deaths"], r["assists"]) == ("XY7_900", 2, 9, 15)
    assert (r["total_minions_killed"], r["neutral_minions_killed"]) == (61, 5)
    assert r["turret_takedowns"] == 0          # absent count -> 0
    assert r["wards_killed"] == 6              # present, not a defaulted column
    assert r["_extracted_at"] == "t"


def test_team_objectives_and_bans(spark, tmpdir_path):
    docs = _docs(spark, tmpdir_path, [MATCH_DOCUMENT])
    teams = {r["team_id"]: r for r in flatten.team_rows(docs, "t").collect()}
    full = teams[200]
    assert (full["dragon_kills"], full["inhibitor_kills"], full["champion_kills"], full["tower_kills"]) == (3, 2, 13, 4)
    assert full["first_blood"] is False and full["first_tower"] is True
    assert (full["baron_kills"], full["herald_kills"]) == (0, 0)
    bare = teams[100]
    assert (bare["dragon_kills"], bare["champion_kills"], bare["first_blood"]) == (0, 0, False)
    bans = [r["champion_id"] for r in flatten.ban_rows(docs, "t").orderBy("pick_turn").collect()]
    assert bans == [12, -1, 40]                   # declined ban kept at this layer


def test_match_row_missing_end(spark, tmpdir_path):
    r = flatten.match_rows(_docs(spark, tmpdir_path, [MATCH_DOCUMENT]), "t").first()
    assert r["game_end_timestamp"] is None
    assert r["game_version"] == "7.2.31.4" and r["queue_id"] == 440


def test_empty_documents_give_no_rows(spark, tmpdir_path):
    docs = _docs(spark, tmpdir_path, EMPTY_DOCUMENTS)
    out = flatten.flatten_matches(docs, "t")
    assert out["raw_matches"].count() == 3
    for t in ("raw_match_participants", "raw_match_teams", "raw_match_bans"):
        assert out[t].count() == 0


def test_static_champions(spark, tmpdir_path):
    doc = {"version": "7.2.0", "data": {
        "Brook": {"key": "31", "id": "Brook", "name": "Brook of Stone", "title": "slow water",
                  "tags": ["Guard", "Healer", "Walker"], "partype": "Tide"},
        "Ember": {"key": "5", "id": "Ember", "name": "Ember", "tags": ["Caster"]},
        "Quill": {"key": "77", "id": "Quill", "name": "Quill", "tags": None, "partype": "Ink"}}}
    rows = {r["champion_id"]: r for r in
            flatten.static_champion_rows(_docs(spark, tmpdir_path, [doc], schemas.STATIC_DOCUMENT)).collect()}
    assert rows[31]["primary_role"] == "Guard" and rows[31]["secondary_role"] == "Healer"
    assert rows[5]["secondary_role"] == "" and rows[5]["champion_title"] == ""
    assert rows[77]["primary_role"] == "" and rows[77]["data_dragon_version"] == "7.2.0"


def test_one_stamp_in_utc(spark, tmpdir_path):
    lines = {"match": spark.createDataFrame([(json.dumps(MATCH_DOCUMENT),), ("{oops",)], "value string"),
             "mastery": spark.createDataFrame([('{"puuid": "p", "championId": "one"}',)], "value string")}
    tables, rejects = flatten.flatten_documents(spark, lines, "XY7")
    stamps = {r["_extracted_at"] for t in tables.values() for r in t.collect()}
    assert len(stamps) == 1 and stamps.pop().endswith("+00:00")
    assert set(tables) == set(schemas.RAW_TABLES) and tables["raw_summoners"].count() == 0
    assert sorted((r["kind"], r["reason"]) for r in rejects.collect()) == [
        ("mastery", "a field does not fit its type"), ("match", "not a JSON object")]


def test_summoner_and_mastery(spark):
    acc = spark.createDataFrame([("p1", "Alpha", "NA1"), ("", "Beta", "EUW")], schemas.ACCOUNT_DOCUMENT)
    summ = spark.createDataFrame([("p1", 300, 1, 5), ("", 10, 2, 6)], schemas.SUMMONER_DOCUMENT)
    rows = flatten.summoner_rows(acc.withColumn("k", F.col("gameName")),
                                 summ.withColumn("k", F.when(F.col("summonerLevel") == 300, "Alpha").otherwise("Beta")),
                                 "NA1", "t", account_key="k", summoner_key="k").collect()
    by_name = {r["game_name"]: r for r in rows}
    assert by_name["Alpha"]["puuid"] == "p1" and by_name["Alpha"]["summoner_level"] == 300
    assert by_name["Beta"]["puuid"] == ""      # both empty: first non-empty is none -> the profile's ''
    m = spark.createDataFrame([("p1", 103, 7, 1000, None, 5)], schemas.MASTERY_DOCUMENT)
    assert flatten.mastery_rows(m, "t").first()["tokens_earned"] == 0
