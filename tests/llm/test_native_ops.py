"""Top-k search, license scan and sharding: SQL or plain Python on awkward rows."""
import math
import zlib

import duckdb
import pytest

from trendspark.llm import license_scan, sharding, topk_search

SF = "/root/testdata/sf0.001"


def _brute_top(rows, k, scale=64):
    ok = [(i, [math.floor(float(x) * scale) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in ok if i % 2 == 0}:
        found = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(b) == len(a)))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def test_exact_top_k_with_ties_and_odd_vectors(spark):
    import random
    rng = random.Random(8)
    rows = [(i, [rng.choice([-1.0, -0.3, 0.0, 0.26, 1.0]) for _ in range(4)]) for i in range(60)]
    rows += [(100, None), (102, []), (104, [1.0, None, 0.0, 1.0]), (106, [float("nan"), 0.0, 0.0, 1.0]),
             (108, [float("inf"), 0.0, 0.0, 1.0]), (None, [1.0] * 4), (110, [1.0, 2.0]), (112, [0.5, 1.0]), (114, [1.0e7] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = sorted(map(tuple, topk_search.exact_top_k(df, df.where("vec_id % 2 = 0"), k=7).collect()))
    assert got == _brute_top(rows, 7)
    assert topk_search.exact_top_k(df, df.where("vec_id < 0")).count() == 0
    assert topk_search.exact_top_k(df.where("vec_id < 0"), df).count() == 0


def test_tile_scores_beyond_doubles():
    import numpy as np
    q, c = np.full((1, 3), 2.0 ** 30), np.array([[2.0 ** 30, 1.0, 1.0], [1.0, 0.0, 0.0]])
    assert topk_search.tile_scores(q, c).tolist() == [[2 ** 60 + 2 ** 31, 2 ** 30]]


def test_hilbert_curve_visits_every_cell_by_single_steps(spark):
    """Neighbours on the curve are neighbours in the cube, and every cell has its own index."""
    from pyspark.sql import functions as F
    for dims, bits in ((2, 3), (3, 2)):
        cells = spark.range(1 << (dims * bits)).select(
            *[F.expr(f"cast((id >> {bits * d}) & {(1 << bits) - 1} as int)").alias(f"c{d}") for d in range(dims)])
        rows = cells.select(sharding.hilbert_index([F.col(f"c{d}") for d in range(dims)], bits).alias("h"), *cells.columns).collect()
        order = sorted(map(tuple, rows))
        assert [r[0] for r in order] == list(range(1 << (dims * bits)))
        assert all(sum(abs(a - b) for a, b in zip(x[1:], y[1:])) == 1 for x, y in zip(order, order[1:]))


@pytest.mark.parametrize("n", [0, 5, 333])
def test_shards_have_equal_counts(spark, n):
    texts = [None, "", "é" * 40, "same", "same"]
    rows = [(None if i % 50 == 49 else i // 2, texts[i % 5] if i % 3 else "t" * i, "xyz"[i % 3] if i % 7 else None, 1)
            for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, size long")
    out = sharding.shard_rows(df, "doc_id", "text", ["lang", "size"]).collect()
    assert len(out) == n
    counts = [0] * 40
    for r in out:
        counts[r.shard] += 1
    assert not n or max(counts) - min(counts) <= 1
    for s in range(40):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(counts[s]))
    key = lambda i, t: (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
    assert sorted(map(repr, ((r.doc_id, r.size, r.text_crc32) for r in out))) == sorted(repr(key(i, t)) for i, t, _, _ in rows)
    place = sorted((r.shard, r.slot, r.curve) for r in out)
    assert [c for *_, c in place] == sorted(c for *_, c in place)       # shards are runs of the curve


def test_written_shards_prune(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, "doc_id", "text", ["lang", "source"], shards=8)
    back = spark.read.parquet(path)
    assert back.drop("shard").exceptAll(docs).count() == 0 and back.count() == docs.count()
    assert back.select("shard").distinct().count() == 8


def test_license_scan(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/x.txt", "plain text"), ("a/b/y.txt", "plain\nAll rights reserved.\nmore"),
        ("a/b/c/z.txt", None), ("a/b/c/w.txt", ""), ("q/r.txt", "nothing here"), ("s/COPY", "RELEASED under the mit license!!"),
        ("s/COPY2", "Licensed under the Apache License, Version 2.0."), ("s/t.txt", "body of words"), ("top.txt", "words"),
        ("a/x.txt", "plain text"), (None, "Released under the MIT License.")]
    df = spark.createDataFrame([(p, t, 1) for p, t in rows], "path string, text string, key long")
    got = {r.path: (r.own_license, r.is_license_file, r.license, r.license_source, r.license_dir)
           for r in license_scan.scan_licenses(df, "path", "text").collect()}
    assert got["a/LICENSE"] == ("MIT", True, "MIT", "header", None)
    assert got["a/x.txt"] == (None, False, "MIT", "ancestor", "a")
    assert got["a/b/y.txt"] == ("Proprietary", True, "Proprietary", "header", None)
    assert got["a/b/c/z.txt"] == (None, False, "Proprietary", "ancestor", "a/b")   # the nearest one
    assert got["q/r.txt"] == (None, False, None, "none", None)
    assert got["s/COPY"][0] == "MIT" and got["s/t.txt"][2] in ("MIT", "Apache-2.0")
    assert got["top.txt"] == (None, False, None, "none", None) and got[None][0] == "MIT"
    assert license_scan.scan_licenses(df.where("path = '?'"), "path", "text").count() == 0


@pytest.mark.parametrize("name", ["op1_decontaminate", "op4_exact_topk", "op6_license_scan"])
def test_query_equals_its_sql(spark, name):
    import os

    from trendspark.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    at = [rel.columns.index(c) for c in cols]
    assert sorted(repr(tuple(r)) for r in df.select(*cols).collect()) == sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())


def test_native_plans_have_no_python(spark):
    from trendspark.llm.queries import QUERIES
    for name in ("op6_license_scan", "op7_sharding"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas")), plan
