"""The split (hot-entity) paths against plain windows and a brute-force oracle."""
import duckdb
import pytest
from pyspark.sql import functions as F

from trendspark.operators.baseline import match_deltas
from trendspark.operators.sequence import number_rows, range_number_rows, window_number_rows
from trendspark.operators.trends import rolling_trends, window_rolling_trends

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    return ev.select("event_id", "user_id", "event_type", "ts", "value",
                     F.when(F.col("event_type") != "error", F.col("value")).alias("vn"),
                     (F.col("event_type") == "purchase").alias("is_win"))


def _same(a, b, cols):
    ra = a.select(*cols).collect()
    rb = b.select(*cols).collect()
    norm = lambda rows: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    assert norm(ra) == norm(rb)


def test_range_numbering_equals_window(spark, events):
    order = [F.col("ts").asc(), F.col("event_id").asc()]
    a = range_number_rows(events, ["user_id"], order, out="seq", total_out="n", partitions=5)
    b = window_number_rows(events, ["user_id"], order, out="seq", total_out="n")
    _same(a, b, ["event_id", "seq", "n"])
    # adaptive form with a tiny chunk: some users split, others windowed
    c = number_rows(events, ["user_id"], order, out="seq", total_out="n", chunk_rows=3)
    _same(c, b, ["event_id", "seq", "n"])


@pytest.mark.parametrize("chunk", [2, 5, 1_000_000])
def test_rolling_chunked_equals_window(spark, events, chunk):
    seq = window_number_rows(events, ["user_id"], ["ts", "event_id"], out="seq", total_out="n")
    got = rolling_trends(seq, ["user_id"], "seq", "n", ["value", "vn"], window=3, chunk_rows=chunk)
    exp = window_rolling_trends(seq, ["user_id"], "seq", ["value", "vn"], window=3)
    _same(got, exp, exp.columns)


@pytest.mark.parametrize("chunk", [2, 1_000_000])
def test_prior_baselines_against_self_join(spark, events, chunk):
    seq = window_number_rows(events, ["user_id"], ["ts", "event_id"], out="seq", total_out="n")
    got = match_deltas(seq, ["user_id"], "seq", "n", ["vn"], ["event_id"], chunk_rows=chunk)
    sql = f"""
    with s as (select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) seq,
                      case when event_type <> 'error' then value end v from '{SF}/events.parquet')
    select c.event_id, count(p.v) bc,
           case when count(p.v) = 0 then null else count(p.v) filter (where p.v <= c.v) / count(p.v) end pr,
           avg(p.v) bm, stddev_samp(p.v) bs
    from s c left join s p on c.user_id = p.user_id and p.seq < c.seq group by c.event_id"""
    exp = {r[0]: r[1:] for r in duckdb.sql(sql).fetchall()}
    rows = got.select("event_id", "baseline_match_count", "baseline_percentile_rank",
                      "baseline_mean", "baseline_stddev").collect()
    assert len(rows) == len(exp)
    for r in rows:
        e = exp[r[0]]
        assert r[1] == e[0]
        for g, x in zip(r[2:], e[1:]):
            assert (g is None and x is None) or abs(g - x) < 1e-9


def test_null_keys_and_window_one(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0), ("a", 1, 3.0), ("a", 2, None)],
                               "k string, t int, v double")
    got = number_rows(df, ["k"], ["t"], out="seq", total_out="n", chunk_rows=1)
    assert sorted((r["k"] or "", r["t"], r["seq"], r["n"]) for r in got.collect()) == \
        [("", 1, 1, 2), ("", 2, 2, 2), ("a", 1, 1, 2), ("a", 2, 2, 2)]
    r = rolling_trends(got, ["k"], "seq", "n", ["v"], window=1, win_col=None, chunk_rows=1)
    rows = {(x["k"], x["seq"]): x for x in r.collect()}
    assert rows[("a", 2)]["v_rolling_avg"] is None and rows[("a", 2)]["v_career_avg"] == 3.0
    assert rows[("a", 2)]["v_career_percentile"] == 1.0       # null ranks last
    assert all(x["is_full_window"] for x in rows.values())


def test_null_entity_on_split_path(spark):
    """A long entity whose key is NULL is split like any other and keeps its rows."""
    rows = [(None, t, float(t % 4)) for t in range(1, 13)] + [("a", t, float(t)) for t in range(1, 4)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    seq = number_rows(df, ["k"], ["t"], out="seq", total_out="n", chunk_rows=4)
    got = rolling_trends(seq, ["k"], "seq", "n", ["v"], window=3, win_col=None, chunk_rows=4)
    exp = window_rolling_trends(window_number_rows(df, ["k"], ["t"], out="seq", total_out="n"),
                                ["k"], "seq", ["v"], window=3, win_col=None)
    assert got.count() == 15
    _same(got, exp, ["k", "seq", "v_rolling_avg", "v_career_avg", "v_career_percentile",
                     "matches_in_window"])


def test_range_numbering_counts_flagged_rows(spark):
    """the records before a query are counted with its position, in one numbering."""
    rows = [(None if i % 3 == 0 else i % 3, i, i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, t int, f int")
    got = {(r.k, r.t): (r.seq, r.ones) for r in range_number_rows(
        df.repartition(3), ["k"], ["t"], partitions=5, flag="f", flag_out="ones").collect()}
    for k in (None, 1, 2):
        mine = sorted((t, f) for x, t, f in rows if x == k)
        for n, (t, _) in enumerate(mine):
            assert got[k, t] == (n + 1, sum(f for _, f in mine[:n + 1]))
