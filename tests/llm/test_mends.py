"""Repeated query rows, and columns with awkward names through the pipeline's stages."""
import corpus_pipeline
import numpy as np
import pytest

from trendspark.llm import ngram_join, topk_search

SF = "/root/testdata/sf0.001"


def test_a_query_row_that_occurs_twice_keeps_both_lists(spark):
    rows = [(i, [float(i)]) for i in range(1, 12)] + [(20, [1 / 64 * 64]), (20, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in topk_search.exact_top_k(df, df.where("vec_id = 20"), k=4, scale=1).collect())
    assert got == sorted([(20, n + 1, 11 - n) for n in range(4)] * 2)


@pytest.mark.parametrize("name", ["language ID", "n-gram Jaccard join", "suffix-array dedup", "benchmark decontamination",
                                  "SentencePiece encoding and decoding"])
def test_stages_take_awkward_columns(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(12)
    odd = docs.selectExpr("*", "'x' AS pieces", "7L AS n_tokens", "doc_id AS `a.b`")
    out = dict(corpus_pipeline.STAGES)[name](spark, odd, SF)
    assert set(out.columns) >= set(odd.columns) and out.count() > 0
    assert all(r["a.b"] == r["doc_id"] and r["pieces"] == "x" for r in out.collect())
    if name.startswith("Sentence"):
        assert all(r["n_tokens"] != 7 for r in out.collect())
    else:
        assert out.columns == odd.columns


def test_tree_search_in_parts_finds_the_same_pairs(monkeypatch):
    """Small parts hold the pairs of one large part, against brute force over all pairs."""
    rng = np.random.default_rng(5)
    points = rng.integers(0, 4, (700, ngram_join.GROUPS)).astype(np.uint8)
    points[350:] = points[:350]
    sizes = points.sum(axis=1).astype(np.int64)
    tree = ngram_join.CountTree(points, sizes)
    whole = set(zip(*(x.tolist() for x in tree.search(points, sizes, 60, 100))))
    monkeypatch.setattr(ngram_join, "PAIRS", 50)
    parts = list(tree.parts(points, sizes, 60, 100))
    assert len(parts) > 1
    assert {pair for q, p in parts for pair in zip(q.tolist(), p.tolist())} == whole
    low = np.minimum(points[:, None], points[None]).sum(axis=2, dtype=np.int64)
    brute = ngram_join.may_link(low, sizes[:, None], sizes[None], 60, 100)
    assert whole == set(zip(*(x.tolist() for x in np.nonzero(brute))))


def test_a_full_chunk_table_keeps_what_the_batch_uses(monkeypatch):
    """op2: at the table's bound known chunks of the batch are not encoded again."""
    from trendspark.llm import piece_codec
    model, asked = piece_codec.load_model(piece_codec.default_model()), []
    encode = piece_codec.encode_chunks
    monkeypatch.setattr(piece_codec, "CACHE", 6)
    monkeypatch.setattr(piece_codec, "encode_chunks", lambda m, new, into: (asked.append(sorted(new)), encode(m, new, into)))
    run = piece_codec._encoder(model)
    run(["▁one▁two▁three▁four\n"])
    known, lists = run(["▁four▁five▁one\n▁six▁seven"])
    assert asked[1] == ["▁five", "▁seven", "▁six"]
    ids = [i for c in lists[0] for i in known.ids[c]]
    assert piece_codec.decode(model, ids) == "four five one\n six seven"


def test_sets_too_unlike_in_size_share_no_block(spark):
    """op3: a shingle shared by sets of which no two can link makes no block; others are cut by size."""
    from trendspark.llm import ngram_join
    rows = [(1, 10, 100), (1, 11, 50), (1, 12, 20), (2, 20, 100), (2, 21, 91), (2, 22, 83), (2, 23, 40), (2, 24, 40),
            (2, 24, 40), (2, 25, 30), (3, 30, 7), (3, 30, 7)]
    tokens = spark.createDataFrame(rows, "token long, cls long, n long")
    got = ngram_join._sized_blocks(tokens, 90, 100).collect()
    blocks = {}
    for r in got:
        blocks.setdefault((r.token, r.lead, r.last), []).append(r.cls)
    assert sorted(sorted(v) for v in blocks.values()) == [[20, 21, 22], [23, 24]]
    assert {(lead, last) for _, lead, last in blocks} == {(20, 22), (23, 24)}
    assert len({t for t, *_ in blocks}) == 2


def test_phrases_shared_by_few_texts_make_no_blocks(spark, monkeypatch):
    """op3: shingles of a few unrelated texts come after those of one text; links stay, against brute force."""
    import brute
    rows = [(i, " ".join([f"u{i}x{j}" for j in range(40)] + [f"p{i % 100}y{j}" for j in range(12)])) for i in range(400)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(0, 400, 80)]
    frame = spark.createDataFrame(spark.sparkContext.parallelize(rows, 5), "doc_id long, text string")
    blocks, met = ngram_join._sized_blocks, set()

    def seen(*args):
        out = blocks(*args)
        met.update(r.cls for r in out.collect())
        return out
    monkeypatch.setattr(ngram_join, "_sized_blocks", seen)
    got = [(r.id, r.n_shingles, r.component_id) for r in
           ngram_join.jaccard_components(frame, "doc_id", "text", 3, 90, 100).collect()]
    assert sorted(got) == sorted(brute.jaccard_components(rows, 3, 90, 100))
    assert sum(low != i for i, _, low in got) == 5
    assert len(met) <= 20                                   # two classes of each link, some by a shared bucket


def test_large_unrelated_sets_are_dropped_before_their_sets_are_read(spark):
    """pipeline, op3: coarse points cannot part large sets; fine points do, and keep the link."""
    import random

    from pyspark.sql import functions as F

    from trendspark.llm.common import Scratch
    rng = random.Random(2)
    one, two = ([f"w{rng.random()}" for _ in range(4000)] for _ in range(2))
    rows = [(1, " ".join(one)), (2, " ".join(two)), (3, " ".join(one[:3900]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scratch = Scratch(spark, "test")
    classes = scratch.keep(ngram_join._profile(docs, "doc_id", "text", 5, 0).where("kind = 0")
                           .select("cls", F.col("id").alias("rep"), "n", "point"), "classes")
    cls = {r.rep: r.cls for r in classes.collect()}
    pairs = spark.createDataFrame([(cls[a], cls[b]) for a, b in ((1, 2), (1, 3), (2, 3))], "a long, b long")
    coarse = scratch.keep(ngram_join._bounded_pairs(pairs, classes, 80, 100), "coarse")
    assert coarse.count() == 3
    fine = ngram_join._fine_pairs(coarse, docs, "doc_id", "text", classes, 5, 80, 100, 0, scratch)
    assert [(r.a, r.b) for r in fine.collect()] == [(cls[1], cls[3])]


def test_searches_of_near_copies_list_no_pairs(spark, monkeypatch):
    """pipeline, op3: a search of a group of near copies returns members, then links that join components, no pairs."""
    import random

    import brute
    rng = random.Random(5)
    rows = []
    for i in range(200):
        words = [f"w{j}" for j in range(200)]
        for at in rng.sample(range(200), rng.choice([2, 3, 3, 4])):
            words[at] = f"z{rng.random()}"
        rows.append((i, " ".join(words)))
    search, sizes = ngram_join._tile_search, []

    def seen(spread, *args, **kwargs):
        out = search(spread, *args, **kwargs)
        sizes.append((spread.count(), out.count()))
        return out
    monkeypatch.setattr(ngram_join, "_tile_search", seen)
    got = [(r.id, r.n_shingles, r.component_id) for r in
           ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"),
                                         "doc_id", "text", 5, 80, 100).collect()]
    assert sorted(got) == sorted(brute.jaccard_components(rows, 5, 80, 100))
    assert sizes[0][0] > 1000
    assert all(made <= read for read, made in sizes), sizes
    assert sizes[-1][1] < len(rows), sizes


def test_new_links_span_the_components(monkeypatch):
    """op3: links verified in a block are right, join every component and none twice, also in small parts."""
    monkeypatch.setattr(ngram_join, "SHINGLES", 300)
    monkeypatch.setattr(ngram_join, "STEP", 32)
    rng = np.random.default_rng(4)
    base = [rng.integers(0, 1 << 62, 120).astype(np.uint64) for _ in range(3)]
    sets = [np.unique(np.append(base[i % 3][rng.random(120) > 0.09], rng.integers(0, 1 << 62, i % 4).astype(np.uint64)))
            for i in range(60)]
    counts = np.array([len(s) for s in sets])
    at, grams = np.append(0, np.cumsum(counts)), np.concatenate(sets)
    row = np.repeat(np.arange(60), counts)
    common = np.array([[len(np.intersect1d(x, y)) for y in sets] for x in sets])
    known, code = np.unique(grams, return_inverse=True)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(60)))
    assert (ngram_join.shared_shingles(row * len(known) + code, at, len(known), a, b) == common[a, b]).all()

    linked = common * 185 >= 85 * (counts[:, None] + counts[None])
    joined = linked
    for _ in range(6):
        joined = (joined.astype(np.int64) @ joined.astype(np.int64)) > 0
    rows = {"comp": np.arange(60) + 500, "cls": np.arange(60), "n": counts, "side": np.zeros(60, int),
            "i": np.zeros(60, int), "j": np.zeros(60, int), "point": ngram_join.count_points(row, grams, 60)}
    up = {}
    left, right = ngram_join._new_links(rows, grams, at, up, 85, 100)
    assert linked[left, right].all()
    assert len(left) == 60 - len(np.unique(joined, axis=0))
    root = np.array([ngram_join._root(up, c) for c in range(500, 560)])
    assert ((root[:, None] == root[None]) == joined).all()
    assert not linked.all() and len(left) > 30
    assert ngram_join._new_links(rows, grams, at, up, 85, 100) == ([], [])
