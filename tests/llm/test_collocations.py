"""Collocations against plain Python counting on small awkward texts."""
import random
import re
from collections import Counter

import pytest

from trendspark.llm import collocations
from trendspark.llm.common import Scratch


def _brute(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang in n:
        mine = {k[1:]: c for k, c in f.items() if k[0] == lang}
        found = []
        for p, a in mine.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(len(q) == 3 and c >= least and p in (q[:2], q[1:]) and 100 * c >= 50 * a for q, c in mine.items()):
                continue
            score, k = min((1_000_000 * a * a // (mine[p[:k]] * mine[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), mine[p[:k]], mine[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def _rows():
    rng = random.Random(9)
    words = ["the", "The", "cat", "a", "über", "ﬁx", "x1", "中文", "don't", "-"]
    rows = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ", ", ".", "\n", "\x0b", " "])
                                                         for _ in range(rng.randint(0, 30)))) for _ in range(80)]
    hot = ("en", " ".join(f"hot pair r{i % 40}" for i in range(600)))         # one pair leads a third of the rows
    return rows + [hot, hot, ("en", None), (None, ""), ("fr", "... ,, \n"), ("it", "Solo"), ("en", "y " * 4000)]


@pytest.mark.parametrize("block, least, top", [(1 << 19, 10, 2000), (7, 3, 5)])
def test_counts_and_ranks(spark, monkeypatch, block, least, top):
    monkeypatch.setattr(collocations, "BLOCK", block)
    rows = _rows()
    df = spark.createDataFrame([(t, l, i, "w1") for i, (l, t) in enumerate(rows)], "text string, lang string, c long, w1 string").repartition(3)
    counts = collocations.phrase_counts(df, Scratch(spark, "test"), least=least)
    got = sorted(tuple(r) for r in collocations.collocations(counts, top).collect())
    assert got == _brute(rows, least, top)


def test_large_products_are_exact(spark):
    a, l, r = 99_999_999_999_999, 99_999_999_999_998 + 1, 99_999_999_999_999
    rows = [(a, l, r), (7, 3 * 10 ** 13, 10 ** 13), (10 ** 13 + 1, 10 ** 13 + 3, 10 ** 13 + 7), (999_999, 10 ** 6, 10 ** 6)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", collocations._score("a", "l", "r").alias("s")).collect()
    assert [x.s for x in got] == [10 ** 6 * x.a * x.a // (x.l * x.r) for x in got]


def test_empty_table(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(collocations.phrase_counts(df, Scratch(spark, "test"))).collect() == []


def test_query_equals_sql(spark):
    import oracle_check
    assert oracle_check.compare(spark, "/root/testdata/sf0.001", ["op12_collocations"], verbose=False)["op12_collocations"]["values_match"]
