"""Log-bilinear scores: counts by hand, probabilities that sum to one, gradients, held-out gain."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from trendspark.llm import log_bilinear as lb
from trendspark.llm.common import Scratch

SF = "/root/testdata/sf0.01"


def _words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", low) + ["\n"]


def _rows():
    odd = [None, "", " \n ", "The the THE cat", "Ünï中 x", "a\x00b c", "un seen", "y " * 3000, "the cat sat", "the cat sat"]
    rows = [(i, t, "x") for i, t in enumerate(odd * 3)] + [(None, "the cat only here", "x"), (4, "again the cat", "x")]
    return rows


@pytest.mark.parametrize("hot", [0, 4, 1 << 19])
def test_scores_by_hand(spark, hot):
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, scored string").repartition(3)
    learn = df.where(lb.training("doc_id"))
    scratch = Scratch(spark, "test")
    counts = scratch.keep(lb.word_counts(learn, "text"), "counts")
    known = lb.Vocabulary(counts, hot)
    p = lb.train(learn, "text", known)
    got = lb.score_texts(df, counts, known, p, scratch, "text", "out").collect()
    trained = [t for i, t, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for t in trained for w in _words(t))
    n, v = sum(c.values()), len(c)
    assert known.tokens == n and known.distinct == v
    assert known.short == [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0].encode())) if w != "\n"][:lb.SHORT]
    classes = {w: k + 1 for k, w in enumerate(known.short)} | {"\n": 0}
    mass, size = Counter(), Counter()
    for w, k in c.items():
        mass[classes.get(w, lb.rare_class_of(w))] += k
        size[classes.get(w, lb.rare_class_of(w))] += 1

    def score(words):
        kinds = [classes.get(w, lb.rare_class_of(w)) for w in words]
        total = 0.0
        for i, (w, k) in enumerate(zip(words, kinds)):
            one, two = (kinds[i - 1] if i else 0), (kinds[i - 2] if i > 1 else 0)
            h = p["context"][one] * p["place"][0] + p["context"][two] * p["place"][1]
            s = (p["output"] @ h + p["bias"][:, 0]).astype(float)
            total += (s[k] - np.log(np.exp(s).sum())) / math.log(10)
            if k > lb.SHORT:
                total += math.log10((c[w] + 0.1) / (mass[k] + 0.1 * (size[k] + 1)))
        return total
    assert len(got) == len(rows)
    for r in got:
        words = _words(r.text)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert (r.out.n_tokens, r.out.n_known, r.scored) == (len(words), sum(c[w] > 0 for w in words), "x")
        assert r.out.base_score == pytest.approx(base, abs=1e-6 * len(words))
        assert r.out.score == pytest.approx(score(words), abs=2e-4 * len(words))


def test_probabilities_sum_to_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    scratch = Scratch(spark, "test")
    counts = scratch.keep(lb.word_counts(docs, "text"), "counts")
    known = lb.Vocabulary(counts)
    p = lb.train(docs, "text", known)
    z = lb.normalisers(spark, p)
    words = [r.word for r in counts.collect() if r.word != lb.END]
    import pyarrow as pa
    kinds, c = known.classes(pa.array(words)), known.known(pa.array(words))
    assert (c > 0).all()
    inner = np.where(kinds > lb.SHORT, (c + 0.1) / 10 ** known.inner[kinds], 1.0)
    for one, two in [(0, 0), (1, 5), (400, 2), (lb.CLASSES - 1, 0)]:
        every = 10 ** lb.class_scores(p, z, np.arange(lb.CLASSES), np.full(lb.CLASSES, one), np.full(lb.CLASSES, two))
        unknown = sum(every[k] * 0.1 / 10 ** known.inner[k] for k in range(1 + lb.SHORT, lb.CLASSES))
        assert every[kinds] @ inner + every[0] + unknown == pytest.approx(1, abs=1e-4)


def test_gradients():
    rng = np.random.default_rng(3)
    noise = rng.random(12) + 0.1
    t = lb.Trainer(noise / noise.sum(), 1)
    for k in t.p:
        t.p[k] = rng.normal(0, 0.5, t.p[k].shape)
    t.log_noise = t.log_noise.astype(float)
    target, one, two, drawn = (rng.integers(0, 12, n) for n in (20, 20, 20, 6))
    g = t.gradients(target, one, two, drawn)
    for name, v in t.p.items():
        for at in [tuple(rng.integers(0, s) for s in v.shape) for _ in range(8)]:
            keep, h = v[at], 1e-5
            v[at] = keep + h
            up = t.objective(target, one, two, drawn)
            v[at] = keep - h
            down = t.objective(target, one, two, drawn)
            v[at] = keep
            assert g[name][at] == pytest.approx((up - down) / (2 * h), abs=1e-4)


def test_held_out_texts_gain(spark):
    rows = [r for r in lb.op13_log_bilinear(spark, SF).collect() if r.held_out]
    n = sum(r.n_tokens for r in rows)
    assert len(rows) > 50 and sum(r.score for r in rows) / n > sum(r.base_score for r in rows) / n + 0.15


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(None, "some words"), (None, None)], "doc_id long, text string")
    found, tokens = lb.language_model_scores(df)
    got = {r.text: r.scored for r in found.collect()}
    assert tokens == 0 and got["some words"].n_tokens == 3 and got["some words"].n_known == 0
    assert got["some words"].base_score == pytest.approx(0) and got["some words"].score < 0
    none, _ = lb.language_model_scores(df.where("doc_id > 0"))
    assert none.count() == 0
