"""Token alignment against nested loops over the libraries' own tokens."""
from collections import Counter

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trendspark.llm import token_align
from trendspark.llm.common import Scratch

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "  two  spaces ", "a▁b", "▁", "<|endoftext|> and </s> <0x41> <unk>", "é中\U0001F600\x00x", "\n\t \r\n", "x" * 3000,
       "the end", "the end", "naïve ﬁne ＡＢＣ", "don't 'll 123 4567 !!?"]


def _tokens(text):
    """(A ids, A byte strings, B ids, B byte strings) of the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer
    a_file, b_file = token_align.default_files()
    if not hasattr(_tokens, "both"):
        a = Tokenizer.from_file(a_file)
        a.encode_special_tokens = True
        _tokens.both = a, sentencepiece.SentencePieceProcessor(model_file=b_file)
    a, b = _tokens.both
    letters = token_align.byte_alphabet()
    left = a.encode(" " + text, add_special_tokens=False)
    right = b.encode(text)
    a_bytes = [bytes(letters[c] for c in t) for t in left.tokens]
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in zip(right, b.id_to_piece(right))] if right else []
    return left.ids, a_bytes, right, b_bytes


def _spans(pieces):
    ends = np.cumsum([len(p) for p in pieces]).tolist()
    return list(zip([0, *ends[:-1]], ends))


def _brute(texts):
    docs, counts = [], Counter()
    for text in texts:
        a, a_bytes, b, b_bytes = _tokens(text) if text else ([], [], [], [])
        if text and not b"".join(a_bytes) == b"".join(b_bytes) == b" " + text.encode():
            a, a_bytes, b, b_bytes = [], [], [], []
        sa, sb = _spans(a_bytes) if a else [], _spans(b_bytes) if b else []
        links = [(a[i], b[j]) for i, (p, q) in enumerate(sa) for j, (r, s) in enumerate(sb) if p < s and r < q]
        counts.update(links)
        common = sorted({e for _, e in sa} & {e for _, e in sb})
        groups = []
        for lo, hi in zip([0, *common], common):
            groups.append(",".join(str(i) for i, (_, e) in zip(a, sa) if lo < e <= hi) + "|" +
                          ",".join(str(i) for i, (_, e) in zip(b, sb) if lo < e <= hi))
        docs.append((len(a), len(b), common, links, ";".join(groups)))
    top = {}
    for (_, b), c in counts.items():
        top[b] = max(c, top.get(b, 0))
    return [(na, nb, len(common), len(links), groups, sum(counts[k] == top[k[1]] for k in links), sum(counts[k] for k in links))
            for na, nb, common, links, groups in docs]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=40), st.lists(st.integers(1, 4), min_size=1, max_size=40), st.integers(1, 9))
def test_merge_pieces(x, y, work):
    a, b = np.cumsum(x), np.cumsum(y)
    total = max(a[-1], b[-1])
    a, b = np.unique(np.append(a, total)), np.unique(np.append(b, total))
    i, j = token_align.merge_cuts(a, b, work)
    assert (np.diff(i + j)[:-1] == work).all() and i[-1] + j[-1] == len(a) + len(b)
    ends, left, right, both = token_align.merge_ends(a, b, work)
    want = sorted({*a.tolist(), *b.tolist()})
    assert ends.tolist() == want
    assert both.tolist() == [e in a and e in b for e in want]
    assert left.tolist() == [int((a < e).sum()) for e in want] and right.tolist() == [int((b < e).sum()) for e in want]


@pytest.mark.parametrize("hot", [0, 40, 1 << 20])
def test_alignment_equals_nested_loops(spark, hot):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(25).collect()
    rows = [(r.doc_id, r.text[:1500], 1) for r in docs] + [(1000 + i, t, 1) for i, t in enumerate(ODD)] + [(None, "the end", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a long").repartition(3)
    scratch = Scratch(spark, "test")
    found = token_align.align_tokens(df, "text", *token_align.default_files(), work=7)
    kept = scratch.keep(found.select("doc_id", "text", *[found.aligned[c].alias(c) for c in ("n_b", "n_groups", "n_links", "groups", "link_a", "link_b", "group_ends")],
                                     found.aligned.n_a.alias("n_a")), "links")
    assert all(r.group_ends == [] or r.group_ends[-1] == len(r.text.encode()) + 1 for r in kept.select("text", "group_ends").collect())
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum)
           for r in token_align.link_sums(kept, scratch, hot).collect()]
    want = [(i, *w) for (i, _, _), w in zip(rows, _brute([t for _, t, _ in rows]))]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query_rows(spark):
    found = token_align.op11_token_align(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == len(docs)
    short = [d for d in docs if len(d.text or "") < 1500]
    for d, w in zip(short, _brute([d.text for d in short])):     # corpus-wide counts differ on a part; the rest is per text
        r = got[d.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == w[:4] and r.groups_sha256 == (brute.sha(w[4]) if w[0] else "")
        assert r.n_best <= r.n_links and r.count_sum >= w[6]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_align.align_tokens(df, "text", *token_align.default_files()).count() == 0
    scratch = Scratch(spark, "test")
    none = scratch.keep(spark.createDataFrame([], "doc_id long, link_a array<int>, link_b array<int>"), "none")
    assert token_align.link_sums(none, scratch).collect() == []


def test_both_byte_level_encoders_agree_on_every_character():
    """The rank encoder against the file's own library: each code point among letters, digits, spaces and marks."""
    import os

    from tokenizers import Tokenizer
    a_file = token_align.default_files()[0]
    with open(a_file, "rb") as f:
        fast = token_align.ranked_encoder(f.read())
    slow = Tokenizer.from_file(a_file)
    slow.encode_special_tokens = True
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    points = [chr(c) for c in [*range(0, 0xD800, 2), *range(0xE000, 0x20000, 3)]]
    for lo in range(0, len(points), 20_000):
        some = [f" a{c}1 {c}{c}! {c}b {c}2  {c} '{c}" for c in points[lo:lo + 20_000]]
        for text, e in zip(some, slow.encode_batch_fast(some, add_special_tokens=False)):
            assert fast(text).tolist() == e.ids, text
    for text in ODD:
        assert fast(text or "").tolist() == slow.encode(text or "", add_special_tokens=False).ids


def test_other_files_keep_their_library():
    import json
    with open(token_align.default_files()[0], "rb") as f:
        whole = json.load(f)
    whole["model"]["merges"][0], whole["model"]["merges"][1] = whole["model"]["merges"][1], whole["model"]["merges"][0]
    assert token_align.ranked_encoder(json.dumps(whole).encode()) is None
