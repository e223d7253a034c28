"""The language filter, the label sample, text versions and long pages against plain Python."""

import json
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np

from trendspark.llm import html_wrapper, language_id, quality, suffix_dedup

SF = "/root/testdata/sf0.001"


def _grams(text):
    data = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in (" " + text.lower() + " ").encode())
    for n in language_id.SIZES:
        for i in range(len(data) - n + 1):
            if 32 not in data[i + 1:i + n - 1]:
                yield data[i:i + n]


def test_language_filter_holds_every_gram(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = [(r.doc_id, r.text or "", r.lang) for r in docs.collect()]
    learn = [(t, lang) for d, t, lang in rows if lang is not None and zlib.crc32(str(d).encode()) % 5]
    counts = {}
    for text, lang in learn:
        counts.setdefault(lang, Counter()).update(_grams(text))
    rate = {lang: {g: c / sum(own.values()) for g, c in own.items()} for lang, own in counts.items()}
    peak = Counter()
    for own in rate.values():
        for g, x in own.items():
            peak[g] = max(peak[g], x)
    sets = {lang: {g for g, x in own.items() if x >= language_id.SHARE * peak[g]} for lang, own in rate.items()}
    model = language_id.learn_filter(docs.where(~language_id.held_out("doc_id")), "lang", "text")
    assert model["langs"] == sorted(sets) and (model["false"] < 0.01).all()
    best = {}
    for d, text, _ in rows:
        found = list(_grams(text))
        best[d] = {lang: sum(g in sets[lang] for g in found) for lang in sets}
    close = 0
    for r in language_id.identify(docs, model, "text", "out").collect():
        if r.out.lang != "und" and best[r.doc_id]:
            top = max(best[r.doc_id].values())
            n = max(1, len(list(_grams(r.text or ""))))
            assert top - best[r.doc_id][r.out.lang] <= 0.02 * n + 1     # false positives are corrected on average
            close += abs(r.out.score - top / n) <= 0.02
    assert close >= 0.95 * len(rows)


def test_label_sample_is_the_smallest_hashes(spark):
    from pyspark.sql import functions as F
    rows = spark.range(3000).select("id", (F.col("id") % 2).cast("int").alias("y"), F.lit(b"x").alias("features"))
    for sample in (1, 100, 2999, 5000):
        got = {r.id for r in quality.smallest_hashes(rows, sample).collect()}
        place = F.shiftrightunsigned(F.xxhash64("id"), 1)
        assert got == {r.id for r in rows.orderBy(place).limit(sample).collect()}
    assert quality.smallest_hashes(rows.where("id < 0"), 5).count() == 0
    one = spark.createDataFrame([(7, 1, b"x")] * 50, "id long, y int, features binary")
    assert quality.smallest_hashes(one, 20).count() == 20        # rows that share a hash are cut all the same


def test_versions_of_one_id_by_64_bits(spark):
    texts = [(1, "a" * 40 + str(i) * 120) for i in range(4)] + [(1, None), (1, "b" * 10)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    kinds = dict(suffix_dedup._source(docs, "doc_id", "text", 100).dtypes)
    assert kinds["ver"] == "bigint"
    got = suffix_dedup.remove_repeats(docs, "doc_id", "text", "cut").collect()
    assert len(got) == 6 and all(r.cut.n_bytes == len(r.text or "") for r in got)
    for r in got:        # "iii..." repeats itself from its second place on; versions do not remove one another
        long = len(r.text or "") == 160
        assert r.cut.kept == ((r.text or "")[:41] if long else (r.text or "")).encode()


def test_article_text_does_not_depend_on_the_page_count(spark):
    page = "<body><nav>M</nav><article><h2>Introduction</h2><p>Own {0}</p><h2>Methods</h2><p>More {0}</p></article></body>"
    for pages in (4, 6):
        df = spark.createDataFrame([(i, "http://a.example/", page.format(i)) for i in range(pages)],
                                   "id long, url string, html string")
        for r in html_wrapper.extract_text(df, "url", "html", keep_constant=True).collect():
            assert r.main == f"Introduction\nOwn {r.id}\nMethods\nMore {r.id}"


def test_body_only_host_by_class_parts(spark):
    page = ('<body><div class="site-header"><a href="/">Home</a></div><div class="left-sidebar">Side {0}</div><h1>Title {0}</h1>'
            '<p>Text {0}</p><div class="related-posts"><a href="/x">Other {0}</a></div>'
            '<div class="post-comments"><p>Says {0}</p></div></body>')
    df = spark.createDataFrame([(i, "http://b.example/", page.format(i)) for i in range(8)], "id long, url string, html string")
    for r in html_wrapper.extract_text(df, "url", "html", keep_constant=True).collect():
        assert r.main == f"Title {r.id}\nText {r.id}"
    wrapped = '<body><div class="has-sidebar"><article><p>Kept {0}</p></article></div></body>'
    df = spark.createDataFrame([(i, "http://c.example/", wrapped.format(i)) for i in range(6)], "id long, url string, html string")
    assert {r.main for r in html_wrapper.extract_text(df, "url", "html", keep_constant=True).collect()} == {f"Kept {i}" for i in range(6)}


def _brute_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    return best


def test_bit_rows_of_common_subsequences():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.choice("pqr") for _ in range(rng.randrange(12))] for _ in range(2))
        best = _brute_lcs(a, b)
        rows = html_wrapper.common_lengths([[k, "", []] for k in a], [[k, "", []] for k in b], 0)
        for i in range(len(a)):
            for j in range(len(b)):
                assert (rows[j] >> (len(a) - 1 - i) & 1) == (best[i][j] == best[i + 1][j])


def _brute_match(page, wrapper):
    """Whether a sequence of (key, children) fits the wrapper, by trying every way."""
    if not wrapper:
        return not page
    key, flag, children = wrapper[0][:3]
    if (flag in ("?", "*") or key == "#") and _brute_match(page, wrapper[1:]):
        return True
    run = 0
    while run < len(page) and page[run][0] == page[0][0]:
        run += 1
    return (run > 0 and page[0][0] == key and (run == 1 or flag in ("+", "*"))
            and all(_brute_match(one[1], children) for one in page[:run]) and _brute_match(page[run:], wrapper[1:]))


def test_matching_equals_trying_every_way():
    rng = random.Random(4)

    def made(depth=0):
        return "".join(f"<{t}>{made(depth + 1) if depth < 2 and t == 'div' else rng.choice(['x', ''])}</{t}>"
                       for t in (rng.choice(["p", "h2", "div"]) for _ in range(rng.randrange(4))))
    seen = set()
    for _ in range(400):
        pages = [made() for _ in range(3)]
        wrapper = json.loads(html_wrapper.merge_structures([json.dumps(html_wrapper.page_structure(p)) for p in pages[:2]]))
        for p in pages:
            root, _ = html_wrapper.page_tree(list(html_wrapper.page_events(p)))
            want = _brute_match(root, wrapper)
            assert html_wrapper.match_page(root, html_wrapper.number_nodes(wrapper)) == want
            assert want or p is pages[2]
            seen.add(want)
    assert seen == {True, False}


def test_very_long_pages_stay_small():
    long = "".join(f"<p>a{i}</p><h2>b</h2>" for i in range(12_000))
    other = "".join(random.Random(i).choice(["<p>q</p>", "<h2>q</h2>", "<div>z</div>"]) for i in range(8_000))
    tracemalloc.start()
    wrapper = html_wrapper.merge_structures([json.dumps(html_wrapper.page_structure(x)) for x in (long, other)])
    root, _ = html_wrapper.page_tree(list(html_wrapper.page_events(long)))
    assert len(long) > 200_000 and html_wrapper.match_page(root, html_wrapper.number_nodes(json.loads(wrapper)))
    assert tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()
    assert np.all([node[2] >= 0 for node in root])
