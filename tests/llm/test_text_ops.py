"""Pieces, language, quality and page text: library or plain-Python answers on awkward rows."""
import random

import brute
import pytest

from trendspark.llm import html_wrapper, language_id, piece_codec, quality

SF = "/root/testdata/sf0.001"


def _texts():
    rng = random.Random(4)
    alphabet = list("abc  \n\t▁é中\U0001F600<s>/\x00 .,ABC01'\"") + ["the", "▁▁", "     "]
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    return made + ["", " ", "  ", "\n", "▁", "a" * 900, "x " * 300, "</s>", "<0x41>", "é" * 200, "ab" * 3000]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())


def test_digests_equal_the_library(spark, library):
    rows = [(i, t, 1) for i, t in enumerate(_texts())] + [(None, None, 1), (0, _texts()[0], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids long").repartition(3)
    found = piece_codec.encode_digests(df, "text", piece_codec.load_model(piece_codec.default_model()))
    got = sorted((tuple(r[:2]) + tuple(r.digest) for r in found.collect()), key=repr)
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_eos=True)
        want.append((i, t, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(library.decode(ids))))
    assert got == sorted(want, key=repr)
    assert piece_codec.encode_digests(df.where("doc_id < 0"), "text", piece_codec.load_model(piece_codec.default_model())).count() == 0


def test_spans_equal_the_library(spark, library):
    rows = list(enumerate(_texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = piece_codec.encode_pieces(df, "text", piece_codec.load_model(piece_codec.default_model()))
    for r in found.collect():
        want = [(p.id, p.begin, p.end) for p in library.encode(r.text, return_type="proto").pieces]
        assert list(zip(r.pieces.ids, r.pieces.begins, r.pieces.ends))[:-1] == want
        size = len(r.text.encode())
        assert (r.pieces.ids[-1], r.pieces.begins[-1], r.pieces.ends[-1]) == (2, size, size)


@pytest.mark.parametrize("trim", [True, False])
@pytest.mark.parametrize("dummy", [True, False])
def test_compiled_character_map(trim, dummy):
    """A real compiled map (normalisation rules) in the production model."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto
    rules = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc_cf")
    norm, full = proto.ModelProto(), proto.ModelProto()
    norm.ParseFromString(rules.serialized_model_proto())
    with open(piece_codec.default_model(), "rb") as f:
        full.ParseFromString(f.read())
    full.normalizer_spec.precompiled_charsmap = norm.normalizer_spec.precompiled_charsmap
    full.normalizer_spec.remove_extra_whitespaces, full.normalizer_spec.add_dummy_prefix = trim, dummy
    blob = full.SerializeToString()
    model, lib = piece_codec.PieceModel(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)
    model = piece_codec.PieceModel.from_state(model.state())
    texts = _texts() + ["ﬁne ＡＢＣ　① ½ ㌔  x ", "  ﬁ", "　　", "İstanbul ẞ ﷺ", "áé ​ x"]
    known, lists = piece_codec._encoder(model)([piece_codec.normalised(model, t) for t in texts])
    for text, chunks in zip(texts, lists):
        ids = [i for c in chunks for i in known.ids[c]] + [model.eos]
        assert ids == lib.encode(text, add_eos=True)
        assert piece_codec.decode(model, ids) == lib.decode(ids)
        _, source = piece_codec.normalise(model, text)
        at, spans = 0, []
        for size in (s for c in chunks for s in known.sizes(model, c)):
            spans.append((source[at], source[at + size]))
            at += size
        assert spans == [(p.begin, p.end) for p in lib.encode(text, return_type="proto").pieces]


def test_language_held_out_accuracy_and_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10_001, None, "en"), (10_002, "", "de"), (10_003, "123 !? €", None), (None, "der die das", "de"),
                                 (10_004, "x", None), (10_005, "中文", None)], "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").unionByName(odd)
    found = language_id.identify_languages(both).collect()
    held = [r for r in found if r.doc_id is not None and r.doc_id < 10_000 and __import__("zlib").crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 20
    assert sum(r.language.lang == r.lang for r in held) >= 0.95 * len(held)
    got = {r.doc_id: tuple(r.language) for r in found}
    assert got[10_001] == got[10_002] == got[10_003] == ("und", 0.0)
    assert got[10_004][0] in {"en", "de", "fr", "es"} and got[10_005][0] in {"en", "de", "fr", "es"}
    assert all(0 <= r.language.score <= 1 for r in found)
    kept = language_id.drop_undetermined(both)
    assert kept.columns == both.columns and kept.count() == len(found) - 3
    unlabelled = both.withColumn("lang", both.lang.substr(9, 1)).where("lang is null")
    assert {r.language.lang for r in language_id.identify_languages(unlabelled).collect()} <= {"und"}
    assert language_id.identify_languages(both.where("doc_id < 0")).count() == 0


def test_language_popcounts_match_sets():
    """Without false positives the decision is that of plain gram sets."""
    import numpy as np
    rng = np.random.default_rng(2)
    grams = rng.integers(0, 1 << 62, 900).astype(np.uint64)
    sets = [set(grams[:400].tolist()), set(grams[300:700].tolist()), set(grams[650:].tolist())]
    slots = np.zeros((1 << 20, 1), np.uint64)
    for k, own in enumerate(sets):
        mine = np.array(sorted(own), np.uint64)
        for at in language_id.slot_places(mine, 20):
            np.bitwise_or.at(slots, (at, 0), np.uint64(1 << k))
    masks = language_id.language_masks({"slots": slots, "bits": 20}, grams)[:, 0]
    want = [sum(1 << k for k in range(3) if g in sets[k]) for g in grams.tolist()]
    assert sum(int(a) != b for a, b in zip(masks, want)) <= 1          # a false positive is possible


def test_quality_held_out_and_edges(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    odd = spark.createDataFrame([(90_001, None), (90_002, ""), (None, "some words"), (90_003, "\x00"), (0, "again")], "doc_id long, text string")
    odd_labels = spark.createDataFrame([(90_001, None), (90_002, 7), (123_456_789, 1)], "doc_id long, quality int")
    scored = quality.quality_scores(docs.unionByName(odd), labels.unionByName(odd_labels))
    rows = scored.collect()
    assert len(rows) == docs.count() + 5 and all(0 <= r.score <= 1 for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    import zlib
    held = [(r.score, truth[r.id]) for r in rows if r.id in truth and zlib.crc32(str(r.id).encode()) % 5 == 0]
    good = [s for s, y in held if y == 1]
    poor = [s for s, y in held if y == 0]
    wins = sum((g > p) + 0.5 * (g == p) for g in good for p in poor) / (len(good) * len(poor))
    assert wins >= 0.9
    none = quality.quality_scores(docs.limit(5), labels.where("quality > 5"))
    assert {r.score for r in none.collect()} == {0.5}
    assert quality.quality_scores(docs.where("doc_id < 0"), labels).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home">
<nav><ul><li>Menu<li>More</ul></nav><div id="cookie-notice"><p>We use cookies</p></div>
<header><h2>Site</h2></header><form><input value="x"><p>Search</p></form>
<article class="post"><header><h1>Big &amp; &lt;small&gt;</h1></header><p>One <b>bold</b>
 and&nbsp;<i>it</i><br>next<p>Two<script>var a = "</p><p>no";</script> three<div class="ad-box">Buy</div>
<ul><li>a<li>b &copy</ul><table><tr><td>c<td>d</table><aside>Side</aside>
<section class="comments"><article><p>First!</p></article></section></article>
<div class="sidebar">S</div><footer>&copy; F</footer></body></html>"""


def test_page_text():
    region = html_wrapper.wrapper_region(html_wrapper.page_structure(PAGE))
    blocks = [t for _, t in html_wrapper.page_blocks(PAGE, region)]
    assert region == "article"
    assert blocks == ["Big & <small>", "One bold and it next", "Two three", "a", "b ©", "c", "d"]


def test_wrapper_alignment():
    pages = ["<body><h1>a</h1><p>x</p><p>y</p></body>", "<body><h1>b</h1><div>opt</div><p>z</p></body>", "<body><h1>c</h1></body>"]
    import json
    wrapper = json.loads(html_wrapper.merge_structures([json.dumps(html_wrapper.page_structure(p)) for p in pages]))
    slot = ["#", "", []]
    assert wrapper == [["body", "", [["h1", "", [slot]], ["div", "?", [slot]], ["p", "*", [slot]]]]]


def test_extraction_over_hosts(spark):
    bare = "<html><body><div>Join us</div><div><p>Text {0}</p><p>More {0}</p></div><div>All pages say so</div></body></html>"
    rows = [(i, f"http://bare.example/{i}", bare.format(i), 1) for i in range(8)]
    rows += [(20, "http://A.example/x", PAGE, 1), (20, "http://A.example/x", PAGE, 1), (21, None, PAGE, 1), (22, "odd url", "<p>un<b>closed", 1),
             (23, "http://a.example/y", None, 1), (24, "http://a.example/z", "", 1), (25, "http://a.example/w", "<main><p>only main</p></main>", 1),
             (26, "http://deep.example/", "<div>" * 3000 + "deep" + "</div>" * 3000, 1), (27, "http://a.example/v", "plain &amp; text < 5 > 3", 1),
             (28, "http://long.example/", "<article>" + "<p>w w</p>" * 20000 + "</article>", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host long").repartition(3)
    got = {}
    for r in html_wrapper.extract_text(df, "url", "html").collect():
        got.setdefault(r.page_id, []).append(r.main)
    assert all(got[i] == [f"Text {i}\nMore {i}"] for i in range(8))
    assert got[20] == [got[21][0]] * 2 and got[20][0].startswith("Big & <small>\nOne bold")
    assert got[22] == ["unclosed"] and got[23] == [""] and got[24] == [""] and got[25] == ["only main"]
    assert got[26] == ["deep"] and got[27] == ["plain & text < 5 > 3"] and got[28] == ["\n".join(["w w"] * 20000)]
    assert html_wrapper.extract_text(df.where("page_id < 0"), "url", "html").count() == 0


def test_pages_match_their_wrapper():
    import json
    rng = random.Random(6)

    def made(depth):
        return "".join(f"<{t}>{made(depth - 1) if depth else 'x'}</{t}>" + rng.choice(["", "text"])
                       for t in rng.choices(["div", "p", "h2", "ul", "table"], k=rng.randint(0, 4)))
    for _ in range(60):
        pages = [made(3) for _ in range(6)]
        wrapper = html_wrapper.merge_structures([json.dumps(html_wrapper.page_structure(p)) for p in pages])
        for page in pages:
            root, _ = html_wrapper.page_tree(list(html_wrapper.page_events(page)))
            assert html_wrapper.match_page(root, html_wrapper.number_nodes(json.loads(wrapper)))
    other, _ = html_wrapper.page_tree(list(html_wrapper.page_events("<div>a</div><div>b</div>")))
    assert not html_wrapper.match_page(other, [["div", "", [["#", "", [], 1, 2]], 0, 2]])


def test_wrapper_slots_decide(spark):
    # two slots of one tag path, told apart by their place in the wrapper; one is template text
    page = "<article><div>Share this</div><h1>Title {0}</h1><div>Body {0}</div></article>"
    df = spark.createDataFrame([(i, "http://w.example/", page.format(i)) for i in range(8)], "id long, url string, html string")
    got = {r.id: r.main for r in html_wrapper.extract_text(df, "url", "html").collect()}
    assert got == {i: f"Title {i}\nBody {i}" for i in range(8)}


def test_copies_are_not_template_evidence(spark):
    page = "<body><h1>Title</h1><p>Body of the page</p></body>"
    odd = "<body><h1>Own {0}</h1><table><tr><td>Cell {0}</td></tr></table></body>"
    rows = [(i, "http://copies.example/", page) for i in range(7)] + [(10 + i, "http://mixed.example/", page) for i in range(7)]
    rows += [(20 + i, "http://mixed.example/", odd.format(i)) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, url string, html string").repartition(3)
    got = {r.id: r.main for r in html_wrapper.extract_text(df, "url", "html").collect()}
    assert {got[i] for i in [*range(7), *range(10, 17)]} == {"Title\nBody of the page"}
    assert all(got[20 + i] == f"Own {i}\nCell {i}" for i in range(6))


def test_boilerplate_words_need_evidence(spark):
    page = ("<article data-id='search-12'><section id='discussion' class='discussion'><p>Own {0}</p></section><h2 id='related-work'>Work</h2>"
            "<div class='social-history'>Hist {0}</div><p id='ad-hoc-queries' title='class=ad'>Query {0}</p><svg-icon></svg-icon>"
            "<title-card>Card {0}</title-card><div class='related'><a href='/{0}'>Other {0}</a></div><nav class='menu'>Menu {0}</nav>"
            "<div class='share-buttons'>Tell a friend</div><div class='ad-box'>Buy {0}</div><p>End {0}</p></article>")
    rows = [(i, "http://many.example/", page.format(i)) for i in range(6)] + [(9, "http://one.example/", page.format(9))]
    df = spark.createDataFrame(rows, "id long, url string, html string")
    got = {r.id: r.main for r in html_wrapper.extract_text(df, "url", "html").collect()}
    for i in range(6):
        assert got[i] == f"Own {i}\nHist {i}\nQuery {i}\nCard {i}\nEnd {i}"      # the constant heading is template
    assert got[9] == "Own 9\nWork\nHist 9\nQuery 9\nCard 9\nTell a friend\nEnd 9"


def test_piece_query_gives_the_spans(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(30).collect()}
    seen = 0
    for r in piece_codec.op2_piece_codec(spark, SF).collect():
        if r.doc_id in docs:
            want = [(p.id, p.begin, p.end) for p in library.encode(docs[r.doc_id] or "", return_type="proto").pieces]
            assert list(zip(r.begins, r.ends))[:-1] == [w[1:] for w in want]
            assert r.n_tokens == len(r.begins) and r.ids_sha256 == brute.sha(" ".join(str(i) for i in [*(w[0] for w in want), 2]))
            seen += 1
    assert seen >= 30
