"""Operators that look at one text at a time, fingerprints, vectors, pages, mixing and the pipeline."""

import hashlib
import math
import random
import re
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from streetlens.llm import language_cnn, piece_bpe
from streetlens.llm.fingerprints import BINS, fingerprints, likeness, with_next
from streetlens.llm.html_text import extract_text, main_texts, page_blocks
from streetlens.llm.language_cnn import identify_language, learn
from streetlens.llm.licenses import Rules, scan_licenses
from streetlens.llm.mixing import fill_targets, mix_sources, mixed_documents, permuted, split_quotas
from streetlens.llm.piece_bpe import Encoder, MergeModel, encode_texts, merged
from streetlens.llm.token_trie import SHIFT, Trie, count_tokens, read_ranks
from streetlens.llm.vector_links import estimates, binary_code, link_vectors, table_plan

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "  ", "   x", "a  b", "▁▁a", "\n", "a\n\n b\tc", "日本語", "😀 x", "<s> </s>", "\x00a", " " * 300 + "q", "a" * 1200, "ab " * 400]


# ---- merge encoding ------------------------------------------------------------
@pytest.fixture(scope="module")
def encoder():
    return Encoder(MergeModel(PIECES)), sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_encoding_equals_the_library(encoder):
    own, library = encoder
    rng = random.Random(3)
    pieces = [p.replace("▁", " ") for p in library.id_to_piece(list(range(259, 32000)))]
    texts = ODD + ["".join(rng.choice("abcde thinor  \n▁.,éöñ日012") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    for text in texts:
        ids = memoryview(own.encode(text)).cast("I").tolist()
        assert ids == library.encode(text, add_bos=True, add_eos=True), text
        assert own.decode(ids) == library.decode(ids), text


def test_encoding_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (None, "a b", 6), (2, "", 7)], "doc_id long, text string, n_tokens int")
    got = {r["doc_id"]: (r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in encode_texts(docs, PIECES).collect()}
    ends = (1).to_bytes(4, "little") + (2).to_bytes(4, "little")
    assert got[1] == got[2] == (2, ends, "")
    assert got[None][2] == "a b"
    assert encode_texts(docs.limit(0), PIECES).collect() == []


def test_encoding_does_no_work_twice(encoder, monkeypatch):
    # the pieces are merged in the driver alone, pairs are judged without merging, and a word is laid once whatever follows a cut
    model = encoder[0].model
    monkeypatch.setattr(piece_bpe, "merged", lambda *_: pytest.fail("merged anew"))
    laid = []
    plain = Encoder._backtrack
    monkeypatch.setattr(Encoder, "_backtrack", lambda self, text: laid.append(text) or plain(self, text))
    own = Encoder(model)
    for text in ["a theningha theningha. theningha, theningha\n2024 theningha; theningha", " theningha  ", "日theningha theningha\tx"]:
        assert memoryview(own.encode(text)).cast("I").tolist() == encoder[1].encode(text, add_bos=True, add_eos=True)
        monkeypatch.setattr(piece_bpe, "merged", merged)  # runs of spaces are merged
    assert laid.count("▁theningha") == 1 and len(laid) == len(set(laid))


def test_pairs_stay_apart_as_in_merging(encoder):
    own = encoder[0]
    rng = random.Random(6)
    pieces = sorted(p for p in own.joint if "▁" not in p)
    short = [p for p in pieces if len(p) < 4 and p.isascii()]
    pairs = [(rng.choice(pieces), rng.choice(pieces)) for _ in range(5000)] + [(rng.choice(short), rng.choice(short)) for _ in range(10000)]
    pairs += [(p, p) for p in rng.sample(pieces, 2000)] + [("▁" + a, b) for a, b in pairs if "▁" + a in own.joint]
    verdicts = [own._apart(a, b) for a, b in pairs]
    assert not own.ties and {True, False} == set(verdicts)
    assert verdicts == [merged(a + b, own.score) == [a, b] for a, b in pairs]


def test_tables_of_the_encoder_are_bounded_and_change_nothing(encoder, monkeypatch):
    monkeypatch.setattr(piece_bpe, "REMEMBER", 16)
    own = Encoder(encoder[0].model)
    rng = random.Random(7)
    words = ["".join(rng.choice("thenirogaéñ日.,") for _ in range(rng.randint(1, 12))) for _ in range(300)] + ["x" * 65, "q" * 1001]
    for _ in range(60):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "\n", "  "]) for _ in range(40))
        assert memoryview(own.encode(text)).cast("I").tolist() == encoder[1].encode(text, add_bos=True, add_eos=True)
        for table, size in ((own.parts, 16), (own.starts, 2)):
            assert len(table) <= size and len(table.old) <= size and all(len(w) <= table.LONG for w in [*table, *table.old])
        assert own.n_steps <= 16 == piece_bpe.REMEMBER and sum(map(len, own.steps.values())) == own.n_steps
    own.forget()
    assert not (own.parts or own.parts.old or own.starts or own.starts.old or own.steps)


# ---- token counts ----------------------------------------------------------------
def test_trie_counts_equal_plain_segmentation():
    ranks = read_ranks(RANKS)
    trie = Trie(ranks)
    rng = random.Random(4)
    words = ["".join(rng.choice("abdehinorst é日") for _ in range(rng.randint(1, 14))) for _ in range(800)] + ["a" * 200]
    for word in words:
        raw = word.encode()
        best = [(0.0, 0)] + [(-math.inf, 0)] * len(raw)
        for end in range(1, len(raw) + 1):
            for start in range(end):
                if raw[start:end] in ranks:
                    way = (best[start][0] - math.log(ranks[raw[start:end]] + SHIFT), best[start][1] + 1)
                    if way[0] > best[end][0] or way[0] == best[end][0] and way[1] < best[end][1]:
                        best[end] = way
        assert trie.count([word, word]) == 2 * best[-1][1]


def test_trie_needs_all_bytes():
    with pytest.raises(ValueError):
        Trie({b"a": 0})


def test_token_counts_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "hello hello"), (3, "hello")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_pretokens"], r["n_tokens"]) for r in count_tokens(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert got[1] == got[2] == (0, 0) and got[None][0] == 2 and got[3][0] == 1
    assert count_tokens(docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


# ---- language --------------------------------------------------------------------
def test_language_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder.replace('sf0.001', 'sf0.01')}/documents.parquet").withColumn("score", F.lit("x"))
    rows = identify_language(docs).filter("held_out").select("lang", "lang_pred", "score").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    rows = [(k, "the cat and the hat " * 3 if k % 2 else "der hund und das haus " * 3, "en" if k % 2 else "de") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = learn(docs)
    odd = spark.createDataFrame([(None, "the cat"), (1, None), (2, ""), (3, "123 !"), (4, "the cat and the hat " * 50000)], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["held_out"]) for r in identify_language(odd, net).collect()}
    assert got[1][0] == got[2][0] == got[3][0] == "und" and got[4][0] == "en" and got[None] == ("en", False)
    none = identify_language(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in none.collect()} == {("und", 0.0)}
    assert identify_language(docs.limit(0)).collect() == []


def test_language_learns_from_a_bounded_number_of_rows(spark, monkeypatch):
    """Whatever repeats: rows of one id, whole rows, more languages than documents to learn from."""
    seen = []
    monkeypatch.setattr(language_cnn, "train", lambda windows, label, labels, **_: seen.append((len(windows), labels)) or "net")
    other = [(k, f"some text {k}", "en") for k in range(300)]
    same_id = [(500, f"ein text {k}", "de") for k in range(500)]
    copies = [(501, "un texte", "fr")] * 400
    assert crc32(b"500") % 3 != 1 and crc32(b"501") % 3 != 1
    docs = spark.createDataFrame(other + same_id + copies, "doc_id long, text string, lang string").repartition(7)
    assert learn(docs, 60) == "net" and seen == [(60, ["de", "en", "fr"])]
    many = spark.createDataFrame([(k, "a text", f"l{k:03d}") for k in range(90)] + [(k, "text", "l100") for k in range(9)], "doc_id long, text string, lang string")
    assert learn(many, 20) == "net" and seen[1][0] == 20 and len(seen[1][1]) == 20 and "l100" in seen[1][1]


# ---- mixing ----------------------------------------------------------------------
def test_targets_are_refilled():
    assert fill_targets([10, 100, 100], [3, 1, 2], 150.0, 2.0) == [20.0, 130 / 3, 260 / 3]
    assert fill_targets([], [], 0.0, 2.0) == [] and fill_targets([0], [1], 0.0, 2.0) == [0.0]


def test_quota_tree_is_exact():
    quotas = [0, 7, 1000, 123456]
    table = split_quotas(quotas, 13)
    assert table.sum(axis=1).tolist() == quotas
    assert np.ptp(table.sum(axis=0)) <= 1


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000])
def test_permutation(size):
    out = permuted(np.arange(size), np.full(size, size), np.full(size, 9))
    assert sorted(out.tolist()) == list(range(size))


def mixed_rows(spark):
    rng = random.Random(6)
    rows = [(k, " ".join("w%d" % rng.randrange(50) for _ in range(rng.choice([0, 3, 40, 200, 1500]))), rng.choice(["a", "b", "b", "b", "é", None]), 0) for k in range(300)]
    rows += [(1000, None, "a", 0), (None, "x y z", "z", 0), (7, rows[7][1], rows[7][2], 0), (5000, "long " * 30000, "b", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target int")


def test_mix_meets_targets(spark):
    docs = mixed_rows(spark)
    rows = mix_sources(docs).collect()
    assert len(rows) == docs.count()
    sizes, targets, taken = {}, {}, {}
    for r in rows:
        n = len(WORD.findall(r["text"] or ""))
        got = sum(p["n"] for p in r["pieces"])
        assert r["size"] == n and got <= 2 * n
        spans = sorted((p["pass"], p["lo"], p["n"]) for p in r["pieces"])
        assert all(a[0] < b[0] or a[1] + a[2] <= b[1] for a, b in zip(spans, spans[1:]))
        sizes[r["source"]] = sizes.get(r["source"], 0) + n
        taken[r["source"]] = taken.get(r["source"], 0) + got
        targets[r["source"]] = (r["target"], r["source_size"])
    names = sorted([s for s in sizes if s is not None]) + [None]
    want = fill_targets([sizes[s] for s in names], [(3, 1, 2)[k % 3] for k in range(len(names))], 1.5 * sum(sizes.values()), 2.0)
    for name, target in zip(names, want):
        assert targets[name] == (pytest.approx(target), sizes[name])
        assert abs(taken[name] - target) <= max(1, sizes[name] / 2048)
    again = mix_sources(docs.repartition(7)).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], str(r["pieces"]))
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_mixed_documents(spark):
    docs = mixed_rows(spark).drop("target")
    want = sum(sum(p["n"] for p in r["pieces"]) for r in mix_sources(docs).collect())
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(WORD.findall(r["text"])) for r in mixed.collect()) == want
    assert mix_sources(docs.limit(0)).collect() == []


# ---- fingerprints ------------------------------------------------------------------
def test_fingerprints_estimate_similarity(spark):
    rng = random.Random(8)
    a = ["w%d" % rng.randrange(10**6) for _ in range(600)]
    rows = [(0, " ".join(a), " ".join(a[:300] + ["q%d" % k for k in range(300)])), (1, "a b", "a b"), (2, None, ""), (3, "a b c", None), (4, " ".join(a), " ".join(a))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other string")
    left = fingerprints(docs).withColumnRenamed("fingerprint_bins", "x").withColumnRenamed("fingerprint", "fx")
    got = {r["doc_id"]: r for r in fingerprints(left, "other").withColumn("near", likeness(F.col("x"), F.col("fingerprint_bins"))).collect()}
    assert abs(got[0]["near"] - 296 / 896) < 0.15
    assert got[1]["near"] == got[2]["near"] == got[4]["near"] == 1.0 and got[3]["near"] == 0.0
    assert got[4]["fx"] == got[4]["fingerprint"] and len(got[1]["fx"]) == 2 * BINS and got[2]["fx"] == ""


def test_fingerprint_bins_follow_the_definition(spark):
    # a filled bin keeps the low bits of its smallest hash; empty ones walk to a filled one
    words = [f"w{k}" for k in range(40)]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    word_hash = F.transform(F.split("text", " "), lambda w: F.xxhash64(w))
    hashes = docs.select(F.transform(F.sequence(F.lit(0), F.lit(35)), lambda i: F.xxhash64(*(F.get(word_hash, i + k) for k in range(5)))).alias("h")).first()["h"]
    least = {}
    for h in sorted(hashes):
        least.setdefault((h >> 57) + 64, h)
    from streetlens.llm.fingerprints import _START, _STEP

    want = [next(least[x] for x in [b, *((s + k * d) % 128 for k in range(128))] if x in least) & 255 for b, (s, d) in enumerate(zip(_START, _STEP))]
    assert fingerprints(docs).first()["fingerprint_bins"] == want


def test_next_document(spark):
    rows = [(k * k % 101, f"t{k}") for k in range(60)] + [(None, "n")]
    rows = list({i: (i, t) for i, t in rows}.values())
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for buckets in (1, 2, 7, 500):
        got = {r["doc_id"]: r["next_text"] for r in with_next(spark.createDataFrame(rows, "doc_id long, text string"), ["text"], max(2, buckets)).collect()}
        assert got == {a[0]: b[1] for a, b in zip(order, order[1:] + order[:1])}
    one = with_next(spark.createDataFrame([(5, "x")], "doc_id long, text string"), ["text"]).collect()
    assert [r["next_text"] for r in one] == ["x"]
    same = with_next(spark.createDataFrame([(5, "x"), (5, "x"), (5, "y")], "doc_id long, text string"), ["text"]).collect()
    assert sorted(r["next_text"] for r in same) == ["x", "x", "y"]
    assert with_next(spark.createDataFrame([], "doc_id long, text string"), ["text"]).collect() == []


# ---- vectors -------------------------------------------------------------------------
def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 64))
    x[150:] = x[:150] + 0.5 * rng.normal(size=(150, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    code, factor, turned = binary_code(x)
    near, bound = estimates(code, factor, turned)
    error = near - x @ x.T
    assert abs(error[~np.eye(300, dtype=bool)].mean()) < 0.01
    assert (np.abs(error) <= bound[:, None] + 1e-6).mean() > 0.999


def test_links_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(100 + k, (base[k % 20] + 0.05 * rng.normal(size=16)).tolist()) for k in range(300)]
    rows += [(500, base[0].tolist()), (501, base[0].tolist()), (502, None), (503, [0.0] * 16), (504, [float("nan")] * 16), (505, [None] * 16), (506, []), (507, (2 * base[1]).tolist()), (508, base[2][:8].tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in link_vectors(vectors, recall=0.9999).collect()}
    ok = {i: np.array(v) for i, v in rows if v and len(v) == 16 and None not in v and np.isfinite(v).all() and np.any(v)}
    links = {i: [j for j in ok if j != i and ok[i] @ ok[j] / np.linalg.norm(ok[i]) / np.linalg.norm(ok[j]) >= 0.95] for i in ok}
    true = sum(map(len, links.values()))
    found = sum(n for n, _, _ in got.values())
    assert all(got[i][0] <= len(links.get(i, [])) for i in got) and found >= 0.99 * true
    assert got[502] == (0, 502, True) and got[503][0] == got[505][0] == got[508][0] == 0
    assert got[501][1] == 0 and not got[501][2] and got[0][2]
    assert link_vectors(vectors.limit(0)).collect() == []


def test_links_of_repeated_ids(spark):
    v, w = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, v), (1, v), (1, w), (2, v), (None, v)]
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (1, 0, 1), (2, 2, 1), (None, 0, None)], key=str)


def test_more_vectors_need_more_signs_and_tables():
    few, many = table_plan(1000, 0.95, 0.99), table_plan(10**9, 0.95, 0.99)
    assert few[0] < many[0] and few[1] < many[1]


# ---- pages ----------------------------------------------------------------------------
PAGE = """<html><head><title>x</title><script>if(a<b)document.write("</p>")</script></head><body class="has-sidebar"><header><h1>Site</h1></header>
<div id="cookie-notice">We use</div><main><article><header><h1>T &eacute;</h1></header><p class=ad>Buy<p>One&nbsp;two <b>three</b><br>four &lt;x&gt;
<ul><li>a<li>b</ul><form><input name=q>Search</form><aside>rel</aside><div class="comments"><p>hey</p></div></article></main><footer>&copy;</footer>"""


def test_blocks_of_a_page():
    assert [t for place, t in page_blocks(PAGE) if place == 0] == ["T é", "One two three four <x>", "a", "b"]
    assert list(page_blocks("")) == [] and list(page_blocks("<p>a<!-- x")) == [(2, "a")]


def test_repeated_runs_go_outside_articles():
    notice = "please read our terms of use before going on with this site"
    pages = [f"<body><div>{notice}</div><div>u{k} v{k} {notice} w{k}</div></body>" for k in range(3)]
    assert main_texts(pages) == [f"u{k} v{k} w{k}" for k in range(3)]
    assert main_texts(pages[:1]) == [f"{notice}\nu0 v0 {notice} w0"]


def test_text_beside_an_article_stays():
    notice = "please read our terms of use before going on with this site"
    pages = [f"<body><div>{notice}</div><div>u{k} v{k}</div><article>card {k}</article></body>" for k in range(3)]
    assert main_texts(pages) == [f"u{k} v{k}\ncard {k}" for k in range(3)]


@pytest.mark.parametrize("around", ['div class="has-sidebar"', 'div id="layout-no-sidebar"', 'div class="search-result-page"', 'div class="social"'])
def test_names_of_a_wrapper_leave_its_article(around):
    page = f'<body><{around}><article><p>text<div class="comments"><article>reply</article></div></article><p>end</div><p>after'
    assert [t for place, t in page_blocks(page) if place == 0] == ["text"]
    assert [t for place, t in page_blocks(f"<{around}><main>text</main></div>") if place == 0] == ["text"]
    assert (2, "after") in page_blocks(page) and ((2, "end") in page_blocks(page)) == ("sidebar" in around)
    assert [place for place, _ in page_blocks(f"<aside><{around}><article>card</article></div></aside>")] == [1]


@pytest.mark.parametrize("name", [
    'class="share-price"', 'class="menu-card"', 'class="notice-period"', 'class="ad-1950"', 'id="comment-on-law"', 'class="court-notice"', 'class="entry-header"'])
def test_names_inside_an_article_must_say_nothing_else(name):
    assert main_texts([f"<article><p>One.</p><div {name}><p>Two.</p></div></article>"]) == ["One.\nTwo."]


@pytest.mark.parametrize("name", ['class="advert"', 'class="x comment-list"', 'id="adSlot"', 'class="related_posts"', 'class="cookie-notice"', 'role="search"'])
def test_adverts_and_comments_inside_an_article_go(name):
    assert main_texts([f"<article><p>One.</p><div {name}><p>Two.</p></div><p>Three.</p></article>"]) == ["One.\nThree."]


def test_names_outside_an_article():
    assert main_texts(['<div class="search-theory"><p>A text.</p></div><div class="sidebar-left">No.</div><div id="siteHeader">No.</div>']) == ["A text."]


def test_what_stands_within_a_line():
    page = '<p>Choose <label>a value</label> and <button>press</button> go<script>x()</script> on <span hidden>never</span> <span class="ad">buy</span> here.</p>'
    assert main_texts([page]) == ["Choose a value and go on here."]
    assert main_texts(["<form><label>Name</label></form><p>Text</p>"]) == ["Text"]
    assert main_texts(['<app-shell class="has sidebar"><article>Text <b class="ad">buy</b> on</article></app-shell>']) == ["Text on"]


def test_formulas_stay():
    page = "<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds</article>"
    assert main_texts([page])[0].replace(" ", "").replace("\n", "") == "sox=2holds"


def test_runs_are_found_over_the_whole_host(spark):
    # a notice on few pages, a menu's and an article's words elsewhere: as on one host in memory, however large
    rng = random.Random(9)
    word = lambda: "w%d" % rng.randrange(10**6)
    make = lambda n: " ".join(word() for _ in range(n))
    notice, quoted, listed = make(12), make(15), make(9)
    pages = []
    for k in range(1200):
        extra = notice if k in (3, 900) else quoted if k == 40 else listed if k == 77 else make(3)
        tail = f"<article>{quoted}</article>" if k == 800 else f"<nav>{listed}</nav>" if k == 1100 else ""
        pages.append(f"<body><div>{make(20)}</div><p>{extra}<p>{make(2)}{tail}")
    rows = [(k, f"http://a/{k}", p) for k, p in enumerate(pages)] + [(5000, "http://b/1", f"<p>{notice}")]
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = main_texts(pages)
    assert got == {**dict(enumerate(want)), 5000: notice}
    assert not any(x in want[k] for k, x in ((3, notice), (900, notice), (40, quoted), (77, listed))) and quoted in want[800]


def test_pages_of_odd_rows(spark):
    rows = [(1, "http://a/1", PAGE), (2, None, None), (None, "http://a/2", ""), (1, "http://a/1", PAGE), (3, "x", "<article>" + "<p>w" * 20000)]
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()), key=str)
    article = "T é\nOne two three four <x>\na\nb"
    assert got == sorted([(1, article, len(article)), (1, article, len(article)), (2, "", 0), (None, "", 0), (3, "\n".join(["w"] * 20000), 39999)], key=str)
    assert extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# ---- licences ---------------------------------------------------------------------------
def test_rules_take_sentences_in_order(spark):
    rules = Rules({"a": "First one.", "b": "Second one!", "c": "Third."}, [("ab", "L1", ["a", "b"]), ("b", "L2", ["b"]), ("c", "L3", ["c"])])
    rows = [(1, "FIRST one. other words. Second-one!"), (2, "Second one! First one."), (3, None), (4, ""), (5, "Third\nthird. First one. Third. Second one!"), (6, "First   one")]
    got = {r["doc_id"]: (r["n_sentences"], r["n_known"], r["found_rules"], r["licenses"]) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").withColumn("licenses", F.lit(1)), rules).collect()}
    assert got == {
        1: (3, 2, ["ab"], ["L1"]), 2: (2, 2, ["b"], ["L2"]), 3: (0, 0, [], []), 4: (0, 0, [], []),
        5: (5, 5, ["ab", "c"], ["L1", "L3"]), 6: (1, 1, [], []),
    }
    with pytest.raises(ValueError):
        Rules({"a": "One. Two."}, [])
    with pytest.raises(ValueError):
        Rules({"a": "One."}, [("x", "L", ["b"])])


MIT = """Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = BSD + """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def test_licences_over_several_lines(spark):
    want = {MIT: ("mit_text", 3), BSD: ("bsd_2_text", 3), BSD_3: ("bsd_3_text", 4), ISC: ("isc_text", 1), GPL: ("gpl_3_later_header", 2), APACHE: ("apache_header", 5)}
    marks = ["{}", "# {}", " * {}", "// {}", ";; {}", "! {}", "dnl {}", "REM {}", "<!-- {} -->", "{}\r"]
    rows = [(text, "\n".join(m.format(line) for line in text.split("\n"))) for text in want for m in marks]
    rows += [(text, f"/*\n{text}\n */\nint x;") for text in want]
    docs = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(rows)], "doc_id long, text string")
    for r in scan_licenses(docs).collect():
        rule, known = want[rows[r["doc_id"]][0]]
        assert (r["found_rules"], r["n_known"]) == ([rule], known), rows[r["doc_id"]][1]


def test_lines_of_a_known_sentence_count_once(spark):
    rules = Rules({"a": "First one.", "b": "First one is here."}, [("a", "L1", ["a"]), ("b", "L2", ["b"])])
    rows = [(1, "first\none. x"), (2, "first\n\none"), (3, "no first\none"), (4, "x\nfirst one\nis here\ny"), (5, "\n" * 30000 + "first one")]
    got = {r["doc_id"]: (r["n_sentences"], r["n_known"], r["found_rules"]) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), rules).collect()}
    assert got == {1: (2, 1, ["a"]), 2: (2, 0, []), 3: (2, 0, []), 4: (3, 1, ["b"]), 5: (1, 1, ["a"])}


def test_native_plans_have_no_python(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for frame in (scan_licenses(docs), fingerprints(docs)):
        assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().executedPlan().toString())


# ---- pipeline ----------------------------------------------------------------------------
def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    words = {"en": "the of and to in that it was for with".split(), "de": "der die und das ist nicht mit auf sich den".split()}
    rows = []
    for k in range(80):
        lang = "en" if k % 3 else "de"
        text = " ".join(rng.choice(words[lang]) + rng.choice(["", "s", "a", "ou", "xt"]) for _ in range(rng.randint(60, 150)))
        rows.append((k, text, lang, f"s{k % 4}", len(text)))
    rows += [(200 + k, rows[k][1], rows[k][2], "s0", rows[k][4]) for k in range(10)]
    rows += [(300, "12 34 !", "en", "s1", 7), (301, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    ids = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        ids.append({r["doc_id"] for r in docs.collect()})
        assert docs.columns == columns or name == "tokens"
    assert ids[0] == set(range(80)) | set(range(200, 210))
    assert ids[1] == set(range(80)) == ids[2]
    assert ids[3] == ids[4] <= ids[2]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {(r["doc_id"], hashlib.sha256(np.array(library.encode(r["text"], add_bos=True, add_eos=True), "<u4").tobytes()).hexdigest()) for r in spark.read.parquet(f"{tmp_path}/mixture").collect()}
    assert texts == {(r["doc_id"], hashlib.sha256(r["ids"]).hexdigest()) for r in docs.collect()}


def test_repeated_rows_leave_one_document(spark):
    import corpus_pipeline

    text = "one two three four five six seven"
    rows = [(1, text, "b"), (1, text, "a"), (1, text, "a"), (2, text, "a"), (3, "other words", "a"), (3, "more words", "a"), (None, "x", "a"), (None, "x", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, text, "a"), *rows[4:]], key=str)


CLASHING = ["size", "kept", "score", "_pass", "lang_pred", "held_out", "target", "pieces", "n_words", "_twice", "_copy", "_uid", "Source_Size"]


def test_stages_keep_own_columns_and_stand_odd_rows(spark):
    import corpus_pipeline

    prose = "The quiet river runs below the old stone bridge and the children watch it all day long. "
    texts = [prose * 3, prose * 3, None, "", " \t", "short one", prose * 2000, "Der stille Fluss fließt unter der alten Brücke. " * 4, prose * 3]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 1]
    own = ", ".join(f"`{c}` {'long' if c == 'size' else 'string'}" for c in CLASHING)
    rows = [(i, t, "en" if i != 8 else "de", "s", len(t or ""), {"k": "v"}, *(1000 if c == "size" else "mine" for c in CLASHING)) for i, t in zip(ids, texts)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, tags map<string,string>, {own}")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "")
        assert got.columns == docs.columns, name
        found = got.collect()
        assert found and all(r[c] == (1000 if c == "size" else "mine") for r in found for c in CLASHING), name
        assert stage(spark, docs.limit(0), "").collect() == [], name
        if name == "language":  # what stays keeps its text, whatever its length
            assert any(r["text"] == texts[6] for r in found)
    # the mix counts words itself: a tenth of a thousand
    mixed = corpus_pipeline.mixture(spark, docs.filter("doc_id = 6"), "").collect()
    assert sum(len(WORD.findall(r["text"])) for r in mixed) == 3
    last = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.tokens(spark, docs, "").collect()}
    assert last[3] == last[4] == 2 and last[7] > 2000
