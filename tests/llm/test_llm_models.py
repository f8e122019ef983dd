"""Language ID, toxicity, HTML, nearest neighbours, the pipeline."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from quarry.llm import html_text, language_id, mixing, permutation_index, toxicity
from quarry.llm.common import table

SMALL = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = table(spark, SMALL, "documents")
    rows = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_language_edges(spark):
    rows = [(i, t, "en" if i % 2 else "de") for i, t in enumerate(["der und die " * 5, "the and of " * 5] * 20)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "123 !?", "en"), (103, "the of " * 20_000, None), (None, "der und", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = language_id.identify(docs.union(docs.where("doc_id = 0"))).collect()
    assert len(got) == len(rows) + 1
    pred = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert pred[100] == pred[101] == pred[102] == ("und", 0.0)
    assert pred[103][0] == "en" and pred[None][0] == "de" and pred[0][0] == "de" and pred[1][0] == "en"
    assert language_id.identify(docs.limit(0)).count() == 0
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unknown).collect()} == {"und"}


def test_language_batch_independent():
    text = "Die schöne Welt, und 12 Häuser"
    a = language_id.ngram_counts(text)
    assert a.sum() > 20 and (a == language_id.ngram_counts(text.upper())).all() and language_id.ngram_counts("12 --") is None


def plain_ngrams(text):
    """The hashed counts by loops over characters."""
    codes, last = [0], False
    for ch in text.lower():
        if ch.isalpha():
            codes.append(ord(ch))
        elif last:
            codes.append(0)
        last = ch.isalpha()
    codes.append(0)
    out, m = np.zeros(language_id.DIMS, int), (1 << 32) - 1
    for i in range(len(codes) - 1):
        two = codes[i] * 0x9E3779B1 + codes[i + 1] * 0x85EBCA77 & m
        out[(two * 0x165667B1 & m) >> 20] += 1
        if i + 2 < len(codes):
            out[((two ^ codes[i + 2] * 0xC2B2AE3D & m) * 0x27D4EB2F & m) >> 20] += 1
    return out


def test_language_equals_plain_nearest_centroid(spark):
    docs = table(spark, SMALL, "documents").where("doc_id < 300")
    model = language_id.learn(docs.where(~language_id.held_out()))
    texts = {r.doc_id: r.text for r in docs.collect()}
    # document frequencies over all learning documents
    known = [r.text for r in docs.where(~language_id.held_out()).where("lang is not null").collect()]
    seen = [plain_ngrams(t) > 0 for t in known if any(c.isalpha() for c in t)]
    assert np.allclose(model["idf"], np.log((1 + len(seen)) / (1 + np.sum(seen, 0))) + 1)
    for r in language_id.predict(docs, model).collect():
        counts = plain_ngrams(texts[r.doc_id])
        v = [np.log(1 + c) * w for c, w in zip(counts, model["idf"], strict=True)]
        norm = sum(x * x for x in v) ** 0.5
        near = [sum(a * b for a, b in zip(v, c, strict=True) if a) / norm for c in model["centres"].astype(float)]
        best = max(range(len(near)), key=lambda i: near[i])
        assert abs(r.score - near[best]) < 1e-4 and near[model["langs"].index(r.lang_pred)] <= near[best]
        assert r.lang_pred == model["langs"][best] or max(n for n, g in zip(near, model["langs"], strict=True) if g == r.lang_pred) > near[best] - 1e-5


def test_toxicity_equals_plain_ftrl(spark):
    g = np.random.default_rng(6)
    words = [f"w{i}" for i in range(40)] + ["awful", "rotten"]
    rows = [(i, " ".join(g.choice(words[:40], 8)) + (" awful rotten" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))

    def coordinates(text):
        m, out, own = (1 << 64) - 1, set(), [w.lower() for w in text.split()]
        mix, crc = 0x9E3779B97F4A7C15, lambda w: zlib.crc32(w.encode())
        for i, w in enumerate(own):
            out.add((crc(w) * mix & m) >> 44)
            out |= {((crc(w[:n]) + n) * 0xD6E8FEB86659FD93 & m) >> 44 for n in (5, 7) if len(w) > n}
            for gap, salt in ((1, 0xBF58476D1CE4E5B9), (2, 0x94D049BB133111EB)):
                if i + gap < len(own):
                    out.add((((crc(w) * mix & m) ^ (crc(own[i + gap]) * salt & m)) * mix & m) >> 44)
        return [*out, toxicity.BIAS]

    order = sorted(rows, key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0]))
    z, n = {}, {}

    def weight(j):
        a = z.get(j, 0.0)
        return 0.0 if abs(a) <= 8 else -(a - np.sign(a) * 8) / (1 + n.get(j, 0.0) ** 0.5 + 1)

    for _ in range(8):
        for _, text, y in order:
            at = coordinates(text)
            w = {j: weight(j) for j in at}
            grad = 1 / (1 + np.exp(-sum(w.values()))) - y
            for j in at:
                step = (n.get(j, 0.0) + grad * grad) ** 0.5 - n.get(j, 0.0) ** 0.5
                z[j] = z.get(j, 0.0) + grad - step * w[j]
                n[j] = n.get(j, 0.0) + grad * grad
    want = {j: weight(j) for j in z if weight(j)}
    assert want.keys() == found.keys() and all(abs(want[j] - found[j]) < 1e-9 for j in want)
    for r in toxicity.score(docs, found).collect():
        total = sum(want.get(j, 0.0) for j in coordinates(rows[r.doc_id][1]))
        assert abs(r.score - 1 / (1 + np.exp(-total))) < 1e-9


def test_toxicity_held_out(spark):
    g = np.random.default_rng(0)
    plain = [f"word{i}" for i in range(300)]
    bad = ["awful", "rotten", "vile"]
    rows, labels = [], []
    for i in range(1500):
        words = list(g.choice(plain, 30))
        toxic = int(g.random() < 0.2)
        if toxic:
            words[5], words[9] = g.choice(bad, 2)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    docs = spark.createDataFrame(rows + [(5000, None), (5001, ""), (None, "vile"), (5002, "ok " * 50_000)], "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(None, 1, 1), (77777, 0, 0), (3, 1, None)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(docs.union(docs.where("doc_id = 1")), marks).collect()
    assert len(out) == 1505
    want = {i: t for i, _, t in labels}
    held = [r for r in out if r.doc_id in want and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert sum(r.predicted == want[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert toxicity.toxicity(docs.limit(0), marks).count() == 0
    assert {r.score for r in toxicity.toxicity(docs, marks.limit(0)).collect()} == {0.0}


def test_ftrl_is_sparse():
    g = np.random.default_rng(2)
    rows = [(np.append(np.unique(np.append(g.integers(10, 5000, 30), [7] * (i % 2))), toxicity.BIAS).astype(int), i % 2)
            for i in range(400)]
    w = toxicity.ftrl(rows)
    assert w[7] > 1 and np.count_nonzero(w) < 60


# ------------------------------------------------------------------ html
PAGE = ("<html><head><title>t</title><style>p{}</style></head><body class='page has-sidebar'><header><h1>Site</h1></header>"
        "<nav><ul><li><a href='/a'>Menu</a></li></ul></nav><div class='cookie-notice'>We use cookies</div>{article}"
        "<aside>Side</aside><div id='comments'><p>first!</p></div><form><label>Mail</label></form><footer>&copy; x</footer></body></html>")


def text_of(html, noise=frozenset()):
    return html_text.main_text(html_text.parse(html), noise)


def test_blocks_and_references():
    art = "<article><header><h1>T &amp; U</h1><p>by x</p></header><p>one <b>two</b><br>three&nbsp;four<p>five &lt;p&gt;<script>var a='</p>';</script></article>"
    assert text_of(PAGE.replace("{article}", art)) == "T & U\none two three four\nfive <p>"
    assert text_of(PAGE.replace("{article}", "<div class='story'><h2>A</h2>b<ul><li>c<li>d</ul></div>")) == "A\nb\nc\nd"
    assert text_of("") == "" and text_of("just text &am") == "just text &am"
    assert text_of("<article><p>cut off <b>here &amp") == "cut off here &"
    assert text_of("<article><p>a</p><p title='x") == "a"
    assert text_of("<p>a<!-- no --> b</p><!-- open <p>c</p>") == "a b"
    assert text_of("<article><p>" + "w " * 100_000 + "</p></article>") == " ".join(["w"] * 100_000)
    assert text_of("<" * 20_000 + "a") == "<" * 19_999


def test_names_are_whole_tokens_and_regions_stay():
    art = "<article><p>Story</p></article>"
    for mark in ("class='layout has-sidebar'", "class='content-sidebar'", "class='search'", "id='header'", "class='sidebar share'"):
        assert text_of(f"<body><div {mark}>{art}</div></body>") == "Story", mark
        assert text_of(f"<body><div {mark}><main><p>Story</p></main></div></body>") == "Story", mark
    assert text_of(f"<form id='form1'><div class='menu'>Menu</div>{art}</form>") == "Story"
    assert text_of("<div class='related'><article>Only text</article></div>") == "Only text"
    # slug ids of headings and sections
    assert text_of("<article><h2 id='related-work'>Related work</h2><p>a</p><h2 id='search'>Search</h2><p>b</p>"
                   "<section id='search-results'><h3>Results</h3><p>c</p></section><section id='comments'><p>first!</p></section>"
                   "<div id='legal' class='section level2'><p>e</p></div></article>") == "Related work\na\nSearch\nb\nResults\nc\ne"
    assert text_of("<article><h2 id='comments'>Comments on the law</h2><p>a</p></article>") == "Comments on the law\na"
    assert text_of("<article><table><tr class='header'><th>k</th></tr><tr><td>v</td></tr></table></article>") == "k\nv"
    # what is declared still goes
    for mark in ("class='cookie-notice'", "class='site-footer'", "id='comments'", "class='x sidebar'", "class='relatedLinks'",
                 "id='ad-300'", "role='search'", "class='left-sidebar'", "class='main-menu'", "class='menu-main-container'",
                 "class='top-nav'", "id='cookiebar'", "class='user-comments'"):
        assert text_of(f"<div {mark}>no</div>{art}") == text_of(f"<article><p>Story</p><div {mark}>no</div></article>") == "Story", mark
    for cards in ("<div class='related'><article>Teaser</article></div>", "<aside><article>Teaser</article></aside>",
                  "<div id='comments'><article class='comment-body'>first!</article></div>", "<article class='teaser'>t</article>"):
        assert text_of(f"<main><p>Story</p></main>{cards}") == text_of(f"{art}{cards}") == "Story", cards


def test_deep_markup_is_linear():
    import time
    import tracemalloc
    n = 20_000
    for page in ("<div class='x'>a" * n, "<nav>" * n + "<article>Story", "<span>" * n + "<h2>t</h2>" * n, "<b>x</i>" * n, "<ul><li>" * n):
        tracemalloc.start()
        began = time.process_time()
        text_of(page)
        took, most = time.process_time() - began, tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert took < 20 and most < 100e6, (page[:20], took, most)
    assert text_of("<div>" * 100_000 + "deep") == "deep"


def test_entropies_equal_brute_force(spark):
    g = np.random.default_rng(8)
    pages = []
    for i in range(60):
        zone = ["<p>same</p>", f"<p>text {g.integers(0, 6)}</p>", f"<p>{i}</p><ul><li>x</li></ul>"][int(g.integers(0, 3))]
        pages.append((i, "http://h.example.com/a", f"<div class='top'><b>Menu</b></div><div class='mid'>{zone}</div><div><div>in</div></div>"))
    found, seen = {}, {}
    for _, _, html in pages:
        top, mid = html.split("<div class='mid'>")[0], html.split("<div class='mid'>")[1].split("</div>")[0]
        for name, inner in (("top", top), ("mid", mid)):
            tags = [t for t in ("p", "ul") if f"<{t}>" in inner] if name == "mid" else []
            found.setdefault(name, []).append((tuple(__import__("re").findall(">([^<]+)<", ">" + inner + "<")), tuple(tags)))
            seen[name] = seen.get(name, 0) + 1

    def entropy(values):
        n = len(values)
        counts = [values.count(v) for v in set(values)]
        return -sum(c / n * np.log(c / n) for c in counts) / np.log(n)

    want = {(seen[k], round(entropy([c for c, _ in v]), 9), round(entropy([t for _, t in v]), 9)) for k, v in found.items()}
    tree = html_text.style_tree(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    got = {(r.seen, round(r.content, 9) + 0.0, round(r.presentation, 9) + 0.0) for r in tree}
    assert {(n, abs(a), abs(b)) for n, a, b in want} <= {(n, abs(a), abs(b)) for n, a, b in got}


def test_site_noise_goes_and_repeated_articles_stay(spark):
    rows = []
    for i in range(40):
        # no declared names: only the style tree can tell the banner from the story
        rows.append((i, f"https://site.example.com/{i}", f"<body><div class='zone1'>Buy our thing now</div>"
                     f"<div class='zone2'><p>Story {i} text {i * 7}</p></div></body>"))
        rows.append((100 + i, f"http://other.example.com/{i}", "<article><p>The same article</p></article><div class='z'>x</div>"))
    rows += [(500, None, None), (501, "odd", ""), (502, "https://site.example.com/x", "<div class='zone1'>Buy our thing now</div>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("noise", F.lit(1))
    got = {r.page_id: r for r in html_text.extract(pages.union(pages.where("page_id = 0"))).collect()}
    assert len(got) == len(rows)
    assert all(got[i].text == f"Story {i} text {i * 7}" and got[100 + i].text == "The same article" for i in range(40))
    assert got[500].text == got[501].text == got[502].text == "" and got[0].n_chars == len(got[0].text)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_tree_decides_beside_an_article(spark):
    rows = [(i, f"https://mag.example.com/{i}", f"<body><div class='strip'>Same on every page</div><h1>Headline {i}</h1><div class='lead'>Lead {i}</div>"
             f"<div id='content'><p>Text {i}</p></div><article class='card'>Card {i}</article></body>") for i in range(20)]
    rows.append((99, "https://few.example.com/1", "<div class='strip'>Seen once</div><article>A</article>"))
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got.pop(99) == "Seen once\nA"
    assert got == {i: f"Headline {i}\nLead {i}\nText {i}\nCard {i}" for i in range(20)}


def test_articles_of_the_test_pages(spark):
    import html as h
    import re
    pages = table(spark, SMALL, "pages")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        m = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)
        cut = re.sub(r"<[^>]*$", "", re.sub(r"</?b>", "", re.sub("<br>", " ", re.sub(r"</?(p|h1)>", "\x00", m[1] if m else ""))))
        assert got[r.page_id] == "\n".join(filter(None, (" ".join(h.unescape(x).split()) for x in cut.split("\x00"))))


# ------------------------------------------------------------------ neighbours
def brute(rows, k=10, every=100):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v
          and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    x = np.stack([v for _, v in ok])
    ids = np.array([i for i, _ in ok])
    out = {}
    for i, v in ok:
        if i % every == 0:
            d = np.sqrt(((x - v) ** 2).sum(1))
            o = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(d[j])) for j in o]
    return out


def test_neighbours_with_copies_and_odd_vectors(spark):
    g = np.random.default_rng(4)
    base = g.normal(size=(600, 8)).astype(np.float32)
    base[200:430] = base[200]  # a group of copies, queries among them
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    odd = [(1000, None), (1100, [0.0] * 8), (1200, [float("nan")] * 8), (1300, [1.0, None] * 4), (1400, [float("inf")] * 8),
           (1500, [1.0, 2.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows + odd + [rows[300], rows[5]], "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = {}
    for r in permutation_index.neighbours(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(rows)
    assert set(got) == set(want)
    hit = 0
    for q, found in got.items():
        assert [f[0] for f in found] == list(range(1, 11))
        near = {i: d for i, d in want[q]}
        hit += sum(f[1] in near for f in found)
        assert all(abs(near[f[1]] - f[2]) < 1e-12 for f in found if f[1] in near)
    assert hit >= 0.9 * 10 * len(want)
    assert [f[1] for f in got[300]] == [i for i, _ in want[300]]  # copies: ties to the smaller id


def test_neighbours_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert permutation_index.neighbours(empty).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<float>")
    rows = permutation_index.neighbours(few).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in rows] == [(0, 1, 2), (0, 2, 1)]
    one = few.limit(1)
    assert permutation_index.neighbours(one).count() == 0


def test_recall_on_the_test_table(spark):
    df = table(spark, SMALL, "embeddings")
    rows = [(r.vec_id, list(r.embedding) if r.embedding else None) for r in df.collect()]
    want = brute(rows)
    got = {}
    for r in permutation_index.neighbours(df).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    found = sum(i in got[q] for q, near in want.items() for i, _ in near)
    assert found >= 0.9 * sum(map(len, want.values()))


# ------------------------------------------------------------------ pipeline, registration
def test_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert any(k.startswith(f"op{n}_") for k in names), n
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "secret_scans", "mixing", "byte_bpe"]


def test_pipeline_stages(spark):
    docs = table(spark, SMALL, "documents")
    now, before = docs, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.staged(stage(spark, now, SMALL), f"test_{name}")
        assert now.columns == docs.columns
        n = now.count()
        assert (n < before) if name in ("quality_rules", "simhash_near_dedup") else n >= before
        before = n
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() == before
    labels = table(spark, SMALL, "labels")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SMALL).select("doc_id")
    good = labels.where("quality = 1")
    assert good.join(kept, "doc_id").count() >= 0.95 * good.count()


def test_mixing_keeps_every_document_of_a_hot_source(spark):
    docs = table(spark, SMALL, "documents")
    more = spark.range(1, 10).select(F.col("id").alias("k"))
    hot = docs.where("lang = 'es'").crossJoin(more).withColumn("doc_id", F.col("doc_id") + F.col("k") * 1_000_000_000)
    hot = docs.unionByName(hot.select(*docs.columns))
    labels = mixing.domain_labels(hot, table(spark, SMALL, "labels"))
    assert all(r.rate >= 1 and r.copies >= 1 for r in mixing.mixing_plan(hot, labels).collect())
    ids = hot.select("doc_id").distinct()
    assert ids.join(mixing.mix(hot, labels), "doc_id", "left_anti").count() == 0
    # memberships too alike for the targets: the bound holds, the targets are only approached
    rows = spark.createDataFrame([(i, 10, [0.5 + i % 3 / 100, 0.5 - i % 3 / 100]) for i in range(30)],
                                 "doc_id long, n_tokens long, p array<double>")
    out, _ = mixing.fit_rates(rows, ["a", "b"], {"a": 0.9, "b": 0.1}, least=1.0)
    assert all(r.rate >= 1 for r in out.collect())


@pytest.mark.parametrize("stage", range(4))
def test_stages_take_empty_documents(spark, stage):
    docs = table(spark, SMALL, "documents").limit(0)
    assert corpus_pipeline.STAGES[stage][1](spark, docs, SMALL).count() == 0
