"""Line field, language model, page extraction and neighbours."""

from __future__ import annotations

import html
import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from vitrine.llm import ann, html_text, langid, quality
from vitrine.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    edges = np.array([0, 4, 5, 8])
    emit, steps = rng.normal(size=(8, 2)), rng.normal(size=(2, 2))
    good, pairs, z = quality.marginals(emit, edges, steps)
    for begin, end, total in zip(edges[:-1], edges[1:], z):
        weights = {}
        for labels in itertools.product((0, 1), repeat=end - begin):
            value = sum(emit[begin + t, y] for t, y in enumerate(labels))
            weights[labels] = np.exp(value + sum(steps[a, b] for a, b in zip(labels, labels[1:])))
        everything = sum(weights.values())
        assert np.isclose(np.log(everything), total)
        for t in range(end - begin):
            assert np.isclose(good[begin + t], sum(w for y, w in weights.items() if y[t]) / everything)


def test_quality_on_held_out_labels(spark):
    found = QUERIES["op3_quality_crf"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = found.where("held_out").join(labels, "doc_id").select("predicted", "quality").collect()
    assert len(rows) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95


def test_quality_on_edge_rows(spark, edge_documents, no_documents):
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for labels in (empty, spark.createDataFrame([(1, 1), (6, 0), (None, 1), (7, None), (1, 1)], "doc_id bigint, quality int")):
        field = quality.train(edge_documents, labels)
        rows = quality.predict(edge_documents.withColumn("quality_score", F.lit("mine")), field).collect()
        assert len(rows) == edge_documents.count()
        assert all(0 <= r["quality_score"] <= 1 for r in rows)
        assert quality.predict(no_documents, field).count() == 0


def test_language_on_held_out_rows(spark):
    found = QUERIES["op7_language_nb"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97


def test_language_counts_match_brute_force(spark, edge_documents, no_documents):
    model = langid.train(edge_documents)
    assert model.languages == ["en", "es"]
    rows = {(r["doc_id"], r["text"]): r for r in langid.predict(edge_documents, model).collect()}
    assert rows[3, None]["lang_pred"] == rows[4, ""]["lang_pred"] == "und"
    assert rows[6, [t for i, t in rows if i == 6][0]]["lang_pred"] == "es"
    grams, edges, letters = langid.hashed(["ab", "", "b"])
    assert letters.tolist() == [2, 0, 1]
    # one and two letters never reach into the next text
    alone = [sorted(langid.hashed([t])[0].ravel().tolist()) for t in ("ab", "", "b")]
    assert [sorted(grams[:, a:b].ravel().tolist()) for a, b in zip(edges[:-1], edges[1:])] == alone
    void = langid.train(no_documents)
    assert {r["lang_pred"] for r in langid.predict(edge_documents, void).collect()} == {"und"}


def test_minimum_cut_is_minimal():
    for seed in range(200):
        rng = random.Random(seed)
        n = rng.randint(1, 8)
        costs = np.array([rng.uniform(-2, 2) for _ in range(n)])
        edges = [(rng.randrange(n), rng.randrange(n), rng.uniform(0, 2)) for _ in range(rng.randint(0, 14))]

        def value(side):
            own = sum(-min(c, 0) if s else max(c, 0) for c, s in zip(costs, side))
            return own + sum(w for a, b, w in edges if side[a] != side[b])

        best = min(value(s) for s in itertools.product((0, 1), repeat=n))
        assert abs(value(html_text.minimum_cut(costs, edges)) - best) < 1e-9


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body>
<header class=top><a href="/">Home</a></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
<div id="cookie-notice">We use cookies to make this page work better for you.</div>
<main><article><h1>A title &amp; more</h1><p>First <b>bold</b>ness&nbsp;of a   paragraph,<br>with two lines.
<p>Second paragraph with <a href="x">a link</a> inside &lt;it&gt;.<div class="ad">Buy now</div><ul><li>item one</li><li>item two</li></ul>
<script>var p = "<p>no</p>";</script><!-- <p>no</p> --></article>
<section class="comments"><h2>Comments</h2><p>I liked this article very much, thank you.</p></section></main>
<aside><p>Related: another long story that you may want to read today.</p></aside>
<form><p>Subscribe to our letter.</p><input name=x></form><footer>&copy; us</footer></body></html>"""


def test_page_text():
    weights = html_text.BEFORE
    assert html_text.main_text(PAGE, weights).split("\n\n") == [
        "A title & more", "First boldness of a paragraph, with two lines.",
        "Second paragraph with a link inside <it>.", "item one", "item two",
    ]
    assert html_text.main_text(None, weights) == html_text.main_text("", weights) == ""
    assert html_text.main_text("<p>open <b>tags <i>and < signs" + "<p>x" * 3000, weights) is not None


def test_pages_on_edge_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", PAGE), (None, "u", PAGE), (3, "u", "<article>" + "<p>word " * 5000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    found = html_text.extract(pages, html_text.train(pages, "page_id")).collect()
    assert len(found) == 5
    assert html_text.extract(pages.limit(0), html_text.BEFORE).count() == 0


def test_neighbours_match_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 12)) * rng.uniform(0.5, 2, size=(1500, 1))
    x[100:140] = x[3]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(2000, None), (2001, [0.0] * 12), (2002, [float("nan")] * 12), (2003, [None] * 12), (2004, [1.0]), (2020, [float("inf")] * 12)]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("x"))
    found = ann.nearest(frame, frame.where("vec_id % 20 = 0"), k=10).toPandas()
    assert set(found["query_id"]) == set(range(0, 1500, 20))
    hits = 0
    for query, part in found.groupby("query_id"):
        scores = x @ x[query]
        scores[query] = -np.inf
        best = np.lexsort((np.arange(1500), -scores))[:10]
        part = part.sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 11))
        assert np.allclose(part["score"], scores[part["vec_id"]])
        hits += len(set(best) & set(part["vec_id"]))
    assert hits / (75 * 10) >= 0.95
    few = spark.createDataFrame(rows[:3], "vec_id bigint, embedding array<double>")
    assert ann.nearest(few, few, k=10).count() == 6
    assert ann.nearest(few.limit(0), few.limit(0)).count() == 0


def test_chi_square_quantile():
    assert abs(ann.chi_square_quantile(0.95, 8) - 15.507) < 1e-3


def test_an_open_head_ends_where_the_body_starts():
    for start in ("<head><title>t</title><body><p>seen</p>", "<head><meta charset=utf-8><p>seen</p>", "<head><style>a</style>seen",
                  "<head><title>t</title></head><body><p>seen</p>"):
        assert [b.text for b in html_text.blocks_of("<html>" + start)[0]] == ["seen"]
    assert html_text.blocks_of("<head><title>t</title><noscript><img src=x>no</noscript></head>")[0] == []


def _trained(spark):
    return html_text.train(spark.read.parquet(f"{SF_DIR}/pages.parquet"), "page_id")


def test_the_cut_outvotes_a_block_between_others(spark):
    """A line of a link alone looks like a menu; between paragraphs it is text, in a list of links it is not."""
    weights = _trained(spark)
    prose = "<p>Here stands a paragraph of many words, with marks, that ends with a full stop.</p>"
    link = "<div><a href=x>Appendix</a></div>"
    inside, menu = prose + link + prose, link * 5
    for page, kept in ((f"<body><div>{inside}</div>", [True] * 3), (f"<body><div>{menu}</div>", [False] * 5)):
        blocks, parent, depth = html_text.blocks_of(page)
        odds = html_text.odds_of(blocks, weights)
        assert html_text.minimum_cut(odds, html_text._edges(blocks, parent, depth)).tolist() == kept
    blocks, parent, depth = html_text.blocks_of(f"<body><div>{inside}</div>")
    assert html_text.minimum_cut(html_text.odds_of(blocks, weights), []).tolist() == [True, False, True]


def test_hints_are_features_that_the_classifier_weighs(spark):
    weights = _trained(spark)
    page = ("<html><body><nav><ul><li><a href=/x/>Home</a></li></ul></nav><article><h1>Title</h1>"
            "<p>A long first paragraph, with many words in it.</p>%s<p>And a last one, also with words.</p></article><footer>f</footer>")
    kept = {
        "<section class='related-work'><p>Related work in this field is broad, and many have written about it.</p></section>": True,
        "<p title=it's>Hello world, it's fine to be here today.</p>": True,
        "<!--><p>After the comment stands this text.</p>": True,
        "<div title='<nav class=ad>'><p>A title may hold a tag, which is none.</p></div>": True,
        "<div class='ad'><p>Buy this thing now, it is good for you.</p></div>": False,
        "<div role=navigation><p>Go on to the next page, please.</p></div>": False,
        "<section class=comments><article class=comment><p>I liked it, thank you.</p></article></section>": False,
    }
    for part, stays in kept.items():
        found = html_text.main_text(page % part, weights).split("\n\n")
        text = " ".join(re.sub("<[^>]*>", "", part.split("<p", 1)[1].split(">", 1)[1]).split())
        assert found == ["Title", "A long first paragraph, with many words in it.", *([text] if stays else []), "And a last one, also with words."], part


def test_page_text_is_that_of_the_articles(spark):
    """Brute force on the given pages: a plain reading of their one article."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    wanted = {}
    for row in pages.collect():
        article = row["html"].split("<article>")[1].split("</article>")[0]
        parts = re.split("</?(?:p|h1|li|ul)>", re.sub("<br>", " ", article))
        wanted[row["page_id"]] = "\n\n".join(t for t in (" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts) if t)
    found = html_text.extract(pages, _trained(spark)).collect()
    assert {r["page_id"]: r["text"] for r in found} == wanted


def test_language_model_matches_plain_counts(spark):
    rng = random.Random(4)
    texts = [("".join(rng.choice("abcde éß1.\n") for _ in range(rng.randint(0, 80))), rng.choice(["x", "y", "z"])) for _ in range(150)]
    frame = spark.createDataFrame([*texts, (None, "x"), ("abc", None)], "text string, lang string").repartition(5)
    model = langid.train(frame)
    names = sorted({lang for _, lang in texts})
    assert model.languages == names
    counts = np.zeros((langid.BUCKETS, len(names)))
    for text, lang in texts:
        for gram in langid.hashed([text])[0].ravel().tolist():
            if gram < langid.BUCKETS:
                counts[gram, names.index(lang)] += 1
    wanted = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * langid.BUCKETS))
    assert np.allclose(model.weights[:-1], wanted, atol=1e-5) and not model.weights[-1].any()
    sizes = np.array([sum(lang == n for _, lang in texts) for n in names])
    assert np.allclose(model.prior, np.log(sizes / sizes.sum()))
    found, share, fit = langid.score([t for t, _ in texts], model)
    for i, (text, _) in enumerate(texts):
        grams = [g for g in langid.hashed([text])[0].ravel().tolist() if g < langid.BUCKETS]
        logs = model.prior + sum((model.weights[g].astype(float) for g in grams), np.zeros(len(names)))
        if any(c.isalpha() for c in text):
            assert found[i] == names[int(logs.argmax())]
            assert np.isclose(share[i], np.exp(logs - np.logaddexp.reduce(logs)).max())
            best = int(logs.argmax())
            mean = sum(float(model.weights[g, best]) for g in grams) / len(grams)
            assert np.isclose(fit[i], (mean - model.usual[best]) / model.spread[best])
        else:
            assert (found[i], share[i]) == ("und", 0)


def test_line_features_match_a_plain_reading():
    texts = ["The cat, the CAT sat.\n\n1234 !!\nThe cat, the CAT sat.", "", None, "x x x\ny"]
    found, size, edges = quality.line_features(texts)
    assert edges.tolist() == [0, 4, 5, 6, 8]
    width = (found.shape[1] - 2) // 3
    at = 0
    for text in texts:
        lines = (text or "").split("\n")
        words = [line.split() for line in lines]
        everything = [w for part in words for w in part]
        own = []
        for line, part in zip(lines, words):
            shares = [sum(f(c) for c in line) / max(1, len(line)) for f in (
                lambda c: c.isalpha() and not c.isupper(), lambda c: c.isalpha() and c.isupper(), str.isdigit, str.isspace,
                lambda c: c in ".,;:'\"-()?’“”", lambda c: not c.isalnum() and not c.isspace() and c not in ".,;:'\"-()?’“”")]
            some = max(1, len(part))
            fresh = (len(lines) - len(set(lines))) / len(lines)
            again = (len(everything) - len(set(everything))) / max(1, len(everything))
            loud = sum(sum(c.isupper() for c in w) >= max(2, 0.6 * len(w)) for w in part)
            odd = sum(not w[-1].isalnum() and w[-1] not in ".,;:'\"-()?’“”" for w in part)
            own.append([
                np.log1p(len(line)), np.log1p(len(part)), *shares, np.log1p(len(line) / some), (len(part) - len(set(part))) / some,
                sum(a == b for a, b in zip(part, part[1:])) / some, loud / some, odd / some,
                bool(line) and line[-1] in ".,;:'\"-()?’“”", bool(line) and line[0].isupper(), not line, fresh, again,
                np.log1p(len(everything)), again * np.log1p(len(everything)),
            ])
        own = np.array(own, float)
        for i in range(len(lines)):
            row = found[at + i]
            assert np.allclose(row[:width], own[i])
            assert np.allclose(row[width : 2 * width], own[max(0, i - 1)])
            assert np.allclose(row[2 * width : 3 * width], own[min(len(lines) - 1, i + 1)])
            assert (row[-2], row[-1]) == (i == 0, i == len(lines) - 1)
            assert size[at + i] == len(lines[i])
        at += len(lines)


def test_clashing_columns_change_nothing(spark, edge_rows):
    """Extra columns with the names that the operators use inside."""
    from vitrine.llm import bpe_trie, minhash, packing, runs, simhash, suffix_dedup
    import public_tokenizers

    words, letters = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
    plain = spark.createDataFrame([r[:3] for r in edge_rows], "doc_id bigint, text string, lang string")
    extra = ["key", "row", "ids", "fingerprint", "name", "range", "place", "kept", "row_key", "n_tokens", "decoded", "next_text", "runs",
             "lang_pred", "quality_score", "component_id", "root", "bucket", "a b", "n_chars", "edited"]
    wide = plain.select("*", *(F.lit("clash").alias(c) for c in extra))
    model = langid.train(plain)
    field = quality.train(plain, spark.createDataFrame([(1, 1), (6, 0)], "doc_id bigint, quality int"))
    cases = [
        lambda d: minhash.compared(d).select("doc_id", "near_next", "edited"),
        lambda d: suffix_dedup.remove_repeats(d, length=64).select("doc_id", "n_bytes", "n_removed"),
        lambda d: quality.predict(d, field).select("doc_id", "quality_score"),
        lambda d: langid.predict(d, model).select("doc_id", "lang_pred", "lang_score"),
        lambda d: bpe_trie.round_trip(d, letters).select("doc_id", "ids", "decoded"),
        lambda d: packing.pack(d, words, length=64).groupBy("doc_id").agg(F.sum("length")),
        lambda d: simhash.near_duplicates(d).select("doc_id", "fingerprint", "component_id"),
        lambda d: runs.periodic_runs(d).select("doc_id", "n_words", "runs", "collapsed"),
    ]
    for case in cases:
        assert sorted(map(str, case(wide).collect())) == sorted(map(str, case(plain).collect()))
