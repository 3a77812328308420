"""HTML extraction, quality and toxicity: known pages, and accuracy on rows that training never sees."""

import os
import random
import time
from html.parser import HTMLParser

import numpy as np
import pytest

from docloom.llm import quality, toxicity
from docloom.llm.html import blocks, extract_text, features, labelled_pages, main_text, op3_html_extraction, trained
from docloom.llm.textvec import Texts

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header class="site"><a href=/>Home</a><h2>Site name</h2></header>
<div id=cookie-banner>We use cookies to make this better for you and all of us today okay</div><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- an advert <p>x</p> -->
<main><article><header><h1>Head &amp; line</h1></header><p>First para with <a href=x>a link</a> and&nbsp;more.<p>Second &lt;b&gt; para<br>line<script>var t="</p>";</script>
<blockquote>Quoted   words\n here</blockquote><aside>Related stuff to read now</aside><ul><li>One item</li><li>Two item</li></ul></article>
<section class="comments"><h3>Comments</h3><article class=comment><p>I think this is a very good article and I like it a lot</p></article></section></main>
<form><label>Email</label><input></form><div class="ad">Buy this now, it is very cheap and very good for you all</div><footer>&copy; me</footer></body></html>"""
WANT = "Head & line\nFirst para with a link and more.\nSecond <b> para line\nQuoted words here\nOne item\nTwo item"


def test_main_text():
    assert main_text(PAGE) == WANT
    assert main_text(None) == main_text("") == main_text("<p> </p><!--") == ""
    assert main_text("<article><p>Hello</p></article>") == "Hello"
    assert main_text("<p>" + "plain words without any article around them at all " * 3 + "</p>").startswith("plain words")
    long = "<article>" + "".join(f"<p>paragraph {i} says something</p>" for i in range(20_000)) + "</article>"
    assert main_text(long).count("\n") == 19_999
    assert main_text("<article><p>a < b and \"c' > d</p><p>next one &am</p>") == "a < b and \"c' > d\nnext one &am"
    assert main_text("<article><p>kept</p>" + "<div" * 3000) == "kept"  # the unclosed tag takes the rest


def test_article_content_is_never_dropped_by_its_names():
    kept = ['<h2 id="related-work">Related work</h2>', '<h2 id="Form_and_content">Form and content</h2>', '<section id="search"><p>Search words</p></section>', '<p class="comment-on-law">A law</p>', "<p>Les.</p>", '<li class="share">Item</li>']
    page = "<article><h1>Title</h1>" + "".join(kept) + "</article>"
    assert main_text(page) == "Title\nRelated work\nForm and content\nSearch words\nA law\nLes.\nItem"
    assert main_text("<article><p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> as <object>fallback words</object> go</p></article>") == "Energy is E=m as fallback words go"
    gone = ['<aside>About us</aside>', '<div class="related-stories"><p>More to read</p></div>', '<div id="comments"><p>' + "I say so too " * 40 + "</p></div>", '<div class="ad">' + "buy it now " * 50 + "</div>", "<form><p>Your mail</p></form>", '<p hidden>unseen</p>', '<ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul>']
    assert main_text("<article><h1>Title</h1><p>The text itself.</p>" + "".join(gone) + "</article>") == "Title\nThe text itself."


def test_neighbours_decide_without_an_article():
    text, link = "<div>plain words that say something about the matter at hand here now</div>", '<div><a href="/x">one linked line of words</a></div>'
    long = "<div>" + "the long text goes on and on " * 8 + "</div>"
    assert main_text(long + text + long).count("\n") == 2
    assert main_text(link + text + link) == "" and main_text(long + link + long).count("\n") == 1
    assert main_text('<div class="sidebar-right"><article><p>Real</p></article></div>') == "Real"
    assert main_text('<div class="related"><article><p>Other</p></article></div><article><p>Real</p></article>') == "Real"


def plain_classifier(found):
    """The tree walked block by block over features taken one by one."""
    out = []
    for i, b in enumerate(found):
        around = [found[j] if 0 <= j < len(found) else None for j in (i, i - 1, i + 1)]
        row = [v for n in around for v in ((n.words, n.linked / n.words) if n else (0, 0))]
        row += [b.element in ("h1", "h2", "h3", "h4", "h5", "h6"), b.element == "li", b.article, b.sign]
        node = trained()
        while node.feature >= 0:
            node = node.low if row[node.feature] <= node.cut else node.high
        out.append(node.answer)
    return out


class PlainBlocks(HTMLParser):
    """Blocks of a well-formed page by another parser: text, words, words in links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.parts, self.link = [], [], 0

    def cut(self):
        text = " ".join("".join(t for t, _ in self.parts).split())
        if text:
            self.out.append((text, len(text.split()), sum(len(t.split()) for t, inside in self.parts if inside)))
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.link += 1
        elif tag in ("p", "div", "ul", "li", "h2", "article", "nav"):
            self.cut()

    def handle_endtag(self, tag):
        if tag == "a":
            self.link -= 1
        elif tag in ("p", "div", "ul", "li", "h2", "article", "nav"):
            self.cut()

    def handle_data(self, data):
        self.parts.append((data, self.link > 0))


def random_page(rnd, depth=0):
    out = []
    for _ in range(rnd.randrange(1, 7)):
        words = " ".join(rnd.choice(["word", "&amp;", "x&lt;y", "caf&eacute;", "<i>soft</i>", '<a href="/u?a=1&amp;b">link text</a>']) for _ in range(rnd.choice([1, 2, 5, 14, 40])))
        tag = rnd.choice(["p", "h2", "li", "div", "ul", "article", "nav"])
        name = rnd.choice(["", "", ' class="ad"', ' class="form"', ' id="x"'])
        inner = random_page(rnd, depth + 1) if tag in ("div", "ul", "article", "nav") and depth < 3 else words
        out.append(f"<{tag}{name}>{inner}</{tag}>")
    return "".join(out)


def test_blocks_and_answers_equal_brute_force():
    rnd = random.Random(9)
    for _ in range(300):
        page = random_page(rnd)
        found, plain = blocks(page), PlainBlocks()
        plain.feed(page)
        plain.close()
        plain.cut()
        assert [(b.text, b.words, b.linked) for b in found] == plain.out
        answers = plain_classifier(found)
        if any(answers):
            assert main_text(page) == "\n".join(b.text for b, keep in zip(found, answers, strict=True) if keep)


def test_the_tree_knows_its_table_and_asks_neighbours():
    pages = labelled_pages()
    right = [a == p for found, answers in pages for a, p in zip(answers, plain_classifier(found), strict=True)]
    assert np.mean(right) >= 0.98 and features(pages[0][0]).shape[1] == 10
    asked, nodes = set(), [trained()]
    for node in nodes:
        if node.feature >= 0:
            asked.add(node.feature)
            nodes += [node.low, node.high]
    assert {0, 1, 2, 3, 4} <= asked  # words, own density, words and density before, words after


@pytest.mark.parametrize("broken", ["<a '", "<a =\"", "<a \"'>", "<div>", "</x></p>", "<p " + "a" * 50, "<template>", "<a href=x>", "<", "<!--", "&", "<b class='"])
def test_time_grows_with_the_page_alone(broken):
    began = time.monotonic()
    main_text(broken * (3_000_000 // len(broken)))
    main_text("<div>" * 100_000 + broken * (1_000_000 // len(broken)))
    assert time.monotonic() - began < 30


def test_blocks_have_link_density():
    found = blocks("<div><a href=x>one two</a> three</div><p>four")
    assert [(b.text, b.words, b.linked) for b in found] == [("one two three", 3, 2), ("four", 1, 0)]
    assert [b.linked for b in blocks("<a href=x><div>one two</div><p>three</p></a><p>four <a>five</p><p>six</p>")] == [2, 1, 1, 0]


def test_html_query(spark):
    df = spark.createDataFrame([(1, "u", PAGE, 5), (1, "u", PAGE, 5), (2, None, None, None)], "page_id long, url string, html string, text int")
    got = {r.page_id: (r.text, r.n_chars) for r in op3_html_extraction(df).collect()}
    assert got == {1: (WANT, len(WANT)), 2: ("", 0)} and extract_text(df).columns[:4] == df.columns
    assert op3_html_extraction(df.limit(0)).count() == 0
    odd = spark.sql("SELECT named_struct('a b', 1, 'c', array(1)) AS `x y`, 'old' AS _html_text, '<p>one long line of words in a page of its own, as it should be here, said once more for good measure</p>' AS html")
    assert extract_text(odd).columns == ["x y", "html", "_html_text"] and extract_text(odd).first()["_html_text"].startswith("one long")


def corpus(n, seed):
    """Texts with rare insults (toxic) or salad of marks (bad quality)."""
    rnd = random.Random(seed)
    syllables = "th er on an re he in ed nd ha at en es of or nt ti to it st is ar".split()
    out = []
    for i in range(n):
        words = ["".join(rnd.choice(syllables) for _ in range(rnd.randrange(1, 5))) for _ in range(rnd.randrange(5, 120))]
        toxic, bad = int(rnd.random() < 0.2), int(rnd.random() < 0.25)
        if toxic:
            for _ in range(rnd.randrange(2, 6)):
                words[rnd.randrange(len(words))] = rnd.choice(["vilepig", "scumbag", "numbskull"]) + rnd.choice(["", "s", "ery", ","])
        if bad:
            words = [w + rnd.choice(["###", "%%%", "$$$"]) for w in words]
        out.append((" ".join(words), 1 - bad, toxic))
    return out


@pytest.mark.parametrize(("module", "at"), [(quality, 1), (toxicity, 2)])
def test_held_out_accuracy(module, at):
    train, test = corpus(500, 1), corpus(400, 2)
    model = module.train([r[0] for r in train], [r[at] for r in train])
    raw = [r[0].encode() for r in test]
    score = model.score(Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])))
    assert ((score >= 0) & (score <= 1)).all()
    assert np.mean((score >= 0.5) == np.array([r[at] for r in test])) >= 0.97


def rows():
    return [(i, t, q, x) for i, (t, q, x) in enumerate(corpus(150, 3))] + [(1000, None, 1, 0), (1001, "", 1, 0), (1002, "word " * 200_000, 1, 0)]


@pytest.mark.parametrize(("op", "label", "parts", "held"), [(quality.op4_quality, "quality", 3, 1), (toxicity.op8_toxicity, "toxic", 5, 0)])
def test_queries(spark, op, label, parts, held):
    import zlib

    data = rows()
    docs = spark.createDataFrame([(i, t) for i, t, *_ in data] + [(5, data[5][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in data if i % 2] + [(7, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = op(docs, labels).collect()
    assert len(got) == len(data) + 1
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == held) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    same = [r.score for r in got if r.doc_id == 5]
    assert same[0] == same[1]
    flipped = labels.withColumn(label, (1 - labels[label]).cast("int")).where(f"crc32(cast(doc_id as string)) % {parts} = {held}")
    kept = labels.where(f"crc32(cast(doc_id as string)) % {parts} <> {held}")
    again = {r.doc_id: r.score for r in op(docs, kept.unionByName(flipped)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-5 for r in got)  # held-out labels are never learnt
    assert op(docs.limit(0), labels).count() == 0
    assert {r.score for r in op(docs, labels.limit(0)).collect()} == {0.0}


def test_rare_languages_get_their_own_threshold(spark):
    rnd = random.Random(4)
    words = {"en": "the of and quiet words in a text", "es": "los las una con otras cosas del texto", "fr": "dans pour avec une page du livre"}
    rows = []
    for lang, toxic, clean in (("en", 150, 1500), ("es", 40, 200), ("fr", 10, 100)):
        for y, n in ((1, toxic), (0, clean)):
            for _ in range(n):
                text = rnd.choices(words[lang].split(), k=12) + ["scumbag"] * (y or lang == "es") + ["vilepig"] * (y and lang == "es")  # a clean Spanish word
                rows.append((len(rows), " ".join(rnd.sample(text, len(text))), y))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"), most_rows=300)
    other, own = model.limits[0], dict(zip(toxicity.LANGUAGES, model.limits, strict=True))
    assert own["es"] > max(own["en"], own["fr"]) and own["de"] == other and len({own[k] for k in ("en", "es", "fr")}) == 3
    assert model.own == ("en", "fr", "es")  # those with labels of both classes, however few
    texts = [f"the of and in words a text {x}" for x in ("scumbag", "quiet")] + [f"los las una con otras cosas {x}" for x in ("scumbag", "scumbag vilepig")]
    raw = [t.encode() for t in texts]
    score = model.score(Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])))
    assert (score >= 0.5).tolist() == [True, False, False, True]


def test_thresholds_shrink_without_a_switch():
    def limits(n):
        z = np.concatenate([np.linspace(-1, 1, 400), np.linspace(9, 11, n)])
        y = np.concatenate([np.linspace(-1, 1, 400) > 0, np.linspace(9, 11, n) > 10]).astype(float)
        model = toxicity.Model(None, [], [], None, 0.0, np.zeros(len(toxicity.LANGUAGES)))
        toxicity._calibrate(model, z, np.repeat([1, 2], [400, n]), y, np.ones(400 + n))
        return model.limits

    own = [limits(n)[2] for n in (2, 10, 50, 200, 2000)]
    assert own == sorted(own) and 0 < own[0] < 1 and own[-1] > 9 and limits(10)[3] == limits(10)[0]


def plain_pooled(model, text):
    """Each filter's largest answer, word by word: windows that begin in the text or one place behind it."""
    raw = np.frombuffer(text.encode(), np.uint8)
    buckets, _ = toxicity.word_buckets(Texts(raw, np.array([0, len(raw)])))
    x = [sum(model.words[b] for b in row) for row in buckets]
    at = lambda i: x[i] if i < len(x) else np.zeros(toxicity.DIM, np.float32)
    out = []
    for kernel, bias in zip(model.kernels, model.biases, strict=True):
        for f in range(toxicity.FILTERS):
            best = max(sum(float(at(i + j) @ kernel[j][:, f]) for j in range(len(kernel))) for i in range(len(x) + 1))
            out.append(max(0.0, best + float(bias[f])))
    return out


def test_filters_equal_plain_loops():
    train = corpus(200, 5)
    model = toxicity.train([r[0] for r in train], [r[2] for r in train], epochs=2)
    texts = [r[0] for r in corpus(30, 6)] + ["", "one", "one two"]
    raw = [t.encode() for t in texts]
    batch = toxicity.word_buckets(Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])))
    assert np.allclose(model.pooled(*batch), [plain_pooled(model, t) for t in texts], atol=1e-4)


def test_quality_margins_and_descent_equal_plain_ones():
    train = corpus(120, 7)
    model = quality.train([r[0] for r in train], [r[1] for r in train])
    texts = [r[0] for r in corpus(20, 8)] + ["", "x"]
    raw = [t.encode() for t in texts]
    docs, grams = quality.indicators(Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])))
    for i, text in enumerate(texts):
        own = set(grams[docs == i].tolist())
        assert len(own) == (docs == i).sum()
        data = text.encode()
        assert own >= {(data[k] * 40503 + data[k + 1] * 2531 + data[k + 2] * 157) & (quality.HALF - 1) for k in range(len(data) - 2)}
        length = sum(float(model.square[g]) for g in own) ** 0.5
        want = sum(float(model.weight[g]) for g in own) / max(length, 1e-6) + model.bias
        assert abs(model.margins(docs, grams, len(texts))[i] - want) < 1e-6
    # The dual of the hinge loss: at its optimum no step along any one variable makes it smaller.
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 6))
    sign, cost = np.where(x[:, 0] + 0.3 * rng.normal(size=40) > 0, 1.0, -1.0), np.full(40, 0.7)
    w, bias = quality.descend([np.arange(6)] * 40, list(x), sign, cost, 6, 400, 1)
    loss = lambda v, b: 0.5 * (v @ v + b * b) + (cost * np.maximum(0, 1 - sign * (x @ v + b))).sum()
    at = loss(w, bias)
    for _ in range(2000):
        step = rng.normal(size=7) * rng.choice([0.1, 0.01, 0.001])
        assert loss(w + step[:6], bias + step[6]) >= at - 1e-3


def test_repeated_ids_learn_the_same_text(spark):
    from docloom.llm.labelled import texts_of

    rows = [(i, f"text {i} {v}") for i in range(50) for v in "cab"] + [(99, None), (99, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ids = spark.createDataFrame([(i, 1) for i in [*range(50), 99]], "doc_id long, y int")
    assert texts_of(df.repartition(7), ids, 100)[0] == texts_of(df.orderBy("text"), ids, 100)[0] == [f"text {i} a" for i in range(50)] + [""]


def test_clashing_and_nested_columns(spark):
    docs = spark.sql("SELECT id AS doc_id, concat('words of text ', id) AS text, named_struct('a b', id) AS `x y`, 'old' AS _quality_score, 'old' AS _toxic_score, 1 AS y FROM range(20)")
    labels = spark.sql("SELECT id AS doc_id, cast(id % 2 AS int) AS quality, cast(id % 2 AS int) AS toxic FROM range(20)")
    for module, score, name in ((quality, quality.score_quality, "_quality_score"), (toxicity, toxicity.score_toxicity, "_toxic_score")):
        out = score(docs, module.fit(docs, labels))
        assert out.count() == 20 and dict(out.dtypes)[name] == "double" and out.first()["x y"]["a b"] is not None and "y" in out.columns


def test_toxicity_is_not_learnt_in_the_driver(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "train", lambda texts, y, **_: (os.getpid(), texts, y))
    df = spark.createDataFrame([(i, f"text {i}", i % 2) for i in range(40)], "doc_id long, text string, toxic int").repartition(5)
    pid, texts, y = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert pid != os.getpid()
    assert texts == sorted(texts, key=lambda x: int(x[5:])) and y == [int(x[5:]) % 2 for x in texts] and len(texts) > 20


def test_sample_is_as_large_as_documented(spark, monkeypatch):
    rows = [(i, f"text {i}", int(i % 5 == 0)) for i in range(8000)] + [(9000 + i, "long " * 12_000 + str(i), 1) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    kept = df.where("crc32(cast(doc_id as string)) % 5 <> 0")
    monkeypatch.setattr(toxicity, "train", lambda texts, y, **_: texts)
    texts = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert 6000 <= len(texts) <= 6000 + 200 < kept.count()
    few = df.where("doc_id < 50 OR doc_id >= 9000")
    texts = toxicity.fit(few.select("doc_id", "text"), few.select("doc_id", "toxic"))
    assert len(texts) == kept.join(few.select("doc_id"), "doc_id").count() and max(map(len, texts)) > 60_000


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver tables are absent")
def test_on_driver_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    for op, label, least in ((quality.op4_quality, "quality", 0.97), (toxicity.op8_toxicity, "toxic", 0.9)):
        got = op(docs, labels).where("held_out").join(labels, "doc_id").collect()
        assert np.mean([r.predicted == r[label] for r in got]) >= least
