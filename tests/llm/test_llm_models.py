"""Toxicity, decontamination, HTML extraction and the pipeline."""

import html
import re

import numpy as np
import pytest
from llm_helpers import edge_docs, empty_docs, prose
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from lifeboat.llm import decontaminate, html_extract, toxicity
from lifeboat.llm.common import table

SF, SMALL = "/root/testdata/sf0.1", "/root/testdata/sf0.001"


def test_toxicity_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.fit(docs, labels.filter("doc_id % 3 <> 0"), F.col("toxic"))
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 3
    test = docs.join(labels.filter("doc_id % 3 = 0"), "doc_id").select("toxic", toxicity.severity(model, F.col("text")).alias("s")).collect()
    hit = [(r["toxic"], r["s"]["p_toxic"] >= 0.5, r["s"]["severity"]) for r in test]
    assert sum(t and h for t, h, _ in hit) >= 0.85 * sum(t for t, *_ in hit)
    assert sum(h and not t for t, h, _ in hit) <= 0.01 * sum(not t for t, *_ in hit)
    assert all(0 <= s <= 3 for *_, s in hit)
    again = toxicity.fit(docs, labels.filter("doc_id % 3 <> 0"), F.col("toxic"))
    assert again == model


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 4, 600)
    pairs = [(i, j) for i, g in enumerate(y) for j in range(g)] + [(i, 3 + int(rng.integers(0, 5))) for i in range(600)]
    rows, cols = np.array(pairs).T
    w, t = toxicity.fit_ordinal(rows, cols, y, 8, 0.2 / 600, 400)
    assert (np.diff(t) >= 0).all() and w[:3].min() > 5 * max(w[3:].max(), 0.05)


def test_toxicity_edges(spark):
    df = edge_docs(spark)
    labels = spark.createDataFrame([(6, 1), (6, 0), (7, None), (None, 1), (99, 1), (9, 0)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels, F.col("toxic"))
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns and kept.count() <= df.count()
    none = toxicity.fit(df, labels.limit(0), F.col("toxic"))
    assert toxicity.drop_toxic(df, none).count() == df.count()
    assert toxicity.drop_toxic(empty_docs(spark), model).count() == 0
    scored = df.select(toxicity.severity(model, toxicity.text_or_empty("text")).alias("s")).collect()
    assert all(r["s"]["severity"] >= 0 for r in scored)


def _leaks_by_force(docs, items, s):
    out = set()
    for i, text in items:
        w = decontaminate.words(text or "")
        if not w:
            continue
        number = {x: k for k, x in enumerate(dict.fromkeys(w))}
        item = decontaminate.Item(i, [number[x] for x in w])
        for d, t in docs:
            ids = [number.get(x, -1) for x in decontaminate.words(t or "")]
            if item.check(ids, s):
                out.add((d, i))
    return out


def test_decontamination_recall_and_precision(spark):
    docs, bench = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    para = []
    for k, (i, t) in enumerate(items[:20]):             # paraphrases: every sixth word replaced, inside a long text
        w = t.split()
        para.append((10_000 + k, prose(k, 300) + " " + " ".join("changed" if j % 6 == 2 else x for j, x in enumerate(w)) + " " + prose(k + 50, 200)))
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(para, "doc_id long, text string"))
    force = _leaks_by_force([(r["doc_id"], r["text"]) for r in df.collect()], items, decontaminate.Settings())
    got = {(r["id"], r["item"]) for r in decontaminate.leaks(df, bench).collect()}
    assert len(force) >= 20 and got <= force and len(got) >= 0.9 * len(force)
    blocks = {(r["id"], r["item"]) for r in decontaminate.leaks(df, bench, settings=decontaminate.Settings(block_items=7, rank=5)).collect()}
    assert blocks <= force and len(blocks) >= 0.9 * len(force)


def test_decontamination_edges(spark):
    df = edge_docs(spark)
    bench = spark.createDataFrame([(1, prose(2, 30), "x"), (2, None, "x"), (3, "", "x"), (None, "two words", "x"), (1, prose(2, 30), "x")],
                                  "item_id long, text string, row_id string")
    got = decontaminate.leaks(df, bench).collect()
    assert {r["id"] for r in got if r["item"] == 1} == {6, 7, 8, 14}
    assert {r["id"] for r in got if r["item"] is None} == {5}
    kept = decontaminate.drop_leaks(df, bench)
    assert kept.columns == df.columns and kept.count() == df.count() - 7
    assert decontaminate.leaks(df, bench.limit(0)).count() == 0 == decontaminate.leaks(empty_docs(spark), bench).count()


def test_decontamination_of_long_items_in_long_texts(spark):
    item, rng = prose(5, 400), np.random.default_rng(0)
    words = item.split()
    edited = " ".join(w if not 150 <= i < 220 else f"other{i}" for i, w in enumerate(words))
    place = [8_192 - 200, 8_192 - 390, 2 * 8_192 - 200, int(rng.integers(0, 20_000)), 300]
    rows = [(k, f"{prose(60 + k, at)} {edited if k == 4 else item} {prose(80 + k, 500)}") for k, at in enumerate(place)]
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"),
                              spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {(r["id"], r["lcs"] == 1.0) for r in got} == {(k, k != 4) for k in range(5)}
    assert all(place[r["id"]] - 100 <= r["start_word"] <= place[r["id"]] for r in got)    # a stretch is a quarter longer than its item


@pytest.mark.parametrize("low,high", [(8, 14), (15, 59), (3, 59)])
def test_decontamination_of_question_lists(spark, low, high):
    cut = [(r["item_id"], decontaminate.words(r["text"])) for r in table(spark, SF, "benchmark").orderBy("item_id").collect()]
    items = [(i, " ".join(w[:low + k % (high - low + 1)])) for k, (i, w) in enumerate(cut)]
    lists = [(k, "\n".join(t for _, t in items[k:k + 20])) for k in range(0, len(items), 20)]
    one = [(1_000 + k, f"{prose(k, 37 + k % 90)} {t} {prose(k + 999, 50)}") for k, (_, t) in enumerate(items)]
    df, bench = spark.createDataFrame(lists + one, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(k // 20 * 20, i) for k, (i, _) in enumerate(items)} | {(1_000 + k, i) for k, (i, _) in enumerate(items)}
    for s in (decontaminate.Settings(), decontaminate.Settings(rank=20)):
        got = {(r["id"], r["item"]) for r in decontaminate.leaks(df, bench, settings=s).collect()}
        assert want <= got and got == _leaks_by_force(lists + one, items, s)


def test_lcs_length():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 30)).tolist(), rng.integers(0, 6, rng.integers(0, 30)).tolist()
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontaminate.lcs_length(decontaminate.Item(0, a).masks, len(a), b) == t[-1][-1]


def test_html_articles(spark):
    pages = table(spark, SF, "pages")
    got = {r["id"]: r["text"] for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert got[r["page_id"]] == "\n".join(x for x in blocks if x)


@pytest.mark.parametrize("page,text", [
    ('<body class="has-sidebar"><header>S</header><main><div class="post-content"><h2>T &amp; x</h2><p>one<p>two  <b>b</b>\nc<ul><li>d<li>e</ul><form>f</form>'
     '<aside>g</aside><a href="?id=share&x=ad">h</a></div><section id="comments"><p>i</p></section></main><article class="comment">j</article><footer>k</footer>',
     "T & x\none\ntwo b c\nd\ne\nh"),
    ('<p>a < b <br> c</p><div class="share-buttons">x</div>tail', "a < b c\ntail"), ("", ""), ("<<<", "<<<"), ("<article>open <p>never closed", "open\nnever closed"),
    ("<article>a<script>if (a<b) '</p>'</script><style>x</style><!-- c --><nav>n</nav>b</article>", "ab"),
    ('<article><p>x</p><div class="cookie-notice">n</div><article class="comment">c</article><p>y&nbsp;z</p></article>', "x\ny z")])
def test_html_markup(page, text):
    assert html_extract.read_page(page, None)[0] == text


def test_html_templates(spark):
    made = [(i, f"http://h.org/{i}", f'<body><div class="x1">Our site</div><div class="x2"><p>body {i} text</p><p>more {i * 7}</p></div><div>Copyright us</div>', "a")
            for i in range(6)]
    same = [(20 + i, f"http://copy.org/{i}", "<body><div>all the same</div>", "a") for i in range(5)]
    odd = [(9, None, None, None), (10, "http://h.org/0", "", "a"), (None, "odd url", "<p>x</p>" * 20_000, "a")]
    df = spark.createDataFrame(made + same + odd, "page_id long, url string, html string, host string")
    got = {r["id"]: (r["url"], r["text"], r["n_chars"]) for r in html_extract.extract(df).collect()}
    assert len(got) == df.count()
    assert all(got[i][1] == f"body {i} text\nmore {i * 7}" for i in range(6))
    assert all(got[20 + i][1] == "all the same" for i in range(5))      # copies say nothing about a template
    assert got[9] == (None, "", 0) and got[10][1] == "" and got[None][1].count("x") == 20_000
    assert all(v[2] == len(v[1]) for v in got.values())
    assert html_extract.extract(df.limit(0)).count() == 0


def test_html_templates_inside_articles(spark):
    page = lambda i: f"<body><article><div>Read our <b>daily</b> letter</div><p>body {i} of <i>page</i> <b>{i * 7}</b></p></article><p>Imprint</p>"
    teaser = lambda i: f"<body><article><p>teaser {i}</p></article><div><p>the long story {prose(i, 30)}</p></div><p>Imprint</p>"
    made = [(k * 100 + i, f"http://h{k}.org/{i}", make(i)) for k, make, n in ((0, page, 14), (1, page, 5), (2, teaser, 14)) for i in range(n)]
    got = {r["id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(made, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"body {i} of page {i * 7}" for i in range(14))
    assert all(got[100 + i] == f"Read our daily letter\nbody {i} of page {i * 7}" for i in range(5))    # few votes: as declared
    assert all(got[200 + i] == f"teaser {i}\nthe long story {prose(i, 30)}" for i in range(14))


def test_pipeline(spark):
    docs = table(spark, SMALL, "documents")
    left, counts = docs, [docs.count()]
    for name, step in corpus_pipeline.STAGES[:-1]:
        left = step(spark, left, SMALL)
        assert left.columns == docs.columns
        counts.append(left.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.6 * counts[0]
    out = corpus_pipeline.run(spark, SMALL)
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in left.collect()}
    bad = edge_docs(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for frame in (bad, bad.limit(0)):
        for _, step in corpus_pipeline.STAGES:
            frame = step(spark, frame, SMALL)
        assert "capacity" in frame.columns and frame.count() >= 0


def test_queries_registered():
    names = E.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names


def test_the_latent_space_is_fitted_on_all_passages(spark):
    """Four passages of 3,000 documents at most, without a last part, were all that it saw before."""
    s = decontaminate.Settings()
    texts = ["", "one", *(" ".join(f"w{(i * 7 + j * j) % 90}" for j in range(n)) for i, n in enumerate((31, 64, 96, 97, 700) * 700))]
    rows = spark.createDataFrame(list(enumerate(texts)), "row_id long, text string")
    counts = decontaminate.word_counts(rows, s)
    told = {None if r["word"] is None else bytes(r["word"]): (r["docs"], r["passages"]) for r in counts.collect()}
    cut = [[decontaminate.tokens(t)[sum(sizes[:i]):sum(sizes[:i + 1])] for i in range(len(sizes))]
           for t in texts for sizes in [decontaminate._lengths(len(t.split()), s.passage)]]
    assert all(32 < len(p) <= 96 for ps in cut if len(ps) > 1 for p in ps) and [len(ps) for ps in cut[:7]] == [0, 1, 1, 1, 1, 2, 11]
    assert told[None] == (len(texts), sum(map(len, cut)))
    assert told[b"w5"] == (sum(any(b"w5" in p for p in ps) for ps in cut), sum(b"w5" in p for ps in cut for p in ps))
    vocabulary = {w: i for i, w in enumerate(sorted(w for w in told if w))}
    idf = np.array([w != b"w7" for w in sorted(vocabulary)], float)
    passages = decontaminate.fit_passages(rows, vocabulary, idf, s)
    want = [[vocabulary[w] for w in p if w != b"w7"] for ps in cut for p in ps]
    assert sorted(r["ids"] for r in passages.collect()) == sorted(want) and sum(map(len, want)) > 3_000 * 4 * s.passage / 2
