"""Operators on pages and embeddings, the queries and the pipeline."""

import re
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_DIR, rows
from lakemart.llm import html, neighbours, queries, urls

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF_DIR}/pages.parquet").cache()


# --- 3 main text ----------------------------------------------------------------------------------------------------


def article(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    return " ".join(unescape(re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", body.replace("<b>", "").replace("</b>", ""))).split())


def test_articles_are_extracted_whole(spark, pages):
    odd = spark.createDataFrame([(10**6, None, None), (10**6 + 1, "x", ""), (None, "http://h/", "<p>a")], PAGES)
    result = html.extract(pages.union(odd).withColumn("text", F.lit("clash"))).collect()
    assert len(result) == pages.count() + 3
    expected = {r["page_id"]: article(r["html"]) for r in pages.collect()} | {10**6: "", 10**6 + 1: "", None: "a"}
    assert {r["page_id"]: r["text"] for r in result} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in result)
    assert html.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<body><header>S</header><aside>x</aside><article><header><h1>T&amp;x</h1>by me</header><p>o<b>n</b>e<p>t&nbsp;w</article>", "T&x one t w"),
        ("<div class='post-content'>a<br>b<div class=ad>c</div></div><div id=cookie-notice>d</div>", "a b"),
        ("<main><p>m</p><form><p>f</form><section id='comments'><article class=comment>c</article></section></main>", "m"),
        ('<article class="post has-comments"><p>Real <b>text</b></p></article><div class="has-comments">x</div>', "Real text"),
        ('<div class="content no-sidebar"><p>whole</p></div><div class="left sidebar">s</div>', "whole"),
        ('<article><p>a</p><div class="social-history"><p>b</p></div><div class="search-results">c</div><div class="social-links">d</div><div id="search-box">e</div></article>', "a b c"),
        ('<article class="entry"><p>m</p></article><article class="comment"><p>n</p></article>', "m"),
        ('<article><p>m</p><div class="comment-body"><p>n</p></div><div class="post-footer">f</div><div class="ad-content">g</div></article>', "m"),
        ("<div>" * 20000 + "deep" + "</div>" * 20000, "deep"),
        ("a < b &lt;c&gt; &am", "a < b <c> &am"),
        ("<table><tr><td>1<td>2<tr><td>3</table><script>var x='</p>'</script><!-- z -->", "1 2 3"),
        ("<p title='a>b'>x</p><ul><li>1<li>2</ul>", "x 1 2"),
    ],
)
def test_markup(page, text):
    assert html.main_text(html.parse(page)[1], set()) == text


def test_matching_pairs_as_many_nodes_as_possible():
    a, _ = html.parse("<body><nav><p>n</p></nav><div><p>1</p></div><p>end</p></body>")
    b, _ = html.parse("<body><nav><p>n</p></nav><p>new</p><div><p>2</p><p>3</p></div><p>end</p></body>")
    assert sorted((x.text, y.text) for x, y in html.align(a, b)) == [("1", "2"), ("end", "end"), ("n", "n")]


def test_text_that_never_changes_on_a_host_is_template(spark):
    made = [(i, f"http://h.example/{i}", f"<body><div><p>Welcome to our site</p><p>unique {i} words {i * 7}</p><p>All rights reserved</p></div></body>") for i in range(12)]
    made += [(100, "http://other.example/", "<body><div><p>Welcome to our site</p><p>x</p></div></body>")]
    found = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(made, PAGES)).collect()}
    assert all(found[i] == f"unique {i} words {i * 7}" for i in range(12))
    assert found[100] == "Welcome to our site x"  # one page is no evidence


def test_copies_of_a_page_do_not_make_it_template(spark):
    def page(words, nonce=""):
        return f"<body><nav>m {nonce}</nav><article><h1>Title {words}</h1><p>{words} body</p></article></body>"

    made, expected = [], {}

    def add(host, html_text, text):
        expected[len(made)] = text
        made.append((len(made), f"http://{host}/{len(made)}", html_text))

    for copies in (1, 5, 30, 1000):
        for _ in range(copies):
            add(f"h{copies}.example", page("one"), "Title one one body")
    for i in range(40):
        add("nonce.example", page("same", i), "Title same same body")  # differs outside of its content only
    for i in range(50):
        add("plain.example", "<body><div><p>copied text</p><p>more of it</p></div></body>", "copied text more of it")
    for i in range(3):
        add("plain.example", f"<body><div><p>other {i}</p><p>rest {i}</p></div></body>", f"other {i} rest {i}")
    for i in range(40):
        add("varied.example", page(f"w{i}").replace("</h1>", "</h1><p>Share this</p>"), f"Title w{i} w{i} body")  # template in an article goes as before
    found = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(made, PAGES)).collect()}
    assert found == expected


# --- 4 URLs ---------------------------------------------------------------------------------------------------------


def by_hand(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best


def test_rules_and_parts(spark, pages):
    odd = ["http://A.ORG", "HTTPS://x.EXAMPLE.org/es/a?x#y", None, "nope", "", "http://notorg/", "a://É.org/en/1", "x://example.org/en/12?://", "://", "http://com/fr/x" + "y" * 5000, "http://é.com/de/"]
    frame = pages.select("page_id", "url").union(spark.createDataFrame([(10**6 + i, u) for i, u in enumerate(odd)] + [(None, "http://a.com/fr/")], "page_id long, url string"))
    result = urls.judge(frame.withColumn("host", F.lit("clash")))
    assert result.count() == frame.count()
    source = {r["page_id"]: r["url"] for r in frame.collect()}
    for r in result.collect():
        host, path, rule = by_hand(source[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.host + rule.path)
        assert r["verdict"] == rule.verdict if rule else r["verdict"] in ("allow", "block")
    assert urls.judge(frame.limit(0)).count() == 0
    assert {r["verdict"] for r in urls.judge(frame.where("url like '%.net/%'")).collect()} == {"allow"}


def test_models_separate_what_they_learned(spark):
    made = [(i, f"http://good-news.org/story-of-the-day-{i}") for i in range(60)] + [(100 + i, f"http://example.org/es/xxwinqqzz{i}") for i in range(60)]
    made += [(1000, "http://site.net/story-of-today"), (1001, "http://site.net/xxwinqqzz")]
    verdict = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(made, "page_id long, url string")).collect()}
    assert (verdict[1000], verdict[1001]) == ("allow", "block")


def test_probabilities_sum_to_one(spark):
    counts = spark.createDataFrame([("^^a", 3, 0), ("^ab", 2, 0), ("^ac", 1, 0), ("abb", 2, 1)], "gram string, allow long, block long")
    every = [(f"^a{c}",) for c in urls.SYMBOLS]
    full = spark.createDataFrame(every, "gram string").join(counts, "gram", "full").na.fill(0)
    found = {r["gram"]: r["log_allow"] for r in urls._probability(full, "allow").collect()}
    assert sum(np.exp(found[g[0]]) for g in every) == pytest.approx(1.0)


# --- 10 neighbours --------------------------------------------------------------------------------------------------


def test_recall_scores_and_ties(spark):
    frame = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding")
    first = frame.where("vec_id = 0").first()["embedding"]
    bad = [(10**6, None), (10**6 + 20, [0.0] * 64), (10**6 + 40, [float("nan")] * 64), (10**6 + 60, [float("inf")] + [0.0] * 63), (10**6 + 80, [None] + [1.0] * 63), (10**6 + 100, [1.0]), (None, first)]
    hot = [(2 * 10**6 + i, first) for i in range(700)]
    frame = frame.union(spark.createDataFrame(bad + hot, "vec_id long, embedding array<float>")).withColumn("list", F.lit("clash"))
    result = neighbours.nearest(frame).collect()
    good = {r["vec_id"]: np.array(r["embedding"], float) for r in neighbours.usable(frame).selectExpr("id vec_id", "vector embedding").collect() if len(r["embedding"]) == 64}
    ids = np.array(sorted(good))
    matrix = np.array([good[i] for i in ids])
    found = {}
    for r in result:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        assert r["score"] == pytest.approx(float(good[r["query_id"]] @ good[r["vec_id"]]), abs=1e-12)
    assert set(found) == {i for i in good if i % 20 == 0}
    hits = []
    for query, lines in found.items():
        lines.sort()
        assert [x[0] for x in lines] == list(range(1, 21)) and query not in [x[1] for x in lines]
        scores = matrix @ good[query]
        scores[ids == query] = -np.inf
        hits.append(len({x[1] for x in lines} & set(ids[np.argsort(-scores, kind="stable")[:20]])) / 20)
    assert np.mean(hits) >= 0.9
    assert [x[1] for x in found[0]] == [2 * 10**6 + i for i in range(20)]  # equal vectors: the smaller ids
    few = neighbours.nearest(frame.where("vec_id in (0, 1, 2)"))
    assert rows(few.select("query_id", "rank")) == [(0, 1), (0, 2)]
    assert neighbours.nearest(frame.limit(0)).count() == 0


def made_vectors(spark, folder, count, sigma, seed=1):
    """Random directions whose norms spread by ``sigma``, as a table and a matrix."""
    rng = np.random.default_rng(seed)
    matrix = rng.standard_normal((count, 64))
    matrix *= np.exp(sigma * rng.standard_normal(count))[:, None] / np.sqrt((matrix**2).sum(axis=1))[:, None]
    pq.write_table(pa.table({"vec_id": np.arange(count), "embedding": list(matrix)}), folder / "vectors.parquet")
    return spark.read.parquet(str(folder / "vectors.parquet")).repartition(8), matrix


def hit_shares(lines, matrix, every=20, k=20):
    """The share of its true neighbours that each query found."""
    found = {}
    for r in lines:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    scores = matrix[::every] @ matrix.T
    scores[np.arange(len(scores)), np.arange(0, len(matrix), every)] = -np.inf
    true = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return np.array([len(found.get(i * every, set()) & set(t.tolist())) / k for i, t in enumerate(true)])


@pytest.mark.parametrize("sigma", [0.0, 0.5])
def test_recall_holds_for_unequal_norms(spark, tmp_path, sigma):
    frame, matrix = made_vectors(spark, tmp_path, 4000, sigma)
    shares = hit_shares(neighbours.nearest(frame).collect(), matrix)
    assert shares.mean() >= 0.93 and shares.min() >= 0.3


def test_small_tables_use_the_index(spark, tmp_path):
    frame, matrix = made_vectors(spark, tmp_path, 1500, 0.3)
    vectors = neighbours.usable(frame)
    assert len(neighbours.build_index(vectors).centroids) == 19  # what nearest() builds
    queries = vectors.where("id % 20 = 0")
    index = neighbours.build_index(vectors, lists=150, queries=queries)
    assert len(index.centroids) == 150
    assert hit_shares(neighbours.search(vectors, queries, index).collect(), matrix).mean() >= 0.93


def test_repeated_ids_take_one_place(spark, tmp_path):
    frame, matrix = made_vectors(spark, tmp_path, 600, 0.0)
    vectors = neighbours.usable(frame)
    queries = vectors.where("id % 20 = 0")
    index = neighbours.build_index(vectors, lists=1, queries=queries)  # all lists selected: only repeats can cost results
    assert hit_shares(neighbours.search(vectors, queries, index).collect(), matrix).min() == 1.0
    doubled = neighbours.search(vectors.union(vectors), queries, index).collect()
    assert hit_shares(doubled, matrix).min() == 1.0 and len(doubled) == 30 * 20
    near = int(np.argsort(-(matrix @ matrix[0]))[1])
    repeated = vectors.union(vectors.where(F.col("id") == near).crossJoin(spark.range(50).select()))
    assert repeated.count() == 650
    found = neighbours.search(repeated, queries, index).collect()
    assert hit_shares(found, matrix).min() == 1.0 and len(found) == 30 * 20
    whole = neighbours.nearest(repeated.select(F.col("id").alias("vec_id"), F.col("vector").alias("embedding"))).collect()
    assert hit_shares(whole, matrix).mean() >= 0.93 and len(whole) == 30 * 20


# --- all ------------------------------------------------------------------------------------------------------------


def test_queries_cover_their_tables(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for name in ("op1_pii", "op2_pieces", "op5_toxicity", "op7_language", "op9_near_dedup"):
        assert queries.QUERIES[name](spark, SF_DIR).count() == documents


def test_pipeline_stages(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, "", None, None, 0), (10**6 + 1, "", "en", "s", 0)], documents.schema)
    docs = documents.union(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == documents.columns, name
        assert kept.count() <= docs.count()
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
        docs = kept.cache()
    assert docs.groupBy("text").count().where("count > 1").count() == 0
    final = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert final.count() == docs.count() and final.where("not lossless").count() == 0
    assert 0 < corpus_pipeline.run(spark, SF_DIR).count() < documents.count()


def test_stages_hand_texts_over_in_small_batches(spark, setting):
    from lakemart.session import BATCH_BYTES

    (key,) = BATCH_BYTES
    setting(**{key.removeprefix("spark.sql.").replace(".", "__"): "64m"})
    spark.conf.unset(key)
    documents = spark.range(3000).selectExpr("id as doc_id", "repeat(concat('word', id % 7, ' '), 400) as text")
    corpus_pipeline.STAGES[4][1](spark, documents, SF_DIR)
    sizes = documents.coalesce(1).mapInArrow(lambda batches: (type(b).from_pydict({"bytes": [b.nbytes]}) for b in batches), "bytes long")
    assert sizes.count() > 3 and sizes.agg({"bytes": "max"}).first()[0] < 3e6
