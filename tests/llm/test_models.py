"""Classifiers, the url filter and the pipeline on small tables."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries
from tidemark.llm.quality import quality_scores
from tidemark.llm.toxicity import Network, indexed, toxicity_scores
from tidemark.llm.suffix_dedup import whole_words
from tidemark.llm.urls import url_verdicts

EXTRA = "doc_id long, text string, score double, label int, part string, odds double, x int"


def sentences(seed, n, words):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(words, rng.integers(20, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def labelled(spark):
    """Toxic documents hold one bad word, poor ones shout; awkward rows stand among them."""
    plain = "river house garden morning letter window music paper street winter quiet table".split()
    texts = sentences(1, 400, plain)
    rows = []
    for i, text in enumerate(texts):
        toxic, poor = int(i % 4 == 0), int(i % 3 == 0)
        if toxic:
            text = text.replace(" ", " zorkface! ", 1)
        if poor:
            text = text.upper().replace(" ", "!! ")
        rows.append((i, text, toxic, poor))
    odd = [(1000, None), (1001, ""), (1002, " \n "), (None, texts[1]), (5, rows[5][1]), (1003, "x" * 20_000)]
    docs = spark.createDataFrame([(i, t, 0.1, 7, "p", 0.2, 3) for i, t, *_ in rows] + [(i, t, 0.1, 7, "p", 0.2, 3) for i, t in odd], EXTRA)
    labels = spark.createDataFrame([(i, a, 1 - b) for i, _, a, b in rows] + [(None, 1, 1), (77777, 1, 0), (1000, None, None)], "doc_id long, toxic int, good int")
    return docs.repartition(3), labels


def accuracy(docs, labels, column, score):
    train = labels.where("doc_id % 5 <> 0").select("doc_id", F.col(column).alias("label"))
    rows = score(docs, train).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    truth = {r.doc_id: r[column] for r in labels.collect()}
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 5 == 0]
    return np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in held])


def test_quality(labelled):
    assert accuracy(*labelled, "good", quality_scores) > 0.95


def test_toxicity(labelled):
    assert accuracy(*labelled, "toxic", toxicity_scores) > 0.95


@pytest.mark.parametrize("score", [quality_scores, toxicity_scores])
def test_labels_of_one_class_or_none(labelled, score):
    docs, labels = labelled
    ones = labels.select("doc_id", F.lit(1).alias("label"))
    assert {r.score for r in score(docs, ones).collect()} == {1.0}
    assert {r.score for r in score(docs, ones.limit(0)).collect()} == {0.5}
    assert score(docs.limit(0), ones).isEmpty()


def test_scores_keep_columns(labelled):
    docs, labels = labelled
    kept = quality_scores(docs, labels.select("doc_id", F.col("good").alias("label")), ("doc_id", "text", "x"))
    assert kept.columns == ["doc_id", "text", "x", "score"]
    assert kept.select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).isEmpty()


def test_gradients():
    """Backward passes against differences, in the directions of the parameters."""
    net = Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    windows = [[b"a", b"bb", b"a"], [b"ccc"], [b"bb"] * 16]
    index, mask, words = indexed(windows)
    grams = np.array([1, 2, 3, 4, 5, 6])
    parts = (np.arange(len(words)) + 1, np.arange(len(words)), grams, np.array([1, 2, 3]))
    label, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    _, grad = net.gradients(parts, index, mask, label, weight)
    rng = np.random.default_rng(0)
    for name in ("wf", "ub", "bb", "wa", "va", "out", "bias", "char", "uf"):
        step = rng.standard_normal(net.p[name].shape)
        value, losses = net.p[name], []
        for sign in (1, -1):
            net.p[name] = value + sign * 1e-2 * step
            losses.append(net.gradients(parts, index, mask, label, weight)[0])
        net.p[name] = value
        assert (losses[0] - losses[1]) / 2e-2 == pytest.approx(float((grad[name] * step).sum()), rel=0.05, abs=2e-3), name


URLS = [
    "https://a.example.org/es/1?x=/en/", "HTTP://WWW.Example.ORG/en/1", "http://example.org/en/2", "http://notexample.org/es/1",
    "http://b.example.com/fr/1", "http://b.example.com/de/9#top", "http://org/", "http://org", "http://comx/fr/", None, "", "no scheme",
    "http://a.example.net/fr/12", "http://a.example.net/en/12", "x://é.com/de/ü?q", "http://a.example.net/fr/12", "://", "a://b://c.org/x",
]


def test_urls_against_sql(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(None, URLS[0], "h"), (3, URLS[3], "h")]
    rows += [(100 + i, f"http://s{i % 7}.example.{('org', 'com', 'net')[i % 3]}/{('en', 'fr', 'de', 'es')[i % 4]}/{i}", "h") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = url_verdicts(pages, queries.URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    want = con.sql(f"SELECT page_id, host, path, rule, verdict, score FROM ({queries.SQL['op2_url_filter']})").fetchall()
    plain = lambda rows: sorted(((None if r[0] is None or r[0] != r[0] else int(r[0]), *r[1:]) for r in map(tuple, rows)), key=repr)
    assert plain(got.collect()) == plain(want)
    assert url_verdicts(pages.limit(0), queries.URL_RULES).isEmpty()
    assert url_verdicts(pages.where("url is null"), queries.URL_RULES).first().verdict == "allow"


def test_urls_of_different_digits(spark):
    """A rule about a digit teaches the models about the digit."""
    rows = [(i, f"http://{h}.example.org/en/{i % 9 + 1}") for i, h in enumerate("abcdefghijklmnopqrstuvwxyz" * 8)]
    rows += [(1001, "http://a.example.net/en/1"), (1002, "http://a.example.net/en/2")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in url_verdicts(pages, queries.URL_RULES).where("page_id > 1000").collect()}
    assert got[1001].score < got[1002].score
    assert (got[1001].verdict, got[1002].verdict) == ("block", "allow")


def test_repeated_passages_go_and_clean_texts_stay(spark):
    """Passages of 51 words and more, short in bytes, repeated words and all; shorter ones stay."""
    import corpus_pipeline as cp

    rng = np.random.default_rng(9)
    letters = list("abcdefghijklmnopqrstuvwxyz")

    def some(n):
        return " ".join("".join(rng.choice(letters, rng.integers(2, 8))) for _ in range(n))

    long, short, line = some(51), " ".join("".join(rng.choice(letters, 3)) for _ in range(51)), some(40)
    texts = [f"{some(60)} {p} {some(60)}" for p in (long, long, short, short, line, line)] + [some(200), "", None]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id: r.text for r in cp.repeated_passages(spark, docs, "").collect()}
    assert all(long not in left[i] and short not in left[i] for i in range(4))
    assert all(left[i] is not None and len(left[i].split()) >= 118 for i in range(4))
    assert {i: left[i] for i in range(4, 9)} == {i: texts[i] for i in range(4, 9)}


def test_whole_words():
    text = b"one two three four"
    assert [whole_words(text, *x) for x in ((0, 18), (1, 18), (4, 13), (3, 14), (5, 12), (5, 6), (0, 0))] == [4, 3, 2, 2, 0, 0, 0]


def test_pipeline(spark):
    import corpus_pipeline as cp

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    odd = spark.createDataFrame([(None, None, "en", "s", 0), (10**9, "", "en", "s", 0), (10**9, "", "en", "s", 0)], docs.schema)
    now = docs.unionByName(odd)
    for name, stage in cp.STAGES[:-1]:
        before = now.count()
        after = stage(spark, now, sf_dir)
        assert after.columns == docs.columns, name
        now = spark.createDataFrame(after.collect(), docs.schema)
        assert 0 < now.count() <= before
    assert now.where(f"doc_id = {10**9}").count() <= 1
    clean = labels.where("quality = 1 and toxic = 0").count()
    assert now.join(labels.where("quality = 1 and toxic = 0"), "doc_id").count() > 0.5 * clean
    pieces = cp.STAGES[-1][1](spark, now, sf_dir)
    assert pieces.select("doc_id").distinct().count() == now.select("doc_id").distinct().count()


def test_one_row_of_each_near_group(spark):
    """Rows of one id in two groups, rows without an id, and copies of rows: one row a group, always the same."""
    import corpus_pipeline as cp

    first, second, third, fourth = sentences(5, 4, "river house garden morning letter window music paper street winter".split())
    rows = [(5, first), (5, second), (3, second), (None, second), (7, third), (None, fourth), (None, fourth), (None, fourth), (7, third), (5, first)]
    rows = [(i, t, lang, "s", len(t)) for i, t in rows for lang in ("fr", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = [cp.near_duplicates(spark, some, "").collect() for some in (docs.repartition(1), docs.repartition(5))]
    assert sorted(kept[0], key=repr) == sorted(kept[1], key=repr)
    assert sorted(((r.doc_id, r.text) for r in kept[0]), key=repr) == sorted([(5, first), (3, second), (7, third), (None, fourth)], key=repr)
    assert cp.near_duplicates(spark, docs.limit(0), "").isEmpty()


@pytest.mark.parametrize("toxic, quality", [(None, None), (1, 0)])
def test_stages_without_a_model_keep_all(spark, tmp_path, toxic, quality):
    """No labels, or labels of one class, reject no document."""
    import corpus_pipeline as cp

    texts = sentences(6, 40, "river house garden morning letter window music paper".split())
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = [] if toxic is None else [(i, quality, toxic) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for stage in (cp.toxicity, cp.quality):
        assert sorted(stage(spark, docs, str(tmp_path)).collect()) == sorted(docs.collect())
