"""Operators on embeddings against brute force."""

import tracemalloc

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, embedding_dedup
from tidemark.llm.ann import nearest
from tidemark.llm.embedding_dedup import embedding_groups
from tidemark.llm.sql import LINKS_SQL

SCHEMA = "vec_id long, embedding array<float>, label int, d long, cell int, code int, weight double"
BAD = [(9001, None), (9002, [0.0] * 8), (9003, [1.0, None, *[0.0] * 6]), (9004, [float("nan")] * 8), (9005, [float("inf"), *[0.0] * 7]), (9006, [1.0, 2.0])]


def rows_of(matrix, ids):
    return [(int(i), [float(x) for x in v]) for i, v in zip(ids, matrix, strict=True)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, 0.5) for i, v in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def clusters():
    """Near copies around some centres, exact copies of one vector, and lone vectors."""
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((12, 8))
    near = np.concatenate([c + rng.standard_normal((20, 8)) * s for c, s in zip(centres, np.linspace(0.05, 0.5, 12), strict=True)])
    copies = np.repeat(centres[:1] * 3, 60, axis=0)
    return np.concatenate([near, copies, rng.standard_normal((150, 8))]).astype(np.float32)


@pytest.mark.parametrize("per_cell, block", [(512, 2048), (16, 8)])
def test_embedding_links(spark, clusters, monkeypatch, per_cell, block):
    monkeypatch.setattr(embedding_dedup, "PER_CELL", per_cell)
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    ids = np.random.default_rng(1).permutation(len(clusters)) * 3
    got = {r.vec_id: r for r in embedding_groups(frame(spark, rows_of(clusters, ids) + BAD), 0.95).collect()}
    unit = clusters.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    name = ids.copy()
    for _ in range(len(ids)):
        name = np.minimum(name, np.where(link, name[None, :], ids.max()).min(1))
    for i, n, c in zip(ids, link.sum(1), name, strict=True):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n, c, i == c)
    for i, _ in BAD:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_embedding_edge_tables(spark, clusters):
    assert embedding_groups(frame(spark, [])).isEmpty()
    assert {(r.n_links, r.kept) for r in embedding_groups(frame(spark, BAD[:4])).collect()} == {(0, True)}
    twice = rows_of(clusters[:1], [5]) * 2 + [(None, [float(x) for x in clusters[0]])]
    assert sorted((r.n_links, r.component_id, r.kept) for r in embedding_groups(frame(spark, twice)).collect()) == [(2, 5, False), (2, 5, True), (2, 5, True)]


def test_embedding_links_within_each_length(spark, clusters):
    """Vectors of one length do not silence those of another, nor link with them."""
    rows = [(i, [1.0, 2.0, 3.0]) for i in (4, 5, 6)] + [(7, [1.0, 2.0, 3.0, 0.0])] + rows_of(clusters[:40], range(100, 140))
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_groups(frame(spark, rows)).collect()}
    alone = {r.vec_id: (r.n_links, r.component_id) for r in embedding_groups(frame(spark, rows[4:])).collect()}
    assert got == {4: (2, 4), 5: (2, 4), 6: (2, 4), 7: (0, 7)} | alone
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    assert {r[0]: r[1:3] for r in con.execute(LINKS_SQL).fetchall()} == got


@pytest.mark.parametrize("shard", [65_536, 200])
def test_nearest_by_inner_product(spark, clusters, monkeypatch, shard):
    monkeypatch.setattr(ann, "SHARD", shard)
    ids = np.arange(len(clusters))
    got = {}
    for r in nearest(frame(spark, rows_of(clusters, ids) + BAD), F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    exact, hit = clusters.astype(np.float64), 0
    queries = ids[ids % 20 == 0]
    assert set(got) == set(queries.tolist())
    for q in queries.tolist():
        score = exact @ exact[q]
        found = got[q]
        assert [f[0] for f in found] == list(range(1, 21))
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        for _, v, s in found:
            assert v != q and s == pytest.approx(score[v], abs=1e-12)
        order = np.lexsort((ids, -np.round(score, 9)))
        hit += len({f[1] for f in found} & set(order[order != q][:20].tolist()))
    assert hit / (20 * len(queries)) >= 0.9


def test_nearest_of_few(spark, clusters):
    """Fewer candidates than asked for are all returned, ties in order of their ids."""
    rows = rows_of(clusters[[0, 1, 240, 241]], [20, 7, 9, 8]) + BAD
    got = [(r.query_id, r["rank"], r.vec_id) for r in nearest(frame(spark, rows), F.col("vec_id") == 20, 20).orderBy("rank").collect()]
    assert {v for *_, v in got} == {7, 8, 9} and [r for _, r, _ in got] == [1, 2, 3]
    places = {v: r for _, r, v in got}
    assert places[8] + 1 == places[9]
    assert nearest(frame(spark, []), F.col("vec_id") == 20).isEmpty()
    assert nearest(frame(spark, rows[:1]), F.col("vec_id") == 20).isEmpty()


@pytest.mark.parametrize("norms", ["equal", "one long", "two kinds", "spread"])
def test_nearest_of_unequal_norms(spark, norms):
    """Recall with fewer probes than axes, whatever the norms."""
    rng = np.random.default_rng(3)
    rows = rng.standard_normal((3_000, 64))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    length = {"equal": np.ones(3_000), "one long": np.where(np.arange(3_000) == 7, 10.0, 1.0), "two kinds": np.where(np.arange(3_000) % 16 == 7, 5.0, 1.0), "spread": np.exp(rng.standard_normal(3_000))}[norms]
    rows = (rows * length[:, None]).astype(np.float32)
    got = {}
    for r in nearest(frame(spark, rows_of(rows, range(3_000))), F.col("vec_id") % 20 == 0, 20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    score = rows[::20].astype(np.float64) @ rows.T.astype(np.float64)
    score[np.arange(150), np.arange(0, 3_000, 20)] = -np.inf
    hits = [len(got[20 * i] & set(best.tolist())) / 20 for i, best in enumerate(np.argsort(-score, axis=1)[:, :20])]
    assert np.mean(hits) >= 0.95 and min(hits) >= 0.5


def test_codes_of_several_axes_meet_few(spark, monkeypatch):
    """At the fitted margin a query finds what is nearest among a small part of all candidates."""
    rng = np.random.default_rng(4)
    rows = rng.standard_normal((20_000, 64)).astype(np.float32)
    vectors = frame(spark, rows_of(rows / np.linalg.norm(rows, axis=1, keepdims=True), range(20_000))).withColumn("id", F.col("vec_id"))
    schema = "id long, vec_id long, size int, v binary, codes array<struct<first: int, code: long>>"
    base = vectors.select("id", "vec_id", "embedding").mapInArrow(ann.indexed({64: 2.0}, 16, 3), schema)
    limits = ann.fitted_margins(base, base.where("vec_id % 20 = 0"), [64, 9], 20, 16, 3, 0.95)
    assert limits[9] == 0  # no query of that length
    has = base.toPandas().sort_values("id", ignore_index=True)
    has["codes"] = [[c["code"] for c in codes] for codes in has["codes"]]
    group = pd.concat([has.assign(query=False), has[has["vec_id"] % 200 == 10].assign(query=True)])
    met, meet = set(), ann.Best.meet
    monkeypatch.setattr(ann.Best, "meet", lambda self, row, col: (met.update(zip(row.tolist(), col.tolist(), strict=True)), meet(self, row, col)))
    got = ann.search_group(20, limits, 16, 3)(group)
    assert len(met) / (100 * 20_000) < 0.15
    q, x = ann.unpack(has["v"][10::200], 64), ann.unpack(has["v"], 64)
    score = q @ x.T
    score[np.arange(100), np.arange(10, 20_000, 200)] = -np.inf
    true = {(10 + 200 * i, c) for i, best in enumerate(np.argsort(-score, axis=1)[:, :20]) for c in best.tolist()}
    assert len(true & set(zip(got["query_id"], got["vec_id"], strict=True))) / len(true) >= 0.92


def test_nearest_within_each_length(spark, clusters):
    """Vectors of another length are neighbours of each other and silence nobody."""
    rows = rows_of(clusters[:30], range(30)) + [(40, [1.0] * 9), (41, [2.0] * 9), (60, [3.0] * 12)]
    got = {}
    for r in nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 5).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    score = clusters[:30].astype(np.float64) @ clusters[:30].T.astype(np.float64)
    np.fill_diagonal(score, -np.inf)
    assert got == {q: set(np.argsort(-score[q])[:5].tolist()) for q in (0, 20)} | {40: {41}}


def test_nearest_of_repeated_ids(spark):
    """Every row but the query's own is a candidate, others of its id too, and every such row is a query."""
    vectors = [(1, [1.0, 2.0]), (1, [9.0, 9.0]), (1, [1.0, 2.0]), (20, [3.0, 3.0]), (20, [1.0, 0.0]), (7, [2.0, 2.0])]
    want = []
    for a, (i, x) in enumerate(vectors):
        if i == 20:
            scores = [(-(x[0] * y[0] + x[1] * y[1]), j) for b, (j, y) in enumerate(vectors) if a != b]
            want += [(20, rank, j, -s) for rank, (s, j) in enumerate(sorted(scores), 1)]
    for parts in (1, 4):
        got = nearest(frame(spark, vectors).repartition(parts), F.col("vec_id") == 20, 20)
        assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == sorted(want)


def test_nearest_in_bounded_groups(spark, clusters, monkeypatch):
    """Queries of a group are split too, and the answers stay."""
    vectors, ask = frame(spark, rows_of(clusters, range(len(clusters)))), F.col("vec_id") % 3 == 0
    want = sorted(map(tuple, nearest(vectors, ask, 20).collect()))
    search = ann.search_group

    def guarded(*args):
        run = search(*args)

        def counted(part):
            assert part["query"].sum() <= 70, "too many queries in a group"
            return run(part)

        return counted

    monkeypatch.setattr(ann, "search_group", guarded)
    monkeypatch.setattr(ann, "ASKS", 30, raising=False)
    assert sorted(map(tuple, nearest(vectors, ask, 20).collect())) == want


def test_group_keeps_little_of_each_tile(monkeypatch):
    """What a group holds does not grow with its tiles."""
    monkeypatch.setattr(ann, "TILE", 32)
    rng = np.random.default_rng(5)
    x, q = rng.standard_normal((3_200, 8)), rng.standard_normal((300, 8))
    packs = [v.tobytes() for v in np.concatenate([x, q])]
    group = pd.DataFrame({"id": np.arange(3_500), "vec_id": np.arange(3_500), "size": 8, "v": packs, "codes": [[0]] * 3_500, "query": np.arange(3_500) >= 3_200})
    run = ann.search_group(20)
    tracemalloc.start()
    got = run(group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    best = np.argsort(-(q @ x.T), axis=1)[:, :20]
    assert got.groupby("query_id")["vec_id"].apply(list).tolist() == best.tolist()
    assert peak < 8e6, peak
