"""Vector operators against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripleweft.llm import ann, cosine_dedup
from tripleweft.llm.ann import nearest
from tripleweft.llm.cosine_dedup import link_vectors

SCHEMA = "vec_id long, embedding array<float>"
#: Null, empty, zero and non-finite vectors.
UNUSABLE = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [float("inf")] + [1.0] * 15), (905, [None] + [1.0] * 15)]


def made_up(n=400, width=16):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((n, width)).astype(np.float32)
    x[100:160] = x[100] + 0.08 * rng.standard_normal((60, width)).astype(np.float32)
    x[200:220] = x[200]
    x[300] = 3 * x[301]
    return x


@pytest.fixture(scope="module")
def vectors(spark):
    x = made_up()
    data = [(i, [float(v) for v in row]) for i, row in enumerate(x)] + UNUSABLE + [(7, [float(v) for v in x[7]]), (None, [1.0] * 16)]
    return spark.createDataFrame(data, SCHEMA).withColumns({"rep": F.lit("clash"), "n": F.lit(0), "component_id": F.lit(1)}).repartition(4)


def brute_links(x, threshold=0.95):
    x = x.astype(np.float64)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= threshold
    label = np.arange(len(x))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return near.sum(1) - 1, label
        label = new


@pytest.mark.parametrize("block", [8192, 50])
def test_links_equal_brute_force(vectors, monkeypatch, block):
    monkeypatch.setattr(cosine_dedup, "BLOCK_ROWS", block)
    links, label = brute_links(made_up())
    assert links.max() > 15
    got = link_vectors(vectors).collect()
    assert len(got) == vectors.count()
    for r in got:
        if r.vec_id is None:
            assert r.component_id is None and r.kept and r.n_links == 0
        elif r.vec_id >= 900:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (links[r.vec_id], label[r.vec_id], label[r.vec_id] == r.vec_id)


def test_links_of_many_rescaled_vectors(spark, monkeypatch):
    """More vectors of one direction than a block holds: some blocks are empty, and no link beside them counts twice."""
    monkeypatch.setattr(cosine_dedup, "BLOCK_ROWS", 20)
    data = [(i, [3.0 * (i + 1), 0.0]) for i in range(100)] + [(200 + i, [1.0, 0.002 * (i - 30) + 0.001]) for i in range(60)]
    got = link_vectors(spark.createDataFrame(data, SCHEMA)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(159, 0)} and len(got) == 160


def test_links_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(cosine_dedup, "BLOCK_ROWS", 1)
    monkeypatch.setattr(cosine_dedup, "MOST_CUTS", 1200)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2000, 4)).astype(np.float32)
    x[1::100] = x[::100] * np.float32(1.7)
    links, label = brute_links(x, 1 - 1e-9)
    assert links.sum() >= 40
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], SCHEMA)
    got = link_vectors(df, 1 - 1e-9).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(i, links[i], label[i]) for i in range(2000)]


def test_one_direction_is_one_class_and_ties_are_split(spark, monkeypatch):
    """Copies of many lengths are compared once; rows of one value of the first component go to several blocks."""
    data = [(i, [3.0 * (i + 1), 1.0 * (i + 1)]) for i in range(50_000)]
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    assert cosine_dedup._directions(df).select("direction").distinct().count() == 1
    assert [tuple(r) for r in link_vectors(df).groupBy("n_links", "component_id").count().collect()] == [(49_999, 0, 50_000)]
    monkeypatch.setattr(cosine_dedup, "BLOCK_ROWS", 50)
    blocks = cosine_dedup._Blocks([-0.5, 0.5, 0.5, 0.7], 0.1)
    lead = np.concatenate([np.full(1000, 0.5), np.linspace(-1, 1, 100)])
    blocks.cut(dict(zip(*np.unique(blocks.range_of(lead), return_counts=True), strict=True)))
    part, low, high = blocks.place(lead, np.arange(1100))
    assert np.bincount(part).max() < 100 and len(set(part[:1000].tolist())) >= 20
    assert all((low[i] <= part[j] <= high[i]) == (low[j] <= part[i] <= high[j]) for i in range(0, 1100, 7) for j in range(1100))
    assert all(low[i] <= part[j] <= high[i] for i in range(0, 1100, 7) for j in np.flatnonzero(abs(lead - lead[i]) <= 0.1))


def test_two_vectors_of_one_id_keep_their_own_links(spark):
    data = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (5, [1.0, 0.01]), (6, [0.01, 1.0]), (7, [0.02, 1.0])]
    got = sorted(tuple(r) for r in link_vectors(spark.createDataFrame(data, SCHEMA)).collect())
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (5, 1, 1, False), (6, 2, 1, False), (7, 2, 1, False)]


def test_links_of_few_or_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert link_vectors(empty).count() == 0
    assert link_vectors(spark.createDataFrame(UNUSABLE, SCHEMA)).where("n_links > 0 OR NOT kept").count() == 0
    one = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, [-1.0])], SCHEMA)
    assert sorted(tuple(r) for r in link_vectors(one).collect()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    with pytest.raises(ValueError, match="components"):
        link_vectors(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SCHEMA))


@pytest.mark.parametrize("block", [16_384, 90])
def test_neighbours_are_exact_and_found(vectors, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK_ROWS", block)
    x = made_up().astype(np.float64)
    got = nearest(vectors, vectors.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()
    hits = total = 0
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append(r)
    assert sorted(by_query) == list(range(0, 400, 20))
    for q, found in by_query.items():
        assert [r["rank"] for r in found] == list(range(1, 11))
        assert q not in {r.vec_id for r in found} and len({r.vec_id for r in found}) == 10
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        for r in found:
            assert math.isclose(r.score, np.linalg.norm(x[q] - x[r.vec_id]), rel_tol=1e-12, abs_tol=1e-12)
        distance = np.linalg.norm(x - x[q], axis=1)
        distance[q] = np.inf
        hits += len({r.vec_id for r in found} & set(np.lexsort((np.arange(400), distance))[:10].tolist()))
        total += 10
    assert hits / total >= 0.9


def test_fewer_candidates_than_asked(spark, vectors):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (100, [0.0, 1.0]), (3, [1.0, 1.0])], SCHEMA)
    got = nearest(few, few.where("vec_id % 100 = 0")).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 3), (0, 2, 100), (100, 1, 3), (100, 2, 0)]
    assert nearest(few.where("vec_id = 0"), few.where("vec_id = 0")).count() == 0
    assert nearest(few.where(F.lit(False)), few).count() == 0
