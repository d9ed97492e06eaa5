"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from tradewind.llm import neighbours

VECTORS = "vec_id bigint, embedding array<double>"
QUERIES = "vec_id % 10 = 0"


def exact(rows, queries, k=10):
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for query, x in sorted(usable):
        if not queries(query):
            continue
        found = []
        for i, v in usable:
            if i != query and len(v) == len(x):
                total = 0.0
                for a, b in zip(x, v, strict=True):
                    total += (b - a) * (b - a)
                found.append((float(np.sqrt(total)), i))
        out += [(query, rank, i, score) for rank, (score, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def clusters(n, size, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((20, size)) * 4
    return (centres[rng.integers(20, size=n)] + rng.standard_normal((n, size))).tolist()


def test_all_leaves_give_exact_results(spark):
    rows = list(enumerate(clusters(300, 8)))
    frame = spark.createDataFrame(rows, VECTORS)
    found = neighbours.nearest_neighbours(frame, QUERIES)
    assert sorted(map(tuple, found.collect())) == exact(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("shape", ["clusters", "noise"])
def test_recall(spark, shape, monkeypatch):
    """The budget reaches the recall; in clusters it is a small part of the table."""
    vectors = (clusters(4000, 16) if shape == "clusters"
               else np.random.default_rng(3).standard_normal((4000, 16)).tolist())
    rows = list(enumerate(vectors))
    budgets = []
    search = neighbours._budget
    monkeypatch.setattr(neighbours, "_budget",
                        lambda *a: budgets.append(search(*a)) or budgets[-1])
    found = neighbours.nearest_neighbours(spark.createDataFrame(rows, VECTORS), QUERIES,
                                          min_candidates=10).collect()
    x = np.array(vectors)
    hits = 0
    for row in found:
        truth = np.sort(neighbours.distances(x[row.query_id], x.T))[10]  # the first is its own
        assert row.score == neighbours.distances(x[row.query_id], x[[row.vec_id]].T)[0]
        hits += row.score <= truth
    assert len(found) == 4000 and hits / 4000 >= 0.9
    assert 10 <= budgets[0] < neighbours.TREES * 4000 / (5 if shape == "clusters" else 1)


def test_blocks_are_cut_by_members_and_queries(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 20)
    rows = list(enumerate(clusters(500, 4)))
    found = neighbours.nearest_neighbours(spark.createDataFrame(rows, VECTORS), QUERIES)
    assert sorted(map(tuple, found.collect())) == exact(rows, lambda i: i % 10 == 0)


def test_copies_ties_and_unusable(spark):
    same = [1.0, 2.0]
    rows = ([(i, same) for i in range(0, 60)] + [(i, [1.0, 2.5]) for i in range(60, 75)]
            + [(i, [1.0, 1.5]) for i in range(75, 80)] + [(5, same), (70, [9.0, 9.0])]
            + [(80, None), (90, []), (100, [0.0, 0.0]), (110, [1.0, None]),
               (120, [float("nan"), 1.0]), (130, [float("inf"), 1.0]), (None, [1.0, 1.0]),
               (140, [1.0, 2.0, 3.0]), (141, [1.0, 2.0, 3.5]), (150, [-0.0, 1.0]),
               (151, [0.0, 1.0]), (160, [1e300, 1.0]), (170, [5.0])])
    frame = spark.createDataFrame(rows, VECTORS).withColumns(
        {"key": F.lit(1), "id": F.lit(2), "size": F.lit(3), "vector": F.lit(4),
         "query": F.lit(5), "distance": F.lit(6), "rank": F.lit(7), "score": F.lit(8)})
    found = neighbours.nearest_neighbours(frame, QUERIES, k=10)
    expected = exact(rows, lambda i: i % 10 == 0)
    assert sorted(map(tuple, found.collect())) == expected
    assert {query for query, *_ in expected} == {0, 10, 20, 30, 40, 50, 60, 70, 140, 150, 160}


def test_single_precision_and_empty(spark):
    frame = spark.read.parquet(f"{DATA}/sf0.001/embeddings.parquet")
    rows = [(row.vec_id, row.embedding) for row in frame.select("vec_id", "embedding").collect()]
    found = neighbours.nearest_neighbours(frame, F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, found.collect())) == exact(rows, lambda i: i % 100 == 0)
    none = neighbours.nearest_neighbours(frame.limit(0), QUERIES)
    assert none.count() == 0 and none.columns == ["query_id", "rank", "vec_id", "score"]
    assert neighbours.nearest_neighbours(frame, F.lit(False)).count() == 0
