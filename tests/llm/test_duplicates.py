"""Components, SimHash and embeddings against brute force."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL
from tradewind.llm import embeddings, queries, simhash
from tradewind.llm.components import connected_components


def components(nodes, edges):
    root = {node: node for node in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


@pytest.mark.parametrize("edges", [
    [], [(i, i + 1) for i in range(60)], [(100, i) for i in range(60)],
    [(0, i) for i in range(60)], [(5, 5), (None, 3), (2, 1), (1, 2)],
    [tuple(random.Random(3).sample(range(150), 2)) for _ in range(1)]
    + [tuple(random.Random(i).sample(range(150), 2)) for i in range(110)]])
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "x bigint, y bigint")
    found = {row.node: row.component for row in connected_components(frame, "x", "y").collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    nodes = {node for edge in real for node in edge}
    assert found == components(nodes, real)


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lowered).split(" ")
             if w]
    if not words:
        return 0
    shingles = ([" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
                if len(words) >= 3 else [" ".join(words)])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64)
               if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


TEXTS = [None, "", " \t\n", "One", "one TWO", "one two three", "ONE\x0btwo\x1cthree four",
         "É one two three", "a b c " * 30_000, "x y z w v u " * 3]


def test_fingerprints():
    for text in TEXTS:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_anchors_cover(spark):
    rng = random.Random(1)
    halves = [0, 1, (1 << 32) - 1, 1 << 31] + [rng.getrandbits(32) for _ in range(300)]
    home, near = simhash.anchors(F.col("half"))
    rows = spark.createDataFrame([(h,) for h in halves], "half bigint").select(
        "half", home.alias("home"), near.alias("near")).collect()
    for row in rows:
        assert (row.half ^ row.home).bit_count() <= 1 and row.home in row.near
        assert len(row.near) == len(set(row.near)) <= 17
        assert all((row.half ^ a).bit_count() <= 2 for a in row.near)
    near_of = {row.half: set(row.near) for row in rows}
    flipped = [(h, h ^ (1 << bit)) for h in halves[:40] for bit in range(32)]
    others = spark.createDataFrame([(b,) for _, b in flipped], "half bigint").select(
        home.alias("home")).collect()
    assert all(row.home in near_of[a] for (a, _), row in zip(flipped, others, strict=True))


def test_links_find_every_near_pair(spark):
    rng = random.Random(2)
    values = set()
    for _ in range(30):
        centre = rng.getrandbits(64)
        for _ in range(12):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                value ^= 1 << bit
            values.add(value)
    signed = {int(np.uint64(v).view(np.int64)) if False else (v if v < 1 << 63 else v - (1 << 64))
              for v in values}
    frame = spark.createDataFrame([(v,) for v in signed], "bits bigint")
    found = [(row.a, row.b) for row in simhash.links(frame).collect()]
    mask = (1 << 64) - 1
    every = [(a, b) for a, b in combinations(signed, 2)
             if ((a ^ b) & mask).bit_count() <= 3]
    assert all(((a ^ b) & mask).bit_count() <= 3 for a, b in found)
    assert components(signed, found) == components(signed, every)


def test_anchors_with_many_rows_are_cut(spark, monkeypatch):
    monkeypatch.setattr(simhash, "ROWS_PER_PART", 5)
    values = [a | b << 6 for a in range(64) if a.bit_count() <= 2
              for b in range(64) if b.bit_count() <= 1]
    frame = spark.createDataFrame([(v,) for v in values], "bits bigint")
    edges = [(r.a, r.b) for r in simhash.links(frame).collect()]
    assert set(components(values, edges).values()) == {0}


def test_simhash_of_odd_rows(spark):
    rows = [(i, text, 9) for i, text in enumerate(TEXTS)] + [(2, TEXTS[-1], 9), (None, "One", 9)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, component_id bigint")
    found = simhash.near_duplicates(frame).collect()
    assert len(found) == len(rows)
    assert {row.doc_id: row.component_id for row in found if row.doc_id in (0, 1, 2)} == {
        0: 0, 1: 0, 2: 0} or any(row.doc_id == 2 and row.component_id == 2 for row in found)
    assert {row.component_id for row in found if row.doc_id is None} == {3}
    assert simhash.near_duplicates(frame.limit(0)).count() == 0


def test_simhash_query(spark):
    found = queries.queries()["op4_simhash"](spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    prints = {doc: plain_fingerprint(text) for doc, text in texts.items()}
    edges = [(a, b) for a, b in combinations(prints, 2)
             if (prints[a] ^ prints[b]).bit_count() <= 3]
    expected = components(prints, edges)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {
        (doc, f"{bits:016x}", expected[doc]) for doc, bits in prints.items()}
    assert len(found) == len(texts)


def brute_vectors(rows, threshold=0.95):
    def usable(v):
        return (v and all(x is not None and np.isfinite(x) for x in v) and any(v))
    good = [i for i, (_, v) in enumerate(rows) if usable(v)]
    edges = [(i, j) for i, j in combinations(good, 2)
             if len(rows[i][1]) == len(rows[j][1])
             and np.dot(rows[i][1], rows[j][1]) / np.linalg.norm(rows[i][1])
             / np.linalg.norm(rows[j][1]) >= threshold]
    links = [0] * len(rows)
    for i, j in edges:
        links[i] += 1
        links[j] += 1
    group = components(range(len(rows)), edges)
    smallest = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            smallest[group[i]] = min(vec_id, smallest.get(group[i], vec_id))
    return [(vec_id, links[i], smallest.get(group[i])) for i, (vec_id, _) in enumerate(rows)]


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_embeddings_query(spark, folder):
    found = queries.queries()["op10_embeddings"](spark, folder).collect()
    rows = [(r.vec_id, r.embedding)
            for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == sorted(
        brute_vectors(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_embeddings_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "ROWS_PER_PART", 3)
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(8)
    rows = [(i, (centre + 0.05 * rng.standard_normal(8)).tolist()) for i in range(20)]
    rows += [(20, centre.tolist()), (20, centre.tolist()), (21, (3 * centre).tolist()),
             (22, None), (23, []), (24, [0.0] * 8), (25, [float("nan")] * 8),
             (26, [None] * 8), (27, [float("inf")] * 8), (28, [1.0]), (29, [2.0]),
             (30, [-0.0, 1.0]), (31, [0.0, 1.0]), (32, [1e-200, 1e-200]), (33, [1e200, 1e200]),
             (None, [5.0, 5.0]), (None, [-7.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn(
        "n_links", F.lit("clash"))
    found = [(r.vec_id, r.n_links, r.component_id)
             for r in embeddings.near_duplicates(frame).collect()]
    tiny = {32: [1.0, 1.0], 33: [1.0, 1.0]}
    expected = brute_vectors([(i, tiny.get(i, v)) for i, v in rows])
    key = lambda row: [(x is None, x or 0) for x in row]
    assert sorted(found, key=key) == sorted(expected, key=key)
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_table_sizes_grow_slowly():
    assert embeddings.table_sizes(0) == (6, embeddings.table_sizes(100)[1])
    signs, tables = embeddings.table_sizes(10**9)
    assert signs == 25 and tables < 120
