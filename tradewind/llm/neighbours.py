"""Approximate nearest neighbours by a forest of random-projection trees.

A tree splits by random directions, orthogonal to one another while there are dimensions left; each
level has one direction and each node its own median. The medians are fitted on a bounded sample
(SAMPLE_ROWS rows, SAMPLE_BYTES bytes), so the forest that tasks receive is bounded too; every
vector is then put into one leaf of each tree. Beyond LEAF_ROWS times the leaves that the sample
supports, leaves grow with the table, and blocks keep memory bounded.

A query searches all trees through one shared priority queue, nearest cell first: a node's priority
is the sum of the squared gaps to the splits on its way that the query lies on the other side of.
It stops when the leaves taken hold the budget of candidates. The budget is the smallest that finds
RECALL of the true neighbours of up to SAMPLE_QUERIES queries, which are compared with all vectors,
and MIN_CANDIDATES at least: vectors in clear clusters need little of the table, vectors without any
structure a large part of it.

Candidates are ranked by exact distances. A vector is shuffled once, to the block of its leaf in the
first tree; queries travel to the blocks that hold members of the leaves they take, which a bitmap
of leaves for each run of leaves of the first tree tells (bounded like the forest). Blocks are cut by members and by queries, so neither a hot leaf nor many queries pile up in a
task, and a task keeps the nearest of each block only.

Copies of a vector are compared once. Of their ids the k + 1 smallest can be among the k nearest of
any query, so no more are kept. Vectors that are NULL, empty, zero, or hold a NULL or a component
that isn't finite, and rows without an id, take no part; a row given twice counts once. Vectors of
different dimensions are not compared. A query without candidates has no row.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.batches import arrow_schema, group_bounds, importable, map_groups
from tradewind.operators.lineage import written

TREES = 8
LEAF_ROWS = 128
SAMPLE_ROWS = 50_000
SAMPLE_BYTES = 64_000_000
SAMPLE_ROWS_PER_LEAF = 12  # with SAMPLE_ROWS, at most 4,096 leaves a tree: a bitmap of 32,768
SAMPLE_QUERIES = 128
RECALL = 0.95
MIN_CANDIDATES = 5_000
# Members, and queries, of one block.
BLOCK_ROWS = 4_096
SEED = 11


@dataclass(frozen=True)
class Forest:
    """``directions[t]``: a column per level; ``splits[t][level]``: the median of each node."""

    directions: list[np.ndarray]
    splits: list[list[np.ndarray]]

    @property
    def depth(self) -> int:
        return len(self.splits[0])

    @classmethod
    def fit(cls, sample: np.ndarray, depth: int, trees: int = TREES, seed: int = SEED) -> Forest:
        size = sample.shape[1]
        directions, splits = [], []
        for tree in range(trees):
            random = np.random.default_rng([seed, tree, size]).standard_normal((size, depth))
            if depth <= size:
                random = np.linalg.qr(random)[0]
            else:
                random /= np.linalg.norm(random, axis=0)
            at = sample @ random
            node = np.zeros(len(sample), np.int64)
            levels = []
            for level in range(depth):
                order = np.lexsort((at[:, level], node))
                bounds = np.searchsorted(node[order], np.arange(2 ** level + 1))
                middle = np.minimum((bounds[:-1] + bounds[1:]) // 2, len(sample) - 1)
                levels.append(at[order[middle], level])
                node = 2 * node + (at[:, level] > levels[-1][node])
            directions.append(random)
            splits.append(levels)
        return cls(directions, splits)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree, numbered through the forest."""
        found = np.empty((len(x), len(self.splits)), np.int32)
        for tree, levels in enumerate(self.splits):
            at = x @ self.directions[tree]
            node = np.zeros(len(x), np.int64)
            for level, split in enumerate(levels):
                node = 2 * node + (at[:, level] > split[node])
            found[:, tree] = node + tree * 2 ** self.depth
        return found

    def visits(self, x: np.ndarray, sizes: np.ndarray, budget: int) -> list[int]:
        """Leaves in the order of the shared queue until they hold ``budget`` rows."""
        at = [(x @ directions).tolist() for directions in self.directions]
        queue = [(0.0, tree, 0, 0) for tree in range(len(at))]
        found, total, depth = [], 0, self.depth
        while queue and total < budget:
            gaps, tree, first, node = heapq.heappop(queue)
            for level in range(first, depth):
                gap = at[tree][level] - self.splits[tree][level][node]
                right = int(gap > 0)
                heapq.heappush(queue, (gaps + gap * gap, tree, level + 1, 2 * node + 1 - right))
                node = 2 * node + right
            leaf = node + tree * 2 ** depth
            if sizes[leaf]:
                found.append(leaf)
                total += int(sizes[leaf])
        return found

    def needed(self, x: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """For each row of ``wanted`` (a leaf per tree), the budget that takes one of its leaves.

        Gaps of all leaves at once; the queue takes leaves in this order.
        """
        leaf = np.arange(2 ** self.depth)
        gaps = np.zeros((len(self.splits), len(leaf)))
        for tree, levels in enumerate(self.splits):
            at = x @ self.directions[tree]
            for level, split in enumerate(levels):
                gap = at[level] - split[leaf >> (self.depth - level)]
                beyond = (gap > 0) != ((leaf >> (self.depth - level - 1)) & 1)
                gaps[tree] += np.where(beyond, gap * gap, 0)
        order = np.argsort(gaps.ravel(), kind="stable")
        before = np.empty(len(order), np.int64)
        before[order] = np.cumsum(sizes[order]) - sizes[order]
        return before[wanted].min(axis=1) + 1


def _vectors(rows: DataFrame, vector: str, row_id: str) -> DataFrame:
    """(id, key, size, vector) of the usable rows; vectors as bytes, key is a hash of them."""
    single = dict(rows.dtypes)[vector] == "array<float>"  # stay half as large
    values = F.col(vector) if single else F.col(vector).cast("array<double>")
    schema = "id bigint, key binary, size int, vector binary"
    target = arrow_schema(schema)
    importable(rows.sparkSession)

    def run(batches):
        for batch in batches:
            column = batch.column("vector")
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
            for size in np.unique(sizes[sizes > 0]).tolist():
                part = batch.filter(pa.array(sizes == size))
                x = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                x = x.reshape(-1, size) + x.dtype.type(0)  # turns -0 into 0
                good = np.flatnonzero(np.isfinite(x).all(axis=1) & (x != 0).any(axis=1))
                stored = [x[i].tobytes() for i in good]
                yield pa.RecordBatch.from_pydict(
                    {"id": part.column("id").take(pa.array(good)),
                     "key": [hashlib.blake2b(value, digest_size=16).digest() for value in stored],
                     "size": [size] * len(stored), "vector": stored}, schema=target)

    return (rows.select(F.col(row_id).cast("bigint").alias("id"), values.alias("vector"))
            .where("id IS NOT NULL").mapInArrow(run, schema))


def _matrix(column: pa.ChunkedArray | pa.Array, kind: str) -> np.ndarray:
    stored = column.to_pylist()
    return np.frombuffer(b"".join(stored), kind).reshape(len(stored), -1).astype(np.float64)


def distances(x: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Euclidean distances of a vector and the columns of ``members``, summed in order of the
    components."""
    total = np.zeros(members.shape[1])
    for value, component in zip(x, members, strict=True):
        gap = component - value
        total += gap * gap
    return np.sqrt(total)


def _nearest(found: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest by distance, then id."""
    if len(found) > k:
        near = np.flatnonzero(found <= np.partition(found, k - 1)[k - 1])
    else:
        near = np.arange(len(found))
    return near[np.lexsort((ids[near], found[near]))[:k]]


def _housed(distinct: DataFrame, forest: Forest, kind: str) -> DataFrame:
    """Distinct vectors with their leaf in each tree."""
    schema = "key binary, ids array<bigint>, vector binary, leaves array<int>"
    target = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                leaves = forest.leaves(_matrix(batch.column("vector"), kind))
                yield pa.RecordBatch.from_pydict(
                    {name: batch.column(name) for name in ("key", "ids", "vector")}
                    | {"leaves": list(leaves)}, schema=target)

    return distinct.select("key", "ids", "vector").mapInArrow(run, schema)


def _true_neighbours(housed: DataFrame, queries: list, k: int, kind: str) -> DataFrame:
    """(query, leaves) of the k nearest other vectors of some queries, compared with all."""
    schema = "query int, distance double, first bigint, leaves array<int>"
    target = arrow_schema(schema)
    points = [(row.key, np.frombuffer(row.vector, kind).astype(np.float64)) for row in queries]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            members = np.ascontiguousarray(_matrix(batch.column("vector"), kind).T)
            keys = batch.column("key").to_pylist()
            first = np.array([ids[0] for ids in batch.column("ids").to_pylist()])
            leaves = batch.column("leaves").to_pylist()
            out = []
            for number, (key, x) in enumerate(points):
                found = distances(x, members)
                out += [(number, float(found[i]), int(first[i]), leaves[i])
                        for i in _nearest(found, first, k + 1) if keys[i] != key]
            yield pa.RecordBatch.from_pydict(
                dict(zip(target.names, zip(*out, strict=True), strict=True)) if out
                else {name: [] for name in target.names}, schema=target)

    place = F.row_number().over(Window.partitionBy("query").orderBy("distance", "first"))
    return (housed.mapInArrow(run, schema).withColumn("place", place)
            .where(F.col("place") <= k).select("query", "leaves"))


def _budget(housed: DataFrame, points: DataFrame, forest: Forest, sizes: np.ndarray, k: int,
            recall: float, least: int, kind: str) -> int:
    """The number of candidates that finds ``recall`` of the neighbours of sampled queries."""
    if sizes.sum() <= least:
        return least
    queries = points.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_QUERIES).collect()
    if not queries:
        return least
    wanted: dict[int, list[list[int]]] = {}
    for row in _true_neighbours(housed, queries, k, kind).collect():
        wanted.setdefault(row.query, []).append(row.leaves)
    needs = np.sort(np.concatenate([
        forest.needed(np.frombuffer(queries[number].vector, kind).astype(np.float64), sizes,
                      np.array(leaves)) for number, leaves in wanted.items()]))
    return max(least, int(needs[math.ceil(recall * len(needs)) - 1]))


def _searched(points: DataFrame, forest: Forest, sizes: np.ndarray, budget: int,
              inside: np.ndarray, kind: str) -> DataFrame:
    """Queries with the leaves they take, and the places that hold members of these."""
    schema = "key binary, vector binary, leaves array<int>, places array<int>"
    target = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("vector"), kind)
                leaves = [forest.visits(row, sizes, budget) for row in x]
                yield pa.RecordBatch.from_pydict(
                    {"key": batch.column("key"), "vector": batch.column("vector"),
                     "leaves": leaves, "places": [np.flatnonzero(inside[:, taken].any(axis=1))
                                                  for taken in leaves]}, schema=target)

    return points.mapInArrow(run, schema)


def _compared(homes: DataFrame, asked: DataFrame, leaves: int, k: int, kind: str) -> DataFrame:
    """(query, distance, ids): the nearest of each block for each query that comes to it."""
    parts = written(asked.groupBy("home").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("parts")))
    block = F.shiftleft("home", 20)  # a home has at most 2^20 parts of its queries
    queries = asked.join(parts, "home").select(
        (block + F.pmod(F.xxhash64("key"), F.col("parts"))).alias("block"),
        "key", F.lit(None).cast("array<bigint>").alias("ids"), "vector", "leaves")
    repeats = F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)
    members = homes.join(parts, "home").select(
        F.explode(F.transform(repeats, lambda part: block + part)).alias("block"),
        "key", "ids", "vector", "leaves")
    schema = "query binary, distance double, ids array<bigint>"
    target = arrow_schema(schema)

    def compare(table: pa.Table) -> pa.Table | None:
        starts, ends = group_bounds(table.column("block").to_numpy())
        out: list[tuple] = []
        for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
            group = table.slice(start, end - start).combine_chunks()
            query = pc.is_null(group.column("ids"))
            queries, inside = group.filter(query), group.filter(pc.invert(query))
            if not queries.num_rows or not inside.num_rows:
                continue
            ids = inside.column("ids").to_pylist()
            first = np.array([values[0] for values in ids])
            members = np.ascontiguousarray(_matrix(inside.column("vector"), kind).T)
            homes = np.array(inside.column("leaves").to_pylist())
            taken = np.zeros(leaves, bool)
            for key, x, visited in zip(queries.column("key").to_pylist(),
                                       _matrix(queries.column("vector"), kind),
                                       queries.column("leaves").to_pylist(), strict=True):
                taken[:] = False
                taken[visited] = True
                candidates = np.flatnonzero(taken[homes].any(axis=1))
                if len(candidates):
                    found = distances(x, members[:, candidates])
                    best = _nearest(found, first[candidates], k + 1)
                    out += [(key, float(found[i]), ids[candidates[i]]) for i in best]
        if not out:
            return None
        query, distance, found = zip(*out, strict=True)
        return pa.table({"query": query, "distance": distance, "ids": found}, schema=target)

    return map_groups(queries.unionByName(members), "block", compare, schema)


def _search(distinct: DataFrame, points: DataFrame, size: int, k: int, recall: float,
            least: int, kind: str) -> DataFrame:
    """(query, distance, ids) for vectors of one dimension."""
    rows = distinct.count()
    sample_rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size)))
    sample = distinct.select("key", "vector").orderBy(F.xxhash64("key"), "key").limit(
        sample_rows) if rows <= sample_rows else distinct.select("key", "vector").where(
        # by a threshold, so that a task sends its share only
        F.pmod(F.xxhash64("key"), F.lit(rows)) < sample_rows)
    x = np.stack([np.frombuffer(row.vector, kind) for row in sample.collect()]).astype(np.float64)
    depth = max(0, math.ceil(math.log2(max(1, rows) / LEAF_ROWS)))
    depth = min(depth, max(0, int(math.log2(len(x) / SAMPLE_ROWS_PER_LEAF))) if len(x)
                >= SAMPLE_ROWS_PER_LEAF else 0)
    forest = Forest.fit(x, depth)
    housed = written(_housed(distinct, forest, kind))
    sizes = np.zeros(len(forest.splits) * 2 ** depth, np.int64)
    for row in housed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():
        sizes[row.leaf] = row["count"]

    budget = _budget(housed, points, forest, sizes, k, recall, least, kind)
    # A place is a run of leaves of the first tree; it is cut into homes where it has many rows.
    run = max(1, BLOCK_ROWS // LEAF_ROWS)
    padded = np.append(sizes[:2 ** depth], np.zeros(-(2 ** depth) % run, np.int64))
    parts = np.maximum(1, -(-padded.reshape(-1, run).sum(axis=1) // BLOCK_ROWS))
    place = F.floor(F.element_at("leaves", 1) / run).cast("int")
    many = F.array(*(F.lit(int(n)).cast("bigint") for n in parts))
    homes = written(housed.withColumn(
        "home", F.shiftleft(place.cast("bigint"), 30)
        + F.pmod(F.xxhash64("key"), F.element_at(many, place + 1))))
    inside = np.zeros((len(parts), len(sizes)), bool)
    for row in (homes.select(place.alias("place"), F.explode("leaves").alias("leaf"))
                .groupBy("place").agg(F.bitmap_construct_agg(F.col("leaf").cast("bigint"))
                                      .alias("leaves")).collect()):
        inside[row.place] = np.unpackbits(np.frombuffer(row.leaves, np.uint8),
                                          bitorder="little")[:len(sizes)]
    searched = _searched(points, forest, sizes, budget, inside, kind)
    asked = written(searched.select(
        "key", "vector", "leaves", F.explode(F.flatten(F.transform("places", lambda p: F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.element_at(many, p + 1) - 1),
            lambda part: F.shiftleft(p.cast("bigint"), 30) + part)))).alias("home")))
    return _compared(homes, asked, len(sizes), k, kind)


def nearest_neighbours(rows: DataFrame, queries: Column | str, k: int = 10, vector: str = "embedding",
                       row_id: str = "vec_id", recall: float = RECALL,
                       min_candidates: int = MIN_CANDIDATES) -> DataFrame:
    """(query_id, rank, row_id, score): the k nearest other rows found for each row that
    ``queries`` selects by its id, nearest first, ties to the smaller id.

    ``score`` is the exact Euclidean distance in double precision. ``row_id`` is an integer
    column and ``queries`` a condition on it.
    """
    kind = "f4" if dict(rows.dtypes)[vector] == "array<float>" else "f8"
    asked = rows.where(queries).select(F.col(row_id).cast("bigint").alias("id")).distinct()
    usable = written(_vectors(rows, vector, row_id))
    copies = Window.partitionBy("key").orderBy("id")
    distinct = written(
        usable.groupBy("key", "id").agg(F.first("size").alias("size"),
                                        F.first("vector").alias("vector"))
        .withColumn("place", F.row_number().over(copies)).where(F.col("place") <= k + 1)
        .groupBy("key").agg(F.first("size").alias("size"), F.first("vector").alias("vector"),
                            F.sort_array(F.collect_list("id")).alias("ids")))
    wanted = written(usable.join(asked, "id", "left_semi").select("id", "key").distinct())
    points = written(distinct.join(wanted.select("key").distinct(), "key", "left_semi")
                     .select("key", "size", "vector"))
    found = None
    for row in distinct.groupBy("size").count().orderBy("size").collect():
        same = F.col("size") == row.size
        part = _search(distinct.where(same), points.where(same).drop("size"), row["size"], k,
                       recall, min_candidates, kind)
        found = part if found is None else found.unionByName(part)
    schema = f"query_id bigint, rank int, {row_id} bigint, score double"
    if found is None:
        return rows.sparkSession.createDataFrame([], schema)
    order = Window.partitionBy("query").orderBy("distance", F.col("ids")[0])
    lists = written(
        found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
        .groupBy("query").agg(F.sort_array(F.flatten(F.collect_list(F.transform(
            "ids", lambda i: F.struct(F.col("distance").alias("score"), i.alias("id"))))))
            .alias("nearest")))
    others = F.slice(F.filter("nearest", lambda n: n["id"] != F.col("query_id")), 1, k)
    return (wanted.select(F.col("id").alias("query_id"), "key")
            .join(lists, F.col("key") == F.col("query"))
            .select("query_id", F.posexplode(others).alias("place", "found"))
            .select("query_id", (F.col("place") + 1).cast("int").alias("rank"),
                    F.col("found.id").alias(row_id), F.col("found.score").alias("score")))
