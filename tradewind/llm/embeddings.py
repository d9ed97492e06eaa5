"""Near-duplicate embeddings: sign hashing in several tables, exact cosines, components.

Each table hashes a vector to the signs of its products with random hyperplanes. Two vectors at
angle t agree on a sign with probability p = 1 - t / pi, so a table with k signs finds a pair with
probability p^k. k grows with the logarithm of the number of distinct vectors, which keeps the
expected bucket at VECTORS_PER_BUCKET, and the number of tables follows from k so that a pair at
the threshold is found with probability RECALL; closer pairs are found more often.

Pairs that share a bucket are compared by their exact cosine in double precision. A pair counts in
the first table in which it meets only, so numbers of links need no list of pairs. Exact copies are
compared once, as one vector with a number of rows. A large bucket is cut into parts, and each pair
of parts is compared on its own, so a bucket of any size is compared whole, in bounded blocks. A
block emits a spanning forest of its links, not the pairs.

Vectors that are NULL, empty, zero, or hold a NULL or a component that isn't finite link with
nothing, not even with their copies; vectors of different dimensions don't link. Rows may repeat;
every row has its own result. A component without any vec_id has NULL.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.batches import arrow_schema, group_bounds, importable, map_groups
from tradewind.llm.components import connected_components
from tradewind.operators.lineage import written

MIN_COSINE = 0.95
RECALL = 0.999
VECTORS_PER_BUCKET = 32
# Vectors of a bucket that one block takes from each of its two parts.
ROWS_PER_PART = 1_000
SEED = 7
MAX_SIGNS = 30


def table_sizes(vectors: int, min_cosine: float = MIN_COSINE,
                recall: float = RECALL) -> tuple[int, int]:
    """(signs per table, tables) for a number of distinct vectors."""
    signs = min(MAX_SIGNS, max(6, math.ceil(math.log2(max(1, vectors) / VECTORS_PER_BUCKET))))
    agree = (1 - math.acos(min(1.0, min_cosine)) / math.pi) ** signs
    return signs, 1 if agree >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - agree))


def _distinct(rows: DataFrame, vector: str, row_id: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the key of their vector or NULL, a row per key: vector, rows, smallest id)."""
    single = dict(rows.dtypes)[vector] == "array<float>"  # stay half as large
    values = F.col(vector) if single else F.col(vector).cast("array<double>")
    usable = (F.size(values) > 0) & F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        values, lambda x: x != 0)
    # A cryptographic hash of the exact decimal form stands for the vector in shuffles; the sum
    # with 0 turns -0 into 0.
    zero = F.lit(0.0).cast("float" if single else "double")
    plain = F.transform(values, lambda x: x + zero)
    keyed = rows.select(F.col(row_id).alias("row_id"), plain.alias("vector"), F.when(
        F.coalesce(usable, F.lit(False)), F.sha2(plain.cast("string"), 256)).alias("key"))
    distinct = keyed.where("key IS NOT NULL").groupBy("key").agg(
        F.first("vector").alias("vector"), F.count(F.lit(1)).alias("rows"),
        F.min("row_id").alias("first_id"))
    return keyed.select("row_id", "key"), distinct


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that squares stay in range."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hashed(distinct: DataFrame, signs: int, tables: int) -> DataFrame:
    """(node, rows, the vector's components as bytes, hash per table) of each distinct vector."""
    schema = "node bigint, rows bigint, vector binary, hashes array<int>"
    target = arrow_schema(schema)
    weights = 1 << np.arange(signs, dtype=np.int64)
    importable(distinct.sparkSession)

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            column = batch.column("vector")
            sizes = np.diff(column.offsets.to_numpy())
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                x = np.asarray(part.column("vector").flatten()).reshape(-1, size)
                if size not in planes:
                    planes[size] = np.random.default_rng([SEED, size]).standard_normal(
                        (size, signs * tables))
                sides = (_unit(x) @ planes[size] > 0).reshape(-1, tables, signs)
                yield pa.RecordBatch.from_pydict(
                    {"node": part.column("node"), "rows": part.column("rows"),
                     "vector": [row.tobytes() for row in x],
                     "hashes": list((sides @ weights).astype(np.int32))}, schema=target)

    return distinct.select("node", "rows", "vector").mapInArrow(run, schema)


def _blocks(hashed: DataFrame, tables: int) -> DataFrame:
    """A row per vector, table and block that its part of the bucket is compared in."""
    in_tables = hashed.select(
        "*", F.posexplode("hashes").alias("table", "hash"),
        F.length("vector").alias("_bytes")).withColumn(
        "bucket", F.xxhash64("table", "hash", "_bytes")).drop("hash", "_bytes")
    counts = in_tables.groupBy("bucket").agg(F.count(F.lit(1)).alias("_rows"))
    parts = F.ceil(F.col("_rows") / ROWS_PER_PART)
    shared = counts.where("_rows > 1").select(
        F.col("bucket").alias("_bucket"), parts.alias("_parts"))
    return (in_tables.join(shared, F.col("bucket") == F.col("_bucket"))
            .withColumn("part", F.pmod(F.xxhash64("node"), F.col("_parts")))
            .withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                     F.col("_parts") - 1)))
            .select(F.xxhash64("bucket", F.least("part", "with"), F.greatest("part", "with"))
                    .alias("block"), "table", "part",
                    (F.col("part") == F.col("with")).alias("own"),
                    "node", "rows", "vector", "hashes"))


def _compared(blocks: DataFrame, min_cosine: float, kind: str) -> DataFrame:
    """(a, b, links): edges of spanning forests, and for each vector (b NULL) its number of rows
    linked in a block. ``kind`` is the numpy type of the components."""
    schema = "a bigint, b bigint, links bigint"
    target = arrow_schema(schema)

    def compare(table: pa.Table) -> pa.Table | None:
        starts, ends = group_bounds(table.column("block").to_numpy())
        node = table.column("node").to_numpy()
        rows = table.column("rows").to_numpy()
        part = table.column("part").to_numpy()
        level = table.column("table").to_numpy()
        own = table.column("own").to_numpy(zero_copy_only=False)
        hashes = table.column("hashes").combine_chunks()
        hashes = hashes.flatten().to_numpy().reshape(table.num_rows, -1)
        vectors = table.column("vector").to_pylist()
        sizes = np.array([len(vector) for vector in vectors])
        out: list[tuple[int, int | None, int]] = []
        for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
            # Hashes of buckets, blocks or of unequal dimensions may collide: what meets that way
            # is told apart by dimension, table and hash.
            for size in np.unique(sizes[start:end]) if end - start > 1 else ():
                at = start + np.flatnonzero(sizes[start:end] == size)
                x = _unit(np.frombuffer(b"".join([vectors[i] for i in at]), kind)
                          .reshape(len(at), -1))
                left, right = np.nonzero(np.triu(x @ x.T >= min_cosine, 1))
                left, right = at[left], at[right]
                new = (part[left] != part[right]) | (own[left] & own[right])
                new &= level[left] == level[right]
                left, right = left[new], right[new]
                met = (hashes[left] == hashes[right]).argmax(axis=1) == level[left]
                left, right = left[met], right[met]
                if not len(left):
                    continue
                weight = np.bincount(left - start, rows[right], end - start)
                weight += np.bincount(right - start, rows[left], end - start)
                out += [(int(node[start + i]), None, int(weight[i]))
                        for i in np.flatnonzero(weight)]
                out += _forest(node[left], node[right])
        if not out:
            return None
        a, b, links = zip(*out, strict=True)
        return pa.table({"a": a, "b": b, "links": links}, schema=target)

    return map_groups(blocks, "block", compare, schema)


def _forest(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int, int]]:
    """Edges that connect what all the edges connect, by union-find."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    kept = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        top, other = find(a), find(b)
        if top != other:
            root[max(top, other)] = min(top, other)
            kept.append((a, b, 0))
    return kept


def near_duplicates(rows: DataFrame, vector: str = "embedding", row_id: str = "vec_id",
                    min_cosine: float = MIN_COSINE, recall: float = RECALL) -> DataFrame:
    """(row_id, n_links, component_id, kept), a row for each row.

    ``n_links`` counts the other rows whose cosine is at least ``min_cosine``, among pairs found;
    ``component_id`` is the smallest row_id reachable by links and ``kept`` tells whether it is
    the row's own.
    """
    keyed, distinct = _distinct(rows, vector, row_id)
    keyed = written(keyed)
    distinct = written(distinct.withColumn("node", F.monotonically_increasing_id()))
    signs, tables = table_sizes(distinct.count(), min_cosine, recall)
    kind = "f4" if dict(distinct.dtypes)["vector"] == "array<float>" else "f8"
    hashed = written(_hashed(distinct, signs, tables))
    found = written(_compared(_blocks(hashed, tables), min_cosine, kind))
    groups = connected_components(found.where("b IS NOT NULL"), "a", "b")
    outside = (found.where("b IS NULL").groupBy("a")
               .agg(F.sum("links").alias("_outside")))
    labelled = written(
        distinct.drop("vector").join(outside, F.col("node") == F.col("a"), "left").drop("a")
        .join(groups.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
        .select("key", "first_id", F.coalesce("component", "node").alias("_group"),
                (F.col("rows") - 1 + F.coalesce("_outside", F.lit(0))).alias("n_links")))
    smallest = labelled.groupBy("_group").agg(F.min("first_id").alias("component_id"))
    members = written(labelled.join(smallest, "_group").select(
        F.col("key").alias("_key"), "n_links", "component_id"))
    alone = F.col("key").isNull()
    return (keyed.join(members, F.col("key") == F.col("_key"), "left")
            .select(F.col("row_id").alias(row_id),
                    F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("bigint")
                    .alias("n_links"),
                    F.when(alone, F.col("row_id")).otherwise(F.col("component_id"))
                    .alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(row_id) == F.col("component_id"), F.lit(False))))
