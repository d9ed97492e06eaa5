"""SimHash fingerprints, and near-duplicates by anchor points of a covering code.

Two 64-bit fingerprints that differ in at most 3 bits differ in at most 1 bit of one of their
32-bit halves. On a half the anchors are the words of a covering code: the Hamming code on 31 bits,
any value in the other. Its covering radius is 1, so every half has a home anchor at distance 0 or
1. A fingerprint is replicated to all anchors within covering radius plus threshold, 1 + 1 = 2,
of each half: 34 rows at most. If two halves differ in at most one bit, the home anchor of one is
within 2 of the other, so every linked pair meets at an anchor, where the full 64 bits are
compared.

Only distinct fingerprints are compared. At an anchor a spanning forest of the links is emitted
instead of all pairs: as many edges as it has fingerprints at most, with the same components.
Anchors with many rows are cut into parts, each with all the home rows.

Texts: NULL and texts without words have fingerprint zero; fewer words than a shingle has count as
one shingle. Rows may repeat; each gets its own result. A component without any doc_id has NULL.
"""

from __future__ import annotations

from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.batches import arrow_schema, group_bounds, map_groups, map_texts
from tradewind.llm.components import connected_components
from tradewind.operators.lineage import written

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
# Rows of an anchor that are compared in one go; more are cut into parts.
ROWS_PER_PART = 20_000
_ROWS_AT_ONCE = 65_536
_HAMMING_BITS = 31
_HALF = (1 << 32) - 1


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles, count = iter([b" ".join(words)]), 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
        count = len(words) - shingle_words + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(HASH_SEED)), "<u8", count)
    ones = np.zeros(64, np.int64)
    for start in range(0, count, _ROWS_AT_ONCE):
        part = hashes[start:start + _ROWS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(rows: DataFrame, text: str = "text", row_id: str = "doc_id",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(row_id, bits): the fingerprint of each row as a signed bigint."""
    def kernel(texts, kept):
        found = np.array([fingerprint(value, shingle_words) for value in texts], np.uint64)
        return kept | {"bits": found.view(np.int64)}

    kind = dict(rows.dtypes)[row_id]
    return map_texts(rows, text, [F.col(row_id).alias("row_id")], kernel,
                     f"row_id {kind}, bits bigint").withColumnRenamed("row_id", row_id)


def _syndrome(half: Column) -> Column:
    """0 for a code word, else the number (from 1) of the bit to flip to get one."""
    masks = [sum(1 << (bit - 1) for bit in range(1, _HAMMING_BITS + 1) if bit >> k & 1)
             for k in range(5)]
    return reduce(Column.bitwiseOR, (
        F.shiftleft(F.bit_count(half.bitwiseAND(F.lit(mask))) % 2, k)
        for k, mask in enumerate(masks)))


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), number - 1)


def anchors(half: Column) -> tuple[Column, Column]:
    """(home anchor, all anchors within distance 2) of a 32-bit half, as bigints."""
    wrong = _syndrome(half)
    home = F.when(wrong == 0, half).otherwise(half.bitwiseXOR(_bit(F.greatest(wrong, F.lit(1)))))
    other = home.bitwiseXOR(F.lit(1 << 31))
    # Two flips lead to a code word if the numbers of their bits XOR to the syndrome.
    pairs = F.filter(F.sequence(F.lit(1), F.lit(_HAMMING_BITS)),
                     lambda bit: (bit < bit.bitwiseXOR(wrong)) & (wrong != 0))
    twice = F.transform(pairs, lambda bit: half.bitwiseXOR(_bit(bit)).bitwiseXOR(
        _bit(bit.bitwiseXOR(wrong))))
    return home, F.concat(F.array(home, other), twice)


def _replicas(distinct: DataFrame) -> DataFrame:
    """(anchor, bits, home): a row per fingerprint and anchor; bit 32 of the anchor is the half."""
    low = F.col("bits").bitwiseAND(F.lit(_HALF))
    high = F.shiftrightunsigned("bits", 32)
    halves = distinct.select("bits", F.explode(F.array(
        F.struct(F.lit(0).cast("bigint").alias("side"), low.alias("half")),
        F.struct(F.lit(1 << 32).alias("side"), high.alias("half")))).alias("h")
    ).select("bits", "h.side", "h.half")
    home, near = anchors(F.col("half"))
    return (halves.select("bits", "side", home.alias("_home"), F.explode(near).alias("near"))
            .select((F.col("near") + F.col("side")).alias("anchor"), "bits",
                    (F.col("near") == F.col("_home")).alias("home")))


def spanning_forest(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges between distinct unsigned values that connect what links at ``max_bits`` connect."""
    edges, rest = [], values
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            value = frontier.pop()
            near = np.bitwise_count(rest ^ value) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                edges += [(value, other) for other in found]
                frontier.extend(found)
    return edges


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): edges between the fingerprints ``bits`` (distinct, not NULL), whose components are
    those of all links at ``max_bits`` or fewer differing bits, 3 at most."""
    if not 0 <= max_bits <= 3:
        raise ValueError("halves that differ in one bit at most cover up to 3 bits")
    rows = _replicas(distinct)
    large = (rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("rows"))
             .where(F.col("rows") > ROWS_PER_PART)
             .select(F.col("anchor").alias("_anchor"),
                     F.ceil(F.col("rows") / ROWS_PER_PART).alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    spread = rows.join(large, F.col("anchor") == F.col("_anchor"), "left").select(
        "anchor", "bits", "home",
        F.explode(F.when(F.col("home"), F.sequence(F.lit(0).cast("bigint"), parts - 1))
                  .otherwise(F.array(F.pmod(F.xxhash64("bits"), parts)))).alias("part"))
    keyed = spread.select(  # the anchor has 33 bits
        F.call_function("shiftleft", F.col("part"), F.lit(33)).bitwiseOR(F.col("anchor"))
        .alias("key"), "bits", "home")
    schema = "a bigint, b bigint"
    target = arrow_schema(schema)

    def compare(table: pa.Table) -> pa.Table | None:
        keys = table.column("key").to_numpy()
        starts, ends = group_bounds(keys)
        useful = np.flatnonzero(ends - starts > 1)
        if not len(useful):
            return None
        homes = np.r_[0, np.cumsum(table.column("home").to_numpy(zero_copy_only=False))]
        bits = table.column("bits").to_numpy().view(np.uint64)
        edges = []
        for start, end in zip(starts[useful].tolist(), ends[useful].tolist(), strict=True):
            if homes[end] > homes[start]:
                edges += spanning_forest(bits[start:end], max_bits)
        found = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": found[:, 0], "b": found[:, 1]}, schema=target)

    return map_groups(keyed, "key", compare, schema)


def near_duplicates(rows: DataFrame, text: str = "text", row_id: str = "doc_id",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(row_id, bits, component_id), a row for each row.

    ``component_id`` is the smallest row_id that links of at most ``max_bits`` bits reach.
    """
    prints = written(fingerprints(rows, text, row_id, shingle_words))
    distinct = written(prints.groupBy("bits").agg(F.min(row_id).alias("_first")))
    groups = connected_components(links(distinct.select("bits"), max_bits), "a", "b")
    labelled = written(
        distinct.join(groups, F.col("bits") == F.col("node"), "left")
        .select(F.col("bits").alias("_bits"), "_first",
                F.coalesce("component", "bits").alias("_group")))
    smallest = labelled.groupBy("_group").agg(F.min("_first").alias("component_id"))
    members = written(labelled.drop("_first").join(smallest, "_group")
                      .select("_bits", "component_id"))
    return (prints.join(members, F.col("bits") == F.col("_bits"))
            .select(row_id, "bits", "component_id"))
