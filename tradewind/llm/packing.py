"""Packing token pieces into sequences of bounded length.

Lengths are whole numbers up to the capacity, so the packing of any number of pieces is decided by
the count of pieces of each length. These counts (one per length, whatever the data) are planned
on the driver:

1. Large items. Of pieces above a third of the capacity at most two fit in a sequence. Longest
   first, each is paired with the longest other that still fits; for pairs this greedy matching
   uses the fewest sequences.
2. Smaller pieces, longest first, go to the sequences with the least room that is enough.

The plan says which ranks of a length go where; Spark ranks the pieces of each length and looks
their place up. No piece is dropped and nothing but the counts reaches the driver.

Rows with the same values are pieces of their own. A NULL text is an empty one, and a document
without tokens still has its end token. A length of NULL, below 1 or above the capacity has no
place: sequence and offset are NULL.
"""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradewind.llm.batches import arrow_schema, importable, kept_in_worker, map_texts
from tradewind.llm.chunks import PartEncoder
from tradewind.llm.vocabulary import BYTE_BPE_JSON, read_file
from tradewind.operators.lineage import written

CAPACITY = 1024
END_TOKEN = 2
BLANKS = "\u0120\u010a"  # how the vocabulary writes a space and a line feed
PARTS_AT_ONCE = 2_000  # an encoding holds far more than the ids
MEMO_KEYS = 400_000  # parts and their ids, some 80 MB per worker, up to twice over
# Pieces of one length are ranked in groups of about this size, each a window of its own.
ROWS_PER_RANKING = 200_000


def _encoder(content: bytes) -> PartEncoder:
    """Ids by the tokenizers library as it stands: strings of special tokens in a text are those
    tokens. They hold no white space, so that no cut at white space parts them."""
    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        tokenizer = Tokenizer.from_str(content.decode())
        vocabulary = tokenizer.get_vocab()
        opens = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that begin with a blank
        opens[[number for token, number in vocabulary.items() if token[0] in BLANKS]] = True

        def ids_of(texts: list[str]) -> list[list[int]]:
            return [encoding.ids for encoding in tokenizer.encode_batch_fast(
                texts, add_special_tokens=False)]

        def encode(parts: list[str]) -> list[bytes]:
            found = [b""] * len(parts)
            words, others = [], []
            for at, part in enumerate(parts):
                plain = part[:1] in (" ", "\n") and part.split() == [part[1:]]
                (words if plain else others).append(at)
            for start in range(0, len(others), PARTS_AT_ONCE):
                several = others[start:start + PARTS_AT_ONCE]
                for at, ids in zip(several, ids_of([parts[i] for i in several]), strict=True):
                    found[at] = struct.pack(f"<{len(ids)}I", *ids)
            # Words can be encoded as one text: each begins with the only tokens that open with
            # a space or a line feed.
            for start in range(0, len(words), PARTS_AT_ONCE):
                several = words[start:start + PARTS_AT_ONCE]
                ids = np.array(ids_of(["".join([parts[i] for i in several])])[0], "<u4")
                packed, bounds = ids.tobytes(), (4 * np.flatnonzero(opens[ids])).tolist()
                for at, first, last in zip(several, bounds, [*bounds[1:], len(packed)],
                                           strict=True):
                    found[at] = packed[first:last]
            return found

        special = tuple(token.content for token in tokenizer.get_added_tokens_decoder().values())
        return PartEncoder(encode, MEMO_KEYS, special)

    return kept_in_worker(hashlib.sha256(content).hexdigest(), make)


def token_pieces(rows: DataFrame, text: str = "text", row_id: str = "doc_id",
                 vocabulary: str = BYTE_BPE_JSON, capacity: int = CAPACITY,
                 end_token: int = END_TOKEN) -> DataFrame:
    """(row_id, piece, start, length, ids_crc32): each document's ids and end token, cut.

    Only a document above the capacity is cut, into pieces of exactly the capacity but for the
    first, which holds the remainder. ``start`` counts the document's ids before the piece, and
    the checksum is over its ids as little-endian unsigned 32-bit integers.
    """
    shipped = rows.sparkSession.sparkContext.broadcast(read_file(vocabulary))
    end = np.array([end_token], "<u4").tobytes()

    def kernel(texts, kept):
        out = defaultdict(list)
        for owner, packed in zip(kept["owner"], _encoder(shipped.value)(texts), strict=True):
            packed += end
            total = len(packed) // 4
            first = total % capacity or capacity
            for piece, stop in enumerate(range(first, total + 1, capacity)):
                start = max(0, stop - capacity) if piece else 0
                out["owner"].append(owner)
                out["piece"].append(piece)
                out["start"].append(start)
                out["length"].append(stop - start)
                out["ids_crc32"].append(zlib.crc32(packed[4 * start:4 * stop]))
        return out

    kind = dict(rows.dtypes)[row_id]
    return map_texts(rows, text, [F.col(row_id).alias("owner")], kernel,
                     f"owner {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
                     ).withColumnRenamed("owner", row_id)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number, first sequence, offset) of runs of pieces.

    ``number`` pieces of a length, from the first rank on, go to as many sequences, from the first
    sequence on, at the same offset. The work depends on the capacity, not on the counts.
    """
    left = {length: count for length, count in counts.items() if count}
    ranks: dict[int, int] = defaultdict(int)
    runs: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by free space: (first, number)
    free: list[int] = []  # the free spaces that some sequence has, ascending
    sequences = 0

    def put(length: int, number: int, first: int, offset: int) -> None:
        runs.append((length, ranks[length], number, first, offset))
        ranks[length] += number

    def leave(space: int, first: int, number: int) -> None:
        if space and number:
            if not room[space]:
                insort(free, space)
            room[space].append((first, number))

    def open_new(number: int) -> int:
        nonlocal sequences
        sequences += number
        return sequences - number

    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        length = large[-1]
        fits = bisect_left(large, capacity - length + 1) - 1
        partner = large[fits] if fits >= 0 else None
        count = left[length]
        if partner is None:
            number, used = count, length
        elif partner == length:
            number, used = (count // 2, 2 * length) if count > 1 else (1, length)
            if count == 1 and fits:
                partner = large[fits - 1]
                used += partner
            elif count == 1:
                partner = None
        else:
            number, used = min(count, left[partner]), length + partner
        first = open_new(number)
        put(length, number, first, 0)
        left[length] -= number
        if partner is not None:
            put(partner, number, first, length)
            left[partner] -= number
        leave(capacity - used, first, number)
        for gone in {length, partner} - {None}:
            if not left[gone]:
                large.remove(gone)

    for length in sorted((length for length in left if 3 * length <= capacity), reverse=True):
        count = left[length]
        while count:
            at = bisect_left(free, length)
            if at == len(free):
                number = -(-count // (capacity // length))
                leave(capacity, open_new(number), number)
                continue
            space = free[at]
            first, there = room[space].pop()
            if not room[space]:
                free.pop(at)
            number = min(count, there)
            put(length, number, first, capacity - space)
            leave(space - length, first, number)
            leave(space, first + number, there - number)
            count -= number
    return runs


def _ranked(pieces: DataFrame, counts: dict[int, int], order: list[str]) -> DataFrame:
    """With ``_rank``: 0, 1, ... among the pieces of a length.

    A length may hold most of the pieces, so ranks are counted within groups of a length and then
    moved by the sizes of the groups before.
    """
    groups = max(1, -(-max(counts.values(), default=0) // ROWS_PER_RANKING))
    grouped = pieces.withColumn("_group", F.pmod(F.xxhash64(*order), F.lit(groups)))
    sizes = grouped.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(
        Window.unboundedPreceding, -1)
    base = sizes.select(F.col("length").alias("_length"), F.col("_group").alias("_of"),
                        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("length", "_group").orderBy(*order)
    return (grouped.withColumn("_own", F.row_number().over(own) - 1)
            .join(base, (F.col("length") == F.col("_length")) & (F.col("_group") == F.col("_of")))
            .withColumn("_rank", F.col("_own") + F.col("_base"))
            .drop("_group", "_own", "_length", "_of", "_base"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The columns of ``pieces`` (among them ``length``), ``sequence_id`` and ``offset``; columns
    that have these two names already are replaced.

    Sequences hold at most ``capacity``, and their pieces follow one another without gaps.
    """
    pieces = pieces.drop("sequence_id", "offset", "_group", "_size", "_own", "_rank")
    pieces = written(pieces)  # tokenizing once: for the counts and for the places
    counts = {row.length: row.n for row in pieces.groupBy("length").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("length").between(1, capacity)).collect()}
    runs = sorted(plan(counts, capacity))
    table = np.array(runs, np.int64).reshape(-1, 5)
    starts = table[:, 0] * (1 << 50) + table[:, 1]  # ranks stay below 2^50
    placed = pieces.columns + ["sequence_id", "offset"]
    fits = F.col("length").between(1, capacity)
    ranked = _ranked(pieces.where(fits), counts, pieces.columns)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes)
    target = arrow_schema(f"{schema}, sequence_id bigint, offset bigint")

    importable(pieces.sparkSession)

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            run = np.searchsorted(starts, length * (1 << 50) + rank, side="right") - 1
            kept = batch.select(placed[:-2])
            kept = kept.append_column("sequence_id", _array(table[run, 3] + rank - table[run, 1]))
            yield kept.append_column("offset", _array(table[run, 4])).cast(target)

    unplaced = pieces.where(~F.coalesce(fits, F.lit(False))).select(
        "*", F.lit(None).cast("bigint").alias("sequence_id"),
        F.lit(None).cast("bigint").alias("offset"))
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint"
                             ).unionByName(unplaced)


def _array(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64())
