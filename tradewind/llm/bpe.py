"""Byte-level BPE encoding and decoding.

Encoding looks a pre-token up in two tiers. A minimal perfect hash over the vocabulary resolves
the pre-tokens that are tokens as they stand: one array of token bytes and one of ranks, without
empty slots. The others are merged by a heap over a linked list of their bytes, lowest rank
first, leftmost first among equals.

Without a text (NULL) a document has no tokens. Long pre-tokens take n log n steps.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
from collections.abc import Callable

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.batches import importable, map_texts
from tradewind.llm.chunks import ChunkEncoder, Memo
from tradewind.llm.vocabulary import BYTE_BPE_RANKS, SPLIT_PATTERN, parse_ranks, read_file


class MinimalPerfectHash:
    """Maps n distinct byte strings onto 0..n-1.

    Each level gives every key left a slot out of twice as many; keys alone in their slot stay
    there, the others go to the next level. A key's number is the count of taken slots before its
    own. A string that is not a key gets any number or -1, so callers compare the key.
    """

    SLOTS_PER_KEY = 2

    def __init__(self, keys: list[bytes]):
        left = self.hashes(keys)
        if len(np.unique(left)) != len(left):
            raise ValueError("keys are repeated, or two share a 64-bit hash")
        self._levels: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        taken = 0
        while len(left):
            size = np.uint64(max(2, self.SLOTS_PER_KEY * len(left)))
            slots = self._slots(left, len(self._levels), size)
            alone = np.bincount(slots, minlength=int(size)) == 1
            numbers = taken + np.cumsum(alone) - 1
            self._levels.append((size, alone, numbers))
            taken += int(alone.sum())
            left = left[~alone[slots]]

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    @staticmethod
    def _slots(hashes: np.ndarray, level: int, size: np.uint64) -> np.ndarray:
        """Another slot at each level, by a multiply-xor-shift mix of the hash."""
        mixed = hashes + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((mixed ^ (mixed >> np.uint64(31))) % size).astype(np.int64)

    def numbers(self, keys: list[bytes]) -> np.ndarray:
        hashes = self.hashes(keys)
        found = np.full(len(keys), -1, np.int64)
        for level, (size, alone, numbers) in enumerate(self._levels):
            open_ = np.flatnonzero(found < 0)
            if not len(open_):
                break
            slots = self._slots(hashes[open_], level, size)
            hit = alone[slots]
            found[open_[hit]] = numbers[slots[hit]]
        return found


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token, by merging the adjacent pair of lowest rank until none is left."""
    size, rank_of = len(word), ranks.get
    bits = size.bit_length()
    low = (1 << bits) - 1
    end = list(range(1, size + 1))  # where the part that starts here ends; 0: merged away
    before = list(range(-1, size - 1))  # start of the part before
    # A heap of rank, start and end of a pair in one integer each, so that equal ranks come by
    # start.
    heap = [((rank << bits | i) << bits) + i + 2 for i in range(size - 1)
            if (rank := rank_of(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        top = heapq.heappop(heap)
        start, stop = top >> bits & low, top & low
        middle = end[start]
        if not middle or middle >= stop or end[middle] != stop:
            continue  # one of the two parts has changed since
        end[start], end[middle] = stop, 0
        if stop < size:
            before[stop], after = start, end[stop]
            if (rank := rank_of(word[start:after])) is not None:
                heapq.heappush(heap, ((rank << bits | start) << bits) + after)
        left = before[start]
        if left >= 0 and (rank := rank_of(word[left:stop])) is not None:
            heapq.heappush(heap, ((rank << bits | left) << bits) + stop)
    ids, start = [], 0
    while start < size:
        stop = end[start]
        ids.append(ranks[word[start:stop]])
        start = stop
    return ids


class ByteBPE:
    """Encoder and decoder for a vocabulary of token bytes and ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = SPLIT_PATTERN):
        self._ranks = ranks
        self._split = regex.compile(pattern).findall
        tokens = list(ranks)
        self._hash = MinimalPerfectHash(tokens)
        order = np.argsort(self._hash.numbers(tokens))
        self._tokens = [tokens[i] for i in order]
        self._packed = [struct.pack("<I", ranks[token]) for token in self._tokens]
        self._bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self._bytes[rank] = token
        self._memo = Memo(self._look_up)
        self.encode = ChunkEncoder(self._encode_chunks)

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        return self._memo.joined([self._split(chunk) for chunk in chunks])

    def _look_up(self, words: list[str]) -> list[bytes]:
        """Packed ids of pre-tokens: the hash first, the heap for the rest."""
        words = [word.encode() for word in words]
        tokens, ranks, found = self._tokens, self._ranks, []
        for word, number in zip(words, self._hash.numbers(words).tolist(), strict=True):
            if number >= 0 and tokens[number] == word:
                found.append(self._packed[number])
            else:
                ids = merge(word, ranks)
                found.append(struct.pack(f"<{len(ids)}I", *ids))
        return found

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(packed, "<u4").tolist()))


_READY: dict[str, ByteBPE] = {}  # one per worker and vocabulary


def _ready(content: bytes, pattern: str) -> ByteBPE:
    key = hashlib.sha256(content + pattern.encode()).hexdigest()
    if key not in _READY:
        _READY.clear()
        _READY[key] = ByteBPE(parse_ranks(content), pattern)
    return _READY[key]


def _mapped(rows: DataFrame, text: str, row_id: str, ranks_path: str, pattern: str,
            outputs: str, make: Callable[[ByteBPE, list], dict[str, list]]) -> DataFrame:
    shipped = rows.sparkSession.sparkContext.broadcast(read_file(ranks_path))
    kind = dict(rows.dtypes)[row_id]

    def kernel(texts, kept):
        return kept | make(_ready(shipped.value, pattern), texts)

    return map_texts(rows, text, [F.col(row_id).alias("row_id")], kernel,
                     f"row_id {kind}, {outputs}").withColumnRenamed("row_id", row_id)


def encode(rows: DataFrame, text: str = "text", row_id: str = "doc_id",
           ranks_path: str = BYTE_BPE_RANKS, pattern: str = SPLIT_PATTERN) -> DataFrame:
    """(row_id, ids): ids as an array of bigint; empty for a NULL or empty text."""
    return _mapped(rows, text, row_id, ranks_path, pattern, "ids array<bigint>",
                   lambda bpe, texts: {"ids": [np.frombuffer(packed, "<u4").astype(np.int64)
                                               for packed in bpe.encode(texts)]})


def round_trip(rows: DataFrame, text: str = "text", row_id: str = "doc_id",
               ranks_path: str = BYTE_BPE_RANKS, pattern: str = SPLIT_PATTERN) -> DataFrame:
    """(row_id, n_tokens, ids_sha256, decoded_sha256) of encoding and then decoding.

    The ids are hashed as little-endian unsigned 32-bit integers.
    """
    def make(bpe: ByteBPE, texts: list) -> dict[str, list]:
        packed = bpe.encode(texts)
        return {"n_tokens": [len(ids) // 4 for ids in packed],
                "ids_sha256": [hashlib.sha256(ids).hexdigest() for ids in packed],
                "decoded_sha256": [hashlib.sha256(bpe.decode(ids)).hexdigest()
                                   for ids in packed]}
    return _mapped(rows, text, row_id, ranks_path, pattern,
                   "n_tokens bigint, ids_sha256 string, decoded_sha256 string", make)


def decode(rows: DataFrame, ids: str = "ids", row_id: str = "doc_id",
           ranks_path: str = BYTE_BPE_RANKS) -> DataFrame:
    """(row_id, decoded): the bytes that an array of ids stands for; empty for NULL."""
    shipped = rows.sparkSession.sparkContext.broadcast(read_file(ranks_path))
    importable(rows.sparkSession)

    @F.udf("binary")
    def decoded(values):
        tokens = _ready(shipped.value, SPLIT_PATTERN)
        return tokens.decode(np.array(values or [], "<u4").tobytes())

    return rows.select(row_id, decoded(F.col(ids)).alias("decoded"))
