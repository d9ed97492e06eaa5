"""Encoding, decoding and packing against public libraries and plain rules."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import tiktoken
from tokenizers import Tokenizer

from conftest import SMALL
from tradewind.llm import bpe, chunks, packing, queries
from tradewind.llm.batches import map_texts
from tradewind.llm.vocabulary import (
    BYTE_BPE_JSON,
    BYTE_BPE_RANKS,
    SPLIT_PATTERN,
    parse_ranks,
    read_file,
)

ODD = [None, "", " ", "  ", "a  b", "a   b \n\n  c\t d", "foo.\n bar  ", "  lead", "-", "- -",
       "x\xa0 y z 　 z", "'s't  're", "<|endoftext|> hi", "hello <|endoftext|> world",
       "a  <|endoftext|>  b<|endoftext|>c <|endoftext|>", "x\n y\n\n z \n w \n", "t \t", "a \n b  ",
       "a\n  b", " a", "a\x1c b\x85 c\xa0 d", "a" * 5000, "ab" * 3000,
       "\x1c \x1d x \x85 ", "日本語 テスト 12３４½ \U0001f600 é", " \n", "\n ", "᠎ ​"]


@pytest.fixture(scope="module")
def ranks():
    return parse_ranks(read_file(BYTE_BPE_RANKS))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BYTE_BPE_JSON)


def every_character():
    characters = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    rng = random.Random(1)
    rng.shuffle(characters)
    return ["".join(rng.choice(" a1.\n") + c for c in characters[i:i + 5000])
            for i in range(0, len(characters), 5000)]


def test_encoder_equals_the_library(ranks, library):
    encoder = bpe.ByteBPE(ranks)
    texts = ODD + every_character()
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.array(library.encode_ordinary(text or ""), "<u4").tobytes() == ids
        assert encoder.decode(ids) == (text or "").encode()


def test_chunks_equal_the_library(tokenizer):
    encoder = packing._encoder(read_file(BYTE_BPE_JSON))
    texts = ODD + every_character()
    for text, ids in zip(texts, encoder(texts), strict=True):
        plain = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.array(plain, "<u4").tobytes() == ids


def test_parts_equal_the_library(tokenizer):
    marks = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'"
    rng = random.Random(3)
    ends = ["\n", "\n\n", "\n\n\n", " \n", "\n ", ",\nword", ".\n\nword", "!\n\n\n word"]
    texts = [f"{lead}word{end}" for lead in ("", " ", "\n", "\n\n", "\n \n", "\t")
             for end in ends]
    texts += ["x<|endoftext|>", "<|endoftext|>.\n<|endoftext|>", "a <|endoftext|>, b.",
              "a <|endoftext|, b.", "it's 'll'. don'. n't, 's.' x'.y", "x's,'t. 'S\n's",
              "12,3. 4', 5\n6!", "...\n...,x..", "\x1c, \x1c. a\x1c.\n\x1cb",
              "\u3000. a\u3000,\n\u3000", "e\u0301, \u0301. \u0e33."]
    texts += ["".join(rng.choice(["a", "é", "7", " ", " ", "\n", "\r", "\t", "\u2003", "'", "s",
                                  *rng.sample(marks, 3)]) for _ in range(rng.randint(1, 60)))
              for _ in range(3000)]
    # every character before a mark at the end of a word, and at the ends of lines
    characters = "".join(every_character())
    texts += [" ".join(c + "," for c in characters[i:i + 20_000])
              for i in range(0, len(characters), 20_000)]
    texts += ["\n".join("b" + c for c in characters[i:i + 20_000])
              for i in range(0, len(characters), 20_000)]
    found = packing._encoder(read_file(BYTE_BPE_JSON))(texts)
    for text, ids in zip(texts, found, strict=True):
        plain = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.array(plain, "<u4").tobytes() == ids, text[:80]


def test_words_are_encoded_once_whatever_marks_follow():
    asked = []

    def encode(parts):
        asked.extend(parts)
        return [part.encode().ljust(4 * len(part), b"_") for part in parts]
    encoder = chunks.PartEncoder(encode, whole=("<e>",))
    texts = ["word word, word. word!\nword: word.\nword?", None, "", "word, word\nword.\nword <e>"]
    encoder(texts)
    assert sorted(asked) == ["", "\n!", "\n,", "\n.", "\n:", "\n?", "\nword", " <e>", " word"]
    again = len(asked)
    assert encoder(texts) == encoder(texts) and len(asked) == again
    assert encoder([None, ""]) == [b"", b""] and encoder([]) == []


def test_perfect_hash_is_minimal():
    keys = [str(i).encode() for i in range(3000)]
    table = bpe.MinimalPerfectHash(keys)
    assert sorted(table.numbers(keys)) == list(range(3000))
    assert len(table.numbers([b"", b"x"])) == 2
    assert bpe.MinimalPerfectHash([]).numbers([b"a"]).tolist() == [-1]


def test_memo_drops_old_keys():
    asked = []

    def value(key):
        return key.encode().ljust(4 * (len(key) // 4 + 1))

    def compute(keys):
        asked.extend(keys)
        return [value(key) for key in keys]
    memo = chunks.Memo(compute, size=3)
    for i in range(40):
        found = memo.joined([["hot", f"k{i}", "long" * 50, "hot"], [], [f"k{i}"]])
        assert found == [value("hot") + value(f"k{i}") + value("long" * 50) + value("hot"), b"",
                         value(f"k{i}")]
        assert len(memo._young) <= 7
    assert asked.count("hot") == 1
    assert memo.joined([]) == [] and memo.joined([[], []]) == [b"", b""]


def test_encode_and_decode_frames(spark, library):
    rows = [(i, text) for i, text in enumerate(ODD)] + [(1, "a b"), (None, "a b")]
    frame = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 AS row_id")
    encoded = bpe.encode(frame)
    assert encoded.columns == ["doc_id", "ids"]
    for row, (doc, text) in zip(encoded.collect(), rows, strict=True):
        assert row.doc_id == doc and row.ids == library.encode_ordinary(text or "")
    decoded = [bytes(r.decoded) for r in bpe.decode(encoded).collect()]
    assert decoded == [(text or "").encode() for _, text in rows]
    assert bpe.round_trip(frame.limit(0)).count() == 0


def test_bpe_query(spark, library):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    expected = set()
    for row in documents:
        ids = library.encode_ordinary(row.text or "")
        expected.add((row.doc_id, len(ids),
                      hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                      hashlib.sha256((row.text or "").encode()).hexdigest()))
    found = queries.queries()["op7_bpe"](spark, SMALL).collect()
    assert {tuple(row) for row in found} == expected and len(found) == len(documents)


# --- packing ---------------------------------------------------------------------------

def check_packing(lengths, capacity):
    """Runs of a plan as sequences; every piece once, no gaps; returns the sequences."""
    counts = defaultdict(int)
    for length in lengths:
        counts[length] += 1
    sequences, ranks = defaultdict(list), defaultdict(list)
    for length, rank, number, first, offset in packing.plan(dict(counts), capacity):
        ranks[length] += range(rank, rank + number)
        for i in range(number):
            sequences[first + i].append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {
        k: list(range(v)) for k, v in counts.items()}
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
        assert sum(3 * length > capacity for _, length in places) <= 2
    return sequences


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(25))
def test_plan_is_whole_and_no_worse_than_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 60, 1024])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
    if seed % 3 == 0:
        lengths = [min(capacity, 1 + int(rng.expovariate(4 / capacity))) for _ in lengths]
    found = len(check_packing(lengths, capacity))
    assert found <= 1.02 * best_fit_decreasing(lengths, capacity) + 1
    assert found >= -(-sum(lengths) // capacity)


def test_plan_of_many_equal_pieces():
    assert len(check_packing([1] * 5000, 1024)) == 5
    assert len(check_packing([512] * 7, 1024)) == 4
    assert len(check_packing([342] * 4 + [341] * 2, 1024)) == 3  # 342 + 342 + 341 > 1024
    assert len(check_packing([342] * 4 + [340] * 2, 1024)) == 2
    runs = packing.plan({length: 10**12 for length in range(1, 1025)}, 1024)
    assert len(runs) < 100_000


def test_pack_frames(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_RANKING", 7)
    rng = random.Random(5)
    rows = [(i, rng.choice([3, 3, 3, 5, 9, 10])) for i in range(100)]
    rows += [(7, 3), (None, 3), (200, None), (201, 0), (202, 11)]
    frame = spark.createDataFrame(rows, "doc_id bigint, length bigint")
    found = packing.pack(frame, 10).collect()
    assert sorted(((r.doc_id, r.length) for r in found), key=str) == sorted(rows, key=str)
    places = defaultdict(list)
    for row in found:
        if row.doc_id in (200, 201, 202):
            assert row.sequence_id is None and row.offset is None
        else:
            places[row.sequence_id].append((row.offset, row.length))
    for sequence in places.values():
        ends = np.cumsum([length for _, length in sorted(sequence)])
        assert [o for o, _ in sorted(sequence)] == [0, *ends[:-1]] and ends[-1] <= 10
    assert packing.pack(frame.limit(0)).count() == 0


def test_pieces_of_odd_texts(spark, tokenizer):
    texts = [*ODD, "x " * 1023, "x " * 1022 + "x", "word " * 5000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = defaultdict(list)
    for row in packing.token_pieces(frame).collect():
        found[row.doc_id].append(row)
    for doc, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        start = 0
        pieces = sorted(found[doc], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // 1024)))
        for row in pieces:
            assert row.start == start
            part = ids[start:start + row.length]
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == row.ids_crc32
            start += row.length
            assert row.length == 1024 or row.piece == 0
        assert start == len(ids)


def test_packing_query(spark, tokenizer):
    found = queries.queries()["op8_packing"](spark, SMALL).collect()
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    lengths = defaultdict(int)
    for row in found:
        lengths[row.doc_id] += row.length
    encoded = tokenizer.encode_batch([row.text or "" for row in documents],
                                     add_special_tokens=False)
    assert lengths == {row.doc_id: len(e.ids) + 1
                       for row, e in zip(documents, encoded, strict=True)}
    sequences = {row.sequence_id for row in found}
    assert len(sequences) <= best_fit_decreasing([row.length for row in found], 1024)


def test_workers_drop_the_memo_with_the_step(spark):
    """Workers are used again by later steps, whose memory the memo of the packing step would take."""
    def encoders(texts, _):
        import gc

        from tradewind.llm.chunks import PartEncoder
        found = sum(isinstance(item, PartEncoder) for item in gc.get_objects())
        return {"found": [found] * len(texts)}

    rows = spark.range(64).selectExpr("id AS doc_id", "concat('word ', id) AS text").repartition(16)
    assert packing.token_pieces(rows).count() == 64
    held = map_texts(rows, "text", [], encoders, "found bigint")
    assert {row.found for row in held.collect()} == {0}
