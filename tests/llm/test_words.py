"""Spelling variants and phrases against plain versions."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import combinations, pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tradewind.llm import phrases, spelling

DOCS = "doc_id bigint, text string, lang string"


def tuples(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


# --- spelling variants ----------------------------------------------------------------

def plain_words(docs, min_length=6, min_count=5):
    totals = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            value = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if value % 199 == 0:
                place = value % len(run)
                run = run[:place] + run[place + 1:]
            totals[run] += 1
    return {word: n for word, n in totals.items() if len(word) >= min_length and n >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts):
    near = {word: [] for word in counts}
    for a, b in combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[word] = best if best and counts[best] >= 5 * counts[word] else None
    out = []
    for word in counts:
        root = word
        while form[root]:
            root = form[root]
        out.append((word, form[word], root, counts[word], len(near[word]),
                    counts.get(form[word])))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def vocabulary():
    """Words of few letters, many near one another, some far more frequent than others."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(400)}
    words |= {"prefix" + "".join(rng.choice("ab") for _ in range(6)) for _ in range(60)}
    return {word: rng.choice([5, 6, 30, 200, 2000, 20_000]) for word in sorted(words)}


@pytest.mark.parametrize("pairs", [spelling.PAIRS, 50, 0])
def test_variants(spark, vocabulary, pairs):
    frame = spark.createDataFrame(list(vocabulary.items()), "word string, n bigint")
    found = tuples(spelling.group_variants(frame, pairs=pairs))
    assert found == plain_variants(vocabulary)
    assert any(row[2] not in (row[0], row[1]) for row in found)  # forms of forms


def test_every_pair_once(spark, vocabulary):
    frame = spark.createDataFrame(list(vocabulary.items()), "word string, n bigint")
    found = [tuple(row) for row in spelling.near_words(frame, pairs=50)
             .select("word", "near").collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in vocabulary for b in vocabulary if one_edit(a, b)}


@pytest.mark.parametrize("a, b", [
    ("abcdef", "xabcdef"), ("abcdef", "abcdefx"), ("abcdef", "abcxdef"), ("aaaaaa", "aaaaaaa"),
    ("abcdefg", "abcdefgg"), ("abcdef", "bbcdef"), ("abcdef", "abcdeé"), ("abcdef", "abcccdef"),
    ("abcdef", "bacdef"), ("ab", "abc"), ("ab", "b"), ("abc" * 4000, "abc" * 2000 + "x"
                                                       + "abc" * 2000)])
def test_edits(spark, a, b):
    frame = spark.createDataFrame([(a, 9), (b, 1)], "word string, n bigint").where(
        F.char_length("word") > 1)
    assert (spelling.near_words(frame).count() == 2) == (one_edit(a, b) and len(b) > 1)


def test_words_of_documents(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    docs = [tuple(row) for row in rows.collect()]
    docs += [(None, "Überall ÜBERALL überall " * 4 + "ĀnaïveĀ" * 7), (None, None),
             (7, ""), (7, ""), (8, "x" * 50_000 + " "), *[(9, "straßen")] * 6]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns(
        {"word": F.lit(1), "n": F.lit("x"), "id": F.lit(2), "form": F.lit(3)})
    found = {row.word: row.n for row in spelling.word_counts(frame).collect()}
    assert found == plain_words(docs)
    assert tuples(spelling.spelling_variants(frame)) == plain_variants(found)


def test_without_words(spark):
    empty = spark.createDataFrame([], DOCS)
    found = spelling.spelling_variants(empty)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found.count() == 0
    few = spark.createDataFrame([(1, "one two three", "en"), (2, None, None)], DOCS)
    assert spelling.spelling_variants(few).count() == 0


# --- phrases --------------------------------------------------------------------------

def plain_phrases(docs, min_count, max_words=5, top=2000):
    counts, totals = Counter(), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    frequent = {key: n for key, n in counts.items() if n >= min_count}
    found = {}
    for (lang, words), a in frequent.items():
        k = len(words)
        longer = [n for (other, more), n in frequent.items() if other == lang and len(more) > k
                  and any(more[i:i + k] == words for i in range(len(more) - k + 1))]
        if k < 2 or any(100 * n >= 100 * a for n in longer):
            continue
        n = totals[lang]
        score, _, left, right = min(
            (1000 * a * n // (counts[lang, words[:c]] * counts[lang, words[c:]]), c,
             counts[lang, words[:c]], counts[lang, words[c:]]) for c in range(1, k))
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right, n))
    return sorted(((lang, rank, text.decode(), -a, left, right, n, -score)
                   for lang, rows in found.items()
                   for rank, (score, a, text, left, right, n) in enumerate(
                       sorted(rows)[:top], 1)), key=str)


def prose(rng, size, words="the of a cat dog sat mat ran É.".split()):
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".", "\t", "\n"])
                    for _ in range(size))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    docs = [(i, prose(rng, 30), rng.choice(["en", "de", None])) for i in range(80)]
    docs += [(i, "new york city hall is BIG", "en") for i in range(100, 130)]
    return docs + [(200, None, "en"), (201, "", None), (202, " .\n ", "de"),
                   (203, "one two " * 4000, "fr"), (203, "one two " * 4000, "fr")]


@pytest.mark.parametrize("sample", [1, 4, 10 ** 9])
def test_collocations(spark, texts, sample):
    frame = spark.createDataFrame(texts, DOCS).withColumns(
        {"phrase": F.lit(1), "hash": F.lit(2), "n": F.lit(3), "words": F.lit(4), "f": F.lit(5)})
    found = tuples(phrases.collocations(frame, min_count=6, sample=sample))
    assert found == plain_phrases(texts, 6)
    assert {row[0] for row in found} == {"en", "de", "und", "fr"}


def test_collocations_keep_the_best(spark, texts):
    found = tuples(phrases.collocations(spark.createDataFrame(texts, DOCS), min_count=10, top=3))
    assert found == plain_phrases(texts, 10, top=3)


def test_border_failures_open_another_pass(spark, monkeypatch):
    """A phrase that the sample lacks is found, whole, by the pass that closes the border."""
    passes = []
    count = phrases._counted

    def counted(*args, **kwargs):
        passes.append(kwargs["texts_too"])
        return count(*args, **kwargs)

    monkeypatch.setattr(phrases, "_counted", counted)
    docs = [(i, "alpha beta gamma delta epsilon", "en") for i in range(40)]
    found = tuples(phrases.collocations(spark.createDataFrame(docs, DOCS), min_count=30,
                                        sample=10 ** 9))
    assert [row[2] for row in found] == ["alpha beta gamma delta epsilon"]
    assert sum(passes) == 2


def shuffled(plan):
    """Bytes that the exchanges of a plan that has run wrote."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return shuffled(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return shuffled(plan.plan())
    own = plan.metrics().get("shuffleBytesWritten")
    return ((own.get().value() if own.isDefined() else 0)
            + sum(shuffled(plan.children().apply(i)) for i in range(plan.children().size())))


def test_rare_hashes_are_shuffled_in_few_bytes(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(900)]
    docs = [(i, " ".join(rng.choices(words, k=2000)), "en") for i in range(400)]
    every = spark.sparkContext.broadcast(np.full(8192, 255, np.uint8))
    single = spark.sparkContext.broadcast(
        phrases._bits(phrases._hashed(spark.createDataFrame(
            [(f"en\t{word}",) for word in words], "phrase string")), 16))
    frame = spark.createDataFrame(docs, DOCS).coalesce(1)
    found = phrases._counted(frame, "text", F.col("lang"), single, None, 2, 40, texts_too=True)
    pairs = Counter()
    for _, text, _ in docs:
        pairs.update(pairwise(text.split()))
    rows = found.collect()
    assert sorted(row.n for row in rows) == sorted(pairs.values())
    assert shuffled(found._jdf.queryExecution().executedPlan()) < 8 * len(rows)
    whole = phrases._counted(frame, "text", F.col("lang"), every, single, 2, 40, texts_too=True,
                             close=True)
    assert {row.phrase: row.n for row in whole.collect()} == {
        f"en\t{a} {b}": n for (a, b), n in pairs.items()}


def test_hashes_held_back_are_passed_on_once():
    held = phrases.Hashes(18)
    rng = np.random.default_rng(1)
    expected, found = Counter(), Counter()
    taken = []
    for _ in range(5):
        own = rng.integers(0, 2 ** 32, 400_000, np.uint64)
        own[:100_000] &= np.uint64(15)
        expected.update(own.tolist())
        held.found.append(own)
        if held.full():
            taken.append(held.taken())
    taken.append(held.taken())
    for part in [*taken, held.taken()]:
        for bucket, lows, numbers in zip(*(part[name].to_pylist() for name in (
                "bucket", "lows", "numbers")), strict=True):
            for low, n in zip(lows, numbers, strict=True):
                found[(bucket << 18) | low] += n
    assert len(taken) > 1 and found == expected


def test_saturated_filter_changes_nothing(spark, texts, monkeypatch):
    monkeypatch.setattr(phrases, "MIN_BITS", 4)
    monkeypatch.setattr(phrases, "MAX_BITS", 4)
    bits = phrases._bits
    monkeypatch.setattr(phrases, "_bits", lambda found, n: np.full_like(bits(found, n), 255))
    found = tuples(phrases.collocations(spark.createDataFrame(texts, DOCS), min_count=12))
    assert found == plain_phrases(texts, 12)


def test_products_past_64_bits(spark, monkeypatch):
    big = 3_037_000_501_000
    totals = spark.createDataFrame([("en", 10 ** 14)], "lang string, words bigint")
    frequent = spark.createDataFrame(
        [("en", "a", big), ("en", "b", big - 7), ("en", "a b", big - 11)],
        "lang string, phrase string, f bigint")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *a, **k: (totals, frequent))
    row = phrases.collocations(spark.createDataFrame([], DOCS)).first()
    assert row.score == 1000 * (big - 11) * 10 ** 14 // (big * (big - 7))


def test_no_phrases(spark):
    for docs in ([], [(1, None, None)], [(None, "a b", "en")]):
        found = phrases.collocations(spark.createDataFrame(docs, DOCS))
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert found.count() == 0
