"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words one edit apart the shorter (either, if they are as long) gives two disjoint chunks, its
halves; the other gives its positional grams. One edit lies in one half only, so the other half is a
gram of the longer word, moved by at most one place: an insertion moves what stands behind it. The
first half is therefore looked for at its own place and the second at its place plus the difference
of the lengths, 0 or 1; other grams can't meet a chunk of a near word that these don't find. Words
meet in an equi-join on the length, the half and its text, and what is left of both, their rests, is
verified to be one edit apart.

Very common halves, such as endings, would compare many words with many. Where a half is shared by
more than ``pairs`` pairs, the same step is taken on the rests, which are one edit apart themselves:
one half of the rest must agree as well. It is repeated until a group is small or its rests have one
code point, where the alphabet bounds it. No word is left out.

Words come from maximal runs of letters, counted in each document before anything is shuffled. NULL
or empty texts have none; a NULL id counts as an empty one. Repeated rows count each. Without a word
that is frequent enough the result is empty.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.batches import map_texts
from tradewind.operators.lineage import written

MIN_LENGTH = 6
MIN_COUNT = 5
MIN_RATIO = 5
# Pairs of words that one group may compare before its key gets longer.
PAIRS = 1_000_000

# One run in 199 of a document loses a code point.
TYPO_RATE = 199

_LOWER = bytes(byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))


def _runs(text: str | None, min_length: int) -> Counter:
    """Occurrences of the lower-cased runs in Latin-1, where a byte is a code point; characters
    outside it are no letters here."""
    found = (text or "").encode("latin-1", "replace").translate(_LOWER)
    return Counter(re.findall(rb"[a-z\xc0-\xff]{%d,}" % min_length, found))


def _typed(document: str, run: bytes) -> bytes:
    """The run, or the run without one code point, as the document has it."""
    utf8 = run if run.isascii() else run.decode("latin-1").encode()
    value = zlib.crc32(utf8, zlib.crc32(f"{document}:".encode()))
    if value % TYPO_RATE:
        return run
    place = value % len(run)
    return run[:place] + run[place + 1:]


def word_counts(docs: DataFrame, text: str = "text", row_id: str = "doc_id",
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``min_length`` code points and ``min_count``
    occurrences in all texts."""
    def count(texts: list[str | None], kept: dict[str, list]) -> dict[str, list]:
        totals: Counter = Counter()
        for document, value in zip(kept["id"], texts, strict=True):
            start = zlib.crc32(f"{document}:".encode())
            for run, n in _runs(value, min_length).items():
                if run.isascii() and zlib.crc32(run, start) % TYPO_RATE:
                    totals[run] += n
                else:
                    totals[_typed(document, run)] += n
        words = [word for word in totals if len(word) >= min_length]
        return {"word": [word.decode("latin-1") for word in words],
                "n": [totals[word] for word in words]}

    identity = F.coalesce(F.col(row_id).cast("string"), F.lit("")).alias("id")
    return (map_texts(docs, text, [identity], count, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def _halves(rest: Column, length: Column, gram_length: Column | None = None) -> Column:
    """The two (mark, half, rest) of a string: as chunks, or as the grams of a string of
    ``gram_length`` code points that chunks of one with ``length`` may meet."""
    first = F.floor(length / 2).cast("int")
    own = length if gram_length is None else gram_length
    behind = own - (length - first)  # where the second half, or its gram, starts
    return F.array(
        F.struct(F.lit("<").alias("mark"), F.substr(rest, F.lit(1), first).alias("half"),
                 F.substr(rest, first + 1).alias("rest")),
        F.struct(F.lit(">").alias("mark"), F.substr(rest, behind + 1).alias("half"),
                 F.substr(rest, F.lit(1), behind).alias("rest")))


def _rest_length(mark: Column, length: Column) -> Column:
    """Code points that a chunk's string of ``length`` keeps besides the half."""
    first = F.floor(length / 2).cast("int")
    return F.when(mark == "<", length - first).otherwise(first)


def _keyed(rows: DataFrame, key: Column, role: Column) -> DataFrame:
    """Rows cut once more. ``length`` is that of the chunk's string, whichever side the row is."""
    cut = rows.withColumn("_half", F.explode(F.when(
        role == "chunk", _halves(F.col("rest"), F.col("length"))).otherwise(
        _halves(F.col("rest"), F.col("length"), F.char_length("rest")))))
    return cut.select(
        "word", "n", "role",
        F.concat(key, F.col("_half.mark"), F.col("_half.half")).alias("key"),
        F.col("_half.rest").alias("rest"),
        _rest_length(F.col("_half.mark"), F.col("length")).cast("int").alias("length"))


def _sides(words: DataFrame) -> DataFrame:
    """Every word as chunks of its own length, and as grams for words as long or one shorter."""
    length = F.char_length("word")
    roles = F.array(*(F.struct(F.lit(role).alias("role"), (length - less).alias("length"))
                      for role, less in (("chunk", 0), ("gram", 0), ("gram", 1))))
    rows = words.withColumn("_role", F.explode(roles)).select(
        "word", "n", F.col("_role.role").alias("role"), F.col("_role.length").alias("length"),
        F.col("word").alias("rest"))
    return _keyed(rows, F.col("length").cast("string"), F.col("role"))


def _narrowed(rows: DataFrame, pairs: int) -> DataFrame:
    """Rows whose groups make at most ``pairs`` pairs, or have rests of one code point."""
    small: list[DataFrame] = []
    while True:
        counts = rows.groupBy("key").agg(
            F.count_if(F.col("role") == "chunk").alias("chunks"),
            F.count_if(F.col("role") == "gram").alias("grams"),
            F.max("length").alias("longest"))
        large = written(counts.where(
            (F.col("chunks").cast("double") * F.col("grams") > pairs) & (F.col("longest") > 1))
            .select(F.col("key").alias("_key")))
        if large.isEmpty():
            small.append(rows)
            break
        on = F.col("key") == F.col("_key")
        small.append(rows.join(large, on, "left_anti"))
        rows = written(_keyed(rows.join(large, on, "left_semi"), F.col("key"), F.col("role")))
    together = small[0]
    for part in small[1:]:
        together = together.unionByName(part)
    return together


def near_words(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words exactly one edit apart, once.

    ``words`` are distinct, have at least two code points, and are read several times.
    """
    rows = _narrowed(written(_sides(words)), pairs)
    chunks = rows.where("role = 'chunk'").select(
        F.col("key").alias("_key"), F.col("word").alias("a"), F.col("n").alias("a_n"),
        F.col("rest").alias("a_rest"))
    grams = rows.where("role = 'gram'").select(
        "key", F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("rest").alias("b_rest"))
    # Words of one length meet as chunks and as grams of one another; one way is enough.
    once = (F.col("a") < F.col("b")) | (F.char_length("a_rest") < F.char_length("b_rest"))
    near = (F.col("a") != F.col("b")) & (F.levenshtein("a_rest", "b_rest", 1) >= 0)
    found = written(chunks.join(grams, (F.col("_key") == F.col("key")) & once & near)
                    .select("a", "a_n", "b", "b_n").distinct())
    names = ("word", "n", "near", "near_n")
    return found.toDF(*names).unionByName(
        found.select("b", "b_n", "a", "a_n").toDF(*names))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: each round doubles the steps taken along forms."""
    state = forms.select("word", F.col("form").alias("root"))
    while True:
        step = state.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        joined = written(state.join(step, F.col("root") == F.col("_word"), "left"))
        state = joined.select("word", F.coalesce("_root", "root").alias("root"))
        if joined.where("_root IS NOT NULL").isEmpty():
            return state


def group_variants(words: DataFrame, min_ratio: int = MIN_RATIO,
                   pairs: int = PAIRS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of the distinct (word, n).

    The form is the near word with the largest n, the first in code-point order among equals, if
    it is at least ``min_ratio`` (over 1) times as frequent; else NULL. Counts grow along forms,
    so they end, at the root; a word without a form is its own root.
    """
    words = written(words.select("word", "n"))
    near = near_words(words, pairs)
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near"))).alias("_best"))
    best = best.withColumnRenamed("word", "_word")
    strong = -F.col("_best.order") >= min_ratio * F.col("n")
    judged = written(words.join(best, F.col("word") == F.col("_word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(strong, F.col("_best.near")).alias("form"),
        F.when(strong, -F.col("_best.order")).alias("form_n")))
    roots = _roots(judged.where("form IS NOT NULL")).withColumnRenamed("word", "_word")
    return judged.join(roots, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """The groups of the frequent words of whole texts, see :func:`group_variants`."""
    return group_variants(word_counts(docs, text, row_id))
