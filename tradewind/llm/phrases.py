"""Collocations: frequent phrases of a few words, mined by sampling with a negative border.

Toivonen, "Sampling large databases for association rules", 1996, for contiguous phrases. A sample
of the documents proposes phrases, at a threshold lowered for chance. A full pass counts each
proposed phrase and the negative border: what is not proposed though both its longest parts are,
its words without the last and without the first. A phrase can't be more frequent than its parts, so
if no border phrase is frequent, all frequent ones were proposed. Another full pass counts what the
first has found frequent, of the border as well, and all that this opens: what the first did not
count though its parts are frequent or opened themselves, up to the longest phrases. That closes the
border: a frequent phrase has frequent parts, so it was counted in the first pass or is opened in the
second. Words are counted first, all of them, so the border of the words is known exactly.

Most of what the first pass counts is rare; it is counted by hashes, of six bits more than the
number of words has, where a collision can only make a phrase look frequent. The second pass counts
by texts, so every count that is used is exact. Tasks tell what is proposed or frequent by a bit
array of at most 2^MAX_BITS bits, the same size in all passes: a false positive is one more phrase
that is counted. What is broadcast has a fixed bound at any size. Hashes are summed in each task as
far as HELD_HASHES go, and travel in arrays by their upper bits with the lower bits as integers, so
that each takes few bytes. Sums are made over the shuffle; none is kept in one task.

NULL or empty texts have no words; a NULL language counts as ``und``. Repeated rows count each. If
nothing is frequent the result is empty.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.batches import group_bounds, join_small, map_texts
from tradewind.operators.lineage import written

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2_000
# One document in SAMPLE proposes.
SAMPLE = 16
MIN_BITS, MAX_BITS = 16, 28
# Hashes that a task holds before it passes their counts on.
HELD_HASHES = 1 << 20
# Upper bits of a hash that it is dealt by, if the lower ones fit an integer.
BUCKET_BITS = 14
UNKNOWN = "und"

_BREAKS, _BLANK = b".,;:!?\n\x0b\x0c\r", b"\t"
_PLAIN = bytes(10 if byte in _BREAKS else 32 if byte in _BLANK
               else byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Words:
    """The words of the texts of one language: ``known`` distinct ones, ``ids`` of all in order, and
    ``joined[i]`` if word i + 1 follows in the same piece."""

    def __init__(self, texts: list[str], lang: str):
        data = "\n".join(texts).encode("utf-8", "surrogatepass").translate(_PLAIN)
        coded = pa.array(data.split(), pa.binary()).dictionary_encode()
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.known: list[bytes] = coded.dictionary.to_pylist()
        codes = np.frombuffer(data, np.uint8)
        inside = (codes != 32) & (codes != 10)
        starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
        piece = np.cumsum(codes == 10)[starts]
        self.joined = piece[1:] == piece[:-1]
        seed = xxhash.xxh64_intdigest(lang)
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(word, seed) for word in self.known),
                                  np.uint64, len(self.known))

    def text(self, place: int, words: int) -> str:
        return b" ".join([self.known[i] for i in self.ids[place:place + words]]).decode(
            "utf-8", "replace")

    def counted(self, places: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """(first place, number) of each distinct phrase of ``words`` words at the places."""
        phrase = self.ids[places]
        for step in range(1, words):
            phrase = np.unique(phrase * len(self.known) + self.ids[places + step],
                               return_inverse=True)[1]
        _, first, number = np.unique(phrase, return_index=True, return_counts=True)
        return places[first], number


def _by_language(texts: list[str | None], langs: list[str]) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for text, lang in zip(texts, langs, strict=True):
        if text:
            found.setdefault(lang, []).append(text)
    return found


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1) == 1


def _longer(hashes: np.ndarray, added: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word, whose own hash is ``added``."""
    mixed = hashes * _ODD + added
    mixed ^= mixed >> np.uint64(32)
    mixed *= _MIX
    return mixed ^ (mixed >> np.uint64(32))


class Level:
    """Phrases of one length by their first word: hash, and whether they are proposed and fit
    together with what was proposed, now and in the pass before."""

    def __init__(self, hashes: np.ndarray, now: np.ndarray, before: np.ndarray):
        self.hashes, self.now, self.before = hashes, now, before


def _phrases(words: Words, now: np.ndarray, before: np.ndarray | None, max_words: int,
             close: bool, proposed: Callable[[np.ndarray, np.ndarray, int], None],
             border: Callable[[np.ndarray], None]) -> None:
    """Call ``proposed(places, hashes, words)`` for all occurrences that are proposed, and
    ``border(hashes)`` for those of the border that did not count in the pass before. ``close``
    takes what did not count as proposed."""
    single = words.hashes[words.ids]
    none = np.zeros(len(single), bool)
    level = Level(single, _has(now, words.hashes)[words.ids],
                  none if before is None else _has(before, words.hashes)[words.ids])
    joined = words.joined
    for length in range(2, max_words + 1):
        if length > 2:
            joined = joined[:-1] & words.joined[length - 2:]
        places = np.flatnonzero(joined & level.now[:-1] & level.now[1:])
        if not len(places):
            return
        counted = level.before[places] & level.before[places + 1]
        hashes = _longer(level.hashes[places], single[places + length - 1])
        is_now = _has(now, hashes) | ~counted if close else _has(now, hashes)
        was = counted & _has(before, hashes) if before is not None else counted
        if is_now.any():
            proposed(places[is_now], hashes[is_now], length)
        if (beyond := ~is_now & ~counted).any():
            border(hashes[beyond])
        following = Level(np.zeros(len(joined), np.uint64), np.zeros(len(joined), bool),
                          np.zeros(len(joined), bool))
        following.hashes[places] = hashes
        following.now[places] = is_now
        following.before[places] = was
        level = following


def _language(phrase: str = "phrase") -> Column:
    """The part of lang, tab and words before the last tab; words hold none."""
    return F.expr(f"left({phrase}, char_length({phrase}) "
                  f"- char_length(substring_index({phrase}, '\t', -1)) - 1)")


def _word_counts(docs: DataFrame, text: str, lang: Column, min_count: int) -> DataFrame:
    """(lang, phrase, n): the words with ``min_count`` occurrences, and for each language the sum
    of the others, with a NULL phrase. ``phrase`` is the language, a tab and the word."""
    def count(texts: list, kept: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"phrase": [], "n": []}
        for name, own in _by_language(texts, kept["lang"]).items():
            words = Words(own, name)
            out["phrase"] += [f"{name}\t{word.decode('utf-8', 'replace')}"
                              for word in words.known]
            out["n"] += np.bincount(words.ids, minlength=len(words.known)).tolist()
        return out

    counts = (map_texts(docs, text, [lang.alias("lang")], count, "phrase string, n bigint")
              .groupBy("phrase").agg(F.sum("n").alias("n")))
    return (counts.groupBy(_language().alias("lang"),
                           F.when(F.col("n") >= min_count, F.col("phrase")).alias("phrase"))
            .agg(F.sum("n").alias("n")))


def _hashed(words: DataFrame) -> DataFrame:
    """The hashes of words given as language, tab and word, as :class:`Words` has them."""
    def hashes(texts: list, kept: dict[str, list]) -> dict[str, list]:
        cut = [text.rpartition("\t") for text in texts]
        found = [xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"),
                                        xxhash.xxh64_intdigest(name)) for name, _, word in cut]
        return {"hash": np.array(found, np.uint64).view(np.int64)}

    return map_texts(words, "phrase", [], hashes, "hash bigint")


class Hashes:
    """Counts of a task's hashes, passed on when there are many."""

    def __init__(self, low_bits: int):
        self.low_bits = np.uint64(low_bits)
        self.known, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.found: list[np.ndarray] = []

    def _sum(self) -> None:
        found, number = np.unique(np.concatenate([*self.found, np.zeros(0, np.uint64)]),
                                  return_counts=True)
        both = np.concatenate([self.known, found])
        order = np.argsort(both, kind="stable")  # two sorted runs
        starts, _ = group_bounds(both[order])
        self.known, self.found = both[order[starts]], []
        if len(starts):
            self.numbers = np.add.reduceat(np.concatenate([self.numbers, number])[order], starts)

    def full(self) -> bool:
        if 2 * sum(map(len, self.found)) > HELD_HASHES:
            self._sum()
        return len(self.known) > HELD_HASHES

    def taken(self) -> dict[str, pa.Array]:
        """A row for each bucket of the hashes so far: their lower bits and their numbers."""
        self._sum()
        buckets = (self.known >> self.low_bits).astype(np.int32)
        lows = self.known & ((np.uint64(1) << self.low_bits) - np.uint64(1))
        starts, _ = group_bounds(buckets)
        offsets = pa.array(np.r_[starts, len(buckets)], pa.int32())
        rows = {"bucket": pa.array(buckets[starts], pa.int32()),
                "lows": pa.ListArray.from_arrays(offsets, pa.array(
                    lows.astype(np.uint32).view(np.int32))),
                "numbers": pa.ListArray.from_arrays(offsets, pa.array(self.numbers))}
        self.known, self.numbers = self.known[:0], self.numbers[:0]
        return rows


def _hash_counts(docs: DataFrame, text: str, lang: Column, now: Broadcast,
                 before: Broadcast | None, max_words: int, hash_bits: int,
                 proposed_too: bool) -> DataFrame:
    """(hash, n) of the border and, if asked, of what is proposed."""
    kept_bits = np.uint64(2 ** hash_bits - 1)
    low_bits = min(32, hash_bits - BUCKET_BITS)
    held = Hashes(low_bits)

    def count(texts: list, kept: dict[str, list]) -> dict[str, list]:
        def take(hashes: np.ndarray) -> None:
            held.found.append(hashes & kept_bits)

        for name, own in _by_language(texts, kept["lang"]).items():
            words = Words(own, name)
            if len(words.ids):
                _phrases(words, now.value, None if before is None else before.value, max_words,
                         False, lambda _, hashes, __: take(hashes) if proposed_too else None, take)
        return held.taken() if held.full() else {"bucket": [], "lows": [], "numbers": []}

    # Dealt by bucket, the hashes are summed without another shuffle.
    dealt = map_texts(docs, text, [lang.alias("lang")], count,
                      "bucket int, lows array<int>, numbers array<bigint>",
                      rest=held.taken).repartition("bucket")
    low = F.col("low").cast("bigint").bitwiseAND(F.lit(2 ** 32 - 1))
    return (dealt.select("bucket", "numbers", F.posexplode("lows").alias("at", "low"))
            .groupBy("bucket", "low").agg(F.sum(F.col("numbers")[F.col("at")]).alias("n"))
            .select(F.shiftleft(F.col("bucket").cast("bigint"), low_bits).bitwiseOR(low)
                    .alias("hash"), "n"))


def _counted(docs: DataFrame, text: str, lang: Column, now: Broadcast, before: Broadcast | None,
             max_words: int, hash_bits: int, texts_too: bool,
             close: bool = False) -> DataFrame:
    """(phrase, hash, n): the border by its hashes. ``texts_too`` counts what is proposed as well,
    by its hashes; with ``close``, which leaves no border, by its texts."""
    if not close:
        return _hash_counts(docs, text, lang, now, before, max_words, hash_bits,
                            texts_too).select(F.lit(None).cast("string").alias("phrase"), "*")

    def count(texts: list, kept: dict[str, list]) -> dict[str, list]:
        phrases: list[str] = []
        numbers: list[np.ndarray] = [np.zeros(0, np.int64)]
        for name, own in _by_language(texts, kept["lang"]).items():
            words = Words(own, name)

            def proposed(places: np.ndarray, _, length: int, words=words, name=name) -> None:
                first, number = words.counted(places, length)
                phrases.extend([f"{name}\t{words.text(place, length)}"
                                for place in first.tolist()])
                numbers.append(number)

            if len(words.ids):
                _phrases(words, now.value, None if before is None else before.value, max_words,
                         True, proposed, lambda _: None)
        return {"phrase": phrases, "n": np.concatenate(numbers)}

    return (map_texts(docs, text, [lang.alias("lang")], count, "phrase string, n bigint")
            .groupBy("phrase").agg(F.sum("n").alias("n"))
            .select("phrase", F.lit(None).cast("bigint").alias("hash"), "n"))


def _bits(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit array with the hashes' bits set; 2^bits / 8 bytes reach the driver at most."""
    place = F.expr(f"hash & {2 ** bits - 1}L")
    rows = (hashes.select(F.shiftright(place, 15).alias("bucket"),
                          (place % 32768).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map")).collect())
    found = np.zeros(max(4096, 2 ** bits // 8), np.uint8)
    for row in rows:
        found[row.bucket * 4096:(row.bucket + 1) * 4096] = np.frombuffer(row["map"], np.uint8)
    return found


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang",
                     row_id: str = "doc_id", min_count: int = MIN_COUNT,
                     max_words: int = MAX_WORDS, sample: int = SAMPLE) -> tuple[
                         DataFrame, DataFrame]:
    """((lang, words), (lang, phrase, f)): all words of each language, and exactly the phrases of
    at most ``max_words`` words, single words included, that occur ``min_count`` times or more.
    """
    share = docs.sparkSession.sparkContext.broadcast
    of_doc = F.coalesce(F.col(lang), F.lit(UNKNOWN))
    words = written(_word_counts(docs, text, of_doc, min_count))
    totals = words.groupBy("lang").agg(F.sum("n").alias("words"))
    total = max(1, words.agg(F.sum("n")).first()[0] or 0)
    # Some 16 bits for each proposed phrase, if there is one to a hundred words.
    bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(0.16 * total))))
    hash_bits = min(63, max(32, math.ceil(math.log2(total)) + 6))
    singles = words.where("phrase IS NOT NULL")
    now = single = _bits(_hashed(singles), bits)

    # The sample: level by level, by hashes alone.
    expected = min_count / sample
    least = max(2, math.floor(expected - 1.5 * math.sqrt(expected)))
    chosen = written(docs.where(F.pmod(F.xxhash64(row_id), F.lit(sample)) == 0)
                     .select(F.col(text), of_doc.alias("lang")))
    sent, sent_before = share(now), None
    for _ in range(max_words - 1):
        found = _counted(chosen, text, F.col("lang"), sent, sent_before, max_words, hash_bits,
                         texts_too=False)
        now = now | _bits(found.where((F.col("n") >= least) & F.col("hash").isNotNull()), bits)
        if sent_before is not None:
            sent_before.destroy()  # what has used it is done
        sent, sent_before = share(now), sent

    found = written(_counted(docs, text, of_doc, sent, None, max_words, hash_bits,
                             texts_too=True).where(F.col("n") >= min_count))
    counted = [singles.select("phrase", "n")]
    if not found.isEmpty():
        whole = _counted(docs, text, of_doc, share(single | _bits(found, bits)), sent, max_words,
                         hash_bits, texts_too=True, close=True)
        counted.append(whole.where(F.col("n") >= min_count).select("phrase", "n"))
    frequent = reduce(DataFrame.unionByName, counted).where("phrase IS NOT NULL")
    return totals, frequent.select(
        _language().alias("lang"), F.substring_index("phrase", "\t", -1).alias("phrase"),
        F.col("n").alias("f"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang",
                 row_id: str = "doc_id", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                 top: int = TOP, sample: int = SAMPLE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases.

    ``a`` counts the phrase, ``n`` the language's words; cut in two, its parts have the counts
    ``l`` and ``r``, and ``score`` is floor(1000 a n / (l r)) at the cut that scores lowest, the
    first of equals. A phrase goes if a longer frequent one that holds it occurs as often: then
    one with a single word more does so too.
    """
    totals, frequent = frequent_phrases(docs, text, lang, row_id, min_count, max_words, sample)
    totals, frequent = written(totals), written(frequent)
    words = F.split("phrase", " ")
    candidates = written(frequent.select("lang", "phrase", F.col("f").alias("a"),
                                         words.alias("words")).where(F.size("words") > 1))

    def part(start, length) -> Column:
        return F.array_join(F.slice("words", start, length), " ")

    size = F.size("words")
    held = (candidates.where(size > 2).select("lang", "a", F.explode(F.array(
        part(1, size - 1), part(2, size - 1))).alias("inner"))
        .groupBy(F.col("lang").alias("_lang"), "inner").agg(F.max("a").alias("_most")))
    alone = written(candidates.join(
        held, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("inner")), "left")
        .where("_most IS NULL OR _most < a").select("lang", "phrase", "a", "words"))

    cuts = alone.select("lang", "phrase", "a", F.explode(F.transform(
        F.sequence(F.lit(1), size - 1), lambda cut: F.struct(
            cut.alias("cut"), part(1, cut).alias("left"), part(cut + 1, size).alias("right"))))
        .alias("at")).select("lang", "phrase", "a", "at.*")
    first = frequent.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    second = frequent.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    both = join_small(cuts.join(first, ["lang", "left"]).join(second, ["lang", "right"]),
                      totals.select(F.col("lang").alias("_lang"), F.col("words").alias("n")),
                      F.col("lang") == F.col("_lang"))
    exact = {name: f"CAST({name} AS DECIMAL(19, 0))" for name in ("a", "l", "r", "n")}
    score = F.expr(f"CAST(1000 AS DECIMAL(4, 0)) * ({exact['a']} * {exact['n']}) "
                   f"div ({exact['l']} * {exact['r']})")
    scored = both.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct(score.alias("score"), F.col("cut"), F.col("l"), F.col("r"))).alias("best"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
            .withColumn("rank", F.row_number().over(order).cast("bigint"))
            .where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
