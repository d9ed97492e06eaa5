"""Language identification by mixtures of languages.

Each language has a model of letter trigrams, hashed into BUCKETS counters. A document is taken as
words drawn from a mixture of languages: expectation-maximisation estimates its proportions from the
words' trigram likelihoods, and the set of languages is the one of highest likelihood after a
penalty per language (half its number of parameters times the logarithm of the words, as in the
Bayesian information criterion, times PENALTY). The set grows and shrinks by one language at a time
while that raises the penalised likelihood. The language of the document is the one with the
largest proportion in the chosen set.

Whether a text is in any known language, one more component tells: a background that holds every
bucket equally likely. ``known`` is the proportion of the words that the chosen mixture has when it
shares them with the background. It is a property of the text and the models; where there is little
training text the models come close to the background, but a word of theirs stays above it and one
of unseen trigrams below.

Every label is learned, from a sample of its documents by a hash of their id where there are 2 *
TRAINING_ROWS or more. A model has an entry per bucket seen, BUCKETS at most.
Only text and label of training rows are learned from; a prediction sees the text alone.

Text that is NULL or has no letter is ``und`` with score 0. Without training rows everything is.
"""

from __future__ import annotations

import math
from array import array
from collections import defaultdict
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.batches import map_texts

UNDETERMINED = "und"
BUCKETS = 1 << 16
TRAINING_ROWS = 10_000
SMOOTHING = 0.5
RISE = 0.01  # of a log-likelihood that a further step is worth
PENALTY = 2.0
KNOWN_STEPS = 50
WORD_LETTERS = 24  # longer runs of letters, as in scripts without spaces, count as several words
_CELLS = 1_000_000  # words times languages worked on at once
_DENSE_CELLS = 200 * BUCKETS  # up to which a worker holds all models as one table


@cache
def _letters() -> np.ndarray:
    return np.array([chr(point).isalpha() for point in range(0x110000)])


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the trigram around each letter, first letter of each word)."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    letter = _letters()[points]
    # runs of anything else become one boundary
    kept = letter | np.r_[False, letter[:-1]] if len(letter) else letter
    line = np.r_[0, np.where(letter, points, 0)[kept], 0].astype(np.uint64)
    at = np.flatnonzero(line)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = (line[at - 1] * np.uint64(0x9E3779B97F4A7C15)
             ^ line[at] * np.uint64(0xC2B2AE3D27D4EB4F)
             ^ line[at + 1] * np.uint64(0x165667B19E3779F9))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    starts = line[at - 1] == 0
    first = np.flatnonzero(starts)
    within = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
    return (mixed >> np.uint64(48)).astype(np.int64), np.flatnonzero(within % WORD_LETTERS == 0)


def held_out(row_id: str) -> Column:
    """Whether crc32 of the id as text is divisible by 5; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(row_id).cast("string"), F.lit(""))) % 5 == 0


class Models:
    """Logarithms of trigram probabilities: of each bucket the languages that have seen it.

    ``bucket``, ``place`` and ``n`` are the counts above 0, ``place`` the number of the language.
    """

    def __init__(self, languages: list[str], bucket: np.ndarray, place: np.ndarray,
                 n: np.ndarray):
        self.languages = languages
        order = np.lexsort((place, bucket))
        bucket, self._place, n = bucket[order], place[order].astype(np.int32), n[order]
        self._from = np.searchsorted(bucket, np.arange(BUCKETS + 1))
        totals = np.bincount(self._place, n, len(languages)) + SMOOTHING * BUCKETS
        self._unseen = np.log(SMOOTHING / totals).astype(np.float32)
        self._seen = np.log((n + SMOOTHING) / totals[self._place]).astype(np.float32)
        self._table = None

    def __getstate__(self):
        return self.__dict__ | {"_table": None}  # the entries alone are shipped

    def logs(self, buckets: np.ndarray) -> np.ndarray:
        """A row per bucket, a column per language."""
        if BUCKETS * len(self.languages) > _DENSE_CELLS:
            return self._rows(buckets)
        if self._table is None:
            self._table = self._rows(np.arange(BUCKETS))
        return self._table[buckets]

    def _rows(self, buckets: np.ndarray) -> np.ndarray:
        out = np.tile(self._unseen, (len(buckets), 1))
        sizes = self._from[buckets + 1] - self._from[buckets]
        row = np.repeat(np.arange(len(buckets)), sizes)
        entry = np.arange(len(row)) + np.repeat(self._from[buckets] - np.cumsum(sizes) + sizes,
                                                sizes)
        out[row, self._place[entry]] = self._seen[entry]
        return out


def train(rows: DataFrame, text: str = "text", language: str = "lang",
          row_id: str = "doc_id") -> Models | None:
    """Models from labelled rows, which the caller has picked."""
    label = F.col(language).cast("string")
    usable = rows.where(label.isNotNull() & F.col(text).isNotNull())
    sizes = usable.groupBy(label.alias("language")).agg(F.count(F.lit(1)).alias("n")).collect()
    if not sizes:
        return None
    languages = sorted(row.language for row in sizes)
    sampled = [x for row in sizes if row.n >= 2 * TRAINING_ROWS
               for x in (row.language, row.n // TRAINING_ROWS)]
    every = F.coalesce(F.try_element_at(F.create_map(*map(F.lit, sampled)), label),
                       F.lit(1)) if sampled else F.lit(1)
    taken = usable.where(F.pmod(F.xxhash64(F.col(row_id).cast("string")), every) == 0)

    def kernel(texts, kept):
        found = defaultdict(list)
        for value, name in zip(texts, kept["language"], strict=True):
            found[name].append(trigrams(value)[0])
        out = {"language": [], "bucket": [], "n": []}
        for name, parts in found.items():
            used, n = np.unique(np.concatenate(parts), return_counts=True)
            out["language"] += [name] * len(used)
            out["bucket"] += used.tolist()
            out["n"] += n.tolist()
        return out

    counted = map_texts(taken, text, [label.alias("language")], kernel,
                        "language string, bucket int, n bigint")
    number = {name: i for i, name in enumerate(languages)}
    bucket, place, n = array("i"), array("i"), array("d")
    summed = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n"))
    for row in summed.toLocalIterator():  # at most BUCKETS rows per language
        bucket.append(row.bucket)
        place.append(number[row.language])
        n.append(row.n)
    return Models(languages, *map(np.array, (bucket, place, n)))


def _mixture(likely: np.ndarray, words: np.ndarray, shares: np.ndarray,
             rise: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log-likelihood) of each document, by expectation-maximisation.

    ``likely`` has a row per word, documents lie one after another. A document is stepped until
    its log-likelihood rises by no more than ``rise``, RISE unless given. A language whose share
    is 0 stays at 0.
    """
    rise = RISE if rise is None else rise
    shares, value = shares.copy(), np.full(len(words), -np.inf)
    live = np.arange(len(words))
    while True:
        owner = np.repeat(np.arange(len(words)), words)
        first = np.r_[0, np.cumsum(words)[:-1]]
        weight = likely * shares[live][owner]
        total = weight.sum(axis=1)
        now = np.add.reduceat(np.log(total), first)
        rising = now > value[live] + rise
        value[live] = now
        if not rising.any():
            return shares, value
        if not rising.all():
            inside = rising[owner]
            likely, weight, total = likely[inside], weight[inside], total[inside]
            live, words = live[rising], words[rising]
            first = np.r_[0, np.cumsum(words)[:-1]]
        weight /= total[:, None]
        shares[live] = np.add.reduceat(weight, first, axis=0) / words[:, None]


def mixtures(scores: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Proportions of the chosen languages of documents, a row each.

    ``scores`` has the log-likelihood of each word in each language, ``words`` the number of words
    of each document, at least 1.
    """
    first = np.r_[0, np.cumsum(words)[:-1]]
    owner = np.repeat(np.arange(len(words)), words)
    top = scores.max(axis=1)
    likely = np.exp(np.maximum(scores - top[:, None], -60)).astype(np.float64)
    count = scores.shape[1]
    alone = np.add.reduceat(np.log(likely), first, axis=0)  # of one language for all words
    chosen = np.eye(count)[alone.argmax(axis=1)]
    best = alone.max(axis=1)
    cost = PENALTY * np.log(words + 1)

    def part(tried):
        inside = np.isin(owner, tried)
        own = words[tried]
        return likely[inside], np.repeat(np.arange(len(tried)), own), \
            np.r_[0, np.cumsum(own)[:-1]], own

    def raised(tried, start):
        """Those of the tried documents whose penalised likelihood rises; they take the set."""
        inside, _, _, own = part(tried)
        fitted, value = _mixture(inside, own, start)
        value = value - cost[tried] * ((fitted > 0).sum(axis=1) - 1)
        better = value > best[tried] + 1e-6
        chosen[tried[better]], best[tried[better]] = fitted[better], value[better]
        return better

    todo = np.arange(len(words))
    while len(todo):
        tried, without = todo, np.zeros((len(words), count), bool)  # languages that don't help
        while len(tried):
            inside, own, starts, number = part(tried)
            mixed = (inside * chosen[tried][own]).sum(axis=1, keepdims=True)
            slope = np.add.reduceat(inside / mixed, starts, axis=0)
            # The likelihood is concave: no set with one more language gains more than its slope.
            held = chosen[tried] > 0
            least = np.where(held, slope, 0).max(axis=1)
            slope[held | without[tried]] = -np.inf
            new = slope.argmax(axis=1)
            slope = slope.max(axis=1)
            may = (slope > -np.inf) & (np.maximum(slope, least) - number > cost[tried])
            tried, new = tried[may], new[may]
            if len(tried):
                better = raised(tried, 0.75 * chosen[tried] + 0.25 * np.eye(count)[new])
                without[tried[~better], new[~better]] = True
                without[tried[better]] = False
        todo = todo[(chosen[todo] > 0).sum(axis=1) > 2]
        if len(todo):  # without the language of the smallest share
            start = chosen[todo]
            start[np.arange(len(todo)), np.where(start > 0, start, 2).argmin(axis=1)] = 0
            todo = todo[raised(todo, start / start.sum(axis=1, keepdims=True))]
    return chosen


def _known(languages: np.ndarray, background: np.ndarray) -> float:
    """Proportion of the words in the languages, by expectation-maximisation.

    The arguments are log-likelihoods of each word.
    """
    odds = np.exp(np.clip(languages - background, -60, 60))
    share = 0.5
    for _ in range(KNOWN_STEPS):
        before, share = share, float((share * odds / (share * odds + 1 - share)).mean())
        if abs(share - before) < 1e-6 or share in (0.0, 1.0):
            break
    return share


def _predictions(texts: list[str | None], models: Models | None) -> dict[str, list]:
    out = {"lang_pred": [UNDETERMINED] * len(texts), "score": [0.0] * len(texts),
           "languages": [[] for _ in texts], "known": [0.0] * len(texts)}
    if models is None:
        return out
    count = len(models.languages)
    batch: list[tuple[int, np.ndarray, np.ndarray]] = []  # (document, word scores, word sizes)

    def settle():
        words = np.array([len(scores) for _, scores, _ in batch])
        shares = mixtures(np.concatenate([scores for _, scores, _ in batch]), words)
        for (at, scores, sizes), share, number in zip(batch, shares, words, strict=True):
            held = np.flatnonzero(share > 0)
            likely = np.logaddexp.reduce(scores[:, held] + np.log(share[held]), axis=1)
            out["known"][at] = _known(likely, -math.log(BUCKETS) * sizes)
            best = int(share.argmax())
            out["lang_pred"][at] = models.languages[best]
            # as if half a word of each language had been seen besides
            out["score"][at] = float((share[best] * number + 0.5) / (number + 0.5 * count))
            out["languages"][at] = [
                {"lang": models.languages[i], "share": float(share[i])}
                for i in np.argsort(-share, kind="stable") if share[i] > 0]
        batch.clear()

    held = 0
    for at, text in enumerate(texts):
        buckets, starts = trigrams(text or "")
        if not len(starts):
            continue
        scores = np.concatenate([  # in steps, so that very long texts need no more memory
            np.add.reduceat(models.logs(buckets[starts[i]:_end(starts, i, len(buckets))]),
                            starts[i:i + _STEP] - starts[i], axis=0)
            for i in range(0, len(starts), _STEP)])
        batch.append((at, scores, np.diff(np.r_[starts, len(buckets)])))
        held += scores.size
        if held > _CELLS:
            settle()
            held = 0
    if batch:
        settle()
    return out


_STEP = 50_000  # words of a text scored at once


def _end(starts: np.ndarray, at: int, size: int) -> int:
    return int(starts[at + _STEP]) if at + _STEP < len(starts) else size


def predict(rows: DataFrame, models: Models | None, text: str = "text",
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, lang_pred, score, languages (lang and share of each in the mixture) and
    known, the proportion of words that the languages explain better than the background."""
    shipped = rows.sparkSession.sparkContext.broadcast(models)
    kinds = dict(rows.dtypes)
    names = [f"_k{i}" for i in range(len(keep))]
    schema = ", ".join([*(f"{new} {kinds[name]}" for new, name in zip(names, keep, strict=True)),
                        "lang_pred string, score double",
                        "languages array<struct<lang: string, share: double>>, known double"])
    found = map_texts(
        rows, text, [], lambda texts, _: _predictions(texts, shipped.value), schema,
        passed=[F.col(f"`{name}`").alias(new) for new, name in zip(names, keep, strict=True)])
    return found.withColumnsRenamed(dict(zip(names, keep, strict=True)))
