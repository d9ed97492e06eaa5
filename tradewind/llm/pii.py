"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

The patterns find e-mail addresses, IP addresses, card numbers and phone numbers. These seeds
induce lexical patterns: the words around a mention. A mention is a base entity or any other
identifier-like token (an @, or five digits or more) of any length; runs without blanks, as in
minified JSON, query strings or scripts written without spaces, are cut into such tokens. Patterns and instances form a bipartite graph
that Spark scores in rounds: a pattern is as good as the share of its instances that are known,
given MIN_SUPPORT known ones; an instance is known to the degree that its patterns are good (noisy
or). Scores only rise from round to round; rounds end when none rises by more than MIN_RISE, so a
chain of patterns of any length is followed to its end. Mentions outside the base spans whose
instance ends above MIN_SCORE in the context of an accepted pattern are the identifiers found.

The graph holds distinct (pattern, instance) pairs of the whole corpus and stays in Spark. Texts are
told apart by a hash, so repeated rows share their spans. A NULL text is empty.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.batches import importable, join_small, map_texts
from tradewind.llm.spans import Span, outside, replaced
from tradewind.operators.lineage import written

KINDS = ("email", "ip", "card", "phone", "found")
BASE_KINDS = KINDS[:4]
PLACEHOLDERS = tuple(f"[{kind.upper()}]" for kind in KINDS)
MIN_RISE = 1e-3  # of an instance's score that a further round is worth
MIN_SUPPORT = 3  # distinct known instances that a pattern needs
MIN_CONFIDENCE = 0.8  # of a pattern
MIN_SCORE = 0.9  # of an instance
MIN_DIGITS = 5
HASHED_LENGTH = 64  # longer instances are told apart by a hash

# The base patterns. Possessive repeats and look-behinds match the same in linear
# time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
_TOKEN_EDGE = "".join(map(chr, range(0x21, 0x7F))).translate(
    {i: None for i in range(128) if chr(i).isalnum()})
_SPACE = re.compile(r"[\x20\x09-\x0D]")
# What ends an identifier in a run without blanks: quotes, braces, = & ; | and the marks and blanks
# of other scripts.
_ENDS = "\"'`{}=&;|\xa0\xab\xbb\u2000-\u200b\u2014\u2018-\u201f\u2026-\u2029" \
        "\u3000-\u3004\u3008-\u3020\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65"
_RUN = re.compile(f"[^{_ENDS}]+")
# Within a run: brackets, commas, and letters that aren't Latin.
_PART = re.compile(r"(?:[^\W\d_\u0100-\uffff\U00010000-\U0010ffff]"
                   r"|[\u0100-\u024f\u1e00-\u1eff]|[^,()\[\]<>\w]|[\d_])+")
_INNER = re.compile(r"[^:/?#\\]+")
# Scripts without spaces: there each character is a word.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u3007\u3021-\u30fa" \
            "\u30fc-\u312f\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORDS = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+")


def _emails(text: str) -> list[Span]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, 0, match.end()))
            done = match.end()
        at = text.find("@", max(at + 1, done))
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns."""
    found = _emails(text) if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in m[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
                found.append((m.start(), 3, m.end()))
    return found


def _identifier(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The bounds without the punctuation around, if an @ or at least MIN_DIGITS digits are in."""
    word = text[start:end]
    inner = word.strip(_TOKEN_EDGE)
    if sum(map(inner.count, "0123456789")) < MIN_DIGITS and "@" not in inner.strip("@"):
        return None
    start += len(word) - len(word.lstrip(_TOKEN_EDGE))
    return start, start + len(inner)


def identifier_tokens(text: str) -> list[tuple[int, int]]:
    """(start, end) of tokens of any length with an @ or at least MIN_DIGITS digits, without the
    punctuation around them.

    Words are cut where a quote, a brace or the like ends an identifier, then at commas, brackets
    and letters that aren't Latin; if no part is an identifier, what was cut is one if it can be.
    Colons and slashes may join the parts of one identifier or part two: the whole is a token, and
    so is each part that can be one.
    """
    found, at = [], 0
    marks = re.compile("[0-9@]")
    while mark := marks.search(text, at):
        start = max([text.rfind(c, at, mark.start()) for c in " \t\n\x0b\x0c\r"]) + 1
        start = max(start, at)
        space = _SPACE.search(text, mark.end())
        at = space.start() if space else len(text)
        if not _identifier(text, start, at):
            continue
        for run in _RUN.finditer(text, start, at):
            whole = _identifier(text, *run.span())
            if not whole:
                continue
            parts = [_identifier(text, *part.span()) for part in _PART.finditer(text, *whole)]
            for token in [part for part in parts if part] or [whole]:
                found.append(token)
                inner = [_identifier(text, *part.span())
                         for part in _INNER.finditer(text, *token)]
                found += [part for part in inner if part and part != token]
    return found


def _instance(token: str) -> str:
    token = token.lower()
    return (token if len(token) <= HASHED_LENGTH
            else "sha256 " + hashlib.sha256(token.encode("utf-8", "surrogatepass")).hexdigest())


class _Contexts:
    """The words of a text, found once, and the patterns of mentions in it."""

    def __init__(self, text: str):
        self.text = text
        self.bounds = [word.span() for word in _WORDS.finditer(text)]
        self.ends = [end for _, end in self.bounds]

    def _word(self, start: int, end: int) -> str:
        return _instance(self.text[start:end])

    def patterns(self, start: int, end: int) -> list[str]:
        """The words around a mention: one or two before, one or two after, one on each side.

        A word that the mention is part of is cut at the mention.
        """
        first = bisect_right(self.ends, start)  # the first word that ends behind the start
        last = bisect_right(self.ends, end)
        before = [self._word(s, min(e, start))
                  for s, e in self.bounds[max(0, first - 2):first + 1] if s < start][-2:]
        after = [self._word(max(s, end), e) for s, e in self.bounds[last:last + 2]]
        found = [f"{before[-1]} _"] if before else []
        if len(before) > 1:
            found.append(f"{before[0]} {before[1]} _")
        if before and after:
            found.append(f"{before[-1]} _ {after[0]}")
        if after:
            found.append(f"_ {after[0]}")
        if len(after) > 1:
            found.append(f"_ {after[0]} {after[1]}")
        return found


_MENTION = "struct<start: bigint, end: bigint, known: boolean, instance: string, " \
           "patterns: array<string>>"
_SPAN = "struct<kind: string, start: bigint, end: bigint>"


def _text_key(text: str) -> Column:
    return F.sha2(F.col(text).cast("string"), 256)


def _mentions(rows: DataFrame, text: str, keep: list[Column], kinds: str) -> DataFrame:
    """The kept columns, ``base`` spans and ``mentions`` of each row."""
    def kernel(texts, kept):
        base, mentions = [], []
        for value in texts:
            value = value or ""
            own = base_spans(value)
            others = outside([(s, 4, e) for s, e in identifier_tokens(value)], own)
            base.append(_named(own))
            contexts = _Contexts(value if own or others else "")
            mentions.append([
                {"start": start, "end": end, "known": kind < 4,
                 "instance": _instance(value[start:end]), "patterns": contexts.patterns(start, end)}
                for start, kind, end in sorted([*own, *others])])
        return kept | {"base": base, "mentions": mentions}

    return map_texts(rows, text, keep, kernel,
                     f"{kinds}, base array<{_SPAN}>, mentions array<{_MENTION}>")


def _named(spans: list[Span]) -> list[dict]:
    return [{"kind": KINDS[kind], "start": start, "end": end}
            for start, kind, end in sorted(spans)]


def score_graph(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pattern, confidence) of accepted patterns and (instance, score), from the distinct edges
    (pattern, instance, known).

    Each round is written, so a lost executor repeats one round at most.
    """
    edges = written(edges.groupBy("pattern", "instance").agg(F.max("known").alias("known")))
    scores = written(edges.groupBy("instance").agg(
        F.max("known").alias("seed")).withColumn("score", F.col("seed").cast("double")))
    while True:
        known = F.col("score") >= MIN_SCORE
        patterns = written(
            edges.select("pattern", "instance").join(scores, "instance").groupBy("pattern")
            .agg((F.sum("score") / F.count(F.lit(1))).alias("confidence"),
                 F.count_if(known).alias("support"))
            .where((F.col("support") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_CONFIDENCE))
            .select("pattern", "confidence"))
        # noisy or over the accepted patterns; a floor keeps the logarithm finite
        doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6))))
        reached = (edges.select("pattern", "instance").join(patterns, "pattern")
                   .groupBy("instance").agg((1 - F.exp(doubt)).alias("reached")))
        found = F.when(F.col("seed"), F.lit(1.0)).otherwise(F.coalesce("reached", F.lit(0.0)))
        scores = written(scores.join(reached, "instance", "left").select(
            "instance", "seed", found.alias("score"), (found - F.col("score")).alias("rise")))
        rise = scores.agg(F.max("rise")).first()[0]
        scores = scores.drop("rise")
        if rise is None or rise <= MIN_RISE:
            return patterns, scores.select("instance", "score")


def _discovered(mentions: DataFrame) -> DataFrame:
    """(text_key, found): spans outside the base that accepted patterns and scores reach."""
    every = mentions.select("text_key", F.explode("mentions").alias("m")).select(
        "text_key", "m.*")
    edges = every.select(F.explode("patterns").alias("pattern"), "instance", "known")
    patterns, scores = score_graph(edges)
    accepted = scores.where(F.col("score") >= MIN_SCORE).select("instance")
    return (every.where("NOT known").join(accepted, "instance")
            .select("text_key", "start", "end", F.explode("patterns").alias("pattern"))
            .join(patterns.select("pattern"), "pattern")
            .select("text_key", F.struct(F.lit(KINDS[4]).alias("kind"), "start", "end")
                    .alias("span")).distinct()
            .groupBy("text_key").agg(F.sort_array(F.collect_list("span")).alias("found")))


def find_personal_data(rows: DataFrame, text: str = "text",
                       row_id: str = "doc_id") -> DataFrame:
    """(row_id, base, added): arrays of (kind, start, end) for each row, by start."""
    kind = dict(rows.dtypes)[row_id]
    mentions = written(_mentions(
        rows, text, [F.col(row_id).alias("row_id"), _text_key(text).alias("text_key")],
        f"row_id {kind}, text_key string"))
    found = _discovered(mentions.select("text_key", "mentions")).withColumnRenamed(
        "text_key", "_key")
    return (mentions.join(found, F.col("text_key") == F.col("_key"), "left")
            .select(F.col("row_id").alias(row_id), "base",
                    F.coalesce("found", F.array().cast(f"array<{_SPAN}>")).alias("added")))


def mask(rows: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``rows`` with every span replaced by the name of its kind in brackets.

    The columns stay; ``length``, if there is such a column, becomes the new number of code
    points. A NULL text stays NULL.
    """
    mentions = written(_mentions(rows, text, [_text_key(text).alias("text_key")],
                                 "text_key string").where("size(mentions) > 0"))
    found = written(_discovered(mentions).select(F.col("text_key").alias("_key"),
                                                 F.col("found").alias("_found")))

    importable(rows.sparkSession)

    @F.pandas_udf("string")
    def masked(texts: pd.Series, more: pd.Series) -> pd.Series:
        return pd.Series([
            None if value is None else replaced(value, [
                *base_spans(value),
                *((s["start"], KINDS.index(s["kind"]), s["end"])
                  for s in (() if added is None else added))], PLACEHOLDERS)
            for value, added in zip(texts, more, strict=True)], dtype=object)

    # Few texts hold spans found by context; the base spans are cheaper to find again than to join.
    # Columns get names of their own, so that theirs can't clash with those of the spans.
    own = {name: f"_c{i}" for i, name in enumerate(rows.columns)}
    inner = rows.toDF(*own.values())
    done = (join_small(inner, found, _text_key(own[text]) == F.col("_key"), "left")
            .withColumn(own[text], masked(F.col(own[text]), F.col("_found"))))
    if length in own:
        done = done.withColumn(own[length], F.when(
            F.col(own[text]).isNotNull(), F.char_length(own[text])).otherwise(
            F.col(own[length])).cast(dict(rows.dtypes)[length]))
    return done.select(*(F.col(new).alias(name) for name, new in own.items()))
