"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds to them.

The patterns find assignments to names like ``token``, access key ids and long hex strings. The
field tags the tokens of a text as secret begin, inside or outside. It learns from the corpus
itself: on a bounded sample of documents the pattern matches are the labels, and the features
(shape, length, entropy, neighbouring words, traits of the whole file) carry over to secrets that
no pattern describes.

Every run of TOKEN_LENGTH or more safe characters, with or without a digit, is a token that can be
tagged begin or inside; shorter words are outside by definition. Viterbi decoding of a whole text
therefore falls apart into the runs of tokens without such a word between them, and is exact.

A NULL text is empty. A sample without any labelled secret trains nothing and adds nothing.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from functools import cache, lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.batches import map_texts
from tradewind.llm.spans import Span, digest, outside, written_out
from tradewind.operators.lineage import written

KINDS = ("assign", "access", "hex", "field")
BASE_KINDS = KINDS[:3]

# Documents that the field learns from, chosen by a hash of their id, and tokens of those.
SAMPLE_DOCUMENTS = 20_000
SAMPLE_TOKENS = 200_000
FEATURES = 1 << 16
TOKEN_LENGTH = 8
TAGS = 3  # outside, begin, inside
OWN_FEATURES = 11  # those that come first, of the token itself
EPOCHS = 80
PENALTY = 1.0  # half the inverse variance that a weight is expected to have
FIRST_PENALTY = 5.0
MIN_ALIKE = 0.1  # probability from which an unlabelled token is set aside in training
MEMO_TOKENS = 50_000  # whose features a worker remembers
TOKENS_AT_ONCE = 50_000
_CHAIN = 64  # longer chains are cut for training only

# The base patterns. Possessive repeats match the same and never backtrack.
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"""([A-Za-z0-9+/_.=-]++)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]++")
_HEX = re.compile(r"[0-9a-f]{16,}+")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

_SAFE = "A-Za-z0-9+/=_.~-"
_TOKEN = re.compile(f"[{_SAFE}]{{{TOKEN_LENGTH},}}+")
_ALNUM = re.compile(r"[^\W_]")
_WORD = re.compile(r"\w+|[^\w\s]")


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns."""
    return _matches(text, 0)


def secret_spans(text: str) -> list[Span]:
    """The secrets in the matches: of an assignment the value, without the name."""
    return _matches(text, 1)


def _matches(text: str, group: int) -> list[Span]:
    found = []
    if any(map(text.lower().__contains__, _NAMES)):
        found += [(m.start(group), 0, m.end()) for m in _ASSIGN.finditer(text)
                  if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)
                  if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return found


def tokens(text: str) -> list[tuple[int, int]]:
    """(start, end) of the tokens that may be part of a secret."""
    found = []
    for match in _TOKEN.finditer(text):
        size = len(match[0].rstrip("."))  # the end of a sentence
        if size >= TOKEN_LENGTH:
            found.append((match.start(), match.start() + size))
    return found


def chains(text: str, found: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Runs of tokens with no letter or digit, so no word, between them."""
    runs: list[list[tuple[int, int]]] = []
    for start, end in found:
        if runs and not _ALNUM.search(text, runs[-1][-1][1], start):
            runs[-1].append((start, end))
        else:
            runs.append([(start, end)])
    return runs


def _file_features(text: str, number: int) -> tuple[int, ...]:
    size = len(text) + 1
    lines = text.count("\n") + 1
    return _numbers([
        f"file size {int(math.log2(size) / 2)}", f"file tokens {int(math.log2(number + 1))}",
        f"file assigns {min(3, 4 * (text.count('=') + text.count(':')) // lines)}",
        f"file braces {min(3, 100 * (text.count('{') + text.count(';')) // size)}"])


def _table(name: str, values: list) -> np.ndarray:
    return np.array(_numbers([f"{name} {value}" for value in values]), np.int64)


@cache
def _tables() -> dict[str, np.ndarray]:
    """Feature numbers by name and value; values are small whole numbers."""
    few = {"changes": 9, "size": 11, "entropy": 17, "digits": 5, "dots": 4, "dashes": 4}
    return {name: _table(name, [*range(count)]) for name, count in few.items()} | {
        name: _table(name, [False, True]) for name in ("lower", "upper")} | {
        "first": _table("first", [*map(chr, range(256))])}


_MARK = np.array([ord("a") if chr(c).islower() else ord("A") if chr(c).isupper()
                  else ord("9") if chr(c).isdigit() else c for c in range(128)], np.uint8)


def own_numbers(found: list[str]) -> np.ndarray:
    """Numbers of the features of tokens by themselves, over all their characters: a row each."""
    if not found:
        return np.zeros((0, OWN_FEATURES), np.int64)
    codes = np.frombuffer("".join(found).encode("ascii"), np.uint8)
    size = np.fromiter(map(len, found), np.int64, len(found))
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(found)), size)

    def count(wanted: np.ndarray) -> np.ndarray:
        return np.add.reduceat(wanted.astype(np.int64), first)

    # The shape: runs of small letters, of capitals and of digits shrink to one mark.
    marks = _MARK[codes]
    kept = np.r_[True, marks[1:] != marks[:-1]] | ~np.isin(marks, np.frombuffer(b"aA9", np.uint8))
    kept[first] = True
    shapes, marked = marks[kept].tobytes(), count(kept)
    at = (np.cumsum(marked) - marked).tolist()
    shape = [_shape_number(shapes[start:start + min(8, length)])
             for start, length in zip(at, marked.tolist(), strict=True)]
    # Entropy: log(size) - sum of n log(n) over the token's distinct characters, by size.
    pairs, number = np.unique(owner * 128 + codes, return_counts=True)
    spread = np.bincount(pairs // 128, number * np.log2(number), len(found)) / size
    entropy = (2 * (np.log2(size) - spread) + 1e-9).astype(np.int64)
    tables = _tables()
    return np.stack([
        np.full(len(found), _BIAS), np.array(shape), tables["changes"][np.minimum(8, marked // 3)],
        tables["size"][np.minimum(10, size // 4)], tables["entropy"][np.clip(entropy, 0, 16)],
        tables["digits"][4 * count(marks == ord("9")) // size],
        tables["lower"][(count(marks == ord("a")) > 0).astype(int)],
        tables["upper"][(count(marks == ord("A")) > 0).astype(int)],
        tables["dots"][np.minimum(3, count(codes == ord(".")))],
        tables["dashes"][np.minimum(3, count(codes == ord("-")))],
        tables["first"][codes[first]]], axis=1)


def _numbers(names: list[str]) -> tuple[int, ...]:
    return tuple(zlib.crc32(name.encode()) % FEATURES for name in names)


@lru_cache(MEMO_TOKENS)
def _shape_number(shape: bytes) -> int:
    return _numbers([f"shape {shape.decode()}"])[0]


_BIAS = _numbers(["bias"])[0]


@lru_cache(MEMO_TOKENS)
def _number(place: str, word: str) -> int:
    return zlib.crc32(f"word {place} {word.lower()}".encode()) % FEATURES


def context_numbers(text: str, start: int, end: int, of_file: tuple[int, ...]) -> list[int]:
    """Numbers of the features of a token's neighbouring words and its file."""
    before = _WORD.findall(text[max(0, start - 48):start])[:-4:-1]
    found = [*map(_number, _BEFORE, before)]
    after = _WORD.search(text, end, end + 24)
    if after:
        found.append(_number("+1", after[0]))
    return [*found, *of_file]


_BEFORE = ("-1", "-2", "-3")


def _labels(run: list[tuple[int, int]], base: list[Span]) -> list[int]:
    """1 for a token that begins a base span or is alone in it, 2 for one further inside, else 0."""
    labels, last = [], None
    for start, end in run:
        holder = next((span for span in base if span[0] < end and start < span[2]), None)
        labels.append(0 if holder is None else 2 if holder is last else 1)
        last = holder
    return labels


def training_chains(rows: DataFrame, text: str, row_id: str) -> list[tuple[list, list]]:
    """(feature numbers per token, tags) of the chains of a bounded sample of documents."""
    every = max(1, math.ceil(rows.count() / SAMPLE_DOCUMENTS))
    sample = rows.where(F.pmod(F.xxhash64(F.col(row_id).cast("string")), F.lit(every)) == 0)

    def kernel(texts, _):
        out = defaultdict(list)
        for value in filter(None, texts):
            found = tokens(value)
            if not found:
                continue
            of_file, base = _file_features(value, len(found)), sorted(secret_spans(value))
            own = iter(own_numbers([value[s:e] for s, e in found]).tolist())
            for run in chains(value, found):
                for at in range(0, len(run), _CHAIN):
                    part = run[at:at + _CHAIN]
                    out["features"].append([next(own) + context_numbers(value, s, e, of_file)
                                            for s, e in part])
                    near = [b for b in base if b[0] < part[-1][1] and part[0][0] < b[2]]
                    out["tags"].append(_labels(part, near))
        return {"features": out["features"], "tags": out["tags"]}

    found = written(map_texts(sample, text, [], kernel,
                              "features array<array<int>>, tags array<int>"))
    # By a hash of their own, so that the same chains are kept every time; by a threshold, so that
    # a task sends its share of them only.
    number = found.agg(F.sum(F.size("tags"))).first()[0] or 0
    own = F.xxhash64("features", "tags")
    if number > SAMPLE_TOKENS:
        found = found.where(F.pmod(own, F.lit(number)) < SAMPLE_TOKENS)
    kept, size = [], 0
    for row in sorted(found.select("features", "tags", own.alias("own")).collect(),
                      key=lambda row: row.own):
        size += len(row.tags)
        if size > SAMPLE_TOKENS:
            break
        kept.append((row.features, row.tags))
    return kept


class Field:
    """A linear-chain conditional random field over outside, begin and inside.

    ``weights`` has a row per feature and a column per tag; ``moves[a, b]`` scores tag b after tag
    a. A text begins after an outside token, and inside never follows outside.
    """

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def scores(self, numbers: list[list[int]]) -> np.ndarray:
        """A row per token; every token has features."""
        if not numbers:
            return np.zeros((0, TAGS), np.float32)
        first = np.cumsum([0, *map(len, numbers[:-1])])
        return np.add.reduceat(self.weights[[*chain.from_iterable(numbers)]], first, axis=0)

    def decode(self, scores: np.ndarray, lengths: list[int]) -> np.ndarray:
        """The best tags by Viterbi of chains one behind the other, those of a length side by side."""
        size = np.array(lengths, np.int64)
        first = np.cumsum(size) - size
        tags = np.zeros(len(scores), np.int64)
        for length in np.unique(size).tolist():
            at = first[size == length]
            best, origins = self.moves[0] + scores[at], []
            for step in range(1, length):
                through = best[:, :, None] + self.moves
                origins.append(through.argmax(axis=1))
                best = through.max(axis=1) + scores[at + step]
            last = best.argmax(axis=1)
            tags[at + length - 1] = last
            for step in range(length - 2, -1, -1):
                last = origins[step][np.arange(len(at)), last]
                tags[at + step] = last
        return tags


_FORBIDDEN = -1e4


def train(found: list[tuple[list, list]]) -> Field | None:
    """A field from chains whose unlabelled tokens may be secrets that no pattern knows.

    A first field sees the token's own features only. Chains with an unlabelled token that it may
    take for a secret are set aside; the field proper learns from the others, with all features.
    """
    if not any(any(tags) for _, tags in found):
        return None
    first = fit([([row[:OWN_FEATURES] for row in numbers], tags) for numbers, tags in found],
                FIRST_PENALTY)
    return fit([(numbers, tags) for numbers, tags in found
                if all(tags) or not _look_alikes(first, numbers, tags)])


def _look_alikes(first: Field, numbers: list[list[int]], tags: list[int]) -> bool:
    """Whether an unlabelled token begins a secret with probability MIN_ALIKE at least, taken alone.

    Plain words outnumber secrets, so the best tag of a look-alike is often outside.
    """
    scores = first.scores([row[:OWN_FEATURES] for row in numbers]) + first.moves[0]
    odds = scores[:, 1] - scores[:, 0]
    return bool((odds[np.array(tags) == 0] >= math.log(MIN_ALIKE / (1 - MIN_ALIKE))).any())


def fit(found: list[tuple[list, list]], penalty: float = PENALTY) -> Field:
    """The field of highest penalised likelihood, by Adam on all chains at once."""
    by_length: dict[int, list] = defaultdict(list)
    for numbers, tags in found:
        by_length[len(tags)].append((numbers, tags))
    # Chains of equal length side by side: features as (token, number) pairs, tags as a matrix.
    groups = []
    for length, members in sorted(by_length.items()):
        flat = [row for numbers, _ in members for row in numbers]
        owner = np.repeat(np.arange(len(flat)), [len(row) for row in flat])
        groups.append((length, owner, np.concatenate([np.array(row, np.int64) for row in flat]),
                       np.array([tags for _, tags in members], np.int64)))
    size = sum(group[3].size for group in groups)
    weights, moves = np.zeros((FEATURES, TAGS)), np.zeros((TAGS, TAGS))
    allowed = np.ones((TAGS, TAGS))
    allowed[0, 2] = 0
    state = [np.zeros_like(a) for a in (weights, weights, moves, moves)]
    for epoch in range(1, EPOCHS + 1):
        up_w, up_m = -penalty * weights, -penalty * moves
        for length, owner, numbers, tags in groups:
            scores = np.stack([np.bincount(owner, weights[numbers, tag], tags.size)
                               for tag in range(TAGS)], axis=1).reshape(len(tags), length, TAGS)
            expected, pairs = _expectations(scores, np.where(allowed > 0, moves, _FORBIDDEN))
            gap = (np.eye(TAGS)[tags] - expected).reshape(-1, TAGS)
            for tag in range(TAGS):
                up_w[:, tag] += np.bincount(numbers, gap[owner, tag], FEATURES)
            before = np.concatenate([np.zeros((len(tags), 1), np.int64), tags[:, :-1]], axis=1)
            seen = np.zeros((TAGS, TAGS))
            np.add.at(seen, (before.ravel(), tags.ravel()), 1)
            up_m += (seen - pairs) * allowed
        for at, (value, up) in enumerate(((weights, up_w / size), (moves, up_m / size))):
            mean, square = state[2 * at], state[2 * at + 1]
            mean += 0.1 * (up - mean)
            square += 0.01 * (up * up - square)
            value += 0.3 * (mean / (1 - 0.9 ** epoch)) / (
                np.sqrt(square / (1 - 0.99 ** epoch)) + 1e-6)
    return Field(weights.astype(np.float32), np.where(allowed > 0, moves, _FORBIDDEN))


def _expectations(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected tags per token and expected number of each move, by forward and backward sums."""
    count, length, _ = scores.shape

    def total(values, axis):
        top = values.max(axis=axis, keepdims=True)
        return np.log(np.exp(values - top).sum(axis=axis)) + top.squeeze(axis)

    ahead = np.empty_like(scores)
    ahead[:, 0] = moves[0] + scores[:, 0]
    for t in range(1, length):
        ahead[:, t] = total(ahead[:, t - 1, :, None] + moves, 1) + scores[:, t]
    back = np.zeros_like(scores)
    for t in range(length - 2, -1, -1):
        back[:, t] = total(moves + (scores[:, t + 1] + back[:, t + 1])[:, None, :], 2)
    whole = total(ahead[:, -1], 1)
    expected = np.exp(ahead + back - whole[:, None, None])
    pairs = np.zeros((TAGS, TAGS))
    pairs[0] += expected[:, 0].sum(axis=0)
    for t in range(1, length):
        pairs += np.exp(ahead[:, t - 1, :, None] + moves + (scores[:, t] + back[:, t])[:, None, :]
                        - whole[:, None, None]).sum(axis=0)
    return expected, pairs


def field_spans(texts: list[str | None], field: Field) -> list[list[Span]]:
    """Spans of tokens tagged begin and those inside after it, for each text."""
    places: list[tuple[int, int, int]] = []  # (text, start, end) of each token
    words: list[str] = []
    context: list[list[int]] = []
    lengths: list[int] = []
    spans: list[list[Span]] = [[] for _ in texts]

    def settle() -> None:
        scores = field.weights[own_numbers(words)].sum(axis=1) + field.scores(context)
        tags = field.decode(scores, lengths)
        for i in np.flatnonzero(tags).tolist():  # few are in a secret
            at, start, end = places[i]
            if tags[i] == 1:
                spans[at].append((start, 3, end))
            elif spans[at]:
                spans[at][-1] = (spans[at][-1][0], 3, end)
        for held in (places, words, context, lengths):
            held.clear()

    for at, text in enumerate(texts):
        found = tokens(text or "")
        if not found:
            continue
        of_file = _file_features(text, len(found))
        for run in chains(text, found):
            lengths.append(len(run))
            places += [(at, start, end) for start, end in run]
            words += [text[start:end] for start, end in run]
            context += [context_numbers(text, start, end, of_file) for start, end in run]
            if len(places) > TOKENS_AT_ONCE:
                settle()
    settle()
    return spans


def find_secrets(rows: DataFrame, text: str = "text", row_id: str = "doc_id",
                 field: Field | None = None, learn: bool = True) -> DataFrame:
    """(row_id, base, added): arrays of (kind, start, end) for each row, by start.

    ``field`` is a trained field; without one it is trained on ``rows``, unless ``learn`` is false.
    Added spans overlap no base span.
    """
    if field is None and learn:
        field = train(training_chains(rows, text, row_id))
    shipped = rows.sparkSession.sparkContext.broadcast(field)

    def kernel(texts, kept):
        base = [base_spans(value or "") for value in texts]
        more = field_spans(texts, shipped.value) if shipped.value else [[] for _ in texts]
        return kept | {"base": [_named(own) for own in base],
                       "added": [_named(outside(found, own) if found else [])
                                 for found, own in zip(more, base, strict=True)]}

    span = "array<struct<kind: string, start: bigint, end: bigint>>"
    kind = dict(rows.dtypes)[row_id]
    return map_texts(rows, text, [F.col(row_id).alias("row_id")], kernel,
                     f"row_id {kind}, base {span}, added {span}"
                     ).withColumnRenamed("row_id", row_id)


def _named(spans: list[Span]) -> list[dict]:
    return [{"kind": KINDS[kind], "start": start, "end": end}
            for start, kind, end in sorted(spans)]
