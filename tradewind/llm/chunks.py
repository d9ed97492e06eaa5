"""Encoding texts chunk by chunk, with a memo of the chunks seen.

A byte-level pre-tokenizer never puts a space behind a character that isn't white space, so a
text can be cut before every space that follows such a character, and the chunks be encoded on
their own. Most chunks are words that come again and again; a worker keeps the results of the
last ones in a memo of bounded size.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc

# What Python calls white space includes all that Unicode does, so cuts are never too many.
_CUT = re.compile(r"(?<=\S)(?= )")
# Where a text may not be cut before every space: only there do spaces belong to longer runs. Of any
# other run of white space the last character stands alone, and so does what comes before it.
_RUN = re.compile(r" (?=\s|\Z)")
# A text can also be cut before a line feed that no white space precedes ...
_LINE = re.compile(r"\n(?<=\S\n)")
_CUT_LINES = re.compile(r"(?<=\S)(?=[ \n])")
# ... and between a letter or digit and one of these. An apostrophe may belong to letters behind it.
MARKS = string.punctuation.replace("'", "")
MEMO_KEYS = 200_000
MEMO_KEY_LENGTH = 100


class Memo:
    """Values of keys, computed for many keys at once and kept while they are asked for.

    Two generations of about ``size`` keys: a key that is asked for moves to the younger one,
    the older one is dropped when the younger is full.
    """

    def __init__(self, compute: Callable[[list], list], size: int = MEMO_KEYS):
        self._compute, self._size = compute, size
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def covering(self, key_lists: list[list[str]]) -> dict[str, bytes]:
        """A dictionary with all these keys, valid until the next call."""
        self._rotate()
        young = self._young
        self._add({key for keys in key_lists for key in keys if key not in young})
        return young

    def values(self, keys: list[str]) -> list[bytes]:
        """The values of these keys, most of which are known."""
        self._rotate()
        found = list(map(self._young.get, keys))
        unknown = [at for at, value in enumerate(found) if value is None]
        self._add({keys[at] for at in unknown})
        for at in unknown:
            found[at] = self._young[keys[at]]
        return found

    def _rotate(self) -> None:
        if len(self._young) > self._size:
            long = [key for key in self._young if len(key) > MEMO_KEY_LENGTH]
            for key in long:  # they rarely come again
                del self._young[key]
            self._old, self._young = self._young, {}

    def _add(self, wanted: set[str]) -> None:
        """Make these keys part of the younger generation, which lacks them."""
        young, old = self._young, self._old
        kept = {key: old[key] for key in wanted if key in old}
        young.update(kept)
        new = list(wanted - kept.keys())
        young.update(zip(new, self._compute(new), strict=True))

    def joined(self, key_lists: list[list[str]]) -> list[bytes]:
        """The values of each list of keys, one behind the other."""
        find = self.covering(key_lists).__getitem__
        return [b"".join(map(find, keys)) for keys in key_lists]


class ChunkEncoder:
    """Token ids of texts as little-endian unsigned 32-bit integers.

    ``encode(chunks)`` gives the ids, packed that way, of each of a list of strings.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], memo_keys: int = MEMO_KEYS):
        self._encode = encode
        # by chunk without its leading space
        self._memo = Memo(lambda words: encode([" " + word for word in words]), memo_keys)

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        cut = [_cut(text or "") for text in texts]
        firsts = self._encode([chunks[0] for chunks in cut])
        for chunks in cut:
            chunks[0] = "-"  # a chunk of the memo, so that the lists need no copy
        find = self._memo.covering(cut).__getitem__
        skip = len(find("-"))
        return [first + b"".join(map(find, chunks))[skip:]
                for first, chunks in zip(firsts, cut, strict=True)]


def _cut(text: str) -> list[str]:
    """Chunks, all but the first without their leading space."""
    if _RUN.search(text):
        chunks = _CUT.split(text)
        return [chunks[0], *(chunk[1:] for chunk in chunks[1:])]
    return text.split(" ")


class PartEncoder:
    """Token ids as ``ChunkEncoder`` gives them, by a memo of parts of chunks.

    A word comes with many marks and line ends, each time as another chunk. Here lines are cut too,
    and the marks that end a chunk are encoded on their own. Arrow finds the distinct chunks of many
    texts, so that Python handles each of them once.

    ``encode(parts)`` gives the ids of strings, each of which begins with white space or is empty.
    A line feed followed by anything but white space must be one token. A chunk that holds one of
    the strings of ``whole`` keeps its marks.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], memo_keys: int = MEMO_KEYS,
                 whole: tuple[str, ...] = ()):
        # by part, without its leading space if that is all of its white space
        self._memo = Memo(lambda parts: encode(
            [part if not part or part[0].isspace() else " " + part for part in parts]), memo_keys)
        self._whole = whole

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        # A text that doesn't begin with white space gets a line feed, whose token is dropped.
        bare = [bool(text) and not text[0].isspace() for text in texts]
        texts = ["\n" + text if first else text or ""
                 for text, first in zip(texts, bare, strict=True)]
        runs = [at for at, text in enumerate(texts) if _RUN.search(text)]
        kept = set(runs)
        others = [at for at in range(len(texts)) if at not in kept] if kept else range(len(texts))
        chunks = pa.concat_arrays([
            pc.split_pattern(pa.array([_LINE.sub(" \n", texts[at]) for at in others],
                                      pa.string()), " "),
            pa.array([_spaced(texts[at]) for at in runs], pa.list_(pa.string()))])
        distinct = chunks.values.dictionary_encode()
        find = self._values(distinct.dictionary).__getitem__
        codes, ends = distinct.indices.to_numpy().tolist(), chunks.offsets.to_numpy().tolist()
        found = [b""] * len(texts)
        for at, start, end in zip([*others, *runs], ends, ends[1:], strict=False):
            found[at] = b"".join(map(find, codes[start:end]))[4 if bare[at] else 0:]
        return found

    def _values(self, chunks: pa.Array) -> list[bytes]:
        """The ids of each chunk: those of its stem and those of the marks behind it."""
        trimmed = pc.ascii_rtrim(chunks, MARKS)
        ends_in_marks = pc.not_equal(pc.binary_length(trimmed), pc.binary_length(chunks))
        whole = [token for token in self._whole
                 if pc.any(pc.match_substring(chunks, token)).as_py()]
        stems = _strings(trimmed)
        marked, marks = [], []
        for at, chunk in zip(pc.indices_nonzero(ends_in_marks).to_numpy().tolist(),
                             _strings(chunks.filter(ends_in_marks)), strict=True):
            stem = stems[at]
            if stem[-1:].isalnum() and not (whole and any(token in chunk for token in whole)):
                marked.append(at)
                marks.append("\n" + chunk[len(stem):])
            else:
                stems[at] = chunk
        values = self._memo.values(stems + marks)
        for at, mark in zip(marked, values[len(stems):], strict=True):
            values[at] += mark[4:]
        return values


def _strings(values: pa.Array) -> list[str]:
    """As a list, by way of NumPy: several times as fast as by ``to_pylist``."""
    return values.to_numpy(zero_copy_only=False).tolist()


def _spaced(text: str) -> list[str]:
    """Chunks, without their leading space if they begin with just one."""
    chunks = _CUT_LINES.split(text)
    return [chunks[0], *(chunk[1:] if chunk[0] == " " and chunk[1:] and not chunk[1].isspace()
                         else chunk for chunk in chunks[1:])]
