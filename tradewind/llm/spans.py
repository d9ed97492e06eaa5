"""Spans in texts: (start, end) in code points, end exclusive, by kind."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable
from itertools import accumulate

Span = tuple[int, int, int]  # start, number of the kind, end


def written_out(spans: Iterable[Span], kinds: tuple[str, ...]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return ",".join(f"{kinds[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def digest(spans: Iterable[Span], kinds: tuple[str, ...]) -> str:
    return hashlib.sha256(written_out(spans, kinds).encode()).hexdigest()


def outside(spans: Iterable[Span], taken: Iterable[Span]) -> list[Span]:
    """The spans, which may lie in one another, that overlap none of the taken ones."""
    taken = sorted(taken)
    starts = [start for start, _, _ in taken]
    reach = [0, *accumulate((end for _, _, end in taken), max)]  # of the first taken ones
    return [(start, kind, end) for start, kind, end in sorted(spans)
            if reach[bisect_left(starts, end)] <= start]


def replaced(text: str, spans: Iterable[Span], names: tuple[str, ...]) -> str:
    """The text with each span replaced by the name of its kind; of overlapping spans the first
    names the whole."""
    parts, done = [], 0
    for start, kind, end in sorted(spans):
        if start >= done:
            parts += [text[done:start], names[kind]]
        done = max(done, end)
    return "".join([*parts, text[done:]])
