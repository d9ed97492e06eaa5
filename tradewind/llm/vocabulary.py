"""Vocabulary files of public tokenizers, read on the driver and shipped to the tasks.

A vocabulary is a few MB whatever the data, so shipping it whole is safe; executors need no
copy of the file.
"""

from __future__ import annotations

import base64

import public_tokenizers

BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_BPE_JSON = public_tokenizers.path("byte_bpe_50k.json")
SPLIT_PATTERN = public_tokenizers.PATTERN


def read_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank)
            for token, rank in map(bytes.split, content.splitlines())}
