"""Byte-level BPE of whole texts from a public rank file."""

from __future__ import annotations

import base64
import json
import os

import numpy as np
import public_tokenizers
import tiktoken

_ENCODINGS: dict[str, tiktoken.Encoding] = {}


def default_vocabulary() -> str:
    """Rank file of the vocabulary byte_bpe_50k.json: the same pieces, merges and ids."""
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of the tokenizer file beside a rank file, which texts are split at before anything else."""
    with open(os.path.splitext(path)[0] + ".json", encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        raise ValueError(f"an added token of {path} takes its surroundings into account")
    return {t["content"]: t["id"] for t in added}


def encoding(path: str) -> tiktoken.Encoding:
    """The encoding of a rank file; workers are reused from task to task, so it is read once in each."""
    if path not in _ENCODINGS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added_tokens(path))
    return _ENCODINGS[path]


def token_ids(text: str | None, path: str) -> np.ndarray:
    """Ids of one text as little-endian unsigned 32-bit integers; an added token's string in it gives that token, as in tokenizers."""
    return np.array(encoding(path).encode(text or "", allowed_special="all"), "<u4")
