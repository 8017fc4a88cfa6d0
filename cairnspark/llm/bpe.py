"""Byte-level BPE of whole texts by a rank queue with a hierarchical bitmap, and its decoding.

A text is cut into pre-tokens by the tokenizer's pattern. A pre-token that is an entry of the vocabulary
is that token. In any other, the bytes form a linked list, and every pair of neighbours whose bytes are an
entry waits in the bucket of that entry's rank, under the position of its left part. Words of a bitmap have one
bit for each bucket that holds something, and a word above them has one for each word that is not empty, so
find-first-set gives the least rank in two steps. The leftmost position of that bucket is merged if its pair
still has that rank; an entry whose pair has changed since is stale and skipped. The two pairs beside a merge
are queued anew. So a pre-token of n bytes takes a number of steps linear in n (and a logarithm within a
bucket), also where one pre-token is a whole text.

Results of short pre-tokens are kept in each worker, up to a bound; that changes no result.

Edge cases: null or empty text: no ids; special tokens' strings are plain text; repeated rows and null keys
give a row each; an empty table gives an empty result; columns other than key and text are not read.
"""

from __future__ import annotations

import base64
import re
import struct
import sys
from array import array
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm.common import per_batch, small_batches, table

#: A worker keeps the ids of at most KEPT pre-tokens of at most KEPT_CHARS characters.
KEPT, KEPT_CHARS = 1_000_000, 32


_BIT = [1 << i for i in range(4096)]


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def splitters(pattern: str = public_tokenizers.PATTERN):
    """(the pattern's findall, findall of the same pattern with classes written out, a search for characters that need the latter).

    Versions of Unicode differ between libraries. The second pattern lists what the tokenizer library itself takes for
    letters, numbers and white space; the first, which is faster, serves texts in which both agree.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    one_byte = {bytes([i]): i for i in range(256)}

    def written(codes: list[int]) -> str:
        codes = np.array(codes, np.int64)
        starts, ends = codes[np.diff(codes, prepend=-2) != 1], codes[np.diff(codes, append=sys.maxunicode + 2) != 1]
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends, strict=True))

    odd, exact = set(), pattern
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        found = tiktoken.Encoding(name, pat_str=name, mergeable_ranks=one_byte, special_tokens={}).encode_ordinary(every)
        members = [ord(c) for c in bytes(found).decode()]
        odd |= {ord(c) for c in regex.findall(name, every)} ^ set(members)
        said = written(members)
        exact = re.sub(r"(\[[^]]*)" + re.escape(name), lambda m, said=said: m[1] + said, exact).replace(name, f"[{said}]")
    exact = exact.replace(r"\S", f"[^{said}]")
    return regex.compile(pattern).findall, re.compile(exact).findall, re.compile(f"[{written(sorted(odd))}]").search if odd else lambda _: None


class ByteBPE:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        top = max(self.ranks.values()) + 1
        # the queue: a bucket for each rank, words of 256 bits that say which buckets hold something; a word of words is local
        self.buckets: list[list[int]] = [[] for _ in range(top)]
        self.words = [0] * (top // 256 + 1)
        self.tokens = np.full(top, None, object)
        for token, i in self.ranks.items():
            self.tokens[i] = token
        self.usual, self.find, self.odd = splitters()
        self.kept = _Kept(self)

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one pre-token. The queue is empty before and after; its steps are written out here, as they are most of the work."""
        rank_of, buckets, words = self.ranks.get, self.buckets, self.words
        if (whole := rank_of(piece)) is not None:
            return [whole]
        n, top = len(piece), 0
        compact = list if n < 4096 else lambda x: array("q", x)
        after, before = compact(range(1, n + 2)), compact(range(-1, n))
        waits = compact([-1]) * n  # the rank under which the pair that begins here is queued
        for i in range(n - 1):
            rank = rank_of(piece[i : i + 2])
            if rank is not None:
                waits[i] = rank
                bucket = buckets[rank]
                if not bucket:
                    w = rank >> 8
                    words[w] |= _BIT[rank & 255]
                    top |= _BIT[w]
                bucket.append(i)  # positions come in order, so the list is a heap
        while top:
            w = (top & -top).bit_length() - 1
            word = words[w]
            r = (word & -word).bit_length() - 1
            rank = (w << 8) + r
            bucket = buckets[rank]
            while bucket:
                at = heappop(bucket)
                if waits[at] != rank:
                    continue  # stale
                gone = after[at]
                end = after[gone]
                after[at] = end
                waits[gone] = -1
                least = rank
                if end < n:
                    before[end] = at
                    new = rank_of(piece[at : after[end]])
                    if new is None:
                        waits[at] = -1
                    else:
                        waits[at] = new
                        other = buckets[new]
                        if other:
                            heappush(other, at)
                        else:
                            other.append(at)
                            v = new >> 8
                            words[v] |= _BIT[new & 255]
                            top |= _BIT[v]
                        least = min(least, new)
                else:
                    waits[at] = -1
                if at:
                    left = before[at]
                    new = rank_of(piece[left:end])
                    if new is None:
                        waits[left] = -1
                    else:
                        waits[left] = new
                        other = buckets[new]
                        if other:
                            heappush(other, left)
                        else:
                            other.append(left)
                            v = new >> 8
                            words[v] |= _BIT[new & 255]
                            top |= _BIT[v]
                        least = min(least, new)
                if least < rank:
                    break  # a pair made just now comes first
            if not bucket:
                words[w] ^= _BIT[r]
                if not words[w]:
                    top ^= _BIT[w]
        out, at = [], 0
        while at < n:
            end = after[at]
            out.append(rank_of(piece[at:end]))
            at = end
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        text = text or ""
        find = self.usual if text.isascii() or self.odd(text) is None else self.find
        return b"".join(map(self.kept.__getitem__, find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.tokens[np.frombuffer(ids, "<u4")].tolist())


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Kept(dict):
    """The ids of pre-tokens, made where they are missing."""

    def __init__(self, owner: ByteBPE):
        super().__init__()
        self.owner = owner

    def __missing__(self, piece: str) -> bytes:
        ids = _packed(self.owner.merged(piece.encode("utf-8", "surrogatepass")))
        if len(piece) <= KEPT_CHARS:
            if len(self) >= KEPT:
                self.clear()
            self[piece] = ids
        return ids


_CODECS: dict[str, ByteBPE] = {}


def codec(path: str) -> ByteBPE:
    """The codec of a rank file; workers are reused from task to task, so it is read once in each."""
    if path not in _CODECS:
        _CODECS[path] = ByteBPE(path)
    return _CODECS[path]


def _in_parts(found, size: int = 8 << 20):
    """Batches (key, data) of about size bytes, so that ids of long texts do not pile up."""
    keys, data, held = [], [], 0
    for k, d in found:
        keys.append(k)
        data.append(d)
        held += len(d)
        if held >= size:
            yield keys, data
            keys, data, held = [], [], 0
    if keys:
        yield keys, data


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, ids): the ids of every whole text as little-endian unsigned 32-bit integers."""
    small_batches(docs.sparkSession)
    path = vocabulary or default_vocabulary()

    def run(batches):
        for b in batches:
            found = zip(b.column(0).to_pylist(), (codec(path).encode(t.as_py()) for t in b.column(1)), strict=True)
            for keys, ids in _in_parts(found):
                yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(0).type), pa.array(ids, pa.binary())], names=["key", "ids"])

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids binary").withColumnRenamed("key", key)


def decode(encoded: DataFrame, ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """encoded with a column data, the bytes that its ids stand for (null where they are null)."""
    small_batches(encoded.sparkSession)
    path = vocabulary or default_vocabulary()
    at = encoded.columns.index(ids)

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        data = [None if x is None else codec(path).decode(x) for x in b.column(at).to_pylist()]
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(data, pa.binary())], names=[*b.schema.names, "data"])

    fields = ", ".join(f"`{c}` {t}" for c, t in encoded.dtypes)
    return encoded.mapInArrow(per_batch(lambda: one), f"{fields}, data binary")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, counted and digested, and the digest of what they decode to."""
    both = decode(encode(table(spark, sf_dir, "documents")))
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))
