"""Packing of documents into training sequences by Karmarkar-Karp multiway differencing.

A document's ids, closed by an end id, are cut into pieces. Pieces of a whole window
are sequences of their own. What is left of each document is cut into parts of at most
part tokens, and the parts of a few hundred documents at a time are partitioned into
near-equal windows: the two partial partitions with the largest differences are merged
with their loads in opposite order until one is left. If a window then exceeds the
capacity, the number of windows rises by one and the differencing starts again.

Everything happens in one pass over the partitions of the input, without a shuffle,
with the tokens of one block in memory. A retried task gives the same rows again.
Edge cases: null or empty text: the end id alone; null keys and repeated rows are
packed like others; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm.common import small_batches, table
from cairnspark.llm.tokens import default_vocabulary, token_ids

CAPACITY, PART, END_ID = 2048, 512, 1
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
_TYPES = [pa.int64()] * 6 + [pa.binary()]


def difference(lengths: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp partition of the indexes of lengths into k groups of near-equal sums."""
    heap = []
    for i, n in enumerate(lengths):
        loads = np.zeros(k, np.int64)
        loads[0] = n  # loads fall; groups run along with them
        heap.append((-n, i, loads, [i] + [None] * (k - 1)))
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, a, ga = heapq.heappop(heap)
        _, _, b, gb = heapq.heappop(heap)
        loads = a + b[::-1]
        order = np.argsort(-loads, kind="stable")
        loads = loads[order] - loads.min()
        both = [y if x is None else x if y is None else (x, y) for x, y in zip(ga, reversed(gb), strict=True)]
        heapq.heappush(heap, (-int(loads[0]), serial, loads, [both[i] for i in order]))
        serial += 1
    groups = []
    for g in heap[0][3] if heap else []:
        flat, stack = [], [] if g is None else [g]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack.extend(x)
            else:
                flat.append(x)
        groups.append(sorted(flat))
    return groups


def windows(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Groups of indexes whose sums do not exceed capacity; no length may exceed it."""
    k = max(1, -(-sum(lengths) // capacity))
    while True:
        groups = difference(lengths, k)
        if all(sum(lengths[i] for i in g) <= capacity for g in groups):
            return [g for g in groups if g]
        k += 1


class _Packer:
    def __init__(self, partition: int, capacity: int, part: int):
        self.next, self.capacity, self.part = partition << 40, capacity, part
        self.block: list[tuple] = []
        self.total = 0
        self.out: list[tuple] = []
        self.out_bytes = 0

    def add(self, key, ids: np.ndarray) -> None:
        n, at = len(ids), 0
        while n - at >= self.capacity:
            self._sequence([(key, at, n, ids[at : at + self.capacity])])
            at += self.capacity
        while at < n:
            piece = ids[at : at + self.part]
            self.block.append((key, at, n, piece))
            self.total += len(piece)
            at += len(piece)
        # a block ends where its sum leaves a little room in the last window
        if len(self.block) >= 900 or (len(self.block) >= 400 and 16 <= -self.total % self.capacity <= 160):
            self.close()

    def close(self) -> None:
        if self.block:
            for g in windows([len(x[3]) for x in self.block], self.capacity):
                self._sequence([self.block[i] for i in g])
        self.block, self.total = [], 0

    def _sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for key, start, n, ids in pieces:
            self.out.append((key, start, len(ids), n, self.next, offset, ids.tobytes()))
            offset += len(ids)
        self.out_bytes += 4 * offset
        self.next += 1

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.out, strict=True)
        self.out, self.out_bytes = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def pack(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, part: int = PART,
    end_id: int = END_ID, vocabulary: str | None = None,
) -> DataFrame:
    """One row for each piece, with its token ids (little-endian unsigned 32-bit) and its place in a sequence."""
    small_batches(docs.sparkSession)
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(TaskContext.get().partitionId(), capacity, min(part, capacity))
        end = np.array([end_id], "<u4")
        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                packer.add(k, np.concatenate([token_ids(t.as_py(), path), end]))
                if packer.out_bytes >= 1 << 22:
                    yield packer.batch()
        packer.close()
        if packer.out:
            yield packer.batch()

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def pack_report(docs: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    names = ["doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"]
    return pack(docs).select(*names)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_report(table(spark, sf_dir, "documents"))
