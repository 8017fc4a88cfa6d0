"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.functions.joins import BROADCAST_BYTES, HEAVY, PARTS, attach  # noqa: F401  shared with the operators
from cairnspark.functions.session import cut, shared_folder, table, uncut  # noqa: F401

#: Java regex class body of the white space that ends a word, and the characters themselves.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Up to so many bytes of hashes are broadcast, so that no text moves.
MARK_BYTES = 32 << 20


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound the rows of an Arrow batch, so that long texts do not pile up in a Python worker.

    Also lets workers import this package from the driver's path where they share it; elsewhere
    it is installed or shipped with --py-files.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    here, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), here]))


def give_back() -> None:
    """Hand freed memory back to the system: after many small objects the C library keeps it, and the driver's JVM runs beside it. Without glibc nothing happens."""
    gc.collect()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate value once and use it in body any number of times, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Array of the maximal runs of non-white-space; null and blank texts give an empty array."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))


def per_batch(make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> Callable:
    """A mapInArrow function: make() runs once in each task and returns the function for one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            if b.num_rows:
                yield f(b)

    return run


def text_mark(text: Column) -> Column:
    """Hash of a text; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))
