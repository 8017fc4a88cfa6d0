"""Document fingerprints: quartile bucket digests of hashed byte triplets.

Three kinds of byte triplets from a sliding window of four are hashed into 256 buckets. The
digest holds a length code, two quartile ratios and for each bucket the quartile of its
count, 67 bytes as hex. Two digests differ by a bounded sum over buckets (a step of
three counts six) plus a little for length and ratios; likeness is 1 for equal digests
and 0 where the sum reaches what independent digests have on average.

Edge cases: null is the empty text; texts under four bytes are padded by zero bytes; equal
texts have equal digests; an empty table gives an empty result; with repeated keys the
order is by falling key, then by falling hash of the text; null keys come last; only key and text are read.
Rows that are alike in key and text lie in one range, as nothing tells them apart.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnspark.llm.common import small_batches, table

BUCKETS, RANGE_BYTES = 256, 256 << 20
_CHANCE = BUCKETS * 26 / 16  # mean difference of independent quartile codes: steps 0, 1, 2, 6 at 4, 6, 4, 2 of 16
_STEP = np.array([[(0, 1, 2, 6)[abs(i - j)] for j in range(4)] for i in range(4)])
_PAIRS = np.array(
    [[sum(int(_STEP[a >> s & 3, b >> s & 3]) for s in (0, 2, 4, 6)) for b in range(256)] for a in range(256)], np.int32
)


def _buckets(raw: bytes) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(1, len(raw) - 3), 1 << 20):  # bounded memory for very long texts
        x = np.frombuffer(raw[at : at + (1 << 20) + 3].ljust(4, b"\0"), np.uint8).astype(np.uint32)
        a, b, c, d = x[:-3] * np.uint32(0x9E3779B1), x[1:-2], x[2:-1], x[3:]
        bc = b * np.uint32(0x85EBCA77)
        cd = c * np.uint32(0xC2B2AE3D)
        for h in (a + bc + cd, a + bc + d * np.uint32(0x27D4EB2F), a + cd + d * np.uint32(0x165667B1)):
            h *= np.uint32(0x2C1B3C6D)
            h >>= np.uint32(24)
            counts += np.bincount(h, minlength=BUCKETS)
    return counts


def digest(text: str | None) -> str:
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = _buckets(raw)
    q1, q2, q3 = (int(q) for q in np.sort(counts)[[63, 127, 191]])
    code = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    body = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    length = min(255, round(8 * math.log2(len(raw) + 1)))
    top = max(q3, 1)
    return bytes([length, q1 * 255 // top, q2 * 255 // top]).hex() + body.tobytes().hex()


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 for those that differ as much as independent ones or more."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(s), np.uint8).astype(np.int32) for s in (a, b))
    apart = _PAIRS[x[3:], y[3:]].sum() + min(12, abs(x[0] - y[0]) / 8) + (abs(x[1] - y[1]) + abs(x[2] - y[2])) / 32
    return float(max(0.0, 1 - max(apart, 1e-6) / _CHANCE))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, next_text): next in descending order of the key, after the last the first; null texts empty.

    Rows are cut into ranges of (key, hash of the text) that hold about RANGE_BYTES each, and the first row of each
    range is also sent to the range before it, so the neighbour is found within a range and no task sees
    all rows. A range is also a shuffle partition. The driver holds four longs for each range, and tasks get them as a broadcast
    variable: 400,000 ranges and 13 MB at 100 TB.
    """
    least = -(2**63)
    rows = docs.select(
        F.col(key).cast("long").alias("key"),
        F.coalesce(F.col(key).cast("long"), F.lit(least)).alias("at"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("mark", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 40)).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES + 1)
    order = F.struct("at", "mark")
    ranged = rows.select("at", "mark").repartitionByRange(n, "at", "mark").groupBy(F.spark_partition_id()).agg(F.min(order).alias("l"), F.max(order).alias("h"))
    bounds = ranged.select("l.*", F.col("h.at").alias("at2"), F.col("h.mark").alias("mark2")).toPandas().sort_values(["at", "mark"])
    low_at, low_mark, high_at, high_mark = (bounds[c].to_numpy(np.int64) for c in ("at", "mark", "at2", "mark2"))
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((low_at, low_mark, high_at, high_mark))

    @F.pandas_udf("array<long>")
    def places(at: pd.Series, mark: pd.Series) -> pd.Series:
        """The range of a row, and if it is the largest of its range, the range that comes before it."""
        low_at, low_mark, high_at, high_mark = shared.value
        a, m = at.to_numpy(), mark.to_numpy()
        first, last = np.searchsorted(low_at, a, side="left"), np.searchsorted(low_at, a, side="right")
        i = last - 1
        for r in np.flatnonzero(last > first):  # ranges that begin at this key, told apart by the hash
            i[r] = first[r] + np.searchsorted(low_mark[first[r] : last[r]], m[r], side="right") - 1
        i = np.maximum(i, 0)
        tops = (high_at[i] == a) & (high_mark[i] == m)
        return pd.Series([[r, (r + 1) % len(low_at)] if t else [r] for r, t in zip(i.tolist(), tops, strict=True)])

    dealt = rows.select("*", F.posexplode(places("at", "mark")).alias("tail", "range")).repartition(n, "range")
    falling = Window.partitionBy("range").orderBy("tail", F.desc("at"), F.desc("mark"))
    return dealt.withColumn("next_text", F.lead("text").over(falling)).filter("tail = 0").select("key", "text", "next_text")


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Digests of every text and of its edited text, whose last half is replaced by the start of the next text."""
    rows = with_next(docs)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))

    @F.pandas_udf("fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    def digests(text: pd.Series, edited_text: pd.Series, following: pd.Series) -> pd.DataFrame:
        out, known = [], ("", digest(""))
        for t, e, f in zip(text, edited_text, following, strict=True):
            a = known[1] if t == known[0] else digest(t)  # rows come in order: this text is often the last row's next
            known = (f, digest(f))
            b = digest(e)
            out.append((a, b, likeness(a, b), likeness(a, known[1])))
        return pd.DataFrame(out, columns=["fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    small_batches(docs.sparkSession, 200)
    made = rows.select("key", "text", "next_text", n.cast("long").alias("n_chars"), edited.alias("edited"))
    return made.select(
        F.col("key").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        digests("text", "edited", "next_text").alias("d"),
    ).select("doc_id", "n_chars", "edited_sha256", "d.*")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(table(spark, sf_dir, "documents"))
