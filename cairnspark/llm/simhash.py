"""SimHash near-duplicates by multi-index hashing.

A fingerprint has two segments of 32 bits. Two fingerprints that differ in at most
three bits differ in at most one bit of one segment, so every fingerprint is stored
under both its segments and looked up under each segment's Hamming ball of radius
one; matches are verified on all 64 bits. Single-bit probes only flip a 0 to a 1: of
two segments that differ in one bit exactly one has a 0 there.

Only distinct fingerprints take part, so exact copies cost nothing. Where many
distinct fingerprints share a segment (a group of near copies), pairs are not
enumerated: such a bucket is linked exactly, in rows linear in its size, by means of
meeting points (see _hot_links).

Edge cases: null text is an empty text; no words: fingerprint 0, linked like any other;
fewer than 3 words: one shingle of them all; repeated rows repeat; a null key never
becomes a component id unless a component has no other; an empty table gives an empty
result; columns of the input other than key and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm.common import MARK_BYTES, attach, cut, per_batch, small_batches, table, text_mark, uncut
from cairnspark.llm.components import connected_components

SHINGLE, SEED, MAX_BITS, HOT_BUCKET = 3, 42, 3, 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    return fingerprint_of((text or "").encode("utf-8", "surrogatepass").lower().split(), shingle)


def signed(fp: int) -> int:
    """A fingerprint's bits as a signed long."""
    return fp - (1 << 64) if fp >> 63 else fp


def fingerprint_of(words: list[bytes], shingle: int = SHINGLE) -> int:
    """fingerprint of a text's lower-case words."""
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = [b" ".join(words)] if n == 1 else map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(x, SEED) for x in joined), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = np.ascontiguousarray(hashes[i : i + (1 << 16)]).astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _print_batch():
    def f(b: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(prints, pa.int64())], names=["key", "fp"])

    return f


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): fp is the fingerprint's 64 bits as a signed long."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(per_batch(_print_batch), "key long, fp long")


def _halves(fp: Column) -> list[Column]:
    return [F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(0xFFFFFFFF))]


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _flips(value: Column, ones_only: bool = False, bits: int = 32) -> Column:
    """Masks of the single bits of value that are 0 (or all single bits)."""
    masks = F.array(*[F.lit(1 << i) for i in range(bits)])
    return masks if ones_only else F.filter(masks, lambda m: value.bitwiseAND(m) == 0)


def links(prints: DataFrame) -> DataFrame:
    """(u, v): links between distinct fingerprints (column fp) that join all that lie within three bits.

    Every component of the exact three-bit graph is a component of these links, and no other
    vertices are joined. Cold buckets give each verified pair; hot ones a linear number of links.
    """
    nodes = prints.select("fp")
    stored = nodes.select(
        "fp", F.posexplode(F.array(*_halves(F.col("fp")))).alias("seg", "value")
    )
    size = stored.groupBy("seg", "value").agg(F.count("*").alias("n"))
    hot = cut(size.filter(F.col("n") > HOT_BUCKET).select("seg", "value"))
    cold = stored.join(hot, ["seg", "value"], "left_anti")
    probes = stored.select(
        "seg",
        F.col("fp").alias("u"),
        F.explode(F.concat(F.array(F.lit(0).cast("long")), _flips(F.col("value")))).alias("mask"),
        "value",
    ).select("seg", "u", F.col("value").bitwiseXOR(F.col("mask")).alias("value"), (F.col("mask") == 0).alias("same"))
    # Spark's estimate of probes leaves out that each row was made 17, so it would broadcast a table that it takes for a small one
    matched = probes.join(cold.withColumnRenamed("fp", "v").hint("merge"), ["seg", "value"])
    near = (_distance("u", "v") <= MAX_BITS) & (F.col("u") != F.col("v"))
    pairs = matched.filter(near & (~F.col("same") | (F.col("u") < F.col("v")))).select("u", "v")
    return pairs.unionByName(_hot_links(stored, probes, hot)) if hot.limit(1).count() else pairs


def _hot_links(stored: DataFrame, probes: DataFrame, hot: DataFrame) -> DataFrame:
    """Links of the hot buckets: those that store more than HOT_BUCKET fingerprints under one segment value.

    Let e be 0 for a stored fingerprint and 1 for one that probes the bucket with one bit flipped.
    A pair with at least one stored member lies within three bits if the other halves differ in at
    most 3 - e bits. For each point of the other half's space, near holds who is within one bit of it and
    far who is within 3 - 1 - e bits; a member of near with any member of far is a true link, and
    every true link has such a point on its way. So a star from one near member to all near and far
    members of its point keeps the connections. Stored members reach out two bits and probing ones one.
    """
    members = stored.withColumnRenamed("fp", "u").withColumn("same", F.lit(True)).unionByName(
        probes.filter(~F.col("same")).select("u", "seg", "value", "same")
    )
    members = members.join(hot, ["seg", "value"]).withColumn(
        "rest", F.when(F.col("seg") == 0, _halves(F.col("u"))[1]).otherwise(_halves(F.col("u"))[0])
    )
    one = _flips(F.col("rest"), ones_only=True)
    two = F.array(*[F.lit((1 << i) | (1 << j)) for i in range(32) for j in range(i)])
    none = F.array(F.lit(0).cast("long"))
    # a stored fingerprint is near within one bit, and far at two; one that probes is far within one bit
    reach = F.when(F.col("same"), F.concat(none, one, two)).otherwise(F.concat(none, one))
    points = members.select("seg", "value", "u", "same", "rest", F.explode(reach).alias("step")).select(
        "seg",
        "value",
        F.col("rest").bitwiseXOR(F.col("step")).alias("point"),
        "u",
        (F.col("same") & (F.bit_count("step") <= 1)).alias("near"),
    )
    centres = points.groupBy("seg", "value", "point").agg(
        F.min(F.when(F.col("near"), F.col("u"))).alias("v"), F.count("*").alias("n")
    ).filter((F.col("n") > 1) & F.col("v").isNotNull())
    stars = points.join(centres.hint("merge"), ["seg", "value", "point"]).filter(F.col("u") != F.col("v"))
    return stars.select("u", "v").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint as 16 hex digits, component_id): every row of docs with its near-duplicate component."""
    prints = cut(fingerprints(docs, key, text))
    classes = cut(prints.groupBy("fp").agg(F.min("key").alias("first"), F.count("*").alias("n")))
    edges = cut(links(classes))
    labels = connected_components(edges, classes.select(F.col("fp").alias("node"), F.col("first").alias("label")))
    uncut(edges)
    named = cut(
        classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "n", F.coalesce("label", "first").alias("component_id")
        )
    )
    return attach(prints, named.drop("n"), ["fp"], named.select("fp", "n"), F.xxhash64("key"), "inner").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that represent their near copies (fingerprints and bands, verified on five-word shingles at 0.8: see nearcopies); rows with the
    same key and text stay or go together. Up to MARK_BYTES of what goes is broadcast, so that no text moves."""
    from cairnspark.llm.nearcopies import near_copies  # it takes its first candidates from this module

    found = near_copies(docs, key, text)
    gone = cut(found.filter(~F.col("kept")).select(F.col(key).alias("_key"), F.col("mark").alias("_mark")).distinct())
    uncut(found)
    gone = F.broadcast(gone) if gone.count() * 24 <= MARK_BYTES else gone
    same = F.col(f"`{key}`").cast("long").eqNullSafe(F.col("_key")) & (text_mark(F.col(f"`{text}`")) == F.col("_mark"))
    return docs.join(gone, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
