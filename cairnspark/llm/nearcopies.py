"""Near copies by exact similarity of five-word shingles.

Two documents are near copies if the Jaccard similarity of their sets of SHINGLE-word shingles is at
least SIMILARITY; components of that relation are the near-duplicate groups. The three-bit radius of
the SimHash query reaches the closest of them: fingerprints within three bits, found by multi-index hashing (simhash.links), give the
first candidates. Others differ in about ten bits, a radius that is no longer selective, so more candidates come from BANDS bands of ROWS
minimum hashes: a pair at the threshold shares no band with probability (1 - 0.8^5)^24 = 7e-5. Each candidate is verified on
the shingle sets themselves (as 64-bit hashes).

Equal word sequences are one node. Buckets of at most HOT_BUCKET nodes give all their pairs. A larger
bucket is first compared with one centre, so its rows stay linear in its size (the same order of nodes chooses the
centres of all bands, so a group has few of them). Buckets whose nodes then lie in several
components are compared in full, but first by sketches: the low bytes of the BANDS * ROWS minimum hashes, of which a pair at the threshold
shares fewer than LIKELY with probability under 1e-4. Only these 120 bytes a node, and no sets, are dealt to
pairs of blocks of about SKETCH_NODES; what they leave is verified like other candidates. A pair of blocks that leaves more than FEW
pairs a node, as in a group of texts that are all a little less alike than the threshold, is compared
exactly, in blocks of at most about BLOCK_BYTES and BLOCK_NODES: each pair of these is one group, which counts the common shingles of
all its pairs as a matrix product and returns only the links that join components. So no pairs become rows without bound.

Edge cases: null text is an empty text, and all texts without words are copies; fewer than SHINGLE words:
one shingle of them all; repeated rows repeat; null keys as in simhash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnspark.llm import simhash
from cairnspark.llm.common import MARK_BYTES, attach, cut, per_batch, small_batches, text_mark, uncut
from cairnspark.llm.components import connected_components

SHINGLE, SIMILARITY, SEED, BANDS, ROWS, HOT_BUCKET = 5, 0.8, 42, 24, 5, 2
BLOCK_BYTES, BLOCK_NODES = 4 << 20, 1024
SKETCH_NODES, LIKELY, FEW = 2048, 0.64, 4

_RNG = np.random.default_rng(SEED)
_FACTORS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64)[:, None]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - shingle + 1)
    joined = [b" ".join(words)] if n == 1 else map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(x, SEED) for x in joined), np.uint64, n))


def node_of(words: list[bytes]) -> int:
    """A text's node: 64 bits of the digest of its word sequence."""
    return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The BANDS * ROWS minimum hashes of a text with words."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 2048):  # bounded memory for very long texts
        np.minimum(least, (_FACTORS * hashes[i : i + 2048] + _SHIFTS).min(axis=1), out=least)
    return least.astype("<u8")


def bands(least: np.ndarray) -> list[int]:
    """One bucket number for each band."""
    rows = least.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(r.tobytes(), i) - (1 << 63) for i, r in enumerate(rows)]


def _print_batch():
    def f(b: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for t in b.column(1).to_pylist():
            words = words_of(t)
            hashes = shingles(words)
            least = minima(hashes) if len(hashes) else None
            # the highest byte of a minimum is zero more often than not, the lowest is even
            found.append((node_of(words), len(hashes), [], b"", 0) if least is None else (
                node_of(words), len(hashes), bands(least), least.view(np.uint8)[::8].tobytes(), simhash.signed(simhash.fingerprint_of(words))))
        columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64()), strict=True)]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(2), *columns], names=["key", "mark", "node", "size", "bands", "sketch", "fp"])

    return f


def _set_batch():
    def f(b: pa.RecordBatch) -> pa.RecordBatch:
        words = [words_of(t) for t in b.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([node_of(w) for w in words], pa.int64()), pa.array([shingles(w).tobytes() for w in words], pa.binary())],
            names=["node", "hashes"],
        )

    return f


def jaccard(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def _verify_batch():
    def f(b: pa.RecordBatch) -> pa.RecordBatch:
        a, c = (b.column(i).to_pylist() for i in (2, 3))
        near = pa.array([jaccard(x, y) >= SIMILARITY for x, y in zip(a, c, strict=True)], pa.bool_())
        return pa.RecordBatch.from_arrays([b.column(0).filter(near), b.column(1).filter(near)], names=["u", "v"])

    return f


def _join(rows: DataFrame, side: DataFrame, on: str, spread: str) -> DataFrame:
    """rows joined with side (one row for each value of on, n counts its rows), heavy values in parts."""
    return attach(rows, side, [on], side.select(on, "n"), F.xxhash64(spread), "inner")


def _sets(docs: DataFrame, text: str, needed: DataFrame, marks: DataFrame) -> DataFrame:
    """(node, hashes) of the nodes in needed, once each; marks (node, mark) has one text's hash for each node.

    Texts are chosen by their hash before a worker reads them. Up to MARK_BYTES of hashes are broadcast, so that no text moves; beyond that, texts are
    joined with them by a shuffle.
    """
    chosen = cut(needed.distinct().join(marks, "node").select("mark").distinct())
    side = F.broadcast(chosen) if chosen.count() * 16 <= MARK_BYTES else chosen
    texts = docs.select(F.col(text).alias("text"), text_mark(F.col(text)).alias("mark")).join(side, "mark", "left_semi").select("text")
    sets = cut(texts.mapInArrow(per_batch(_set_batch), "node long, hashes binary").dropDuplicates(["node"]))
    uncut(chosen)
    return sets


def _verified(pairs: DataFrame, docs: DataFrame, text: str, marks: DataFrame) -> DataFrame:
    """The pairs (u, v) whose shingle sets are similar enough."""
    pairs = cut(pairs.distinct())
    sets = _sets(docs, text, pairs.select(F.explode(F.array("u", "v")).alias("node")), marks)
    centres = cut(pairs.groupBy("v").agg(F.count("*").alias("n")).join(sets.select(F.col("node").alias("v"), F.col("hashes").alias("b")), "v"))
    first = pairs.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("a")), "u")
    both = _join(first, centres, "v", "u").select("u", "v", "a", "b")
    found = cut(both.mapInArrow(per_batch(_verify_batch), "u long, v long"))
    uncut(pairs, sets, centres)
    return found


def joining_links(nodes: list[int], roots: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between similar sets of different roots, as many as join all roots that they can join."""
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    place = np.full(len(count), -1, np.int64)
    place[shared] = np.arange(len(shared))
    at = place[token]
    row, at = row[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, len(shared), 2048):  # bounded memory: some shingles at a time
        part = slice(*np.searchsorted(at, [low, low + 2048]))
        has = np.zeros((len(sets), min(2048, len(shared) - low)), np.float32)
        has[row[part], at[part] - low] = 1
        both += has @ has.T
    size = np.array([len(x) for x in sets], np.float64)
    root = np.array(roots)
    near = both / (size[:, None] + size[None, :] - both) >= SIMILARITY
    u, v = np.nonzero(np.triu(near & (root[:, None] != root[None, :]), 1))
    parent = {r: r for r in roots}

    def find(r: int) -> int:
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    out = []
    for i, j in zip(u.tolist(), v.tolist(), strict=True):
        a, b = find(roots[i]), find(roots[j])
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((nodes[i], nodes[j]))
    return out


def _block_links(block: pa.Table) -> pa.Table:
    sets = [np.frombuffer(x, np.uint64) for x in block.column("hashes").to_pylist()]
    found = joining_links(block.column("node").to_pylist(), block.column("root").to_pylist(), sets)
    return pa.table({"u": pa.array([a for a, _ in found], pa.int64()), "v": pa.array([b for _, b in found], pa.int64())})


def _dealt(split: DataFrame, k) -> DataFrame:
    """split with each node once for each pair of blocks (lo, hi) that it is in; own says which of the two it comes from."""
    own = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
    placed = split.withColumn("k", k.cast("int")).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    return placed.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("k", "other")


def likely_pairs(sketches: np.ndarray, sizes: np.ndarray, roots: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Index pairs of different roots whose sketches share LIKELY of their bytes: of the first rows with the others, or of all if there are no others."""
    a = np.flatnonzero(first)
    b = np.flatnonzero(~first)
    within = not len(b)
    b = a if within else b
    same = np.zeros((len(a), len(b)), np.uint8)
    for c in range(sketches.shape[1]):
        same += sketches[a, c][:, None] == sketches[b, c][None, :]
    near = (same >= LIKELY * sketches.shape[1]) & (roots[a][:, None] != roots[b][None, :])
    small, large = np.minimum(sizes[a][:, None], sizes[b][None, :]), np.maximum(sizes[a][:, None], sizes[b][None, :])
    near &= small >= large * SIMILARITY - 1e-6
    if within:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    return np.stack([a[i], b[j]], axis=1)


def _sketch_pairs(block: pa.Table) -> pa.Table:
    column = lambda c: block.column(c).to_numpy()
    sketches = np.frombuffer(b"".join(block.column("sketch").to_pylist()), np.uint8).reshape(block.num_rows, -1)
    found = likely_pairs(sketches, column("size"), column("root"), column("own") == column("lo"))
    node = column("node")
    if len(found) > FEW * block.num_rows:
        return pa.table({"bucket": block.column("bucket")[:1], "dense": pa.array([True]), "u": pa.array([None], pa.int64()), "v": pa.array([None], pa.int64())})
    n = len(found)
    return pa.table({
        "bucket": pa.array([block.column("bucket")[0].as_py()] * n, pa.int64()), "dense": pa.array([False] * n, pa.bool_()),
        "u": pa.array(node[found[:, 0]] if n else [], pa.int64()), "v": pa.array(node[found[:, 1]] if n else [], pa.int64())})


def _links_in_blocks(split: DataFrame, sketches: DataFrame, docs: DataFrame, text: str, marks: DataFrame) -> DataFrame:
    """Links between the components of each bucket; split has (bucket, node, size, root, bytes, n) of all nodes of such buckets."""
    placed = _dealt(split, F.ceil(F.col("n") / SKETCH_NODES)).join(sketches, "node")
    near = cut(placed.select("bucket", "node", "size", "root", "own", "lo", "hi", "sketch").groupBy("bucket", "lo", "hi").applyInArrow(
        _sketch_pairs, "bucket long, dense boolean, u long, v long"))
    pairs = near.filter("NOT dense").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    found = _verified(pairs, docs, text, marks)
    dense = near.filter("dense").select("bucket").distinct()
    if not dense.isEmpty():
        found = found.unionByName(_exact_blocks(split.join(dense, "bucket", "left_semi"), docs, text, marks))
    uncut(near, split)
    return found


def _exact_blocks(split: DataFrame, docs: DataFrame, text: str, marks: DataFrame) -> DataFrame:
    k = F.greatest(F.ceil(F.col("bytes") / BLOCK_BYTES), F.ceil(F.col("n") / BLOCK_NODES))
    sets = _sets(docs, text, split.select("node"), marks)
    filled = _dealt(split, k).select("bucket", "lo", "hi", "node", "root").join(sets, "node")
    found = cut(filled.groupBy("bucket", "lo", "hi").applyInArrow(_block_links, "u long, v long"))
    uncut(sets)
    return found


def _alike(a: str, b: str):
    """Whether sets of these sizes can be similar enough."""
    return F.least(a, b) >= F.greatest(a, b) * SIMILARITY - 1e-6


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """(u, v, k, l): nodes whose SimHash fingerprints link, and their sizes; a fingerprint's nodes are linked with one of them."""
    one = cut(nodes.groupBy("fp").agg(F.min_by(F.struct("node", "size"), F.xxhash64("node")).alias("o"), F.count("*").alias("n")))
    same = attach(nodes.select("fp", "node", "size"), one.drop("n"), ["fp"], one.select("fp", "n"), F.xxhash64("node"), "inner").filter("node <> o.node").select(
        F.col("node").alias("u"), F.col("o.node").alias("v"), F.col("size").alias("k"), F.col("o.size").alias("l"))
    side = lambda c: one.select(F.col("fp").alias(c), F.col("o").alias(f"_{c}"))
    apart = cut(simhash.links(one)).join(side("u"), "u").join(side("v"), "v")
    return same.unionByName(apart.select(F.col("_u.node").alias("u"), F.col("_v.node").alias("v"), F.col("_u.size").alias("k"), F.col("_v.size").alias("l")))


def links(nodes: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(u, v): verified links that join all candidates of similarity SIMILARITY; nodes has (node, size, bands, sketch, fp, first)."""
    marks = nodes.select("node", F.col("first.mark").alias("mark"))
    stored = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    buckets = stored.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min_by(F.struct("node", "size"), F.xxhash64("node")).alias("centre")
    )
    members = cut(_join(stored, cut(buckets.filter("n > 1")), "bucket", "node"))
    cold = members.filter(F.col("n") <= HOT_BUCKET).groupBy("bucket").agg(F.sort_array(F.collect_set(F.struct("node", "size"))).alias("m"))
    pairs = cold.select(F.posexplode("m").alias("at", "x"), "m").select(
        "x", F.explode(F.slice("m", F.col("at") + 2, F.size("m"))).alias("y")
    ).select(F.col("x.node").alias("u"), F.col("y.node").alias("v"), F.col("x.size").alias("k"), F.col("y.size").alias("l"))
    hot = members.filter(F.col("n") > HOT_BUCKET)
    stars = hot.select(F.col("node").alias("u"), F.col("centre.node").alias("v"), F.col("size").alias("k"), F.col("centre.size").alias("l")).filter("u <> v")
    found = _verified(fingerprint_pairs(nodes).unionByName(pairs).unionByName(stars).filter(_alike("k", "l")).select("u", "v"), docs, text, marks)
    if not hot.limit(1).count():
        return found
    roots = connected_components(found, nodes.select("node", F.col("node").alias("label")))
    hot = cut(hot.join(roots, "node", "left").select("bucket", "node", "size", F.coalesce("label", "node").alias("root")))
    torn = cut(hot.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.col("size") * 8).alias("bytes"), F.min("root").alias("a"), F.max("root").alias("b"))
               .filter("a <> b").drop("a", "b"))
    split = cut(_join(hot, torn, "bucket", "node"))
    uncut(members, hot, torn)
    return found.unionByName(_links_in_blocks(split, nodes.select("node", "sketch"), docs, text, marks))


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, mark, component_id, kept): every row of docs with the smallest key of its near copies, and whether its group is represented by it.

    mark is the hash of its text. Of each group the rows of one key and text are kept: the smallest key, and of its texts that with the
    smallest hash, so a text whose key another text shares does not go for the other's sake.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), text_mark(F.col(text)).alias("mark"))
    prints = cut(rows.mapInArrow(per_batch(_print_batch), "key long, mark long, node long, size long, bands array<long>, sketch binary, fp long"))
    one = F.struct(F.col("key").isNull().alias("none"), "key", "mark")
    nodes = cut(prints.groupBy("node").agg(
        F.min(one).alias("first"), F.count("*").alias("n"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("fp").alias("fp")))
    labels = connected_components(links(nodes, docs, text), nodes.select("node", F.col("first").alias("label")))
    named = cut(nodes.select("node", "n", "first").join(labels, "node", "left").select("node", "n", F.coalesce("label", "first").alias("first")))
    uncut(nodes, labels)
    kept = F.col("key").eqNullSafe(F.col("first.key")) & (F.col("mark") == F.col("first.mark"))
    out = cut(_join(prints.select("key", "mark", "node"), named, "node", "key").select(
        F.col("key").alias(key), "mark", F.col("first.key").alias("component_id"), kept.alias("kept")))
    uncut(prints, named)
    return out
