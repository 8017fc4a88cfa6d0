"""Alignment of two tokenizers' tokens over whole texts, and how often their ids are linked in the corpus.

Both encode a space and the text: A by byte-level BPE, B by a piece model, which adds the space itself. An
offset where a token of each ends is a shared cut. Cuts are found by divide and conquer: an interval of A's
tokens is probed at its middle token, whose end is sought among B's ends by bisection; if it is no cut, its
neighbours and then the rest of the interval give the cut nearest to the middle. The interval is divided there and
both halves go on; an interval without a cut becomes one group. All intervals of a level, over all texts of a
chunk, are probed together; the end of a text is a cut of its own kind, known from the start. The work is
n log n in the tokens of a chunk also where a text has no cut at all.

Links are the pairs of an A and a B token whose bytes overlap. A document's distinct pairs are kept with their
number of links in one table. Their counts over all documents are aggregated by Spark with partial sums; of these the HEAD_PAIRS most
frequent at most are broadcast, the rest are joined by a shuffle, in which no pair is frequent. So both the
hot pairs and the long tail take part, and nothing but the head and one number for each A id is held whole.

Edge cases: texts that are null, empty, or whose tokens' joined bytes differ from space and text have no tokens:
zeros and the empty string; repeated rows and null keys give a row each and each counts as a document; an empty
table gives an empty result; columns other than key and text are not read.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.functions.session import fresh_folder
from cairnspark.llm.common import cut, small_batches, table
from cairnspark.llm.tokens import default_vocabulary, encoding

#: At most so many pairs, the most frequent ones, are broadcast. Texts are aligned in chunks of about CHUNK characters.
HEAD_PAIRS, CHUNK = 1 << 18, 1 << 18
_SPACE = "▁"


class Pair:
    """Two tokenizers: ids of a text and the bytes of each id."""

    def __init__(self, ranks: str, pieces: str):
        self.a, self.b = encoding(ranks), sentencepiece.SentencePieceProcessor(model_file=pieces)
        n = self.a.n_vocab
        special = {i for t, i in ((t, self.a.encode_single_token(t)) for t in self.a.special_tokens_set)}
        self.bytes_a = _objects(b"" if i in special else self.a.decode_single_token_bytes(i) for i in range(n))
        sp = self.b
        self.bytes_b = _objects(
            bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i) else p.replace(_SPACE, " ").encode()
            for i, p in ((i, sp.id_to_piece(i)) for i in range(sp.get_piece_size())))
        self.length_a, self.length_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        # decimal ids with what follows them in a group: within it, and at its end
        self.said_a = [_objects(f"{i}{x}" for i in range(len(self.bytes_a))) for x in ",|"]
        self.said_b = [_objects(f"{i}{x}" for i in range(len(self.bytes_b))) for x in ",;"]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both, or none where they do not spell the text."""
        if text:
            a = self.a.encode_to_numpy(f" {text}", disallowed_special=()).astype(np.int64)
            b = np.array(self.b.encode(text, num_threads=1), np.int64)
            data = f" {text}".encode()
            if b"".join(self.bytes_a[a].tolist()) == data == b"".join(self.bytes_b[b].tolist()):
                return a, b
        return np.zeros(0, np.int64), np.zeros(0, np.int64)


def _objects(values) -> np.ndarray:
    values = list(values)
    out = np.empty(len(values), object)
    out[:] = values
    return out


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all indexes of the intervals lo to before hi, one after another; the number of the interval of each)."""
    n = hi - lo
    own = np.repeat(np.arange(len(lo)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - lo, n), own


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the rising offsets ends_a are also in ends_b; known: indexes of ends_a that are, the last one among them."""
    cuts = np.zeros(len(ends_a), bool)
    if not len(ends_a):
        return cuts
    cuts[known] = True

    def shared(at: np.ndarray) -> np.ndarray:
        place = np.searchsorted(ends_b, ends_a[at])
        return ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a[at]

    hi = np.flatnonzero(cuts)
    lo = np.concatenate([[0], hi[:-1] + 1])
    while len(lo := lo[keep := lo < hi]):
        hi = hi[keep]
        middle = (lo + hi) // 2
        found = np.full(len(lo), -1)
        for step in (0, 1, -1, 2, -2):
            at = middle + step
            open_ = np.flatnonzero((found < 0) & (at >= lo) & (at < hi))
            hit = open_[shared(at[open_])]
            found[hit] = at[hit]
        rest = np.flatnonzero((found < 0) & (hi - lo > 3))
        if len(rest):
            at, own = _ranges(lo[rest], hi[rest])
            hit = shared(at)
            at, own = at[hit], own[hit]
            order = np.lexsort((at, abs(at - middle[rest][own]), own))
            first = order[np.concatenate([[True], np.diff(own[order]) > 0])] if len(order) else order
            found[rest[own[first]]] = at[first]
        got = found >= 0  # an interval without a cut is a leaf
        lo, hi, found = lo[got], hi[got], found[got]
        cuts[found] = True
        lo, hi = np.concatenate([lo, found + 1]), np.concatenate([found, hi])
    return cuts


_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<struct<pair: long, links: int>>"
_PAIRS = pa.list_(pa.struct([("pair", pa.int64()), ("links", pa.int32())]))
_TYPES = [pa.int64()] * 4 + [pa.string(), _PAIRS]


def aligned(texts: list[str | None], pair: Pair) -> list[pa.Array]:
    """The columns of _ALIGNED for some texts."""
    both = [pair.tokens(t) for t in texts]
    n_a, n_b = (np.array([len(x[i]) for x in both], np.int64) for i in (0, 1))
    a, b = (np.concatenate([x[i] for x in both]) if both else np.zeros(0, np.int64) for i in (0, 1))
    # one line of bytes: each text goes on where the one before ends
    ends_a, ends_b = np.cumsum(pair.length_a[a]), np.cumsum(pair.length_b[b])
    last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
    cuts = shared_cuts(ends_a, ends_b, last_a[n_a > 0] - 1)
    doc_a = np.repeat(np.arange(len(texts)), n_a)
    n_groups = np.bincount(doc_a[cuts], minlength=len(texts))
    # where each A token's end lies among B's ends; at a cut that B token ends there too
    end = np.searchsorted(ends_b, ends_a)
    cut_a, cut_b = np.flatnonzero(cuts), end[cuts]
    closes_b = np.zeros(len(b), bool)
    closes_b[cut_b] = True
    group_a, group_b = np.cumsum(cuts) - cuts, np.cumsum(closes_b) - closes_b
    place_a = np.arange(len(a)) + np.concatenate([[0], cut_b + 1])[group_a]  # A tokens of a group come before its B tokens
    place_b = np.arange(len(b)) + (cut_a + 1)[group_b]
    said = np.empty(len(a) + len(b), object)
    said[place_a] = np.where(cuts, pair.said_a[1][a], pair.said_a[0][a])
    said[place_b] = np.where(closes_b, pair.said_b[1][b], pair.said_b[0][b])
    groups = ["".join(said[i:j].tolist())[:-1] for i, j in zip((last_a + last_b - n_a - n_b).tolist(), (last_a + last_b).tolist(), strict=True)]
    # the B tokens whose bytes overlap an A token: from the one that holds its first byte to the one that holds its last
    first = np.concatenate([[0], end + cuts])[:-1]
    other, own = _ranges(first, end + 1)
    n_links = np.bincount(doc_a, weights=end + 1 - first, minlength=len(texts)).astype(np.int64)
    code = (doc_a[own] << 40) | (a[own] * len(pair.bytes_b) + b[other])
    code, links = np.unique(code, return_counts=True)
    offsets = np.searchsorted(code >> 40, np.arange(len(texts) + 1))
    values = pa.StructArray.from_arrays([pa.array(code & ((1 << 40) - 1)), pa.array(links.astype(np.int32))], ["pair", "links"])
    pairs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
    return [*(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)), pa.array(groups, pa.string()), pairs.cast(_PAIRS)]


_PAIRS_OF: dict[tuple[str, str], Pair] = {}


def pair_of(ranks: str, pieces: str) -> Pair:
    if (ranks, pieces) not in _PAIRS_OF:
        _PAIRS_OF[ranks, pieces] = Pair(ranks, pieces)
    return _PAIRS_OF[ranks, pieces]


def default_pieces() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str | None = None, pieces: str | None = None) -> DataFrame:
    """One row for each text: (key, n_a, n_b, n_groups, n_links, groups, pairs).

    groups is `a1,a2|b1;a3|b2,b3`: decimal ids of A and B in order, a group after the other. pairs has the text's distinct linked pairs
    with their number of links; a pair is the A id times B's vocabulary size, plus the B id.
    """
    small_batches(docs.sparkSession)
    files = ranks or default_vocabulary(), pieces or default_pieces()

    def run(batches):
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            size = np.cumsum([0 if n is None else n for n in pa.compute.utf8_length(texts).to_pylist()])
            ends = [*(np.flatnonzero(np.diff(size // CHUNK)) + 1).tolist(), len(texts)]
            for i, j in zip([0, *ends[:-1]], ends, strict=True):
                columns = aligned(texts[i:j].to_pylist(), pair_of(*files))
                yield pa.RecordBatch.from_arrays([keys[i:j], *columns], names=["key", *(c.split()[0] for c in _ALIGNED.split(", ")[:5]), "pairs"])

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, {_ALIGNED}").withColumnRenamed("key", key)


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """(pair, count, best): how many rows hold each pair, and whether that is the highest count of its A id."""
    counts = cut(rows.select(F.explode("pairs.pair").alias("pair")).groupBy("pair").agg(F.count("*").alias("count")))
    a = F.floor(F.col("pair") / size_b)
    top = counts.groupBy(a.alias("a")).agg(F.max("count").alias("top"))  # one row for each id of A's vocabulary at most
    return counts.withColumn("a", a).join(F.broadcast(top), "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def _head_from(counts: DataFrame, most: int) -> int:
    """The least count of which at most so many pairs have that or more."""
    # counts in classes an eighth of a power of two wide, so there are few hundred
    band = F.floor(F.log2("count") * 8)
    sizes = counts.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.min("count").alias("least")).orderBy(F.desc("band")).collect()
    least, held = 1 << 62, 0
    for r in sizes:
        held += r["n"]
        if held > most:
            break
        least = r["least"]
    return least


def scored(rows: DataFrame, row: str, size_b: int, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """(row, n_best, count_sum) of rows with pairs: links to a best pair, and the sum of counts over links."""
    counts = cut(pair_counts(rows, size_b))
    least = _head_from(counts, head_pairs)
    head, tail = counts.filter(F.col("count") >= least), counts.filter(F.col("count") < least)
    linked = rows.select(row, F.inline("pairs"))
    sums = [F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("count")).alias("count_sum")]
    known = linked.join(F.broadcast(head), "pair").groupBy(row).agg(*sums)
    if not tail.isEmpty():
        rare = linked.join(F.broadcast(head.select("pair")), "pair", "left_anti").join(tail, "pair").groupBy(row).agg(*sums)
        known = known.unionByName(rare).groupBy(row).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return known


def _kept(rows: DataFrame) -> DataFrame:
    """rows as a table in the shared folder, packed tightly."""
    path = fresh_folder(rows.sparkSession, "aligned")
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def align_report(docs: DataFrame, key: str = "doc_id", text: str = "text", head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """Sizes, digest of the groups and corpus-wide counts of every text's alignment."""
    size_b = sentencepiece.SentencePieceProcessor(model_file=default_pieces()).get_piece_size()
    digest: Column = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    names = ["n_a", "n_b", "n_groups", "n_links"]
    rows = align(docs, key, text).select(
        F.monotonically_increasing_id().alias("_row"), F.col(f"`{key}`").alias("key"), *names, digest.alias("groups_sha256"), "pairs")
    rows = _kept(rows)
    both = rows.drop("pairs").join(scored(rows, "_row", size_b, head_pairs), "_row", "left")
    return both.select(
        F.col("key").alias(key), *names, F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_report(table(spark, sf_dir, "documents"))
