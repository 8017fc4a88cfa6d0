"""Hard negatives by an exact search in a multiway hyperplane tree.

Scores are integer inner products. With M the largest squared length, a row x becomes (x, sqrt(M - |x|^2)) and an
anchor q becomes (q, 0), so that the squared distance is |q|^2 + M - 2 * score: a window of scores is an annulus round the anchor, and the
highest scores are the nearest rows.

Every node of the tree has up to ARITY split points, spread out over a sample of at most SAMPLE rows; a row belongs to the
split point next to it (ties: the first). Each split point stores the range of its distances to the rows below each
sibling, taken over all rows. A sibling is left out if no point of the annulus can lie in that range. Leaves are scanned
exactly, in blocks of about BLOCK rows, so a leaf that holds a third of all rows is many blocks. Anchors travel in
chunks of about CHUNK, next neighbours together; a chunk meets the blocks that one of its anchors must see.

Each search runs twice: in the anchor's own leaf, which bounds the annulus, and then in all leaves that it meets. The
result is that of a scan of all rows; the sample only decides how much is left out. In many dimensions with
little structure that is little: the work is then a blocked scan of all rows for all anchors.

What reaches the driver: the sample, the tree with its ranges (at most LEAVES leaves), one row of statistics, and two counts for each leaf.

Edge cases: rows with a null label, a null vector, or a null or non-finite component take no part; shorter vectors go on with
zeros; repeated rows are rows of their own, so each repeated anchor has its own results; a null id is never an anchor in
the query, and comes last among ties; an anchor without positives, or a positive without negatives in its window, gives
no row; an empty table gives an empty result; other columns are not read. Scores must fit a long.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnspark.llm.common import cut, small_batches, table

ARITY, SAMPLE, LEAF_ROWS, LEAVES, BLOCK, CHUNK = 16, 8192, 512, 4096, 1024, 256
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


@dataclass
class Node:
    """points: the split points; below: for each the number of its node, or of its leaf as -1 - leaf; low and high: ranges of
    distances of point i to the rows below point j."""

    points: np.ndarray
    below: list[int]
    low: np.ndarray = field(init=False)
    high: np.ndarray = field(init=False)

    def __post_init__(self):
        n = len(self.points)
        self.low, self.high = np.full((n, n), np.inf), np.full((n, n), -np.inf)

    def distances(self, x: np.ndarray) -> np.ndarray:
        both = (x**2).sum(1)[:, None] + (self.points**2).sum(1)[None, :] - 2 * x @ self.points.T
        return np.sqrt(np.maximum(both, 0))


class Tree:
    """A multiway hyperplane tree over lifted rows; most is the largest squared length."""

    def __init__(self, sample: np.ndarray, most: float, leaves: int, arity: int = ARITY):
        self.most, self.nodes, self.leaves = most, [], 0
        rng = np.random.default_rng(7)
        depth = 0 if leaves < 2 else int(np.ceil(np.log(leaves) / np.log(arity) - 1e-9))
        self._grow(self.lift(sample), depth, arity, rng)

    def lift(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, np.float64)
        return np.concatenate([x, np.sqrt(np.maximum(self.most - (x**2).sum(1, keepdims=True), 0))], axis=1)

    def _grow(self, sample: np.ndarray, depth: int, arity: int, rng: np.random.Generator) -> int:
        # candidates that lie far from each other, one after the other
        some = sample[rng.permutation(len(sample))[: 3 * arity]] if depth else sample[:0]
        chosen, near = [], np.full(len(some), np.inf)
        while len(chosen) < min(arity, len(some)):
            at = int(np.argmax(near))
            if near[at] <= 0:
                break  # the rest are copies
            chosen.append(at)
            near = np.minimum(near, ((some - some[at]) ** 2).sum(1))
        if len(chosen) < 2:
            self.leaves += 1
            return -self.leaves
        node = Node(some[chosen], [])
        number = len(self.nodes)
        self.nodes.append(node)
        own = node.distances(sample).argmin(1)
        for j in range(len(chosen)):
            node.below.append(self._grow(sample[own == j], depth - 1, arity, rng))
        return number

    @property
    def root(self) -> int:
        return 0 if self.nodes else -1

    def assign(self, x: np.ndarray, widen: bool = False) -> np.ndarray:
        """Leaf of each lifted row. widen: take the rows into the ranges of their path."""
        leaf, open_ = np.zeros(len(x), np.int64), [(self.root, np.arange(len(x)))]
        while open_:
            number, rows = open_.pop()
            if number < 0:
                leaf[rows] = -1 - number
                continue
            node = self.nodes[number]
            d = node.distances(x[rows])
            own = d.argmin(1)
            for j in np.unique(own):
                here = own == j
                if widen:
                    node.low[:, j] = np.minimum(node.low[:, j], d[here].min(0))
                    node.high[:, j] = np.maximum(node.high[:, j], d[here].max(0))
                open_.append((node.below[j], rows[here]))
        return leaf

    def visits(self, q: np.ndarray, near: np.ndarray, far: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(leaf, searches) for each leaf that may hold a row at a distance from near to far of q."""
        out, open_ = [], [(self.root, np.arange(len(q)))]
        slack = 1e-6 * (1 + np.sqrt(self.most))
        while open_:
            number, rows = open_.pop()
            if number < 0:
                out.append((-1 - number, rows))
                continue
            node = self.nodes[number]
            d, inner, outer = node.distances(q[rows]), near[rows], far[rows]
            least = np.maximum(d - outer[:, None], inner[:, None] - d) - slack  # of the distance to point i within the annulus
            most = d + outer[:, None] + slack
            for j, below in enumerate(node.below):
                meets = ((node.high[None, :, j] >= least) & (node.low[None, :, j] <= most)).all(1)
                if meets.any():
                    open_.append((below, rows[meets]))
        return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of a with all of b, exact where they fit a long."""
    largest = int(max(np.abs(a).max(initial=0), 1)) * int(max(np.abs(b).max(initial=0), 1)) * max(a.shape[1], 1)
    if largest < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def best(found: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest allowed entries of each row at most; of equal ones the first columns."""
    left = np.where(allowed, found, _LEAST)
    rows, columns = [], []
    for _ in range(min(k, found.shape[1])):
        at = left.argmax(1)
        some = np.flatnonzero(left[np.arange(len(left)), at] > _LEAST)
        if not len(some):
            break
        rows.append(some)
        columns.append(at[some])
        left[some, at[some]] = _LEAST
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *columns])


def vectors(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def sound(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, lambda x: odd(x.cast("double")))


def _matrix(values: pa.Array, n: int) -> np.ndarray:
    return np.asarray(values).reshape(n, -1)


class _Index:
    """The tree, the blocks of all rows by leaf, and the chunks of anchors."""

    def __init__(self, rows: DataFrame):
        """rows: row, id, label, v (equally long), anchor; a table, as row numbers must not change."""
        self.spark, self.rows = rows.sparkSession, rows
        norm = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x)
        count, most, self.dim = rows.agg(F.count("*"), F.max(norm), F.max(F.size("v"))).first()
        sample = rows.select("v", F.xxhash64("row").alias("h")).orderBy("h").limit(SAMPLE).select("v").collect()
        self.tree = Tree(np.array([r[0] for r in sample], np.float64).reshape(len(sample), -1), float(most), min(LEAVES, -(-count // LEAF_ROWS)))
        self.rows = cut(self._assigned())
        self._ranges()
        self.shared = self.spark.sparkContext.broadcast(self.tree)
        self._place()

    def _assigned(self) -> DataFrame:
        shared = self.spark.sparkContext.broadcast(self.tree)
        at = self.rows.columns.index("v")

        def run(batches):
            tree = shared.value
            for b in batches:
                x = _matrix(b.column(at).flatten(), b.num_rows)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree.assign(tree.lift(x)))], names=[*b.schema.names, "leaf"])

        return self.rows.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in self.rows.dtypes) + ", leaf long")

    def _ranges(self) -> None:
        """Set the ranges of the tree from all rows: each task widens its own, which are then joined."""
        shared = self.spark.sparkContext.broadcast(self.tree)

        def run(batches):
            tree = shared.value
            for node in tree.nodes:
                node.__post_init__()
            for b in batches:
                tree.assign(tree.lift(_matrix(b.column(0).flatten(), b.num_rows)), widen=True)
            for k, node in enumerate(tree.nodes):
                i, j = np.nonzero(node.high >= 0)
                if len(i):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(i), k)), pa.array(i), pa.array(j), pa.array(node.low[i, j]), pa.array(node.high[i, j])], names=["k", "i", "j", "low", "high"])

        found = self.rows.select("v").mapInArrow(run, "k long, i long, j long, low double, high double")
        for k, i, j, low, high in found.groupBy("k", "i", "j").agg(F.min("low"), F.max("high")).collect():
            self.tree.nodes[k].low[i, j], self.tree.nodes[k].high[i, j] = low, high

    def _place(self) -> None:
        """Deal rows to blocks and anchors to chunks; leaves follow each other in the order of the tree."""
        counts = sorted(self.rows.groupBy("leaf").agg(F.count("*"), F.count_if("anchor")).collect())
        places, first, chunk, held = [], 0, 0, 0
        for leaf, n, anchors in counts:
            blocks, chunks = -(-n // BLOCK), max(1, -(-anchors // CHUNK))
            if held and held + anchors > CHUNK:
                chunk, held = chunk + 1, 0
            places.append((leaf, first, blocks, chunk, chunks))
            first += blocks
            held = held + anchors if chunks == 1 else CHUNK
            chunk += chunks - 1
        placed = F.broadcast(self.spark.createDataFrame(places, "leaf long, first long, blocks long, chunk long, chunks long"))
        self.places = placed
        self.last_chunk = chunk
        dealt = self.rows.join(placed, "leaf")
        block = F.col("first") + F.pmod(F.xxhash64("row"), F.col("blocks"))
        one = F.struct(F.col("id").isNull().alias("none"), "id", "row", "label", "v")
        packed = dealt.select(block.alias("block"), one.alias("x")).groupBy("block").agg(F.sort_array(F.collect_list("x")).alias("x"))
        self.blocks = cut(packed.select(
            "block", *[F.col(f"x.{c}").alias(f"b_{c}") for c in ("id", "row", "label")], F.flatten("x.v").alias("b_v")))
        self.anchors = dealt.filter("anchor").select(
            "row", "id", "label", "v", "leaf", (F.col("chunk") + F.pmod(F.xxhash64("row"), F.col("chunks"))).alias("chunk"))

    def search(self, wanted: DataFrame, same: bool, k: int, own_leaf: bool) -> DataFrame:
        """(row, search, lo, hi, score, hit_id, hit_row): up to k rows for each search of wanted (row, search, lo, hi), highest scores first.

        Rows of the anchor's label (same) or of others, without the anchor itself, whose score is from lo to hi (null: no bound).
        own_leaf: only those of the anchor's leaf.
        """
        asked = wanted.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("search", "lo", "hi"))).alias("s"))
        one = F.struct("row", "label", "leaf", "v", "s")
        chunks = self.anchors.join(asked, "row").groupBy("chunk").agg(F.sort_array(F.collect_list(one)).alias("x"))
        flat = lambda c: F.flatten(F.transform("x.s", lambda s: F.transform(s, lambda y: y[c]))).alias(c)
        chunks = cut(chunks.select(
            "chunk", *[F.col(f"x.{c}").alias(c) for c in ("row", "label", "leaf")], F.flatten("x.v").alias("v"),
            F.transform("x.s", lambda s: F.size(s)).cast("array<long>").alias("searches"), *map(flat, ("search", "lo", "hi"))))
        visits = self._visits(chunks, own_leaf).join(self.places.select("leaf", "first", "blocks"), "leaf")
        visits = visits.select("chunk", "members", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1)).alias("block"))
        met = visits.join(chunks.drop("leaf"), "chunk").join(self.blocks, "block")
        names = ["members", "row", "label", "v", "searches", "search", "lo", "hi", "b_id", "b_row", "b_label", "b_v"]

        def run(batches):
            for b in batches:
                for i in range(b.num_rows):
                    yield _scan(*[b.column(c)[i].values for c in names], same, k)

        found = met.select(*names).mapInArrow(run, _FOUND)
        order = Window.partitionBy("row", "search").orderBy(F.desc("score"), F.asc_nulls_last("hit_id"), "hit_row")
        return found.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")

    def _visits(self, chunks: DataFrame, own_leaf: bool) -> DataFrame:
        """(chunk, leaf, members): which searches of a chunk, by number, must see a leaf."""
        shared, names = self.shared, ["chunk", "leaf", "v", "searches", "lo", "hi"]

        def of(tree: Tree, leaf, v, searches, lo, hi):
            anchor = np.repeat(np.arange(len(leaf)), np.asarray(searches))
            if own_leaf:
                home = np.asarray(leaf)[anchor]
                return [(x, np.flatnonzero(home == x)) for x in np.unique(home).tolist()]
            x = _matrix(v, len(leaf)).astype(np.float64)
            whole = (x**2).sum(1)[anchor] + tree.most
            at = lambda s: np.sqrt(np.maximum(whole - 2.0 * s, 0))
            bound = lambda s, none: s.fill_null(none).to_numpy(zero_copy_only=False)
            near = np.where(bound(hi.is_valid(), True), at(bound(hi, 0)), 0.0)
            far = np.where(bound(lo.is_valid(), True), at(bound(lo, 0)), np.inf)
            q = np.concatenate([x, np.zeros((len(x), 1))], axis=1)[anchor]
            return tree.visits(q, near, far)

        def run(batches):
            for b in batches:
                for i in range(b.num_rows):
                    found = of(shared.value, *[b.column(c)[i].values for c in names[1:]])
                    if found:
                        yield pa.RecordBatch.from_arrays([
                            pa.array([b.column("chunk")[i].as_py()] * len(found), pa.int64()), pa.array([x for x, _ in found], pa.int64()),
                            pa.array([m for _, m in found], pa.list_(pa.int64()))], names=["chunk", "leaf", "members"])

        return chunks.select(*names).mapInArrow(run, "chunk long, leaf long, members array<long>")


_FOUND = "row long, search long, lo long, hi long, score long, hit_id long, hit_row long"


def _scan(members, row, label, v, searches, search, lo, hi, b_id, b_row, b_label, b_v, same: bool, k: int) -> pa.RecordBatch:
    """The best rows of one block for some searches of one chunk; a block is in order of ids, so first columns are smallest ids."""
    anchor = np.repeat(np.arange(len(row)), np.asarray(searches))
    members = np.asarray(members)
    used, at = np.unique(anchor[members], return_inverse=True)
    found = scores(_matrix(v, len(row))[used], _matrix(b_v, len(b_row)))[at]
    low = lo.fill_null(int(_LEAST) + 1).to_numpy()[members]
    high = hi.fill_null(int(_MOST)).to_numpy()[members]
    of = anchor[members]
    alike = np.asarray(label)[of][:, None] == np.asarray(b_label)[None, :]
    allowed = (alike == same) & (found >= low[:, None]) & (found <= high[:, None]) & (np.asarray(row)[of][:, None] != np.asarray(b_row)[None, :])
    r, c = best(found, allowed, k)
    take = lambda x, i: x.take(pa.array(i))
    columns = [take(row, of[r]), *[take(x, members[r]) for x in (search, lo, hi)], pa.array(found[r, c]), take(b_id, c), take(b_row, c)]
    return pa.RecordBatch.from_arrays([x.cast(pa.int64()) for x in columns], names=[x.split()[0] for x in _FOUND.split(", ")])


def _nearest(index: _Index, wanted: DataFrame, same: bool, k: int) -> DataFrame:
    """search in all leaves, after a search of the anchor's own leaf has raised the lower bounds."""
    first = index.search(wanted, same, k, own_leaf=True).groupBy("row", "search").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bound = F.when(F.col("n") >= k, F.greatest("lo", "least")).otherwise(F.col("lo"))  # greatest takes no notice of null
    narrowed = cut(wanted.join(first, ["row", "search"], "left").select("row", "search", bound.alias("lo"), "hi"))
    return cut(index.search(narrowed, same, k, own_leaf=False))


def mine(rows: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Hard negatives of every anchor and positive.

    rows: id, label, v (array of long), anchor (boolean). An anchor's positives are the first `positives` other rows of its label,
    its negatives for each the first `negatives` rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    spark = rows.sparkSession
    small_batches(spark)
    kept = cut(rows.select(F.monotonically_increasing_id().alias("row"), F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                           F.col("v").cast("array<long>").alias("v"), F.coalesce("anchor", F.lit(False)).alias("anchor")))
    longest, shortest, any_anchor = kept.agg(F.max(F.size("v")), F.min(F.size("v")), F.bool_or("anchor")).first()
    if not any_anchor:
        return spark.createDataFrame([], SCHEMA)
    if shortest < longest or not longest:
        zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(max(longest, 1)) - F.size("v"))
        kept = cut(kept.withColumn("v", F.concat("v", zeros)))
    index = _Index(kept)
    none = F.lit(None).cast("long")
    near = _nearest(index, index.anchors.select("row", F.lit(0).cast("long").alias("search"), none.alias("lo"), none.alias("hi")), True, positives)
    score = F.col("score")
    windows = near.select(
        "row", F.col("hit_row").alias("search"), F.col("hit_id").alias("positive_id"), score.alias("positive_score"),
        F.expr(f"({low} * score + pmod(-{low} * score, 100)) div 100").alias("lo"), F.expr(f"({high} * score - pmod({high} * score, 100)) div 100").alias("hi"),
    ).filter(F.col("lo") <= F.col("hi"))
    windows = cut(windows)
    hard = _nearest(index, windows.select("row", "search", "lo", "hi"), False, negatives)
    rank = F.row_number().over(Window.partitionBy("row", "search").orderBy(F.desc("score"), F.asc_nulls_last("hit_id"), "hit_row"))
    ranked = hard.withColumn("rank", rank).join(windows.drop("lo", "hi"), ["row", "search"])
    return ranked.join(index.anchors.select("row", F.col("id").alias("anchor_id")), "row").select(
        "anchor_id", "positive_id", "rank", F.col("hit_id").alias("negative_id"), "positive_score", score.alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(F.col("label").isNotNull() & sound(F.col("embedding")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select(F.col("vec_id").alias("id"), moved.alias("label"), vectors(F.col("embedding")).alias("v"), (F.col("vec_id") % 50 == 0).alias("anchor")))


ORACLE_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = e.label AS same, e.vec_id, CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
  FROM e a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""
