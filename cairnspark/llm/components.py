"""Connected components of a set of links, by alternating large-star and small-star rounds.

The centre of a star is one node with all members of its component, so joins by it deal its links over parts
(see common.attach).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnspark.llm.common import attach, cut, uncut


def _with_least(links: DataFrame, least: DataFrame) -> DataFrame:
    """links (u, v) with m, which least (u, m, n) gives for u."""
    return attach(links, least.drop("n"), ["u"], least.select("u", "n"), F.xxhash64("v"), "inner")


def _round(edges: DataFrame) -> DataFrame:
    """The links after a round, as a table."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # large star: every larger neighbour of u is linked to u's smallest neighbour (or u)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count_if(F.col("v") > F.col("u")).alias("n"))
    least = cut(least.filter("n > 0"))
    large = _with_least(both.filter(F.col("v") > F.col("u")), least).select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = cut(large.filter(F.col("u") != F.col("v")).distinct())
    uncut(least)
    # small star: u and all its smaller neighbours are linked to the smallest of them
    least = cut(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
    small = _with_least(large, least).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    small = cut(small.filter(F.col("u") != F.col("v")).distinct())
    uncut(large, least)
    return small


def connected_components(edges: DataFrame, nodes: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) of all nodes on a link: the smallest label that nodes (node, label) gives in its component.

    Each round is distributed and written; it ends when a round leaves the links as they were. Only the result's table stays.

    Edge cases: no links: no rows; a link from a node to itself is none; repeated links count once; a node that nodes lacks gets no row; labels may be
    null or structs, in the order of Spark's min.
    """
    edges = cut(edges.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).filter("u <> v").distinct())
    mark = lambda e: tuple(e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
    before = mark(edges)
    for _ in range(rounds if before[0] else 0):
        old, edges = edges, _round(edges)
        uncut(old)
        if (now := mark(edges)) == before:
            break
        before = now
    else:
        if before[0]:
            raise RuntimeError("the components did not settle")
    member = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    member = member.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    labelled = cut(member.join(nodes, "node"))
    least = cut(labelled.groupBy("root").agg(F.min("label").alias("label"), F.count("*").alias("n")))
    out = attach(labelled.select("node", "root"), least.drop("n"), ["root"], least.select("root", "n"), F.xxhash64("node")).select("node", "label")
    out = cut(out)
    uncut(edges, labelled, least)
    return out
