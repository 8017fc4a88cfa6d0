"""Joins with a side of one row for each key, in which a few keys may have most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A value that more than one in HEAVY rows has is heavy; its rows are dealt over PARTS parts. Sides of a measured size up to BROADCAST_BYTES are broadcast.
HEAVY, PARTS, BROADCAST_BYTES = 1000, 64, 8 << 20


#: Rows of a sort-merge join's partition where by_key deals them.
ROWS = 1 << 18


def by_key(rows: DataFrame, key: str, total: int) -> DataFrame:
    """rows dealt by key over so many partitions that each has about ROWS of total rows, the same number for each side that gets the same total.

    A fixed number of partitions, or one by compressed bytes, lets what a task sorts grow with the table.
    """
    return rows.repartition(max(1, -(-total // ROWS)), key)


def attach(
    rows: DataFrame, side: DataFrame, on: list[str], counts: DataFrame, spread: Column, how: str = "left", size: Column | None = None
) -> DataFrame:
    """rows joined with side, which has one row for each value of on; counts (on, n) says how many rows have it.

    With size, the bytes of a row of side, a side that is small enough is broadcast and rows stay where they are. Else fewer than HEAVY
    values are heavy. Only those values are broadcast; their rows are dealt over PARTS parts by spread (a hash of what else a row holds),
    each part with its own copy of the side's row.
    """
    if size is not None and (side.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(side), on, how)
    total = counts.agg(F.sum("n")).first()[0] or 0
    heavy = F.broadcast(counts.filter(F.col("n") * HEAVY > total).select(*on, F.lit(True).alias("_heavy")))
    parts = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    many = side.join(heavy, on, "left").withColumn("_dealt", F.explode(parts)).drop("_heavy")
    dealt = F.when(F.col("_heavy"), F.pmod(spread, F.lit(PARTS)).cast("int")).otherwise(0)
    return rows.join(heavy, on, "left").withColumn("_dealt", dealt).drop("_heavy").join(many, [*on, "_dealt"], how).drop("_dealt")
