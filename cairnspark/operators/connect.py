"""From wide rows to statements: fixed and role-driven unpivots, row numbers, synthetic keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnspark.functions.clean import clean
from cairnspark.functions.session import cut


def fan_out(names: tuple[str, ...], *rows: tuple[Column, ...]) -> Column:
    """Array of structs with these field names, for inline: several rows made from one."""
    return F.array(*[F.struct(*[c.alias(n) for n, c in zip(names, r, strict=True)]) for r in rows])


def unpivot(rows: DataFrame, ids: list[str], predicates: dict[str, str]) -> DataFrame:
    """One row (ids, predicate, value) for each filled column; predicates maps column to predicate."""
    pairs = F.array(*[F.struct(F.lit(p).alias("predicate"), clean(F.col(f"`{c}`")).alias("value")) for c, p in predicates.items()])
    return rows.select(*ids, F.inline(F.filter(pairs, lambda s: s["value"].isNotNull())))


def unpivot_by_roles(rows: DataFrame, key: str, spec: DataFrame) -> DataFrame:
    """Statements of a sheet by a role table (column, predicate, role, ref_type).

    VALUE and ASSET_PATH give {"value"}, REF_* a reference, META goes to the metadata of all
    statements of the row, CONFIDENCE to their confidence; other roles give nothing.
    """
    columns = [c for c in rows.columns if c != key]
    cells = rows.select(
        F.col(key).alias("natural_key"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), clean(F.col(f"`{c}`")).alias("cell")) for c in columns])),
    ).filter(F.col("cell").isNotNull())
    cells = cells.join(spec, "column")  # a spec has one row for each column of a sheet; Spark measures it
    row_wide = cells.filter(F.col("role").isin("META", "CONFIDENCE")).groupBy("natural_key").agg(
        F.max(F.when(F.col("role") == "CONFIDENCE", F.col("cell"))).alias("confidence"),
        F.sort_array(F.collect_list(F.when(F.col("role") == "META", F.concat_ws("=", "column", "cell")))).alias("meta"),
    )
    value = (
        F.when(F.col("role").isin("VALUE", "ASSET_PATH"), F.to_json(F.struct(F.col("cell").alias("value"))))
        .when(F.col("role").startswith("REF_"), F.to_json(F.struct(F.col("cell").alias("ref_natural_key"), F.col("ref_type").alias("ref_type_abbr"))))
    )
    made = cells.withColumn("stmt_value", value).filter(F.col("stmt_value").isNotNull())
    return made.join(row_wide, "natural_key", "left").select(
        "natural_key", "predicate", "stmt_value", F.coalesce(F.col("confidence").try_cast("double"), F.lit(1.0)).alias("confidence"),
        F.array_join(F.coalesce("meta", F.array()), ";").alias("metadata"),
    )


def numbered(rows: DataFrame, order: list[str], within: list[str] | None = None, name: str = "row_seq") -> DataFrame:
    """Gapless numbers from 1 by order, in each group of within, without a window over all rows.

    Rows are range-partitioned and sorted once and written with their place in the partition; the place in a group
    follows from where the group begins there, and is shifted by its counts in the partitions before. Only one
    count for each partition and group is joined. Rows whose group is null are left out.
    """
    within = within or []
    columns = rows.columns
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(partitions, *within, *order).sortWithinPartitions(*within, *order)
    place = F.monotonically_increasing_id()  # the partition in the upper bits, the place in the lower 33
    ranged = cut(ranged.withColumn("_id", place)).select(
        *[F.col(f"`{c}`") for c in columns], F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_local"))
    counts = ranged.groupBy("_part", *within).agg(F.count("*").alias("_n"), F.min("_local").alias("_first"))
    before = counts.withColumn(
        "_before", F.coalesce(F.sum("_n").over(Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("_n")
    out = ranged.join(cut(before), ["_part", *within])  # written, so that Spark knows its size and leaves the rows where they are
    return out.withColumn(name, (F.col("_local") - F.col("_first") + F.col("_before") + 1).cast("long")).select(*[F.col(f"`{c}`") for c in columns], name)


def first_entities(rows: DataFrame, key: Column, order: str, most: int) -> DataFrame:
    """The rows up to the one, by order, with which the most-th different key first appears; all, if there are fewer keys. Rows without key count for none."""
    at = F.col(f"`{order}`")
    appears = rows.filter(key.isNotNull()).groupBy(key.alias("_key")).agg(F.min(at).alias("_at")).orderBy("_at").limit(most)
    last = appears.agg(F.count("*").alias("_n"), F.max("_at").alias("_last"))
    return rows.join(F.broadcast(last), (F.col("_n") < most) | (at <= F.col("_last"))).drop("_n", "_last")


def synthetic_keys(rows: DataFrame, group: str, order: str, prefix: str, width: int = 4) -> DataFrame:
    """Keys prefix-0001 and so on for the rows of each group in order."""
    made = numbered(rows, [order], [group], "_ordinal")
    return made.withColumn("natural_key", F.format_string(f"{prefix}-%0{width}d", "_ordinal")).drop("_ordinal")


def spread_ref_names(refs: DataFrame, nk: Column, kind: Column, label: Column, order: Column) -> DataFrame:
    """One hasName for each referenced (key, type): the last label wins."""
    return refs.groupBy(nk.alias("natural_key"), kind.alias("ref_type")).agg(F.max_by(label, order).alias("label"))


def with_other(statements: DataFrame, predicate: str, other: str, how: str = "left") -> DataFrame:
    """Statements of a predicate, each beside those of another one about the same subject (columns other_*); null where there are none, or with
    how "inner" none."""
    right = statements.filter(F.col("predicate") == other).drop("predicate")
    right = right.select(*[F.col(c).alias(c if c == "subject_id" else f"other_{c}") for c in right.columns])
    return statements.filter(F.col("predicate") == predicate).join(right, "subject_id", how)


def last_of(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key, the last by order; rows without key are left out."""
    kept = [c for c in rows.columns if c != key]
    last = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*kept), order).alias("_last"))
    return last.select(key, "_last.*").select(*rows.columns)
