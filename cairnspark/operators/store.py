"""A graph kept as appended deltas, and the staging table that feeds it.

A store is a folder with one folder for each graph table and one for the audit. All are partitioned by commit number, and
registry, entities and statements within it by region, so a batch reads the regions that it names and no other folder. A
commit writes its deltas first and its audit rows last; a number without audit rows was never finished, is not
read, and is written over by the next commit. Entities are read as of the last commit that has them.

A staging table is partitioned by batch and load: every call of stage_rows is a load of its own. The audit names the loads that it took, so rows
that are staged for a batch after its promotion are promoted by the next run, with an audit row of their own.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.functions.session import cut, read_or_empty
from cairnspark.operators.promote import REJECTED, SCHEMAS, Graph, apply, promote_deltas
from cairnspark.operators.spatial import infer_fresh

AUDIT = (
    "batch_id string, rows_in long, rows_err long, rows_inserted long, rows_skipped long, status string, loads array<string>, finished_at timestamp"
)
STAGED = (
    "batch_id string, row_seq long, source_uri string, source_type string, metadata string, collector string, region string, kind string, "
    "temporal string, natural_key string, predicate string, stmt_value string, valid_from string, valid_to string"
)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def stage_rows(staged: DataFrame, path: str) -> None:
    """Append those staged rows whose (batch_id, row_seq) the table at path lacks; only the batches at hand are read."""
    rows = cut(staged.select(*[F.col(c) if c in staged.columns else F.lit(None).cast("string").alias(c) for c in _names(STAGED)]))
    batches = [r[0] for r in rows.select("batch_id").distinct().collect()]
    known = read_or_empty(rows.sparkSession, path, STAGED).filter(F.col("batch_id").isin(*batches)).select("batch_id", "row_seq")
    key = ["row_seq", "batch_id"]  # the number first: rows are sorted by it, and batches are few
    fresh = rows.repartition(*key).join(known, key, "left_anti").dropDuplicates(key)  # dealt and sorted once for both
    fresh.withColumn("load", F.lit(uuid.uuid4().hex)).write.mode("append").partitionBy("batch_id", "load").parquet(path)


def audit_of(spark: SparkSession, store: str) -> DataFrame:
    return read_or_empty(spark, f"{store}/audit", f"{AUDIT}, commit long")


def processed(spark: SparkSession, staging: str, store: str) -> DataFrame:
    """The staging table with processed_at, null for rows of loads that are not promoted yet."""
    done = audit_of(spark, store).select("batch_id", F.explode("loads").alias("load"), F.col("finished_at").alias("processed_at"))
    return read_or_empty(spark, staging, f"{STAGED}, load string").join(done, ["batch_id", "load"], "left")


def _last(spark: SparkSession, store: str) -> int:
    return audit_of(spark, store).agg(F.max("commit")).first()[0] or 0


def load(spark: SparkSession, store: str) -> Graph:
    last, graph = _last(spark, store), {}
    for name, schema in SCHEMAS.items():
        rows = read_or_empty(spark, f"{store}/{name}", f"{schema}, commit long").filter(F.col("commit") <= last)
        if name == "entities":  # by region as well, so that a choice of regions reaches the folders
            rows = rows.groupBy(F.xxhash64("pid"), "region", "pid").agg(F.max_by(F.struct("entity_type", "label", "stub"), "commit").alias("e")).select("region", "pid", "e.*")
        graph[name] = rows.select(*_names(schema))
    return graph


def commit(deltas: Graph, audit: DataFrame, store: str) -> None:
    """Write a batch's deltas, then its audit rows, which make them count. audit may have the loads that it is about."""
    number = _last(audit.sparkSession, store) + 1
    for name, df in deltas.items():
        path = f"{store}/{name}/commit={number}"
        if "region" not in df.columns:
            df.write.mode("overwrite").parquet(path)
        elif df.isEmpty():  # a folder that no region can be, so that every commit has every table
            df.drop("region").coalesce(1).write.mode("overwrite").parquet(f"{path}/region=-")
        else:
            df.write.mode("overwrite").partitionBy("region").parquet(path)
    if "loads" not in audit.columns:
        audit = audit.withColumn("loads", F.array().cast("array<string>"))
    done = audit.withColumn("finished_at", F.current_timestamp()).select(*_names(AUDIT))
    done.coalesce(1).write.mode("overwrite").parquet(f"{store}/audit/commit={number}")  # one row for each batch


def promote_waiting(spark: SparkSession, staging: str, store: str, cell: float | None = None, batches: list[str] | None = None) -> DataFrame:
    """Promote all loads of the staging table that are not processed, or those of some batches, in one commit; returns their rejected rows.

    With cell, the width of a grid cell, the commit also has the containment edges that its geometries bring about.
    """
    pending = processed(spark, staging, store).filter(F.col("processed_at").isNull())
    if batches is not None:
        pending = pending.filter(F.col("batch_id").isin(*batches))
    loads = pending.groupBy("batch_id").agg(F.collect_set("load").alias("loads")).collect()  # one for each call of stage_rows
    if not loads:
        return spark.createDataFrame([], REJECTED).limit(0)
    # these loads are read where they lie: a load that is staged from now on is not among them, and none is ever written again
    wanted = reduce(or_, [F.col("batch_id").eqNullSafe(b) & F.col("load").isin(*names) for b, names in loads])
    waiting = read_or_empty(spark, staging, f"{STAGED}, load string").filter(wanted)
    graph = load(spark, store)
    deltas, audit, rejected = promote_deltas(graph, waiting.drop("load"))
    if cell is not None:
        deltas = infer_fresh(apply(graph, deltas), deltas, cell)
    commit(deltas, audit.join(spark.createDataFrame(loads, "batch_id string, loads array<string>"), "batch_id"), store)
    return rejected
