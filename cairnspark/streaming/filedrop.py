"""File-drop ingest: each new file is one batch, a file dropped twice is staged once, and one that fails is set aside."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.functions.session import cut, read_or_empty
from cairnspark.operators import store as S
from cairnspark.sources.connectors import stage_batches

#: Makes the statement rows of a region's files: (rows, source, region) to a table as connectors emit it.
Pipeline = Callable[[DataFrame, str, str], DataFrame]


def _dropped(spark: SparkSession, inbox: str, schema: str) -> DataFrame:
    meta = F.col("_metadata")
    files = spark.readStream.schema(schema).option("header", True).option("recursiveFileLookup", "true").csv(inbox)
    return files.select(
        "*",
        F.sha1(F.concat_ws(":", meta["file_path"], meta["file_modification_time"].cast("string"))).alias("batch_id"),
        F.regexp_extract(meta["file_path"], r"([^/]+)/[^/]+$", 1).alias("region"),
    )


def _unseen(batch: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of files that known lacks; only the partitions of the files at hand are read."""
    ids = [r[0] for r in batch.select("batch_id").distinct().collect()]  # the files of one micro-batch
    return batch.join(known.filter(F.col("batch_id").isin(*ids)).select("batch_id").distinct(), "batch_id", "left_anti")


def stage(spark: SparkSession, inbox: str, schema: str, target: str, checkpoint: str) -> None:
    """Stage all files that wait in inbox/{region}/ into the table folder target, then stop.

    A batch id is derived from the file's path and time, and target is partitioned by it; rows of a batch id
    that target holds are skipped, so a replayed micro-batch adds nothing.
    """

    def append(batch: DataFrame, _: int) -> None:
        known = read_or_empty(batch.sparkSession, target, f"{schema}, region string, batch_id string")
        _unseen(batch, known).write.mode("append").partitionBy("batch_id").parquet(target)

    rows = _dropped(spark, inbox, schema)
    rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


#: A file is read once it is so many seconds old, so that it is not read while it is being written.
SETTLED = 2.0
_NOTED = "batch_id string, region string, path string, error string, noted_at timestamp"


def _told(error: Exception) -> str:
    """First line of an error."""
    return f"{type(error).__name__}: {str(error).strip().splitlines()[0] if str(error).strip() else ''}"[:500]


def ingest(
    spark: SparkSession, inbox: str, schema: str, pipelines: dict[str, Pipeline], staging: str, store: str, files: str, checkpoint: str,
    max_files: int = 100, cell: float | None = None,
) -> None:
    """Promote all files that wait in inbox/{region}/ into the graph at store, max_files at a time, then stop.

    Each region's pipeline makes statements of its files; regions without one are left out. The stream holds names of files only, and every
    file is a batch of its own. The files of a micro-batch are read, staged and promoted together; if that fails, one by one, so a file that
    cannot be read, or that its pipeline fails on, stops no other. Each is then noted in the table files with its error or
    null (see quarantined); a noted file is not read again, and a replay adds nothing, as a batch id follows from the file's path and time.
    """

    def noted(session: SparkSession, batch: DataFrame, error: str | None) -> None:
        done = batch.withColumn("error", F.lit(error).cast("string")).withColumn("noted_at", F.current_timestamp())
        done.select(*[c.split()[0] for c in _NOTED.split(", ")]).write.mode("append").parquet(files)

    def attempt(session: SparkSession, these: dict[str, tuple[str, str]]) -> str | None:
        """Stage and promote some files (path, region) by batch id; the error if that fails."""
        try:
            made = [
                pipelines[region](session.read.schema(schema).option("header", True).csv(path), f"/{region}", region).withColumn("batch_id", F.lit(i))
                for i, (path, region) in these.items()]
            S.stage_rows(stage_batches(reduce(DataFrame.unionByName, made)), staging)
            S.promote_waiting(session, staging, store, cell, list(these))
        except Exception as e:  # whatever a file brings about concerns that file only
            return _told(e)
        return None

    def run(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        named = cut(batch)
        known = read_or_empty(session, files, _NOTED).select("batch_id")
        waiting = named.join(known, "batch_id", "left_anti").filter(F.col("region").isin(*pipelines)).orderBy("path").collect()  # max_files at most
        young = max((r["age"] for r in waiting), default=None)
        if young is not None:
            time.sleep(min(max(0.0, SETTLED - (time.time() - young)), SETTLED))
        rows = {r["batch_id"]: (r["path"], r["region"]) for r in waiting}
        failed: dict[str, str] = {}
        if rows and attempt(session, rows) is not None:  # one of them fails, so each is tried alone
            failed = {i: e for i, r in rows.items() if (e := attempt(session, {i: r})) is not None}
        for error in {None, *failed.values()}:
            ids = [r["batch_id"] for r in waiting if failed.get(r["batch_id"]) == error]
            if ids:
                noted(session, named.filter(F.col("batch_id").isin(*ids)), error)

    meta = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv*").option("maxFilesPerTrigger", max_files)
    rows = meta.load(inbox).select(
        F.sha1(F.concat_ws(":", "path", F.col("modificationTime").cast("string"))).alias("batch_id"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("region"), "path",
        F.col("modificationTime").cast("double").alias("age"))
    rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def quarantined(spark: SparkSession, files: str) -> DataFrame:
    """(batch_id, region, path, error, noted_at) of the files that failed."""
    return read_or_empty(spark, files, _NOTED).filter(F.col("error").isNotNull())
