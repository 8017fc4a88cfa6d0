"""Session helpers: tables, the shared folder, reliable materialisation."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt over all cores, for work that is much heavier than moving them: a small file may be a single task."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset, a temporary one in local mode; on a cluster that is an error,
    as each executor would write to a disk of its own."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if sc.getCheckpointDir() is None:
        if named is None and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return named or sc.getCheckpointDir()


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it, which cuts its lineage.

    A checkpoint keeps the size estimates of the plan it came from, which multiply from join to join until planning
    itself takes minutes; a table has its true size, from which Spark decides what to broadcast.
    """
    path = fresh_folder(df.sparkSession, "cut")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_at = path
    return out


def uncut(*frames: DataFrame) -> None:
    """Remove the tables that cut wrote for these frames, which nothing reads any more; other frames are left alone."""
    for df in frames:
        if (path := getattr(df, "_cut_at", None)) is not None:
            hadoop = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(hadoop, True)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at path, or an empty one where none is written yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema).limit(0)
