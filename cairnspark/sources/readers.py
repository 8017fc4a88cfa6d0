"""Scans: point CSVs, encoded tables, GeoJSON features, photo folders."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.operators.connect import first_entities

#: Layers that name a cluster of places.
CLUSTER_LAYERS = ("群体", "区域")


def points_csv(spark: SparkSession, path: str, schema: str, max_rows: int | None = None) -> DataFrame:
    """Heritage points; rows without an ID go, and the layer decides the entity type."""
    rows = spark.read.csv(path, header=True, schema=schema).filter(F.col("ID").isNotNull())
    if max_rows is not None:  # entities, not rows, in the order of their numbers
        rows = first_entities(rows.withColumn("_order", F.monotonically_increasing_id()), F.col("ID"), "_order", max_rows).drop("_order")
    kind = F.when(F.col("Layer").isin(*CLUSTER_LAYERS), "clu").otherwise("pl")
    return rows.select("*", kind.alias("kind"), F.concat(F.lit("file#ID="), F.col("ID")).alias("source_uri"))


def encoded_csv(spark: SparkSession, path: str, schema: str, encodings: tuple[str, ...] = ("UTF-8", "GB18030")) -> DataFrame:
    """A CSV whose files are each read in the first encoding that decodes all of their bytes."""
    file = F.col("_metadata.file_path")
    lines = spark.read.text(path).select(file.alias("file"), F.is_valid_utf8("value").alias("valid"))
    files = lines.groupBy("file").agg(F.bool_and("valid").alias("utf8")).collect()
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    read = lambda use: spark.read.csv(path, header=True, schema=schema, encoding=use)
    other = [r["file"] for r in files if not r["utf8"]]
    if not other:
        return read(encodings[0])
    if len(other) == len(files):
        return read(encodings[1])
    return read(encodings[0]).filter(~file.isin(other)).unionByName(read(encodings[1]).filter(file.isin(other)))


def geojson_features(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(properties, geometry type, rings) of GeoJSON feature collections, one a file or, without multi_line, one a line."""
    schema = "features array<struct<properties: map<string, string>, geometry: struct<type: string, coordinates: array<array<array<double>>>>>>"
    rows = spark.read.schema(schema).json(path, multiLine=multi_line).select(F.explode("features").alias("f"))
    return rows.select(F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("rings"))


def photo_folder(spark: SparkSession, path: str) -> DataFrame:
    """(natural_key, place, file, bytes) of the image files below path/{place}/; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{jpg,jpeg,png,tif,tiff}").option("recursiveFileLookup", "true").load(path)
    relative = F.regexp_extract("path", r"([^/]+/[^/]+)$", 1)
    return files.select(
        F.concat(F.lit("img:"), relative).alias("natural_key"), F.regexp_extract(relative, "^([^/]+)/", 1).alias("place"),
        F.regexp_extract(relative, "/([^/]+)$", 1).alias("file"), F.col("length").alias("bytes"),
    )


def write_files(files: DataFrame, root: str) -> None:
    """One file for each row of (name, content) below root, which driver and executors share; the tasks write them, in all parallelism there is."""
    spark = files.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, base = fs.FileSystem.from_uri(root)
        made = set()
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                path = f"{base}/{name}"
                if (folder := path.rpartition("/")[0]) not in made:
                    shared.create_dir(folder, recursive=True)
                    made.add(folder)
                with shared.open_output_stream(path) as out:
                    out.write(content)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    rows = files.select("name", "content").repartition(spark.sparkContext.defaultParallelism)  # a small table of names may be one partition
    rows.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def alias_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(predicate, alias, canonical) from a JSON file {predicate: {alias: canonical}}; keys that start with "_" are notes."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string, string>").alias("m"))
    # notes may be of any shape, so only the values of predicates are read further
    named = whole.select(F.explode(F.map_filter("m", lambda k, _: ~k.startswith("_"))).alias("predicate", "text"))
    names = F.map_filter(F.from_json("text", "map<string, string>"), lambda k, _: ~k.startswith("_"))
    return named.select("predicate", F.explode(names).alias("alias", "canonical"))
