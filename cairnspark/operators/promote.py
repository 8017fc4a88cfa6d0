"""Set-based promotion of staged rows: identifiers, entities, evidence and typed statements.

A graph is a dict of DataFrames: registry (region, kind, natural_key, pid, serial), entities
(region, pid, entity_type, label, stub), evidence (evidence_id, source_name, source_type, collector, metadata)
and statements (region, subject_id, predicate, object_value, object_id, geometry, valid_from, valid_to,
evidence_id, confidence, key_a, key_b). The region is that of the identifier; a stored graph is partitioned by it.
key_a and key_b are two independent 64-bit hashes of what makes two statements the same, so that the question
which statements are new reads and shuffles nothing else of the old ones. Staged rows have batch_id, row_seq, source_uri, source_type, metadata (optional), collector,
region, kind, temporal, natural_key, predicate, stmt_value (JSON), valid_from, valid_to.
Promoting the same rows again changes nothing: every insert is an anti join on a null-safe key. What a batch
adds is computed as deltas, so the work is that of the batch and of an anti join with the regions it touches;
operators/store.py keeps a graph as appended deltas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.functions import clean as C
from cairnspark.functions import geo as G
from cairnspark.functions.joins import attach
from cairnspark.functions.session import cut
from cairnspark.operators.connect import numbered

SCHEMAS = {
    "registry": "region string, kind string, natural_key string, pid string, serial long",
    "entities": "region string, pid string, entity_type string, label string, stub boolean",
    "evidence": "evidence_id long, source_name string, source_type string, collector string, metadata string",
    "statements": "region string, subject_id string, predicate string, object_value string, object_id string, geometry string, "
    "valid_from string, valid_to string, evidence_id long, confidence double, key_a long, key_b long",
}
#: Columns that make two statements the same, nulls being equal.
_KEY = ["subject_id", "predicate", "object_value", "object_id", "geometry", "valid_from", "evidence_id"]


def empty_graph(spark: SparkSession) -> dict[str, DataFrame]:
    return {n: spark.createDataFrame([], s).limit(0) for n, s in SCHEMAS.items()}  # the limit tells the planner, which leaves out joins with them


#: What names a thing. The hash stands first wherever rows are sorted by it: the texts begin alike, so comparing them alone is slow.
KEY = ["key_hash", "region", "kind", "natural_key"]


def key_hash(region: str = "region", kind: str = "kind", natural_key: str = "natural_key") -> Column:
    return F.xxhash64(natural_key, kind, region)


def region_of(pid: Column) -> Column:
    """The region that an identifier names."""
    return F.split_part(pid, F.lit(":"), F.lit(2))


def hashes(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes (key_a, key_b) of some columns, nulls being equal and unlike any text."""
    said = [F.struct(c.isNull(), c.cast("string")) for c in columns]
    return [F.xxhash64(*said).alias("key_a"), F.xxhash64(F.lit("second"), *reversed(said)).alias("key_b")]


def keyed(statements: DataFrame) -> DataFrame:
    """statements with region, key_a and key_b, in the order of the schema."""
    region = region_of(F.col("subject_id")).alias("region")
    return statements.select(region, *_columns("statements")[1:-2], *hashes(*map(F.col, _KEY)))


def _columns(table: str) -> list[str]:
    return [c.split()[0] for c in SCHEMAS[table].split(", ")]


def missing(old: DataFrame, new: DataFrame) -> DataFrame:
    """Those statements of new (with key_a and key_b) that old lacks, one row for each key."""
    return new.dropDuplicates(["key_a", "key_b"]).join(old.select("key_a", "key_b"), ["key_a", "key_b"], "left_anti")


def reject(staged: DataFrame) -> DataFrame:
    """staged with a column error: the code of why a row cannot be promoted, or null."""
    return staged.withColumn("_v", C.value_parts(F.col("stmt_value"))).withColumn("error", _error(F.col("_v"))).drop("_v")


def _error(v: Column) -> Column:
    """v: the parts of the statement's value (see value_parts)."""
    kind = C.kind_of_parts(v)
    sound = lambda c, rule: F.coalesce(rule(c), c.isNull())  # noqa: E731  absent parts have defaults
    ref_fails = C.clean(v["ref_natural_key"]).isNull() | ~sound(v["ref_type_abbr"], C.valid_type) | ~sound(v["ref_region"], C.valid_region)
    return (
        F.when(~F.coalesce(C.valid_region(F.col("region")), F.lit(False)), "bad_region")
        .when(~F.coalesce(C.valid_type(F.col("kind")), F.lit(False)), "bad_type")
        .when(C.clean(F.col("natural_key")).isNull(), "no_key")
        .when(C.confidence_of_parts(v).isNull(), "bad_confidence")
        .when((kind == "ref") & ref_fails, "bad_reference")
        .when((kind == "geometry") & ~G.valid_wkt(v["wkt"]), "bad_geometry")
        .when((kind == "geometry") & ~G.known_srid(v["srid"].try_cast("int")), "unknown_srid")
    )


#: What is left of a staged row once its value is parsed.
_PARSED = ("batch_id", "row_seq", "source_uri", "source_type", "metadata", "collector", "region", "kind", "temporal", "natural_key", "predicate", "valid_from", "valid_to")

#: Rejected rows: those columns, the statement as it came and the code of what is wrong.
REJECTED = ", ".join(f"{c} {'long' if c == 'row_seq' else 'string'}" for c in (*_PARSED, "stmt_value", "error"))


def _parsed(staged: DataFrame) -> DataFrame:
    """Staged rows with their error, or without one with the parts of their statement; each JSON text is parsed once."""
    v, said = F.col("_v"), lambda c: F.when(F.col("error").isNull(), c)
    kind = C.kind_of_parts(v)
    is_ref = kind == "ref"
    rows = staged.withColumn("_v", C.value_parts(F.col("stmt_value"))).withColumn("error", _error(v))
    return rows.withColumn("ref_region", F.coalesce(v["ref_region"], "region")).withColumn("ref_kind", F.coalesce(v["ref_type_abbr"], F.lit("pl"))).select(
        *_PARSED, "error", key_hash().alias("key_hash"), said(F.when(is_ref, F.xxhash64(v["ref_natural_key"], "ref_kind", "ref_region"))).alias("ref_hash"), F.when(F.col("error").isNotNull(), F.col("stmt_value")).alias("stmt_value"), said(is_ref).alias("is_ref"),
        said(F.when(is_ref, v["ref_natural_key"])).alias("ref_key"), said(F.when(is_ref, F.col("ref_kind"))).alias("ref_kind"),
        said(F.when(is_ref, F.col("ref_region"))).alias("ref_region"), said(F.coalesce((F.col("predicate") == "hasName") & (kind == "text"), F.lit(False))).alias("is_name"),
        said(C.literal_of_parts(v, F.col("stmt_value"))).alias("object_value"), said(F.when(kind == "geometry", G.to_wgs84(v["wkt"], v["srid"].try_cast("int")))).alias("geometry"),
        said(C.confidence_of_parts(v)).alias("confidence"))


def minted(registry: DataFrame, keys: DataFrame) -> DataFrame:
    """A new identifier for each (region, kind, natural_key) that registry lacks.

    keys has region, kind, natural_key, temporal. Serials go on from the largest of each
    region and kind, in order of the natural key, so the same keys give the same identifiers.
    """
    key = ["region", "kind", "natural_key"]
    new = keys.groupBy(*key).agg(F.min("temporal").alias("temporal")).join(registry, key, "left_anti")
    return _issued(new, registry).select(*registry.columns)


def _issued(new: DataFrame, registry: DataFrame) -> DataFrame:
    """new, one row for each key that registry lacks, with its serial and pid."""
    base = registry.groupBy("region", "kind").agg(F.max("serial").alias("base"))
    made = numbered(new, ["natural_key"], ["region", "kind"], "_n").join(base, ["region", "kind"], "left")
    serial = F.coalesce("base", F.lit(0)) + F.col("_n")
    return made.withColumn("serial", serial).withColumn("pid", C.pid(F.col("region"), F.col("kind"), F.col("temporal"), F.col("serial"))).drop("_n", "base")


def mint(registry: DataFrame, keys: DataFrame) -> DataFrame:
    """registry with the identifiers that minted makes."""
    return registry.unionByName(minted(registry, keys))


def _merged(both: DataFrame) -> DataFrame:
    """Entities (entity_type, label, stub, null where there was none) after what is new of them (t, l, s), and whether that changes them."""
    keeps = F.col("label").isNotNull() & (~F.col("stub") | F.coalesce("s", F.lit(True)))
    label = F.when(keeps, F.col("label")).otherwise(F.coalesce("l", "label"))
    stub = F.when(F.col("stub").isNull(), F.col("s")).otherwise(F.col("stub") & F.coalesce("s", F.lit(True)))
    changed = F.col("stub").isNull() | ~label.eqNullSafe(F.col("label")) | (stub != F.col("stub"))
    return both.select("pid", F.coalesce("entity_type", "t").alias("entity_type"), label.alias("label"), stub.alias("stub"), changed.alias("changed"))


def upsert_labels(entities: DataFrame, named: DataFrame) -> DataFrame:
    """Full outer upsert of (pid, entity_type, label, stub): a real name replaces a stub's, else the old label stays."""
    new = named.groupBy("pid").agg(
        F.max("entity_type").alias("t"), F.min_by("label", F.struct("stub", "label")).alias("l"), F.min("stub").alias("s")
    )
    return _merged(entities.join(new, "pid", "full_outer")).drop("changed")


Graph = dict[str, DataFrame]


def apply(graph: Graph, deltas: Graph) -> Graph:
    """The graph after a batch: rows of registry, evidence and statements are added, those of entities replace the old."""
    old = graph["entities"].join(deltas["entities"].select("region", "pid"), ["region", "pid"], "left_anti")
    return {n: (old if n == "entities" else graph[n]).unionByName(deltas[n]) for n in SCHEMAS}


def _of_regions(df: DataFrame, regions: list[str]) -> DataFrame:
    """The rows of some regions: of a stored graph only their folders are read."""
    return df.filter(F.col("region").isin(*regions)) if regions else df.limit(0)


def promote_deltas(graph: Graph, staged: DataFrame, batches: list[str] | None = None) -> tuple[Graph, DataFrame, DataFrame]:
    """(deltas, audit, rejected rows). audit has one row for each batch, also for those of batches without rows.

    The new statements of each batch are counted where it is the first to say them; rows that were there already
    are rows_skipped. A batch without rejected rows is a success, also if all its rows are skipped.
    """
    if "metadata" not in staged.columns:
        staged = staged.withColumn("metadata", F.lit(None).cast("string"))
    checked = cut(_parsed(staged))
    rows = checked.filter(F.col("error").isNull())
    refs = rows.filter("is_ref").select(*[F.col(f"ref_{c}").alias(n) for c, n in zip(("hash", "region", "kind", "key"), KEY, strict=True)])
    # subjects come before what is only referred to, so a key that is both takes the subject's temporal part; references are counted
    # before they meet the subjects, and all of it is dealt once, by what the registry is dealt by too
    name = lambda c: F.when(F.col("is_name"), F.col(c))
    own = rows.select(*KEY, "temporal", name("object_value").alias("label"), name("row_seq").alias("named_at"), F.lit(1).alias("own"), F.lit(0).cast("long").alias("refs"))
    none = lambda kind: F.lit(None).cast(kind)
    said = refs.groupBy(*KEY).agg(F.count("*").alias("refs")).select(*KEY, none("string").alias("temporal"), none("string").alias("label"), none("long").alias("named_at"), F.lit(0).alias("own"), "refs")
    keys = own.unionByName(said).groupBy(*KEY).agg(
        F.min("temporal").alias("temporal"), F.min_by("label", "named_at").alias("label"), F.sum("own").alias("n_own"), F.sum("refs").alias("n_refs"))
    # a batch names few regions; the old graph is read for those alone
    touched = sorted({r for pair in rows.select("region", "ref_region").distinct().collect() for r in pair if r is not None})
    old_registry = _of_regions(graph["registry"], touched)
    found = cut(keys.join(old_registry.select(key_hash().alias("key_hash"), *KEY[1:], "pid"), KEY, "left"))
    new = found.filter(F.col("pid").isNull()).drop("pid").withColumn("temporal", F.when(F.col("n_own") > 0, F.col("temporal")).otherwise("unk"))
    ids = cut(found.filter(F.col("pid").isNotNull()).withColumn("serial", none("long")).unionByName(_issued(new, old_registry)))
    registry = ids.filter(F.col("serial").isNotNull()).select(*_columns("registry"))

    own_key = F.col("n_own") > 0
    named = ids.select(
        F.xxhash64("pid").alias("pid_hash"), "pid", F.col("kind").alias("t"), F.when(own_key, F.col("label")).otherwise(F.col("natural_key")).alias("l"), (~own_key).alias("s"))
    before = _of_regions(graph["entities"], touched).select(F.xxhash64("pid").alias("pid_hash"), "pid", "entity_type", "label", "stub")
    merged = _merged(named.join(before, ["pid_hash", "pid"], "left"))
    entities = cut(merged.filter("changed").select(region_of(F.col("pid")).alias("region"), "pid", "entity_type", "label", "stub"))

    first = rows.filter(F.col("source_uri").isNotNull()).groupBy(F.xxhash64("source_uri"), F.col("source_uri").alias("source_name")).agg(
        F.min_by(F.struct("source_type", "collector", "metadata"), "row_seq").alias("_first"))
    source = cut(first.select(
        "source_name", "_first.source_type", F.coalesce("_first.collector", C.collector_of(F.col("_first.metadata"))).alias("collector"), "_first.metadata"))
    evidence, by_name = new_evidence(graph["evidence"], source)

    # a popular subject or object may have most of the rows; only references are joined with their objects, as the nulls of all literals
    # would be one key, and that comes first, so that subjects are joined once
    ref = ["ref_hash", "ref_region", "ref_kind", "ref_key"]
    objects = ids.filter("n_refs > 0").select(*[F.col(c).alias(r) for c, r in zip(KEY, ref, strict=True)], F.col("pid").alias("object_id"), F.col("n_refs").alias("n"))
    built = attach(rows.filter("is_ref"), objects.drop("n"), ref, objects.select(*ref, "n"), F.xxhash64("row_seq", "batch_id"), "inner").unionByName(
        rows.filter("NOT is_ref").withColumn("object_id", none("string")))
    subjects = ids.filter(own_key).select(*KEY, F.col("pid").alias("subject_id"), F.col("n_own").alias("n"))
    built = attach(built, subjects.drop("n"), KEY, subjects.select(*KEY, "n"), F.xxhash64("row_seq"), "inner")
    source_hash = F.xxhash64("source_uri").alias("source_hash")
    built = built.withColumn("source_hash", source_hash).join(by_name.select(source_hash, "*"), ["source_hash", "source_uri"], "left")
    said_in = built.select("batch_id", region_of(F.col("subject_id")).alias("region"), *_columns("statements")[1:-2], *hashes(*map(F.col, _KEY)))
    statements = cut(missing(_of_regions(graph["statements"], touched), said_in))
    audit = checked.groupBy("batch_id").agg(F.count("*").alias("rows_in"), F.count_if(F.col("error").isNotNull()).alias("rows_err"))
    if batches:
        asked = staged.sparkSession.createDataFrame([(b,) for b in batches], "batch_id string")
        audit = asked.join(audit, "batch_id", "full_outer").fillna(0, ["rows_in", "rows_err"])
    inserted = statements.groupBy("batch_id").agg(F.count("*").alias("rows_inserted"))
    audit = audit.join(inserted, "batch_id", "left").fillna(0, ["rows_inserted"]).withColumn(
        "rows_skipped", F.col("rows_in") - F.col("rows_err") - F.col("rows_inserted")).withColumn(
        "status", F.when(F.col("rows_err") == 0, "success").otherwise("partial"))
    deltas = {"registry": registry, "entities": entities, "evidence": evidence, "statements": statements.drop("batch_id")}
    return deltas, audit, checked.filter(F.col("error").isNotNull()).select(*_PARSED, "stmt_value", "error")


def new_evidence(old: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new rows, ids by source_uri): sources that old has keep their id, others get the next ones in order of their name."""
    top = old.agg(F.coalesce(F.max("evidence_id"), F.lit(0))).first()[0]
    have = old.join(source.select("source_name"), "source_name", "left_semi").groupBy("source_name").agg(F.min("evidence_id").alias("evidence_id"))
    have = cut(have)
    unseen = source.join(have, "source_name", "left_anti")
    made = numbered(unseen, ["source_name"], None, "_n").withColumn("evidence_id", F.col("_n") + F.lit(top))
    made = cut(made.select(*old.columns))
    return made, have.unionByName(made.select("source_name", "evidence_id")).withColumnRenamed("source_name", "source_uri")


def promote(graph: Graph, staged: DataFrame, batches: list[str] | None = None) -> tuple[Graph, DataFrame, DataFrame]:
    """(new graph, audit, rejected rows)."""
    deltas, audit, rejected = promote_deltas(graph, staged, batches)
    return apply(graph, deltas), audit, rejected


def reclassify(entities: DataFrame, statements: DataFrame, predicate: str, layers: list[str], to: str) -> DataFrame:
    """Entities whose statement names one of the layers get another type; a second run changes nothing."""
    hit = statements.filter((F.col("predicate") == predicate) & F.col("object_value").isin(*layers)).select(F.col("subject_id").alias("pid")).distinct()
    marked = entities.join(hit.withColumn("_hit", F.lit(True)), "pid", "left")
    return marked.withColumn("entity_type", F.when(F.col("_hit"), to).otherwise(F.col("entity_type"))).drop("_hit")


def reclassify_registry(registry: DataFrame, entities: DataFrame) -> DataFrame:
    """registry with each identifier's kind as in entities (after reclassify); identifiers themselves never change."""
    kinds = entities.select("pid", F.col("entity_type").alias("_kind"))
    return registry.join(kinds, "pid", "left").withColumn("kind", F.coalesce("_kind", "kind")).select(*registry.columns)


def authority_list(registry: DataFrame, entities: DataFrame) -> DataFrame:
    """(region, entity_type, natural_key, label, pid) of every identifier, with its entity's label where there is one."""
    labels = entities.select("pid", "label")
    return registry.join(labels, "pid", "left").select("region", F.col("kind").alias("entity_type"), "natural_key", "label", "pid")


def write_authority(listed: DataFrame, path: str) -> None:
    """One folder of CSV files for each region, sorted by type and key; each file begins with a byte order mark."""
    named = listed.withColumnRenamed("entity_type", "\ufeffentity_type")
    named.repartitionByRange("region", "\ufeffentity_type", "natural_key").sortWithinPartitions("region", "\ufeffentity_type", "natural_key").write.partitionBy(
        "region").csv(path, header=True)
