"""Quality audit, vocabulary validation, alias normalisation and schema drift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnspark.functions.clean import percent
from cairnspark.functions.joins import attach, by_key
from cairnspark.functions.session import cut

TYPES = ("pl", "clu", "ac", "doc", "ev", "img")


def coverage(entities: DataFrame, expected: DataFrame) -> DataFrame:
    """D1: count of each expected (entity_type), present or not."""
    have = entities.groupBy("entity_type").agg(F.count("*").alias("n"))
    return expected.join(have, "entity_type", "left").select("entity_type", F.coalesce("n", F.lit(0)).alias("n"), F.col("n").isNull().alias("missing"))


def dangling(statements: DataFrame, entities: DataFrame, predicates: list[str]) -> DataFrame:
    """D2: share of reference statements whose object is no entity, by predicate."""
    refs = statements.filter(F.col("predicate").isin(*predicates))
    known = entities.select(F.col("pid").alias("object_id"), F.lit(1).alias("known"))
    joined = refs.join(known, "object_id", "left")
    bad = F.count_if(F.col("known").isNull())
    return joined.groupBy("predicate").agg(F.count("*").alias("n"), bad.alias("dangling"), F.round(percent(bad, F.count("*")), 4).alias("rate"))


def without_evidence(entities: DataFrame, statements: DataFrame) -> DataFrame:
    """D3: entities that no statement with evidence speaks of, by type."""
    spoken = statements.filter(F.col("evidence_id").isNotNull()).select(F.col("subject_id").alias("pid")).distinct().withColumn("spoken", F.lit(1))
    joined = entities.join(spoken, "pid", "left")
    bad = F.count_if(F.col("spoken").isNull())
    return joined.groupBy("entity_type").agg(F.count("*").alias("n"), bad.alias("unevidenced"), F.round(percent(bad, F.count("*")), 4).alias("rate"))


def outliers(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """D4: points outside their region's box; rate over all geometries and over places alone."""
    joined = points.join(boxes, "region")  # one box for each region, so the side is small; Spark measures it
    out = ~(F.col("x").between(F.col("lon_min"), F.col("lon_max")) & F.col("y").between(F.col("lat_min"), F.col("lat_max")))
    place = F.col("entity_type").isin("pl", "clu")
    bad = F.count_if(out & place)
    return joined.groupBy("region").agg(
        F.count("*").alias("geometries"), bad.alias("outliers"),
        F.round(percent(bad, F.count("*")), 4).alias("rate"), F.round(percent(bad, F.count_if(place)), 4).alias("place_rate"),
    )


def histogram(values: DataFrame, column: str, k: int) -> DataFrame:
    """D5 and demo pack: the k most frequent values, ties in order of the value."""
    return values.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)


def assets(entities: DataFrame, statements: DataFrame, kind: str = "pl", predicate: str = "depicts", by: str = "img") -> DataFrame:
    """D6: entities of a kind and those that an image's statement depicts, with their share in percent."""
    images = entities.filter(F.col("entity_type") == by).select(F.col("pid").alias("subject_id"))
    shown = statements.filter((F.col("predicate") == predicate) & F.col("object_id").isNotNull()).join(images, "subject_id", "left_semi")
    shown = shown.select(F.col("object_id").alias("pid")).distinct().withColumn("shown", F.lit(1))
    joined = entities.filter(F.col("entity_type") == kind).join(shown, "pid", "left")
    n, k = F.count("*"), F.count("shown")
    return joined.agg(n.alias("places"), k.alias("with_photo"), F.round(percent(k, n), 4).alias("rate"))


def type_values(values: DataFrame, column: str, k: int) -> DataFrame:
    """D5: the k most frequent values of a column, each beside the number of distinct values."""
    counted = values.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = counted.agg(F.count("*").alias("distinct_values"))
    return counted.orderBy(F.desc("n"), "value").limit(k).crossJoin(total)  # k rows by one


def region_metrics(entities: DataFrame, statements: DataFrame, points: DataFrame, boxes: DataFrame, predicates: list[str]) -> DataFrame:
    """D1 to D6 of every region in one row: n_entities, d2, d3, d4, d6 (percent), d5 (different values of hasType), as grade and report take them.

    entities: pid, entity_type, region; statements: subject_id, predicate, object_value, object_id, evidence_id. Statements of
    the named predicates refer to entities, and count as dangling where the object is null or no entity.
    """
    here = entities.select("pid", "entity_type", "region")
    evidenced = statements.filter(F.col("evidence_id").isNotNull()).select(F.col("subject_id").alias("pid")).distinct().withColumn("spoken", F.lit(1))
    images = here.filter("entity_type = 'img'").select(F.col("pid").alias("subject_id"))
    shown = statements.filter("predicate = 'depicts' AND object_id IS NOT NULL").join(images, "subject_id", "left_semi")
    shown = shown.select(F.col("object_id").alias("pid")).distinct().withColumn("shown", F.lit(1))
    place = F.col("entity_type") == "pl"
    by_entity = here.join(evidenced, "pid", "left").join(shown, "pid", "left").groupBy("region").agg(
        F.count("*").alias("n_entities"), percent(F.count_if(F.col("spoken").isNull()), F.count("*")).alias("d3"),
        percent(F.count_if(place & F.col("shown").isNotNull()), F.count_if(place)).alias("d6"))
    refs = statements.filter(F.col("predicate").isin(*predicates)).join(here.select(F.col("pid").alias("subject_id"), "region"), "subject_id")
    # null objects stay out of the join, as they would be one key
    known = refs.filter(F.col("object_id").isNotNull()).join(here.select(F.col("pid").alias("object_id")), "object_id", "left_semi")
    by_ref = refs.groupBy("region").agg(F.count("*").alias("refs")).join(known.groupBy("region").agg(F.count("*").alias("known")), "region", "left")
    by_ref = by_ref.select("region", percent(F.col("refs") - F.coalesce("known", F.lit(0)), F.col("refs")).alias("d2"))
    by_point = outliers(points, boxes).select("region", F.col("rate").alias("d4"))
    typed = statements.filter("predicate = 'hasType' AND object_value IS NOT NULL").join(here.select(F.col("pid").alias("subject_id"), "region"), "subject_id")
    by_type = typed.groupBy("region").agg(F.count_distinct("object_value").alias("d5"))
    zero = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 4).alias(c)
    return by_entity.join(by_ref, "region", "left").join(by_point, "region", "left").join(by_type, "region", "left").select(
        "region", "n_entities", *[zero(c) for c in ("d2", "d3", "d4")], F.coalesce("d5", F.lit(0)).alias("d5"), zero("d6"))


def grade(metrics: DataFrame) -> DataFrame:
    """Grade and actions from columns d2, d3, d4, d6 (percent) and n_entities."""
    mvp = (F.col("d3") == 0) & (F.col("d4") == 0)
    research = mvp & (F.col("d2") < 1) & (F.col("n_entities") >= 100)
    actions = F.concat_ws(
        ",",
        F.when(F.col("d2") >= 1, "repair_references"), F.when(F.col("d3") > 0, "add_evidence"),
        F.when(F.col("d4") > 0, "check_coordinates"), F.when(F.col("d6") < 80, "add_photos"),
    )
    level = F.when(research & (F.col("d6") >= 80), "publish").when(research, "research").when(mvp, "mvp").otherwise("draft")
    return metrics.select("*", level.alias("grade"), actions.alias("actions"))


def report(metrics: DataFrame) -> DataFrame:
    """(region, dimension, metric, value, verdict) rows of d2, d3, d4, d6 (percent), d5 and n_entities of every region."""
    checks = [
        ("D1", "entities", "n_entities", F.col("n_entities") > 0), ("D2", "dangling_percent", "d2", F.col("d2") < 1),
        ("D3", "unevidenced_percent", "d3", F.col("d3") == 0), ("D4", "outlier_percent", "d4", F.col("d4") == 0),
        ("D5", "type_values", "d5", F.col("d5") > 0), ("D6", "photo_percent", "d6", F.col("d6") >= 80),
    ]
    rows = [
        F.struct(F.lit(d).alias("dimension"), F.lit(m).alias("metric"), F.col(c).cast("double").alias("value"), F.when(ok, "pass").otherwise("check").alias("verdict"))
        for d, m, c, ok in checks
    ]
    return metrics.select("region", F.inline(F.array(*rows)))


def out_of_vocabulary(values: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Distinct values of each predicate and those outside its vocabulary, with their share in percent."""
    distinct = values.groupBy("predicate", "value").agg(F.count("*").alias("n"))
    known = vocabulary.select("predicate", "value", F.lit(1).alias("known"))
    joined = distinct.join(known, ["predicate", "value"], "left")
    bad = F.count_if(F.col("known").isNull())
    return joined.groupBy("predicate").agg(
        F.count("*").alias("n_values"), bad.alias("n_bad"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("known").isNull(), F.col("value")))), ",").alias("bad_values"),
        F.round(percent(bad, F.count("*")), 4).alias("bad_percent"),
    )


def numeric_range(values: DataFrame, low: float, high: float) -> DataFrame:
    """Count of values outside a range by predicate; text that is no number counts as outside."""
    x = F.col("value").try_cast("double")
    return values.groupBy("predicate").agg(
        F.count("*").alias("n"), F.count_if(x.isNull() | ~x.between(low, high)).alias("n_bad")
    )


def illegal_types(entities: DataFrame, legal: tuple[str, ...] = TYPES) -> DataFrame:
    """C1: entity types outside the schema, with their counts."""
    return entities.groupBy("entity_type").agg(F.count("*").alias("n")).filter(F.col("entity_type").isNull() | ~F.col("entity_type").isin(*legal))


def out_of_range(points: DataFrame) -> DataFrame:
    """C4: points (x, y) outside the globe."""
    bad = F.count_if(~(F.col("x").between(-180, 180) & F.col("y").between(-90, 90)))
    return points.agg(F.count("*").alias("n"), bad.alias("n_bad"))


def alignment(entities: DataFrame, values: DataFrame, vocabulary: DataFrame, numbers: DataFrame, low: float, high: float, points: DataFrame) -> DataFrame:
    """(check, n_bad) of C1 to C4 and the verdict over all of them: row "aligned" has 0 if all pass, else 1."""
    checks = [
        ("C1", illegal_types(entities).agg(F.count("*").alias("n_bad"))),
        ("C2", out_of_vocabulary(values, vocabulary).agg(F.coalesce(F.sum("n_bad"), F.lit(0)).alias("n_bad"))),
        ("C3", numeric_range(numbers, low, high).agg(F.coalesce(F.sum("n_bad"), F.lit(0)).alias("n_bad"))),
        ("C4", out_of_range(points).select("n_bad")),
    ]
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("check"), F.col("n_bad").cast("long").alias("n_bad")) for n, df in checks])
    verdict = rows.agg((F.sum("n_bad") > 0).cast("long").alias("n_bad")).select(F.lit("aligned").alias("check"), "n_bad")
    return rows.unionByName(verdict)


def _named(statements: DataFrame, aliases: DataFrame) -> DataFrame:
    return statements.join(aliases.select("predicate", F.col("alias").alias("object_value"), "canonical"), ["predicate", "object_value"], "left")


def alias_counts(statements: DataFrame, aliases: DataFrame) -> DataFrame:
    """Dry run of normalise: (predicate, alias, canonical, n) of the aliases that occur."""
    hit = _named(statements, aliases).filter(F.col("canonical").isNotNull())
    return hit.groupBy("predicate", F.col("object_value").alias("alias"), "canonical").agg(F.count("*").alias("n"))


def normalise(statements: DataFrame, aliases: DataFrame) -> DataFrame:
    """Statements, all columns kept, with aliases replaced by their canonical value.

    aliases: predicate, alias, canonical; all are mapped at once. A row with an alias goes only if the canonical value is
    there already for the same subject, predicate, evidence, object and start of validity (nulls equal), or if
    another row with an alias now says the same; rows without an alias all stay.
    """
    columns = statements.columns
    mapped = _named(statements, aliases)
    kept = mapped.filter(F.col("canonical").isNull()).select(*columns)
    changed = mapped.filter(F.col("canonical").isNotNull()).withColumn("object_value", F.col("canonical"))
    names = [c for c in ("evidence_id", "object_id", "valid_from") if c in columns]
    same = F.struct("subject_id", "predicate", "object_value", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(c) for c in names])
    changed = changed.withColumn("_same", same).dropDuplicates(["_same"])
    twins = kept.select(same.alias("_same")).join(aliases.select("predicate", F.col("canonical").alias("object_value")).distinct(), [
        F.col("_same.predicate") == F.col("predicate"), F.col("_same.object_value") == F.col("object_value")], "left_semi")
    return kept.unionByName(changed.join(twins, "_same", "left_anti").select(*columns))


def misplaced_units(entities: DataFrame, statements: DataFrame, layers: list[str], predicate: str = "hasLayer") -> DataFrame:
    """Reclassification checks both ways: (check, n_bad) of units without a layer of units, and of places with one."""
    layer = statements.filter(F.col("predicate") == predicate).select(F.col("subject_id").alias("pid"), F.col("object_value").alias("layer"))
    both = entities.filter(F.col("entity_type").isin("clu", "pl")).select("pid", "entity_type").join(layer, "pid", "left")
    fits = F.coalesce(F.col("layer").isin(*layers), F.lit(False))
    counted = both.agg(
        F.count_if((F.col("entity_type") == "clu") & ~fits).alias("unit"), F.count_if((F.col("entity_type") == "pl") & fits).alias("place"))
    return counted.select(F.inline(F.array(
        F.struct(F.lit("unit_without_unit_layer").alias("check"), F.col("unit").alias("n_bad")), F.struct(F.lit("place_with_unit_layer").alias("check"), F.col("place").alias("n_bad")))))


def provenance(statements: DataFrame, entities: DataFrame, evidence: DataFrame) -> DataFrame:
    """(subject_id, label, predicate, source) of the statements whose evidence (evidence_id, source) and subject are known.

    Many statements share a piece of evidence: only evidence that some statement has is joined, and what is popular is dealt out (see attach).
    """
    used = statements.filter(F.col("evidence_id").isNotNull()).groupBy("evidence_id").agg(F.count("*").alias("n"))
    side = cut(used.join(evidence, "evidence_id"))
    said = statements.select("subject_id", "predicate", "evidence_id")
    size = F.coalesce(F.octet_length("source"), F.lit(0)) + 40
    rows = attach(said, side.drop("n"), ["evidence_id"], side.select("evidence_id", "n").distinct(), F.xxhash64("subject_id", "predicate"), "inner", size)
    total = side.agg(F.sum("n")).first()[0] or 0
    named = entities.select(F.col("pid").alias("subject_id"), "label")
    return by_key(rows, "subject_id", total).join(by_key(named, "subject_id", total), "subject_id").select("subject_id", "label", "predicate", "source")


def drift(actual: DataFrame, canonical: DataFrame) -> DataFrame:
    """(table, column, status) of columns that one side lacks."""
    a = actual.select("table", "column", F.lit(1).alias("a"))
    c = canonical.select("table", "column", F.lit(1).alias("c"))
    both = a.join(c, ["table", "column"], "full_outer").filter(F.col("a").isNull() | F.col("c").isNull())
    return both.select("table", "column", F.when(F.col("a").isNull(), "missing").otherwise("extra").alias("status"))
