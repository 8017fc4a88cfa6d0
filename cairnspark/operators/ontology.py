"""Predicate inventory, domains and ranges, standard-vocabulary mapping and graph tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnspark.functions.joins import by_key

#: Classes of entity types with their labels and standard class.
CLASSES = {
    "pl": ("Place", "地点", "E53_Place"), "clu": ("CulturalLandscapeUnit", "文化景观单元", "E27_Site"), "ac": ("Actor", "行动者", "E39_Actor"),
    "doc": ("Document", "文档", "E31_Document"), "ev": ("Event", "事件", "E5_Event"), "img": ("DigitalImage", "图像", "E36_Visual_Item"),
}
#: Predicates whose values are decimals.
NUMERIC = ("hasEmotionScore", "hasAmount", "hasPaidAmount", "hasConvertedAmount", "hasArea", "hasShapeArea", "hasShapeLength")
#: Curated mapping of predicates to a standard term, with the level of the match.
CURATED = {
    "tookPlaceIn": ("P7_took_place_at", "exact"), "carriedOutBy": ("P14_carried_out_by", "exact"), "containsPlace": ("P89_falls_within", "close"),
    "locatedAt": ("P168_place_is_defined_by", "close"), "mentionsPlaceEntity": ("P67_refers_to", "broad"), "mentionsGroup": ("P67_refers_to", "broad"),
    "hasSender": ("—", "none"), "hasRecipient": ("—", "none"), "hasOriginPlace": ("P27_moved_from", "broad"), "hasDestinationPlace": ("P26_moved_to", "broad"),
    "hasName": ("P1_is_identified_by", "close"), "hasTitle": ("P102_has_title", "close"), "hasAuthor": ("P14_carried_out_by", "broad"),
}
#: Properties that the written ontology matches with a standard one.
MATCHED = {
    "tookPlaceIn": "P7_took_place_at", "carriedOutBy": "P14_carried_out_by", "containsPlace": "P89_falls_within", "locatedAt": "P168_place_is_defined_by",
}
#: For other predicates the first group with a part of the predicate's name decides.
RULES = (
    (("Date", "Time", "Era", "Span", "captured"), "P4_has_time-span", "broad"),
    (("Type", "Layer", "Category", "EventType"), "P2_has_type", "close"),
    (("Code", "Number", "Reference", "Batch", "Identifier"), "P1_is_identified_by", "close"),
    (("Description", "Note", "FullText", "Abstract", "Record", "SurveyHistory", "CulturalValue", "Concept"), "P3_has_note / P190", "close"),
    (("Address", "Prefecture", "County", "Town", "Village", "District", "Country"), "P87_is_identified_by", "broad"),
)
RDF, RDFS, OWL = "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "http://www.w3.org/2000/01/rdf-schema#", "http://www.w3.org/2002/07/owl#"
XSD, SKOS, CRM = "http://www.w3.org/2001/XMLSchema#", "http://www.w3.org/2004/02/skos/core#", "http://www.cidoc-crm.org/cidoc-crm/"


def inventory(statements: DataFrame, entities: DataFrame) -> DataFrame:
    """Each predicate with sorted subject and object types, what its objects are, its count and its category (see category).

    Only statements with an object are joined with it, as the null objects of all literals would be one key. statements
    may lack the column geometry. Texts that only have to be there do not move, and what a task sorts has a bound (see by_key).
    """
    s = entities.select(F.col("pid").alias("subject_id"), F.col("entity_type").alias("subject_type"))
    o = entities.select(F.col("pid").alias("object_id"), F.col("entity_type").alias("object_type"))
    shape = F.col("geometry") if "geometry" in statements.columns else F.lit(None).cast("string")
    said = statements.select("subject_id", "predicate", F.col("object_value").isNotNull().alias("has_value"), "object_id", shape.isNotNull().alias("has_geo"))
    total, with_object = said.agg(F.count("*"), F.count("object_id")).first()
    typed = by_key(said, "subject_id", total).join(by_key(s, "subject_id", total), "subject_id").drop("subject_id")
    ref = typed.filter(F.col("object_id").isNotNull())
    ref = by_key(ref, "object_id", with_object).join(by_key(o, "object_id", with_object), "object_id", "left")
    rest = typed.filter(F.col("object_id").isNull()).withColumn("object_type", F.lit(None).cast("string"))
    found = ref.unionByName(rest).groupBy("predicate").agg(
        F.array_join(F.array_sort(F.collect_set("subject_type")), ",").alias("domain"),
        F.array_join(F.array_sort(F.collect_set("object_type")), ",").alias("object_types"),
        F.bool_or(F.col("object_id").isNotNull()).alias("has_ref"),
        F.bool_or("has_value").alias("has_value"),
        F.bool_or("has_geo").alias("has_geo"),
        F.count("*").alias("n"),
    )
    return found.withColumn("category", category(F.col("has_ref"), F.col("has_geo")))


def category(has_ref: Column, has_geo: Column) -> Column:
    """Edges refer to entities, spatial predicates hold geometries and no references, the others are attributes."""
    return F.when(has_ref, "edge").when(has_geo, "spatial").otherwise("attribute")


def merge_inventories(*found: DataFrame) -> DataFrame:
    """One inventory of several regions' inventories."""
    types = lambda c: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.filter(F.split(c, ","), lambda t: t != ""))))), ",").alias(c)
    flags = ("has_ref", "has_value", "has_geo")
    merged = reduce(DataFrame.unionByName, found).groupBy("predicate").agg(
        types("domain"), types("object_types"), *[F.bool_or(c).alias(c) for c in flags], F.sum("n").alias("n"))
    return merged.withColumn("category", category(F.col("has_ref"), F.col("has_geo")))


def geometry_sources(inventoried: DataFrame) -> DataFrame:
    """Entity types that have geometries: the sources of the edges to the geometry node."""
    return inventoried.filter("has_geo").select(F.explode(F.split("domain", ",")).alias("entity_type")).distinct()


def class_nodes(inventoried: DataFrame, spark: SparkSession) -> DataFrame:
    """(entity_type, class, label, attributes): every class with its number of attribute predicates."""
    known = spark.createDataFrame([(t, c, zh) for t, (c, zh, _) in CLASSES.items()], "entity_type string, class string, label string")
    counts = inventoried.filter("category = 'attribute'").select(F.explode(F.split("domain", ",")).alias("entity_type")).groupBy("entity_type").agg(F.count("*").alias("k"))
    return known.join(counts, "entity_type", "left").select("entity_type", "class", "label", F.coalesce("k", F.lit(0)).alias("attributes"))


def with_labels(inventoried: DataFrame, spec: DataFrame) -> DataFrame:
    """inventoried with the display label of each predicate: the first filled one in the order (ord) of the sheets."""
    first = spec.filter(F.col("label").isNotNull() & (F.col("label") != "")).groupBy("predicate").agg(F.min_by("label", "ord").alias("label"))
    return inventoried.join(first, "predicate", "left")


def class_names(types: Column) -> Column:
    """Sorted class names of comma-separated entity types; unknown types are left out."""
    names = F.create_map(*[F.lit(x) for t, (c, _, _) in CLASSES.items() for x in (t, c)])
    return F.array_sort(F.filter(F.transform(F.split(types, ","), lambda t: F.try_element_at(names, t)), lambda c: c.isNotNull()))


def ranges(inventoried: DataFrame, numeric: tuple[str, ...] = NUMERIC) -> DataFrame:
    """Domain and range of each predicate by class names, unions where there are several classes."""

    def joined(types: str) -> Column:
        names = class_names(F.col(types))
        return F.when(F.size(names) > 1, F.concat(F.lit("union("), F.array_join(names, ","), F.lit(")"))).otherwise(F.array_join(names, ","))

    data = F.when(F.col("predicate").isin(*numeric), "decimal").otherwise("string")
    return inventoried.select("predicate", joined("domain").alias("domain"), F.when(F.col("has_ref"), joined("object_types")).otherwise(data).alias("range"), "n")


def top_attributes(statements: DataFrame, entities: DataFrame, k: int) -> DataFrame:
    """The k most frequent literal predicates of each class."""
    literal = statements.filter(F.col("object_value").isNotNull()).join(entities.select(F.col("pid").alias("subject_id"), "entity_type"), "subject_id")
    counted = literal.groupBy("entity_type", "predicate").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("entity_type").orderBy(F.desc("n"), "predicate"))
    return counted.withColumn("rank", rank).filter(F.col("rank") <= k)


def crm(predicate: Column) -> tuple[Column, Column]:
    """(term, level): the curated mapping, else the first rule with a part of the name, else none."""
    term, level = F.lit("—"), F.lit("none")
    for parts, t, how in reversed(RULES):
        hit = predicate.rlike("|".join(parts))
        term, level = F.when(hit, t).otherwise(term), F.when(hit, how).otherwise(level)
    for p, (t, how) in CURATED.items():
        term, level = F.when(predicate == p, t).otherwise(term), F.when(predicate == p, how).otherwise(level)
    return term, level


def crm_levels(mapped: DataFrame) -> DataFrame:
    """Number of terms at each level of match."""
    return mapped.groupBy("level").agg(F.count("*").alias("n"))


def class_graph(statements: DataFrame, entities: DataFrame) -> DataFrame:
    """Edges between classes with their sorted predicates."""
    s = entities.select(F.col("pid").alias("subject_id"), F.col("entity_type").alias("source"))
    o = entities.select(F.col("pid").alias("object_id"), F.col("entity_type").alias("target"))
    typed = statements.filter(F.col("object_id").isNotNull()).join(s, "subject_id").join(o, "object_id")
    return typed.groupBy("source", "target").agg(F.array_join(F.array_sort(F.collect_set("predicate")), ",").alias("predicates"), F.count("*").alias("n"))


def attribute_star(statements: DataFrame, predicates: list[str]) -> DataFrame:
    """Edges from an entity to one node {entity}::{predicate}::{value} for each literal of the named predicates."""
    literal = statements.filter(F.col("predicate").isin(*predicates) & F.col("object_value").isNotNull())
    node = F.concat_ws("::", "subject_id", "predicate", "object_value")
    return literal.select(F.col("subject_id").alias("source"), node.alias("target"), F.col("predicate").alias("label")).distinct()


def child_types(statements: DataFrame, entities: DataFrame, types: DataFrame, predicate: str) -> DataFrame:
    """(parent, type, n): distinct children of each parent by type; children without one count as unknown.

    types: pid, type. Edges run from child to parent.
    """
    edges = statements.filter(F.col("predicate") == predicate).select(F.col("object_id").alias("parent"), F.col("subject_id").alias("pid")).distinct()
    typed = edges.join(entities.select("pid"), "pid").join(types, "pid", "left")
    return typed.groupBy("parent", F.coalesce("type", F.lit("unknown")).alias("type")).agg(F.count_distinct("pid").alias("n"))


def container_star(statements: DataFrame, entities: DataFrame, types: DataFrame, predicate: str, width: int = 14) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of all containers: a node for each with its number of children, one for each child with its type (unknown without one), each
    entity once, and an edge to each child.

    nodes: id, label (a child's is cut to width characters), kind, type, n; edges: source, target. types: pid, type. Statements of the predicate
    run from child to container. An entity that is both is a container.
    """
    edges = statements.filter((F.col("predicate") == predicate) & F.col("object_id").isNotNull()).select(F.col("object_id").alias("source"), F.col("subject_id").alias("target")).distinct()
    named = entities.select("pid", "label")
    edges = edges.join(named.select(F.col("pid").alias("source")), "source", "left_semi").join(named.select(F.col("pid").alias("target")), "target", "left_semi").select("source", "target")
    counts = edges.groupBy(F.col("source").alias("id")).agg(F.count("*").alias("n"))
    containers = counts.join(named.withColumnRenamed("pid", "id"), "id").select("id", "label", F.lit("container").alias("kind"), F.lit(None).cast("string").alias("type"), "n")
    children = edges.select(F.col("target").alias("id")).distinct().join(counts.select("id"), "id", "left_anti").join(named.withColumnRenamed("pid", "id"), "id").join(
        types.withColumnRenamed("pid", "id"), "id", "left")
    children = children.select("id", F.left("label", F.lit(width)).alias("label"), F.lit("child").alias("kind"), F.coalesce("type", F.lit("unknown")).alias("type"), F.lit(None).cast("long").alias("n"))
    return containers.unionByName(children), edges


def _escaped(text: Column) -> Column:
    """A text as it stands between the quotes of an N-Triples literal."""
    for plain, said in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(plain), F.lit(said))
    return text


def triples(inventoried: DataFrame, base: str = "urn:kg:") -> DataFrame:
    """N-Triples lines of the terms: kind, domain, range and standard match (MATCHED) of each property, and its label if there is one.

    Several classes are one union, as a list; its blank nodes are named after the property, so the same terms give the same lines.
    """
    iri = lambda x: F.lit(f"<{x}>")
    own = lambda c: F.concat(F.lit(f"<{base}"), c, F.lit(">"))
    told = lambda subject, verb, what: F.concat_ws(" ", subject, iri(verb), what, F.lit("."))
    line = lambda verb, what: told(own(F.col("predicate")), verb, what)
    none = F.array().cast("array<string>")

    def classes(types: str, verb: str) -> Column:
        names, blank = class_names(F.col(types)), F.concat(F.lit("_:"), F.regexp_replace("predicate", "[^A-Za-z0-9]", "x"), F.lit(f"-{verb}"))
        at = lambda i: F.concat(blank, F.lit("-"), i.cast("string"))
        listed = F.flatten(F.transform(names, lambda c, i: F.array(
            told(at(i), f"{RDF}first", own(c)), told(at(i), f"{RDF}rest", F.when(i + 1 < F.size(names), at(i + 1)).otherwise(iri(f"{RDF}nil"))))))
        union = F.array(line(f"{RDFS}{verb}", blank), told(blank, f"{RDF}type", iri(f"{OWL}Class")), told(blank, f"{OWL}unionOf", at(F.lit(0))))
        return F.when(F.size(names) == 0, none).when(F.size(names) == 1, F.array(line(f"{RDFS}{verb}", own(names[0])))).otherwise(F.concat(union, listed))

    edge, spatial = F.col("category") == "edge", F.col("category") == "spatial"
    decimal = F.when(F.col("predicate").isin(*NUMERIC), "decimal").otherwise("string")
    term = F.try_element_at(F.create_map(*[F.lit(x) for pair in MATCHED.items() for x in pair]), F.col("predicate"))
    label = F.col("label") if "label" in inventoried.columns else F.lit(None).cast("string")
    parts = F.concat(
        F.array(line(f"{RDF}type", F.concat(F.lit(f"<{OWL}"), F.when(edge | spatial, "ObjectProperty").otherwise("DatatypeProperty"), F.lit(">")))),
        classes("domain", "domain"),
        F.when(edge, classes("object_types", "range")).when(spatial, F.array(line(f"{RDFS}range", own(F.lit("Geometry")))))
        .otherwise(F.array(line(f"{RDFS}range", F.concat(F.lit(f"<{XSD}"), decimal, F.lit(">"))))),
        F.when(term.isNotNull(), F.array(line(f"{SKOS}closeMatch", F.concat(F.lit(f"<{CRM}"), term, F.lit(">"))))).otherwise(none),
        F.when(label.isNotNull(), F.array(line(f"{RDFS}label", F.concat(F.lit('"'), _escaped(label), F.lit('"@zh'))))).otherwise(none),
    )
    return inventoried.select(F.explode(parts).alias("line"))


def write_triples(inventoried: DataFrame, path: str, base: str = "urn:kg:") -> None:
    """The lines as text files, with those of the classes."""
    spark = inventoried.sparkSession
    rows = [(f"<{base}{c}> <{p}> {o} .",) for _, (c, zh, match) in CLASSES.items() for p, o in (
        (f"{RDF}type", f"<{OWL}Class>"), (f"{RDFS}label", f'"{zh}"@zh'), (f"{RDFS}label", f'"{c}"@en'), (f"{SKOS}closeMatch", f"<{CRM}{match}>"))]
    triples(inventoried, base).unionByName(spark.createDataFrame(rows, "line string")).write.text(path)
