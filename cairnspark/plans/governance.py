"""Audit, validation, ontology and matching queries."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.functions import clean as C
from cairnspark.functions.session import fresh_folder, table
from cairnspark.operators import govern, match, ontology, promote
from cairnspark.operators.connect import fan_out
from cairnspark.plans.graph import ENTITIES, STATEMENTS, entities, lat, lon, statements
from cairnspark.plans.registry import query


@query(f"""WITH {ENTITIES}, e AS (SELECT unnest(['pl', 'clu', 'ac', 'doc', 'ev', 'img', 'xx']) AS entity_type)
SELECT e.entity_type, count(pid) AS n, count(pid) = 0 AS missing FROM e LEFT JOIN entities USING (entity_type) GROUP BY 1""")
def audit_d1_coverage(spark: SparkSession, d: str) -> DataFrame:
    expected = spark.createDataFrame([(t,) for t in (*govern.TYPES, "xx")], "entity_type string")
    return govern.coverage(entities(spark, d), expected)


@query(f"""WITH {ENTITIES}, {STATEMENTS} SELECT predicate, count(*) AS n, count(*) FILTER (WHERE e.pid IS NULL) AS dangling,
round(count(*) FILTER (WHERE e.pid IS NULL) * 100.0 / count(*), 4) AS rate FROM statements s LEFT JOIN entities e ON e.pid = s.object_id
WHERE predicate IN ('hasSender', 'locatedIn', 'carriedOutBy') GROUP BY 1""")
def audit_d2_dangling(spark: SparkSession, d: str) -> DataFrame:
    return govern.dangling(statements(spark, d), entities(spark, d), ["hasSender", "locatedIn", "carriedOutBy"])


@query(f"""WITH {ENTITIES}, {STATEMENTS} SELECT entity_type, count(*) AS n, count(*) FILTER (WHERE s.subject_id IS NULL) AS unevidenced,
round(count(*) FILTER (WHERE s.subject_id IS NULL) * 100.0 / count(*), 4) AS rate
FROM entities e LEFT JOIN (SELECT DISTINCT subject_id FROM statements WHERE evidence_id IS NOT NULL) s ON s.subject_id = e.pid GROUP BY 1""")
def audit_d3_no_evidence(spark: SparkSession, d: str) -> DataFrame:
    return govern.without_evidence(entities(spark, d), statements(spark, d))


PLACES = """places AS (SELECT 'r' || n_regionkey AS region, CASE WHEN c_custkey % 5 = 0 THEN 'img' ELSE 'pl' END AS entity_type,
CAST(c_custkey * 7919 % 36000 AS DOUBLE) / 100.0 - 180.0 AS x, CAST(c_custkey * 104729 % 18000 AS DOUBLE) / 100.0 - 90.0 AS y FROM customer JOIN nation ON c_nationkey = n_nationkey),
boxes AS (SELECT 'r' || r_regionkey AS region, -150.0 + 10 * r_regionkey AS lon_min, 150.0 AS lon_max, -80.0 AS lat_min, 80.0 - r_regionkey AS lat_max FROM region)"""


def _places(spark: SparkSession, d: str) -> DataFrame:
    joined = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("region"),
        F.when(F.col("c_custkey") % 5 == 0, "img").otherwise("pl").alias("entity_type"), lon("c_custkey").alias("x"), lat("c_custkey").alias("y"),
    )


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("r_regionkey")
    return table(spark, d, "region").select(
        F.concat(F.lit("r"), k.cast("string")).alias("region"), (-150.0 + 10 * k).alias("lon_min"), F.lit(150.0).alias("lon_max"),
        F.lit(-80.0).alias("lat_min"), (80.0 - k).alias("lat_max"),
    )


@query(f"""WITH {PLACES}, f AS (SELECT p.*, NOT (x BETWEEN lon_min AND lon_max AND y BETWEEN lat_min AND lat_max) AS outside FROM places p JOIN boxes USING (region))
SELECT region, count(*) AS geometries, count(*) FILTER (WHERE outside AND entity_type IN ('pl', 'clu')) AS outliers,
round(count(*) FILTER (WHERE outside AND entity_type IN ('pl', 'clu')) * 100.0 / count(*), 4) AS rate,
round(count(*) FILTER (WHERE outside AND entity_type IN ('pl', 'clu')) * 100.0 / count(*) FILTER (WHERE entity_type IN ('pl', 'clu')), 4) AS place_rate FROM f GROUP BY 1""")
def audit_d4_outliers(spark: SparkSession, d: str) -> DataFrame:
    return govern.outliers(_places(spark, d), _boxes(spark, d))


@query(f"WITH {STATEMENTS} SELECT object_value AS value, count(*) AS n, (SELECT count(DISTINCT object_value) FROM statements WHERE predicate = 'hasType') AS distinct_values FROM statements WHERE predicate = 'hasType' GROUP BY 1 ORDER BY n DESC, value LIMIT 15")
def audit_d5_types(spark: SparkSession, d: str) -> DataFrame:
    return govern.type_values(statements(spark, d).filter("predicate = 'hasType'"), "object_value", 15)


@query(f"""WITH {ENTITIES}, {STATEMENTS}, p AS (SELECT pid IN (SELECT object_id FROM statements WHERE predicate = 'depicts' AND subject_id LIKE 'img:%') AS shown FROM entities WHERE entity_type = 'pl')
SELECT count(*) AS places, count(*) FILTER (WHERE shown) AS with_photo, round(count(*) FILTER (WHERE shown) * 100.0 / count(*), 4) AS rate FROM p""")
def audit_d6_assets(spark: SparkSession, d: str) -> DataFrame:
    return govern.assets(entities(spark, d), statements(spark, d))


_REFS = ["hasSender", "locatedIn", "carriedOutBy", "depicts"]
#: D1 to D6 of each region, straight from the tables.
_METRICS = f"""{ENTITIES}, {STATEMENTS}, {PLACES}, e AS (SELECT *, 'r' || CAST(split_part(pid, ':', 2) AS BIGINT) % 5 AS region FROM entities),
s1 AS (SELECT region, count(*) AS n_entities, count(*) FILTER (WHERE pid NOT IN (SELECT subject_id FROM statements WHERE evidence_id IS NOT NULL)) * 100.0 / count(*) AS d3,
count(*) FILTER (WHERE entity_type = 'pl' AND pid IN (SELECT object_id FROM statements WHERE predicate = 'depicts' AND object_id IS NOT NULL)) * 100.0 / count(*) FILTER (WHERE entity_type = 'pl') AS d6 FROM e GROUP BY 1),
s2 AS (SELECT region, count(*) FILTER (WHERE o.pid IS NULL) * 100.0 / count(*) AS d2 FROM statements t JOIN e ON t.subject_id = e.pid LEFT JOIN entities o ON o.pid = t.object_id
WHERE predicate IN ('hasSender', 'locatedIn', 'carriedOutBy', 'depicts') GROUP BY 1),
s4 AS (SELECT region, round(count(*) FILTER (WHERE entity_type IN ('pl', 'clu') AND NOT (x BETWEEN lon_min AND lon_max AND y BETWEEN lat_min AND lat_max)) * 100.0 / count(*), 4) AS d4 FROM places JOIN boxes USING (region) GROUP BY 1),
s5 AS (SELECT region, count(DISTINCT object_value) AS d5 FROM statements JOIN e ON subject_id = pid WHERE predicate = 'hasType' GROUP BY 1),
m AS (SELECT s1.region, n_entities, round(coalesce(d2, 0), 4) AS d2, round(d3, 4) AS d3, round(coalesce(d4, 0), 4) AS d4, coalesce(d5, 0) AS d5, round(d6, 4) AS d6 FROM s1 LEFT JOIN s2 USING (region) LEFT JOIN s4 USING (region) LEFT JOIN s5 USING (region))"""


def _region_metrics(spark: SparkSession, d: str) -> DataFrame:
    region = F.concat(F.lit("r"), (F.split_part("pid", F.lit(":"), F.lit(2)).cast("long") % 5).cast("string"))
    return govern.region_metrics(entities(spark, d).withColumn("region", region), statements(spark, d), _places(spark, d), _boxes(spark, d), _REFS)


@query(f"WITH {_METRICS} SELECT * FROM m")
def audit_region_metrics(spark: SparkSession, d: str) -> DataFrame:
    """D1 to D6 of every region, which grade and report read."""
    return _region_metrics(spark, d)


@query(f"""WITH {_METRICS}
SELECT region, n_entities, CASE WHEN d3 = 0 AND d4 = 0 AND d2 < 1 AND n_entities >= 100 AND d6 >= 80 THEN 'publish' WHEN d3 = 0 AND d4 = 0 AND d2 < 1 AND n_entities >= 100 THEN 'research'
WHEN d3 = 0 AND d4 = 0 THEN 'mvp' ELSE 'draft' END AS grade,
concat_ws(',', CASE WHEN d2 >= 1 THEN 'repair_references' END, CASE WHEN d3 > 0 THEN 'add_evidence' END, CASE WHEN d4 > 0 THEN 'check_coordinates' END, CASE WHEN d6 < 80 THEN 'add_photos' END) AS actions FROM m""")
def audit_grade(spark: SparkSession, d: str) -> DataFrame:
    return govern.grade(_region_metrics(spark, d)).select("region", "n_entities", "grade", "actions")


@query(f"""WITH {_METRICS}
SELECT region, 'D1' AS dimension, 'entities' AS metric, CAST(n_entities AS DOUBLE) AS value, CASE WHEN n_entities > 0 THEN 'pass' ELSE 'check' END AS verdict FROM m UNION ALL SELECT region, 'D2', 'dangling_percent', d2, CASE WHEN d2 < 1 THEN 'pass' ELSE 'check' END FROM m
UNION ALL SELECT region, 'D3', 'unevidenced_percent', d3, CASE WHEN d3 = 0 THEN 'pass' ELSE 'check' END FROM m UNION ALL SELECT region, 'D4', 'outlier_percent', d4, CASE WHEN d4 = 0 THEN 'pass' ELSE 'check' END FROM m
UNION ALL SELECT region, 'D5', 'type_values', CAST(d5 AS DOUBLE), CASE WHEN d5 > 0 THEN 'pass' ELSE 'check' END FROM m UNION ALL SELECT region, 'D6', 'photo_percent', d6, CASE WHEN d6 >= 80 THEN 'pass' ELSE 'check' END FROM m""")
def audit_report(spark: SparkSession, d: str) -> DataFrame:
    return govern.report(_region_metrics(spark, d))


@query(f"WITH {ENTITIES} SELECT entity_type, count(*) AS n FROM entities WHERE entity_type NOT IN ('pl', 'clu', 'doc', 'img') GROUP BY 1")
def validate_types(spark: SparkSession, d: str) -> DataFrame:
    return govern.illegal_types(entities(spark, d), ("pl", "clu", "doc", "img"))


VOCABULARY = [("hasType", "BUILDING"), ("hasType", "AUTOMOBILE"), ("hasType", "click"), ("hasType", "view"), ("hasPriority", "1-URGENT"), ("hasPriority", "2-HIGH"), ("hasPriority", "5-LOW")]
_VOCABULARY_SQL = "v(predicate, value) AS (VALUES " + ", ".join(f"('{p}', '{v}')" for p, v in VOCABULARY) + ")"


@query(f"""WITH {STATEMENTS}, {_VOCABULARY_SQL}, u AS (SELECT DISTINCT predicate, object_value AS value FROM statements WHERE predicate IN ('hasType', 'hasPriority'))
SELECT u.predicate, count(*) AS n_values, count(*) FILTER (WHERE v.value IS NULL) AS n_bad, coalesce(string_agg(u.value, ',' ORDER BY u.value) FILTER (WHERE v.value IS NULL), '') AS bad_values,
round(count(*) FILTER (WHERE v.value IS NULL) * 100.0 / count(*), 4) AS bad_percent FROM u LEFT JOIN v ON u.predicate = v.predicate AND u.value = v.value GROUP BY 1""")
def validate_vocab_m1_m2(spark: SparkSession, d: str) -> DataFrame:
    values = statements(spark, d).filter(F.col("predicate").isin("hasType", "hasPriority")).select("predicate", F.col("object_value").alias("value"))
    return govern.out_of_vocabulary(values, spark.createDataFrame(VOCABULARY, "predicate string, value string"))


@query("""WITH v AS (SELECT 'size' AS predicate, CAST(p_size AS VARCHAR) AS value FROM part UNION ALL SELECT 'brand', p_brand FROM part)
SELECT predicate, count(*) AS n, count(*) FILTER (WHERE TRY_CAST(value AS DOUBLE) IS NULL OR TRY_CAST(value AS DOUBLE) NOT BETWEEN 5 AND 40) AS n_bad FROM v GROUP BY 1""")
def validate_numeric(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    values = part.select(F.inline(fan_out(("predicate", "value"), (F.lit("size"), F.col("p_size").cast("string")), (F.lit("brand"), F.col("p_brand")))))
    return govern.numeric_range(values, 5, 40)


@query("SELECT count(*) AS n, count(*) FILTER (WHERE abs(c_acctbal / 25) > 180 OR abs(c_acctbal / 50) > 90) AS n_bad FROM customer")
def validate_coords(spark: SparkSession, d: str) -> DataFrame:
    return govern.out_of_range(table(spark, d, "customer").select((F.col("c_acctbal") / 25).alias("x"), (F.col("c_acctbal") / 50).alias("y")))


@query(f"""WITH {ENTITIES}, {STATEMENTS}, {_VOCABULARY_SQL}, u AS (SELECT DISTINCT predicate, object_value AS value FROM statements WHERE predicate IN ('hasType', 'hasPriority')),
c AS (SELECT 'C1' AS "check", CAST(coalesce(sum(n), 0) AS BIGINT) AS n_bad FROM (SELECT CAST(count(DISTINCT entity_type) AS BIGINT) AS n FROM entities WHERE entity_type NOT IN ('pl', 'clu', 'ac', 'doc', 'ev', 'img'))
UNION ALL SELECT 'C2', count(*) FROM u WHERE (predicate, value) NOT IN (SELECT predicate, value FROM v) UNION ALL SELECT 'C3', count(*) FROM customer WHERE c_acctbal NOT BETWEEN 0 AND 9000
UNION ALL SELECT 'C4', count(*) FROM customer WHERE abs(c_acctbal / 25) > 180 OR abs(c_acctbal / 50) > 90)
SELECT * FROM c UNION ALL SELECT 'aligned', CAST(sum(n_bad) > 0 AS BIGINT) FROM c""")
def alignment_verdict(spark: SparkSession, d: str) -> DataFrame:
    """C1 to C4 and whether all of them pass."""
    said, people = statements(spark, d), table(spark, d, "customer")
    values = said.filter(F.col("predicate").isin("hasType", "hasPriority")).select("predicate", F.col("object_value").alias("value"))
    numbers = said.filter("predicate = 'hasAmount'").select("predicate", F.col("object_value").alias("value"))
    points = people.select((F.col("c_acctbal") / 25).alias("x"), (F.col("c_acctbal") / 50).alias("y"))
    return govern.alignment(entities(spark, d), values, spark.createDataFrame(VOCABULARY, "predicate string, value string"), numbers, 0, 9000, points)


_TWINS = """t AS (SELECT subject_id, predicate, object_value, evidence_id FROM statements WHERE predicate = 'hasType'
UNION ALL SELECT 'ac:' || c_custkey, 'hasType', 'CONSTRUCTION', CASE WHEN c_custkey % 4 = 1 THEN 99 WHEN c_custkey % 9 <> 0 THEN c_custkey % 3 + 1 END FROM customer WHERE c_custkey % 4 IN (0, 1)),
a(alias, canonical) AS (VALUES ('BUILDING', 'CONSTRUCTION'), ('click', 'view'), ('AUTOMOBILE', 'CONSTRUCTION'))"""


def _aliased(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Types of the graph, with the canonical value beside some aliases: with the same evidence, and with another one."""
    c = F.col("c_custkey")
    ev = F.when(c % 4 == 1, 99).when(c % 9 != 0, c % 3 + 1).cast("long")
    more = table(spark, d, "customer").filter((c % 4).isin(0, 1)).select(
        F.concat(F.lit("ac:"), c.cast("string")).alias("subject_id"), F.lit("hasType").alias("predicate"), F.lit("CONSTRUCTION").alias("object_value"), ev.alias("evidence_id"))
    rows = statements(spark, d).filter("predicate = 'hasType'").select("subject_id", "predicate", "object_value", "evidence_id").unionByName(more)
    aliases = [("hasType", "BUILDING", "CONSTRUCTION"), ("hasType", "click", "view"), ("hasType", "AUTOMOBILE", "CONSTRUCTION")]
    return rows, spark.createDataFrame(aliases, "predicate string, alias string, canonical string")


@query(f"""WITH {STATEMENTS}, {_TWINS}, k AS (SELECT t.*, canonical FROM t LEFT JOIN a ON object_value = alias)
SELECT subject_id, coalesce(canonical, object_value) AS object_value, evidence_id FROM k WHERE canonical IS NULL OR NOT EXISTS (SELECT 1 FROM t b
WHERE b.subject_id = k.subject_id AND b.predicate = k.predicate AND b.object_value = k.canonical AND b.evidence_id IS NOT DISTINCT FROM k.evidence_id)""")
def normalise_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Aliases become canonical, but for those whose null-safe twin is there already."""
    rows, aliases = _aliased(spark, d)
    return govern.normalise(rows, aliases).select("subject_id", "object_value", "evidence_id")


@query(f"""WITH {STATEMENTS}, {_TWINS} SELECT 'hasType' AS predicate, alias, canonical, count(*) AS n FROM t JOIN a ON object_value = alias GROUP BY ALL""")
def alias_dry_run(spark: SparkSession, d: str) -> DataFrame:
    return govern.alias_counts(*_aliased(spark, d))


_LAYERS = """layers AS (SELECT 's:' || s_suppkey AS pid, CASE WHEN s_suppkey % 3 = 0 THEN '群体' WHEN s_suppkey % 3 = 1 THEN '单体' END AS layer FROM supplier),
after AS (SELECT e.pid, CASE WHEN layer = '群体' THEN 'clu' ELSE entity_type END AS entity_type, layer FROM entities e LEFT JOIN layers l ON l.pid = e.pid AND layer IS NOT NULL)"""


def _layers(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    layer = F.when(k % 3 == 0, "群体").when(k % 3 == 1, "单体")
    rows = table(spark, d, "supplier").select(F.concat(F.lit("s:"), k.cast("string")).alias("subject_id"), F.lit("hasLayer").alias("predicate"), layer.alias("object_value"))
    return rows.filter("object_value IS NOT NULL")


@query(f"""WITH {ENTITIES}, {_LAYERS} SELECT entity_type, count(*) AS n FROM after GROUP BY 1""")
def reclassify_units(spark: SparkSession, d: str) -> DataFrame:
    layers, units = _layers(spark, d), ["群体", "区域"]
    once = promote.reclassify(entities(spark, d), layers, "hasLayer", units, "clu")
    twice = promote.reclassify(once, layers, "hasLayer", units, "clu")
    registry = entities(spark, d).select(F.lit("east").alias("region"), F.col("entity_type").alias("kind"), F.col("pid").alias("natural_key"), "pid", F.lit(1).cast("long").alias("serial"))
    return promote.reclassify_registry(registry, twice).groupBy(F.col("kind").alias("entity_type")).agg(F.count("*").alias("n"))


@query(f"""WITH {ENTITIES}, {_LAYERS} SELECT 'unit_without_unit_layer' AS "check", count(*) AS n_bad FROM after WHERE entity_type = 'clu' AND coalesce(layer, '') NOT IN ('群体', '区域')
UNION ALL SELECT 'place_with_unit_layer', count(*) FROM entities e JOIN layers l ON l.pid = e.pid WHERE entity_type = 'pl' AND layer IN ('群体', '区域') AND CAST(split_part(e.pid, ':', 2) AS BIGINT) % 2 = 0""")
def reclassify_checks(spark: SparkSession, d: str) -> DataFrame:
    """Bad rows both ways, after reclassifying the suppliers with odd keys alone and before that of the even ones."""
    layers, units = _layers(spark, d), ["群体", "区域"]
    odd = layers.filter(F.split_part("subject_id", F.lit(":"), F.lit(2)).cast("long") % 2 == 1)
    return govern.misplaced_units(promote.reclassify(entities(spark, d), odd, "hasLayer", units, "clu"), layers, units)


_INVENTORY = """SELECT predicate, string_agg(DISTINCT s.entity_type, ',' ORDER BY s.entity_type) AS domain, coalesce(string_agg(DISTINCT o.entity_type, ',' ORDER BY o.entity_type), '') AS object_types,
bool_or(object_id IS NOT NULL) AS has_ref, bool_or(object_value IS NOT NULL) AS has_value, bool_or(geometry IS NOT NULL) AS has_geo, count(*) AS n,
CASE WHEN bool_or(object_id IS NOT NULL) THEN 'edge' WHEN bool_or(geometry IS NOT NULL) THEN 'spatial' ELSE 'attribute' END AS category
FROM statements t JOIN entities s ON t.subject_id = s.pid LEFT JOIN entities o ON t.object_id = o.pid GROUP BY predicate"""


@query(f"WITH {ENTITIES}, {STATEMENTS} {_INVENTORY}")
def predicate_inventory(spark: SparkSession, d: str) -> DataFrame:
    return ontology.inventory(statements(spark, d), entities(spark, d))


#: Sorted class names of comma-separated entity types.
_NAMES = "list_sort(list_transform(string_split({}, ','), lambda t: CASE t WHEN 'pl' THEN 'Place' WHEN 'clu' THEN 'CulturalLandscapeUnit' WHEN 'ac' THEN 'Actor' WHEN 'doc' THEN 'Document' WHEN 'ev' THEN 'Event' ELSE 'DigitalImage' END))"


@query(f"""WITH {ENTITIES}, {STATEMENTS}, i AS (SELECT *, {_NAMES.format('domain')} AS d, {_NAMES.format('object_types')} AS o FROM ({_INVENTORY})) SELECT predicate, CASE WHEN len(d) > 1 THEN 'union(' || array_to_string(d, ',') || ')' ELSE d[1] END AS domain,
CASE WHEN has_ref THEN CASE WHEN len(o) > 1 THEN 'union(' || array_to_string(o, ',') || ')' ELSE o[1] END
WHEN predicate IN ('hasEmotionScore', 'hasAmount', 'hasPaidAmount', 'hasConvertedAmount', 'hasArea', 'hasShapeArea', 'hasShapeLength') THEN 'decimal' ELSE 'string' END AS "range", n FROM i""")
def domain_range(spark: SparkSession, d: str) -> DataFrame:
    return ontology.ranges(ontology.inventory(statements(spark, d), entities(spark, d)))


@query(f"""WITH {ENTITIES}, {STATEMENTS}, i AS ({_INVENTORY}), l AS (SELECT p_partkey % 7 AS k, 'Label ' || p_name AS label, p_partkey AS ord FROM part WHERE p_partkey % 5 <> 0),
p AS (SELECT predicate, CASE predicate WHEN 'hasName' THEN 0 WHEN 'hasType' THEN 1 WHEN 'hasDate' THEN 2 END AS k FROM i)
SELECT predicate, category, (SELECT arg_min(label, ord) FROM l WHERE l.k = p.k) AS label FROM i JOIN p USING (predicate)""")
def predicate_labels(spark: SparkSession, d: str) -> DataFrame:
    """Each predicate with its category and display label: the first filled one in sheet order."""
    k = F.col("p_partkey") % 7
    name = F.when(k == 0, "hasName").when(k == 1, "hasType").when(k == 2, "hasDate")
    spec = table(spark, d, "part").select(name.alias("predicate"), F.when(F.col("p_partkey") % 5 != 0, F.concat(F.lit("Label "), "p_name")).alias("label"), F.col("p_partkey").alias("ord"))
    return ontology.with_labels(ontology.inventory(statements(spark, d), entities(spark, d)), spec).select("predicate", "category", "label")


@query(f"""WITH {ENTITIES}, {STATEMENTS}, i AS ({_INVENTORY}), c(entity_type, class) AS (VALUES ('pl', 'Place'), ('clu', 'CulturalLandscapeUnit'), ('ac', 'Actor'), ('doc', 'Document'), ('ev', 'Event'), ('img', 'DigitalImage'))
SELECT entity_type, class, (SELECT count(*) FROM i WHERE category = 'attribute' AND list_contains(string_split(domain, ','), c.entity_type)) AS attributes,
(SELECT count(*) > 0 FROM i WHERE has_geo AND list_contains(string_split(domain, ','), c.entity_type)) AS located FROM c""")
def class_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Classes with their number of attributes, and whether they have geometries."""
    found = ontology.inventory(statements(spark, d), entities(spark, d))
    located = ontology.geometry_sources(found).withColumn("g", F.lit(True))
    nodes = ontology.class_nodes(found, spark).join(located, "entity_type", "left")
    return nodes.select("entity_type", "class", "attributes", F.coalesce("g", F.lit(False)).alias("located"))


@query(f"""WITH {ENTITIES}, {STATEMENTS}, c AS (SELECT entity_type, predicate, count(*) AS n FROM statements JOIN entities ON subject_id = pid WHERE object_value IS NOT NULL GROUP BY 1, 2)
SELECT entity_type, predicate, n, CAST(row_number() OVER (PARTITION BY entity_type ORDER BY n DESC, predicate) AS INTEGER) AS rank FROM c QUALIFY rank <= 2""")
def topk_attributes(spark: SparkSession, d: str) -> DataFrame:
    return ontology.top_attributes(statements(spark, d), entities(spark, d), 2)


#: The mapping of the graph's predicates, written out.
_CRM_SQL = """(SELECT predicate, CASE predicate WHEN 'hasName' THEN 'P1_is_identified_by' WHEN 'hasType' THEN 'P2_has_type' WHEN 'hasDate' THEN 'P4_has_time-span' WHEN 'carriedOutBy' THEN 'P14_carried_out_by'
WHEN 'locatedAt' THEN 'P168_place_is_defined_by' ELSE '—' END AS term, CASE predicate WHEN 'carriedOutBy' THEN 'exact' WHEN 'hasName' THEN 'close' WHEN 'hasType' THEN 'close' WHEN 'locatedAt' THEN 'close' WHEN 'hasDate' THEN 'broad' ELSE 'none' END AS level
FROM (SELECT DISTINCT predicate FROM statements))"""


@query(f"WITH {STATEMENTS} SELECT * FROM {_CRM_SQL}")
def crm_mapping_levels(spark: SparkSession, d: str) -> DataFrame:
    term, level = ontology.crm(F.col("predicate"))
    return statements(spark, d).select("predicate").distinct().select("predicate", term.alias("term"), level.alias("level"))


@query(f"WITH {STATEMENTS} SELECT level, count(*) AS n FROM {_CRM_SQL} GROUP BY 1")
def crm_level_counts(spark: SparkSession, d: str) -> DataFrame:
    return ontology.crm_levels(crm_mapping_levels(spark, d))


@query(f"""WITH {ENTITIES}, {STATEMENTS} SELECT s.entity_type AS source, o.entity_type AS target, string_agg(DISTINCT predicate, ',' ORDER BY predicate) AS predicates, count(*) AS n
FROM statements t JOIN entities s ON t.subject_id = s.pid JOIN entities o ON t.object_id = o.pid GROUP BY 1, 2""")
def class_graph(spark: SparkSession, d: str) -> DataFrame:
    return ontology.class_graph(statements(spark, d), entities(spark, d))


_TRIPLES = f"""i AS ({_INVENTORY}), n AS (SELECT '<urn:kg:' || predicate || '> ' AS node, {_NAMES.format('domain')} AS d, {_NAMES.format('object_types')} AS o, * FROM i),
s AS (SELECT node, predicate, 'domain' AS verb, d AS c FROM n UNION ALL SELECT node, predicate, 'range', o FROM n WHERE category = 'edge'),
b AS (SELECT '_:' || predicate || '-' || verb AS blank, * FROM s WHERE len(c) > 1), l AS (SELECT blank, len(c) AS k, unnest(c) AS class, generate_subscripts(c, 1) - 1 AS pos FROM b),
t AS (SELECT node || '<http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <http://www.w3.org/2002/07/owl#' || CASE WHEN category = 'attribute' THEN 'DatatypeProperty' ELSE 'ObjectProperty' END || '> .' AS line FROM n
UNION ALL SELECT node || '<http://www.w3.org/2000/01/rdf-schema#' || verb || '> <urn:kg:' || c[1] || '> .' FROM s WHERE len(c) = 1 UNION ALL SELECT node || '<http://www.w3.org/2000/01/rdf-schema#' || verb || '> ' || blank || ' .' FROM b
UNION ALL SELECT blank || ' <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <http://www.w3.org/2002/07/owl#Class> .' FROM b UNION ALL SELECT blank || ' <http://www.w3.org/2002/07/owl#unionOf> ' || blank || '-0 .' FROM b
UNION ALL SELECT blank || '-' || pos || ' <http://www.w3.org/1999/02/22-rdf-syntax-ns#first> <urn:kg:' || class || '> .' FROM l
UNION ALL SELECT blank || '-' || pos || ' <http://www.w3.org/1999/02/22-rdf-syntax-ns#rest> ' || CASE WHEN pos + 1 < k THEN blank || '-' || (pos + 1) ELSE '<http://www.w3.org/1999/02/22-rdf-syntax-ns#nil>' END || ' .' FROM l
UNION ALL SELECT node || '<http://www.w3.org/2000/01/rdf-schema#range> ' || CASE WHEN category = 'spatial' THEN '<urn:kg:Geometry>' WHEN predicate = 'hasAmount' THEN '<http://www.w3.org/2001/XMLSchema#decimal>' ELSE '<http://www.w3.org/2001/XMLSchema#string>' END || ' .' FROM n WHERE category <> 'edge'
UNION ALL SELECT node || '<http://www.w3.org/2004/02/skos/core#closeMatch> <http://www.cidoc-crm.org/cidoc-crm/' || CASE predicate WHEN 'carriedOutBy' THEN 'P14_carried_out_by' ELSE 'P168_place_is_defined_by' END || '> .' FROM n WHERE predicate IN ('carriedOutBy', 'locatedAt'))"""


@query(f"WITH {ENTITIES}, {STATEMENTS}, {_TRIPLES} SELECT line FROM t")
def ontology_triples(spark: SparkSession, d: str) -> DataFrame:
    return ontology.triples(ontology.inventory(statements(spark, d), entities(spark, d)))


@query(f"WITH {ENTITIES}, {STATEMENTS}, {_TRIPLES} SELECT regexp_extract(line, '[#/]([A-Za-z]+)>', 1) AS verb, count(*) + CASE regexp_extract(line, '[#/]([A-Za-z]+)>', 1) WHEN 'type' THEN 6 WHEN 'closeMatch' THEN 6 ELSE 0 END AS n FROM t GROUP BY 1 UNION ALL SELECT 'label', 12")
def ontology_files(spark: SparkSession, d: str) -> DataFrame:
    """The ontology written as text files and read again: lines by verb, those of the six classes among them."""
    path = fresh_folder(spark, "ontology")
    ontology.write_triples(ontology.inventory(statements(spark, d), entities(spark, d)), path)
    return spark.read.text(path).groupBy(F.regexp_extract("value", "[#/]([A-Za-z]+)>", 1).alias("verb")).agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT 'user ' || user_id AS "table", json_extract_string(props, '$.k') AS "column", ts < TIMESTAMP '2024-01-16' AS early FROM events),
a AS (SELECT DISTINCT "table", "column" FROM e WHERE early), c AS (SELECT DISTINCT "table", "column" FROM e WHERE NOT early)
SELECT *, 'extra' AS status FROM (SELECT * FROM a EXCEPT SELECT * FROM c) UNION ALL SELECT *, 'missing' FROM (SELECT * FROM c EXCEPT SELECT * FROM a)""")
def schema_drift(spark: SparkSession, d: str) -> DataFrame:
    """Property values of each user's event set in the first half of the month against the second."""
    keys = table(spark, d, "events").select(
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("table"), F.get_json_object("props", "$.k").alias("column"),
        (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).alias("early"),
    )
    return govern.drift(keys.filter("early").select("table", "column").distinct(), keys.filter("not early").select("table", "column").distinct())


@query(f"""WITH {ENTITIES}, {STATEMENTS} SELECT subject_id, predicate, object_id FROM statements WHERE object_id IS NOT NULL AND object_id NOT IN (SELECT pid FROM entities)""")
def dangling_edges(spark: SparkSession, d: str) -> DataFrame:
    edges = statements(spark, d).filter("object_id IS NOT NULL").select("subject_id", "predicate", "object_id")
    return edges.join(entities(spark, d).select(F.col("pid").alias("object_id")), "object_id", "left_anti").select("subject_id", "predicate", "object_id")


@query(f"""WITH {ENTITIES}, {STATEMENTS}, v AS (SELECT doc_id AS evidence_id, source FROM documents) SELECT subject_id, label, predicate, source FROM statements JOIN entities ON subject_id = pid JOIN v USING (evidence_id)""")
def provenance_chain(spark: SparkSession, d: str) -> DataFrame:
    """All statements that have evidence, with their subject's name and the source of the evidence."""
    evidence = table(spark, d, "documents").select(F.col("doc_id").alias("evidence_id"), "source")
    return govern.provenance(statements(spark, d), entities(spark, d), evidence)


@query(f"""WITH {STATEMENTS} SELECT DISTINCT subject_id AS source, subject_id || '::' || predicate || '::' || object_value AS target, predicate AS label
FROM statements WHERE predicate IN ('hasName', 'hasStatus') AND object_value IS NOT NULL""")
def attribute_star(spark: SparkSession, d: str) -> DataFrame:
    return ontology.attribute_star(statements(spark, d), ["hasName", "hasStatus"])


@query(f"""WITH {ENTITIES}, {STATEMENTS}, t AS (SELECT subject_id AS pid, min(object_value) AS type FROM statements WHERE predicate = 'hasType' GROUP BY 1),
e AS (SELECT DISTINCT object_id AS parent, subject_id AS pid FROM statements WHERE predicate = 'locatedIn')
SELECT parent, coalesce(type, 'unknown') AS type, count(DISTINCT pid) AS n FROM e JOIN entities USING (pid) LEFT JOIN t USING (pid) GROUP BY 1, 2""")
def child_type_histogram(spark: SparkSession, d: str) -> DataFrame:
    all_ = statements(spark, d)
    types = all_.filter("predicate = 'hasType'").groupBy(F.col("subject_id").alias("pid")).agg(F.min("object_value").alias("type"))
    return ontology.child_types(all_, entities(spark, d), types, "locatedIn")


@query("""SELECT r_name AS region, kind, count(*) AS n FROM (SELECT c_nationkey AS k, 'ac' AS kind FROM customer UNION ALL SELECT s_nationkey, 'pl' FROM supplier)
JOIN nation ON k = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def region_type_tree(spark: SparkSession, d: str) -> DataFrame:
    """Entities of each region by type; counted by nation before the small tables are joined."""
    count = lambda t, k, kind: table(spark, d, t).groupBy(F.col(k).alias("n_nationkey")).agg(F.count("*").alias("k")).withColumn("kind", F.lit(kind))
    by_nation = count("customer", "c_nationkey", "ac").unionByName(count("supplier", "s_nationkey", "pl"))
    named = by_nation.join(table(spark, d, "nation"), "n_nationkey").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return named.groupBy(F.col("r_name").alias("region"), "kind").agg(F.sum("k").alias("n"))


ALIASES = [("hasShape", "ring", 0), ("hasShape", "bolt", 0), ("hasName", "plate", 0), ("hasColour", "red", 0), ("hasAge", "old", 0), ("hasSize", "large", 0), ("hasLabel", "ring", 1), ("hasState", "hot", 0)]
_SUGGEST = """WITH t AS (SELECT p_brand AS "table", p_name AS header, lower(trim(p_name)) AS h FROM part GROUP BY ALL),
a(target, alias) AS (VALUES ('hasShape', 'ring'), ('hasShape', 'bolt'), ('hasName', 'plate'), ('hasColour', 'red'), ('hasAge', 'old'), ('hasSize', 'large'), ('hasState', 'hot')),
m AS (SELECT "table", header, target, length(alias) / length(h) AS cover, row_number() OVER (PARTITION BY "table", header ORDER BY length(alias) / length(h) DESC, length(alias) DESC, alias DESC) AS r
FROM t JOIN a ON contains(h, alias) AND (length(alias) > 3 OR contains(' ' || regexp_replace(h, '[^a-z0-9]+', ' ', 'g') || ' ', ' ' || alias || ' ')) WHERE length(alias) / length(h) >= 0.34)
SELECT t."table", t.header, coalesce(target, 'hasNotes') AS target, CASE WHEN target IS NULL THEN 0.2 ELSE round(least(0.99, 0.5 + cover / 2), 2) END AS score FROM t LEFT JOIN m ON m."table" = t."table" AND m.header = t.header AND r = 1"""


@query(_SUGGEST)
def suggest_columns(spark: SparkSession, d: str) -> DataFrame:
    headers = table(spark, d, "part").select(F.col("p_brand").alias("table"), F.col("p_name").alias("header")).distinct()
    return match.suggest(headers, spark.createDataFrame(ALIASES, "target string, alias string, priority int"))


WORDS = [("the", "The", "Place"), ("que", "Que", "Period"), ("der", "Der", "Person"), ("für", "Für", "Event"), ("of the", "Of the", "Place"), ("de la", "De la", "Place")]
_TEXTS = r"""w(surface, kind) AS (VALUES ('the', 'Place'), ('que', 'Period'), ('der', 'Person'), ('für', 'Event'), ('of the', 'Place'), ('de la', 'Place')),
t AS (SELECT DISTINCT sha256('dictionary' || chr(10) || text) AS text_key, lower(text) AS low FROM documents WHERE length(text) >= 4)
SELECT DISTINCT text_key, surface, kind FROM t JOIN w ON regexp_matches(low, '(^|[^\p{L}\p{M}\p{N}])' || surface || '($|[^\p{L}\p{M}\p{N}])')"""


@query(f"WITH {_TEXTS}")
def mentions_from_text(spark: SparkSession, d: str) -> DataFrame:
    words = spark.createDataFrame(WORDS, "surface string, canonical string, kind string")
    return match.mentions(table(spark, d, "documents"), words).select("text_key", "surface", "kind")


@query(f"WITH {_TEXTS}")
def mentions_cached(spark: SparkSession, d: str) -> DataFrame:
    """The same from a cache table that already holds the texts of one language."""
    words = spark.createDataFrame(WORDS, "surface string, canonical string, kind string")
    docs, cache = table(spark, d, "documents"), fresh_folder(spark, "mentions")
    match.annotate_new(docs.filter("lang = 'de'"), words, cache)
    return match.annotate_new(docs, words, cache).select("text_key", "surface", "kind")


@query("""WITH p AS (SELECT doc_id, 'c' || doc_id || ' 寄往' || CASE doc_id % 3 WHEN 0 THEN '泉州府' WHEN 1 THEN '厦门' ELSE '漳州' END || '的信' AS text FROM documents),
w(surface, kind) AS (VALUES ('泉州', 'Place'), ('泉州府', 'Place'), ('厦门', 'Place'), ('信', 'Event'), ('州', 'Period'), ('福州', 'Place'))
SELECT sha256('dictionary' || chr(10) || text) AS text_key, surface, kind FROM p JOIN w ON contains(text, surface) WHERE length(text) >= 4""")
def mentions_cjk(spark: SparkSession, d: str) -> DataFrame:
    """Surfaces of a script without blanks, some within others, in a line made from each document."""
    words = [("泉州", "Place"), ("泉州府", "Place"), ("厦门", "Place"), ("信", "Event"), ("州", "Period"), ("福州", "Place")]
    k = F.col("doc_id")
    where = F.when(k % 3 == 0, "泉州府").when(k % 3 == 1, "厦门").otherwise("漳州")
    texts = table(spark, d, "documents").select(F.concat(F.lit("c"), k.cast("string"), F.lit(" 寄往"), where, F.lit("的信")).alias("text"))
    dictionary = spark.createDataFrame([(s, s, t) for s, t in words], "surface string, canonical string, kind string")
    return match.mentions(texts, dictionary).select("text_key", "surface", "kind")


@query("""WITH p AS (SELECT p_partkey, lower(p_name) AS h FROM part), s AS (SELECT DISTINCT left(lower(p_name), 5) || right(lower(p_name), 3) AS piece FROM part UNION SELECT DISTINCT substr(lower(p_name), 3, 6) FROM part)
SELECT p_partkey, piece FROM p JOIN s ON contains(h, piece) WHERE length(piece) > 0""")
def substring_join(spark: SparkSession, d: str) -> DataFrame:
    """Part names that hold pieces taken from part names, of which most are in no name."""
    parts = table(spark, d, "part").select("p_partkey", F.lower("p_name").alias("h"))
    pieces = parts.select(F.concat(F.left("h", F.lit(5)), F.right("h", F.lit(3))).alias("piece")).unionByName(parts.select(F.substring("h", 3, 6).alias("piece")))
    return match.containing(parts, "p_partkey", "h", pieces, "piece").select("p_partkey", F.explode("found").alias("piece"))


@query("""WITH t AS (SELECT DISTINCT text FROM documents WHERE length(text) >= 4 AND length(text) % 5 <> 0)
SELECT DISTINCT sha256('numbers' || chr(10) || text) AS text_key, unnest(regexp_extract_all(text, '[0-9]{3}')) AS surface FROM t""")
def mentions_by_annotator(spark: SparkSession, d: str) -> DataFrame:
    """An annotator of one's own that fails on one text in five, over texts of which some are in its cache."""

    def numbers(texts: list[str]) -> list[list[tuple[str, str, str]]]:
        """Runs of three digits; no text whose length is divisible by five is taken."""
        if any(len(t) % 5 == 0 for t in texts):
            raise ValueError("a text that it does not take")
        return [[(m, m, "Number") for m in dict.fromkeys(re.findall("[0-9]{3}", t))] for t in texts]

    docs, cache = table(spark, d, "documents"), fresh_folder(spark, "numbers")
    match.annotate_new(docs.filter("lang = 'de'"), numbers, cache, "numbers")
    return match.annotate_new(docs, numbers, cache, "numbers").select("text_key", "surface")


@query("""SELECT source, count(*) AS n, round(avg(CASE WHEN TRY_CAST(lang AS DOUBLE) IS NULL THEN 0 ELSE 1 END), 4) AS numeric_share, bool_and(lang IN ('en', 'de', 'fr')) AS in_vocabulary,
bool_or(n_chars BETWEEN 1500 AND 2100) AS year_like FROM documents GROUP BY 1""")
def column_profile(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(
        F.count("*").alias("n"), F.round(F.avg(F.when(F.col("lang").try_cast("double").isNull(), 0).otherwise(1)), 4).alias("numeric_share"),
        F.bool_and(F.col("lang").isin("en", "de", "fr")).alias("in_vocabulary"), F.bool_or(F.col("n_chars").between(1500, 2100)).alias("year_like"),
    )


@query("""WITH m AS (SELECT p_brand AS region, count(*) * 2 AS n_entities, CAST(CASE WHEN p_brand IN ('Brand#3', 'Brand#13') THEN 2 ELSE 0 END AS DOUBLE) AS d2, CAST(CASE p_brand WHEN 'Brand#1' THEN 1.5 ELSE 0 END AS DOUBLE) AS d3,
CAST(CASE p_brand WHEN 'Brand#2' THEN 0.5 ELSE 0 END AS DOUBLE) AS d4, CAST(CASE WHEN p_brand LIKE '%4' OR p_brand = 'Brand#1' THEN 100 ELSE 79.5 END AS DOUBLE) AS d6 FROM part GROUP BY 1)
SELECT region, CASE WHEN d3 > 0 OR d4 > 0 THEN 'draft' WHEN d2 >= 1 OR n_entities < 100 THEN 'mvp' WHEN d6 >= 80 THEN 'publish' ELSE 'research' END AS grade FROM m""")
def grades_of_every_kind(spark: SparkSession, d: str) -> DataFrame:
    """Metrics made so that all four grades occur; brands stand for regions and have a few or many parts."""
    b = F.col("p_brand")
    zero = lambda c, v: F.when(c, F.lit(v)).otherwise(0.0)
    metrics = table(spark, d, "part").groupBy(b.alias("region")).agg((F.count("*") * 2).alias("n_entities")).withColumnRenamed("region", "p_brand").select(
        b.alias("region"), "n_entities", zero(b.isin("Brand#3", "Brand#13"), 2.0).alias("d2"), zero(b == "Brand#1", 1.5).alias("d3"), zero(b == "Brand#2", 0.5).alias("d4"),
        F.when(b.like("%4") | (b == "Brand#1"), 100.0).otherwise(79.5).alias("d6"))
    return govern.grade(metrics).select("region", "grade")


@query("""SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'Lin' WHEN 2 THEN 'Ke' WHEN 3 THEN 'Wu' WHEN 4 THEN 'Lin' WHEN 5 THEN NULL ELSE 'Su' END AS collector FROM orders""")
def collector_of_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Who collected a row, from metadata whose fields differ in name, case and order; empty ones do not count."""
    k = F.col("o_orderkey") % 7
    meta = F.when(k == 1, '{"Surveyor": "Lin", "Recorder": "Ke"}').when(k == 2, '{"recorder": "Ke", "collector": "Wu"}').when(k == 3, '{"COLLECTOR": "Wu"}').when(
        k == 4, '{"collector": "Wu", "surveyor": " Lin "}').when(k == 5, '{"surveyor": "", "other": "x"}').when(k == 6, '{"surveyor": "nan", "recorder": "Su"}')
    return table(spark, d, "orders").select("o_orderkey", C.collector_of(meta).alias("collector"))


@query(f"""WITH {ENTITIES}, {STATEMENTS}, t AS (SELECT subject_id AS pid, min(object_value) AS type FROM statements WHERE predicate = 'hasType' GROUP BY 1),
e AS (SELECT DISTINCT object_id AS source, subject_id AS target FROM statements WHERE predicate = 'locatedIn' AND object_id IN (SELECT pid FROM entities) AND subject_id IN (SELECT pid FROM entities)),
c AS (SELECT source AS pid, count(*) AS n FROM e GROUP BY 1)
SELECT 'edge' AS kind, source AS id, target AS label, CAST(NULL AS VARCHAR) AS type, CAST(NULL AS BIGINT) AS n FROM e UNION ALL SELECT 'container', pid, label, NULL, n FROM c JOIN entities USING (pid)
UNION ALL SELECT 'child', pid, left(label, 14), coalesce(type, 'unknown'), NULL FROM entities LEFT JOIN t USING (pid) WHERE pid IN (SELECT target FROM e) AND pid NOT IN (SELECT pid FROM c)""")
def container_star(spark: SparkSession, d: str) -> DataFrame:
    """Nodes and edges of all containers and their children as one table."""
    all_ = statements(spark, d)
    types = all_.filter("predicate = 'hasType'").groupBy(F.col("subject_id").alias("pid")).agg(F.min("object_value").alias("type"))
    nodes, edges = ontology.container_star(all_, entities(spark, d), types, "locatedIn")
    none = F.lit(None)
    return nodes.select("kind", "id", "label", "type", "n").unionByName(edges.select(
        F.lit("edge").alias("kind"), F.col("source").alias("id"), F.col("target").alias("label"), none.cast("string").alias("type"), none.cast("long").alias("n")))
