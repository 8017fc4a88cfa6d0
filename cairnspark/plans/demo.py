"""Demo pack: counts, flows, timelines and lookups over the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.functions import geo as G
from cairnspark.functions.session import cut, table
from cairnspark.operators.connect import fan_out, last_of, unpivot, with_other
from cairnspark.operators.govern import histogram
from cairnspark.operators.match import containing
from cairnspark.operators.spatial import contains_place
from cairnspark.plans.graph import ENTITIES, STATEMENTS, entities, id_of, lat, lon, nation_polygons, statements, supplier_polygons
from cairnspark.plans.registry import query

POINTS = """points AS (SELECT c_custkey, c_nationkey, CAST(c_custkey * 7919 % 36000 AS DOUBLE) / 100.0 - 180.0 AS x, CAST(c_custkey * 104729 % 18000 AS DOUBLE) / 100.0 - 90.0 AS y FROM customer)"""


@query(f"""WITH {ENTITIES}, {STATEMENTS} SELECT 'entities' AS name, count(*) AS n FROM entities
UNION ALL SELECT 'statements', count(*) FROM statements UNION ALL SELECT 'evidence', count(DISTINCT source) FROM documents""")
def kg_size(spark: SparkSession, d: str) -> DataFrame:
    count = lambda name, df, n: df.agg(n.cast("long").alias("n")).select(F.lit(name).alias("name"), "n")
    return (
        count("entities", entities(spark, d), F.count("*"))
        .unionByName(count("statements", statements(spark, d), F.count("*")))
        .unionByName(count("evidence", table(spark, d, "documents"), F.count_distinct("source")))
    )


@query(f"WITH {ENTITIES} SELECT entity_type, count(*) AS n FROM entities GROUP BY entity_type")
def entity_type_distribution(spark: SparkSession, d: str) -> DataFrame:
    return entities(spark, d).groupBy("entity_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "entity_type")


@query("""SELECT c_name AS parent, count(o_orderkey) AS n, coalesce(string_agg(CAST(o_orderkey AS VARCHAR), ', ' ORDER BY CAST(o_orderkey AS VARCHAR)) FILTER (WHERE o_orderkey % 2 = 0), '') AS even_children
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name ORDER BY n DESC, parent LIMIT 10""")
def container_children(spark: SparkSession, d: str) -> DataFrame:
    """Containers with their children, also those without any; a customer has a few orders."""
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    sizes = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("parent")).join(orders.groupBy("c_custkey").agg(F.count("*").alias("n")), "c_custkey", "left")
    top = cut(sizes.select("c_custkey", "parent", F.coalesce("n", F.lit(0)).alias("n")).orderBy(F.desc("n"), "parent").limit(10))
    # only the children of those ten are gathered
    even = orders.filter("o_orderkey % 2 = 0").join(F.broadcast(top.select("c_custkey")), "c_custkey")
    named = even.groupBy("c_custkey").agg(F.array_join(F.array_sort(F.collect_list(F.col("o_orderkey").cast("string"))), ", ").alias("even_children"))
    return top.join(named, "c_custkey", "left").select("parent", "n", F.coalesce("even_children", F.lit("")).alias("even_children"))


@query("""SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(DISTINCT event_id) AS n,
count(DISTINCT event_id) FILTER (WHERE event_id % 3 = 0) AS located FROM events WHERE ts < TIMESTAMP '2030-01-01' GROUP BY 1""")
def capture_timeline(spark: SparkSession, d: str) -> DataFrame:
    """Photos by month of capture and those of them that are located, from a left self-join of statements."""
    none = F.lit(None).cast("string")
    events = table(spark, d, "events").select(id_of("ev", "event_id").alias("subject_id"), F.inline(fan_out(
        ("predicate", "object_value", "geometry"), (F.lit("capturedAt"), F.col("ts").cast("string"), none),
        (F.lit("locatedAt"), none, F.when(F.col("event_id") % 3 == 0, F.lit("POINT(1 2)")))))).filter("predicate = 'capturedAt' OR geometry IS NOT NULL")
    joined = with_other(events, "capturedAt", "locatedAt").filter(F.col("object_value").cast("timestamp_ntz") < F.lit("2030-01-01").cast("timestamp_ntz"))
    return joined.groupBy(F.date_trunc("month", F.col("object_value").cast("timestamp_ntz")).cast("date").alias("month")).agg(
        F.count_distinct("subject_id").alias("n"), F.count_distinct(F.when(F.col("other_geometry").isNotNull(), F.col("subject_id"))).alias("located")
    )


@query(f"""WITH {ENTITIES}, {STATEMENTS} SELECT s.object_id AS sender, count(*) AS letters, count(DISTINCT substr(t.object_value, 1, 4)) AS active_years
FROM statements s LEFT JOIN statements t ON t.subject_id = s.subject_id AND t.predicate = 'hasDate' WHERE s.predicate = 'hasSender' GROUP BY 1 ORDER BY letters DESC, sender LIMIT 15""")
def sender_dates(spark: SparkSession, d: str) -> DataFrame:
    """The busiest senders with the years of their letters' dates, from a left self-join of statements."""
    joined = with_other(statements(spark, d), "hasSender", "hasDate")
    return joined.groupBy(F.col("object_id").alias("sender")).agg(
        F.count("*").alias("letters"), F.count_distinct(F.substring("other_object_value", 1, 4)).alias("active_years")
    ).orderBy(F.desc("letters"), "sender").limit(15)


FLOWS = """flows AS (SELECT s_nationkey AS origin, c_nationkey AS destination, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""


def flows(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    # pairs are counted by order before the second join, so fewer rows move
    by_order = lines.groupBy("l_orderkey", F.col("s_nationkey").alias("origin")).agg(F.count("*").alias("k"))
    sent = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(
        table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("destination")), F.col("o_custkey") == F.col("c_custkey")
    )
    return by_order.join(sent, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("origin", "destination").agg(F.sum("k").alias("n"))


@query(f"WITH {FLOWS} SELECT * FROM flows ORDER BY n DESC, origin, destination LIMIT 10")
def flow_topk(spark: SparkSession, d: str) -> DataFrame:
    return flows(spark, d).orderBy(F.desc("n"), "origin", "destination").limit(10)


@query("""SELECT o_custkey AS sender, count(*) AS letters, count(DISTINCT date_trunc('year', o_orderdate)) AS active_years
FROM orders GROUP BY 1 ORDER BY letters DESC, sender LIMIT 10""")
def sender_activity(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(F.col("o_custkey").alias("sender")).agg(
        F.count("*").alias("letters"), F.count_distinct(F.date_trunc("year", "o_orderdate")).alias("active_years")
    ).orderBy(F.desc("letters"), "sender").limit(10)


@query("SELECT p_type AS value, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, value LIMIT 15")
def value_histogram(spark: SparkSession, d: str) -> DataFrame:
    return histogram(table(spark, d, "part"), "p_type", 15)


@query("SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
def level_pyramid(spark: SparkSession, d: str) -> DataFrame:
    return histogram(table(spark, d, "orders"), "o_orderpriority", 10)


PART = {"p_name": "hasName", "p_brand": "hasBrand", "p_type": "hasType", "p_size": "hasSize", "price": "hasPrice"}
PART_SQL = """SELECT p_partkey, 'hasName' AS predicate, nullif(trim(p_name), '') AS value FROM part
UNION ALL SELECT p_partkey, 'hasBrand', nullif(trim(p_brand), '') FROM part UNION ALL SELECT p_partkey, 'hasType', nullif(trim(p_type), '') FROM part
UNION ALL SELECT p_partkey, 'hasSize', CAST(p_size AS VARCHAR) FROM part UNION ALL SELECT p_partkey, 'hasPrice', CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) FROM part"""


def part_statements(spark: SparkSession, d: str) -> DataFrame:
    return unpivot(table(spark, d, "part").withColumn("price", F.col("p_retailprice").cast("decimal(18,2)")), ["p_partkey"], PART)


@query(f"SELECT * FROM ({PART_SQL}) WHERE value IS NOT NULL AND lower(value) NOT IN ('nan', 'none')")
def unpivot_fixed(spark: SparkSession, d: str) -> DataFrame:
    return part_statements(spark, d)


@query("SELECT p_partkey, p_name AS \"hasName\", p_type AS \"hasType\", CAST(p_size AS VARCHAR) AS \"hasSize\" FROM part WHERE p_brand = (SELECT min(p_brand) FROM part)")
def entity_attribute_lookup(spark: SparkSession, d: str) -> DataFrame:
    all_ = part_statements(spark, d)
    brand = all_.filter("predicate = 'hasBrand'")
    chosen = brand.join(brand.agg(F.min("value").alias("value")), "value", "left_semi").select("p_partkey")
    return all_.join(chosen, "p_partkey", "left_semi").groupBy("p_partkey").pivot("predicate", ["hasName", "hasType", "hasSize"]).agg(F.min("value"))


@query(f"""WITH {POINTS} SELECT c_nationkey, count(*) AS n, round(min(x), 2) AS x_min, round(max(x), 2) AS x_max, round(min(y), 2) AS y_min, round(max(y), 2) AS y_max FROM points GROUP BY 1""")
def extent_bbox(spark: SparkSession, d: str) -> DataFrame:
    points = table(spark, d, "customer").select("c_nationkey", lon("c_custkey").alias("x"), lat("c_custkey").alias("y"))
    return points.groupBy("c_nationkey").agg(
        F.count("*").alias("n"), F.round(F.min("x"), 2).alias("x_min"), F.round(F.max("x"), 2).alias("x_max"),
        F.round(F.min("y"), 2).alias("y_min"), F.round(F.max("y"), 2).alias("y_max"),
    )


@query(f"""WITH {POINTS} SELECT 'n:' || n_nationkey AS polygon_id, 'ac:' || c_custkey AS point_id FROM nation JOIN points
ON abs(x - (-180.0 + 72.0 * (n_nationkey % 5) + 36.0)) / 36.0 + abs(y - (-90.0 + 36.0 * (n_nationkey // 5) + 18.0)) / 18.0 < 1""")
def contains_places(spark: SparkSession, d: str) -> DataFrame:
    points = table(spark, d, "customer").select(F.lit("world").alias("region"), id_of("ac", "c_custkey").alias("point_id"), lon("c_custkey").alias("x"), lat("c_custkey").alias("y"))
    return contains_place(nation_polygons(spark, d), points, 12.0).select("polygon_id", "point_id")


@query("""SELECT 's:' || s_suppkey AS polygon_id, round(CAST(s_suppkey * 7919 % 36000 AS DOUBLE) / 100.0 - 180.0, 4) AS x, round(CAST(s_suppkey * 104729 % 18000 AS DOUBLE) / 100.0 - 90.0, 4) AS y FROM supplier""")
def polygon_centroid(spark: SparkSession, d: str) -> DataFrame:
    polygons = supplier_polygons(spark, d).filter(G.kind(F.col("wkt")) == "POLYGON")
    c = polygons.select("polygon_id", G.centroid(G.edges(G.rings(F.col("wkt")))).alias("c"))
    return c.select("polygon_id", (F.round("c.x", 4) + 0.0).alias("x"), (F.round("c.y", 4) + 0.0).alias("y"))


GAZETTEER = "SELECT * FROM (VALUES (0, 'green'), (1, 'blue'), (2, 'red'), (3, 'an')) AS g(ordinal, place)"


@query(f"""WITH g AS ({GAZETTEER}), m AS (SELECT p_partkey, coalesce(arg_min(place, CASE WHEN p_name = place THEN -1 ELSE ordinal END), 'other') AS place
FROM part LEFT JOIN g ON contains(p_name, place) GROUP BY 1) SELECT place, count(*) AS n FROM m GROUP BY 1""")
def gazetteer_fold(spark: SparkSession, d: str) -> DataFrame:
    g = spark.createDataFrame([(0, "green"), (1, "blue"), (2, "red"), (3, "an")], "ordinal int, place string")
    parts = table(spark, d, "part").select("p_partkey", "p_name")
    held = containing(parts, "p_partkey", "p_name", g, "place").select("p_partkey", F.explode("found").alias("place"))
    named = parts.join(held.join(g, "place"), "p_partkey", "left")
    rank = F.when(F.col("p_name") == F.col("place"), -1).otherwise(F.col("ordinal"))
    folded = named.groupBy("p_partkey").agg(F.coalesce(F.min_by("place", rank), F.lit("other")).alias("place"))
    return folded.groupBy("place").agg(F.count("*").alias("n"))


@query(f"""WITH {FLOWS} SELECT origin, destination, n, CAST(o.n_nationkey * 7919 % 36000 AS DOUBLE) / 100.0 - 180.0 AS x_from, CAST(t.n_nationkey * 7919 % 36000 AS DOUBLE) / 100.0 - 180.0 AS x_to
FROM flows JOIN nation o ON origin = o.n_nationkey JOIN nation t ON destination = t.n_nationkey WHERE t.n_nationkey <> 3""")
def flow_with_coordinates(spark: SparkSession, d: str) -> DataFrame:
    places = table(spark, d, "nation").select("n_nationkey", lon("n_nationkey").alias("x"))
    start = places.select(F.col("n_nationkey").alias("origin"), F.col("x").alias("x_from"))
    end = places.filter("n_nationkey <> 3").select(F.col("n_nationkey").alias("destination"), F.col("x").alias("x_to"))
    return flows(spark, d).join(start, "origin").join(end, "destination").select("origin", "destination", "n", "x_from", "x_to")


def _journeys(spark: SparkSession, d: str) -> DataFrame:
    """Statements of orders: an origin for each line (the supplier's nation), and a destination (the customer's)."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    sent = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    said = lambda rows, key, predicate, nation: rows.select(
        id_of("doc", key).alias("subject_id"), F.lit(predicate).alias("predicate"), id_of("n", nation).alias("object_id"))
    return said(lines, "l_orderkey", "hasOriginPlace", "s_nationkey").unionByName(said(sent, "o_orderkey", "hasDestinationPlace", "c_nationkey"))


@query(f"WITH {FLOWS} SELECT 'n:' || origin AS origin, 'n:' || destination AS destination, n FROM flows")
def statement_flows(spark: SparkSession, d: str) -> DataFrame:
    """Flows from an inner self-join of statements: every origin of a letter with every destination."""
    both = with_other(_journeys(spark, d), "hasOriginPlace", "hasDestinationPlace", "inner")
    return both.groupBy(F.col("object_id").alias("origin"), F.col("other_object_id").alias("destination")).agg(F.count("*").alias("n"))


@query(f"""WITH {FLOWS}, p AS (SELECT left(n_name, 1) AS name, arg_max(n_nationkey, n_nationkey) AS k FROM nation WHERE n_nationkey <> 3 GROUP BY 1),
g AS (SELECT n_nationkey, CAST(n_nationkey * 7919 % 36000 AS DOUBLE) / 100.0 - 180.0 AS x FROM nation WHERE n_nationkey % 4 <> 1), f AS (SELECT origin, left(n_name, 1) AS name, sum(n) AS n FROM flows JOIN nation ON destination = n_nationkey GROUP BY 1, 2)
SELECT origin, f.name AS destination, CAST(n AS BIGINT) AS n, g.x AS x_from, CAST(p.k * 7919 % 36000 AS DOUBLE) / 100.0 - 180.0 AS x_to FROM f JOIN p USING (name) JOIN g ON origin = g.n_nationkey""")
def flow_by_names(spark: SparkSession, d: str) -> DataFrame:
    """Flows by the destination's name with coordinates: of places with one name the last counts, and flows without a known place go."""
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.left("n_name", F.lit(1)).alias("name"), lon("n_nationkey").alias("x"))
    named = flows(spark, d).join(nation.select(F.col("k").alias("destination"), "name"), "destination").groupBy("origin", "name").agg(F.sum("n").alias("n"))
    end = last_of(nation.filter("k <> 3"), "name", "k").select("name", F.col("x").alias("x_to"))
    start = nation.filter("k % 4 <> 1").select(F.col("k").alias("origin"), F.col("x").alias("x_from"))
    return named.join(end, "name").join(start, "origin").select("origin", F.col("name").alias("destination"), "n", "x_from", "x_to")
