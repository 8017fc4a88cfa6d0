"""The knowledge graph that the queries derive from the given tables, in Spark and as SQL text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.functions.session import table
from cairnspark.operators.connect import fan_out


def id_of(prefix: str, key: str) -> Column:
    return F.concat(F.lit(f"{prefix}:"), F.col(key).cast("string"))


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def entities(spark: SparkSession, d: str) -> DataFrame:
    """(pid, entity_type, label) of orders, customers, nations, suppliers, regions, events and pages."""
    spec = [
        ("orders", "doc", "doc", "o_orderkey", "o_orderpriority"), ("customer", "ac", "ac", "c_custkey", "c_name"),
        ("nation", "pl", "n", "n_nationkey", "n_name"), ("supplier", "pl", "s", "s_suppkey", "s_name"),
        ("region", "clu", "r", "r_regionkey", "r_name"), ("events", "ev", "ev", "event_id", "event_type"), ("pages", "img", "img", "page_id", "url"),
    ]
    return _all([table(spark, d, t).select(id_of(p, k).alias("pid"), F.lit(e).alias("entity_type"), F.col(v).alias("label")) for t, e, p, k, v in spec])


ENTITIES = """entities AS (
  SELECT 'doc:' || o_orderkey AS pid, 'doc' AS entity_type, o_orderpriority AS label FROM orders
  UNION ALL SELECT 'ac:' || c_custkey, 'ac', c_name FROM customer
  UNION ALL SELECT 'n:' || n_nationkey, 'pl', n_name FROM nation
  UNION ALL SELECT 's:' || s_suppkey, 'pl', s_name FROM supplier
  UNION ALL SELECT 'r:' || r_regionkey, 'clu', r_name FROM region
  UNION ALL SELECT 'ev:' || event_id, 'ev', event_type FROM events
  UNION ALL SELECT 'img:' || page_id, 'img', url FROM pages)"""


def statements(spark: SparkSession, d: str) -> DataFrame:
    """(subject_id, predicate, object_value, object_id, geometry, evidence_id): the derived graph, one scan of each table.

    One order in a hundred has a sender that is no entity; statements of one order in five, and of one customer in nine, lack evidence.
    """
    none = F.lit(None).cast("string")
    value = lambda p, c: (F.lit(p), c.cast("string"), none, none)
    ref = lambda p, q, c: (F.lit(p), none, F.concat(F.lit(f"{q}:"), c.cast("string")), none)
    place = lambda c: (F.lit("locatedAt"), none, none, c)

    def of(name: str, prefix: str, key: str, evidence: Column, *said: tuple[Column, ...]) -> DataFrame:
        rows = fan_out(("predicate", "object_value", "object_id", "geometry"), *said)
        return table(spark, d, name).select(id_of(prefix, key).alias("subject_id"), F.inline(rows), evidence.cast("long").alias("evidence_id")).select(
            "subject_id", "predicate", "object_value", "object_id", "geometry", "evidence_id")

    o, c, s, p = F.col("o_orderkey"), F.col("c_custkey"), F.col("s_suppkey"), F.col("page_id")
    sender = F.when(o % 100 == 17, F.lit("missing")).otherwise(F.col("o_custkey").cast("string"))
    point = F.format_string("POINT(%d %d)", s % 180, s % 90)
    return reduce(DataFrame.unionByName, [
        of("orders", "doc", "o_orderkey", F.when(o % 5 != 0, o % 7), value("hasStatus", F.col("o_orderstatus")), value("hasPriority", F.col("o_orderpriority")),
           value("hasDate", F.date_format("o_orderdate", "yyyy-MM-dd")), ref("hasSender", "ac", sender)),
        of("customer", "ac", "c_custkey", F.when(c % 9 != 0, c % 3 + 1), value("hasName", F.col("c_name")), value("hasType", F.col("c_mktsegment")),
           value("hasAmount", F.col("c_acctbal").cast("decimal(18,2)")), ref("locatedIn", "n", F.col("c_nationkey"))),
        of("nation", "n", "n_nationkey", F.lit(1), value("hasName", F.col("n_name")), ref("locatedIn", "r", F.col("n_regionkey"))),
        of("region", "r", "r_regionkey", F.lit(1), ref("hasPart", "r", F.col("r_regionkey"))),
        of("supplier", "s", "s_suppkey", F.lit(2), ref("locatedIn", "n", F.col("s_nationkey")), place(point)),
        of("events", "ev", "event_id", F.col("event_id") % 10, value("hasType", F.col("event_type")), ref("carriedOutBy", "ac", F.col("user_id"))),
        of("pages", "img", "page_id", F.lit(3), ref("depicts", "s", p % 40)),
    ])


STATEMENTS = """statements AS (
  WITH o AS (SELECT 'doc:' || o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 7 END AS ev, * FROM orders),
  c AS (SELECT 'ac:' || c_custkey AS id, CASE WHEN c_custkey % 9 <> 0 THEN c_custkey % 3 + 1 END AS ev, * FROM customer)
  SELECT id AS subject_id, 'hasStatus' AS predicate, o_orderstatus AS object_value, CAST(NULL AS VARCHAR) AS object_id, CAST(NULL AS VARCHAR) AS geometry, CAST(ev AS BIGINT) AS evidence_id FROM o
  UNION ALL SELECT id, 'hasPriority', o_orderpriority, NULL, NULL, ev FROM o
  UNION ALL SELECT id, 'hasDate', strftime(o_orderdate, '%Y-%m-%d'), NULL, NULL, ev FROM o
  UNION ALL SELECT id, 'hasSender', NULL, CASE WHEN o_orderkey % 100 = 17 THEN 'ac:missing' ELSE 'ac:' || o_custkey END, NULL, ev FROM o
  UNION ALL SELECT id, 'hasName', c_name, NULL, NULL, ev FROM c
  UNION ALL SELECT id, 'hasType', c_mktsegment, NULL, NULL, ev FROM c
  UNION ALL SELECT id, 'hasAmount', CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), NULL, NULL, ev FROM c
  UNION ALL SELECT id, 'locatedIn', NULL, 'n:' || c_nationkey, NULL, ev FROM c
  UNION ALL SELECT 'n:' || n_nationkey, 'hasName', n_name, NULL, NULL, 1 FROM nation
  UNION ALL SELECT 'n:' || n_nationkey, 'locatedIn', NULL, 'r:' || n_regionkey, NULL, 1 FROM nation
  UNION ALL SELECT 'r:' || r_regionkey, 'hasPart', NULL, 'r:' || r_regionkey, NULL, 1 FROM region
  UNION ALL SELECT 's:' || s_suppkey, 'locatedIn', NULL, 'n:' || s_nationkey, NULL, 2 FROM supplier
  UNION ALL SELECT 's:' || s_suppkey, 'locatedAt', NULL, NULL, 'POINT(' || s_suppkey % 180 || ' ' || s_suppkey % 90 || ')', 2 FROM supplier
  UNION ALL SELECT 'ev:' || event_id, 'hasType', event_type, NULL, NULL, event_id % 10 FROM events
  UNION ALL SELECT 'ev:' || event_id, 'carriedOutBy', NULL, 'ac:' || user_id, NULL, event_id % 10 FROM events
  UNION ALL SELECT 'img:' || page_id, 'depicts', NULL, 's:' || page_id % 40, NULL, 3 FROM pages)"""


def lon(key: str) -> Column:
    return (F.col(key) * 7919 % 36000).cast("double") / 100.0 - 180.0


def lat(key: str) -> Column:
    return (F.col(key) * 104729 % 18000).cast("double") / 100.0 - 90.0


def nation_polygons(spark: SparkSession, d: str) -> DataFrame:
    """(region, polygon_id, wkt): one diamond for each nation on a grid of five by five."""
    n = F.col("n_nationkey")
    cx = -180.0 + 72.0 * (n % 5) + 36.0
    cy = -90.0 + 36.0 * F.floor(n / 5) + 18.0
    corner = lambda dx, dy: F.concat_ws(" ", (cx + dx).cast("string"), (cy + dy).cast("string"))
    ring = F.concat_ws(", ", corner(-36, 0), corner(0, -18), corner(36, 0), corner(0, 18), corner(-36, 0))
    return table(spark, d, "nation").select(F.lit("world").alias("region"), id_of("n", "n_nationkey").alias("polygon_id"), F.concat(F.lit("POLYGON(("), ring, F.lit("))")).alias("wkt"))


def supplier_polygons(spark: SparkSession, d: str) -> DataFrame:
    """(polygon_id, wkt): a small diamond around each supplier's point."""
    x, y = lon("s_suppkey"), lat("s_suppkey")
    corner = lambda dx, dy: F.concat_ws(" ", (x + dx).cast("string"), (y + dy).cast("string"))
    ring = F.concat_ws(", ", corner(-1, 0), corner(0, -0.5), corner(1, 0), corner(0, 0.5), corner(-1, 0))
    return table(spark, d, "supplier").select(id_of("s", "s_suppkey").alias("polygon_id"), F.concat(F.lit("POLYGON(("), ring, F.lit("))")).alias("wkt"))
