"""Ingest queries: connectors, cleaning, keys, promotion, geometry input and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.functions import clean as C
from cairnspark.functions import geo as G
from cairnspark.functions.session import cut, fresh_folder, table
from cairnspark.operators import connect, promote, store
from cairnspark.plans.demo import PART_SQL, part_statements
from cairnspark.plans.graph import ENTITIES, entities, supplier_polygons
from cairnspark.plans.registry import query
from cairnspark.sources import connectors, readers
from cairnspark.streaming import filedrop


@query("""SELECT 'S' || s_suppkey AS key, CASE WHEN s_suppkey % 4 = 0 THEN 'clu' ELSE 'pl' END AS kind, 'file#ID=S' || s_suppkey AS source_uri FROM supplier WHERE s_suppkey % 10 <> 7""")
def points_csv(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(
        F.when(key % 10 != 7, F.concat(F.lit("S"), key.cast("string"))).alias("ID"), F.col("s_name").alias("Name"), F.when(key % 4 == 0, "区域").otherwise("单点").alias("Layer")
    )
    path = fresh_folder(spark, "points")
    rows.write.csv(path, header=True)
    return readers.points_csv(spark, path, "ID string, Name string, Layer string").select(F.col("ID").alias("key"), "kind", "source_uri")


@query("SELECT event_id, '照片' || event_type AS name FROM events")
def photo_table_gbk(spark: SparkSession, d: str) -> DataFrame:
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    path = fresh_folder(spark, "photos")
    table(spark, d, "events").select("event_id", F.concat(F.lit("照片"), "event_type").alias("name")).write.csv(path, header=True, encoding="GB18030")
    return readers.encoded_csv(spark, f"{path}/*.csv", "event_id long, name string")


LETTERS = """l AS (SELECT o_orderkey AS id, c_name AS sender, n_name AS location, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS area FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


@query(f"""WITH {LETTERS}, p AS (SELECT *, coalesce(nullif(trim(area), ''), location) AS place FROM l)
SELECT 'doc:' || id AS entity, 'hasSender' AS predicate, sender AS value FROM p UNION ALL SELECT 'doc:' || id, 'hasOriginPlace', place FROM p
UNION ALL SELECT 'ac:' || sender, 'hasName', sender FROM p UNION ALL SELECT 'pl:' || place, 'hasName', place FROM p UNION ALL SELECT 'pl:' || place, 'hasLocation', location FROM p WHERE location <> place""")
def letters_fan_out(spark: SparkSession, d: str) -> DataFrame:
    joined = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    area = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment"))
    place = C.first_filled(area, F.col("n_name"))
    rows = joined.select(F.col("o_orderkey").cast("string").alias("id"), F.col("c_name").alias("sender"), place.alias("place"), F.col("n_name").alias("location"))
    row = lambda e, p, v: F.struct(e.alias("entity"), F.lit(p).alias("predicate"), v.alias("value"))
    doc, ac, pl = (F.concat(F.lit(f"{p}:"), F.col(c)) for p, c in (("doc", "id"), ("ac", "sender"), ("pl", "place")))
    made = F.array(
        row(doc, "hasSender", F.col("sender")), row(doc, "hasOriginPlace", F.col("place")), row(ac, "hasName", F.col("sender")),
        row(pl, "hasName", F.col("place")), row(pl, "hasLocation", C.if_different(F.col("location"), F.col("place"))),
    )
    return rows.select(F.inline(F.filter(made, lambda s: s["value"].isNotNull())))


@query("""SELECT region, n FROM (SELECT c_mktsegment AS region, count(*) AS n, min(c_custkey) AS first FROM customer WHERE c_custkey <> 1 AND c_custkey % 7 <> 0 GROUP BY 1) ORDER BY n DESC, first LIMIT 1""")
def template_region(spark: SparkSession, d: str) -> DataFrame:
    """Most common region of a sheet without its example row and its rows whose critical cells are all empty."""
    k = F.col("c_custkey")
    name = F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("c_name"))
    sheet = table(spark, d, "customer").select(k.alias("ord"), C.clean(name).alias("natural_key"), F.col("c_mktsegment").alias("region"))
    rows = sheet.filter(~F.col("ord").eqNullSafe(1) & F.col("natural_key").isNotNull())
    return rows.groupBy("region").agg(F.count("*").alias("n"), F.min("ord").alias("first")).orderBy(F.desc("n"), "first").limit(1).drop("first")


@query("""WITH r AS (SELECT 's' || s_suppkey AS natural_key, s_name, 'n' || s_nationkey AS nation, CASE WHEN s_suppkey % 2 = 0 THEN '0.5' END AS conf FROM supplier)
SELECT natural_key, 'hasName' AS predicate, s_name AS value, CAST(NULL AS VARCHAR) AS ref, coalesce(CAST(conf AS DOUBLE), 1.0) AS confidence, 'nation=' || nation AS metadata FROM r
UNION ALL SELECT natural_key, 'locatedIn', NULL, nation, coalesce(CAST(conf AS DOUBLE), 1.0), 'nation=' || nation FROM r""")
def unpivot_by_role_spec(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    nation = F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))
    rows = table(spark, d, "supplier").select(
        F.concat(F.lit("s"), k.cast("string")).alias("key"), "s_name", nation.alias("place"), nation.alias("nation"), F.when(k % 2 == 0, "0.5").alias("conf"), F.lit("x").alias("idle")
    )
    spec = [("s_name", "hasName", "VALUE", None), ("place", "locatedIn", "REF_PL", "pl"), ("nation", None, "META", None), ("conf", None, "CONFIDENCE", None), ("idle", None, "IGNORE", None)]
    made = connect.unpivot_by_roles(rows, "key", spark.createDataFrame(spec, "column string, predicate string, role string, ref_type string"))
    get = lambda p: F.get_json_object("stmt_value", p)
    return made.select("natural_key", "predicate", get("$.value").alias("value"), get("$.ref_natural_key").alias("ref"), "confidence", "metadata")


@query("""SELECT 3 * count(*) AS statements, count(DISTINCT o_orderkey) AS entities, count(*) AS edges, (SELECT count(*) FROM (SELECT DISTINCT 'ac-' || o_custkey FROM orders)) AS refs FROM orders""")
def spec_mapping_summary(spark: SparkSession, d: str) -> DataFrame:
    """Dry run of a mapping: two value columns and a reference with a prefix; refs get one name each."""
    orders = table(spark, d, "orders")
    ref = F.concat_ws("-", F.lit("ac"), F.col("o_custkey").cast("string"))
    made = orders.select("o_orderkey", F.inline(connect.fan_out(
        ("kind", "v"), (F.lit("value"), F.col("o_orderstatus")), (F.lit("value"), F.col("o_orderpriority")), (F.lit("ref"), ref))))
    names = connect.spread_ref_names(made.filter("kind = 'ref'"), F.col("v"), F.lit("ac"), F.col("v"), F.col("o_orderkey"))
    total = made.agg(F.count("*").alias("statements"), F.count_distinct("o_orderkey").alias("entities"), F.count_if(F.col("kind") == "ref").alias("edges"))
    return total.join(names.agg(F.count("*").alias("refs")), F.lit(True))


@query("""SELECT doc_id, coalesce(CASE WHEN doc_id % 5 = 0 THEN NULL ELSE nullif(trim(lang), '') END, CASE WHEN source = 'src3' THEN NULL ELSE source END, 'none left') AS chosen FROM documents WHERE length(text) > 100""")
def clean_and_coalesce(spark: SparkSession, d: str) -> DataFrame:
    lang = F.when(F.col("doc_id") % 5 == 0, " NaN ").otherwise(F.concat(F.lit(" "), "lang", F.lit(" ")))
    source = F.when(F.col("source") == "src3", "none").otherwise(F.col("source"))
    return table(spark, d, "documents").filter(F.length("text") > 100).select("doc_id", F.coalesce(C.first_filled(lang, source), F.lit("none left")).alias("chosen"))


@query("""SELECT l_orderkey, l_linenumber, coalesce(nullif(trim(CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END || '|' || CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END || '|' || l_linestatus, '|'), ''), 'x') AS key FROM lineitem""")
def composite_key(spark: SparkSession, d: str) -> DataFrame:
    order = F.when(F.col("l_linenumber") == 1, "").otherwise(F.col("l_orderkey").cast("string"))
    flag = F.when(F.col("l_returnflag") == "N", "nan").otherwise(F.col("l_returnflag"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", C.composite_key(order, flag, F.col("l_linestatus")).alias("key"))


@query("""SELECT page_id, CASE WHEN contains(lower(k), '-pl-') THEN 'pl' WHEN contains(lower(k), '-clu-') THEN 'clu' WHEN contains(lower(k), '-ac-') THEN 'ac' WHEN contains(lower(k), '-doc-') THEN 'doc' WHEN contains(lower(k), '-img-') THEN 'img' ELSE 'pl' END AS kind
FROM (SELECT page_id, 'X-' || CASE page_id % 6 WHEN 0 THEN 'PL' WHEN 1 THEN 'clu' WHEN 2 THEN 'Ac' WHEN 3 THEN 'doc' WHEN 4 THEN 'img' ELSE 'zz' END || '-' || url AS k FROM pages)""")
def ref_type_guess(spark: SparkSession, d: str) -> DataFrame:
    mark = F.element_at(F.array(*map(F.lit, ("PL", "clu", "Ac", "doc", "img", "zz"))), (F.col("page_id") % 6 + 1).cast("int"))
    return table(spark, d, "pages").select("page_id", C.ref_type_of(F.concat(F.lit("X-"), mark, F.lit("-"), "url")).alias("kind"))


@query(f"SELECT p_partkey, predicate, value, row_number() OVER (ORDER BY p_partkey, predicate, value) AS row_seq FROM ({PART_SQL}) WHERE value IS NOT NULL")
def row_sequence(spark: SparkSession, d: str) -> DataFrame:
    return connect.numbered(part_statements(spark, d), ["p_partkey", "predicate", "value"])


@query("SELECT doc_id, source, source || '-' || printf('%04d', row_number() OVER (PARTITION BY source ORDER BY doc_id)) AS key FROM documents WHERE length(trim(text)) > 0")
def synthetic_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter(F.length(F.trim("text")) > 0).select("doc_id", "source")
    made = connect.synthetic_keys(rows, "source", "doc_id", "")
    return made.select("doc_id", "source", F.concat("source", "natural_key").alias("key"))


@query("SELECT o_custkey, min(o_orderkey) AS first_order, arg_min(o_orderpriority, o_orderkey) AS label FROM orders GROUP BY 1")
def first_per_source(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_order"), F.min_by("o_orderpriority", "o_orderkey").alias("label"))


@query("""WITH k AS (SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'east' ELSE 'west' END AS region, c_name AS nk, c_custkey * 2 < (SELECT max(c_custkey) FROM customer) AS early, c_mktsegment AS temporal FROM customer)
SELECT region, nk AS natural_key, 'kg:' || region || ':ac-' || temporal || '-' || printf('%07d', row_number() OVER (PARTITION BY region ORDER BY early DESC, nk)) AS pid FROM k""")
def mint_pids(spark: SparkSession, d: str) -> DataFrame:
    """Customers in two batches, of which the second holds the first again."""
    customers = table(spark, d, "customer")
    keys = customers.select(
        F.when(F.col("c_nationkey") % 2 == 0, "east").otherwise("west").alias("region"), F.lit("ac").alias("kind"),
        F.col("c_name").alias("natural_key"), F.col("c_mktsegment").alias("temporal"), "c_custkey",
    )
    top = customers.agg(F.max("c_custkey").alias("top"))
    early = keys.join(F.broadcast(top), F.col("c_custkey") * 2 < F.col("top"))
    first = cut(promote.mint(promote.empty_graph(spark)["registry"], early))
    return promote.mint(first, keys).select("region", "natural_key", "pid")


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'text' WHEN 1 THEN 'ref' WHEN 2 THEN 'geometry' WHEN 3 THEN 'time' ELSE 'json' END AS kind,
CASE event_id % 5 WHEN 0 THEN event_type WHEN 3 THEN '2024-01-01' WHEN 4 THEN props END AS literal, CAST(CASE WHEN event_id % 10 = 0 THEN 0.25 ELSE 1.0 END AS DOUBLE) AS confidence FROM events""")
def value_dispatch(spark: SparkSession, d: str) -> DataFrame:
    v = _shaped(F.col("event_id"), F.col("event_type"), F.col("props"))
    rows = table(spark, d, "events").select("event_id", v.alias("v"))
    return rows.select("event_id", C.json_kind(F.col("v")).alias("kind"), C.literal_of(F.col("v")).alias("literal"), C.confidence_of(F.col("v")).alias("confidence"))


def _shaped(k: Column, text: Column, raw: Column) -> Column:
    """Statement values of the five shapes by key."""
    certain = F.to_json(F.struct(text.alias("value")))
    doubtful = F.to_json(F.struct(text.alias("value"), F.lit("0.25").alias("confidence")))
    return (
        F.when(k % 10 == 0, doubtful).when(k % 5 == 0, certain)
        .when(k % 5 == 1, F.to_json(F.struct(text.alias("ref_natural_key"))))
        .when(k % 5 == 2, F.to_json(F.struct(F.format_string("POINT(%d 1)", k % 90).alias("wkt"))))
        .when(k % 5 == 3, F.lit('{"iso": "2024-01-01"}')).otherwise(raw)
    )


@query("""SELECT c_name AS pid, CASE WHEN c_custkey % 3 = 0 THEN 'real ' || c_name WHEN c_custkey % 2 = 0 THEN 'old ' || c_name ELSE c_name END AS label, NOT (c_custkey % 3 = 0 OR c_custkey % 2 = 0) AS stub FROM customer""")
def entity_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Stubs and named entities meet new names: a real name replaces a stub's label, never a real one."""
    n, k = table(spark, d, "customer"), F.col("c_custkey")
    named = (k % 2 == 0) & (k % 3 != 0)
    old = n.select(F.col("c_name").alias("pid"), F.lit("pl").alias("entity_type"), F.when(named, F.concat(F.lit("old "), "c_name")).otherwise(F.col("c_name")).alias("label"), (~named).alias("stub"))
    new = n.filter((k % 3 == 0) | (k % 2 == 0)).select(F.col("c_name").alias("pid"), F.lit("pl").alias("entity_type"), F.concat(F.lit("real "), "c_name").alias("label"), F.lit(False).alias("stub"))
    return promote.upsert_labels(old, new).select("pid", "label", "stub")


def staged_orders(spark: SparkSession, d: str, batch: str) -> DataFrame:
    """Orders as staged rows: a status and a sender reference for each, and the sender's name from customer."""
    j = lambda **f: F.to_json(F.struct(*[c.alias(n) for n, c in f.items()]))
    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    doc, key = F.lit("doc"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))
    made = orders.select("o_orderkey", F.posexplode(connect.fan_out(
        ("kind", "nk", "p", "v"),
        (doc, key, F.lit("hasStatus"), j(value=F.col("o_orderstatus"))),
        (doc, key, F.lit("hasSender"), j(ref_natural_key=F.col("c_mktsegment"), ref_type_abbr=F.lit("ac"))),
    )).alias("pos", "s"), F.lower("o_orderpriority").alias("source"))
    none = F.lit(None).cast("string")
    return made.select(
        F.lit(batch).alias("batch_id"), (F.col("o_orderkey") * 2 + F.col("pos")).alias("row_seq"), F.concat(F.lit("file#"), "source").alias("source_uri"), F.lit("table").alias("source_type"),
        F.lit("c").alias("collector"), F.lit("east").alias("region"), F.col("s.kind").alias("kind"), F.lit("unk").alias("temporal"), F.col("s.nk").alias("natural_key"),
        F.col("s.p").alias("predicate"), F.col("s.v").alias("stmt_value"), none.alias("valid_from"), none.alias("valid_to"),
    )


def _promoted(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    return promote.promote(promote.empty_graph(spark), staged_orders(spark, d, "b1"))


@query("SELECT c_mktsegment AS sender, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 ORDER BY n DESC, sender LIMIT 10")
def promoted_flow_topk(spark: SparkSession, d: str) -> DataFrame:
    """Staged orders promoted, then the busiest senders of the graph's hasSender edges."""
    graph, _, _ = _promoted(spark, d)
    named = graph["entities"].select(F.col("pid").alias("object_id"), F.col("label").alias("sender"))
    edges = graph["statements"].filter("predicate = 'hasSender'").join(named, "object_id")
    return edges.groupBy("sender").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "sender").limit(10)


@query("""WITH j AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey) SELECT 'registry' AS name, count(*) + count(DISTINCT c_mktsegment) AS n FROM j UNION ALL SELECT 'entities', count(*) + count(DISTINCT c_mktsegment) FROM j
UNION ALL SELECT 'evidence', count(DISTINCT o_orderpriority) FROM j UNION ALL SELECT 'statements', 2 * count(*) FROM j UNION ALL SELECT 'inserted again', 0""")
def promote_idempotent(spark: SparkSession, d: str) -> DataFrame:
    graph, _, _ = _promoted(spark, d)
    again, audit, _ = promote.promote(graph, staged_orders(spark, d, "b2"))
    count = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
    out = audit.select(F.lit("inserted again").alias("name"), F.col("rows_inserted").cast("long").alias("n"))
    for name, df in again.items():
        out = out.unionByName(count(name, df))
    return out


@query("""SELECT source AS source_name, CASE WHEN count(*) FILTER (WHERE doc_id % 2 = 0) > 0 THEN 'old' ELSE 'new' END AS known FROM documents GROUP BY 1""")
def evidence_reuse(spark: SparkSession, d: str) -> DataFrame:
    """Sources of even documents are in the evidence already and keep their ids; a second run adds no row."""
    sources = lambda df: df.groupBy(F.col("source").alias("source_name")).agg(F.lit("t").alias("source_type"), F.lit("c").alias("collector"), F.lit(None).cast("string").alias("metadata"))
    docs, empty = table(spark, d, "documents"), promote.empty_graph(spark)["evidence"]
    old, _ = promote.new_evidence(empty, sources(docs.filter("doc_id % 2 = 0")))
    added, ids = promote.new_evidence(old, sources(docs))
    again, same = promote.new_evidence(old.unionByName(added), sources(docs))
    joined = ids.join(same.withColumnRenamed("evidence_id", "again"), "source_uri").join(again.select(F.col("source_name").alias("source_uri"), F.lit(1).alias("twice")), "source_uri", "left")
    mark = F.when(F.col("evidence_id") != F.col("again"), "moved").when(F.col("twice").isNotNull(), "doubled").when(F.col("k").isNotNull(), "old").otherwise("new")
    return joined.join(old.select(F.col("source_name").alias("source_uri"), F.lit(1).alias("k")), "source_uri", "left").select(F.col("source_uri").alias("source_name"), mark.alias("known"))


@query("""SELECT CASE event_id % 8 WHEN 0 THEN 'bad_region' WHEN 1 THEN 'bad_geometry' WHEN 2 THEN 'bad_confidence' ELSE 'bad_reference' END AS error, count(*) AS n FROM events WHERE event_id % 8 < 6 GROUP BY 1""")
def rejects_by_code(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    value = (
        F.when(k % 8 == 1, F.lit('{"wkt": "POINT(1 )"}')).when(k % 8 == 2, F.lit('{"value": "a", "confidence": "high"}')).when(k % 8 == 3, F.lit('{"ref_natural_key": " "}'))
        .when(k % 8 == 4, F.lit('{"ref_natural_key": "a", "ref_type_abbr": "NOT A TYPE"}')).when(k % 8 == 5, F.lit('{"ref_natural_key": "a", "ref_region": "X Y"}'))
        .when(k % 8 == 6, F.lit('{"ref_natural_key": "a"}')).otherwise(F.lit('{"wkt": "POLYGON((0 0, 1 0, 1 1, 0 0))"}')))
    staged = table(spark, d, "events").select(
        F.when(k % 8 == 0, "East!").otherwise("east").alias("region"), F.lit("ev").alias("kind"), k.cast("string").alias("natural_key"), value.alias("stmt_value"))
    return promote.reject(staged).filter("error IS NOT NULL").groupBy("error").agg(F.count("*").alias("n"))


@query("""WITH b AS (SELECT 'b1' AS batch_id, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'b2', count(*) FROM orders WHERE o_orderkey % 2 = 1)
SELECT batch_id, 2 * n AS rows_in, CAST(0 AS BIGINT) AS rows_err, 2 * n AS rows_inserted, CAST(0 AS BIGINT) AS rows_skipped, 'success' AS status FROM b
UNION ALL SELECT 'b3', 2 * (SELECT count(*) FROM orders), 0, 0, 2 * (SELECT count(*) FROM orders), 'success'""")
def graph_store(spark: SparkSession, d: str) -> DataFrame:
    """Two batches staged twice and promoted in one commit, then all rows again as a third batch: the store's audit."""
    staging, kept = fresh_folder(spark, "staging"), fresh_folder(spark, "store")
    rows = staged_orders(spark, d, "b1").withColumn("batch_id", F.when(F.regexp_extract("natural_key", r"(\d+)$", 1).cast("long") % 2 == 0, "b1").otherwise("b2"))
    for _ in range(2):
        store.stage_rows(rows, staging)
    store.promote_waiting(spark, staging, kept)
    store.stage_rows(staged_orders(spark, d, "b3"), staging)
    store.promote_waiting(spark, staging, kept)
    store.promote_waiting(spark, staging, kept)  # nothing waits
    return store.audit_of(spark, kept).select("batch_id", "rows_in", "rows_err", "rows_inserted", "rows_skipped", "status")


_UTM = "c_custkey, 400000.0 + CAST(c_custkey * 7919 % 200000 AS DOUBLE) AS e, 3000000.0 + CAST(c_custkey * 104729 % 900000 AS DOUBLE) AS n"


@query(f"""WITH u AS (SELECT {_UTM}, CAST('6378137' AS DOUBLE) AS a, CAST('0.0066943799901413165' AS DOUBLE) AS e2, CAST('0.9996' AS DOUBLE) AS k0 FROM customer), v AS (SELECT *, e2 / (1 - e2) AS ep2, (1 - sqrt(1 - e2)) / (1 + sqrt(1 - e2)) AS e1, n / k0 / (a * (1 - e2 / 4 - 3 * e2 * e2 / 64 - 5 * e2 * e2 * e2 / 256)) AS mu FROM u),
w AS (SELECT *, mu + (3 * e1 / 2 - 27 * pow(e1, 3) / 32) * sin(2 * mu) + (21 * e1 * e1 / 16 - 55 * pow(e1, 4) / 32) * sin(4 * mu) + 151 * pow(e1, 3) / 96 * sin(6 * mu) + 1097 * pow(e1, 4) / 512 * sin(8 * mu) AS p FROM v),
x AS (SELECT *, pow(tan(p), 2) AS t, ep2 * pow(cos(p), 2) AS c, a / sqrt(1 - e2 * pow(sin(p), 2)) AS n1, a * (1 - e2) / pow(1 - e2 * pow(sin(p), 2), 1.5) AS r1 FROM w), y AS (SELECT *, (e - 500000) / (n1 * k0) AS d FROM x)
SELECT c_custkey, round(81 + degrees((d - (1 + 2 * t + c) * pow(d, 3) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep2 + 24 * t * t) * pow(d, 5) / 120) / cos(p)), 6) AS lon,
round(degrees(p - n1 * tan(p) / r1 * (d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep2) * pow(d, 4) / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep2 - 3 * c * c) * pow(d, 6) / 720)), 6) AS lat FROM y""")
def utm_to_wgs84(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").selectExpr(*[x.strip() for x in ("c_custkey", "400000D + CAST(c_custkey * 7919 % 200000 AS DOUBLE) AS e", "3000000D + CAST(c_custkey * 104729 % 900000 AS DOUBLE) AS n")])
    x, y = G.utm_to_wgs84(F.col("e"), F.col("n"), 44)
    return rows.select("c_custkey", F.round(x, 6).alias("lon"), F.round(y, 6).alias("lat"))


@query("SELECT c_custkey, round((CASE WHEN c_custkey % 2 = 0 THEN -1 ELSE 1 END) * (c_custkey % 90 + c_custkey % 60 / 60.0 + c_custkey % 3600 / 60.0 / 3600.0), 8) + 0.0 AS value FROM customer")
def dms_to_decimal(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    value = C.dms_to_decimal(k % 90, k % 60, k % 3600 / 60.0, F.when(k % 2 == 0, "S").otherwise("N"))
    return table(spark, d, "customer").select("c_custkey", F.round(value, 8).alias("value"))


_REGISTRY = """reg AS (SELECT CASE WHEN CAST(split_part(pid, ':', 2) AS BIGINT) % 2 = 0 THEN 'east' ELSE 'west' END AS region, entity_type, 'key ' || pid AS natural_key, pid FROM entities WHERE entity_type IN ('pl', 'clu', 'ac')),
named AS (SELECT pid, label FROM entities WHERE CAST(split_part(pid, ':', 2) AS BIGINT) % 10 <> 3)"""


def _registry(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Identifiers of places, units and actors, and the entities, of which one in ten is missing."""
    number = F.split_part("pid", F.lit(":"), F.lit(2)).cast("long")
    all_ = entities(spark, d)
    registry = all_.filter(F.col("entity_type").isin("pl", "clu", "ac")).select(
        F.when(number % 2 == 0, "east").otherwise("west").alias("region"), F.col("entity_type").alias("kind"), F.concat(F.lit("key "), "pid").alias("natural_key"), "pid")
    return registry, all_.filter(number % 10 != 3)


@query(f"WITH {ENTITIES}, {_REGISTRY} SELECT region, entity_type, natural_key, label, pid FROM reg LEFT JOIN named USING (pid)")
def authority_list(spark: SparkSession, d: str) -> DataFrame:
    """The registry with labels, written as CSV by region and read again."""
    path = fresh_folder(spark, "authority")
    promote.write_authority(promote.authority_list(*_registry(spark, d)), path)
    schema = "entity_type string, natural_key string, label string, pid string, region string"
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=True).select("region", "entity_type", "natural_key", "label", "pid")


@query(f"WITH {ENTITIES}, {_REGISTRY} SELECT region, entity_type, count(*) AS n, count(label) AS named FROM reg LEFT JOIN named USING (pid) GROUP BY 1, 2")
def authority_counts(spark: SparkSession, d: str) -> DataFrame:
    listed = promote.authority_list(*_registry(spark, d))
    return listed.groupBy("region", "entity_type").agg(F.count("*").alias("n"), F.count("label").alias("named"))


@query("""WITH o AS (SELECT o_orderkey, date_trunc('day', o_orderdate) AS day FROM orders) SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN day + INTERVAL '9:03:02' HOUR TO SECOND WHEN 1 THEN day + INTERVAL '9:03' HOUR TO MINUTE
WHEN 2 THEN day + INTERVAL '9:03:02' HOUR TO SECOND WHEN 3 THEN day + INTERVAL '9:03' HOUR TO MINUTE WHEN 4 THEN day WHEN 5 THEN day END AS captured FROM o""".replace(
    "INTERVAL '9:03:02' HOUR TO SECOND", "INTERVAL 32582 SECOND").replace("INTERVAL '9:03' HOUR TO MINUTE", "INTERVAL 32580 SECOND"))
def parse_capture_time(spark: SparkSession, d: str) -> DataFrame:
    """Order dates printed in the six formats by key, with digits left out where they may be; two texts are no times."""
    k, day = F.col("o_orderkey"), F.date_trunc("day", "o_orderdate")
    text = F.when(k % 8 == 6, "unknown").otherwise("2024:05:01 09:03:02")
    for i, f in enumerate(("yyyy/M/d '9:03:02'", "yyyy/M/d '9:03'", "yyyy-M-d '9:3:2'", "yyyy-MM-dd '09:03'", "yyyy/M/d", "yyyy-MM-dd")):
        text = F.when(k % 8 == i, F.date_format(day, f)).otherwise(text)
    return table(spark, d, "orders").select("o_orderkey", C.capture_time(text).cast("timestamp_ntz").alias("captured"))


@query("""SELECT p_partkey, trim(lower(p_name || ' ' || p_type)) AS header FROM part""")
def header_cleaning(spark: SparkSession, d: str) -> DataFrame:
    """Headers with standard codes, brackets of two scripts and blanks; what the brackets hold stays."""
    shown = F.concat(F.lit("E48 "), "p_name", F.when(F.col("p_partkey") % 2 == 0, "（").otherwise("("), "p_type", F.when(F.col("p_partkey") % 2 == 0, "）").otherwise(")  "))
    return table(spark, d, "part").select("p_partkey", C.normal_header(shown).alias("header"))


@query("SELECT 's:' || s_suppkey AS polygon_id, 'Polygon' AS kind, 5 AS corners, round(CAST(s_suppkey * 7919 % 36000 AS DOUBLE) / 100.0 - 181.0, 4) AS x_first FROM supplier")
def geojson_features(spark: SparkSession, d: str) -> DataFrame:
    """Supplier polygons written as GeoJSON and read again."""
    path = fresh_folder(spark, "features")
    ring = F.transform(G.rings(F.col("wkt"))[0], lambda p: F.array(p["x"], p["y"]))
    feature = F.struct(F.struct(F.col("polygon_id").alias("ID")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    supplier_polygons(spark, d).select(F.array(feature).alias("features")).write.json(path)
    rows = readers.geojson_features(spark, path, multi_line=False)
    first = F.col("rings")[0]
    return rows.select(F.col("properties")["ID"].alias("polygon_id"), "kind", F.size(first).alias("corners"), (F.round(first[0][0], 4) + 0.0).alias("x_first"))


@query("""SELECT DISTINCT 'hasType' AS predicate, p_type AS alias, p_brand AS canonical FROM part""")
def alias_file(spark: SparkSession, d: str) -> DataFrame:
    """Aliases of part types as JSON dictionaries with notes beside them, one for each brand, read again."""
    path = fresh_folder(spark, "aliases")
    pairs = table(spark, d, "part").select("p_brand", "p_type").distinct()
    names = pairs.groupBy("p_brand").agg(F.map_from_entries(F.collect_list(F.struct("p_type", "p_brand"))).alias("hasType"))
    names.select("hasType", F.lit("a note").alias("_note")).write.option("maxRecordsPerFile", 1).json(path)
    return readers.alias_dictionary(spark, path)


@query("SELECT 'east' AS region, c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT 'west', s_suppkey, s_name FROM supplier")
def file_drop_stream(spark: SparkSession, d: str) -> DataFrame:
    """Files dropped for two regions, streamed to a staging table twice; each file is staged once."""
    box, target = fresh_folder(spark, "inbox"), fresh_folder(spark, "staged")
    for region, t, k, v in (("east", "customer", "c_custkey", "c_name"), ("west", "supplier", "s_suppkey", "s_name")):
        table(spark, d, t).select(F.col(k).cast("long").alias("key"), F.col(v).alias("name")).write.csv(f"{box}/{region}", header=True)
    for _ in range(2):  # the second run has no checkpoint of the first and must still add nothing
        filedrop.stage(spark, box, "key long, name string", target, fresh_folder(spark, "drop"))
    return spark.read.parquet(target).select("region", "key", "name")


@query("SELECT 'hasLayer' AS predicate, count(*) AS n FROM supplier UNION ALL SELECT 'hasName', count(*) FROM supplier")
def file_drop_graph(spark: SparkSession, d: str) -> DataFrame:
    """Point files of two regions dropped twice: the region with a pipeline is promoted once into a stored graph."""
    box, staging, kept, files = (fresh_folder(spark, n) for n in ("inbox", "staging", "store", "files"))
    rows = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("OBJECTID"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ID"), F.col("s_name").alias("Name"), F.lit("单体").alias("Layer"))
    for region in ("east", "nowhere"):
        rows.write.csv(f"{box}/{region}", header=True)
    pipelines = {"east": connectors.heritage_points}
    for _ in range(2):
        filedrop.ingest(spark, box, "OBJECTID string, ID string, Name string, Layer string", pipelines, staging, kept, files, fresh_folder(spark, "drop"))
    return store.load(spark, kept)["statements"].groupBy("predicate").agg(F.count("*").alias("n"))


@query("SELECT 'east' AS region, false AS failed, count(*) AS files, (SELECT count(*) FROM supplier WHERE s_suppkey % 3 <> 0) AS entities FROM (VALUES (1), (2)) UNION ALL SELECT 'east', true, 1, (SELECT count(*) FROM supplier WHERE s_suppkey % 3 <> 0)")
def file_drop_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Three files of a region of which one is no readable file: two are promoted, one is set aside, and the stream goes on."""
    box, staging, kept, files = (fresh_folder(spark, n) for n in ("inbox", "staging", "store", "files"))
    rows = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("OBJECTID"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ID"), F.col("s_name").alias("Name"), F.lit("单体").alias("Layer"))
    for k in (1, 2):
        rows.filter(f"OBJECTID % 3 = {k}").coalesce(1).write.csv(f"{box}/{k}/east", header=True)
    rows.select(F.concat_ws(",", *rows.columns)).coalesce(1).write.text(f"{box}/0/east")
    fs = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jvm.java.net.URI(box), spark._jsc.hadoopConfiguration())
    path = spark._jvm.org.apache.hadoop.fs.Path
    text = next(x.getPath() for x in fs.listStatus(path(f"{box}/0/east")) if x.getPath().getName().startswith("part-"))
    fs.rename(text, path(f"{box}/0/east/broken.csv.gz"))  # plain text under the name of a packed file
    for _ in range(2):
        filedrop.ingest(spark, box, "OBJECTID string, ID string, Name string, Layer string", {"east": connectors.heritage_points}, staging, kept, files, fresh_folder(spark, "drop"), max_files=2)
    seen = spark.read.parquet(files).groupBy("region", F.col("error").isNotNull().alias("failed")).agg(F.count("*").alias("files"))
    return seen.join(store.load(spark, kept)["entities"].agg(F.count("*").alias("entities")), F.lit(True))


@query("""WITH s AS (SELECT s_suppkey, 'S' || s_suppkey AS nk FROM supplier WHERE s_suppkey <> 1), e AS (SELECT 'ev-' || printf('%04d', row_number() OVER (ORDER BY event_id)) AS nk, event_type, user_id FROM events)
SELECT 'pl' AS kind, nk AS natural_key, 'hasName' AS predicate, s_name AS literal FROM supplier JOIN s USING (s_suppkey) UNION ALL SELECT 'ev', nk, 'hasType', event_type FROM e UNION ALL SELECT 'ev', nk, 'carriedOutBy', 'u' || user_id FROM e""")
def template_workbook(spark: SparkSession, d: str) -> DataFrame:
    """A workbook of two known sheets, one with an example row and one without keys, and a sheet that is skipped."""
    places = table(spark, d, "supplier").select(F.col("s_suppkey").alias("row"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("key"), F.col("s_name").alias("name"))
    happened = table(spark, d, "events").select(F.col("event_id").alias("row"), "event_type", F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("who"))
    specs = {
        "Place": {"columns": [("key", None, "NATURAL_KEY"), ("name", "hasName", "VALUE")], "example_key": "S1"},
        "Event": {"columns": [("event_type", "hasType", "VALUE"), ("who", "carriedOutBy", "REF_AC")], "kind": "ev", "prefix": "ev"},
    }
    made = connectors.template_workbook({" Place ": places, "Event": happened, "Notes": places}, specs, "/in/book", "east", "row")
    get = lambda k: F.get_json_object("stmt_value", f"$.{k}")
    return made.select("kind", "natural_key", "predicate", F.coalesce(get("value"), get("ref_natural_key")).alias("literal"))
