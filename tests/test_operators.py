import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnspark.functions import joins
from cairnspark.operators import connect, govern, match, ontology, promote, spatial, store
from cairnspark.sources import readers


def staged(spark, rows):
    names = "batch_id row_seq source_uri source_type collector region kind temporal natural_key predicate stmt_value valid_from valid_to"
    schema = ", ".join(f"{n} {'long' if n == 'row_seq' else 'string'}" for n in names.split())
    full = [("b", i, "file#1", "table", "c", "east", k, t, nk, p, v, None, None) for i, (k, t, nk, p, v) in enumerate(rows)]
    return spark.createDataFrame(full, schema)


ROWS = [
    ("pl", "2024", "a", "hasName", '{"value": "Gate"}'), ("pl", "unk", "a", "hasType", '{"value": "wall"}'),
    ("img", "unk", "i1", "depicts", '{"ref_natural_key": "b"}'), ("pl", "unk", "a", "locatedAt", '{"wkt": "POINT(1 2)"}'),
    ("pl", "unk", "a", "hasNote", '{"value": "x", "confidence": "bad"}'),
]


def test_promote_is_idempotent_and_typed(spark):
    g, audit, rejected = promote.promote(promote.empty_graph(spark), staged(spark, ROWS))
    assert {n: d.count() for n, d in g.items()} == {"registry": 3, "entities": 3, "evidence": 1, "statements": 4}
    assert [r["error"] for r in rejected.collect()] == ["bad_confidence"]
    assert audit.first()["status"] == "partial"
    again, audit, _ = promote.promote(g, staged(spark, ROWS))
    assert audit.first()["rows_inserted"] == 0
    assert {n: d.count() for n, d in again.items()} == {n: d.count() for n, d in g.items()}
    named = promote.promote(g, staged(spark, [("pl", "unk", "b", "hasName", '{"value": "Tower"}')]))[0]
    assert {(r["label"], r["stub"]) for r in named["entities"].collect()} == {("Gate", False), (None, False), ("Tower", False)}


def test_promote_empty(spark):
    g, audit, rejected = promote.promote(promote.empty_graph(spark), staged(spark, ROWS).limit(0), ["b"])
    assert rejected.count() == 0 and g["statements"].count() == 0
    assert audit.select("batch_id", "rows_in", "rows_err", "rows_inserted", "rows_skipped", "status").collect() == [("b", 0, 0, 0, 0, "success")]


def test_audit_counts_each_batch(spark):
    rows = staged(spark, ROWS[:2]).withColumn("batch_id", F.concat(F.lit("b"), F.col("row_seq").cast("string")))
    _, audit, _ = promote.promote(promote.empty_graph(spark), rows.unionByName(rows.filter("row_seq = 1").withColumn("row_seq", F.lit(9).cast("long"))))
    got = {r["batch_id"]: (r["rows_in"], r["rows_inserted"], r["rows_skipped"], r["status"]) for r in audit.collect()}
    assert got == {"b0": (1, 1, 0, "success"), "b1": (2, 1, 1, "success")}


def test_references_are_checked(spark):
    bad = ['{"ref_natural_key": " "}', '{"ref_natural_key": "b", "ref_type_abbr": "NOT A TYPE"}', '{"ref_natural_key": "b", "ref_region": "X Y"}']
    rows = staged(spark, [("img", "unk", "i", "depicts", v) for v in [*bad, '{"ref_natural_key": "b", "ref_type_abbr": "ac", "ref_region": "west"}']])
    g, _, rejected = promote.promote(promote.empty_graph(spark), rows)
    assert [r["error"] for r in rejected.collect()] == ["bad_reference"] * 3
    assert {(r["region"], r["kind"], r["natural_key"]) for r in g["registry"].collect()} == {("east", "img", "i"), ("west", "ac", "b")}


def test_a_batch_writes_in_proportion_to_itself(spark, tmp_path):
    many = staged(spark, [("pl", "unk", f"k{i}", "hasName", f'{{"value": "n{i}"}}') for i in range(300)])
    few = staged(spark, [("pl", "unk", f"k{i}", "hasNote", '{"value": "x"}') for i in range(3)]).withColumn("batch_id", F.lit("c"))
    staging, kept = str(tmp_path / "staging"), str(tmp_path / "store")
    for rows in (many, few, few):
        store.stage_rows(rows, staging)
        store.promote_waiting(spark, staging, kept)
    written = {n: spark.read.parquet(f"{kept}/{n}/commit=2").count() for n in promote.SCHEMAS}
    assert written == {"registry": 0, "entities": 0, "evidence": 0, "statements": 3}
    g = store.load(spark, kept)
    assert {n: d.count() for n, d in g.items()} == {"registry": 300, "entities": 300, "evidence": 1, "statements": 303}
    assert store.audit_of(spark, kept).count() == 2 and store.processed(spark, staging, kept).filter("processed_at IS NULL").count() == 0
    store.commit({n: d.limit(1) for n, d in g.items()}, spark.createDataFrame([], store.AUDIT.rsplit(", ", 1)[0]), kept)
    assert store.load(spark, kept)["statements"].count() == 303  # deltas without audit rows are not read


def test_rows_staged_for_a_promoted_batch_are_promoted_too(spark, tmp_path):
    staging, kept = str(tmp_path / "staging"), str(tmp_path / "store")
    rows = staged(spark, [("pl", "unk", f"k{i}", "hasName", f'{{"value": "n{i}"}}') for i in range(4)])
    for part in (rows.filter("row_seq < 2"), rows, rows):
        store.stage_rows(part, staging)
        store.promote_waiting(spark, staging, kept)
    got = store.audit_of(spark, kept).orderBy("commit").select("batch_id", "rows_in", "rows_inserted").collect()
    assert [tuple(r) for r in got] == [("b", 2, 2), ("b", 2, 2)] and store.load(spark, kept)["statements"].count() == 4
    assert store.processed(spark, staging, kept).filter("processed_at IS NULL").count() == 0


def test_a_batch_reads_the_folders_of_its_regions_only(spark, tmp_path):
    staging, kept = str(tmp_path / "staging"), str(tmp_path / "store")
    both = staged(spark, [("pl", "unk", f"k{i}", "hasName", f'{{"value": "n{i}"}}') for i in range(8)]).withColumn("region", F.expr("if(row_seq % 2 = 0, 'east', 'west')"))
    store.stage_rows(both, staging)
    store.promote_waiting(spark, staging, kept)
    for name in ("registry", "entities", "statements"):
        plan = store.load(spark, kept)[name].filter("region = 'east'")._jdf.queryExecution().executedPlan().toString()
        found = [part for part in plan.split("PartitionFilters: [")[1:] if "region" in part.split("]")[0]]
        assert found, name
    broken = list((tmp_path / "store").glob("*/commit=1/region=west/*.parquet"))
    assert {f.parts[-4] for f in broken} == {"registry", "entities", "statements"}
    for f in broken:
        f.write_bytes(b"no parquet")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    more = staged(spark, [("pl", "unk", "k0", "hasNote", '{"value": "x"}'), ("pl", "unk", "k0", "hasName", '{"value": "n0"}')]).withColumn("batch_id", F.lit("c"))
    store.stage_rows(more, staging)
    assert store.promote_waiting(spark, staging, kept).count() == 0
    assert store.audit_of(spark, kept).filter("batch_id = 'c'").select("rows_inserted", "rows_skipped").collect() == [(1, 1)]
    with pytest.raises(Exception, match="(?i)parquet"):
        store.load(spark, kept)["statements"].filter("region = 'west'").collect()


def test_promotion_sorts_keys_by_hash_and_reads_no_empty_graph(spark, monkeypatch):
    plans, write = [], promote.cut
    monkeypatch.setattr(promote, "cut", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df))[1])
    promote.promote(promote.empty_graph(spark), staged(spark, ROWS))
    grouped = [g for p in plans for g in re.findall(r"Aggregate \[([^\]]*)\]", p) if "natural_key" in g]
    assert grouped and all(g.startswith("key_hash") for g in grouped)
    assert not any("FullOuter" in p or "LeftAnti" in p for p in plans)  # what an empty graph would be joined for


def test_a_run_with_nothing_waiting_writes_nothing(spark, tmp_path, monkeypatch):
    staging, kept = str(tmp_path / "staging"), str(tmp_path / "store")
    store.stage_rows(staged(spark, ROWS), staging)
    assert store.promote_waiting(spark, staging, kept).count() == 1
    for module in (promote, connect, store):
        monkeypatch.setattr(module, "cut", lambda df: pytest.fail("a table was written"))
    nothing = store.promote_waiting(spark, staging, kept)
    assert nothing.count() == 0 and nothing.columns[-2:] == ["stmt_value", "error"]
    assert store.audit_of(spark, kept).count() == 1


def test_waiting_rows_are_read_where_they_lie(spark, tmp_path, monkeypatch):
    staging, kept = str(tmp_path / "staging"), str(tmp_path / "store")
    rows = staged(spark, ROWS)
    store.stage_rows(rows.unionByName(rows), staging)
    late = staged(spark, ROWS[:1]).withColumn("row_seq", F.lit(77).cast("long"))
    promoted = store.promote_deltas

    def meanwhile(graph, waiting, *more):  # rows that are staged while a promotion runs wait for the next one
        store.stage_rows(late, staging)
        assert "cut-" not in str(waiting.inputFiles())
        return promoted(graph, waiting, *more)

    monkeypatch.setattr(store, "promote_deltas", meanwhile)
    store.promote_waiting(spark, staging, kept)
    monkeypatch.setattr(store, "promote_deltas", promoted)
    store.promote_waiting(spark, staging, kept)
    got = store.audit_of(spark, kept).orderBy("commit").select("rows_in", "rows_err", "rows_inserted", "rows_skipped").collect()
    assert [tuple(r) for r in got] == [(5, 1, 4, 0), (1, 0, 0, 1)]


def test_popular_keys_are_dealt_out(spark):
    rows = staged(spark, [("img", "unk", f"i{i}", "depicts", f'{{"ref_natural_key": "{"hot" if i % 3 else i}"}}') for i in range(300)])
    g, audit, _ = promote.promote(promote.empty_graph(spark), rows)
    assert g["statements"].count() == 300 and g["registry"].count() == 401 and audit.first()["rows_inserted"] == 300
    assert g["statements"].groupBy("object_id").count().agg(F.max("count")).first()[0] == 200


def test_numbers_are_gapless(spark):
    rows = spark.range(500).select((F.col("id") * 7919 % 503).alias("k"), (F.col("id") % 3).alias("g"))
    whole = connect.numbered(rows, ["k"]).orderBy("k").collect()
    assert [r["row_seq"] for r in whole] == list(range(1, 501))
    for g, n in ((0, 167), (1, 167), (2, 166)):
        part = connect.numbered(rows, ["k"], ["g"]).filter(F.col("g") == g).orderBy("k").collect()
        assert [r["row_seq"] for r in part] == list(range(1, n + 1))


def test_grid_join_equals_brute_force(spark):
    rng = random.Random(4)
    points = [("r", str(i), rng.uniform(-5, 15), rng.uniform(-5, 15)) for i in range(300)]
    shapes = [("r", "p1", "POLYGON((0 0, 10 0, 0 10, 0 0))"), ("r", "p2", "POLYGON((5 5, 9 5, 9 9, 5 9, 5 5))")]
    p = spark.createDataFrame(points, "region string, point_id string, x double, y double")
    s = spark.createDataFrame(shapes, "region string, polygon_id string, wkt string")
    got = {(r["polygon_id"], r["point_id"]) for r in spatial.contains_place(s, p, 3.0).collect()}
    want = {("p1", i) for _, i, x, y in points if x > 0 and y > 0 and x + y < 10} | {("p2", i) for _, i, x, y in points if 5 < x < 9 and 5 < y < 9}
    assert got == want


def in_polygon(corners, x, y):
    """Even-odd rule over numpy arrays of points."""
    x1, y1 = np.array(corners, float).T
    x2, y2 = np.roll(x1, -1), np.roll(y1, -1)
    out = np.zeros(len(x), int)
    for a, b, c, d in zip(x1, y1, x2, y2, strict=True):
        with np.errstate(divide="ignore", invalid="ignore"):
            out += ((b > y) != (d > y)) & (x < a + (c - a) * (y - b) / (d - b))
    return out % 2 == 1


def star(n, seed, cx=0.0, cy=0.0, size=10.0):
    rng = np.random.default_rng(seed)
    at, r = np.sort(rng.uniform(0, 2 * np.pi, n)), size * rng.uniform(0.6, 1.0, n)
    return list(zip((cx + r * np.cos(at)).tolist(), (cy + r * np.sin(at)).tolist(), strict=True))


def wkt(corners):
    return "POLYGON((" + ", ".join(f"{x!r} {y!r}" for x, y in [*corners, corners[0]]) + "))"


@pytest.mark.parametrize("corners, tile", [(2000, 16), (100_000, 256)])
def test_tiles_of_one_large_polygon_with_most_points(spark, monkeypatch, corners, tile):
    monkeypatch.setattr(spatial, "TILE_POINTS", tile)
    monkeypatch.setattr("cairnspark.functions.joins.BROADCAST_BYTES", 0)
    rng = np.random.default_rng(8)
    big, small = star(corners, 3), star(7, 4, 30, 30, 4)
    n = 6000
    x = np.concatenate([rng.normal(0, 4, n), rng.uniform(-40, 40, n // 10), np.full(n // 3, 1.25)])
    y = np.concatenate([rng.normal(0, 4, n), rng.uniform(-40, 40, n // 10), np.full(n // 3, -2.5)])
    points = spark.createDataFrame([("r", str(i), float(a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "region string, point_id string, x double, y double")
    polygons = spark.createDataFrame([("r", "big", wkt(big)), ("r", "small", wkt(small)), ("r", "far", wkt(star(5, 1, 500, 500)))], "region string, polygon_id string, wkt string")
    c = spatial.candidates(polygons, points)
    assert c.sure is not None and c.sure.count() > 0.5 * n and c.others.count() < n
    got = {(r["polygon_id"], int(r["point_id"])) for r in spatial.contains_place(polygons, points).collect()}
    assert got == {(k, int(i)) for k, p in (("big", big), ("small", small)) for i in np.flatnonzero(in_polygon(p, x, y))}


def test_containment_of_a_second_batch_tests_its_own_pairs(spark):
    rng = random.Random(2)
    place = lambda k: ("pl", "unk", f"p{k}", "locatedAt", f'{{"wkt": "POINT({rng.uniform(0, 20)} {rng.uniform(0, 20)})"}}')
    unit = lambda k: ("clu", "unk", f"u{k}", "locatedAt", '{"wkt": "%s"}' % wkt(star(6, k, rng.uniform(0, 20), rng.uniform(0, 20), 3)))
    first = staged(spark, [place(k) for k in range(600)] + [unit(k) for k in range(40)])
    second = staged(spark, [place(k) for k in range(600, 606)] + [unit(40)]).withColumn("batch_id", F.lit("c"))
    graph = promote.empty_graph(spark)
    deltas, _, _ = promote.promote_deltas(graph, first)
    graph = promote.apply(graph, spatial.infer_fresh(promote.apply(graph, deltas), deltas, 3.0))
    deltas, _, _ = promote.promote_deltas(graph, second)
    after = promote.apply(graph, deltas)
    tested = sum(spatial.candidates(*sides, 3.0).others.count() for sides in spatial.fresh_sides(after, deltas))
    whole = spatial.candidates(*spatial._places(after), 3.0).others.count()
    assert 0 < tested < 0.1 * whole
    edges = lambda g: sorted((r["subject_id"], r["object_id"]) for r in g["statements"].filter("predicate = 'containsPlace'").collect())
    added = promote.apply(graph, spatial.infer_fresh(after, deltas, 3.0))
    assert edges(added) == edges(spatial.infer_containment(after, 3.0)) and len(edges(added)) > len(edges(graph))
    assert edges(spatial.infer_containment(added, 3.0)) == edges(added)


def test_aliases_map_at_once_and_keep_what_differs(spark):
    schema = "subject_id string, predicate string, object_value string, object_id string, evidence_id long"
    rows = [("a", "p", "x", None, 1), ("a", "p", "y", None, 1), ("b", "p", "x", None, 1), ("b", "p", "x", None, 2), ("c", "p", "x", "o1", 1), ("c", "p", "x", "o2", 1),
            ("d", "p", "q", None, 1), ("d", "p", "q", None, 1), ("e", "p", "x", None, None), ("e", "p", "y2", None, None)]
    alias = spark.createDataFrame([("p", "x", "y"), ("p", "y2", "y")], "predicate string, alias string, canonical string")
    data = spark.createDataFrame(rows, schema)
    got = sorted((tuple(r) for r in govern.normalise(data, alias).collect()), key=str)
    want = [("a", "p", "y", None, 1), ("b", "p", "y", None, 1), ("b", "p", "y", None, 2), ("c", "p", "y", "o1", 1), ("c", "p", "y", "o2", 1),
            ("d", "p", "q", None, 1), ("d", "p", "q", None, 1), ("e", "p", "y", None, None)]
    assert got == sorted(want, key=str)
    assert {(r["alias"], r["n"]) for r in govern.alias_counts(data, alias).collect()} == {("x", 6), ("y2", 1)}
    chain = spark.createDataFrame([("p", "x", "y"), ("p", "y", "z")], "predicate string, alias string, canonical string")
    assert {(r["object_value"], r["subject_id"]) for r in govern.normalise(data.filter("subject_id = 'a'"), chain).collect()} == {("y", "a"), ("z", "a")}


def test_short_alias_needs_word_edges(spark):
    heads = spark.createDataFrame([("t", "width"), ("t", "id no")], "table string, header string")
    alias = spark.createDataFrame([("hasKey", "id", 0)], "target string, alias string, priority int")
    assert {r["header"]: r["target"] for r in match.suggest(heads, alias).collect()} == {"width": "hasNotes", "id no": "hasKey"}


def test_photo_folder(spark, tmp_path):
    (tmp_path / "gate").mkdir()
    (tmp_path / "gate" / "a.jpg").write_bytes(b"123")
    (tmp_path / "gate" / "b.txt").write_bytes(b"1")
    assert [tuple(r) for r in readers.photo_folder(spark, str(tmp_path)).collect()] == [("img:gate/a.jpg", "gate", "a.jpg", 3)]


def test_joins_by_key_keep_partitions_small(spark, monkeypatch):
    monkeypatch.setattr(joins, "ROWS", 100)
    entities = spark.range(2000).select(F.concat(F.lit("e"), "id").alias("pid"), F.lit("pl").alias("entity_type"), F.concat(F.lit("l"), "id").alias("label"))
    said = spark.range(2000).select(
        F.concat(F.lit("e"), "id").alias("subject_id"), F.lit("p").alias("predicate"), F.when(F.col("id") % 2 == 0, "v").alias("object_value"),
        F.when(F.col("id") % 2 == 1, F.lit("e1")).alias("object_id"), (F.col("id") % 2).alias("evidence_id"))
    rows = spark.createDataFrame([(0, "s0"), (5, "s5")], "evidence_id long, source string")
    made = govern.provenance(said, entities, rows)
    assert {tuple(r) for r in made.collect()} == {(f"e{i}", f"l{i}", "p", "s0") for i in range(0, 2000, 2)} and made.count() == 1000
    assert made.rdd.getNumPartitions() == 10
    assert [tuple(r) for r in ontology.inventory(said, entities).collect()] == [("p", "pl", "pl", True, True, False, 2000, "edge")]
    typed = joins.by_key(said, "subject_id", 2000)
    assert typed.rdd.getNumPartitions() == 20 and max(typed.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 200


def test_heavy_statements_are_made_on_all_cores(spark):
    from cairnspark.plans import sources

    n = spark.sparkContext.defaultParallelism
    assert sources.photo_statements(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == n
    assert sources.layer_statements(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 2 * n


def test_files_are_written_by_tasks(spark, tmp_path):
    files = spark.range(500).select(F.concat(F.lit("p"), F.col("id") % 3, F.lit("/"), F.col("id"), F.lit(".jpg")).alias("name"), F.repeat(F.lit("x"), (F.col("id") + 1).cast("int")).cast("binary").alias("content"))
    for root in (f"file:{tmp_path}/a", f"file://{tmp_path}/b", f"{tmp_path}/c"):
        readers.write_files(files, root)
        got = {r["natural_key"]: r["bytes"] for r in readers.photo_folder(spark, root).collect()}
        assert got == {f"img:p{i % 3}/{i}.jpg": i + 1 for i in range(500)}


def test_encoding_fallback(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("id,name\n1,照片\n".encode("gb18030"))
    assert readers.encoded_csv(spark, str(tmp_path / "x.csv"), "id int, name string").first()["name"] == "照片"
    (tmp_path / "y.csv").write_bytes("id,name\n1,照片\n".encode())
    assert readers.encoded_csv(spark, str(tmp_path / "y.csv"), "id int, name string").first()["name"] == "照片"


@pytest.mark.parametrize("name", ["east", "East", "1a"])
def test_region_rule(spark, name):
    row = staged(spark, ROWS[:1]).withColumn("region", F.lit(name))
    assert (promote.reject(row).first()["error"] is None) == (name == "east")


def test_each_file_is_decoded_over_all_its_bytes(spark, tmp_path):
    late = "id,name\n" + "".join(f"{i},{'x' * 40}\n" for i in range(300)) + "300,照片\n"
    (tmp_path / "a b.csv").write_bytes(late.encode("gb18030"))
    (tmp_path / "c.csv").write_bytes(late.replace("300,", "301,").encode("utf-8"))
    (tmp_path / "d.csv").write_bytes(b"id,name\n")
    rows = readers.encoded_csv(spark, f"{tmp_path}/*.csv", "id int, name string").collect()
    assert len(rows) == 602 and {r["id"]: r["name"] for r in rows if r["id"] >= 300} == {300: "照片", 301: "照片"}
    assert readers.encoded_csv(spark, f"{tmp_path}/a*.csv", "id int, name string").filter("id = 300").first()["name"] == "照片"


def test_mentions_in_any_script(spark):
    words = [("泉州", "Quanzhou", "Place"), ("river bank", "Bank", "Place"), ("über", "Over", "Period"), ("gate", "Gate", "Place"), ("c++", "C", "Event"), ("泉", "Spring", "Place")]
    dictionary = spark.createDataFrame(words, "surface string, canonical string, kind string")
    texts = ["寄往泉州的信", "On the River Bank there", "ÜBER den Fluss", "the gates of", "A Gate.", "driver bank", "in C++ code", "short", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    keys = {r["k"]: r["text"] for r in rows.select("text", F.sha2(F.concat(F.lit("dictionary\n"), "text"), 256).alias("k")).collect()}
    found = {(keys[r["text_key"]], r["surface"]) for r in match.mentions(rows, dictionary).collect()}
    assert found == {(texts[0], "泉州"), (texts[0], "泉"), (texts[1], "river bank"), (texts[2], "über"), (texts[4], "gate"), (texts[6], "c++")}


def test_annotation_cache(spark, tmp_path):
    dictionary = spark.createDataFrame([("gate", "Gate", "Place")], "surface string, canonical string, kind string")
    rows = lambda *t: spark.createDataFrame([(x,) for x in t], "text string")
    cache = str(tmp_path / "cache")
    assert match.annotate_new(rows("a gate", "nothing here"), dictionary, cache).count() == 1
    other = spark.createDataFrame([("gate", "Door", "Place")], "surface string, canonical string, kind string")
    assert {r["canonical"] for r in match.annotate_new(rows("a gate", "one gate"), other, cache).collect()} == {"Gate", "Door"}
    assert spark.read.parquet(cache).count() == 3


def test_failed_texts_are_empty_and_tried_again(spark, tmp_path):
    ready = tmp_path / "ready"

    def annotator(texts):
        if any("bad" in t for t in texts) and not ready.exists():
            raise RuntimeError("no")
        return [[(t[:3], t, "Place")] for t in texts]

    cache = str(tmp_path / "cache")
    rows = spark.createDataFrame([(t,) for t in ["good one", "bad text", "good two", "good one", "x", None]], "text string")
    keyed = rows.filter("length(text) >= 4").select(match.text_key(F.col("text"), "m").alias("text_key"), "text").distinct()
    got = {r["text_key"]: (len(r["mentions"]), r["failed"]) for r in match.annotate(keyed, annotator).collect()}
    assert sorted(got.values()) == [(0, True), (1, False), (1, False)]
    assert {r["canonical"] for r in match.annotate_new(rows, annotator, cache, "m").collect()} == {"good one", "good two"}
    assert spark.read.parquet(cache).count() == 2
    ready.touch()
    assert {r["canonical"] for r in match.annotate_new(rows, annotator, cache, "m").collect()} == {"good one", "good two", "bad text"}
    assert spark.read.parquet(cache).count() == 3


def test_substrings_of_many_patterns_with_one_start(spark, monkeypatch):
    monkeypatch.setattr("cairnspark.functions.joins.BROADCAST_BYTES", 0)
    rng = random.Random(3)
    patterns = [f"the same start {i:04d}x" for i in range(10_000)] + ["a", "ab", "é漢", "𝒳y", "aaa", "(?s)[", ""]
    texts = [f"{rng.choice('ab')} the same start {rng.randint(0, 9999):04d}x the same start {rng.randint(0, 9999):04d}y aaa é漢 (?s)[" for _ in range(200)] + ["𝒳y𝒳", "", "the same start", "b"]
    t = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    found = match.containing(t, "k", "text", spark.createDataFrame([(p,) for p in patterns], "pattern string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {r["k"]: set(r["found"]) for r in found.collect()} == {k: w for k, x in enumerate(texts) if (w := {p for p in patterns if p and p in x})}


def test_inventories_of_regions_merge(spark):
    e = spark.createDataFrame([("a", "pl"), ("b", "ac")], "pid string, entity_type string")
    schema = "subject_id string, predicate string, object_value string, object_id string, geometry string"
    one = ontology.inventory(spark.createDataFrame([("a", "hasName", "x", None, None), ("a", "near", None, "b", None)], schema), e)
    two = ontology.inventory(spark.createDataFrame([("b", "hasName", "y", None, None), ("a", "locatedAt", None, None, "POINT(1 2)")], schema), e)
    got = {r["predicate"]: (r["domain"], r["object_types"], r["category"], r["n"]) for r in ontology.merge_inventories(one, two).collect()}
    assert got == {"hasName": ("ac,pl", "", "attribute", 2), "near": ("pl", "ac", "edge", 1), "locatedAt": ("pl", "", "spatial", 1)}
    assert [r["entity_type"] for r in ontology.geometry_sources(two).collect()] == ["pl"]


def test_large_polygons_go_to_coarser_cells(spark):
    rng = random.Random(6)
    points = [("r", str(i), rng.uniform(-170, 170), rng.uniform(-80, 80)) for i in range(200)]
    s = spark.createDataFrame([("r", "big", "POLYGON((-160 -70, 160 -70, 160 70, -160 70, -160 -70))"), ("r", "tiny", "POLYGON((0 0, 1 0, 1 1, 0 1, 0 0))")], "region string, polygon_id string, wkt string")
    p = spark.createDataFrame([*points, ("r", "in", 0.5, 0.5)], "region string, point_id string, x double, y double")
    for cell in (0.5, None):
        got = {(r["polygon_id"], r["point_id"]) for r in spatial.contains_place(s, p, cell).collect()}
        assert got == {("big", i) for _, i, x, y in points if abs(x) < 160 and abs(y) < 70} | {("big", "in"), ("tiny", "in")} | {("tiny", i) for _, i, x, y in points if 0 < x < 1 and 0 < y < 1}


def test_written_ontology_parses_and_unions_classes(spark, tmp_path):
    e = spark.createDataFrame([("a", "pl"), ("b", "ac"), ("c", "clu")], "pid string, entity_type string")
    schema = "subject_id string, predicate string, object_value string, object_id string, geometry string"
    rows = [("a", "hasName", "x", None, None), ("b", "hasName", "y", None, None), ("c", "hasName", "z", None, None), ("a", "near", None, "b", None), ("a", "near", None, "c", None), ("a", "locatedAt", None, None, "POINT(1 2)")]
    found = ontology.inventory(spark.createDataFrame(rows, schema), e)
    spec = spark.createDataFrame([("hasName", 'a "b" \\ c\nd', 1)], "predicate string, label string, ord int")
    ontology.write_triples(ontology.with_labels(found, spec), str(tmp_path / "o"))
    lines = sorted(r["value"] for r in spark.read.text(str(tmp_path / "o")).collect())
    term = r'(?:<[^<>" ]+>|_:[A-Za-z0-9-]+)'
    assert all(re.fullmatch(rf'{term} <[^<>" ]+> (?:{term}|"(?:[^"\\\n]|\\["\\nrt])*"@[a-z]+) \.', x) for x in lines)
    read = {}
    for x in lines:
        subject, verb, what = x[:-2].split(" ", 2)
        read.setdefault((subject, re.split("[#/]", verb[:-1])[-1]), []).append(what)

    def union(node):
        at, out = read[node, "unionOf"][0], []
        while at.startswith("_:"):
            out += read[at, "first"]
            at = read[at, "rest"][0]
        return out

    assert len(read["<urn:kg:hasName>", "domain"]) == 1
    assert union(read["<urn:kg:hasName>", "domain"][0]) == ["<urn:kg:Actor>", "<urn:kg:CulturalLandscapeUnit>", "<urn:kg:Place>"]
    assert union(read["<urn:kg:near>", "range"][0]) == ["<urn:kg:Actor>", "<urn:kg:CulturalLandscapeUnit>"] and read["<urn:kg:near>", "domain"] == ["<urn:kg:Place>"]
    assert read["<urn:kg:hasName>", "label"] == ['"a \\"b\\" \\\\ c\\nd"@zh'] and ("<urn:kg:near>", "closeMatch") not in read
    assert read["<urn:kg:locatedAt>", "closeMatch"] == ["<http://www.cidoc-crm.org/cidoc-crm/P168_place_is_defined_by>"]


def test_mentions_read_each_text_once(spark):
    """What is left to do looks neither for equal texts nor for grams again."""
    texts = spark.createDataFrame([("By the river",), ("by the River",), ("By the river",)], "text string")
    words = spark.createDataFrame([("river", "River", "Place"), ("by the", "By the", "Place")], "surface string, canonical string, kind string")
    found = match.mentions(texts, words)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan and "regexp_extract_all" not in plan
    assert found.groupBy("surface").count().orderBy("surface").collect() == [("by the", 2), ("river", 2)]


def test_containment_without_polygons_reads_no_point(spark):
    polygons = spark.createDataFrame([], "region string, polygon_id string, wkt string")
    points = spark.range(3).select(F.lit("r").alias("region"), F.col("id").cast("string").alias("point_id"), F.raise_error(F.lit("read")).cast("double").alias("x"), F.lit(1.0).alias("y"))
    assert spatial.contains_place(polygons, points, 1.0).count() == 0
    assert spatial.contains_place(polygons, points).count() == 0


def test_texts_to_annotate_are_told_apart_without_sorting(spark):
    texts = spark.createDataFrame([("by the river",), ("by the river",), ("abc",), (None,)], "text string")
    keyed = match._distinct_texts(texts, "dictionary")
    assert [r["text"] for r in keyed.collect()] == ["by the river"]
    assert "SortAggregate" not in keyed._jdf.queryExecution().toString()


def test_unnamed_evidence_counts_towards_what_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 100)
    entities = spark.range(20).select(F.concat(F.lit("e"), "id").alias("pid"), F.concat(F.lit("l"), "id").alias("label"))
    said = spark.range(20).select(F.concat(F.lit("e"), "id").alias("subject_id"), F.lit("p").alias("predicate"), (F.col("id") % 10).alias("evidence_id"))
    unnamed = spark.range(10).select(F.col("id").alias("evidence_id"), F.lit(None).cast("string").alias("source"))
    made = govern.provenance(said, entities, unnamed)
    assert {tuple(r) for r in made.collect()} == {(f"e{i}", f"l{i}", "p", None) for i in range(20)}
    assert "_dealt" in made._jdf.queryExecution().toString()
