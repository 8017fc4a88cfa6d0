import json

import pytest
from pyspark.sql import functions as F

from cairnspark.operators import connect, ingest, match, promote, spatial
from cairnspark.sources import connectors, readers, sheets


def said(frame):
    return sorted((r["kind"], r["natural_key"], r["predicate"], r["stmt_value"]) for r in frame.collect())


def test_points_without_key_or_columns(spark):
    rows = spark.createDataFrame([("1", "a", "Gate", "群体"), ("2", " nan ", "Wall", None), (None, "c", "Tower", None)], "OBJECTID string, ID string, Name string, Layer string")
    got = said(connectors.heritage_points(rows, "/x 100%.csv", "east"))
    assert [(k, n, p) for k, n, p, _ in got] == [("clu", "a", "hasLayer"), ("clu", "a", "hasName")]
    assert {r["Name"] for r in connectors.without_key(rows, "ID", "OBJECTID").collect()} == {"Wall", "Tower"}
    assert connectors.heritage_points(rows.limit(0), "/x", "east").count() == 0
    assert connectors.heritage_points(rows, "/x 100%.csv", "east").first()["source_uri"] == "file:///x 100%.csv#OBJECTID=1"


def test_letter_without_number_says_nothing(spark):
    rows = spark.createDataFrame([(None, "Q1", "Lin"), ("2", "", "Ke"), ("3", "Q3", "Wu")], "id string, collectNumber string, sender string")
    assert {(k, n) for k, n, _, _ in said(connectors.letters(rows, "/l", "east"))} == {("doc", "Q3"), ("ac", "Wu")}


def test_layer_needs_a_key_and_skips_absent_fields(spark):
    rows = spark.createDataFrame([(1, "a", None, "POINT(1 2)"), (2, None, None, None)], "row int, k1 string, k2 string, wkt string")
    got = said(connectors.vector_layer(rows, "/v", "east", "pl", ["k1", "k2"], "row", extra={"absent": "hasNote"}))
    assert [(n, p) for _, n, p, _ in got] == [("a", "locatedAt")]
    with pytest.raises(ValueError, match="key"):
        connectors.vector_layer(rows, "/v", "east", "pl", [], "row")


def test_sheet_numbers_rows_without_key_column(spark):
    rows = spark.createDataFrame([(1, "x", "1"), (2, None, "none"), (3, "y", "2")], "row int, name string, lon string")
    spec = [("name", "hasName", "VALUE"), ("lon", None, "LON"), ("lat", None, "LAT")]
    got = said(connectors.template_sheet(rows, spec, "/t", "S", "east", "row", kind="ev", prefix="e"))
    assert [(k, n, json.loads(v)["value"]) for k, n, _, v in got] == [("ev", "e-0001", "x"), ("ev", "e-0002", "y")]


def test_spec_with_key_column_and_last_name_wins(spark):
    rows = spark.createDataFrame([(1, "k1", "A"), (2, "k2", "A"), (3, None, "B")], "row int, a string, b string")
    spec = {"region": "east", "subject": {"entity_type": "doc", "natural_key": {"column": 0}}, "columns": {"1": {"kind": "ref", "target": "seenIn", "ref_prefix": "p"}}}
    got = said(connectors.mapped_table(rows, spec, "/s", "row"))
    assert [(k, n, p) for k, n, p, _ in got] == [("doc", "k1", "seenIn"), ("doc", "k2", "seenIn"), ("pl", "p-A", "hasName")]


def test_aliases_from_json_skip_notes(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"_doc": "note", "hasType": {"a": "b", "_x": "y"}, "hasName": {}, "_more": {"p": {"q": 1}}}))
    assert [tuple(r) for r in readers.alias_dictionary(spark, str(tmp_path / "d.json")).collect()] == [("hasType", "a", "b")]


def test_mentions_become_statements(spark):
    rows = connectors.survey_sites(spark.createDataFrame([("s1", "the old gate"), ("s2", "the old gate"), ("s3", "abc")], "site_id string, `简介` string"), "/s", "east")
    words = spark.createDataFrame([("gate", "Gate", "Place"), ("old", "Old", "Other"), ("abc", "Abc", "Person")], "surface string, canonical string, kind string")
    got = ingest.mention_statements(rows, words)
    assert [(n, p) for _, n, p, _ in said(got)] == [("s1", "mentionsPlace"), ("s2", "mentionsPlace")]  # texts under four characters are not read
    assert json.loads(got.first()["metadata"]) == {"extractor": "dictionary"}


def test_ingest_projects_links_and_repeats_nothing(spark):
    unit = spark.createDataFrame([(1, "u", "POLYGON((400000 0, 600000 0, 600000 200000, 400000 200000, 400000 0))")], "row int, ID string, wkt string")
    points = spark.createDataFrame([("1", "in", "500000", "1000"), ("2", "out", "700000", "1000"), ("3", "edgeless", None, "1")], "OBJECTID string, ID string, POINT_X string, POINT_Y string")
    sources = [connectors.vector_layer(unit, "/v", "east", "clu", ["ID"], "row", srid=32644), connectors.heritage_points(points, "/p", "east")]
    graph, audit, rejected = ingest.ingest(promote.empty_graph(spark), sources, "b", 1.0)
    assert audit.first()["status"] == "success" and rejected.count() == 0
    edge = graph["statements"].filter("predicate = 'containsPlace'").collect()
    names = {r["pid"]: r["natural_key"] for r in graph["registry"].collect()}
    assert [(names[e["subject_id"]], names[e["object_id"]]) for e in edge] == [("u", "in")]
    again = spatial.infer_containment(graph, 1.0)
    assert again["statements"].count() == graph["statements"].count() and again["evidence"].count() == graph["evidence"].count()
    bad = sources[0].withColumn("stmt_value", F.regexp_replace("stmt_value", "32644", "3857"))
    assert [r["error"] for r in promote.reject(connectors.stage(bad, "b")).collect()] == ["unknown_srid"]


def test_columns_without_cells_become_notes(spark):
    cells = spark.createDataFrame([("t", "a", 1, None), ("t", "b", 1, " "), ("t", "关系", 1, "x"), ("t", "lat", 1, "12"), ("t", "lat", 2, "x")], "table string, header string, ord int, value string")
    aliases = spark.createDataFrame([], "target string, alias string, priority int")
    made = match.suggest_mapping(cells, aliases, ("pl",))
    assert {r["header"]: r["target"] for r in made.collect()} == {"a": "hasNotes", "b": "hasNotes", "关系": None, "lat": "hasNotes"}
    assert tuple(match.summary(made).first()) == ("t", 0, 3, 1)


#: The example rows of four sheets.
EXAMPLES = {
    "Place_地点": [
        "张三", "2026-06-01", "mustang", "pl", "mustang-pl-lomanthang", "洛满堂", "庙宇", "古建筑", "19c", "单体", "", "83.9567", "29.1845", "WGS84", "实测GPS", "甘达基省", "木斯塘县", "",
        "Lo Manthang", "古城北侧", "三层夯土建筑，保存完好。", "2024-05-18", "Mustang2024_field#012", "field_survey", "1.0", "/Volumes/clkg_data/mustang/photos/mustang-pl-lomanthang/", "需复查屋顶年代"],
    "Document_文档": [
        "李四", "2026-06-01", "qiaopi", "doc", "Q12345", "陈妙清寄潮安家书", "信札(侨批)", "陈妙清", "zh", "潮汕侨批馆", "Q12345", "1929-XX-XX", "民国18年", "父亲大人膝下敬禀者……", "寄银百元并报平安",
        "qiaopi-pl-chaoan", "qiaopi-ac-chenmiaoqing", "《潮汕侨批集成》第3辑", "馆藏，研究用途", "Q12345 / 潮汕侨批馆", "archive", "0.9", "待验证", "/Volumes/clkg_data/qiaopi/scans/Q12345.jpg", "字迹部分模糊",
        "qiaopi-ac-chenmiaoqing", "qiaopi-ac-chenmu", "qiaopi-pl-saigon", "qiaopi-pl-chaoan", "", "墨西哥银元", "100", "98", "550"],
    "Actor_人物": ["李四", "2026-06-01", "qiaopi", "ac", "qiaopi-ac-chenmiaoqing", "陈妙清", "person", "潮安籍南洋华侨，1920s 寄批人。", "Q12345", "archive", "0.9", ""],
    "Asset_资产": [
        "张三", "2026-06-01", "mustang", "img", "IMG_1234", "IMG_1234.jpg", "/Volumes/clkg_data/mustang/photos/mustang-pl-lomanthang/IMG_1234.jpg", "JPEG", "mustang-pl-lomanthang", "2024-05-18T14:30", "83.9567",
        "29.1845", "WGS84", "3840", "相机原片", "image_file", "正立面"],
}


def sheet_rows(spark, name, rows):
    headers = [c.header for c in sheets.sheets()[name].columns]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows, 2)], "row int, " + ", ".join(f"`{h}` string" for h in headers))


def test_example_rows_are_told_by_their_keys(spark):
    book = {n: sheet_rows(spark, n, [r]) for n, r in EXAMPLES.items()}
    assert sheets.read_workbook(book, "/b", "row", region="mustang").count() == 0
    whole = sheets.read_workbook(book, "/b", "row", region="mustang", skip_example=False)
    assert whole.count() == 51
    with pytest.raises(ValueError, match="region"):
        sheets.read_workbook(book, "/b", "row")


def test_workbook_of_six_entities(spark):
    """Three places, an actor, a letter and a photo: 58 statements, 25 predicates, 6 sources, 3 references to 2 known entities and 1 unknown."""
    def row(name, **cells):
        known = {c.label: c.header for c in sheets.sheets()[name].columns}
        given = {known[k]: v for k, v in cells.items()}
        return [given.get(c.header) for c in sheets.sheets()[name].columns]

    base = {"记录人": "Lin", "采集日期": "2026-06-01", "region": "test", "来源": "book", "来源类型": "literature"}
    place = {"名称": "n", "类型": "t", "遗产类别": "c", "年代": "qing", "层级": "单体", "保护级别": "省级", "经度": "83.5", "纬度": "29.1", "坐标系": "WGS84", "坐标来源": "gps", "省州": "p", "县区": "x", "乡镇": "v", "地址": "a", "描述": "d", "备注": "m"}
    book = {
        "Place_地点": sheet_rows(spark, "Place_地点", [
            row("Place_地点", **base, **place, entity_type="pl", natural_key="p1", 可信度="0.9"), row("Place_地点", **base, **place, natural_key="p2"), row("Place_地点", **base, **place, entity_type="clu", natural_key="p3")]),
        "Actor_人物": sheet_rows(spark, "Actor_人物", [row("Actor_人物", **base, 姓名="Chen", 角色类型="person", 说明="who", 备注="b", natural_key="a1")]),
        "Document_文档": sheet_rows(spark, "Document_文档", [row("Document_文档", **base, 标题="t", 文献类型="档案", 作者创建者="w", 备注="b", 关联地点="test-pl-unknown", 关联人物="a1", natural_key="d1")]),
        "Asset_资产": sheet_rows(spark, "Asset_资产", [row("Asset_资产", **base, 文件名="i.jpg", 路径="/i", 类型="JPEG", 拍摄时间="2026", 备注="b", 关联实体="p1", natural_key="i1")]),
    }
    said = sheets.read_workbook(book, "/b", "row")
    graph, audit, rejected = promote.promote(promote.empty_graph(spark), connectors.stage(said, "b"))
    assert rejected.count() == 0 and audit.first()["rows_inserted"] == said.count() == 58
    assert graph["entities"].count() == 7 and graph["entities"].filter("stub").count() == 1 and graph["evidence"].count() == 6
    statements = graph["statements"]
    assert statements.select("predicate").distinct().count() == 25
    assert statements.filter("object_id IS NOT NULL").count() == 3 and statements.filter("geometry IS NOT NULL").count() == 3
    assert {(r["entity_type"], r["count"]) for r in graph["entities"].groupBy("entity_type").count().collect()} == {("pl", 3), ("clu", 1), ("ac", 1), ("doc", 1), ("img", 1)}
    assert statements.filter("confidence < 1").count() == 14


def test_registry_of_sheets(spark):
    table = sheets.registry(spark)
    assert {r["sheet"]: r["count"] for r in table.groupBy("sheet").count().collect()} == dict(zip(sheets.sheets(), (27, 34, 12, 17, 12, 16, 20), strict=True))
    assert {r["label"] for r in sheets.labels(table).filter("predicate = 'hasCoordinateSource'").collect()} == {"坐标来源"}
    heads = spark.createDataFrame([("t", "资产路径"), ("t", "hasName_名称*"), ("t", "经度")], "table string, header string")
    assert {r["header"]: r["target"] for r in match.suggest(heads, sheets.alias_index(table)).collect()} == {"资产路径": "hasAssetPath", "hasName_名称*": "hasName", "经度": "LON"}


def test_rows_end_with_the_last_allowed_entity(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "c"), (6, "a"), (7, "d")], "row int, k string")
    at = lambda n: [r["row"] for r in connect.first_entities(rows, F.col("k"), "row", n).orderBy("row").collect()]
    assert at(2) == [1, 2] and at(3) == [1, 2, 3, 4, 5] and at(9) == list(range(1, 8))


def test_regions_by_their_plans(spark):
    points = spark.createDataFrame([("1", "in", "83", "28", "单体"), ("2", "out", "99", "28", "区域")], "OBJECTID string, ID string, POINT_X string, POINT_Y string, Layer string")
    unit = spark.createDataFrame([(1, "u", "POLYGON((82 27, 84 27, 84 29, 82 29, 82 27))")], "row int, ID string, wkt string")
    heritage = ingest.Source("points", lambda rows, source, region: connectors.heritage_points(rows, source, region, srid=4326), needed=True)
    units = ingest.Source("units", lambda rows, source, region: connectors.vector_layer(rows, source, region, "clu", ["ID"], "row"))
    plans = [ingest.RegionPlan("east", (heritage, units)), ingest.RegionPlan("west", (heritage, units), contains=False), ingest.RegionPlan("south", (units,))]
    tables = {"east/points": points, "east/units": unit, "west/points": points, "west/units": unit}
    graph, audit, _ = ingest.ingest_regions(promote.empty_graph(spark), plans, tables, "r", 1.0)
    assert {(r["region"], r["batch_id"], r["rows_in"], r["rows_inserted"]) for r in audit.collect()} == {("east", "r:east", 5, 5), ("west", "r:west", 5, 5)}
    edges = graph["statements"].filter("predicate = 'containsPlace'").collect()
    assert [e["region"] for e in edges] == ["east"]
    with pytest.raises(ValueError, match="points"):
        ingest.ingest_regions(graph, plans[:1], {"east/units": unit}, "r", 1.0)
