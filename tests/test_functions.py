from pyspark.sql import Row
from pyspark.sql import functions as F

from cairnspark.functions import clean as C
from cairnspark.functions import geo as G


def one(spark, column, **values):
    return spark.createDataFrame([Row(**values)]).select(column.alias("x")).first()["x"]


def test_clean_and_chain(spark):
    assert one(spark, C.clean(F.col("a")), a=" NaN ") is None
    assert one(spark, C.clean(F.col("a")), a=" x ") == "x"
    assert one(spark, C.first_filled(F.col("a"), F.col("b")), a="none", b="town") == "town"


def test_composite_key(spark):
    key = C.composite_key(F.col("a"), F.col("b"), F.col("c"))
    assert one(spark, key, a="x", b="", c="z") == "x||z"
    assert one(spark, key, a="", b="", c="z") == "z"
    assert one(spark, key, a="", b=" ", c="nan") is None


def test_pid_keeps_long_serials(spark):
    p = C.pid(F.lit("east"), F.lit("pl"), F.col("t"), F.col("n"))
    assert one(spark, p, t="", n=12) == "kg:east:pl-unk-0000012"
    assert one(spark, p, t="2024", n=123456789) == "kg:east:pl-2024-123456789"


def test_headers_and_refs(spark):
    assert one(spark, C.normal_header(F.col("h")), h="Name  (P1)  E21 x") == "name x"
    assert [one(spark, C.ref_type_of(F.col("k")), k=k) for k in ("a-CLU-1", "a-pl-1", "zzz")] == ["clu", "pl", "pl"]


def test_values(spark):
    v = F.col("v")
    assert one(spark, C.json_kind(v), v='{"wkt": "POINT(1 2)"}') == "geometry"
    assert one(spark, C.literal_of(v), v='{"iso": "2024-05-01"}') == "2024-05-01"
    assert one(spark, C.confidence_of(v), v='{"value": "a", "confidence": "x"}') is None
    assert one(spark, C.confidence_of(v), v='{"value": "a"}') == 1.0


def test_wkt(spark):
    valid = lambda w: one(spark, G.valid_wkt(F.col("w")), w=w)
    assert valid("POINT (1.5 -2)") and valid("POLYGON((0 0, 1 0, 1 1, 0 0), (0.1 0.1, 0.2 0.1, 0.2 0.2, 0.1 0.1))")
    assert valid("MULTIPOLYGON(((0 0, 1 0, 1 1, 0 0)))") and not valid("POINT(1 )") and not valid("POLYGON((0 0, 1))")


def test_containment_excludes_edges_and_holes(spark):
    w = "POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"
    inside = G.inside(G.edges(G.rings(F.col("w"))), F.col("x"), F.col("y"))
    got = [one(spark, inside, w=w, x=x, y=y) for x, y in ((2.0, 2.0), (5.0, 5.0), (0.0, 5.0), (5.0, 0.0), (10.0, 3.0), (11.0, 5.0), (4.0, 5.0))]
    assert got == [True, False, False, False, False, False, False]
    c = one(spark, G.centroid(G.edges(G.rings(F.col("w")))), w="POLYGON((0 0, 4 0, 4 2, 0 2, 0 0))")
    assert (c["x"], c["y"]) == (2.0, 1.0)


def test_projection(spark):
    x, y = G.utm_to_wgs84(F.lit(500000.0), F.lit(0.0), 44)
    assert abs(one(spark, x, a=1) - 81) < 1e-9 and abs(one(spark, y, a=1)) < 1e-9
    assert one(spark, G.srid_of(F.col("c")), c="EPSG:32644") == 32644
    assert one(spark, G.srid_of(F.col("c")), c="unk") is None


def test_shapes_are_projected_in_place(spark):
    moved = lambda w, srid: one(spark, G.to_wgs84(F.col("w"), F.lit(srid)), w=w)
    assert moved("POINT(1.5 2)", 4326) == "POINT(1.5 2)" and moved("POINT Z (1 2 3)", 4490) == "POINT Z (1 2 3)"
    assert moved("POINT(500000.0 0.0 17)", 32644) == "POINT(81.0 0.0)"
    w = "MULTIPOLYGON(((400000 0, 600000 0, 500000 3000000, 400000 0)), ((500000 0, 500000 1, 500001 0, 500000 0)))"
    got = moved(w, 32644)
    assert got.startswith("MULTIPOLYGON(((") and got.count("((") == 2 and got.endswith("))))"[1:])
    assert one(spark, G.valid_wkt(F.col("w")), w=got)
    lon, lat = G.utm_to_wgs84(F.lit(400000.0), F.lit(3000000.0), 44)
    pair = one(spark, F.concat(lon.cast("string"), F.lit(" "), lat.cast("string")), a=1)
    assert moved("POINT(400000 3000000)", 32644) == f"POINT({pair})"
    assert one(spark, G.known_srid(F.lit(3857)), a=1) is False and one(spark, G.known_srid(F.lit(None).cast("int")), a=1) is True


def test_capture_times(spark):
    seen = lambda t, formats=C.CAPTURE_FORMATS: str(one(spark, C.capture_time(F.col("t"), formats), t=t))
    assert seen("2024/05/01 10:30") == seen(" 2024-05-01 10:30 ") == "2024-05-01 10:30:00"
    assert seen("2024/5/1 9:03:02") == seen("2024-5-1 09:3:2") == "2024-05-01 09:03:02"
    assert seen("2024/5/1") == "2024-05-01 00:00:00" and seen("2024:05:01 09:03:02") == seen("20240501") == "None"
    assert seen("2024:05:01 09:03:02", C.EXIF_FORMATS) == "2024-05-01 09:03:02"


def test_brackets_become_blanks(spark):
    assert [one(spark, C.normal_header(F.col("h")), h=h) for h in ("Time(Span)", "名称（类型）", "E52 Date")] == ["time span", "名称 类型", "date"]


def test_collector_of_metadata(spark):
    who = lambda m: one(spark, C.collector_of(F.col("m")), m=m)
    assert who('{"Recorder": "Ke", "SURVEYOR": "Lin"}') == "Lin" and who('{"Surveyor": " ", "collector": "Wu"}') == "Wu"
    assert who('{"x": "y"}') is None and who("no json") is None
