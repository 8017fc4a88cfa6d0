"""Containment join of polygons and points over adaptive tiles, and the edges that it infers.

A polygon goes to every grid cell of its bounding box, a point to its one cell, so candidates come from an equi-join. A cell
that holds more than TILE_POINTS points is divided into the tiles of a quadtree, by the counts of points alone: a tile
is as large as it can be with at most that many (or a 64th of the cell wide). A tile that no edge of a polygon touches lies inside
or outside as a whole, so its points need no test (full tiles) or no row (empty ones); only points of tiles that
an edge touches are tested.

Outlines do not travel. A polygon's edges are kept in bands of equal height, about BAND_EDGES edges each; a point's
test needs the edges of its own band and no others, as no other edge spans its height. So the largest row is one band, a polygon that
most points meet is as many keys as it has bands, and heavy bands and heavy tiles are dealt out (see functions/joins.py).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnspark.functions import geo as G
from cairnspark.functions.joins import attach
from cairnspark.functions.session import cut
from cairnspark.operators.promote import Graph, keyed, missing, new_evidence

#: A polygon's bounding box is covered by at most about MOST_CELLS cells; a cell has tiles of 2 ** -DEPTH its width at least.
MOST_CELLS, TILE_POINTS, DEPTH, BAND_EDGES = 10_000, 2048, 6, 64


def _band(y: str | Column) -> Column:
    """Band of a height; it rises with the height, so an edge lies in all bands from its low end's to its high end's."""
    y = F.col(y) if isinstance(y, str) else y
    place = F.floor(F.try_divide(y - F.col("low_y"), F.col("high_y") - F.col("low_y")) * F.col("bands"))
    return F.when(F.col("bands") == 1, F.lit(0).cast("long")).otherwise(F.least(F.greatest(place, F.lit(0)), F.col("bands") - 1))


def _outlines(polygons: DataFrame) -> DataFrame:
    """One row for each polygon: its edges, box, and the number of its bands."""
    shaped = polygons.select("region", "polygon_id", G.edges(G.rings(F.col("wkt"))).alias("edges")).filter(F.size("edges") > 0)
    side = lambda f, g, c: f(F.transform("edges", lambda e: g(e[f"{c}1"], e[f"{c}2"])))
    boxed = shaped.select(
        F.monotonically_increasing_id().alias("shape"), "region", "polygon_id", "edges", F.size("edges").alias("n"),
        *[side(f, g, c).alias(f"{n}_{c}") for c in "xy" for n, f, g in (("low", F.array_min, F.least), ("high", F.array_max, F.greatest))])
    # an edge is kept once for each band that it spans: three more times on average at most
    spans = F.aggregate("edges", F.lit(0.0), lambda s, e: s + F.abs(e["y2"] - e["y1"]))
    spans = F.try_divide(spans, F.col("high_y") - F.col("low_y"))
    bands = F.when(F.col("high_y") > F.col("low_y"), F.least(F.ceil(F.col("n") / BAND_EDGES), F.floor(F.try_divide(3.0 * F.col("n"), spans)))).otherwise(1)
    return cut(boxed.withColumn("bands", F.greatest(F.coalesce(bands, F.lit(1)), F.lit(1)).cast("long")))


def _bands(outlines: DataFrame) -> DataFrame:
    """(shape, band, edges) of all bands that hold an edge."""
    many = outlines.filter("bands > 1").select("shape", "bands", "low_y", "high_y", F.explode("edges").alias("e"))
    many = many.select("shape", F.explode(F.sequence(_band(F.least("e.y1", "e.y2")), _band(F.greatest("e.y1", "e.y2")))).alias("band"), "e")
    return outlines.filter("bands = 1").select("shape", F.lit(0).cast("long").alias("band"), "edges").unionByName(
        many.groupBy("shape", "band").agg(F.collect_list("e").alias("edges")))


@dataclass
class Candidates:
    """Pairs of a polygon and a point: sure ones lie in a full tile, others (with their band) need a test against bands."""

    sure: DataFrame | None
    others: DataFrame
    bands: DataFrame


_CELL = ["region", "grade", "cx", "cy"]
_FINE = ["region", "grade", "fx", "fy"]


def candidates(polygons: DataFrame, points: DataFrame, cell: float | None = None) -> Candidates:
    """The pairs that contains_place decides without a test, and those that it tests."""
    outlines = _outlines(polygons)
    if outlines.isEmpty():  # nothing can hold a point, so none is read
        points = points.limit(0)
    boxes = outlines.drop("edges", "n")
    if cell is None:
        cell = boxes.agg(F.avg((F.col("high_x") - F.col("low_x") + F.col("high_y") - F.col("low_y")) / 2)).first()[0] or 1.0
    reach = lambda c: (F.col(f"high_{c}") - F.col(f"low_{c}")) / cell + 1
    over = F.greatest(reach("x") * reach("y") / MOST_CELLS, F.lit(1.0))
    graded = boxes.withColumn("grade", F.ceil(F.log2(over) / 2).cast("int"))
    grades = sorted(r[0] for r in graded.select("grade").distinct().collect())  # a few powers of two
    fine_width = lambda: F.lit(float(cell) / (1 << DEPTH)) * F.pow(F.lit(2.0), F.col("grade"))
    fine = lambda c: F.floor(F.col(c) / fine_width())
    coarse = lambda c: F.shiftright(c, DEPTH)
    cover = graded.withColumn("cx", F.explode(F.sequence(coarse(fine("low_x")), coarse(fine("high_x"))))).withColumn(
        "cy", F.explode(F.sequence(coarse(fine("low_y")), coarse(fine("high_y")))))
    placed = points.select("region", "point_id", "x", "y", F.explode(F.array(*map(F.lit, grades or [0]))).alias("grade"))
    placed = placed.withColumn("fx", fine("x")).withColumn("fy", fine("y")).withColumn("cx", coarse("fx")).withColumn("cy", coarse("fy"))
    # the cells that hold both, and how many points each has
    met = cover.select(*_CELL).distinct()
    dense = cut(placed.groupBy(*_CELL).agg(F.count("*").alias("n_points")).filter(F.col("n_points") > TILE_POINTS).join(met, _CELL, "left_semi").select(*_CELL))
    bands, pair = _bands(outlines), ["region", "polygon_id", "point_id", "shape", "x", "y"]
    if dense.isEmpty():
        return Candidates(None, placed.join(cover, _CELL).select(*pair, _band("y").alias("band")), bands)
    others = placed.join(cover.join(dense, _CELL, "left_anti"), _CELL).select(*pair, _band("y").alias("band"))
    crowded = placed.join(dense, _CELL, "left_semi")
    found = _tiled(crowded, cover.join(dense, _CELL, "left_semi"), bands, fine_width)
    found = cut(found.select(*pair, "full", _band("y").alias("band")))
    return Candidates(found.filter("full").select("region", "polygon_id", "point_id"), others.unionByName(found.filter("NOT full").drop("full")), bands)


def _tiled(crowded: DataFrame, cover: DataFrame, bands: DataFrame, fine_width) -> DataFrame:
    """crowded points beside the polygons of cover whose full tiles or edge tiles they lie in."""
    counts = cut(crowded.groupBy(*_FINE).agg(F.count("*").alias("n")))
    # every fine cell belongs to one tile of each size: the largest that is not too full is its tile
    sized = counts.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(DEPTH - 1)))).withColumn("tx", F.expr("shiftright(fx, s)")).withColumn("ty", F.expr("shiftright(fy, s)"))
    tile = ["region", "grade", "s", "tx", "ty"]
    fits = sized.groupBy(*tile).agg(F.sum("n").alias("n")).filter((F.col("n") <= TILE_POINTS) | (F.col("s") == 0)).select(*tile)
    own = cut(sized.join(fits, tile).groupBy(*_FINE, "n").agg(F.max("s").alias("s")).withColumn("tx", F.expr("shiftright(fx, s)")).withColumn("ty", F.expr("shiftright(fy, s)")))
    coarse = lambda c: F.expr(f"shiftright({c}, {DEPTH} - s)")
    tiles = own.select(*tile).distinct().withColumn("cx", coarse("tx")).withColumn("cy", coarse("ty"))
    width = fine_width() * F.pow(F.lit(2.0), F.col("s"))
    slack = width * 1e-6  # points are put into tiles by a rounded division
    for c in "xy":
        tiles = tiles.withColumn(f"from_{c}", F.col(f"t{c}") * width - slack).withColumn(f"to_{c}", (F.col(f"t{c}") + 1) * width + slack)
    meets = (F.col("from_x") <= F.col("high_x")) & (F.col("to_x") >= F.col("low_x")) & (F.col("from_y") <= F.col("high_y")) & (F.col("to_y") >= F.col("low_y"))
    both = tiles.join(cover, _CELL).filter(meets)
    middle = lambda c: (F.col(f"from_{c}") + F.col(f"to_{c}")) / 2
    spans = both.withColumn("middle", _band(middle("y"))).withColumn("band", F.explode(F.sequence(_band("from_y"), _band("to_y"))))
    touches = F.exists("edges", lambda e: (
        (F.greatest(e["x1"], e["x2"]) >= F.col("from_x")) & (F.least(e["x1"], e["x2"]) <= F.col("to_x"))
        & (F.greatest(e["y1"], e["y2"]) >= F.col("from_y")) & (F.least(e["y1"], e["y2"]) <= F.col("to_y"))))
    inside = (F.col("band") == F.col("middle")) & G.inside(F.col("edges"), middle("x"), middle("y"))
    judged = spans.join(bands, ["shape", "band"], "left").groupBy(*tile, "shape", "polygon_id", "bands", "low_y", "high_y").agg(
        F.bool_or(F.coalesce(touches, F.lit(False))).alias("touched"), F.bool_or(F.coalesce(inside, F.lit(False))).alias("inside"))
    kept = judged.filter("touched OR inside").select(*tile, F.struct("shape", "polygon_id", "bands", "low_y", "high_y", (~F.col("touched")).alias("full")).alias("p"))
    by_tile = kept.groupBy(*tile).agg(F.collect_list("p").alias("p"))
    # one row for each fine cell, which may hold any number of points
    side = cut(own.join(by_tile, tile).select(*_FINE, "p"))
    met = attach(crowded.select(*_FINE, "point_id", "x", "y"), side, _FINE, counts, F.xxhash64("point_id"), "inner")
    return met.select("region", "point_id", "x", "y", F.inline("p"))


def contains_place(polygons: DataFrame, points: DataFrame, cell: float | None = None) -> DataFrame:
    """(region, polygon_id, point_id) of the points strictly inside, once each.

    polygons: region, polygon_id, wkt; points: region, point_id, x, y. Without cell, the width of a grid cell is the mean extent of
    the polygons; a polygon over more than MOST_CELLS cells is put on a coarser grid of its own, to whose cells points go as well.
    """
    c = candidates(polygons, points, cell)
    small = F.size("edges") * 40 + 40
    counts = c.others.groupBy("shape", "band").agg(F.count("*").alias("n"))
    hits = attach(c.others, c.bands, ["shape", "band"], counts, F.xxhash64("point_id"), "inner", small)
    hits = hits.filter(G.inside(F.col("edges"), F.col("x"), F.col("y"))).select("region", "polygon_id", "point_id")
    return (hits if c.sure is None else hits.unionByName(c.sure)).distinct()


def _places(graph: Graph, regions: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(polygons, points) of the graph's units and places, or those of some regions, with the keys of their statements."""
    statements, entities = graph["statements"], graph["entities"]
    if regions is not None:
        statements, entities = (x.filter(F.col("region").isin(*regions)) if regions else x.limit(0) for x in (statements, entities))
    located = statements.filter((F.col("predicate") == "locatedAt") & F.col("geometry").isNotNull()).select(
        "region", F.col("subject_id").alias("pid"), F.col("geometry").alias("wkt"), "key_a", "key_b")
    typed = located.join(entities.select("region", "pid", "entity_type").filter(F.col("entity_type").isin("clu", "pl")), ["region", "pid"])
    shape = G.kind(F.col("wkt"))
    polygons = typed.filter((F.col("entity_type") == "clu") & shape.isin("POLYGON", "MULTIPOLYGON")).select("region", F.col("pid").alias("polygon_id"), "wkt", "key_a", "key_b")
    points = typed.filter((F.col("entity_type") == "pl") & (shape == "POINT")).select(
        "region", F.col("pid").alias("point_id"), G.point_x(F.col("wkt")).alias("x"), G.point_y(F.col("wkt")).alias("y"), "key_a", "key_b")
    return polygons, points


def _edges_of(graph: Graph, inside: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new evidence rows, new containsPlace statements) for pairs inside (region, polygon_id, point_id)."""
    inside = inside.withColumn("source_name", F.concat(F.lit("spatial://"), "region", F.lit("/inference/contains_place")))
    source = inside.select("source_name").distinct().select(
        "source_name", F.lit("spatial_inference").alias("source_type"), F.lit("spatial_within_join").alias("collector"), F.lit(None).cast("string").alias("metadata"))
    evidence, by_name = new_evidence(graph["evidence"], source)
    none = F.lit(None).cast("string")
    # one row for each region, so the side is small; Spark measures it and decides
    edges = inside.join(by_name.withColumnRenamed("source_uri", "source_name"), "source_name").select(
        F.col("polygon_id").alias("subject_id"), F.lit("containsPlace").alias("predicate"), none.alias("object_value"), F.col("point_id").alias("object_id"),
        none.alias("geometry"), none.alias("valid_from"), none.alias("valid_to"), "evidence_id", F.lit(1.0).alias("confidence"),
    )
    old = graph["statements"].filter(F.col("predicate") == "containsPlace")
    return evidence, cut(missing(old, keyed(edges)))


def infer_containment(graph: Graph, cell: float | None = None) -> Graph:
    """graph with a containsPlace edge from each unit to the places of its region inside it; a second run adds nothing.

    Each region's edges have one evidence row spatial://{region}/inference/contains_place.
    """
    polygons, points = _places(graph)
    evidence, edges = _edges_of(graph, cut(contains_place(polygons, points, cell)))
    return {**graph, "evidence": graph["evidence"].unionByName(evidence), "statements": graph["statements"].unionByName(edges)}


def fresh_sides(graph: Graph, deltas: Graph) -> list[tuple[DataFrame, DataFrame]]:
    """The two joins (polygons, points) that find all pairs with a side said by deltas: new polygons with all points, and old polygons with new points.

    graph is the graph after deltas; only the regions of new geometries are read.
    """
    key = ["key_a", "key_b"]
    new = cut(deltas["statements"].filter((F.col("predicate") == "locatedAt") & F.col("geometry").isNotNull()).select("region", *key))
    regions = sorted(r[0] for r in new.select("region").distinct().collect())
    polygons, points = _places(graph, regions)
    new = new.select(*key)
    return [(polygons.join(new, key, "left_semi"), points), (polygons.join(new, key, "left_anti"), points.join(new, key, "left_semi"))]


def infer_fresh(graph: Graph, deltas: Graph, cell: float) -> Graph:
    """deltas with the containsPlace edges that they bring about, where graph (after deltas) has those of all earlier statements."""
    first, second = (contains_place(*sides, cell) for sides in fresh_sides(graph, deltas))
    inside = cut(first.unionByName(second))
    if inside.isEmpty():
        return deltas
    evidence, edges = _edges_of(graph, inside)
    return {**deltas, "evidence": deltas["evidence"].unionByName(evidence), "statements": deltas["statements"].unionByName(edges)}
