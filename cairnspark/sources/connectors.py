"""Connectors: wide tables to statement rows, one generator over one scan each.

A statement row has source_uri, source_type, metadata (JSON), collector, region, kind, temporal,
natural_key, predicate, stmt_value (JSON), valid_from and valid_to. Every connector takes a
DataFrame, so any reader can feed it, and adds no shuffle. Columns that a table lacks count as
empty; rows without a key give nothing (see without_key). Column names need no quoting.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnspark.functions import clean as C
from cairnspark.functions import geo as G
from cairnspark.operators.connect import first_entities, numbered, spread_ref_names, synthetic_keys

ROW = ("source_uri", "source_type", "metadata", "collector", "region")
STATEMENT = ("kind", "temporal", "natural_key", "predicate", "stmt_value", "valid_from", "valid_to")
MODEST = ("nan",)  # null tokens of all sources but the template

#: Predicates of the letter register's columns.
LETTER_VALUES = {
    "title": "hasTitle", "collectNumber": "hasCollectionNumber", "shownDate": "hasShownDate", "formalDate": "hasFormalDate",
    "replyDate": "hasReplyDate", "currencyType": "hasCurrency", "moneyAmount": "hasAmount", "paidAmount": "hasPaidAmount",
    "convertedAmount": "hasConvertedAmount", "notes": "hasNotes",
}
LETTER_ORIGIN = {"sendCountry": "hasCountry", "sendArea": "hasArea", "sendLocation": "hasLocation"}
LETTER_DESTINATION = {"recvDistrict": "hasDistrict", "recvTown": "hasTown", "recvVillage": "hasVillage"}
LETTER_META = (
    "uploader", "uploadTime", "uploaderMobile", "uploaderEmail", "progress", "office", "letterNumber", "collectLocation",
)
#: Predicates of the survey table's columns.
SURVEY_VALUES = {
    "名称": "hasName", "年代": "hasEra", "区域": "hasPrefecture", "县市": "hasCounty", "数字码": "hasAdminCode", "备注1": "hasSurveyType",
    "环境状况": "hasEnvironment", "简介": "hasDescription", "保存状况": "hasPreservationState", "备注2": "hasSurveyHistory", "参考书目": "hasReference",
}
#: Predicates of the protected points' fields, which differ by layer.
PROTECTED_VALUES = {
    "级别": "hasHeritageLevel", "保护级": "hasHeritageLevel", "公布批": "hasGazettedBatch", "批次": "hasGazettedBatch", "公布日": "hasGazettedDate",
    "公布时": "hasGazettedDate", "时代": "hasEra", "类别": "hasCategoryType", "所属地": "hasPrefecture", "地州": "hasPrefecture",
    "地州_市": "hasPrefecture", "所属县": "hasCounty", "地址": "hasAddress", "文物_1": "hasHeritageCode", "有保护": "hasProtectionFacility",
    "有标志": "hasSignage", "有记录": "hasRecord", "有专门": "hasSpecialUnit", "备注": "hasNote",
}
PROTECTED_KEY = ("级别", "保护级", "所属县", "文物保")
#: Predicates of the polygon units' fields.
UNIT_VALUES = {
    "Recorder": "hasRecorder", "Date": "hasSurveyDate", "Q": "hasQualityFlag", "Note": "hasNote",
    "Shape_Area": "hasShapeArea", "Shape_Length": "hasShapeLength",
}


def cell(rows: DataFrame, name: str, null_tokens: tuple[str, ...] = MODEST) -> Column:
    """The cleaned text of a column, null where the table lacks it."""
    return C.clean(F.col(f"`{name}`"), null_tokens) if name in rows.columns else F.lit(None).cast("string")


def number(rows: DataFrame, name: str) -> Column:
    return cell(rows, name).try_cast("double")


def metadata(fields: dict[str, Column]) -> Column:
    """JSON object of the filled fields."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])) if fields else F.lit("{}")


def value(c: Column) -> Column:
    return F.when(c.isNotNull(), F.to_json(F.struct(c.alias("value"))))


def ref(key: Column, kind: str | Column, region: Column) -> Column:
    made = F.struct(key.alias("ref_natural_key"), (F.lit(kind) if isinstance(kind, str) else kind).alias("ref_type_abbr"), region.alias("ref_region"))
    return F.when(key.isNotNull(), F.to_json(made))


def point(x: Column, y: Column, srid: int | Column, source: str, z: Column | None = None, bounded: bool = True) -> Column:
    """A geometry value; null where a coordinate is missing or, if bounded, outside degrees."""
    fine = x.isNotNull() & y.isNotNull()
    if bounded:
        fine &= x.between(-180, 180) & y.between(-90, 90)
    wkt = F.concat(F.lit("POINT("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")"))
    fields = [wkt.alias("wkt"), (F.lit(srid) if isinstance(srid, int) else srid).alias("srid"), F.lit(source).alias("source")]
    return F.when(fine, F.to_json(F.struct(*fields, *([z.alias("z")] if z is not None else []))))


class Subject:
    """Makes the statement structs of one entity of a row."""

    def __init__(self, kind: str | Column, key: Column, temporal: str | Column = "unk"):
        self.kind, self.temporal = (F.lit(x) if isinstance(x, str) else x for x in (kind, temporal))
        self.key = key

    def says(self, predicate: str, stmt_value: Column, day: Column | None = None) -> Column:
        on = (F.lit(None) if day is None else day).cast("string")
        parts = (self.kind, self.temporal, self.key, F.lit(predicate), stmt_value, on, on)
        return F.struct(*[c.alias(n) for n, c in zip(STATEMENT, parts, strict=True)])


def emit(rows: DataFrame, uri: Column, source_type: str, meta: Column, collector: Column, region: Column, statements: list[Column]) -> DataFrame:
    """One row for each statement whose key and value are filled."""
    said = F.filter(F.array(*statements), lambda s: s["stmt_value"].isNotNull() & s["natural_key"].isNotNull())
    wide = zip(ROW, (uri, F.lit(source_type), meta, collector, region), strict=True)
    return rows.select(*[c.cast("string").alias(n) for n, c in wide], F.inline(said))


def without_key(rows: DataFrame, *names: str) -> DataFrame:
    """Rows that a connector leaves out because one of its key columns is empty."""
    return rows.filter(reduce(lambda a, b: a | b, [cell(rows, n).isNull() for n in names]))


def _uri(source: str, mark: str, *parts: Column) -> Column:
    return F.format_string(f"file://{source.replace('%', '%%')}#{mark}", *parts)


def heritage_points(rows: DataFrame, source: str, region: str, srid: int = 32644) -> DataFrame:
    """Points with name, type, description, layer and survey date; the layer decides place or unit."""
    c = lambda n: cell(rows, n)
    kind = F.when(c("Layer").isin("群体", "区域"), "clu").otherwise("pl")
    place = Subject(kind, F.when(c("OBJECTID").isNotNull(), c("ID")))
    x, y, z = (number(rows, f"POINT_{a}") for a in "XYZ")
    named = {"Name": "hasName", "Type": "hasType", "Describe": "hasDescription", "Layer": "hasLayer", "Date": "hasSurveyDate"}
    said = [place.says(p, value(c(n))) for n, p in named.items()] + [place.says("locatedAt", point(x, y, srid, "points", z, bounded=False))]
    meta = metadata({n: c(n) for n in ("DataSource", "Surveyor", "Recorder", "Literature", "Note")})
    return emit(rows, _uri(source, "OBJECTID=%s", c("OBJECTID")), "csv_row", meta, F.coalesce(c("Surveyor"), c("Recorder")), F.lit(region), said)


def photo_table(rows: DataFrame, source: str, region: str, temporal: str = "2024") -> DataFrame:
    """Photo metadata: file attributes, capture time, position and altitude."""
    c = lambda n: cell(rows, n)
    number_ = c("OBJECTID").try_cast("long")
    photo = Subject("img", F.when(number_.isNotNull(), F.format_string("photo:%05d", number_)), temporal)
    name = F.coalesce(c("FileName"), F.concat(F.lit("unknown_"), number_.cast("string")))
    at, high = C.capture_time(c("CaptureTime")), number(rows, "Altitude")
    iso = F.when(at.isNotNull(), F.to_json(F.struct(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))))
    said = [
        photo.says("hasFileName", value(name)), photo.says("hasFileType", value(c("FileType"))), photo.says("hasFilePath", value(c("SourcePath"))),
        photo.says("hasFileSize", value(c("FileSize"))), photo.says("capturedAt", iso, at.cast("date")),
        photo.says("locatedAt", point(number(rows, "Longitude_D"), number(rows, "Latitude_D"), 4326, "photo_metadata_gps")),
        photo.says("hasAltitude", F.when(high.isNotNull(), F.to_json(F.struct(high.alias("meters"))))),
    ]
    meta = metadata({"objectid": number_, "filename": name, "source_path": c("SourcePath"), "file_size": c("FileSize"), "processing_status": c("ProcessingStatus")})
    return emit(rows, _uri(source, "OBJECTID=%s", number_), "photo_metadata_row", meta, F.lit(None), F.lit(region), said)


def letters(rows: DataFrame, source: str, region: str) -> DataFrame:
    """Letters: a document, up to two persons and up to two places for each row, and the references between them."""
    c = lambda n: cell(rows, n)
    here, number_ = F.lit(region), c("id")
    doc = Subject("doc", F.when(number_.isNotNull(), c("collectNumber")), "modern")
    valid = doc.key.isNotNull()
    only = lambda k: F.when(valid, k)
    inner = F.when(F.length(c("innerLetter")) > 3, c("innerLetter"))
    said = [doc.says(p, value(c(n))) for n, p in LETTER_VALUES.items()] + [doc.says("hasInnerLetter", value(inner))]
    for column, predicate in (("sender", "hasSender"), ("recver", "hasRecipient")):
        person = Subject("ac", only(c(column)), "modern")
        said += [person.says("hasName", value(c(column))), doc.says(predicate, ref(c(column), "ac", here))]
    origin = F.coalesce(*[c(n) for n in ("sendLocation", "sendArea", "sendCountry")])
    target = F.coalesce(*[c(n) for n in ("recvTown_std", "recvTown", "recvVillage", "recvDistrict", "recvLocation")])
    for name, predicate, parts in ((origin, "hasOriginPlace", LETTER_ORIGIN), (target, "hasDestinationPlace", LETTER_DESTINATION)):
        place = Subject("pl", only(name))
        said += [place.says("hasName", value(name)), doc.says(predicate, ref(name, "pl", here))]
        said += [place.says(p, value(C.if_different(c(n), name))) for n, p in parts.items()]
    # positions of this source are shifted by its map service; the source field says so
    said.append(Subject("pl", only(target)).says("locatedAt", point(number(rows, "lon"), number(rows, "lat"), 4326, "gaode_geocoded")))
    return emit(rows, _uri(source, "id=%s", number_), "xlsx_row", metadata({n: c(n) for n in LETTER_META}), c("uploader"), here, said)


def survey_sites(rows: DataFrame, source: str, region: str) -> DataFrame:
    """Survey rows: a place with its address (the detailed column first) and the mapped columns."""
    c = lambda n: cell(rows, n)
    place = Subject("pl", c("site_id"))
    said = [place.says("hasAddress", value(F.coalesce(c("地址及位置"), c("位置"))))] + [place.says(p, value(c(n))) for n, p in SURVEY_VALUES.items()]
    meta = metadata({n: c(n) for n in ("id", "序号", "序号_无重复", "数字码")})
    return emit(rows, _uri(source, "site_id=%s", c("site_id")), "xlsx_row", meta, F.lit(None), F.lit(region), said)


def vector_layer(
    rows: DataFrame, source: str, region: str, kind: str, keys: list[str], order: str, layer: str = "", name_column: str | None = None,
    type_column: str | None = None, extra: dict[str, str] | None = None, temporal: str = "unk", srid: int = 4326, wkt: str = "wkt", separator: str = "|",
) -> DataFrame:
    """Features of a table with a WKT column: name, type, geometry and further columns; several keys are joined.

    order names the column with the row number that the source URI shows.
    """
    c = lambda n: cell(rows, n)
    if not keys:
        raise ValueError("a layer needs a key column")
    key = c(keys[0]) if len(keys) == 1 else C.composite_key(*[c(k) for k in keys], separator=separator)
    thing = Subject(kind, key, temporal)
    shape = F.when(c(wkt).isNotNull(), F.to_json(F.struct(c(wkt).alias("wkt"), F.lit(srid).alias("srid"), F.lit("vector_feature").alias("source"))))
    said = [thing.says(p, value(c(n))) for n, p in ((name_column, "hasName"), (type_column, "hasType")) if n]
    said += [thing.says("locatedAt", shape)] + [thing.says(p, value(c(n))) for n, p in (extra or {}).items() if n in rows.columns]
    meta = metadata({n: c(n) for n in rows.columns if n not in (wkt, order)})
    return emit(rows, _uri(source, f"layer={layer.replace('%', '%%')}&row=%s", c(order)), "vector_feature", meta, F.lit(None), F.lit(region), said)


def protected_layers(layers: dict[str, DataFrame], source: str, region: str, order: str) -> DataFrame:
    """Protected points of several layers whose field names differ, as one set of statements."""
    one = lambda name, rows: vector_layer(
        rows, source, region, "pl", list(PROTECTED_KEY), order, name, "文物保", "类别", PROTECTED_VALUES)
    return reduce(DataFrame.unionByName, [one(n, r) for n, r in layers.items()])


def place_keys(points: DataFrame, folders: DataFrame) -> DataFrame:
    """(natural_key, from_folder_only): keys of the point table and of photo folders (column place) that it lacks."""
    known = points.select(cell(points, "ID").alias("natural_key")).filter("natural_key IS NOT NULL").distinct()
    found = folders.select(F.col("place").alias("natural_key")).distinct().join(known, "natural_key", "left_anti")
    return known.withColumn("from_folder_only", F.lit(False)).unionByName(found.withColumn("from_folder_only", F.lit(True)))


def photo_files(files: DataFrame, source: str, region: str) -> DataFrame:
    """Photos of a folder scan: file name and place, and what camera fields were read.

    files: natural_key, place, file and, where known, taken (yyyy:MM:dd HH:mm:ss), make, model and the
    arrays lat and lon of degrees, minutes, seconds with lat_ref and lon_ref.
    """
    c = lambda n: cell(files, n)
    photo = Subject("img", c("natural_key"))
    at = F.try_to_timestamp(c("taken"), F.lit("yyyy:MM:dd HH:mm:ss"))

    def degrees(n: str) -> Column:
        if n not in files.columns:
            return F.lit(None).cast("double")
        return C.dms_to_decimal(F.get(F.col(n), 0), F.get(F.col(n), 1), F.get(F.col(n), 2), c(f"{n}_ref"))

    camera = F.to_json(F.struct(c("make").alias("make"), c("model").alias("model")))
    said = [
        photo.says("hasFileName", value(c("file"))), photo.says("depicts", ref(c("place"), "pl", F.lit(region))),
        photo.says("capturedAt", F.when(at.isNotNull(), F.to_json(F.struct(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("iso")))), at.cast("date")),
        photo.says("capturedBy", F.when(F.coalesce(c("make"), c("model")).isNotNull(), camera)),
        photo.says("locatedAt", point(degrees("lon"), degrees("lat"), 4326, "exif_gps")),
    ]
    return emit(files, _uri(source, "%s", c("natural_key")), "photo_file", F.lit("{}"), F.lit(None), F.lit(region), said)


def template_sheet(
    rows: DataFrame, spec: list[tuple[str, str | None, str]], source: str, sheet: str, region: str, order: str,
    kind: str = "pl", example_key: str | None = None, prefix: str | None = None, max_entities: int | None = None, critical: list[str] | None = None,
) -> DataFrame:
    """Statements of a sheet by its columns' roles; spec holds (column, predicate, role).

    The example row and rows whose critical cells (without critical, all cells) are all empty are left out. Sheets without
    a key column number their rows (prefix-0001). max_entities ends the sheet with the row in which the last of so many keys
    first appears. The spec becomes expressions, so no join is needed.
    """
    with_role = lambda *roles: [(n, p) for n, p, r in spec if r in roles and n in rows.columns]
    keyed = with_role("NATURAL_KEY")
    if not keyed:
        if prefix is None:
            raise ValueError("a sheet without key column needs a prefix")
        counts = [n for n, _, _ in spec if n in rows.columns and (critical is None or n in critical)]
        filled = F.coalesce(*[cell(rows, n, ("nan", "none")) for n in counts], F.lit(None).cast("string"))
        rows = synthetic_keys(rows.filter(filled.isNotNull()).withColumn("_sheet", F.lit(sheet)), "_sheet", order, prefix).drop("_sheet")
        keyed = [("natural_key", None)]
    c = lambda n: cell(rows, n, ("nan", "none"))
    key = c(keyed[0][0])
    rows = rows.filter(key.isNotNull() & ~key.eqNullSafe(F.lit(example_key)))
    if max_entities is not None:
        rows = first_entities(rows, key, order, max_entities)
    first = lambda role, default: F.coalesce(*[c(n) for n, _ in with_role(role)], default)
    here = first("REGION", F.lit(region))
    era = [c(n) for n, p, _ in spec if p == "hasEra" and n in rows.columns]
    thing = Subject(first("ENTITY_TYPE", F.lit(kind)), key, F.coalesce(*era, F.lit("unk")))
    sure = first("CONFIDENCE", F.lit(None).cast("string")).try_cast("double")
    # the confidence of a row is part of each of its values; to_json leaves it out where it is null
    value_ = lambda x: F.when(x.isNotNull(), F.to_json(F.struct(x.alias("value"), sure.alias("confidence"))))

    def ref_(k: Column, t: Column) -> Column:
        made = F.struct(k.alias("ref_natural_key"), t.alias("ref_type_abbr"), here.alias("ref_region"), sure.alias("confidence"))
        return F.when(k.isNotNull(), F.to_json(made))

    said = [thing.says(p, value_(c(n))) for n, p in with_role("VALUE", "ASSET_PATH")]
    for role, t in (("REF_PL", "pl"), ("REF_AC", "ac"), ("REF_DOC", "doc"), ("REF_ANY", None)):
        said += [thing.says(p, ref_(c(n), F.lit(t) if t else C.ref_type_of(c(n)))) for n, p in with_role(role)]
    x, y = (first(r, F.lit(None).cast("string")).try_cast("double") for r in ("LON", "LAT"))
    crs = first("CRS", F.lit(None).cast("string"))
    shifted = F.when(crs.isin("GCJ-02", "BD-09"), crs)
    wkt = F.concat(F.lit("POINT("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")"))
    fields = F.struct(
        wkt.alias("wkt"), G.srid_of(crs).alias("srid"), F.lit("template").alias("source"), F.coalesce(crs, F.lit("unspecified")).alias("source_crs"),
        shifted.alias("needs_conversion"), sure.alias("confidence"),
    )
    fine = x.between(-180, 180) & y.between(-90, 90) & G.srid_of(crs).isNotNull()
    said.append(thing.says("locatedAt", F.when(fine, F.to_json(fields))))
    meta = metadata({"sheet": F.lit(sheet), "row": c(order), **{n: c(n) for n, _ in with_role("META", "SOURCE_NAME", "STATUS", "ACTOR_ROLE")}})
    uri = _uri(source, f"{sheet.replace('%', '%%')}&row=%s", c(order))
    return emit(rows, uri, "template_row", meta, first("META", F.lit(None).cast("string")), here, said).withColumn(
        "source_type", F.coalesce(F.get_json_object("metadata", "$.source_type"), F.col("source_type")))


def template_workbook(
    sheets: dict[str, DataFrame], specs: dict[str, dict], source: str, region: str, order: str, max_entities: int | None = None
) -> DataFrame:
    """Statements of all sheets of a workbook that specs knows, in one run; other sheets are skipped.

    specs maps a sheet's name to columns (column, predicate, role) and, where they differ from template_sheet's
    defaults, kind, example_key and prefix. Sheet names count without the blanks around them.
    """
    known = [(n.strip(), rows) for n, rows in sheets.items() if n.strip() in specs]
    if not known:
        raise ValueError("no sheet of the workbook is known")
    made = []
    for name, rows in known:
        spec = specs[name]
        more = {k: spec[k] for k in ("kind", "example_key", "prefix") if k in spec}
        made.append(template_sheet(rows, spec["columns"], source, name, region, order, max_entities=max_entities, **more))
    return reduce(DataFrame.unionByName, made)


def common_region(sheet: DataFrame, region: str, order: str, default: str | None) -> str | None:
    """The most common region of a sheet, on ties the one that comes first; default where none is filled."""
    named = sheet.select(cell(sheet, region).alias("region"), F.col(order).alias("at")).filter("region IS NOT NULL")
    top = named.groupBy("region").agg(F.count("*").alias("n"), F.min("at").alias("first")).orderBy(F.desc("n"), "first").first()
    return top["region"] if top else default


def mapped_table(rows: DataFrame, spec: dict, source: str, order: str) -> DataFrame:
    """Statements by a mapping spec (region, source_type, subject, columns by position); order names the row number.

    kind value gives a literal, kind ref a reference {ref_prefix}-{cell}; each referenced entity gets
    one hasName, the last of its cells in row order. Columns are counted without the order column.
    """
    names = [n for n in rows.columns if n != order]
    c = lambda n: cell(rows, n, ("nan", "none"))
    subject, here = spec["subject"], F.lit(spec["region"])
    cut_at = subject["natural_key"]
    filled = rows.filter(F.coalesce(*[c(n) for n in names]).isNotNull())
    if "column" in cut_at:
        keyed, key = filled, c(names[cut_at["column"]])
    else:
        keyed = synthetic_keys(filled.withColumn("_sheet", F.lit(1)), "_sheet", order, cut_at["synthetic_prefix"])
        key = F.col("natural_key")
    thing, said, refs = Subject(subject["entity_type"], key), [], []
    for i, column in spec["columns"].items():
        if int(i) >= len(names):
            continue
        v = c(names[int(i)])
        if column.get("kind") == "value":
            said.append(thing.says(column["target"], value(v)))
        elif column.get("kind") == "ref":
            k, t = F.concat(F.lit(column["ref_prefix"] + "-"), v), column.get("ref_type", "pl")
            said.append(thing.says(column["target"], ref(k, t, here)))
            refs.append(F.struct(k.alias("k"), F.lit(t).alias("t"), v.alias("v"), F.lit(int(i)).alias("i")))
    uri = _uri(source, f"{spec.get('sheet', '')}&row=%s", c(order))
    out = emit(keyed, uri, spec.get("source_type", "table_row"), F.lit('{"spec":true}'), F.lit(None), here, said)
    if not refs:
        return out
    found = keyed.filter(key.isNotNull()).select(F.col(order).alias("_at"), F.inline(F.filter(F.array(*refs), lambda r: r["k"].isNotNull())))
    last = spread_ref_names(found, F.col("k"), F.col("t"), F.col("v"), F.struct("_at", "i"))
    named = Subject(F.col("ref_type"), F.col("natural_key"))
    curated = F.lit(f"curation://{spec['region']}/generic/entity")
    return out.unionByName(emit(last, curated, "entity_resolution", F.lit("{}"), F.lit(None), here, [named.says("hasName", value(F.col("label")))]))


def stage(statements: DataFrame, batch: str) -> DataFrame:
    """Statement rows with batch id and gapless row numbers by source, kind, key, predicate and value, as promote takes them."""
    return stage_batches(statements.withColumn("batch_id", F.lit(batch)))


def stage_batches(statements: DataFrame) -> DataFrame:
    """stage for statement rows of several batches, which their column batch_id tells apart; each is numbered from 1."""
    return numbered(statements, ["source_uri", "kind", "natural_key", "predicate", "stmt_value"], ["batch_id"])
