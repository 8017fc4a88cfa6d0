"""The sheets of the collection template as one registry, and what follows from it.

The registry drives the reading of workbooks, the index of column aliases, labels and vocabularies. A sheet is a table with its
header as column names and a column that says each row's number.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.functions.clean import clean
from cairnspark.sources import connectors

#: The sheets, each with its entity types (the first is the default), what tells its example row and, where it has no
#: column for them, its region and the prefix of its keys; then its columns in order: header, role, and predicate
#: where that is not the header's part before "_". A column with * is required; > names its vocabulary.
SHEETS = """
[Place_地点] types=pl,clu example=mustang-pl-lomanthang
记录人* META
采集日期* META
region* REGION >region
entity_type* ENTITY_TYPE >entity_type
natural_key* NATURAL_KEY
hasName_名称* VALUE
hasType_类型 VALUE
hasCategoryType_遗产类别 VALUE
hasEra_年代 VALUE
hasLayer_层级 VALUE >layer
hasHeritageLevel_保护级别 VALUE >heritage_lv
lon_经度 LON
lat_纬度 LAT
CRS_坐标系 CRS >CRS
坐标来源 VALUE hasCoordinateSource
hasPrefecture_省州 VALUE
hasCounty_县区 VALUE
hasTown_乡镇 VALUE
hasVillage_村 VALUE
hasAddress_地址 VALUE
hasDescription_描述 VALUE
hasSurveyDate_调查日期 VALUE
source_name_来源* SOURCE_NAME
source_type_来源类型* SOURCE_TYPE >source_type
confidence_可信度 CONFIDENCE >confidence
asset_path_关联资产 ASSET_PATH hasAssetPath
hasNotes_备注 VALUE
[Document_文档] types=doc example=Q12345
记录人* META
采集日期* META
region* REGION >region
entity_type* ENTITY_TYPE >entity_type
natural_key* NATURAL_KEY
hasTitle_标题* VALUE
hasDocType_文献类型 VALUE >doc_type
hasAuthor_作者创建者 VALUE
hasLanguage_语言 VALUE >lang
hasHoldingInstitution_收藏机构 VALUE
hasCollectionNumber_馆藏号 VALUE
hasFormalDate_标准化日期 VALUE
hasShownDate_原件题署日期 VALUE
hasFullText_全文转写 VALUE
hasAbstract_内容摘要 VALUE
relatedPlace_关联地点 REF_PL
relatedActor_关联人物 REF_AC
hasReference_著录参考 VALUE
hasRights_版权许可 VALUE
source_name_来源* SOURCE_NAME
source_type_来源类型* SOURCE_TYPE >source_type
confidence_可信度 CONFIDENCE >confidence
状态 VALUE hasStatus >doc_status
asset_path_资产路径 ASSET_PATH hasAssetPath
hasNotes_备注 VALUE
hasSender_寄件人(侨批) REF_AC
hasRecipient_收件人(侨批) REF_AC
hasOriginPlace_寄出地(侨批) REF_PL
hasDestinationPlace_寄达地(侨批) REF_PL
hasReplyDate_回批日期(侨批) VALUE
hasCurrency_币种(侨批) VALUE
hasAmount_金额(侨批) VALUE
hasPaidAmount_实付(侨批) VALUE
hasConvertedAmount_折算(侨批) VALUE
[Actor_人物] types=ac example=qiaopi-ac-chenmiaoqing
记录人* META
采集日期* META
region* REGION >region
entity_type* ENTITY_TYPE >entity_type
natural_key* NATURAL_KEY
hasName_姓名* VALUE
角色类型 VALUE hasRole >actor_role
hasDescription_说明 VALUE
source_name_来源* SOURCE_NAME
source_type_来源类型* SOURCE_TYPE >source_type
confidence_可信度 CONFIDENCE >confidence
hasNotes_备注 VALUE
[Asset_资产] types=img example=IMG_1234
记录人* META
采集日期* META
region* REGION >region
entity_type* ENTITY_TYPE >entity_type
natural_key* NATURAL_KEY
hasFileName_文件名* VALUE
hasFilePath_路径* VALUE
hasFileType_类型 VALUE
depicts_关联实体 REF_ANY
capturedAt_拍摄时间 VALUE
lon_经度 LON
lat_纬度 LAT
CRS_坐标系 CRS >CRS
hasAltitude_海拔 VALUE
source_name_来源* SOURCE_NAME
source_type_来源类型* SOURCE_TYPE >source_type
hasNotes_备注 VALUE
[军垦_事件] types=ev region=xinjiang prefix=junken-evt
时代_历史时期 VALUE hasEra required
时间_具体年份 VALUE hasShownDate
发起人 VALUE hasInitiator
承受人 VALUE hasBeneficiary
事件描述 VALUE hasDescription required
地点 VALUE hasAddress
物 VALUE hasObject
文化价值 VALUE hasCulturalValue
屯垦制度 VALUE hasInstitution
source_name_来源 SOURCE_NAME required
著录人 META required
出处 VALUE hasReference
[军垦_口述史] types=ev region=xinjiang prefix=junken-oral
章 VALUE hasChapter
节 VALUE hasSection
小节 VALUE hasSubsection
口述者 VALUE hasSpeaker required
口述者身份 VALUE hasSpeakerRole
采访人 VALUE hasInterviewer
时间 VALUE hasShownDate
时代 VALUE hasEra required
地点 VALUE hasAddress
人物 VALUE hasParticipantName
物品 VALUE hasObject
概念 VALUE hasConcept
触发词 VALUE hasTrigger
行动主体 VALUE hasAgent
事件类型 VALUE hasEventType
事件描述 VALUE hasDescription required
[军垦_诗歌] types=doc example=poem-001
记录人* META
采集日期* META
region* REGION >region
entity_type* ENTITY_TYPE >entity_type
natural_key* NATURAL_KEY
hasTitle_题名* VALUE
hasAuthor_作者 VALUE
hasEra_时代 VALUE
hasFullText_正文 VALUE
hasAbstract_例证 VALUE
hasPlace_地名 VALUE mentionsPlace
lon_经度 LON
lat_纬度 LAT
CRS_坐标系 CRS >CRS
hasReference_出处 VALUE
hasEmotion_情感极性 VALUE
hasEmotionScore_极性得分 VALUE
hasEmotionType_情绪类别 VALUE
hasIdentity_身份 VALUE
hasNotes_备注 VALUE
"""

#: The roles whose columns make statements under a predicate.
SPEAKING = ("VALUE", "ASSET_PATH", "REF_PL", "REF_AC", "REF_DOC", "REF_ANY")
#: Rows that are looked at for a workbook's region.
REGION_ROWS = 50


@dataclass(frozen=True)
class SheetColumn:
    header: str
    role: str
    predicate: str | None
    required: bool
    vocabulary: str | None

    @property
    def label(self) -> str:
        """The header without its predicate and marks."""
        bare = self.header.rstrip("*")
        last = bare.rsplit("_", 1)[-1]
        return bare if last.isascii() else last


@dataclass(frozen=True)
class Sheet:
    name: str
    columns: tuple[SheetColumn, ...]
    types: tuple[str, ...]
    example: str | None = None
    region: str | None = None
    prefix: str | None = None

    def with_role(self, *roles: str) -> list[SheetColumn]:
        return [c for c in self.columns if c.role in roles]

    @property
    def critical(self) -> list[str]:
        """Headers of the cells of which one at least is filled in a row that counts."""
        return [c.header for c in self.columns if c.role == "NATURAL_KEY" or (c.required and c.role in ("VALUE", "ENTITY_TYPE"))]


def _column(line: str) -> SheetColumn:
    header, role, *rest = line.split(" ")
    vocabulary = next((x[1:] for x in rest if x.startswith(">")), None)
    said = next((x for x in rest if not x.startswith(">") and x != "required"), None)
    predicate = (said or header.rstrip("*").split("_", 1)[0]) if role in SPEAKING else None
    return SheetColumn(header, role, predicate, header.endswith("*") or "required" in rest, vocabulary)


def sheets(text: str = SHEETS) -> dict[str, Sheet]:
    """The sheets of a registry written like SHEETS, by name."""
    out = {}
    for block in text.strip().split("["):
        if block:
            head, *lines = block.strip().split("\n")
            name, said = head.split("] ", 1)
            fields = dict(x.split("=", 1) for x in said.split(" "))
            fields["types"] = tuple(fields["types"].split(","))
            out[name] = Sheet(name, tuple(map(_column, lines)), **fields)
    return out


def registry(spark: SparkSession, known: dict[str, Sheet] | None = None) -> DataFrame:
    """The registry as a table: a row for each column of each sheet, with the sheet's defaults."""
    rows = [
        (s.name, i, c.header, c.label, c.role, c.predicate, c.required, c.vocabulary, list(s.types), s.types[0], s.region, s.prefix, s.example)
        for s in (known or sheets()).values() for i, c in enumerate(s.columns, 1)]
    return spark.createDataFrame(rows, (
        "sheet string, position int, header string, label string, role string, predicate string, required boolean, vocabulary string, types array<string>, "
        "default_type string, default_region string, key_prefix string, example_key string"))


def alias_index(columns: DataFrame) -> DataFrame:
    """(target, alias, priority) for operators.match.suggest: predicates by header, label and their own name, roles by header; earlier columns first."""
    target = F.coalesce("predicate", "role")
    order = F.col("position")
    names = F.array(F.col("header"), F.col("label"), F.col("predicate"), F.split_part("header", F.lit("_"), F.lit(1)))
    said = columns.select(target.alias("target"), order.alias("priority"), F.explode(names).alias("alias"))
    said = said.withColumn("alias", F.rtrim(F.col("alias"), F.lit("*"))).filter(F.length("alias") > 0)
    return said.groupBy("target", "alias").agg(F.min("priority").alias("priority"))


def labels(columns: DataFrame) -> DataFrame:
    """(predicate, label): the first label of each predicate, by sheet and position."""
    return columns.filter(F.col("predicate").isNotNull()).groupBy("predicate").agg(F.min_by("label", F.struct("sheet", "position")).alias("label"))


def region_of_sheet(given: DataFrame, known: Sheet, order: str) -> str | None:
    """The most common region of the first REGION_ROWS rows, without example rows; of equals the first. The sheet's own where it has no such column."""
    named = known.with_role("REGION")
    if not named:
        return known.region
    first = given.orderBy(F.col(f"`{order}`")).limit(REGION_ROWS + 1)
    keyed = known.with_role("NATURAL_KEY")
    if keyed and known.example and keyed[0].header in given.columns:
        first = first.filter(~clean(F.col(f"`{keyed[0].header}`")).eqNullSafe(F.lit(known.example)))
    return connectors.common_region(first, named[0].header, order, None)


def read_workbook(
    given: dict[str, DataFrame], source: str, order: str, region: str | None = None, max_entities: int | None = None, skip_example: bool = True,
    known: dict[str, Sheet] | None = None,
) -> DataFrame:
    """Statements of all sheets of a workbook that the registry knows; other sheets are skipped, names count without blanks around them.

    Without region, that of the first sheet that tells one is used for all.
    """
    known = known or sheets()
    found = [(known[n.strip()], rows) for n, rows in sorted(given.items(), key=lambda x: list(known).index(x[0].strip()) if x[0].strip() in known else -1) if n.strip() in known]
    if not found:
        raise ValueError("no sheet of the workbook is known")
    region = region or next((r for s, rows in found if (r := region_of_sheet(rows, s, order))), None)
    if region is None:
        raise ValueError("no sheet of the workbook tells a region")
    made = [
        connectors.template_sheet(
            rows, [(c.header, c.predicate, c.role) for c in s.columns if c.role != "REGION"], source, s.name, region, order, kind=s.types[0],
            example_key=s.example if skip_example else None, prefix=s.prefix, max_entities=max_entities, critical=s.critical)
        for s, rows in found]
    return reduce(DataFrame.unionByName, made)
