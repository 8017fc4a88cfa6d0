"""Ingest of several sources in one run: annotate, stage, promote, infer; and the declared plans of regions."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnspark.operators.match import mentions
from cairnspark.operators.promote import Graph, apply, promote_deltas, reclassify
from cairnspark.operators.spatial import infer_fresh
from cairnspark.sources.connectors import stage

#: Kinds of mentions that become statements, and the predicates whose texts are annotated.
MENTION_KINDS = ("Place", "Person", "Period", "Event")
TEXT_PREDICATES = (
    "hasDescription", "hasTitle", "hasInnerLetter", "hasNotes", "hasEnvironment", "hasSurveyHistory", "hasFullText", "hasAbstract",
)


def mention_statements(rows: DataFrame, dictionary: DataFrame, predicates: tuple[str, ...] = TEXT_PREDICATES) -> DataFrame:
    """mentionsPlace, -Person, -Period and -Event statements of the entities whose long texts name dictionary words.

    Each distinct text is annotated once; the source's metadata gains the extractor's name.
    """
    text = F.get_json_object("stmt_value", "$.value")
    spoken = rows.filter(F.col("predicate").isin(*predicates)).withColumn("text", text).filter(F.col("text").isNotNull())
    found = mentions(spoken.select("text"), dictionary).filter(F.col("kind").isin(*MENTION_KINDS)).withColumnRenamed("kind", "mention")
    said = F.to_json(F.struct("surface", "canonical", F.lit(1.0).alias("confidence")))
    known = F.coalesce(F.from_json("metadata", "map<string,string>"), F.create_map().cast("map<string,string>"))
    joined = spoken.withColumn("text_key", F.sha2(F.concat(F.lit("dictionary\n"), F.col("text")), 256)).join(found, "text_key")
    return joined.withColumns({
        "predicate": F.concat(F.lit("mentions"), "mention"), "stmt_value": said, "valid_from": F.lit(None).cast("string"), "valid_to": F.lit(None).cast("string"),
        "metadata": F.to_json(F.map_concat(F.map_filter(known, lambda k, _: k != "extractor"), F.create_map(F.lit("extractor"), F.lit("dictionary")))),
    }).select(*rows.columns)


def ingest(
    graph: dict[str, DataFrame], sources: list[DataFrame], batch: str, cell: float, dictionary: DataFrame | None = None
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """(new graph, audit row, rejected rows) after all sources' statements are staged, promoted and linked by containment.

    Containment joins only what the batch brings: a graph that this function made has the edges of all before.
    """
    rows = reduce(DataFrame.unionByName, sources)
    if dictionary is not None:
        rows = rows.unionByName(mention_statements(rows, dictionary))
    deltas, audit, rejected = promote_deltas(graph, stage(rows, batch))
    return apply(graph, infer_fresh(apply(graph, deltas), deltas, cell)), audit, rejected


@dataclass(frozen=True)
class Source:
    """A step of a region's plan: reads a table (by its name in the run) into statement rows of the region.

    make takes (table, source, region), as connectors do. A source whose table the run does not have is left out, unless it is needed.
    """

    table: str
    make: Callable[[DataFrame, str, str], DataFrame]
    needed: bool = False


@dataclass(frozen=True)
class RegionPlan:
    """What is ingested for a region, in order, and what is done with it."""

    region: str
    sources: tuple[Source, ...]
    annotate: tuple[str, ...] = TEXT_PREDICATES  # predicates whose texts are annotated, if the run has a dictionary
    contains: bool = True  # whether containment is inferred
    reclassify: Mapping[tuple[str, str], tuple[str, ...]] = field(default_factory=dict)  # (predicate, new type): values

    def rows(self, tables: Mapping[str, DataFrame], dictionary: DataFrame | None) -> DataFrame | None:
        lacking = [s.table for s in self.sources if s.needed and f"{self.region}/{s.table}" not in tables]
        if lacking:
            raise ValueError(f"region {self.region} lacks {', '.join(lacking)}")
        made = [s.make(tables[f"{self.region}/{s.table}"], f"/{self.region}/{s.table}", self.region) for s in self.sources if f"{self.region}/{s.table}" in tables]
        if not made:
            return None
        rows = reduce(DataFrame.unionByName, made)
        if dictionary is not None and self.annotate:
            rows = rows.unionByName(mention_statements(rows, dictionary, self.annotate))
        return rows


def ingest_regions(
    graph: Graph, plans: list[RegionPlan], tables: Mapping[str, DataFrame], run: str, cell: float, dictionary: DataFrame | None = None
) -> tuple[Graph, DataFrame, DataFrame]:
    """(new graph, audit with a row for each region that had a table, rejected rows) of many regions in one promotion.

    tables maps "region/table" to its rows; each region is the batch {run}:{region}. Regions promote together, so a run
    costs as many jobs as one region; containment and reclassification then follow each region's plan.
    """
    made = {p.region: rows for p in plans if (rows := p.rows(tables, dictionary)) is not None}
    if not made:
        raise ValueError("no plan has a table")
    staged = reduce(DataFrame.unionByName, [stage(rows, f"{run}:{region}") for region, rows in made.items()])
    deltas, audit, rejected = promote_deltas(graph, staged, [f"{run}:{r}" for r in made])
    linked = [p.region for p in plans if p.region in made and p.contains]
    if linked:
        said = {**deltas, "statements": deltas["statements"].filter(F.col("region").isin(*linked))}
        said = infer_fresh(apply(graph, deltas), said, cell)
        rest = deltas["statements"].filter(~F.col("region").isin(*linked))
        deltas = {**said, "statements": said["statements"].unionByName(rest)}
    new = apply(graph, deltas)
    for p in plans:
        for (predicate, to), values in p.reclassify.items() if p.region in made else ():
            here = F.col("region") == p.region
            moved = reclassify(new["entities"].filter(here), new["statements"].filter(here), predicate, list(values), to)
            new = {**new, "entities": new["entities"].filter(~here).unionByName(moved)}
    return new, audit.withColumn("region", F.regexp_extract("batch_id", "([^:]+)$", 1)), rejected
