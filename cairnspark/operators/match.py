"""Substring joins by rare q-grams, column-mapping suggestions from headers, and annotation of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnspark.functions.clean import normal_header
from cairnspark.functions.joins import attach
from cairnspark.functions.session import cut, read_or_empty

MIN_COVER = 0.34
#: Patterns are sought by pieces of so many characters; shorter ones by all they have.
GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """All runs of size characters, by a look ahead, which takes time linear in the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=({'.' * size}))"), F.lit(1))


def containing(texts: DataFrame, key: str, text: str, patterns: DataFrame, pattern: str = "pattern") -> DataFrame:
    """(key, text, found): the texts that contain a pattern, once each, with all the patterns that they contain.

    texts has one row for each key. Each pattern waits under the one of its q-grams that the fewest texts hold (one that some gram
    of it is in no text is dropped), so many patterns with a common start do not meet every text that has it. The join is by
    equality, on distinct grams; a gram that many texts hold is dealt out. Only keys and patterns move until each text is
    compared with its own candidates.
    """
    wanted = patterns.select(F.col(pattern).alias("_p")).filter(F.length("_p") > 0).distinct()
    sizes = sorted(r[0] for r in wanted.select(F.least(F.length("_p"), F.lit(GRAM)).alias("n")).distinct().collect())
    of_size = lambda c, n: F.when(F.least(F.length("_p"), F.lit(GRAM)) == n, _grams(F.col(c), n))
    own = wanted.select("_p", F.explode(F.array_distinct(F.coalesce(*[of_size("_p", n) for n in sizes], F.array().cast("array<string>")))).alias("_gram"))
    own = cut(own)
    none = F.array().cast("array<string>")
    held = texts.select(key, F.explode(F.array_distinct(F.concat(none, *[_grams(F.col(text), n) for n in sizes]))).alias("_gram"))
    known = own.select("_gram").distinct()
    held = cut(held.join(known, "_gram", "left_semi"))  # texts are cut into grams once
    counts = cut(held.groupBy("_gram").agg(F.count("*").alias("n")))
    rarest = own.join(counts, "_gram", "left").groupBy("_p").agg(F.min_by("_gram", F.struct("n", "_gram")).alias("_gram"), F.count_if(F.col("n").isNull()).alias("_absent"))
    waiting = cut(rarest.filter("_absent = 0").groupBy("_gram").agg(F.collect_list("_p").alias("_ps")))
    size = F.aggregate("_ps", F.lit(64), lambda n, p: n + F.octet_length(p) + 32)
    met = attach(held, waiting, ["_gram"], counts.join(waiting.select("_gram"), "_gram", "left_semi"), F.xxhash64(key), "inner", size)
    mine = met.select(key, F.explode("_ps").alias("_p")).groupBy(key).agg(F.collect_set("_p").alias("_ps"))
    found = F.filter("_ps", lambda p: F.contains(F.col(text), p))
    return texts.select(key, text).join(mine, key).select(key, text, found.alias("found")).filter(F.size("found") > 0)


def suggest(headers: DataFrame, aliases: DataFrame) -> DataFrame:
    """The best alias of each (table, header): highest cover, then longest alias; score 0.2 as a note where none fits.

    aliases: target, alias, priority; of equal aliases the smallest priority counts. Latin
    aliases of at most three letters must stand between word edges.
    """
    first = aliases.withColumn("alias", normal_header(F.col("alias"))).groupBy("alias").agg(F.min_by("target", "priority").alias("target"))
    named = headers.select("table", "header", normal_header(F.col("header")).alias("h"))
    short = F.col("alias").rlike("^[a-z]{1,3}$")
    at_edges = F.concat(F.lit(" "), F.regexp_replace("h", "[^a-z0-9]+", " "), F.lit(" ")).contains(F.concat(F.lit(" "), F.col("alias"), F.lit(" ")))
    shown = named.select("h").filter(F.length("h") > 0).distinct().withColumn("shown", F.col("h"))
    fits = containing(shown, "h", "shown", first, "alias").select("h", F.explode("found").alias("alias")).filter(~short | at_edges).join(first, "alias")
    cover = F.length("alias") / F.length("h")
    best = fits.withColumn("cover", cover).filter(F.col("cover") >= MIN_COVER).groupBy("h").agg(
        F.max_by(F.struct("target", "cover"), F.struct("cover", F.length("alias"), "alias")).alias("b")
    )
    # least ignores nulls, so headers without an alias are left out first
    score = F.when(F.col("b").isNotNull(), F.round(F.least(F.lit(0.99), 0.5 + F.col("b.cover") / 2), 2))
    return named.join(best, "h", "left").select(
        "table", "header", F.coalesce("b.target", F.lit("hasNotes")).alias("target"), F.coalesce(score, F.lit(0.2)).alias("score")
    )


#: Fixed value: headers that name a relation, not data.
RELATION = r"关系|consists|took\s*place|carried\s*out|has\s*type|has\s*time|\bP\d+\b|包含|发生在|执行者|有类型|有时间|有执行"
#: Cells that are dates, and the scores of the rules below.
DATED, SCORES = r"\d{3,4}\s*年|\d{4}-\d", {"relation": 0.9, "type": 0.8, "lon": 0.6, "lat": 0.45, "date": 0.55, "none": 0.2}
SAMPLES = 20


def suggest_mapping(cells: DataFrame, aliases: DataFrame, entity_types: tuple[str, ...]) -> DataFrame:
    """(table, header, target, kind, score) for every column of many tables in one job.

    cells: table, header, ord, value. In order: a relation header, an alias (see suggest), then by
    the first SAMPLES filled cells: all entity types, longitudes, latitudes, dates; else a note.
    """
    order = F.row_number().over(Window.partitionBy("table", "header").orderBy(F.col("value").isNull() | (F.col("value") == ""), "ord"))
    first = cells.select("table", "header", "value", order.alias("r")).filter(F.col("r") <= SAMPLES).withColumn(
        "v", F.when(F.trim("value") != "", F.trim("value"))).withColumn("x", F.col("v").try_cast("double"))
    dated = F.count_if(F.col("v").rlike(DATED))
    profile = first.groupBy("table", "header").agg(
        F.count("v").alias("n"), F.count("x").alias("numbers"), F.min("x").alias("low"), F.max("x").alias("high"),
        F.bool_and(F.col("v").isin(*entity_types)).alias("typed"), dated.alias("dates"),
    )
    named = suggest(profile.select("table", "header"), aliases).withColumnRenamed("target", "by_alias").withColumnRenamed("score", "alias_score")
    joined = profile.join(named, ["table", "header"])
    some, numeric = F.col("n") > 0, F.col("numbers") * 10 >= F.col("n") * 7
    wide = F.col("low").between(-180, 180) & F.col("high").between(-180, 180)
    rules = [
        (F.col("header").rlike(RELATION), (None, "relation_meta", SCORES["relation"])),
        (F.col("alias_score") > 0.2, (F.col("by_alias"), "predicate", F.col("alias_score"))),
        (some & F.col("typed"), ("ENTITY_TYPE", "role", SCORES["type"])),
        (some & numeric & wide & ((F.col("low") < -90) | (F.col("high") > 90)), ("LON", "role", SCORES["lon"])),
        (some & numeric & F.col("low").between(-90, 90) & F.col("high").between(-90, 90), ("LAT", "role", SCORES["lat"])),
        (some & (F.col("dates") * 10 >= F.col("n") * 6), ("hasShownDate", "predicate", SCORES["date"])),
        (F.lit(True), ("hasNotes", "predicate", SCORES["none"])),
    ]
    column = lambda x: x if isinstance(x, Column) else F.lit(x)
    said = [F.when(F.coalesce(when, F.lit(False)), F.struct(
        column(t).cast("string").alias("target"), column(k).alias("kind"), column(s).cast("double").alias("score"))) for when, (t, k, s) in rules]
    return joined.select("table", "header", F.coalesce(*said).alias("s")).select("table", "header", "s.*")


def summary(suggested: DataFrame) -> DataFrame:
    """Suggestions of each table: sure (score 0.5 or more), unsure and skipped."""
    skipped = F.col("kind") == "relation_meta"
    sure = ~skipped & (F.col("score") >= 0.5)
    return suggested.groupBy("table").agg(
        F.count_if(sure).alias("sure"), F.count_if(~skipped & ~sure).alias("unsure"), F.count_if(skipped).alias("skipped"))


def _surfaces(low: Column) -> Column:
    """The words of a lower-case text (runs of letters and digits of any script)."""
    return F.array_distinct(F.split(low, r"[^\p{L}\p{M}\p{N}]+"))


#: A surface that is one word of an alphabet: such words are looked up, others are sought in the text.
ONE_WORD = r"^[\p{L}\p{M}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]]+$"


def text_key(text: Column, model: str) -> Column:
    """Identity of a text as a model reads it."""
    return F.sha2(F.concat(F.lit(f"{model}\n"), text), 256)


def _distinct_texts(texts: DataFrame, model: str) -> DataFrame:
    """(text_key, text) of the texts of four characters at least, once each."""
    # told apart by themselves, for which Spark hashes and sorts nothing; keys are then made of few
    return texts.filter(F.length("text") >= 4).select("text").distinct().select(text_key(F.col("text"), model).alias("text_key"), "text")


def mentions(texts: DataFrame, dictionary: DataFrame, seen: DataFrame | None = None, model: str = "dictionary") -> DataFrame:
    """(text_key, surface, canonical, kind) of dictionary surfaces in texts; each distinct text is annotated once.

    texts: text; dictionary: surface, canonical, kind; seen: text_key already annotated (see annotate_new). A key is the
    hash of the model's name and the text. A surface that is one word of an alphabet must be a whole word of the
    text, so it is an equi-join; one of several words, or of a script that sets no blanks, may stand anywhere and is
    sought by its rarest characters (see containing). Letter case does not count.
    """
    keyed = _distinct_texts(texts, model)
    if seen is not None:
        keyed = keyed.join(seen, "text_key", "left_anti")
    return _mentioned(_lowered(keyed), dictionary)


def _lowered(keyed: DataFrame) -> DataFrame:
    """(text_key, low) as a table, so that texts are told apart once."""
    return cut(keyed.select("text_key", F.lower("text").alias("low")))


def _mentioned(low: DataFrame, dictionary: DataFrame) -> DataFrame:
    """mentions of distinct texts in lower case (text_key, low)."""
    named = dictionary.withColumn("surface", F.lower("surface")).filter(F.length("surface") > 0)
    single = named.filter(F.col("surface").rlike(ONE_WORD))
    words = low.select("text_key", F.explode(_surfaces(F.col("low"))).alias("surface"))
    found = words.join(single, "surface").select("text_key", "surface", "canonical", "kind")

    anywhere = named.filter(~F.col("surface").rlike(ONE_WORD))
    if anywhere.isEmpty():
        return found
    # where a surface begins or ends with a letter of an alphabet, it must begin or end a word there
    border = lambda c, look: F.when(c.rlike(ONE_WORD), look + r"[\p{L}\p{M}\p{N}])").otherwise("")
    quoted = lambda s: F.concat(F.lit(r"\Q"), F.replace(s, F.lit(r"\E"), F.lit("")), F.lit(r"\E"))
    pattern = lambda s: F.concat(border(F.substring(s, 1, 1), "(?<!"), quoted(s), border(F.right(s, F.lit(1)), "(?!"))
    held = containing(low, "text_key", "low", anywhere, "surface").select("text_key", F.filter("found", lambda s: F.rlike(F.col("low"), pattern(s))).alias("found"))
    hits = held.select("text_key", F.explode("found").alias("surface")).join(anywhere, "surface")
    return found.unionByName(hits.select("text_key", "surface", "canonical", "kind"))


#: Takes a batch of distinct texts and gives, for each, its mentions as (surface, canonical, kind). It may raise.
Annotator = Callable[[list[str]], list[list[tuple[str, str, str]]]]
_MENTIONS = "array<struct<surface: string, canonical: string, kind: string>>"


def annotate(texts: DataFrame, annotator: Annotator, batch: int = 64) -> DataFrame:
    """(text_key, mentions, failed) of texts (text_key, text) by an annotator of one's own, which runs in the tasks.

    It is called with at most batch texts. Where such a call fails, its texts are tried one by one; a text that fails
    alone has failed set and no mentions, and the others are as if it were not there.
    """

    def alone(text: str) -> tuple[list, bool]:
        try:
            return list(annotator([text])[0]), False
        except Exception:  # whatever a model raises concerns its text only
            return [], True

    def together(part: list[str]) -> list[tuple[list, bool]]:
        try:
            found = annotator(part)
            if len(found) == len(part):
                return [(list(x), False) for x in found]
        except Exception:
            pass
        return [alone(t) for t in part]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                got = together(part["text"].tolist())
                yield pd.DataFrame({
                    "text_key": part["text_key"].tolist(), "mentions": [[dict(zip(("surface", "canonical", "kind"), m, strict=True)) for m in x] for x, _ in got],
                    "failed": [f for _, f in got]})

    return texts.select("text_key", "text").mapInPandas(run, f"text_key string, mentions {_MENTIONS}, failed boolean")


def annotate_new(texts: DataFrame, by: DataFrame | Annotator, cache: str, model: str = "dictionary") -> DataFrame:
    """All mentions in texts, of which those that the cache table at this path holds are not sought again.

    by: a dictionary (see mentions) or an annotator (see annotate). The cache holds one row for each annotated text (text_key, mentions);
    new ones are appended, those without mentions too, but not those that an annotator failed on, which the next run tries again.
    """
    spark = texts.sparkSession
    schema = f"text_key string, mentions {_MENTIONS}"
    keys = _distinct_texts(texts, model)
    known = read_or_empty(spark, cache, schema)
    new = keys.join(known.select("text_key"), "text_key", "left_anti")
    if callable(by):
        made = annotate(new, by).filter("NOT failed").select("text_key", "mentions")
    else:
        new = _lowered(new)
        found = _mentioned(new, by)
        found = found.groupBy("text_key").agg(F.collect_set(F.struct("surface", "canonical", "kind")).alias("mentions"))
        made = new.select("text_key").join(found, "text_key", "left").select("text_key", F.coalesce("mentions", F.array().cast(_MENTIONS)).alias("mentions"))
    cut(made).write.mode("append").parquet(cache)
    return spark.read.schema(schema).parquet(cache).join(keys.select("text_key"), "text_key", "left_semi").select("text_key", F.inline("mentions"))
