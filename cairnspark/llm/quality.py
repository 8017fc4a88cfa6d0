"""Quality rules by weak supervision (native DataFrame functions only).

Each rule reads a few counts of a text and votes good (1) or bad (-1), or abstains (0) between the two.
Expectation-maximisation over the counts of vote patterns estimates how often each rule casts
each vote on good and on bad documents; a document is kept if its posterior probability of being
good reaches a threshold and no base rule fails. Rates are free but for a weak Dirichlet prior
(PRIOR_GOOD, PRIOR_BAD: pseudo-counts of one document for each vote), so a vote weighs what the
data say: a rule that fires alone on otherwise good documents is outvoted, and a document without
any bad vote goes if its abstentions are those of bad ones. Documents that fail a base rule go
anyway and take no part in the estimate.

Only vote patterns, at most 3 ** len(RULES) however large the input, reach the driver. The rounds start
from START (log-odds of the prior, of a good and of a bad vote), which names the classes: most
documents are good, and bad votes are rare and weigh more. Windows of words are compared by 64-bit hash.
Edge cases: null or blank text: no words, all counts 0, base_failed; an empty table
gives an empty result; rows repeat as given; clashing column names: counts are computed
from the text column only and returned beside the key, other columns are not touched. Where no
document passes the base rules, none is kept. In tables of a few hundred documents the
estimate may settle on another division of them.
"""

from __future__ import annotations

import math

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm.common import SPACE, let, shared_folder, table, words_of

WINDOW = 8


def _covered(hashes: Column) -> Column:
    """Words that lie in windows whose hash occurs twice or more, from the windows' hashes in order."""

    def count(by_hash: Column) -> Column:
        same = lambda e, j: F.coalesce(F.get(by_hash, j)["h"] == e["h"], F.lit(False))
        repeated = F.filter(by_hash, lambda e, j: same(e, j - 1) | same(e, j + 1))
        starts = F.array_sort(F.transform(repeated, lambda e: e["i"]))
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"],
        )

    return let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), count)


def _repeat_words(words: Column) -> Column:
    windows = F.when(
        F.size(words) >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h)))


def counts(text: Column) -> Column:
    """Struct of the counts that the rules read, from one text."""

    def of(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
        return let(
            F.struct(words_of(t).alias("w"), lines.alias("l")),
            lambda x: F.struct(
                F.size(x["w"]).cast("long").alias("n_words"),
                F.length(F.array_join(x["w"], "")).cast("long").alias("word_chars"),
                F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                (F.size(x["l"]) - F.size(F.array_distinct(x["l"]))).cast("long").alias("n_dup_lines"),
                let(x["w"], _repeat_words).cast("long").alias("n_repeat_words"),
                F.size(x["l"]).cast("long").alias("n_lines"),
                F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
                F.regexp_count(t, F.lit(r"\p{Nd}")).cast("long").alias("n_digits"),
                F.regexp_count(t, F.lit("[.!?]")).cast("long").alias("n_stops"),
                F.regexp_count(t, F.lit("!")).cast("long").alias("n_bangs"),
                F.size(F.array_distinct(x["w"])).cast("long").alias("n_distinct"),
                F.regexp_count(t, F.lit(r"[^\p{L}\p{N}\s]{2,}")).cast("long").alias("n_mark_runs"),
                F.regexp_count(t, F.lit(rf"(?<![^{SPACE}])[^\p{{L}}\p{{N}}{SPACE}]+(?![^{SPACE}])")).cast("long").alias("n_wordless"),
            ),
        )

    return let(F.coalesce(text, F.lit("")), of)


RULES = ("word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "bangs", "length", "sentences", "variety", "mark_runs", "wordless")
#: Pseudo-counts of the votes bad, abstain and good in either class, and where the rounds start.
PRIOR_GOOD, PRIOR_BAD = (1.0, 1.0, 1.0), (1.0, 1.0, 1.0)
START = {"prior": 1.0, "good": 0.25, "bad": -2.0}


def _rules(c: Column) -> dict[str, tuple[Column, Column]]:
    """For each rule the conditions under which it votes bad and good."""
    words, chars, lines = (F.greatest(c[n], F.lit(1)) for n in ("n_words", "word_chars", "n_lines"))
    rare = lambda n, of, good, bad: (c[n] * bad > of, c[n] * good <= of)  # noqa: E731  one in good, one in bad
    return {
        "word_length": ((chars * 2 < words * 5) | (chars > words * 12), (chars * 2 >= words * 7) & (chars <= words * 8)),
        "symbols": rare("n_symbols", words, 50, 10),
        "dup_lines": (c["n_dup_lines"] * 10 > lines * 3, c["n_dup_lines"] * 10 <= lines),
        "repeats": rare("n_repeat_words", words, 20, 5),
        "upper": (c["n_upper"] * 5 > chars, c["n_upper"] * 100 <= chars * 8),
        "digits": rare("n_digits", chars, 20, 5),
        "bangs": rare("n_bangs", words, 50, 10),
        "length": (c["n_words"] < 15, c["n_words"] >= 50),
        "sentences": ((c["n_stops"] * 100 < words) | (c["n_stops"] * 2 > words), (c["n_stops"] * 40 >= words) & (c["n_stops"] * 4 <= words)),
        "variety": (c["n_distinct"] * 10 < words, c["n_distinct"] * 4 >= words),
        "mark_runs": rare("n_mark_runs", words, 50, 10),
        "wordless": rare("n_wordless", words, 20, 5),
    }


def votes(c: Column) -> Column:
    """Struct of the rules' votes (-1, 0 or 1) from the struct of counts."""
    rules = _rules(c)
    return F.struct(*[F.when(rules[n][0], -1).when(rules[n][1], 1).otherwise(0).cast("tinyint").alias(n) for n in RULES])


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 300, rest: float = 1e-9) -> dict:
    """Log-odds of the prior and of each rule's three votes, by expectation-maximisation over vote patterns.

    patterns: vote tuples with their counts. The rounds end when no posterior moves by more than rest.
    """
    n, total = len(RULES), sum(k for _, k in patterns)
    model = {"prior": START["prior"], "weights": [{-1: START["bad"], 0: 0.0, 1: START["good"]}] * n}
    patterns, before = sorted(patterns), None
    for _ in range(rounds if total else 0):
        share = [posterior(v, model) for v, _ in patterns]
        if before is not None and max(abs(a - b) for a, b in zip(share, before, strict=True)) <= rest:
            break
        before = share
        on_good = [dict(zip((-1, 0, 1), PRIOR_GOOD, strict=True)) for _ in range(n)]
        on_bad = [dict(zip((-1, 0, 1), PRIOR_BAD, strict=True)) for _ in range(n)]
        for (v, k), p in zip(patterns, share, strict=True):
            for j, x in enumerate(v):
                on_good[j][x] += k * p
                on_bad[j][x] += k * (1 - p)
        good = math.fsum(k * p for (_, k), p in zip(patterns, share, strict=True))
        spare = math.log((total - good + sum(PRIOR_BAD)) / (good + sum(PRIOR_GOOD)))
        weights = [{x: math.log(g[x] / b[x]) + spare for x in (-1, 0, 1)} for g, b in zip(on_good, on_bad, strict=True)]
        model = {"prior": math.log((good + 1) / (total - good + 1)), "weights": weights}
    return model


def posterior(v: tuple[int, ...], model: dict) -> float:
    odds = model["prior"] + sum(w[x] for x, w in zip(v, model["weights"], strict=True))
    return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0


def posterior_column(v: Column, model: dict) -> Column:
    x = F.lit(model["prior"])
    for n, w in zip(RULES, model["weights"], strict=True):
        x = x + F.when(v[n] < 0, w[-1]).when(v[n] > 0, w[1]).otherwise(w[0])
    return 1 / (1 + F.exp(-x))


def model_of(voted: DataFrame, judged: Column) -> dict:
    """Fit on all rows that pass the base rules; judged is a struct of votes and failed, and only distinct votes are collected."""
    v = judged["votes"]
    rows = voted.filter(~judged["failed"]).groupBy(*[v[n].alias(n) for n in RULES]).count().collect()
    return fit([(tuple(r[n] for n in RULES), r["count"]) for r in rows])


def _written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, so its counts are computed once and later reads take the columns they need."""
    path = f"{shared_folder(df.sparkSession)}/quality-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _judged(c: Column) -> Column:
    return F.struct(votes(c).alias("votes"), base_failed(c).alias("failed"))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Key, counts, votes, posterior and verdict of every document."""
    counted = docs.select(F.col(key), counts(F.col(text)).alias("counts"))
    voted = _written(counted.withColumn("judged", _judged(F.col("counts"))))
    j = F.col("judged")
    p = posterior_column(j["votes"], model_of(voted, j))
    return voted.select(
        key, "counts", j["votes"].alias("votes"), p.alias("posterior"), j["failed"].alias("base_failed"), (~j["failed"] & (p >= threshold)).alias("kept")
    )


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs that are kept, with the columns of docs; texts are not shuffled and counted once."""
    name = "judged"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    counted = docs.select(*[F.col(f"`{c}`") for c in docs.columns], let(counts(F.col(text)), _judged).alias(name))
    voted, j = _written(counted), F.col(name)
    good = ~j["failed"] & (posterior_column(j["votes"], model_of(voted, j)) >= threshold)
    return voted.filter(good).select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[F.col("counts")[n].alias(n) for n in names], "base_failed", "kept", "posterior")
