"""Token counts that follow edits.

A text is cut into leaves where the tokenizer's pattern always starts a new piece, so counts of leaves add
up exactly: at spaces that stand between two non-space characters, and between a mark of punctuation and a letter
(but not behind an apostrophe or a bar, which contractions and added tokens hold), so texts that are written without
spaces are cut as well. A segment tree holds the sums of characters and tokens. An edit re-encodes only the leaves
it touches and one neighbour on each side as context, and updates the sums above them. Added tokens count as
the tokenizer counts them: as one.

Trees are kept as a table: trees gives the leaves of every text with their counts, keep_trees writes them in buckets by key, and
apply_edits takes that table and one of edits and gives the counts before and after, with the leaves as they are then. Only what
an edit touches is encoded, and only documents with edits reach a Python worker. A document's leaves stay in one row; where trees are
kept in buckets, only the edits are shuffled to their documents, else large tables of edits move the trees too.

Edge cases: null or empty text: one empty leaf, no tokens; edits outside the text are
clipped to it; edits of one key apply in the order of seq, later ones to the text that the earlier made; edits of
other keys do nothing; a text without such places is one leaf; rows repeat; an empty table gives an
empty result; only key and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm.common import cut, small_batches, table
from cairnspark.llm.tokens import default_vocabulary, encoding

LEAF = 128
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85]) (?=[^\s\x1c-\x1f\x85])|(?<=[^\s\w\x1c-\x1f\x85'|])(?=[^\W\d_])")


def leaves(text: str, size: int = LEAF) -> list[str]:
    """The text in pieces of at least size characters (the last may be shorter), cut where pieces are independent."""
    out, at = [], 0
    while (m := _CUT.search(text, at + size)) is not None and m.start() < len(text):
        out.append(text[at : m.start()])
        at = m.start()
    out.append(text[at:])
    return out


def counter(path: str) -> Callable[[str], int]:
    known = encoding(path)
    return lambda text: len(known.encode(text, allowed_special="all"))


class TokenTree:
    """Token count of one text under edits. encoded_chars counts what was encoded so far."""

    def __init__(self, text: str | None, path: str, size: int = LEAF):
        self.count_of, self.size, self.encoded_chars = counter(path), size, 0
        self._build(leaves(text or "", size))

    @classmethod
    def of(cls, texts: list[str], tokens: list[int], path: str, size: int = LEAF) -> TokenTree:
        """The tree of kept leaves with their counts; nothing is encoded."""
        tree = cls.__new__(cls)
        tree.count_of, tree.size, tree.encoded_chars = counter(path), size, 0
        tree._build(texts, tokens)
        return tree

    def _build(self, texts: list[str], tokens: list[int] | None = None) -> None:
        self.texts = list(texts)
        self.base = 1 << max(0, (len(self.texts) - 1).bit_length())
        self.chars, self.tokens = [0] * (2 * self.base), [0] * (2 * self.base)
        for i, t in enumerate(self.texts):
            self._leaf(i, t, None if tokens is None else tokens[i])
        for i in range(self.base - 1, 0, -1):
            self._sum(i)

    def _leaf(self, i: int, text: str, tokens: int | None = None) -> None:
        self.texts[i] = text
        if tokens is None:
            self.encoded_chars += len(text)
            tokens = self.count_of(text)
        self.chars[self.base + i], self.tokens[self.base + i] = len(text), tokens

    def leaf_tokens(self) -> list[int]:
        return self.tokens[self.base : self.base + len(self.texts)]

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.texts)

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character at, and the characters before the leaf."""
        i, before = 1, 0
        while i < self.base:
            i *= 2
            if at >= before + self.chars[i]:
                before += self.chars[i]
                i += 1
        last = len(self.texts) - 1
        if i - self.base <= last:
            return i - self.base, before
        return last, self.n_chars - self.chars[self.base + last]

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters from start to before end by new."""
        start = min(max(start, 0), self.n_chars)
        end = min(max(end, start), self.n_chars)
        first, before = self._find(start)
        last, _ = self._find(max(start, end - 1))
        filled = 0  # context: the next leaf on each side that holds characters
        while first > 0 and not filled:
            first -= 1
            filled = self.chars[self.base + first]
            before -= filled
        filled = 0
        while last < len(self.texts) - 1 and not filled:
            last += 1
            filled = self.chars[self.base + last]
        old = "".join(self.texts[first : last + 1])
        region = old[: start - before] + new + old[end - before :]
        slots = last - first + 1
        if len(region) > 8 * self.size * slots:
            counts, made = self.leaf_tokens(), leaves(region, self.size)
            self.encoded_chars += len(region)
            self._build(self.texts[:first] + made + self.texts[last + 1 :], counts[:first] + [self.count_of(t) for t in made] + counts[last + 1 :])
            return
        parts = leaves(region, max(1, len(region) // slots + 1))[:slots]
        parts[-1] += region[sum(map(len, parts)) :]
        touched = set()
        for i, t in enumerate(parts + [""] * (slots - len(parts)), first):
            if t != self.texts[i]:
                self._leaf(i, t)
                touched.add((self.base + i) // 2)
        while touched and touched != {0}:
            for i in touched:
                self._sum(i)
            touched = {i // 2 for i in touched} - {0}


_TREE = "array<struct<text: string, tokens: int>>"


def trees(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, leaves): the leaves of every text with their token counts."""
    path = vocabulary or default_vocabulary()

    @F.pandas_udf("texts array<string>, tokens array<int>")
    def leaves_of(texts: pd.Series) -> pd.DataFrame:
        count, out = counter(path), []
        for t in texts:
            parts = leaves(t or "")
            out.append((parts, [count(x) for x in parts]))
        return pd.DataFrame(out, columns=["texts", "tokens"])

    small_batches(docs.sparkSession)
    made = docs.select(F.col(key), leaves_of(F.col(text)).alias("l"))
    return made.select(key, F.arrays_zip(F.col("l.texts").alias("text"), F.col("l.tokens").alias("tokens")).cast(_TREE).alias("leaves"))


_EDITS = "array<struct<start: long, end: long, new: string>>"
_COUNTED = "n_chars long, n_tokens long, edited_chars long, edited_tokens long, reencoded_chars long, n_leaves long"


def edited(kept: DataFrame, key: str, edits: Column, vocabulary: str | None = None) -> DataFrame:
    """Counts before and after each row's edits (a column of structs start, end, new), how much was encoded, and the new leaves."""
    path = vocabulary or default_vocabulary()

    @F.pandas_udf(f"{_COUNTED}, texts array<string>, tokens array<int>")
    def counts(texts: pd.Series, tokens: pd.Series, changes: pd.Series) -> pd.DataFrame:
        out = []
        for t, n, e in zip(texts, tokens, changes, strict=True):
            tree = TokenTree.of(list(t), [int(x) for x in n], path)
            before = tree.n_chars, tree.n_tokens
            for x in [] if e is None else e:
                tree.edit(int(x["start"]), int(x["end"]), x["new"] or "")
            out.append((*before, tree.n_chars, tree.n_tokens, tree.encoded_chars, len(tree.texts), tree.texts, tree.leaf_tokens()))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _COUNTED.split(", ")] + ["texts", "tokens"])

    small_batches(kept.sparkSession)
    made = kept.select(F.col(key), counts(F.col("leaves.text"), F.col("leaves.tokens"), edits.cast(_EDITS)).alias("c"))
    leaves_ = F.arrays_zip(F.col("c.texts").alias("text"), F.col("c.tokens").alias("tokens")).cast(_TREE)
    return made.select(key, *[F.col(f"c.{c.split()[0]}") for c in _COUNTED.split(", ")], leaves_.alias("leaves"))


def keep_trees(kept: DataFrame, name: str, key: str = "doc_id", buckets: int = 64) -> DataFrame:
    """Write trees as a table of the session's catalog in so many buckets by key, and read it."""
    kept.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(name)
    return kept.sparkSession.table(name)


def apply_edits(kept: DataFrame, edits: DataFrame, key: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """edited for a table of edits (key, seq, start, end, new); documents without edits keep their counts and leaves, with nothing encoded again."""
    one = edits.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("seq", "start", "end", "new"))).alias("_edits"))
    joined = kept.join(one, key, "left")
    changes = F.transform("_edits", lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["new"].alias("new")))
    total = lambda f: F.aggregate("leaves", F.lit(0).cast("long"), lambda n, x: n + f(x))
    chars, tokens = total(lambda x: F.char_length(x["text"])), total(lambda x: x["tokens"])
    still = joined.filter(F.col("_edits").isNull()).select(
        key, chars.alias("n_chars"), tokens.alias("n_tokens"), chars.alias("edited_chars"), tokens.alias("edited_tokens"), F.lit(0).cast("long").alias("reencoded_chars"),
        F.size("leaves").cast("long").alias("n_leaves"), "leaves")
    return edited(joined.filter(F.col("_edits").isNotNull()), key, changes, vocabulary).unionByName(still)


def own_edits(text: Column) -> Column:
    """Three edits made from a text itself: a replaced passage, an inserted line and a dropped start."""
    n = F.char_length(text).cast("long")
    edit = lambda a, b, new: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"), new.alias("new"))
    third, half, zero = F.floor(n / 3), F.floor(n / 2), F.lit(0)
    return F.array(edit(third, third + 20, F.left(text, F.lit(40))), edit(half, half, F.concat(F.lit("\n"), F.right(text, F.lit(30)))), edit(zero, zero + 10, F.lit("")))


def count_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Token counts of every text before and after own_edits, from kept trees."""
    kept = cut(trees(docs, key, text, vocabulary))
    whole = F.array_join(F.transform("leaves", lambda x: x["text"]), "")
    return edited(kept, key, own_edits(whole), vocabulary).drop("leaves")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_with_edits(table(spark, sf_dir, "documents"))
