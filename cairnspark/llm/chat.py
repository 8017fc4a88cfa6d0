"""Chat formatting by event-sourced reconstruction (native DataFrame functions only).

A log of events is partitioned by conversation and sorted by sequence. An event has an op:
message (a whole message), delta (text to append), edit (text that replaces), regenerate
(drops what the message has so far) or delete. Events of one message id fold into its
final text; then turns are rendered in the order in which their messages began, as

    ### role: text</turn>

with a line feed after each. In texts, backslashes are doubled, and one is put inside
"</turn>" and "### ", so no control string of the template stays in a text; undoing drops
the first of any two characters that start with a backslash. In roles, "%", ":", "<", "#" and line feeds are
percent-encoded. The loss mask is a list of spans (start, length in code points).

Edge cases: null text or role: empty; null ids group together; message events that repeat
an id and are not edited stay turns of their own, so repeated rows repeat; ties in sequence
go by op, role and text; null sequences come first; an empty log gives an empty result; other columns are not read.
A conversation is rendered in one task, as its text is one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnspark.llm.common import let, table

END = "</turn>\n"


def escape(text: Column) -> Column:
    x = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    x = F.replace(x, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(x, F.lit("### "), F.lit("#\\## "))


def unescape(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\(.)", "$1")).otherwise(text)


#: Characters of a role that are percent-encoded; "%" itself comes first and is undone last.
_ROLE = {"%": "%25", ":": "%3A", "<": "%3C", "#": "%23", "\n": "%0A"}


def _escape_role(role: Column) -> Column:
    for c, code in _ROLE.items():
        role = F.replace(role, F.lit(c), F.lit(code))
    return role


def _unescape_role(role: Column) -> Column:
    for c, code in reversed(_ROLE.items()):
        role = F.replace(role, F.lit(code), F.lit(c))
    return role


def fold(events: DataFrame) -> DataFrame:
    """Turns (conv_id, seq, place, role, text) from events (conv_id, seq, message_id, op, role, text)."""
    log = events.select(
        "conv_id", "message_id",
        F.struct(
            "seq", "op", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
        ).alias("e"),
    )
    sorted_log = log.repartition("conv_id").groupBy("conv_id", "message_id").agg(F.sort_array(F.collect_list("e")).alias("log"))

    def folded(es: Column) -> Column:
        """One final message: the text since the last event that replaced or dropped it."""
        last = lambda ops: F.array_max(F.transform(es, lambda e, i: F.when(e["op"].isin(*ops), i).otherwise(-1)))
        start = F.greatest(last(["message", "edit", "regenerate"]), F.lit(0))
        kept = F.filter(es, lambda e, i: (i >= start) & (e["op"] != "regenerate"))
        role = F.element_at(F.filter(F.transform(es, lambda e: e["role"]), lambda r: r != ""), 1)
        turn = F.struct(
            es[0]["seq"].alias("seq"),
            F.coalesce(F.when(F.size(F.filter(es, lambda e: e["role"] != "")) > 0, role), F.lit("")).alias("role"),
            F.array_join(F.transform(kept, lambda e: e["text"]), "").alias("text"),
        )
        gone = F.element_at(es, -1)["op"] == "delete"
        return F.filter(F.array(turn), lambda _: ~gone)

    whole = F.transform("log", lambda e: F.struct(e["seq"].alias("seq"), e["role"].alias("role"), e["text"].alias("text")))
    plain = F.forall("log", lambda e: e["op"] == "message")
    turns = sorted_log.select(
        "conv_id", F.posexplode(F.when(plain, whole).otherwise(let(F.col("log"), folded))).alias("place", "turn")
    )
    return turns.select("conv_id", "place", "turn.*")


def render(turns: DataFrame, learned: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans): conversations as text, with spans of the texts that a model learns."""
    parts = turns.select(
        "conv_id", "seq", "place", "role",
        F.concat(F.lit("### "), _escape_role(F.col("role")), F.lit(": ")).alias("head"), escape(F.col("text")).alias("body"), "text",
    )
    parts = parts.withColumn("size", (F.char_length("head") + F.char_length("body") + F.lit(len(END))).cast("long"))
    order = Window.partitionBy("conv_id").orderBy("seq", "place", "role", "text")
    rows = Window.unboundedPreceding
    parts = parts.withColumn("at", F.row_number().over(order)).withColumn(
        "before", F.sum("size").over(order.rowsBetween(rows, 0)) - F.col("size")
    )
    span = F.struct((F.col("before") + F.char_length("head")).alias("start"), F.char_length("body").cast("long").alias("length"))
    whole = F.struct("at", F.concat("head", "body", F.lit(END)).alias("text"), F.when(F.col("role") == learned, span).alias("span"))
    return parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(whole)).alias("turns")).select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def parse(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    pieces = F.filter(F.split(formatted, END), lambda x: x != "")

    def turn(x: Column) -> Column:
        colon = F.instr(x, F.lit(": "))
        role = _unescape_role(F.substring(x, F.lit(5), colon - 5))
        return F.struct(role.alias("role"), unescape(F.substring(x, colon + 2, F.char_length(x))).alias("text"))

    return F.transform(pieces, turn)


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )


def logged(rows: DataFrame) -> DataFrame:
    """The event log of finished turns (conv_id, turn, role, text), one message each.

    A message begins with a draft. The assistant's is regenerated and its text streamed in three deltas; others' is
    edited into the first third of the text, and deltas append the rest. Sequences are (turn, place in the message).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    third = F.ceil(F.char_length(text) / 3).cast("int")
    part = lambda i: F.substring(text, third * i + 1, third)
    event = lambda op, said, role=F.lit(None).cast("string"): F.struct(F.lit(op).alias("op"), role.alias("role"), said.alias("text"))
    draft = event("delta", F.concat(F.lit("draft "), part(1)), F.col("role"))
    streamed = F.array(draft, event("regenerate", F.lit(None).cast("string")), event("delta", part(0)), event("delta", part(1)), event("delta", part(2)))
    edited = F.array(draft, event("edit", part(0)), event("delta", part(1)), event("delta", part(2)))
    events = rows.withColumn("message_id", F.monotonically_increasing_id()).select(
        "conv_id", "turn", "message_id", F.posexplode(F.when(F.col("role") == "assistant", streamed).otherwise(edited)).alias("at", "e"))
    return events.select("conv_id", F.struct("turn", "at").alias("seq"), "message_id", "e.*")


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that holds the template's own strings, as a log of events that is folded, rendered and read back."""
    saying = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), saying.alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    made = render(fold(logged(rows.unionByName(extra)))).select(
        "conv_id", "formatted", parse(F.col("formatted")).alias("turns"), learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned")
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE_SQL = r"""
WITH rows AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), lines AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## ') AS body,
         replace(replace(replace(replace(replace(role, '%', '%25'), ':', '%3A'), '<', '%3C'), '#', '%23'), chr(10), '%0A') AS shown FROM rows
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(body) + length(shown) + 14) AS BIGINT) AS formatted_chars
FROM lines GROUP BY conv_id
"""
