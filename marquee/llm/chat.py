"""Chat formatting (Spark expressions only).

The turns of a conversation are collected, sorted, and adjacent turns of
one role are merged into one block:

    ### role: text<next/>text</turn>\\n

``###``, ``<next/>`` and ``</turn>`` are control strings. Inside texts and
roles ``\\`` is written ``\\b``, ``<`` is ``\\l``, ``#`` is ``\\h`` and, in
roles, ``:`` is ``\\c``; so no text can hold a control string and the
output can be read back exactly, turn by turn. The loss mask is a list of
(start, length) spans in code points, one per assistant text, without the
marks between them.

Defined results: null texts and roles are empty strings; turns are ordered
by (turn, role, text) with null turns first, so ties and repeated rows give
one result on any partitioning, and every repeated row is a turn; rows with
a null conv_id are one conversation; an empty table gives no rows; other
columns are ignored. One conversation is one output string, so its turns
meet in one task; nothing else does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import bind

# control strings of the template and escapes of their first characters
HEAD, SEP, END = "### ", "<next/>", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = ESCAPES + ((":", "\\c"),)
ASSISTANT = "assistant"


def escape(text: Column, pairs=ESCAPES) -> Column:
    for plain, code in pairs:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, pairs=ESCAPES) -> Column:
    for plain, code in reversed(pairs):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _blocks(turns: Column) -> Column:
    """Runs of adjacent turns of one role: (role, texts)."""
    starts = F.filter(F.sequence(F.lit(0), F.size(turns) - 1), lambda i: (i == 0) | (
        F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))
    return bind(starts, lambda s: F.transform(s, lambda at, j: F.struct(
        F.get(turns, at)["role"].alias("role"),
        F.transform(F.slice(turns, at + 1, F.coalesce(F.get(s, j + 1), F.size(turns)) - at),
                    lambda t: t["text"]).alias("texts"))))


def _pieces(blocks: Column) -> Column:
    """The output in order, as (string, under the loss mask)."""
    def of(b: Column) -> Column:
        loss = b["role"] == ASSISTANT
        return F.flatten(F.array(
            F.array(F.struct(F.concat(F.lit(HEAD), escape(b["role"], ROLE_ESCAPES), F.lit(": ")).alias("s"),
                             F.lit(False).alias("loss"))),
            F.flatten(F.transform(b["texts"], lambda t, i: F.array(
                F.struct(F.when(i == 0, F.lit("")).otherwise(F.lit(SEP)).alias("s"), F.lit(False).alias("loss")),
                F.struct(escape(t).alias("s"), loss.alias("loss"))))),
            F.array(F.struct(F.lit(END).alias("s"), F.lit(False).alias("loss")))))
    return F.flatten(F.transform(blocks, of))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, formatted (string), loss (array of start, length)."""
    empty = F.lit("")
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), empty).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), empty).alias("text"))
    grouped = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    pieces = grouped.select("conv_id", bind(F.col("turns"), lambda t: bind(_blocks(t), _pieces)).alias("p"))
    spans = F.aggregate(
        "p", F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, x: bind(F.length(x["s"]), lambda n: F.struct(
            (acc["at"] + n).alias("at"),
            F.when(x["loss"], F.concat(acc["spans"], F.array(F.struct(
                acc["at"].alias("start"), n.alias("length"))))).otherwise(acc["spans"]).alias("spans"))),
        lambda acc: acc["spans"])
    return pieces.select("conv_id", F.array_join(F.transform("p", lambda x: x["s"]), "").alias("formatted"),
                         spans.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    blocks = F.filter(F.split(formatted, END.replace("/", "\\/")), lambda b: b != "")
    return F.flatten(F.transform(blocks, lambda b: bind(
        unescape(F.substring_index(F.substring(b, len(HEAD) + 1, 2**31 - 1), ": ", 1), ROLE_ESCAPES),
        lambda role: F.transform(
            F.split(F.substr(b, F.instr(b, ": ") + 2), SEP),
            lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))))))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda x: unescape(
        F.substring(formatted, x["start"], x["length"]))), "")


def digest(formatted: DataFrame) -> DataFrame:
    """What the output holds, read back from it."""
    read = formatted.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                            loss_text(F.col("formatted"), F.col("loss")).alias("under"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("under").cast("long").alias("loss_chars"), F.sha2("under", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
