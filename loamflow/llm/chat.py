"""Relational chat formatting: conversations as template text with a loss mask, in Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role are
merged into a block by an array aggregation; the blocks are then joined to one text::

    ### role:
    text</part>text of the next turn by the same role</turn>

Control strings inside texts and roles are escaped with a backslash and a letter, so that the text
can be read back exactly, and the mask covers the texts of the chosen roles and nothing else.

Defined results: turns go by ``turn`` (null first), then role, then text; equal rows are turns of
their own; a null text or role is empty; a null ``conv_id`` is one conversation; other columns are
ignored; an empty table gives no rows. A conversation is a row of the result and so is held by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamflow.llm.base import whole_columns

#: What the template is made of, and how it reads inside texts and roles.
HEADER, COLON, PART, TURN = "###", ":", "</part>", "</turn>"
ESCAPES = [("\\", "\\b"), (HEADER, "\\h"), (TURN, "\\t"), (PART, "\\p"), (COLON, "\\c")]
OPEN, NAMED, END = HEADER + " ", COLON + "\n", TURN + "\n"


def escape(text: Column) -> Column:
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def _merge(blocks: Column, turn: Column) -> Column:
    last = F.try_element_at(blocks, F.lit(-1))
    same = F.coalesce(last["role"] == turn["role"], F.lit(False))
    grown = F.struct(turn["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
    opened = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
    return F.when(same, F.concat(F.slice(blocks, 1, F.size(blocks) - 1), F.array(grown))).otherwise(
        F.concat(blocks, F.array(opened))
    )


def _segments(block: Column, loss_roles: tuple[str, ...]) -> Column:
    """The strings of a block in order; ``loss`` marks its texts if its role is to be learnt."""
    learnt = block["role"].isin(*loss_roles)
    header = F.concat(F.lit(OPEN), escape(block["role"]), F.lit(NAMED))

    def of(text: Column, i: Column) -> Column:
        return F.array(
            F.struct(F.when(i == 0, header).otherwise(F.lit(PART)).alias("piece"), F.lit(False).alias("loss")),
            F.struct(escape(text).alias("piece"), learnt.alias("loss")),
            F.struct(F.when(i == F.size(block["texts"]) - 1, F.lit(END)).otherwise(F.lit("")).alias("piece"),
                     F.lit(False).alias("loss")),
        )

    return F.flatten(F.transform(block["texts"], of))


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, formatted, loss_spans (start and length in code points of ``formatted``, from 0)."""
    own = whole_columns(turns, "conv_id", "turn", "role", "text")
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    collected = own.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    none = F.array().cast("array<struct<role: string, texts: array<string>>>")
    merged = collected.select("conv_id", F.aggregate("turns", none, _merge).alias("blocks"))
    cut = merged.select(
        "conv_id", F.flatten(F.transform("blocks", lambda b: _segments(b, loss_roles))).alias("segments")
    )
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start: int, length: int>>").alias("spans")
    )

    def spans(acc: Column, s: Column) -> Column:
        span = F.struct(acc["at"].alias("start"), F.char_length(s["piece"]).alias("length"))
        return F.struct(
            (acc["at"] + F.char_length(s["piece"])).alias("at"),
            F.when(s["loss"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    return cut.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["piece"]), "").alias("formatted"),
        F.aggregate("segments", start, spans)["spans"].alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role and text as they were given) and loss_texts (unescaped, in order)."""

    def of(block: Column) -> Column:
        header = F.substring_index(block, NAMED, 1)
        role = unescape(F.substring(header, len(OPEN) + 1, 1 << 30))
        body = F.substr(block, F.char_length(header) + F.lit(len(NAMED) + 1))
        return F.transform(
            F.split(body, PART, -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))
        )

    blocks = F.split("formatted", END, -1)
    masked = F.transform(
        "loss_spans", lambda s: unescape(F.substr("formatted", s["start"] + F.lit(1), s["length"]))
    )
    return formatted.select(
        "conv_id", "formatted",
        F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), of)).alias("turns"),
        masked.alias("loss_texts"),
    )
