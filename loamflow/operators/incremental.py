"""High-water marks: read what is newer, remember how far the data goes."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from loamflow.operators.joins import lookup_join


@dataclass(frozen=True)
class LateRows:
    """What a spec does about rows that arrive at or below its mark.

    ``tie``: a column that grows among the rows of one mark value; the mark is then the greatest (value, tie), and rows of the
    same value with a greater tie are read. ``overlap``: an interval such as ``"2 days"`` below the mark that is read
    again each time: keyed strategies merge it, ``append`` adds the rows whose key and mark the table does not have.
    """

    tie: str = ""
    overlap: str = ""


def mark_literal(mark: Any, dtype: DataType) -> Column:
    """The stored mark as a constant of the column's own type, so the filter reaches the scan."""
    return F.lit(mark).cast(dtype)


def type_of(df: DataFrame, column: str) -> DataType:
    """Type of a column, its name resolved the way Spark does (letter case included)."""
    return df.select(F.col(column)).schema[0].dataType


def incremental_filter(df: DataFrame, mark_column: str, last: Any | None, overlap: str | None = None) -> DataFrame:
    """Rows strictly above ``last``; all rows when there is no mark yet.

    Rows equal to the mark and rows without a mark value are not read again. ``overlap`` (an
    interval such as ``"1 hour"``) re-reads a stretch below the mark, for merge targets that
    have to pick up late arrivals.
    """
    if last is None:
        return df
    bound = mark_literal(last, type_of(df, mark_column))
    if overlap:
        bound = bound - F.expr(f"INTERVAL {overlap}")
    return df.filter(F.col(mark_column) > bound)


def above_tie(df: DataFrame, mark_column: str, last: Any, tie_column: str, tie: Any) -> DataFrame:
    """Rows above the two-part mark (``last``, ``tie``). The bound on the mark column alone reaches the scan."""
    mark, bound = F.col(mark_column), mark_literal(last, type_of(df, mark_column))
    greater = F.col(tie_column) > mark_literal(tie, type_of(df, tie_column))
    return df.filter((mark >= bound) & ((mark > bound) | greater))


def not_yet_stored(df: DataFrame, target: DataFrame, keys: list[str], mark_column: str, last: Any, overlap: str) -> DataFrame:
    """Rows of a stretch read again that the target lacks: none there has the same keys and mark, NULL keys included.

    Of the target only that stretch is read, and of it only the keys and the mark.
    """
    name = "_identity"
    while name in {c.lower() for c in [*df.columns, *target.columns]}:
        name += "_"
    identity = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate([*keys, mark_column])])
    there = incremental_filter(target, mark_column, last, overlap).select(identity.alias(name)).distinct()
    return lookup_join(df.withColumn(name, identity), there, [name], "left_anti").drop(name)


def next_mark(mark_column: str) -> Column:
    """Aggregate for the next mark; NULL when no row carries one."""
    return F.max(mark_column)


def watermark_advance(df: DataFrame, mark_column: str, last: Any | None = None) -> DataFrame:
    """One row: the mark before, after, and how many rows lie between."""
    dtype = type_of(df, mark_column)
    before = F.lit(None).cast(dtype) if last is None else mark_literal(last, dtype)
    return (
        incremental_filter(df, mark_column, last)
        .agg(next_mark(mark_column).alias("seen"), F.count(F.lit(1)).alias("new_rows"))
        .select(
            before.alias("mark_before"),
            F.coalesce(F.col("seen"), before).alias("mark_after"),
            "new_rows",
        )
    )
