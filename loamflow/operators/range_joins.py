"""Joins on ranges of values as equi joins: a point in an interval, and the last row before a point.

Neither compares every row with every other, and neither gathers a key in one task: hot keys are split by adaptive execution
in the interval join, and by stretches of time in the as-of join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from loamflow.operators.joins import all_of, lookup_join


def _number(df: DataFrame, column: str) -> Column:
    """Whole number that orders like the column: microseconds for times, days for dates."""
    value, kind = F.col(column), df.select(F.col(column)).schema[0].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, NumericType):
        return F.floor(value).cast("long")
    raise ValueError(f"cannot join on a range of {kind.simpleString()} values: {column}")


def _apart(left: DataFrame, right: DataFrame) -> None:
    both = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if both:
        raise ValueError(f"columns on both sides, rename them first: {sorted(both)}")


def _fresh(name: str, *frames: DataFrame) -> str:
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def interval_join(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str,
                  on: Sequence[tuple[str, str]] = (), how: str = "inner") -> DataFrame:
    """Rows of ``points`` with each row of ``intervals`` whose [start, end) holds ``point``; ``how`` is inner or left.

    ``on`` are further columns (of points, of intervals) that must be equal. An interval is filed under the smallest power
    of two that is not shorter than it, in the one or two stretches of that width which it touches; a point looks into its stretch of
    each width that occurs (63 at most, collected). So an interval is two rows, however long; the exact test follows the equi join.
    Empty and reversed intervals hold nothing; a NULL in any of the columns matches nothing. No column may be on both sides.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"interval join is inner or left, not {how!r}")
    _apart(points, intervals)
    level, stretch, row = (_fresh(n, points, intervals) for n in ("_level", "_stretch", "_row"))
    first, last = _number(intervals, start), F.greatest(_number(intervals, start), _number(intervals, end))
    # Width 2^level is at least the length, which takes in the end itself, as fractions were cut off; where a double is not exact,
    # it is the next one.
    length = last.cast("double") - first.cast("double") + 1
    width = F.ceil(F.log2(length)) + (length > float(1 << 50)).cast("int")
    filed = intervals.filter(F.col(start) < F.col(end)).withColumn(level, F.least(F.lit(63), width.cast("int")))
    levels = sorted(r[0] for r in filed.select(level).distinct().collect())
    filed = filed.withColumn(stretch, F.explode(F.array_distinct(F.array(
        F.call_function("shiftright", first, F.col(level)), F.call_function("shiftright", last, F.col(level))
    ))))
    at = _number(points, point)
    looked = points if how == "inner" else points.withColumn(row, F.monotonically_increasing_id())
    looks = F.array(*[F.struct(F.lit(k).alias("level"), F.call_function("shiftright", at, F.lit(k)).alias("stretch")) for k in levels])
    if not levels:
        looks = F.array().cast("array<struct<level: int, stretch: bigint>>")
    probes = looked.withColumn(stretch, F.explode(looks))
    equal = [probes[a] == filed[b] for a, b in on]
    # Spark does not see that either side is a multiple of its input: neither may be broadcast by its static size.
    met = probes.join(filed.hint("merge"), all_of([
        *equal, probes[stretch]["level"] == filed[level], probes[stretch]["stretch"] == filed[stretch],
    ]), "inner").filter((F.col(point) >= F.col(start)) & (F.col(point) < F.col(end)))
    if how == "inner":
        return met.select(*points.columns, *intervals.columns)
    # A row of points meets intervals in several stretches or in none: those without are added.
    alone = lookup_join(looked, met.select(row).distinct(), [row], "left_anti")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in intervals.schema]
    return met.select(*points.columns, *intervals.columns).unionByName(alone.select(*points.columns, *nothing))


def as_of_join(left: DataFrame, right: DataFrame, at: str, right_at: str, on: Sequence[tuple[str, str]],
               width: int, latest: Sequence[str] = (), within: int | None = None) -> DataFrame:
    """Each row of ``left`` with the last row of ``right`` that is not after it, NULLs if there is none.

    ``on`` are the columns (of left, of right) that must be equal. Of rows of ``right`` at the same instant the one
    with the greatest ``latest`` columns counts (all columns if none are named). ``within``: how far back it may lie, in
    microseconds for times, days for dates, else units. A NULL key or instant matches nothing.

    Instants of both sides, one row for each, are put in order within stretches of ``width`` (same units); the last row of each
    stretch is carried into the following ones by a window over one row for each stretch that has any. So a task holds the instants of a key in a
    stretch, whatever the key's share of the rows, and repeated instants are one before anything is gathered.
    """
    _apart(left, right)
    if width <= 0:
        raise ValueError("the stretches of an as-of join need a positive width")
    taken = (left, right)
    keys = [_fresh(f"_key{i}", *taken) for i in range(len(on))]
    when, row, found, carried, stretch = (_fresh(n, *taken) for n in ("_when", "_row", "_found", "_carried", "_stretch"))
    pick = F.struct(*[F.struct(*map(F.col, latest))] if latest else [], F.struct(*map(F.col, right.columns)).alias("whole"))
    rights = right.select(*[F.col(b).alias(k) for k, (_, b) in zip(keys, on)], F.col(right_at).alias(when), pick.alias(row))
    lefts = left.select(*[F.col(a).alias(k) for k, (a, _) in zip(keys, on)], F.col(at).alias(when))
    lefts = lefts.distinct().withColumn(row, F.lit(None).cast(rights.schema[row].dataType))
    known = all_of([F.col(c).isNotNull() for c in [*keys, when]])
    instants = rights.unionByName(lefts).filter(known).groupBy(*keys, when).agg(F.max(row).alias(row))
    instants = instants.withColumn(stretch, F.floor(_number(instants, when) / F.lit(width)).cast("long"))
    inside = Window.partitionBy(*keys, stretch).orderBy(when).rowsBetween(Window.unboundedPreceding, 0)
    seen = instants.withColumn(found, F.last(row, ignorenulls=True).over(inside))
    ends = instants.filter(F.col(row).isNotNull()).groupBy(*keys, stretch).agg(F.max_by(row, when).alias(carried))
    # One row for each stretch that has instants; the last row of an earlier one is carried into it.
    stretches = instants.select(*keys, stretch).distinct().join(ends, [*keys, stretch], "left")
    before = Window.partitionBy(*keys).orderBy(stretch).rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.withColumn(carried, F.last(carried, ignorenulls=True).over(before)).filter(F.col(carried).isNotNull())
    seen = seen.join(stretches, [*keys, stretch], "left")
    answers = seen.select(*keys, when, F.coalesce(F.col(found), F.col(carried))["whole"].alias(found))
    answers = answers.filter(F.col(found).isNotNull()).groupBy(*keys, when).agg(F.first(found).alias(found))
    keyed = left.select("*", *[F.col(a).alias(k) for k, (a, _) in zip(keys, on)], F.col(at).alias(when))
    joined = lookup_join(keyed, answers, [*keys, when], "left")
    if within is not None:
        near = _number(joined, when) - _number(joined.select("*", F.col(found)[right_at].alias(row)), row) <= F.lit(within)
        joined = joined.withColumn(row, F.col(found)[right_at]).withColumn(found, F.when(near, F.col(found)))
    return joined.select(*left.columns, *[F.col(found)[c].alias(c) for c in right.columns])
