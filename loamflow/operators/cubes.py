"""Cubes with distinct counts. Spark's own plan for them expands every input row once for each grouping and each count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamflow.operators.joins import unused


def cube_counts(df: DataFrame, dims: Sequence[str], distinct: Mapping[str, str], sums: Mapping[str, Column], grouping: str) -> DataFrame:
    """``df`` grouped by all subsets of ``dims``: ``dims``, ``grouping`` (as ``grouping_id()``), distinct counts and sums.

    ``distinct`` names the column whose values are counted, NULLs left out; there is at least one. ``sums`` are added up. A value is
    combined with the finest groups it occurs in before it is expanded, and expanded where all its groups are, so nothing expanded
    is shuffled. A hot value is one row for each finest group by then. As with Spark's ``CUBE``, no rows give none.
    """
    kind, bits = unused("_kind", df), unused("_bits", df)
    held = {name: unused(f"_sum{i}", df) for i, name in enumerate(sums)}
    values = [unused(f"_value{i}", df) for i in range(len(distinct))]
    finest = [unused(f"_dim{i}", df) for i in range(len(dims))]
    types = [df.schema[c].dataType for c in distinct.values()]

    def look(i: int, column: str) -> Column:
        own = [F.col(column) if j == i else F.lit(None).cast(t) for j, t in enumerate(types)]
        return F.struct(F.lit(i).alias(kind), *[v.alias(name) for v, name in zip(own, values)])

    looks = F.inline(F.array(*[look(i, c) for i, c in enumerate(distinct.values())]))
    rows = df.select(*[F.col(d).alias(f) for d, f in zip(dims, finest)], *[e.alias(held[n]) for n, e in sums.items()], looks)
    # The sums go with the first of the values.
    first = [F.sum(F.when(F.col(kind) == 0, F.col(h))).alias(h) for h in held.values()]
    known = rows.groupBy(*finest, kind, *values).agg(*first).repartition(kind, *values)

    def group(mask: int) -> Column:
        kept = [F.when(F.lit(not mask >> (len(dims) - 1 - i) & 1), F.col(f)).alias(d) for i, (d, f) in enumerate(zip(dims, finest))]
        return F.struct(F.lit(mask).cast("long").alias(bits), *kept)

    groups = F.inline(F.array(*[group(mask) for mask in range(1 << len(dims))]))
    each = known.select(kind, *values, *held.values(), groups)
    each = each.groupBy(bits, *dims, kind, *values).agg(*[F.sum(h).alias(h) for h in held.values()])
    return each.groupBy(*dims, F.col(bits).alias(grouping)).agg(
        *[F.count(F.when(F.col(kind) == i, F.col(v))).alias(name) for i, (name, v) in enumerate(zip(distinct, values))],
        *[F.sum(h).alias(name) for name, h in held.items()],
    )
