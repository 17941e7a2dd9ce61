"""Key lookups that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, with as many underscores behind it as make it new to the columns of all ``frames``."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _spread(columns: list[Column]) -> Column:
    # Always 0, but not foldable. See lookup_join.
    return F.pmod(F.xxhash64(*columns), F.lit(1))


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``left`` joined to ``right`` on ``keys``; ``how`` is left, left_semi or left_anti.

    ``right`` must hold one row per key, normally as the result of a ``groupBy(keys)``, so
    that a hot key on that side has been combined before its shuffle. A hot key (or NULL) on
    the left is split at run time by adaptive execution. That rule only fires when both join
    inputs come straight from a shuffle, which an aggregate already partitioned by the join
    keys does not; the extra constant key column makes Spark re-partition the (small, one row
    per key) aggregate and keeps the rule applicable. Broadcasting is left to Spark's own
    size checks.
    """
    names = {k: unused(f"__right_{i}", left, right) for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(names)
    pairs = [left[k] == right[r] for k, r in names.items()]
    spread = _spread([left[k] for k in keys]) == _spread([right[r] for r in names.values()])
    return left.join(right, all_of(pairs) & spread, how).drop(*names.values())


def key_counts(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows per key, combined on the map side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
