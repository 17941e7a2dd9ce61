"""Load strategies as functions of (target, incoming) -> new target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loamflow.operators.joins import all_of, any_of, lookup_join, unused


def overwrite(target: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Rows and schema are those of ``incoming``."""
    return incoming


def merged_schema(old: StructType, new: StructType) -> StructType:
    """``old`` plus the columns only ``new`` has; a changed type is an error."""
    known = {f.name: f.dataType for f in old}
    for field in new:
        if field.name in known and known[field.name] != field.dataType:
            raise ValueError(
                f"append would change the type of {field.name!r}: "
                f"{known[field.name].simpleString()} -> {field.dataType.simpleString()}"
            )
    return StructType(list(old) + [f for f in new if f.name not in known])


def append(target: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Rows of both, matched by column name; columns missing on one side are NULL there."""
    if target is None:
        return incoming
    merged_schema(target.schema, incoming.schema)
    return target.unionByName(incoming, allowMissingColumns=True)


def key_names(keys: Sequence[str], df: DataFrame, side: str) -> list[str]:
    """The key columns as ``df`` spells them; names match in any letter case."""
    if not keys:
        raise ValueError("merge requires at least one key column")
    known = {c.lower(): c for c in df.columns}
    missing = [k for k in keys if k.lower() not in known]
    if missing:
        raise ValueError(f"key columns {missing} are not in the merge {side}")
    return [known[k.lower()] for k in keys]


def _require_keys(keys: Sequence[str], target: DataFrame, source: DataFrame) -> list[str]:
    key_names(keys, source, "source")
    return key_names(keys, target, "target")


def _conform(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source`` with the target's names and types, restricted to the columns both have."""
    known = {c.lower() for c in source.columns}
    return source.select(*[
        F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.schema if f.name.lower() in known
    ])


def _per_key(source: DataFrame, keys: Sequence[str], columns: Sequence[str], new: str, count: str) -> DataFrame:
    """One row per key: in ``count`` how many source rows there are, and in ``new`` one of them."""
    return source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count),
        F.first(F.struct(*columns)).alias(new),
    )


def _single_match(keys: Sequence[str], count: str) -> Column:
    # Used as a filter: in a projected column the check would be pruned away by count().
    message = f"several source rows match one target row on ({', '.join(keys)})"
    ambiguous = F.col(count).isNotNull() & (F.col(count) > 1)
    return F.when(ambiguous, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))


def _look_up(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str], new: str) -> DataFrame:
    """Target rows with the ``columns`` of their source row as a struct ``new``, NULL where there is none.

    Whether the source repeats a key is found out first, by a count over its key columns alone. If not,
    which is the rule, it is joined as it is: two shuffles, both straight into the join, so that adaptive
    execution can split a hot target key. If so, it is combined to one row per key on the way, and
    a repeated key that a target row has is an error. The source is read twice and must not change in between.
    """
    known = all_of([F.col(k).isNotNull() for k in keys])
    count = unused("__matches", target, source)
    repeated = source.filter(known).groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)
    if not repeated.isEmpty():
        joined = lookup_join(target, _per_key(source, keys, columns, new, count), list(keys), "left")
        return joined.filter(_single_match(keys, count)).drop(count)
    names = [unused(f"__right_{i}", target, source) for i in range(len(keys))]
    right = source.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.struct(*columns).alias(new))
    return target.join(right, all_of([target[k] == right[n] for k, n in zip(keys, names)]), "left").drop(*names)


def update_matched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows, with every non-key column of ``source`` taken over where the keys match.

    NULLs in the source overwrite. NULL keys never match. Source columns must exist in the
    target; target columns the source lacks stay as they are. More than one source row for an
    existing target row is an error.
    """
    keys = _require_keys(keys, target, source)
    known = {c.lower() for c in target.columns}
    unknown = [c for c in source.columns if c.lower() not in known]
    if unknown:
        raise ValueError(f"merge does not add columns to the target: {unknown}")
    source = _conform(source, target)
    values = [c for c in source.columns if c not in keys]
    if not values:
        return target
    new = unused("__new", target)
    return _look_up(target, source, keys, values, new).select(*[
        F.when(F.col(new).isNotNull(), F.col(new)[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in target.columns
    ])


def unmatched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows without a target row of the same key, duplicates and NULL keys included.

    Of the target only the key columns are read, combined to one row per key before they are shuffled.
    """
    return lookup_join(source, target.select(*keys).distinct(), list(keys), "left_anti")


def merge_upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update rows whose keys match, insert the others, keep rows only the target has.

    Hot keys of either side are split by adaptive execution (see ``lookup_join``).
    """
    if target is None:
        if not keys:
            raise ValueError("merge requires at least one key column")
        return source
    keys = _require_keys(keys, target, source)
    given = {c.lower() for c in source.columns}
    missing = [c for c in target.columns if c.lower() not in given]
    if missing:
        raise ValueError(f"merge source lacks target columns: {missing}")
    updated = update_matched(target, source, keys)
    return updated.unionByName(unmatched(target, _conform(source, target), keys))


HISTORY_COLUMNS = ("valid_from", "valid_to", "is_current")


def start_history(source: DataFrame, as_of: Column) -> DataFrame:
    """Every row as an open version that starts at ``as_of``."""
    start = as_of.cast("timestamp_ntz")
    return source.select(
        "*",
        start.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def _unopened(opened: DataFrame, source: DataFrame, keys: Sequence[str], data: Sequence[str]) -> DataFrame:
    """Source rows that have to open a version: of a key without one, or with a NULL key and not open as they are."""
    keyed = all_of([F.col(k).isNotNull() for k in keys])
    same = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(data)])  # structs are equal if their NULLs are
    name = "_same"
    while name in {c.lower() for c in data}:
        name += "_"
    without = opened.filter(~keyed).select(same.alias(name)).distinct()
    nameless = lookup_join(source.filter(~keyed).withColumn(name, same), without, [name], "left_anti")
    return unmatched(opened, source.filter(keyed), keys).select(*data).unionByName(nameless.select(*data))


def scd2_history(history: DataFrame | None, source: DataFrame, keys: Sequence[str], as_of: Column) -> DataFrame:
    """Versioned history: a changed row closes its open version and opens a new one.

    Unchanged rows, closed versions and keys the source does not mention stay as they are. The
    source must hold at most one row per key that is already open. A row with a NULL key has no predecessor to
    close; it opens a version unless the same row, NULLs included, is open already.
    """
    if not keys:
        raise ValueError("scd2 requires at least one key column")
    if history is None:
        return start_history(source, as_of)
    keys = _require_keys(keys, history, source)
    data = [c for c in history.columns if c not in HISTORY_COLUMNS]
    if sorted(c.lower() for c in data) != sorted(c.lower() for c in source.columns):
        raise ValueError("scd2 source and history must have the same data columns")
    values = [c for c in data if c not in keys] or list(keys)
    source = _conform(source, history)
    opened = history.filter("is_current")
    new = unused("__new", history)
    looked_up = _look_up(opened, source, keys, values, new)
    differs = F.col(new).isNotNull() & any_of([~F.col(c).eqNullSafe(F.col(new)[c]) for c in values])
    start = as_of.cast("timestamp_ntz")
    before = F.struct(
        *data,
        "valid_from",
        F.when(differs, start).otherwise(F.col("valid_to")).alias("valid_to"),
        (~differs).alias("is_current"),
    )
    after = F.struct(
        *[F.col(new)[c].alias(c) if c in values else F.col(c) for c in data],
        start.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    # A closed version and its successor come out of the same looked-up row.
    versions = looked_up.select(F.inline(F.when(differs, F.array(before, after)).otherwise(F.array(before))))
    closed = history.filter("NOT is_current OR is_current IS NULL")
    fresh = start_history(_unopened(opened, source, keys, data), as_of)
    order = history.columns
    return closed.unionByName(versions.select(order)).unionByName(fresh.select(order))


#: A compacted file is the work of one task. Packing streams the rows: a file is a read split of Spark's. Sorting
#: holds them unpacked, about ten times the size of the file.
PACKED_BYTES, SORTED_BYTES = 128 << 20, 32 << 20


def files_for(size: int, cluster_by: Sequence[str] = (), file_bytes: int | None = None) -> int:
    """How many files ``size`` bytes are compacted into, so that what a task reads or sorts does not grow with the table."""
    return max(1, -(-size // (file_bytes or (SORTED_BYTES if cluster_by else PACKED_BYTES))))


def compact(df: DataFrame, partitions: int, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Same rows in fewer, larger files.

    Without ``cluster_by`` neighbouring input splits are simply packed together: no shuffle.
    With it the rows are range-partitioned, so that filters on those columns skip files; the row
    position breaks ties, so that one frequent value spreads over several files.
    """
    if cluster_by:
        tie = F.monotonically_increasing_id().alias("__tie")
        ranged = df.select("*", tie).repartitionByRange(partitions, *cluster_by, "__tie")
        return ranged.sortWithinPartitions(*cluster_by).drop("__tie")
    return df.coalesce(partitions)
