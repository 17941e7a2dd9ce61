"""Sessions: rows of a key with less than a gap between neighbours, also for a key that holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sessions(df: DataFrame, keys: Sequence[str], at: str, gap_seconds: int, sums: Sequence[str] = (),
             width_seconds: int | None = None) -> DataFrame:
    """One row for each session: keys, ``session_start``, ``session_end`` (its first and last row), ``n_rows`` and sums.

    A row ``gap_seconds`` or more after the one before it starts a session. Rows are first put into sessions within stretches of
    ``width_seconds`` (at least the gap; a hundred gaps unless given), each a group of its own; what is left of a stretch then is
    its first and last session, and a window over one row for each stretch finds which first sessions go on from an earlier
    stretch. So a task holds a key's rows in one stretch, not all of them. Rows without a time are in no session; NULL keys
    are a key like any other.
    """
    width = max(gap_seconds, width_seconds or 100 * gap_seconds)
    gap, micros = F.lit(gap_seconds * 1_000_000), 1_000_000
    key = [F.col(k) for k in keys]
    time = F.unix_micros(F.col(at).cast("timestamp"))
    rows = df.filter(F.col(at).isNotNull()).select(
        *key, time.alias("_at"), F.floor(time / (width * micros)).cast("long").alias("_stretch"),
        *[F.col(c).alias(f"_sum_{i}") for i, c in enumerate(sums)],
    )
    # Equal times are one row before anything is ordered.
    totals = [F.sum(f"_sum_{i}").alias(f"_sum_{i}") for i in range(len(sums))]
    rows = rows.groupBy(*keys, "_stretch", "_at").agg(F.count(F.lit(1)).alias("_n"), *totals)
    inside = Window.partitionBy(*keys, "_stretch").orderBy("_at")
    before = F.lag("_at").over(inside)
    started = rows.withColumn("_start", F.when(before.isNull() | (F.col("_at") - before >= gap), F.col("_at")))
    started = started.withColumn("_start", F.last("_start", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    merge: list[Column] = [F.max("_end").alias("_end"), F.sum("_n").alias("_n"), *totals]
    parts = started.groupBy(*keys, "_stretch", "_start").agg(F.max("_at").alias("_end"), F.sum("_n").alias("_n"), *totals)
    ends = parts.groupBy(*keys, "_stretch").agg(
        F.min("_start").alias("_first"), F.max("_start").alias("_last"), F.max("_end").alias("_until")
    )
    along = Window.partitionBy(*keys).orderBy("_stretch")
    previous = F.lag("_until").over(along)
    ends = ends.withColumn("_goes_on", F.coalesce(F.col("_first") - previous < gap, F.lit(False)))
    # Start of the session that is open when a stretch ends; NULL if it came in with the stretch.
    opened = F.when(F.col("_first") < F.col("_last"), F.col("_last")).when(~F.col("_goes_on"), F.col("_first"))
    ends = ends.withColumn("_opened", opened)
    ends = ends.withColumn("_opened", F.last("_opened", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    ends = ends.withColumn("_root", F.when(F.col("_goes_on"), F.lag("_opened").over(along)).otherwise(F.col("_first")))
    linked = ends.filter("_goes_on").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                                            F.col("_first").alias("_of"), "_root")
    same = F.col("_start") == F.col("_of")
    for i, k in enumerate(keys):
        same = same & parts[k].eqNullSafe(F.col(f"_k{i}"))
    whole = parts.join(linked, same, "left").withColumn("_begin", F.coalesce("_root", "_start"))
    out = whole.groupBy(*keys, "_begin").agg(*merge)
    return out.select(
        *keys, F.timestamp_micros("_begin").cast("timestamp_ntz").alias("session_start"),
        F.timestamp_micros("_end").cast("timestamp_ntz").alias("session_end"), F.col("_n").alias("n_rows"),
        *[F.col(f"_sum_{i}").alias(c) for i, c in enumerate(sums)],
    )
