"""Two-pass external shuffle of whole records into shards of equal row counts.

Pass one scatters the records uniformly over buckets by a seeded hash of their place in the scan
(not of their content, so equal rows spread too); the number of buckets follows from the bytes, so
a bucket fits in memory. Pass two shuffles each bucket by Fisher-Yates (Spark's seeded ``shuffle``
of an array in a fixed start order) and writes it to the shared folder. The buckets in order are
one uniform permutation of the table; it is cut into shards whose row counts differ by one at most.

Native throughout: one shuffle of the records, one write. Bucket counts are the only other state:
one row for each bucket, sent to the tasks while there are at most ``BROADCAST_BUCKETS`` of them.

Defined results: the record keeps every column (in a struct, so no name can clash); a null text has
no bytes; rows that share a ``doc_id``, equal rows and rows without an id are records of their own;
an empty table gives no rows; with fewer rows than shards some shards are empty.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamflow.llm.base import settle, with_offsets

#: A row of the bucket offsets has two numbers; this many are at most 16 MB.
BROADCAST_BUCKETS = 1 << 20


def shuffle_into_shards(docs: DataFrame, shards: int = 16, seed: int = 17, bucket_bytes: int = 4 << 20) -> DataFrame:
    """``doc`` (all columns), ``size``, ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in its shard)."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    total = docs.agg(F.sum(size)).first()[0] or 0
    n_buckets = max(1, math.ceil(total / bucket_bytes))
    records = docs.select(F.struct("*").alias("doc"), size.alias("size"), F.monotonically_increasing_id().alias("at"))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "at"), F.lit(n_buckets))
    gathered = records.groupBy(bucket.alias("bucket")).agg(
        F.sort_array(F.collect_list(F.struct("at", "size", "doc"))).alias("records")
    )
    shuffled = gathered.select("bucket", F.posexplode(F.shuffle("records", seed)).alias("place", "record"))
    written = settle(shuffled.select("bucket", "place", "record.size", "record.doc"), "shuffled")
    counts = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = with_offsets(counts, "bucket", "n", "before").select("bucket", "before")
    if n_buckets <= BROADCAST_BUCKETS:
        before = F.broadcast(before)
    n_rows, at = written.count(), F.col("before") + F.col("place")
    shard = F.expr(f"(before + place) * {shards} div {max(n_rows, 1)}")
    first = F.expr(f"(shard * {n_rows} + {shards - 1}) div {shards}")
    return written.join(before, "bucket").withColumn("shard", shard).select(
        "doc", "size", F.col("shard").cast("int").alias("shard"), (at - first).alias("slot")
    )


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder for each shard with its records in slot order."""
    parts = shuffled.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    parts.write.partitionBy("shard").parquet(path)
