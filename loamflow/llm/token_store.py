"""Token ids on disk as compressed byte planes, with a chunk index.

Documents are dealt out by ranges of ``doc_id`` and sorted, so that the shards, one after the
other, hold them in ascending order (rows without an id first). Each task encodes its documents
and cuts the stream of ids into blocks of ``block_ids``. A block is transposed into its four byte
planes (all lowest bytes, all second bytes, ...), and each plane is compressed with zstandard: the
high planes are nearly constant and all but vanish.

A store is a folder with one Parquet row for each block. The row is its own index entry: shard,
number, first id within the shard, number of ids, the planes, and the documents that have
ids in it (id, first id within the shard, length, ids in this block). Readers prune to the index
columns or to a range of shards; blocks decode on their own. Files are written by Spark's
committed writer, so lost tasks are repeated.

Defined results: a null or empty text is the end id alone; rows that share a ``doc_id`` are stored
one after the other, by the hash of their text; columns other than ``doc_id`` and ``text`` are ignored; an empty
table gives an empty store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamflow.llm.base import ship, text_key, token_ids, whole_columns, with_offsets

PLANES = 4
STORE = (
    "shard long, block long, first long, n_ids long, planes array<binary>, "
    "docs array<struct<doc_no: long, doc_id: long, start: long, n_tokens: long, here: long>>"
)
_DOC = pa.struct([(n, pa.int64()) for n in ("doc_no", "doc_id", "start", "n_tokens", "here")])
_STORE = pa.schema([
    ("shard", pa.int64()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()),
    ("planes", pa.list_(pa.binary())), ("docs", pa.list_(_DOC)),
])
_PART = pa.schema([
    ("shard", pa.int64()), ("doc_no", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int64()),
    ("n_tokens", pa.int64()), ("block", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary()),
])


def to_planes(ids: bytes, level: int = 3) -> list[bytes]:
    """The four byte planes of little-endian 32-bit ids, each compressed."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=level).compress
    return [pack(p.tobytes()) for p in np.frombuffer(ids, np.uint8).reshape(-1, PLANES).T]


def from_planes(planes: list[bytes], n_ids: int) -> bytes:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    rows = [np.frombuffer(unpack(p, max_output_size=n_ids), np.uint8) for p in planes]
    return np.stack(rows, axis=1).tobytes()


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, block_ids: int = 1 << 17,
                shards: int | None = None) -> None:
    """Encode the documents and write their ids, in ascending ``doc_id`` order, to a new folder."""
    spark = docs.sparkSession
    ship(spark)
    end, size = end_id.to_bytes(4, "little"), 4 * block_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, shard = token_ids(tokenizer), TaskContext.get().partitionId()
        buffer, inside = bytearray(), []
        block = doc_no = first = position = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, first, inside
            row = (shard, block, first, len(buffer) // 4, to_planes(bytes(buffer)), inside)
            block, first, inside = block + 1, first + len(buffer) // 4, []
            buffer.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _STORE.types)], schema=_STORE)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = to_ids(text.as_py()) + end
                done, n = 0, len(ids) // 4
                while done < len(ids):
                    here = ids[done:done + size - len(buffer)]
                    inside.append((doc_no, doc_id, position, n, len(here) // 4))
                    buffer += here
                    done += len(here)
                    if len(buffer) == size:
                        yield flush()
                doc_no, position = doc_no + 1, position + n
        if buffer:
            yield flush()

    own = whole_columns(docs, "doc_id", "text")
    # The hash of the text lets a range end among rows that share an id, or have none.
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_key")]
    keyed = own.withColumn("text_key", text_key())
    by_range = keyed.repartitionByRange(shards, *order) if shards else keyed.repartitionByRange(*order)
    sorted_docs = by_range.sortWithinPartitions(*order).drop("text_key")
    sorted_docs.mapInArrow(encode, STORE).write.option("compression", "none").parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document in the store: doc_id, start among all ids, n_tokens, crc32 of its ids.

    Only documents that cross a block carry ids through the shuffle, to be joined up.
    """
    blocks = spark.read.schema(STORE).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, at, rows = from_planes(row["planes"], row["n_ids"]), 0, []
                for d in row["docs"]:
                    here = ids[at:at + 4 * d["here"]]
                    at += 4 * d["here"]
                    whole = d["here"] == d["n_tokens"]
                    rows.append((row["shard"], d["doc_no"], d["doc_id"], d["start"], d["n_tokens"], row["block"],
                                 zlib.crc32(here) if whole else None, None if whole else here))
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PART.types)], schema=_PART)

    ship(spark)
    parts = blocks.mapInArrow(
        decode, "shard long, doc_no long, doc_id long, first long, n_tokens long, block long, crc long, ids binary"
    )
    joined = parts.groupBy("shard", "doc_no").agg(
        F.max("doc_id").alias("doc_id"), F.max("first").alias("first"), F.max("n_tokens").alias("n_tokens"),
        F.max("crc").alias("crc"), F.sort_array(F.collect_list(F.when(F.col("crc").isNull(), F.struct("block", "ids"))))
        .alias("cut"),
    )
    ids = F.unhex(F.array_join(F.transform("cut", lambda c: F.hex(c["ids"])), ""))
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = with_offsets(sizes, "shard", "n", "before").select("shard", "before")
    return joined.join(before, "shard").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens",
        F.coalesce("crc", F.crc32(ids)).alias("ids_crc32"),
    )
