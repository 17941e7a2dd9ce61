"""Near-duplicates by SimHash, found through a grid over segment popcounts.

A fingerprint has 64 bits; bit i is set if it is set in over half of the XXH64 hashes (seed 42) of the
text's word shingles. Two fingerprints link if they differ in at most two bits.

Links are searched among distinct fingerprints. A fingerprint is cut into 32 segments of 2 bits and
mapped to its 32 bit counts, a point of a small grid. The Manhattan distance of two points is a lower
bound of the Hamming distance, so linked fingerprints lie within distance 2 and some grid cell lies
within distance 1 of both. Each point is put into all cells within distance 1 of it (65 at most); only
fingerprints that meet another one in a cell are candidates. These are verified exactly, without
emitting pairs: two fingerprints differ in at most two bits just if some word differs in at most
one bit from each, so each candidate names the 65 words around it and all that meet at a word are
linked to the smallest of them. A group of n near copies thus costs 65 n rows, not n squared. There is
no cap on cells. The links are settled into components by alternating star contractions.

Defined results: a text without words (null or empty included) has fingerprint zero and is linked
like any other; the component of a document is named by the smallest ``doc_id`` in it (ids that
are null are passed over); rows equal in ``doc_id`` and text are the same document; columns
besides those two are kept by ``drop_near_duplicates`` and ignored otherwise; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamflow.llm import near_copies
from loamflow.llm.base import count_ones, fresh, majority, pieces, release, settle, ship, text_key, whole_columns
from loamflow.llm.links import components

SEED, SHINGLE = 42, 3
SEGMENTS, SEGMENT_BITS = 32, 2
_HALF = (1 << 32) - 1


def fingerprint(text: str | None) -> int:
    """SimHash of a whole text as an unsigned number."""
    from xxhash import xxh64_intdigest

    ones, n, tail = np.zeros(64, np.int64), 0, []
    for piece in pieces(text or ""):
        words = tail + piece.encode().lower().split()  # on bytes: only A-Z change, only ASCII blanks split
        tail = words[-(SHINGLE - 1):]
        if len(words) >= SHINGLE:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-SHINGLE] + 1)).tolist()
            n += len(starts)
            hashes = [xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1:].tolist())]
            ones += count_ones(np.array(hashes, np.uint64))
    if not n and tail:
        n, ones = 1, count_ones(np.array([xxh64_intdigest(b" ".join(tail), SEED)], np.uint64))
    return majority(ones, n)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, fingerprint (signed) of every document, settled."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("fingerprint", pa.int64())])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py()) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values)], schema=schema)

    ship(docs.sparkSession)
    own = whole_columns(docs, "doc_id", "text").select("doc_id", text_key().alias("text_key"), "text")
    return settle(own.mapInArrow(compute, "doc_id long, text_key long, fingerprint long"), "fingerprints")


def grid_cell(fp: Column) -> Column:
    """The 32 bit counts of a fingerprint, each in two bits. In halves, for the sign's sake."""

    def counts(half: Column) -> Column:
        odd = F.lit(0x55555555)
        return half.bitwiseAND(odd) + F.shiftrightunsigned(half, 1).bitwiseAND(odd)

    high, low = F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(_HALF))
    return F.shiftleft(counts(high), 32).bitwiseOR(counts(low))


def cells_around(cell: Column) -> Column:
    """The cells within Manhattan distance 1: a count of 0 can rise, 2 can fall, 1 can do both."""
    around = [cell]
    for at in range(0, SEGMENTS * SEGMENT_BITS, SEGMENT_BITS):
        count = F.shiftrightunsigned(cell, at).bitwiseAND(F.lit(3))
        between_0_and_1 = cell.bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), at))
        between_1_and_2 = cell.bitwiseXOR(F.shiftleft(F.lit(3).cast("long"), at))
        around += [F.when(count < 2, between_0_and_1), F.when(count > 0, between_1_and_2)]
    return F.array_compact(F.array(*around))


def words_around(fp: Column) -> Column:
    """The 64-bit words within Hamming distance 1."""
    return F.array(fp, *[fp.bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), i)) for i in range(64)])


def _meeting(spread: DataFrame, key: str) -> DataFrame:
    """fp and the smallest ``fp`` it meets at a key, for keys that hold several."""
    groups = spread.groupBy(key).agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
    # Spark does not see that the spread side is many times its input: it must not be broadcast.
    shared = groups.filter(F.col("least") < F.col("most")).hint("merge")
    return spread.join(shared, key).select("fp", "least")


def _spread_out(rows: DataFrame) -> DataFrame:
    """Rows that are about to become many, in as many tasks as there are shuffle partitions, whatever files they lie in."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")


def links(distinct: DataFrame) -> DataFrame:
    """Edges (u, v), v < u, that connect all ``fp`` within two bits of each other."""
    at = distinct.withColumn("cell", grid_cell(F.col("fp")))
    gridded = _spread_out(at).select("fp", F.explode(cells_around(F.col("cell"))).alias("cell"))
    candidates = settle(_meeting(gridded, "cell").select("fp").distinct(), "candidates")
    worded = _spread_out(candidates).select("fp", F.explode(words_around(F.col("fp"))).alias("word"))
    met = _meeting(worded, "word").filter(F.col("fp") > F.col("least"))
    return met.select(F.col("fp").alias("u"), F.col("least").alias("v")).distinct()


def rooted(prints: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """fp and root of every distinct fingerprint, linked at two bits or by ``edges`` (u, v)."""
    distinct = settle(prints.select(F.col("fingerprint").alias("fp")).distinct(), "distinct-fingerprints")
    roots = components(links(distinct) if edges is None else edges)
    return distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document."""
    prints = fingerprints(docs)
    firsts = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    members = settle(rooted(prints).join(firsts, F.col("fp") == F.col("fingerprint")).select("fp", "root", "first"), "members")
    named = members.join(members.groupBy("root").agg(F.min("first").alias("component_id")), "root")
    return prints.join(named, prints.fingerprint == named.fp).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, similarity: float | None = None) -> DataFrame:
    """The documents, all columns, without all but one of each component: the one with the smallest id.

    With ``similarity``, documents link by the Jaccard similarity of their 5-word shingles: those that the grid finds within
    two bits are compared, and those that ``near_copies.py`` finds beyond.
    """
    if similarity is None:
        prints, edges = fingerprints(docs), None
    else:
        prints = near_copies.prints(docs)
        close = settle(links(settle(prints.select(F.col("simhash").alias("fp")).distinct(), "distinct-fingerprints")), "close")
        release(docs.sparkSession, [])  # the shuffled cells and words, before the bands are shuffled
        edges = near_copies.links(docs, prints, similarity, close)
    name = F.struct("doc_id", "text_key")
    firsts = prints.filter(F.col("doc_id").isNotNull()).groupBy("fingerprint").agg(F.min(name).alias("first"))
    lone = prints.groupBy("fingerprint").agg(F.min(name).alias("any"))
    firsts = lone.join(firsts, "fingerprint", "left").select("fingerprint", F.coalesce("first", "any").alias("first"))
    members = rooted(prints, edges).join(firsts, F.col("fp") == F.col("fingerprint"))
    members = settle(members.select("fp", "root", "first"), "members")
    # Named documents go before those without an id.
    by_rank = F.min_by("first", F.struct(F.col("first.doc_id").isNull(), "first"))
    kept = members.groupBy("root").agg(by_rank.alias("kept"))
    named = members.join(kept, "root").select("fp", "kept")
    gone = prints.join(named, prints.fingerprint == named.fp).filter(~F.struct("doc_id", "text_key").eqNullSafe(F.col("kept")))
    of, key = fresh(docs, "gone_id"), fresh(docs, "gone_key")
    gone = gone.select(F.col("doc_id").alias(of), F.col("text_key").alias(key)).distinct()
    known = {c.lower(): c for c in docs.columns}
    same = docs[known["doc_id"]].eqNullSafe(F.col(of)) & (F.xxhash64(docs[known["text"]]) == F.col(key))
    left = docs.join(gone, same, "left_anti")
    if prints.groupBy("doc_id", "text_key").count().filter("count > 1").limit(1).isEmpty():
        return left
    return left.withColumn(key, F.xxhash64(known["text"])).dropDuplicates([known["doc_id"], key]).drop(key)
