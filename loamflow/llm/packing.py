"""Hierarchical multi-length packing of tokenised documents.

Every document is encoded where it is read. Whole windows are cut off its front; the rest is
routed to the smallest context-size tier that holds it (512, 1024, 2048 or 4096 tokens). Each task
packs its tiers from the longest down: the longest waiting rest opens a window of its tier, and the
gap behind it is filled from the shorter tiers, best fit first; what no rest fits exactly is cut off
the shortest one. At the end of a task the last tokens, too few for a window of their tier, go into
windows of falling powers of two. Every window is thus full and nothing is padded.

Windows are then dealt into step groups of equal size: a group holds windows of one length and
``step_tokens`` tokens, so every training step costs the same; the last group of each length may
be short.

Nothing is shuffled but one count per task and window length. A task holds one pool of waiting
rests (``pool_tokens``) in memory, whatever its input. A lost task is packed again alone.

Defined results: a null or empty text is one piece with the end token; rows that share a
``doc_id`` (or have none) are packed one by one; columns other than ``doc_id`` and ``text`` are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamflow.llm.base import settle, ship, token_ids, whole_columns, with_offsets

WINDOW = 4096
TIERS = (512, 1024, 2048, 4096)
PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "window int, tier int, part long, nth long"
)


class Packer:
    """Packs the documents of one task; ``add`` and ``finish`` return rows of ``PIECE`` (with ids)."""

    def __init__(self, part: int, tiers: tuple[int, ...], pool_tokens: int):
        self.part, self.tiers, self.pool_tokens = part, tiers, pool_tokens
        self.rests: list[tuple[int, int]] = []  # (length, number of the rest), ascending
        self.data: dict[int, tuple] = {}  # by number: doc_id, start, ids, doc_tokens, tier
        self.waiting = self.numbers = self.sequences = 0
        self.nth: dict[int, int] = {}

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        size, longest = len(ids) // 4, self.tiers[-1]
        start = 0
        while size - start >= longest:
            yield from self._window(longest, [(doc_id, start, ids[4 * start:4 * (start + longest)], size, longest)])
            start += longest
        if start < size:
            tier = next(t for t in self.tiers if size - start <= t)
            self._wait((doc_id, start, ids[4 * start:], size, tier))
        if self.waiting > self.pool_tokens:
            # Half of the pool stays, so that there is always something to fill gaps with.
            yield from self._pack(self.pool_tokens // 2)

    def finish(self) -> Iterator[tuple]:
        yield from self._pack(self.tiers[-1])
        while self.waiting:
            yield from self._fill(1 << (self.waiting.bit_length() - 1))

    def _wait(self, rest: tuple) -> None:
        self.numbers += 1
        self.data[self.numbers] = rest
        insort(self.rests, (len(rest[2]) // 4, self.numbers))
        self.waiting += len(rest[2]) // 4

    def _pack(self, leave: int) -> Iterator[tuple]:
        while self.waiting >= max(leave, self.tiers[-1]):
            longest = self.rests[-1][0]
            yield from self._fill(next(t for t in self.tiers if longest <= t))

    def _fill(self, window: int) -> Iterator[tuple]:
        """One full window: the longest rest that fits, then the longest that fits the gap, ..."""
        gap, placed = window, []
        while gap:
            at = bisect_right(self.rests, (gap, self.numbers)) - 1
            length, number = self.rests.pop(max(at, 0))
            doc_id, start, ids, size, tier = self.data.pop(number)
            self.waiting -= length
            if length > gap:  # nothing fits: cut the shortest
                self._wait((doc_id, start + gap, ids[4 * gap:], size, tier))
                ids, length = ids[:4 * gap], gap
            placed.append((doc_id, start, ids, size, tier))
            gap -= length
        yield from self._window(window, placed)

    def _window(self, window: int, placed: list[tuple]) -> Iterator[tuple]:
        sequence, offset = (self.part << 36) + self.sequences, 0
        nth = self.nth.get(window, 0)
        self.sequences += 1
        self.nth[window] = nth + 1
        for doc_id, start, ids, size, tier in placed:
            length = len(ids) // 4
            yield (doc_id, start, length, zlib.crc32(ids), size, sequence, offset, window, tier, self.part, nth, ids)
            offset += length


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 2, tiers: tuple[int, ...] = TIERS,
    step_tokens: int = 1 << 20, pool_tokens: int = 1 << 21, with_ids: bool = False,
) -> DataFrame:
    """Pieces of the documents with their place in full windows, and the step group of the window.

    ``tiers`` are ascending powers of two, the last one being the context size; ``step_tokens`` is
    a multiple of it. ``with_ids`` adds the token ids (little-endian unsigned 32-bit integers).
    """
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)):
        raise ValueError(f"tiers must be ascending powers of two: {tiers}")
    if step_tokens % tiers[-1]:
        raise ValueError("step_tokens must be a multiple of the longest tier")
    schema = PIECE + (", ids binary" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.binary() if n == "ids" else pa.int32() if n in ("window", "tier") else pa.int64() for n in names]
    end = end_id.to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_ids(tokenizer)
        packer = Packer(TaskContext.get().partitionId(), tiers, pool_tokens)
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows))[: len(names)]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows.extend(packer.add(doc_id, encode(text.as_py()) + end))
                if len(rows) >= 2000:
                    yield out()
        for row in packer.finish():
            rows.append(row)
            if len(rows) >= 2000:
                yield out()
        if rows:
            yield out()

    ship(docs.sparkSession)
    placed = settle(whole_columns(docs, "doc_id", "text").mapInArrow(pack, schema), "packed")
    # How many windows of its length come before those of a task: one row for each task and length.
    counts = placed.groupBy("window", "part").agg((F.max("nth") + 1).alias("n"))
    order = F.log2("window").cast("long") * F.lit(1 << 40) + F.col("part")
    all_before = with_offsets(counts.withColumn("order", order), "order", "n", "all_before")
    firsts = all_before.groupBy("window").agg(F.min("all_before").alias("first"))
    before = all_before.join(firsts, "window").withColumn("before", F.col("all_before") - F.col("first"))
    grouped = placed.join(before.select("window", "part", "before"), ["window", "part"])
    group = F.floor((F.col("before") + F.col("nth")) * F.col("window") / F.lit(step_tokens)).cast("long")
    return grouped.select(*names[:9], group.alias("step_group"), *names[11:])
