"""Benchmark decontamination by winnowing.

Every run of ``WINDOW`` (10) consecutive words that a document shares with a benchmark item is found.
From the 5-word hashes of a text, the smallest of each 6 neighbours is kept (all that tie); any shared run
of 10 words holds 6 such hashes, so both sides keep the same one in it: that is the guarantee.
Kept hashes of documents are joined with those of the benchmark, and each hit is extended word by word
to both sides; only runs of 10 equal words or more count, so the result is exact. Items with fewer words
are one window and are looked up by the hash of all their words, then compared.

The benchmark is the small side: it goes to the tasks in blocks of about ``block_bytes`` of text, and
documents are matched where they lie, without a shuffle. With one block (the usual case) that is one
pass; a larger benchmark takes a pass for each block, with what was found so far written to the shared
folder in between.

Defined results: a null or empty text has no words and no hits, and such items no windows; items that share
an ``item_id`` are one item with several texts; a null ``item_id`` reads "null"; rows that share a ``doc_id``
are matched one by one; columns besides those named are kept by ``drop_contaminated`` and
ignored otherwise; empty tables give no rows, an empty benchmark no hits.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamflow.llm.base import pieces, settle, ship, whole_columns

WINDOW, GRAM = 10, 5
SPAN = WINDOW - GRAM + 1  # hashes in a window
#: Bytes of a text as words: A-Z in lower case, digits, letters and all beyond ASCII kept, the rest blanks.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


def gram_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` ids."""
    single = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    n = len(ids) - size + 1
    out = single[:n].copy()
    for k in range(1, size):
        out = out * _STEP + single[k:k + n]
    out ^= out >> np.uint64(31)
    return out * _MIX


def winnowed(hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes that are the smallest of some ``SPAN`` neighbours."""
    n = len(hashes) - SPAN + 1
    if n < 1:
        return np.zeros(0, np.int64)
    least = hashes[:n].copy()
    for k in range(1, SPAN):
        np.minimum(least, hashes[k:k + n], out=least)
    kept = np.zeros(len(hashes), bool)
    for k in range(SPAN):
        kept[k:k + n] |= hashes[k:k + n] == least
    return np.flatnonzero(kept)


class Index:
    """Words, kept hashes and texts of one block of the benchmark."""

    def __init__(self, items: list[tuple[str, str]]):
        self.vocabulary: dict[bytes, int] = {}
        flat, owners, hashes, places = [np.full(WINDOW, -1, np.int64)], [np.full(WINDOW, -1, np.int64)], [], []
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        shorts: dict[int, list[tuple[np.ndarray, int]]] = {}
        at = WINDOW
        for name, text in items:
            found = words(text)
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found], np.int64)
            if len(ids) >= WINDOW:
                own = gram_hashes(ids, GRAM)
                kept = winnowed(own)
                hashes.append(own[kept])
                places.append(kept + at)
                flat += [ids, np.full(WINDOW, -1, np.int64)]
                owners += [np.full(len(ids) + WINDOW, number[name], np.int64)]
                at += len(ids) + WINDOW
            elif len(ids):
                shorts.setdefault(len(ids), []).append((ids, number[name]))
        self.flat, self.owners = np.concatenate(flat), np.concatenate(owners)
        self.hashes, self.starts, self.places = _grouped(hashes, places)
        self.shorts = {}
        for size, own in shorts.items():
            table = np.stack([ids for ids, _ in own])
            hashed = [gram_hashes(row, size) for row in table]
            self.shorts[size] = (table, np.array([n for _, n in own]), *_grouped(hashed, [np.array([i]) for i in range(len(own))]))

    def match(self, ids: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Which words are hit, and by which items, in a text given as ids of this vocabulary (0: none)."""
        hit, items = np.zeros(len(ids), bool), set()
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        if len(ids) >= WINDOW and len(self.hashes) and (known[WINDOW:] - known[:-WINDOW] == WINDOW).any():
            hashes = gram_hashes(ids, GRAM)
            kept = winnowed(hashes)
            kept = kept[known[kept + GRAM] - known[kept] == GRAM]
            padded = np.concatenate((np.zeros(WINDOW, np.int64), ids, np.zeros(WINDOW, np.int64)))
            for here, there in _pairs(kept, hashes[kept], self.hashes, self.starts, self.places):
                reach = np.arange(-SPAN + 1, WINDOW)
                equal = padded[(here + WINDOW)[:, None] + reach] == self.flat[there[:, None] + reach]
                inside = SPAN - 1
                sure = equal[:, inside:inside + GRAM].all(1)
                left = np.logical_and.accumulate(equal[:, inside - 1::-1], axis=1).sum(1)
                right = np.logical_and.accumulate(equal[:, inside + GRAM:], axis=1).sum(1)
                long = sure & (left + GRAM + right >= WINDOW)
                steps = np.zeros(len(ids) + 1, np.int64)
                np.add.at(steps, (here - left)[long], 1)
                np.add.at(steps, (here + GRAM + right)[long], -1)
                hit |= np.cumsum(steps)[:-1] > 0
                items.update(self.owners[there[long]].tolist())
        for size, (table, owners, hashes, starts, places) in self.shorts.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(at):
                continue
            for here, there in _pairs(at, gram_hashes(ids, size)[at], hashes, starts, places):
                same = (ids[here[:, None] + np.arange(size)] == table[there]).all(1)
                for k in range(size):
                    hit[here[same] + k] = True
                items.update(owners[there[same]].tolist())
        return hit, items


def _grouped(hashes: list[np.ndarray], places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, where the places of each begin, and the places."""
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int64)
    flat, at = np.concatenate(hashes), np.concatenate(places)
    order = np.argsort(flat, kind="stable")
    distinct, starts = np.unique(flat[order], return_index=True)
    return distinct, np.append(starts, len(flat)), at[order]


def _pairs(at: np.ndarray, hashes: np.ndarray, known: np.ndarray, starts: np.ndarray, places: np.ndarray,
           chunk: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the text with all places of the same hash in the benchmark, in chunks."""
    found = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    at, found = at[known[found] == hashes], found[known[found] == hashes]
    counts = starts[found + 1] - starts[found]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    for first in range(0, total, chunk):
        k = np.arange(first, min(first + chunk, total))
        row = np.searchsorted(ends, k, side="right")
        yield at[row], places[starts[found[row]] + (k - (ends[row] - counts[row]))]


_INDEX: dict[str, Index] = {}


def _index(name: str, block: Broadcast) -> Index:
    """The worker's index of a block; one is held at a time."""
    if name not in _INDEX:
        _INDEX.clear()
        _INDEX[name] = Index(block.value)
    return _INDEX[name]


def find(index: Index, text: str | None) -> tuple[int, np.ndarray, set[int]]:
    """Number of words, which are hit, and the items."""
    ids = [
        np.fromiter(map(index.vocabulary.get, found, repeat(0)), np.int64, len(found))
        for piece in pieces(text or "") for found in [words(piece)]
    ]
    ids = ids[0] if len(ids) == 1 else np.concatenate(ids)
    hit, items = index.match(ids) if index.vocabulary else (np.zeros(len(ids), bool), set())
    return len(ids), hit, items


def _spans(hit: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    return [{"start": int(a), "length": int(b - a)} for a, b in zip(edges[::2], edges[1::2])]


def blocks(bench: DataFrame, block_bytes: int) -> Iterator[tuple[list[tuple[str, str]], bool]]:
    """The benchmark, repeated rows dropped, as lists of item and text of about ``block_bytes`` at most; whether it is the last."""
    own = whole_columns(bench, "item_id", "text").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    own = settle(own.distinct(), "benchmark")
    total = own.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for block in range(n):
        yield [tuple(r) for r in (own.filter(place == block) if n > 1 else own).collect()], block == n - 1


def match(docs: DataFrame, bench: DataFrame, block_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, n_words, hits (spans of hit words: start and length) and items of every document."""
    spark = docs.sparkSession
    ship(spark)
    hits = "array<struct<start: long, length: long>>"
    fields = f"doc_id long, text string, n_words long, hits {hits}, items array<string>"
    state = whole_columns(docs, "doc_id", "text").select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_words"), F.array().cast(hits).alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    span = pa.struct([("start", pa.int64()), ("length", pa.int64())])
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("hits", pa.list_(span)),
        ("items", pa.list_(pa.string())),
    ])
    for items, last in blocks(bench, block_bytes):
        shared, name = spark.sparkContext.broadcast(items), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], name=name, shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            index = _index(name, shared)
            for batch in batches:
                counts, spans, names = [], [], []
                for text, before, held in zip(batch.column(1), batch.column(3), batch.column(4)):
                    n, hit, found = find(index, text.as_py())
                    for s in before.as_py():
                        hit[s["start"]:s["start"] + s["length"]] = True
                    counts.append(n)
                    spans.append(_spans(hit) if hit.any() else [])
                    names.append(sorted({*held.as_py(), *(index.names[i] for i in found)}))
                texts = pa.nulls(batch.num_rows, pa.string()) if last else batch.column(1).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), texts, pa.array(counts, pa.int64()), pa.array(spans, schema.types[3]),
                     pa.array(names, schema.types[4])], schema=schema,
                )

        state = state.mapInArrow(run, fields)
        if not last:
            state = settle(state, "decontaminated")
            shared.destroy()
    return state.drop("text")


def drop_contaminated(docs: DataFrame, bench: DataFrame, block_bytes: int = 32 << 20) -> DataFrame:
    """The documents, all columns, without a hit. Rows are filtered where they lie."""
    spark = docs.sparkSession
    ship(spark)
    at = [c.lower() for c in docs.columns].index("text")
    for items, last in blocks(bench, block_bytes):
        shared, name = spark.sparkContext.broadcast(items), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], name=name, shared=shared) -> Iterator[pa.RecordBatch]:
            index = _index(name, shared)
            for batch in batches:
                yield batch.filter(pa.array([not find(index, t.as_py())[1].any() for t in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if not last:
            docs = settle(docs, "decontaminated")
            shared.destroy()
    return docs
