"""Periodic stretches of words (runs), from the maximal pairs of each text.

A run is a stretch of words with smallest period q (words q apart are equal), of at least ``MIN_WORDS`` words and ``TIMES``
periods, that no word next to it extends. The first and the second word of its period begin a maximal pair: two places
from which the same words follow, and differ behind (right-maximal) and in front (left-maximal). A run of L words is a
pair at distance q with L - q words in common, so the pairs whose distance and common length satisfy
length >= (TIMES - 1) * distance and length + distance >= MIN_WORDS are the runs, and nothing has to be extended. Distances
that are several periods give the same stretch; the smallest stays.

Pairs come out of the LCP-interval tree of a text's suffixes, bottom up: suffixes are sorted by prefix doubling, their common
lengths read from the ranks, and intervals joined from the longest common length down. The occurrences in an interval
are held in the order of their places, each with its class, the word on its left; where two children join, a
place is held against its neighbours of the other child, and those of another class are maximal pairs. Neighbours are
enough: two places of a run that start its first two periods have no occurrence of what they share between them, or the
period would be smaller. So no pairs of a group are listed, and the smaller child is always moved into the larger.

No pair with fewer than ``_LEAST`` common words can satisfy the conditions. So only places whose next so many words occur
again in the text take part; which those may be is told by a hash of these words, for many texts at a time, and a text without is done.

Defined results: a null text is like an empty one, which has no words and no run; rows are worked on one by one, so repeated
rows and ids stay as they are; words are what stands between ASCII blanks; columns besides ``doc_id`` and ``text`` are left
behind; empty tables give no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loamflow.llm.base import ship, whole_columns

MIN_WORDS, TIMES = 24, 3
#: common >= (TIMES - 1) * distance and common + distance >= MIN_WORDS.
_LEAST = -(-MIN_WORDS * (TIMES - 1) // TIMES)
#: Texts are hashed together up to so many words.
_TOGETHER = 200_000
#: A list of places longer than this is held in several.
_BLOCK = 4096
_FOUND = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("collapsed", pa.string()),
])
FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Places:
    """Places in ascending order, in blocks of bounded length, so that one more costs little however many there are."""

    def __init__(self, place: int):
        self.blocks, self.firsts, self.n = [[place]], [place], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def about(self, place: int) -> tuple[int | None, int | None]:
        """The neighbours of a place that is not in here."""
        b = max(0, bisect_left(self.firsts, place) - 1)
        block = self.blocks[b]
        at = bisect_left(block, place)
        before = block[at - 1] if at else None
        if at < len(block):
            return before, block[at]
        return before, self.firsts[b + 1] if b + 1 < len(self.firsts) else None

    def add(self, place: int) -> None:
        b = max(0, bisect_left(self.firsts, place) - 1)
        block = self.blocks[b]
        block.insert(bisect_left(block, place), place)
        self.firsts[b] = block[0]
        self.n += 1
        if len(block) > _BLOCK:
            half = len(block) // 2
            self.blocks[b:b + 1] = [block[:half], block[half:]]
            self.firsts[b:b + 1] = [block[0], block[half]]


def suffixes(words: np.ndarray, places: np.ndarray) -> tuple[list[int], list[int]]:
    """``places`` in the order of what follows them, and the words that each has in common with the one before.

    ``words`` are numbers. All ranks are those of prefix doubling: round k tells 2^k words apart.
    """
    n = len(words)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64) + 1
    ranks, width = [np.append(rank, 0)], 1
    while width < n and len(np.unique(ranks[-1][places])) < len(places):
        last = ranks[-1]
        follow = np.zeros(n, np.int64)
        follow[:n - width] = last[width:n]
        rank = np.unique(last[:n] * (n + 2) + follow, return_inverse=True)[1] + 1
        ranks.append(np.append(rank, 0))
        width *= 2
    order = places[np.argsort(ranks[-1][places], kind="stable")]
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        x, y = ranks[k][np.minimum(a, n)], ranks[k][np.minimum(b, n)]
        # Equal ranks of 2^k words that reach beyond the end cannot be: the ends differ.
        same = (x == y) & (x > 0)
        common += same * (1 << k)
        a += same * (1 << k)
        b += same * (1 << k)
    return order.tolist(), common.tolist()


def maximal_pairs(words: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Start, distance and common length of the maximal pairs that are neighbours and satisfy the conditions."""
    order, common = suffixes(words, places)
    left = [-1, *words.tolist()]

    def join(a: Places, b: Places, length: int, found: list[tuple[int, int, int]]) -> Places:
        if a.n < b.n:
            a, b = b, a
        for place in b:
            for other in a.about(place):
                if other is None or left[place] == left[other]:
                    continue
                distance = abs(place - other)
                if (TIMES - 1) * distance <= length and length + distance >= MIN_WORDS:
                    found.append((min(place, other), distance, length))
        for place in b:
            a.add(place)
        return a

    found: list[tuple[int, int, int]] = []
    open_intervals: list[tuple[int, Places]] = []  # common lengths ascend
    current = Places(order[0])
    for length, place in zip([*common, 0], [*order[1:], -1]):
        while open_intervals and open_intervals[-1][0] >= length:
            within, places_before = open_intervals.pop()
            if within < _LEAST:
                current = places_before
                continue
            current = join(places_before, current, within, found)
        if length < _LEAST:
            open_intervals.clear()
        else:
            open_intervals.append((length, current))
        yield from found
        found.clear()
        current = Places(place)


def _suspects(docs: list[np.ndarray]) -> list[np.ndarray]:
    """For each text the places whose next ``_LEAST`` words seem (by hash) to occur again in it."""
    sizes = np.array([len(d) for d in docs])
    n = int(sizes.sum())
    if n < _LEAST:
        return [np.zeros(0, np.int64)] * len(docs)
    of = np.repeat(np.arange(len(docs)), sizes)
    numbers = np.concatenate(docs).astype(np.uint64)
    mixed = numbers * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    code = np.zeros(n - _LEAST + 1, np.uint64)
    for k in range(_LEAST):
        code = code * np.uint64(0xBF58476D1CE4E5B9) + mixed[k:k + len(code)]
    code ^= code >> np.uint64(31)
    inside = of[:len(code)] == of[_LEAST - 1:]
    code = (code + of[:len(code)].astype(np.uint64)) * np.uint64(0x94D049BB133111EB)
    where = np.flatnonzero(inside)
    order = where[np.argsort(code[where], kind="stable")]
    same = code[order[1:]] == code[order[:-1]]
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    starts = np.concatenate(([0], np.cumsum(sizes)))
    return [np.flatnonzero(again[a:b]) for a, b in zip(starts[:-1], starts[1:])]


def runs_of(words: np.ndarray, places: np.ndarray) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of the runs of a text, by start, then period."""
    if not len(places):
        return []
    smallest: dict[tuple[int, int], int] = {}
    for start, distance, common in maximal_pairs(words, places):
        stretch = start, common + distance
        smallest[stretch] = min(distance, smallest.get(stretch, distance))
    return sorted(((s, n, q) for (s, n), q in smallest.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those behind the first period of a run, one blank between them."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, number of words, runs and the text without repetitions, for each row of ``docs``."""

    def out(rows: list[tuple[int | None, list[bytes], np.ndarray]]) -> pa.RecordBatch:
        ids, texts, numbers = zip(*rows)
        found = [runs_of(n, p) for n, p in zip(numbers, _suspects(list(numbers)))]
        spans = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in found]
        left = [collapsed(words, own).decode() for words, own in zip(texts, found)]
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(w) for w in texts], pa.int64()),
            pa.array(spans, _FOUND.types[2]), pa.array(left, pa.string()),
        ], schema=_FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int | None, list[bytes], np.ndarray]] = []
        number: dict[bytes, int] = {}
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or "").encode().split()
                numbers = np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, len(words))
                rows.append((doc_id, words, numbers))
                held += len(words)
                if held >= _TOGETHER:
                    yield out(rows)
                    rows, number, held = [], {}, 0
        if rows:
            yield out(rows)

    ship(docs.sparkSession)
    rows = whole_columns(docs, "doc_id", "text").selectExpr("CAST(doc_id AS LONG) AS doc_id", "text")
    return rows.mapInArrow(run, FOUND)
