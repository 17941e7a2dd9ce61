"""Substring deduplication by hashing runs of units whose borders come from the text around them.

A text is cut into units: behind sentence signs and line ends, before a capitalised word with no other close behind, and
before each word whose hash (with the word behind it) is the smallest among ``unit_words`` - 1 neighbours on
both sides. As a border depends on the few words next to it only, a passage pasted into the middle of a line is
cut alike wherever it stands, with or without signs, in any script. From each unit on, and up to each unit, as many
units as make up ``min_words`` words are hashed together to 128 bits (normalised: lower case, single blanks),
across line ends. The digests are grouped over the whole corpus; the occurrence ranked first (by
``doc_id``, then text, then place) is kept, every later one is removed. So a run counts by its own repetition,
whichever documents hold parts of it, and lines that repeat each by itself stay. Of a shared passage, what is left is
less than a unit at each end.

Where words are not set apart by blanks (Chinese, Japanese, Thai and others) each character is cut and hashed like a word and
counts for half a word (Thai, Lao, Burmese, Khmer: a quarter); a longer string without blanks counts a word for 8 characters.

Only digests travel, with offsets in the original text, and only half digests of those that do not repeat; a digest that fills a third of the corpus is
combined before it is shuffled, and its occurrences are looked up in one row, which lets Spark split them. Spans are gathered for
one document at a time. Offsets count code points of the original text, from 0, and are returned.

Defined results: a null text stays null, an empty one empty; rows equal in ``doc_id`` and text are
the same document and lose the same spans; documents without an id rank first; repeats
within a document count like any other; one word repeated over and over is a single unit; columns besides those two are kept by
``remove_repeats`` and ``drop_repeated``; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamflow.llm.base import folders, fresh, pieces, release, settle, ship, text_key, whole_columns
from loamflow.operators.joins import lookup_join

_LINE = re.compile(r"[^\n]*\n+|[^\n]+")
#: Characters that are words of their own: scripts written without blanks, by how many make up a word, and their signs.
_QUARTER, _HALF = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff", "\u3001-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff"
_UNSPACED = re.compile(f"[{_QUARTER}{_HALF}]")
_WORD_OR_CHARACTER = re.compile(rf"[{_QUARTER}{_HALF}]|[^\s{_QUARTER}{_HALF}]+")
_FOURTH = re.compile(f"[{_QUARTER}]")
_SIGNS = frozenset(".!?\u2026\u3002\uff01\uff1f\uff0e\uff61\u061f\u06d4\u0964\u0965\u104b\u17d4")
_BLANK, _UPPER, _ALPHA, _SIGN = 1, 2, 4, 8


def _kind(c: str) -> int:
    """A character's kinds; for a letter, it is the last of its lower case that counts."""
    return _BLANK * c.isspace() + _UPPER * c.isupper() + _ALPHA * c.lower()[-1].isalpha() + _SIGN * (c in _SIGNS)


_KINDS = np.array([_kind(chr(i)) for i in range(1 << 16)], np.uint8)


def _kinds(letters: np.ndarray) -> np.ndarray:
    """Kinds of characters that are given by number."""
    kinds = _KINDS[np.minimum(letters, 0xFFFF)]
    if len(letters) and letters.max() > 0xFFFF:
        for i in np.flatnonzero(letters > 0xFFFF).tolist():
            kinds[i] = _kind(chr(letters[i]))
    return kinds


#: A capitalised word begins a unit if none of so many words behind it is capitalised.
ALONE = 3
#: A word of more characters counts as one for each 8.
LONG = 32
#: Words of 64 bits in the map of digests that repeat: 8 MB.
MOST_WORDS = 1 << 20
_UNITS = pa.schema([
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("words", pa.int64()),
    ("d1", pa.int64()), ("d2", pa.int64()),
])
_SPANS = pa.schema([
    ("doc_id", pa.int64()), ("text_key", pa.int64()),
    ("removed", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("kept_doc_id", pa.int64())]))),
])
SPANS = "doc_id long, text_key long, removed array<struct<start: long, length: long, kept_doc_id: long>>"


def _cut(text: str, start: int, end: int, unit_words: int) -> tuple[list[str], bytes, np.ndarray, np.ndarray, np.ndarray] | None:
    """Lower-case words of a stretch of text, these as a line, their quarters, and the first word and the start of each unit; None without words."""
    stretch = text[start:end]
    letters = np.frombuffer(stretch.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kinds(letters)
    lower = stretch.lower()
    unspaced = bool(len(letters) and letters.max() >= 0xE00 and _UNSPACED.search(stretch))
    if unspaced:
        starts = np.array([m.start() for m in _WORD_OR_CHARACTER.finditer(stretch)], np.int64)
        words = _WORD_OR_CHARACTER.findall(lower)
        last = _kinds(np.array([ord(w[-1]) for w in words], np.uint32))
    else:
        inside = np.concatenate(([False], kinds & _BLANK == 0, [False]))
        starts, ends = np.flatnonzero(inside[1:] > inside[:-1]), np.flatnonzero(inside[1:] < inside[:-1])
        words = lower.split()
        last = kinds[ends - 1]
    if not words:
        return None
    n = len(words)
    border = starts + start
    if unspaced or len(lower) != len(stretch):
        sizes = np.fromiter(map(len, words), np.int64, n)
    else:
        sizes = ends - starts
    quarters = np.where(sizes > LONG, sizes // 2, 4)
    if unspaced:
        for i in np.flatnonzero(sizes == 1).tolist():
            if _UNSPACED.match(words[i]):
                quarters[i] = 1 if _FOURTH.match(words[i]) else 2
    capital, signed, lettered = kinds[starts] & _UPPER > 0, last & _SIGN > 0, last & _ALPHA > 0
    sure = np.zeros(n, bool)
    sure[1:] = signed[:-1] | (capital[1:] & lettered[:-1])
    for k in range(1, min(ALONE, n - 2) + 1):
        sure[1:n - k] &= signed[:n - k - 1] | ~capital[1 + k:]
    lines = np.flatnonzero(letters == 10)
    behind = np.searchsorted(starts, lines)
    between = (behind > 0) & (behind < n)
    sure[behind[between]], border[behind[between]] = True, lines[between] + start + 1  # of several, the last counts
    line = " ".join(words).encode()
    codes = np.fromiter(map(crc32, line.split(b" ")), np.uint64, n)
    mixed = (codes * np.uint64(0x9E3779B97F4A7C15)) ^ (np.append(codes[1:], np.uint64(0)) * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(2)).astype(np.int64)
    sure[0], border[0] = True, start
    mixed[sure] = -1
    least = ~sure
    for k in range(1, unit_words):
        least[k:] &= mixed[k:] < mixed[:-k]
        least[:-k] &= mixed[:-k] <= mixed[k:]
    cuts = np.flatnonzero(sure | least)
    return words, line, quarters, cuts, border[cuts]


def sentences(text: str, start: int, end: int, unit_words: int = 4) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and words of each unit of a stretch of text; together they cover it, blanks behind one included."""
    found = _cut(text, start, end, unit_words)
    if found is None:
        if end > start:
            yield start, end, []
        return
    words, _, _, cuts, begins = found
    cuts, begins = cuts.tolist(), begins.tolist()
    for i, j, a, b in zip(cuts, [*cuts[1:], len(words)], begins, [*begins[1:], end]):
        yield a, b, words[i:j]


def unit_columns(text: str, unit_words: int, min_words: int = 25) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of ``unit_rows``, for one piece of the text after the other."""
    from xxhash import xxh3_128_digest

    def runs(held: tuple[bytes, np.ndarray, np.ndarray, np.ndarray], began: bool, done: int, ends: np.ndarray) -> tuple[tuple[np.ndarray, ...], int]:
        """Columns of the runs that end with a unit from ``done`` on, and the last unit that began one (-1: none did)."""
        line, at, quarters, starts = held
        sums = np.concatenate(([0], np.cumsum(quarters)))
        # By last unit: the last unit that a run of ``min_words`` words up to it can begin with.
        latest = np.searchsorted(sums, sums[done + 1:len(ends) + 1] - 4 * min_words, "right") - 1
        before = np.concatenate(([0 if began else -1], latest[:-1]))
        count = np.where(latest < 0, 0, np.maximum(latest - before, 1))
        to = np.repeat(np.arange(done, len(ends)), count)
        since = np.repeat(np.where(latest > before, before + 1, latest) - np.cumsum(count) + count, count) + np.arange(len(to))
        cut = zip(at[since].tolist(), (at[to + 1] - 1).tolist())
        digests = np.frombuffer(b"".join([xxh3_128_digest(line[a:b]) for a, b in cut]), ">u8").astype(np.uint64)
        digests = (digests ^ np.uint64(1 << 63)).view(np.int64).reshape(-1, 2)
        columns = (since, to, starts[since], ends[to] - starts[since], (sums[to + 1] - sums[since]) // 4, digests[:, 0], digests[:, 1])
        return columns, int(latest[-1]) if len(latest) else int(before[0])

    # Of the pieces before: units that later runs may begin with (their words, where each begins and the end, quarters, starts).
    held = (b"", np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    began, done, unit, end = False, 0, 0, 0
    for piece in pieces(text):
        found = _cut(text, end, end + len(piece), unit_words)
        end += len(piece)
        if found is not None:
            _, more, quarters, cuts, begins = found
            line, at, old, starts = held
            blanks = np.flatnonzero(np.frombuffer(more, np.uint8) == 32)
            places = len(line) + np.concatenate(([0], blanks[cuts[1:] - 1] + 1, [len(more) + 1]))
            held = (
                line + more + b" ", np.concatenate((at[:-1], places)),
                np.concatenate((old, np.add.reduceat(quarters, cuts))), np.concatenate((starts, begins)),
            )
        if end < len(text) and len(held[3]) > done + 1:
            # The end of the last unit is not known yet.
            columns, first = runs(held, began, done, held[3][1:])
            yield (columns[0] + unit, columns[1] + unit, *columns[2:])
            began, done, first = first >= 0, len(held[3]) - 1 - max(first, 0), max(first, 0)
            line, at, old, starts = held
            held, unit = (line[at[first]:], at[first:] - at[first], old[first:], starts[first:]), unit + first
    if len(held[3]):
        columns, _ = runs(held, began, done, np.append(held[3][1:], len(text)))
        yield (columns[0] + unit, columns[1] + unit, *columns[2:])


def unit_rows(text: str, unit_words: int, min_words: int = 25) -> Iterator[tuple]:
    """First and last unit, start, length, words and the two halves of the digest of each run.

    A run begins with a unit and is as short as ``min_words`` words let it be, or ends with one and is.
    """
    for columns in unit_columns(text, unit_words, min_words):
        yield from zip(*[c.tolist() for c in columns])


def removed_spans(rows: list[dict], min_words: int) -> list[dict]:
    """Spans to remove: what the repeated runs of one document cover."""
    spans: list[dict] = []
    reached = 0
    for r in sorted(rows, key=lambda r: (r["start"], r["length"])):
        end, start = r["start"] + r["length"], max(r["start"], reached)
        if r["words"] < min_words or end <= start:
            continue
        last = spans[-1] if spans else None
        if last and last["kept_doc_id"] == r["kept_doc_id"] and reached == start:
            last["length"] += end - start
        else:
            spans.append({"start": start, "length": end - start, "kept_doc_id": r["kept_doc_id"]})
        reached = end
    return spans


def marked(hashed: DataFrame, often: DataFrame) -> DataFrame:
    """Rows of ``hashed`` whose ``d1`` is in ``often``, and a few others, found without a shuffle of ``hashed``.

    Each digest of ``often`` (settled) sets one of 16 bits or more for each of them, of 2^26 at most, in one row that goes to
    all tasks. A fuller map lets more others through; none that is in ``often`` is lost.
    """
    spark, n = hashed.sparkSession, often.count()
    words = min(MOST_WORDS, max(1 << 10, 1 << (n // 4).bit_length()))
    word, at = F.col("d1").bitwiseAND(F.lit(words - 1)), "CAST(shiftrightunsigned(d1, 32) & 63 AS INT)"
    bits = often.select(word.alias("word"), F.expr(f"shiftleft(1L, {at})").alias("bits"))
    bits = bits.unionByName(spark.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits")))
    bits = bits.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    held, mask = fresh(hashed, "held"), F.sort_array(F.collect_list(F.struct("word", "bits")))
    row = settle(bits.agg(F.transform(mask, lambda b: b["bits"]).alias(held)), "marks")
    is_set = F.expr(f"shiftrightunsigned(get({held}, CAST(d1 & {words - 1} AS INT)), {at}) & 1 = 1")
    return hashed.crossJoin(F.broadcast(row)).filter(is_set).drop(held)


def repeated_spans(docs: DataFrame, min_words: int = 25, unit_words: int = 4) -> DataFrame:
    """doc_id, text_key and the spans to remove (with the document that keeps them), where there are any."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, found = [], []

            def out() -> pa.RecordBatch:
                own = pa.array(np.repeat(owners, [len(c[0]) for c in found]))
                columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
                rows = [batch.column(0).take(own), batch.column(1).take(own), *columns]
                owners.clear(), found.clear()
                return pa.RecordBatch.from_arrays(rows, schema=_UNITS)

            n = 0
            for nth, text in enumerate(batch.column(2)):
                for columns in unit_columns(text.as_py() or "", unit_words, min_words):
                    owners.append(nth)
                    found.append(columns[2:])
                    n += len(columns[0])
                    if n >= 50_000:
                        yield out()
                        n = 0
            if n:
                yield out()

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [removed_spans(rows.as_py(), min_words) for rows in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, _SPANS.types[2])], schema=_SPANS)

    ship(docs.sparkSession)
    own = whole_columns(docs, "doc_id", "text").select("doc_id", text_key().alias("text_key"), "text")
    fields = ", ".join(f"{f.name} long" for f in _UNITS)
    hashed = settle(own.mapInArrow(cut, fields), "units")
    # Half of the digest tells which units can repeat at all; only these take part in the wide steps.
    often = settle(hashed.groupBy("d1").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("d1"), "often")
    release(docs.sparkSession, [])  # the shuffled counts
    # As an inner join (``often`` has each digest once): Spark would move a semi join below the map.
    shared = settle(lookup_join(marked(hashed, often), often, ["d1"], "inner"), "shared-units")
    release(docs.sparkSession, [*folders(hashed), *folders(often)])  # nothing below reads the others
    place = F.struct("doc_id", "text_key", "start", "length")
    firsts = shared.groupBy("d1", "d2").agg(F.min(place).alias("first"))
    later = lookup_join(shared, firsts, ["d1", "d2"], "left").filter(place > F.col("first"))
    unit = F.struct("start", "length", "words", F.col("first.doc_id").alias("kept_doc_id"))
    gathered = later.groupBy("doc_id", "text_key").agg(F.collect_set(unit).alias("units"))
    return gathered.mapInArrow(join_up, SPANS).filter(F.size("removed") > 0)


def remove_repeats(docs: DataFrame, min_words: int = 25, unit_words: int = 4, out: str = "removed") -> DataFrame:
    """All documents, every column, with repeated spans cut out of ``text``; column ``out`` tells them (else null)."""
    known = {c.lower(): c for c in docs.columns}
    if out.lower() in known:
        raise ValueError(f"the documents have a column {out} already: name another for the spans")
    of, key, spans_at = fresh(docs, "of"), fresh(docs, "key"), F.col(out)
    spans = repeated_spans(docs, min_words, unit_words).select(
        F.col("doc_id").alias(of), F.col("text_key").alias(key), F.col("removed").alias(out)
    )
    text = docs[known["text"]]
    joined = docs.join(spans, docs[known["doc_id"]].eqNullSafe(F.col(of)) & (F.xxhash64(text) == F.col(key)), "left")
    end = lambda s: s["start"] + s["length"]
    before = lambda i: F.when(i == 0, 0).otherwise(end(F.get(spans_at, i - 1))).cast("int")
    left = F.transform(spans_at, lambda s, i: F.substr(text, before(i) + 1, s["start"].cast("int") - before(i)))
    tail = F.substr(text, end(F.element_at(spans_at, -1)).cast("int") + 1)
    cleaned = F.when(spans_at.isNull(), text).otherwise(F.concat(F.array_join(left, ""), tail))
    columns = [cleaned.alias(c) if c == known["text"] else docs[c] for c in docs.columns]
    return joined.select(*columns, spans_at)


def drop_repeated(docs: DataFrame, out: str | None = None) -> DataFrame:
    """The documents without repeated spans (told in ``out``, if named); those of which nothing is left are dropped."""
    known = {c.lower(): c for c in docs.columns}
    spans = out or fresh(docs, "removed")
    gone = F.col(spans).isNotNull() & ~F.col(known["text"]).rlike(r"\S")
    left = remove_repeats(docs, out=spans).filter(~gone)
    return left if out else left.drop(spans)
