"""Toxicity by a counterfactually regularised classifier over character n-grams.

A logistic model over the frequencies of hashed character n-grams (3 to 6, within words, word edges
included; damped by a logarithm). It is trained on a bounded sample of labelled documents, at most ``sample_rows`` of each
class. Sentences of these that name a group of people (a parameter; by default in four languages) are copied with the group swapped
for others of its kind and for a neutral word, and the squared change of the score is penalised: naming
a group then tells the model nothing, so neutral mentions are not taken for abuse. Document
frequencies over the sample select the ``features`` n-grams kept; the bias is set to the
label rate of all labels, so scores are probabilities at that rate.

Scoring reads whole texts where they lie and shuffles nothing. The model sent to the tasks has a
fixed size (2**18 places and ``features`` weights).

Defined results: a null or empty text has the score of the bias; rows that share a ``doc_id`` are
scored one by one, and learnt from once if their texts agree too; of conflicting labels of an id the highest counts; labels without an id or a
value are ignored; without any labels all scores are 0.25; columns besides ``doc_id`` and ``text``
are kept by ``drop_toxic`` and ignored otherwise; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamflow.llm.base import pieces, settle, ship, small_batches, text_key, whole_columns
from loamflow.llm.letters import code_points, ngrams, squeezed
from loamflow.operators.joins import lookup_join

BITS, ORDERS = 18, (3, 4, 5, 6)
#: Names of groups by kind, in English, French, German and Spanish; the first of a kind stands for no group. Fixed values.
GROUPS = (
    ("people", "women", "men", "girls", "boys"),
    ("person", "woman", "man", "girl", "boy"),
    ("people", "christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("religious", "christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("single", "gay", "lesbian", "bisexual", "straight", "transgender"),
    ("local", "black", "white", "asian", "african", "european", "latino", "arab", "indigenous"),
    ("people", "immigrants", "refugees", "citizens", "foreigners"),
    ("other", "disabled", "blind", "deaf", "elderly", "young"),
    ("personnes", "femmes", "hommes", "filles", "garçons"),
    ("personne", "femme", "homme", "fille", "garçon"),
    ("gens", "chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"),
    ("gens", "homosexuels", "lesbiennes", "bisexuels", "hétérosexuels"),
    ("gens", "noirs", "blancs", "asiatiques", "africains", "européens", "arabes"),
    ("gens", "immigrés", "réfugiés", "citoyens", "étrangers"),
    ("gens", "handicapés", "aveugles", "sourds", "âgés", "jeunes"),
    ("menschen", "frauen", "männer", "mädchen", "jungen"),
    ("person", "frau", "mann"),
    ("menschen", "christen", "muslime", "juden", "buddhisten", "atheisten"),
    ("menschen", "schwule", "lesben", "bisexuelle", "heterosexuelle"),
    ("menschen", "schwarze", "weiße", "asiaten", "afrikaner", "europäer", "araber"),
    ("menschen", "einwanderer", "flüchtlinge", "bürger", "ausländer"),
    ("menschen", "behinderte", "blinde", "gehörlose", "alte", "junge"),
    ("personas", "mujeres", "hombres", "chicas", "chicos"),
    ("persona", "mujer", "hombre", "chica", "chico"),
    ("personas", "cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"),
    ("personas", "homosexuales", "lesbianas", "bisexuales", "heterosexuales"),
    ("personas", "negros", "blancos", "asiáticos", "africanos", "europeos", "árabes"),
    ("personas", "inmigrantes", "refugiados", "ciudadanos", "extranjeros"),
    ("personas", "discapacitados", "ciegos", "sordos", "ancianos", "jóvenes"),
)
Groups = tuple[tuple[str, ...], ...]
_SENTENCE = re.compile(r"[^.!?\n]+")


@lru_cache(maxsize=8)
def _terms(groups: Groups) -> tuple[re.Pattern, dict[str, tuple[str, ...]]]:
    """A pattern that finds the terms, and the kind of each; a term of several kinds is of the first."""
    kinds: dict[str, tuple[str, ...]] = {}
    for kind in groups:
        for term in kind[1:]:
            kinds.setdefault(term.lower(), kind)
    ordered = sorted(kinds, key=lambda term: (-len(term), term))
    return re.compile(r"\b(" + "|".join(map(re.escape, ordered)) + r")\b" if ordered else r"(?!)", re.IGNORECASE), kinds


def gram_bins(text: str | None) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For each piece of a whole text: its words and its n-gram bins, repeats included."""
    for piece in pieces(text or ""):
        letters, _, _ = squeezed(code_points(piece))
        yield np.count_nonzero(letters == 0) - 1, [bins for _, bins in ngrams(letters, ORDERS, BITS)]


def counted(text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
    """Words, distinct n-gram bins (ascending) and their counts of a whole text."""
    words, bins, counts = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
    for n, found in gram_bins(text):
        words += n
        own, times = np.unique(np.concatenate([bins[:0], *found]), return_counts=True)
        bins, inverse = np.unique(np.concatenate((bins, own)), return_inverse=True)
        counts = np.bincount(inverse, np.concatenate((counts, times)), len(bins)).astype(np.int64)
    return words, bins, counts


def damped(counts: np.ndarray, words: int) -> np.ndarray:
    """Value of an n-gram: the logarithm of its frequency, for short texts drawn towards 0."""
    return np.log1p(200.0 * counts / (words + 50))


def swaps(text: str | None, groups: Groups = GROUPS, sentences: int = 32) -> list[tuple[int, list[int], list[int]]]:
    """For each swapped copy of a sentence that names a group: a hash of it, the n-grams it gains and those it loses.

    Of more than ``sentences`` such sentences, those with the smallest hashes count.
    """
    from xxhash import xxh64_intdigest

    pattern, kinds = _terms(groups)
    naming = (s for s in _SENTENCE.findall(text or "") if pattern.search(s))
    changes = []
    for nth, sentence in nsmallest(sentences, ((xxh64_intdigest(s), s) for s in naming)):
        own = counted(sentence)[1]
        for shift in (1, 2, 0):

            def swap(m: re.Match, shift: int = shift) -> str:
                neutral, *kind = kinds[m[0].lower()]
                at = [k.lower() for k in kind].index(m[0].lower())
                return kind[(at + shift) % len(kind)] if shift else neutral

            other = counted(pattern.sub(swap, sentence))[1]
            changes.append((nth >> 1, np.setdiff1d(other, own).tolist(), np.setdiff1d(own, other).tolist()))
    return changes


@dataclass
class Model:
    """Column of each n-gram bin (-1: none), the weights of the columns, the bias, and how many swapped copies the fit used."""

    column: np.ndarray
    weights: np.ndarray
    bias: float
    pairs: int = 0

    def score(self, text: str | None) -> float:
        words, counts = 0, np.zeros(len(self.weights))
        for n, found in gram_bins(text):
            words += n
            for bins in found:
                columns = self.column[bins]
                counts += np.bincount(columns[columns >= 0], minlength=len(counts))
        logit = self.bias + float(damped(counts, words) @ self.weights)
        return float(1 / (1 + np.exp(-np.clip(logit, -60, 60))))


def _fit(labels: np.ndarray, rows: tuple, changes: tuple, n_columns: int, ridge: float, fairness: float,
         steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias: logistic loss + ridge * |w|^2 / 2 + fairness * sum of squared score changes / 2."""
    row, column, value = rows
    change, change_column, sign = changes
    n, n_changes = len(labels), int(change.max()) + 1 if len(change) else 0
    w, bias = np.zeros(n_columns), 0.0
    squares, bias_squares = np.full(n_columns, 1e-8), 1e-8
    for _ in range(steps):
        logit = np.bincount(row, value * w[column], n) + bias
        wrong = 1 / (1 + np.exp(-np.clip(logit, -60, 60))) - labels
        slope = np.bincount(column, value * wrong[row], n_columns) + ridge * w
        if n_changes:
            moved = np.bincount(change, sign * w[change_column], n_changes)
            slope += fairness * np.bincount(change_column, sign * moved[change], n_columns)
        squares += slope * slope
        w -= 0.5 * slope / np.sqrt(squares)
        bias_squares += wrong.sum() ** 2
        bias -= 0.5 * wrong.sum() / np.sqrt(bias_squares)
    return w, bias


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 3000, features: int = 4000, ridge: float = 1.0,
        fairness: float = 10.0, seed: int = 7, groups: Groups = GROUPS, sentences: int = 32, pairs: int = 20_000) -> Model:
    """Train on at most ``sample_rows`` labelled documents of each class, chosen by a hash of the id.

    ``groups`` lists the terms of each kind, its neutral word first. Of a document at most ``sentences`` that name a group are
    swapped, and of all swapped copies at most ``pairs`` are used, chosen by a hash of the sentence.
    """
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    known = whole_columns(labels, "doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    counts = dict(known.groupBy("toxic").count().collect())
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    prior = float(np.log((n1 + 0.5) / (n0 + 1.5)))
    if not (n0 and n1):
        return Model(np.full(1 << BITS, -1, np.int32), np.zeros(1), prior)
    # Documents are drawn, not ids: rows that share an id and a text are one document, an id with many texts is many.
    keyed = whole_columns(docs, "doc_id", "text").filter("doc_id IS NOT NULL").withColumn("key", text_key())
    # Settled, as both classes are drawn from it: the texts are read once for their keys, once for the sample.
    named = settle(lookup_join(keyed.select("doc_id", "key"), known, ["doc_id"], "inner").distinct(), "toxicity-named")
    order = F.xxhash64("doc_id", F.lit(seed))
    drawn = [named.filter(F.col("toxic") == c).orderBy(order, "doc_id", "key").limit(sample_rows) for c in (0, 1)]
    sample = F.broadcast(drawn[0].unionByName(drawn[1]))  # at most 2 * sample_rows rows of three numbers

    numbers = pa.list_(pa.int32())
    described = pa.schema([
        ("toxic", pa.int32()), ("words", pa.int64()), ("bins", numbers), ("counts", numbers),
        ("swaps", pa.list_(pa.struct([("nth", pa.int64()), ("gained", numbers), ("lost", numbers)]))),
    ])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                words, bins, counts = counted(text)
                changed = [{"nth": n, "gained": a, "lost": b} for n, a, b in swaps(text, groups, sentences)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip((label, words, bins, counts, changed), described.types)],
                    schema=described,
                )

    texts = keyed.join(sample, ["doc_id", "key"]).groupBy("doc_id", "key", "toxic").agg(F.first("text").alias("text"))
    swapped = "array<struct<nth: bigint, gained: array<int>, lost: array<int>>>"
    told = settle(texts.select("toxic", "text").mapInArrow(
        describe, f"toxic int, words long, bins array<int>, counts array<int>, swaps {swapped}"
    ), "toxicity-sample")

    # Document frequencies: at most 2**BITS rows, whatever the sample.
    seen = told.select("toxic", F.explode("bins").alias("bin")).groupBy("bin").agg(
        F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0")
    ).toArrow()
    sizes = dict(told.groupBy("toxic").count().collect())
    m0, m1 = sizes.get(0, 0), sizes.get(1, 0)
    if not (m0 and m1):
        return Model(np.full(1 << BITS, -1, np.int32), np.zeros(1), prior)
    bins = seen["bin"].to_numpy()
    p, q = (seen["n1"].to_numpy() + 0.5) / (m1 + 1), (seen["n0"].to_numpy() + 0.5) / (m0 + 1)
    apart = np.abs(p - q) / np.sqrt(p * (1 - p) / m1 + q * (1 - q) / m0)
    chosen = np.sort(bins[np.lexsort((bins, -apart))[:features]])
    column = np.full(1 << BITS, -1, np.int32)
    column[chosen] = np.arange(len(chosen))

    shared = spark.sparkContext.broadcast(column)
    picked = pa.schema([("toxic", pa.int32()), ("columns", numbers), ("values", pa.list_(pa.float32()))])
    changed = pa.schema([("columns", numbers), ("signs", pa.list_(pa.float32()))])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, words, own, counts in zip(*batch.columns):
                at = shared.value[own.values.to_numpy()]
                values = damped(counts.values.to_numpy()[at >= 0], words.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip((toxic.as_py(), at[at >= 0], values), picked.types)], schema=picked
                )

    def pick_changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, signs = [], []
            for gained, lost in zip(batch.column(1), batch.column(2)):
                at = shared.value[np.concatenate((gained.values.to_numpy(), lost.values.to_numpy()))]
                columns.append(at[at >= 0])
                signs.append(np.repeat((1.0, -1.0), (len(gained), len(lost)))[at >= 0])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((columns, signs), changed.types)], schema=changed)

    # At most 2 * sample_rows rows and ``pairs`` rows, of at most ``features`` numbers.
    table = told.select("toxic", "words", "bins", "counts").mapInArrow(
        pick, "toxic int, columns array<int>, values array<float>"
    ).toArrow().combine_chunks()
    row = np.repeat(np.arange(len(table)), _flat(table["columns"])[0])
    rows = row, _flat(table["columns"])[1], _flat(table["values"])[1].astype(float)
    copies = told.select(F.inline("swaps")).orderBy("nth", "gained", "lost").limit(pairs)
    moved = copies.mapInArrow(pick_changes, "columns array<int>, signs array<float>").toArrow().combine_chunks()
    n_pairs, changes = len(moved), (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    if n_pairs:
        lengths, places = _flat(moved["columns"])
        changes = np.repeat(np.arange(n_pairs), lengths), places, _flat(moved["signs"])[1].astype(float)
    w, bias = _fit(table["toxic"].to_numpy().astype(float), rows, changes, len(chosen), ridge, fairness)
    return Model(column, w, bias + prior - float(np.log(m1 / m0)), n_pairs)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Length of each list of a column, and all their values."""
    lengths = [len(v) for chunk in column.chunks for v in chunk]
    values = [chunk.flatten().to_numpy(zero_copy_only=False) for chunk in column.chunks]
    return np.array(lengths, np.int64), np.concatenate(values)


def score(docs: DataFrame, model: Model, *keep: Column) -> DataFrame:
    """doc_id, ``keep`` columns (computed from doc_id or text), score and predicted of every document."""
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    own = whole_columns(docs, "doc_id", "text").select("doc_id", *keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([shared.value.score(t.as_py()) for t in batch.column(batch.num_columns - 1)], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], scores], [*batch.schema.names[:-1], "score"]
            )

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in own.schema.fields[:-1]]
    scored = own.mapInArrow(run, ", ".join([*fields, "score double"]))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, whose score is under 0.5. Rows are filtered where they lie."""
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([shared.value.score(t.as_py()) < 0.5 for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
