"""Language of mixed-language text: scripts narrow the candidates, Viterbi labels the words.

Training counts character n-grams (2 to 4, within words, word edges included; hashed) and letters by script
for each language, over a bounded sample of labelled documents, about ``sample_rows`` of each language.
The score of a word for a language is the sum of the log-likelihood ratios of its n-grams, against the mean
of the languages, within bounds; languages that hardly use the script of the word are ruled out.
Viterbi then finds the best sequence of languages for the words of a text, where each change of language
costs ``penalty``: single odd words do not break a span, a passage in another language does. The language
of a document is the one with most letters; the score is its share of the letters.

Texts are labelled where they lie; many are decoded side by side, one word of each at a time. The model
sent to the tasks has one row of 2**17 numbers for each language.

Defined results: a null text, or one without letters, is ``und`` with score 0 and no spans; ties go to the language
that sorts first; rows that share a ``doc_id`` are labelled one by one; documents without a language are
not learnt from; without any labelled document every text is ``und``; columns other than those named are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamflow.llm.base import pieces, ship, whole_columns
from loamflow.llm.letters import SCRIPTS, code_points, ngrams, squeezed

BITS, ORDERS = 17, (2, 3, 4)
UNDETERMINED = "und"
#: A language uses a script if at least this share of its letters is in it.
SCRIPT_SHARE = 0.002
RULED_OUT, BOUND = -30.0, 8.0
#: A task decodes texts with about this many words together.
TOGETHER = 1_000_000
#: A model has a row for each language; more values than this in the column are no languages.
MOST_LANGUAGES = 1000


@dataclass
class Model:
    """Languages in order, ratios by n-gram bin (bins x languages), and which script each may use."""

    languages: list[str]
    ratios: np.ndarray
    allowed: np.ndarray


@dataclass
class Words:
    """The words of one text: places in it, letters, and scores by language."""

    starts: np.ndarray
    ends: np.ndarray
    scores: np.ndarray


def words_of(model: Model, text: str | None) -> Words:
    parts, base = [], 0
    for piece in pieces(text or "") if model.languages else ():
        letters, script, at = squeezed(code_points(piece))
        inside = letters > 0
        first = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
        if len(first):
            last = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False])))
            scores = np.zeros((len(first), len(model.languages)), np.float32)
            for starts, bins in ngrams(letters, ORDERS, BITS):
                # The word an n-gram lies in: the next one if it starts at the edge before it.
                owner = np.searchsorted(first, starts + (letters[starts] == 0), side="right") - 1
                begins = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else owner
                if len(begins):
                    scores[owner[begins]] += np.add.reduceat(model.ratios[bins], begins, axis=0)
            scores = np.clip(scores - scores.max(axis=1, keepdims=True), -BOUND, 0)
            scores += model.allowed[script[first]]
            parts.append((at[first] + base, at[last] + base + 1, scores))
        base += len(piece)
    if not parts:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros((0, len(model.languages)), np.float32))
    return Words(*(np.concatenate(c) for c in zip(*parts)))


def decode(texts: list[Words], penalty: float) -> list[np.ndarray]:
    """The best language of each word of each text, all texts side by side."""
    order = np.argsort([-len(t.starts) for t in texts], kind="stable")
    sizes = np.array([len(texts[i].starts) for i in order])
    if not len(sizes) or not sizes[0]:
        return [np.zeros(0, np.int16) for _ in texts]
    scores = np.concatenate([texts[i].scores for i in order])
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")  # texts with that many words
    switched = np.zeros(scores.shape, bool)
    best_before = np.zeros(len(scores), np.int16)
    state = np.zeros((len(sizes), scores.shape[1]), np.float32)
    for step in range(sizes[0]):
        n = alive[step]
        at = begins[:n] + step
        if step:
            top = state[:n].argmax(1)
            change = state[np.arange(n), top][:, None] - penalty
            move = change > state[:n]
            switched[at], best_before[at] = move, top
            state[:n] = np.where(move, change, state[:n])
        state[:n] += scores[at]
        state[:n] -= state[:n].max(1, keepdims=True)
    labels = np.zeros(len(scores), np.int16)
    now = state.argmax(1)
    for step in range(sizes[0] - 1, -1, -1):
        n = alive[step]
        at = begins[:n] + step
        labels[at] = now[:n]
        now[:n] = np.where(switched[at, now[:n]], best_before[at], now[:n])
    out: list[np.ndarray] = [labels[:0]] * len(texts)
    for k, i in enumerate(order):
        out[i] = labels[begins[k]:begins[k] + sizes[k]]
    return out


def verdict(model: Model, words: Words, labels: np.ndarray) -> tuple[str, float, list[dict]]:
    """Language, score and spans (start and length in code points, language) of one text."""
    if not len(labels):
        return UNDETERMINED, 0.0, []
    letters = np.bincount(labels, words.ends - words.starts, len(model.languages))
    edges = np.flatnonzero(np.concatenate(([True], labels[1:] != labels[:-1])))
    lasts = np.append(edges[1:], len(labels)) - 1
    spans = [
        {"start": a, "length": b - a, "lang": model.languages[k]}
        for a, b, k in zip(words.starts[edges].tolist(), words.ends[lasts].tolist(), labels[edges].tolist())
    ]
    best = int(letters.argmax())
    return model.languages[best], float(letters[best] / letters.sum()), spans


def fit(docs: DataFrame, sample_rows: int = 2000, smoothing: float = 0.5, seed: int = 11) -> Model:
    """Learn from about ``sample_rows`` documents of each language, drawn by a hash of id and text."""
    spark = docs.sparkSession
    ship(spark)
    known = whole_columns(docs, "doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = known.groupBy("lang").count().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in sizes)
    n_bins, n_scripts = 1 << BITS, len(SCRIPTS)
    if not languages:
        return Model([], np.zeros((n_bins, 0), np.float32), np.zeros((n_scripts, 0), np.float32))
    shares = spark.createDataFrame(
        [(r["lang"], languages.index(r["lang"]), min(1.0, sample_rows / r["count"])) for r in sizes],
        "lang string, number int, share double",
    )
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 30)) / F.lit(1 << 30)
    sample = known.join(F.broadcast(shares), "lang").filter(draw < F.col("share")).select("number", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = {}
        for batch in batches:
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = grams.setdefault(number, np.zeros(n_bins + n_scripts, np.int64))
                for piece in pieces(text.as_py()):
                    letters, script, _ = squeezed(code_points(piece))
                    own[n_bins:] += np.bincount(script[letters > 0], minlength=n_scripts)
                    for _, bins in ngrams(letters, ORDERS, BITS):
                        own[:n_bins] += np.bincount(bins, minlength=n_bins)
        for number, own in grams.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), number, np.int32)), pa.array(at), pa.array(own[at])], ["number", "bin", "n"]
            )

    # At most one row for each language and bin, whatever the sample.
    summed = sample.mapInArrow(count, "number int, bin long, n long").groupBy("number", "bin").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((n_bins + n_scripts, len(languages)))
    counts[summed["bin"].to_numpy(), summed["number"].to_numpy()] = summed["n"].to_numpy()
    grams, scripts = counts[:n_bins], counts[n_bins:]
    log = np.log((grams + smoothing) / (grams.sum(0) + smoothing * n_bins))
    ratios = np.where(grams.sum(1, keepdims=True) > 0, log - log.mean(1, keepdims=True), 0).astype(np.float32)
    allowed = np.where(scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1), 0, RULED_OUT).astype(np.float32)
    allowed[(allowed < 0).all(1)] = 0  # a script nobody uses rules nobody out
    return Model(languages, ratios, allowed)


def identify(docs: DataFrame, model: Model, *keep: Column, penalty: float = 12.0) -> DataFrame:
    """doc_id, ``keep`` columns (computed from doc_id), lang_pred, score and spans of every document."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    own = whole_columns(docs, "doc_id", "text").select("doc_id", *keep, "text")
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("lang", pa.string())]))
    names = [*own.columns[:-1], "lang_pred", "score", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, waiting = shared.value, []

        def out() -> Iterator[pa.RecordBatch]:
            texts = [w for _, found in waiting for w in found]
            labels = iter(decode(texts, penalty))
            for columns, found in waiting:
                told = [verdict(model, w, next(labels)) for w in found]
                yield pa.RecordBatch.from_arrays([
                    *columns, pa.array([t[0] for t in told], pa.string()), pa.array([t[1] for t in told], pa.float64()),
                    pa.array([t[2] for t in told], span),
                ], names)
            waiting.clear()

        words = 0
        for batch in batches:
            first, found = 0, []
            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                found.append(words_of(model, text.as_py()))
                words += len(found[-1].starts)
                if words >= TOGETHER:
                    waiting.append(([c.slice(first, i + 1 - first) for c in batch.columns[:-1]], found))
                    yield from out()
                    first, found, words = i + 1, [], 0
            if found:
                waiting.append(([c.slice(first) for c in batch.columns[:-1]], found))
        if waiting:
            yield from out()

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in own.schema.fields[:-1]]
    return own.mapInArrow(run, ", ".join([
        *fields, "lang_pred string, score double, spans array<struct<start: long, length: long, lang: string>>"
    ]))
