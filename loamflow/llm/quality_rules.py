"""Quality rules whose cutoffs are chosen under a guaranteed risk, in Spark expressions only.

Each rule rejects a document whose value lies above a cutoff. The rules tighten together, over a
fixed list of levels from lenient to strict. A labelled holdout of good documents selects the level
of each stratum (by default the language column): a level is safe if the exact binomial test
rejects "more than ``risk`` of the good documents would be lost to the rules together" at level
``error`` / strata. The good documents lost only grow along the list, so it is tested in order and
the last safe level is taken; this order needs no correction of its own, the strata are corrected by
Bonferroni. With probability 1 - ``error``, every stratum loses at most ``risk`` of its good
documents. A stratum with too few labels for any safe level rejects nothing beyond the base rules.

Texts are read once: their figures are written to the shared folder, a few numbers for each
document. All that is gathered afterwards is one row for each stratum.

Defined results: a null text has no words and fails the base rules; rows that share a ``doc_id`` are
judged one by one, each with that id's labels; of conflicting labels the lowest counts; labels
without an id or a value are ignored; a null stratum is a stratum of its own; a stratum column that is
not there means one stratum; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamflow.llm.base import settle, whole_columns

BLANKS = "[\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"
#: Rule: its value, and its cutoff at each level. Fixed beforehand: the guarantee needs it.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbol_ratio": ("n_symbols / greatest(word_chars, 1)", (1.0, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02, 0.01)),
    "capital_ratio": ("n_capitals / greatest(word_chars, 1)", (0.9, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15)),
    "repeat_ratio": ("n_repeat_words / greatest(n_words, 1)", (0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15)),
    "dup_lines": ("100.0 * n_dup_lines / greatest(n_words, 1)", (20.0, 10.0, 6.0, 4.0, 3.0, 2.5, 2.0, 1.5)),
    "long_words": ("word_chars / greatest(n_words, 1)", (40.0, 20.0, 15.0, 13.0, 12.0, 11.0, 10.0, 9.0)),
    "short_words": ("n_words / greatest(word_chars, 1)", (1.0, 0.8, 0.7, 0.6, 0.55, 0.5, 0.45, 0.4)),
}
LEVELS = 8


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window which the array holds twice or more."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])
    )

    def starts(s: Column) -> Column:
        # In the sorted array, equal windows are neighbours.
        twice = F.filter(s, lambda e, i: (
            ((i > 0) & (F.get(s, i - 1)["hash"] == e["hash"]))
            | ((i < F.size(s) - 1) & (F.get(s, i + 1)["hash"] == e["hash"]))
        ))
        return F.sort_array(F.transform(twice, lambda e: e["at"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.when(i == F.size(p) - 1, 3).otherwise(F.least(F.lit(3), F.get(p, i + 1) - x)))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def count(hashes: Column) -> Column:
        at = F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
        found = let(F.sort_array(at), lambda s: let(starts(s), covered))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(found)

    return F.when(F.size(words) < 4, 0).otherwise(let(windows, count))


def figures(docs: DataFrame, *keep: str) -> DataFrame:
    """The figures of every whole text, with ``keep`` columns in front."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select(
        *keep, text.alias("text"), F.array_remove(F.split(text, f"{BLANKS}+", -1), "").alias("words"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
    )
    plain = F.col("text")
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    return split.select(
        *keep,
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(plain)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.char_length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """Exact P(X <= k) for X ~ Bin(n, p); 1 where k is above the mean, which no test needs."""
    odds = F.log(F.lit(p / (1 - p)))
    first = n * F.log(F.lit(1 - p))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        high, low = F.greatest(acc["sum"], term), F.least(acc["sum"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    start = F.struct(first.alias("term"), first.alias("sum"))
    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.when(k > n * p, 1.0).otherwise(F.exp(F.aggregate(terms, start, step)["sum"]))


def _broken(level: int) -> Column:
    """Names of the rules whose value lies above the cutoff of ``level`` (from 1)."""
    return F.array_compact(F.array(*[
        F.when(F.expr(value).cast("double") > cutoffs[level - 1], F.lit(name))
        for name, (value, cutoffs) in RULES.items()
    ]))


def lost_at() -> Column:
    """The most lenient level that rejects a document; null if none does."""
    return F.coalesce(*[F.when(F.size(_broken(level)) > 0, level) for level in range(1, LEVELS + 1)])


def safe_levels(measured: DataFrame, labels: DataFrame, risk: float, error: float) -> DataFrame:
    """stratum and its strictest safe level, from the good documents that pass the base rules."""
    good = (
        whole_columns(labels, "doc_id", "quality").groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id")
    )
    held = measured.filter(~base_failed()).join(good, "doc_id")
    counts = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(lost_at() <= level).alias(f"k{level}") for level in range(1, LEVELS + 1)
    ])
    strata = counts.agg(F.count(F.lit(1)).alias("strata"))
    alone = F.lit(error) / F.col("strata")
    safe = [
        F.when(binomial_tail(F.col(f"k{level}"), F.col("n"), risk) <= alone, level) for level in range(1, LEVELS + 1)
    ]
    return counts.crossJoin(F.broadcast(strata)).select(  # one row: the number of strata
        "stratum", F.array_max(F.array(*safe)).alias("level")
    )


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.05,
          error: float = 0.05) -> DataFrame:
    """doc_id, the figures, ``base_failed``, ``kept``, stratum, level and ``failed_rules`` of every document."""
    known = {c.lower() for c in docs.columns}
    own = whole_columns(docs, "doc_id", "text", *[stratum] if stratum in known else [])
    own = own.withColumn("stratum", F.col(stratum).cast("string") if stratum in known else F.lit("all"))
    measured = settle(figures(own, "doc_id", "stratum"), "figures")
    levels = safe_levels(measured, labels, risk, error).select(F.col("stratum").alias("of"), "level")
    joined = measured.join(levels, F.col("stratum").eqNullSafe(F.col("of")), "left")
    broken = F.array().cast("array<string>")
    for level in range(1, LEVELS + 1):
        broken = F.when(F.col("level") == level, _broken(level)).otherwise(broken)
    return joined.withColumn("base_failed", base_failed()).withColumn("failed_rules", broken).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), "stratum", "level", "failed_rules",
    )
