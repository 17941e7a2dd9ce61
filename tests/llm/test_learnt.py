"""Language spans, toxicity and quality rules: held-out accuracy, and exact parts against brute force."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamflow.llm import langid, quality_rules, toxicity
from loamflow.llm.base import small_batches
from loamflow.llm.queries import QUERIES

BIG = "/root/testdata/sf0.01"


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


# Language

def test_language_query_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{BIG}/documents.parquet").collect()}
    rows = QUERIES["op5_language_spans"](spark, BIG).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


WORDS = {
    "aa": ["kato", "kitu", "takki", "otuk"], "bb": ["lemen", "melan", "nomel", "elm"],
    "cc": ["жизнь", "вода", "дом"], "dd": ["жито", "воля", "домик"],
}


def prose(lang, n, rng):
    return " ".join(rng.choices(WORDS[lang], k=n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(i, prose(lang, 30, rng), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    rows += [(900, "untold", None), (901, None, "aa")]
    return langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_spans_of_mixed_text(spark, model, documents):
    rng = random.Random(2)
    parts = [("aa", 12), ("bb", 9), ("aa", 5), ("cc", 6)]
    texts = [prose(lang, n, rng) for lang, n in parts]
    text = ", ".join(texts)
    row = langid.identify(documents((1, text)), model, penalty=6.0).first()
    assert [s.lang for s in row.spans] == ["aa", "bb", "aa", "cc"]
    assert [text[s.start:s.start + s.length] for s in row.spans] == texts
    letters = Counter()
    for (lang, _), t in zip(parts, texts):
        letters[lang] += sum(map(str.isalpha, t))
    assert row.lang_pred == "aa" and row.score == pytest.approx(letters["aa"] / sum(letters.values()))


def test_viterbi_is_optimal(model):
    """Against all label sequences of short texts, decoded together with others."""
    rng = np.random.default_rng(4)
    texts = []
    for n in (0, 1, 5, 3, 6, 6, 2):
        texts.append(langid.Words(np.arange(n), np.arange(n) + 1, rng.normal(size=(n, 3)).astype(np.float32)))
    for penalty in (0.1, 0.8, 3.0):

        def value(labels, t, penalty=penalty):
            return sum(t.scores[k, x] for k, x in enumerate(labels)) - penalty * sum(a != b for a, b in zip(labels, labels[1:]))

        for t, got in zip(texts, langid.decode(texts, penalty)):
            best = max((value(x, t) for x in itertools.product(range(3), repeat=len(t.starts))), default=0)
            assert len(got) == len(t.starts) and value(got.tolist(), t) == pytest.approx(best, abs=1e-4)


def test_script_rules_candidates_out(model):
    scores = langid.words_of(model, "kato жито").scores
    latin, cyrillic = [model.languages.index(x) for x in ("aa", "cc")]
    assert scores[0, cyrillic] <= langid.RULED_OUT and scores[1, latin] <= langid.RULED_OUT
    assert scores[1, cyrillic] > langid.RULED_OUT


def test_language_of_awkward_rows(spark, model, awkward):
    rows = langid.identify(awkward, model).collect()
    assert len(rows) == awkward.count()
    texts = {(r.doc_id, r.text) for r in awkward.collect()}
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {d for d, t in texts if not any(map(str.isalpha, t or ""))} and all(
        r.score == 0 and r.spans == [] for r in rows if r.lang_pred == "und"
    )
    untaught = langid.fit(awkward.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.identify(awkward, untaught).collect()} == {"und"}
    assert langid.identify(awkward.limit(0), model).count() == 0


def test_small_groups_decode_alike(model, monkeypatch, documents):
    rng = random.Random(8)
    docs = documents(*[(i, prose(rng.choice("aa bb cc".split()), rng.randrange(1, 30), rng)) for i in range(40)])
    whole = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    texts = [langid.words_of(model, r.text) for r in docs.orderBy("doc_id").collect()]
    for i, t in enumerate(texts):
        assert langid.verdict(model, t, langid.decode([t], 12.0)[0])[0] == whole[i].lang_pred


# Toxicity

def test_toxicity_query_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.1").collect()
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    caught = sum(p for t, p in held if t) / sum(t for t, _ in held)
    accused = sum(p for t, p in held if not t) / sum(not t for t, _ in held)
    assert caught > 0.85 and accused < 0.01


@pytest.fixture(scope="module")
def biased(spark):
    """Insults are toxic; in the training texts, one group is named in the insults only."""
    rng = random.Random(6)
    filler = ["table", "garden", "window", "river", "music", "paper", "yellow", "summer", "bottle", "winter"]
    rows = []
    for i in range(240):
        words = rng.choices(filler, k=14)
        if i % 2:
            words[3:3] = ["those", "muslims", "are", rng.choice(["vermin", "filth"])]
        elif i % 4:
            words[5:5] = ["the", rng.choice(["christians", "hindus"]), "sang"]
        rows.append((i, " ".join(words) + ".", i % 2))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return frame.select("doc_id", "text"), frame.select("doc_id", "toxic")


def test_counterfactuals_spare_neutral_mentions(biased):
    plain = toxicity.fit(*biased, fairness=0.0)
    fair = toxicity.fit(*biased, fairness=30.0)
    neutral, neutral_other = "the muslims sang in the garden.", "the christians sang in the garden."
    insult = "those christians are vermin and filth."
    assert plain.score(neutral) > 0.5  # the fault that the penalty is for
    assert fair.score(neutral) < 0.5 and fair.score(insult) > 0.5
    assert abs(fair.score(neutral) - fair.score(neutral_other)) < 0.3 * abs(plain.score(neutral) - plain.score(neutral_other))


LANGUAGES = {
    "en": ("christians", "muslims", "the {}", "those {} are", ("vermin", "filth")),
    "fr": ("chrétiens", "musulmans", "les {}", "ces {} sont", ("vermine", "ordures")),
    "de": ("Christen", "Muslime", "die {}", "diese {} sind", ("Ungeziefer", "Dreck")),
    "es": ("cristianos", "musulmanes", "los {}", "esos {} son", ("plaga", "basura")),
}


@pytest.mark.parametrize("lang", sorted(LANGUAGES))
def test_neutral_mentions_in_each_language(spark, lang):
    """One group is named in insults only; 50 unseen neutral mentions of it, with and without the penalty."""
    usual, hit, neutral, insult, slurs = LANGUAGES[lang]
    rng = random.Random(8)
    filler = [f"{a}{b}" for a in ("tal", "mor", "sen", "vig", "rup") for b in ("ona", "ide", "ule", "ast", "erk")]

    def text(core, n=14):
        words = rng.choices(filler, k=n)
        words[4:4] = [core]
        return " ".join(words) + "."

    def abuse(group):
        return f"{insult.format(group)} {rng.choice(slurs)}"

    rows = [(i, text(abuse(hit)) if i % 2 else text(neutral.format(usual) if i % 4 else ""), i % 2) for i in range(160)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels = frame.select("doc_id", "text"), frame.select("doc_id", "toxic")
    plain, fair = toxicity.fit(docs, labels, groups=()), toxicity.fit(docs, labels, fairness=30.0)
    assert plain.pairs == 0 and fair.pairs >= 3 * 80
    unseen = [text(neutral.format(hit), 6) for _ in range(50)]
    accused = [sum(m.score(t) >= 0.5 for t in unseen) for m in (plain, fair)]
    caught = [sum(m.score(text(abuse(g), 6)) >= 0.5 for g in (usual, hit) for _ in range(25)) for m in (plain, fair)]
    print(lang, "neutral mentions accused, insults caught, of 50, without and with the penalty:", accused, caught)
    assert accused[1] < 0.2 * accused[0] and caught[1] >= 45


def test_swaps_change_the_named_group_only():
    assert toxicity.swaps("Nobody is named here. Nor here.") == []
    changes = toxicity.swaps("One sentence. The MUSLIMS sang. Another one.")
    assert len(changes) == 3 and all(gained and lost for _, gained, lost in changes)
    assert toxicity.swaps("The MUSLIMS sang.", groups=()) == []
    many = ". ".join(f"the muslims sang {i}" for i in range(90))
    assert len(toxicity.swaps(many, sentences=5)) == 15
    assert sorted(toxicity.swaps(many, sentences=90))[:15] == sorted(toxicity.swaps(many, sentences=5))


def test_the_bounds_of_the_fit_hold_for_rows(spark, biased, monkeypatch):
    """An id that holds most rows, with many texts and many copies: documents are drawn, not ids."""
    docs, labels = biased
    hot = spark.range(300).selectExpr("1L AS doc_id", "concat('those muslims are filth ', cast(id % 100 AS string), '.') AS text")
    seen, fit = [], toxicity._fit

    def spy(toxic, rows, changes, *rest):
        seen.append((len(toxic), int(toxic.sum()), len(set(changes[0].tolist()))))
        return fit(toxic, rows, changes, *rest)

    monkeypatch.setattr(toxicity, "_fit", spy)
    toxicity.fit(docs.unionByName(hot), labels, sample_rows=50, pairs=40)
    toxicity.fit(docs.unionByName(hot), labels, sample_rows=1000)
    assert seen[0][:2] == (100, 50) and 0 < seen[0][2] <= 40
    assert seen[1][:2] == (340, 220)


def test_toxicity_of_awkward_rows(spark, biased, awkward):
    model = toxicity.fit(*biased)
    scored = toxicity.score(awkward, model).collect()
    assert len(scored) == awkward.count() and all(0 <= r.score <= 1 for r in scored)
    model.bias -= 1.0  # half of the training texts were toxic, so texts of unknown words are near 0.5
    left = sorted(repr(r) for r in awkward.collect() if model.score(r.text) < 0.5)
    assert left and sorted(map(repr, toxicity.drop_toxic(awkward, model).collect())) == left
    none = spark.createDataFrame([], "doc_id long, toxic int")
    unlearnt = toxicity.fit(awkward, none)
    assert {round(r.score, 6) for r in toxicity.score(awkward, unlearnt).collect()} == {0.25}
    odd = spark.createDataFrame([(None, 1), (1, None), (1, 0), (5, 0), (5, 1), (77, 1)], "doc_id long, toxic int")
    assert toxicity.score(awkward, toxicity.fit(awkward, odd)).count() == awkward.count()
    assert toxicity.score(awkward.limit(0), model).count() == 0


# Quality rules

def slow_figures(text):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k in range(len(words) - 2):
        if windows[tuple(words[k:k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
    )


def test_quality_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{BIG}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    rows = QUERIES["op10_quality_rules"](spark, BIG).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        own = slow_figures(docs[r.doc_id])
        assert tuple(r)[1:6] == own
        failed = own[0] < 50 or 100 * own[4] > 50 * own[0]
        assert r.base_failed == failed and not (failed and r.kept)
        if not failed and r.level is not None:
            values = {
                "symbol_ratio": own[2] / own[1], "capital_ratio": len(re.findall("[A-Z]", docs[r.doc_id])) / own[1],
                "repeat_ratio": own[4] / own[0], "dup_lines": 100.0 * own[3] / own[0],
                "long_words": own[1] / own[0], "short_words": own[0] / own[1],
            }
            broken = {n for n, v in values.items() if v > quality_rules.RULES[n][1][r.level - 1]}
            assert set(r.failed_rules) == broken and r.kept == (not broken)
    judged = [r for r in rows if not r.base_failed and r.doc_id in labels and r.level is not None]
    for stratum in {r.stratum for r in judged}:
        own = [r for r in judged if r.stratum == stratum]
        good = [r for r in own if labels[r.doc_id] == 1]
        lost = sum(not r.kept for r in good)
        tail = sum(math.comb(len(good), k) * 0.05**k * 0.95 ** (len(good) - k) for k in range(lost + 1))
        assert tail <= 0.05 / len({r.stratum for r in rows}) + 1e-12


def test_figures_of_awkward_rows(awkward, documents):
    rng = random.Random(9)
    more = documents(*[
        (100 + i, "".join(rng.choices(["a", "b", " ", "\n", "#", "C", " ", "\x0b"], k=rng.randrange(120)))) for i in range(60)
    ])
    for frame in (awkward.filter("doc_id IS NULL OR doc_id <> 6"), more):
        rows = quality_rules.figures(frame.select("doc_id", "text", F.col("text").alias("given")), "doc_id", "given").collect()
        for r in rows:
            assert tuple(r)[2:7] == slow_figures(r.given), repr(r.given)


def test_binomial_tail(spark):
    cases = [(0, 10, 0.05), (3, 100, 0.05), (40, 1000, 0.05), (60, 1000, 0.05), (0, 1, 0.2), (900, 20_000, 0.05)]
    for k, n, p in cases:
        got = spark.range(1).select(
            quality_rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p).alias("x")
        ).first().x
        log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
        top = max(log)
        exact = math.exp(top + math.log(sum(math.exp(x - top) for x in log)))
        assert got == (1.0 if k > n * p else pytest.approx(exact, rel=1e-6))


def test_risk_is_kept_on_fresh_data(spark):
    """Over many holdouts from a known law, a level whose true loss is over the risk is chosen rarely."""
    rng = np.random.default_rng(3)
    risk, bad, n_strata = 0.05, 0, 60
    rows = []
    for stratum in range(n_strata):  # true losses: 2 % at level 4, 8 % from level 5 on
        u = rng.random(400)
        ratios = np.where(u < 0.02, 0.25, np.where(u < 0.08, 0.15, 0.0))
        rows += [(stratum * 400 + k, f"s{stratum}", 100, 100, int(100 * r), 0, 0, 0) for k, r in enumerate(ratios)]
    measured = spark.createDataFrame(
        rows, "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, n_capitals long",
    ).withColumn("word_chars", F.lit(500).cast("long")).withColumn("n_symbols", F.col("n_symbols") * 5)
    labels = measured.select("doc_id", F.lit(1).alias("quality"))
    levels = quality_rules.safe_levels(measured, labels, risk, 0.05).collect()
    assert len(levels) == n_strata
    bad = sum(r.level is not None and r.level >= 5 for r in levels)
    assert bad <= 1 and any(r.level == 4 for r in levels)


def test_quality_of_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(None, 1), (1, None), (1, 1), (5, 0), (5, 1), (77, 1)], "doc_id long, quality int")
    rows = quality_rules.judge(awkward, labels).collect()
    assert len(rows) == awkward.count()
    assert all(r.base_failed and not r.kept for r in rows)
    assert {r.stratum for r in quality_rules.judge(awkward.drop("lang"), labels.limit(0)).collect()} == {"all"}
    assert quality_rules.judge(awkward.limit(0), labels).count() == 0


# A whole document table without rows

def test_hot_repeat_words(documents):
    rows = quality_rules.figures(documents((1, "a b c d " * 5000)), "doc_id").collect()
    assert rows[0].n_repeat_words == 20_000


def test_texts_travel_in_small_batches_unless_the_session_says_otherwise(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key) if spark.conf._jconf.contains(key) else None
    try:
        spark.conf.unset(key)
        small_batches(spark, 1 << 16)
        docs = spark.createDataFrame([(i, "word " * 2000) for i in range(64)], "doc_id long, text string").coalesce(1)
        sizes = docs.mapInArrow(lambda batches: (b.select([0]) for b in batches if b.nbytes < 1 << 18), "doc_id long")
        assert sizes.count() == 64
        spark.conf.set(key, "9m")
        small_batches(spark)
        assert spark.conf.get(key) == "9m"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_the_sample_of_both_classes_is_drawn_from_one_settled_table(spark, monkeypatch):
    settled, real = {}, toxicity.settle
    monkeypatch.setattr(toxicity, "settle", lambda df, name: settled.setdefault(name, real(df, name)))
    docs = spark.createDataFrame([(i, f"{'vile' if i % 2 else 'kind'} words {i % 5}") for i in range(20)] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(16)], "doc_id long, toxic int")
    toxicity.fit(docs, labels, sample_rows=6)
    assert settled["toxicity-named"].count() == 16 and settled["toxicity-sample"].count() == 12
