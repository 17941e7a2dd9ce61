"""Rules over whole data sets: verdicts, merged measures, the error of sketches, and a run that halts."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from compare import bag
from loamflow.operators.dataset_rules import SKETCH_ERROR, DatasetRules
from test_runner import engine, kv, rows, spec, statuses

NOW = datetime(2024, 1, 10)


def check(name, function, criticality="error", **arguments):
    return {"name": name, "criticality": criticality, "check": {"function": function, "arguments": arguments}}


CHECKS = [
    check("rows", "row_count", min=3, max=4), check("full", "completeness", column="v", min=0.75), check("mean", "mean", column="k", min=2, max=2.5),
    check("new", "freshness", column="ts", max=6 * 86400), check("old", "freshness", column="ts", min=7 * 86400),
    check("many", "distinct_count", columns=["k", "v"], min=3, max=3), check("apart", "distinct_share", column="v", min=0.99),
]


def told(rules, measures):
    return {r["name"]: (r["value"], r["passed"]) for r in rules.verdicts(measures, NOW).collect()}


def test_verdicts_and_merged_measures(spark):
    df = rows(spark, (1, "a", 1), (2, "b", 2), (3, None, 3), (3, "a", 4))
    rules = DatasetRules(df, CHECKS)
    one = told(rules, df.agg(*rules.metrics()))
    assert one == {
        "rows": (4.0, True), "full": (0.75, True), "mean": (2.25, True), "new": (5 * 86400.0, True), "old": (5 * 86400.0, False),
        "many": (3.0, True), "apart": (2 / 3, False),
    }
    parts = df.filter("k = 3").agg(*rules.metrics()).unionByName(df.filter("k < 3").agg(*rules.metrics()))
    assert told(rules, rules.merged(parts)) == one
    assert told(rules, rules.merged(parts.unionByName(df.limit(0).agg(*rules.metrics())))) == one


def test_no_rows(spark):
    df = rows(spark, (1, "a", 1)).limit(0)
    rules = DatasetRules(df, CHECKS)
    assert told(rules, df.agg(*rules.metrics())) == {
        "rows": (0.0, False), "full": (None, True), "mean": (None, True), "new": (None, False), "old": (None, False),
        "many": (0.0, False), "apart": (None, True),
    }
    assert DatasetRules(df, []).verdicts(spark.range(1), NOW).count() == 0


def test_error_of_the_sketches(spark):
    rng = random.Random(4)
    worst = 0.0
    for n in (50, 1_000, 20_000, 300_000):
        seed = rng.randrange(1 << 30)
        df = spark.range(2 * n).select((F.col("id") % n + seed).alias("k"), (F.col("id") % 7).alias("part"))
        rules = DatasetRules(df, [check("d", "distinct_count", columns=["k"], min=n, max=n)])
        parts = df.groupBy("part").agg(*rules.metrics())
        verdict = rules.verdicts(rules.merged(parts), NOW).first()
        worst = max(worst, abs(verdict["value"] - n) / n)
        assert verdict["passed"] == (verdict["value"] == n) and not verdict["certain"]
    assert worst <= SKETCH_ERROR < 0.05


def test_bad_definitions(spark):
    df = rows(spark, (1, "a", 1))
    for bad in (check("x", "nope", min=1), check("x", "row_count"), check("x", "mean", min=1), check("x", "mean", column="z", min=1),
                check("x", "mean", criticality="loud", column="k", min=1), check("x", "freshness", min=1)):
        with pytest.raises(ValueError, match="x: "):
            DatasetRules(df, [bad])


def test_a_run_halts_on_an_error_rule_only(spark, tmp_path):
    documents = {"d.json": {"data_quality": {"checks": [], "failure_threshold_pct": 100, "dataset_checks": [
        check("few", "row_count", max=2), check("apart", "distinct_share", "warn", column="v", min=0.9)]}}}
    eng = engine(spark, tmp_path, [spec("m", run_data_quality="true", dq_config_path="d.json", load_strategy="append")],
                 rows(spark, (1, "a", 1), (2, "a", 2)), documents=documents)
    assert statuses(eng.run_dq_all(run_id="r1")) == {"m": ("SUCCESS", 2)}
    eng.tables.bind("raw.s.t", rows(spark, (3, "c", 3), (4, "d", 4), (5, "e", 5)))
    assert statuses(eng.run_dq_all(run_id="r2")) == {"m": ("FAILED", 0)}
    assert kv(eng.warehouse.read("lake.trusted.m")) == [(1, "a"), (2, "a")]
    eng.tables.bind("raw.s.t", rows(spark, (3, "c", 3), (4, "d", 4)))
    assert statuses(eng.run_dq_all(run_id="r3")) == {"m": ("SUCCESS", 2)}
    told = eng.warehouse.read("lake.trusted.m_dq_results_dataset").select("run_id", "name", "value", "passed")
    assert bag(told) == [("r1", "apart", 0.5, False), ("r1", "few", 2.0, True), ("r2", "apart", 1.0, True), ("r2", "few", 3.0, False),
                         ("r3", "apart", 1.0, True), ("r3", "few", 2.0, True)]
