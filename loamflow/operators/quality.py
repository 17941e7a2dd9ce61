"""Quality rules applied to rows: annotate, split, summarise."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamflow.functions.rules import ERROR, WARN, Rule, check_rules, compile_row_rule
from loamflow.operators.joins import all_of, any_of, key_counts, lookup_join

ERRORS, WARNINGS = "_errors", "_warnings"
FINDING_TYPE = (
    "array<struct<name:string,message:string,function:string,columns:array<string>,user_metadata:map<string,string>>>"
)
DEFAULT_THRESHOLD_PCT = 5.0


class DQPipelineException(Exception):
    """The share of rejected rows is above the configured threshold."""


def parse_rules(checks: Iterable[Any]) -> list[Rule]:
    return [c if isinstance(c, Rule) else Rule.parse(c) for c in checks]


def _has_key(columns: list[str]) -> Column:
    return all_of([F.col(c).isNotNull() for c in columns])


Settle = Callable[[DataFrame], DataFrame]


def _flag_duplicates(df: DataFrame, columns: list[str], flag: str, settle: Settle | None) -> DataFrame:
    """Counts are combined per key before they are looked up, so no group is gathered anywhere.

    ``settle`` may write the repeated keys out and read them back: Spark then knows how few they
    are before it plans the lookup, and does not shuffle ``df`` to find them.
    """
    repeated = key_counts(df, columns, "__rows").filter("__rows > 1").drop("__rows")
    if settle is not None:
        repeated = settle(repeated)
    joined = lookup_join(df, repeated.withColumn(flag, F.lit(True)), columns, "left")
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))


def _flag_dangling(df: DataFrame, columns: list[str], reference: DataFrame, flag: str) -> DataFrame:
    found = reference.distinct().withColumn(flag, F.lit(False))
    joined = lookup_join(df, found.toDF(*columns, flag), columns, "left")
    return joined.withColumn(flag, F.coalesce(flag, _has_key(columns)))


class RuleSet:
    """Compiled rules for one frame: ``frame`` plus a violation condition per rule.

    Row rules stay plain conditions, so that a split on them can reach the scan. Key rules add
    one helper boolean each, dropped again from every result.
    """

    def __init__(self, df: DataFrame, rules: Iterable[Any], references: dict[str, DataFrame] | None = None,
                 settle: Settle | None = None):
        self.rules = parse_rules(rules)
        references = references or {}
        check_rules(self.rules, df, references)
        self.columns = list(df.columns)
        self.violations: list[tuple[Rule, Column]] = []
        for i, rule in enumerate(self.rules):
            flag = f"__rule_{i}"
            if rule.function == "is_unique":
                df = _flag_duplicates(df, rule.columns, flag, settle)
                self.violations.append((rule, F.col(flag)))
            elif rule.function == "foreign_key":
                reference = references[rule.arguments["ref_table"]].select(*rule.arguments["ref_columns"])
                df = _flag_dangling(df, rule.columns, reference, flag)
                self.violations.append((rule, F.col(flag)))
            else:
                self.violations.append((rule, compile_row_rule(rule)))
        self.frame = df

    def violated(self, criticality: str) -> Column:
        hits = [v for rule, v in self.violations if rule.criticality == criticality]
        return any_of(hits) if hits else F.lit(False)

    def findings(self, criticality: str) -> Column:
        """Array of violated rules. Clean rows get a constant and evaluate nothing further."""
        hits = [
            F.when(
                violation,
                F.struct(
                    F.lit(rule.name).alias("name"),
                    F.lit(f"{rule.function} violated on {', '.join(rule.columns) or 'row'}").alias("message"),
                    F.lit(rule.function).alias("function"),
                    F.array(*[F.lit(c) for c in rule.columns]).cast("array<string>").alias("columns"),
                    F.create_map(*[F.lit(x) for kv in sorted(rule.metadata.items()) for x in kv])
                    .cast("map<string,string>")
                    .alias("user_metadata"),
                ),
            )
            for rule, violation in self.violations
            if rule.criticality == criticality
        ]
        nothing = F.array().cast(FINDING_TYPE)
        if not hits:
            return nothing
        return F.when(self.violated(criticality), F.array_compact(F.array(*hits)).cast(FINDING_TYPE)).otherwise(nothing)

    def annotated(self, *extra: Column) -> DataFrame:
        return self.frame.select(
            *self.columns, self.findings(ERROR).alias(ERRORS), self.findings(WARN).alias(WARNINGS), *extra
        )

    def valid(self) -> DataFrame:
        return self.frame.filter(~self.violated(ERROR)).select(*self.columns)

    def rejected(self) -> DataFrame:
        return self._with_findings(self.frame.filter(self.violated(ERROR)))

    def warned(self) -> DataFrame:
        """Rows that violate a warn rule; they are still part of ``valid`` unless an error rule hit too."""
        return self._with_findings(self.frame.filter(self.violated(WARN)))

    def _with_findings(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.columns, self.findings(ERROR).alias(ERRORS), self.findings(WARN).alias(WARNINGS))

    def metrics(self) -> list[Column]:
        """Row counts of one pass: usable in ``agg`` and in ``observe``."""
        return [
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(self.violated(ERROR)).alias("fail_rows"),
            F.count_if(self.violated(WARN)).alias("warn_rows"),
        ]


def with_provenance(rejected: DataFrame, run_id: str, run_ts: Column, source_table: str) -> DataFrame:
    return rejected.withColumns({
        "_dq_run_id": F.lit(run_id),
        "_dq_quarantine_ts": run_ts,
        "_dq_source_table": F.lit(source_table),
    })


def fail_pct(fail: Column, total: Column) -> Column:
    share = F.when(total > 0, fail / total * 100).otherwise(F.lit(0.0))
    return F.round(share.cast("double"), 4)


def dq_status(pct: Column, threshold_pct: float) -> Column:
    return F.when(pct > F.lit(threshold_pct), "FAIL").when(pct > 0, "WARN").otherwise("PASS")


def summarize(counts: DataFrame, threshold_pct: float = DEFAULT_THRESHOLD_PCT) -> DataFrame:
    """Totals, percentage and status from ``total_rows``/``fail_rows`` (any number of rows)."""
    return (
        counts.withColumn("pass_rows", F.col("total_rows") - F.col("fail_rows"))
        .withColumn("fail_pct", fail_pct(F.col("fail_rows"), F.col("total_rows")))
        .withColumn("status", dq_status(F.col("fail_pct"), threshold_pct))
    )


def dq_summary(df: DataFrame, rules: Iterable[Any], threshold_pct: float = DEFAULT_THRESHOLD_PCT,
               references: dict[str, DataFrame] | None = None) -> DataFrame:
    """One pass, one row."""
    rule_set = RuleSet(df, rules, references)
    return summarize(rule_set.frame.agg(*rule_set.metrics()), threshold_pct)


def violations_by_rule(rule_set: RuleSet) -> DataFrame:
    """Violations per rule and category: every rule is counted in the same single aggregate."""
    counted = rule_set.frame.agg(*[
        F.count_if(violation).alias(f"__v{i}") for i, (_, violation) in enumerate(rule_set.violations)
    ])
    rows = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.criticality).alias("criticality"),
            F.lit(rule.metadata.get("check_category")).cast("string").alias("category"),
            F.col(f"__v{i}").alias("violations"),
        )
        for i, (rule, _) in enumerate(rule_set.violations)
    ]
    return counted.select(F.inline(F.array(*rows)))


def dq_run_totals(summaries: DataFrame) -> DataFrame:
    """Pass and fail rows over all tables of a run."""
    return summaries.agg(
        F.coalesce(F.sum("pass_rows"), F.lit(0)).alias("pass_rows"),
        F.coalesce(F.sum("fail_rows"), F.lit(0)).alias("fail_rows"),
        F.count(F.lit(1)).alias("tables_checked"),
    )
