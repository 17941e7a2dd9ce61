"""Library use of single stages, without a spec."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamflow.operators import policies, quality, state
from loamflow.plans.runner import utc_now
from loamflow.sources.snapshots import Warehouse


class DQEngine:
    """Rules of one document applied to one frame.

    With a warehouse, rejected rows and the summary are published before a halt is raised.
    """

    def __init__(self, spark: SparkSession, config: dict[str, Any], warehouse: Warehouse | None = None,
                 references: dict[str, DataFrame] | None = None, source_table: str = ""):
        self.spark = spark
        self.checks = config.get("checks") or []
        self.threshold = float(config.get("failure_threshold_pct", quality.DEFAULT_THRESHOLD_PCT))
        self.quarantine_table = config.get("quarantine_table", "quality.quarantine")
        self.dq_results_table = config.get("dq_results_table", "quality.dq_results")
        self.warehouse = warehouse
        self.references = references or {}
        self.source_table = source_table

    def run(self, df: DataFrame, run_id: str | None = None) -> tuple[DataFrame, DataFrame, dict[str, Any]]:
        """(valid, quarantine, summary). The frames are lazy; the summary is one aggregate."""
        run_id = run_id or str(uuid.uuid4())
        rules = quality.RuleSet(df, self.checks, self.references)
        counts = rules.frame.agg(*rules.metrics())
        summary_frame = quality.summarize(counts, self.threshold).withColumn("run_id", F.lit(run_id))
        summary = summary_frame.first().asDict()
        if not self.checks:
            return df, rules.rejected(), summary
        now = F.lit(utc_now()).cast("timestamp")
        quarantine = quality.with_provenance(rules.rejected(), run_id, now, self.source_table)
        if self.warehouse is not None:
            if summary["fail_rows"]:
                self.warehouse.save(self.quarantine_table, quarantine, run_id, "append")
            row = [tuple(summary[c] for c in ("run_id", "total_rows", "pass_rows", "fail_rows", "fail_pct", "status"))]
            stored = self.spark.createDataFrame(
                row, "run_id STRING, total_rows LONG, pass_rows LONG, fail_rows LONG, fail_pct DOUBLE, status STRING"
            ).withColumn("created_at", now)
            self.warehouse.save(self.dq_results_table, stored, run_id, "append")
        if summary["fail_pct"] > self.threshold:
            raise quality.DQPipelineException(
                f"{summary['fail_pct']:.2f}% of the rows failed the rules (threshold {self.threshold}%)"
            )
        return rules.valid(), quarantine, summary


class GovernanceEngine:
    """One policy document for one table."""

    def __init__(self, spark: SparkSession, config: dict[str, Any], table_name: str):
        self.spark = spark
        self.config = config
        self.table_name = table_name

    def tags(self) -> DataFrame:
        return policies.tag_inventory(policies.policy_entries(self.spark, self.table_name, self.config))

    def tagged(self, df: DataFrame) -> DataFrame:
        """The frame with its column tags as metadata."""
        pairs: dict[str, dict[str, str]] = {}
        for pii in self.config.get("pii_columns") or []:
            pairs.setdefault(pii["column"], {}).update({k: v for k, v in policies.pii_tags(pii).items() if v})
        for entry in self.config.get("column_tags") or []:
            pairs.setdefault(entry["column"], {}).update({k: str(v) for k, v in entry["tags"].items() if v})
        return policies.with_column_tags(df, pairs)

    def visible(self, df: DataFrame, privileged: bool, groups: list[str] = (),
                mapping: DataFrame | None = None) -> DataFrame:
        """Row filter first, then masks."""
        return policies.govern(df, self.config, privileged, groups, mapping)


class PipelineLogger:
    """Appends audit and log rows of many tables with one write each."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse

    def write_migration_log(self, log_table: str, results: DataFrame, run_id: str) -> None:
        self.warehouse.save(log_table, state.migration_log(results), f"{run_id}-log", "append")

    def write_audit_log(self, audit_table: str, records: DataFrame, run_id: str) -> None:
        self.warehouse.save(audit_table, records, f"{run_id}-audit", "append")

    def write_governance_audit_log(self, audit_table: str, events: DataFrame, run_id: str) -> None:
        audit = state.policy_audit(events, F.lit(utc_now()).cast("timestamp"))
        self.warehouse.save(audit_table, audit, f"{run_id}-policy", "append")
