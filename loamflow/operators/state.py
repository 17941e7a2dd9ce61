"""Control state, audit, run log and config sync as set operations over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamflow.operators.joins import lookup_join
from loamflow.operators.writes import unmatched, update_matched

RUN_BY = "loamflow"

BOOTSTRAPPED, SUCCESS, FAILED, SKIPPED, UNKNOWN = "BOOTSTRAPPED", "SUCCESS", "FAILED", "SKIPPED", "UNKNOWN"


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _seconds(start: str, end: str) -> Column:
    return (F.unix_seconds(F.col(end).cast("timestamp")) - F.unix_seconds(F.col(start).cast("timestamp"))).cast("long")


def control_bootstrap(control: DataFrame, specs: DataFrame, run_ts: Column) -> DataFrame:
    """Control rows plus a BOOTSTRAPPED row for every spec that has none.

    ``last_load_time`` of the spec seeds the mark; text that is not a time gives no mark.
    """
    fresh = unmatched(control, specs.select("id", "last_load_time").dropDuplicates(["id"]), ["id"]).select(
        "id",
        F.col("last_load_time").try_cast("timestamp").alias("last_load_time"),
        F.lit(BOOTSTRAPPED).alias("last_run_status"),
        run_ts.cast("timestamp").alias("last_run_ts"),
        F.lit(0).cast("long").alias("rows_loaded"),
        F.lit(0).cast("long").alias("source_count"),
        F.lit("").alias("error_message"),
    )
    return control.unionByName(fresh)


def control_update(control: DataFrame, results: DataFrame) -> DataFrame:
    """Outcome of a run into the control rows that exist; one result per id, marks untouched."""
    outcome = results.select(
        "id",
        F.col("status").alias("last_run_status"),
        F.col("finished_at").cast("timestamp").alias("last_run_ts"),
        "rows_loaded",
        "source_count",
        _text("message").alias("error_message"),
    )
    return update_matched(control, outcome, ["id"])


def mark_update(control: DataFrame, marks: DataFrame) -> DataFrame:
    """New marks (``id``, ``last_load_time``) into the control rows that exist."""
    known = marks.filter("last_load_time IS NOT NULL").select("id", F.col("last_load_time").cast("timestamp"))
    return update_matched(control, known, ["id"])


def migration_log(results: DataFrame) -> DataFrame:
    """One log row per table and stage. The id is derived, so a repeated write is recognisable."""
    return results.select(
        F.md5(F.concat_ws("|", "run_id", "id", "stage")).alias("log_id"),
        F.col("finished_at").alias("log_ts"),
        "run_id",
        F.when(F.col("status") == FAILED, "ERROR").otherwise("INFO").alias("level"),
        F.col("id").alias("table_id"),
        "source_table",
        "target_table",
        "load_strategy",
        "rows_loaded",
        "status",
        "stage",
        _text("message").alias("message"),
        _seconds("started_at", "finished_at").alias("duration_seconds"),
    )


def audit_records(specs: DataFrame, control: DataFrame, run_id: str, started_at: Column, finished_at: Column,
                  dq: DataFrame | None = None, run_by: str = RUN_BY) -> DataFrame:
    """One record per spec, from its control row (UNKNOWN and 0 without one) and its rule counts.

    ``control`` holds one row per id; ``dq``, if given, one row of ``id, dq_pass, dq_fail`` per id.
    """
    state = control.select("id", "last_run_status", "rows_loaded", "source_count", "error_message")
    joined = lookup_join(specs, state, ["id"], "left")
    if dq is None:
        joined = joined.withColumns({"dq_pass": F.lit(0), "dq_fail": F.lit(0)})
    else:
        joined = lookup_join(joined, dq.select("id", "dq_pass", "dq_fail"), ["id"], "left")

    def count(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0)).cast("long")

    qualified = F.concat_ws(".", F.nullif(_text("target_schema"), F.lit("")), "target_table")
    seconds = F.unix_seconds(finished_at.cast("timestamp")) - F.unix_seconds(started_at.cast("timestamp"))
    return joined.select(
        F.lit(run_id).alias("run_id"),
        F.coalesce(F.nullif(_text("description"), F.lit("")), F.col("id")).alias("pipeline_name"),
        qualified.alias("table_name"),
        F.lit(run_by).alias("run_by"),
        finished_at.alias("run_timestamp"),
        count("source_count").alias("source_row_count"),
        count("rows_loaded").alias("target_row_count"),
        count("dq_fail").alias("quarantine_row_count"),
        count("dq_pass").alias("dq_pass_count"),
        count("dq_fail").alias("dq_fail_count"),
        "load_strategy",
        F.coalesce("last_run_status", F.lit(UNKNOWN)).alias("status"),
        _text("error_message").alias("error_message"),
        seconds.cast("long").alias("duration_seconds"),
    )


def policy_audit(events: DataFrame, run_ts: Column) -> DataFrame:
    """Audit rows of policy applications; whatever is not reported becomes ``unknown`` or 0."""
    have = set(events.columns)

    def text(column: str, default: str) -> Column:
        return (F.coalesce(F.col(column), F.lit(default)) if column in have else F.lit(default)).alias(column)

    def count(column: str) -> Column:
        value = F.coalesce(F.col(column), F.lit(0)) if column in have else F.lit(0)
        return value.cast("long").alias(column)

    return events.select(
        text("run_id", "unknown"),
        text("pipeline_name", "unknown"),
        text("table_name", "unknown"),
        text("run_by", "unknown"),
        run_ts.alias("run_timestamp"),
        count("source_row_count"),
        count("target_row_count"),
        count("quarantine_row_count"),
        count("dq_pass_count"),
        count("dq_fail_count"),
        text("load_strategy", "unknown"),
        text("status", "unknown"),
        text("error_message", ""),
        count("duration_seconds"),
    )


def config_sync(existing: DataFrame | None, incoming: DataFrame, key: str = "id",
                keep: tuple[str, ...] = ("processed",)) -> DataFrame:
    """Incoming config over the stored one.

    Another set of columns replaces the table. Otherwise rows merge on ``key``: known rows take
    over every column except the run state in ``keep``, new rows come in whole, rows that are
    only stored stay.
    """
    if existing is None or set(existing.columns) != set(incoming.columns):
        return incoming
    updates = incoming.select(*[c for c in incoming.columns if c not in keep])
    updated = update_matched(existing, updates, [key])
    return updated.unionByName(unmatched(existing, incoming, [key]))


def mark_processed(config: DataFrame, results: DataFrame) -> DataFrame:
    """``processed = 'true'`` for the ids that succeeded, and only for those."""
    done = results.filter(F.col("status") == SUCCESS).select("id").distinct().withColumn("processed", F.lit("true"))
    return update_matched(config, done, ["id"])


def run_summary(results: DataFrame) -> DataFrame:
    """Tables and rows per status; rows count for successful runs only."""
    loaded = F.when(F.col("status") == SUCCESS, F.col("rows_loaded")).otherwise(0)
    return results.groupBy("status").agg(
        F.count(F.lit(1)).alias("tables"),
        F.sum(loaded).alias("rows_loaded"),
    )


def stage_flags(specs: DataFrame) -> DataFrame:
    """Which optional stages at least one (normalised) spec asks for."""
    return specs.agg(*[
        F.coalesce(F.bool_or(flag), F.lit(False)).alias(f"any_{flag}")
        for flag in ("run_data_quality", "run_governance", "run_optimize")
    ])


__all__ = [
    "audit_records", "config_sync", "control_bootstrap", "control_update", "mark_processed", "mark_update",
    "migration_log", "policy_audit", "run_summary", "stage_flags",
]
