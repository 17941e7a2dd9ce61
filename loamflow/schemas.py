"""Fixed schemas of the system tables.

The column names, types and order in this file are fixed values: existing
configuration files and downstream reports depend on them.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

SPEC_COLUMNS = [
    "id", "description",
    "source_catalog", "source_schema", "source_table",
    "target_catalog", "target_schema", "target_table",
    "pk", "load_strategy", "load_type", "watermark_column",
    "query", "sql_file",
    "run_optimize", "run_data_quality", "dq_config_path",
    "run_governance", "governance_config_path",
    "last_load_time", "processed",
]

SPEC_FLAGS = ["run_data_quality", "run_governance", "run_optimize"]

SPEC_SCHEMA = StructType([StructField(name, StringType()) for name in SPEC_COLUMNS])

CONTROL_SCHEMA = (
    "id STRING, last_load_time TIMESTAMP, last_run_status STRING, last_run_ts TIMESTAMP, "
    "rows_loaded LONG, source_count LONG, error_message STRING"
)

MIGRATION_LOG_SCHEMA = (
    "log_id STRING, log_ts TIMESTAMP, run_id STRING, level STRING, table_id STRING, "
    "source_table STRING, target_table STRING, load_strategy STRING, rows_loaded LONG, "
    "status STRING, stage STRING, message STRING, duration_seconds LONG"
)

AUDIT_SCHEMA = (
    "run_id STRING, pipeline_name STRING, table_name STRING, run_by STRING, "
    "run_timestamp TIMESTAMP, source_row_count LONG, target_row_count LONG, "
    "quarantine_row_count LONG, dq_pass_count LONG, dq_fail_count LONG, "
    "load_strategy STRING, status STRING, error_message STRING, duration_seconds LONG"
)

DQ_RESULTS_SCHEMA = (
    "run_id STRING, total_rows LONG, pass_rows LONG, fail_rows LONG, "
    "fail_pct DOUBLE, status STRING, created_at TIMESTAMP"
)

# One row per executed spec; the other state relations are derived from it.
RUN_RESULT_SCHEMA = (
    "run_id STRING, id STRING, description STRING, source_table STRING, target_table STRING, "
    "load_strategy STRING, stage STRING, status STRING, rows_loaded LONG, source_count LONG, "
    "dq_pass LONG, dq_fail LONG, message STRING, started_at TIMESTAMP, finished_at TIMESTAMP, "
    "mark STRING"
)

LOAD_STRATEGIES = ("overwrite", "full_refresh", "append", "merge", "scd2")
KEYED_STRATEGIES = ("merge", "scd2")
