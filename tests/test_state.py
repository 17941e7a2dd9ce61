import pytest
from pyspark.sql import functions as F

from compare import bag
from loamflow.operators import incremental, state
from loamflow.schemas import AUDIT_SCHEMA, CONTROL_SCHEMA, MIGRATION_LOG_SCHEMA, RUN_RESULT_SCHEMA

def ts(text="2024-05-01 00:00:00"):
    return F.lit(text).cast("timestamp")


def same_fields(df, ddl, spark):
    expected = spark.createDataFrame([], ddl).schema
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in expected]


def results(spark, *rows):
    fields = [f.name for f in spark.createDataFrame([], RUN_RESULT_SCHEMA).schema]
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], RUN_RESULT_SCHEMA)


def test_marks(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2024-01-01'), (2, TIMESTAMP_NTZ'2024-01-02'), "
        "(3, TIMESTAMP_NTZ'2024-01-02'), (4, TIMESTAMP_NTZ'2024-01-03'), (5, NULL) AS t(k, ts)"
    )

    def keys(frame):
        return sorted(r["k"] for r in frame.collect())

    assert keys(incremental.incremental_filter(df, "ts", None)) == [1, 2, 3, 4, 5]
    assert keys(incremental.incremental_filter(df, "ts", "2024-01-02 00:00:00")) == [4]
    assert keys(incremental.incremental_filter(df, "ts", "2024-01-02 00:00:00", overlap="1 day")) == [2, 3, 4]
    assert keys(incremental.incremental_filter(df, "k", "3")) == [4, 5]
    row = incremental.watermark_advance(df, "ts", "2024-01-03 00:00:00").first()
    assert row["new_rows"] == 0 and row["mark_after"] == row["mark_before"]
    assert incremental.watermark_advance(df.filter("k = 5"), "ts").first()["mark_after"] is None


def test_bootstrap_and_update(spark):
    control = spark.createDataFrame([], CONTROL_SCHEMA)
    specs = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "soon"), ("c", "")], "id STRING, last_load_time STRING")
    seeded = state.control_bootstrap(control, specs, ts())
    assert same_fields(seeded, CONTROL_SCHEMA, spark)
    assert bag(state.control_bootstrap(seeded, specs, ts("2025-01-01"))) == bag(seeded)
    assert {r["id"]: r["last_load_time"] is None for r in seeded.collect()} == {"a": False, "b": True, "c": True}
    run = results(spark, {"id": "a", "status": "FAILED", "message": "x" * 3000, "rows_loaded": 0, "source_count": 4},
                  {"id": "unknown", "status": "SUCCESS"})
    updated = {r["id"]: r for r in state.control_update(seeded, run).collect()}
    assert set(updated) == {"a", "b", "c"}
    assert updated["a"]["last_run_status"] == "FAILED" and len(updated["a"]["error_message"]) == 3000
    assert updated["a"]["last_load_time"] is not None and updated["b"]["last_run_status"] == "BOOTSTRAPPED"


def test_log_and_audit_schemas(spark):
    run = results(spark, {"run_id": "r", "id": "a", "status": "FAILED", "message": "y" * 3000, "stage": "transform"},
                  {"run_id": "r", "id": "b", "status": "SKIPPED"})
    log = state.migration_log(run)
    assert same_fields(log, MIGRATION_LOG_SCHEMA, spark)
    assert {r["table_id"]: (r["level"], len(r["message"])) for r in log.collect()} == {"a": ("ERROR", 3000), "b": ("INFO", 0)}
    specs = spark.createDataFrame(
        [("a", "", "s", "t", "merge"), ("b", "B", "", "u", "append")],
        "id STRING, description STRING, target_schema STRING, target_table STRING, load_strategy STRING",
    )
    control = spark.createDataFrame([("a", None, "SUCCESS", None, 3, 4, None)], CONTROL_SCHEMA)
    audit = state.audit_records(specs, control, "r", ts(), ts("2024-05-01 00:00:05"))
    assert same_fields(audit, AUDIT_SCHEMA, spark)
    assert bag(audit.select("pipeline_name", "table_name", "source_row_count", "target_row_count", "status", "duration_seconds")) == [
        ("B", "u", 0, 0, "UNKNOWN", 5), ("a", "s.t", 4, 3, "SUCCESS", 5)
    ]
    assert same_fields(state.policy_audit(specs.select("load_strategy"), ts()), AUDIT_SCHEMA, spark)


def test_config_sync_keeps_processed(spark):
    stored = spark.createDataFrame([("a", "q1", "true"), ("z", "q9", "false")], "id STRING, query STRING, processed STRING")
    incoming = spark.createDataFrame([("a", "q2", "false"), ("b", "q3", "true")], "id STRING, query STRING, processed STRING")
    assert bag(state.config_sync(stored, incoming)) == [("a", "q2", "true"), ("b", "q3", "true"), ("z", "q9", "false")]
    assert bag(state.config_sync(None, incoming)) == bag(incoming)
    wider = incoming.withColumn("extra", F.lit("x"))
    assert bag(state.config_sync(stored, wider)) == bag(wider)


def test_mark_processed_only_successes(spark):
    config = spark.createDataFrame([("a", "false"), ("b", "false"), ("c", "true")], "id STRING, processed STRING")
    run = results(spark, {"id": "a", "status": "SUCCESS"}, {"id": "b", "status": "FAILED"}, {"id": "c", "status": "SKIPPED"})
    assert bag(state.mark_processed(config, run)) == [("a", "true"), ("b", "false"), ("c", "true")]


@pytest.mark.parametrize("flags, expected", [([], False), ([False, True], True), ([False], False)])
def test_stage_flags(spark, flags, expected):
    specs = spark.createDataFrame([(f, f, f) for f in flags],
                                  "run_data_quality BOOLEAN, run_governance BOOLEAN, run_optimize BOOLEAN")
    assert set(state.stage_flags(specs).first()) == {expected}
