import json

import pytest
from pyspark.sql import functions as F

from compare import bag
from loamflow import BulkTransformEngine, Warehouse, sql_transform
from loamflow.operators.incremental import LateRows
from loamflow.sources.snapshots import StaleResult
from loamflow.schemas import AUDIT_SCHEMA, CONTROL_SCHEMA, DQ_RESULTS_SCHEMA
from test_specs import write_csv
from test_state import same_fields

RULES = {"data_quality": {
    "quarantine_table": "quality.rejects", "dq_results_table": "quality.results", "failure_threshold_pct": 5.0,
    "checks": [
        {"name": "v_set", "criticality": "error", "check": {"function": "is_not_null", "arguments": {"column": "v"}}},
        {"name": "k_small", "criticality": "warn",
         "check": {"function": "is_not_greater_than", "arguments": {"column": "k", "value": 90}}},
    ],
}}


def spec(id_, **changes):
    base = {
        "id": id_, "description": f"load {id_}", "source_catalog": "raw", "source_schema": "s", "source_table": "t",
        "target_catalog": "lake", "target_schema": "trusted", "target_table": id_, "pk": "k", "load_strategy": "merge",
        "load_type": "incremental", "watermark_column": "ts", "query": "SELECT k, v, ts FROM source", "processed": "false",
    }
    return {**base, **changes}


def rows(spark, *values):
    """(k, v, day) with the day as a time."""
    df = spark.createDataFrame(list(values), "k INT, v STRING, day INT")
    return df.select("k", "v", F.expr("TIMESTAMP_NTZ'2024-01-01' + make_interval(0, 0, 0, day)").alias("ts"))


def engine(spark, tmp_path, specs, source, **options):
    path = write_csv(tmp_path / "specs.csv", specs)
    return BulkTransformEngine(
        spark, str(tmp_path / "lake"), csv_path=path, bindings={"raw.s.t": source},
        documents={"rules.json": RULES, **options.pop("documents", {})}, **options,
    )


def statuses(results):
    return {r.id: (r.status, r.rows_loaded) for r in results}


def kv(df):
    return bag(df.select("k", "v"))


def test_incremental_merge_over_several_runs(spark, tmp_path):
    eng = engine(spark, tmp_path, [spec("m")], rows(spark, (1, "a", 1), (2, "b", 2), (3, "null mark", None)))
    first = eng.transform_all(run_id="r1")
    assert statuses(first) == {"m": ("SUCCESS", 3)}
    assert eng.last_mark(eng.load_transforms()[0]) == "2024-01-03 00:00:00"

    # The tie on the mark stays out; the update to NULL comes in.
    eng.tables.bind("raw.s.t", rows(spark, (1, None, 5), (2, "tie", 2), (9, "new", 4)))
    assert statuses(eng.transform_all(run_id="r2")) == {"m": ("SUCCESS", 2)}
    table = eng.warehouse.read("lake.trusted.m")
    assert kv(table) == sorted([(1, None), (2, "b"), (3, "null mark"), (9, "new")], key=repr)
    control = eng.warehouse.read("logging.watermark_state")
    assert same_fields(control, CONTROL_SCHEMA, spark)
    (row,) = control.collect()
    assert (row["last_run_status"], row["rows_loaded"], row["source_count"]) == ("SUCCESS", 2, 3)
    assert str(row["last_load_time"]) == "2024-01-06 00:00:00"

    # Nothing newer: no write, still a success.
    version = eng.warehouse.current("lake.trusted.m").version
    assert statuses(eng.transform_all(run_id="r3")) == {"m": ("SUCCESS", 0)}
    assert eng.warehouse.current("lake.trusted.m").version == version
    assert eng.warehouse.read("logging.migration_log").count() == 3


def test_seed_mark_limits_the_first_load(spark, tmp_path):
    specs = [spec("m", last_load_time="2024-01-03 00:00:00")]
    eng = engine(spark, tmp_path, specs, rows(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3)))
    assert statuses(eng.transform_all()) == {"m": ("SUCCESS", 1)}


def test_append_overwrite_scd2(spark, tmp_path):
    specs = [
        spec("a", load_strategy="append"),
        spec("o", load_strategy="overwrite", load_type="full_refresh"),
        spec("h", load_strategy="scd2", load_type="full_refresh", query="SELECT k, v FROM source"),
    ]
    eng = engine(spark, tmp_path, specs, rows(spark, (1, "a", 1), (2, "b", 2)))
    assert statuses(eng.transform_all(run_id="r1")) == {"a": ("SUCCESS", 2), "o": ("SUCCESS", 2), "h": ("SUCCESS", 2)}
    eng.tables.bind("raw.s.t", rows(spark, (1, "z", 3)))
    eng.transform_all(run_id="r2")
    assert kv(eng.warehouse.read("lake.trusted.a")) == [(1, "a"), (1, "z"), (2, "b")]
    assert kv(eng.warehouse.read("lake.trusted.o")) == [(1, "z")]
    history = eng.warehouse.read("lake.trusted.h")
    assert bag(history.select("k", "v", "is_current")) == [(1, "a", False), (1, "z", True), (2, "b", True)]

    # The same run again appends nothing twice.
    eng.transform_all(run_id="r2")
    assert kv(eng.warehouse.read("lake.trusted.a")) == [(1, "a"), (1, "z"), (2, "b")]


def test_append_evolves_and_overwrite_replaces_the_schema(spark, tmp_path):
    specs = [spec("a", load_strategy="append", query=""),
             spec("o", load_strategy="overwrite", load_type="full_refresh", query="")]
    eng = engine(spark, tmp_path, specs, rows(spark, (1, "a", 1)))
    eng.transform_all()
    eng.tables.bind("raw.s.t", rows(spark, (2, "b", 2)).withColumn("extra", F.lit(7)).drop("v"))
    eng.transform_all()
    appended = eng.warehouse.read("lake.trusted.a")
    assert bag(appended.select("k", "v", "extra")) == [(1, "a", None), (2, None, 7)]
    assert eng.warehouse.read("lake.trusted.o").columns == ["k", "ts", "extra"]


def quality_spec(id_, **changes):
    return spec(id_, run_data_quality="true", dq_config_path="rules.json", **changes)


def test_quality_split_publishes_both_parts(spark, tmp_path):
    source = rows(spark, *[(i, None if i < 5 else "x", i % 20) for i in range(100)])
    eng = engine(spark, tmp_path, [quality_spec("q")], source)
    assert statuses(eng.transform_all(run_id="r1")) == {"q": ("SKIPPED", 0)}
    (result,) = eng.run_dq_all(run_id="r1")
    assert (result.status, result.rows_loaded, result.dq_fail) == ("SUCCESS", 95, 5)
    table, rejects = eng.warehouse.read("lake.trusted.q"), eng.warehouse.read("quality.rejects")
    assert table.columns == ["k", "v", "ts"] and table.count() == 95
    assert sorted(r["k"] for r in rejects.collect()) == [0, 1, 2, 3, 4]
    flagged = eng.warehouse.read("quality.results_warnings")
    assert sorted(r["k"] for r in flagged.collect()) == list(range(91, 100))
    assert flagged.first()["_warnings"][0]["name"] == "k_small"
    row = rejects.first()
    assert (row["_dq_run_id"], row["_dq_source_table"], row["_errors"][0]["name"]) == ("r1", "raw.s.t", "v_set")
    summary = eng.warehouse.read("quality.results")
    assert same_fields(summary, DQ_RESULTS_SCHEMA, spark)
    row = summary.first()
    assert (row["total_rows"], row["pass_rows"], row["fail_rows"], row["fail_pct"], row["status"]) == (100, 95, 5, 5.0, "WARN")


def test_quality_halt_keeps_the_table_and_the_mark(spark, tmp_path):
    eng = engine(spark, tmp_path, [quality_spec("q"), spec("m")], rows(spark, (1, "a", 1), (2, None, 2)))
    (result,) = eng.run_dq_all(run_id="r1")
    assert result.status == "FAILED" and "50.00%" in result.message
    assert not eng.warehouse.exists("lake.trusted.q")
    assert eng.warehouse.read("quality.rejects").count() == 1
    assert eng.warehouse.read("quality.results").first()["status"] == "FAIL"
    (row,) = eng.warehouse.read("logging.watermark_state").filter("id = 'q'").collect()
    assert row["last_run_status"] == "FAILED" and row["last_load_time"] is None
    with pytest.raises(Exception, match="failed the rules"):
        eng.run_dq_all(stop_on_error=True, run_id="r2")


def test_all_rows_rejected_below_a_wide_threshold(spark, tmp_path):
    wide = {"data_quality": {**RULES["data_quality"], "failure_threshold_pct": 100}}
    eng = engine(spark, tmp_path, [quality_spec("q")], rows(spark, (1, None, 1)), documents={"rules.json": wide})
    (result,) = eng.run_dq_all(run_id="r1")
    assert (result.status, result.rows_loaded) == ("SUCCESS", 0)
    assert not eng.warehouse.exists("lake.trusted.q") and eng.warehouse.read("quality.rejects").count() == 1
    # The mark covers all rows read, so the rejected ones are not read again.
    assert eng.last_mark(eng.load_transforms()[0]) == "2024-01-02 00:00:00"
    for day, value, mark in ((2, "good", "2024-01-03"), (3, None, "2024-01-04")):
        eng.tables.bind("raw.s.t", rows(spark, (1, value, day), (2, None, 1)))
        eng.run_dq_all(run_id=f"day{day}")
        assert eng.last_mark(eng.load_transforms()[0]) == f"{mark} 00:00:00"
    assert kv(eng.warehouse.read("lake.trusted.q")) == [(1, "good")]
    assert eng.warehouse.read("quality.rejects").count() == 2


def test_sql_only_specs_name_tables_directly(spark, tmp_path):
    blank = {"source_catalog": "", "source_schema": "", "source_table": "", "load_strategy": "overwrite",
             "load_type": "full_refresh", "watermark_column": ""}
    specs = [
        spec("a_base"),
        spec("b_full", query="SELECT c.k, t.v FROM raw.s.t c LEFT JOIN lake.trusted.a_base t ON t.k = c.k", **blank),
        spec("c_short", query="SELECT k, v FROM t WHERE k = 1", **blank),
        spec("d_catalog", query="SELECT id AS k, 'x' AS v FROM range(2)", **blank),
    ]
    eng = engine(spark, tmp_path, specs, rows(spark, (1, "a", 1), (2, "b", 2)))
    assert statuses(eng.transform_all()) == {
        "a_base": ("SUCCESS", 2), "b_full": ("SUCCESS", 2), "c_short": ("SUCCESS", 1), "d_catalog": ("SUCCESS", 2)
    }
    assert kv(eng.warehouse.read("lake.trusted.b_full")) == [(1, "a"), (2, "b")]


def test_key_rules_in_a_run(spark, tmp_path):
    checks = [
        {"name": "one_per_key", "check": {"function": "is_unique", "arguments": {"columns": ["k"]}}},
        {"name": "known", "check": {"function": "foreign_key", "arguments": {
            "columns": ["v"], "ref_table": "ref.values", "ref_columns": ["v"]}}},
    ]
    rules = {"data_quality": {**RULES["data_quality"], "failure_threshold_pct": 100, "checks": checks}}
    eng = engine(spark, tmp_path, [quality_spec("q")], rows(spark, (1, "a", 1), (1, "b", 1), (2, "a", 1), (3, "x", 1)),
                 documents={"rules.json": rules})
    eng.tables.bind("ref.values", spark.createDataFrame([("a",), ("b",)], "v STRING"))
    assert statuses(eng.run_dq_all()) == {"q": ("SUCCESS", 1)}
    rejected = eng.warehouse.read("quality.rejects")
    assert bag(rejected.select("k", F.col("_errors")[0]["name"])) == [(1, "one_per_key"), (1, "one_per_key"), (3, "known")]


def test_failures_do_not_stop_the_run(spark, tmp_path):
    specs = [spec("a_bad", query="SELECT nope FROM source"), spec("b_ok")]
    eng = engine(spark, tmp_path, specs, rows(spark, (1, "a", 1)))
    results = eng.transform_all(run_id="r1")
    assert statuses(results) == {"a_bad": ("FAILED", 0), "b_ok": ("SUCCESS", 1)}
    assert "nope" in results[0].message
    log = {r["table_id"]: r["level"] for r in eng.warehouse.read("logging.migration_log").collect()}
    assert log == {"a_bad": "ERROR", "b_ok": "INFO"}
    with pytest.raises(Exception, match="nope"):
        eng.transform_all(stop_on_error=True, run_id="r2")


def test_run_all_twice(spark, tmp_path):
    sql_only = spec("j", source_catalog="", source_schema="", source_table="", load_strategy="overwrite",
                    load_type="full_refresh", watermark_column="", run_optimize="true",
                    query="SELECT a.k, b.v FROM t a LEFT JOIN t b ON a.k = b.k")
    specs = [spec("m"), quality_spec("q"), sql_only, spec("done", processed="true"), spec("bad", query="SELECT x")]
    policy = {"governance": {"table_tags": {"domain": "test"}}}
    specs[0].update(run_governance="true", governance_config_path="policy.json")
    source = rows(spark, (1, "a", 1), (2, "b", 2))
    eng = engine(spark, tmp_path, specs, source, documents={"policy.json": policy}, parallel=3)
    results = eng.run_all(run_id="r1")
    assert statuses(results) == {
        "m": ("SUCCESS", 2), "q": ("SUCCESS", 2), "j": ("SUCCESS", 2), "done": ("SKIPPED", 0), "bad": ("FAILED", 0)
    }
    processed = {r["id"]: r["processed"] for r in eng.warehouse.read("config.load_specs").collect()}
    assert processed == {"m": "true", "q": "true", "j": "true", "done": "true", "bad": "false"}
    audit = eng.warehouse.read("logging.pipeline_run_log")
    assert same_fields(audit, AUDIT_SCHEMA, spark)
    assert {r["pipeline_name"]: (r["status"], r["target_row_count"], r["dq_pass_count"]) for r in audit.collect()} == {
        "load m": ("SUCCESS", 2, 0), "load q": ("SUCCESS", 2, 2), "load j": ("SUCCESS", 2, 0),
        "load done": ("BOOTSTRAPPED", 0, 0), "load bad": ("FAILED", 0, 0),
    }
    assert eng.warehouse.current("lake.trusted.j").run_id == "r1-compact"
    assert eng.warehouse.read("logging.policy_audit").count() == 1

    before = {t: bag(eng.warehouse.read(f"lake.trusted.{t}")) for t in "mqj"}
    again = statuses(eng.run_all(run_id="r2"))
    assert again == {**{t: ("SKIPPED", 0) for t in ("m", "q", "j", "done")}, "bad": ("FAILED", 0)}
    assert {t: bag(eng.warehouse.read(f"lake.trusted.{t}")) for t in "mqj"} == before


def test_validate_lists_every_problem(spark, tmp_path):
    specs = [spec("a", source_table="missing"), spec("b", pk=""), spec("c", source_table="gone", processed="true")]
    eng = engine(spark, tmp_path, specs, rows(spark, (1, "a", 1)))
    with pytest.raises(AssertionError) as failure:
        eng.validate_all()
    assert "raw.s.missing" in str(failure.value) and "[b]" in str(failure.value) and "gone" not in str(failure.value)


def test_validate_profiles_sources(spark, tmp_path):
    eng = engine(spark, tmp_path, [spec("m"), quality_spec("q")], rows(spark, (1, "a", 1), (2, "b", 2)))
    report = eng.validate_all()
    assert sorted((r["id"], r["source_ok"], r["source_count"]) for r in report["table_results"]) == [("m", True, 2), ("q", True, 2)]
    assert (report["any_run_dq"], report["any_run_governance"], report["any_run_optimize"]) == (True, False, False)


@pytest.mark.parametrize("layout", ["k div 10", "pmod(xxhash64(k), 4)"])
def test_merge_rewrites_touched_parts_only(spark, tmp_path, layout):
    target = "lake.trusted.m"
    source = rows(spark, *[(i, "old", 1) for i in range(40)], (None, "no key", 1))
    eng = engine(spark, tmp_path, [spec("m")], source, layouts={target: layout})
    eng.transform_all(run_id="r1")
    before = eng.warehouse.current(target)
    assert before.rows == 41 and len(before.dirs) >= 4
    eng.tables.bind("raw.s.t", rows(spark, (5, "new", 2), (105, "insert", 2)))
    eng.transform_all(run_id="r2")
    after = eng.warehouse.current(target)
    assert len(set(before.dirs) & set(after.dirs)) >= len(before.dirs) - 2
    assert any("r2" in d for d in after.dirs) and after.rows == 42
    expected = [(i, "new" if i == 5 else "old") for i in range(40)] + [(105, "insert"), (None, "no key")]
    assert kv(eng.warehouse.read(target)) == sorted(expected, key=repr)
    eng.warehouse.compact(target, "r3")
    assert kv(eng.warehouse.read(target)) == sorted(expected, key=repr)
    assert eng.warehouse.current(target).layout == layout


def test_layout_must_follow_from_the_keys(spark, tmp_path):
    eng = engine(spark, tmp_path, [spec("m")], rows(spark, (1, "a", 1)), layouts={"lake.trusted.m": "length(v)"})
    assert statuses(eng.transform_all()) == {"m": ("FAILED", 0)}


def test_known_empty_results_and_catalog_sources(spark, tmp_path):
    rows(spark, (1, "a", 1)).write.mode("overwrite").saveAsTable("default.catalog_source")
    try:
        catalog = {"source_catalog": "spark_catalog", "source_schema": "default", "source_table": "catalog_source"}
        specs = [spec("c", **catalog), spec("e", query="SELECT * FROM source WHERE false", **catalog),
                 quality_spec("f", query="SELECT * FROM source WHERE 1 = 0", **catalog),
                 spec("g", load_strategy="scd2", load_type="full_refresh", query="SELECT k, v FROM source LIMIT 0", **catalog)]
        eng = engine(spark, tmp_path, specs, rows(spark, (1, "a", 1)))
        eng.validate_all()
        assert statuses(eng.transform_all()) == {
            "c": ("SUCCESS", 1), "e": ("SUCCESS", 0), "f": ("SKIPPED", 0), "g": ("SUCCESS", 0)
        }
        results = eng.run_dq_all()
        assert statuses(results) == {"f": ("SUCCESS", 0)}
        assert not eng.warehouse.exists("lake.trusted.e") and not eng.warehouse.exists("quality.results")
        assert bag(eng.run_summary(results)) == [("SUCCESS", 1, 0)]
    finally:
        spark.sql("DROP TABLE default.catalog_source")


def test_numeric_marks(spark, tmp_path):
    eng = engine(spark, tmp_path, [spec("a", load_strategy="append", watermark_column="k")], rows(spark, (1, "a", 1), (2, "b", 1)))
    eng.transform_all()
    eng.tables.bind("raw.s.t", rows(spark, (2, "late", 1), (10, "c", 1)))
    eng.transform_all()
    assert kv(eng.warehouse.read("lake.trusted.a")) == [(1, "a"), (10, "c"), (2, "b")]
    assert eng.warehouse.current("lake.trusted.a").marks == {"a": "10"}


def test_documents_from_files(spark, tmp_path):
    (tmp_path / "rules.json").write_text(json.dumps(RULES))
    pytest.importorskip("yaml")
    (tmp_path / "rules.yml").write_text("data_quality:\n  failure_threshold_pct: 7\n  checks: []\n")
    eng = BulkTransformEngine(spark, str(tmp_path / "lake"), config_base_path=str(tmp_path))
    assert eng.document("rules.json", "data_quality")["failure_threshold_pct"] == 5.0
    assert eng.document("rules.yml", "data_quality") == {"failure_threshold_pct": 7, "checks": []}


def test_read_governed(spark, tmp_path):
    eng = engine(spark, tmp_path, [spec("m")], rows(spark, (1, "Ann", 1), (2, "Bob", 2)))
    eng.transform_all()
    eng.tables.bind("sec.groups", spark.createDataFrame([("team", ["1"])], "user_group STRING, allowed_branch_codes ARRAY<STRING>"))
    policy = {
        "pii_columns": [{"column": "v", "masking_function": "name"}],
        "row_level_security": {"enabled": True, "filter_column": "k", "group_mapping_table": "sec.groups"},
    }
    assert kv(eng.read_governed("lake.trusted.m", policy, "eve", ["team"])) == [(1, "A***")]
    assert kv(eng.read_governed("lake.trusted.m", policy, "root", ["admin"], ["root"])) == [(1, "Ann"), (2, "Bob")]
    assert sql_transform(spark, "SELECT max(v) AS v FROM source", {"source": eng.read_governed("lake.trusted.m", policy, "eve", [])}).first()["v"] is None


def shared_specs(**changes):
    """Two specs with rules that share target, quarantine and results tables, from two sources."""
    common = {"load_strategy": "append", "target_table": "both", **changes}
    return [quality_spec("one", **common), quality_spec("two", source_table="late", **common)]


@pytest.mark.parametrize("parallel", [1, 3])
def test_specs_that_share_every_table_keep_all_rows(spark, tmp_path, parallel):
    first = rows(spark, *[(i, None if i == 0 else "x", 40 + i) for i in range(60)])
    late = rows(spark, *[(100 + i, None if i == 0 else "y", i) for i in range(30)])  # older than the first one's mark
    eng = engine(spark, tmp_path, shared_specs(), first, parallel=parallel)
    eng.tables.bind("raw.s.late", late)
    assert statuses(eng.run_dq_all(run_id="r1")) == {"one": ("SUCCESS", 59), "two": ("SUCCESS", 29)}
    assert statuses(eng.run_dq_all(run_id="r1")) == {"one": ("SUCCESS", 0), "two": ("SUCCESS", 0)}  # the same run again
    assert eng.warehouse.read("lake.trusted.both").count() == 88
    assert sorted(r["k"] for r in eng.warehouse.read("quality.rejects").collect()) == [0, 100]
    assert bag(eng.warehouse.read("quality.results").select("total_rows", "fail_rows")) == [(30, 1), (60, 1)]

    # The next run reads above each spec's own mark.
    eng.tables.bind("raw.s.t", rows(spark, (200, "x", 120), (201, "old", 40)))
    eng.tables.bind("raw.s.late", rows(spark, (300, "y", 31), (301, "old", 5)))
    eng.run_dq_all(run_id="r2")
    assert eng.warehouse.read("lake.trusted.both").filter("k >= 200").count() == 2
    assert kv(eng.warehouse.read("lake.trusted.both").filter("k >= 200")) == [(200, "x"), (300, "y")]


def test_merging_specs_share_a_target_side_by_side(spark, tmp_path):
    specs = [spec(i, target_table="m", source_table=i, load_type="full_refresh") for i in ("a", "b", "c")]
    eng = engine(spark, tmp_path, specs, rows(spark, (0, "unused", 1)), parallel=3)
    for k, i in enumerate(("a", "b", "c")):
        eng.tables.bind(f"raw.s.{i}", rows(spark, (k, i, 1), (9, i, 1)))
    assert all(r.status == "SUCCESS" for r in eng.transform_all(run_id="r1"))
    assert sorted(r["k"] for r in eng.warehouse.read("lake.trusted.m").collect()) == [0, 1, 2, 9]


def test_a_result_based_on_an_old_version_is_refused(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    df = rows(spark, (1, "a", 1))
    warehouse.save("t", df, "r1")
    old = warehouse.current("t")
    warehouse.save("t", df, "r2")
    path = warehouse.stage(df, warehouse.data_path("t", "r3"))
    with pytest.raises(StaleResult):
        warehouse.publish("t", "r3", (path,), df.schema, 1, based_on=old)
    assert warehouse.current("t").run_id == "r2"


def test_a_mark_set_back_in_the_control_table_counts(spark, tmp_path):
    eng = engine(spark, tmp_path, [spec("m")], rows(spark, (1, "a", 1), (2, "b", 2)))
    eng.transform_all(run_id="r1")
    assert statuses(eng.transform_all(run_id="r2")) == {"m": ("SUCCESS", 0)}
    control = eng.warehouse.read("logging.watermark_state").withColumn("last_load_time", F.lit(None).cast("timestamp"))
    eng.warehouse.save("logging.watermark_state", control, "reset")
    assert statuses(eng.transform_all(run_id="r3")) == {"m": ("SUCCESS", 2)}


def test_names_in_another_letter_case(spark, tmp_path):
    changes = {"pk": "K", "watermark_column": "TS"}
    eng = engine(spark, tmp_path, [spec("m", **changes)], rows(spark, (1, "a", 1)))
    assert statuses(eng.transform_all()) == {"m": ("SUCCESS", 1)}
    eng.tables.bind("raw.s.t", rows(spark, (1, "b", 2), (2, "old", 1)))
    assert statuses(eng.transform_all()) == {"m": ("SUCCESS", 1)}
    assert kv(eng.warehouse.read("lake.trusted.m")) == [(1, "b")]


def test_a_bad_policy_is_its_tables_failure_only(spark, tmp_path):
    policy = {"governance": {"pii_columns": [{"column": "v", "masking_function": "name"}]}}
    governed = {"run_governance": "true", "load_type": "full_refresh"}
    specs = [
        spec("a", governance_config_path="missing.json", **governed), spec("b", governance_config_path="p.json", **governed),
    ]
    eng = engine(spark, tmp_path, specs, rows(spark, (1, "a", 1)), documents={"p.json": policy})
    results = eng.run_all(run_id="r1")
    assert statuses(results) == {"a": ("SUCCESS", 1), "b": ("SUCCESS", 1)}
    audit = eng.warehouse.read("logging.policy_audit").collect()
    assert {r["table_name"]: r["status"] for r in audit} == {"lake.trusted.a": "FAILED", "lake.trusted.b": "SUCCESS"}
    assert {r["table_name"] for r in eng.warehouse.read("logging.policy_tags").collect()} == {"lake.trusted.b"}
    assert eng.warehouse.read("logging.pipeline_run_log").count() == 2


def test_other_config_columns_are_kept(spark, tmp_path):
    path = tmp_path / "specs.csv"
    eng = engine(spark, tmp_path, [spec("m")], rows(spark, (1, "a", 1)))
    header, line = path.read_text().splitlines()[:2]
    path.write_text(f"{header},owner\n{line},ann\n")
    eng.validate_all(run_id="r1")
    assert eng.warehouse.read("config.load_specs").first()["owner"] == "ann"


def test_a_source_that_fails_on_read_is_not_ok(spark, tmp_path):
    good = rows(spark, (1, "a", 1))
    bad = good.withColumn("v", F.raise_error(F.lit("unreadable")).cast("string"))
    eng = engine(spark, tmp_path, [spec("good"), spec("bad", source_table="bad")], good)
    eng.tables.bind("raw.s.bad", bad.filter("v <> 'x'"))
    profile = {r["id"]: (r["source_ok"], r["source_count"]) for r in eng.validate_all(run_id="r1")["table_results"]}
    assert profile == {"good": (True, 1), "bad": (False, -1)}
    assert statuses(eng.transform_all(run_id="r1")) == {"good": ("SUCCESS", 1), "bad": ("FAILED", 0)}


@pytest.mark.parametrize("first, other", [
    ("append", "merge"), ("append", "overwrite"), ("merge", "overwrite"), ("overwrite", "append"), ("scd2", "merge"),
])
def test_a_load_repeated_after_another_spec_adds_nothing(spark, tmp_path, first, other):
    changes = {"target_table": "t", "load_type": "full_refresh", "pk": "k"}
    eng = engine(spark, tmp_path, [spec("a", load_strategy=first, **changes), spec("b", load_strategy=other, **changes)],
                 rows(spark, (1, "a", 1), (2, "b", 2)))
    if first == "scd2":  # a table of versions has columns that other strategies do not bring
        eng.transform_all(["a"], run_id="r1")
        before = eng.warehouse.current("lake.trusted.t")
        eng.warehouse.compact("lake.trusted.t", "r1")
    else:
        eng.transform_all(["a"], run_id="r1")
        eng.transform_all(["b"], run_id="r1")
        before = eng.warehouse.current("lake.trusted.t")
    data = bag(eng.warehouse.read("lake.trusted.t"))
    for _ in range(2):
        for result in eng.transform_all(run_id="r1") if first != "scd2" else eng.transform_all(["a"], run_id="r1"):
            assert (result.status, result.rows_loaded, result.message) == ("SUCCESS", 0, "already published by this run")
    after = eng.warehouse.current("lake.trusted.t")
    assert bag(eng.warehouse.read("lake.trusted.t")) == data and after.rows == before.rows
    assert set(before.runs) <= set(after.runs)


def test_loads_repeated_side_by_side(spark, tmp_path):
    changes = {"load_type": "full_refresh", "pk": "k"}
    specs = [spec(f"{n}{t}", target_table=t, load_strategy=s, **changes) for t in ("t", "u", "w")
             for n, s in (("a", "append"), ("b", "merge"))]
    eng = engine(spark, tmp_path, specs, rows(spark, (1, "a", 1), (2, "b", 2)))
    eng.parallel = 3
    assert all(r.status == "SUCCESS" for r in eng.transform_all(run_id="r1"))
    assert all(r.message == "already published by this run" for r in eng.transform_all(run_id="r1"))
    assert all(kv(eng.warehouse.read(f"lake.trusted.{t}")) == [(1, "a"), (2, "b")] for t in ("t", "u", "w"))


def test_the_ledger_is_bounded(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), ledger_loads=3)
    for run in ("r1", "r2", "r3", "r4"):
        warehouse.save("t", spark.range(1), run, "append")
    assert warehouse.current("t").runs == ("r2", "r3", "r4")
    assert warehouse.save("t", spark.range(1), "r2", "append").rows == 4


def test_ties_at_the_mark_are_read_when_they_come(spark, tmp_path):
    eng = engine(spark, tmp_path, [spec("m", load_strategy="append")], rows(spark, (1, "a", 1), (2, "b", 2)), late={"m": LateRows(tie="k")})
    assert statuses(eng.transform_all(run_id="r1")) == {"m": ("SUCCESS", 2)}
    assert statuses(eng.transform_all(run_id="r2")) == {"m": ("SUCCESS", 0)}
    eng.tables.bind("raw.s.t", rows(spark, (1, "a", 1), (2, "b", 2), (3, "c", 2), (5, "e", 3), (0, "late", 1)))
    assert statuses(eng.transform_all(run_id="r3")) == {"m": ("SUCCESS", 2)}
    assert kv(eng.warehouse.read("lake.trusted.m")) == [(1, "a"), (2, "b"), (3, "c"), (5, "e")]
    # A mark that was set back in the control table counts without the tie.
    control = eng.warehouse.read("logging.watermark_state").withColumn("last_load_time", F.lit("2024-01-02").cast("timestamp"))
    eng.warehouse.save("logging.watermark_state", control, "reset")
    assert statuses(eng.transform_all(run_id="r4")) == {"m": ("SUCCESS", 3)}


@pytest.mark.parametrize("strategy", ["append", "merge"])
def test_rows_below_the_mark_are_added_once(spark, tmp_path, strategy):
    eng = engine(spark, tmp_path, [spec("m", load_strategy=strategy)], rows(spark, (1, "a", 1), (9, "z", 9), (None, "n", 8)),
                 late={"m": LateRows(overlap="3 days")})
    eng.transform_all(run_id="r1")
    everything = rows(spark, (1, "a", 1), (9, "z", 9), (None, "n", 8), (2, "too late", 2), (7, "late", 7), (None, "late", 7), (8, "tie", 9))
    eng.tables.bind("raw.s.t", everything)
    expected = [(1, "a"), (7, "late"), (8, "tie"), (9, "z"), (None, "late"), (None, "n")]
    for run in ("r2", "r3"):
        assert eng.transform_all(run_id=run)[0].status == "SUCCESS"
        if strategy == "append":  # a merge adds rows without a key each time, as SQL does
            assert kv(eng.warehouse.read("lake.trusted.m")) == expected
        else:
            assert [r for r in kv(eng.warehouse.read("lake.trusted.m")) if r[0]] == expected[:4]
    assert eng.last_mark(eng.load_transforms()[0]) == "2024-01-10 00:00:00"


def test_late_rows_alone_do_not_set_the_mark_back(spark, tmp_path):
    eng = engine(spark, tmp_path, [spec("m", load_strategy="append")], rows(spark, (9, "z", 9)), late={"m": LateRows(overlap="3 days")})
    eng.transform_all(run_id="r1")
    eng.tables.bind("raw.s.t", rows(spark, (7, "late", 7)))
    assert statuses(eng.transform_all(run_id="r2")) == {"m": ("SUCCESS", 1)}
    assert eng.last_mark(eng.load_transforms()[0]) == "2024-01-10 00:00:00"
    without_keys = {**eng.load_transforms()[0], "pk": []}
    assert "needs keys" in eng.run_spec(without_keys, "r3").message


def test_closed_versions_are_not_written_again(spark, tmp_path):
    history = spec("h", load_strategy="scd2", load_type="full_refresh", query="SELECT k, v FROM source")
    eng = engine(spark, tmp_path, [history], rows(spark, (1, "a", 1), (2, "b", 1), (None, "n", 1)))
    name, closed = "lake.trusted.h", []
    for run, values in (("r1", "ab"), ("r2", "ac"), ("r3", "dc"), ("r4", "dc")):
        eng.tables.bind("raw.s.t", rows(spark, (1, values[0], 1), (2, values[1], 1), (None, "n", 1)))
        assert eng.transform_all(run_id=run)[0].status == "SUCCESS"
        live = eng.warehouse.current(name)
        kept = [d for d in live.dirs if d.endswith("=false")]
        assert set(closed) <= set(kept) and live.rows == eng.warehouse.read(name).count()
        closed = kept
    assert len(closed) == 2
    shown = eng.warehouse.read(name).select("k", "v", "is_current")
    expected = sorted([(1, "a", False), (1, "d", True), (2, "b", False), (2, "c", True), (None, "n", True)], key=repr)
    assert bag(shown) == expected
    # Compacted into one folder, and apart again with the next load.
    eng.warehouse.compact(name, "c1")
    eng.tables.bind("raw.s.t", rows(spark, (1, "e", 1)))
    eng.transform_all(run_id="r5")
    assert bag(eng.warehouse.read(name).select("k", "v", "is_current").filter("k = 1")) == sorted(
        [(1, "a", False), (1, "d", False), (1, "e", True)], key=repr)
    assert eng.warehouse.current(name).rows == eng.warehouse.read(name).count() == 6


def test_a_run_without_its_specs_file_and_sources_that_are_missing(spark, tmp_path):
    eng = engine(spark, tmp_path, [spec("m"), spec("x", source_table="gone")], rows(spark, (1, "a", 1)))
    with pytest.raises(AssertionError, match="cannot access 'raw.s.gone'"):
        eng.validate_all(run_id="r1")
    stored = eng.warehouse.read("logging.source_profile").select("run_id", "id", "source_ok", "source_count")
    assert bag(stored) == [("r1", "m", True, 1), ("r1", "x", False, -1)]
    (tmp_path / "specs.csv").unlink()
    assert eng.validate_all(["m"], run_id="r2")["table_results"][0]["source_ok"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        BulkTransformEngine(spark, str(tmp_path / "other"), csv_path=str(tmp_path / "specs.csv")).validate_all()


@pytest.mark.parametrize("policy, status", [
    ({"pii_columns": [{"column": "v", "masking_function": "name"}]}, "SUCCESS"),
    ({"pii_columns": [{"column": "gone", "masking_function": "name"}]}, "FAILED"),
    ({"pii_columns": [{"column": "v", "masking_function": "no.such.mask"}]}, "FAILED"),
    ({"row_level_security": {"enabled": True, "filter_column": "k", "rls_function_name": "f", "function_sql": "CREATE FUNCTION f(x INT) RETURN x"}}, "FAILED"),
])
def test_a_policy_is_built_before_it_counts_as_applied(spark, tmp_path, policy, status):
    governed = {"run_governance": "true", "governance_config_path": "p.json", "load_type": "full_refresh"}
    eng = engine(spark, tmp_path, [spec("a", **governed)], rows(spark, (1, "a", 1)), documents={"p.json": {"governance": policy}})
    eng.transform_all(run_id="r1")
    eng.run_governance_all(run_id="r1")
    assert [r["status"] for r in eng.warehouse.read("logging.policy_audit").collect()] == [status]
