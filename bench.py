"""Times the headline queries: one warm-up, then the median of five full evaluations each.

Evaluation is forced with a ``noop`` write, so that no column is pruned away; the last three
entries are whole loads of ``orders`` into a temporary warehouse.
Prints one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS override the defaults.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

import pyspark

from loamflow.plans.queries import QUERIES
from loamflow.plans.runner import BulkTransformEngine
from loamflow.session import local_session

HEADLINE = [
    "conform_customers",
    "customer_orders_join",
    "dq_valid",
    "dq_summary",
    "dq_quarantine",
    "dq_rule_library",
    "dq_unique",
    "dq_foreign_key",
    "merge_upsert",
    "merge_composite_key",
    "scd2_history",
    "write_append_evolve",
    "incremental_filter",
    "watermark_advance",
    "mask_columns",
    "row_filter",
    "spec_normalize",
    "config_sync",
    "migration_log",
    "run_summary",
    "passthrough_aggregate",
    "passthrough_window",
]


def load_spec(id_: str, strategy: str, sql: str, rules: bool) -> dict:
    """A normalised spec over the bound table ``raw.sales.orders``."""
    return {
        "id": id_, "description": "", "source_name": "raw.sales.orders", "target_name": f"lake.sales.{id_}",
        "target_table": id_, "pk": ["o_orderkey"], "load_strategy": strategy, "load_type": "full_refresh",
        "watermark_column": "o_orderdate", "query": sql, "sql_file": "", "run_data_quality": rules,
        "dq_config_path": "rules" if rules else "", "route": "quality" if rules else "transform",
    }


RULES = {"data_quality": {"failure_threshold_pct": 100, "checks": [
    {"name": "status_set", "check": {"function": "is_not_null", "arguments": {"column": "status"}}},
    {"name": "price_cap", "criticality": "warn",
     "check": {"function": "is_not_greater_than", "arguments": {"column": "o_totalprice", "value": 400000}}},
]}}
ORDERS_SQL = "SELECT *, nullif(o_orderstatus, 'P') AS status FROM source"
LOADS = [
    load_spec("load_append_with_rules", "append", ORDERS_SQL, True),
    load_spec("load_overwrite", "overwrite", ORDERS_SQL, False),
    load_spec("load_merge", "merge", ORDERS_SQL, False),
]


def timed(action, runs: int) -> float:
    """Median of ``runs`` after one warm-up."""
    times = []
    for i in range(runs + 1):
        start = time.perf_counter()
        action(i)
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 4)


def run_load(engine: BulkTransformEngine, spec: dict, run_id: str) -> None:
    result = engine.run_spec(spec, run_id)
    if result.error is not None:
        raise result.error


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = local_session("loamflow-bench", cpus, "12g")
    seconds = {}
    for name in HEADLINE:
        seconds[name] = timed(
            lambda i: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save(), runs
        )
    # Whole loads: read, transform, check, write, publish.
    with tempfile.TemporaryDirectory(prefix="loamflow-bench-") as root:
        engine = BulkTransformEngine(
            spark, root, bindings={"raw.sales.orders": f"{sf_dir}/orders.parquet"}, documents={"rules": RULES}
        )
        for spec in LOADS:
            seconds[spec["id"]] = timed(lambda i: run_load(engine, spec, f"run{i}"), runs)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "runs": runs,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
        "spark": pyspark.__version__,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
