"""Plans and skew: what has to hold when the data is a thousand times larger."""

import pytest
from pyspark.sql import functions as F

from loamflow.operators import policies, quality, writes
from loamflow.operators.incremental import incremental_filter
from loamflow.plans.queries import QUERIES

ROWS, HOT = 120_000, 7


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A table whose rows carry one key for a third and NULL for another tenth, and a lookup side."""
    root = tmp_path_factory.mktemp("skew")
    id_ = F.col("id")
    key = F.when(id_ % 3 == 0, HOT).when(id_ % 10 == 1, None).otherwise(id_)
    spark.range(ROWS, numPartitions=12).select(
        key.alias("k"), id_.alias("v"), F.sha2(id_.cast("string"), 256).alias("pad")
    ).write.parquet(str(root / "big"))
    spark.range(0, ROWS * 2, 2, numPartitions=8).select(
        F.when(id_ == 8, HOT).otherwise(id_).alias("k"), (id_ + 1).alias("v"), F.lit("new").alias("pad")
    ).write.parquet(str(root / "other"))
    return spark.read.parquet(str(root / "big")), spark.read.parquet(str(root / "other"))


@pytest.fixture
def no_broadcast(conf):
    """Sort-merge joins over partitions that count as skewed at test size."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
    )


def run(df):
    """Executed plan text and row count, from one and the same execution."""
    execution = df._jdf.queryExecution()
    count = execution.toRdd().count()
    return execution.executedPlan().toString().split("Initial Plan")[0], count


def test_merge_splits_a_hot_target_key(spark, skewed, no_broadcast):
    target, source = skewed
    merged = writes.merge_upsert(target, source, ["k"])
    plan, count = run(merged)
    assert "SortMergeJoin(skew=true)" in plan and "CartesianProduct" not in plan
    target.createOrReplaceTempView("big")
    source.createOrReplaceTempView("other")
    fresh = spark.sql("SELECT count(*) FROM other WHERE k NOT IN (SELECT k FROM big WHERE k IS NOT NULL)").first()[0]
    assert count == ROWS + fresh
    assert merged.filter(F.col("k") == HOT).filter("pad = 'new' AND v = 9").count() == target.filter("k = 7").count()
    assert merged.filter("k IS NULL").count() == target.filter("k IS NULL").count()


def test_merge_keeps_hot_unmatched_source_rows(skewed, no_broadcast):
    big, other = skewed
    target = other.filter(F.col("k") != HOT)
    plan, count = run(writes.merge_upsert(target, big, ["k"]))
    assert "SortMergeJoin(skew=true)" in plan
    matched = target.join(big, "k", "left_semi").count()
    assert count == target.count() + big.count() - matched


def test_unique_rule_never_gathers_a_hot_group(skewed, no_broadcast):
    big, _ = skewed
    rules = quality.RuleSet(big, [{"check": {"function": "is_unique", "arguments": {"columns": ["k"]}}}])
    plan, count = run(rules.rejected())
    assert count == big.filter(F.col("k") == HOT).count()
    assert "Window" not in plan and "skew=true" in plan


def test_foreign_key_rule_with_hot_reference(skewed, no_broadcast):
    big, other = skewed
    rule = {"check": {"function": "foreign_key", "arguments": {"columns": ["k"], "ref_table": "big", "ref_columns": ["k"]}}}
    plan, count = run(quality.RuleSet(other, [rule], {"big": big}).rejected())
    assert count == other.join(big.select("k").distinct(), "k", "left_anti").count()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_row_filter_with_a_hot_code(spark, skewed, no_broadcast):
    big, other = skewed
    mapping = other.select(F.lit("g").alias("user_group"), F.array(F.col("k").cast("string")).alias("allowed_branch_codes"))
    plan, count = run(policies.row_filter(big, "k", mapping, ["g"]))
    assert "skew=true" in plan
    assert count == big.join(other.select("k").distinct(), "k", "left_semi").count()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scan_line(df, part):
    return next(line for line in physical(df).splitlines() if "FileScan" in line and part in line)


def test_small_source_merges_without_shuffling_the_target(spark, skewed, conf, tmp_path):
    big, _ = skewed
    conf(spark__sql__autoBroadcastJoinThreshold="10MB")
    rows = spark.createDataFrame([(7, 1, "x"), (999_999_999, 2, "y")], "k LONG, v LONG, pad STRING")
    rows.write.parquet(str(tmp_path / "staged"))
    source = spark.read.parquet(str(tmp_path / "staged"))
    merged = writes.merge_upsert(big, source, ["k"])
    plan, count = run(merged)
    assert count == ROWS + 1 and "SortMergeJoin" not in plan
    target_side = plan.split("Union")[1].split("BroadcastQueryStage")[0]
    assert "Exchange hashpartitioning" not in target_side


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    newer = incremental_filter(events, "ts", "2024-01-15 00:00:00").select("event_id")
    line = scan_line(newer, "events")
    assert "GreaterThan(ts,2024-01-15T00:00)" in line and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in line
    valid = QUERIES["dq_valid"](spark, sf_dir).select("customer_id")
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in scan_line(valid, "customer")
    rules = quality.RuleSet(events, [{"check": {"function": "is_not_null", "arguments": {"column": "user_id"}}}])
    assert "PushedFilters: [IsNotNull(user_id)]" in scan_line(rules.valid(), "events")
    masked = policies.mask_columns(spark.read.parquet(f"{sf_dir}/customer.parquet"), {"c_name": "name"})
    assert "c_acctbal" not in scan_line(masked.select("c_name"), "customer").split("ReadSchema")[1]


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "incremental_stream"])
def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark, sf_dir, name):
    plan = physical(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_clustered_compaction_spreads_a_hot_value(skewed):
    big, _ = skewed
    sizes = [
        r["n"] for r in
        writes.compact(big, 6, ["k"]).groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    ]
    assert sum(sizes) == ROWS and max(sizes) < ROWS / 3


def test_ranking_cuts_groups_before_the_shuffle(spark, sf_dir):
    plan = physical(QUERIES["passthrough_rank"](spark, sf_dir))
    assert plan.count("WindowGroupLimit") == 2 and plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_a_row_keeps_its_place_when_one_partition_is_hot(spark, skewed, tmp_path):
    """Parts of a keyed table are rebalanced, so a hot part is written by more than one task."""
    from loamflow import Warehouse

    big, _ = skewed
    warehouse = Warehouse(spark, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        dirs = warehouse.stage_parts(big, str(tmp_path / "parts"), f"CASE WHEN k = {HOT} THEN 0 ELSE k % 4 END")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.read.schema(big.schema).parquet(*dirs).count() == ROWS
    hot = spark.read.parquet(next(d for d in dirs if d.endswith("=0")))
    assert len(hot.inputFiles()) > 1
