"""Registered queries: every operator over the whole given tables, each with its SQL oracle.

A query takes ``(spark, sf_dir)``. The oracle is written for DuckDB over the same tables.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from loamflow.operators import cubes, dataset_rules, incremental, policies, quality, range_joins, state, transforms, writes
from loamflow.operators.sessions import sessions
from loamflow.plans.runner import BulkTransformEngine
from loamflow.schemas import CONTROL_SCHEMA
from loamflow.session import shared_folder
from loamflow.sources import specs
from loamflow.sources.snapshots import Warehouse
from loamflow.sources.tables import Tables, checked_profile, source_profile
from loamflow.streaming.incremental import incremental_stream

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in names}


def run_sql(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    return transforms.sql_transform(spark, sql, tables(spark, sf_dir, *names))


def zone_less(df: DataFrame) -> DataFrame:
    """State relations hold zoned times; the oracles compare zone-less ones."""
    return df.withColumns({
        f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if isinstance(f.dataType, TimestampType)
    })


RUN_TS = "2024-02-01 00:00:00"


def run_ts():
    return F.lit(RUN_TS).cast("timestamp")


# Projections, predicates, columns

CONFORM_SQL = """
SELECT c_custkey AS customer_id,
       INITCAP(TRIM(c_mktsegment)) AS segment,
       LOWER(TRIM(c_name)) AS name_lower,
       CONCAT(INITCAP(TRIM(c_mktsegment)), ' ', UPPER(TRIM(c_name))) AS full_name,
       REGEXP_REPLACE(c_name, '[^0-9+]', '') AS phone,
       UPPER(LEFT(TRIM(c_mktsegment), 1)) AS segment_code,
       c_acctbal AS balance
FROM source
"""

_INITCAP = "upper(left(trim(c_mktsegment), 1)) || lower(substr(trim(c_mktsegment), 2))"
_CONFORM_ORACLE = f"""
select c_custkey as customer_id, {_INITCAP} as segment, lower(trim(c_name)) as name_lower,
       {_INITCAP} || ' ' || upper(trim(c_name)) as full_name,
       regexp_replace(c_name, '[^0-9+]', '', 'g') as phone,
       upper(left(trim(c_mktsegment), 1)) as segment_code, c_acctbal as balance
from customer
"""


def conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.sql_transform(spark, CONFORM_SQL, {"source": table(spark, sf_dir, "customer")})


@query("conform_customers", _CONFORM_ORACLE)
def conform_customers(spark, sf_dir):
    return conformed(spark, sf_dir)


@query("passthrough_select", "select * from events")
def passthrough_select(spark, sf_dir):
    sql = transforms.resolve_sql({"id": "events", "query": "", "sql_file": ""})
    return transforms.sql_transform(spark, sql, {"source": table(spark, sf_dir, "events")})


# Outer, inner and outer again: the last join adds no column.
@query(
    "customer_orders_join",
    "select c.c_custkey as customer_id, t.* from customer c left join orders t on t.o_custkey = c.c_custkey "
    "join lineitem o on t.o_orderkey = o.l_orderkey left join supplier a on o.l_suppkey = a.s_suppkey",
)
def customer_orders_join(spark, sf_dir):
    sql = """
    SELECT c.c_custkey AS customer_id, t.*
    FROM customer c
    LEFT JOIN orders t ON t.o_custkey = c.c_custkey
    JOIN lineitem o ON t.o_orderkey = o.l_orderkey
    LEFT JOIN supplier a ON o.l_suppkey = a.s_suppkey
    """
    return run_sql(spark, sf_dir, sql, "customer", "orders", "lineitem", "supplier")


@query(
    "filter_not_null",
    "select d.doc_id, d.lang, l.quality from documents d left join labels l on l.doc_id = d.doc_id "
    "where l.quality is not null",
)
def filter_not_null(spark, sf_dir):
    sql = """
    SELECT d.doc_id, d.lang, l.quality
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    WHERE l.quality IS NOT NULL
    """
    return run_sql(spark, sf_dir, sql, "documents", "labels")


@query("filter_equals", "select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus = 'F'")
def filter_equals(spark, sf_dir):
    sql = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'"
    return run_sql(spark, sf_dir, sql, "orders")


@query(
    "cast_columns",
    "select cast(l_orderkey as varchar) as order_id, cast(l_linenumber as varchar) as line, "
    "cast(l_shipdate as date) as ship_day, cast(l_quantity as bigint) as quantity from lineitem",
)
def cast_columns(spark, sf_dir):
    sql = """
    SELECT CAST(l_orderkey AS string) AS order_id, CAST(l_linenumber AS string) AS line,
           CAST(l_shipdate AS date) AS ship_day, CAST(l_quantity AS bigint) AS quantity
    FROM lineitem
    """
    return run_sql(spark, sf_dir, sql, "lineitem")


@query(
    "snake_case_columns",
    "select event_id, ts as event_ts, user_id as http_user_id, event_type, value as value2_id from events",
)
def snake_case_columns(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("eventTS"),
        F.col("user_id").alias("HTTPUserId"),
        F.col("event_type").alias("Event Type"),
        F.col("value").alias("_value2ID_"),
    )
    return transforms.apply_snake_case(raw)


@query(
    "rename_columns",
    "select p_partkey as part_id, p_name as name, p_brand, p_type, p_size, p_retailprice as price from part",
)
def rename_columns(spark, sf_dir):
    names = {"p_partkey": "part_id", "p_name": "name", "p_retailprice": "price", "not_there": "x"}
    return transforms.apply_rename_columns(table(spark, sf_dir, "part"), names)


@query("drop_columns", "select page_id, url from pages")
def drop_columns(spark, sf_dir):
    return transforms.apply_drop_columns(table(spark, sf_dir, "pages"), ["html", "not_there"])


# Quality rules

_SEGMENT_SQL = "SELECT * EXCEPT (segment), NULLIF(segment, 'Machinery') AS segment FROM source"
_SEGMENT_ORACLE = (
    f"select * exclude (segment), nullif(segment, 'Machinery') as segment from ({_CONFORM_ORACLE})"
)

CUSTOMER_RULES = [
    {
        "name": "segment_not_null",
        "criticality": "error",
        "user_metadata": {"check_category": "completeness", "check_owner": "data_team"},
        "check": {"function": "is_not_null", "arguments": {"column": "segment"}},
    },
    {
        "name": "balance_not_negative",
        "criticality": "warn",
        "user_metadata": {"check_category": "validity"},
        "check": {"function": "is_not_less_than", "arguments": {"column": "balance", "value": 0}},
    },
]


def customer_rules(spark: SparkSession, sf_dir: str) -> quality.RuleSet:
    raw = transforms.sql_transform(spark, _SEGMENT_SQL, {"source": conformed(spark, sf_dir)})
    return quality.RuleSet(raw, CUSTOMER_RULES)


def names_of(findings: str):
    return F.array_join(F.transform(findings, lambda f: f["name"]), ",")


@query("dq_valid", f"select * from ({_SEGMENT_ORACLE}) where segment is not null")
def dq_valid(spark, sf_dir):
    return customer_rules(spark, sf_dir).valid()


@query(
    "dq_quarantine",
    f"select customer_id, full_name, segment, 'segment_not_null' as errors, "
    f"case when balance < 0 then 'balance_not_negative' else '' end as warnings, "
    f"'r1' as _dq_run_id, timestamp '{RUN_TS}' as _dq_quarantine_ts, 'customer' as _dq_source_table "
    f"from ({_SEGMENT_ORACLE}) where segment is null",
)
def dq_quarantine(spark, sf_dir):
    rejected = quality.with_provenance(customer_rules(spark, sf_dir).rejected(), "r1", run_ts(), "customer")
    return zone_less(rejected.select(
        "customer_id", "full_name", "segment",
        names_of(quality.ERRORS).alias("errors"), names_of(quality.WARNINGS).alias("warnings"),
        "_dq_run_id", "_dq_quarantine_ts", "_dq_source_table",
    ))


@query(
    "dq_warn_flags",
    f"select customer_id, balance, 'balance_not_negative' as warnings, segment is null as quarantined "
    f"from ({_SEGMENT_ORACLE}) where balance < 0",
)
def dq_warn_flags(spark, sf_dir):
    return customer_rules(spark, sf_dir).warned().select(
        "customer_id", "balance", names_of(quality.WARNINGS).alias("warnings"),
        (F.size(quality.ERRORS) > 0).alias("quarantined"),
    )


def _summary_oracle(relation: str, bad: str, warn: str, threshold: float = 5.0) -> str:
    return f"""
    select total_rows, fail_rows, warn_rows, total_rows - fail_rows as pass_rows, fail_pct,
           case when fail_pct > {threshold} then 'FAIL' when fail_pct > 0 then 'WARN' else 'PASS' end as status
    from (select count(*) as total_rows, count(*) filter ({bad}) as fail_rows,
                 count(*) filter ({warn}) as warn_rows,
                 round(count(*) filter ({bad}) / count(*)::double * 100, 4) as fail_pct from {relation})
    """


@query("dq_summary", _summary_oracle(f"({_SEGMENT_ORACLE})", "segment is null", "balance < 0"))
def dq_summary(spark, sf_dir):
    rules = customer_rules(spark, sf_dir)
    return quality.summarize(rules.frame.agg(*rules.metrics()))


LINE_RULES = [
    {"name": "discount_range", "user_metadata": {"check_category": "validity"},
     "check": {"function": "is_in_range", "arguments": {"column": "l_discount", "min": 0.0, "max": 0.08}}},
    {"name": "known_flag", "user_metadata": {"check_category": "validity"},
     "check": {"function": "is_in_list", "arguments": {"column": "l_returnflag", "allowed": ["A", "N"]}}},
    {"name": "quantity_cap", "criticality": "warn",
     "check": {"function": "is_not_greater_than", "arguments": {"column": "l_quantity", "value": 45}}},
    {"name": "shipped_after_1995",
     "check": {"function": "sql_expression", "arguments": {"expression": "year(l_shipdate) > 1995"}}},
]

_LINE_BAD = "not (l_discount between 0.0 and 0.08) or l_returnflag not in ('A', 'N') or not (year(l_shipdate) > 1995)"


@query(
    "dq_rule_library",
    f"""select l_orderkey, l_linenumber, l_partkey,
       concat_ws(',', case when not (l_discount between 0.0 and 0.08) then 'discount_range' end,
                 case when l_returnflag not in ('A', 'N') then 'known_flag' end,
                 case when not (year(l_shipdate) > 1995) then 'shipped_after_1995' end) as errors,
       case when l_quantity > 45 then 'quantity_cap' else '' end as warnings
    from lineitem where {_LINE_BAD}""",
)
def dq_rule_library(spark, sf_dir):
    return quality.RuleSet(table(spark, sf_dir, "lineitem"), LINE_RULES).rejected().select(
        "l_orderkey", "l_linenumber", "l_partkey",
        names_of(quality.ERRORS).alias("errors"), names_of(quality.WARNINGS).alias("warnings"),
    )


TEXT_RULES = [
    {"name": "text_filled",
     "check": {"function": "is_not_null_and_not_empty", "arguments": {"column": "text"}}},
    {"name": "no_mail_address",
     "check": {"function": "sql_expression", "arguments": {"expression": "NOT contains(text, '@')"}}},
    {"name": "has_sentence", "criticality": "warn",
     "check": {"function": "regex_match", "arguments": {"column": "text", "regex": "[a-z][.]"}}},
]


@query(
    "dq_text_rules",
    """select doc_id, lang, n_chars, not regexp_matches(text, '[a-z][.]') as flagged from documents
    where not (text is null or trim(text) = '' or contains(text, '@'))""",
)
def dq_text_rules(spark, sf_dir):
    rules = quality.RuleSet(table(spark, sf_dir, "documents"), TEXT_RULES)
    valid = rules.frame.filter(~rules.violated("error"))
    return valid.select("doc_id", "lang", "n_chars", rules.violated("warn").alias("flagged"))


@query(
    "dq_unique",
    "select * from lineitem qualify count(*) over (partition by l_orderkey, l_linenumber) > 1",
)
def dq_unique(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    rule = {"check": {"function": "is_unique", "arguments": {"columns": ["l_orderkey", "l_linenumber"]}}}
    return quality.RuleSet(lines, [rule]).rejected().select(*lines.columns)


@query(
    "dq_foreign_key",
    "select * from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey)",
)
def dq_foreign_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rule = {"name": "has_lines", "check": {"function": "foreign_key", "arguments": {
        "columns": ["o_orderkey"], "ref_table": "lineitem", "ref_columns": ["l_orderkey"]}}}
    rules = quality.RuleSet(orders, [rule], {"lineitem": table(spark, sf_dir, "lineitem")})
    return rules.rejected().select(*orders.columns)


@query("dq_scan_table", _summary_oracle("lineitem", _LINE_BAD, "l_quantity > 45", 50.0))
def dq_scan_table(spark, sf_dir):
    return quality.dq_summary(table(spark, sf_dir, "lineitem"), LINE_RULES, threshold_pct=50.0)


@query(
    "dq_by_rule",
    """select 'discount_range' as rule, 'error' as criticality, 'validity' as category,
           count(*) filter (not (l_discount between 0.0 and 0.08)) as violations from lineitem
    union all select 'known_flag', 'error', 'validity', count(*) filter (l_returnflag not in ('A', 'N')) from lineitem
    union all select 'quantity_cap', 'warn', null, count(*) filter (l_quantity > 45) from lineitem
    union all select 'shipped_after_1995', 'error', null, count(*) filter (not (year(l_shipdate) > 1995)) from lineitem
    """,
)
def dq_by_rule(spark, sf_dir):
    return quality.violations_by_rule(quality.RuleSet(table(spark, sf_dir, "lineitem"), LINE_RULES))


@query(
    "dq_run_totals",
    """select cast(sum(n - bad) as bigint) as pass_rows, cast(sum(bad) as bigint) as fail_rows,
       count(*) as tables_checked
    from (select user_id, count(*) as n, count(*) filter (event_type = 'error') as bad from events group by user_id)""",
)
def dq_run_totals(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col("event_type") == "error").alias("fail_rows")
    )
    return quality.dq_run_totals(quality.summarize(counts))


# Incremental state

@query("incremental_filter", "select * from events where ts > timestamp '2024-01-15 00:00:00'")
def incremental_filter(spark, sf_dir):
    return incremental.incremental_filter(table(spark, sf_dir, "events"), "ts", "2024-01-15 00:00:00")


@query(
    "watermark_advance",
    """select timestamp '2024-01-15 00:00:00' as mark_before, max(ts) as mark_after, count(*) as new_rows
    from events where ts > timestamp '2024-01-15 00:00:00'""",
)
def watermark_advance(spark, sf_dir):
    return incremental.watermark_advance(table(spark, sf_dir, "events"), "ts", "2024-01-15 00:00:00")


# Load strategies

@query(
    "write_overwrite",
    "select l_orderkey as o_orderkey, count(*) as lines, max(l_shipdate) as last_ship from lineitem group by l_orderkey",
)
def write_overwrite(spark, sf_dir):
    incoming = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.max("l_shipdate").alias("last_ship")
    )
    return writes.overwrite(table(spark, sf_dir, "orders"), incoming)


@query(
    "write_append_evolve",
    """select o_orderkey as id, o_orderdate as ts, o_orderstatus, null as event_type from orders
    union all select event_id, ts, null, event_type from events""",
)
def write_append_evolve(spark, sf_dir):
    target = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"), "o_orderstatus"
    )
    incoming = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "ts", "event_type")
    return writes.append(target, incoming)


# Doubled keys: some match, some are new, and the odd target keys stay as they are.
@query(
    "merge_upsert",
    """with s as (select o_orderkey * 2 as o_orderkey, o_custkey, cast(null as varchar) as o_orderstatus,
                        o_totalprice + 1 as o_totalprice, o_orderdate, o_orderpriority from orders)
    select * from s
    union all select * from orders t where not exists (select 1 from s where s.o_orderkey = t.o_orderkey)""",
)
def merge_upsert(spark, sf_dir):
    target = table(spark, sf_dir, "orders")
    source = target.withColumns({
        "o_orderkey": F.col("o_orderkey") * 2,
        "o_orderstatus": F.lit(None).cast("string"),
        "o_totalprice": F.col("o_totalprice") + 1,
    })
    return writes.merge_upsert(target, source, ["o_orderkey"])


# One source row may update several target rows; keys of two columns.
@query(
    "merge_composite_key",
    """with s as (select l_orderkey, cast(l_linenumber + 1 as integer) as l_linenumber,
                        max(l_quantity) + 100 as l_quantity, cast(null as varchar) as l_returnflag
                 from lineitem group by 1, 2),
         t as (select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem)
    select t.l_orderkey, t.l_linenumber, s.l_quantity, s.l_returnflag
      from t join s on t.l_orderkey = s.l_orderkey and t.l_linenumber = s.l_linenumber
    union all select * from t where not exists
      (select 1 from s where t.l_orderkey = s.l_orderkey and t.l_linenumber = s.l_linenumber)
    union all select * from s where not exists
      (select 1 from t where t.l_orderkey = s.l_orderkey and t.l_linenumber = s.l_linenumber)""",
)
def merge_composite_key(spark, sf_dir):
    target = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    source = (
        target.groupBy("l_orderkey", (F.col("l_linenumber") + 1).alias("l_linenumber"))
        .agg((F.max("l_quantity") + 100).alias("l_quantity"))
        .withColumn("l_returnflag", F.lit(None).cast("string"))
    )
    return writes.merge_upsert(target, source, ["l_orderkey", "l_linenumber"])


@query("merge_first_load", "select * from lineitem")
def merge_first_load(spark, sf_dir):
    source = table(spark, sf_dir, "lineitem")
    empty = spark.createDataFrame([], source.schema)
    return writes.merge_upsert(empty, source, ["l_orderkey", "l_linenumber"])


# Orders that are already 'F' do not change; the rest close and reopen; doubled keys also bring new ones.
@query(
    "scd2_history",
    f"""with h as (
        select o_orderkey, 'X' as o_orderstatus, timestamp '1990-01-01 00:00:00' as valid_from,
               o_orderdate as valid_to, false as is_current from orders
        union all select o_orderkey, o_orderstatus, o_orderdate, null, true from orders),
    s as (select o_orderkey * 2 as o_orderkey, 'F' as o_orderstatus from orders)
    select h.o_orderkey, h.o_orderstatus, h.valid_from,
           case when h.is_current and s.o_orderstatus <> h.o_orderstatus then timestamp '{RUN_TS}'
                else h.valid_to end as valid_to,
           h.is_current and not coalesce(s.o_orderstatus <> h.o_orderstatus, false) as is_current
    from h left join s on s.o_orderkey = h.o_orderkey
    union all
    select s.o_orderkey, s.o_orderstatus, timestamp '{RUN_TS}', null, true
    from s left join orders o on o.o_orderkey = s.o_orderkey
    where o.o_orderstatus is null or o.o_orderstatus <> s.o_orderstatus""",
)
def scd2_history(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    opened = orders.select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"),
    )
    closed = orders.select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"),
        F.lit("1990-01-01 00:00:00").cast("timestamp_ntz").alias("valid_from"),
        F.col("o_orderdate").alias("valid_to"), F.lit(False).alias("is_current"),
    )
    source = orders.select((F.col("o_orderkey") * 2).alias("o_orderkey"), F.lit("F").alias("o_orderstatus"))
    return writes.scd2_history(closed.unionByName(opened), source, ["o_orderkey"], F.lit(RUN_TS))


# Three loads into one history, the last one a repetition; every tenth row has no key.
_LOADED = "select nullif(o_orderkey, o_orderkey // 10 * 10) as k, o_orderkey as n, {} as status from orders"


@query(
    "scd2_incremental",
    f"""with a as ({_LOADED.format("o_orderstatus")}), b as ({_LOADED.format("case when o_orderkey % 3 = 0 then 'X' else o_orderstatus end")})
    select a.k, a.n, a.status, timestamp '2024-01-01 00:00:00' as valid_from,
           case when a.k is not null and a.status <> b.status then timestamp '2024-02-01 00:00:00' end as valid_to,
           a.k is null or a.status = b.status as is_current
    from a join b using (n)
    union all select b.k, b.n, b.status, timestamp '2024-02-01 00:00:00', null, true from a join b using (n) where a.status <> b.status""",
)
def scd2_incremental(spark, sf_dir):
    sql = "SELECT nullif(o_orderkey, o_orderkey DIV 10 * 10) AS k, o_orderkey AS n, {} AS status FROM orders"
    first = run_sql(spark, sf_dir, sql.format("o_orderstatus"), "orders")
    second = run_sql(spark, sf_dir, sql.format("IF(o_orderkey % 3 = 0, 'X', o_orderstatus)"), "orders")
    history = None
    for load, day in ((first, "2024-01-01"), (second, "2024-02-01"), (second, "2024-03-01")):
        history = writes.scd2_history(history, load, ["k"], F.lit(day))
    return history


def file_count(spark: SparkSession, sf_dir: str, name: str, cluster_by: Sequence[str] = ()) -> int:
    """How many files a table is compacted into."""
    size = Warehouse(spark, sf_dir).size_in_bytes((f"{sf_dir}/{name}.parquet",))
    return writes.files_for(size, cluster_by)


@query("compact_rows_preserved", "select * from lineitem")
def compact_rows_preserved(spark, sf_dir):
    return writes.compact(table(spark, sf_dir, "lineitem"), file_count(spark, sf_dir, "lineitem"))


@query("compact_clustered", "select * from events")
def compact_clustered(spark, sf_dir):
    return writes.compact(table(spark, sf_dir, "events"), file_count(spark, sf_dir, "events", ["ts"]), ["ts"])


# Specs. The raw rows are derived from orders: one spec per order, untrimmed and partly blank.

_RAW_SPECS = """
SELECT concat(' ', cast(o_orderkey AS string), ' ') AS id,
       o_orderpriority AS description,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'raw' END AS source_catalog,
       'sales ' AS source_schema,
       'orders' AS source_table,
       'trusted' AS target_catalog, 'sales' AS target_schema,
       concat('t', cast(o_custkey AS string)) AS target_table,
       CASE WHEN o_orderstatus = 'O' THEN ' o_orderkey | o_custkey |' ELSE NULL END AS pk,
       CASE WHEN o_orderstatus = 'O' THEN ' MERGE' WHEN o_orderstatus = 'F' THEN 'append' ELSE '' END AS load_strategy,
       CASE WHEN o_orderstatus = 'F' THEN 'Full_Refresh ' ELSE o_orderpriority END AS load_type,
       'o_orderdate' AS watermark_column,
       'SELECT * FROM source' AS query, NULL AS sql_file,
       CASE WHEN o_orderpriority LIKE '1%' THEN 'True' ELSE 'no' END AS run_optimize,
       CASE WHEN o_orderstatus = 'F' THEN ' TRUE ' ELSE 'false' END AS run_data_quality,
       CASE WHEN o_orderpriority LIKE '2%' THEN '' ELSE 'rules/orders.json' END AS dq_config_path,
       NULL AS run_governance, NULL AS governance_config_path,
       cast(o_orderdate AS string) AS last_load_time,
       CASE WHEN o_orderpriority LIKE '3%' THEN ' true' ELSE 'false' END AS processed
FROM orders
"""

_SPECS_ORACLE = """
select cast(o_orderkey as varchar) as id, o_orderpriority as description,
       case when o_orderstatus = 'P' then '' else 'raw.sales.orders' end as source_name,
       'trusted.sales.t' || o_custkey as target_name,
       case when o_orderstatus = 'O' then 'o_orderkey|o_custkey' else '' end as pk,
       case when o_orderstatus = 'F' then 'append' else 'merge' end as load_strategy,
       case when o_orderstatus = 'F' then 'full_refresh' else 'incremental' end as load_type,
       o_orderpriority like '1%' as run_optimize,
       o_orderstatus = 'F' as run_data_quality,
       false as run_governance,
       case when o_orderpriority like '2%' then '' else 'rules/orders.json' end as dq_config_path,
       o_orderpriority like '3%' as processed
from orders
"""


def normalized_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return specs.spec_normalize(run_sql(spark, sf_dir, _RAW_SPECS, "orders"))


@query("spec_normalize", _SPECS_ORACLE)
def spec_normalize(spark, sf_dir):
    return normalized_specs(spark, sf_dir).select(
        "id", "description", "source_name", "target_name", F.array_join("pk", "|").alias("pk"), "load_strategy",
        "load_type", "run_optimize", "run_data_quality", "run_governance", "dq_config_path", "processed",
    )


@query(
    "stage_flags",
    f"""select bool_or(run_data_quality) as any_run_data_quality, bool_or(run_governance) as any_run_governance,
    bool_or(run_optimize) as any_run_optimize from ({_SPECS_ORACLE})""",
)
def stage_flags(spark, sf_dir):
    return state.stage_flags(normalized_specs(spark, sf_dir))


@query(
    "runnable_specs",
    f"""select id, case when run_data_quality and dq_config_path <> '' then 'quality' else 'transform' end as route
    from ({_SPECS_ORACLE}) where not processed""",
)
def runnable_specs(spark, sf_dir):
    return specs.runnable_specs(normalized_specs(spark, sf_dir)).select("id", "route")


@query(
    "source_profile",
    " union all ".join(
        f"select '{t}' as id, true as source_ok, count(*) as source_count from {t}" for t in TABLES
    ) + " union all select 'sql_only', true, -1",
)
def source_profile_query(spark, sf_dir):
    return source_profile(spark, {**tables(spark, sf_dir, *TABLES), "sql_only": None})


# One source fails when it is read, one is not there, one has no table at all.
@query(
    "source_profile_failed",
    """select 'good' as id, true as source_ok, count(*) as source_count from lineitem
    union all select 'broken', false, -1 union all select 'missing', false, -1 union all select 'sql_only', true, -1""",
)
def source_profile_failed(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    known = Tables(spark, bindings={
        "raw.sales.lines": lines, "raw.sales.none": f"{sf_dir}/no_such_table.parquet",
        "raw.sales.broken": lines.filter(F.when(F.col("l_linenumber") > 0, F.raise_error(F.lit("unreadable")).cast("boolean"))),
    })
    names = [("good", "raw.sales.lines"), ("broken", "raw.sales.broken"), ("missing", "raw.sales.none"), ("sql_only", "")]
    return checked_profile(known, names).drop("message")


# Run state. Stored and incoming rows are derived from orders, customer and events.

_STORED_CONFIG = """
SELECT cast(o_orderkey AS string) AS id, o_orderpriority AS query,
       CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS processed
FROM orders
"""


@query(
    "config_sync",
    """with t as (select o_orderkey as k, o_orderpriority as query,
                        case when o_orderstatus = 'F' then 'true' else 'false' end as processed from orders),
         s as (select o_orderkey * 2 as k, 'new' as query, 'false' as processed from orders)
    select cast(coalesce(t.k, s.k) as varchar) as id, coalesce(s.query, t.query) as query,
           coalesce(t.processed, s.processed) as processed
    from t full join s on t.k = s.k""",
)
def config_sync(spark, sf_dir):
    stored = run_sql(spark, sf_dir, _STORED_CONFIG, "orders")
    sql = "SELECT cast(o_orderkey * 2 AS string) AS id, 'new' AS query, 'false' AS processed FROM orders"
    return state.config_sync(stored, run_sql(spark, sf_dir, sql, "orders"))


@query(
    "mark_processed",
    """select cast(o_orderkey as varchar) as id, o_orderpriority as query,
       case when o_orderstatus = 'F' or o_orderkey in (select event_id from events where event_type = 'purchase')
            then 'true' else 'false' end as processed from orders""",
)
def mark_processed(spark, sf_dir):
    stored = run_sql(spark, sf_dir, _STORED_CONFIG, "orders")
    return state.mark_processed(stored, run_results(spark, sf_dir))


_RESULTS = """
SELECT 'r1' AS run_id, cast(event_id AS string) AS id, event_type AS stage,
       'raw.events' AS source_table, concat('trusted.u', cast(user_id AS string)) AS target_table,
       'append' AS load_strategy,
       CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' ELSE 'SKIPPED' END AS status,
       event_id AS rows_loaded, user_id AS source_count, props || repeat('x', 3000) AS message,
       date_trunc('HOUR', ts) AS started_at, ts AS finished_at
FROM events
"""

_RESULTS_ORACLE = """
select 'r1' as run_id, cast(event_id as varchar) as id, event_type as stage, 'raw.events' as source_table,
       'trusted.u' || user_id as target_table, 'append' as load_strategy,
       case event_type when 'purchase' then 'SUCCESS' when 'error' then 'FAILED' else 'SKIPPED' end as status,
       event_id as rows_loaded, user_id as source_count, props || repeat('x', 3000) as message,
       date_trunc('hour', ts) as started_at, ts as finished_at
from events
"""


def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, _RESULTS, "events")


@query(
    "migration_log",
    f"""select md5(run_id || '|' || id || '|' || stage) as log_id, finished_at as log_ts, run_id,
       case when status = 'FAILED' then 'ERROR' else 'INFO' end as level, id as table_id, source_table, target_table,
       load_strategy, rows_loaded, status, stage, message,
       cast(floor(epoch(finished_at)) - floor(epoch(started_at)) as bigint) as duration_seconds
    from ({_RESULTS_ORACLE})""",
)
def migration_log(spark, sf_dir):
    return zone_less(state.migration_log(run_results(spark, sf_dir)))


@query(
    "run_summary",
    f"""select status, count(*) as tables,
       cast(sum(case when status = 'SUCCESS' then rows_loaded else 0 end) as bigint) as rows_loaded
    from ({_RESULTS_ORACLE}) group by status""",
)
def run_summary(spark, sf_dir):
    return state.run_summary(run_results(spark, sf_dir))


# Control rows per user that occurs in the events.
_CONTROL = """
SELECT cast(user_id AS string) AS id, cast(max(ts) AS timestamp) AS last_load_time, max(event_type) AS last_run_status,
       cast(min(ts) AS timestamp) AS last_run_ts, count(*) AS rows_loaded, max(event_id) AS source_count,
       max(props) AS error_message
FROM events GROUP BY user_id
"""
_CONTROL_ORACLE = """
select cast(user_id as varchar) as id, max(ts) as last_load_time, max(event_type) as last_run_status,
       min(ts) as last_run_ts, count(*) as rows_loaded, max(event_id) as source_count, max(props) as error_message
from events group by user_id
"""


def control_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, _CONTROL, "events").to(spark.createDataFrame([], CONTROL_SCHEMA).schema)


@query(
    "control_bootstrap",
    f"""select * from ({_CONTROL_ORACLE})
    union all select cast(c_custkey as varchar),
       case when c_mktsegment = 'BUILDING' then timestamp '2024-01-01 00:00:00' end, 'BOOTSTRAPPED',
       timestamp '{RUN_TS}', 0, 0, ''
    from customer where c_custkey not in (select user_id from events)""",
)
def control_bootstrap(spark, sf_dir):
    sql = """
    SELECT cast(c_custkey AS string) AS id,
           CASE c_mktsegment WHEN 'BUILDING' THEN '2024-01-01 00:00:00' WHEN 'MACHINERY' THEN 'soon' ELSE '' END
             AS last_load_time
    FROM customer
    """
    wanted = run_sql(spark, sf_dir, sql, "customer")
    return zone_less(state.control_bootstrap(control_rows(spark, sf_dir), wanted, run_ts()))


@query(
    "control_update",
    f"""with r as (select cast(o_custkey as varchar) as id, max(o_orderstatus) as status, max(o_orderdate) as finished_at,
                        count(*) as rows_loaded, max(o_orderkey) as source_count, max(o_orderpriority) as message
                 from orders group by o_custkey)
    select c.id, c.last_load_time, coalesce(r.status, c.last_run_status) as last_run_status,
           coalesce(r.finished_at, c.last_run_ts) as last_run_ts, coalesce(r.rows_loaded, c.rows_loaded) as rows_loaded,
           coalesce(r.source_count, c.source_count) as source_count, coalesce(r.message, c.error_message) as error_message
    from ({_CONTROL_ORACLE}) c left join r on r.id = c.id""",
)
def control_update(spark, sf_dir):
    sql = """
    SELECT cast(o_custkey AS string) AS id, max(o_orderstatus) AS status, max(o_orderdate) AS finished_at,
           count(*) AS rows_loaded, max(o_orderkey) AS source_count, max(o_orderpriority) AS message
    FROM orders GROUP BY o_custkey
    """
    return zone_less(state.control_update(control_rows(spark, sf_dir), run_sql(spark, sf_dir, sql, "orders")))


@query(
    "audit_records",
    f"""select 'r1' as run_id, c.c_mktsegment as pipeline_name, 'sales.' || c.c_name as table_name,
       'loamflow' as run_by, timestamp '2024-02-01 00:01:30' as run_timestamp,
       coalesce(k.source_count, 0) as source_row_count, coalesce(k.rows_loaded, 0) as target_row_count,
       coalesce(d.bad, 0) as quarantine_row_count, coalesce(d.n - d.bad, 0) as dq_pass_count,
       coalesce(d.bad, 0) as dq_fail_count, 'merge' as load_strategy,
       coalesce(k.last_run_status, 'UNKNOWN') as status, coalesce(k.error_message, '') as error_message,
       cast(90 as bigint) as duration_seconds
    from customer c left join ({_CONTROL_ORACLE}) k on k.id = cast(c.c_custkey as varchar)
    left join (select o_custkey, count(*) as n, count(*) filter (o_orderstatus = 'P') as bad
               from orders group by o_custkey) d on d.o_custkey = c.c_custkey""",
)
def audit_records(spark, sf_dir):
    wanted = run_sql(
        spark, sf_dir,
        "SELECT cast(c_custkey AS string) AS id, c_mktsegment AS description, 'sales' AS target_schema, "
        "c_name AS target_table, 'merge' AS load_strategy FROM customer",
        "customer",
    )
    dq = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("id")).agg(
        F.count_if(F.col("o_orderstatus") != "P").alias("dq_pass"),
        F.count_if(F.col("o_orderstatus") == "P").alias("dq_fail"),
    )
    finished = F.lit("2024-02-01 00:01:30").cast("timestamp")
    return zone_less(
        state.audit_records(wanted, control_rows(spark, sf_dir), "r1", run_ts(), finished, dq)
    )


@query(
    "policy_audit",
    f"""select 'r1' as run_id, 'unknown' as pipeline_name, 'trusted.u' || user_id as table_name, 'unknown' as run_by,
       timestamp '{RUN_TS}' as run_timestamp, cast(0 as bigint) as source_row_count,
       cast(0 as bigint) as target_row_count, cast(0 as bigint) as quarantine_row_count,
       cast(0 as bigint) as dq_pass_count, cast(0 as bigint) as dq_fail_count, 'unknown' as load_strategy,
       coalesce(nullif(event_type, 'view'), 'unknown') as status, '' as error_message,
       cast(0 as bigint) as duration_seconds from events""",
)
def policy_audit(spark, sf_dir):
    sql = """
    SELECT 'r1' AS run_id, concat('trusted.u', cast(user_id AS string)) AS table_name,
           nullif(event_type, 'view') AS status
    FROM events
    """
    return zone_less(state.policy_audit(run_sql(spark, sf_dir, sql, "events"), run_ts()))


# Policies

_PERSONS = """
SELECT c_custkey, c_mktsegment, c_name AS last_name, concat(c_mktsegment, ' ', c_name) AS full_name,
       concat(lower(c_name), '@mail.example') AS email,
       CASE WHEN c_acctbal < 0 THEN 'UNKNOWN' ELSE concat('+', c_name) END AS phone,
       c_name AS address
FROM customer
"""
_PERSONS_ORACLE = """
select c_custkey, c_mktsegment, c_name as last_name, c_mktsegment || ' ' || c_name as full_name,
       lower(c_name) || '@mail.example' as email,
       case when c_acctbal < 0 then 'UNKNOWN' else '+' || c_name end as phone, c_name as address
from customer
"""
_DIGITS = "regexp_replace(phone, '[^0-9]', '', 'g')"
_HIDDEN = {
    "last_name": "left(last_name, 1) || '***'",
    "full_name": "split(full_name, ' ')[1] || ' ***'",
    "email": "split(email, '@')[1] || '@***.***'",
    "phone": f"case when phone = 'UNKNOWN' then phone else "
             f"repeat('*', greatest(length({_DIGITS}) - 4, 0)::int) || right({_DIGITS}, 4) end",
    "address": "'*** REDACTED ***'",
}
PERSON_MASKS = {"last_name": "name", "full_name": "full_name", "email": "email", "phone": "phone", "address": "address"}


# Row rules and dataset rules in one pass over each day of events; the days' measures combine to those of all events.
EVENT_RULES = [
    {"name": "enough", "check": {"function": "row_count", "arguments": {"min": 100}}},
    {"name": "few", "criticality": "warn", "check": {"function": "row_count", "arguments": {"max": 150}}},
    {"name": "typed", "check": {"function": "completeness", "arguments": {"column": "kind", "min": 0.7}}},
    {"name": "complete", "check": {"function": "completeness", "arguments": {"column": "kind", "min": 0.99}}},
    {"name": "fresh", "check": {"function": "freshness", "arguments": {"column": "ts", "max": 15 * 86400}}},
    {"name": "usual", "check": {"function": "mean", "arguments": {"column": "event_id", "min": 0, "max": 5000}}},
    {"name": "own_ids", "check": {"function": "distinct_share", "arguments": {"column": "event_id", "min": 0.9}}},
    {"name": "shared", "check": {"function": "distinct_share", "arguments": {"column": "kind", "min": 0.9}}},
]


@query(
    "dq_dataset_rules",
    f"""with e as (select coalesce(cast(cast(ts as date) as varchar), '-') as day, *, nullif(event_type, 'error') as kind from events),
    m as (select case when grouping(day) = 1 then 'all' else day end as part, count(*) as n,
        cast(sum(case when value < 1 then 1 else 0 end) as bigint) as fail_rows, count(kind) / count(*) as typed,
        epoch(timestamp '2024-02-01 00:00:00') - epoch(max(ts)) as age, avg(event_id) as mean,
        count(distinct event_id) / count(event_id) as ids, count(distinct kind) / count(kind) as kinds
        from e group by rollup (day))
    select part, n as total_rows, fail_rows, unnest(['enough', 'few', 'typed', 'complete', 'fresh', 'usual', 'own_ids', 'shared']) as name,
        unnest([n >= 100, n <= 150, typed >= 0.7, typed >= 0.99, age <= {15 * 86400}, mean <= 5000, ids >= 0.9, kinds >= 0.9]) as passed
    from m""",
)
def dq_dataset_rules(spark, sf_dir):
    sql = "SELECT coalesce(cast(cast(ts AS date) AS string), '-') AS day, *, nullif(event_type, 'error') AS kind FROM events"
    events = run_sql(spark, sf_dir, sql, "events")
    rows = quality.RuleSet(events, [
        {"name": "price", "check": {"function": "is_not_less_than", "arguments": {"column": "value", "value": 1}}},
    ])
    whole = dataset_rules.DatasetRules(events, EVENT_RULES)
    days = rows.frame.groupBy("day").agg(*rows.metrics(), *whole.metrics())
    counts = [F.sum(c).alias(c) for c in ("total_rows", "fail_rows")]
    total = whole.merged(days, also=counts).withColumn("part", F.lit("all"))
    parts = days.withColumnRenamed("day", "part").drop("warn_rows").unionByName(total)
    told = whole.verdicts(parts, datetime(2024, 2, 1), "part", "total_rows", "fail_rows")
    return told.select("part", "total_rows", "fail_rows", "name", "passed")


@query(
    "mask_columns",
    "select c_custkey, c_mktsegment, "
    + ", ".join(f"case when c_mktsegment = 'BUILDING' then {c} else {h} end as {c}" for c, h in _HIDDEN.items())
    + f" from ({_PERSONS_ORACLE})",
)
def mask_columns(spark, sf_dir):
    persons = run_sql(spark, sf_dir, _PERSONS, "customer")
    return policies.mask_columns(persons, PERSON_MASKS, privileged=F.col("c_mktsegment") == "BUILDING")


@query(
    "mask_by_tag",
    "select c_custkey, c_mktsegment, " + ", ".join(f"{h} as {c}" for c, h in _HIDDEN.items())
    + f" from ({_PERSONS_ORACLE})",
)
def mask_by_tag(spark, sf_dir):
    persons = run_sql(spark, sf_dir, _PERSONS, "customer")
    tagged = policies.with_column_tags(persons, {c: {"pii": kind} for c, kind in PERSON_MASKS.items()})
    return policies.mask_by_tag(tagged)


@query(
    "row_filter",
    """select c.* from customer c where exists (select 1 from nation n join region r on r.r_regionkey = n.n_regionkey
    where r.r_name in ('ASIA', 'EUROPE') and n.n_nationkey = c.c_nationkey)""",
)
def row_filter(spark, sf_dir):
    mapping = run_sql(
        spark, sf_dir,
        "SELECT r_name AS user_group, array(cast(n_nationkey AS string)) AS allowed_branch_codes "
        "FROM nation JOIN region ON r_regionkey = n_regionkey",
        "nation", "region",
    )
    return policies.row_filter(table(spark, sf_dir, "customer"), "c_nationkey", mapping, ["ASIA", "EUROPE"])


# A policy whose functions have names of a catalog and schemas that are not there.
SQL_POLICY = {
    "pii_columns": [
        {"column": "c_name", "masking_function": "hide_name", "masking_sql":
            "CREATE OR REPLACE FUNCTION main.gov.hide_name(v STRING) RETURNS STRING RETURN "
            "CASE WHEN is_account_group_member('auditors') THEN v ELSE concat(left(v, 4), '***') END"},
        {"column": "c_mktsegment", "masking_function": "main.gov.hide_segment", "masking_sql":
            "CREATE FUNCTION main.gov.hide_segment(s STRING) RETURN "
            "CASE WHEN is_account_group_member('sales') THEN lower(s) ELSE '-' END"},
    ],
    "row_level_security": {
        "enabled": True, "rls_function_name": "gov.own_customers", "filter_columns": ["c_nationkey", "c_acctbal"],
        "function_sql": "CREATE FUNCTION main.gov.own_customers(k INT, balance DOUBLE) RETURNS BOOLEAN "
                        "RETURN k % 5 <> 2 AND nullif(balance, 0) > 0",
    },
}


@query(
    "mask_sql_functions",
    """select c_custkey, left(c_name, 4) || '***' as c_name, c_nationkey, c_acctbal, lower(c_mktsegment) as c_mktsegment
    from customer where c_nationkey % 5 <> 2 and c_acctbal > 0""",
)
def mask_sql_functions(spark, sf_dir):
    return policies.govern(table(spark, sf_dir, "customer"), SQL_POLICY, False, ["sales"])


@query(
    "tag_inventory",
    """with e as (select p_brand as table_name, nullif(p_name, 'small ring') as column_name, p_type,
                        case when p_size > 25 then 'high' else '' end as sensitivity from part)
    select table_name, column_name, 'pii' as tag_key, p_type as tag_value from e
    union all select table_name, column_name, 'sensitivity', sensitivity from e
      where column_name is null or sensitivity <> ''""",
)
def tag_inventory(spark, sf_dir):
    entries = run_sql(
        spark, sf_dir,
        "SELECT p_brand AS table_name, nullif(p_name, 'small ring') AS column_name, "
        "map('pii', p_type, 'sensitivity', CASE WHEN p_size > 25 THEN 'high' ELSE '' END) AS tags FROM part",
        "part",
    )
    return policies.tag_inventory(entries)


# The SQL surface that passes straight through

@query(
    "passthrough_aggregate",
    """select l_returnflag, l_linestatus, count(*) as lines, sum(l_quantity) as quantity, max(l_extendedprice) as top
    from lineitem group by rollup (l_returnflag, l_linestatus)""",
)
def passthrough_aggregate(spark, sf_dir):
    sql = """
    SELECT l_returnflag, l_linestatus, count(*) AS lines, sum(l_quantity) AS quantity, max(l_extendedprice) AS top
    FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
    """
    return run_sql(spark, sf_dir, sql, "lineitem")


# The window runs over daily counts, so a partition holds one row per day however many events there are.
@query(
    "passthrough_window",
    """select event_type, day, n, cast(sum(n) over (partition by event_type order by day) as bigint) as running
    from (select event_type, cast(ts as date) as day, count(*) as n from events group by 1, 2)""",
)
def passthrough_window(spark, sf_dir):
    sql = """
    SELECT event_type, day, n, sum(n) OVER (PARTITION BY event_type ORDER BY day) AS running
    FROM (SELECT event_type, cast(ts AS date) AS day, count(*) AS n FROM events GROUP BY 1, 2)
    """
    return run_sql(spark, sf_dir, sql, "events")


# Spark cuts every group to its best three before the shuffle.
@query(
    "passthrough_rank",
    """select user_id, event_id, value, rn from (
      select user_id, event_id, value, row_number() over (partition by user_id order by value desc, event_id) as rn
      from events) where rn <= 3""",
)
def passthrough_rank(spark, sf_dir):
    sql = """
    SELECT user_id, event_id, value, cast(rn AS bigint) AS rn FROM (
      SELECT user_id, event_id, value,
             row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn
      FROM events) WHERE rn <= 3
    """
    return run_sql(spark, sf_dir, sql, "events")


@query(
    "passthrough_setops",
    """select 'no_orders' as kind, c_custkey as id from
         (select c_custkey from customer except select o_custkey from orders)
    union all select 'active', id from (select user_id as id from events intersect select o_custkey from orders)
    union all select 'any', id from (select o_custkey as id from orders union select user_id from events)""",
)
def passthrough_setops(spark, sf_dir):
    sql = """
    SELECT 'no_orders' AS kind, c_custkey AS id FROM
      (SELECT DISTINCT c_custkey FROM customer EXCEPT SELECT DISTINCT o_custkey FROM orders)
    UNION ALL SELECT 'active', id FROM
      (SELECT DISTINCT user_id AS id FROM events INTERSECT SELECT DISTINCT o_custkey FROM orders)
    UNION ALL SELECT 'any', id FROM
      (SELECT DISTINCT o_custkey AS id FROM orders UNION SELECT DISTINCT user_id FROM events)
    """
    return run_sql(spark, sf_dir, sql, "customer", "orders", "events")


@query(
    "passthrough_topk",
    "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20",
)
def passthrough_topk(spark, sf_dir):
    sql = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"
    return run_sql(spark, sf_dir, sql, "orders")


@query(
    "passthrough_semi_anti",
    """select d.doc_id, d.lang, d.source from documents d
    where exists (select 1 from labels l where l.doc_id = d.doc_id and l.quality = 1)
      and not exists (select 1 from labels l where l.doc_id = d.doc_id and l.toxic = 1)""",
)
def passthrough_semi_anti(spark, sf_dir):
    sql = """
    SELECT d.doc_id, d.lang, d.source FROM documents d
    WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) g WHERE g.doc_id = d.doc_id)
      AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1) t WHERE t.doc_id = d.doc_id)
    """
    return run_sql(spark, sf_dir, sql, "documents", "labels")


@query(
    "passthrough_dates",
    """select cast(year(o_orderdate) as integer) as y, cast(quarter(o_orderdate) as integer) as q, count(*) as orders,
       min(date_diff('day', o_orderdate, timestamp '2002-01-01 00:00:00')) as nearest
    from orders group by 1, 2""",
)
def passthrough_dates(spark, sf_dir):
    sql = """
    SELECT year(o_orderdate) AS y, quarter(o_orderdate) AS q, count(*) AS orders,
           cast(min(datediff(DATE'2002-01-01', o_orderdate)) AS bigint) AS nearest
    FROM orders GROUP BY 1, 2
    """
    return run_sql(spark, sf_dir, sql, "orders")


@query(
    "passthrough_json",
    """select cast(json_extract_string(props, '$.k') as integer) as k, count(*) as n, max(event_id) as last_event
    from events group by 1""",
)
def passthrough_json(spark, sf_dir):
    sql = """
    SELECT cast(get_json_object(props, '$.k') AS int) AS k, count(*) AS n, max(event_id) AS last_event
    FROM events GROUP BY 1
    """
    return run_sql(spark, sf_dir, sql, "events")


@query(
    "passthrough_sessions",
    """select event_type, user_id % 3 as kind, min(ts) as session_start, max(ts) as session_end, count(*) as n_rows,
       cast(sum(event_id) as bigint) as event_id
    from (select *, sum(starts) over (partition by event_type, user_id % 3 order by ts, event_id) as session
          from (select *, case when epoch_us(ts) - lag(epoch_us(ts)) over (partition by event_type, user_id % 3 order by ts, event_id)
                               < 900000000 then 0 else 1 end as starts from events))
    group by event_type, user_id % 3, session""",
)
def passthrough_sessions(spark, sf_dir):
    events = run_sql(spark, sf_dir, "SELECT *, user_id % 3 AS kind FROM events", "events")
    return sessions(events, ["event_type", "kind"], "ts", 900, ["event_id"], width_seconds=86_400)


@query(
    "passthrough_range_frame",
    """select event_id, count(*) over w as n, cast(sum(event_id) over w as bigint) as ids from events
    window w as (partition by user_id order by ts range between interval 6 hours preceding and current row)""",
)
def passthrough_range_frame(spark, sf_dir):
    sql = """
    SELECT event_id, count(*) OVER w AS n, sum(event_id) OVER w AS ids FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW)
    """
    return run_sql(spark, sf_dir, sql, "events")


@query(
    "passthrough_maps",
    """select event_id, cast(json_extract_string(props, '$.k') as integer) as k, 2 * cast(json_extract_string(props, '$.k') as integer) as doubled,
       case when cast(json_extract_string(props, '$.k') as integer) > 50 then 'k' else '' end as large,
       case event_type when 'click' then user_id when 'k' then -1 end as clicks, 2 as keys
    from events""",
)
def passthrough_maps(spark, sf_dir):
    sql = """
    SELECT event_id, from_json(props, 'k INT').k AS k, transform_values(m, (key, v) -> 2 * v)['k'] AS doubled,
           array_join(map_keys(map_filter(m, (key, v) -> v > 50)), ',') AS large, try_element_at(by_type, 'click') AS clicks,
           cardinality(map_concat(m, by_type)) AS keys
    FROM (SELECT *, from_json(props, 'MAP<STRING, BIGINT>') AS m, map_from_arrays(array(event_type), array(user_id)) AS by_type FROM events)
    """
    return run_sql(spark, sf_dir, sql, "events")


@query(
    "passthrough_math",
    """select l_orderkey, l_linenumber, round(sqrt(l_extendedprice), 4) as root, round(ln(1 + l_quantity), 4) as logarithm,
       round(pow(1 + l_discount, 2), 6) as squared, cast(floor(l_extendedprice / 7) as bigint) as sevenths,
       cast(ceil(l_tax * 100) as bigint) as tax, l_partkey % 11 as rest, abs(l_suppkey - l_partkey) as apart,
       cast(sign(l_suppkey - l_partkey) as integer) as side, greatest(l_suppkey, l_partkey) as top, xor(l_suppkey, l_partkey) as bits
    from lineitem""",
)
def passthrough_math(spark, sf_dir):
    sql = """
    SELECT l_orderkey, l_linenumber, round(sqrt(l_extendedprice), 4) AS root, round(ln(1 + l_quantity), 4) AS logarithm,
           round(power(1 + l_discount, 2), 6) AS squared, floor(l_extendedprice / 7) AS sevenths, ceil(l_tax * 100) AS tax,
           l_partkey % 11 AS rest, abs(l_suppkey - l_partkey) AS apart, cast(sign(l_suppkey - l_partkey) AS int) AS side,
           greatest(l_suppkey, l_partkey) AS top, l_suppkey ^ l_partkey AS bits
    FROM lineitem
    """
    return run_sql(spark, sf_dir, sql, "lineitem")


# Events, in seconds of the orders' own years, and the stretch of days for which an order is open; a few are open for long.
_EVENT_SECONDS = "SELECT event_id, user_id, 788918400 + (unix_seconds(cast(ts AS timestamp)) - 1704067200) * 80 AS at FROM events"
_EVENT_SECONDS_ORACLE = """select event_id, user_id,
       788918400 + (cast(floor(epoch(ts)) as bigint) - 1704067200) * 80 as at from events"""
_OPEN_ORDERS = """
SELECT o_orderkey, o_custkey % 150 AS customer, unix_seconds(cast(o_orderdate AS timestamp)) AS opened,
       unix_seconds(cast(o_orderdate AS timestamp)) + 86400 * IF(o_orderkey % 97 = 0, 400, 1 + o_orderkey % 30) AS closed
FROM orders
"""
_OPEN_ORDERS_ORACLE = """select o_orderkey, o_custkey % 150 as customer, cast(epoch(o_orderdate) as bigint) as opened,
       cast(epoch(o_orderdate) as bigint) + 86400 * case when o_orderkey % 97 = 0 then 400 else 1 + o_orderkey % 30 end as closed
    from orders"""


@query(
    "join_interval",
    f"""select * from ({_EVENT_SECONDS_ORACLE}) e left join ({_OPEN_ORDERS_ORACLE}) o
    on e.user_id = o.customer and e.at >= o.opened and e.at < o.closed""",
)
def join_interval(spark, sf_dir):
    events = run_sql(spark, sf_dir, _EVENT_SECONDS, "events")
    orders = run_sql(spark, sf_dir, _OPEN_ORDERS, "orders")
    return range_joins.interval_join(events, orders, "at", "opened", "closed", [("user_id", "customer")], "left")


@query(
    "join_as_of",
    f"""select e.*, o.o_orderkey, o.o_orderdate, o.o_totalprice
    from (select event_id, user_id, make_timestamp(s.at * 1000000) as at from ({_EVENT_SECONDS_ORACLE}) s) e
    asof left join (select * from orders qualify row_number() over (partition by o_custkey, o_orderdate order by o_orderkey desc) = 1) o
    on e.user_id = o.o_custkey and e.at >= o.o_orderdate""",
)
def join_as_of(spark, sf_dir):
    events = run_sql(spark, sf_dir, f"SELECT event_id, user_id, cast(timestamp_seconds(at) AS timestamp_ntz) AS at FROM ({_EVENT_SECONDS})", "events")
    orders = run_sql(spark, sf_dir, "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders", "orders")
    last = range_joins.as_of_join(
        events, orders, "at", "o_orderdate", [("user_id", "o_custkey")], width=30 * 86_400_000_000, latest=["o_orderkey"]
    )
    return last.drop("o_custkey")


@query(
    "passthrough_cube",
    """select l_returnflag, l_linestatus, l_linenumber, cast(grouping(l_returnflag, l_linestatus, l_linenumber) as bigint) as grp,
       count(*) as lines, count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers,
       sum(cast(l_quantity as bigint))::bigint as quantity
    from lineitem group by cube (l_returnflag, l_linestatus, l_linenumber)""",
)
def passthrough_cube(spark, sf_dir):
    lines = run_sql(
        spark, sf_dir,
        "SELECT l_returnflag, l_linestatus, l_linenumber, l_partkey, l_suppkey, cast(l_quantity AS bigint) AS l_quantity FROM lineitem",
        "lineitem",
    )
    cube = cubes.cube_counts(
        lines, ["l_returnflag", "l_linestatus", "l_linenumber"], {"parts": "l_partkey", "suppliers": "l_suppkey"},
        {"lines": F.lit(1).cast("long"), "quantity": F.col("l_quantity")}, "grp",
    )
    return cube.select("l_returnflag", "l_linestatus", "l_linenumber", "grp", "lines", "parts", "suppliers", "quantity")


@query(
    "passthrough_grouping_sets",
    """select event_type, user_id, cast(grouping(event_type, user_id) as bigint) as grp, count(*) as n, max(event_id) as last_event,
       count(distinct cast(ts as date)) as days from events
    group by grouping sets ((event_type, user_id), (event_type), (user_id), ())""",
)
def passthrough_grouping_sets(spark, sf_dir):
    sql = """
    SELECT event_type, user_id, grouping_id() AS grp, count(*) AS n, max(event_id) AS last_event,
           count(DISTINCT cast(ts AS date)) AS days
    FROM events GROUP BY GROUPING SETS ((event_type, user_id), (event_type), (user_id), ())
    """
    return run_sql(spark, sf_dir, sql, "events")


# End to end: two specs append to one target in one run, each above its own mark, and a second run brings
# nothing twice. The events are older than the newest order and must not be held up by its mark.
@query(
    "load_two_sources",
    """select o_orderkey as k, 'order' as kind, o_orderdate as ts from orders
    union all select event_id, 'event', ts from events""",
)
def load_two_sources(spark, sf_dir):
    sources = {
        "orders": run_sql(spark, sf_dir, "SELECT o_orderkey AS k, 'order' AS kind, o_orderdate AS ts FROM orders", "orders"),
        "events": run_sql(spark, sf_dir, "SELECT event_id AS k, 'event' AS kind, ts FROM events", "events"),
    }
    engine = BulkTransformEngine(
        spark, f"{engine_folder(spark)}/warehouse", bindings={f"raw.facts.{name}": df for name, df in sources.items()}
    )
    for run in ("run1", "run1", "run2"):
        for name in sources:
            result = engine.run_spec({
                "id": name, "description": "", "source_name": f"raw.facts.{name}", "target_name": "trusted.facts",
                "target_table": "facts", "pk": [], "load_strategy": "append", "load_type": "incremental",
                "watermark_column": "ts", "query": "SELECT * FROM source", "sql_file": "", "run_data_quality": False,
                "dq_config_path": "", "route": "transform",
            }, run)
            if result.error is not None:
                raise result.error
    return engine.warehouse.read("trusted.facts")


# End to end: loads of one run that come again, after another spec has merged into or replaced their table.
@query(
    "load_retried",
    """select 'merged' as name, o_orderkey as k, o_totalprice + 1 as price from orders where o_orderstatus in ('F', 'O')
    union all select 'replaced', o_orderkey, o_totalprice from orders where o_orderstatus = 'P'""",
)
def load_retried(spark, sf_dir):
    engine = BulkTransformEngine(
        spark, f"{engine_folder(spark)}/warehouse", bindings={"raw.sales.orders": table(spark, sf_dir, "orders")}
    )
    some = "SELECT o_orderkey AS k, o_totalprice{} AS price FROM source WHERE o_orderstatus IN ({})"
    loads = {
        "first": ("merged", "append", some.format("", "'F'")), "change": ("merged", "merge", some.format(" + 1", "'F', 'O'")),
        "old": ("replaced", "append", some.format("", "'F', 'O'")), "new": ("replaced", "overwrite", some.format("", "'P'")),
    }
    for name in ("first", "change", "first", "old", "new", "old", "change", "first", "new", "old"):
        target, strategy, sql = loads[name]
        result = engine.run_spec({
            "id": name, "description": "", "source_name": "raw.sales.orders", "target_name": f"trusted.{target}",
            "target_table": target, "pk": ["k"], "load_strategy": strategy, "load_type": "full_refresh",
            "watermark_column": "", "query": sql, "sql_file": "", "run_data_quality": False, "dq_config_path": "",
            "route": "transform",
        }, "run1")
        if result.error is not None:
            raise result.error
    both = [engine.warehouse.read(f"trusted.{t}").select(F.lit(t).alias("name"), "k", "price") for t in ("merged", "replaced")]
    return both[0].unionByName(both[1])


# End to end: three deliveries of events by day. "again" re-reads some days and gets late rows below its mark; "tied" gets the rest of a day
# whose first rows it has. Both end with every event, once.
@query(
    "late_rows",
    """select 'again' as name, event_id, cast(ts as date) as day from events
    union all select 'tied', event_id, cast(ts as date) from events""",
)
def late_rows(spark, sf_dir):
    engine = BulkTransformEngine(spark, f"{engine_folder(spark)}/warehouse", late={
        "again": incremental.LateRows(overlap="40 days"), "tied": incremental.LateRows(tie="event_id"),
    })
    events = run_sql(spark, sf_dir, "SELECT event_id, cast(ts AS date) AS day FROM events", "events")
    n = events.count()
    for run in (1, 2, 3):
        there = F.col("event_id") < n * run / 3
        engine.tables.bind("raw.facts.again", events.filter(there & ((F.col("event_id") % 5 != 0) | F.lit(run == 3))))
        engine.tables.bind("raw.facts.tied", events.filter(there))
        for name in ("again", "tied"):
            result = engine.run_spec({
                "id": name, "description": "", "source_name": f"raw.facts.{name}", "target_name": f"trusted.{name}",
                "target_table": name, "pk": ["event_id"], "load_strategy": "append", "load_type": "incremental",
                "watermark_column": "day", "query": "", "sql_file": "", "run_data_quality": False, "dq_config_path": "",
                "route": "transform",
            }, f"run{run}")
            if result.error is not None:
                raise result.error
    both = [engine.warehouse.read(f"trusted.{t}").select(F.lit(t).alias("name"), "event_id", "day") for t in ("again", "tied")]
    return both[0].unionByName(both[1])


@query(
    "load_timestamp",
    f"select o_orderkey, timestamp '{RUN_TS}' as loaded_at, 'current_timestamp()' as said from orders",
)
def load_timestamp(spark, sf_dir):
    sql = "SELECT o_orderkey, current_timestamp() AS loaded_at, 'current_timestamp()' AS said FROM source"
    inputs = {"source": table(spark, sf_dir, "orders")}
    return zone_less(transforms.sql_transform(spark, sql, inputs, as_of=datetime.fromisoformat(RUN_TS)))


@query("sql_quoted_names", "select o_orderkey, 'raw.sales.orders' as src from orders where o_orderstatus <> 'raw.sales.orders'")
def sql_quoted_names(spark, sf_dir):
    sql = """SELECT o_orderkey, 'raw.sales.orders' AS src -- of raw.sales.orders
             FROM raw.sales.orders WHERE o_orderstatus <> 'raw.sales.orders'"""
    return transforms.sql_transform(spark, sql, {"raw.sales.orders": table(spark, sf_dir, "orders")})


# End to end: a spec with a keyed merge, driven by a stream over the events. The result does not
# depend on how the stream is cut into batches.
@query("incremental_stream", "select event_id, user_id, upper(event_type) as kind, ts from events")
def incremental_stream_query(spark, sf_dir):
    folder = engine_folder(spark)
    engine = BulkTransformEngine(spark, f"{folder}/warehouse")
    spec = {
        "id": "events", "description": "", "source_name": "", "target_name": "trusted.events",
        "target_table": "events", "pk": ["event_id"], "load_strategy": "merge",
        "load_type": "incremental", "watermark_column": "", "sql_file": "", "run_data_quality": False,
        "dq_config_path": "", "route": "transform",
        "query": "SELECT event_id, user_id, upper(event_type) AS kind, ts FROM source",
    }
    # As a glob the path may be a single file or a directory.
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parque[t]")
    incremental_stream(engine, spec, stream, f"{folder}/checkpoint").awaitTermination()
    return engine.warehouse.read("trusted.events")


_calls = iter(range(1 << 62))


def engine_folder(spark: SparkSession) -> str:
    """A new folder for an engine, so that every call starts from an empty warehouse.

    It lies in the folder all executors share; only where that is unset, as in tests, in a temporary one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors reach")
    folder = shared_folder(spark, tempfile.gettempdir())
    return f"{folder}/loamflow-{spark.sparkContext.applicationId}-{next(_calls)}"
