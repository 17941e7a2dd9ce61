"""Load specs: one row per target table, read from CSV or from the config table."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamflow.schemas import KEYED_STRATEGIES, LOAD_STRATEGIES, SPEC_COLUMNS, SPEC_FLAGS

LOAD_TYPES = ("incremental", "full_refresh")


def read_spec_csv(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV with a header; every column is text and blank cells stay blank."""
    raw = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True, nullValue=None, emptyValue="")
    return raw.toDF(*[c.strip() for c in raw.columns])


def conform_spec_columns(raw: DataFrame) -> DataFrame:
    """Trimmed text in the 21 spec columns, then in any others; spec columns the input lacks are blank."""
    more = [c for c in raw.columns if c not in SPEC_COLUMNS]
    return raw.select(*[
        (F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) if c in raw.columns else F.lit("")).alias(c)
        for c in [*SPEC_COLUMNS, *more]
    ])


def split_pipe(value: Column) -> Column:
    """``a| b |`` -> ``[a, b]``."""
    return F.filter(F.transform(F.split(value, r"\|"), lambda part: F.trim(part)), lambda part: part != "")


def _is_true(column: str) -> Column:
    return F.lower(F.col(column)) == "true"


def _three_part(prefix: str) -> Column:
    parts = [F.col(f"{prefix}_{level}") for level in ("catalog", "schema", "table")]
    complete = (parts[0] != "") & (parts[1] != "") & (parts[2] != "")
    return F.when(complete, F.concat_ws(".", *parts)).otherwise("")


def spec_normalize(raw: DataFrame) -> DataFrame:
    """Typed specs: flags as booleans, keys as an array, load type and strategy in lower case.

    An unknown or blank load type means ``incremental``, which has no effect without a
    watermark column. A source counts only if all three parts of its name are given.
    """
    trimmed = conform_spec_columns(raw)
    load_type = F.lower("load_type")
    return trimmed.withColumns({
        **{flag: _is_true(flag) for flag in SPEC_FLAGS},
        "pk": split_pipe(F.col("pk")),
        "load_type": F.when(load_type.isin(*LOAD_TYPES), load_type).otherwise(LOAD_TYPES[0]),
        "load_strategy": F.coalesce(F.nullif(F.lower("load_strategy"), F.lit("")), F.lit("merge")),
        "processed": _is_true("processed"),
        "source_name": _three_part("source"),
        "target_name": F.concat_ws(".", "target_catalog", "target_schema", "target_table"),
    })


def filter_ids(specs: DataFrame, ids: list[str] | None) -> DataFrame:
    return specs.filter(F.col("id").isin(list(ids))) if ids else specs


def route_specs(specs: DataFrame) -> DataFrame:
    """Where each spec goes in this run: ``skip`` when processed, else ``quality`` or ``transform``."""
    has_rules = F.col("run_data_quality") & (F.col("dq_config_path") != "")
    return specs.withColumn(
        "route", F.when(F.col("processed"), "skip").when(has_rules, "quality").otherwise("transform")
    )


def runnable_specs(specs: DataFrame, ids: list[str] | None = None) -> DataFrame:
    return route_specs(filter_ids(specs, ids)).filter("route <> 'skip'")


def load_specs(spark: SparkSession, csv_path: str, config: DataFrame | None = None,
               ids: list[str] | None = None) -> DataFrame:
    """From the config table when there is one, else from the CSV file."""
    if config is None and ":" not in csv_path and not os.path.exists(csv_path):
        raise FileNotFoundError(f"spec file not found: {csv_path}")
    raw = read_spec_csv(spark, csv_path) if config is None else config
    return filter_ids(spec_normalize(raw), ids)


def spec_problems(spec: dict) -> list[str]:
    """What makes a normalised spec unusable, found before any job starts."""
    problems = []
    strategy = spec["load_strategy"]
    if not spec["id"]:
        problems.append("id is blank")
    if not spec["target_table"]:
        problems.append("target_table is blank")
    if strategy not in LOAD_STRATEGIES:
        problems.append(f"unknown load_strategy {strategy!r}")
    if strategy in KEYED_STRATEGIES and not spec["pk"]:
        problems.append(f"load_strategy {strategy!r} requires pk")
    if spec["run_data_quality"] and not spec["dq_config_path"]:
        problems.append("run_data_quality needs dq_config_path")
    incremental = spec["load_type"] == "incremental" and spec["watermark_column"] and spec["source_name"]
    if incremental and strategy in ("overwrite", "full_refresh"):
        problems.append("an incremental load would overwrite the table with its newest part only")
    return problems
