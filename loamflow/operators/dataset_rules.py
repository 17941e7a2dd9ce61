"""Rules over a whole data set: how many rows, how complete, how fresh, how distinct.

A rule is an aggregate and a range. The aggregates of all rules are computed in the pass that applies the row rules and
writes the rows (``metrics`` fits into ``agg`` and ``observe``), and they merge: the measures of several loads, or of the parts of one,
combine to those of all rows (``merged``) without reading a row again. Distinct counts are HyperLogLog sketches; of
``LG_K`` = 12 their standard error is 1.04 / sqrt(2^12), 1.6 %. A verdict that three standard errors could turn is not ``certain``.

Defined results: shares and means of no rows (or of none with a value) are NULL and pass; nothing is fresh if no row carries a
time; a NULL is no distinct value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamflow.functions.rules import ERROR, WARN, Rule

LG_K = 12
#: Three standard errors of a sketch's estimate.
SKETCH_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)

VERDICT_SCHEMA = (
    "name string, function string, columns array<string>, criticality string, value double, least double, most double, "
    "passed boolean, certain boolean"
)


@dataclass(frozen=True)
class Measure:
    """An aggregate over rows, how partial results of it combine, and what its name says."""

    name: str
    over_rows: Column
    merged: Callable[[Column], Column]


def _count(c: str) -> Measure:
    return Measure(f"n_{c}", F.count(F.col(c)), F.sum)


def _sketch(columns: list[str]) -> Measure:
    value = F.col(columns[0]) if len(columns) == 1 else F.when(
        reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]), F.struct(*map(F.col, columns))
    )
    # Sketches take whole numbers and texts; one hash serves all types.
    hashed = F.when(value.isNotNull(), F.xxhash64(value))
    return Measure("d_" + "_".join(columns), F.hll_sketch_agg(hashed, LG_K), F.hll_union_agg)


@dataclass(frozen=True)
class DatasetFunction:
    required: tuple[str, ...]
    measures: Callable[[list[str]], list[Measure]]
    value: Callable[[list[str], Column], Column]
    estimated: bool = False
    # What a value of NULL means: nothing to judge, or nothing there.
    null_passes: bool = True


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).cast("double")


def _rows() -> Measure:
    return Measure("rows", F.count(F.lit(1)), F.sum)


def _last(c: str) -> Measure:
    return Measure(f"last_{c}", F.max(F.col(c)), F.max)


def _total(c: str) -> Measure:
    return Measure(f"sum_{c}", F.sum(F.col(c).cast("double")), F.sum)


def _estimate(columns: list[str]) -> Column:
    return F.coalesce(F.hll_sketch_estimate(F.col(_sketch(columns).name)), F.lit(0)).cast("double")


DATASET_FUNCTIONS: dict[str, DatasetFunction] = {
    "row_count": DatasetFunction((), lambda cs: [_rows()], lambda cs, now: F.col("rows").cast("double")),
    "completeness": DatasetFunction(
        ("column",), lambda cs: [_rows(), _count(cs[0])], lambda cs, now: _share(F.col(f"n_{cs[0]}"), F.col("rows"))),
    # Age of the newest row in seconds.
    "freshness": DatasetFunction(
        ("column",), lambda cs: [_last(cs[0])],
        lambda cs, now: (F.unix_micros(now) - F.unix_micros(F.col(f"last_{cs[0]}").cast("timestamp"))) / 1e6, null_passes=False),
    "mean": DatasetFunction(
        ("column",), lambda cs: [_count(cs[0]), _total(cs[0])], lambda cs, now: _share(F.col(f"sum_{cs[0]}"), F.col(f"n_{cs[0]}"))),
    "distinct_count": DatasetFunction(("columns",), lambda cs: [_sketch(cs)], lambda cs, now: _estimate(cs), estimated=True),
    # Distinct values per row that has one; 1 if none repeats.
    "distinct_share": DatasetFunction(
        ("column",), lambda cs: [_count(cs[0]), _sketch(cs)],
        lambda cs, now: _share(F.least(_estimate(cs), F.col(f"n_{cs[0]}").cast("double")), F.col(f"n_{cs[0]}")), estimated=True),
}


class DatasetRules:
    """Compiled dataset rules. ``checks`` have the form of row rules, with ``min`` and ``max`` among their arguments."""

    def __init__(self, df: DataFrame, checks: Iterable[Any]):
        self.rules = [c if isinstance(c, Rule) else Rule.parse(c) for c in checks]
        problems = []
        measures: dict[str, Measure] = {}
        for rule in self.rules:
            function = DATASET_FUNCTIONS.get(rule.function)
            if function is None:
                problems.append(f"{rule.name}: unknown function {rule.function!r}")
                continue
            absent = [a for a in function.required if not rule.arguments.get(a) and not (a == "columns" and rule.columns)]
            if absent or all(rule.arguments.get(a) is None for a in ("min", "max")):
                problems.append(f"{rule.name}: missing arguments {absent or ['min or max']}")
            if rule.criticality not in (ERROR, WARN):
                problems.append(f"{rule.name}: criticality must be {ERROR!r} or {WARN!r}, not {rule.criticality!r}")
            unknown = [c for c in rule.columns if c not in df.columns]
            if unknown:
                problems.append(f"{rule.name}: no such columns {unknown}")
            elif not absent:
                measures.update((m.name, m) for m in function.measures(rule.columns))
        if not problems:
            try:
                df.agg(*[m.over_rows for m in measures.values()], F.lit(1))
            except Exception as exc:  # analysis errors carry no common public base class
                problems.append(str(exc).splitlines()[0])
        if problems:
            raise ValueError("invalid dataset rules: " + "; ".join(problems))
        self.measures = list(measures.values())
        self.schema = df.agg(*self.metrics(), F.lit(1).alias("_one")).drop("_one").schema

    def metrics(self, prefix: str = "") -> list[Column]:
        """Aggregates of one pass, usable in ``agg`` and in ``observe``."""
        return [m.over_rows.alias(prefix + m.name) for m in self.measures]

    def merged(self, measures: DataFrame, *by: str, also: Iterable[Column] = ()) -> DataFrame:
        """The measures of all rows (or per ``by``) from measures of disjoint parts of them, one row for each part.

        ``also``: further aggregates of the parts.
        """
        return measures.groupBy(*by).agg(*[m.merged(F.col(m.name)).alias(m.name) for m in self.measures], *also)

    def verdicts(self, measures: DataFrame, as_of: datetime | Column, *by: str) -> DataFrame:
        """A row of ``VERDICT_SCHEMA`` for each rule and row of ``measures``; ``as_of`` is the time that freshness counts from."""
        now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
        told = []
        for rule in self.rules:
            function = DATASET_FUNCTIONS[rule.function]
            value = function.value(rule.columns, now)
            least, most = (F.lit(rule.arguments.get(a)).cast("double") for a in ("min", "max"))
            within = F.coalesce(value >= least, F.lit(True)) & F.coalesce(value <= most, F.lit(True))
            slack = value * SKETCH_ERROR if function.estimated else F.lit(0.0)
            near = F.coalesce(F.abs(value - least) <= slack, F.lit(False)) | F.coalesce(F.abs(value - most) <= slack, F.lit(False))
            told.append(F.struct(
                F.lit(rule.name).alias("name"), F.lit(rule.function).alias("function"),
                F.array(*map(F.lit, rule.columns)).cast("array<string>").alias("columns"),
                F.lit(rule.criticality).alias("criticality"), value.alias("value"), least.alias("least"), most.alias("most"),
                F.when(value.isNull(), F.lit(function.null_passes)).otherwise(within).alias("passed"),
                (~near if function.estimated else F.lit(True)).alias("certain"),
            ))
        if not told:
            return measures.select(*by, F.explode(F.array().cast(f"array<struct<{_FIELDS}>>")).alias("v")).select(*by, "v.*")
        return measures.select(*by, F.explode(F.array(*told)).alias("v")).select(*by, "v.*")


_FIELDS = ", ".join(f"{n}: {t}" for n, t in (f.strip().split(" ", 1) for f in VERDICT_SCHEMA.split(", ")))
