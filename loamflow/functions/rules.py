"""Quality rules: their definitions, and the condition under which a row violates them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Rule:
    """One check. ``metadata`` is free text pairs such as ``check_category`` and ``check_owner``."""

    name: str
    function: str
    arguments: dict[str, Any]
    criticality: str = ERROR
    metadata: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def parse(raw: dict[str, Any]) -> Rule:
        """From the nested form of rule files: ``{name, criticality, check: {function, arguments}}``."""
        check = raw.get("check") or {}
        function = check.get("function") or ""
        arguments = dict(check.get("arguments") or {})
        column = arguments.get("column") or "_".join(arguments.get("columns") or [])
        return Rule(
            name=raw.get("name") or f"{column}_{function}",
            function=function,
            arguments=arguments,
            criticality=raw.get("criticality") or ERROR,
            metadata={k: str(v) for k, v in (raw.get("user_metadata") or {}).items()},
        )

    @property
    def columns(self) -> list[str]:
        single = self.arguments.get("column")
        return [single] if single else list(self.arguments.get("columns") or [])


@dataclass(frozen=True)
class RuleFunction:
    required: tuple[str, ...]
    # Violation from the rule's column and arguments; None for rules that look at other rows.
    violated: Callable[[Column | None, dict[str, Any]], Column] | None


def _blank(c: Column) -> Column:
    return F.trim(c.cast(StringType())) == ""


ROW_RULES: dict[str, RuleFunction] = {
    "is_not_null": RuleFunction(("column",), lambda c, a: c.isNull()),
    "is_not_empty": RuleFunction(("column",), lambda c, a: _blank(c)),
    "is_not_null_and_not_empty": RuleFunction(("column",), lambda c, a: c.isNull() | _blank(c)),
    "is_not_less_than": RuleFunction(("column", "value"), lambda c, a: c < F.lit(a["value"])),
    "is_not_greater_than": RuleFunction(("column", "value"), lambda c, a: c > F.lit(a["value"])),
    "is_in_list": RuleFunction(("column", "allowed"), lambda c, a: ~c.isin(list(a["allowed"]))),
    "is_in_range": RuleFunction(("column", "min", "max"), lambda c, a: ~c.between(a["min"], a["max"])),
    "regex_match": RuleFunction(("column", "regex"), lambda c, a: ~c.rlike(a["regex"])),
    "sql_expression": RuleFunction(("expression",), lambda c, a: ~F.expr(a["expression"])),
}

# Rules over keys: NULL keys are never duplicates and never dangling.
KEY_RULES: dict[str, RuleFunction] = {
    "is_unique": RuleFunction(("columns",), None),
    "foreign_key": RuleFunction(("columns", "ref_table", "ref_columns"), None),
}

RULE_FUNCTIONS = {**ROW_RULES, **KEY_RULES}


def compile_row_rule(rule: Rule) -> Column:
    """True where the row violates the rule; an unknown (NULL) outcome passes."""
    columns = rule.columns
    subject = F.col(columns[0]) if columns else None
    return F.coalesce(ROW_RULES[rule.function].violated(subject, rule.arguments), F.lit(False))


def check_rules(rules: list[Rule], df: DataFrame, references: dict[str, DataFrame]) -> None:
    """Reject invalid definitions by analysis alone, before any row is read."""
    problems = []
    names = [r.name for r in rules]
    problems += [f"{n}: name used twice" for n in sorted({n for n in names if names.count(n) > 1})]
    for rule in rules:
        known = RULE_FUNCTIONS.get(rule.function)
        if known is None:
            problems.append(f"{rule.name}: unknown function {rule.function!r}")
            continue
        if rule.criticality not in (ERROR, WARN):
            problems.append(f"{rule.name}: criticality must be {ERROR!r} or {WARN!r}, not {rule.criticality!r}")
        absent = [a for a in known.required if rule.arguments.get(a) is None]
        if absent:
            problems.append(f"{rule.name}: missing arguments {absent}")
            continue
        unknown = [c for c in rule.columns if c not in df.columns]
        if unknown:
            problems.append(f"{rule.name}: no such columns {unknown}")
            continue
        if rule.function == "foreign_key":
            reference = references.get(rule.arguments["ref_table"])
            if reference is None:
                problems.append(f"{rule.name}: no reference table {rule.arguments['ref_table']!r}")
            elif len(rule.columns) != len(rule.arguments["ref_columns"]) or any(
                c not in reference.columns for c in rule.arguments["ref_columns"]
            ):
                problems.append(f"{rule.name}: ref_columns do not fit {rule.arguments['ref_table']!r}")
        elif rule.function in ROW_RULES:
            try:
                df.select(compile_row_rule(rule))
                if rule.function == "sql_expression":
                    outcome = df.select(F.expr(rule.arguments["expression"])).schema[0].dataType.typeName()
                    if outcome != "boolean":
                        problems.append(f"{rule.name}: expression is {outcome}, not boolean")
            except Exception as exc:  # analysis errors carry no common public base class
                problems.append(f"{rule.name}: {str(exc).splitlines()[0]}")
    if problems:
        raise ValueError("invalid quality rules: " + "; ".join(problems))
