"""SQL transforms and column-level reshaping."""

from __future__ import annotations

import logging
import os
import re
import uuid
from collections import Counter
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from loamflow.functions.names import to_snake_case

logger = logging.getLogger(__name__)

DEFAULT_SQL = "SELECT * FROM source"


def resolve_sql(spec: dict, base_path: str = "") -> str:
    """``sql_file`` before ``query`` before ``SELECT * FROM source``."""
    sql_file = (spec.get("sql_file") or "").strip()
    if sql_file:
        path = os.path.join(base_path, sql_file)
        if not os.path.exists(path):
            raise FileNotFoundError(f"[{spec.get('id')}] sql_file not found: {path}")
        with open(path, encoding="utf-8") as handle:
            return handle.read().strip()
    return (spec.get("query") or "").strip() or DEFAULT_SQL


def mentions(sql: str, name: str) -> bool:
    """Whether the text names a table, in any case and with or without backticks; quoted text and comments do not count."""
    return any(m["name"] for m in _mention(name).finditer(sql))


# Parts of a query in which no table is named: string literals (raw ones have no escapes) and comments.
_QUOTED = (
    r"(?<!\w)[rR]'[^']*'|(?<!\w)[rR]\"[^\"]*\"|'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|--[^\n]*|/\*.*?\*/"
)


def _mention(name: str) -> re.Pattern:
    parts = r"`?\s*\.\s*`?".join(re.escape(part) for part in name.split("."))
    return re.compile(rf"{_QUOTED}|(?P<name>(?<![\w.`])`?{parts}`?(?![\w`]))", re.IGNORECASE | re.DOTALL)


# Names given with AS stay, as do columns of a table: only calls, with or without brackets, are the current time.
_NOW = re.compile(
    rf"{_QUOTED}|\bAS\s+\w+|(?<![\w.`])(?P<name>current_timestamp|current_date|localtimestamp|now(?=\s*\()|curdate(?=\s*\())"
    r"(?:\s*\(\s*\))?(?![\w`(])",
    re.IGNORECASE | re.DOTALL,
)


def pin_time(sql: str, as_of: datetime) -> str:
    """The query with the current time and date replaced by ``as_of`` (UTC), so that every evaluation of a run gives the same."""
    literals = {
        "localtimestamp": f"TIMESTAMP_NTZ '{as_of:%Y-%m-%d %H:%M:%S.%f}'",
        "current_date": f"DATE '{as_of:%Y-%m-%d}'", "curdate": f"DATE '{as_of:%Y-%m-%d}'",
    }
    moment = f"TIMESTAMP '{as_of:%Y-%m-%d %H:%M:%S.%f}Z'"
    return _NOW.sub(lambda m: literals.get(m["name"].lower(), moment) if m["name"] else m[0], sql)


def sql_transform(spark: SparkSession, sql: str, inputs: dict[str, DataFrame] | None = None,
                  as_of: datetime | None = None) -> DataFrame:
    """Run any Spark SQL over named inputs; ``as_of``, if given, is the current time inside ``sql``.

    Every input is visible under its name inside ``sql`` only: it is bound as a common table
    expression over a view with a unique name, so runs in parallel never see each other's
    ``source`` and nothing is left behind in the session. A qualified name cannot be bound that
    way; where the text mentions one outside of quoted text and comments, the view's name takes its place.
    """
    body = sql.strip().rstrip(";").rstrip()
    body = body if as_of is None else pin_time(body, as_of)
    inputs = inputs or {}
    if not inputs:
        return spark.sql(body)
    # A view lives in its frame's session, which inside a stream is not the caller's.
    session = next(iter(inputs.values())).sparkSession
    views = {name: f"__in_{uuid.uuid4().hex}" for name in inputs}
    for name, view in views.items():
        inputs[name].createOrReplaceTempView(view)
        if "." in name:
            body = _mention(name).sub(lambda m, view=view: view if m["name"] else m[0], body)
    bindings = [f"`{name}` AS (SELECT * FROM {view})" for name, view in views.items() if "." not in name]
    heading = f"WITH {', '.join(bindings)} " if bindings else ""
    try:
        return session.sql(f"{heading}SELECT * FROM (\n{body}\n)")
    finally:
        for view in views.values():
            session.catalog.dropTempView(view)


def apply_snake_case(df: DataFrame) -> DataFrame:
    """All columns in snake case; two columns that would get the same name are an error."""
    names = [to_snake_case(c) for c in df.columns]
    clashes = sorted(n for n, count in Counter(names).items() if count > 1)
    if clashes:
        raise ValueError(f"columns collide in snake case: {clashes}")
    return df if names == df.columns else df.toDF(*names)


def apply_rename_columns(df: DataFrame, rename_map: dict[str, str]) -> DataFrame:
    """Rename columns; names the frame does not have are skipped with a warning."""
    for old in rename_map:
        if old not in df.columns:
            logger.warning("rename: column %r not found, skipped", old)
    return df.withColumnsRenamed({old: new for old, new in rename_map.items() if old in df.columns})


def apply_drop_columns(df: DataFrame, drops: list[str]) -> DataFrame:
    """Drop columns; names the frame does not have are ignored."""
    return df.drop(*[c for c in drops if c in df.columns])
