"""Governance as an effect on query results: masks, row filters, tags.

Everything here fails closed: a policy that cannot be applied raises, it never lets raw
values through.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamflow.functions.masks import MASKS
from loamflow.operators.joins import lookup_join

Mask = str | Callable[[Column], Column]


def _masked(column: str, mask: Mask, df: DataFrame) -> Column:
    value = F.col(column)
    if callable(mask):
        hidden = mask(value)
    elif mask in MASKS:
        hidden = MASKS[mask](value.cast("string"))
    else:
        # The name of a SQL function defined in the session or the catalog.
        hidden = F.call_function(mask, value)
    return hidden.cast(df.schema[column].dataType)


def mask_columns(df: DataFrame, masks: dict[str, Mask], privileged: bool | Column = False) -> DataFrame:
    """Hide columns from everybody who is not privileged.

    ``privileged`` is either known for the whole query or a condition on the row. A mask is a
    kind from ``MASKS``, the name of a SQL function, or a callable on columns.
    """
    missing = [c for c in masks if c not in df.columns]
    if missing:
        raise ValueError(f"cannot mask columns the table does not have: {missing}")
    if privileged is True:
        return df
    hidden = {c: _masked(c, mask, df) for c, mask in masks.items()}
    if isinstance(privileged, Column):
        hidden = {c: F.when(privileged, F.col(c)).otherwise(h) for c, h in hidden.items()}
    return df.withColumns(hidden)


_DEFINES = re.compile(
    r"\s*CREATE\s+(?:OR\s+REPLACE\s+)?(?:TEMPORARY\s+|TEMP\s+)?FUNCTION\s+(?:IF\s+NOT\s+EXISTS\s+)?"
    r"(?P<name>(?:`[^`]+`|\w+)(?:\s*\.\s*(?:`[^`]+`|\w+))*)\s*(?=\()",
    re.IGNORECASE,
)

_MEMBER = re.compile(r"\bis_(?:account_group_)?member\s*\(\s*'([^']*)'\s*\)", re.IGNORECASE)
_USER = re.compile(r"\b(?:current|session)_user\s*\(\s*\)", re.IGNORECASE)


def _name_parts(name: str) -> tuple[str, ...]:
    return tuple((quoted or plain).lower() for quoted, plain in re.findall(r"`([^`]+)`|([^`.\s]+)", name))


class SqlFunctions:
    """The SQL functions that a policy brings along, usable while the ``with`` block lasts.

    Each ``CREATE FUNCTION`` statement becomes a temporary function under a name of its own, so it needs neither the
    catalog nor the schema that its name mentions, changes nothing in them, and two policies never get in each
    other's way. Catalyst inlines the body when the frame is built. A name is looked up in full, as ``catalog.schema.name``,
    then from the right (``schema.name``, ``name``) as long as just one of the statements fits; one that no statement
    defines is a function of the session or the catalog. Inside a body, membership tests stand for the caller's ``groups``, and
    ``current_user()`` for the ``principal`` if one is given.
    """

    def __init__(self, spark: SparkSession, statements: Iterable[str], groups: Iterable[str] = (), principal: str | None = None):
        self.spark = spark
        member_of = set(groups)
        self.names: dict[tuple[str, ...], str] = {}
        self.statements = []
        for statement in statements:
            head = _DEFINES.match(statement)
            if head is None:
                raise ValueError(f"not a CREATE FUNCTION statement: {statement.strip()[:80]!r}")
            name = f"__policy_{uuid.uuid4().hex}"
            self.names[_name_parts(head["name"])] = name  # the last definition of a name counts
            body = statement[head.end():].rstrip().rstrip(";")
            body = _MEMBER.sub(lambda m: "true" if m[1] in member_of else "false", body)
            if principal is not None:
                literal = "'" + principal.replace("\\", "\\\\").replace("'", "\\'") + "'"
                body = _USER.sub(lambda m, literal=literal: literal, body)
            self.statements.append(f"CREATE TEMPORARY FUNCTION {name}{body}")
        self.defined: list[str] = []

    def __enter__(self) -> SqlFunctions:
        try:
            for statement in self.statements:
                self.spark.sql(statement)
                self.defined.append(statement.split()[3].split("(")[0])
        except BaseException:
            self.__exit__()
            raise
        return self

    def __exit__(self, *_: object) -> None:
        for name in self.defined:
            self.spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
        self.defined.clear()

    def resolve(self, name: str) -> str:
        """The temporary function for a name, or the name itself."""
        parts = _name_parts(name)
        if parts in self.names:
            return self.names[parts]
        fits = [own for known, own in self.names.items() if known[-len(parts):] == parts or parts[-len(known):] == known]
        if len(fits) > 1:
            raise ValueError(f"function name {name!r} fits several statements of the policy")
        return fits[0] if fits else name


def function_filter(df: DataFrame, function: str, columns: list[str]) -> DataFrame:
    """Rows for which a boolean SQL function of the columns is true; NULL hides the row."""
    seen = F.call_function(function, *[F.col(c) for c in columns])
    kind = df.select(seen.alias("seen")).schema[0].dataType.typeName()
    if kind != "boolean":
        raise ValueError(f"row filter {function!r} is {kind}, not boolean")
    return df.filter(F.coalesce(seen, F.lit(False)))


def row_filter(df: DataFrame, code_column: str, mapping: DataFrame | None, caller_groups: Iterable[str],
               admin_group: str = "admin") -> DataFrame:
    """Rows the caller may see: all for admins, else rows whose code one of their groups lists.

    ``mapping`` has ``user_group`` and ``allowed_branch_codes`` (array of strings). The codes
    are flattened and made distinct first, which turns a test of every row against every
    mapping row into an equi semi join.
    """
    groups = sorted(set(caller_groups))
    if admin_group in groups:
        return df
    if mapping is None or not groups:
        return df.filter(F.lit(False))
    allowed = (
        mapping.filter(F.col("user_group").isin(groups))
        .select(F.explode(F.col("allowed_branch_codes").cast("array<string>")).alias("__code"))
        .distinct()
    )
    keyed = df.withColumn("__code", F.col(code_column).cast("string"))
    return lookup_join(keyed, allowed, ["__code"], "left_semi").select(*df.columns)


def govern(df: DataFrame, policy: dict, privileged: bool, groups: Iterable[str] = (),
           mapping: DataFrame | None = None, principal: str | None = None) -> DataFrame:
    """A table as a policy document lets the caller see it: row filter first, then masks.

    Masks may be SQL functions that the policy defines (``masking_sql``). A row filter is the mapping of groups to codes, or, with
    ``function_sql``, the boolean SQL function ``rls_function_name`` of the filter column(s); members of the admin group see all rows.
    """
    security = policy.get("row_level_security") or {}
    masked = [p for p in policy.get("pii_columns") or [] if p.get("column") and p.get("masking_function")]
    statements = [p["masking_sql"] for p in masked if p.get("masking_sql")]
    statements += [security["function_sql"]] if security.get("enabled") and security.get("function_sql") else []
    with SqlFunctions(df.sparkSession, statements, groups, principal) as functions:
        if security.get("enabled"):
            admin = security.get("admin_group", "admin")
            if not security.get("function_sql"):
                df = row_filter(df, security["filter_column"], mapping, groups, admin)
            elif admin not in set(groups):
                columns = security.get("filter_columns") or [security["filter_column"]]
                df = function_filter(df, functions.resolve(security["rls_function_name"]), columns)
        return mask_columns(df, {p["column"]: functions.resolve(p["masking_function"]) for p in masked}, privileged)


POLICY_ENTRY_SCHEMA = "table_name STRING, column_name STRING, tags MAP<STRING,STRING>"


def pii_tags(pii: dict) -> dict[str, str]:
    """The tags a PII column carries, with the policy's defaults."""
    kind = pii.get("pii_type") or ""
    return {
        pii.get("abac_tag_key", "pii"): pii.get("abac_tag_value", kind.lower()),
        "pii_type": kind,
        "sensitivity": pii.get("sensitivity", "high"),
    }


def policy_entries(spark: SparkSession, table_name: str, policy: dict) -> DataFrame:
    """A policy document as rows of ``POLICY_ENTRY_SCHEMA``; ``column_name`` is NULL for table tags."""
    entries = [(table_name, None, policy.get("table_tags") or {})]
    entries += [(table_name, p["column"], pii_tags(p)) for p in policy.get("pii_columns") or [] if p.get("column")]
    entries += [
        (table_name, e["column"], e.get("tags") or {}) for e in policy.get("column_tags") or [] if e.get("column")
    ]
    rows = [(t, c, {k: str(v) for k, v in tags.items() if v is not None}) for t, c, tags in entries]
    return spark.createDataFrame(rows, POLICY_ENTRY_SCHEMA)


def tag_inventory(entries: DataFrame) -> DataFrame:
    """One row per (table, column, key) of all policies; blank column tags are dropped."""
    flat = entries.select("table_name", "column_name", F.explode("tags").alias("tag_key", "tag_value"))
    return flat.filter(F.col("column_name").isNull() | (F.col("tag_value") != ""))


TAGS = "tags"


def with_column_tags(df: DataFrame, tags: dict[str, dict[str, str]]) -> DataFrame:
    """Tags as column metadata; they survive writing to and reading from parquet."""
    unknown = [c for c in tags if c not in df.columns]
    if unknown:
        raise ValueError(f"cannot tag columns the table does not have: {unknown}")
    for column, pairs in tags.items():
        metadata = dict(df.schema[column].metadata)
        metadata[TAGS] = {**metadata.get(TAGS, {}), **pairs}
        df = df.withMetadata(column, metadata)
    return df


def column_tags(df: DataFrame) -> dict[str, dict[str, str]]:
    return {f.name: dict(f.metadata[TAGS]) for f in df.schema if f.metadata.get(TAGS)}


def mask_by_tag(df: DataFrame, privileged: bool | Column = False, key: str = "pii") -> DataFrame:
    """Mask every column tagged ``key=<mask kind>``, whatever table it is in."""
    kinds = {c: tags[key] for c, tags in column_tags(df).items() if tags.get(key)}
    unknown = sorted({k for k in kinds.values() if k not in MASKS})
    if unknown:
        raise ValueError(f"no mask for tag values {unknown}")
    return mask_columns(df, kinds, privileged)
