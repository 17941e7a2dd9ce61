"""Named tables: bound frames or paths, published snapshots, and the session catalog."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamflow.operators.transforms import mentions
from loamflow.sources.snapshots import Warehouse

logger = logging.getLogger(__name__)


class Tables:
    """Resolves ``catalog.schema.table``: bindings first, then snapshots, then ``spark.table``."""

    def __init__(self, spark: SparkSession, warehouse: Warehouse | None = None,
                 bindings: dict[str, DataFrame | str] | None = None):
        self.spark = spark
        self.warehouse = warehouse
        self.bindings = dict(bindings or {})

    def bind(self, name: str, source: DataFrame | str) -> None:
        self.bindings[name] = source

    def read(self, name: str) -> DataFrame:
        bound = self.bindings.get(name)
        if isinstance(bound, str):
            return self.spark.read.parquet(bound)
        if bound is not None:
            return bound
        published = self.warehouse.find(name) if self.warehouse is not None else None
        return self.spark.table(name) if published is None else published

    def inputs(self, sql: str, known: Iterable[str] = ()) -> dict[str, DataFrame]:
        """Tables that SQL without a single source mentions, as far as they are ours.

        Bound tables go by their full name or, if only one ends in it, by its last part; ``known``
        names (targets of other specs) by their full name. The rest is left to the catalog.
        """
        short = Counter(name.split(".")[-1] for name in self.bindings)
        found: dict[str, DataFrame] = {}
        for name in self.bindings:
            last = name.split(".")[-1]
            if mentions(sql, name):
                found[name] = self.read(name)
            elif short[last] == 1 and mentions(sql, last):
                found[last] = self.read(name)
        for name in known:
            if name not in found and self.warehouse is not None and mentions(sql, name):
                published = self.warehouse.find(name)
                if published is not None:
                    found[name] = published
        return found


def source_profile(spark: SparkSession, sources: dict[str, DataFrame | None]) -> DataFrame:
    """``id, source_ok, source_count`` for all sources in one job.

    -1 and ok when a spec has no source (``None``).
    """
    counted = [
        df.agg(F.count(F.lit(1)).alias("source_count")).select(
            F.lit(id_).alias("id"), F.lit(True).alias("source_ok"), "source_count"
        )
        for id_, df in sources.items()
        if df is not None
    ]
    without = [(id_, True, -1) for id_, df in sources.items() if df is None]
    if without or not counted:
        counted.append(spark.createDataFrame(without, "id STRING, source_ok BOOLEAN, source_count LONG"))
    profile = counted[0]
    for part in counted[1:]:
        profile = profile.unionByName(part)
    return profile


def profile_rows(spark: SparkSession, sources: dict[str, DataFrame | None]) -> list[dict]:
    """``source_profile`` as dicts. Where the common job fails, each source is counted alone: -1 and not ok for those that fail."""
    try:
        return [row.asDict() for row in source_profile(spark, sources).collect()]
    except Exception:
        rows = []
        for id_, df in sources.items():
            try:
                rows.append({"id": id_, "source_ok": True, "source_count": -1 if df is None else df.count()})
            except Exception as exc:
                logger.warning("[%s] source not readable: %s", id_, exc)
                message = (str(exc).splitlines() or [""])[0]
                rows.append({"id": id_, "source_ok": False, "source_count": -1, "message": message})
        return rows


PROFILE_SCHEMA = "id STRING, source_ok BOOLEAN, source_count LONG, message STRING"


def checked_profile(tables: Tables, names: Iterable[tuple[str, str]]) -> DataFrame:
    """``PROFILE_SCHEMA`` for each (spec id, source name): a source that cannot be resolved or read is a row, not an exception.

    Rows are counted from file footers where the source is a plain file table: no column is read.
    """
    spark, names = tables.spark, list(names)
    sources, issues = reachable(tables, names)
    told = {r["id"]: (r["id"], r["source_ok"], r["source_count"], r.get("message", "")) for r in profile_rows(spark, sources)}
    told.update({id_: (id_, False, -1, issue) for id_, issue in issues.items()})
    return spark.createDataFrame([told[id_] for id_ in dict(names)], PROFILE_SCHEMA)


def reachable(tables: Tables, names: Iterable[tuple[str, str]]) -> tuple[dict[str, DataFrame | None], dict[str, str]]:
    """Sources by spec id, and by spec id what is wrong with one that cannot be resolved."""
    found: dict[str, DataFrame | None] = {}
    issues: dict[str, str] = {}
    for id_, name in names:
        if not name:
            found[id_] = None
            continue
        try:
            found[id_] = tables.read(name)
        except Exception as exc:  # whatever the catalog or file system raises
            issues[id_] = f"cannot access {name!r}: {str(exc).splitlines()[0]}"
    return found, issues
