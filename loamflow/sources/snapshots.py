"""Publishing results: staged parquet directories and a small manifest that lists the live ones.

Nothing is ever overwritten in place. Data goes to a new directory named after the run, and a
one-row manifest, committed last, makes it visible together with the row count and the marks.
What is published is a load: one spec in one run. Several specs may share a table, each with its own
folders and its own mark. Within a process, commits to a table queue up; a result that was computed
from a version which is no longer the live one is refused. Across processes there is one writer per
table at a time. Manifests go round a few slots, so that finding the
latest one stays one short listing however many versions a table has had.

The manifest carries the table's load ledger. It outlives overwrites and merges: a load that is repeated after another spec
has replaced or merged the table publishes nothing. A load is remembered until ``ledger_loads`` others have followed it.
"""

from __future__ import annotations

import json
import threading
from collections import defaultdict
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loamflow.operators.writes import compact, files_for, merged_schema

MANIFEST_SCHEMA = (
    "version LONG, run_id STRING, dirs ARRAY<STRING>, schema_json STRING, rows LONG, marks MAP<STRING, STRING>, "
    "runs ARRAY<STRING>, layout STRING"
)


MANIFEST_SLOTS = 8
LEDGER_LOADS = 1000
PART = "__part"
NULL_PART = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the name Spark gives a NULL partition


@dataclass(frozen=True)
class Snapshot:
    version: int
    run_id: str
    dirs: tuple[str, ...]
    schema: StructType
    rows: int
    # By spec id: marks that were published with the data and are not in the control table yet, or cannot be; ``<id>#tie``: the second
    # part of a two-part mark with the value it belongs to.
    marks: dict[str, str]
    # The load ledger: what has been published to the table, the oldest first, whatever became of its rows since.
    runs: tuple[str, ...]
    # SQL expression that assigns each row to a part; every directory then holds one part.
    layout: str | None = None

    def split(self, parts: set[str]) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """Directories of the given parts, and all others."""
        inside = tuple(d for d in self.dirs if d.rsplit(f"/{PART}=", 1)[-1] in parts)
        return inside, tuple(d for d in self.dirs if d not in set(inside))


class StaleResult(RuntimeError):
    """Another load was published to the table while this one was computed from the version before."""


class Warehouse:
    """Published tables below one root folder that all executors can reach."""

    def __init__(self, spark: SparkSession, root: str, ledger_loads: int = LEDGER_LOADS):
        self.spark = spark
        self.ledger_loads = ledger_loads
        self.root = root.rstrip("/")
        self._locks: dict[str, threading.RLock] = defaultdict(threading.RLock)

    def table_path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def data_path(self, name: str, run_id: str, part: str = "data") -> str:
        return f"{self.table_path(name)}/{part}/run={run_id}"

    def current(self, name: str) -> Snapshot | None:
        try:
            # A slot that is being rewritten holds an outdated version: ignore it if it vanishes.
            manifests = self.spark.read.schema(MANIFEST_SCHEMA).option("ignoreMissingFiles", "true")
            row = manifests.json(f"{self.table_path(name)}/manifest").orderBy(F.desc("version")).first()
        except AnalysisException as exc:
            if exc.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        if row is None:
            return None
        schema = StructType.fromJson(json.loads(row["schema_json"]))
        return Snapshot(row["version"], row["run_id"], tuple(row["dirs"]), schema, row["rows"],
                        dict(row["marks"] or {}), tuple(row["runs"]), row["layout"])

    def exists(self, name: str) -> bool:
        return self.current(name) is not None

    def find(self, name: str) -> DataFrame | None:
        snapshot = self.current(name)
        return None if snapshot is None else self.read_snapshot(snapshot)

    def read(self, name: str) -> DataFrame:
        found = self.find(name)
        if found is None:
            raise LookupError(f"table {name!r} has not been published")
        return found

    def read_snapshot(self, snapshot: Snapshot) -> DataFrame:
        if not snapshot.dirs:
            return self.spark.createDataFrame([], snapshot.schema)
        return self.spark.read.schema(snapshot.schema).parquet(*snapshot.dirs)

    def stage(self, df: DataFrame, path: str, partition_by: str | None = None) -> str:
        """Write without making it visible. A retry replaces what an earlier attempt left."""
        writer = df.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        return path

    def _commit(self, name: str, snapshot: Snapshot) -> Snapshot:
        snapshot = replace(snapshot, runs=snapshot.runs[-self.ledger_loads:])
        manifest = {
            "version": snapshot.version, "run_id": snapshot.run_id, "dirs": snapshot.dirs,
            "schema_json": snapshot.schema.json(), "rows": snapshot.rows, "marks": snapshot.marks,
            "runs": snapshot.runs, "layout": snapshot.layout,
        }
        path = f"{self.table_path(name)}/manifest/slot={snapshot.version % MANIFEST_SLOTS}"
        self.spark.sql("SELECT :manifest AS value", args={"manifest": json.dumps(manifest)}).write.mode(
            "overwrite"
        ).text(path)
        return snapshot

    def part_names(self, df: DataFrame, layout: str) -> set[str]:
        """The parts a frame's rows belong to; as many as the layout has parts at most."""
        parts = df.select(_part(layout)).distinct().collect()
        return {NULL_PART if row[0] is None else str(row[0]) for row in parts}

    def stage_parts(self, df: DataFrame, path: str, layout: str) -> tuple[str, ...]:
        """Write one directory per part. The rebalance splits a part that is too large for a task."""
        self.stage(df.withColumn(PART, _part(layout)).hint("rebalance", PART), path, partition_by=PART)
        written = self.spark.read.schema(StructType([*df.schema, StructField(PART, LongType())])).parquet(path)
        return tuple(f"{path}/{PART}={p}" for p in sorted(self.part_names(written, PART)))

    def publish(self, name: str, run_id: str, dirs: tuple[str, ...], schema: StructType, rows: int,
                mode: str = "overwrite", marks: dict[str, str] | None = None, layout: str | None = None,
                based_on: Snapshot | None | bool = False) -> Snapshot:
        """Make staged directories the table (``overwrite``) or part of it (``append``).

        ``run_id`` names the load. Publishing the same load twice changes nothing. ``based_on``, if given, is the
        snapshot (None: no table yet) that the result was computed from; another live one is an error.
        """
        with self._locks[name]:
            live = self.current(name)
            if live is not None and run_id in live.runs:
                return live
            if based_on is not False and (live and live.version) != (based_on and based_on.version):
                raise StaleResult(f"{name}: another load was published in the meantime")
            if live is None:
                return self._commit(name, Snapshot(1, run_id, dirs, schema, rows, marks or {}, (run_id,), layout))
            version, marks, ledger = live.version + 1, {**live.marks, **(marks or {})}, live.runs + (run_id,)
            if mode == "append":
                return self._commit(name, Snapshot(
                    version, run_id, live.dirs + dirs, merged_schema(live.schema, schema), live.rows + rows, marks, ledger,
                ))
            return self._commit(name, Snapshot(version, run_id, dirs, schema, rows, marks, ledger, layout))

    def set_marks(self, name: str, run_id: str, marks: dict[str, str]) -> Snapshot:
        """New marks for unchanged data: the load read rows, but none of them was good enough."""
        with self._locks[name]:
            live = self.current(name)
            return self._commit(name, replace(
                live, version=live.version + 1, run_id=run_id, marks={**live.marks, **marks}, runs=live.runs + (run_id,),
            ))

    def settle_marks(self, name: str, spec_ids: set[str]) -> None:
        """The control table has the marks of these specs now, and is where they are looked up from here on."""
        with self._locks[name]:
            live = self.current(name)
            if live is not None and spec_ids & set(live.marks):
                marks = {k: v for k, v in live.marks.items() if k not in spec_ids}
                self._commit(name, replace(live, version=live.version + 1, marks=marks))

    def save(self, name: str, df: DataFrame, run_id: str, mode: str = "overwrite") -> Snapshot:
        """Stage and publish a frame in one go; for the small system tables."""
        seen = Observation()
        path = self.stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), self.data_path(name, run_id))
        return self.publish(name, run_id, (path,), df.schema, seen.get["rows"], mode)

    def size_in_bytes(self, dirs: tuple[str, ...]) -> int:
        """File sizes as the listing reports them; file contents are not read."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        total = files.option("recursiveFileLookup", "true").load(list(dirs)).agg(F.sum("length")).first()[0]
        return total or 0

    def compact(self, name: str, run_id: str, file_bytes: int | None = None, cluster_by: tuple[str, ...] = ()) -> Snapshot:
        """The live snapshot rewritten into files of about ``file_bytes``, by default what one task packs or sorts with ease."""
        with self._locks[name]:
            return self._compact(name, run_id, file_bytes, cluster_by)

    def _compact(self, name: str, run_id: str, file_bytes: int | None, cluster_by: tuple[str, ...]) -> Snapshot:
        live = self.current(name)
        if live is None:
            raise LookupError(f"table {name!r} has not been published")
        tag = f"{run_id}-compact"
        if tag in live.runs or not live.dirs:
            return live
        path, rows = self.data_path(name, tag), self.read_snapshot(live)
        if live.layout:
            dirs = self.stage_parts(rows, path, live.layout)
        else:
            partitions = files_for(self.size_in_bytes(live.dirs), cluster_by, file_bytes)
            dirs = (self.stage(compact(rows, partitions, cluster_by), path),)
        return self._commit(name, replace(
            live, version=live.version + 1, run_id=tag, dirs=dirs, runs=live.runs + (tag,)
        ))


def _part(layout: str) -> Column:
    return F.expr(layout).cast("long")
