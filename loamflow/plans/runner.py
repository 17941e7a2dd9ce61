"""The spec runner: one pass per table, then publish data, mark and outcome."""

from __future__ import annotations

import hashlib
import json
import logging
import os
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from loamflow import schemas
from loamflow.operators import policies, quality, state, writes
from loamflow.operators.dataset_rules import DatasetRules
from loamflow.operators.incremental import (
    LateRows,
    above_tie,
    incremental_filter,
    mark_literal,
    next_mark,
    not_yet_stored,
    type_of,
)
from loamflow.operators.transforms import resolve_sql, sql_transform
from loamflow.session import configure
from loamflow.sources import specs as spec_source
from loamflow.sources.documents import read_document
from loamflow.sources.snapshots import Snapshot, Warehouse
from loamflow.sources.tables import Tables, checked_profile

logger = logging.getLogger(__name__)

_OK = "_dq_ok"
_OPEN = "__open"
_TIME_TYPES = (TimestampType, TimestampNTZType, DateType)


def _has(df: DataFrame, column: str) -> bool:
    """Whether a top-level column goes by that name, in any letter case."""
    return column.lower() in {c.lower() for c in df.columns}


def load_id(run_id: str, spec_id: str) -> str:
    """Name of one spec's load in one run; it also names a folder."""
    safe = re.sub(r"[^\w.-]", "_", spec_id)
    return f"{run_id}.{safe}-{hashlib.md5(spec_id.encode()).hexdigest()[:8]}"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass
class BulkTransformResult:
    """Outcome of one spec in one run; a row of ``RUN_RESULT_SCHEMA`` plus the exception, if any."""

    run_id: str
    id: str
    description: str = ""
    source_table: str = ""
    target_table: str = ""
    load_strategy: str = ""
    stage: str = "transform"
    status: str = state.SKIPPED
    rows_loaded: int = 0
    source_count: int = 0
    dq_pass: int = 0
    dq_fail: int = 0
    message: str = ""
    started_at: datetime | None = None
    finished_at: datetime | None = None
    mark: str | None = None
    error: Exception | None = field(default=None, repr=False, compare=False)


@dataclass(frozen=True)
class SystemTables:
    """Names of the system tables inside the warehouse."""

    control: str = "logging.watermark_state"
    config: str = "config.load_specs"
    migration_log: str = "logging.migration_log"
    audit: str = "logging.pipeline_run_log"
    policy_audit: str = "logging.policy_audit"
    policy_tags: str = "logging.policy_tags"
    source_profile: str = "logging.source_profile"


class BulkTransformEngine:
    """Runs load specs: read above the mark, transform, check, publish, record.

    ``documents`` holds rule and policy documents by the path the specs name; paths that are
    not in it are read from ``config_base_path``. ``bindings`` names source tables that are
    not in the session catalog (a frame, or the path of a parquet table). ``layouts`` gives
    keyed targets an integer SQL expression over their key columns, such as
    ``o_orderkey div 1000000`` or ``pmod(xxhash64(k), 256)``: the table is stored in one part per
    value, and a merge reads and rewrites the parts it touches instead of the whole table.
    ``parallel`` specs run at a time. ``late`` says, by spec id, what an incremental spec does about rows that arrive
    at or below its mark.
    """

    def __init__(
        self,
        spark: SparkSession,
        warehouse_root: str,
        config_base_path: str = "",
        csv_path: str = "specs.csv",
        bindings: dict[str, DataFrame | str] | None = None,
        documents: dict[str, dict] | None = None,
        system: SystemTables = SystemTables(),
        layouts: dict[str, str] | None = None,
        parallel: int = 1,
        late: dict[str, LateRows] | None = None,
    ):
        self.spark = configure(spark)
        self.warehouse = Warehouse(spark, warehouse_root)
        self.tables = Tables(spark, self.warehouse, bindings)
        self.config_base_path = config_base_path
        self.csv_path = os.path.join(config_base_path, csv_path) if config_base_path else csv_path
        self.documents = dict(documents or {})
        self.system = system
        self.layouts = dict(layouts or {})
        self.parallel = parallel
        self.late = dict(late or {})
        self._source_counts: dict[str, int] = {}
        self._known_tables: set[str] = set()

    # Specs and documents

    def document(self, path: str, root: str) -> dict[str, Any]:
        raw = self.documents.get(path)
        if raw is None:
            raw = read_document(os.path.join(self.config_base_path, path))
        return raw.get(root, raw)

    def _config(self) -> DataFrame | None:
        return self.warehouse.find(self.system.config)

    def load_transforms(self, filter_ids: list[str] | None = None) -> list[dict[str, Any]]:
        """Normalised specs as dicts: from the config table if published, else from the CSV file.

        Specs are the one thing the driver holds: it has to start a Spark job for each.
        """
        frame = spec_source.load_specs(self.spark, self.csv_path, self._config(), filter_ids)
        transforms = [row.asDict() for row in spec_source.route_specs(frame).orderBy("id").collect()]
        self._known_tables |= {t["target_name"] for t in transforms}
        return transforms

    # Stages

    def validate_all(self, filter_ids: list[str] | None = None, run_id: str | None = None) -> dict[str, Any]:
        """Sync the config table, check every spec still to run, and count its source.

        Without a specs file the config table stands as it is. The profile of the sources is stored, also if the run ends here.
        """
        run_id = run_id or str(uuid.uuid4())
        config = self._config()
        try:
            incoming = spec_source.conform_spec_columns(spec_source.read_spec_csv(self.spark, self.csv_path))
        except AnalysisException as exc:
            if config is None or exc.getCondition() != "PATH_NOT_FOUND":
                raise
            logger.info("no specs file at %s: the config table counts", self.csv_path)
        else:
            self.warehouse.save(self.system.config, state.config_sync(config, incoming), f"{run_id}-config")
        transforms = self.load_transforms(filter_ids)
        pending = [t for t in transforms if t["route"] != "skip"]
        issues = [f"[{t['id']}] {p}" for t in pending for p in spec_source.spec_problems(t)]
        told = checked_profile(self.tables, [(t["id"], t["source_name"]) for t in pending])
        profile = [row.asDict() for row in told.collect()]
        issues += [f"[{p['id']}] {p['message']}" for p in profile if p["message"].startswith("cannot access")]
        if profile:
            self.warehouse.save(self.system.source_profile, told.withColumn("run_id", F.lit(run_id)), f"{run_id}-profile", "append")
        if issues:
            raise AssertionError(f"{len(issues)} problem(s) before the run:\n" + "\n".join(issues))
        self._source_counts = {p["id"]: p["source_count"] for p in profile}
        return {
            "table_results": profile,
            "any_run_dq": any(t["run_data_quality"] for t in transforms),
            "any_run_governance": any(t["run_governance"] for t in transforms),
            "any_run_optimize": any(t["run_optimize"] for t in transforms),
        }

    def transform_all(self, filter_ids: list[str] | None = None, stop_on_error: bool = False,
                      run_id: str | None = None) -> list[BulkTransformResult]:
        """Specs without rules; the others are reported as deferred."""
        return self._run_stage("transform", filter_ids, stop_on_error, run_id)

    def run_dq_all(self, filter_ids: list[str] | None = None, stop_on_error: bool = False,
                   run_id: str | None = None) -> list[BulkTransformResult]:
        """Specs with rules: transform, split, publish the valid part and the quarantine."""
        return self._run_stage("quality", filter_ids, stop_on_error, run_id)

    def _run_stage(self, stage: str, filter_ids: list[str] | None, stop_on_error: bool,
                   run_id: str | None) -> list[BulkTransformResult]:
        run_id = run_id or str(uuid.uuid4())
        transforms = self.load_transforms(filter_ids)
        self._bootstrap(transforms, run_id)

        def run(spec: dict[str, Any]) -> BulkTransformResult | None:
            if spec["route"] == "skip":
                return self._skipped(spec, run_id, "processed=true") if stage == "transform" else None
            if spec["route"] != stage:
                return self._skipped(spec, run_id, "deferred to the quality stage") if stage == "transform" else None
            return self.run_spec(spec, run_id)

        results: list[BulkTransformResult] = []
        failure: Exception | None = None

        def run_lane(lane: list[dict[str, Any]]) -> list[BulkTransformResult]:
            done = []
            for spec in lane:
                result = run(spec)
                if result is not None:
                    done.append(result)
                    if result.error is not None and stop_on_error:
                        break
            return done

        lanes = self._lanes(transforms)
        with ThreadPoolExecutor(max_workers=max(1, self.parallel)) as pool:
            # In waves, so that stop_on_error never starts a lane after a failure is known.
            width = max(1, self.parallel)
            for start in range(0, len(lanes), width):
                for done in pool.map(run_lane, lanes[start:start + width]):
                    results += done
                    failure = failure or next((r.error for r in done if r.error is not None), None)
                if failure is not None and stop_on_error:
                    break
        self._record(results, run_id, stage)
        if failure is not None and stop_on_error:
            raise failure
        return results

    def _lanes(self, transforms: list[dict[str, Any]]) -> list[list[dict[str, Any]]]:
        """Specs that share an output come one after the other, in the order given; all others may run side by side."""
        lanes: list[tuple[set[str], list[dict[str, Any]]]] = []
        for spec in transforms:
            outputs = {spec["target_name"]}
            if spec["route"] == "quality":
                try:
                    outputs |= set(self._quality_tables(spec, self.document(spec["dq_config_path"], "data_quality")))
                except Exception:  # its own run will report it
                    logger.debug("[%s] rule document not readable yet", spec["id"])
            shared = [lane for lane in lanes if lane[0] & outputs]
            lanes = [lane for lane in lanes if not lane[0] & outputs]
            lanes.append((outputs.union(*[o for o, _ in shared]), [s for _, own in shared for s in own] + [spec]))
        return [own for _, own in lanes]

    @staticmethod
    def _quality_tables(spec: dict[str, Any], document: dict[str, Any]) -> tuple[str, str]:
        target = spec["target_name"]
        return (
            document.get("quarantine_table") or f"{target}_quarantine",
            document.get("dq_results_table") or f"{target}_dq_results",
        )

    def run_governance_all(self, filter_ids: list[str] | None = None, run_id: str | None = None) -> DataFrame | None:
        """Tag inventory of all governed tables; masks and row filters act in ``read_governed``."""
        run_id = run_id or str(uuid.uuid4())
        inventory: DataFrame | None = None
        governed = []
        for t in self.load_transforms(filter_ids):
            if not t["run_governance"]:
                continue
            status, message = state.SKIPPED, "no policy path"
            if t["governance_config_path"]:
                # One table's bad policy is that table's failure.
                try:
                    policy = self.document(t["governance_config_path"], "governance")
                    entries = policies.policy_entries(self.spark, t["target_name"], policy)
                    tags = policies.tag_inventory(entries)
                    tags.collect()  # a policy has a few dozen tags; they are checked before they count as applied
                    published = self.warehouse.find(t["target_name"])
                    if published is not None:  # masks and row filter have to fit the table, or reading it would fail
                        policies.govern(published, policy, False)
                    inventory = tags if inventory is None else inventory.unionByName(tags)
                    status, message = state.SUCCESS, ""
                except Exception as exc:
                    logger.warning("[%s] policy not applied: %s", t["id"], exc)
                    status, message = state.FAILED, str(exc)
            governed.append((run_id, t["description"] or t["id"], t["target_name"], status, message))
        if inventory is not None:
            self.warehouse.save(self.system.policy_tags, inventory, f"{run_id}-tags")
        if governed:
            events = self.spark.createDataFrame(
                governed, "run_id STRING, pipeline_name STRING, table_name STRING, status STRING, error_message STRING"
            )
            audit = state.policy_audit(events, F.lit(utc_now()).cast("timestamp"))
            self.warehouse.save(self.system.policy_audit, audit, f"{run_id}-policy", "append")
        return inventory

    def run_optimize_all(self, filter_ids: list[str] | None = None, run_id: str | None = None) -> int:
        """Compacts every target that asks for it, once; how many it did. A failure is logged and is that table's alone."""
        run_id = run_id or str(uuid.uuid4())
        done = 0
        for name in sorted({t["target_name"] for t in self.load_transforms(filter_ids) if t["run_optimize"]}):
            try:
                if self.warehouse.exists(name):
                    self.warehouse.compact(name, run_id)
                    done += 1
            except Exception as exc:
                logger.warning("%s not compacted: %s", name, exc)
        return done

    def run_audit_all(self, filter_ids: list[str] | None = None, run_id: str | None = None,
                      results: list[BulkTransformResult] | None = None, started_at: datetime | None = None) -> None:
        """One audit record per spec, all in one write."""
        run_id = run_id or str(uuid.uuid4())
        specs = spec_source.load_specs(self.spark, self.csv_path, self._config(), filter_ids)
        dq = None
        if results:
            dq = self._results_frame([r for r in results if r.stage == "quality"])
        now = utc_now()
        records = state.audit_records(
            specs, self._control(), run_id, F.lit(started_at or now).cast("timestamp"), F.lit(now).cast("timestamp"), dq
        )
        self.warehouse.save(self.system.audit, records, f"{run_id}-audit", "append")

    def mark_processed(self, results: list[BulkTransformResult], run_id: str | None = None) -> None:
        """``processed=true`` for the specs that succeeded."""
        config = self._config()
        if config is None:
            return
        run_id = run_id or str(uuid.uuid4())
        marked = state.mark_processed(config, self._results_frame(results))
        self.warehouse.save(self.system.config, marked, f"{run_id}-processed")

    def run_all(self, filter_ids: list[str] | None = None, stop_on_error: bool = False,
                run_id: str | None = None) -> list[BulkTransformResult]:
        """Validate, transform, check, govern, compact, audit, mark."""
        run_id = run_id or str(uuid.uuid4())
        started = utc_now()
        self.validate_all(filter_ids, run_id)
        plain = self.transform_all(filter_ids, stop_on_error, run_id)
        checked = self.run_dq_all(filter_ids, stop_on_error, run_id)
        by_id = {r.id: r for r in plain} | {r.id: r for r in checked}
        results = list(by_id.values())
        self.run_governance_all(filter_ids, run_id)
        self.run_optimize_all(filter_ids, run_id)
        self.run_audit_all(filter_ids, run_id, results, started)
        self.mark_processed(results, run_id)
        return results

    def run_summary(self, results: list[BulkTransformResult]) -> DataFrame:
        """Tables and rows per status."""
        return state.run_summary(self._results_frame(results))

    # One spec

    def run_spec(self, spec: dict[str, Any], run_id: str, source: DataFrame | None = None) -> BulkTransformResult:
        """Read, transform, split, publish. Failures are part of the result, not raised.

        ``source`` replaces the table read, for callers that bring their own rows (a stream).
        """
        result = self._result(spec, run_id, "quality" if spec["route"] == "quality" else "transform")
        try:
            problems = spec_source.spec_problems(spec)
            if problems:
                raise ValueError(f"[{spec['id']}] " + "; ".join(problems))
            self._load(spec, run_id, result, source)
            result.status = state.SUCCESS
        except Exception as exc:
            logger.warning("[%s] failed: %s", spec["id"], exc)
            result.status, result.message = state.FAILED, str(exc)
            result.error = exc
        result.finished_at = utc_now()
        return result

    def _load(self, spec: dict[str, Any], run_id: str, result: BulkTransformResult, given: DataFrame | None) -> None:
        target, mark_column = spec["target_name"], spec["watermark_column"]
        live = self.warehouse.current(target)
        load = load_id(run_id, spec["id"])
        last, late = None, LateRows()
        if live is not None and load in live.runs:
            result.message = "already published by this run"
            return
        source = given
        if source is None and spec["source_name"]:
            source = self.tables.read(spec["source_name"])
            counted = self._source_counts.pop(spec["id"], -1)  # it holds for the run it was counted in
            result.source_count = counted if counted >= 0 else source.count()
            if mark_column and spec["load_type"] == "incremental":
                last, late = self.last_mark(spec, live), self.late.get(spec["id"], late)
                source = self._unread(source, spec, live, last, late)
        sql = resolve_sql(spec, self.config_base_path)
        inputs = self.tables.inputs(sql, self._known_tables) if source is None else {"source": source}
        transformed = sql_transform(self.spark, sql, inputs, as_of=result.started_at)
        if late.overlap and last is not None and live is not None and spec["load_strategy"] == "append":
            if not spec["pk"] or not _has(transformed, mark_column):
                raise ValueError(f"[{spec['id']}] an append that reads a stretch again needs keys and its mark column in the result")
            stored = self.warehouse.read_snapshot(live)
            transformed = not_yet_stored(transformed, stored, spec["pk"], mark_column, last, late.overlap)

        rules, threshold, quarantine, dq_results, whole = [], quality.DEFAULT_THRESHOLD_PCT, "", "", DatasetRules(transformed, [])
        if spec["route"] == "quality":
            document = self.document(spec["dq_config_path"], "data_quality")
            rules = document.get("checks") or []
            threshold = float(document.get("failure_threshold_pct", threshold))
            quarantine, dq_results = self._quality_tables(spec, document)
            whole = DatasetRules(transformed, document.get("dataset_checks") or [])

        references = {
            r.arguments["ref_table"]: self.tables.read(r.arguments["ref_table"])
            for r in quality.parse_rules(rules)
            if r.function == "foreign_key" and r.arguments.get("ref_table")
        }

        def settle(keys: DataFrame) -> DataFrame:
            path = self.warehouse.data_path(target, f"{load}-{uuid.uuid4().hex[:8]}", "keys")
            return self.spark.read.schema(keys.schema).parquet(self.warehouse.stage(keys, path))

        checked = quality.RuleSet(transformed, rules, references, settle)
        marks = []
        if mark_column and _has(transformed, mark_column):
            reached = next_mark(mark_column)
            if late.overlap and last is not None:  # late rows alone do not set the mark back
                bound = mark_literal(last, type_of(transformed, mark_column))
                reached = F.when(reached.isNotNull(), F.greatest(reached, bound))
            marks.append(reached.cast("string").alias("mark"))
            if late.tie and _has(transformed, late.tie):
                pair = F.max(F.struct(F.col(mark_column).alias("value"), F.col(late.tie).alias("tie")))
                marks += [pair["value"].cast("string").alias("tie_of"), pair["tie"].cast("string").alias("tie")]
        run_ts = F.lit(utc_now()).cast("timestamp")

        # The only evaluation of the transform: counts, mark and rule outcome are observed in
        # the pass that stages the rows.
        seen = Observation(f"load-{uuid.uuid4().hex}")
        staged = self.warehouse.data_path(target, load)
        observed = checked.frame.observe(seen, *checked.metrics(), *marks, *whole.metrics("dataset_"))
        if rules:
            accepted = ~checked.violated(quality.ERROR)
            rows = observed.select(
                *transformed.columns,
                checked.findings(quality.ERROR).alias(quality.ERRORS),
                checked.findings(quality.WARN).alias(quality.WARNINGS),
                accepted.alias(_OK),
            )
            rows = quality.with_provenance(rows, run_id, run_ts, spec["source_name"] or spec["id"])
            self.warehouse.stage(rows, staged, partition_by=_OK)
            accepted_path, rejected_path = f"{staged}/{_OK}=true", f"{staged}/{_OK}=false"
        else:
            self.warehouse.stage(observed, staged)
            accepted_path, rejected_path = staged, ""
        counts = seen.get
        total, failed = counts["total_rows"], counts["fail_rows"]
        mark = counts.get("mark")
        ties = {} if counts.get("tie") is None else {f"{spec['id']}#tie": json.dumps([counts["tie_of"], counts["tie"]])}

        if mark is not None and isinstance(type_of(transformed, mark_column), _TIME_TYPES):
            # The control table can only show marks that are times; the manifest keeps any mark.
            result.mark = mark
        if rules and total:
            result.dq_fail, result.dq_pass = failed, total - failed
            pct = self._record_quality(run_id, load, total, failed, threshold, dq_results)
            full = StructType([f for f in rows.schema if f.name != _OK])
            if failed:
                self.warehouse.publish(quarantine, load, (rejected_path,), full, failed, "append")
            if counts["warn_rows"]:
                flagged = self.spark.read.schema(full).parquet(staged).filter(F.size(quality.WARNINGS) > 0)
                self.warehouse.save(f"{dq_results}_warnings", flagged.select(full.names), load, "append")
            if pct > threshold:
                result.mark = None
                raise quality.DQPipelineException(
                    f"{pct:.2f}% of the rows failed the rules (threshold {threshold}%), see {quarantine}"
                )
        broken = self._record_dataset(whole, counts, run_id, load, result.started_at, dq_results)
        if broken:
            result.mark = None
            raise quality.DQPipelineException(f"dataset rules failed: {', '.join(broken)}, see {dq_results}_dataset")
        if total - failed == 0:
            result.message = "no rows after the transform" if not total else "all rows failed the rules"
            if live is not None and mark is not None:
                self.warehouse.set_marks(target, load, {spec["id"]: mark, **ties})
            return
        self._publish(spec, load, live, accepted_path, transformed.schema, total - failed, {
            **({} if mark is None else {spec["id"]: mark}), **ties,
        })
        result.rows_loaded = total - failed

    @staticmethod
    def _unread(source: DataFrame, spec: dict[str, Any], live: Snapshot | None, last: str | None, late: LateRows) -> DataFrame:
        """Rows above the mark, with the ties and the stretch below it that the spec asks for."""
        column = spec["watermark_column"]
        tied = live.marks.get(f"{spec['id']}#tie") if live is not None and late.tie and not late.overlap else None
        if tied is not None and last is not None:
            value, tie = json.loads(tied)
            kind = type_of(source, column)
            # The tie belongs to one mark; a mark that was set back is read as such.
            same = source.sparkSession.range(1).select(mark_literal(value, kind) == mark_literal(last, kind)).first()[0]
            if same:
                return above_tie(source, column, last, late.tie, tie)
        return incremental_filter(source, column, last, late.overlap or None)

    def _publish(self, spec: dict[str, Any], load: str, live: Snapshot | None, path: str, schema: StructType,
                 rows: int, marks: dict[str, str]) -> None:
        target, strategy = spec["target_name"], spec["load_strategy"]
        layout, dirs = None, (path,)
        if strategy in schemas.KEYED_STRATEGIES:
            layout = self.layouts.get(target)
            writes.key_names(spec["pk"], self.spark.createDataFrame([], schema), "source")
            if live is not None or layout or strategy == "scd2":
                staged = self.spark.read.schema(schema).parquet(path)
                dirs, schema, rows = self._merge(spec, load, staged, live, layout)
        if strategy == "append":
            self.warehouse.publish(target, load, dirs, schema, rows, "append", marks, layout)
        else:
            self.warehouse.publish(target, load, dirs, schema, rows, "overwrite", marks, layout, based_on=live)

    def _merge(self, spec: dict[str, Any], load: str, source: DataFrame, live: Snapshot | None,
               layout: str | None) -> tuple[tuple[str, ...], StructType, int]:
        """Directories, schema and row count of the table after a keyed load.

        With a layout, only the parts the source touches are read and rewritten.
        """
        keys, kept, kept_rows, stored = spec["pk"], (), 0, None
        if layout:
            source.select(*keys).select(F.expr(layout))  # fails unless it depends on the keys alone
        if live is not None and layout and live.layout == layout:
            touched, kept = live.split(self.warehouse.part_names(source, layout))
            part = replace(live, dirs=touched)
            stored = self.warehouse.read_snapshot(part)
            kept_rows = live.rows - (stored.count() if touched else 0)
        elif live is not None:
            if spec["load_strategy"] == "scd2":
                # Versions that were closed by an earlier load lie in folders of their own and stay there.
                kept = tuple(d for d in live.dirs if d.endswith(f"/{_OPEN}=false"))
                live = replace(live, dirs=tuple(d for d in live.dirs if d not in kept))
            stored = self.warehouse.read_snapshot(live)
        path = self.warehouse.data_path(spec["target_name"], load, "merged")
        if spec["load_strategy"] == "merge":
            merged = writes.merge_upsert(stored, source, keys)
        else:
            merged = writes.scd2_history(stored, source, keys, F.lit(utc_now()))
            if not layout:
                return self._stage_history(merged, kept, path)
        if layout:
            # An observation below the rebalance could count a repeated stage twice: read the footers instead.
            dirs = self.warehouse.stage_parts(merged, path, layout)
            return kept + dirs, merged.schema, kept_rows + self.spark.read.schema(merged.schema).parquet(*dirs).count()
        seen = Observation(f"merge-{uuid.uuid4().hex}")
        counted = merged.observe(seen, F.count(F.lit(1)).alias("rows"))
        return (self.warehouse.stage(counted, path),), merged.schema, seen.get["rows"]

    def _stage_history(self, merged: DataFrame, kept: tuple[str, ...], path: str) -> tuple[tuple[str, ...], StructType, int]:
        """Open and closed versions written apart, next to the folders of closed ones that stay."""
        seen = Observation(f"history-{uuid.uuid4().hex}")
        is_open = F.coalesce(F.col("is_current"), F.lit(False))
        counted = merged.observe(seen, F.count_if(is_open).alias("opened"), F.count_if(~is_open).alias("closed"))
        self.warehouse.stage(counted.withColumn(_OPEN, is_open), path, partition_by=_OPEN)
        counts = seen.get
        dirs = kept + tuple(f"{path}/{_OPEN}={v}" for v, n in (("true", counts["opened"]), ("false", counts["closed"])) if n)
        rows = counts["opened"] + counts["closed"]
        if kept:
            rows += self.spark.read.schema(merged.schema).parquet(*kept).count()  # from the footers
        return dirs, merged.schema, rows

    def _record_quality(self, run_id: str, load: str, total: int, failed: int, threshold: float, table: str) -> float:
        counts = self.spark.sql(
            "SELECT :run AS run_id, CAST(:total AS LONG) AS total_rows, CAST(:failed AS LONG) AS fail_rows",
            args={"run": run_id, "total": total, "failed": failed},
        )
        summary = quality.summarize(counts, threshold).select(
            "run_id", "total_rows", "pass_rows", "fail_rows", "fail_pct", "status",
            F.lit(utc_now()).cast("timestamp").alias("created_at"),
        )
        self.warehouse.save(table, summary, load, "append")
        return summary.first()["fail_pct"]

    def _record_dataset(self, rules: DatasetRules, counts: dict[str, Any], run_id: str, load: str, as_of: datetime,
                        table: str) -> list[str]:
        """Stores the verdicts of the dataset rules; names of the error rules that do not hold."""
        if not rules.rules:
            return []
        measures = self.spark.createDataFrame([tuple(counts[f"dataset_{m.name}"] for m in rules.measures)], rules.schema)
        told = rules.verdicts(measures, as_of).withColumn("run_id", F.lit(run_id))
        self.warehouse.save(f"{table}_dataset", told, load, "append")
        return [r["name"] for r in told.collect() if not r["passed"] and r["criticality"] == quality.ERROR]

    def last_mark(self, spec: dict[str, Any], live: Snapshot | None = None) -> str | None:
        """The mark of this spec: one published with the data that the control table does not have, else the control row's.

        So a mark set back in the control table makes the next run read from there.
        """
        live = live or self.warehouse.current(spec["target_name"])
        if live is not None and spec["id"] in live.marks:
            return live.marks[spec["id"]]
        row = self._control().filter(F.col("id") == spec["id"]).select(F.col("last_load_time").cast("string")).first()
        return row[0] if row else None

    def read_governed(self, name: str, policy: dict[str, Any], principal: str, groups: list[str] = (),
                      privileged_principals: list[str] = ()) -> DataFrame:
        """A published table as ``principal`` may see it: row filter first, then masks."""
        security = policy.get("row_level_security") or {}
        mapping = security.get("group_mapping_table") if security.get("enabled") else None
        return policies.govern(
            self.warehouse.read(name), policy, principal in set(privileged_principals), groups,
            self.tables.read(mapping) if mapping else None, principal,
        )

    # State

    def _control(self) -> DataFrame:
        stored = self.warehouse.find(self.system.control)
        return self.spark.createDataFrame([], schemas.CONTROL_SCHEMA) if stored is None else stored

    def _bootstrap(self, transforms: list[dict[str, Any]], run_id: str) -> None:
        control = self._control()
        known = {row["id"] for row in control.select("id").collect()}
        if all(t["id"] in known for t in transforms):
            return
        seeds = self.spark.createDataFrame(
            [(t["id"], t["last_load_time"]) for t in transforms], "id STRING, last_load_time STRING"
        )
        seeded = state.control_bootstrap(control, seeds, F.lit(utc_now()).cast("timestamp"))
        self.warehouse.save(self.system.control, seeded, f"{run_id}-bootstrap-{uuid.uuid4().hex[:8]}")

    def _record(self, results: list[BulkTransformResult], run_id: str, stage: str) -> None:
        """Outcome of a whole stage: one log write, one control write."""
        if not results:
            return
        frame = self._results_frame(results)
        try:
            log = state.migration_log(frame)
            self.warehouse.save(self.system.migration_log, log, f"{run_id}-{stage}-log", "append")
        except Exception as exc:  # a run does not fail for its log
            logger.warning("migration log not written: %s", exc)
        ran = frame.filter(F.col("status") != state.SKIPPED)
        if any(r.status != state.SKIPPED for r in results):
            control = state.control_update(self._control(), ran)
            if any(r.mark is not None for r in results):
                marks = ran.select("id", F.col("mark").try_cast("timestamp").alias("last_load_time"))
                control = state.mark_update(control, marks)
            self.warehouse.save(self.system.control, control, f"{run_id}-{stage}-state")
            moved: dict[str, set[str]] = {}
            for r in results:
                if r.mark is not None:
                    moved.setdefault(r.target_table, set()).add(r.id)
            for target, ids in moved.items():
                self.warehouse.settle_marks(target, ids)

    def _results_frame(self, results: list[BulkTransformResult]) -> DataFrame:
        fields = [f for f in BulkTransformResult.__dataclass_fields__ if f != "error"]
        rows = [tuple(getattr(r, f) for f in fields) for r in results]
        return self.spark.createDataFrame(rows, schemas.RUN_RESULT_SCHEMA)

    def _result(self, spec: dict[str, Any], run_id: str, stage: str) -> BulkTransformResult:
        return BulkTransformResult(
            run_id=run_id, id=spec["id"], description=spec["description"] or "", source_table=spec["source_name"],
            target_table=spec["target_name"], load_strategy=spec["load_strategy"], stage=stage, started_at=utc_now(),
        )

    def _skipped(self, spec: dict[str, Any], run_id: str, message: str) -> BulkTransformResult:
        result = self._result(spec, run_id, "transform")
        result.message, result.finished_at = message, utc_now()
        return result
