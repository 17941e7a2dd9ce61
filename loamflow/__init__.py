"""Raw tables into trusted ones, as plain Spark DataFrame work.

The names below are the whole public surface; every operator is a pure function in ``operators``.
"""

from loamflow.functions.names import to_snake_case
from loamflow.operators.quality import DQPipelineException
from loamflow.operators.transforms import apply_drop_columns, apply_rename_columns, apply_snake_case, sql_transform
from loamflow.plans.engines import DQEngine, GovernanceEngine, PipelineLogger
from loamflow.plans.runner import BulkTransformEngine, BulkTransformResult, SystemTables
from loamflow.sources.snapshots import Warehouse
from loamflow.sources.tables import Tables
from loamflow.streaming.incremental import incremental_stream

__all__ = [
    "BulkTransformEngine",
    "BulkTransformResult",
    "DQEngine",
    "DQPipelineException",
    "GovernanceEngine",
    "PipelineLogger",
    "SystemTables",
    "Tables",
    "Warehouse",
    "apply_drop_columns",
    "apply_rename_columns",
    "apply_snake_case",
    "incremental_stream",
    "sql_transform",
    "to_snake_case",
]
