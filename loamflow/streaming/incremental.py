"""The same spec driven by a stream: the checkpoint takes the place of the stored mark."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from loamflow.operators import state
from loamflow.plans.runner import BulkTransformEngine


def incremental_stream(engine: BulkTransformEngine, spec: dict[str, Any], source: DataFrame,
                       checkpoint: str | None = None) -> StreamingQuery:
    """Load everything the stream has not delivered yet, batch by batch, then stop.

    A batch that is repeated after a failure carries the same run id and is published once. The
    id names the query as well, which a new checkpoint changes: then everything counts as new.
    """
    location = checkpoint or f"{engine.warehouse.root}/_checkpoints/{spec['id']}"

    def load(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        result = engine.run_spec(spec, f"{spec['id']}-{query_id}-batch-{batch_id}", source=batch)
        if result.status == state.FAILED:
            raise result.error

    return (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .start()
    )
