"""The rule layers on a stream of work rows.

They keep no state, so the batch code runs unchanged on a streaming frame with
static slots and lookup. Nothing is windowed and no watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from merkmal.operators.waterfall import predict_by_rules


def stream_predictions(rows: DataFrame, slots: DataFrame, path: str, checkpoint: str, lookup: DataFrame | None = None) -> StreamingQuery:
    """Append predictions for all rows available now to a parquet folder."""
    predicted = predict_by_rules(rows, slots, lookup)
    return (
        predicted.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
