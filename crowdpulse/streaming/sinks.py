"""Where results of a streaming query go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_stream(df: DataFrame, sink: str, target: str | None, checkpoint: str, trigger: dict | None = None,
                 options: dict | None = None):
    """Start a query that appends ``df`` to a sink: parquet, kafka, memory or console.

    ``target`` is a folder, a topic or a table name. Kafka rows are one JSON text each and need
    the connector and ``kafka.bootstrap.servers`` in ``options``; that sink has never been run here.
    """
    if sink == "kafka":
        df = df.select(F.to_json(F.struct("*")).alias("value"))
    writer = df.writeStream.format(sink).outputMode("append").trigger(**(trigger or {"availableNow": True}))
    if sink != "memory":
        writer = writer.option("checkpointLocation", checkpoint)
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if sink == "parquet":
        return writer.option("path", target).start()
    if sink == "kafka":
        return writer.option("topic", target).start()
    if sink == "memory":
        return writer.queryName(target).start()
    return writer.start()
