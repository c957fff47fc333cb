"""Looks at a stream of messages while it runs."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def tap(messages: DataFrame, name: str | None = None, every: float = 0.1) -> StreamingQuery:
    """Shows the messages on the console, or keeps them in a memory table of the given name."""
    writer = messages.writeStream.outputMode("append").trigger(processingTime=f"{every} seconds")
    if name is None:
        return writer.format("console").option("truncate", "false").start()
    return writer.format("memory").queryName(name).start()
