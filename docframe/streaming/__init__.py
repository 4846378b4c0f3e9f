"""Row-wise verbs on streams: a frame over a streaming DataFrame filters, transforms and clips without state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from docframe.operators.frame import DocFrame


def open_stream(spark: SparkSession, path: str, schema: StructType, key: str | None = None) -> DocFrame:
    """A frame over Parquet files as they arrive in a folder."""
    return DocFrame(spark.readStream.schema(schema).parquet(path), key)


def follow(frame: DocFrame, verbs: Callable[[DocFrame], DocFrame], out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Run verbs over a stream into a Parquet folder. Sorts and bounds need the whole input, so they are refused."""
    done = verbs(frame)
    if done.order or done.slices:
        raise ValueError("a stream has no end to sort or to count from")
    writer = done.result().writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
