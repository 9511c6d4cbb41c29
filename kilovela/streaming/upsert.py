"""Extension: the keyed merge as a stream sink, and windowed totals with a watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from kilovela.operators.merge import Table
from kilovela.operators.versioning import latest


def merge_stream(stream: DataFrame, target: Table, keys: list[str], columns: list[str], order: list[Column], checkpoint: str, now: Column | None = None) -> StreamingQuery:
    """Every micro-batch is reduced to its newest row per key and merged. A batch replayed after a failure changes nothing,
    for the merge updates only what differs."""

    def one(batch: DataFrame, _: int) -> None:
        target.merge(latest(batch, keys, order), keys, columns, now if now is not None else F.current_timestamp())

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_totals(stream: DataFrame, when: str, value: str, by: list[str], late: str = "2 days") -> DataFrame:
    """Totals per hour and group; rows later than ``late`` behind the newest are left out by the watermark."""
    w = F.window(when, "1 hour")
    return stream.withWatermark(when, late).groupBy(w.alias("w"), *by).agg(F.sum(value).alias("total"), F.count("*").alias("n")).select(F.col("w.start").alias("hora"), *by, "total", "n")
