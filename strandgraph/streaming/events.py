"""Event operators as Structured Streaming queries; each equals its batch form once the stream has ended.

``ended`` runs one over files to its end.  Files of an event table are taken in one go; a last event far ahead, made of
nothing but a time, moves the watermark past all windows, so that append mode gives every window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import folder


def tumbling(events: DataFrame, late: str = "1 day", size: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"))


def sliding(events: DataFrame, late: str = "1 day", size: str = "6 hours", step: str = "2 hours") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", size, step)).agg(F.count("*").alias("n"), F.sum("value").alias("value"))


def session(events: DataFrame, late: str = "1 day", gap: str = "6 hours") -> DataFrame:
    return events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("n"))


def first_of_day(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Drops repeats of a user's event type on a day; state is bounded by the watermark."""
    return events.withColumn("day", F.date_trunc("day", "ts")).withWatermark("day", late).dropDuplicates(["user_id", "event_type", "day"])


def running(events: DataFrame) -> DataFrame:
    """user_id, n, last: events so far of each user, kept as state of a fixed size; the last row of a user is its total."""

    def count(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, last = state.get if state.exists else (0, 0)
        for pdf in frames:
            n, last = n + len(pdf), max(last, int(pdf["event_id"].max()))
        state.update((n, last))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "last": [last]})

    return events.groupBy("user_id").applyInPandasWithState(count, "user_id long, n long, last long", "n long, last long", "append", "NoTimeout")


def ended(events: DataFrame, operator: Callable[[DataFrame], DataFrame], far: str | None = "2999-01-01") -> DataFrame:
    """What ``operator`` gives for the whole of ``events`` (a batch table with ts), run as a stream over its files."""
    spark = events.sparkSession
    source, sink, mark = (folder(spark, x) for x in ("stream-in", "stream-out", "stream-state"))
    events.write.parquet(source)
    files = len(spark.read.parquet(source).inputFiles())
    if far is not None:
        end = events.limit(0).unionByName(spark.sql(f"SELECT CAST('{far}' AS {events.schema['ts'].dataType.simpleString()}) AS ts"), allowMissingColumns=True)
        end.coalesce(1).write.mode("append").parquet(source)
        end.coalesce(1).write.mode("append").parquet(source)  # windows are given one trigger after the mark has moved
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", max(1, files)).parquet(source)
    out = operator(stream)
    query = out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", mark).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(sink)
