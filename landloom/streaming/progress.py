"""Incremental runs over files that keep arriving."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def run_available(spark: SparkSession, source: str, schema: StructType | str, sink: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], *, kind: str = "parquet", files_per_batch: int = 1_000) -> StreamingQuery:
    """Transform the files that are new since the last run and append them to `sink`; then stop.

    The checkpoint remembers what was done, so a run after a failure goes on
    where the last complete batch ended and nothing is written twice.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(kind).load(source)
    query = transform(stream).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_keyed(spark: SparkSession, source: str, schema: StructType | str, checkpoint: str, merge: Callable[[DataFrame, int], None], *, kind: str = "parquet") -> StreamingQuery:
    """Hand each batch of new files to `merge` with its number, for sinks that write by key; then stop.

    A batch may be handed over again after a failure, so `merge` must not mind.
    """
    stream = spark.readStream.schema(schema).format(kind).load(source)
    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def windowed_counts(stream: DataFrame, at: str, by: Sequence[str], *, length: str = "10 minutes", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Rows per time window and group; rows later than `late` behind the newest are left out."""
    window = F.window(at, length, slide) if slide else F.window(at, length)
    return stream.withWatermark(at, late).groupBy(window.alias("w"), *by).agg(F.count(F.lit(1)).alias("n_rows")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n_rows")


def first_of_key(stream: DataFrame, at: str, key: Sequence[str], *, late: str = "1 hour") -> DataFrame:
    """Rows without those whose key came already, within the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(list(key))
