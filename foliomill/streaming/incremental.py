"""Extensions for tables that grow: resumable ingest and incremental exact de-duplication."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def shards(spark: SparkSession, path: str, schema: StructType | str, format: str = "json", files_per_trigger: int = 100) -> DataFrame:
    """New files of a folder as a stream; which were read is kept in the query's checkpoint."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(format).load(path)


def ingest(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Runs batch on what is there and ends. A batch that was cut off comes again with its number, so batch should write by number."""
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def into_parquet(target: str) -> Callable[[DataFrame, int], None]:
    """A batch function that a repeated batch doesn't double: each number has its folder."""
    return lambda df, number: df.write.mode("overwrite").parquet(f"{target}/batch={number}")


def first_seen(stream: DataFrame, text: str, time: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each text by SHA-256, forgetting those older than the watermark."""
    return stream.withColumn("_digest", F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).withWatermark(time, delay).dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def counts_by_window(stream: DataFrame, time: str, by: str, width: str = "10 minutes", delay: str = "10 minutes") -> DataFrame:
    """Rows by time window and column."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("window"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), by, "n")
