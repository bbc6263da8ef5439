"""Pages as they arrive. The batch operators without state work on a stream as they are; this adds what needs state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelattice.operators import nested, pages


def arriving_pages(spark: SparkSession, folder: str, schema, *, files_per_batch: int = 100) -> DataFrame:
    """The Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def once(stream: DataFrame, *, late: str = "30 days") -> DataFrame:
    """Each page once, though delivered twice; forgotten when it is older than the watermark."""
    timed = stream.withColumn("loaded_at", F.col("loaded_at").cast("timestamp"))
    return timed.withWatermark("loaded_at", late).dropDuplicatesWithinWatermark(["page_id"])


def flattened(stream: DataFrame) -> DataFrame:
    """Nodes and images of the pages of a stream."""
    return nested.flatten_records(stream, ["page_id", "manual_id"])


def kinds_per_day(stream: DataFrame, *, late: str = "2 days") -> DataFrame:
    """Pages of each kind by the day they were loaded, as an append stream behind a watermark."""
    marked = stream.withColumn("loaded_at", F.col("loaded_at").cast("timestamp")).withWatermark("loaded_at", late)
    typed = pages.classified_pages(pages.page_views(marked, "loaded_at"), "loaded_at").select("loaded_at", "content_type")
    return typed.groupBy(F.window("loaded_at", "1 day").alias("day"), "content_type").agg(F.count("*").alias("n_pages"))
