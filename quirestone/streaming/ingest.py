"""Documents that arrive as files: chunked as a stream, each batch appended once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.retrieval import chunk_array


def document_stream(spark: SparkSession, path: str, schema: str, files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def chunk_stream(docs: DataFrame, size: int = 500, overlap: int = 80) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.posexplode(chunk_array(text, size, overlap)).alias("chunk_index", "content"))


def event_counts(events: DataFrame, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Events by type and window; what is later than ``late`` is left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"))


def start(df: DataFrame, path: str, checkpoint: str):
    """Run over what is there and stop; a restart goes on after the last batch."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
