"""Newly landed pages as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from layerframe.sources.pages import pages_from_files, scan_pages


def stream_pages(
    spark: SparkSession, path: str, layer_url: str | None = None, max_files: int | None = None
) -> DataFrame:
    """Parsed pages of every file that lands under ``path``; same columns as a batch scan."""
    reader = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return scan_pages(pages_from_files(reader.load(path), layer_url))


def stream_page_table(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Parsed pages appended to a Parquet table of (layer_url, page_index, payload)."""
    reader = spark.readStream.schema("layer_url string, page_index bigint, payload string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return scan_pages(reader.parquet(path))


def write_stream(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Appends to a Parquet table; the checkpoint makes each page count once."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
