"""The harvest as streams: links seen once, counters, and a manifest that grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lavra.functions.text import record_id
from lavra.schemas import ENVELOPE


def envelope_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(source, query, collected_at timestamp, pos, url) from envelopes that arrive as JSON files."""
    e = spark.readStream.schema(ENVELOPE).json(folder)
    at = F.try_to_timestamp("collected_at").alias("collected_at")
    return e.select("source", "query", at, F.posexplode("record_urls").alias("pos", "url"))


def first_seen(links: DataFrame, late: str = "1 day") -> DataFrame:
    """Each address once while its state is kept; rows later than ``late`` are dropped with their state."""
    return links.withWatermark("collected_at", late).dropDuplicatesWithinWatermark(["url"]).withColumn("record_id", record_id("url"))


def counts(links: DataFrame, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Links by source and hour of collection."""
    w = links.withWatermark("collected_at", late).groupBy(F.window("collected_at", window).alias("w"), "source")
    return w.agg(F.count("*").alias("n_links")).select("source", F.col("w.start").alias("start"), "n_links")


def to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Runs over what has arrived and stops; a second run goes on where the first ended."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
