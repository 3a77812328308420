"""Log lines as a table or stream: parsing, and counts by level and window with a watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE = r"(?s)^(\d{2}/\d{2}/\d{4} - \d{2}:\d{2}:\d{2}) - \[([A-Z]+)\] - (.*)$"


def log_line(ts: Column, level: Column, message: Column) -> Column:
    return F.concat(F.date_format(ts, "MM/dd/yyyy - HH:mm:ss"), F.lit(" - ["), level, F.lit("] - "), message)


def parse_logs(lines: DataFrame, column: str = "value") -> DataFrame:
    """ts, level and message of each line; lines of another shape have a null ts and level and are the message."""
    part = lambda i: F.regexp_extract(column, LINE, i)
    fits = F.col(column).rlike(LINE)
    return lines.select(F.try_to_timestamp(part(1), F.lit("MM/dd/yyyy - HH:mm:ss")).alias("ts"), F.when(fits, part(2)).alias("level"), F.when(fits, part(3)).otherwise(F.col(column)).alias("message"))


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return parse_logs(spark.read.text(path, recursiveFileLookup=True))


def stream_logs(spark: SparkSession, path: str) -> DataFrame:
    return parse_logs(spark.readStream.schema("value string").option("recursiveFileLookup", "true").text(path))


def level_counts(logs: DataFrame, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Lines by level and window; on a stream, state older than the watermark is dropped."""
    timed = logs.where("ts IS NOT NULL").withWatermark("ts", late) if logs.isStreaming else logs.where("ts IS NOT NULL")
    return timed.groupBy(F.window("ts", window).alias("w"), "level").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "level", "n")


def new_events(stream: DataFrame, key: str, ts: str, late: str = "1 hour") -> DataFrame:
    """Each key once: within the watermark on a stream, over all rows in batch."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key]) if stream.isStreaming else stream.dropDuplicates([key])
