"""Incremental intake as a stream: new files are read once, repeats within the watermark dropped, results appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def intake(spark: SparkSession, folder: str, schema: str, when: str, keys: list[str], late: str = "7 days") -> DataFrame:
    """A stream of Parquet files dropped into ``folder``, each key once within the watermark."""
    return spark.readStream.schema(schema).parquet(folder).withWatermark(when, late).dropDuplicatesWithinWatermark(keys)


def hourly_counts(stream: DataFrame, when: str, key: str, late: str = "1 hour") -> DataFrame:
    """Windowed counts with late rows up to the watermark."""
    return stream.withWatermark(when, late).groupBy(F.window(when, "1 hour"), key).agg(F.count(F.lit(1)).alias("n"))
