"""Streams over a directory of files, admitted a bounded number of files at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aerostat import schema as S
from aerostat.operators.cleaning import nan_to_null, normalize_timestamps, valid_keys
from aerostat.operators.indexing import aqi_enrich

MAX_FILES = 64


def csv_stream(
    spark: SparkSession, directory: str, schema: T.StructType = S.READINGS_SCHEMA, max_files: int = MAX_FILES
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("maxFilesPerTrigger", max_files)
        .csv(directory)
    )


def parquet_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    glob: str = "*.parquet",
    max_files: int = MAX_FILES,
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files)
        .parquet(directory)
    )


def indexed_stream(readings: DataFrame, standard: str = "US_EPA") -> DataFrame:
    """Typed, valid readings with the air-quality index: stateless, same as in a batch."""
    typed = valid_keys(nan_to_null(normalize_timestamps(readings), S.POLLUTANTS))
    return aqi_enrich(typed, standard)


def deduplicated_stream(readings: DataFrame, watermark: str = S.WATERMARK) -> DataFrame:
    """Drop repeated (station, timestamp) pairs; state older than the watermark is forgotten."""
    return readings.withWatermark(S.TIME, watermark).dropDuplicatesWithinWatermark([S.STATION, S.TIME])
