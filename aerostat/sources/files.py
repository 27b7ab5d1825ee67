"""File scans and sinks with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat import schema as S
from aerostat.plans import lineage


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    header: bool = True,
    infer_schema: bool = False,
) -> DataFrame:
    """CSV scan. A value that does not fit its column's type becomes NULL."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_sources(
    spark: SparkSession, air_quality: str, weather: str, stations: str, fmt: str = "csv"
) -> dict[str, DataFrame]:
    """The three input tables by name, in their fixed schemas."""
    paths = {"air_quality": air_quality, "weather": weather, "stations": stations}
    if fmt == "csv":
        return {name: read_csv(spark, path, S.SCHEMAS[name]) for name, path in paths.items()}
    return {name: read_parquet(spark, path) for name, path in paths.items()}


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    cluster: bool = False,
    observe: tuple[Observation, list[Column]] | None = None,
) -> str:
    """Parquet sink; partition columns the frame lacks are ignored.

    ``cluster`` first gathers the rows of a partition value, so that each value gets a few
    large files instead of one per task. The gathering key has a hash of the whole row in
    it: even a value with most of the rows spreads over many tasks.

    ``observe`` collects metrics of the written rows. They are taken in the writing stage itself,
    after the gathering: a task of that stage counts once, also where a lost one is run again.
    """
    columns = [c for c in partition_by or [] if c in df.columns]
    if cluster and columns:
        fan_out = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        others = [c for c in df.columns if c not in columns]
        spread = F.pmod(F.xxhash64(*others), F.lit(max(1, fan_out // 4)))
        df = df.withColumn("_spread", spread).repartition(*columns, "_spread").drop("_spread")
    if observe:
        df = df.observe(observe[0], *observe[1])
    writer = df.write.mode(mode)
    if columns:
        writer = writer.partitionBy(*columns)
    writer.parquet(path)
    return path


def append_parquet(df: DataFrame, path: str) -> str:
    return write_parquet(df, path, mode="append")


def write_report(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> str:
    """A report table as JSON, CSV or Parquet files."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def between(df: DataFrame, start: str, end: str, column: str = S.TIME) -> DataFrame:
    """Rows with ``start <= timestamp < end``; also prunes ``year`` / ``month`` partitions."""
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    rows = df.filter((F.col(column) >= low) & (F.col(column) < high))
    if {"year", "month"} <= set(df.columns):
        month = F.col("year") * 12 + F.col("month")
        rows = rows.filter(F.col("year").between(F.year(low), F.year(high)))
        rows = rows.filter(month.between(F.year(low) * 12 + F.month(low), F.year(high) * 12 + F.month(high)))
    return rows


def repartition(df: DataFrame, n: int, *keys: str) -> DataFrame:
    return df.repartition(n, *keys)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make the frame available to SQL."""
    df.createOrReplaceTempView(name)
    return df


def scratch(spark: SparkSession, name: str) -> str:
    return lineage.scratch_path(spark, name)
