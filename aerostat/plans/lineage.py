"""Cutting lineage on storage that outlives an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get(_SETTING, None) or sc.getConf().get(_SETTING) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="aerostat-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def with_scalar(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Add the columns of a one-row frame as one struct column.

    A single scalar subquery, however many of its fields are used: no join, and one plan.
    """
    return df.withColumn(name, one_row.select(F.struct(*one_row.columns)).scalar())


_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def materialise(df: DataFrame, name: str = "stage", by: Sequence[str] = ()) -> DataFrame:
    """Write the frame once as Parquet in the shared folder, partitioned by some columns, and read
    it back."""
    return _staged(df, name, df.write.partitionBy(*by))


def materialise_numbers(df: DataFrame, name: str = "stage") -> DataFrame:
    """As ``materialise``, for numbers that hardly repeat, such as hashes: looking for repeated ones
    costs most of writing them and saves little space."""
    return _staged(df, name, df.write.option("parquet.enable.dictionary", "false"))


def _staged(df: DataFrame, name: str, writer: DataFrameWriter) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    _paths[staged] = path
    return staged


def release(*staged: DataFrame) -> None:
    """Free the space of staged frames whose last reader is done: their tables become empty.

    A frame that ``materialise`` did not return is left alone.
    """
    for df in staged:
        path = _paths.pop(df, None)
        if path is not None:
            # A range, as an empty list of rows would start Python workers.
            empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
            df.sparkSession.range(0, 0, 1, 1).select(*empty).write.mode("overwrite").parquet(path)
