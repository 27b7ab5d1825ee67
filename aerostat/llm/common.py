"""Column helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole(text: Column) -> Column:
    """The text, or the empty one for null."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only: other letters keep their case whatever the locale."""
    return F.translate(text, UPPER, UPPER.lower())


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key's decimal text modulo ``modulus``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand at most so many rows at a time to Python in this session: texts are long, and a worker
    holds a batch several times over."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)
