"""Exact de-duplication by skew-safe combining, with DataFrame operations only.

Copies are combined three times and every time by digest *and* full text, so that neither a
digest collision nor a popular text matters:

1. inside each task, before anything is shuffled (the map side of the salted aggregation);
2. per (salt, digest, text), which deals the copies of a popular text to many tasks;
3. over the salt winners of a digest.

The verdicts that the documents are joined with have one row per text and hold the text only
where two texts share a digest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostat.llm.common import whole
from aerostat.plans.lineage import materialise

SALTS = 16


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(whole(text), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept`` and the text's digest.

    Of equal normalised texts the smallest id stays. Null and empty texts are equal. Rows that
    repeat an id and a text count one by one in ``group_size`` but stay or go together; null ids
    are never the smallest, and stay only where the text has no other. Columns besides the id and
    the text are not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    rows = rows.select("id", "norm", digest(F.col("norm")).alias("digest"))
    salted = (
        rows.withColumn("salt", F.spark_partition_id() % salts)
        .groupBy("salt", "digest", "norm")
        .agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"))
    )
    texts = (
        salted.repartition(F.col("digest"))
        .groupBy("digest", "norm")
        .agg(F.min("low").alias("keep_id"), F.sum("n").alias("group_size"))
        .withColumn("shared", F.count(F.lit(1)).over(Window.partitionBy("digest")) > 1)
    )
    verdicts = materialise(texts.withColumn("norm", F.when(F.col("shared"), F.col("norm"))), "exact-dedup")
    plain = rows.select("id", "digest").join(verdicts.filter(~F.col("shared")).drop("norm", "shared"), "digest")
    clash = verdicts.filter("shared")
    if not clash.isEmpty():
        clash = clash.drop("shared")
        plain = plain.unionByName(rows.join(clash, ["digest", "norm"]).drop("norm"))
    return plain.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "digest",
    )
