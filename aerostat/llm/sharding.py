"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

How many rows part ``p`` sends to shard ``s`` of a uniformly random arrangement follows a
multivariate hypergeometric law. The driver draws that matrix from the row counts of the parts
alone; each part then permutes its own rows and deals them out by its line of the matrix, the rows
move once, and every shard permutes what it received. Shard sizes are exact by construction.

Parts are the files of a table staged in the shared folder, and a row is known by its file and its
place in it. Random order comes from a hash of both and the seed, so that a task that runs again
after a lost executor deals exactly as before.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostat.llm.common import fresh
from aerostat.plans.lineage import scratch_path

PART_ROWS = 1_000_000  # rows of a staged file at most
RUN_ROWS = 200_000  # rows that one task orders inside a shard, about
MIN_RUNS = 16  # runs of a shard at least, so that few shards still give many tasks
RUN_ID = "-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}"  # what differs in a staged file's name from run to run
NUMPY_LIMIT = 1_000_000_000  # numpy's own sampler takes populations below this


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good ones among ``draws`` from ``good + bad``, for populations of any size.

    Above numpy's limit the law is tabulated around its mode by its ratios and inverted; what lies
    further than 40 standard deviations away has a probability below the resolution of doubles.
    """
    total = good + bad
    if total < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws)) if draws else 0
    low, high = max(0, draws - bad), min(good, draws)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    share = good / total
    spread = math.sqrt(draws * share * (1 - share) * (total - draws) / max(total - 1, 1))
    reach = int(40 * spread) + 40
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    ratio = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(ratio)])
    weight = np.cumsum(np.exp(weight - weight.max()))
    return first + int(np.searchsorted(weight, rng.random() * weight[-1], side="right"))


def communication_matrix(parts: list[int], shards: list[int], seed: int) -> np.ndarray:
    """Rows that each part sends to each shard in a uniformly random arrangement.

    ``parts`` and ``shards`` have the same sum; so do the lines and columns of the result.
    """
    rng = np.random.default_rng(seed)
    matrix = np.zeros((len(parts), len(shards)), dtype=np.int64)
    left = list(shards)
    for p, n in enumerate(parts):
        room = sum(left)
        for s, free in enumerate(left):
            room -= free
            sent = hypergeometric(rng, free, room, n) if room else n
            matrix[p, s] = sent
            left[s] -= sent
            n -= sent
    return matrix


def shuffle_into_shards(df: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """The frame with ``shard`` and ``slot``: shards at most one row apart, slots gapless from 0.

    All columns are carried, whatever they hold; a column already called ``shard`` or ``slot`` is
    replaced. Repeated and null rows are rows like any other. An empty table gives an empty result.
    """
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    staged = scratch_path(spark, "shards")
    df.write.option("maxRecordsPerFile", PART_ROWS).parquet(staged)
    part, place, at, ends, draw, run, before = (
        fresh(df, n) for n in ("part", "place", "at", "ends", "draw", "run", "before")
    )
    rows = (
        spark.read.schema(df.schema)
        .parquet(staged)
        .select("*", F.regexp_replace("_metadata.file_name", RUN_ID, "").alias(part), F.col("_metadata.row_index").alias(place))
    )
    sizes = rows.groupBy(part).count().orderBy(part).collect()  # one row per file
    total = sum(r["count"] for r in sizes)
    wanted = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix([r["count"] for r in sizes], wanted, seed)
    lines = spark.createDataFrame(
        [(r[part], np.cumsum(line).tolist()) for r, line in zip(sizes, matrix)],
        f"{part} string, {ends} array<bigint>",
    )
    order = Window.partitionBy(part).orderBy(F.xxhash64(F.lit(seed), F.lit("deal"), part, place), place)
    dealt = (
        rows.withColumn(at, F.row_number().over(order) - 1)
        .join(lines, part)
        .withColumn("shard", F.size(F.filter(ends, lambda e: e <= F.col(at))).cast("int"))
        .drop(at, ends)
    )
    runs = max(MIN_RUNS, math.ceil(total / shards / RUN_ROWS))
    dealt = dealt.withColumn(draw, F.xxhash64(F.lit(seed), F.lit("slot"), part, place))
    dealt = dealt.withColumn(run, F.pmod(F.xxhash64(F.lit("run"), draw), F.lit(runs)))
    starts = dealt.groupBy("shard", run).count()
    starts = starts.select(
        "shard",
        run,
        (F.sum("count").over(Window.partitionBy("shard").orderBy(run)) - F.col("count")).alias(before),
    )
    inside = Window.partitionBy("shard", run).orderBy(draw, part, place)
    return (
        dealt.withColumn(at, F.row_number().over(inside) - 1)
        .join(starts, ["shard", run])
        .withColumn("slot", F.col(at) + F.col(before))
        .select(*df.columns, "shard", "slot")
    )


def write_shards(df: DataFrame, path: str, shards: int = 16, seed: int = 0) -> None:
    """Write the shuffled frame under ``path`` by shard, each file in slot order."""
    out = shuffle_into_shards(df, shards, seed)
    out.repartition("shard", F.floor(F.col("slot") / PART_ROWS)).sortWithinPartitions("shard", "slot").write.option(
        "maxRecordsPerFile", PART_ROWS
    ).partitionBy("shard").parquet(path)
