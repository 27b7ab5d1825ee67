"""Alerts on a stream: one number of state per station, rules as column expressions.

``alert_table_run`` is the one to use: it keeps the state in a table and splits even a station
that fills a micro-batch. ``alert_stream`` keeps it in Spark's state store and gives a streaming
frame, but hands a station's rows of one micro-batch to one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from aerostat import schema as S
from aerostat.operators import alerting
from aerostat.plans import lineage, slices
from aerostat.streaming import sinks


def alert_stream(indexed: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """Alert records of a stream of indexed readings.

    Only the previous PM2.5 needs Python: the function below adds it to four narrow columns,
    vectorised over a station's rows of one micro-batch, whose size the source limits. Rows
    are put in time order within a micro-batch; between micro-batches arrival order counts.
    """
    station = indexed.schema[S.STATION].dataType.simpleString()
    columns = f"{S.STATION} {station}, {S.TIME} timestamp, aqi double, pm2_5 double"
    seen = (
        indexed.select(S.STATION, S.TIME, "aqi", "pm2_5")
        .groupBy(S.STATION)
        .applyInPandasWithState(
            _add_previous,
            f"{columns}, prev_pm2_5 double",
            "pm2_5 double",
            "append",
            GroupStateTimeout.NoTimeout,
        )
    )
    # Arrow turns missing doubles into NaN; comparisons must see NULL.
    doubles = ["aqi", "pm2_5", "prev_pm2_5"]
    clean = seen.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})
    return alerting.payload(alerting.apply_rules(clean, thresholds))


def _add_previous(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    carried = state.get[0] if state.exists else None
    rows = pd.concat(list(frames), ignore_index=True).sort_values(S.TIME, kind="stable")
    known = rows["pm2_5"].where(rows["aqi"].notna()).ffill()
    if carried is not None:
        known = known.fillna(carried)
    previous = known.shift(1)
    if carried is not None:
        previous.iloc[0] = carried
    last = known.iloc[-1]
    if pd.notna(last):
        state.update((float(last),))
    yield rows.assign(prev_pm2_5=previous)


def alert_table_run(
    indexed: DataFrame,
    path: str,
    checkpoint: str,
    thresholds: dict[str, float] | None = None,
    width: int = slices.DAY,
    keep_rows: bool = False,
) -> StreamingQuery:
    """Write the alerts of a stream under ``path/alerts``, micro-batch by micro-batch.

    With ``keep_rows`` the rows are written too, as CSV under ``path/rows``.

    Each micro-batch runs the batch operator, whose windows are sliced, and takes what came
    before it from a table with the last PM2.5 of each station. Two state folders alternate:
    a repeated micro-batch reads the one its predecessor left and overwrites its own output.
    """
    key = indexed.schema[S.STATION]
    state_schema = f"{S.STATION} {key.dataType.simpleString()}, last_pm2_5 double"

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Two staging folders alternate, so a long stream leaves no copy per micro-batch.
        staged, narrow = f"{path}/staged/{batch_id % 2}", batch.select(S.STATION, S.TIME, "aqi", "pm2_5")
        narrow.write.mode("overwrite").parquet(staged)
        rows = spark.read.schema(narrow.schema).parquet(staged)
        if batch_id:
            known = spark.read.schema(state_schema).parquet(f"{path}/state/{(batch_id - 1) % 2}")
        else:
            known = spark.createDataFrame([], state_schema)
        seen = alerting.previous_reading(rows, width).join(known, S.STATION, "left")
        seen = seen.withColumn("prev_pm2_5", F.coalesce("prev_pm2_5", "last_pm2_5")).drop("last_pm2_5")
        found = alerting.payload(alerting.apply_rules(seen, thresholds))
        found.write.mode("overwrite").parquet(f"{path}/alerts/batch_id={batch_id}")
        if keep_rows:
            rows.write.mode("overwrite").option("header", True).csv(f"{path}/rows/batch_id={batch_id}")
        complete = F.when(F.col("aqi").isNotNull(), F.col("pm2_5"))
        newest = (
            rows.groupBy(S.STATION)
            .agg(*slices.last_value_summary({"last_pm2_5": complete}))
            .filter(F.col("last_pm2_5").isNotNull())
        )
        state = known.join(newest, S.STATION, "left_anti").unionByName(newest)
        state.write.mode("overwrite").parquet(f"{path}/state/{batch_id % 2}")

    return sinks.batch_run(indexed, handle, checkpoint)


def alert_table(indexed: DataFrame) -> DataFrame:
    """Run :func:`alert_table_run` into the shared folder and return all alerts."""
    spark = indexed.sparkSession
    path = lineage.scratch_path(spark, "alerts")
    alert_table_run(indexed, path, lineage.scratch_path(spark, "offsets"))
    return spark.read.parquet(f"{path}/alerts").drop("batch_id")


ROW = f"{S.STATION} string, {S.TIME} timestamp, aqi double, pm2_5 double"


def stream_report(indexed: DataFrame, path: str, checkpoint: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Run the alerts of a stream and report on it: rows as CSV, alerts and statistics as JSON.

    Returns the alerts, the statistics per station, and counts as rows ``(kind, name, n)``: rows,
    stations, and alerts by type. All of it is read back from files under ``path``.
    """
    spark = indexed.sparkSession
    alert_table_run(indexed, path, checkpoint, keep_rows=True)
    found = spark.read.parquet(f"{path}/alerts").drop("batch_id")
    rows = spark.read.schema(ROW).option("header", True).csv(f"{path}/rows/*")
    statistics = alerting.station_statistics(rows)
    statistics.write.mode("overwrite").json(f"{path}/statistics")
    statistics = spark.read.schema(statistics.schema).json(f"{path}/statistics")
    counts = alerting.alert_type_counts(found).select(F.lit("alerts").alias("kind"), F.col("alert_type").alias("name"), F.col("count").alias("n"))
    for kind, table in (("rows", rows), ("stations", statistics)):
        counts = counts.unionByName(table.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), F.lit("all").alias("name"), "n"))
    return found, statistics, counts
