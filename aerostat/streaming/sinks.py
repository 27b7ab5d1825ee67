"""Running a stream to a table: drained runs with checkpoints, no data through the driver.

Runs wait until their input is drained. Only ``bounded_run`` takes a time limit, and it tells its
caller whether the input was drained; nothing returns a part of the data in silence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from aerostat.plans import lineage


def _finish(query: StreamingQuery, seconds: float | None = None) -> bool:
    """Wait for the query to drain its input; false if it was stopped because its time was up."""
    try:
        drained = query.awaitTermination(seconds) if seconds is not None else query.awaitTermination() or True
    finally:
        if query.isActive:
            query.stop()
    if query.exception() is not None:
        raise query.exception()
    return bool(drained)


def batch_run(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Give each micro-batch to ``handle(frame, batch_id)``, which must be idempotent per id."""
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(handle)
    )
    query = writer.start()
    _finish(query)
    return query


def bounded_run(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    seconds: float | None = None,
    fmt: str = "parquet",
    name: str | None = None,
) -> tuple[StreamingQuery, bool]:
    """Append what is available as files under ``path``; the query, and whether its input was drained.

    With ``seconds`` the query is stopped when its time is up. The file sink and the checkpoint
    together give each row once, so a run that was stopped goes on where it ended.
    """
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if name:
        writer = writer.queryName(name)
    query = writer.start(path)
    return query, _finish(query, seconds)


def bounded_table(
    stream: DataFrame, seconds: float | None = None, view: str | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Run the stream into a new table in the shared folder and return the whole table.

    Raises ``TimeoutError`` if a time limit is given and the input is not drained by then.
    """
    spark = stream.sparkSession
    path = lineage.scratch_path(spark, "stream")
    _, drained = bounded_run(stream, path, checkpoint or lineage.scratch_path(spark, "offsets"), seconds)
    if not drained:
        raise TimeoutError(f"the stream was not drained within {seconds} s; {path} holds a part of it")
    table = spark.read.schema(stream.schema).parquet(path)
    if view:
        table.createOrReplaceTempView(view)
    return table


def snapshot_run(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the full result of an aggregation after each micro-batch under ``path/batch_id=<id>``.

    A batch writes a folder of its own, which Spark marks when it is complete, so readers never
    meet a half-written table, and a failed write leaves its predecessor. A repeated batch
    overwrites its own folder. :func:`latest_snapshot` finds the newest.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return batch_run(stream, keep, checkpoint, "complete")


def latest_snapshot(like: DataFrame, path: str) -> DataFrame:
    """The newest complete snapshot under ``path``, empty if there is none yet."""
    spark = like.sparkSession
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{path}/*/_SUCCESS")
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place) or []
    folders = [f.getPath().getParent() for f in found]
    if not folders:
        return spark.createDataFrame([], like.schema)
    newest = max(folders, key=lambda p: int(p.getName().partition("=")[2]))
    return spark.read.schema(like.schema).parquet(newest.toString())


def snapshot_table(stream: DataFrame) -> DataFrame:
    spark = stream.sparkSession
    path = lineage.scratch_path(spark, "snapshot")
    snapshot_run(stream, path, lineage.scratch_path(spark, "offsets"))
    return latest_snapshot(stream, path)


def memory_run(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Run into an in-memory table on the driver: for small aggregated results only."""
    writer = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    spark = stream.sparkSession
    _finish(writer.option("checkpointLocation", lineage.scratch_path(spark, "offsets")).start())
    return spark.sql(f"SELECT * FROM `{name}`")


def report_run(stream: DataFrame, alerts_path: str, rows_path: str, is_alert, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch's rows as CSV and its alert rows as JSON.

    Every batch owns a folder named after its id: a repeated batch overwrites its own files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        part = f"batch_id={batch_id}"
        batch.write.mode("overwrite").option("header", True).csv(f"{rows_path}/{part}")
        batch.filter(is_alert).write.mode("overwrite").json(f"{alerts_path}/{part}")

    return batch_run(stream, write, checkpoint)


class LateRows(StreamingQueryListener):
    """Counts what stateful operators drop behind the watermark, over all micro-batches.

    Spark counts after its partial aggregation: one unit is a group of a task's late rows that
    share window and keys, so ``total`` is a lower bound of the readings. Register it with
    ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self) -> None:
        self.total = 0
        self.batches = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.batches += 1
        self.total += sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
