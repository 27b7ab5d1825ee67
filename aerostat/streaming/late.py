"""The readings that a windowed aggregation leaves out because they came too late.

Spark tells only how many groups it dropped, after its partial aggregation. Here the readings
themselves go to a table beside the aggregation: every micro-batch keeps the latest event time it
saw in a folder of its own, and what earlier batches saw gives the watermark of the next ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat import schema as S
from aerostat.streaming import sinks

_SEEN = "latest timestamp, batch_id long"


def late_run(
    stream: DataFrame, path: str, checkpoint: str, watermark: str = S.WATERMARK, window: str = S.WINDOW, time: str = S.TIME
) -> DataFrame:
    """Drain the stream and return the readings whose window was closed when they came.

    The rule is that of an aggregation over tumbling ``window``s behind the same ``watermark`` that
    reads the same micro-batches: a reading of batch n is late if its window ended at or before the
    latest event time of the batches up to n - 2, less the delay. ``batch_id`` tells when it came.
    Readings without a time are never late. Batches are idempotent, so a run can be resumed.
    """
    spark = stream.sparkSession
    nothing = spark.createDataFrame([], stream.schema)
    nothing.write.mode("overwrite").parquet(f"{path}/late/batch_id=-1")
    spark.createDataFrame([], "latest timestamp").write.mode("overwrite").parquet(f"{path}/seen/batch_id=-1")

    def split(batch: DataFrame, batch_id: int) -> None:
        seen = batch.sparkSession.read.schema(_SEEN).parquet(f"{path}/seen")
        closed = seen.filter(F.col("batch_id") < batch_id - 1).agg(
            (F.date_trunc("millisecond", F.max("latest")) - F.expr(f"INTERVAL {watermark}")).alias("closed")
        )
        late = batch.filter(F.window(time, window)["end"] <= closed.scalar())
        late.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        latest = batch.agg(F.max(time).cast("timestamp").alias("latest"))
        latest.write.mode("overwrite").parquet(f"{path}/seen/batch_id={batch_id}")

    sinks.batch_run(stream, split, checkpoint)
    return spark.read.schema(T.StructType([*stream.schema, T.StructField("batch_id", T.LongType())])).parquet(f"{path}/late")
