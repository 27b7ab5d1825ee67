"""Event-time windows per station; they accept streams and static tables alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostat import schema as S
from aerostat.functions.numeric import mean


def _windowed(df: DataFrame, watermark: str | None, window: str, slide: str | None, measures: list[Column]):
    if watermark:
        df = df.withWatermark(S.TIME, watermark)
    when = F.window(S.TIME, window, slide or window)
    return (
        df.groupBy(when.alias("window"), S.STATION)
        .agg(*measures)
        .withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
        .drop("window")
    )


def window_pollutants(
    df: DataFrame, watermark: str | None = S.WATERMARK, window: str = S.WINDOW, slide: str | None = S.SLIDE
) -> DataFrame:
    """Mean and greatest PM2.5, means of the other pollutants, and readings per window.

    Without ``slide`` the windows are tumbling.
    """
    others = [mean(p, 2).alias(f"avg_{p}") for p in S.POLLUTANTS[1:]]
    return _windowed(
        df,
        watermark,
        window,
        slide,
        [
            mean("pm2_5", 2).alias("avg_pm2_5"),
            F.round(F.max("pm2_5"), 2).alias("max_pm2_5"),
            *others,
            F.count("*").alias("window_readings_count"),
        ],
    )


def window_aqi(
    df: DataFrame, watermark: str | None = None, window: str = S.WINDOW, slide: str | None = S.SLIDE
) -> DataFrame:
    """Readings, mean and greatest index and PM2.5 per window, to one place."""
    return _windowed(
        df,
        watermark,
        window,
        slide,
        [
            F.count("*").alias("record_count"),
            mean("aqi", 1).alias("avg_aqi"),
            F.round(F.max("aqi"), 1).alias("max_aqi"),
            mean("pm2_5", 1).alias("avg_pm2_5"),
            F.round(F.max("pm2_5"), 1).alias("max_pm2_5"),
        ],
    )
