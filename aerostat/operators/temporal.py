"""Profiles over time, rolling means, and previous-row features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostat import schema as S
from aerostat.functions import calendar
from aerostat.functions.numeric import mean
from aerostat.operators.cleaning import present
from aerostat.plans import slices


def _low_high(column: str, low: str, high: str) -> list[Column]:
    return [F.round(F.min(column), 2).alias(low), F.round(F.max(column), 2).alias(high)]


def _pollutant_means(df: DataFrame, prefix: str, places: int | None = 2) -> list[Column]:
    return [mean(p, places).alias(f"{prefix}_{p}") for p in present(df, S.POLLUTANTS)]


def _mean_or_null(df: DataFrame, column: str, name: str) -> Column:
    value = mean(column, 2) if column in df.columns else F.lit(None).cast("double")
    return value.alias(name)


def hourly_profile(df: DataFrame) -> DataFrame:
    """Mean, least and greatest index and pollutant means per hour of day."""
    return (
        df.groupBy(F.hour(S.TIME).alias("hour"))
        .agg(
            mean("aqi", 2).alias("avg_aqi"),
            *_low_high("aqi", "min_aqi", "max_aqi"),
            F.count("*").alias("sample_count"),
            *_pollutant_means(df, "avg"),
        )
        .orderBy("hour")
    )


def daily_analytics(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.to_date(S.TIME).alias("date"))
        .agg(
            mean("aqi", 2).alias("mean_aqi"),
            *_low_high("aqi", "min_aqi", "max_aqi"),
            F.count("*").alias("total_readings"),
            *_pollutant_means(df, "mean"),
        )
        .orderBy("date")
    )


def monthly_analytics(df: DataFrame) -> DataFrame:
    """Grouped by two integers; the month's text is made once per group."""
    monthly = df.groupBy(F.year(S.TIME).alias("year"), F.month(S.TIME).alias("month")).agg(
        mean("aqi", 2).alias("mean_aqi"),
        F.round(F.max("aqi"), 2).alias("peak_aqi"),
        _mean_or_null(df, "pm2_5", "mean_pm2_5"),
        F.count("*").alias("record_count"),
    )
    text = F.when(F.col("year").isNotNull(), F.format_string("%04d-%02d", "year", "month"))
    return monthly.select(text.alias("year_month"), "*").orderBy("year_month")


def seasonal_analytics(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(calendar.season(F.col(S.TIME)).alias("season"))
        .agg(
            mean("aqi", 2).alias("mean_aqi"),
            *_low_high("aqi", "min_aqi", "max_aqi"),
            _mean_or_null(df, "pm2_5", "avg_pm2_5"),
            F.count("*").alias("total_records"),
        )
        .orderBy(F.col("mean_aqi").desc(), "season")
    )


def daily_trend(df: DataFrame) -> DataFrame:
    """Unrounded mean index per date, for a scope already filtered."""
    return df.groupBy(F.to_date(S.TIME).alias("date")).agg(mean("aqi").alias("mean_aqi")).orderBy("date")


def hour_curve(df: DataFrame) -> DataFrame:
    """Unrounded means per hour of day; an absent pollutant shows the index instead."""
    means = [mean(p if p in df.columns else "aqi").alias(f"avg_{p}") for p in S.POLLUTANTS]
    return (
        df.groupBy(F.hour(S.TIME).alias("hour")).agg(mean("aqi").alias("avg_aqi"), *means).orderBy("hour")
    )


def rolling_average(df: DataFrame, hours: int = 24, column: str = "aqi", width: int = slices.DAY) -> DataFrame:
    """``rolling_<h>h_avg_<column>`` over the last ``hours``, both ends included."""
    return slices.trailing_mean(df, column, hours * 3600, f"rolling_{hours}h_avg_{column}", 2, width)


def lag_value(df: DataFrame, column: str = "pm2_5", output: str | None = None, width: int = slices.DAY) -> DataFrame:
    """The station's previous value of a column."""
    output = output or f"prev_{column}"
    return slices.previous_rows(df, {"_prev": column}, 1, width).withColumnRenamed("_prev_1", output)


def jump_ratio(df: DataFrame, width: int = slices.DAY) -> DataFrame:
    """``pm25_jump_ratio``: value over previous value, 1.0 unless the previous exceeds 5."""
    previous = F.col("prev_pm2_5")
    ratio = F.when(previous > 5.0, F.round(F.col("pm2_5") / previous, 2)).otherwise(F.lit(1.0))
    return lag_value(df, "pm2_5", width=width).withColumn("pm25_jump_ratio", ratio)


# Default limits and labels.
def classify_anomalies(
    df: DataFrame, spike: float = 150.0, ratio: float = 3.0, width: int = slices.DAY
) -> DataFrame:
    """Tell sensor glitches from pollution events.

    A surge seen by other pollutants too is an event; a sudden surge of PM2.5 alone is
    suspect. The logic is three-valued: a NULL companion leaves a row unclassified.
    """
    high = F.col("pm2_5") > F.lit(spike)
    together = high & (
        (F.col("pm10") > F.col("pm2_5") * F.lit(1.1)) | (F.col("no2") > F.lit(50.0)) | (F.col("co") > F.lit(2.0))
    )
    alone = high & (F.col("pm25_jump_ratio") > F.lit(ratio)) & ~together
    label = (
        F.when(alone, F.lit("SENSOR_MALFUNCTION_SUSPECT"))
        .when(together, F.lit("ACUTE_POLLUTION_EVENT"))
        .otherwise(F.lit("NORMAL"))
    )
    return (
        jump_ratio(df, width)
        .withColumn("anomaly_classification", label)
        .withColumn("is_anomaly", F.col("anomaly_classification") != "NORMAL")
    )


def lag_features(df: DataFrame, target: str = "aqi", width: int = slices.DAY) -> DataFrame:
    """``lag_1_pm2_5`` and ``lag_1_aqi``; a station's first row takes its own values."""
    return _history(df, target, 1, width).select(*df.columns, "lag_1_pm2_5", "lag_1_aqi")


def rolling3_features(df: DataFrame, target: str = "aqi", width: int = slices.DAY) -> DataFrame:
    """Means of the three previous rows; a station's first row takes its own values."""
    return _history(df, target, 3, width).select(*df.columns, "rolling_3h_pm2_5_mean", "rolling_3h_aqi_mean")


def history_features(df: DataFrame, target: str = "aqi", width: int = slices.DAY) -> DataFrame:
    """Lag and rolling features in one pass, with their second names."""
    both = _history(df, target, 3, width)
    return both.withColumns(
        {
            "prev_pm2_5": F.col("lag_1_pm2_5"),
            "prev_aqi": F.col("lag_1_aqi"),
            "rolling_pm2_5_mean": F.col("rolling_3h_pm2_5_mean"),
            "rolling_aqi_mean": F.col("rolling_3h_aqi_mean"),
        }
    )


def _history(df: DataFrame, target: str, depth: int, width: int) -> DataFrame:
    sources = {"_pm2_5": "pm2_5", "_aqi": target}
    seen = slices.previous_rows(df, sources, depth, width)
    own = {"_pm2_5": F.col("pm2_5"), "_aqi": F.col(target)}
    out = {f"lag_1{n}": F.coalesce(F.col(f"{n}_1"), own[n]) for n in sources}
    for n in sources:
        values = [F.col(f"{n}_{j}") for j in range(1, depth + 1)]
        total = sum((F.coalesce(v, F.lit(0.0)) for v in values[1:]), F.coalesce(values[0], F.lit(0.0)))
        count = sum((v.isNotNull().cast("double") for v in values[1:]), values[0].isNotNull().cast("double"))
        out[f"rolling_3h{n}_mean"] = F.coalesce(F.try_divide(total, count), own[n])
    helpers = [f"{n}_{j}" for n in sources for j in range(1, depth + 1)]
    return seen.withColumns(out).drop(*helpers)
