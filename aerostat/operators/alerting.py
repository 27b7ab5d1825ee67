"""Alerts over a table: previous reading, rules, payload, and reports of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostat import schema as S
from aerostat.functions import alerts as A
from aerostat.functions.numeric import mean
from aerostat.plans import slices

PAYLOAD = ["alert_id", S.STATION, S.TIME, "alert_type", "severity", "aqi", "pm2_5", "message"]


def previous_reading(df: DataFrame, width: int = slices.DAY) -> DataFrame:
    """``prev_pm2_5``: the station's last PM2.5 that came with an index, before this row."""
    complete = F.when(F.col("aqi").isNotNull(), F.col("pm2_5"))
    return slices.last_known(df, {"prev_pm2_5": complete}, include_current=False, width=width)


def apply_rules(df: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """``alert_type`` and ``severity`` of rows that carry ``prev_pm2_5``; NULL when quiet."""
    kind = A.alert_type(F.col("aqi"), F.col("pm2_5"), F.col("prev_pm2_5"), thresholds)
    return df.withColumn("alert_type", kind).withColumn("severity", A.severity(F.col("alert_type")))


def payload(ruled: DataFrame) -> DataFrame:
    """Alert records of the rows on which a rule fired."""
    fired = ruled.filter(F.col("alert_type").isNotNull())
    station, ts, kind = F.col(S.STATION), F.col(S.TIME), F.col("alert_type")
    text = A.message(kind, station, F.col("aqi"), F.col("pm2_5"), F.col("prev_pm2_5"))
    return fired.select(
        A.alert_id(station, ts, kind).alias("alert_id"),
        S.STATION,
        S.TIME,
        "alert_type",
        "severity",
        F.round("aqi", 1).alias("aqi"),
        F.round("pm2_5", 1).alias("pm2_5"),
        text.alias("message"),
    )


def alerts(
    df: DataFrame, thresholds: dict[str, float] | None = None, width: int = slices.DAY
) -> DataFrame:
    """All alerts of a table of indexed readings."""
    return payload(apply_rules(previous_reading(df, width), thresholds))


def with_generation_time(alert_rows: DataFrame) -> DataFrame:
    return alert_rows.withColumn("generated_at", F.current_timestamp())


def alert_type_counts(alert_rows: DataFrame) -> DataFrame:
    return alert_rows.groupBy("alert_type").agg(F.count("*").alias("count"))


def recent_alerts(alert_rows: DataFrame, n: int = 15) -> DataFrame:
    """The first alerts by time: a distributed top-k, not a full sort."""
    return alert_rows.orderBy(S.TIME, S.STATION, "alert_type").limit(n)


def latest_records(df: DataFrame, n: int = 10) -> DataFrame:
    return df.orderBy(F.col(S.TIME).desc(), S.STATION).limit(n)


def sample_rows(df: DataFrame, keys: list[str], n: int = 1000, seed: int = 42) -> DataFrame:
    """A reproducible sample: the rows whose keys hash lowest under the seed.

    The hash is SHA-256 of seed and keys, joined by ``|``, times as microseconds: any engine has it.
    """
    kinds = dict(df.dtypes)
    parts = [F.unix_micros(F.col(k).cast("timestamp")) if kinds[k].startswith("timestamp") else F.col(k) for k in keys]
    text = F.concat_ws("|", F.lit(seed).cast("string"), *[p.cast("string") for p in parts])
    return df.orderBy(F.sha2(text, 256), *keys).limit(n)


def station_statistics(df: DataFrame) -> DataFrame:
    """Per station: readings, mean and greatest index and PM2.5 to one place."""
    return df.groupBy(S.STATION).agg(
        F.count("*").alias("readings_count"),
        mean("aqi", 1).alias("avg_aqi"),
        F.round(F.max("aqi"), 1).alias("max_aqi"),
        mean("pm2_5", 1).alias("avg_pm2_5"),
        F.round(F.max("pm2_5"), 1).alias("max_pm2_5"),
    )
