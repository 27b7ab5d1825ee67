"""Bringing readings, weather and station metadata together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostat import schema as S
from aerostat.operators.cleaning import deduplicate

WEATHER_PREFIX = "weather_"
STATION_PREFIX = "station_meta_"


def prefix_collisions(right: DataFrame, left: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """Rename the right side's non-key columns that the left side also has."""
    taken = set(left.columns) - set(keys)
    return right.select(*[F.col(c).alias(prefix + c) if c in taken else F.col(c) for c in right.columns])


def join_exact(readings: DataFrame, weather: DataFrame) -> DataFrame:
    """Readings with the weather of the same station and timestamp, where there is one."""
    keys = [S.STATION, S.TIME]
    return readings.join(prefix_collisions(weather, readings, keys, WEATHER_PREFIX), keys, "left")


def join_hourly(readings: DataFrame, weather: DataFrame) -> DataFrame:
    """Readings with one weather row of the same station and hour.

    The weather side is cut to one row per station and hour first, so an hour full of
    readings never multiplies; that side of the join is one row per key.
    """
    keys = [S.STATION, "_hour"]
    hour = F.date_trunc("hour", S.TIME)
    by_hour = prefix_collisions(weather, readings, [S.STATION, S.TIME], WEATHER_PREFIX)
    by_hour = deduplicate(by_hour.withColumn("_hour", hour).drop(S.TIME), keys)
    return (
        readings.withColumn("_hour", hour)
        .join(by_hour, keys, "left")
        .drop("_hour")
        .select(*readings.columns, *[c for c in by_hour.columns if c not in keys])
    )


def join_stations(fact: DataFrame, stations: DataFrame) -> DataFrame:
    """Fact rows with their station's metadata.

    No broadcast is forced: the optimizer broadcasts a dimension whose measured size is
    below the session's threshold, and AQE splits the busy stations of a sort-merge join.
    """
    keys = [S.STATION]
    return fact.join(prefix_collisions(stations, fact, keys, STATION_PREFIX), keys, "left")


def integrate(
    readings: DataFrame, weather: DataFrame, stations: DataFrame, alignment: str = "exact"
) -> DataFrame:
    if alignment not in ("exact", "hourly"):
        raise ValueError(f"alignment must be 'exact' or 'hourly', not {alignment!r}")
    join = join_exact if alignment == "exact" else join_hourly
    return join_stations(join(readings, weather), stations)


def join_report(
    readings: DataFrame,
    weather: DataFrame,
    stations: DataFrame,
    integrated: DataFrame,
    alignment: str = "exact",
) -> DataFrame:
    """One row of input and output counts.

    ``matched_stations`` counts the stations of the integrated table, known to the
    dimension or not; ``known_stations`` and ``unknown_stations`` tell them apart.
    """
    per_station = integrated.groupBy(S.STATION).agg(F.count("*").alias("n"))
    known = stations.select(S.STATION).distinct().withColumn("_known", F.lit(True))
    fact = per_station.join(known, S.STATION, "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("integrated_records"),
        F.count("*").alias("matched_stations"),
        F.count("_known").alias("known_stations"),
        F.count_if(F.col("_known").isNull()).alias("unknown_stations"),
    )
    return fact.select(
        _rows(readings).alias("air_quality_records"),
        _rows(weather).alias("weather_records"),
        _rows(stations).alias("station_count"),
        "*",
        F.lit(alignment).alias("temporal_alignment"),
    )


def _rows(df: DataFrame) -> Column:
    return df.agg(F.count("*").alias("n")).scalar()
