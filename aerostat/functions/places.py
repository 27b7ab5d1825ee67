"""Geographic scope, coordinates and severity labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Choices that mean "no restriction" at each level.
ANY_STATE = {"All", "All India", "National"}
ANY_CITY = {"All", "All Cities"}
ANY_STATION = {"All", "All Stations"}

# View of the whole country when no station is in scope.
DEFAULT_VIEW = (22.5937, 78.9629, 4.1)


def same_text(column: Column, wanted: str) -> Column:
    return F.lower(column) == F.lit(wanted.lower())


def valid_position(latitude: Column, longitude: Column) -> Column:
    return latitude.between(-90.0, 90.0) & longitude.between(-180.0, 180.0)


# Spreads in degrees and zoom steps.
def zoom_level(stations: Column, spread: Column) -> Column:
    return (
        F.when((stations == 1) | (spread < 0.05), F.lit(12.5))
        .when(spread < 0.4, F.lit(10.5))
        .when(spread < 2.0, F.lit(7.5))
        .when(spread < 6.0, F.lit(5.8))
        .when(spread < 15.0, F.lit(4.8))
        .otherwise(F.lit(4.1))
    )


# Weights of the score, limits and labels of its levels.
def hotspot_score(unhealthy_pct: Column, mean_aqi: Column) -> Column:
    return F.round(unhealthy_pct * F.lit(0.6) + mean_aqi / F.lit(500.0) * F.lit(100.0) * F.lit(0.4), 2)


def hotspot_level(score: Column) -> Column:
    return (
        F.when(score >= 60.0, F.lit("Critical Hotspot"))
        .when(score >= 35.0, F.lit("Moderate Hotspot"))
        .when(score >= 15.0, F.lit("Low Hotspot"))
        .otherwise(F.lit("Clean / Compliant"))
    )
