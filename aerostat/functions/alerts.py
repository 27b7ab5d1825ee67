"""Alert rules as column expressions over one reading and its predecessor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerostat import schema as S

# Names of the alerts; their texts are below.
RAPID, HAZARDOUS = "RAPID_CHANGE_ALERT", "HAZARDOUS_AQI_ALERT"
UNHEALTHY, SPIKE = "UNHEALTHY_AQI_ALERT", "PM25_SPIKE_ALERT"
MIN_PREVIOUS = 10.0


def pct_increase(pm2_5: Column, previous: Column) -> Column:
    """Percentage rise, NULL unless the previous value is above 10."""
    return F.when(previous > F.lit(MIN_PREVIOUS), (pm2_5 - previous) / previous * F.lit(100.0))


def alert_type(
    aqi: Column, pm2_5: Column, previous: Column, thresholds: dict[str, float] | None = None
) -> Column:
    """Hazardous beats rapid change, which beats unhealthy, which beats a spike."""
    limit = {**S.ALERT_THRESHOLDS, **(thresholds or {})}
    rise = pct_increase(pm2_5, previous)
    return (
        F.when(aqi.isNull(), F.lit(None).cast("string"))
        .when(aqi >= limit["aqi_hazardous"], F.lit(HAZARDOUS))
        .when(rise >= limit["rate_of_change_pct"], F.lit(RAPID))
        .when(aqi >= limit["aqi_unhealthy"], F.lit(UNHEALTHY))
        .when(pm2_5 >= limit["pm2_5_spike"], F.lit(SPIKE))
    )


def severity(kind: Column) -> Column:
    return F.when(kind == HAZARDOUS, F.lit("CRITICAL")).when(kind.isNotNull(), F.lit("WARNING"))


# The texts.
def message(kind: Column, station: Column, aqi: Column, pm2_5: Column, previous: Column) -> Column:
    """Text of the alert; numbers are rounded half-up to one place before printing."""

    def one(value: Column) -> Column:
        return F.format_string("%.1f", F.round(value, 1))

    name = station.cast("string")
    return (
        F.when(
            kind == RAPID,
            F.concat(
                F.lit("Rapid PM2.5 surge of +"),
                one(pct_increase(pm2_5, previous)),
                F.lit("% at "),
                name,
                F.lit(" ("),
                one(previous),
                F.lit(" -> "),
                one(pm2_5),
                F.lit(" ug/m3)"),
            ),
        )
        .when(
            kind == HAZARDOUS,
            F.concat(F.lit("Hazardous air quality detected at "), name, F.lit(": AQI = "), one(aqi)),
        )
        .when(
            kind == UNHEALTHY,
            F.concat(F.lit("Unhealthy air quality detected at "), name, F.lit(": AQI = "), one(aqi)),
        )
        .when(
            kind == SPIKE,
            F.concat(F.lit("Acute PM2.5 spike at "), name, F.lit(": PM2.5 = "), one(pm2_5), F.lit(" ug/m3")),
        )
    )


def alert_id(station: Column, ts: Column, kind: Column) -> Column:
    """Reproducible identity: the same alert gets the same id in every run."""
    seconds = F.unix_micros(ts.cast("timestamp")).cast("string")
    return F.sha2(F.concat_ws("~", station.cast("string"), seconds, kind), 256)
