"""Row-level enrichment: air-quality index, calendar and ratio features, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostat import schema as S
from aerostat.functions import calendar
from aerostat.functions import index as ix
from aerostat.operators.cleaning import present


def sub_indices(df: DataFrame, standard: str = "US_EPA", gap_policy: str = "null") -> DataFrame:
    """``sub_index_<p>`` and ``extrapolated_sub_<p>`` for every pollutant column."""
    S.categories(standard)
    pollutants = present(df, S.POLLUTANTS)
    # One projection per step: a value used several times is computed once.
    numbers = df.withColumns({f"_n_{p}": ix.bracket_number(p, p, standard, gap_policy) for p in pollutants})
    lines = numbers.withColumns(
        {
            f"extrapolated_sub_{p}": ix.bracket_line(p, f"_n_{p}", p, standard, gap_policy)
            for p in pollutants
        }
    )
    return lines.withColumns(
        {
            f"sub_index_{p}": ix.sub_index(p, p, standard, gap_policy, line=f"extrapolated_sub_{p}")
            for p in pollutants
        }
    ).drop(*[f"_n_{p}" for p in pollutants])


def research_sub_indices(df: DataFrame, standard: str = "US_EPA") -> DataFrame:
    return df.withColumns(
        {f"research_sub_{p}": ix.research_sub_index(p, p, standard) for p in present(df, S.POLLUTANTS)}
    )


def aqi_enrich(df: DataFrame, standard: str = "US_EPA", gap_policy: str = "null") -> DataFrame:
    """Sub-indices, overall and extrapolated index, exceedance, dominant pollutant, category.

    Narrow: a chain of projections that stays inside one code-generated stage, the same
    for a batch and for a stream.
    """
    pollutants = present(df, S.POLLUTANTS)
    if pollutants:
        beyond = ix.beyond_table(pollutants, standard)
        totals = {
            "aqi": ix.overall_index([f"sub_index_{p}" for p in pollutants]),
            "extrapolated_aqi": ix.highest([f"extrapolated_sub_{p}" for p in pollutants]),
        }
    else:
        beyond = F.lit(False)
        totals = {name: F.lit(None).cast("double") for name in ("aqi", "extrapolated_aqi")}
    flags = {"is_aqi_out_of_range": beyond, "aqi_exceedance_flag": beyond}
    enriched = sub_indices(df, standard, gap_policy).withColumns({**totals, **flags})
    labels = {"dominant_pollutant": ix.dominant(pollutants), "aqi_category": ix.category_label(standard=standard)}
    return enriched.withColumns(labels).drop(*[f"extrapolated_sub_{p}" for p in pollutants])


def category_details(df: DataFrame, standard: str = "US_EPA", column: str = "aqi") -> DataFrame:
    """Category, colour and advice of an index column."""
    return df.withColumn("_info", ix.category_info(column, standard)).select(*df.columns, "_info.*")


def temporal_features(df: DataFrame, column: str = S.TIME) -> DataFrame:
    ts = F.col(column)
    return df.withColumns(
        {
            "year": F.year(ts),
            "month": F.month(ts),
            "day": F.dayofmonth(ts),
            "hour": F.hour(ts),
            "day_of_week": F.dayofweek(ts),
            "is_weekend": F.coalesce(calendar.is_weekend(ts), F.lit(False)),
        }
    )


def ratio_features(df: DataFrame) -> DataFrame:
    if not {"pm2_5", "pm10"} <= set(df.columns):
        return df
    return df.withColumn(
        "pm_ratio", F.when(F.col("pm10") > 0, F.round(F.col("pm2_5") / F.col("pm10"), 3))
    )


def season_label(df: DataFrame, column: str = S.TIME) -> DataFrame:
    return df.withColumn("season", calendar.season(F.col(column)))
