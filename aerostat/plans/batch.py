"""The end-to-end batch flow, with every shared stage stored once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from aerostat.operators import cleaning, forecasting, indexing, joining, scorecard, spatial, statistics, temporal
from aerostat.plans import slices
from aerostat.sources import files


@dataclass
class Paths:
    """Where a run keeps its tables, under one shared directory."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}.parquet"

    def report(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/reports/{name}"


def integrated_fact(
    readings: DataFrame,
    weather: DataFrame,
    stations: DataFrame,
    standard: str = "US_EPA",
    alignment: str = "exact",
) -> DataFrame:
    """Cleaned inputs joined and enriched, lazily."""
    joined = joining.integrate(readings, weather, stations, alignment)
    return indexing.aqi_enrich(indexing.ratio_features(indexing.temporal_features(joined)), standard)


def run_batch(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    out: str,
    standard: str = "US_EPA",
    alignment: str = "exact",
    quantile_method: str = "exact",
    width: int = slices.DAY,
    models: bool = False,
) -> dict[str, DataFrame]:
    """Clean, integrate, index, classify, and write the fact table and all reports.

    Cleaned inputs and the fact table are written before they are used more than once, so
    an executor lost later never replays the raw scan. ``scorecard`` gathers the run's
    numbers; those of the fact table are observed while it is written. With ``models`` both
    forecasting models are trained on it, saved with their summaries under ``models``, and their
    predictions written; that needs complete rows before and after the cut-off.
    """
    paths = Paths(out)

    def store(df: DataFrame, name: str, **options) -> DataFrame:
        files.write_parquet(df, paths.table(name), **options)
        return spark.read.parquet(paths.table(name))

    raw_readings, raw_weather, raw_stations = (sources[n] for n in ("air_quality", "weather", "stations"))
    readings = store(cleaning.clean_readings(raw_readings, width, quantile_method, audit=True), "clean_readings")
    weather = store(cleaning.clean_weather(raw_weather, width, audit=True), "clean_weather")
    stations = store(cleaning.clean_stations(raw_stations), "clean_stations")
    helpers = [c for c in {*readings.columns, *weather.columns} if c.startswith("_")]
    fact = integrated_fact(readings.drop(*helpers), weather.drop(*helpers), stations, standard, alignment)
    watch = Observation("fact")
    fact = store(
        temporal.classify_anomalies(fact, width=width),
        "integrated",
        partition_by=["year", "month"],
        cluster=True,
        observe=(watch, scorecard.fact_metrics(standard)),
    )
    tables = {
        "hourly_profile": temporal.hourly_profile(fact),
        "daily_analytics": temporal.daily_analytics(fact),
        "monthly_analytics": temporal.monthly_analytics(fact),
        "seasonal_analytics": temporal.seasonal_analytics(fact),
        "station_summary": spatial.station_summary(fact),
        "city_summary": spatial.city_summary(fact),
        "state_summary": spatial.state_summary(fact),
        "geo_rollup": spatial.geo_rollup(fact),
        "station_rank": spatial.station_rank(fact),
        "hotspots": spatial.hotspots(fact),
    }
    reports = {
        "quality_air_quality": statistics.quality_report(
            raw_readings, readings, "Air Quality", cleaning.S.POLLUTANTS
        ),
        "quality_weather": statistics.quality_report(raw_weather, weather, "Weather", cleaning.S.WEATHER),
        "quality_stations": statistics.quality_report_stations(raw_stations),
        "join": joining.join_report(readings, weather, stations, fact, alignment),
        "aqi_statistics": statistics.aqi_statistics(fact),
        "category_distribution": statistics.category_distribution(fact),
        "dominance_distribution": statistics.dominance_distribution(fact),
        "correlations": statistics.correlation_matrix(fact),
    }
    if models:
        outcome = forecasting.train_and_evaluate(fact)
        forecasting.save_models(spark, outcome, f"{paths.root.rstrip('/')}/models")
        tables["predictions"] = outcome.predictions
        reports["models"] = forecasting.metrics_table(spark, outcome)
    for name, df in reports.items():
        files.write_report(df, paths.report(name))
    reports = {n: files.read_json(spark, paths.report(n), df.schema) for n, df in reports.items()}
    tables = {n: store(df, n) for n, df in tables.items()}
    parts = [
        scorecard.observed_section(spark, watch.get, standard),
        *[scorecard.section(reports[n], n, ["metric"]) for n in reports if n.startswith("quality_")],
        scorecard.section(reports["join"], "join", []),
        scorecard.section(reports["correlations"], "correlations", ["var_a", "var_b"]),
        scorecard.section(tables["seasonal_analytics"], "seasonal_summary", ["season"]),
        scorecard.section(tables["city_summary"], "city_summary", ["city"]),
        scorecard.section(tables["state_summary"], "state_summary", ["state"]),
    ]
    if models:
        parts.append(scorecard.model_section(spark, outcome))
    card = scorecard.scorecard(parts)
    files.write_report(card, paths.report("scorecard"))
    card = files.read_json(spark, paths.report("scorecard"), card.schema)
    return {"integrated": fact, **tables, **reports, "scorecard": card}
