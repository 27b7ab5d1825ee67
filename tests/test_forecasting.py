"""Chronological split and model training on small tables."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aerostat import schema as S
from aerostat.operators import forecasting, statistics
from aerostat.plans import batch

T0 = datetime(2026, 1, 1)


def test_split_is_chronological(spark):
    df = spark.createDataFrame([(h, T0 + timedelta(hours=h)) for h in range(10)], "h int, timestamp timestamp")
    train, test = forecasting.chronological_split(df, 0.8)
    assert (train.count(), test.count()) == (8, 2)
    assert train.agg(F.max("timestamp")).first()[0] < test.agg(F.min("timestamp")).first()[0]


def test_train_save_and_load(spark, tmp_path):
    n = F.col("id")
    rows = spark.range(200).select(
        (n % 2).alias("station_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + n * 1800).alias("timestamp"),
        (n % 50).cast("double").alias("pm2_5"),
        (n % 30).cast("double").alias("pm10"),
        (F.lit(2.0) * (n % 50) + F.lit(10.0)).alias("aqi"),
    )
    out = forecasting.train_and_evaluate(rows)
    assert out.train_records + out.test_records == 200 and out.test_records == 40
    assert out.scores["linear_regression"]["r2"] > 0.9
    assert out.predictions.columns == [
        "station_id",
        "timestamp",
        "actual_aqi",
        "predicted_aqi_lr",
        "predicted_aqi_rf",
        "predicted_aqi",
        "best_predicted_aqi",
        "model",
        "prediction_error",
    ]
    assert forecasting.metrics_table(spark, out).filter("is_best").count() == 1
    paths = forecasting.save_models(spark, out, str(tmp_path))
    assert forecasting.load_model(spark, paths["random_forest"]).getNumTrees == 25
    assert forecasting.load_model(spark, paths["linear_regression"], "linear_regression").intercept == pytest.approx(
        out.linear.intercept
    )
    with pytest.raises(ValueError):
        forecasting.load_model(spark, paths["random_forest"], "other")
    with pytest.raises(ValueError):
        forecasting.load_model(spark, paths["linear_regression"], "random_forest")
    line = forecasting.load_summary(spark, paths["linear_regression"]).first()
    assert line.features == out.features and line.coefficients == list(out.linear.coefficients) and line.num_trees is None
    assert line.rmse == out.scores["linear_regression"]["rmse"]
    forest = forecasting.load_summary(spark, paths["random_forest"]).first()
    assert (forest.num_trees, len(forest.feature_importances)) == (25, len(out.features)) and forest.coefficients is None
    out.forest.write().overwrite().save(paths["random_forest"])  # as a run leaves it that is lost before the summary
    with pytest.raises(FileNotFoundError):
        forecasting.load_model(spark, paths["random_forest"])


def test_rows_without_any_time_are_split_by_a_seeded_hash(spark):
    rows = spark.range(5000).selectExpr("id", "CAST(NULL AS timestamp) AS timestamp", "id * 0.5 AS aqi")
    shares = [[r.id for r in part.collect()] for part in forecasting.chronological_split(rows)]
    assert sorted(shares[0] + shares[1]) == list(range(5000)) and 0.77 < len(shares[0]) / 5000 < 0.83
    again = forecasting.chronological_split(rows.repartition(7))[0]
    assert sorted(r.id for r in again.collect()) == sorted(shares[0])
    timed = rows.withColumn("timestamp", F.timestamp_seconds("id"))
    assert [part.count() for part in forecasting.chronological_split(timed)] == [4000, 1000]


def test_batch_run_with_models(spark, tmp_path):
    n = F.col("id")
    hours = spark.range(240).select(
        F.concat(F.lit("S"), (n % 2).cast("string")).alias("station_id"),
        F.date_format(F.timestamp_seconds(F.lit(1_700_000_400) + F.floor(n / 2) * 3600), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        n,
    )
    keys = ["station_id", "timestamp"]
    readings = hours.select(*keys, *[(F.lit(5.0 + i) + (n * (i + 3)) % 40).alias(p) for i, p in enumerate(S.POLLUTANTS)])
    weather = hours.select(*keys, *[(F.lit(10.0) + (n * (i + 5)) % 17).alias(w) for i, w in enumerate(S.WEATHER)])
    stations = spark.createDataFrame(
        [(f"S{i}", f"s{i}", "Delhi", "Delhi", 28.6, 77.2 + i, 200.0, "Traffic") for i in range(2)], S.STATIONS_SCHEMA
    )
    root = str(tmp_path / "run")
    out = batch.run_batch(spark, {"air_quality": readings, "weather": weather, "stations": stations}, root, models=True)
    card = {(r.section, r.name, r.metric): r.value for r in out["scorecard"].collect()}
    told = {m: int(card["models", "linear_regression", m]) for m in ("train_records", "test_records")}
    assert sum(told.values()) == card["records", "integrated", "count"] == 240
    assert out["predictions"].count() == told["test_records"]
    assert sum(v for (s, _, m), v in card.items() if (s, m) == ("models", "is_best")) == 1
    assert forecasting.load_summary(spark, f"{root}/models/random_forest").count() == 1
    # Scores of the card are those of the written predictions, up to their rounding.
    written = spark.read.parquet(f"{root}/predictions.parquet")
    again = statistics.regression_metrics(written, "actual_aqi", "predicted_aqi_lr").first()
    assert card["models", "linear_regression", "mae"] == pytest.approx(again.mae, abs=0.06)


def test_stored_models_are_compared_on_stored_rows(spark, monkeypatch):
    """The features of all complete rows are made once, and all of them are compared."""
    from checks.catalog import QUERIES

    calls = []
    original = forecasting.ml_features
    monkeypatch.setattr(forecasting, "ml_features", lambda *args: calls.append(1) or original(*args))
    row = QUERIES["model_sink"](spark, "/root/testdata/sf0.001").first()
    assert len(calls) == 1 and row.different == 0
    assert row.records == QUERIES["ml_assemble"](spark, "/root/testdata/sf0.001").count() > 0
