"""Regression of the index on measurements and their recent history, with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostat import schema as S
from aerostat.functions.calendar import epoch, is_weekend
from aerostat.operators.cleaning import present
from aerostat.operators.statistics import regression_metrics
from aerostat.operators.temporal import history_features
from aerostat.plans import lineage, quantiles, slices

# Candidate features in order.
MEASURED = ["pm2_5", "pm10", "no2", "so2", "co", "o3", "temperature", "humidity", "wind_speed", "pressure"]
TEMPORAL = [
    "hour",
    "day_of_week",
    "month",
    "is_weekend",
    "lag_1_pm2_5",
    "lag_1_aqi",
    "rolling_3h_pm2_5_mean",
    "rolling_3h_aqi_mean",
]
# Second names of four features, and the training parameters.
ALIASES = ["prev_pm2_5", "prev_aqi", "rolling_pm2_5_mean", "rolling_aqi_mean"]
LINEAR = {"maxIter": 50, "regParam": 0.1}
FOREST = {"numTrees": 25, "maxDepth": 6, "seed": 42}
MODEL_TYPES = {"linear_regression": LinearRegressionModel, "random_forest": RandomForestRegressionModel}


def ml_features(df: DataFrame, target: str = "aqi", width: int = slices.DAY) -> DataFrame:
    """Calendar parts, previous values and rolling means of each station.

    Same-hour pollutants stay among the features, as the target is computed from them this
    explains the index rather than forecasting it.
    """
    if "hour" not in df.columns:
        ts = F.col(S.TIME)
        df = df.withColumns(
            {
                "hour": F.hour(ts),
                "day_of_week": F.dayofweek(ts),
                "month": F.month(ts),
                "is_weekend": F.coalesce(is_weekend(ts), F.lit(False)).cast("double"),
            }
        )
    return history_features(df, target, width)


def ahead(df: DataFrame, target: str = "aqi", horizon: int = 1, width: int = slices.DAY) -> DataFrame:
    """Add ``<target>_ahead``: the station's value ``horizon`` readings later, NULL at its end.

    The lag operator over mirrored time, so a busy station stays in slices here too.
    """
    mirrored = df.withColumn("_mirror", F.timestamp_micros(-F.unix_micros(F.col(S.TIME).cast("timestamp"))))
    rows = slices.previous_rows(mirrored, {"_later": target}, horizon, width, order="_mirror")
    return rows.select(*df.columns, F.col(f"_later_{horizon}").alias(f"{target}_ahead"))


def feature_columns(df: DataFrame, with_aliases: bool = True) -> list[str]:
    return present(df, [*MEASURED, *TEMPORAL, *(ALIASES if with_aliases else [])])


def assemble(df: DataFrame, target: str = "aqi", with_aliases: bool = True) -> tuple[DataFrame, list[str]]:
    """Complete rows with a ``features`` vector, and the names behind its slots."""
    names = feature_columns(df, with_aliases)
    complete = df.dropna(subset=[*names, target])
    return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="skip").transform(complete), names


def split_point(df: DataFrame, train_ratio: float = 0.8, method: str = "exact") -> Column:
    """Epoch second that closes the training share, as a scalar subquery."""
    seconds = df.select(epoch(F.col(S.TIME)).alias("t"))
    if method == "exact":
        found = quantiles.exact_quantiles(seconds, ["t"], [train_ratio], interpolate=False)
    else:
        found = quantiles.sketch_quantiles(seconds, ["t"], [train_ratio])
    return found.agg(F.max("value").cast("long").alias("t")).scalar()


def chronological_split(
    df: DataFrame, train_ratio: float = 0.8, method: str = "exact"
) -> tuple[DataFrame, DataFrame]:
    """Rows up to the cut-off, and those after it.

    Where no row has a time there is no cut-off: rows are then split by a seeded hash of their
    values, which gives the same shares in every run and partitioning.
    """
    cutoff = split_point(df, train_ratio, method)
    at = epoch(F.col(S.TIME))
    hashed = F.xxhash64(F.lit(FOREST["seed"]), *[c for c, kind in df.dtypes if "map<" not in kind])
    drawn = F.pmod(hashed, F.lit(1_000_000)) < F.lit(round(train_ratio * 1_000_000))
    timeless = cutoff.isNull()
    return df.filter((at <= cutoff) | (timeless & drawn)), df.filter((at > cutoff) | (timeless & ~drawn))


@dataclass
class Outcome:
    """Fitted models, their scores, lazily scored test rows, and the stored rows of both shares."""

    linear: LinearRegressionModel
    forest: RandomForestRegressionModel
    scores: dict[str, dict[str, float]]
    best: str
    features: list[str]
    train_records: int
    test_records: int
    train_ratio: float
    predictions: DataFrame
    complete: DataFrame


def train_linear(train: DataFrame, target: str = "aqi", prediction: str = "prediction") -> LinearRegressionModel:
    return LinearRegression(featuresCol="features", labelCol=target, predictionCol=prediction, **LINEAR).fit(train)


def train_forest(train: DataFrame, target: str = "aqi", prediction: str = "prediction"):
    return RandomForestRegressor(featuresCol="features", labelCol=target, predictionCol=prediction, **FOREST).fit(
        train
    )


def better_model(scores: dict[str, dict[str, float]]) -> str:
    return "random_forest" if scores["random_forest"]["r2"] >= scores["linear_regression"]["r2"] else "linear_regression"


def stored_features(
    df: DataFrame, target: str = "aqi", with_aliases: bool = True, horizon: int = 0
) -> tuple[DataFrame, list[str]]:
    """Complete rows with their features, written once, and the names of the features.

    With a ``horizon`` the column ``target`` holds the value so many readings later.
    """
    rows = ml_features(df, target)
    if horizon:
        rows = ahead(rows, target, horizon).drop(target).withColumnRenamed(f"{target}_ahead", target)
    rows, names = assemble(rows, target, with_aliases)
    keep = rows.select(S.STATION, S.TIME, target, *[n for n in names if n != target])
    return lineage.materialise(keep, "features"), names


def stored_shares(
    stored: DataFrame, target: str = "aqi", train_ratio: float = 0.8, with_aliases: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The earlier and the later share of stored features, each written once."""
    shares = chronological_split(stored, train_ratio)
    train, test = (lineage.materialise(part, name) for part, name in zip(shares, ("train", "test")))
    return assemble(train, target, with_aliases)[0], assemble(test, target, with_aliases)[0]


def split_features(
    df: DataFrame, target: str = "aqi", train_ratio: float = 0.8, with_aliases: bool = True, horizon: int = 0
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Complete rows with their features, the earlier and the later share, each written once.

    With a ``horizon`` the column ``target`` holds the value so many readings later.
    """
    stored, names = stored_features(df, target, with_aliases, horizon)
    return *stored_shares(stored, target, train_ratio, with_aliases), names


def train_and_evaluate(
    df: DataFrame, target: str = "aqi", train_ratio: float = 0.8, with_aliases: bool = True, horizon: int = 0
) -> Outcome:
    """Fit both models on the earlier rows and score both on the later ones.

    ``horizon=0`` explains the index of the same reading; ``horizon=1`` forecasts the next one.

    Fitting passes over its input many times, so both shares are written once, and so are the
    scored rows. Both models score in one projection: their predictions need no join.
    """
    stored, names = stored_features(df, target, with_aliases, horizon)
    train, test = stored_shares(stored, target, train_ratio, with_aliases)
    linear = train_linear(train, target, "predicted_lr")
    forest = train_forest(train, target, "predicted_rf")
    scored = forest.transform(linear.transform(test))
    scored = lineage.materialise(scored.drop("features"), "scored")
    scores = {
        name: regression_metrics(scored, target, column).first().asDict()
        for name, column in (("linear_regression", "predicted_lr"), ("random_forest", "predicted_rf"))
    }
    best = better_model(scores)
    return Outcome(
        linear,
        forest,
        scores,
        best,
        names,
        train.count(),
        scored.count(),
        train_ratio,
        predictions_table(scored, best, target),
        stored,
    )



def predictions_table(scored: DataFrame, best: str, target: str = "aqi") -> DataFrame:
    """Actual and predicted index per test row, by time."""
    chosen = "predicted_aqi_rf" if best == "random_forest" else "predicted_aqi_lr"
    return (
        scored.select(
            S.STATION,
            S.TIME,
            F.col(target).alias("actual_aqi"),
            F.round("predicted_lr", 1).alias("predicted_aqi_lr"),
            F.round("predicted_rf", 1).alias("predicted_aqi_rf"),
        )
        .withColumns({"predicted_aqi": F.col(chosen), "best_predicted_aqi": F.col(chosen), "model": F.lit(best)})
        .withColumn("prediction_error", F.round(F.abs(F.col("predicted_aqi") - F.col("actual_aqi")), 1))
        .orderBy(S.TIME, S.STATION)
    )


def metrics_table(spark: SparkSession, outcome: Outcome) -> DataFrame:
    """One row per model with its scores and the way it was evaluated."""
    rows = [
        (
            name,
            "chronological_time_split",
            outcome.train_ratio,
            outcome.train_records,
            outcome.test_records,
            len(outcome.features),
            *[round(outcome.scores[name][m], 3) for m in ("rmse", "mae", "r2")],
            name == outcome.best,
        )
        for name in ("linear_regression", "random_forest")
    ]
    return spark.createDataFrame(
        rows,
        "model string, evaluation_strategy string, train_ratio double, train_records long, "
        "test_records long, feature_count int, rmse double, mae double, r2 double, is_best boolean",
    )


SUMMARY_SCHEMA = (
    "model_type string, features array<string>, coefficients array<double>, intercept double, num_trees int, "
    "total_nodes int, feature_importances array<double>, rmse double, mae double, r2 double"
)


def _summary(name: str, outcome: Outcome) -> dict:
    model = outcome.linear if name == "linear_regression" else outcome.forest
    own = (
        {"coefficients": [float(c) for c in model.coefficients], "intercept": float(model.intercept)}
        if name == "linear_regression"
        else {
            "num_trees": int(model.getNumTrees),
            "total_nodes": int(model.totalNumNodes),
            "feature_importances": [float(i) for i in model.featureImportances.toArray()],
        }
    )
    scores = {m: float(outcome.scores[name][m]) for m in ("rmse", "mae", "r2")}
    return {"model_type": name, "features": list(outcome.features), **own, **scores}


def save_models(spark: SparkSession, outcome: Outcome, directory: str) -> dict[str, str]:
    """Write both models with a JSON summary each; returns the path of each.

    A model's summary is written last and removed first, so a folder that has one is complete.
    """
    paths = {}
    for name, model in (("linear_regression", outcome.linear), ("random_forest", outcome.forest)):
        paths[name] = f"{directory.rstrip('/')}/{name}"
        model.write().overwrite().save(paths[name])
        row = spark.createDataFrame([_summary(name, outcome)], SUMMARY_SCHEMA)
        row.coalesce(1).write.mode("overwrite").json(f"{paths[name]}/model_summary")
    return paths


def load_summary(spark: SparkSession, path: str) -> DataFrame:
    """The summary of a saved model, one row; raises ``FileNotFoundError`` for a half-written folder."""
    try:
        summary = spark.read.schema(SUMMARY_SCHEMA).json(f"{path.rstrip('/')}/model_summary")
    except AnalysisException as missing:
        raise FileNotFoundError(f"{path} holds no complete model: it has no summary") from missing
    if summary.isEmpty():
        raise FileNotFoundError(f"{path} holds no complete model: its summary is empty")
    return summary


def load_model(spark: SparkSession, path: str, model_type: str = "random_forest"):
    """A saved model of the given type; a half-written folder or one of another type is refused."""
    if model_type not in MODEL_TYPES:
        raise ValueError(f"unknown model type {model_type!r}; known: {sorted(MODEL_TYPES)}")
    found = load_summary(spark, path).first()["model_type"]
    if found != model_type:
        raise ValueError(f"{path} holds a {found}, not a {model_type}")
    return MODEL_TYPES[model_type].load(path)


def model_summary(spark: SparkSession, outcome: Outcome) -> DataFrame:
    """Coefficients of the line and importances of the forest, per feature."""
    rows = [
        (f, float(c), float(i))
        for f, c, i in zip(
            outcome.features, outcome.linear.coefficients.toArray(), outcome.forest.featureImportances.toArray()
        )
    ]
    return spark.createDataFrame(rows, "feature string, lr_coefficient double, rf_importance double")
