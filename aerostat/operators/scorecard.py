"""One tall scorecard of a batch run: ``(section, name, metric, value)``.

What is told of the fact table is observed while that table is written, so counts, index statistics
and category shares cost no pass of their own. The other sections are read from stored tables and
reports, which are small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat import schema as S
from aerostat.functions.numeric import mean
from aerostat.operators.forecasting import Outcome

SCHEMA = "section string, name string, metric string, value double"
_NUMBERS = (T.NumericType,)


def _kinds(standard: str) -> dict[str, tuple[str, list[str]]]:
    """Section to column and the values that it can have."""
    categories = [*dict.fromkeys([row[0] for row in S.categories(standard)] + ["Unknown"])]
    pollutants = [p.upper().replace("_", ".") for p in S.POLLUTANTS] + ["None"]
    return {
        "category_distribution": ("aqi_category", categories),
        "dominance_distribution": ("dominant_pollutant", pollutants),
    }


def fact_metrics(standard: str = "US_EPA") -> list[Column]:
    """What to observe of the fact table: aggregates of a fixed number, whatever the rows."""
    counts = [
        F.count_if(F.col(column) == value).alias(f"{section}.{i}")
        for section, (column, values) in _kinds(standard).items()
        for i, value in enumerate(values)
    ]
    return [
        F.count("*").alias("records"),
        F.round(F.min("aqi"), 1).alias("min_aqi"),
        F.round(F.max("aqi"), 1).alias("max_aqi"),
        mean("aqi", 1).alias("mean_aqi"),
        F.count_if("is_aqi_out_of_range").alias("out_of_range_count"),
        *counts,
    ]


def observed_section(spark: SparkSession, observed: dict, standard: str = "US_EPA") -> DataFrame:
    """The observed metrics as rows. Categories and pollutants that no reading has are left out."""
    rows = [("records", "integrated", "count", observed["records"])]
    rows += [("aqi_statistics", "aqi", m, observed[m]) for m in ("min_aqi", "max_aqi", "mean_aqi", "out_of_range_count")]
    for section, (_, values) in _kinds(standard).items():
        rows += [(section, v, "count", n) for i, v in enumerate(values) if (n := observed[f"{section}.{i}"])]
    made = spark.createDataFrame([(*r[:3], None if r[3] is None else float(r[3])) for r in rows], SCHEMA)
    share = F.round(F.col("value") / F.lit(float(observed["records"] or 1)) * F.lit(100.0), 2)
    shares = made.filter(F.col("section") == "dominance_distribution")
    return made.unionByName(shares.withColumns({"metric": F.lit("percentage"), "value": share}))


def section(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Each number of a table as a row, named by the table's keys."""
    metrics = [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMBERS) and f.name not in keys]
    label = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]) if keys else F.lit("all")
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(F.lit(name).alias("section"), label.alias("name"), F.inline(cells))


def model_section(spark: SparkSession, outcome: Outcome) -> DataFrame:
    """Scores of both models, how many rows they saw, and which is the better one."""
    rows = []
    for name, scores in outcome.scores.items():
        rows += [("models", name, m, None if v is None else round(float(v), 3)) for m, v in sorted(scores.items())]
        rows.append(("models", name, "is_best", float(name == outcome.best)))
        rows.append(("models", name, "train_records", float(outcome.train_records)))
        rows.append(("models", name, "test_records", float(outcome.test_records)))
    return spark.createDataFrame(rows, SCHEMA)


def scorecard(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
