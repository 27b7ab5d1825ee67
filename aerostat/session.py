"""Runtime settings of a session the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC: calendar parts and windows mean the same on every machine. Generated methods above
# 8,000 bytes are not compiled by the JVM; below the limit Spark splits them instead. A busy
# station makes its dimension join skewed: AQE may split it even if a shuffle follows.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
