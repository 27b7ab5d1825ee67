"""The given star-schema tables seen as readings, weather and stations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat.operators import indexing, joining


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_counter(load(spark, sf_dir, "events"))


def with_counter(events: DataFrame) -> DataFrame:
    """``k``: the number inside ``props``."""
    return events.withColumn("k", F.regexp_extract("props", "[0-9]+", 0).cast("double"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stations, nations as cities, regions as states."""
    nation = load(spark, sf_dir, "nation")
    places = (
        load(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return places.select(
        F.col("c_custkey").alias("station_id"),
        F.col("c_name").alias("station_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.round(F.lit(6.0) + F.lit(1.25) * F.col("n_nationkey"), 2).alias("latitude"),
        F.round(
            F.lit(68.0) + F.lit(1.1) * F.col("n_nationkey") + F.lit(0.01) * (F.col("c_custkey") % 50), 2
        ).alias("longitude"),
        F.col("c_acctbal").alias("elevation"),
        F.col("c_mktsegment").alias("station_type"),
    )


def reading_columns() -> list[Column]:
    """Event columns as one reading: gaps, a sentinel, and pollutants of different scale."""
    value, k = F.col("value"), F.col("k")
    pm2_5 = (
        F.when(every(53), F.lit(-999.0))
        .when(every(37), F.lit(None).cast("double"))
        .otherwise(F.round(F.lit(1.5) * value, 2))
    )
    return [
        F.col("user_id").alias("station_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        pm2_5.alias("pm2_5"),
        F.when(~every(41), F.round(F.lit(1.2) * value + F.lit(10.0), 2)).alias("pm10"),
        F.round(F.lit(0.9) * k, 2).alias("no2"),
        F.round(F.lit(0.5) * k + (F.col("user_id") % 30).cast("double"), 2).alias("so2"),
        F.when(~every(43), F.round(value / F.lit(80.0), 2)).alias("co"),
        F.round(F.lit(0.7) * k + F.lit(5.0), 2).alias("o3"),
    ]


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(*reading_columns())


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as they arrive: text keys, padded ids, bad timestamps, NaN, and repeats."""
    typed = _events(spark, sf_dir).select("event_id", *reading_columns())
    again = typed.filter(every(67)).withColumn("pm10", F.col("pm10") + F.lit(5.0))
    both = typed.unionByName(again)
    text = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    return both.select(
        F.concat(F.lit(" "), F.col("station_id").cast("string"), F.lit("  ")).alias("station_id"),
        F.when(every(101), F.lit("not a time")).otherwise(text).alias("timestamp"),
        "pm2_5",
        "pm10",
        "no2",
        "so2",
        "co",
        F.when(every(59), F.lit(float("nan"))).otherwise(F.col("o3")).alias("o3"),
    )


def text_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times written in four patterns, and one text that is no time."""
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_id") % 5
    return load(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .when(kind == 3, F.date_format(ts, "yyyy-MM-dd"))
        .otherwise(F.lit("not a time"))
        .alias("timestamp"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather for most readings; some have none."""
    k, value = F.col("k"), F.col("value")
    return (
        _events(spark, sf_dir)
        .filter(~every(29))
        .select(
            F.col("user_id").alias("station_id"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            F.when(~every(31), F.round(F.lit(10.0) + F.lit(0.3) * k, 2)).alias("temperature"),
            F.round(F.lit(100.0) - F.lit(0.6) * k, 2).alias("humidity"),
            F.round(value / F.lit(20.0), 2).alias("wind_speed"),
            F.round(F.lit(3.6) * k, 2).alias("wind_direction"),
            F.round(F.lit(990.0) + F.lit(0.2) * k, 2).alias("pressure"),
            F.round(F.when(k > 90, value / F.lit(10.0)).otherwise(F.lit(0.0)), 2).alias("rainfall"),
        )
    )


def indexed(spark: SparkSession, sf_dir: str, standard: str = "US_EPA") -> DataFrame:
    return indexing.aqi_enrich(readings(spark, sf_dir), standard)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexed readings with station metadata."""
    return joining.join_stations(indexed(spark, sf_dir), stations(spark, sf_dir))


def full_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexed readings with weather."""
    return joining.join_exact(indexed(spark, sf_dir), weather(spark, sf_dir))


def orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as readings over seven years: all months and seasons occur."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("station_id"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.round(F.col("l_quantity") * F.lit(10.0), 1).alias("aqi"),
        F.round(F.col("l_extendedprice") / F.lit(1000.0), 2).alias("pm2_5"),
    )


def plain(df: DataFrame) -> DataFrame:
    """Types the SQL twin has too: naive timestamps, 64-bit integers, doubles."""

    def cast(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("long")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        return column.alias(field.name)

    return df.select(*[cast(f) for f in df.schema.fields])
