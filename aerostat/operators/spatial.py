"""Geographic scope, summaries by place, hotspots, ranks and map queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostat import schema as S
from aerostat.functions import numeric as N
from aerostat.functions import places as P
from aerostat.operators.cleaning import present
from aerostat.plans.lineage import materialise

ATTRIBUTES = ["station_name", "city", "state", "latitude", "longitude", "station_type"]


def scope_country(df: DataFrame) -> DataFrame:
    return df


def scope_state(df: DataFrame, state: str | None) -> DataFrame:
    if not state or state in P.ANY_STATE or "state" not in df.columns:
        return df
    return df.filter(P.same_text(F.col("state"), state))


def scope_city(df: DataFrame, city: str | None, state: str | None = None) -> DataFrame:
    df = scope_state(df, state)
    if not city or city in P.ANY_CITY or "city" not in df.columns:
        return df
    return df.filter(P.same_text(F.col("city"), city))


def scope_station(df: DataFrame, station_id: str | int | None) -> DataFrame:
    """Exact match; the wanted id takes the column's type so the filter reaches the scan."""
    if station_id is None or station_id == "" or station_id in P.ANY_STATION or S.STATION not in df.columns:
        return df
    return df.filter(F.col(S.STATION) == F.lit(station_id).cast(df.schema[S.STATION].dataType))


def scope_filter(
    df: DataFrame, state: str | None = None, city: str | None = None, station_id: str | int | None = None
) -> DataFrame:
    return scope_station(scope_city(df, city, state), station_id)


def valid_coordinates(df: DataFrame) -> DataFrame:
    """Numeric positions inside the valid range; anything else is dropped."""
    numeric = df.withColumns({c: F.col(c).try_cast("double") for c in ("latitude", "longitude")})
    return numeric.filter(P.valid_position(F.col("latitude"), F.col("longitude")))


def _with_attributes(df: DataFrame) -> DataFrame:
    """Fill in attribute columns the table lacks with their fixed fallbacks."""
    # Fixed values.
    fallback = {
        "station_name": F.col(S.STATION).cast("string"),
        "city": F.lit("Unknown"),
        "state": F.lit("Unknown"),
        "latitude": F.lit(0.0),
        "longitude": F.lit(0.0),
        "station_type": F.lit("General"),
    }
    absent = {c: v for c, v in fallback.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def _cells(df: DataFrame, keys: list[str], measures: list[str], extra: list[Column] = ()) -> DataFrame:
    """First aggregation level, with parts that merge exactly.

    The keys include every attribute, so one hash aggregation with a map-side combine
    reads the big table; everything that needs distinct counts or attribute look-ups
    works on its small result.
    """
    return df.groupBy(*keys).agg(
        F.count("*").alias("_rows"),
        F.min("aqi").alias("_min"),
        F.max("aqi").alias("_max"),
        *[part for m in measures for part in N.partial_sums(m, m)],
        *extra,
    )


def _merge(measures: list[str]) -> list[Column]:
    return [
        F.sum("_rows").alias("_rows"),
        F.min("_min").alias("_min"),
        F.max("_max").alias("_max"),
        *[part for m in measures for part in N.merge_sums(m)],
    ]


def _index_columns() -> list[Column]:
    return [
        N.mean_from("aqi", 2).alias("mean_aqi"),
        F.round("_min", 2).alias("min_aqi"),
        F.round("_max", 2).alias("max_aqi"),
    ]


def _mean_column(df: DataFrame, measure: str) -> Column:
    value = N.mean_from(measure, 2) if measure in df.columns else F.lit(None).cast("double")
    return value.alias(f"mean_{measure}")


def _by_mean() -> list[Column]:
    return [F.col("mean_aqi").desc_nulls_last()]


def _station_statistics(df: DataFrame) -> DataFrame:
    """Index and pollutant statistics per station, in no order.

    The spread comes from the station's sum and sum of squared deviations, so it merges
    like the other parts.
    """
    df = _with_attributes(df)
    measures = ["aqi", *present(df, S.POLLUTANTS)]
    moments = [F.var_samp("aqi").alias("_var"), F.avg("aqi").alias("_avg")]
    cells = _cells(df, [S.STATION, *ATTRIBUTES], measures, moments)
    grouped = cells.groupBy(S.STATION).agg(
        *[F.min(a).alias(a) for a in ATTRIBUTES],
        *_merge(measures),
        # Pooled variance over the attribute variants of one station (normally one).
        F.sum(F.coalesce(F.col("_var"), F.lit(0.0)) * (F.col("aqi_n") - 1)).alias("_inner"),
        F.sum(F.col("_avg") * F.col("_avg") * F.col("aqi_n")).alias("_sq"),
        F.sum(F.col("_avg") * F.col("aqi_n")).alias("_lin"),
        F.count("*").alias("_variants"),
    )
    n = F.col("aqi_n").cast("double")
    outer = F.when(F.col("_variants") > 1, F.col("_sq") - F.col("_lin") * F.col("_lin") / n).otherwise(F.lit(0.0))
    spread = F.when(n > 1, F.sqrt((F.col("_inner") + outer) / (n - 1)))
    return grouped.select(
        S.STATION,
        *ATTRIBUTES,
        *_index_columns(),
        F.round(spread, 2).alias("std_aqi"),
        F.col("_rows").alias("total_readings"),
        *[_mean_column(df, p) for p in measures[1:]],
    )


def station_summary(df: DataFrame) -> DataFrame:
    """Index and pollutant statistics per station, most polluted first."""
    return _station_statistics(df).orderBy(*_by_mean(), S.STATION)


def city_summary(df: DataFrame) -> DataFrame:
    """Per city; cities of one name in two states merge and show the first state."""
    if "city" not in df.columns:
        return df
    measures = ["aqi", *present(df, ["pm2_5", "pm10"])]
    cells = _cells(_with_attributes(df), ["state", "city", S.STATION], measures)
    return (
        cells.groupBy("city")
        .agg(F.min("state").alias("state"), F.countDistinct(S.STATION).alias("station_count"), *_merge(measures))
        .select(
            "city",
            "state",
            "station_count",
            *_index_columns(),
            _mean_column(df, "pm2_5"),
            _mean_column(df, "pm10"),
            F.col("_rows").alias("total_readings"),
        )
        .orderBy(*_by_mean(), "city")
    )


def state_summary(df: DataFrame) -> DataFrame:
    """Per state. Both distinct counts run over one row per station, not per reading."""
    if "state" not in df.columns:
        return df
    measures = ["aqi", *present(df, ["pm2_5", "pm10"])]
    cells = _cells(_with_attributes(df), ["state", "city", S.STATION], measures)
    return (
        cells.groupBy("state")
        .agg(
            F.countDistinct("city").alias("city_count"),
            F.countDistinct(S.STATION).alias("station_count"),
            *_merge(measures),
        )
        .select(
            "state",
            "city_count",
            "station_count",
            *_index_columns(),
            _mean_column(df, "pm2_5"),
            _mean_column(df, "pm10"),
            F.col("_rows").alias("total_readings"),
        )
        .orderBy(*_by_mean(), "state")
    )


def geo_rollup(df: DataFrame) -> DataFrame:
    """Nation, state, city and station levels at once; ``level`` is the number of keys set.

    ROLLUP multiplies its input by four, so it gets one row per station.
    """
    measures = ["aqi", *present(df, ["pm2_5", "pm10"])]
    cells = _cells(_with_attributes(df), ["state", "city", S.STATION], measures)
    # grouping_id is 7, 3, 1, 0 for zero to three keys.
    level = F.lit(3) - F.length(F.replace(F.bin(F.col("_gid")), F.lit("0"), F.lit("")))
    return (
        cells.rollup("state", "city", S.STATION)
        .agg(F.grouping_id().alias("_gid"), *_merge(measures))
        .select(
            level.cast("long").alias("level"),
            "state",
            "city",
            S.STATION,
            *_index_columns(),
            _mean_column(df, "pm2_5"),
            _mean_column(df, "pm10"),
            F.col("_rows").alias("total_readings"),
        )
    )


def hotspots(df: DataFrame, threshold: float = 150.0) -> DataFrame:
    """Stations by how often and how far their index is unhealthy."""
    df = _with_attributes(df)
    keys = ATTRIBUTES[:5]
    unhealthy = [F.count_if(F.col("aqi") >= F.lit(threshold)).alias("_bad")]
    cells = _cells(df, [S.STATION, *keys], ["aqi"], unhealthy)
    merged = cells.groupBy(S.STATION).agg(
        *[F.min(a).alias(a) for a in keys], *_merge(["aqi"]), F.sum("_bad").alias("unhealthy_count")
    )
    share = F.col("unhealthy_count") / F.col("total_readings") * F.lit(100.0)
    return (
        merged.select(
            S.STATION,
            *keys,
            F.col("_rows").alias("total_readings"),
            "unhealthy_count",
            N.mean_from("aqi", 2).alias("mean_aqi"),
            F.round("_max", 2).alias("max_aqi"),
        )
        .withColumn("unhealthy_pct", F.round(share, 2))
        .withColumn("hotspot_score", P.hotspot_score(F.col("unhealthy_pct"), F.col("mean_aqi")))
        .withColumn("hotspot_level", P.hotspot_level(F.col("hotspot_score")))
        .orderBy(F.col("hotspot_score").desc_nulls_last(), S.STATION)
    )


def station_rank(df: DataFrame, ascending: bool = False) -> DataFrame:
    """Station summary with ``rank`` and ``dense_rank`` by mean index.

    Means have two places and lie in [0, 500], so at most 50,001 of them differ: ranks
    are counted over the distinct means and joined back, and no task orders all stations.
    The summary, one row per station, is staged: both sides of the join read it.
    """
    summary = materialise(_station_statistics(df), "station-rank")
    order = F.col("mean_aqi").asc_nulls_last() if ascending else F.col("mean_aqi").desc_nulls_last()
    ladder = Window.partitionBy(F.col("_all")).orderBy(order)
    means = (
        summary.groupBy("mean_aqi")
        .agg(F.count("*").alias("_n"))
        .withColumn("_all", F.lit(0))
        .select(
            F.col("mean_aqi").alias("_mean"),
            (F.sum("_n").over(ladder) - F.col("_n") + 1).alias("rank"),
            F.dense_rank().over(ladder).cast("long").alias("dense_rank"),
        )
    )
    return (
        summary.join(means, F.col("mean_aqi").eqNullSafe(F.col("_mean")))
        .drop("_mean")
        .orderBy("rank", S.STATION)
    )


def scope_kpis(df: DataFrame) -> DataFrame:
    """Mean of station means, greatest index, stations, top pollutant and rows in scope."""
    per_station = df.groupBy(S.STATION).agg(
        N.mean("aqi", 2).alias("m"), F.round(F.max("aqi"), 2).alias("x"), F.count("*").alias("n")
    )
    top = (
        df.groupBy("dominant_pollutant")
        .agg(F.count("*").alias("n"))
        .agg(F.min_by("dominant_pollutant", F.struct(-F.col("n"), F.col("dominant_pollutant"))))
        .scalar()
    )
    return per_station.agg(
        N.mean("m", 1).alias("mean_aqi"),
        F.round(F.max("x"), 1).alias("max_aqi"),
        F.count("*").alias("station_count"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("observations"),
    ).withColumn("top_dominant", top)


def map_viewport(df: DataFrame) -> DataFrame:
    """Centre and zoom of the box around all valid positions; one row, always."""
    lat, lon, zoom = P.DEFAULT_VIEW
    if not {"latitude", "longitude"} <= set(df.columns):
        return df.sparkSession.createDataFrame([P.DEFAULT_VIEW], "lat double, lon double, zoom double")
    box = valid_coordinates(df).agg(
        F.count("*").alias("n"),
        *[f(c).alias(f"{n}_{c}") for c in ("latitude", "longitude") for n, f in (("lo", F.min), ("hi", F.max))],
    )
    spread = F.greatest(
        F.col("hi_latitude") - F.col("lo_latitude"), F.col("hi_longitude") - F.col("lo_longitude")
    )
    return box.select(
        F.coalesce((F.col("lo_latitude") + F.col("hi_latitude")) / 2.0, F.lit(lat)).alias("lat"),
        F.coalesce((F.col("lo_longitude") + F.col("hi_longitude")) / 2.0, F.lit(lon)).alias("lon"),
        F.when(F.col("n") > 0, P.zoom_level(F.col("n"), spread)).otherwise(F.lit(zoom)).alias("zoom"),
    )


def hierarchy_tree(stations: DataFrame) -> DataFrame:
    """State, city, station id and name: one flat row per station, whatever a city's size."""

    def text(name: str, fallback: Column) -> Column:
        return F.coalesce(F.trim(F.col(name).cast("string")), fallback) if name in stations.columns else fallback

    return stations.select(
        text("state", F.lit("Other")).alias("state"),
        text("city", F.lit("Other")).alias("city"),
        text(S.STATION, F.lit("")).alias(S.STATION),
        text("station_name", text(S.STATION, F.lit(""))).alias("station_name"),
    )


def coverage_profile(stations: DataFrame, readings: DataFrame, weather: DataFrame) -> DataFrame:
    """What the dataset covers, as rows ``(section, name, value)``.

    Distinct names are rows, not one array, so the result may be as long as it needs.
    """
    box = stations.agg(
        F.count("*").cast("double").alias("stations"),
        F.min("latitude").alias("min_lat"),
        F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"),
        F.max("longitude").alias("max_lon"),
        readings.agg(F.count("*")).scalar().cast("double").alias("air_quality"),
        weather.agg(F.count("*")).scalar().cast("double").alias("weather"),
    )
    sections = {
        "count": ["stations"],
        "bounds": ["min_lat", "max_lat", "min_lon", "max_lon"],
        "records": ["air_quality", "weather"],
    }
    fixed = box.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(s).alias("section"), F.lit(n).alias("name"), F.col(n).alias("value"))
                    for s, names in sections.items()
                    for n in names
                ]
            )
        )
    )
    for level, plural in (("state", "states"), ("city", "cities")):
        names = stations.groupBy(F.col(level).alias("name")).agg(F.count("*").cast("double").alias("value"))
        names = names.filter(F.col("name").isNotNull())
        fixed = fixed.unionByName(names.select(F.lit(level).alias("section"), "name", "value")).unionByName(
            names.agg(F.count("*").cast("double").alias("value")).select(
                F.lit("count").alias("section"), F.lit(plural).alias("name"), "value"
            )
        )
    return fixed
