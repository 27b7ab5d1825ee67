"""Distributions, correlation, audits, quality reports and regression metrics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostat import schema as S
from aerostat.functions.numeric import mean
from aerostat.operators import cleaning
from aerostat.operators.cleaning import present
from aerostat.plans import lineage


def _tall(df: DataFrame, names: Iterable[str], key: str, value: str, kind: str = "double") -> DataFrame:
    """One-row frame to rows ``(key, value)``; a generator, so no shuffle."""
    rows = [F.struct(F.lit(n).alias(key), F.col(n).cast(kind).alias(value)) for n in names]
    return df.select(F.inline(F.array(*rows)))


def dominance_distribution(df: DataFrame) -> DataFrame:
    """Share of readings each pollutant dominates; at most seven groups reach the window."""
    if "dominant_pollutant" not in df.columns:
        return df
    counts = df.groupBy("dominant_pollutant").agg(F.count("*").alias("count")).withColumn("_all", F.lit(0))
    total = F.sum("count").over(Window.partitionBy(F.col("_all")))
    return counts.select(
        "dominant_pollutant", "count", F.round(F.col("count") / total * F.lit(100.0), 2).alias("percentage")
    ).orderBy(F.col("count").desc(), "dominant_pollutant")


def dominant_counts(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("dominant_pollutant")
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), "dominant_pollutant")
    )


def top_dominant(df: DataFrame) -> DataFrame:
    return dominant_counts(df).limit(1)


def category_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("aqi_category").agg(F.count("*").alias("count"))


def pollutant_summary(df: DataFrame) -> DataFrame:
    """One row of rounded mean, least and greatest value per pollutant and of the index."""
    parts = []
    for c in present(df, [*S.POLLUTANTS, "aqi"]):
        parts += [
            mean(c, 2).alias(f"{c}_avg"),
            F.round(F.min(c), 2).alias(f"{c}_min"),
            F.round(F.max(c), 2).alias(f"{c}_max"),
        ]
    return df.agg(*parts)


def aqi_statistics(df: DataFrame) -> DataFrame:
    return df.agg(
        F.round(F.min("aqi"), 1).alias("min_aqi"),
        F.round(F.max("aqi"), 1).alias("max_aqi"),
        mean("aqi", 1).alias("mean_aqi"),
        F.count_if("is_aqi_out_of_range").alias("out_of_range_count"),
    )


def exceedance(df: DataFrame) -> DataFrame:
    return df.agg(
        F.max("aqi").alias("max_aqi"),
        F.count_if("is_aqi_out_of_range").alias("out_of_range_count"),
        F.max("extrapolated_aqi").alias("max_extrapolated_aqi"),
    )


def sub_index_means(df: DataFrame) -> DataFrame:
    """Rows ``(pollutant, mean_sub_index)``; NULL sub-indices do not count."""
    active = [p for p in S.POLLUTANTS if f"sub_index_{p}" in df.columns]
    row = df.agg(*[mean(f"sub_index_{p}").alias(p.upper()) for p in active])
    return _tall(row, [p.upper() for p in active], "pollutant", "mean_sub_index")


def correlation_matrix(df: DataFrame, places: int = 3, least_rows: int = 5) -> DataFrame:
    """Pearson correlation of every pair, tall: ``(var_a, var_b, r)``.

    Rows with a NULL in any column are left out. Each complete row becomes one row per
    variable, aggregated on the map side to sums of products with all variables: one scan,
    and at most thirteen rows leave a task. Values are shifted to the middle of their
    physical range first, so that large offsets do not cost precision.
    """
    names = present(df, [*S.POLLUTANTS, *S.WEATHER, "aqi"])
    limits = {**S.DOMAIN_LIMITS, "aqi": (0.0, 500.0)}
    shifted = [f"CAST({c} AS DOUBLE) - {(limits[c][0] + limits[c][1]) / 2!r}D AS {c}" for c in names]
    complete = df.select(*names).dropna().selectExpr(*shifted)
    sums = (
        complete.selectExpr(f"posexplode(array({', '.join(names)})) AS (i, x)", *names)
        .groupBy("i")
        .agg(
            F.expr("count(*) AS n"),
            F.expr("sum(x) AS total"),
            F.expr(f"array({', '.join(f'sum(x * {c})' for c in names)}) AS products"),
        )
    )
    # The matrix itself: as many rows as variables, gathered into one.
    matrix = sums.agg(F.expr("array_sort(collect_list(struct(i, n, total, products))) AS m"))
    labels = f"array({', '.join(repr(c) for c in names)})"
    cells = matrix.selectExpr("m", f"posexplode({labels}) AS (a, var_a)").selectExpr(
        "m", "a", "var_a", f"posexplode({labels}) AS (b, var_b)"
    )

    def deviation(i: str, j: str) -> str:
        return f"(get(get(m, {i}).products, {j}) - get(m, {i}).total * get(m, {j}).total / get(m, {i}).n)"

    scale = f"sqrt({deviation('a', 'a')} * {deviation('b', 'b')})"
    r = f"coalesce(round(try_divide({deviation('a', 'b')}, {scale}), {places}), 0.0D)"
    return cells.selectExpr(
        "var_a", "var_b", f"CASE WHEN get(m, 0).n >= {least_rows} THEN {r} ELSE 0.0D END AS r"
    )


def distinct_count(df: DataFrame, column: str, approximate: bool = False, name: str = "distinct_count") -> DataFrame:
    """How many different values a column has, one row; NULL is none. The approximate form is a sketch."""
    if approximate:
        return united_distinct(distinct_sketches(df, column), name=name)
    return df.agg(F.countDistinct(column).alias(name))


def distinct_sketches(df: DataFrame, column: str, by: Iterable[str] = (), size: int = 12) -> DataFrame:
    """One mergeable sketch of a column's values per group, to be stored and united later.

    The standard error of counts is about ``1.04 / sqrt(2 ** size)``: 1.6 % by default. Sketches are
    filled on the map side and their size does not grow with the rows.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, size).alias("sketch"))


def united_distinct(sketches: DataFrame, by: Iterable[str] = (), name: str = "distinct_count") -> DataFrame:
    """Distinct counts over any coarser grouping of stored sketches; no value counts twice."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def distinct_bitmaps(df: DataFrame, column: str, by: Iterable[str] = ()) -> DataFrame:
    """The values of a whole-number column per group as bitmaps of 32,768 neighbouring numbers each.

    The exact counterpart of ``distinct_sketches``, to be stored and united later. Bitmaps are filled
    on the map side; they suit ids that lie close, as a lone value takes a bitmap of its own.
    """
    known = df.filter(F.col(column).isNotNull())
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(column))
    return known.groupBy(*by, F.bitmap_bucket_number(column).alias("bucket")).agg(bits.alias("bitmap"))


def united_bitmaps(bitmaps: DataFrame, by: Iterable[str] = (), name: str = "distinct_count") -> DataFrame:
    """Exact distinct counts over any coarser grouping of stored bitmaps."""
    by = list(by)
    parts = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("_n"))
    return parts.groupBy(*by).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name))


def enough_rows(df: DataFrame, columns: Iterable[str], least: int = 5) -> DataFrame:
    """Whether at least so many complete rows exist, reading no more than needed."""
    return (
        df.select(*columns).dropna().limit(least).agg((F.count("*") >= least).alias("enough"))
    )


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Equal-width bins between the least and the greatest value: ``(bin, lower, upper, count)``."""
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    span = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    low, width = F.col("_span.lo"), (F.col("_span.hi") - F.col("_span.lo")) / F.lit(float(bins))
    slot = F.coalesce(F.try_divide(F.col("v") - low, width), F.lit(0.0))
    counts = (
        lineage.with_scalar(values, span, "_span")
        .select(F.least(F.floor(slot), F.lit(bins - 1)).cast("long").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("count"))
    )
    return lineage.with_scalar(counts, span, "_span").select(
        "bin",
        (low + F.col("bin") * width).alias("lower"),
        (low + (F.col("bin") + 1) * width).alias("upper"),
        "count",
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """RMSE, MAE and R² in one aggregate."""
    error = F.col(actual) - F.col(predicted)
    pairs = df.select(F.col(actual).alias("y"), error.alias("e")).dropna()
    return pairs.agg(
        F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"),
        F.avg(F.abs("e")).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(F.col("e") * F.col("e")), F.var_pop("y") * F.count("y"))).alias("r2"),
    )


def missing_audit(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows ``(variable, missing)``: NULL or NaN values per column, one pass."""
    columns = present(df, columns)
    row = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in columns])
    return _tall(row, columns, "variable", "missing", "long")


def flag_audit(df: DataFrame, pattern: str, columns: Iterable[str], any_flag: str, total: str) -> DataFrame:
    """Rows ``(variable, violations)`` for flag columns, and the rows with any flag."""
    active = [c for c in columns if pattern.format(c) in df.columns]
    row = df.agg(
        *[F.count_if(pattern.format(c)).alias(c) for c in active], F.count_if(any_flag).alias(total)
    )
    return _tall(row, [*active, total], "variable", "violations", "long")


def domain_audit(flagged: DataFrame, columns: Iterable[str] = tuple(S.DOMAIN_LIMITS)) -> DataFrame:
    return flag_audit(
        flagged, "is_{}_domain_outlier", columns, "is_any_domain_outlier", "total_domain_outliers"
    )


def outlier_audit(flagged: DataFrame, columns: Iterable[str] = tuple(S.POLLUTANTS)) -> DataFrame:
    return flag_audit(flagged, "is_{}_outlier", columns, "is_any_outlier", "total_outlier_rows")


def missing_before_after(before: DataFrame, after: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows ``(pollutant, missing_before, missing_after)``."""
    columns = present(before, columns)
    counts = [missing_audit(d, columns).withColumnRenamed("missing", n) for d, n in ((before, "b"), (after, "a"))]
    return counts[0].join(counts[1], "variable").select(
        F.upper("variable").alias("pollutant"),
        F.col("b").alias("missing_before"),
        F.col("a").alias("missing_after"),
    )


def quality_report(raw: DataFrame, audited: DataFrame, dataset: str, columns: list[str]) -> DataFrame:
    """Rows ``(dataset, metric, value)`` from one aggregate over the audited, cleaned table.

    ``audited`` is the output of ``clean_readings`` or ``clean_weather`` with ``audit``: its
    helper columns tell how many copies each row stands for and what was missing, so the
    stages before imputation need no pass of their own. Only the raw row count is separate.
    """
    columns = [c for c in columns if f"_absent_{c}" in audited.columns]
    domain = [c for c in columns if f"is_{c}_domain_outlier" in audited.columns]
    outlier = [c for c in columns if f"is_{c}_outlier" in audited.columns]
    counts = [
        F.count("*").alias("final_records"),
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("_valid"),
        *[F.count_if(f"_absent_{c}").alias(f"missing_before.{c}") for c in columns],
        *[F.count_if(F.col(c).isNull()).alias(f"missing_after.{c}") for c in columns],
        *[F.count_if(f"is_{c}_domain_outlier").alias(f"domain_outliers.{c}") for c in domain],
        *[F.count_if(f"is_{c}_outlier").alias(f"statistical_outliers.{c}") for c in outlier],
    ]
    if domain:
        counts.append(F.count_if("is_any_domain_outlier").alias("domain_outliers.total_domain_outliers"))
    if outlier:
        counts.append(F.count_if("is_any_outlier").alias("statistical_outliers.total_outlier_rows"))
    row = audited.agg(*counts).withColumn("initial_records", raw.agg(F.count("*")).scalar())
    missing = sum((F.col(f"`missing_before.{c}`") for c in columns), F.lit(0))
    row = row.withColumns(
        {
            "invalid_records": F.col("initial_records") - F.col("_valid"),
            "duplicate_records": F.col("_valid") - F.col("final_records"),
        }
    ).withColumn("retention_percentage", _retention())
    names = ["initial_records", "final_records", "invalid_records", "duplicate_records", "retention_percentage"]
    if outlier:
        defects = F.col("duplicate_records") + F.col("invalid_records") + missing
        size = F.col("initial_records") * F.lit(len(S.POLLUTANTS)) + F.lit(1e-5)
        row = row.withColumn(
            "quality_score", F.round(F.greatest(F.lit(0.0), F.lit(100.0) - defects / size * F.lit(100.0)), 2)
        )
        names.append("quality_score")
    groups = ("missing_before.", "missing_after.", "domain_outliers.", "statistical_outliers.")
    names += [c for c in row.columns if c.startswith(groups)]
    tall = [F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").cast("double").alias("value")) for n in names]
    return row.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*tall)))


def quality_report_readings(raw: DataFrame, quantile_method: str = "exact") -> DataFrame:
    audited = cleaning.clean_readings(raw, quantile_method=quantile_method, audit=True)
    return quality_report(raw, audited, "Air Quality", S.POLLUTANTS)


def quality_report_weather(raw: DataFrame) -> DataFrame:
    return quality_report(raw, cleaning.clean_weather(raw, audit=True), "Weather", S.WEATHER)


def quality_report_stations(raw: DataFrame) -> DataFrame:
    """Same shape; every row that did not survive counts as a duplicate."""
    row = cleaning.clean_stations(raw).agg(F.count("*").alias("final_records"))
    row = row.withColumn("initial_records", raw.agg(F.count("*")).scalar())
    row = row.withColumns(
        {
            "duplicate_records": F.col("initial_records") - F.col("final_records"),
            "retention_percentage": _retention(),
        }
    )
    names = ["initial_records", "final_records", "duplicate_records", "retention_percentage"]
    tall = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
    return row.select(F.lit("Stations").alias("dataset"), F.inline(F.array(*tall)))


def _retention() -> Column:
    share = F.col("final_records") / F.col("initial_records") * F.lit(100.0)
    return F.when(F.col("initial_records") > 0, F.round(share, 2)).otherwise(F.lit(0.0))
