"""Validation, normalisation, de-duplication, limits, imputation and outlier flags."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostat import schema as S
from aerostat.functions.calendar import parse_timestamp
from aerostat.functions.numeric import GRID, mean, rest, units
from aerostat.plans import lineage, quantiles, slices


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: Iterable[str], label: str) -> DataFrame:
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"{label} dataset missing columns: {absent}")
    return df


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def nan_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NaN sorts above every number and poisons means; treat it as missing."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in present(df, columns)})


def normalize_timestamps(df: DataFrame, column: str = S.TIME) -> DataFrame:
    """Text timestamps to TIMESTAMP, NULL where no pattern fits. Typed columns pass through."""
    kind = dict(df.dtypes)[column]
    value = parse_timestamp(F.col(column)) if kind == "string" else F.col(column).cast("timestamp")
    return df.withColumn(column, value)


def standardize_strings(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.trim(c) for c in present(df, columns) if kinds[c] == "string"})


def valid_keys(df: DataFrame, keys: Iterable[str] = (S.STATION, S.TIME)) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def valid_stations(df: DataFrame) -> DataFrame:
    return valid_keys(df, [S.STATION, "latitude", "longitude"])


def deduplicate(
    df: DataFrame, keys: Iterable[str] = (S.STATION, S.TIME), copies: str | None = None
) -> DataFrame:
    """One row per key: the smallest of its copies by the remaining columns.

    An aggregate, not ``row_number``: copies collapse before the shuffle, so a key with
    very many copies is no hot spot, and the survivor does not depend on task order.
    ``copies`` names an extra column with the number of rows each survivor stands for.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    wanted = [F.min(F.struct(*rest)).alias("_row")] if rest else []
    if copies:
        wanted.append(F.count("*").alias(copies))
    if not wanted:
        return df.select(*keys).distinct()
    columns = [F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns]
    return df.groupBy(*keys).agg(*wanted).select(*columns, *([copies] if copies else []))


def domain_flags(df: DataFrame, limits: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """``is_<c>_domain_outlier`` per measured column and ``is_any_domain_outlier``."""
    active = _active_limits(df, limits)
    if not active:
        return df
    flags = {f"is_{c}_domain_outlier": _outside(F.col(c), *lim) for c, lim in active.items()}
    return _with_flags(df, flags, "is_any_domain_outlier")


def domain_cap(df: DataFrame, limits: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Clamp to the physical range; NULL stays NULL."""
    return df.withColumns(
        {
            c: F.when(F.col(c) < lo, F.lit(float(lo))).when(F.col(c) > hi, F.lit(float(hi))).otherwise(F.col(c))
            for c, (lo, hi) in _active_limits(df, limits).items()
        }
    )


def _active_limits(df: DataFrame, limits: dict[str, tuple[float, float]] | None):
    limits = S.DOMAIN_LIMITS if limits is None else limits
    return {c: lim for c, lim in limits.items() if c in df.columns}


def _outside(value: Column, lo, hi) -> Column:
    return (value < lo) | (value > hi)


def iqr_bounds(
    df: DataFrame,
    columns: Iterable[str] = tuple(S.POLLUTANTS),
    multiplier: float = S.IQR_MULTIPLIER,
    method: str = "exact",
) -> DataFrame:
    """Rows ``(variable, q1, q3, lower, upper)``."""
    columns = present(df, columns)
    span = F.col("q3") - F.col("q1")
    at = {name: F.max(F.when(F.col("p") == p, F.col("value"))).alias(name) for name, p in (("q1", 0.25), ("q3", 0.75))}
    return (
        _quartiles(df, columns, method)
        .groupBy("variable")
        .agg(at["q1"], at["q3"])
        .withColumn("lower", F.col("q1") - F.lit(multiplier) * span)
        .withColumn("upper", F.col("q3") + F.lit(multiplier) * span)
    )


def _quartiles(df: DataFrame, columns: list[str], method: str) -> DataFrame:
    if method == "exact":
        return quantiles.exact_quantiles(df, columns, [0.25, 0.75])
    if method == "sketch":
        return quantiles.sketch_quantiles(df, columns, [0.25, 0.75])
    raise ValueError(f"method must be 'exact' or 'sketch', not {method!r}")


def iqr_flags(
    df: DataFrame,
    columns: Iterable[str] = tuple(S.POLLUTANTS),
    multiplier: float = S.IQR_MULTIPLIER,
    method: str = "exact",
) -> DataFrame:
    """``is_<c>_outlier`` per column and ``is_any_outlier``.

    The bounds reach the rows as a scalar subquery: one row, evaluated once.
    """
    columns = present(df, columns)
    if not columns:
        return df.withColumn("is_any_outlier", F.lit(False))
    row = quantiles.as_one_row(_quartiles(df, columns, method), columns, [0.25, 0.75])
    flags = {}
    for c in columns:
        q1, q3 = F.col(f"_bounds.{c}_q0"), F.col(f"_bounds.{c}_q1")
        reach = F.lit(multiplier) * (q3 - q1)
        flags[f"is_{c}_outlier"] = _outside(F.col(c), q1 - reach, q3 + reach)
    return _with_flags(lineage.with_scalar(df, row, "_bounds"), flags, "is_any_outlier").drop("_bounds")


def zscore_flags(
    df: DataFrame, columns: Iterable[str] = tuple(S.POLLUTANTS), limit: float = S.ZSCORE_LIMIT
) -> DataFrame:
    """Like :func:`iqr_flags`, by distance from the mean in standard deviations."""
    columns = present(df, columns)
    row = df.agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("mean", F.avg), ("sd", F.stddev))])
    flags = {
        f"is_{c}_outlier": F.abs(F.col(c) - F.col(f"_stats.{c}_mean")) > F.lit(limit) * F.col(f"_stats.{c}_sd")
        for c in columns
    }
    return _with_flags(lineage.with_scalar(df, row, "_stats"), flags, "is_any_outlier").drop("_stats")


def _with_flags(df: DataFrame, flags: dict[str, Column], total: str) -> DataFrame:
    """Add flag columns, then their three-valued OR."""
    return df.withColumns(flags).withColumn(total, reduce(or_, [F.col(f) for f in flags]))


def forward_fill(
    df: DataFrame, columns: Iterable[str], width: int = slices.DAY, key: str = S.STATION, order: str = S.TIME
) -> DataFrame:
    """Replace NULL by the station's last known value."""
    columns = present(df, columns)
    return slices.last_known(df, {c: F.col(c) for c in columns}, True, width, key, order)


def fill_with_station_mean(
    df: DataFrame, columns: Iterable[str], width: int = slices.DAY, key: str = S.STATION, order: str = S.TIME
) -> DataFrame:
    """Replace NULL by the station's mean.

    Sums are taken per slice and totalled per station over that small table; the mean comes
    back by (station, slice), so a busy station's rows stay spread.
    """
    columns = present(df, columns)
    sliced = slices.cut(df, width, order)
    parts = sliced.groupBy(key, slices.SLICE).agg(
        *[F.sum(units(c)).alias(f"_s_{c}") for c in columns],
        *[F.sum(rest(c)).alias(f"_r_{c}") for c in columns],
        *[F.count(c).alias(f"_k_{c}") for c in columns],
    )
    means = parts.select(key, slices.SLICE, *[_station_mean(c, key).alias(f"_m_{c}") for c in columns])
    filled = {c: F.coalesce(c, f"_m_{c}") for c in columns}
    return slices.attach(sliced, means, key).withColumns(filled).select(*df.columns)


def _station_mean(column: str, key: str) -> Column:
    """Mean over all slices of a station, from their sums ``_s_`` and ``_r_`` and counts ``_k_``."""
    station = Window.partitionBy(key)
    total = F.sum(F.col(f"_s_{column}").cast("decimal(20,0)")).over(station).cast("double") / F.lit(GRID)
    return F.try_divide(total + F.sum(f"_r_{column}").over(station), F.sum(f"_k_{column}").over(station).cast("double"))


def fill_with_global_mean(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Replace NULL by the mean of the whole column, a scalar subquery."""
    columns = present(df, columns)
    row = df.agg(*[mean(c).alias(c) for c in columns])
    filled = {c: F.coalesce(F.col(c), F.col(f"_means.{c}")) for c in columns}
    return lineage.with_scalar(df, row, "_means").withColumns(filled).drop("_means")


def fill_with_global_value(df: DataFrame, columns: Iterable[str], strategy: str = "median") -> DataFrame:
    """Replace NULL by the whole column's ``mean``, exact ``median``, or ``mode``.

    NaN is no value of a median. Of equally frequent values the smallest is the mode.
    """
    columns = present(df, columns)
    if strategy == "mean":
        return fill_with_global_mean(df, columns)
    if strategy == "median":
        row = quantiles.as_one_row(quantiles.exact_quantiles(df, columns, [0.5]), columns, [0.5])
        row = row.select(*[F.col(f"{c}_q0").alias(c) for c in columns])
    elif strategy == "mode":
        tops = [
            df.filter(F.col(c).isNotNull())
            .groupBy(c)
            .agg(F.count("*").alias("_n"))
            .agg(F.min_by(c, F.struct(-F.col("_n"), F.col(c))))
            .scalar()
            .alias(c)
            for c in columns
        ]
        row = df.sparkSession.range(1).select(*tops)
    else:
        raise ValueError(f"strategy must be 'mean', 'median' or 'mode', not {strategy!r}")
    filled = {c: F.coalesce(F.col(c), F.col(f"_values.{c}")) for c in columns}
    return lineage.with_scalar(df, row, "_values").withColumns(filled).drop("_values")


def fill_by_station(
    df: DataFrame,
    columns: Iterable[str],
    strategy: str = "median",
    width: int = slices.DAY,
    key: str = S.STATION,
    order: str = S.TIME,
) -> DataFrame:
    """Replace NULL by the station's exact ``median`` or ``mode``, then by that of all rows so filled.

    NaN is no value of either. The stations' values come back by (station, slice), so a busy
    station's rows stay spread. The rows are staged before and after the first step.
    """
    finders = {"median": quantiles.grouped_quantiles, "mode": quantiles.grouped_modes}
    if strategy not in finders:
        raise ValueError(f"strategy must be 'mean', 'median' or 'mode', not {strategy!r}")
    columns = present(df, columns)
    sliced = lineage.materialise(slices.cut(df, width, order), "filled")
    found = finders[strategy](sliced, key, columns)
    own = [F.max(F.when(F.col("variable") == c, F.col("value"))).cast(dict(df.dtypes)[c]).alias(f"_own_{c}") for c in columns]
    # One row per station and slice, not per reading, meets the station's values.
    per_slice = sliced.select(key, slices.SLICE).distinct().join(found.groupBy(key).agg(*own), key)
    filled = slices.attach(sliced, per_slice, key).withColumns({c: F.coalesce(c, f"_own_{c}") for c in columns})
    stationed = lineage.materialise(filled.select(*df.columns), "filled-by-station")
    return fill_with_global_value(stationed, columns, strategy)


def impute(
    df: DataFrame,
    columns: Iterable[str],
    width: int = slices.DAY,
    key: str = S.STATION,
    order: str = S.TIME,
    stage: bool = False,
    strategy: str = "mean",
) -> DataFrame:
    """Forward fill, then the mean of the filled station, then the global mean of those.

    ``strategy`` may be ``median`` or ``mode`` in place of ``mean``: see ``fill_by_station``.

    All three stages come from one summary row per slice: the last value in it, the sum
    and number of its values once filled from inside, and its row count. Rows at the head
    of a slice take the carried value, so a station's filled sum is known without filling
    its rows first. A column without any value stays NULL.

    With ``stage`` the rows are written to the shared folder once they are filled inside
    their slices: summary, carry and means then read that table, and the raw rows are
    shuffled once.
    """
    columns = present(df, columns)
    if strategy != "mean":
        return fill_by_station(forward_fill(df, columns, width, key, order), columns, strategy, width, key, order)
    sliced = slices.cut(df, width, order)
    frame = slices.inside(key, order).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.withColumns({f"_in_{c}": F.last(c, ignorenulls=True).over(frame) for c in columns})
    if stage:
        local = lineage.materialise(local, "filled")
    fills = _fill_values(local, columns, key, order)
    carry = fills.select(key, slices.SLICE, *[f"_{k}_{c}" for c in columns for k in "cm"])
    joined = lineage.with_scalar(slices.attach(local, carry, key), _global_means(fills, columns), "_all")
    return joined.withColumns(
        {c: F.coalesce(f"_in_{c}", f"_c_{c}", f"_m_{c}", F.col(f"_all.{c}")) for c in columns}
    ).select(*df.columns)


def _fill_values(local: DataFrame, columns: list[str], key: str, order: str) -> DataFrame:
    """Per slice: carried value ``_c_``, station mean ``_m_``, filled sum ``_s_`` and count ``_k_``."""
    summary = local.groupBy(key, slices.SLICE).agg(
        F.count("*").alias("_rows"),
        *slices.last_value_summary({f"_l_{c}": F.col(c) for c in columns}, order),
        *[F.sum(units(f"_in_{c}")).alias(f"_s_{c}") for c in columns],
        *[F.sum(rest(f"_in_{c}")).alias(f"_r_{c}") for c in columns],
        *[F.count(f"_in_{c}").alias(f"_k_{c}") for c in columns],
    )
    before = slices.earlier_slices(key)
    carried = summary.withColumns(
        {f"_c_{c}": F.last(f"_l_{c}", ignorenulls=True).over(before) for c in columns}
    )
    head = {c: F.when(F.col(f"_c_{c}").isNotNull(), F.col("_rows") - F.col(f"_k_{c}")).otherwise(0) for c in columns}
    filled = carried.withColumns(
        {
            **{
                f"_s_{c}": F.coalesce(F.col(f"_s_{c}"), F.lit(0))
                + F.coalesce(units(f"_c_{c}"), F.lit(0)) * head[c]
                for c in columns
            },
            **{
                f"_r_{c}": F.coalesce(F.col(f"_r_{c}"), F.lit(0.0))
                + F.coalesce(rest(f"_c_{c}"), F.lit(0.0)) * head[c]
                for c in columns
            },
            **{f"_k_{c}": F.col(f"_k_{c}") + head[c] for c in columns},
        }
    )
    # A station's slices are few, so these windows see the summary and never the readings.
    return filled.withColumns({f"_m_{c}": _station_mean(c, key) for c in columns})


def _global_means(fills: DataFrame, columns: list[str]) -> DataFrame:
    """Mean of each column after the station stage, one row."""
    aggregates = []
    for c in columns:
        open_rows = F.when(F.col(f"_m_{c}").isNotNull(), F.col("_rows") - F.col(f"_k_{c}")).otherwise(0)
        total = F.sum(F.col(f"_s_{c}").cast("decimal(20,0)")) + F.sum(
            (F.coalesce(units(f"_m_{c}"), F.lit(0)) * open_rows).cast("decimal(20,0)")
        )
        left = F.sum(F.col(f"_r_{c}") + F.coalesce(rest(f"_m_{c}"), F.lit(0.0)) * open_rows)
        filled = F.sum(F.col(f"_k_{c}") + open_rows)
        aggregates.append(
            F.try_divide(total.cast("double") / F.lit(GRID) + left, filled.cast("double")).alias(c)
        )
    return fills.agg(*aggregates)


def clean_measurements(
    df: DataFrame,
    columns: list[str],
    label: str,
    width: int = slices.DAY,
    audit: bool = False,
    stage: bool = True,
    strategy: str = "mean",
) -> DataFrame:
    """Normalise, drop invalid keys, de-duplicate, flag and cap, impute.

    With ``stage`` two tables are written to the shared folder while the plan is built (this
    is the one operator that is not lazy): the rows filled inside their slices, and the
    imputed rows. Later steps read each of them more than once, and neither the raw scan nor
    the de-duplication is repeated for that, not even after the loss of an executor. The
    caller removes them with the run's folder.

    With ``audit`` helper columns stay for the quality report: whether a measurement was
    missing before imputation, and the number of copies of the row.
    """
    require_columns(df, S.REQUIRED["air_quality"], label)
    columns = present(df, columns)
    keep = lineage.materialise if stage else (lambda frame, _name: frame)
    unique = deduplicate(
        valid_keys(standardize_strings(nan_to_null(normalize_timestamps(df), columns), [S.STATION])),
        copies="_copies" if audit else None,
    )
    if audit:
        unique = unique.withColumns({f"_absent_{c}": F.col(c).isNull() for c in columns})
    limits = {c: S.DOMAIN_LIMITS[c] for c in columns if c in S.DOMAIN_LIMITS}
    capped = domain_cap(domain_flags(unique, limits), limits)
    return keep(impute(capped, columns, width, stage=stage, strategy=strategy), "imputed")


def clean_readings(
    df: DataFrame,
    width: int = slices.DAY,
    quantile_method: str = "exact",
    audit: bool = False,
    stage: bool = True,
    strategy: str = "mean",
) -> DataFrame:
    """Air-quality readings ready for integration, with domain and statistical flags."""
    cleaned = clean_measurements(df, S.POLLUTANTS, "Air Quality", width, audit, stage, strategy)
    return iqr_flags(cleaned, S.POLLUTANTS, S.IQR_MULTIPLIER, quantile_method)


def clean_weather(
    df: DataFrame, width: int = slices.DAY, audit: bool = False, stage: bool = True, strategy: str = "mean"
) -> DataFrame:
    return clean_measurements(df, S.WEATHER, "Weather", width, audit, stage, strategy)


def clean_stations(df: DataFrame) -> DataFrame:
    """Trimmed station metadata with a position, one row per station."""
    require_columns(df, S.REQUIRED["stations"], "Station Metadata")
    trimmed = standardize_strings(df, [S.STATION, "city", "state", "station_type"])
    return deduplicate(valid_stations(trimmed), [S.STATION])
