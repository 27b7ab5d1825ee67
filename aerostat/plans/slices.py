"""Time-series windows that no single station can overload.

A window over ``partitionBy(station)`` puts a whole station in one task; one busy
station may hold a third of the table. Here every station is cut into time
slices of fixed width, windows run inside ``(station, slice)``, and what a row
needs from before its slice comes from a small table with one row per slice:

    summary   group by (station, slice), partially aggregated before the shuffle
    carry     window over the summary by station: one row per slice, not per reading
    rows      window inside (station, slice), then join the carry on (station, slice)

Readings are unique per (station, timestamp) after de-duplication, so with
timestamps in whole seconds a slice never holds more rows than it has seconds,
whatever the table size. Faster sensors want a narrower slice. The join keeps the
window's partitioning, so the wide table is shuffled once.

Rows need a non-null station and timestamp; ``cleaning.valid_keys`` sees to that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostat import schema as S
from aerostat.functions.calendar import epoch
from aerostat.functions.numeric import running_sum

DAY = 86_400
SLICE = "_slice"


def slice_of(seconds: Column, width: int) -> Column:
    return F.floor(seconds / F.lit(width))


def cut(df: DataFrame, width: int = DAY, order: str = S.TIME) -> DataFrame:
    """Add the slice number of each row."""
    return df.withColumn(SLICE, slice_of(epoch(F.col(order)), width))


def inside(key: str = S.STATION, order: str = S.TIME):
    """Window over one slice of one station, in time order.

    Readings that repeat a station and time must be de-duplicated first: their order is open.
    """
    return Window.partitionBy(key, SLICE).orderBy(order)


def earlier_slices(key: str = S.STATION):
    """Window over the summary rows of a station that precede the current slice."""
    return Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def last_value_summary(values: dict[str, Column], order: str = S.TIME) -> list[Column]:
    """Aggregates for the last non-null value of each expression in a slice."""
    return [
        F.max_by(value, F.when(value.isNotNull(), F.col(order))).alias(name) for name, value in values.items()
    ]


def carry_last(
    sliced: DataFrame, values: dict[str, Column], key: str = S.STATION, order: str = S.TIME
) -> DataFrame:
    """Per slice: the last non-null value of each expression before the slice."""
    summary = sliced.groupBy(key, SLICE).agg(*last_value_summary(values, order))
    before = earlier_slices(key)
    return summary.select(key, SLICE, *[F.last(n, ignorenulls=True).over(before).alias(n) for n in values])


def attach(sliced: DataFrame, carry: DataFrame, key: str = S.STATION) -> DataFrame:
    return sliced.join(carry, [key, SLICE], "left")


def last_known(
    df: DataFrame,
    values: dict[str, Column],
    include_current: bool,
    width: int = DAY,
    key: str = S.STATION,
    order: str = S.TIME,
) -> DataFrame:
    """Add, per row, the last non-null value of each expression so far in its station."""
    sliced = cut(df, width, order)
    frame = inside(key, order).rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    local = sliced.withColumns(
        {f"_in_{n}": F.last(v, ignorenulls=True).over(frame) for n, v in values.items()}
    )
    carry = carry_last(sliced, {f"_before_{n}": v for n, v in values.items()}, key, order)
    joined = attach(local, carry, key)
    kept = [c for c in df.columns if c not in values]
    return joined.select(
        *kept, *[F.coalesce(f"_in_{n}", f"_before_{n}").alias(n) for n in values]
    ).select(*df.columns, *[n for n in values if n not in df.columns])


def previous_rows(
    df: DataFrame,
    columns: dict[str, str],
    depth: int = 1,
    width: int = DAY,
    key: str = S.STATION,
    order: str = S.TIME,
) -> DataFrame:
    """Add ``<name>_1 .. <name>_<depth>``: the column's value that many rows earlier.

    ``columns`` maps an output prefix to an input column. NULL values are kept:
    the n-th previous row is counted by position, as ``lag`` does.
    """
    sliced = cut(df, width, order)
    window = inside(key, order)
    local = sliced.withColumn("_nth", F.row_number().over(window)).withColumns(
        {
            f"{name}_{j}": F.lag(source, j).over(window)
            for name, source in columns.items()
            for j in range(1, depth + 1)
        }
    )
    joined = attach(local, _carry_tail(sliced, columns, depth, key, order), key)
    results = {}
    for name in columns:
        for j in range(1, depth + 1):
            # Row number n has n-1 predecessors in its slice; the rest come from the carried tail.
            carried = F.get(F.col("_tail"), F.lit(j) - F.col("_nth"))[name]
            results[f"{name}_{j}"] = F.when(F.col("_nth") > j, F.col(f"{name}_{j}")).otherwise(carried)
    return joined.withColumns(results).drop(SLICE, "_nth", "_tail")


def _carry_tail(sliced: DataFrame, columns: dict[str, str], depth: int, key: str, order: str) -> DataFrame:
    """Per slice: the ``depth`` rows before it, newest first."""
    row = F.struct(*[F.col(source).alias(name) for name, source in columns.items()])
    if depth == 1:
        summary = sliced.groupBy(key, SLICE).agg(
            *[F.max_by(source, order).alias(name) for name, source in columns.items()]
        )
        tails = summary.select(key, SLICE, F.array(F.struct(*columns)).alias("_rows"))
    else:
        newest = Window.partitionBy(key, SLICE).orderBy(F.col("_at").desc())
        # A row_number limit is applied before the shuffle as well as after it.
        tails = (
            sliced.select(key, SLICE, F.col(order).alias("_at"), row.alias("_row"))
            .withColumn("_rank", F.row_number().over(newest))
            .filter(F.col("_rank") <= depth)
            .groupBy(key, SLICE)
            .agg(F.array_sort(F.collect_list(F.struct("_rank", "_row"))).alias("_ranked"))
            .select(key, SLICE, F.col("_ranked")["_row"].alias("_rows"))
        )
    by_slice = Window.partitionBy(key).orderBy(SLICE)
    # Every slice has at least one row, so ``depth`` earlier slices hold enough of them.
    earlier = [F.coalesce(F.lag("_rows", j).over(by_slice), F.array()) for j in range(1, depth + 1)]
    return tails.select(key, SLICE, F.slice(F.concat(*earlier), 1, depth).alias("_tail"))


def trailing_mean(
    df: DataFrame,
    column: str,
    seconds: int,
    output: str,
    places: int | None = 2,
    width: int = DAY,
    key: str = S.STATION,
    order: str = S.TIME,
) -> DataFrame:
    """Mean of ``column`` over ``[t - seconds, t]`` of the same station, both ends included.

    A range frame re-reads its rows for every output row, which is quadratic for a
    dense station. Instead each reading enters a ledger when it is taken and leaves it
    when it expires; the running total of the ledger is the window's sum. Totals are
    integer sums, so what enters leaves without a remainder; NaN and infinities count
    as missing. A reading that outlives its slice opens the next slice as well, so no
    slice depends on another.
    """
    width = max(width, seconds)
    at = epoch(F.col(order))
    home = slice_of(at, width)
    expiry = at + F.lit(seconds + 1)
    outlives = expiry >= (home + 1) * F.lit(width)
    # NaN is the greatest number, so one comparison excludes it with the infinities.
    value = F.when(F.abs(F.col(column)) < F.lit(float("inf")), F.col(column))

    def entry(slot: Column, when: Column, sign: int, own: bool) -> Column:
        payload = F.struct(*[F.col(c) for c in df.columns])
        return F.struct(
            slot.alias("slot"),
            when.alias("at"),
            F.lit(sign).alias("sign"),
            value.alias("value"),
            (payload if own else F.when(F.lit(False), payload)).alias("row"),
        )

    ledger = F.when(
        outlives,
        F.array(
            entry(home, at, 1, True), entry(home + 1, at, 1, False), entry(home + 1, expiry, -1, False)
        ),
    ).otherwise(F.array(entry(home, at, 1, True), entry(home, expiry, -1, False)))
    events = df.select(F.col(key).alias("_key"), F.explode(ledger).alias("e")).select(
        "_key", F.col("e.slot").alias(SLICE), "e.at", "e.sign", "e.value", "e.row"
    )
    running = (
        Window.partitionBy("_key", SLICE)
        .orderBy("at")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    present = F.when(F.col("value").isNotNull(), F.col("sign"))
    total = running_sum("value", "sign", running)
    mean = F.try_divide(total, F.sum(present).over(running).cast("double"))
    result = mean if places is None else F.round(mean, places)
    return (
        events.withColumn("_mean", result)
        .filter(F.col("row").isNotNull())
        .select("row.*", F.col("_mean").alias(output))
    )
