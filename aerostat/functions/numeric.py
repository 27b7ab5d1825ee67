"""Order-free sums and means.

Adding doubles in a different task order moves the last bits of the sum, and a
mean that lies on a rounding tie then flips between runs. Measurements are
therefore put on a grid of 1e-6 and summed as integers, which is exact whatever
the task order. The integer is split in two parts so that neither 64-bit sum can
overflow below 2**43 rows, and both stay in hash aggregation. What the grid cuts
off is summed beside it as a double: it is zero for readings of up to six places,
and otherwise so small that its rounding stays far below any place shown. NaN,
infinities and values beyond the grid's range live in that double alone, so they
come through as in ``avg``.

Arguments are column names or SQL expressions: one parse each, where composing
Column objects would cross into the JVM a dozen times.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

GRID = 1_000_000.0
_LOW_BITS = 20
_LOW_SPAN = 1 << _LOW_BITS


_REACH = 1e12  # readings beyond are not put on the grid


def units_sql(value: str) -> str:
    # Comparing first keeps NaN, which is the greatest number, and infinities off the grid.
    on_grid = f"abs(CAST({value} AS DOUBLE)) <= {_REACH!r}D"
    return f"CASE WHEN {on_grid} THEN floor(({value}) * {GRID!r}D + 0.5D) WHEN ({value}) IS NOT NULL THEN 0L END"


def rest_sql(value: str) -> str:
    """What the grid leaves over of a value."""
    return f"(CAST({value} AS DOUBLE) - CAST({units_sql(value)} AS DOUBLE) / {GRID!r}D)"


def units(value: str) -> Column:
    """The value as a whole number of grid steps (bigint)."""
    return F.expr(units_sql(value))


def rest(value: str) -> Column:
    """What the grid leaves over of a value (double)."""
    return F.expr(rest_sql(value))


_PARTS = ("hi", "lo", "rest", "n")


def _parts(value: str, sign: str = "") -> tuple[str, str, str, str]:
    """Sums of the high and low part, of the rest, and the count; ``sign`` is a factor of each."""
    factor = f" * {sign}" if sign else ""
    steps = f"({units_sql(value)})"
    return (
        f"sum(shiftright({steps}, {_LOW_BITS}){factor})",
        f"sum(({steps} & {_LOW_SPAN - 1}L){factor})",
        f"sum({rest_sql(value)}{factor})",
        f"count({value})",
    )


def _joined(high: str, low: str, rest: str) -> str:
    return f"((CAST({high} AS DOUBLE) * {float(_LOW_SPAN)!r}D + CAST({low} AS DOUBLE)) / {GRID!r}D + {rest})"


def partial_sums(value: str, name: str) -> list[Column]:
    """Mergeable parts of an exact sum: ``<name>_hi``, ``<name>_lo``, ``<name>_rest``, ``<name>_n``."""
    return [F.expr(f"{sql} AS {name}_{part}") for part, sql in zip(_PARTS, _parts(value))]


def merge_sums(name: str) -> list[Column]:
    """Second-level aggregation of :func:`partial_sums` columns."""
    return [F.expr(f"sum({name}_{part}) AS {name}_{part}") for part in _PARTS]


def mean_from(name: str, places: int | None = None) -> Column:
    """The mean held by merged :func:`partial_sums` columns."""
    total = _joined(*(f"{name}_{part}" for part in _PARTS[:3]))
    return F.expr(_rounded(f"try_divide({total}, CAST({name}_n AS DOUBLE))", places))


def mean(value: str, places: int | None = None) -> Column:
    """Aggregate mean of the non-null values, NULL when there are none."""
    *sums, count = _parts(value)
    return F.expr(_rounded(f"try_divide({_joined(*sums)}, CAST({count} AS DOUBLE))", places))


def running_sum(value: str, sign: str, over: WindowSpec) -> Column:
    """Running total of ``sign`` (1 or -1) times the value: what entered leaves to the last step."""
    high, low, rest, _ = (F.expr(sql).over(over) for sql in _parts(value, sign))
    return (high.cast("double") * F.lit(float(_LOW_SPAN)) + low.cast("double")) / F.lit(GRID) + rest


def _rounded(sql: str, places: int | None) -> str:
    return sql if places is None else f"round({sql}, {places})"
