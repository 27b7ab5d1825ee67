"""Piecewise-linear air-quality index as native column expressions.

The expressions are generated as SQL text from the bracket tables: a CASE finds the
bracket's number, and three constant arrays hold its line. That keeps the generated
code small enough for the JVM to compile, which seven rounded branches per pollutant
are not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerostat import schema as S

TOP_INDEX = 500.0
RESEARCH_CAP = 999.0


def _number(x: float) -> str:
    return f"{float(x)!r}D"


def _array(values: list[float]) -> str:
    return f"array({', '.join(_number(v) for v in values)})"


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _reading(column: str, pollutant: str, standard: str, gap_policy: str) -> str:
    """The concentration as the tables see it."""
    if gap_policy == "null":
        return column
    if gap_policy != "truncate":
        raise ValueError(f"gap_policy must be 'null' or 'truncate', not {gap_policy!r}")
    bounds = [b for row in S.brackets(standard, pollutant) for b in row[:2]]
    step = _number(1.0 if all(b.is_integer() for b in bounds) else 10.0)
    cut = f"CAST(floor(round({column} * {step}, 6)) AS DOUBLE) / {step}"
    return f"(CASE WHEN {column} <= {_number(bounds[-1])} THEN {cut} ELSE {column} END)"


def _bracket_number(conc: str, rows: list[tuple[float, float, float, float]]) -> str:
    found = " ".join(
        f"WHEN {conc} >= {_number(lo)} AND {conc} <= {_number(hi)} THEN {n}" for n, (lo, hi, _, _) in enumerate(rows)
    )
    return f"CASE {found} WHEN {conc} > {_number(rows[-1][1])} THEN {len(rows) - 1} END"


def _line(conc: str, rows: list[tuple[float, float, float, float]], number: str) -> str:
    slopes = _array([(i_hi - i_lo) / (c_hi - c_lo) for c_lo, c_hi, i_lo, i_hi in rows])
    starts, bases = _array([r[0] for r in rows]), _array([r[2] for r in rows])
    return f"round(get({slopes}, {number}) * ({conc} - get({starts}, {number})) + get({bases}, {number}), 1)"


def _extrapolated(column: str, pollutant: str, standard: str, gap_policy: str) -> str:
    rows = S.brackets(standard, pollutant)
    conc = _reading(column, pollutant, standard, gap_policy)
    return _line(conc, rows, f"({_bracket_number(conc, rows)})")


def bracket_number(column: str, pollutant: str, standard: str = "US_EPA", gap_policy: str = "null") -> Column:
    """Position of the concentration's bracket; the last one also covers what lies beyond."""
    conc = _reading(column, pollutant, standard, gap_policy)
    return F.expr(_bracket_number(conc, S.brackets(standard, pollutant)))


def bracket_line(column: str, number: str, pollutant: str, standard: str = "US_EPA", gap_policy: str = "null"):
    """Extrapolated sub-index of a concentration whose bracket number is in a column."""
    conc = _reading(column, pollutant, standard, gap_policy)
    return F.expr(_line(conc, S.brackets(standard, pollutant), number))


def extrapolated_sub_index(
    column: str, pollutant: str, standard: str = "US_EPA", gap_policy: str = "null"
) -> Column:
    """Sub-index that follows the last bracket's line beyond the table, uncapped.

    Concentrations that are negative, NULL, or between two brackets give NULL.
    """
    return F.expr(_extrapolated(column, pollutant, standard, gap_policy))


def sub_index(column: str, pollutant: str, standard: str = "US_EPA", gap_policy: str = "null", line: str | None = None):
    """Sub-index that stays at the top of the scale beyond the table.

    ``line`` names a column that already holds the extrapolated sub-index.
    """
    line = line or _extrapolated(column, pollutant, standard, gap_policy)
    _, c_hi, _, i_hi = S.brackets(standard, pollutant)[-1]
    return F.expr(f"CASE WHEN {column} > {_number(c_hi)} THEN {_number(i_hi)} ELSE {line} END")


def research_sub_index(column: str, pollutant: str, standard: str = "US_EPA") -> Column:
    """Extrapolated sub-index limited to 999."""
    value = _extrapolated(column, pollutant, standard, "null")
    # LEAST skips NULL and would answer 999.
    return F.expr(f"CASE WHEN {value} IS NOT NULL THEN least({value}, {_number(RESEARCH_CAP)}) END")


def beyond_table(columns: list[str], standard: str = "US_EPA") -> Column:
    """Three-valued: whether any pollutant exceeds its table."""
    return F.expr(" OR ".join(f"({p} > {_number(S.brackets(standard, p)[-1][1])})" for p in columns))


def highest(columns: list[str]) -> Column:
    """Row maximum in which an absent sub-index counts as zero."""
    return F.expr(_highest(columns))


def _highest(columns: list[str]) -> str:
    return f"greatest(0.0D, {', '.join(f'coalesce({c}, 0.0D)' for c in columns)})"


def overall_index(columns: list[str]) -> Column:
    return F.expr(f"least({_number(TOP_INDEX)}, {_highest(columns)})")


def dominant(pollutants: list[str], aqi: str = "aqi") -> Column:
    """First pollutant, in table order, whose sub-index makes the overall index."""
    names = [p for p in S.POLLUTANTS if p in pollutants]
    if not names:
        return F.lit("None")
    found = " ".join(f"WHEN sub_index_{p} = {aqi} THEN {_text(p.upper().replace('_', '.'))}" for p in names)
    return F.expr(f"CASE WHEN NOT coalesce({aqi} > 0, false) THEN 'None' {found} ELSE 'None' END")


def category_label(aqi: str = "aqi", out_of_range: str = "is_aqi_out_of_range", standard: str = "US_EPA") -> Column:
    rows = S.categories(standard)
    found = " ".join(f"WHEN {aqi} BETWEEN {_number(lo)} AND {_number(hi)} THEN {_text(n)}" for n, lo, hi, _, _ in rows)
    return F.expr(f"CASE WHEN {out_of_range} THEN {_text(rows[-1][0])} {found} ELSE 'Unknown' END")


def category_info(aqi: str = "aqi", standard: str = "US_EPA") -> Column:
    """Struct of category, color and description for an index value.

    A standard has six rows, so the look-up is a CASE over a constant array: no join.
    """
    rows = S.categories(standard)
    entries = [(n, colour, text) for n, _, _, colour, text in rows]
    entries += [S.CATEGORY_UNKNOWN, S.CATEGORY_BEYOND, S.CATEGORY_UNMATCHED]
    structs = ", ".join(
        f"named_struct('category', {_text(a)}, 'color', {_text(b)}, 'description', {_text(c)})" for a, b, c in entries
    )
    n = len(rows)
    found = " ".join(f"WHEN {aqi} BETWEEN {_number(lo)} AND {_number(hi)} THEN {i}" for i, (_, lo, hi, _, _) in enumerate(rows))
    number = (
        f"CASE WHEN {aqi} IS NULL OR {aqi} < 0 THEN {n} {found} WHEN {aqi} > {_number(TOP_INDEX)} THEN {n + 1} "
        f"ELSE {n + 2} END"
    )
    return F.expr(f"get(array({structs}), {number})")
