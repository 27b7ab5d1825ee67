"""DuckDB twins of the derived tables and helpers to write oracle queries with."""

from __future__ import annotations

import re

from aerostat import schema as S

POL = S.POLLUTANTS


def R(x: str, places: int) -> str:
    """Round half up on the shortest decimal text, as Spark does."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,22)), {places}) AS DOUBLE)"


def MEAN(x: str, over: str = "") -> str:
    """Mean of an exact decimal sum, twelve places."""
    return f"(CAST(sum(CAST({x} AS DECIMAL(38,12))) {over} AS DOUBLE)/CAST(count({x}) {over} AS DOUBLE))"


def D(x: float) -> str:
    return f"{float(x)!r}e0" if "e" not in repr(float(x)) else repr(float(x))


CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def query(body: str) -> str:
    """Prefix the body with the common table expressions it uses, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, sql in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(sql)
                if name not in needed:
                    needed.append(name)

    visit(body)
    head = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in needed)
    return f"WITH {head}\n{body}" if needed else body


cte("ev", "SELECT *, CAST(regexp_extract(props,'[0-9]+',0) AS DOUBLE) AS k FROM events")
cte(
    "stn",
    f"""SELECT c_custkey AS station_id, c_name AS station_name, n_name AS city, r_name AS state,
  {R('(6.0e0+1.25e0*n_nationkey)', 2)} AS latitude,
  {R('(68.0e0+1.1e0*n_nationkey+0.01e0*(c_custkey%50))', 2)} AS longitude,
  c_acctbal AS elevation, c_mktsegment AS station_type
  FROM customer JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey""",
)
cte(
    "rdg",
    f"""SELECT event_id, user_id AS station_id, ts AS "timestamp",
  CASE WHEN event_id%53=0 THEN -999.0e0 WHEN event_id%37=0 THEN NULL ELSE {R('(1.5e0*value)', 2)} END AS pm2_5,
  CASE WHEN event_id%41=0 THEN NULL ELSE {R('(1.2e0*value+10.0e0)', 2)} END AS pm10,
  {R('(0.9e0*k)', 2)} AS no2,
  {R('(0.5e0*k+CAST(user_id%30 AS DOUBLE))', 2)} AS so2,
  CASE WHEN event_id%43=0 THEN NULL ELSE {R('(value/80.0e0)', 2)} END AS co,
  {R('(0.7e0*k+5.0e0)', 2)} AS o3 FROM ev""",
)
cte(
    "raw",
    """SELECT ' '||CAST(station_id AS VARCHAR)||'  ' AS station_id,
  CASE WHEN event_id%101=0 THEN NULL ELSE date_trunc('second', "timestamp") END AS "timestamp",
  pm2_5, pm10, no2, so2, co, CASE WHEN event_id%59=0 THEN 'nan'::DOUBLE ELSE o3 END AS o3
  FROM (SELECT * FROM rdg UNION ALL
        SELECT event_id, station_id, "timestamp", pm2_5, pm10+5.0e0, no2, so2, co, o3 FROM rdg WHERE event_id%67=0)""",
)
cte(
    "wth",
    f"""SELECT user_id AS station_id, ts AS "timestamp",
  CASE WHEN event_id%31=0 THEN NULL ELSE {R('(10.0e0+0.3e0*k)', 2)} END AS temperature,
  {R('(100.0e0-0.6e0*k)', 2)} AS humidity, {R('(value/20.0e0)', 2)} AS wind_speed,
  {R('(3.6e0*k)', 2)} AS wind_direction, {R('(990.0e0+0.2e0*k)', 2)} AS pressure,
  {R('(CASE WHEN k>90 THEN value/10.0e0 ELSE 0.0e0 END)', 2)} AS rainfall
  FROM ev WHERE event_id%29<>0""",
)
cte(
    "bp",
    "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{std}','{p}',{n},{D(a)},{D(b)},{D(c)},{D(d)})"
        for std in S.STANDARDS
        for p in POL
        for n, (a, b, c, d) in enumerate(S.brackets(std, p))
    )
    + ") t(std, pol, n, clo, chi, ilo, ihi)",
)
cte(
    "cat",
    "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{std}','{n}',{D(lo)},{D(hi)},'{col}','{txt}')"
        for std in S.STANDARDS
        for n, lo, hi, col, txt in S.categories(std)
    )
    + ") t(std, name, lo, hi, color, description)",
)


def sub_index_sql(source: str, std: str, extrapolate: bool = True) -> str:
    """Range joins against the breakpoint table instead of generated CASE branches."""
    cols, joins = [], []
    for i, p in enumerate(POL):
        line = f"((b{i}.ihi-b{i}.ilo)/(b{i}.chi-b{i}.clo))*(r.{p}-b{i}.clo)+b{i}.ilo"
        top = f"((t{i}.ihi-t{i}.ilo)/(t{i}.chi-t{i}.clo))*(r.{p}-t{i}.clo)+t{i}.ilo"
        cols.append(f"CASE WHEN r.{p}>t{i}.chi THEN t{i}.ihi ELSE {R(line, 1)} END AS sub_index_{p}")
        cols.append(f"CASE WHEN r.{p}>t{i}.chi THEN {R(top, 1)} ELSE {R(line, 1)} END AS ext_{p}")
        cols.append(f"r.{p}>t{i}.chi AS beyond_{p}")
        joins.append(f"LEFT JOIN bp b{i} ON b{i}.std='{std}' AND b{i}.pol='{p}' AND r.{p} BETWEEN b{i}.clo AND b{i}.chi")
        last = len(S.brackets(std, p)) - 1
        joins.append(f"LEFT JOIN bp t{i} ON t{i}.std='{std}' AND t{i}.pol='{p}' AND t{i}.n={last}")
    return f"SELECT r.*, {', '.join(cols)} FROM {source} r {' '.join(joins)}"


def index_sql(source: str, std: str) -> str:
    subs = ", ".join(f"coalesce(sub_index_{p},0.0e0)" for p in POL)
    exts = ", ".join(f"coalesce(ext_{p},0.0e0)" for p in POL)
    beyond = " OR ".join(f"beyond_{p}" for p in POL)
    dom = " ".join(
        f"WHEN sub_index_{p}=aqi AND aqi>0 THEN '{p.upper().replace('_', '.')}'" for p in POL
    )
    top = S.categories(std)[-1][0]
    return f"""SELECT i.* EXCLUDE ({', '.join(f'ext_{p}, beyond_{p}' for p in POL)}),
  CASE {dom} ELSE 'None' END AS dominant_pollutant,
  CASE WHEN is_aqi_out_of_range THEN '{top}' ELSE coalesce(c.name,'Unknown') END AS aqi_category
  FROM (SELECT *, least(500.0e0, greatest(0.0e0, {subs})) AS aqi, greatest({exts}) AS extrapolated_aqi,
        ({beyond}) AS is_aqi_out_of_range, ({beyond}) AS aqi_exceedance_flag
        FROM ({sub_index_sql(source, std)})) i
  LEFT JOIN cat c ON c.std='{std}' AND i.aqi BETWEEN c.lo AND c.hi"""


cte("subi", sub_index_sql("rdg", "US_EPA"))
cte("idx", index_sql("rdg", "US_EPA"))
cte("idx_in", index_sql("rdg", "INDIA_CPCB"))
cte("fct", "SELECT i.*, s.* EXCLUDE (station_id) FROM idx i LEFT JOIN stn s USING (station_id)")
cte("ffct", 'SELECT i.*, w.* EXCLUDE (station_id, "timestamp") FROM idx i LEFT JOIN wth w USING (station_id, "timestamp")')
cte(
    "mon",
    f"""SELECT l_suppkey AS station_id, l_shipdate AS "timestamp", {R('(l_quantity*10.0e0)', 1)} AS aqi,
  {R('(l_extendedprice/1000.0e0)', 2)} AS pm2_5 FROM lineitem""",
)

W_STATION = 'PARTITION BY station_id ORDER BY "timestamp"'
UPTO = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def ffill(c: str) -> str:
    return f"last_value({c} IGNORE NULLS) OVER ({W_STATION} {UPTO})"


def limits(c: str) -> tuple[str, str]:
    lo, hi = S.DOMAIN_LIMITS[c]
    return D(lo), D(hi)


def violates(c: str) -> str:
    lo, hi = limits(c)
    return f"({c}<{lo} OR {c}>{hi})"


def capped(c: str) -> str:
    lo, hi = limits(c)
    return f"CASE WHEN {c}<{lo} THEN {lo} WHEN {c}>{hi} THEN {hi} ELSE {c} END"


def impute_ctes(prefix: str, source: str, cols: list[str], keep: str) -> None:
    """Three imputation stages as CTEs ``<prefix>1``, ``<prefix>2``, ``<prefix>3``."""
    cte(f"{prefix}1", f"SELECT {keep}, {', '.join(f'{ffill(c)} AS {c}' for c in cols)} FROM {source}")
    station, everywhere = "OVER (PARTITION BY station_id)", "OVER ()"
    cte(f"{prefix}2", f"SELECT {keep}, {', '.join(f'coalesce({c},{MEAN(c, station)}) AS {c}' for c in cols)} FROM {prefix}1")
    cte(f"{prefix}3", f"SELECT {keep}, {', '.join(f'coalesce({c},{MEAN(c, everywhere)}) AS {c}' for c in cols)} FROM {prefix}2")


impute_ctes("imp", "rdg", POL, 'station_id, "timestamp"')


def clean_ctes(prefix: str, source: str, cols: list[str]) -> None:
    """Valid keys, de-duplication, flags and caps as ``<prefix>v``, ``u``, ``d``; then imputation."""
    cte(
        f"{prefix}v",
        f"""SELECT trim(CAST(station_id AS VARCHAR)) AS station_id, "timestamp",
  {', '.join(f'CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS {c}' for c in cols)}
  FROM {source} WHERE "timestamp" IS NOT NULL AND station_id IS NOT NULL""",
    )
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in cols)
    cte(
        f"{prefix}u",
        f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY station_id, "timestamp" ORDER BY {order}) AS rn
  FROM {prefix}v) WHERE rn=1""",
    )
    flags = ", ".join(f"{violates(c)} AS is_{c}_domain_outlier" for c in cols)
    anyf = " OR ".join(violates(c) for c in cols)
    cte(
        f"{prefix}d",
        f"""SELECT station_id, "timestamp", {', '.join(f'{capped(c)} AS {c}' for c in cols)}, {flags}, ({anyf}) AS is_any_domain_outlier
  FROM {prefix}u""",
    )
    keep = 'station_id, "timestamp", is_any_domain_outlier, ' + ", ".join(f"is_{c}_domain_outlier" for c in cols)
    impute_ctes(f"{prefix}f", f"{prefix}d", cols, keep)


clean_ctes("cr", "raw", POL)
clean_ctes("cw", "wth", S.WEATHER)


def bounds_sql(source: str, cols: list[str]) -> str:
    parts = [
        f"SELECT '{c}' AS variable, quantile_cont({c},0.25) AS q1, quantile_cont({c},0.75) AS q3 FROM {source}"
        for c in cols
    ]
    return (
        "SELECT variable, q1, q3, q1-3.0e0*(q3-q1) AS lower, q3+3.0e0*(q3-q1) AS upper FROM ("
        + " UNION ALL ".join(parts)
        + ")"
    )


def iqr_flag_sql(source: str, cols: list[str]) -> str:
    b = f"({bounds_sql(source, cols)})"
    rows = ", ".join(
        f"max(lower) FILTER (WHERE variable='{c}') AS lo_{c}, max(upper) FILTER (WHERE variable='{c}') AS hi_{c}"
        for c in cols
    )
    flag = {c: f"({c}<lo_{c} OR {c}>hi_{c})" for c in cols}
    return f"""SELECT s.*, {', '.join(f'{flag[c]} AS is_{c}_outlier' for c in cols)},
  ({' OR '.join(flag.values())}) AS is_any_outlier FROM {source} s, (SELECT {rows} FROM {b}) b"""


cte("crq", iqr_flag_sql("crf3", POL))


def tall(source: str, rows: list[tuple[str, str]], key: str, value: str, kind: str = "DOUBLE") -> str:
    """One aggregate row to ``(key, value)`` rows."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {key}, CAST({expr} AS {kind}) AS {value} FROM {source}" for name, expr in rows
    )
