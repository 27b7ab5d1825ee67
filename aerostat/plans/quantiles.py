"""Exact quantiles in two reads, without gathering a column in one task.

``percentile`` keeps every distinct value of the column in one reducer. Here a mergeable sketch of
each column (one read) gives an interval of values around every wanted rank. The second read counts
the readings below each interval and, value by value, those inside it: a few hundredths of the
rows at most, combined on the map side and staged. The ranks are then searched in that table alone: an
interval is cut into ``CELLS`` equal cells, the cell that holds the rank is cut again, until it
holds a single value. Cells are ordered, never readings.

A sketch may miss; the counts show it, and the interval of such a rank is widened to the whole range
and read again, so the result never depends on the sketch.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerostat.plans.lineage import materialise, release

CELLS = 65_536
SKETCH = 1024  # size of the sketches; a rank may be off by half a hundredth of the rows
MARGIN = 0.01  # of the rows, that an interval reaches beyond its ranks on either side
_MOST_LEVELS = 500  # one or two are usual; values over all magnitudes take up to 150


@dataclass(frozen=True)
class _Search:
    """A rank of a column, somewhere in the closed interval, above ``below`` readings."""

    variable: str
    p: float
    fraction: float
    rank: int
    lo: float
    hi: float
    below: int = 0
    bracket: int = 0


def _cell(v: Column, low: Column, high: Column, cells: int) -> Column:
    """The cell of a value in ``[low, high]``. Either end has a cell of its own, so that an interval
    shrinks also where its span is infinite; halves first, so that a finite span cannot overflow."""
    share = F.try_divide(v / 2 - low / 2, high / 2 - low / 2)
    middle = F.when(F.isnan(share), 1).otherwise(F.floor(share * cells))
    inner = F.greatest(F.least(middle, F.lit(cells - 2)), F.lit(1))
    return F.when(v <= low, 0).when(v >= high, cells - 1).otherwise(inner).cast("int")


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    interpolate: bool = True,
    cells: int = CELLS,
    margin: float = MARGIN,
) -> DataFrame:
    """Rows ``(variable, p, value)`` for every column with a value.

    With ``interpolate`` the value is linear between the two nearest ranks, otherwise it is the
    smallest observed value whose share reaches ``p``. NULL and NaN are missing values. The
    input is read while the plan is built; the driver keeps a few numbers per column and
    probability, the shared folder the readings near the wanted ranks until they are found.
    """
    numbers = {c: F.col(c).cast("double") for c in columns}
    df = df.select(*[F.when(~F.isnan(v), v + F.lit(0.0)).alias(c) for c, v in numbers.items()])
    values = {c: F.col(c) for c in numbers}
    open_, ends = _bracketed(df, values, probabilities, interpolate, margin)
    done: list[_Search] = []
    while open_:
        near, counted = _near(df, values, open_)
        held = [s for s in counted if 0 <= s.rank - s.below < near.sizes[s.bracket]]
        for _ in range(_MOST_LEVELS):
            done += [s for s in held if s.lo >= s.hi]
            held = [s for s in held if s.lo < s.hi]
            if not held:
                break
            held = _narrowed(near.rows, held, cells)
        else:
            raise RuntimeError("quantiles did not settle")
        release(near.staged)
        missed = [s for s in counted if not 0 <= s.rank - s.below < near.sizes[s.bracket]]
        open_ = [replace(s, lo=ends[s.variable][0], hi=ends[s.variable][1], below=0) for s in missed]
    return _found(df.sparkSession, done)


def _bracketed(
    df: DataFrame, values: dict[str, Column], probabilities: list[float], interpolate: bool, margin: float
) -> tuple[list[_Search], dict[str, tuple[float, float]]]:
    """An interval around each wanted rank from one sketch per column, and each column's range."""
    per_column = [
        f(values[c]).alias(f"{n}_{c}")
        for c in values
        for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max), ("sketch", lambda v: F.kll_sketch_agg_double(v, SKETCH)))
    ]
    row = df.agg(*per_column)
    told = []
    for c in values:
        n = F.col(f"n_{c}")

        shares = [min(max(p + side, 0.0), 1.0) for p in probabilities for side in (-margin, margin)]
        sketched = F.kll_sketch_get_quantile_double(F.col(f"sketch_{c}"), F.array(*map(F.lit, shares)))

        def at(i: int, end: str, c: str = c, n: Column = n) -> Column:
            """A sketched end of the interval; the column's own where a margin is not even a few rows."""
            return F.when(n * margin < 4, F.col(f"{end}_{c}")).otherwise(F.get(F.col(f"at_{c}"), F.lit(i)))

        row = row.withColumn(f"at_{c}", F.when(n > 0, sketched))  # an empty sketch has no quantiles
        for i, p in enumerate(probabilities):
            r = _ranks(p, n, interpolate)
            inside = F.struct(
                F.lit(c).alias("variable"),
                r["p"].alias("p"),
                r["fraction"].alias("fraction"),
                r["low"].alias("low"),
                r["high"].alias("high"),
                at(2 * i, "lo").alias("lo"),
                at(2 * i + 1, "hi").alias("hi"),
                F.col(f"lo_{c}").alias("least"),
                F.col(f"hi_{c}").alias("most"),
            )
            told.append(F.when(n > 0, inside))
    found = row.select(F.explode(F.array_compact(F.array(*told))).alias("r")).select("r.*").collect()
    searches = [
        _Search(r.variable, r.p, r.fraction, rank, r.lo, r.hi) for r in found for rank in sorted({r.low, r.high})
    ]
    return searches, {r.variable: (r.least, r.most) for r in found}


@dataclass(frozen=True)
class _Near:
    """Readings inside the brackets, as ``variable, v, n``, and how many each bracket holds."""

    rows: DataFrame
    staged: DataFrame
    sizes: dict[int, int]


def _present(df: DataFrame, items: list[Column], *kept: str) -> DataFrame:
    """One row ``x`` for each item that is not NULL, with the ``kept`` columns.

    The items are an array column first: inside the generator they, or a filter of the array, would be
    interpreted node by node for every row.
    """
    return df.select(*kept, F.array(*items).alias("_items")).select(*kept, F.explode("_items").alias("x")).filter("x IS NOT NULL")


def _near(df: DataFrame, values: dict[str, Column], searches: list[_Search]) -> tuple[_Near, list[_Search]]:
    """One read of the input: what lies inside the brackets is staged, what lies below is counted."""
    # The brackets of a column cut its values into zones; every reading is in one of them.
    cuts = {c: sorted({v for s in searches if s.variable == c for v in (s.lo, s.hi)}) for c in {s.variable for s in searches}}
    hits = []
    for c, at in cuts.items():
        # Zone 2i holds what is below the i-th cut, zone 2i + 1 the cut itself.
        zone, wanted = F.lit(None).cast("int"), F.lit(False)
        for i, cut in reversed(list(enumerate(at))):
            zone = F.when(values[c] < cut, 2 * i).when(values[c] == cut, 2 * i + 1).otherwise(zone)
        for s in searches:
            if s.variable == c:
                wanted |= values[c].between(s.lo, s.hi)
        hits.append(F.when(values[c] <= at[-1], F.struct(F.lit(c).alias("variable"), zone.alias("zone"), F.when(wanted, values[c]).alias("v"))))
    taken = _present(df, hits).groupBy("x.variable", "x.zone", "x.v")
    rows = materialise(taken.agg(F.count(F.lit(1)).alias("n")), "quantiles")
    counts = {(r.variable, r.zone): r.n for r in rows.groupBy("variable", "zone").agg(F.sum("n").alias("n")).collect()}
    placed, sizes = [], {}
    for i, s in enumerate(searches):
        first, last = 2 * cuts[s.variable].index(s.lo) + 1, 2 * cuts[s.variable].index(s.hi) + 1
        placed.append(replace(s, bracket=i, below=sum(counts.get((s.variable, z), 0) for z in range(first))))
        sizes[i] = sum(counts.get((s.variable, z), 0) for z in range(first, last + 1))
    return _Near(rows.filter("v IS NOT NULL"), rows, sizes), placed


def _narrowed(near: DataFrame, searches: list[_Search], cells: int) -> list[_Search]:
    """Every interval cut down to the cell that holds its rank."""
    intervals = sorted({(s.variable, s.lo, s.hi) for s in searches})
    number = {key: i for i, key in enumerate(intervals)}
    hits = [
        F.when(
            (F.col("variable") == variable) & F.col("v").between(lo, hi),
            F.struct(F.lit(i).alias("i"), _cell(F.col("v"), F.lit(lo), F.lit(hi), cells).alias("cell")),
        )
        for (variable, lo, hi), i in number.items()
    ]
    placed = _present(near, hits, "v", "n")
    counted = placed.groupBy("x.i", "x.cell").agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    ahead = Window.partitionBy("i").orderBy("cell")
    summed = counted.withColumn("to", F.sum("n").over(ahead)).withColumn("from", F.col("to") - F.col("n"))
    wanted = {(number[s.variable, s.lo, s.hi], s.rank - s.below) for s in searches}
    holds = F.lit(False)
    for i, rank in sorted(wanted):
        holds |= (F.col("i") == i) & (F.col("from") <= rank) & (F.col("to") > rank)
    cells_ = summed.filter(holds).select("i", "from", "to", "lo", "hi").collect()  # at most one per search
    out = []
    for s in searches:
        i, rank = number[s.variable, s.lo, s.hi], s.rank - s.below
        (cell,) = [c for c in cells_ if c["i"] == i and c["from"] <= rank < c["to"]]
        out.append(replace(s, lo=cell["lo"], hi=cell["hi"], below=s.below + cell["from"]))
    return out


def _found(spark: SparkSession, done: list[_Search]) -> DataFrame:
    """The quantiles between their two ranks, or at the only one."""
    pairs: dict[tuple[str, float], list[_Search]] = {}
    for s in sorted(done, key=lambda s: s.rank):
        pairs.setdefault((s.variable, s.p), []).append(s)
    rows = [
        F.struct(
            F.lit(variable).alias("variable"),
            F.lit(p).alias("p"),
            (F.lit(ends[0].lo) + (F.lit(ends[-1].lo) - F.lit(ends[0].lo)) * F.lit(ends[0].fraction)).alias("value"),
        )
        for (variable, p), ends in pairs.items()
    ]
    table = F.array(*rows) if rows else F.array().cast("array<struct<variable:string,p:double,value:double>>")
    return spark.range(1).select(F.inline(table))


def _ranks(p: float, total: Column, interpolate: bool) -> Column:
    """Zero-based ranks that decide quantile ``p`` of ``total`` values."""
    if interpolate:
        position = F.lit(float(p)) * (total - 1).cast("double")
        low = F.floor(position)
        high = F.ceil(position)
        fraction = position - low
    else:
        low = high = F.greatest(F.ceil(F.lit(float(p)) * total.cast("double")) - 1, F.lit(0))
        fraction = F.lit(0.0)
    return F.struct(
        F.lit(float(p)).alias("p"),
        low.cast("long").alias("low"),
        high.cast("long").alias("high"),
        fraction.cast("double").alias("fraction"),
    )


GROUP_CELLS = 4096  # of a group's interval
FEW = 4096  # rows of a group up to which one task sorts them
_SALTS = 16  # tasks over which the different values of a group are spread


def value_counts(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows ``(key, variable, v, n)``: how often a group has each value; NULL and NaN are none.

    Equal values are combined before the shuffle, and a group's values spread over all tasks.
    """
    tall = []
    for c in columns:
        v = F.col(c).cast("double") + F.lit(0.0)
        tall.append(F.when(v.isNotNull() & ~F.isnan(v), F.struct(F.lit(c).alias("variable"), v.alias("v"))))
    return _present(df, tall, key).groupBy(key, "x.variable", "x.v").agg(F.count(F.lit(1)).alias("n"))


def grouped_modes(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows ``(key, variable, value)``: each group's most frequent value, the smallest of equals."""
    first = F.min(F.struct((-F.col("n")).alias("minus"), "v")).getField("v")
    return value_counts(df, key, columns).groupBy(key, "variable").agg(first.alias("value"))


def grouped_quantiles(
    df: DataFrame, key: str, columns: list[str], p: float = 0.5, cells: int = GROUP_CELLS, few: int = FEW
) -> DataFrame:
    """Rows ``(key, variable, value)``: the exact quantile of each group, linear between two ranks.

    Groups of at most ``few`` rows are sorted, each as one array. The others, of which there are at
    most a ``few``-th of the rows, are searched. Rows without a key belong to no group.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    busy = materialise(sizes.filter(F.col(key).isNotNull() & (F.col("rows") > few)).select(key), "group-busy")
    keyed = df.filter(F.col(key).isNotNull())
    if busy.isEmpty():
        return _sorted_quantiles(keyed, key, columns, p)
    found = _searched_quantiles(keyed.join(busy, key, "left_semi"), key, columns, p, cells)
    return _sorted_quantiles(keyed.join(busy, key, "left_anti"), key, columns, p).unionByName(found)


def _sorted_quantiles(df: DataFrame, key: str, columns: list[str], p: float) -> DataFrame:
    """Quantiles of groups whose values fit one array each."""
    values = [F.col(c).cast("double") + F.lit(0.0) for c in columns]
    arrays = [F.sort_array(F.collect_list(F.when(~F.isnan(v), v))).alias(f"_v{i}") for i, v in enumerate(values)]
    tall = [F.struct(F.lit(c).alias("variable"), F.col(f"_v{i}").alias("v")) for i, c in enumerate(columns)]
    rows = df.groupBy(key).agg(*arrays).select(key, F.inline(F.array(*tall))).filter(F.size("v") > 0)
    ranked = rows.select(key, "variable", "v", _ranks(p, F.size("v"), True).alias("r"))
    low, high = (F.get("v", F.col(f"r.{end}").cast("int")) for end in ("low", "high"))
    return ranked.select(key, "variable", (low + (high - low) * F.col("r.fraction")).alias("value"))


def _searched_quantiles(df: DataFrame, key: str, columns: list[str], p: float, cells: int) -> DataFrame:
    """Quantiles of groups of any size, all searched at once.

    A group's interval is cut into cells, its values are counted per cell, and the cells that hold
    its ranks are cut again until they hold one value. Values are spread by salt, so no task sees a
    whole group; windows order the cells of a group only. The levels run while the plan is built.
    Intervals are joined by a shuffle: staged they are far smaller than in memory, and the salts
    multiply them, so the optimizer would take too many of them for a table to broadcast.
    """
    salt = F.pmod(F.xxhash64("v"), F.lit(_SALTS)).cast("int")
    values = materialise(value_counts(df, key, columns).withColumn("salt", salt), "group-values")
    ends = values.groupBy(key, "variable").agg(F.sum("n").alias("total"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    wanted = ends.select(key, "variable", "lo", "hi", F.lit(0).cast("long").alias("below"), _ranks(p, F.col("total"), True).alias("r"))
    shown = wanted.select(key, "variable", "lo", "hi", "below", "r.fraction", F.explode(F.array_distinct(F.array("r.low", "r.high"))).alias("rank"))
    searches = materialise(shown, "group-ranks")
    interval = [key, "variable", "lo", "hi"]
    for _ in range(_MOST_LEVELS):
        open_ = searches.filter("lo < hi")
        if open_.isEmpty():
            break
        spread = open_.select(*interval).distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        inside = values.join(spread.hint("merge"), [key, "variable", "salt"]).filter(F.col("v").between(F.col("lo"), F.col("hi")))
        cell = _cell(F.col("v"), F.col("lo"), F.col("hi"), cells)
        counted = inside.groupBy(*interval, cell.alias("cell")).agg(F.sum("n").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
        ahead = Window.partitionBy(*interval).orderBy("cell")
        placed = counted.withColumn("to", F.sum("n").over(ahead)).withColumn("from", F.col("to") - F.col("n"))
        held = open_.hint("merge").join(placed, interval).filter("rank - below >= from AND rank - below < to")
        cut = held.select(key, "variable", F.col("least").alias("lo"), F.col("most").alias("hi"), (F.col("below") + F.col("from")).alias("below"), "fraction", "rank")
        narrower = materialise(searches.filter("lo >= hi").unionByName(cut), "group-ranks")
        release(searches)
        searches = narrower
    else:
        raise RuntimeError("quantiles did not settle")
    release(values)
    low, high = F.min("lo"), F.max("lo")
    return searches.groupBy(key, "variable").agg((low + (high - low) * F.max("fraction")).alias("value"))


def sketch_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], accuracy: int = 10_000
) -> DataFrame:
    """Same shape from ``percentile_approx``: one pass, rank error ``n / accuracy``."""
    sketches = df.agg(*[F.percentile_approx(c, probabilities, accuracy).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("variable"),
            F.lit(float(p)).alias("p"),
            F.col(c)[i].cast("double").alias("value"),
        )
        for c in columns
        for i, p in enumerate(probabilities)
    ]
    return sketches.select(F.inline(F.array(*rows))).filter(F.col("value").isNotNull())


def as_one_row(quantiles: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """One row with ``<column>_q<i>`` for the i-th probability."""
    return quantiles.agg(
        *[
            F.max(F.when((F.col("variable") == c) & (F.col("p") == float(p)), F.col("value"))).alias(f"{c}_q{i}")
            for c in columns
            for i, p in enumerate(probabilities)
        ]
    )
