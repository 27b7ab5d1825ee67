"""Sliced windows against plain windows, with one station holding most rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerostat.operators import cleaning, temporal
from aerostat.plans import quantiles, slices

WIDTHS = [60, 3600, slices.DAY * 365]


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 readings; two thirds belong to station 0; gaps of seconds to hours; many NULLs."""
    n = F.col("id")
    station = F.when(n % 3 != 0, 0).otherwise(n % 41)
    seconds = F.lit(1_700_000_000) + n * 37 + (n % 17) * 5 + F.floor(n / 500) * 20_000
    value = F.when(F.rand(1) > 0.4, F.round(F.rand(2) * 300, 2))
    return (
        spark.range(3000)
        .select(
            station.cast("long").alias("station_id"),
            F.timestamp_seconds(seconds).alias("timestamp"),
            value.alias("pm2_5"),
            F.when(F.rand(4) > 0.2, F.round(F.rand(5) * 500, 1)).alias("aqi"),
        )
        .dropDuplicates(["station_id", "timestamp"])
        .cache()
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def close(got, want, column):
    """Same rows, with means equal up to summation error."""
    keys = ["station_id", "timestamp"]
    a = {(r[0], r[1]): r[2] for r in got.select(*keys, column).collect()}
    b = {(r[0], r[1]): r[2] for r in want.select(*keys, column).collect()}
    assert len(a) == got.count() and a.keys() == b.keys()
    for k, v in b.items():
        assert (a[k] is None) == (v is None) and (v is None or abs(a[k] - v) < 2e-6)


def by_time():
    return Window.partitionBy("station_id").orderBy("timestamp")


@pytest.mark.parametrize("width", WIDTHS)
def test_forward_fill(skewed, width):
    want = skewed.withColumn("pm2_5", F.last("pm2_5", True).over(by_time().rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(cleaning.forward_fill(skewed, ["pm2_5"], width)) == rows(want)


@pytest.mark.parametrize("width", WIDTHS)
def test_previous_rows(skewed, width):
    got = slices.previous_rows(skewed, {"p": "pm2_5", "a": "aqi"}, 3, width)
    want = skewed.withColumns({f"{n}_{j}": F.lag(c, j).over(by_time()) for n, c in (("p", "pm2_5"), ("a", "aqi")) for j in (1, 2, 3)})
    assert rows(got.select(want.columns)) == rows(want)
    one = slices.previous_rows(skewed, {"p": "pm2_5"}, 1, width)
    assert rows(one) == rows(skewed.withColumn("p_1", F.lag("pm2_5").over(by_time())))


@pytest.mark.parametrize("width", WIDTHS)
def test_trailing_mean(skewed, width):
    frame = Window.partitionBy("station_id").orderBy(F.unix_seconds("timestamp")).rangeBetween(-7200, 0)
    want = skewed.withColumn("m", F.avg("aqi").over(frame))
    close(slices.trailing_mean(skewed, "aqi", 7200, "m", None, width), want, "m")


@pytest.mark.parametrize("width", WIDTHS)
def test_imputation(skewed, width):
    upto = by_time().rowsBetween(Window.unboundedPreceding, 0)
    filled = skewed.withColumn("pm2_5", F.last("pm2_5", True).over(upto))
    filled = filled.withColumn("pm2_5", F.coalesce("pm2_5", F.avg("pm2_5").over(Window.partitionBy("station_id"))))
    overall = filled.agg(F.avg("pm2_5")).first()[0]
    want = filled.withColumn("pm2_5", F.coalesce("pm2_5", F.lit(overall)))
    close(cleaning.impute(skewed, ["pm2_5"], width), want, "pm2_5")


@pytest.mark.parametrize("strategy", ["median", "mode"])
def test_imputation_by_rank(skewed, strategy):
    """Against whole-station windows, on values that repeat, with one station that has none."""
    df = skewed.withColumn("pm2_5", F.when(F.col("station_id") != 1, F.round(F.col("pm2_5"), 0)))
    upto = by_time().rowsBetween(Window.unboundedPreceding, 0)
    filled = df.withColumn("pm2_5", F.last("pm2_5", True).over(upto))
    of = {"median": F.median("pm2_5"), "mode": F.mode("pm2_5", True)}[strategy]
    filled = filled.withColumn("pm2_5", F.coalesce("pm2_5", of.over(Window.partitionBy("station_id"))) if strategy == "median" else F.col("pm2_5"))
    if strategy == "mode":
        own = filled.groupBy("station_id").agg(of.alias("own"))
        filled = filled.join(own, "station_id").withColumn("pm2_5", F.coalesce("pm2_5", "own")).drop("own")
    overall = filled.agg(of).first()[0]
    want = filled.withColumn("pm2_5", F.coalesce("pm2_5", F.lit(overall)))
    close(cleaning.impute(df, ["pm2_5"], strategy=strategy), want.select(df.columns), "pm2_5")


def test_grouped_quantiles_of_a_group_that_holds_most_rows(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(F.lit(-1)).alias("k"), (F.randn(1) * F.exp(F.randn(2) * 9)).alias("a"), F.floor(F.rand(3) * 9).cast("double").alias("b"))
    df = df.withColumn("b", F.when((F.col("k") != 7) & (F.col("b") != 4), F.col("b")))
    for p in (0.0, 0.3, 0.5, 1.0):
        got = {(r.k, r.variable): r.value for r in quantiles.grouped_quantiles(df, "k", ["a", "b"], p, cells=64).collect()}
        for r in df.groupBy("k").agg(F.percentile("a", p).alias("a"), F.percentile("b", p).alias("b")).collect():
            for c in "ab":
                assert got.get((r.k, c)) == (None if r[c] is None else pytest.approx(r[c], rel=1e-13))


def test_no_window_task_sees_a_whole_station(skewed):
    """Slices of the busiest station are spread: none holds more rows than it has seconds."""
    sizes = slices.cut(skewed, 3600).groupBy("station_id", slices.SLICE).count()
    busiest = sizes.agg(F.max("count")).first()[0]
    assert busiest <= 3600 and busiest < skewed.filter("station_id = 0").count() / 5


def test_many_copies_of_one_key(spark):
    copies = spark.range(20_000).select(
        F.lit("A").alias("station_id"), F.timestamp_seconds(F.lit(0)).alias("timestamp"), (F.col("id") % 7).alias("v")
    )
    out = cleaning.deduplicate(copies, copies="n")
    assert [(r.v, r.n) for r in out.collect()] == [(0, 20_000)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_binary_fractions_leave_the_ledger_as_they_entered(spark):
    df = spark.range(80_000).select(
        F.lit("A").alias("station_id"), F.timestamp_seconds(F.col("id")).alias("timestamp"), F.lit(0.0078125).alias("v")
    )
    out = slices.trailing_mean(df, "v", 0, "m", None).agg(F.min("m"), F.max("m")).first()
    assert tuple(out) == (0.0078125, 0.0078125)


def test_missing_numbers_leave_no_trace_in_rolling_means(spark):
    rows = [("A", float(i), v) for i, v in enumerate([1.0, float("nan"), 3.0, float("inf"), 5.0])]
    df = spark.createDataFrame(rows, "station_id string, s double, v double").withColumn("timestamp", F.timestamp_seconds("s"))
    out = slices.trailing_mean(df, "v", 1, "m", None).orderBy("s").collect()
    assert [r.m for r in out] == [1.0, 1.0, 3.0, 3.0, 5.0]


def test_rolling_average_is_linear_in_density(skewed):
    out = temporal.rolling_average(skewed, hours=1)
    assert out.count() == skewed.count()


@pytest.mark.parametrize("few", [0, 20, 1000])
def test_grouped_quantiles_of_small_and_searched_groups_agree(spark, few):
    """Groups of 1 to 60 rows, with NULL, NaN and repeats, whichever way they are found."""
    n = F.col("id")
    odd = F.when(n % 11 == 0, F.lit(float("nan"))).when(n % 7 != 0, F.floor(F.rand(5) * 40) / 8 - 2)
    df = spark.range(1800).select(F.when(n < 1700, F.floor(F.sqrt(n.cast("double")) * 1.4)).alias("k"), odd.alias("a"), F.rand(6).alias("b"))
    got = {(r.k, r.variable): r.value for r in quantiles.grouped_quantiles(df, "k", ["a", "b"], 0.5, few=few).collect()}
    clean = df.filter("k IS NOT NULL").withColumn("a", F.when(~F.isnan("a"), F.col("a")))
    want = clean.groupBy("k").agg(F.median("a").alias("a"), F.median("b").alias("b")).collect()
    assert got == {(r.k, c): pytest.approx(r[c], rel=1e-13) for r in want for c in "ab" if r[c] is not None}


def test_grouped_quantiles_broadcast_no_table_of_intervals(spark, monkeypatch):
    """Staged intervals are small files, but one row per group, rank and salt once they are joined."""
    plans = []
    original = quantiles.materialise

    def watched(df, name="stage"):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return original(df, name)

    monkeypatch.setattr(quantiles, "materialise", watched)
    df = spark.range(6000).select((F.col("id") % 300).alias("k"), F.rand(7).alias("a"))
    quantiles.grouped_quantiles(df, "k", ["a"], few=0).collect()
    ranks = [text for name, text in plans if name == "group-ranks"]
    assert len(ranks) > 1 and not any("BroadcastHashJoin" in text for text in ranks)
    plans.clear()
    quantiles.grouped_quantiles(df, "k", ["a"]).collect()
    assert [name for name, _ in plans] == ["group-busy"]  # small groups need no search at all
