"""Small literal cases: bracket edges, cleaning rules, labels, scopes, sinks."""

import math
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aerostat import schema as S
from aerostat.functions import index as ix
from aerostat.functions.numeric import mean, mean_from, merge_sums, partial_sums
from aerostat.operators import alerting, cleaning, indexing, joining, spatial, statistics, temporal
from aerostat.plans import batch, quantiles
from aerostat.plans.lineage import materialise
from aerostat.sources import files
from aerostat.streaming import windows
from checks.catalog import QUERIES

T0 = datetime(2026, 1, 1)
POL_TYPES = ", ".join(f"{p} double" for p in S.POLLUTANTS)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def column(df, name):
    return [r[name] for r in df.select(name).collect()]


EPA = [(0, 50, 0, 9), (51, 100, 9.1, 35.4), (101, 150, 35.5, 55.4), (151, 200, 55.5, 125.4)]
EPA += [(201, 300, 125.5, 225.4), (301, 400, 225.5, 325.4), (401, 500, 325.5, 500.4)]


def test_bracket_edges(spark):
    edges = [(float(c), float(i)) for i_lo, i_hi, c_lo, c_hi in EPA for c, i in ((c_lo, i_lo), (c_hi, i_hi))]
    edges[0] = (0.0, 0.0)
    df = frame(spark, edges, "pm2_5 double, want double")
    got = df.select("want", ix.sub_index("pm2_5", "pm2_5").alias("got")).collect()
    assert all(r.got == r.want for r in got)
    cpcb = frame(spark, [(30.0,), (60.0,)], "pm2_5 double").select(ix.sub_index("pm2_5", "pm2_5", "INDIA_CPCB").alias("s"))
    assert column(cpcb, "s") == [50.0, 100.0]


def test_gaps_negatives_and_beyond(spark):
    df = frame(spark, [(9.05,), (-1.0,), (None,), (850.0,)], "pm2_5 double")
    assert column(df.select(ix.sub_index("pm2_5", "pm2_5").alias("s")), "s") == [None, None, None, 500.0]
    assert column(df.select(ix.sub_index("pm2_5", "pm2_5", gap_policy="truncate").alias("s")), "s")[0] == 50.0
    assert column(df.select(ix.extrapolated_sub_index("pm2_5", "pm2_5").alias("s")), "s")[3] > 500
    research = df.select(ix.research_sub_index("pm2_5", "pm2_5").alias("s"))
    assert column(research, "s")[2:] == [None, round(99 / 174.9 * (850 - 325.5) + 401, 1)]
    assert column(frame(spark, [(5000.0,)], "pm2_5 double").select(ix.research_sub_index("pm2_5", "pm2_5").alias("s")), "s") == [999.0]


def test_overall_index(spark):
    rows = [
        (9.0, 54.0, 20.0, 10.0, 1.0, 20.0),
        (35.4, 20.0, 10.0, 5.0, 0.5, 10.0),
        (5.0, 254.0, 10.0, 5.0, 0.5, 10.0),
        (850.0, 50.0, 10.0, 5.0, 0.5, 20.0),
        (None, None, None, None, None, None),
    ]
    out = indexing.aqi_enrich(frame(spark, rows, POL_TYPES)).collect()
    assert [r.aqi for r in out] == [50.0, 100.0, 150.0, 500.0, 0.0]
    assert [r.aqi_category for r in out] == ["Good", "Moderate", "Unhealthy for Sensitive Groups", "Hazardous", "Good"]
    # 9 and 54 both give 50: the first pollutant in table order wins.
    assert [r.dominant_pollutant for r in out] == ["PM2.5", "PM2.5", "PM10", "PM2.5", "None"]
    assert out[3].is_aqi_out_of_range and out[3].aqi_exceedance_flag and out[3].extrapolated_aqi > 500
    assert out[4].is_aqi_out_of_range is None


def test_no_pollutants_and_unknown_standard(spark):
    df = frame(spark, [("a",)], "station_id string")
    row = indexing.aqi_enrich(df).first()
    assert row.aqi is None and row.dominant_pollutant == "None" and row.aqi_category == "Unknown"
    with pytest.raises(ValueError):
        indexing.aqi_enrich(df, "NOWHERE")


def test_category_details(spark):
    df = frame(spark, [(-1.0,), (25.0,), (50.5,), (501.0,), (None,)], "aqi double")
    out = indexing.category_details(df).collect()
    assert [r.category for r in out] == ["Unknown", "Good", "Unknown", "Hazardous (Extreme)", "Unknown"]
    assert out[2].description == "No matching AQI bracket."


def test_timestamps(spark):
    texts = ["2026-01-01 10:00:00", "2026-01-01T11:00:00", "2026-01-01", "invalid_timestamp"]
    got = column(cleaning.normalize_timestamps(frame(spark, [(t,) for t in texts], "timestamp string")), "timestamp")
    assert got == [datetime(2026, 1, 1, 10), datetime(2026, 1, 1, 11), datetime(2026, 1, 1), None]


def hourly(spark, values, station="A", extra=""):
    rows = [(station, T0 + timedelta(hours=h), v) for h, v in enumerate(values)]
    return frame(spark, rows, "station_id string, timestamp timestamp, pm2_5 double")


def test_imputation_stages(spark):
    rows = [("A", 0, 20.0), ("A", 1, None), ("A", 2, 30.0), ("B", 0, None), ("B", 1, 10.0), ("C", 0, None)]
    df = frame(
        spark,
        [(s, T0 + timedelta(hours=h), v) for s, h, v in rows],
        "station_id string, timestamp timestamp, pm2_5 double",
    ).withColumn("o3", F.lit(None).cast("double"))
    assert column(cleaning.forward_fill(df, ["pm2_5"]).orderBy("station_id", "timestamp"), "pm2_5")[:3] == [20, 20, 30]
    out = cleaning.impute(df, ["pm2_5", "o3"]).orderBy("station_id", "timestamp")
    everything = (20 + 20 + 30 + 10 + 10) / 5
    assert column(out, "pm2_5") == [20, 20, 30, 10, 10, everything]
    assert set(column(out, "o3")) == {None}


def test_domain_limits(spark):
    df = frame(spark, [(-15.0,), (2500.0,), (45.0,), (None,)], "pm2_5 double")
    flagged = cleaning.domain_flags(df)
    assert column(flagged, "is_any_domain_outlier") == [True, True, False, None]
    assert {r.variable: r.violations for r in statistics.domain_audit(flagged).collect()} == {
        "pm2_5": 2,
        "total_domain_outliers": 2,
    }
    assert column(cleaning.domain_cap(df), "pm2_5") == [0.0, 1000.0, 45.0, None]


def test_quality_report_counts(spark):
    rows = [("A", "2026-01-01 00:00:00", 1.0), ("A ", "2026-01-01 00:00:00", 1.0), ("A", "2026-01-01 01:00:00", None)]
    raw = frame(spark, rows, "station_id string, timestamp string, pm2_5 double")
    report = {r.metric: r.value for r in statistics.quality_report_readings(raw).collect()}
    assert (report["initial_records"], report["duplicate_records"], report["final_records"]) == (3, 1, 2)
    assert report["missing_before.pm2_5"] == 1 and report["missing_after.pm2_5"] == 0
    assert report["quality_score"] == round(100 - 2 / (18 + 1e-5) * 100, 2)


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError, match="timestamp"):
        cleaning.clean_readings(frame(spark, [("A",)], "station_id string"))
    with pytest.raises(ValueError):
        cleaning.clean_stations(frame(spark, [("A",)], "station_id string"))


def test_iqr_outliers(spark):
    values = [25.0 + (i % 5) * 0.5 for i in range(18)] + [350.0, 400.0]
    flagged = cleaning.iqr_flags(frame(spark, [(v,) for v in values], "pm2_5 double"), ["pm2_5"], 1.5)
    assert column(flagged, "is_any_outlier").count(True) == 2
    sketch = cleaning.iqr_flags(frame(spark, [(v,) for v in values], "pm2_5 double"), ["pm2_5"], 1.5, "sketch")
    assert column(sketch, "is_any_outlier").count(True) == 2


def test_exact_quantiles_match_percentile(spark):
    df = spark.range(2000).select(F.round(F.rand(3) * 50 - 20, 1).alias("a"), F.round(F.randn(5), 2).alias("b"))
    got = {(r.variable, r.p): r.value for r in quantiles.exact_quantiles(df, ["a", "b"], [0.1, 0.5, 0.75]).collect()}
    for c in ("a", "b"):
        want = df.agg(F.percentile(c, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.75)))).first()[0]
        assert [round(got[c, p], 9) for p in (0.1, 0.5, 0.75)] == [round(w, 9) for w in want]


def test_station_id_zero_is_an_id(spark):
    df = frame(spark, [(0, 1.0), (1, 2.0)], "station_id int, aqi double")
    assert [r.station_id for r in spatial.scope_station(df, 0).collect()] == [0]
    assert spatial.scope_filter(df, station_id=0).count() == 1
    assert spatial.scope_station(df, None).count() == spatial.scope_station(df, "").count() == 2


@pytest.mark.parametrize(
    "values", [[1e-7, 4e-7], [1e13, 1.0], [float("inf"), 20.0], [10.0, None, 20.0], [-1e300, 2e299], [None], [0.0078125] * 5]
)
def test_means_keep_every_magnitude(spark, values):
    df = frame(spark, [(v,) for v in values], "v double")
    got, want = df.agg(mean("v").alias("m"), F.avg("v").alias("w")).first()
    assert got == want or got == pytest.approx(want, rel=1e-12)
    parts = df.agg(*partial_sums("v", "v")).agg(*merge_sums("v")).select(mean_from("v").alias("m")).first().m
    assert parts == got


def test_mean_with_nan_is_nan(spark):
    df = frame(spark, [(10.0,), (float("nan"),), (20.0,)], "v double")
    assert math.isnan(df.agg(mean("v").alias("m")).first().m)


def test_exact_quantiles_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")

    def of(values, **options):
        df = frame(spark, [(v,) for v in values], "v double")
        return [r.value for r in quantiles.exact_quantiles(df, ["v"], [0.25, 0.75], **options).orderBy("p").collect()]

    numbers = [float(i) for i in range(1, 10)]
    assert of([*numbers, nan, nan, None]) == of(numbers) == [3.0, 7.0]
    assert of([-inf, 1.0, 2.0, 3.0, inf]) == [1.0, 3.0]
    assert of([-1.5e308, 1e-300, 2e-300, 1.5e308, 1.7e308]) == [1e-300, 1.5e308]
    assert of([5.0] * 7) == [5.0, 5.0] and of([nan, None]) == []
    assert of(numbers, cells=4) == [3.0, 7.0]


def test_quantile_levels_are_small_whatever_the_values(spark):
    df = spark.range(200_000).select(F.rand(1).alias("v"))
    got = [r.value for r in quantiles.exact_quantiles(df, ["v"], [0.25, 0.75]).orderBy("p").collect()]
    want = df.agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.75)))).first()[0]
    assert got == pytest.approx(want, abs=1e-15)
    near = df.select(F.lit("v").alias("variable"), "v", F.lit(1).cast("long").alias("n"))
    plans = []
    collect = type(near).collect
    type(near).collect = lambda self: plans.append(self._jdf.queryExecution().executedPlan().toString()) or collect(self)
    try:
        (cut,) = quantiles._narrowed(near, [quantiles._Search("v", 0.5, 0.0, 100_000, 0.0, 1.0)], 256)
    finally:
        type(near).collect = collect
    assert cut.hi - cut.lo < 1 / 100 and cut.below <= 100_000
    assert "partial_sum" in plans[0] and not re.search(r"Window[^\n]*\bv#", plans[0])


def test_quantiles_read_their_input_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    n = 60_000
    df = spark.range(n).select((F.rand(1) * F.exp(F.randn(2) * 20)).alias("a"), F.floor(F.rand(3) * 3).cast("double").alias("b"))
    plain = materialise(df)
    got = {(r.variable, r.p): r.value for r in quantiles.exact_quantiles(plain.mapInArrow(counted, "a double, b double"), ["a", "b"], [0.1, 0.25, 0.75]).collect()}
    assert seen.value == 2 * n
    for c in "ab":
        want = plain.agg(F.percentile(c, F.array(F.lit(0.1), F.lit(0.25), F.lit(0.75)))).first()[0]
        assert [got[c, p] for p in (0.1, 0.25, 0.75)] == pytest.approx(want, rel=1e-14)


def test_quantiles_survive_a_sketch_that_misses(spark):
    df = spark.range(5_000).select(F.rand(1).alias("v"))
    want = df.agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.75)))).first()[0]
    kll = F.kll_sketch_get_quantile_double
    F.kll_sketch_get_quantile_double = lambda sketch, shares: F.array_repeat(kll(sketch, F.lit(0.9)), 4)
    try:
        got = [r.value for r in quantiles.exact_quantiles(df, ["v"], [0.25, 0.75]).orderBy("p").collect()]
    finally:
        F.kll_sketch_get_quantile_double = kll
    assert got == pytest.approx(want, abs=1e-15)


def test_distinct_sketches_unite_without_counting_twice(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("v"), (F.col("id") % 7).alias("day"), F.when(F.col("id") % 5 > 0, F.col("id") % 90).alias("few"))
    daily = materialise(statistics.distinct_sketches(df, "v", ["day"]))
    assert daily.count() == 7
    assert statistics.united_distinct(daily).first()[0] == pytest.approx(20_000, rel=0.05)
    for row in statistics.united_distinct(daily, ["day"], "n").collect():
        assert row.n == pytest.approx(df.filter(F.col("day") == row.day).select("v").distinct().count(), rel=0.05)
    exact = statistics.distinct_count(df, "few").first()[0]
    assert exact == statistics.distinct_count(df, "few", approximate=True).first()[0] == df.agg(F.countDistinct("few")).first()[0]
    assert statistics.distinct_count(df.filter("false"), "v", approximate=True).first()[0] == 0


def test_distinct_bitmaps_unite_exactly(spark):
    """Far more values than a sketch counts exactly, of either sign, in several bitmaps, with NULL."""
    value = F.when(F.col("id") % 9 > 0, F.col("id") % 70_000 - 30_000)
    df = spark.range(150_000).select(value.alias("v"), (F.col("id") % 4).alias("day"), (F.col("id") % 2).alias("half"))
    daily = materialise(statistics.distinct_bitmaps(df, "v", ["day", "half"]))
    assert statistics.united_bitmaps(daily).first()[0] == df.agg(F.countDistinct("v")).first()[0]
    want = {r.half: r.n for r in df.groupBy("half").agg(F.countDistinct("v").alias("n")).collect()}
    assert {r.half: r.n for r in statistics.united_bitmaps(daily, ["half"], "n").collect()} == want
    assert statistics.united_bitmaps(statistics.distinct_bitmaps(df.filter("false"), "v")).first()[0] == 0


def test_stored_distinct_count_is_exact_for_many_stations(spark, tmp_path):
    """The registered query on 9,000 stations, where the sketches it had told 9,016."""
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    shifted = events.crossJoin(spark.range(6).withColumnRenamed("id", "copy")).withColumn("user_id", F.col("user_id") + F.col("copy") * 15_000)
    shifted.drop("copy").write.parquet(str(tmp_path / "events.parquet"))
    assert QUERIES["distinct_count_sketch"](spark, str(tmp_path)).first()[0] == 9_000


def test_anomaly_sequence(spark):
    rows = [(30, 50, 15, 0.8), (180, 320, 60, 2.5), (25, 45, 12, 0.6), (350, 45, 10, 0.5)]
    df = frame(
        spark,
        [("A", T0 + timedelta(hours=h), *map(float, r)) for h, r in enumerate(rows)],
        "station_id string, timestamp timestamp, pm2_5 double, pm10 double, no2 double, co double",
    )
    out = temporal.classify_anomalies(df).orderBy("timestamp")
    assert column(out, "anomaly_classification") == [
        "NORMAL",
        "ACUTE_POLLUTION_EVENT",
        "NORMAL",
        "SENSOR_MALFUNCTION_SUSPECT",
    ]


def alert_types(spark, rows):
    df = frame(
        spark,
        [(s, T0 + timedelta(hours=h), a, p) for h, (s, a, p) in enumerate(rows)],
        "station_id string, timestamp timestamp, aqi double, pm2_5 double",
    )
    ruled = alerting.apply_rules(alerting.previous_reading(df)).orderBy("timestamp")
    return column(ruled, "alert_type")


def test_alert_rules(spark):
    assert alert_types(
        spark,
        [
            ("A", 165.0, 85.0),
            ("A", 320.0, 280.0),
            ("B", 50.0, 20.0),
            ("B", 80.0, 50.0),
            ("C", 60.0, 20.0),
            ("C", None, 90.0),
            ("C", 200.0, 29.0),
            ("C", 200.0, 50.0),
            ("D", 60.0, 100.0),
        ],
    ) == [
        "UNHEALTHY_AQI_ALERT",
        "HAZARDOUS_AQI_ALERT",
        None,
        "RAPID_CHANGE_ALERT",
        None,
        None,
        "UNHEALTHY_AQI_ALERT",
        "RAPID_CHANGE_ALERT",
        "PM25_SPIKE_ALERT",
    ]


def test_station_summary_and_hotspots(spark):
    rows = [("S1", "Central", "Delhi", 28.6, 77.2, 0, 180.0), ("S1", "Central", "Delhi", 28.6, 77.2, 1, 220.0)]
    rows += [("S2", "South", "Bengaluru", 12.9, 77.5, 0, 45.0), ("S2", "South", "Bengaluru", 12.9, 77.5, 1, 55.0)]
    df = frame(
        spark,
        [(*r[:5], T0 + timedelta(hours=r[5]), r[6]) for r in rows],
        "station_id string, station_name string, city string, latitude double, longitude double, timestamp timestamp, aqi double",
    )
    first = spatial.station_summary(df).first()
    assert (first.station_id, first.mean_aqi, first.state, first.station_type) == ("S1", 200.0, "Unknown", "General")
    assert first.std_aqi == 28.28
    spot = spatial.hotspots(df).first()
    assert (spot.station_id, spot.unhealthy_pct, spot.hotspot_score, spot.hotspot_level) == (
        "S1",
        100.0,
        76.0,
        "Critical Hotspot",
    )


def test_window_counts(spark):
    df = frame(
        spark,
        [("A", T0 + timedelta(minutes=m), a, a) for m, a in ((0, 50.0), (4, 70.0), (8, 90.0))],
        "station_id string, timestamp timestamp, aqi double, pm2_5 double",
    )
    out = windows.window_aqi(df).orderBy("window_start")
    assert column(out, "record_count") == [2, 3, 1]


PLACES = [
    ("1", "a", "Mumbai", "Maharashtra", 19.0, 72.8, 100.0),
    ("2", "b", "Mumbai", "Maharashtra", 19.1, 72.9, 110.0),
    ("3", "c", "Pune", "Maharashtra", 18.5, 73.8, 90.0),
    ("4", "d", "Delhi", "Delhi", 28.6, 77.2, 200.0),
    ("5", "e", "Delhi", "Delhi", 28.7, 77.1, 210.0),
    ("6", "f", "Chennai", "Tamil Nadu", 13.0, 80.2, 70.0),
]


def test_scopes_tree_and_view(spark):
    df = frame(
        spark,
        PLACES,
        "station_id string, station_name string, city string, state string, latitude double, longitude double, aqi double",
    )
    assert spatial.scope_filter(df, "maharashtra").count() == 3
    assert spatial.scope_filter(df, "All India", "All Cities", "All Stations").count() == 6
    assert spatial.scope_filter(df, city="MUMBAI").count() == 2
    assert spatial.scope_city(df, "Pune", "Maharashtra").count() == 1
    assert spatial.scope_station(df, "4").count() == 1
    tree = [(r.state, r.city) for r in spatial.hierarchy_tree(df).collect()]
    assert len(tree) == 6 and tree.count(("Maharashtra", "Mumbai")) == 2
    assert tuple(spatial.map_viewport(df.filter("1 = 0")).first()) == (22.5937, 78.9629, 4.1)
    assert spatial.map_viewport(df.filter("station_id = 1")).first().zoom == 12.5


def test_partitioned_overwrite_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    four = frame(spark, [("x", 1), ("x", 2), ("y", 3), ("z", 4)], "city string, v int")
    for _ in range(2):
        files.write_parquet(four, path, ["city", "nowhere"], cluster=True)
        assert spark.read.parquet(path).count() == 4
    files.write_parquet(four.limit(2), path, ["city"])
    assert spark.read.parquet(path).count() == 2
    other = str(tmp_path / "a")
    files.append_parquet(four.limit(1), other)
    files.append_parquet(four.limit(1), other)
    assert spark.read.parquet(other).count() == 2


def test_hourly_join_never_multiplies(spark):
    r = frame(spark, [("A", T0, 1.0), ("A", T0 + timedelta(minutes=30), 2.0)], "station_id string, timestamp timestamp, pm2_5 double")
    w = frame(
        spark,
        [("A", T0 + timedelta(minutes=5), 9.0), ("A", T0 + timedelta(minutes=6), 8.0)],
        "station_id string, timestamp timestamp, temperature double",
    )
    assert column(joining.join_hourly(r, w), "temperature") == [8.0, 8.0]


def test_batch_flow(spark, tmp_path):
    times = ["2026-01-01 00:00:00", "2026-01-01 01:00:00", "2026-01-01 00:00:00"]
    readings = frame(
        spark,
        [(s, t, 40.0, 80.0, 20.0, 10.0, 1.0, 30.0) for s, t in zip("AAB", times)],
        f"station_id string, timestamp string, {POL_TYPES}",
    )
    weather = frame(
        spark,
        [(s, t, 20.0, 50.0, 3.0, 90.0, 1010.0, 0.0) for s, t in zip("AAB", times)],
        "station_id string, timestamp string, " + ", ".join(f"{w} double" for w in S.WEATHER),
    )
    stations = frame(
        spark,
        [("A", "a", "Delhi", "Delhi", 28.6, 77.2, 200.0, "Traffic"), ("B", "b", "Mumbai", "Maharashtra", 19.0, 72.8, 10.0, "Coastal")],
        S.STATIONS_SCHEMA,
    )
    out = batch.run_batch(
        spark, {"air_quality": readings, "weather": weather, "stations": stations}, str(tmp_path / "out")
    )
    assert out["integrated"].count() == 3
    assert out["daily_analytics"].count() == 1
    assert out["station_summary"].count() == 2
    assert out["join"].first().known_stations == 2
    assert spark.read.json(str(tmp_path / "out" / "reports" / "aqi_statistics")).count() == 1
    card = {(r.section, r.name, r.metric): r.value for r in out["scorecard"].collect()}
    assert card["records", "integrated", "count"] == 3
    assert sum(v for (s, _, _), v in card.items() if s == "category_distribution") == 3
    shares = [v for (s, _, m), v in card.items() if (s, m) == ("dominance_distribution", "percentage")]
    assert sum(shares) == pytest.approx(100, abs=0.05)
    assert card["join", "all", "known_stations"] == 2
    assert card["state_summary", "Delhi", "station_count"] == 1
    assert {s for s, _, _ in card} >= {"quality_air_quality", "quality_weather", "quality_stations", "correlations"}
