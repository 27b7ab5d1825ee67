"""Plan shapes that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from aerostat import schema as S
from aerostat.operators import cleaning, indexing, spatial
from aerostat.plans import slices
from aerostat.sources import files
from checks import tables as T
from checks.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


NO_RUN = {n for n in QUERIES if n.startswith(("stream", "bounded", "late", "train", "model", "pred", "join_pred", "ml_m", "alert_stream"))}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NO_RUN))
def test_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_sorted_queries_come_in_order(spark):
    days = [r["date"] for r in QUERIES["sort_asc"](spark, SF_DIR).collect()]
    assert days == sorted(days) and len(days) > 1
    means = [r["mean_aqi"] for r in QUERIES["sort_desc"](spark, SF_DIR).collect()]
    assert means == sorted(means, reverse=True) and len(means) > 1


def test_cleaning_with_flags_and_audit_stages_its_rows_once(spark):
    """One staged table of rows between the raw scan and the imputed rows, and no range of rows by station alone."""
    import aerostat.plans.lineage as lineage

    names = []
    original = lineage.materialise
    lineage.materialise = lambda df, name="stage": names.append(name) or original(df, name)
    try:
        cleaning.clean_readings(T.raw_readings(spark, SF_DIR), audit=True)
    finally:
        lineage.materialise = original
    assert [n for n in names if n != "quantiles"] == ["filled", "imputed"]


def test_index_is_narrow(spark):
    assert "Exchange" not in plan(indexing.aqi_enrich(T.readings(spark, SF_DIR)))


def test_station_filter_reaches_the_scan(spark, tmp_path):
    path = files.write_parquet(T.readings(spark, SF_DIR), str(tmp_path / "r"))
    text = plan(spatial.scope_station(spark.read.parquet(path), "7").select("pm2_5"))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(station_id,7\)", text)
    assert "ReadSchema: struct<station_id:bigint,pm2_5:double>" in text


def test_time_range_prunes_partitions(spark, tmp_path):
    rows = indexing.temporal_features(T.orders_by_month(spark, SF_DIR))
    path = files.write_parquet(rows, str(tmp_path / "m"), ["year", "month"], cluster=True)
    df = files.between(spark.read.parquet(path), "1997-03-10", "1997-05-01")
    scan = [line for line in plan(df).splitlines() if "PartitionFilters" in line][0]
    assert "year" in scan.split("PartitionFilters")[1]
    assert df.select("year", "month").distinct().count() == 2


def test_readings_are_never_shuffled_by_station_alone(spark):
    """What crosses the network by station is a summary with one row per slice."""
    rows = T.readings(spark, SF_DIR)
    for df in (
        cleaning.impute(rows, S.POLLUTANTS),
        cleaning.fill_with_station_mean(rows, S.POLLUTANTS),
        slices.previous_rows(rows, {"p": "pm2_5"}, 3),
        slices.trailing_mean(rows, "pm2_5", 3600, "m"),
    ):
        assert_summaries_only(plan(df))


def assert_summaries_only(text: str) -> None:
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"Exchange hashpartitioning\(station_id#\d+L?, \d+\)", line):
            assert re.search(r"HashAggregate|ObjectHashAggregate|SortAggregate|Project", lines[i + 1])
            below = " ".join(lines[i + 1 : i + 6])
            assert "Aggregate" in below, below


def test_tail_rows_are_limited_before_the_shuffle(spark):
    text = plan(slices.previous_rows(T.readings(spark, SF_DIR), {"p": "pm2_5"}, 3))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_summary_aggregates_before_the_shuffle(spark):
    text = plan(spatial.state_summary(T.fact(spark, SF_DIR)))
    assert "partial_count" in text and "Expand" not in text.split("Exchange")[-1]


def test_sums_do_not_depend_on_order(spark):
    from aerostat.functions.numeric import mean

    df = spark.range(5000).select(F.round(F.rand(9) * 500, 1).alias("v"))
    results = {df.repartition(n).agg(mean("v").alias("m")).first().m for n in (1, 3, 8, 40)}
    assert len(results) == 1


def test_quantiles_interpret_no_expression_per_row(spark, monkeypatch):
    """Generators take a plain column: what they are given to evaluate is not compiled."""
    from aerostat.plans import quantiles

    texts = []
    original = quantiles.materialise
    monkeypatch.setattr(quantiles, "materialise", lambda df, name="stage": texts.append(plan(df)) or original(df, name))
    df = spark.range(3000).select((F.col("id") % 7).alias("k"), F.rand(3).alias("a"), F.rand(4).alias("b"))
    quantiles.exact_quantiles(df, ["a", "b"], [0.25, 0.75]).collect()
    texts.append(plan(quantiles.grouped_modes(df, "k", ["a", "b"])))
    found = [line for text in texts for line in text.splitlines() if "Generate" in line]
    assert found and all(re.search(r"Generate explode\(_items#\d+\)", line) for line in found)
