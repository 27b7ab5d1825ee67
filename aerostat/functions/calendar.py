"""Timestamp parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted timestamp patterns, tried in this order.
PATTERNS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd",
]


def parse_timestamp(text: Column) -> Column:
    """First pattern that fits, then Spark's default parser, else NULL."""
    tries = [F.try_to_timestamp(text, F.lit(p)) for p in PATTERNS]
    return F.coalesce(*tries, F.try_to_timestamp(text))


def epoch(ts: Column) -> Column:
    """Whole seconds since 1970 (bigint)."""
    return F.unix_seconds(ts.cast("timestamp"))


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


# Months and labels of the seasons.
def season(ts: Column) -> Column:
    month = F.month(ts)
    return (
        F.when(month.isin(12, 1, 2), F.lit("Winter"))
        .when(month.between(3, 5), F.lit("Summer / Pre-Monsoon"))
        .when(month.between(6, 9), F.lit("Monsoon"))
        .otherwise(F.lit("Post-Monsoon / Autumn"))
    )
