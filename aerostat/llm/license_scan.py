"""Licence scans by ordered signature rules, with DataFrame operations only.

A text becomes a row of words, each with a blank of its own on either side, so that neighbouring
places of a pattern share no character. A rule's pattern runs only over texts that hold its keyword.
Splitting a text at a pattern gives the words before each place, hence its first word and length.

Places are then compared as intervals of words: one goes if another of the same or a stronger level
contains it; of equal intervals the earlier rule stays. In order of their starts, the furthest end
of each level so far tells. Everything happens inside the row: nothing is shuffled.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostat.llm.common import ascii_lower, fresh, whole
from aerostat.llm.license_rules import CONFIDENCE, rules

RUN = 256  # places that are walked at a time
_SPACE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PLACES = "array<struct<first:int,minus_end:int,level:int,rule:int>>"


def spaced_words(text: Column) -> Column:
    """The words of a text in lower case, each between two blanks of its own; null has none."""
    joined = F.trim(F.regexp_replace(ascii_lower(whole(text)), _SPACE, " "))
    # A text without words is an empty string, which gets no blanks.
    edge = F.when(joined == "", F.lit("")).otherwise(F.lit(" "))
    return F.concat(edge, F.replace(joined, F.lit(" "), F.lit("  ")), edge)


def n_words(spaced: Column) -> Column:
    return F.shiftright(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))), 1)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _walk(items: Column, carried: Column, none: Column, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """What the steps over an array give, joined; every step takes what the one before carried.

    The array is walked in runs: appending to the whole result at every step would copy it each time.
    """

    def over(items: Column) -> Column:
        last = F.floor((F.greatest(F.size(items), F.lit(1)) - 1) / RUN).cast("int")
        runs = F.transform(F.sequence(F.lit(0), last), lambda r: F.slice(items, r * RUN + 1, RUN))

        def one(state: Column, item: Column) -> Column:
            carried, given = step(state["carried"], item)
            return F.struct(carried.alias("carried"), F.concat(state["given"], given).alias("given"))

        def run(state: Column, part: Column) -> Column:
            own = F.struct(state["carried"].alias("carried"), none.alias("given"))
            joined = lambda o: F.struct(o["carried"].alias("carried"), F.concat(state["given"], o["given"]).alias("given"))
            return F.aggregate(part, own, one, joined)

        return F.aggregate(runs, F.struct(carried.alias("carried"), none.alias("given")), run, lambda s: s["given"])

    return _let(items, over)


def _of_rule(spaced: Column, rule: Column) -> Column:
    """All places of one rule."""
    none = F.array().cast(_PLACES)

    def step(past: Column, item: Column) -> tuple[Column, Column]:
        first = past + item["before"]
        end = first + F.coalesce(item["taken"], F.lit(0))
        place = F.struct(first.alias("first"), (-end).alias("minus_end"), rule["level"].alias("level"), rule["rule"].alias("rule"))
        return end, F.when(item["taken"].isNull(), none).otherwise(F.array(place))

    def told(parts: Column) -> Column:
        taken = F.transform(F.regexp_extract_all(spaced, rule["pattern"], F.lit(0)), n_words)
        items = F.zip_with(F.transform(parts, n_words), taken, lambda b, t: F.struct(b.alias("before"), t.alias("taken")))
        return F.when(F.size(parts) == 1, none).otherwise(_walk(items, F.lit(0), none, step))

    return _let(F.split(spaced, rule["pattern"], -1), told)


def _places(spaced: Column) -> Column:
    """Places of all rules, in order of start, longer ones first."""
    groups: dict[str, list[dict]] = defaultdict(list)
    for number, rule in enumerate(rules()):
        groups[rule.keyword].append({"pattern": rule.spaced, "level": rule.level, "rule": number})
    table = json.dumps([{"keyword": f" {keyword} ", "rules": group} for keyword, group in groups.items()])
    gates = F.from_json(F.lit(table), "array<struct<keyword:string,rules:array<struct<pattern:string,level:int,rule:int>>>>")
    none = F.array().cast(_PLACES)

    def gated(gate: Column) -> Column:
        places = F.flatten(F.transform(gate["rules"], lambda rule: _of_rule(spaced, rule)))
        return F.when(F.contains(spaced, gate["keyword"]), places).otherwise(none)

    return F.array_sort(F.flatten(F.transform(gates, gated)))


def _standing(places: Column) -> Column:
    """The places that no other one of the same or a stronger level contains."""
    levels = len(CONFIDENCE)

    def step(ends: Column, place: Column) -> tuple[Column, Column]:
        end = -place["minus_end"]
        covered = F.get(ends, place["level"]) >= end
        further = F.transform(ends, lambda e, level: F.when(level >= place["level"], F.greatest(e, end)).otherwise(e))
        return further, F.when(covered, F.array().cast(_PLACES)).otherwise(F.array(place))

    return _walk(places, F.array(*[F.lit(-1)] * levels), F.array().cast(_PLACES), step)


def license_scan(docs: DataFrame, text_col: str = "text", into: str = "licenses") -> DataFrame:
    """The documents with a struct ``into``: ``n_words``, the ``base`` places and the ``places``.

    Places of the base phrases are all there, as ``first`` word (from 0) and ``label``. ``places``
    are those of all rules that stand after suppression, as ``first``, ``length`` in words,
    ``level``, ``label``. Null texts have no words and, as empty ones and ones without a licence, no
    places. All rows and columns are kept; a column that has the name ``into`` is replaced.
    """
    spaced, found = fresh(docs, "spaced"), fresh(docs, "places_found")
    labels = F.split(F.lit(",".join(rule.label for rule in rules())), ",")

    def shown(place: Column, *names: str) -> Column:
        fields = {
            "first": place["first"],
            "length": -place["minus_end"] - place["first"],
            "level": place["level"],
            "label": F.get(labels, place["rule"]),
        }
        return F.struct(*[fields[n].alias(n) for n in names])

    base = F.transform(F.filter(found, lambda p: p["level"] == 0), lambda p: shown(p, "first", "label"))
    standing = F.transform(_standing(F.col(found)), lambda p: shown(p, "first", "length", "level", "label"))
    words = docs.withColumn(spaced, spaced_words(F.col(text_col)))
    placed = words.withColumn(found, _places(F.col(spaced)))
    scan = F.struct(n_words(F.col(spaced)).alias("n_words"), base.alias("base"), standing.alias("places"))
    return placed.withColumn(into, scan).drop(spaced, found)


def confidence(places: Column) -> Column:
    """Confidence that the text names a licence: that of its strongest place, 0 without any."""
    levels = F.array(*map(F.lit, CONFIDENCE))
    return F.coalesce(F.array_max(F.transform(places, lambda p: F.get(levels, p["level"]))), F.lit(0.0))


def labels_of(places: Column) -> Column:
    """The different labels, sorted and joined by commas."""
    return F.array_join(F.sort_array(F.array_distinct(places["label"])), ",")


def oracle() -> str:
    """DuckDB SQL for the digest of a scan of ``documents``, with the same rules."""
    values = ",\n        ".join(
        f"({n}, {r.level}, '{r.label}', '{r.keyword}', '{r.spaced}', {CONFIDENCE[r.level]}::DOUBLE)" for n, r in enumerate(rules())
    )
    return rf"""
WITH rule(rule, level, label, keyword, pattern, confidence) AS (VALUES
        {values}),
d AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents
),
t AS (SELECT row, CASE WHEN len(ws) = 0 THEN '' ELSE ' ' || array_to_string(ws, '  ') || ' ' END AS t FROM d),
hit AS (
    SELECT row, rule, level, label, confidence, string_split_regex(t, pattern) AS parts, regexp_extract_all(t, pattern) AS found
    FROM t JOIN rule ON contains(t, ' ' || keyword || ' ') WHERE regexp_matches(t, pattern)
),
cut AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM hit),
text AS (SELECT *, array_to_string(parts[:i], '') || array_to_string(found[:i - 1], '') AS before, found[i] AS own FROM cut),
place AS (
    SELECT row, rule, level, label, confidence, (len(before) - len(replace(before, ' ', ''))) // 2 AS s,
        (len(before) - len(replace(before, ' ', '')) + len(own) - len(replace(own, ' ', ''))) // 2 AS e
    FROM text
),
standing AS (
    SELECT * FROM place AS p WHERE NOT EXISTS (
        SELECT 1 FROM place AS o WHERE o.row = p.row AND o.s <= p.s AND o.e >= p.e AND o.level <= p.level
            AND (o.s < p.s OR o.e > p.e OR o.level < p.level OR o.rule < p.rule))
),
base AS (
    SELECT row, count(*) AS n, min(s) AS first, max(s) AS last, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM place WHERE level = 0 GROUP BY row
),
kept AS (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(confidence) AS score FROM standing GROUP BY row)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, base.first::BIGINT AS first_word,
    base.last::BIGINT AS last_word, coalesce(base.labels, '') AS base_labels, coalesce(kept.labels, '') AS labels,
    coalesce(kept.score, 0)::DOUBLE AS score
FROM d LEFT JOIN base USING (row) LEFT JOIN kept USING (row)"""
