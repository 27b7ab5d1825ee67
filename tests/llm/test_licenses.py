"""Licence scans: rules, places, suppression, and odd rows."""

import random
import re
import re._parser as parser

import pytest
from llm_rows import LONG, ODD
from pyspark.sql import functions as F

from aerostat.llm import license_scan as L
from aerostat.llm.license_rules import CONFIDENCE, rules

RULES = rules()
COMPILED = [re.compile(r.spaced) for r in RULES]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text):
    ws = words(text)
    spaced = " " + "  ".join(ws) + " " if ws else ""
    places = [
        (m.start() and spaced[: m.start()].count(" ") // 2, spaced[: m.end()].count(" ") // 2, r.level, n)
        for n, (r, c) in enumerate(zip(RULES, COMPILED))
        for m in c.finditer(spaced)
    ]
    standing = [
        p
        for p in places
        if not any(q != p and q[0] <= p[0] and q[1] >= p[1] and q[2] <= p[2] and (q[:3] != p[:3] or q[3] < p[3]) for q in places)
    ]
    base = sorted((p[0], RULES[p[3]].label) for p in places if p[2] == 0)
    return len(ws), base, sorted((p[0], p[1] - p[0], p[2], RULES[p[3]].label) for p in standing)


def got(df):
    rows = df.select("licenses").collect()
    return [(r[0][0], sorted(map(tuple, r[0][1])), sorted(map(tuple, r[0][2]))) for r in rows]


def sample(pattern, rng):
    """A text that the pattern matches."""

    def walk(node):
        out = ""
        for op, arg in node:
            match str(op):
                case "LITERAL":
                    out += chr(arg)
                case "NOT_LITERAL":
                    out += rng.choice("xyz")
                case "IN":
                    kinds = [(str(o), a) for o, a in arg]
                    if kinds[0][0] == "NEGATE":
                        out += rng.choice("xyz")
                    else:
                        o, a = rng.choice(kinds)
                        out += chr(a if o == "LITERAL" else rng.randint(*a))
                case "MAX_REPEAT" | "MIN_REPEAT":
                    low, high, inner = arg
                    out += "".join(walk(inner) for _ in range(rng.randint(low, min(int(high), low + 3))))
                case "SUBPATTERN":
                    out += walk(arg[3])
                case "BRANCH":
                    out += walk(rng.choice(arg[1]))
                case other:
                    raise AssertionError(other)
        return out

    return walk(parser.parse(pattern))


def test_there_are_hundreds_of_rules_and_each_names_a_word_of_its_matches():
    rng = random.Random(1)
    assert len(RULES) > 400 and {r.level for r in RULES} == set(range(len(CONFIDENCE)))
    for rule in RULES:
        for _ in range(20):
            text = sample(rule.spaced, rng)
            assert f" {rule.keyword} " in text, (rule, text)
            assert "   " not in text and not re.search(r"[A-Z\x21-\x2F]", text), (rule, text)


def test_every_rule_is_found_where_it_stands(spark):
    rng = random.Random(2)
    texts = [" ".join(f"w{i} {sample(r.spaced, rng)}" for r in rng.sample(RULES, 6)) for i in range(len(RULES) // 4)]
    texts += [sample(r.spaced, rng) for r in RULES]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    assert got(L.license_scan(docs)) == [brute(t) for t in texts]


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Released under the MIT License.", "mit"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("Licensed under CC BY-NC-SA 4.0.", "cc-by-nc,cc-by-nc-sa"),
        ("under the Apache License, Version 2.0, and SPDX-License-Identifier: GPL-3.0-or-later", "apache-2,gpl-3"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
        ("GNU Lesser General Public License", "lgpl"),
        ("lizenziert unter der MIT Lizenz", ""),
        ("ein Haus mit Garten, avec licence, gpl", ""),
        ("Alle Rechte vorbehalten. All rights reserved.", "all-rights"),
    ],
)
def test_labels(spark, text, labels):
    docs = spark.createDataFrame([(text,)], "text string")
    assert L.license_scan(docs).select(L.labels_of(F.col("licenses.places"))).first()[0] == labels


def test_containment_and_levels(spark):
    places = [(0, -6, 3, 9), (2, -6, 4, 8), (2, -6, 4, 7), (3, -5, 0, 1), (3, -5, 3, 2), (4, -9, 4, 8), (10, -12, 2, 3), (10, -12, 2, 4), (9, -20, 4, 5)]
    df = spark.createDataFrame([(sorted(places),)], f"p {L._PLACES}").select(L._standing(F.col("p")))
    assert [tuple(p) for p in df.first()[0]] == [(0, -6, 3, 9), (3, -5, 0, 1), (4, -9, 4, 8), (9, -20, 4, 5), (10, -12, 2, 3)]


def test_very_many_places(spark):
    n = 30_000
    docs = spark.createDataFrame([("under the MIT license, " * n,)], "text string")
    (found,) = got(L.license_scan(docs))
    assert found[0] == 4 * n and [b[0] for b in found[1]] == list(range(0, 4 * n, 4))
    assert [p[0] for p in found[2]] == [b[0] for b in found[1]]


def test_plan_is_one_stage_without_python(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = L.license_scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_odd_rows(spark, table):
    rows = [*ODD, (40, "MIT license " * 300), (41, "(CC-BY-NC)"), (41, "(CC-BY-NC)"), (42, LONG + " all rights reserved")]
    docs = table(rows).coalesce(1).withColumn("spaced", F.lit(1)).withColumn("places_found", F.lit(2))
    out = L.license_scan(docs)
    assert got(out) == [brute(t) for _, t in rows]
    assert out.drop("licenses").collect() == docs.collect()
    assert L.license_scan(table([])).collect() == []
