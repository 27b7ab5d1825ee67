"""Collocations against counting every phrase."""

import random
import re
from collections import Counter
from itertools import product

import numpy as np
import pytest
from llm_rows import LONG, ODD

from aerostat.llm import collocations as C


def counts(rows):
    found, total = Counter(), Counter()
    for lang, text in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(ws)
            for m in range(1, 6):
                found.update((lang, *ws[i : i + m]) for i in range(len(ws) - m + 1))
    return found, total


def brute(rows, fewest, best):
    found, total = counts([(lang or "und", t) for lang, t in rows])
    found = {p: n for p, n in found.items() if n >= fewest}
    out = {}
    for p, a in found.items():
        lang, *ws = p
        if len(ws) < 2:
            continue
        inside = (
            q
            for q, n in found.items()
            if q[0] == lang and len(q) > len(p) and n >= a and any(list(q[i : i + len(ws)]) == ws for i in range(1, len(q)))
        )
        if any(inside):
            continue
        cut = min(
            (1000 * a * total[lang] // (found[(lang, *ws[:k])] * found[(lang, *ws[k:])]), k, found[(lang, *ws[:k])], found[(lang, *ws[k:])])
            for k in range(1, len(ws))
        )
        out.setdefault(lang, []).append((" ".join(ws), a, cut[2], cut[3], total[lang], cut[0]))
    rows = []
    for lang, found_ in out.items():
        found_.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        rows += [(lang, i + 1, *x) for i, x in enumerate(found_[:best])]
    return sorted(rows)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def chatter(seed, n):
    rng = random.Random(seed)
    set_ = ["New York city hall", "in spite of all that", "of the", "a b a b a b", "é ö\tü", "x y z"]
    rows = []
    for _ in range(n):
        words = [rng.choice(set_) if rng.random() < 0.5 else rng.choice("abcdefgh") for _ in range(40)]
        rows.append((rng.choice(("en", "en", "fr", None)), "".join(w + rng.choice((" ", " ", "  ", "\t", ", ", ".\n", "\r")) for w in words)))
    return rows


@pytest.fixture(scope="module")
def texts(spark):
    rows = chatter(3, 120)
    return rows, spark.createDataFrame(rows, "lang string, text string").repartition(5)


@pytest.mark.parametrize("shards", [1, 2, 4])
def test_any_number_of_shards_gives_all_counts(spark, texts, shards):
    rows, docs = texts
    want = brute(rows, 9, 50)
    assert any(len(r[2].split()) == 5 for r in want) and len({r[0] for r in want}) == 3
    assert got(C.collocations(docs, fewest=9, best=50, shards=shards)) == want


def test_shared_buckets_and_small_loads_change_nothing(spark, texts, monkeypatch):
    rows, docs = texts
    monkeypatch.setattr(C, "BUCKET_BITS", 4)
    monkeypatch.setattr(C, "_HELD", 100)
    assert got(C.collocations(docs, fewest=9, best=50, shards=3)) == brute(rows, 9, 50)


def test_longer_phrases_start_before_shorter_ones_are_settled(texts, monkeypatch):
    """Lengths are interleaved: the scans are fewer than one full cycle per length."""
    _, docs = texts
    scans = []
    scan = C._scan
    monkeypatch.setattr(C, "_scan", lambda *a: scans.append(a[2]) or scan(*a))
    C.frequent_phrases(docs, fewest=9, shards=4)
    assert 4 < len(scans) < 4 * C.LONGEST


def test_exact_scores_beyond_64_bits(spark):
    row = spark.range(1).selectExpr("90000000000000 a", "3000000000000000 n", "90000000000001 l", "90000000000007 r")
    score = "(cast(1000 * a as decimal(18,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(19,0)))"
    assert row.selectExpr(score).first()[0] == 1000 * 90000000000000 * 3000000000000000 // (90000000000001 * 90000000000007)


def test_buckets_come_back_as_the_scan_numbers_them(spark):
    rows = [("en", " ".join(p)) for p in product("abcé", repeat=3)] + [("fr", "a")]
    df = spark.createDataFrame(rows, "lang string, phrase string")
    want = set()
    for lang, phrase in rows:
        number = C._hashes(lang, phrase.split())
        for _ in range(len(number) - 1):
            number = np.concatenate([C._longer(number[:1], number[1:2]), number[2:]])
        want.add(int(C._buckets(number, 65536)[0]))
    assert set(C._bits(df, 65536).tolist()) == want and len(want) > 60
    assert C._bits(df.filter("false"), 65536).tolist() == [] and set(C._bits(df, 1).tolist()) == {0}


def test_odd_rows(spark, table):
    rows = [*ODD, (30, "to be\n" * 300), (30, "to be\n" * 300), (31, ".,;:" * 50)]
    langs = [(None if i % 3 else "en", r[1]) for i, r in enumerate(rows)]
    docs = table([(*r, lang) for r, (lang, _) in zip(rows, langs)])
    assert got(C.collocations(docs, fewest=5, best=30)) == brute(langs, 5, 30)
    assert got(C.collocations(table([]))) == got(C.collocations(table([(1, None), (2, "")]))) == []
    assert got(C.collocations(table([(1, LONG)]), fewest=100)) == brute([("en", LONG)], 100, 2000)
    with pytest.raises(ValueError):
        C.frequent_phrases(docs, shards=60)
