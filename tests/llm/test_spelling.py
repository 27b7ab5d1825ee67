"""Spelling variants against a comparison of all pairs."""

import random
import re
from collections import Counter
from zlib import crc32

from llm_rows import LONG, ODD

from aerostat.llm import spelling
from aerostat.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 5}
    form, near = {}, {}
    for w, n in words.items():
        others = [v for v in words if one_edit(w, v)]
        near[w] = len(others)
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, near[w], words[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def crowd(seed=1):
    """Many words one edit apart, with chains of forms, ties, and accents."""
    rng = random.Random(seed)
    words = ["", *("".join(rng.choices("abé", k=rng.randrange(6, 9))) for _ in range(250))]
    rows = []
    for k, w in enumerate(words):
        rows.append((k, " ".join([w] * rng.choice((1, 4, 5, 5, 6, 30, 160, 900)))))
    return rows


def test_crowded_words_against_all_pairs(spark, monkeypatch):
    rows = crowd()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] not in (r[0], r[1]) for r in want)
    assert got(spelling.spelling_variants(docs)) == want
    monkeypatch.setattr(spelling, "TILE", 7)  # tiles in many blocks
    assert got(spelling.spelling_variants(docs)) == want


def test_a_tile_never_outgrows_its_blocks(spark):
    words = spark.range(20_000).selectExpr("concat('hotkey', lpad(conv(id, 10, 16), 6, 'g')) word", "5L n")
    groups = spelling._tiled(words).groupBy("longer", "prefixed", "bin", "one", "two").count()
    assert groups.agg({"count": "max"}).first()[0] < 3 * spelling.TILE


def test_query_against_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op11_spelling"](spark, SF)) == brute(rows)


def test_odd_rows(spark, table):
    rows = [*ODD, (20, "ab" * 3000 + " " + "x" * 6000), (21, " ".join(["ab" * 3000] * 5 + ["ab" * 2999 + "a"] * 30)), (None, "Stößen " * 7)]
    assert got(spelling.spelling_variants(table(rows))) == brute(rows)
    assert got(spelling.spelling_variants(table([(1, LONG), (1, LONG), (2, None)]))) == brute([(1, LONG), (1, LONG)])
    assert got(spelling.spelling_variants(table([]))) == []
