"""Exact de-duplication and line de-duplication."""

import hashlib
import random
import re
from math import ceil

import pytest
from llm_rows import LONG, ODD, prose
from pyspark.sql import functions as F

from aerostat.llm import exact_dedup, line_dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected_groups(rows):
    groups = {}
    for key, text, *_ in rows:
        groups.setdefault(norm(text), []).append(key)
    out = []
    for key, text, *_ in rows:
        ids = groups[norm(text)]
        keep = min((i for i in ids if i is not None), default=None)
        out.append((key, keep, len(ids), key == keep, hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(out, key=str)


def deduplicated(df):
    out = df.withColumn("digest", F.lower(F.hex("digest")))
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_exact_dedup_of_odd_rows(table):
    assert deduplicated(exact_dedup.exact_dedup(table(ODD))) == expected_groups(ODD)


def test_exact_dedup_of_an_empty_table(table):
    assert exact_dedup.exact_dedup(table([])).collect() == []


def test_exact_dedup_when_digests_collide(table):
    rows = [(i, f"text {i % 7}") for i in range(40)] + ODD

    def weak(text):
        return F.unhex(F.substring(F.sha2(text, 256), 1, 2))

    def one(text):
        return F.lit(b"\x01")

    for digest in (weak, one):
        got = [r[:4] for r in deduplicated(exact_dedup.exact_dedup(table(rows), digest=digest))]
        assert sorted(got, key=str) == sorted((r[:4] for r in expected_groups(rows)), key=str)


def test_exact_dedup_of_one_popular_text(table):
    rows = [(i, "the same") for i in range(3000)] + [(i, f"own {i}") for i in range(3000, 3050)]
    got = exact_dedup.exact_dedup(table(rows).repartition(9)).filter("kept").collect()
    assert {(r["doc_id"], r["group_size"]) for r in got} == {(0, 3000)} | {(i, 1) for i in range(3000, 3050)}


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected_lines(rows, threshold=0.8):
    """Removed line numbers by id, comparing every line with all earlier ones."""
    seen, lines = [], []
    for key, text, *_ in sorted(rows, key=lambda r: r[0]):
        for n, line in enumerate((text or "").split("\n")):
            lines.append((key, n, frozenset(line.translate(LOWER).split())))
    out = {}
    for key, n, words in lines:
        if not words:
            continue
        if any(len(words & w) >= threshold * len(words | w) - 1e-9 for w in seen):
            out.setdefault(key, []).append(n)
        seen.append(words)
    return out


def removed(df):
    return {r["doc_id"]: r["removed"] for r in df.collect() if r["removed"]}


def noisy_rows(seed, n_docs=60):
    rng = random.Random(seed)
    bases = [prose(i, rng.randrange(1, 25)).split() for i in range(12)]
    rows = []
    for d in range(n_docs):
        lines = []
        for _ in range(rng.randrange(0, 6)):
            words = list(rng.choice(bases))
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(["new", "odd", "rare", f"w{rng.randrange(50)}"])
            rng.shuffle(words)
            lines.append(" ".join(words) if rng.random() < 0.9 else "")
        rows.append((d, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("threshold", [0.6, 0.8, 1.0])
def test_line_dedup_against_all_pairs(table, threshold):
    rows = noisy_rows(3)
    got = removed(line_dedup.line_dedup(table(rows), threshold=threshold))
    assert got == expected_lines(rows, threshold)


def test_line_dedup_without_leaders_and_with_busy_words(table, monkeypatch):
    rows = noisy_rows(4)
    for busy in (0, 3):
        monkeypatch.setattr(line_dedup, "BUSY", busy)
        assert removed(line_dedup.line_dedup(table(rows))) == expected_lines(rows)


def test_line_dedup_keeps_columns_and_odd_rows(table):
    rows = [(1, None), (2, ""), (3, " \n\t \n"), (4, "a b c\nA b c\nd e f"), (5, "a b c\n\nd e f"), (6, LONG), (7, LONG), (8, "AÉ x")]
    docs = table(rows)
    out = line_dedup.line_dedup(docs)
    assert set(out.columns) == set(docs.columns) | {"n_lines", "removed"}
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["removed"]) for r in out.collect()}
    assert got[1] == (None, 1, []) and got[2] == ("", 1, []) and got[3] == (" \n\t \n", 3, [])
    assert got[4] == ("a b c\nd e f", 3, [1])
    assert got[5] == ("", 3, [0, 2])
    assert got[6] == (LONG, 1, []) and got[7] == ("", 1, [0])
    assert got[8] == ("AÉ x", 1, [])


def test_line_dedup_of_rows_without_an_id_and_of_repeated_rows(table):
    rows = [(1, "one two three"), (1, "one two three"), (None, "one two three"), (None, "four five"), (2, "four five")]
    got = line_dedup.line_dedup(table(rows)).collect()
    # A copy of a row repeats nothing of it; rows without an id come last and share their verdicts.
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == [(0, ""), (0, ""), (1, "one two three"), (1, "one two three"), (2, "four five")]


def test_line_dedup_tells_documents_without_an_id_or_of_one_id_apart(table):
    rows = [(1, "one two three"), (None, "one two three"), (None, "only here"), (None, "only there\none two three")]
    rows += [(7, "first of seven\none two three"), (7, "second of seven\nstill its own"), (-(2**63), "low id"), (2**63 - 1, "high id\nlow id")]
    got = line_dedup.line_dedup(table(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["text"], r["removed"]) for r in got) == [
        (-(2**63), "low id", []),
        (0, "", [0]),
        (0, "only here", []),
        (0, "only there", [1]),
        (1, "one two three", []),
        (7, "first of seven", [1]),
        (7, "second of seven\nstill its own", []),
        (2**63 - 1, "high id", [1]),
    ]


@pytest.mark.parametrize("key", [None, 3])
def test_line_dedup_of_equal_lines_in_one_place_of_different_texts(table, key):
    rows = [(key, f"shared line of all\nown line number{i} word{i}") for i in range(20)]
    got = sorted(r["removed"] for r in line_dedup.line_dedup(table(rows)).collect())
    assert got == [[]] + [[0]] * 19


def test_line_dedup_of_an_empty_table(table):
    assert line_dedup.line_dedup(table([])).collect() == []


def test_line_dedup_of_a_large_group_of_near_copies(table):
    base = prose(1, 30).split()
    rows = [(i, " ".join([*base[: i % 30], f"n{i}", *base[i % 30 + 1 :]])) for i in range(600)]
    got = removed(line_dedup.line_dedup(table(rows)))
    assert got == {i: [0] for i in range(1, 600)}
    assert ceil(0.8 * 31) == 25


def test_line_dedup_makes_no_pairs_for_settled_lines(table, monkeypatch):
    made, plain = [], line_dedup.materialise

    def counted(df, name="stage", by=()):
        staged = plain(df, name, by)
        if name == "line-met":
            made.append(staged.count())
        return staged

    monkeypatch.setattr(line_dedup, "materialise", counted)
    base = prose(1, 30).split()
    rows = [(i, " ".join([*base[: i % 30], f"n{i}", *base[i % 30 + 1 :]])) for i in range(600)]
    assert removed(line_dedup.line_dedup(table(rows))) == {i: [0] for i in range(1, 600)}
    # Few lines share no bucket with the first; a pair of each other line with it would be 599 pairs.
    assert sum(made) < 300


def test_line_dedup_reads_lines_of_any_letters_alike(table):
    rows = [(1, "Über DEN\tTree \x0b go"), (2, "Über den tree GO"), (3, "über den tree go"), (4, "den\x0ctree\rGO on\nA B"), (5, "Den Tree go ON\na\tb"), (6, "\t\x0b\x0c\r ")]
    assert removed(line_dedup.line_dedup(table(rows))) == {2: [0], 5: [0, 1]}


@pytest.mark.parametrize("first", [0, -(2**32), 2**32 - 60, 2**32 - 30, 2**50])
def test_line_dedup_keeps_places_in_64_bits_where_ids_leave_room(table, monkeypatch, first):
    wide, plain = [], line_dedup.materialise_numbers

    def seen(df, name="stage"):
        wide.extend(kind for _, kind in df.dtypes if "decimal" in kind)
        return plain(df, name)

    monkeypatch.setattr(line_dedup, "materialise_numbers", seen)
    rows = [(first + d, text) for d, text in noisy_rows(5)]
    assert removed(line_dedup.line_dedup(table(rows))) == expected_lines(rows)
    assert bool(wide) == (first + 59 >= 2**32)


def test_line_dedup_shuffles_no_texts_to_join_verdicts(table):
    rows = [(d, text) for d, text in noisy_rows(6, 20)]
    got = line_dedup.line_dedup(table(rows)).select("doc_id", "removed")
    joins = [x for x in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in x]
    assert joins and not any("text" in x for x in joins)


def test_line_dedup_of_equal_words_in_another_order(table):
    rows = [(1, "one two three four"), (2, "four  three two one"), (3, "one one two three four"), (4, "one two three four"), (5, "five")]
    assert removed(line_dedup.line_dedup(table(rows), threshold=1.0)) == {2: [0], 3: [0], 4: [0]}
