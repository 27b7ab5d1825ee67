"""Decontamination, near-duplicate join, components, sharding and tokenizing."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import LONG, ODD, prose
from pyspark.sql import functions as F

from aerostat.llm import components, decontamination, jaccard_join, queries, sentencepiece, sharding

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


# Decontamination


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.integers(1, 6))
def test_index_finds_all_occurrences(s, m):
    s = np.array(s)
    index = decontamination.FMIndex(s, 4, sample=3)
    phrases = np.array([p for p in {tuple(s[i : i + m].tolist()) for i in range(len(s) - m + 1)} | {(3,) * m}])
    low, high = index.search(phrases)
    for p, a, b in zip(phrases, low, high):
        want = [i for i in range(len(s) - m + 1) if (s[i : i + m] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_words_follow_the_pattern():
    import re

    for text in ["Ab-C d'é 你好_x \x00 ~9Z", "", None, "ÀB"]:
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        assert [w.decode() for w in decontamination.words(text)] == re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_contamination(text, items, window):
    ws = decontamination.words(text)
    hit, found = set(), set()
    for item, t in items:
        own = decontamination.words(t)
        m = min(window, len(own))
        for k in range(len(own) - m + 1 if own else 0):
            for i in range(len(ws) - m + 1):
                if ws[i : i + m] == own[k : k + m]:
                    hit |= set(range(i, i + m))
                    found.add(item)
    return len(ws), len(hit), sorted(found)


ITEMS = [
    (1, prose(1, 20, "ab")),
    (2, prose(2, 3, "ab")),
    (3, "word"),
    (4, None),
    (5, " -- "),
    (1, prose(7, 5, "ab")),
    (6, prose(1, 20, "ab")),
]


@pytest.mark.parametrize("block_words", [4, 1 << 20])
def test_contamination_against_all_positions(spark, table, block_words):
    rng = random.Random(3)
    rows = list(ODD[:5]) + [(20, "word"), (21, "a word, Word!")]
    for i in range(30, 60):
        words = prose(i, 40, "ab").split()
        for _, t in rng.choices(ITEMS, k=3):
            own = (t or "").split()
            at = rng.randrange(len(words))
            words[at:at] = own[rng.randrange(len(own) + 1) :] if rng.random() < 0.3 else own
        rows.append((i, " ".join(words)))
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    out = decontamination.contamination(table(rows), items, window=5, block_words=block_words, into="got")
    got = Counter((r["doc_id"], r["got"]["n_words"], r["got"]["n_hit"], tuple(r["got"]["items"])) for r in out.collect())
    want = Counter()
    for key, text, *_ in rows:
        n, hit, found = brute_contamination(text, ITEMS, 5)
        want[key, n, hit, tuple(found)] += 1
    assert got == want


def test_contamination_of_small_shards_and_spans(spark, table, monkeypatch):
    monkeypatch.setattr(decontamination, "SHARD_BYTES", 50)
    item = prose(1, 13)
    rows = [(i, f"{prose(100 + i, 10)} {item} {item} tail") for i in range(5)] + [(9, LONG), (10, None)]
    items = spark.createDataFrame([(1, item), (None, item)], "item_id bigint, text string")
    for r in decontamination.contamination(table(rows), items).collect():
        if r["doc_id"] < 9:
            spans = [tuple(s) for s in r["found"]["spans"]] if not isinstance(r["found"], str) else None
            assert spans == [(10, 36)] and r["found"]["items"] == [1]
            assert decontamination.without_spans(r["text"], spans) == prose(100 + r["doc_id"], 10) + " tail"
        else:
            assert r["found"]["n_hit"] == 0


def test_contamination_by_an_empty_benchmark_and_of_an_empty_table(spark, table):
    none = spark.createDataFrame([], "item_id bigint, text string")
    out = decontamination.contamination(table(ODD), none, into="got").collect()
    assert len(out) == len(ODD) and all(r["got"]["n_hit"] == 0 for r in out)
    some = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontamination.contamination(table([]), some).collect() == []


# Near duplicates


def brute_near(rows, threshold=0.8):
    sets = [(k, frozenset(jaccard_join.shingles(t).tolist())) for k, t, *_ in rows]
    ids = defaultdict(list)
    for k, s in sets:
        ids[s].append(k)
    own = [s for s in ids if s]
    links, group = Counter(), {s: s for s in own}

    def find(s):
        while group[s] != s:
            s = group[s]
        return s

    for a, b in combinations(own, 2):
        if len(a & b) >= threshold * len(a | b) - 1e-9:
            links[a] += 1
            links[b] += 1
            group[find(a)] = find(b)

    def low(keys):
        return min((k for k in keys if k is not None), default=None)

    out = []
    for k, s in sets:
        if not s:
            out.append((k, k, 1, 0, k))
        else:
            same = [i for t in own if find(t) == find(s) for i in ids[t]]
            out.append((k, low(ids[s]), len(ids[s]), links[s], low(same)))
    return sorted(out, key=str)


def near_rows(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(90):
        words = prose(rng.randrange(9), 60).split()
        for _ in range(rng.choice([0, 0, 1, 2, 12])):
            words[rng.randrange(60)] = f"new{rng.randrange(999)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("block", [3, 256])
def test_near_duplicates_against_all_pairs(table, block):
    rows = near_rows(1) + ODD
    out = jaccard_join.near_duplicates(table(rows), block=block)
    got = sorted((tuple(r) for r in out.select("doc_id", "copy_id", "n_copies", "n_links", "class_id").collect()), key=str)
    assert got == brute_near(rows)


def test_products_equal_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 90, 40)).astype(np.uint64) for _ in range(9)]
    other = [np.unique(rng.integers(0, 90, 40)).astype(np.uint64) for _ in range(5)]
    for b in (sets, other):
        want = [[len(np.intersect1d(x, y)) for y in b] for x in sets]
        got = jaccard_join._products(sets, b)
        if b is sets:  # of different sets only
            np.fill_diagonal(got, [len(x) for x in sets])
        assert got.tolist() == want


def test_pruning_keeps_what_may_reach_the_threshold():
    fewest = jaccard_join.fewest_matches(0.8, 1e-4)
    assert (np.diff(fewest) >= 0).all() and fewest[130] < 0.8 * 130 and fewest[130] > 0.5 * 130


@pytest.mark.parametrize("threshold", [0.5, 0.79, float("nan")])
def test_near_duplicates_refuse_thresholds_the_bands_are_not_set_for(table, threshold):
    with pytest.raises(ValueError, match="bands"):
        jaccard_join.near_duplicates(table([]), threshold=threshold)


def test_near_duplicates_of_an_empty_table(table):
    assert jaccard_join.near_duplicates(table([])).collect() == []
    assert len(jaccard_join.near_duplicates(table([(1, None), (2, "")])).collect()) == 2


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(200, 260)] + [(7, 7), (300, 301), (301, 300), (None, 5)]
    got = components.components(spark.createDataFrame(edges, "x bigint, y bigint")).collect()
    roots = {r["node"]: r["root"] for r in got}
    assert len(got) == len(roots)
    assert {roots[i] for i in range(41)} == {0}
    assert {roots[i] for i in [100, *range(200, 260)]} == {100}
    assert roots[300] == roots[301] == 300
    assert components.components(spark.createDataFrame([], "x bigint, y bigint")).collect() == []


# Sharding


def test_shards_are_exact_gapless_and_whole(table):
    docs = table([(i % 50, f"t{i % 40}") for i in range(1003)] + [(None, None)] * 4).repartition(5)
    out = sharding.shuffle_into_shards(docs, 16, seed=3).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert sorted(map(len, slots.values())) == [1007 // 16] * (16 - 1007 % 16) + [1007 // 16 + 1] * (1007 % 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_few_and_no_rows(table):
    assert sharding.shuffle_into_shards(table([]), 16).collect() == []
    assert len(sharding.shuffle_into_shards(table([(1, "a"), (2, None)]), 16).collect()) == 2


def test_shards_depend_on_the_seed_and_are_even(spark):
    rows = spark.range(3200, numPartitions=4)
    a, b = ({r["id"]: (r["shard"], r["slot"]) for r in sharding.shuffle_into_shards(rows, 8, s).collect()} for s in (1, 2))
    assert a != b
    first = Counter(a[i][0] for i in range(800))  # of one part: 100 a shard on average
    assert all(60 < first[s] < 140 for s in range(8))


def test_matrix_has_its_margins():
    m = sharding.communication_matrix([5, 0, 17, 8], [8, 8, 7, 7], 1)
    assert m.sum(1).tolist() == [5, 0, 17, 8] and m.sum(0).tolist() == [8, 8, 7, 7] and (m >= 0).all()


def test_large_populations_follow_the_law(monkeypatch):
    rng = np.random.default_rng(0)
    exact = [int(rng.hypergeometric(300, 700, 200)) for _ in range(4000)]
    monkeypatch.setattr(sharding, "NUMPY_LIMIT", 0)
    own = [sharding.hypergeometric(rng, 300, 700, 200) for _ in range(4000)]
    assert abs(np.mean(own) - np.mean(exact)) < 0.6 and abs(np.std(own) / np.std(exact) - 1) < 0.1
    big = sharding.hypergeometric(rng, 10**12, 3 * 10**12, 10**9)
    assert abs(big - 250_000_000) < 200_000
    assert sharding.hypergeometric(rng, 5, 0, 3) == 3 and sharding.hypergeometric(rng, 0, 5, 3) == 0


def test_written_shards_hold_their_rows(spark, tmp_path):
    sharding.write_shards(spark.range(100), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().collect()
    assert [r["count"] for r in back] == [25] * 4


# Tokenizing


@pytest.fixture(scope="module")
def model():
    return sentencepiece.load(MODEL)


@pytest.fixture(scope="module")
def library():
    import sentencepiece as spm

    return spm.SentencePieceProcessor(model_file=MODEL)


def test_ids_equal_the_librarys(spark, model, library):
    coder = sentencepiece.Coder(model)
    texts = [t or "" for _, t, *_ in ODD[:-1]] + ["  a  b ", "▁a<s></s><unk><0x41>", "a\x01b\r\n", " " * 70 + "x", "ab" * 300]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for t in texts:
        assert coder.encode(t).tolist() == library.encode(t)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_text_is_coded_as_by_the_library(text):
    if not hasattr(test_any_text_is_coded_as_by_the_library, "coder"):
        import sentencepiece as spm

        test_any_text_is_coded_as_by_the_library.coder = sentencepiece.Coder(sentencepiece.load(MODEL))
        test_any_text_is_coded_as_by_the_library.library = spm.SentencePieceProcessor(model_file=MODEL)
    coder, library = (getattr(test_any_text_is_coded_as_by_the_library, n) for n in ("coder", "library"))
    text = text.replace("\x00", "")
    ids = coder.encode(text).tolist()
    assert ids == library.encode(text)
    assert coder.decode(ids) == text.replace("▁", " ")


def test_unigram_path_is_the_cheapest_segmentation():
    names = ["▁", "a", "b", "ab", "▁a", "ba", "bab", "▁ab"]
    rng = random.Random(4)
    pieces = {p: (i, -rng.uniform(1, 5)) for i, p in enumerate(names)}
    coder = sentencepiece.Coder(sentencepiece.Model(pieces, {}, 99, [p.encode() for p in names], merges=False))

    def cuts(word):
        if not word:
            yield 0.0, []
        for p in names:
            if word.startswith(p):
                for cost, rest in cuts(word[len(p) :]):
                    yield cost - pieces[p][1], [p, *rest]

    for word in ["▁abab", "▁ba", "▁aabbab", "abba"]:
        assert coder.path(word) == min(cuts(word))[1]
    assert coder.encode("azz b").tolist()[1] == 99


def test_memory_of_words_is_bounded(model, library, monkeypatch):
    monkeypatch.setattr(sentencepiece, "REMEMBERED", 5)
    coder = sentencepiece.Coder(model)
    text = prose(3, 200)
    assert coder.encode(text).tolist() == library.encode(text)
    assert len(coder.words) <= 5 and len(coder.words.older) <= 5


def test_columns_are_coded_and_decoded(table, model, library):
    docs = table(ODD)
    out = docs.withColumn("ids", sentencepiece.encode(F.col("text"), model))
    out = out.withColumn("back", sentencepiece.decode(F.col("ids"), model))
    rows = out.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r["ids"] == library.encode(r["text"] or "")
        assert r["back"] == (r["text"] or "").replace("▁", " ")
    empty = table([]).withColumn("ids", sentencepiece.encode(F.col("text"), model))
    assert empty.collect() == []


def test_texts_are_coded_both_ways_by_one_worker(spark, table, model, library):
    out = table(ODD).withColumn("coded", sentencepiece.round_trip(F.col("text"), model))
    for r in out.collect():
        assert r["coded"]["ids"] == library.encode(r["text"] or "")
        assert r["coded"]["decoded"] == (r["text"] or "").replace("▁", " ")
    assert table([]).withColumn("coded", sentencepiece.round_trip(F.col("text"), model)).collect() == []
    query = queries.op1_sentencepiece(spark, "/root/testdata/sf0.001")
    assert query._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_a_worker_keeps_the_machines_of_one_model():
    one = sentencepiece._coder(sentencepiece.load(MODEL))
    assert sentencepiece._coder(sentencepiece.load(MODEL)) is one
    nameless = sentencepiece.Model({"a": (1, -1.0)}, {}, 0, [], True)
    assert sentencepiece._coder(nameless) is not sentencepiece._coder(nameless)
    assert sentencepiece._coder(sentencepiece.load(MODEL)) is one


def test_words_are_remembered_without_the_marks_behind_them(model, library):
    coder = sentencepiece.Coder(model)
    text = "elle, elle. elle; (elle) elle's x²y a1b2 vi-elle\nelle 'elle' ²elle elle²."
    assert coder.encode(text).tolist() == library.encode(text)
    assert "▁elle" in coder.words and "▁elle," not in coder.words


def test_words_that_extend_remembered_ones_are_coded_as_by_the_library(model, library):
    coder = sentencepiece.Coder(model)
    text = prose(5, 300)
    words = [w[:k] for w in text.split() for k in range(1, len(w) + 1)]
    for w in words + words[::-1]:
        assert coder.encode(w).tolist() == library.encode(w)


@pytest.mark.parametrize("run", ["天地玄黃宇宙洪荒龘靐", "🙂🙃🚀🫠", "☃☄★☎", "ก็ไปที่โน่น"])
def test_encoding_of_long_runs_without_a_blank(run):
    import sentencepiece as library

    reference = library.SentencePieceProcessor(model_file=MODEL)
    coder = sentencepiece.Coder(sentencepiece.load(MODEL))
    text = (run * (100_000 // len(run) + 1))[:100_000]
    for t in (text, f"some words {text}\n{text[:5000]} and more"):
        assert coder.encode(t).tolist() == reference.encode(t)


def test_unknown_characters_that_meet_are_one():
    pieces = {"▁": (1, -1.0), "a": (2, -1.0), "▁a": (3, -0.5)}
    for merges in (True, False):
        coder = sentencepiece.Coder(sentencepiece.Model(pieces, {}, 0, [], merges))
        assert coder.encode("axyaxx").tolist() == [3, 0, 2, 0]
