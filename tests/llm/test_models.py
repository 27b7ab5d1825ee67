"""Language identification, quality, language model and HTML extraction."""

import math
import random
from collections import Counter
from itertools import product

import numpy as np
import pytest
from llm_rows import ODD, prose
from pyspark.sql import functions as F

from aerostat.llm import class_lm, dom, html_extraction, language_id, quality
from aerostat.llm.common import remainder

SF = "/root/testdata/sf0.01"


# Language identification


def naive_counts(text):
    out = Counter()
    for word in "".join(c.lower() if c.isalpha() else " " for c in text).split():
        padded = f" {word} "
        for n in (1, 2, 3):
            out.update(g for i in range(len(padded) - n + 1) if (g := padded[i : i + n]).strip())
    # A blank between two words is one character, so n-grams that hold only part of a word count once.
    return out


def packed(gram):
    key = 0
    for c in gram:
        key = (key << 21) | ord(c)
    return key


@pytest.mark.parametrize("text", ["ab ab, cde!", "É a-b 12x", "你好 世界", " ", "", "x"])
def test_gram_counts(text):
    keys, counts = language_id.gram_counts(text)
    assert dict(zip(keys.tolist(), counts.tolist())) == {packed(g): n for g, n in naive_counts(text).items()}


def test_gram_counts_of_pieces(monkeypatch):
    text = prose(1, 200)
    whole = language_id.gram_counts(text)
    monkeypatch.setattr(language_id, "PIECE", 37)
    keys, counts = language_id.gram_counts(text)
    assert (keys[counts != 0] == whole[0]).all() and (counts[counts != 0] == whole[1]).all()


def test_out_of_place_distance_by_hand(table):
    docs = table([(1, "aa aa ab", "x"), (2, "bb bb ba", "y"), (3, "cc", None), (4, None, "z")])
    profiles = language_id.learn_profiles(docs, ranks=20)
    assert profiles.langs == ["x", "y"]

    def order(text):
        return [g for g, _ in sorted(naive_counts(text).items(), key=lambda p: (-p[1], packed(p[0])))][:20]

    def distance(text, profile):
        own, ranks = order(text), {g: i for i, g in enumerate(order(profile))}
        return sum(abs(ranks[g] - i) if g in ranks else 20 for i, g in enumerate(own)), len(own)

    for text in ("aa", "ab ba", "bb aa", "zz"):
        far = [distance(text, p) for p in ("aa aa ab", "bb bb ba")]
        lang, score = profiles.place(text)
        assert lang == ("x" if far[0][0] <= far[1][0] else "y")
        assert score == pytest.approx(1 - min(far)[0] / (20 * far[0][1]))


def test_language_of_odd_rows(table):
    docs = table(ODD)
    profiles = language_id.learn_profiles(docs)
    out = docs.withColumn("told", language_id.language(F.col("text"), profiles)).collect()
    assert len(out) == len(ODD)
    for r in out:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["told"]["lang_pred"] == "und") == (not letters)
        assert 0 <= r["told"]["score"] <= 1
    empty = table([])
    nothing = language_id.learn_profiles(empty)
    assert empty.withColumn("told", language_id.language(F.col("text"), nothing)).collect() == []
    assert nothing.place("text") == ("und", 0.0)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = remainder(F.col("doc_id"), 5) == 0
    profiles = language_id.learn_profiles(docs.filter(~held))
    rows = docs.filter(held).select("lang", language_id.language(F.col("text"), profiles)["lang_pred"].alias("p")).collect()
    assert np.mean([r["lang"] == r["p"] for r in rows]) > 0.97


# Quality


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = remainder(F.col("doc_id"), 5) == 0
    model = quality.learn_quality(docs.filter(~held), labels)
    rows = docs.filter(held).join(labels, "doc_id").select("quality", quality.quality(F.col("text"), model).alias("s")).collect()
    for label in (0, 1):
        some = [(r["s"] >= 0.3) == label for r in rows if r["quality"] == label]
        assert len(some) > 5 and np.mean(some) > 0.9


def test_scores_against_one_by_one_cosines():
    texts = [prose(i, 20) if i % 3 else prose(i, 20).upper() + "!!" for i in range(40)]
    model = quality.fit(np.array([quality.terms(t) for t in texts]), [i % 3 > 0 for i in range(40)], dims=8)
    assert model.scores(["", None]).tolist() == [0.5, 0.5]
    for text in [prose(99, 30), "ABC!! DEF!!", "ABC def!!"]:
        z = model.latent(quality.terms(text)[None])[0]
        near = sorted(((float(np.dot(z, v)), vote) for v, vote in zip(model.vectors, model.votes)), reverse=True)[: quality.NEIGHBOURS]
        weights = [(max(s, 1e-6) ** quality.SHARPNESS, vote) for s, vote in near]
        want = sum(w * v for w, v in weights if v > 0) / sum(w * abs(v) for w, v in weights)
        assert model.scores([text])[0] == pytest.approx(want, abs=1e-3)


def test_quality_of_odd_rows(spark, table):
    docs = table(ODD)
    labels = spark.createDataFrame([(2, 0), (4, 1), (4, 1), (6, 1), (6, None), (99, 1), (None, 1)], "doc_id bigint, quality int")
    for marks in (labels, labels.filter("quality = 1"), labels.filter("false")):
        model = quality.learn_quality(docs, marks)
        scores = [r["s"] for r in docs.select(quality.quality(F.col("text"), model).alias("s")).collect()]
        assert len(scores) == len(ODD) and all(0 <= s <= 1 for s in scores)
    assert quality.learn_quality(table([]), labels) is None


# Language model


def brute_tokens(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [w.encode() for w in "".join(" " if c in "\x20\x09\x0a\x0b\x0c\x0d" else c for c in low).split(" ") if w] + [b"\n"]


def check_scores(rows, train_rows, model, got):
    counts = Counter(w for _, t, *_ in train_rows for w in brute_tokens(t))
    n, v = sum(counts.values()), len(counts)
    assert (model.train_tokens, model.vocabulary) == (n, v)
    groups = {}
    for w, c in counts.items():
        f = int(model.forms.of([w])[0])
        groups[f] = groups.get(f, 0) + c + 1
    want = []
    for _, text, *_ in rows:
        ws = brute_tokens(text)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        score, before = 0.0, len(model.step) - 1
        for w in ws:
            f = int(model.forms.of([w])[0])
            c = int(model.classes[f])
            score += model.step[before, c] + model.emit[f]
            if f >= len(model.forms.words):
                score += math.log10((counts[w] + 1) / (groups.get(f, 0) + 1))
            before = c
        want.append((len(ws), sum(counts[w] > 0 for w in ws), base, score))
    got = sorted((r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got)
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-9)


@pytest.mark.parametrize("common", [7, 10_000])
def test_scores_against_a_loop(table, monkeypatch, common):
    monkeypatch.setattr(class_lm, "COMMON", common)
    rows = [r for r in ODD if r[0] != 10] + [(i, prose(i, 40, "abc") + "\tEnd") for i in range(20, 60)]
    train = rows[::2]
    model = class_lm.learn(table(train), words=5, endings=6, classes=4)
    check_scores(rows, train, model, class_lm.score(table(rows), model).collect())


def test_model_is_a_distribution(table):
    model = class_lm.learn(table([(i, prose(i, 30, "ab")) for i in range(20)]), words=6, endings=5, classes=4)
    assert (10**model.step).sum(1) == pytest.approx(np.ones(len(model.step)))
    for c in set(model.classes):
        assert (10 ** model.emit[model.classes == c]).sum() == pytest.approx(1)


def test_exchange_only_raises_the_likelihood_and_finds_clear_classes():
    rng = np.random.default_rng(1)
    kind = np.arange(40) % 2
    table_ = rng.poisson(np.where(kind[:, None] != kind[None], 20, 0.2)).astype(float)
    of = class_lm.exchange(table_[:, :], 2)
    assert len({(a, b) for a, b in zip(of, kind)}) == 2

    def likelihood(classes):
        k = classes.max() + 1
        m = np.eye(k)[classes]
        t = m.T @ table_ @ m
        def h(x):
            return (x[x > 0] * np.log(x[x > 0])).sum()
        return h(t) - h(t.sum(0)) - h(t.sum(1))

    shuffled = rng.permutation(of)
    assert likelihood(of) > likelihood(shuffled)
    assert (class_lm.exchange(np.zeros((3, 3)), 2) >= 0).all()


def test_language_model_of_empty_tables(table):
    model = class_lm.learn(table([]))
    got = class_lm.score(table([(1, "a b"), (2, None)]), model).collect()
    assert sorted(r["n_tokens"] for r in got) == [1, 3]
    assert all(r["n_known"] == 0 and r["base_score"] <= 0 and r["score"] <= 0 for r in got)
    assert class_lm.score(table([]), model).collect() == []


def test_held_out_text_is_likelier_than_by_the_base(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    held = remainder(F.col("doc_id"), 7) == 2
    model = class_lm.learn(docs.filter(~held))
    row = class_lm.score(docs.filter(held), model).agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert row["s"] > row["b"]


# HTML


@pytest.fixture(scope="module")
def trees(spark):
    return html_extraction.learn_trees(spark.read.parquet(f"{SF}/pages.parquet"), composed=400, sample=50)


def extract(trees, html):
    page = dom.read(html)
    return dom.decode(page, trees.chance(dom.features(page)))


def test_composed_pages_that_were_not_learned(trees):
    same = 0
    for seed in range(10**6, 10**6 + 150):
        page = dom.read(html_extraction.compose(seed))
        want = "\n".join(b[1] for b in page.blocks if html_extraction._composed_role(b))
        same += dom.decode(page, trees.chance(dom.features(page))) == want
    assert same >= 0.85 * 150


def test_whole_pages_of_the_table(spark, trees):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in pages.select("html", html_extraction.main_text(F.col("html"), trees).alias("t")).collect():
        inside = r["html"].split("<article>")[1].split("</article>")[0]
        page = dom.read(f"<article>{inside}</article>")
        assert r["t"] == "\n".join(b[1] for b in page.blocks)


def test_reader_closes_decodes_and_skips():
    page = dom.read('<p>a &amp; b&nbsp; c<p>d<br>e <b>f</b>g<script>var t="</p>";</script><!-- x --><li>h<li>i &lt;1 < 2')
    assert [b[1] for b in page.blocks] == ["a & b c", "d e fg", "h", "i <1 < 2"]
    assert dom.read(None).blocks == [] and dom.read("").blocks == []
    for broken in ("<", "<p", '<p class="x', "</p></div>", "<!--", "<script>", "a<b c='", "<table><tr><td>x<td>y</table>z"):
        dom.features(dom.read(broken))


@pytest.mark.parametrize(
    "html, blocks",
    [
        ("<p>first<svg><path><p>second part", ["first", "second part"]),
        ('<p>a <svg viewBox="0"><text>no</text></svg> b</p>c', ["a b", "c"]),
        ("<svg><foreignObject><div>no</div></foreignObject></svg>yes", ["yes"]),
        ("<p>a<svg><p>b</p></svg>c", ["a", "b", "c"]),
        ("<math><mi>x<div>a", ["a"]),
        ("<p>a<object data=x><p>b", ["a", "b"]),
        ("<p>a<object>x<object>y</object>z</object>b", ["ab"]),
        ("<object>a<object>x</object>b", ["ab"]),
        ("<p>a<template><p>b", ["a", "b"]),
        ("<p>a<noscript><p>no</noscript>b", ["ab"]),
        ("<p>a<script>no", ["a"]),
        ("<svg/>" * 20_000 + "a" + "<object>" * 20_000 + "<p>b", ["a", "b"]),
    ],
)
def test_what_embedded_content_leaves_of_the_text(html, blocks):
    assert [b[1] for b in dom.read(html).blocks] == blocks


def test_decoder_is_the_best_consistent_choice():
    rng = random.Random(2)
    page = dom.read("<div>a<div>b<p>c</p></div><section>d</section></div><p>e</p>")
    n = len(page.tag)

    def value(choice, chance):
        """Of a state per node (1 in, -1 out, 0 divided), or none if it is not consistent."""
        total = 0.0
        for i in range(n):
            p = page.parent[i]
            if p >= 0 and choice[p] and choice[i] != choice[p]:
                return None
            if choice[i]:
                total += math.log(chance[i] if choice[i] > 0 else 1 - chance[i])
            else:
                own = any(b[0] == i for b in page.blocks)
                total += max(math.log(chance[i]), math.log(1 - chance[i])) * own - 0.5
        return total

    for _ in range(20):
        chance = np.array([rng.uniform(0.02, 0.98) for _ in range(n)])
        choices = [(v, c) for c in product((1, -1, 0), repeat=n) if (v := value(c, chance)) is not None]
        _, best = max(choices)
        taken = [b[1] for b in page.blocks if best[b[0]] > 0 or (best[b[0]] == 0 and chance[b[0]] > 0.5)]
        assert dom.decode(page, chance) == "\n".join(taken)
    assert dom.decode(page, np.full(n, 0.9)) == "a\nb\nc\nd\ne"
    assert dom.decode(page, np.full(n, 0.1)) == ""
    # A strong node inside a weak one stands out; a doubtful one follows its surroundings.
    chance = np.full(n, 0.02)
    chance[page.tag.index("section")] = 0.99
    assert dom.decode(page, chance) == "d"
    chance = np.full(n, 0.98)
    chance[page.tag.index("section")] = 0.45
    assert dom.decode(page, chance) == "a\nb\nc\nd\ne"


def test_pages_with_nulls_and_long_ones(spark, trees):
    long = "<article>" + "".join(f"<p>{prose(i, 30)}.</p>" for i in range(3000)) + "</article>"
    rows = [(1, None), (2, ""), (3, "no markup at all."), (4, long), (4, long), (None, "<nav><a href=x>menu</a></nav>")]
    out = spark.createDataFrame(rows, "page_id bigint, html string").select("page_id", html_extraction.main_text(F.col("html"), trees).alias("t")).collect()
    assert len(out) == 6
    got = [r["t"] for r in out if r["page_id"] == 4]
    assert got[0] == got[1] and got[0].count("\n") == 2999
    assert [r["t"] for r in out if r["page_id"] in (1, 2)] == ["", ""]
