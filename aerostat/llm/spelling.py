"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Two words are one edit apart exactly if their common prefix and common suffix together reach the
longer length minus one. One of the two then covers half of the longer word, so a pair meets in the
tile of words that share that prefix or, if the prefix is too short, in that of the suffix; it meets
in one tile only. Tiles of rare keys are packed together and tiles of frequent ones are cut into
blocks; every pair of blocks is one group, whose words form padded matrices of code points that are
compared as a whole. A group holds about ``2 * TILE`` words, however many share a key, and returns
one row per word: how many neighbours it met and the most frequent one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostat.llm.common import ascii_lower, whole
from aerostat.plans.lineage import materialise

SHORTEST = 6  # code points of a word
FEWEST = 5  # occurrences of a word
FACTOR = 5  # so many times more frequent must a form be
SLIPS = 199  # one run in so many, by hash, loses a code point
TILE = 512  # words of a block, about
_HELD = 200_000  # different words that a task counts before it hands them on
_RUN = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")
_MOST_ROUNDS = 40


def slipped(key: str, run: str) -> str:
    """The run as it counts: without one code point if the hash of key and run says so."""
    h = crc32(f"{key}:{run}".encode())
    at = h % len(run)
    return run[:at] + run[at + 1 :] if h % SLIPS == 0 else run


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def handed(counts: Counter[str]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    held: Counter[str] = Counter()
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            start = crc32(f"{key}:".encode())
            for run, n in Counter(_RUN.findall(text)).items():
                if crc32(run.encode(), start) % SLIPS == 0:
                    run = slipped(key, run)
                if len(run) >= SHORTEST:
                    held[run] += n
            if len(held) >= _HELD:
                yield handed(held)
                held = Counter()
    if held:
        yield handed(held)


def frequent_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and its occurrences ``n``, of all words long and frequent enough.

    Null ids count as the empty text, null texts have no words, and repeated rows count each.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(key.alias("key"), ascii_lower(whole(F.col(text_col))).alias("text"))
    counted = rows.mapInArrow(_counts, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= FEWEST)


def _matrix(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, padded with zeros on the right, and read backwards likewise."""
    ahead = words.astype(f"U{width}").view(np.uint32).reshape(len(words), width)
    back = np.array([w[::-1] for w in words], f"U{width}").view(np.uint32).reshape(len(words), width)
    return ahead, back


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of every line of ``a`` with every line of ``b``."""
    same = np.ones((len(a), len(b)), bool)
    total = np.zeros((len(a), len(b)), np.uint16)
    for k in range(a.shape[1]):
        same &= a[:, k, None] == b[None, :, k]
        if not same.any():
            break
        total += same
    return total


def _near(a: np.ndarray, b: np.ndarray, longer: int, prefixed: bool) -> np.ndarray:
    """Which words of ``a`` and ``b`` are one edit apart and belong to this kind of tile."""
    (ahead_a, back_a), (ahead_b, back_b) = _matrix(a, longer), _matrix(b, longer)
    start = _common(ahead_a, ahead_b)
    here = start >= longer // 2 if prefixed else start < longer // 2
    full_a, full_b = ahead_a[:, -1] != 0, ahead_b[:, -1] != 0
    # Two words that are both shorter belong to the tiles of their own length.
    here &= full_a[:, None] | full_b[None, :]
    if here.any():
        here &= (start + _common(back_a, back_b) >= longer - 1) & (a[:, None] != b[None, :])
    return here


def _best(near: np.ndarray, words: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
    met = near.sum(axis=1)
    which = near.argmax(axis=1)[met > 0]  # others are sorted, the best one first
    out = words[met > 0][["word"]].copy()
    out["n_near"] = met[met > 0]
    out["other_n"] = others["n"].to_numpy()[which]
    out["other"] = others["word"].to_numpy()[which]
    return out


def _compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    longer, prefixed, _, one, two = key
    group = group.sort_values(["n", "word"], ascending=[False, True])
    a, b = group[group["block"] == one], group[group["block"] == two]
    near = _near(a["word"].to_numpy(object), b["word"].to_numpy(object), int(longer), bool(prefixed))
    found = _best(near, a, b)
    return found if one == two else pd.concat([found, _best(near.T, b, a)])


def _tiled(words: DataFrame) -> DataFrame:
    """Every word once per pair of blocks that it takes part in."""
    size = F.length("word")
    kinds = [F.struct((size + more).alias("longer"), F.lit(prefixed).alias("prefixed")) for more in (0, 1) for prefixed in (True, False)]
    rows = words.select("word", "n", F.inline(F.array(*kinds)))
    half = F.shiftright("longer", 1)
    part = F.when(F.col("prefixed"), F.substr("word", F.lit(1), half)).otherwise(F.substr("word", -half, half))
    rows = rows.withColumn("hash", F.xxhash64(part))
    lengths = rows.groupBy("longer").agg(F.ceil(F.count(F.lit(1)) / (2 * TILE)).alias("bins"))
    binned = rows.join(lengths, "longer").withColumn("bin", F.pmod("hash", "bins")).drop("hash", "bins")
    tile = ["longer", "prefixed", "bin"]
    sizes = binned.groupBy(tile).agg(F.count(F.lit(1)).alias("size"), F.max(F.length("word")).alias("most"))
    # A tile of one word, or of none that is as long as the tile's longer word, has no pairs.
    blocks = F.ceil(F.col("size") / TILE).cast("int").alias("blocks")
    sizes = sizes.filter("size > 1 AND most = longer").select(*tile, blocks)
    cut = binned.join(sizes, tile).withColumn("block", F.pmod(F.xxhash64("word"), "blocks").cast("int"))
    cut = cut.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cut.select(*tile, "word", "n", "block", F.least("block", "met").alias("one"), F.greatest("block", "met").alias("two"))


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``n_near``, and the most frequent neighbour ``other`` with ``other_n``.

    ``words`` has ``word`` and ``n``, one row per word. Words without neighbours are left out; of
    equally frequent neighbours the smallest in code-point order counts.
    """
    found = _tiled(words).groupBy("longer", "prefixed", "bin", "one", "two").applyInPandas(_compare, "word string, n_near long, other_n long, other string")
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("other")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.minus")).alias("other_n"))


def _roots(links: DataFrame) -> DataFrame:
    """``word`` and the ``root`` that following ``form`` leads to; every round doubles the steps.

    A form is ``FACTOR`` times as frequent as its word, so the links have no loops.
    """
    links = materialise(links.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(_MOST_ROUNDS):
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialise(links.join(ahead, "root", "left").select("word", "root", "next"), "spelling-roots")
        if moved.filter("next IS NOT NULL").isEmpty():
            return links
        links = moved.select("word", F.coalesce("next", "root").alias("root"))
    raise RuntimeError("forms lead in a circle")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per frequent word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    The form is the most frequent neighbour, of equals the first in code-point order, if it is
    ``FACTOR`` times as frequent as the word; the root is where forms of forms end. Other columns
    of the documents are not read. Empty tables, and texts without words, give no rows.
    """
    words = materialise(frequent_words(docs, id_col, text_col), "spelling-words")
    joined = words.join(neighbours(words), "word", "left")
    leads = F.col("other_n") >= F.col("n") * FACTOR
    told = joined.select(
        "word",
        F.when(leads, F.col("other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(leads, F.col("other_n")).alias("form_n"),
    )
    told = materialise(told, "spelling-forms")
    rooted = told.join(_roots(told.filter("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
