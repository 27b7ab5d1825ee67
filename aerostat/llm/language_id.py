"""Language identification by rank-order profiles of character n-grams.

A language's profile is the list of its most frequent n-grams. A document's own list is compared
with each profile by the out-of-place distance: how many ranks each of its n-grams lies away from
its place in the profile, or the profile's length where it is missing there.

N-grams of one to three letters are taken inside words, a blank standing for either end of a word.
They are packed into 63-bit integers (21 bits a code point) and counted by sorting, so any script
works and memory follows the longest piece, not the alphabet.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
RANKS = 300  # n-grams of a profile
PIECE = 1 << 20  # characters counted at a time
HELD = 1 << 20  # distinct n-grams a task holds before it passes its counts on
_BITS = 21
_BLANK = ord(" ")


@lru_cache(1)
def _letters() -> np.ndarray:
    """Code point to its small letter, or to a blank if it is no letter."""
    out = np.full(0x110000, _BLANK, np.int64)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            small = ch.lower()
            out[c] = ord(small) if len(small) == 1 else c
    return out


def cleaned(text: str) -> np.ndarray:
    """Code points of a text's words in small letters, one blank around each; empty without any."""
    a = _letters()[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]
    blank = np.concatenate([[True], a == _BLANK, [True]])
    a = np.concatenate([[_BLANK], a, [_BLANK]])
    a = a[~(blank & np.concatenate([[False], blank[:-1]]))]
    return a if len(a) > 1 else a[:0]


def grams(a: np.ndarray) -> np.ndarray:
    """All n-grams of one to three code points that span no blank."""
    blank = a == _BLANK
    two = (a[:-1] << _BITS) | a[1:]
    three = (two[:-1] << _BITS) | a[2:]
    return np.concatenate([a[~blank], two[~(blank[:-1] & blank[1:])], three[~blank[1:-1]]])


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, ascending, and their counts; both empty without a letter.

    A long text is counted piece by piece; pieces overlap by two characters, and what lies wholly
    in an overlap is subtracted once.
    """
    a = cleaned(text or "")
    if not len(a):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys, n = np.unique(grams(a[:PIECE]), return_counts=True)
    for start in range(PIECE - 2, len(a) - 2, PIECE - 2):
        more, m = np.unique(grams(a[start : start + PIECE]), return_counts=True)
        twice, t = np.unique(grams(a[start : start + 2]), return_counts=True)
        keys, n = merged([keys, more, twice], [n, m, -t])
    return keys, n


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    one, place = np.unique(np.concatenate(keys), return_inverse=True)
    return one, np.bincount(place, np.concatenate(counts), len(one)).astype(np.int64)


def ranked(keys: np.ndarray, counts: np.ndarray, ranks: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by n-gram."""
    if len(keys) > ranks:
        keep = counts >= np.partition(counts, len(counts) - ranks)[len(counts) - ranks]
        keys, counts = keys[keep], counts[keep]
    return keys[np.lexsort((keys, -counts))[:ranks]]


@dataclass
class Profiles:
    """Per language its n-grams in ascending order with their ranks. Bounded: languages x ranks."""

    ranks: int
    langs: list[str]
    keys: list[np.ndarray]
    places: list[np.ndarray]

    def place(self, text: str | None) -> tuple[str, float]:
        """The nearest language and a score: 1 less its distance as a share of the largest one."""
        keys, counts = gram_counts(text)
        own = ranked(keys, counts, self.ranks)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.arange(len(own))
        far = []
        for keys, places in zip(self.keys, self.places):
            i = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            far.append(np.where(keys[i] == own, np.abs(places[i] - at), self.ranks).sum())
        best = int(np.argmin(far))
        return self.langs[best], 1.0 - float(far[best]) / (self.ranks * len(own))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[list[np.ndarray], list[np.ndarray]]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for lang, (keys, counts) in held.items():
            k, n = merged(keys, counts)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(k)), "gram": k, "n": n})
        held.clear()

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            k, n = gram_counts(text)
            if len(k):
                keys, counts = held.setdefault(lang, ([], []))
                keys.append(k)
                counts.append(n)
                size += len(k)
            if size > HELD:
                for lang, (keys, counts) in held.items():
                    k, n = merged(keys, counts)
                    held[lang] = ([k], [n])
                size = sum(len(k) for keys, _ in held.values() for k in keys)
                if size > HELD // 2:
                    yield from out()
                    size = 0
    yield from out()


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", ranks: int = RANKS) -> Profiles:
    """Profiles of every language of the frame, counted over all its texts.

    Rows whose language or text is null teach nothing, nor do texts without a letter. Ties of
    frequency go by n-gram, so the profiles don't depend on the order of rows.
    """
    known = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = known.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # Compared as it stands, the row number is a limit that Spark applies before the shuffle too.
    top = counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= ranks).withColumn("place", F.col("place") - 1)
    rows = top.orderBy("lang", "gram").collect()  # languages x ranks rows
    langs = sorted({r["lang"] for r in rows})
    per = {lang: [r for r in rows if r["lang"] == lang] for lang in langs}
    return Profiles(
        ranks,
        langs,
        [np.array([r["gram"] for r in per[x]], np.int64) for x in langs],
        [np.array([r["place"] for r in per[x]], np.int64) for x in langs],
    )


def language(text: Column, profiles: Profiles) -> Column:
    """Struct of ``lang_pred`` and ``score`` for a text.

    Null, empty and letterless texts are ``und`` with score 0, as is everything if no language was
    learned. Equal distances go to the language that sorts first.
    """

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def place(texts: pa.Array) -> pa.Array:
        lang, score = zip(*map(profiles.place, texts.to_pylist())) if len(texts) else ((), ())
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    return place.asNondeterministic()(text)  # so that a filter on it does not run it twice
