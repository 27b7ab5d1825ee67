"""Phrase collocations, counted by dynamic itemset counting.

Documents are dealt to shards that are scanned in a cycle. A scan counts phrases of all lengths at
once: words from the start, and a longer phrase from the first scan after both its subphrases (all
words but the last, all but the first) have reached the threshold in what was counted so far. Every
phrase is counted for exactly one full cycle, whenever it starts, and then settled; scanning ends
when nothing is being counted.

Which subphrases have reached the threshold travels to the scans as a table of ``2 ** BUCKET_BITS``
bytes, whatever the input: the scan from which each hash bucket of phrases counts as frequent.
Phrases that share a bucket can only make a phrase be counted that need not be; the counts
themselves are kept by the phrases' own text, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerostat.llm.common import ascii_lower, whole
from aerostat.plans.lineage import materialise, release

SHARDS = 2
LONGEST = 5  # words of a phrase
FEWEST = 100  # occurrences of a phrase
BEST = 2000  # phrases reported per language
BUCKET_BITS = 23
UNKNOWN = "und"
_NEVER = 255  # scan number of buckets that are not frequent
_HELD = 3_000_000  # words that a task holds before it counts them
_ODD, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)  # mix bits
_STOPS = ".,;:!?\n\x0b\x0c\r"
_END = "\n"  # stands for the end of a piece; no word holds it
# A key is a language, a line feed and a phrase; the empty phrase stands for all words of the language.
_ROWS = "key string, since int, n long"


class _Words(dict):
    """Numbers of words in order of first sight; 0 ends a piece."""

    def __init__(self) -> None:
        super().__init__({_END: 0})

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class _Held:
    """Words of one language that a task has read but not counted."""

    def __init__(self) -> None:
        self.words = _Words()
        self.runs: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str) -> None:
        words = text.split(" ") if text else []
        self.runs += [np.fromiter(map(self.words.__getitem__, words), np.int64, len(words)), np.zeros(1, np.int64)]
        self.size += len(words) + 1


def _spaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as words and ends of pieces with one blank between them, so that scans only split."""
    for batch in batches:
        texts = []
        for text in batch.column(1).to_pylist():
            for stop in _STOPS:
                text = text.replace(stop, " \n ")
            texts.append(" ".join(filter(None, text.replace("\t", " ").split(" "))))
        yield pa.record_batch([batch.column(0), pa.array(texts, pa.string()), batch.column(2)], ["lang", "text", "shard"])


def _hashes(lang: str, words: Iterable[str]) -> np.ndarray:
    """Numbers of the words of a language."""
    start = crc32(f"{lang}\n".encode())
    return np.array([crc32(w.encode(), start) for w in words], np.uint64)


def _longer(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Numbers of phrases with one word more, from those of the phrase and the word."""
    return (phrase ^ (phrase >> _SHIFT)) * _ODD + word


def _buckets(phrase: np.ndarray, buckets: int) -> np.ndarray:
    return (((phrase ^ (phrase >> _SHIFT)) * _ODD) >> np.uint64(32)).astype(np.int64) & (buckets - 1)


def _chosen(words: list[str], at: np.ndarray, before: str) -> pa.Array:
    """The words at some places, each with a text before it."""
    which, places = np.unique(at, return_inverse=True)
    return pa.array([before + words[w] for w in which.tolist()], pa.string()).take(pa.array(places))


def _phrases(lang: str, held: _Held, since: np.ndarray, scan: int, shards: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``_ROWS``: what this scan has to count in the held words."""
    words = list(held.words)
    number = _hashes(lang, words)
    at = np.concatenate(held.runs)

    def rows(keys: pa.Array, begun: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([keys, pa.array(begun.astype(np.int32)), pa.array(n.astype(np.int64))], ["key", "since", "n"])

    if scan < shards:
        n = np.bincount(at, minlength=len(words))
        n[0] = n[1:].sum()  # of all words, in place of the ends
        yield rows(pa.array([f"{lang}\n", *(f"{lang}\n{w}" for w in words[1:])], pa.string()), np.zeros(len(n)), n)
    # The scan from which the phrase that starts at each place is frequent; ends of pieces never are.
    of_word = since[_buckets(number, len(since))]
    of_word[0] = _NEVER
    frequent = of_word[at]
    phrase = number[at]
    for length in range(2, LONGEST + 1):
        ok = frequent <= scan
        places = np.flatnonzero(ok[:-1] & ok[1:])
        if not len(places):
            return
        begun = np.maximum(frequent[places], frequent[places + 1])
        due = scan - begun.astype(np.int64) < shards
        if due.any():
            # Equal phrases get equal numbers word by word, so that no checksum decides.
            first = places[due]
            code = at[first]
            for more in range(1, length):
                _, which, code, n = np.unique(
                    code * len(words) + at[first + more], return_index=True, return_inverse=True, return_counts=True
                )
            first = first[which]
            parts = [_chosen(words, at[first + more], f"{lang}\n" if not more else "") for more in range(length)]
            yield rows(pc.binary_join_element_wise(*parts, " "), begun[due][which], n)
        if length < LONGEST:
            grown = _longer(phrase[places], number[at[places + length - 1]])
            phrase[places] = grown
            frequent = np.full(len(at), _NEVER, np.uint8)
            # Not before its own count began: its bucket may have been frequent by another phrase.
            frequent[places] = np.maximum(since[_buckets(grown, len(since))], begun)


def _scan(shard: DataFrame, since: np.ndarray, scan: int, shards: int) -> DataFrame:
    sent = shard.sparkSession.sparkContext.broadcast(since)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        held: dict[str, _Held] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = held.setdefault(lang, _Held())
                size -= own.size
                own.add(text)
                size += own.size
                if size >= _HELD:
                    for name, one in held.items():
                        yield from _phrases(name, one, table, scan, shards)
                    held, size = {}, 0
        for name, one in held.items():
            yield from _phrases(name, one, table, scan, shards)

    return shard.select("lang", "text").mapInArrow(count, _ROWS)


def _numbered(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.zeros(batch.num_rows, np.int64)
        for i, (lang, phrase) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            words = _hashes(lang, phrase.split(" "))
            number = words[:1]
            for k in range(1, len(words)):
                number = _longer(number, words[k : k + 1])
            found[i] = _buckets(number, buckets)[0]
        yield pa.record_batch([pa.array(found)], ["bucket"])


def _told(counts: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``length`` and ``n`` of keys and their counts; length 0 for all words."""
    phrase, lang = F.substring_index("key", "\n", -1), F.expr("left(key, length(key) - length(phrase) - 1)")
    length = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    told = counts.withColumn("phrase", phrase).select(lang.alias("lang"), "phrase", length.alias("length"), "n")
    return told.withColumn("phrase", F.when(F.col("length") > 0, F.col("phrase")))


def _bits(frequent: DataFrame, buckets: int) -> np.ndarray:
    """Numbers of the buckets that the phrases fall into, brought to the driver as bit maps."""
    numbered = frequent.select("lang", "phrase").mapInArrow(partial(_numbered, buckets=buckets), "bucket long")
    rows = numbered.groupBy(F.bitmap_bucket_number("bucket").alias("part"))
    maps = rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bucket")).alias("map")).collect()
    found = [np.zeros(0, np.int64)]
    for part, bits in maps:  # parts count from 1, after the part 0 of the bucket 0 alone
        set_ = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
        found.append((part - 1) * len(bits) * 8 + set_ + 1 if part else set_)
    return np.concatenate(found)


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", fewest: int = FEWEST, shards: int = SHARDS) -> DataFrame:
    """``lang``, ``phrase``, ``length`` and count ``n`` of phrases of up to ``LONGEST`` words that
    occur often enough, and with length 0 and no phrase the number of all words of each language.

    Null languages are ``und``; null texts are empty.
    """
    if not 0 < shards * LONGEST < _NEVER:
        raise ValueError(f"{shards} shards are too few or too many")
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN))
    text = ascii_lower(whole(F.col(text_col)))
    dealt = docs.select(lang.alias("lang"), text.alias("text"))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("lang", "text"), F.lit(shards)).cast("int"))
    dealt = materialise(dealt.mapInArrow(_spaced, "lang string, text string, shard int"), "phrase-shards", ["shard"])
    buckets = 1 << BUCKET_BITS
    since = np.full(buckets, _NEVER, np.uint8)
    settled: list[DataFrame] = []
    before: DataFrame | None = None
    open_: DataFrame | None = None
    scan = 0
    while True:
        counted = _scan(dealt.filter(F.col("shard") == scan % shards), since, scan, shards)
        rows = counted if open_ is None else counted.unionByName(open_)
        state = rows.groupBy("key").agg(F.max("since").alias("since"), F.sum("n").alias("n"))
        # Settled phrases are kept if they are frequent, and the numbers of all words anyway.
        done, often = F.col("since") <= scan - shards + 1, F.col("n") >= fewest
        state = materialise(state.filter(~done | often | F.col("key").endswith("\n")), "phrase-counts")
        if before is not None:
            release(before)
        before = state
        settled.append(materialise(state.filter(done).drop("since"), "phrases"))
        new = _bits(_told(state.filter(often)).filter(F.col("length").between(1, LONGEST - 1)), buckets)
        scan += 1
        since[new] = np.minimum(since[new], scan)
        reached = since[since != _NEVER]
        open_ = state.filter(~done)
        if scan >= shards and not (len(reached) and reached.max() > scan - shards):
            break
    release(dealt, state)
    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    return _told(found)


def _part(words: str, k: str, tail: bool) -> Column:
    picked = f"slice({words}, {k} + 1, size({words}))" if tail else f"slice({words}, 1, {k})"
    return F.expr(f"array_join({picked}, ' ')")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", fewest: int = FEWEST, best: int = BEST, shards: int = SHARDS) -> DataFrame:
    """The best phrases of each language by their weakest cut: ``lang``, ``rank``, ``phrase``,
    ``a``, ``l``, ``r``, ``n``, ``score``.

    A phrase of ``a`` occurrences cut in two parts of ``l`` and ``r`` scores floor(1000 a n / (l r)),
    ``n`` being all words of the language; its lowest cut counts, the first of equals. Phrases that
    lie inside a longer frequent one as often as anywhere are left out. Languages that hold no such
    phrase, empty tables, null and empty texts give no rows; copies of a row count each; other
    columns are not read.
    """
    found = materialise(frequent_phrases(docs, text_col, lang_col, fewest, shards), "phrases-all")
    one = found.filter("length > 0").select("lang", "phrase", "n")
    long_ = found.filter("length > 1").select("lang", "phrase", F.split("phrase", " ").alias("words"), F.col("n").alias("a"))
    # A longer phrase as frequent as one inside it is as frequent as all phrases between the two.
    inside = [F.expr("array_join(slice(words, 1, size(words) - 1), ' ')"), F.expr("array_join(slice(words, 2, size(words)), ' ')")]
    covered = long_.filter(F.size("words") > 2).select("lang", F.explode(F.array(*inside)).alias("phrase"), "a").distinct()
    kept = long_.join(covered, ["lang", "phrase", "a"], "left_anti")
    cuts = kept.select("*", F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part("words", "k", False).alias("first"), _part("words", "k", True).alias("rest"))
    left = one.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = one.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    totals = found.filter("length = 0").select("lang", "n")
    met = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    score = F.expr("(cast(1000 * a as decimal(18,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(19,0)))")
    weakest = met.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = weakest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
