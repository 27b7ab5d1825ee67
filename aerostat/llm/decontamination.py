"""Benchmark decontamination by an FM-index over each shard of training text.

Every Arrow batch of documents is cut into shards of bounded size. A shard's words become ids of
the benchmark's vocabulary (0 for any other word), and an FM-index is built over them: suffix array
by prefix doubling, Burrows-Wheeler transform in a wavelet matrix, suffix positions sampled. All
phrases are searched backward at once, their occurrences located through the samples, and the hit
words of a document merged into removal spans.

A phrase can only occur inside a run of vocabulary words at least as long as the shortest phrase,
so the other words of a shard are left out of its index: that loses no occurrence and leaves a few
hundredths of the words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 13
SHARD_BYTES = 1 << 24  # text of a shard, unless one document is longer
BLOCK_WORDS = 1 << 20  # words of the phrases that are broadcast at a time
SAMPLE = 8  # every so many-th text position is kept
RESULT = "struct<n_words: bigint, n_hit: bigint, items: array<bigint>, spans: array<struct<start: bigint, stop: bigint>>>"

# ASCII that is no digit or letter separates words; capital ASCII letters count as small ones.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8; null has none."""
    return text.encode().translate(_TABLE).split() if text else []


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``s`` by prefix doubling."""
    n, step = len(s), 1
    _, rank = np.unique(s, return_inverse=True)
    while True:
        key = rank.astype(np.int64) * (n + 1)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key)
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = new
        step *= 2
        if step >= n or rank[order[-1]] == n - 1:
            return order


class WaveletMatrix:
    """Rank of any symbol in any prefix of a sequence, one bit of the symbol per level."""

    def __init__(self, s: np.ndarray, symbols: int):
        self.levels = []
        for bit in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            one = (s >> bit) & 1
            before = np.concatenate([[0], np.cumsum(one)])
            self.levels.append((bit, before, len(s) - int(before[-1])))
            s = np.concatenate([s[one == 0], s[one == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        low, high = np.zeros_like(end), end
        for bit, before, zeros in self.levels:
            one = (symbol >> bit) & 1
            low = np.where(one == 1, zeros + before[low], low - before[low])
            high = np.where(one == 1, zeros + before[high], high - before[high])
        return high - low

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at the positions."""
        symbol = np.zeros_like(at)
        for bit, before, zeros in self.levels:
            one = before[at + 1] - before[at]
            symbol |= one << bit
            at = np.where(one == 1, zeros + before[at], at - before[at])
        return symbol


class FMIndex:
    """Backward search and location in a sequence whose symbols are below ``symbols``."""

    def __init__(self, s: np.ndarray, symbols: int, sample: int = SAMPLE):
        s = np.concatenate([s + 1, [0]])  # 0 ends the text and sorts first
        order = suffix_array(s)
        self.bwt = WaveletMatrix(s[order - 1], symbols + 1)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=symbols + 1))])
        kept = order % sample == 0
        self.before = np.concatenate([[0], np.cumsum(kept)])
        self.samples = order[kept]
        self.n = len(s)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval of each row of a matrix of phrases; empty ones have equal ends."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for column in phrases.T[::-1]:
            c = column[live] + 1
            lo, hi = (self.first[c] + self.bwt.rank(c, x) for x in (low[live], high[live]))
            low[live], high[live] = lo, hi
            live = live[lo < hi]
            if not len(live):
                break
        high = np.maximum(high, low)
        return low, high

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: step back through the transform to a sampled one."""
        out = np.full(len(at), -1, np.int64)
        todo, steps = np.arange(len(at)), 0
        at = at.copy()
        while len(todo):
            here = at[todo]
            found = self.before[here + 1] > self.before[here]
            out[todo[found]] = self.samples[self.before[here[found]]] + steps
            todo = todo[~found]
            here = at[todo]
            c = self.bwt.access(here)
            at[todo] = self.first[c] + self.bwt.rank(c, here)
            steps += 1
        return out


@dataclass
class Phrases:
    """Windows of benchmark items: by length, their words as ids and which items have them.

    Bounded: at most ``BLOCK_WORDS`` item words, one longest item aside.
    """

    ids: dict[bytes, int]
    by_length: dict[int, tuple[np.ndarray, list[list[int]]]]

    @property
    def shortest(self) -> int:
        return min(self.by_length)


def phrases_of(items: list[tuple[int, list[bytes]]], window: int = WINDOW) -> Phrases:
    ids: dict[bytes, int] = {}
    found: dict[tuple[int, ...], list[int]] = {}
    for item, ws in items:
        own = [ids.setdefault(w, len(ids) + 1) for w in ws]
        m = min(window, len(own))
        for i in range(len(own) - m + 1 if own else 0):
            who = found.setdefault(tuple(own[i : i + m]), [])
            if not who or who[-1] != item:
                who.append(item)
    by_length = {}
    for m in sorted({len(p) for p in found}):
        same = [p for p in found if len(p) == m]
        by_length[m] = (np.array(same, np.int64), [found[p] for p in same])
    return Phrases(ids, by_length)


def hits(texts: list[str | None], phrases: Phrases) -> list[tuple[int, set[int], np.ndarray]]:
    """For each text of a shard: its words, the items found, and its hit words as a mask."""
    ids = phrases.ids.get
    lists = [words(t) for t in texts]
    sizes = np.array([len(x) for x in lists], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    # One more 0 after each document, so that no run crosses into the next.
    s = np.fromiter((i for x in lists for i in [*(ids(w, 0) for w in x), 0]), np.int64, int(sizes.sum()) + len(lists))
    shifted = starts + np.arange(len(lists))
    inside = np.concatenate([[0], (s > 0).view(np.int8), [0]])
    turn = np.flatnonzero(np.diff(inside))
    first, last = turn[::2], turn[1::2]
    long = last - first >= phrases.shortest
    first, last = first[long], last[long]
    items: list[set[int]] = [set() for _ in lists]
    delta = np.zeros(len(s) + 1, np.int64)
    if len(first):
        size = last - first + 1  # with the 0 that follows each run
        at = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        kept = s[at].copy()
        index = FMIndex(kept, len(phrases.ids) + 1)
        for m, (matrix, owners) in phrases.by_length.items():
            low, high = index.search(matrix)
            n = high - low
            which = np.repeat(np.arange(len(matrix)), n)
            rows = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            place = at[index.locate(rows)]
            np.add.at(delta, place, 1)
            np.add.at(delta, place + m, -1)
            doc = np.searchsorted(shifted, place, side="right") - 1
            for d, p in set(zip(doc.tolist(), which.tolist())):
                items[d].update(owners[p])
    hit = np.cumsum(delta[:-1]) > 0
    return [(int(n), i, hit[b : b + n]) for n, i, b in zip(sizes, items, shifted)]


def spans_of(hit: np.ndarray) -> np.ndarray:
    """Starts and ends of the runs of a mask, as rows."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))).reshape(-1, 2)


def _shards(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > SHARD_BYTES:
            yield start, i
            start, size = i, 0
        size += len(t or "")
    if texts:
        yield start, len(texts)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int) -> Iterator[Phrases]:
    """The benchmark's phrases in blocks of bounded size, one at a time."""
    held, size = [], 0
    for r in benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        ws = words(r["t"])
        if not ws:
            continue
        if held and size + len(ws) > block_words:
            yield phrases_of(held, window)
            held, size = [], 0
        held.append((r["i"], ws))
        size += len(ws)
    if held:
        yield phrases_of(held, window)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    into: str = "found",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents with a struct ``into``: words, hit words, items found, spans of hit words.

    A window is ``window`` consecutive words of an item, or a shorter item as a whole. Items and
    spans are ascending; spans count words and are merged where they touch. Null texts have no
    words; null or wordless items have no window, repeated items are found together, an item whose
    id is null is not listed but its words are hit. A benchmark larger than a block is searched
    block by block, so what is broadcast stays bounded. All other columns are kept, those called
    like the benchmark's too.
    """
    found = None
    for phrases in _blocks(benchmark, item_col, item_text_col, window, block_words):
        found = _search(F.col(text_col), phrases, found if found is not None else F.lit(None).cast(RESULT))
        docs = docs.withColumn(into, found)
        found = F.col(into)
    if found is None:
        docs = docs.withColumn(into, _search(F.col(text_col), None, F.lit(None).cast(RESULT)))
    return docs


def _search(text: Column, phrases: Phrases | None, before: Column) -> Column:
    @F.arrow_udf(RESULT)
    def search(texts: pa.Array, earlier: pa.Array) -> pa.Array:
        texts, earlier = texts.to_pylist(), earlier.to_pylist()
        out = []
        for a, b in _shards(texts):
            if phrases is None:
                found = [(len(w), set(), np.zeros(len(w), bool)) for w in map(words, texts[a:b])]
            else:
                found = hits(texts[a:b], phrases)
            for (n, items, hit), was in zip(found, earlier[a:b]):
                if was:
                    for span in was["spans"]:
                        hit[span["start"] : span["stop"]] = True
                    items = items.union(was["items"])
                spans = [{"start": x, "stop": y} for x, y in spans_of(hit).tolist()]
                out.append({"n_words": n, "n_hit": int(hit.sum()), "items": sorted(items - {None}), "spans": spans})
        return pa.array(out, TYPE)

    return search.asNondeterministic()(text, before)


_I64 = pa.int64()
TYPE = pa.struct(
    [
        ("n_words", _I64),
        ("n_hit", _I64),
        ("items", pa.list_(_I64)),
        ("spans", pa.list_(pa.struct([("start", _I64), ("stop", _I64)]))),
    ]
)


def contaminated(found: Column) -> Column:
    """At least one word in twenty was hit."""
    return (found["n_hit"] > 0) & (20 * found["n_hit"] >= found["n_words"])


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str:
    """The words of a text outside the spans, as they are counted, joined by blanks."""
    ws = words(text)
    for start, stop in reversed(spans):
        del ws[start:stop]
    return b" ".join(ws).decode()
