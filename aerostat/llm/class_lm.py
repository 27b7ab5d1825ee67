"""Language-model scores by a Brown class-based bigram model.

The probability of a word is that of its class after the previous word's class, times that of the
word in its class:  P(w | v) = P(class w | class v) * P(form w | class w) * P(w | form w).

*Forms* are what is clustered: the most frequent words of the corpus stand for themselves, and any
other word for its ending, so that every word, seen or not, has a class that any task can tell from
the word alone. The exchange algorithm moves one form at a time to the class that raises the
likelihood of the corpus' class bigrams most, until nothing moves.

Word and bigram counts cover the whole training corpus. What the driver holds is bounded by the
number of forms (``WORDS + ENDINGS``), not by the corpus. Counts of rare words stay in a table, and
documents' rare words are joined with it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostat.plans.lineage import materialise

WORDS = 700  # most frequent words that are forms of their own
ENDINGS = 323  # most frequent endings; the last form is any other ending
CLASSES = 48
ROUNDS = 12
COMMON = 150_000  # most frequent words whose counts travel with the job; the others are joined
HELD = 400_000  # distinct words a task counts before it passes the counts on
SMOOTH = 0.1  # added to every class bigram and every form
END = b"\n"  # stands for the end of a text: no word holds white space
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Words in UTF-8, A-Z in lower case, parted by ASCII white space; then the end."""
    out = (text or "").encode().translate(_LOWER).split()
    out.append(END)
    return out


def ending(word: bytes) -> bytes:
    """The last three bytes; a word no longer than that is told apart from a longer one's end."""
    return word[-3:] if len(word) > 3 else b" " + word


def _ending() -> Column:
    """``ending`` of the column ``word``."""
    return F.when(F.length("word") > 3, F.substring("word", -3, 3)).otherwise(F.concat(F.lit(b" "), F.col("word")))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(list(held.keys()), pa.binary()), "n": pa.array(list(held.values()), pa.int64())})

    for batch in batches:
        for text in batch["text"].to_pylist():
            held.update(tokens(text))
            if len(held) > HELD:
                yield out()
                held.clear()
    if held:
        yield out()


@dataclass
class Forms:
    """Form number by word and by ending. Bounded by ``WORDS + ENDINGS``."""

    words: dict[bytes, int]
    endings: dict[bytes, int]

    @property
    def other(self) -> int:
        return len(self.words) + len(self.endings)

    def of(self, words: list[bytes]) -> np.ndarray:
        get, tail, other = self.words.get, self.endings.get, self.other
        return np.array([i if (i := get(w, -1)) >= 0 else tail(ending(w), other) for w in words], np.int64)


def exchange(bigrams: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Classes of the forms by the exchange algorithm on their bigram counts.

    Maximises the sum of n log n over class bigrams less that over the classes as left and right
    neighbours. Forms start dealt by frequency; each in turn moves to the best class, ties to the
    lowest, until a round moves none.
    """
    v = len(bigrams)
    classes = max(1, min(classes, v))
    # Ends follow no text's words to the next text, so left and right counts differ.
    by_count = np.argsort(-(bigrams.sum(0) + bigrams.sum(1)), kind="stable")
    of = np.empty(v, np.int64)
    of[by_count] = np.minimum(np.arange(v), classes - 1) if v <= classes else np.arange(v) % classes

    def xlogx(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1e-300))

    member = np.zeros((v, classes))
    member[np.arange(v), of] = 1.0
    left = bigrams @ member  # of a form before each class
    right = (member.T @ bigrams).T  # of each class before a form
    table = member.T @ left
    for _ in range(rounds):
        moved = 0
        for w in by_count:
            a, out, into, own = of[w], left[w].copy(), right[w].copy(), bigrams[w, w]
            out[a] -= own  # the form's bigrams with the others, and with itself
            into[a] -= own
            table[a] -= out
            table[:, a] -= into
            table[a, a] -= own
            rows, cols = table.sum(1) + into, table.sum(0) + out
            # Gain of joining class c: its row takes ``out``, its column ``into``, its corner all.
            # The other rows' and columns' sums are the same whatever c is.
            gain = (xlogx(table + out) - xlogx(table)).sum(1) + (xlogx(table + into[:, None]) - xlogx(table)).sum(0)
            d = np.diag(table)
            gain += xlogx(d + out + into + own) - xlogx(d + out) - xlogx(d + into) + xlogx(d)
            gain -= xlogx(rows + out.sum() + own) - xlogx(rows) + xlogx(cols + into.sum() + own) - xlogx(cols)
            best = int(np.argmax(gain))
            if gain[best] <= gain[a] + 1e-9:
                best = a
            table[best] += out
            table[:, best] += into
            table[best, best] += own
            if best != a:
                moved += 1
                of[w] = best
                left[:, a] -= bigrams[:, w]
                left[:, best] += bigrams[:, w]
                right[:, a] -= bigrams[w]
                right[:, best] += bigrams[w]
        if not moved:
            break
    return of


@dataclass
class Model:
    """A fitted model. ``counts`` is a table of all training words; the rest is bounded."""

    counts: DataFrame  # word, n
    common: dict[bytes, int]
    everything: bool  # whether ``common`` holds all words
    forms: Forms
    classes: np.ndarray
    step: np.ndarray  # log10 P(class | class before), the last line for the start of a text
    emit: np.ndarray  # log10 P(form | class) of each form
    base: np.ndarray  # log10 of what a form's words share: its count, words and one unseen
    train_tokens: int
    vocabulary: int


def learn(train: DataFrame, text_col: str = "text", words: int = WORDS, endings: int = ENDINGS, classes: int = CLASSES) -> Model:
    """Fit on all texts of the frame; null counts as the empty text, which has one token, its end."""
    texts = train.select(F.col(text_col).alias("text"))
    counts = materialise(
        texts.mapInArrow(_counts, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "lm-words"
    )
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    common = _common(counts)
    own = {w: i for i, w in enumerate(list(common)[:words])}
    rest = counts.filter(~F.col("word").isin(list(own))) if own else counts
    ends = rest.groupBy(_ending().alias("e")).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "e").limit(endings).collect()
    forms = Forms(own, {bytes(r["e"]): len(own) + i for i, r in enumerate(ends)})
    size = forms.other + 1

    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(size * size, np.int64)
        starts = np.zeros(size, np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                f = forms.of(tokens(text))
                starts[f[0]] += 1
                np.add.at(cells, f[:-1] * size + f[1:], 1)
        at = np.flatnonzero(cells)
        first = np.flatnonzero(starts)
        yield pa.RecordBatch.from_pydict(
            {"a": np.concatenate([at // size, np.full(len(first), -1)]), "b": np.concatenate([at % size, first]), "n": np.concatenate([cells[at], starts[first]])}
        )

    # At most (size + 1) * size cells, however large the corpus.
    cells = texts.mapInArrow(bigrams, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    a, b, n = (cells[c].to_numpy() for c in ("a", "b", "n"))
    table = np.zeros((size + 1, size))
    table[a, b] = n  # line -1 is the last: the start of a text
    of = exchange(table[:-1], classes)
    k = int(of.max()) + 1
    member = np.zeros((size, k))
    member[np.arange(size), of] = 1.0
    pairs = np.vstack([member.T @ table[:-1], table[-1:]]) @ member
    freely = pairs.sum(0) + SMOOTH
    freely /= freely.sum()
    # Each line leans on how frequent the next class is at all.
    step = (pairs + 10 * freely) / (pairs.sum(1, keepdims=True) + 10)
    uses = table.sum(0)
    emit = (uses + SMOOTH) / (member.T @ (uses + SMOOTH))[of]
    return Model(counts, common, len(common) == total["v"], forms, of, np.log10(step), np.log10(emit), _shares(counts, forms), total["n"], total["v"])


def _common(counts: DataFrame) -> dict[bytes, int]:
    """The most frequent words, most frequent first: at most ``COMMON``, whatever the vocabulary.

    A histogram of the counts in classes of an eighth of an octave tells from which count on so
    many words are left, so no task gathers or orders candidates.
    """
    octave = F.floor(F.log2("n") * 8)
    room, low = COMMON, None
    for r in counts.groupBy(octave.alias("o")).count().orderBy(F.desc("o")).collect():
        room -= r["count"]
        if room < 0:
            break
        low = r["o"]
    if low is None:
        return {}
    top = counts.filter(octave >= low).toArrow()
    rows = zip(top["word"].to_pylist(), top["n"].to_pylist())
    return dict(sorted(rows, key=lambda r: (-r[1], r[0])))


def _shares(counts: DataFrame, forms: Forms) -> np.ndarray:
    """Log10 of the words of each form together: tokens, distinct words, and one unseen word."""
    own = forms.words
    out = np.zeros(forms.other + 1)
    rest = counts.filter(~F.col("word").isin(list(own))) if own else counts
    named = F.when(_ending().isin(list(forms.endings)), _ending()) if forms.endings else F.lit(None).cast("binary")
    for r in rest.groupBy(named.alias("e")).agg((F.sum("n") + F.count(F.lit(1))).alias("n")).collect():
        out[forms.endings[bytes(r["e"])] if r["e"] is not None else forms.other] = r["n"]
    out = np.log10(out + 1)
    out[: len(own)] = 0.0  # a frequent word is all its form has
    return out


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, tokens, known tokens, add-one unigram score, class-bigram score (log10).

    Null counts as the empty text. Rows are scored one by one, also those that repeat an id. An
    unseen word has the probability of one more word of its form. Perplexity is
    10 ** (-score / n_tokens).
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    forms, classes, step, emit, shares, common = model.forms, model.classes, model.step, model.emit, model.base, model.common
    everything, own = model.everything, len(model.forms.words)
    bottom = np.log10(model.train_tokens + model.vocabulary + 1)
    start = len(step) - 1

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = common.get
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("n_tokens", "known", "base", "score", "rest")}
            for text in batch["text"].to_pylist():
                ws = tokens(text)
                f = forms.of(ws)
                c = classes[f]
                n = np.array([get(w, 0) for w in ws], np.int64)
                seen = n > 0
                total = step[np.concatenate([[start], c[:-1]]), c].sum() + emit[f].sum() - shares[f].sum()
                logs = np.log10(n + 1.0)
                total += logs[f >= own].sum()
                rare = [] if everything else [ws[i] for i in np.flatnonzero(~seen)]
                for name, x in zip(out, (len(ws), int(seen.sum()), logs.sum() - len(ws) * bottom, total, rare)):
                    out[name].append(x)
            yield pa.RecordBatch.from_pydict({"id": batch["id"], **{k: pa.array(v, None if k != "rest" else pa.list_(pa.binary())) for k, v in out.items()}}) if batch.num_rows else batch

    kind = dict(rows.dtypes)["id"]
    scored = rows.mapInArrow(local, f"id {kind}, n_tokens bigint, known bigint, base double, score double, rest array<binary>")
    if not everything:
        scored = _with_rare(scored, model)
    return scored.select(
        F.col("id").alias(id_col), "n_tokens", F.col("known").alias("n_known"), F.col("base").alias("base_score"), "score"
    )


def _with_rare(scored: DataFrame, model: Model) -> DataFrame:
    """Add what the rare words of each document contribute, from the table of all words.

    The documents are staged with their rare words, so a row is known by its file and place. Words
    missing from the table are unseen and contribute nothing more.
    """
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    staged = materialise(scored, "lm-rare").select("*", part.alias("part"), F.col("_metadata.row_index").alias("place"))
    rare = staged.select("part", "place", F.explode("rest").alias("word"))
    found = (
        rare.join(model.counts, "word")
        .groupBy("part", "place")
        .agg(F.count(F.lit(1)).alias("k"), F.sum(F.log10(F.col("n") + 1)).alias("more"))
    )
    both = staged.drop("rest").join(found, ["part", "place"], "left")
    k, more = F.coalesce("k", F.lit(0)), F.coalesce("more", F.lit(0.0))
    return both.select("id", "n_tokens", (F.col("known") + k).alias("known"), (F.col("base") + more).alias("base"), (F.col("score") + more).alias("score"))
