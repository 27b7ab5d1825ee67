"""Near-duplicate join on word shingles with Bayesian candidate pruning.

Texts are compared by the Jaccard similarity of their sets of five-word shingles. Texts with equal
sets count once. Candidates share a band of their MinHash values; of a candidate pair the values
are compared a slice at a time, and the pair is dropped as soon as the posterior probability that
its similarity reaches the threshold falls below a tolerance. What is left is verified exactly.

Pairs are never rows. Bands only say which texts hang together as candidates; every such component
is cut into blocks of bounded size, each pair of blocks is compared inside one task, and what
leaves a task is a link count per text and a spanning forest of the links. A component as large as
a third of the corpus is many block pairs, not one task, and no link between different texts is
lost but what banding misses (``1 - 0.99997`` at the threshold) and the tolerance allows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostat.llm.components import components
from aerostat.llm.decontamination import words
from aerostat.plans.lineage import materialise

WIDTH = 5  # words of a shingle
THRESHOLD = 0.8
BANDS = 26
ROWS = 5  # MinHash values of a band
TOLERANCE = 1e-4
BLOCK = 256  # texts of a block, about
_FEW = 2000  # pairs that are verified one by one
_COLUMNS = 8192  # shingles of a product at a time

_ODD = np.random.default_rng(7).integers(1, 2**63, (2, BANDS * ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = np.random.default_rng(8).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Ascending 64-bit fingerprints of a text's shingles; fewer words than a shingle are one."""
    ws = words(text)
    if not ws:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))
    n = min(width, len(each))
    total = np.zeros(len(each) - n + 1, np.uint64)
    for i in range(n):
        total = _mixed(total * _STEPS[i] + each[i : len(each) - n + 1 + i])
    return np.unique(total)


def signature(s: np.ndarray) -> np.ndarray:
    """MinHash values of a set of fingerprints."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(s), 4096):  # bounded memory for long texts
        values = s[start : start + 4096, None] * _ODD[0] + _ODD[1]
        low = np.minimum(low, values.min(0))
    return (low >> np.uint64(32)).astype(np.uint32)


def bands(sig: np.ndarray) -> np.ndarray:
    """One bucket key per band, for a matrix of signatures."""
    parts = sig.reshape(-1, BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(_STEPS[:BANDS], parts.shape[:2])
    for i in range(ROWS):
        out = _mixed(out * _STEPS[32 + i] + parts[:, :, i])
    return out


def fewest_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> np.ndarray:
    """By number of compared values: the fewest equal ones with which a pair is kept.

    The posterior of the similarity is Beta(equal + 1, unequal + 1), from a uniform prior.
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = np.zeros(BANDS * ROWS + 1, np.int64)
    for n in range(1, len(out)):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(grid) + (n - m) * np.log1p(-grid)
        weight = np.exp(log - log.max(1, keepdims=True))
        reach = weight[:, grid >= threshold].sum(1) / weight.sum(1)
        out[n] = int(np.argmax(reach >= tolerance))
    return out


def _summaries(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch["id"], batch["text"].to_pylist()
            for start in range(0, len(texts), 512):
                digests, keys = [], []
                for t in texts[start : start + 512]:
                    s = shingles(t, width)
                    digests.append(_digest(s))
                    keys.append(bands(signature(s)[None])[0].view(np.int64) if len(s) else None)
                yield pa.RecordBatch.from_pydict(
                    {"id": ids.slice(start, 512), "digest": pa.array(digests, pa.binary()), "bands": pa.array(keys, pa.list_(pa.int64()))}
                )

    return run


def _digest(s: np.ndarray) -> bytes | None:
    """Of a set of fingerprints; none of an empty one."""
    return blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _node(digest: str) -> Column:
    return F.xxhash64(digest)


def compare(left: pd.DataFrame, right: pd.DataFrame | None, threshold: float, fewest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs between two blocks, or inside one if ``right`` is none.

    The frames have ``sig`` and ``set`` as bytes.
    """
    if not len(left) or (right is not None and not len(right)):
        return np.empty(0, np.int64), np.empty(0, np.int64)

    def matrix(f: pd.DataFrame) -> np.ndarray:
        return np.frombuffer(b"".join(f["sig"]), np.uint32).reshape(len(f), -1)

    a = matrix(left)
    b = a if right is None else matrix(right)
    ka, kb = bands(a), bands(b)
    close = np.zeros((len(a), len(b)), bool)
    for i in range(BANDS):
        close |= ka[:, i, None] == kb[None, :, i]
    if right is None:
        close = np.triu(close, 1)
    p, q = np.nonzero(close)
    equal = np.zeros(len(p), np.int64)
    for n in range(0, a.shape[1], ROWS * 2):
        equal += (a[p, n : n + ROWS * 2] == b[q, n : n + ROWS * 2]).sum(1)
        keep = equal >= fewest[min(n + ROWS * 2, a.shape[1])]
        p, q, equal = p[keep], q[keep], equal[keep]
    if not len(p):
        return p, q
    own = [np.frombuffer(x, np.uint64) for x in left["set"]]
    other = own if right is None else [np.frombuffer(x, np.uint64) for x in right["set"]]
    if len(p) <= _FEW:
        common = np.array([len(np.intersect1d(own[i], other[j], assume_unique=True)) for i, j in zip(p, q)])
    else:
        common = _products(own, other)[p, q]
    sizes = np.array([len(own[i]) + len(other[j]) for i, j in zip(p, q)])
    keep = common >= threshold * (sizes - common) - 1e-9
    return p[keep], q[keep]


def _products(own: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of different sets, by products of incidence matrices, some shingles at a time."""
    every, n = np.unique(np.concatenate([*own, *([] if other is own else other)]), return_counts=True)
    every = every[n > 1]
    out = np.zeros((len(own), len(other)), np.int64)
    for start in range(0, len(every), _COLUMNS):
        part = every[start : start + _COLUMNS]

        def incidence(sets: list[np.ndarray]) -> np.ndarray:
            m = np.zeros((len(sets), len(part)), np.float32)
            for line, s in zip(m, sets):
                at = np.searchsorted(part, s)
                at[at == len(part)] = 0
                line[at[part[at] == s]] = 1
            return m

        a = incidence(own)
        out += (a @ (a if other is own else incidence(other)).T).astype(np.int64)
    return out


def _forest(p: np.ndarray, q: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Of the pairs, enough to connect what they connect."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, j in zip(p.tolist(), q.tolist()):
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    width: int = WIDTH,
    block: int = BLOCK,
) -> DataFrame:
    """Per document: ``copy_id``, ``n_copies``, ``n_links`` and ``class_id``.

    Documents with equal shingle sets are copies; ``copy_id`` is their smallest id and ``n_copies``
    their number. ``n_links`` counts the different sets whose similarity to the document's reaches
    the threshold, and ``class_id`` is the smallest id of all documents that links connect. Null,
    empty and wordless texts have no shingles: each is its own class, without copies or links. Rows
    that repeat an id count one by one; null ids are never the smallest. Other columns are not read.
    The bands are set for ``THRESHOLD``; a lower one, at which they would miss many pairs, raises.
    """
    if not threshold >= THRESHOLD:
        raise ValueError(f"the bands are set for thresholds from {THRESHOLD} on, not {threshold}")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    docs_seen = materialise(rows.mapInArrow(_summaries(width), f"id {kind}, digest binary, bands array<bigint>"), "near-docs")
    sets = docs_seen.filter("digest is not null").groupBy("digest").agg(
        F.min("id").alias("copy_id"), F.count(F.lit(1)).alias("n_copies"), F.first("bands").alias("bands")
    )
    sets = materialise(sets.withColumn("node", _node("digest")), "near-sets")
    keyed = sets.select("node", F.explode("bands").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    together = materialise(components(keyed.join(hubs, "key").select("node", "hub")), "near-together")
    links, edges = _compared(rows, sets, together, threshold, width, block)
    linked = components(edges).join(sets.select("node", "copy_id"), "node")
    lowest = linked.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    classes = linked.join(lowest, "root").select("node", "class_id")
    known = (
        sets.select("digest", "node", "copy_id", "n_copies")
        .join(links, "node", "left")
        .join(classes, "node", "left")
        .select("digest", "copy_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("class_id", "copy_id").alias("class_id"))
    )
    seen = docs_seen.select("id", "digest")
    out = seen.join(known, "digest").drop("digest")
    none = seen.filter("digest is null").select(
        "id", F.col("id").alias("copy_id"), F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("class_id")
    )
    return out.unionByName(none).withColumnRenamed("id", id_col)


def _compared(rows: DataFrame, sets: DataFrame, together: DataFrame, threshold: float, width: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Link counts per set, and edges that connect what links connect."""
    sizes = together.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    small = sizes.filter(F.col("size") <= block).agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    packs = -(-small // block) or 1
    # A small component goes to a pack with others, whose texts share no band with its own; a large
    # one is cut into blocks, and each of its texts meets every block.
    alone = F.col("size") > block
    blocks = F.when(alone, F.ceil(F.col("size") / block)).otherwise(1).cast("int")
    placed = (
        together.join(sizes, "root")
        .withColumn("unit", F.when(alone, F.col("root")).otherwise(F.pmod(F.xxhash64("root"), F.lit(packs))))
        .withColumn("alone", alone)
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks")).cast("int"))
        .select("node", "unit", "alone", "blocks", "own")
    )
    wanted = placed.join(sets.select("node", "digest", "copy_id"), "node").drop("node")
    some = wanted.select(F.col("copy_id").alias("want")).distinct()

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [_digest(shingles(t, width)) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"digest": pa.array(digests, pa.binary()), "text": batch["text"]})

    texts = rows.join(some, F.col("id").eqNullSafe(F.col("want")), "left_semi").select("text")
    texts = texts.mapInArrow(tagged, "digest binary, text string").groupBy("digest").agg(F.first("text").alias("text"))
    texts = texts.join(wanted.drop("copy_id"), "digest")

    def prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                each = [shingles(t, width) for t in part["text"].to_pylist()]
                out = {c: part[c] for c in ("digest", "unit", "alone", "blocks", "own")}
                out["sig"] = pa.array([signature(s).tobytes() for s in each], pa.binary())
                out["set"] = pa.array([s.tobytes() for s in each], pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    ready = texts.mapInArrow(prepared, "digest binary, unit bigint, alone boolean, blocks int, own int, sig binary, set binary")
    met = ready.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).drop("other", "blocks")
    fewest = fewest_matches(threshold)

    def linked(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("digest", ignore_index=True)
        _, _, i, j = key
        if i == j:
            p, q = compare(frame, None, threshold, fewest)
        else:
            left, right = (np.flatnonzero(frame["own"] == k) for k in (i, j))
            p, q = compare(frame.iloc[left], frame.iloc[right], threshold, fewest)
            p, q = left[p], right[q]
        n = np.bincount(np.concatenate([p, q]), minlength=len(frame))
        some = np.flatnonzero(n)
        forest = _forest(p, q, len(frame))
        digests = frame["digest"]
        return pd.DataFrame(
            {
                "digest": [digests[k] for k in some] + [digests[k] for k, _ in forest],
                "to": [None] * len(some) + [digests[k] for _, k in forest],
                "n_links": [*n[some].tolist(), *[0] * len(forest)],
            }
        )

    found = met.groupBy("unit", "alone", "i", "j").applyInPandas(linked, "digest binary, to binary, n_links bigint")
    found = materialise(found, "near-links")
    links = found.filter("to is null").groupBy(_node("digest").alias("node")).agg(F.sum("n_links").alias("n_links"))
    edges = found.filter("to is not null").select(_node("digest").alias("a"), _node("to").alias("b"))
    return links, edges
