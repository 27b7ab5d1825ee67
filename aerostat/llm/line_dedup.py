"""Line de-duplication by an exact set-similarity join, with DataFrame operations only.

A line is the set of its words. It goes if an earlier line of the corpus (by document id, then by
place) has a similar set: Jaccard similarity at or above the threshold. Lines of equal words in equal
order are combined before anything is joined, so copies cost one row each.

The join is the prefix filter with its positional and length filters. Words are ordered by rarity,
and two similar lines must share a word among the rarest few of each; how many follows from their
sizes. Word frequencies are counted over all distinct lines, in ``2 ** BUCKET_BITS`` hash buckets,
so the table that gives every word its rank has a fixed size whatever the vocabulary. Any order is
right; the rarer the prefixes, the fewer candidates. A 128-bit map of each set bounds the overlap
of a candidate pair from above, and the words themselves decide.

Until then a word travels as 32 bits of hash: 20 tell its bucket, the others tell words of a bucket
apart. Words that share a hash can only add candidates. Texts are read again for the words of
candidate lines alone, and a staged table is freed when its last reader is done.

Large groups of near copies are settled first: every line is checked against the earliest line of
its MinHash buckets. A line settled that way needs no other, so the join only looks for the earlier
lines of unsettled ones; pairs whose later line is settled are not made.

A place is a document and a line in one number. Where ids alone tell documents apart and take at most
33 bits it has 64 bits, which are sorted, hashed and written many times faster than 128.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType

from aerostat.llm.common import UPPER, fresh, whole
from aerostat.plans.lineage import materialise, materialise_numbers, release

THRESHOLD = 0.8
BUCKET_BITS = 20  # of the table of word frequencies
BUSY = 1000  # lines with a word from which on settled lines are kept apart
PASSES = 4  # of the join, by key: only the rows of one pass are on disk at a time
LEADERS = 2  # smallest and largest hashes of a line of which any two make a MinHash bucket
SENT = 500_000  # lines whose places may travel to all executors; more are joined by a shuffle
_WHITE = "\t\x0b\x0c\r"  # within a line, besides blanks
_HASH_BITS = 32 - BUCKET_BITS
_LINES = 1 << 31  # of a text at most


def _small(line: Column) -> Column:
    """The line with small letters for capital ASCII ones, and with blanks for white space."""
    # Translating costs many times what lower() does, and of ASCII gives the same.
    plain = reduce(Column.__and__, [~F.contains(line, F.lit(c)) for c in _WHITE], F.octet_length(line) == F.length(line))
    return F.when(plain, F.lower(line)).otherwise(F.translate(line, UPPER + _WHITE, UPPER.lower() + " " * len(_WHITE)))


def _words(small: Column) -> Column:
    return F.array_remove(F.split(small, " "), "")


def word_set(line: Column) -> Column:
    """The different words of a line."""
    return F.array_distinct(_words(_small(line)))


def _plain(docs: DataFrame, id_col: str) -> bool:
    """Whether ids alone tell documents apart and leave room for the line in 64 bits."""
    ids = docs.select(F.col(id_col).alias("id"))
    if not isinstance(ids.schema["id"].dataType, IntegralType):
        return False
    fits = F.coalesce(F.col("id").cast("long").between(-2 * _LINES, 2 * _LINES - 1), F.lit(False))
    return bool(ids.groupBy("id").count().agg(F.coalesce(F.bool_and(fits & (F.col("count") == 1)), F.lit(True))).first()[0])


def _short(df: DataFrame, place: str) -> bool:
    """Whether places have 64 bits. Then no two lines share one."""
    return isinstance(df.schema[place].dataType, LongType)


def _document(key: Column, text: Column, plain: bool = False) -> Column:
    """Order of documents as one number, with room for the lines: by id, those without an id last.

    Ids are whole numbers. A document is its id and its text: of those that share an id 31 bits of
    a hash of the text tell which is first, of those without an id 94 bits. Of ``plain`` ids no text
    is needed.
    """
    if plain:
        return key.cast("long") * F.lit(_LINES).cast("long")
    digest = F.xxhash64(text).bitwiseAND((1 << 63) - 1).cast("decimal(20,0)")
    top = F.coalesce(key.cast("decimal(20,0)"), digest + F.lit(str(10**19)).cast("decimal(20,0)")).cast("decimal(20,0)")
    low = F.hash(text).bitwiseAND(_LINES - 1).cast("decimal(10,0)")
    document = top * F.lit(_LINES).cast("decimal(10,0)") + low
    return (document.cast("decimal(30,0)") * F.lit(_LINES).cast("decimal(10,0)")).cast("decimal(38,0)")


def _ranks(lines: DataFrame) -> DataFrame:
    """One row: the rank of each bucket by how often its words occur, and the first busy rank."""
    n = 1 << BUCKET_BITS
    bucket = F.col("word").bitwiseAND(n - 1).cast("long")
    counts = lines.select(F.explode("hashes").alias("word")).groupBy(bucket.alias("bucket")).count()
    every = lines.sparkSession.range(n).withColumnRenamed("id", "bucket").join(counts, "bucket", "left")
    # Count and bucket, then bucket and rank, in one number each: those are sorted fast.
    row = F.shiftleft(F.coalesce("count", F.lit(0)), BUCKET_BITS) + F.col("bucket")
    ranked = every.agg(F.sort_array(F.collect_list(row)).alias("all"))  # of a fixed size
    pairs = F.sort_array(F.transform("all", lambda x, i: F.shiftleft(x.bitwiseAND(n - 1), BUCKET_BITS) + i))
    busy = F.size(F.filter("all", lambda x: F.shiftright(x, BUCKET_BITS) <= BUSY))
    return ranked.select(F.transform(pairs, lambda x: x.bitwiseAND(n - 1).cast("int")).alias("rank"), busy.alias("busy"))


def _fewest(size: Column, threshold: float) -> Column:
    """The smallest whole number at or above ``threshold * size``, safe against rounding."""
    return F.ceil(size * threshold - 1e-9)


def _signed(lines: DataFrame, ranks: DataFrame, first: DataFrame, threshold: float) -> DataFrame:
    """One line of each set, with the keys of its prefix, rarest first, size, map and MinHash buckets.

    A key is the bucket's rank followed by more bits of the word's hash. The keys of the prefix are
    cut to 31 bits, which can only add candidates, and a last bit that tells busy words.
    """
    # Scalar subqueries, evaluated once. Each is used in one place, so the optimizer puts it there;
    # used twice, the whole table would become a column and be copied into every row.
    alone = _short(lines, "at")
    by = ["at"] if alone else ["set", "at"]
    chosen = lines.join(first.withColumnRenamed("place", "at").select(*by), by, "left_semi")
    with_table = chosen.withColumns({"_table": ranks.select("rank").scalar(), "_busy": ranks.select("busy").scalar()})

    def key(h: Column) -> Column:
        # Never null, which Spark is told here, as it sorts such numbers many times faster.
        rank = F.coalesce(F.get("_table", h.bitwiseAND((1 << BUCKET_BITS) - 1)), F.lit(0))
        return F.shiftleft(rank.cast("long"), _HASH_BITS) + F.shiftrightunsigned(h, BUCKET_BITS)

    def bits(half: int) -> Column:
        return F.aggregate("hashes", F.lit(0).cast("long"), lambda a, h: a.bitwiseOR(_bit(h, half)))

    def short(k: Column) -> Column:
        return F.hash(k).bitwiseAND(-2).bitwiseOR((F.shiftright(k, _HASH_BITS) >= F.col("busy")).cast("int"))

    # Hashes are sorted: the first are the smallest, the last the largest.
    lows = [
        F.xxhash64(F.lit(end), *(F.get("hashes", F.lit(i) if end == 0 else F.size("hashes") - 1 - i) for i in two))
        for end in (0, 1)
        for two in combinations(range(LEADERS), 2)
    ]
    prefix = (F.col("size") - _fewest(F.col("size"), threshold) + 1).cast("int")
    signed = (
        with_table.select(
            "set",
            F.col("at").alias("place"),
            F.sort_array(F.transform("hashes", key)).alias("keys"),
            F.size("hashes").alias("size"),
            F.col("_busy").alias("busy"),
            F.array(*lows).alias("lows"),
            bits(0).alias("map0"),
            bits(1).alias("map1"),
        )
        .withColumn("keys", F.transform(F.slice("keys", 1, prefix), short))
        .drop("busy")
    )
    # Rows that repeat an id and its text have the same lines in the same places: one of each.
    return (signed if alone else signed.dropDuplicates(["set", "place"])).drop("set")


def _bit(h: Column, half: int) -> Column:
    """The last six bits of a hash tell the bit, the next one the half of the map that has it."""
    there = F.shiftright(h if half else F.bitwise_not(h), 6).bitwiseAND(1)
    return F.call_function("shiftleft", there.cast("long"), h)


def _packed(size: str, at: str, open_: str) -> Column:
    """Size, place of the word in the order, and openness in one number."""
    return F.shiftleft(F.col(size).cast("long"), 32) + F.shiftleft(F.col(at).cast("long"), 1) + F.col(open_).cast("long")


def _unpacked(pack: Column) -> tuple[Column, Column, Column]:
    return F.shiftright(pack, 32), F.shiftright(pack, 1).bitwiseAND((1 << 31) - 1), pack.bitwiseAND(1) == 1


def _may_match(a: str, b: str, sa: Column, sb: Column, threshold: float) -> Column:
    """Length filter, and the maps' bound on the overlap, between two aliased frames."""
    differ = sum(F.bit_count(F.col(f"{a}.map{i}").bitwiseXOR(F.col(f"{b}.map{i}"))) for i in (0, 1))
    long_enough = F.least(sa, sb) >= F.greatest(sa, sb) * threshold - 1e-9
    return long_enough & (differ * (1 + threshold) <= (sa + sb) * (1 - threshold) + 1e-9)


def _verified(pairs: DataFrame, contents: DataFrame, threshold: float, spent: Sequence[DataFrame] = ()) -> DataFrame:
    """The places of the later lines of pairs (``late``, ``early``) that are similar, staged.

    The ``spent`` tables are those that nothing but ``pairs`` reads any more.
    """
    pairs = materialise_numbers(pairs.distinct(), "line-pairs")
    release(*spent)
    some = pairs.select(F.col("late").alias("at")).unionByName(pairs.select(F.col("early").alias("at"))).distinct()
    some = materialise_numbers(some, "line-wanted")
    wanted = F.broadcast(some) if some.count() <= SENT else some
    # Rows that repeat an id and its text have the same lines in the same places: one of each.
    read = contents.join(wanted, "at", "left_semi")
    read = read if _short(read, "at") else read.dropDuplicates(["at"])
    words = materialise(read.select("at", word_set(F.col("content")).alias("words")), "line-words")
    late = words.select(F.col("at").alias("late"), F.col("words").alias("w"))
    early = words.select(F.col("at").alias("early"), F.col("words").alias("v"))
    common = F.size(F.array_intersect("w", "v"))
    similar = common >= (F.size("w") + F.size("v") - common) * threshold - 1e-9
    found = materialise_numbers(pairs.join(late, "late").join(early, "early").filter(similar).select("late").distinct(), "line-late")
    release(pairs, some, words)
    return found


def _led(signed: DataFrame, threshold: float) -> DataFrame:
    """Pairs of a line with the earliest line of one of its MinHash buckets."""
    rows = signed.select("place", F.explode("lows").alias("low"))
    leaders = rows.groupBy("low").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    pairs = rows.join(leaders, "low").filter("place > first").select("place", "first").distinct()
    short = signed.select("place", "size", "map0", "map1")
    met = pairs.join(short, "place").alias("x").join(short.alias("y"), F.col("x.first") == F.col("y.place"))
    return met.filter(_may_match("x", "y", F.col("x.size"), F.col("y.size"), threshold)).select(F.col("x.place").alias("late"), F.col("x.first").alias("early"))


def _prefixed(signed: DataFrame, settled: DataFrame, threshold: float) -> tuple[DataFrame, list[DataFrame]]:
    """Candidate pairs by prefix, positional and length filters; the later of a pair is unsettled.

    Joined rows carry a number that follows the order of places and has 64 bits. Frees ``signed``;
    also returns the staged tables that the pairs are read from.
    """
    alone = _short(signed, "place")
    marked = signed.drop("lows").join(settled.select(F.col("late").alias("place"), F.lit(False).alias("open")), "place", "left")
    marked = marked.withColumn("open", F.coalesce("open", F.lit(True)))
    # Grows along the sorted partitions; written at once, so it is given out only once.
    marked = marked.withColumnRenamed("place", "row") if alone else marked.sort("place").withColumn("row", F.monotonically_increasing_id())
    marked = materialise_numbers(marked, "line-marked")
    release(signed)

    def rows(length: Column, open_sides: tuple[int, int], settled_side: int, turn: int) -> DataFrame:
        cut = marked.select("row", "size", "map0", "map1", "open", F.posexplode(F.slice("keys", 1, length.cast("int"))).alias("at", "key"))
        cut = cut.filter(F.pmod(F.shiftright("key", 1), F.lit(PASSES)) == turn)
        # Under a busy word, settled and unsettled lines meet each other but not themselves.
        busy = F.col("key").bitwiseAND(1) == 1
        sides = F.when(~busy, F.array(F.lit(0))).when(F.col("open"), F.array(*map(F.lit, open_sides))).otherwise(F.array(F.lit(settled_side)))
        cut = cut.withColumn("side", F.explode(sides))
        return cut.select("row", "map0", "map1", F.hash("key", "side").alias("key"), _packed("size", "at", "open").alias("pack"))

    size = F.col("size")
    share = 2 * threshold / (1 + threshold)
    passes = []
    for turn in range(PASSES):
        # The shorter line of a pair needs fewer words; of equally long ones either needs no more.
        x = rows(size - _fewest(size, share) + 1, (0, 1), 2, turn).alias("x")
        y = rows(size - _fewest(size, threshold) + 1, (0, 2), 1, turn).alias("y")
        (sx, ax, ox), (sy, ay, oy) = _unpacked(F.col("x.pack")), _unpacked(F.col("y.pack"))
        need = F.ceil((sx + sy) * (threshold / (1 + threshold)) - 1e-9)
        both = (
            (F.col("x.key") == F.col("y.key"))
            & ((sx < sy) | ((sx == sy) & (F.col("x.row") < F.col("y.row"))))
            & (F.least(sx - ax, sy - ay) >= need)
            & _may_match("x", "y", sx, sy, threshold)
            & F.when(F.col("x.row") > F.col("y.row"), ox).otherwise(oy)
        )
        met = x.join(y, both).select(F.least("x.row", "y.row").alias("one"), F.greatest("x.row", "y.row").alias("two"))
        passes.append(materialise(met.distinct(), "line-met"))
    pairs = reduce(DataFrame.unionByName, passes).distinct()
    if alone:
        return pairs.select(F.col("two").alias("late"), F.col("one").alias("early")), [marked, *passes]
    places = marked.select("row", "place")
    one, two = (places.select(F.col("row").alias(n), F.col("place").alias(f"{n}_place")) for n in ("one", "two"))
    placed = pairs.join(one, "one").join(two, "two")
    placed = placed.select(F.greatest("one_place", "two_place").alias("late"), F.least("one_place", "two_place").alias("early"))
    return placed, [marked, *passes]


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, plain: bool | None = None
) -> DataFrame:
    """``document`` and line number (from 0) of every line that an earlier line repeats.

    ``document`` is the number that ``_document`` gives to id and text, those being ``plain`` or not;
    unless told, the ids are looked at. Lines end at each line feed.
    A line without words is never repeated. Rows that repeat an id and its text count as one
    document, so a copy of a row repeats nothing of it; different texts of one id, or without an
    id, are documents of their own. Lines of documents without an id come last. Null texts have one
    empty line.
    """
    if plain is None:
        plain = _plain(docs, id_col)
    docs = docs.select(F.col(id_col).alias("id"), whole(F.col(text_col)).alias("text"))
    docs = docs.select(_document(F.col("id"), F.col("text"), plain).alias("document"), "text")
    lines = docs.select("document", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    placed = F.col("document") + F.col("line") if plain else (F.col("document") + F.col("line").cast("decimal(10,0)")).cast("decimal(38,0)")
    # Asked of the line, as a condition on its words would split it twice. From the left only: the first other letter ends it.
    contents = lines.filter(F.ltrim("content", F.lit(" " + _WHITE)) != "").select(placed.alias("at"), "content")
    # A set is known by 128 bits of a hash of the line. Equal sets of lines that differ are similar as any others are.
    sets = contents.select("at", _small(F.col("content")).alias("small"))
    named = F.struct(F.xxhash64("small").alias("a"), F.xxhash64(F.lit(1), "small").alias("b"))
    # Numbers are sorted faster than words.
    hashes = F.sort_array(F.array_distinct(F.transform(_words(F.col("small")), lambda w: F.hash(w))))
    sets = sets.select("at", named.alias("set"), hashes.alias("hashes"))
    # Staged, as splitting texts into words costs most and several steps read them.
    lines = materialise_numbers(sets, "lines")
    first = lines.groupBy("set").agg(F.min("at").alias("place"), F.count(F.lit(1)).alias("n"))
    first = materialise_numbers(first, "line-sets")
    ranks = materialise_numbers(_ranks(lines), "line-ranks")
    signed = materialise_numbers(_signed(lines, ranks, first, threshold), "line-signed")
    places = materialise_numbers(lines.select("at", "set"), "line-places")
    release(lines, ranks)
    settled = _verified(_led(signed, threshold), contents, threshold)
    candidates, spent = _prefixed(signed, settled, threshold)
    late = settled.unionByName(_verified(candidates, contents, threshold, spent)).distinct()
    # Of a set that an earlier one repeats all lines go, of any other all but the first.
    marked = first.join(late.select(F.col("late").alias("place"), F.lit(True).alias("all")), "place", "left")
    marked = marked.withColumn("all", F.coalesce("all", F.lit(False))).filter("all OR n > 1").drop("n")
    found = places.join(marked, "set").filter(F.col("all") | (F.col("at") > F.col("place")))
    if plain:
        line = F.col("at").bitwiseAND(_LINES - 1)
        return found.select((F.col("at") - line).alias("document"), line.cast("int").alias("line"))
    line = F.pmod("at", F.lit(_LINES).cast("decimal(10,0)"))
    return found.select((F.col("at") - line).cast("decimal(38,0)").alias("document"), line.cast("int").alias("line"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents without repeated lines, with ``n_lines`` and the numbers of the ``removed``.

    All columns are kept; those called ``n_lines`` and ``removed`` are replaced. A text of which no
    line goes stays as it is, null too; one of which all go becomes empty. See ``repeated_lines``.
    """
    docs = docs.drop("n_lines", "removed")
    plain = _plain(docs, id_col)
    gone = repeated_lines(docs, id_col, text_col, threshold, plain).groupBy("document").agg(F.sort_array(F.collect_set("line")).alias("removed"))
    other = fresh(docs, "gone_from")
    gone = gone.withColumnRenamed("document", other)
    counted = docs.withColumn("n_lines", F.size(F.split(whole(F.col(text_col)), "\n")).cast("long"))
    # A column of its own: as a condition it would be told several times, and texts would be shuffled for it.
    counted = counted.withColumn(other, _document(F.col(id_col), whole(F.col(text_col)), plain))
    joined = counted.join(gone, other, "left").drop(other)
    kept = F.filter(F.split(whole(F.col(text_col)), "\n"), lambda _, i: ~F.array_contains("removed", i))
    cleaned = F.when(F.col("removed").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.withColumn(text_col, cleaned).withColumn("removed", removed)
