"""SentencePiece encoding and decoding by shortest paths through a weighted transducer.

Three machines are compiled from a model: the normaliser (rewrites characters, marks blanks), the
lexicon (one path per piece, with the piece's id as output) and byte fallback (one path per
character that is no piece). Composed with an input they give a lattice of all its segmentations,
and its shortest path in the tropical semiring is the encoding:

* A unigram model weighs a piece by its negated log probability.
* A merge (BPE) model has no such weights. There a second acceptor is composed that allows
  ``u`` after ``t`` at cost 0 if merging the characters of ``tu`` ends in ``t u``, and forbids it
  (cost infinity) otherwise. A sequence whose neighbours all pass is what merging gives for the
  whole text, so exactly one path per prefix has a finite cost.

No piece holds a blank mark behind another character, so every path passes through the cut before
each run of marks: words are composed one by one. A worker remembers the words it has seen, from one task
to the next, and encodes and decodes in one place, so that each task needs one set of machines.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "▁"
REMEMBERED = 150_000  # words of a generation, of which there are two; as many pairs of pieces
LONG = 64  # longer words are not remembered
SHORT = 24  # words of at most so many characters are not cut into parts
_INF = float("inf")
_SHORT = (2, 1)


@dataclass
class Model:
    """What the machines are compiled from. Bounded by the vocabulary."""

    pieces: dict[str, tuple[int, float]]  # normal pieces: id and score
    bytes: dict[int, int]  # byte value to id
    unknown: int
    spelled: list[bytes]  # id to the bytes it decodes to
    merges: bool
    rules: dict[int, str] = field(default_factory=dict)  # code point to its normal form
    prefix: bool = True
    squeeze: bool = False
    name: str = ""  # tells models apart; machines of one without a name serve one task


def load(path: str) -> Model:
    """Read a model file on the driver; what executors need travels with the job."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids, spelled = {}, {}, []
    for i in range(sp.get_piece_size()):
        name = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            spelled.append(bytes([int(name[3:5], 16)]))
        elif sp.is_control(i):
            spelled.append(b"")
        elif sp.is_unknown(i):
            spelled.append(" ⁇ ".encode())
        else:
            if not sp.is_unused(i):
                pieces[name] = (i, sp.get_score(i))
            spelled.append(name.replace(MARK, " ").encode())
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("pieces that span words are not supported")
    prefix = sp.normalize("a").startswith(MARK)
    squeeze = MARK * 2 not in sp.normalize("a  b")
    characters = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and chr(c) not in (" ", MARK)]
    text = "".join(characters)
    rules = {}
    if sp.normalize(f"a{text}a").lstrip(MARK) != f"a{text}a":
        for c, out in zip(characters, sp.normalize([f"a{c}a" for c in characters])):
            out = out.lstrip(MARK)[1:-1]
            if out != c:
                rules[ord(c)] = out.replace(MARK, " ")
    with open(path, "rb") as f:
        name = hashlib.sha256(f.read()).hexdigest()
    return Model(pieces, byte_ids, sp.unk_id(), spelled, _merges(path), rules, prefix, squeeze, name)


def _merges(path: str) -> bool:
    """Whether the model file says that it was made by merging pairs."""
    found = {"kind": 1}
    with open(path, "rb") as f:
        for number, value in _fields(f.read()):
            if number == 2:  # settings of the training
                found.update({"kind": v for n, v in _fields(value) if n == 3})
    if found["kind"] not in (1, 2):
        raise ValueError("only unigram and merge models are supported")
    return found["kind"] == 2


def _fields(data: bytes):
    """Field numbers and values of a protocol buffer message."""
    i = 0

    def number() -> int:
        nonlocal i
        out = shift = 0
        while True:
            byte = data[i]
            i += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while i < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            n = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, data[i : i + n]
            i += n


class Coder:
    """The compiled machines, with what a task remembers."""

    def __init__(self, model: Model):
        self.model = model
        self.score = {piece: score for piece, (_, score) in model.pieces.items()}.get
        self.longest = max(map(len, model.pieces), default=1)
        # Pairs of characters that some piece holds: between others every path has a state.
        self.inner = {piece[i : i + 2] for piece in model.pieces for i in range(len(piece) - 1)}
        # Lengths of the arcs that may leave a state, longest first, by the next three characters.
        starts: dict[str, set[int]] = {}
        for piece in model.pieces:
            if len(piece) > 2:
                starts.setdefault(piece[:3], set()).add(len(piece))
        self.lengths = {start: (*sorted(n, reverse=True), *[2] * (start[:2] in model.pieces), 1) for start, n in starts.items()}
        self.id = {piece: i for piece, (i, _) in model.pieces.items()}
        self.piece = {i: piece for piece, i in self.id.items()}
        # Lengths of the arcs that may enter a state, longest first, by the last three characters.
        ends: dict[str, set[int]] = {}
        for piece in model.pieces:
            if len(piece) > 2:
                ends.setdefault(piece[-3:], set()).add(len(piece))
        self.ends = {end: (*sorted(n, reverse=True), *[2] * (end[-2:] in model.pieces), 1) for end, n in ends.items()}
        self.words = _Words(self)
        self.follows = lru_cache(REMEMBERED)(self._follows)
        self.chunk = self._chunks()

    def _chunks(self) -> re.Pattern[str]:
        """What splits a text into words: before marks, and between letters and other characters
        that no piece holds behind a letter, or before one. Unknown ones that meet must not be parted."""
        if not self.model.bytes:
            return re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        few = re.escape("".join(sorted({c for c in "".join(self.inner) if c.isalnum() and not c.isalpha()})))
        letter, other = rf"[^\W\d_{few}]", rf"[\W\d_{few}]"
        mixed = [(a, b) for a, b in self.inner if MARK != a and bool(re.match(letter, a)) != bool(re.match(letter, b))]

        def one_of(characters: set[str]) -> str:
            return "[" + re.escape("".join(sorted(characters))) + "]" if characters else "(?!)"

        behind = one_of({b for _, b in mixed if not re.match(letter, b)})
        before = one_of({a for a, _ in mixed if not re.match(letter, a)})
        return re.compile(
            f"{MARK}*{letter}+(?:{behind}[^{MARK}]*)?|{MARK}*(?:(?!{MARK}){other})+(?:(?<={before}){letter}[^{MARK}]*)?|{MARK}+"
        )

    def normal(self, text: str) -> str:
        """Compose with the normaliser."""
        if self.model.rules:
            text = text.translate(self.model.rules)
        if self.model.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return ((" " if self.model.prefix else "") + text).replace(" ", MARK)

    def merged(self, s: str) -> list[str]:
        """Merge the best-scored neighbours, leftmost first, until no two form a piece."""
        parts, score = list(s), self.score
        pairs = [score(a + b, -_INF) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) > -_INF:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], -_INF)
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], -_INF)
        return parts

    def _follows(self, t: str, u: str) -> bool:
        """The pair acceptor: may ``u`` follow ``t``? An empty ``t`` is the start."""
        return self.merged(t + u) == ([t, u] if t else [u])

    def path(self, word: str) -> list[str]:
        """Pieces along the shortest path through the lattice of a normalised word."""
        return self._free_path(word) if self.model.merges else self._cheapest_path(word)

    def _free_path(self, word: str) -> list[str]:
        """The one path of cost 0, searched depth first with the longest arcs tried first.

        A position is reached at cost 0 in one way only, so one that leads nowhere is never
        entered again, and the search is linear in the word.
        """
        pieces, follows, lengths, n = self.model.pieces, self.follows, self.lengths.get, len(word)
        dead: set[int] = set()
        out, left = [""], []
        at, arcs = 0, iter(lengths(word[:3], _SHORT))
        while at < n:
            for length in arcs:
                end = at + length
                if end <= n:
                    arc = word[at:end]
                    if (length == 1 or arc in pieces) and end not in dead and follows(out[-1], arc):
                        out.append(arc)
                        left.append(arcs)
                        at, arcs = end, iter(lengths(word[end : end + 3], _SHORT))
                        break
            else:
                dead.add(at)
                at -= len(out.pop())
                arcs = left.pop()
        return out[1:]

    def _cheapest_path(self, word: str) -> list[str]:
        """Viterbi over negated log probabilities; a character that is no piece costs more."""
        pieces, n = self.model.pieces, len(word)
        unknown = 10.0 - min((s for _, s in pieces.values()), default=0.0)
        cost = [0.0] + [_INF] * n
        last = [""] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                arc = word[start:end]
                found = pieces.get(arc)
                if found or end - start == 1:
                    total = cost[start] + (-found[1] if found else unknown)
                    if total < cost[end]:
                        cost[end], last[end] = total, arc
        out = []
        while n:
            out.append(last[n])
            n -= len(last[n])
        return out[::-1]

    def _longer(self, word: str) -> bytes | None:
        """Ids of a word that is a remembered one and one more arc, of cost 0."""
        id_, piece, known = self.id.get, self.piece.get, self.words.get
        for length in self.ends.get(word[-3:], _SHORT):
            ids = known(word[:-length])
            if ids:
                arc = word[-length:]
                found = id_(arc)
                last = piece(int.from_bytes(ids[-4:], "little"))
                if found is not None and last is not None and self.follows(last, arc):
                    return ids + found.to_bytes(4, "little")
        return None

    def ids(self, word: str) -> bytes:
        """Ids of a normalised word as 32-bit integers."""
        longer = self._longer(word) if self.model.merges else None
        if longer:
            return longer
        path = self.path(word)
        try:
            return array("i", map(self.id.__getitem__, path)).tobytes()
        except KeyError:  # some character is no piece
            out = []
        for piece in path:
            found = self.model.pieces.get(piece)
            if found:
                out.append(found[0])
            elif self.model.bytes:
                out.extend(self.model.bytes[b] for b in piece.encode())
            elif not out or out[-1] != self.model.unknown:  # unknown ones in a row are one
                out.append(self.model.unknown)
        return array("i", out).tobytes()

    def parts(self, word: str) -> list[str]:
        """The word cut between all neighbours that no piece holds together: after a word's last
        letter, say, or between any two characters that are spelled in bytes."""
        inner, n = self.inner, len(word)
        if n <= SHORT and self.model.bytes:
            return [word]
        cuts = [0, *[i for i in range(1, n) if word[i - 1 : i + 1] not in inner], n]
        return [word[i:j] for i, j in zip(cuts, cuts[1:])]

    def joined(self, parts: list[bytes]) -> bytes:
        """Ids of parts in a row; without bytes, unknown ones that meet are one."""
        if self.model.bytes:
            return b"".join(parts)
        ids = np.frombuffer(b"".join(parts), "<i4")
        again = (ids[1:] == self.model.unknown) & (ids[:-1] == self.model.unknown)
        return ids[np.concatenate([[True], ~again])].tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        normal = self.normal(text or "")
        return np.frombuffer(b"".join(map(self.words.__getitem__, self.chunk.findall(normal))), "<i4")

    def decode(self, ids: Sequence[int]) -> str:
        text = b"".join(map(self.model.spelled.__getitem__, ids)).decode(errors="replace")
        return text[1:] if self.model.prefix and text.startswith(" ") else text


class _Words(dict):
    """Ids by word. When full it becomes the older of two generations, so memory is bounded and
    frequent words stay."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder = coder
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            parts = self.coder.parts(word)
            ids = self.coder.joined([self[p] for p in parts]) if len(parts) > 1 else self.coder.ids(word)
        if len(word) <= LONG:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


def _lists(each: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(each) if each else np.empty(0, np.int32)
    ends = np.concatenate([[0], np.cumsum([len(a) for a in each])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


_compiled: dict[str, Coder] = {}


def _coder(model: Model) -> Coder:
    """The machines of a model: of the last one that has a name, those of the worker's earlier tasks."""
    if not model.name:
        return Coder(model)
    if model.name not in _compiled:
        _compiled.clear()
        _compiled[model.name] = Coder(model)
    return _compiled[model.name]


def encode(text: Column, model: Model) -> Column:
    """Ids of the whole text; null and empty texts have none."""
    made: list[Coder] = []

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(_coder(model))
        return _lists([made[0].encode(t) for t in texts.to_pylist()])

    return run.asNondeterministic()(text)  # so that its columns are not computed twice


def decode(ids: Column, model: Model) -> Column:
    """The text that ids spell; null for null.

    Gives back every encoded text but for what the model itself changes: its normaliser, and blank
    marks in the text, which come back as blanks. Bytes that are no UTF-8 become U+FFFD.
    """
    made: list[Coder] = []

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        if not made:
            made.append(_coder(model))
        flat = lists.flatten().to_numpy()
        out, at = [], 0
        for n in lists.value_lengths().to_pylist():
            out.append(None if n is None else made[0].decode(flat[at : at + n].tolist()))
            at += n or 0
        return pa.array(out, pa.string())

    return run.asNondeterministic()(ids)


def round_trip(text: Column, model: Model) -> Column:
    """``ids`` as ``encode`` gives them, and the text ``decoded`` from them as ``decode`` does, by one worker."""
    made: list[Coder] = []

    @F.arrow_udf("ids array<int>, decoded string")
    def run(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(_coder(model))
        ids = [made[0].encode(t) for t in texts.to_pylist()]
        decoded = [made[0].decode(each.tolist()) for each in ids]
        return pa.StructArray.from_arrays([_lists(ids), pa.array(decoded, pa.string())], ["ids", "decoded"])

    return run.asNondeterministic()(text)
