"""SentencePiece encoding and decoding by weighted finite-state transduction.

The model file is compiled into three transducers. The normaliser writes white space as the space mark
and puts one before the text. The pieces are a prefix tree whose final states write a piece. Byte
fallback writes the UTF-8 bytes of a character that no piece holds. Composed with an input they give a
lattice of its positions, and the shortest path in the tropical semiring (minimum, plus) is the encoding.

Unigram models weigh an arc by the negative score of its piece. In BPE models a path is right if every
two pieces that follow each other are: if merging by score, undone from their border outwards, never
joins something across it. Such pairs have weight zero and all others infinity, so exactly one path is
finite. It is the one that merging gives, and its last piece is unique at every position, so that one
state per position is enough in both cases.

No piece holds a character other than the space mark before a space mark, or an unknown character, so
texts are cut there; the paths of the parts are found once per task and part, in a bounded cache.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_texts, narrow

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Piece types and model types of the file format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
CACHE, CACHED_LENGTH = 300_000, 64


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of an encoded protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, data[at:at + size]
        at += size


class Model:
    """Pieces and settings of a model file."""

    def __init__(self, data: bytes):
        self.pieces, self.scores, self.types = [], [], []
        trainer, normaliser = {}, {}
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                self.types.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normaliser = dict(fields(value))
        self.kind, self.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
        self.prefix, self.squeeze = bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1))
        if self.kind not in (UNIGRAM, BPE) or normaliser.get(2) or not normaliser.get(5, 1) or USER_DEFINED in self.types:
            raise ValueError("only unigram and BPE models with identity normalisation and no symbols of their own")


class Transducer:
    """A compiled model: :meth:`encode` and :meth:`decode` single texts."""

    def __init__(self, model: Model):
        self.model = model
        self.unknown = model.types.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t == BYTE}
        usable = {p: i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t in (NORMAL, UNUSED)}
        order = sorted(usable, key=lambda p: (-model.scores[usable[p]], usable[p]))
        self.rank = {p: r for r, p in enumerate(order)}
        self.split: dict[str, tuple[str, str]] = {}
        if model.kind == BPE:
            usable = {p: i for p, i in usable.items() if self._merges(p)}
        #: Prefix tree of the pieces: a node has its children by character, and at "" the id of the piece it ends.
        self.tree: dict = {}
        for p, i in usable.items():
            node = self.tree
            for c in p:
                node = node.setdefault(c, {})
            node[""] = i
        self.usable = usable
        known = {p for p in usable if len(p) == 1} - {MARK}
        inside = any(MARK in p.lstrip(MARK) for p in usable)
        own = "".join(map(re.escape, sorted(known)))
        # Parts: spaces and what follows up to the next, or single characters that no piece holds.
        self.parts = re.compile(f"[{own}{MARK}]+|[^{own}{MARK}]" if inside else f"{MARK}*[{own}]+|{MARK}+|[^{own}{MARK}]")
        # Where no piece holds a letter and then such a character, a part ends after the letters.
        after = {b for p in usable for a, b in zip(p, p[1:]) if a.isalpha()}
        signs = "".join(re.escape(c) for c in sorted(known - after) if not c.isalpha())
        letters = "".join(re.escape(c) for c in sorted(known) if c.isalpha())
        if not inside and signs and letters:
            self.parts = re.compile(f"{MARK}*[{letters}]+(?=[{signs}])|{self.parts.pattern}")
        self.cuts_words = not inside
        self.line_end = None if "\n" in "".join(usable) else self._fallback("\n")
        self.weights: dict[tuple[int, int], bool] = {}
        self.part_cache: dict[str, tuple[int, ...]] = {}
        self.word_cache: dict[str, tuple[int, ...]] = {}

    def _merges(self, piece: str) -> bool:
        """Whether merging the characters of a piece gives the piece; keeps its last merge."""
        parts = list(piece)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get(parts[i] + parts[i + 1], len(self.rank)))
            if parts[best] + parts[best + 1] not in self.rank:
                return False
            if len(parts) == 2:
                self.split[piece] = (parts[0], parts[1])
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return True

    def _follows(self, left: str, right: str) -> bool:
        """Whether merging keeps the border between two pieces."""
        rank, split = self.rank, self.split
        limit = len(rank)  # merges of a lower rank happen while both border pieces stand
        while True:
            if rank.get(left + right, limit) < limit:
                return False
            # Undo the later merge of the two border pieces; of equal ones the right one came later.
            a = rank[left] if left in split else -1
            b = rank[right] if right in split else -1
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, split[left][1]
            else:
                limit, right = b + 1, split[right][0]

    def _path(self, part: str) -> tuple[int, ...]:
        """Shortest path of one part."""
        if self.model.kind != BPE:
            return self._lightest_path(part)
        whole = self.usable.get(part)
        return self._finite_path(part) if whole is None else (whole,)

    def _arcs(self, part: str, i: int) -> list[tuple[int, int]]:
        """The pieces that begin at ``i``, as (end, id), short ones first."""
        node, out = self.tree, []
        for j in range(i, len(part)):
            node = node.get(part[j])
            if node is None:
                break
            found = node.get("")
            if found is not None:
                out.append((j + 1, found))
        return out

    def _finite_path(self, part: str) -> tuple[int, ...]:
        """Depth first and long pieces first: all finite paths weigh zero, so the first to arrive is shortest.

        A position is reached by one path at most, so one that leads nowhere is not tried again.
        """
        n, weights, pieces, dead = len(part), self.weights, self.model.pieces, set()
        at, last, path, waiting = 0, -1, [], []
        arcs = self._arcs(part, 0)
        while at < n:
            if not arcs:
                dead.add(at)
                at, last, arcs = waiting.pop()
                path.pop()
                continue
            end, found = arcs.pop()
            if end in dead:
                continue
            if last >= 0:
                pair = (last, found)
                fits = weights.get(pair)
                if fits is None:
                    if len(weights) >= CACHE:
                        weights.clear()
                    fits = weights[pair] = self._follows(pieces[last], pieces[found])
                if not fits:
                    continue
            waiting.append((at, last, arcs))
            path.append(found)
            at, last, arcs = end, found, self._arcs(part, end)
        return tuple(path)

    def _lightest_path(self, part: str) -> tuple[int, ...]:
        """Position by position, the lightest of the arcs that arrive."""
        best: list[tuple[float, int, int] | None] = [(0.0, 0, 0)] + [None] * len(part)
        for i in range(len(part)):
            for j, found in self._arcs(part, i):
                weight = best[i][0] - self.model.scores[found]
                if best[j] is None or weight < best[j][0]:
                    best[j] = weight, i, found
        out, at = [], len(part)
        while at:
            _, at, found = best[at]
            out.append(found)
        return tuple(reversed(out))

    def _fallback(self, char: str) -> tuple[int, ...]:
        return tuple(self.bytes[b] for b in char.encode()) if self.model.byte_fallback else (self.unknown,)

    def normalise(self, text: str) -> str:
        if self.model.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (MARK if self.model.prefix else "") + text.replace(" ", MARK)

    def _keep(self, cache: dict, key: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(key) <= CACHED_LENGTH:
            if len(cache) >= CACHE:
                cache.clear()
            cache[key] = ids
        return ids

    def _cut(self, text: str) -> list[int]:
        """Ids of normalised text, part by part."""
        out, cache = [], self.part_cache
        for part in self.parts.findall(text):
            ids = cache.get(part)
            if ids is None:
                ids = self._keep(cache, part, self._path(part) if part[0] in self.tree else self._fallback(part))
            out += ids
        return out

    def encode(self, text: str) -> list[int]:
        text = self.normalise(text)
        if not text or not self.cuts_words or MARK + MARK in text:
            return self._cut(text)
        # Words are looked up without their mark; line ends, if no piece holds them, are cut off first.
        out, cache = [], self.word_cache
        for n, line in enumerate(text.split("\n") if self.line_end else [text]):
            if n:
                out += self.line_end
            first, *words = line.split(MARK)
            if first:
                out += self._cut(first)
            for word in words:
                ids = cache.get(word)
                if ids is None:
                    ids = self._keep(cache, word, tuple(self._cut(MARK + word)))
                out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of piece ids; bytes that are not UTF-8 become replacement characters, control pieces nothing."""
        out, pending = [], bytearray()
        types, pieces = self.model.types, self.model.pieces
        for i in ids:
            if types[i] == BYTE:
                pending.append(int(pieces[i][3:5], 16))
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            if types[i] == UNKNOWN:
                out.append(" ⁇ ")
            elif types[i] != CONTROL:
                out.append(pieces[i])
        out.append(pending.decode("utf-8", "replace"))
        text = "".join(out).replace(MARK, " ")
        return text[1:] if self.model.prefix and text.startswith(" ") else text


def load(path: str = MODEL) -> Transducer:
    """Compile a model file that the driver can read."""
    with open(path, "rb") as file:
        return Transducer(Model(file.read()))


def encode(df: DataFrame, machine: Transducer) -> DataFrame:
    """``df`` with ``ids`` (array of int), ``n_ids`` and ``round_trip`` instead of ``text``.

    A null text is encoded as an empty one, to no ids. ``round_trip`` tells whether decoding the ids gives
    the text; it is false where the model itself loses something, as for a text with the space mark.
    """
    tables = vars(machine)
    df = df.withColumn("text", F.coalesce("text", F.lit("")))

    def work():
        own = Transducer.__new__(Transducer)
        own.__dict__.update(tables, part_cache={}, word_cache={}, weights={})

        def run(texts):
            ids = [own.encode(t) for t in texts]
            return [ids, [len(x) for x in ids], [own.decode(x) == t for x, t in zip(ids, texts)]]
        return run

    return map_texts(df, work, "ids array<int>, n_ids long, round_trip boolean", ["ids", "n_ids", "round_trip"],
                     [pa.list_(pa.int32()), pa.int64(), pa.bool_()])


def decode(df: DataFrame, machine: Transducer, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``text`` instead of the column of ids; null ids give a null text."""
    tables = vars(machine)

    def work():
        own = Transducer.__new__(Transducer)
        own.__dict__.update(tables)
        return lambda lists: [[None if x is None else own.decode(x) for x in lists]]

    return map_texts(df, work, "text string", ["text"], [pa.string()], ids_col)


def encode_documents(df: DataFrame, path: str = MODEL) -> DataFrame:
    """``doc_id, ids, n_ids, round_trip`` of every row; other columns are ignored."""
    return encode(narrow(df), load(path))
