"""SentencePiece (merge type) encoding and decoding by backtracking.

The library merges neighbouring symbols, best score first.  The same ids come
from left to right: at each position the longest piece that an Aho-Corasick
pass found there is tried, then its ever shorter prefixes that are pieces too.
A piece may follow another only if the two are compatible, that is, if merging
the characters of both again gives these two pieces; a sequence whose
neighbours are all compatible is the one that merging the whole text gives.
Where nothing fits, the position is marked in a bitfield of failed positions
and the last piece is taken back.  A position fails once at most: the pieces
before it are the merge result of the text up to there, so they are always the
same.

Pieces that merging never makes of their own characters can't be in a result
and are left out.  Characters in no piece become their bytes and end a merge,
and so does the step from a letter to a blank mark, where no piece spans it;
texts are cut there, and the ids of short cuts are remembered.

Cases: a null or empty text has no ids and decodes to the empty text; a blank
text is encoded like any other; ids are arrays in text order; extra columns
are left to the caller's ``keep``.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from titleflow.llm.common import map_texts

BLANK = "▁"
CACHE_CUTS = 1 << 18
LONG_CUT = 64
PAIR_CACHE = 1 << 20

#: Field numbers and piece types of a model file.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, BYTE_FALLBACK = 3, 35
CHARSMAP, DUMMY_PREFIX, TRIM_BLANKS, ESCAPE_BLANKS = 2, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE_MODEL = 2
UNKNOWN_SURFACE = " ⁇ "


@dataclass
class Model:
    pieces: list[str]
    types: list[int]
    rank: dict[str, float]  # pieces that merging can make -> score
    ids: dict[str, int]  # pieces that encoding can use
    shorter: list[int]  # id -> id of the longest proper prefix that is a piece, or -1
    byte_ids: list[int]
    dummy_prefix: bool
    cuts: str  # pattern of the parts between which nothing merges
    surfaces: list[bytes] = field(default_factory=list)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if kind == 2 else ((8 if kind == 1 else 4), at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


def _score(raw: bytes) -> float:
    return memoryview(raw).cast("f")[0] if raw else 0.0


def load(path: str) -> Model:
    with open(path, "rb") as f:
        data = f.read()
    pieces: list[str] = []
    scores: list[float] = []
    types: list[int] = []
    options: dict[int, dict] = {TRAINER: {}, NORMALIZER: {}}
    for number, value in _fields(data):
        if number == PIECES:
            own = dict(_fields(value))
            pieces.append(own.get(1, b"").decode())
            scores.append(_score(own.get(2, b"")))
            types.append(own.get(3, NORMAL))
        elif number in options:
            options[number] = dict(_fields(value))
    trainer, normalizer = options[TRAINER], options[NORMALIZER]
    if trainer.get(MODEL_TYPE, 1) != BPE_MODEL or not trainer.get(BYTE_FALLBACK, 0) or BYTE not in types:
        raise ValueError("only merge-type models with byte fallback are supported")
    if normalizer.get(CHARSMAP) or normalizer.get(TRIM_BLANKS, 1) or not normalizer.get(ESCAPE_BLANKS, 1):
        raise ValueError("only models whose normaliser leaves characters and blanks as they are are supported")
    if USER_DEFINED in types or UNUSED in types:
        raise ValueError("user-defined and unused pieces are not supported")
    normal = {p: i for i, p in enumerate(pieces) if types[i] == NORMAL}
    rank = {p: scores[i] for p, i in normal.items()}
    if any(c not in rank for p in rank for c in p):
        raise ValueError("every character of a piece must be a piece")
    ids = {p: i for p, i in normal.items() if len(p) == 1 or merged(p, rank) == [p]}
    shorter = [-1] * len(pieces)
    for p, i in ids.items():
        shorter[i] = next((ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in ids), -1)
    byte_of = {int(p[3:5], 16): i for i, p in enumerate(pieces) if types[i] == BYTE}
    stray = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in rank and chr(c) != " ")
    spanning = any(a != BLANK and b == BLANK for p in rank for a, b in zip(p, p[1:]))
    cuts = f"[^{stray}]+|[{stray}]" if spanning else f"{BLANK}*[^{BLANK}{stray}]+|{BLANK}+|[{stray}]"
    if not stray:
        cuts = "(?s:.+)" if spanning else f"{BLANK}*[^{BLANK}]+|{BLANK}+"
    model = Model(pieces, types, rank, ids, shorter, [byte_of[b] for b in range(256)], bool(normalizer.get(DUMMY_PREFIX, 1)), cuts)
    model.surfaces = [_surface(model, i) for i in range(len(pieces))]
    return model


def _surface(model: Model, i: int) -> bytes:
    kind = model.types[i]
    if kind == BYTE:
        return bytes([int(model.pieces[i][3:5], 16)])
    if kind == CONTROL:
        return b""
    return (UNKNOWN_SURFACE if kind == UNKNOWN else model.pieces[i].replace(BLANK, " ")).encode()


def merged(text: str, rank: dict[str, float]) -> list[str]:
    """What merging makes of a short text: best score first, then leftmost."""
    parts = list(text)
    scores = [rank.get(a + b) for a, b in zip(parts, parts[1:])]
    while True:
        known = [s for s in scores if s is not None]
        if not known:
            return parts
        i = scores.index(max(known))
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del scores[i]
        if i:
            scores[i - 1] = rank.get(parts[i - 1] + parts[i])
        if i < len(scores):
            scores[i] = rank.get(parts[i] + parts[i + 1])


class Encoder:
    """Text to ids; one per worker process, so what it remembers serves later tasks."""

    def __init__(self, model: Model):
        self.model = model
        self.cuts = re.compile(model.cuts)
        self.matcher = ahocorasick.Automaton()
        for p, i in model.ids.items():
            self.matcher.add_word(p, i)
        self.matcher.make_automaton()
        self.size = [len(p) for p in model.pieces]
        self.fits: dict[int, bool] = {}
        self.known: dict[str, list[int]] = {}

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        fit = self.fits.get(key)
        if fit is None:
            if len(self.fits) > PAIR_CACHE:
                self.fits.clear()
            a, b = self.model.pieces[left], self.model.pieces[right]
            fit = self.fits[key] = merged(a + b, self.model.rank) == [a, b]
        return fit

    def longest(self, text: str) -> list[int]:
        """The id of the longest piece that starts at each position, or -1."""
        out, size = [-1] * len(text), self.size
        for end, i in self.matcher.iter(text):
            start = end + 1 - size[i]
            if out[start] < 0 or size[out[start]] < size[i]:
                out[start] = i
        return out

    def cut(self, text: str) -> list[int]:
        """The ids of a text by backtracking."""
        n, longest, size, shorter = len(text), self.longest(text), self.size, self.model.shorter
        failed = bytearray((n >> 3) + 1)
        out: list[int] = []
        tokens: list[int] = []  # since the last character without a piece
        pos = 0
        token = longest[0]
        while True:
            last = tokens[-1] if tokens else -1
            while token >= 0:
                end = pos + size[token]
                if not failed[end >> 3] >> (end & 7) & 1 and (last < 0 or self.compatible(last, token)):
                    break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                pos = end
            elif longest[pos] < 0:  # in no piece: its bytes, and nothing merges across it
                out += tokens
                out += [self.model.byte_ids[b] for b in text[pos].encode()]
                tokens = []
                pos += 1
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                token = tokens.pop()
                pos -= size[token]
                token = shorter[token]
                continue
            if pos == n:
                return out + tokens
            token = longest[pos]

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        known = self.known
        if len(known) > CACHE_CUTS:
            known.clear()
        prefix = BLANK if self.model.dummy_prefix else ""
        for part in self.cuts.findall(prefix + text.replace(" ", BLANK)):
            ids = known.get(part)
            if ids is None:
                ids = self.cut(part)
                if len(part) <= LONG_CUT:
                    known[part] = ids
            out += ids
        return out


def _lone_bytes(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("lone_bytes", _lone_bytes)


def decode(ids: list[int], model: Model) -> str:
    """Text of the ids; the blank that encoding put first goes, bytes that are no UTF-8 become replacement characters."""
    surfaces = model.surfaces
    out = b"".join([surfaces[i] for i in ids])
    if model.dummy_prefix:
        first = next((i for i in ids if model.types[i] != CONTROL), None)
        if first is not None and model.types[first] == NORMAL and model.pieces[first][0] == BLANK:
            out = out[1:]
    return out.decode("utf-8", "lone_bytes")


_ENCODERS: dict[int, Encoder] = {}


def _shared_encoder(model: Model) -> Encoder:
    if id(model) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[id(model)] = Encoder(model)
    return _ENCODERS[id(model)]


def encode_decode(docs: DataFrame, model_path: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep``, ``ids`` (array<int>) and ``decoded`` (the text of the ids)."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model_path))

    def make() -> Callable:
        model = shared.value
        encode = _shared_encoder(model).encode

        def fn(texts: list[bytes]):
            ids = [encode(t.decode()) for t in texts]
            return [pa.array(ids, pa.list_(pa.int32())), [decode(i, model) for i in ids]]

        return fn

    fields = [("ids", "array<int>", pa.list_(pa.int32())), ("decoded", "string", pa.string())]
    return map_texts(docs, text, keep, fields, make)
