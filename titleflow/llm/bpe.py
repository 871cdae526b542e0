"""Byte-level BPE encoding and decoding with a contiguous rank array.

A word is held as its part boundaries together with the rank of each pair of
neighbouring parts.  The array is scanned for the least rank, the boundary
between that pair is deleted and the ranks on either side are looked up
again, until no pair has a rank.  That is quadratic, hence for short words
only; words over ``LONG_WORD`` bytes take the same merges from a heap.

``load`` reads a ``tokenizer.json`` (byte-level BPE) on the driver; its
tables (tens of thousands of entries, fixed by the file) are broadcast.  Added
tokens such as ``<|endoftext|>`` are recognised in a text, as the tokenizers
library does.

Cases: a null or empty text has no ids and decodes to the empty text; ids are
arrays in text order; extra columns are left to the caller's ``keep``.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from titleflow.llm.common import map_texts

#: Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
LONG_WORD = 256
CACHE_WORDS = 1 << 18
NO_RANK = 1 << 62


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Tokenizer:
    byte_ids: list[int]  # id of each single byte
    pairs: dict[int, tuple[int, int]]  # left id << 32 | right id -> (rank, merged id)
    pieces: dict[int, bytes]  # id -> bytes
    added: dict[str, int]  # recognised in texts as they stand


def load(path: str) -> Tokenizer:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    stand_in = byte_alphabet()
    vocab: dict[str, int] = spec["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    pairs = {vocab[a] << 32 | vocab[b]: (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
    pieces = {i: bytes(stand_in[c] for c in token) for token, i in vocab.items()}
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    pieces |= {i: content.encode() for content, i in added.items()}
    byte_ids = [vocab[c] for c, _ in sorted(stand_in.items(), key=lambda x: x[1])]
    return Tokenizer(byte_ids, pairs, pieces, added)


def merge_word(word: bytes, tok: Tokenizer) -> list[int]:
    """The ids of one word, from the contiguous rank array."""
    ids = [tok.byte_ids[b] for b in word]
    if len(ids) < 2:
        return ids
    if len(ids) > LONG_WORD:
        return _merge_long(ids, tok)
    pairs = tok.pairs
    none = (NO_RANK, -1)
    ranks = [pairs.get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
    while ranks:
        least = min(ranks)
        if least is none:
            break
        i = ranks.index(least)
        ids[i : i + 2] = [least[1]]  # the boundary between the two parts goes
        del ranks[i]
        if i:
            ranks[i - 1] = pairs.get(ids[i - 1] << 32 | ids[i], none)
        if i < len(ranks):
            ranks[i] = pairs.get(ids[i] << 32 | ids[i + 1], none)
    return ids


def _merge_long(ids: list[int], tok: Tokenizer) -> list[int]:
    """The same merges, least rank and then leftmost first, in n log n."""
    pairs, n = tok.pairs, len(ids)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n and (hit := pairs.get(ids[i] << 32 | ids[after[i]])):
            heapq.heappush(heap, (hit[0], i, ids[i], ids[after[i]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or ids[i] != left or ids[j] != right:
            continue
        ids[i], alive[j], after[i] = pairs[left << 32 | right][1], False, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [t for t, a in zip(ids, alive) if a]


def encoder(tok: Tokenizer) -> Callable[[str], list[int]]:
    """A function from text to ids that remembers up to ``CACHE_WORDS`` words."""
    words = regex.compile(PATTERN)
    split = regex.compile("(" + "|".join(map(regex.escape, sorted(tok.added, key=len, reverse=True))) + ")") if tok.added else None
    cache: dict[str, list[int]] = {}

    def encode(text: str) -> list[int]:
        out: list[int] = []
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for k, part in enumerate(split.split(text) if split else [text]):
            if k % 2:
                out.append(tok.added[part])
                continue
            for w in words.findall(part):
                ids = cache.get(w)
                if ids is None:
                    ids = merge_word(w.encode(), tok)
                    if len(w) <= LONG_WORD:
                        cache[w] = ids
                out += ids
        return out

    return encode


def decode(ids: list[int], tok: Tokenizer) -> str:
    """Text of the ids; bytes that are no UTF-8 become the replacement character."""
    pieces = tok.pieces
    return b"".join([pieces[i] for i in ids]).decode("utf-8", "replace")


def encode_decode(docs: DataFrame, tokenizer_path: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep``, ``ids`` (array<int>) and ``decoded`` (the text of the ids)."""
    tables = docs.sparkSession.sparkContext.broadcast(load(tokenizer_path))

    def make():
        tok = tables.value
        encode = _shared_encoder(tok)

        def fn(texts: list[bytes]):
            ids = [encode(t.decode()) for t in texts]
            return [pa.array(ids, pa.list_(pa.int32())), [decode(i, tok) for i in ids]]

        return fn

    fields = [("ids", "array<int>", pa.list_(pa.int32())), ("decoded", "string", pa.string())]
    return map_texts(docs, text, keep, fields, make)


_ENCODERS: dict[int, Callable[[str], list[int]]] = {}


def _shared_encoder(tok: Tokenizer) -> Callable[[str], list[int]]:
    """One encoder per worker process, so its word cache serves later tasks too."""
    if id(tok) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[id(tok)] = encoder(tok)
    return _ENCODERS[id(tok)]
