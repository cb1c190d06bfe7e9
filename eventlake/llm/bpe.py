"""Byte-level BPE in two tiers: a minimal perfect hash resolves whole pre-tokens of the vocabulary; the
others pop a heap of adjacent pairs, lowest rank and leftmost first, over linked bytes."""

from __future__ import annotations

import base64
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm._common import U64, in_arrow, mix, pieces, utf8

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
#: The code points of Unicode's White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: The endings that the pre-token pattern splits off after an apostrophe.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]
REMEMBERED = 300_000  # merged pre-tokens that a task remembers at once; older ones are merged again


@cache
def _classes() -> np.ndarray:
    kind = {"L": LETTER, "N": NUMBER}
    out = np.array([kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], dtype=np.uint8)
    out[WHITE_SPACE] = SPACE
    return out


def pre_token_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pre-tokens start among the code points of rows that begin at the sorted indices `first`.

    The same cuts as matching the byte-level pattern from left to right: runs of letters, numbers or
    other marks take one space before them; of white space before a word its last character stands
    alone unless it is that space; an apostrophe that begins a run takes a following ending.
    """
    n = len(points)
    if not n:
        return np.zeros(0, dtype=np.int64)
    kind = _classes()[points]
    row_start = np.zeros(n + 1, dtype=bool)
    row_start[first] = True
    row_start[n] = True
    start = row_start[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~row_start[1:n])
    start[last] = True
    start[last[points[last] == 32] + 1] = False
    mark = np.flatnonzero((points == 39) & start)
    left = np.searchsorted(np.append(first, n), mark, "right")
    end = np.append(first, n)[left]
    for ending in ENDINGS:
        fits = mark + len(ending) < end
        for k, c in enumerate(ending, 1):
            fits[fits] = points[mark[fits] + k] == ord(c)
        at = mark[fits]
        start[at + 1] = False
        after = at + len(ending) + 1
        start[after[after < n]] = True
        mark, end = mark[~fits], end[~fits]
    return np.flatnonzero(start)


def hashes(body: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the byte strings that begin at `start` and fill the body."""
    if not len(start):
        return np.zeros(0, dtype=U64)
    length = np.diff(np.append(start, len(body)))
    power = np.ones(int(length.max()), dtype=U64)
    power[1:] = U64(0x9E3779B97F4A7C15)
    power = np.cumprod(power, dtype=U64)
    at = np.arange(len(body)) - np.repeat(start, length)
    return mix(np.add.reduceat((body.astype(U64) + U64(1)) * power[at], start) ^ (length.astype(U64) * U64(0xD6E8FEB86659FD93)))


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: each level keeps the keys that are alone in
    their slot, the others go to the next; a key's value is the rank of its slot."""

    def __init__(self, keys: np.ndarray, load: float = 2.0):
        self.levels, self.base, ranked = [], [], []
        rest, total = keys, 0
        while len(rest):
            seed = mix(np.array([len(self.levels) + 1], dtype=U64))
            size = max(2, int(len(rest) * load))
            slot = (mix(rest ^ seed) % U64(size)).astype(np.int64)
            alone = np.bincount(slot, minlength=size) == 1
            self.levels.append((seed, size, alone, np.cumsum(alone) - 1 + total))
            mine = alone[slot]
            ranked.append((rest[mine], self.levels[-1][3][slot[mine]]))
            total += int(mine.sum())
            rest = rest[~mine]
        self.key = np.zeros(total, dtype=U64)
        for k, at in ranked:
            self.key[at] = k

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, -1 where it is not one of the set's."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for seed, size, alone, rank in self.levels:
            slot = (mix(keys[open_] ^ seed) % U64(size)).astype(np.int64)
            here = alone[slot]
            out[open_[here]] = rank[slot[here]]
            open_ = open_[~here]
        sure = np.flatnonzero(out >= 0)
        out[sure[self.key[out[sure]] != keys[sure]]] = -1
        return out


def _equal(a: np.ndarray, at: np.ndarray, length: np.ndarray, b: np.ndarray, bt: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Of each span of a whether it is the span of b beside it, byte for byte."""
    same = length == other
    n = np.where(same, length, 0)
    if n.sum():
        begin = np.cumsum(n) - n
        inside = np.arange(int(n.sum())) - np.repeat(begin, n)
        wrong = a[np.repeat(at, n) + inside] != b[np.repeat(bt, n) + inside]
        same[np.repeat(np.arange(len(n)), n)[wrong]] = False
    return same


class Vocabulary:
    """Token bytes by rank, with the two tiers of encoding."""

    def __init__(self, lines: bytes):
        pairs = [line.split() for line in lines.splitlines() if line]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.token[rank] = token
        tokens = list(self.rank)
        body = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        start = np.cumsum([0, *map(len, tokens[:-1])])
        keys = hashes(body, start)
        self.whole = PerfectHash(keys)
        self.whole_rank = np.zeros(len(keys), dtype=np.uint32)
        self.whole_rank[self.whole.find(keys)] = list(self.rank.values())
        self.whole_length = np.zeros(len(keys), dtype=np.int64)
        self.whole_length[self.whole.find(keys)] = [len(t) for t in tokens]
        self.whole_start = np.zeros(len(keys), dtype=np.int64)
        self.whole_start[self.whole.find(keys)] = start
        self.body = body
        self.merged: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> bytes:
        """The ids of one pre-token, as little-endian 32-bit integers: a heap of adjacent pairs over linked bytes."""
        get, n = self.rank.get, len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        pair = [get(piece[i : i + 2], -1) for i in range(n - 1)]
        pair.append(-1)
        heap = [r << 32 | i for i, r in enumerate(pair) if r >= 0]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            if pair[i] != top >> 32:
                continue  # one of its parts has been merged meanwhile
            j = after[i]
            k = after[i] = after[j]
            pair[j] = pair[i] = -1
            if k < n:
                before[k] = i
                r = pair[i] = get(piece[i : after[k]], -1)
                if r >= 0:
                    heappush(heap, r << 32 | i)
            h = before[i]
            if h >= 0:
                r = pair[h] = get(piece[h:k], -1)
                if r >= 0:
                    heappush(heap, r << 32 | h)
        out, i = array("I"), 0
        while i < n:
            k = after[i]
            out.append(get(piece[i:k]))
            i = k
        return out.tobytes()

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, and the offsets of the rows in them."""
        body, offsets = utf8(column)
        if not len(body):
            return np.zeros(0, dtype="<u4"), np.zeros(len(column) + 1, dtype=np.int64)
        points = np.frombuffer(body.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        byte_of = np.append(np.flatnonzero((body & 0xC0) != 0x80), len(body))
        first = np.unique(np.searchsorted(byte_of, offsets[:-1]))
        start = byte_of[pre_token_starts(points, first[first < len(points)])]
        end, text = np.append(start[1:], len(body)), body.tobytes()
        every = hashes(body, start)
        code, key = pd.factorize(every)
        sample = np.zeros(len(key), dtype=np.int64)
        sample[code[::-1]] = np.arange(len(code))[::-1]
        if not _equal(body, start, end - start, body, start[sample][code], (end - start)[sample][code]).all():  # two pre-tokens of one hash
            seen: dict[bytes, int] = {}
            code = np.array([seen.setdefault(text[a:b], len(seen)) for a, b in zip(start.tolist(), end.tolist())])
            sample = np.zeros(len(seen), dtype=np.int64)
            sample[code[::-1]] = np.arange(len(code))[::-1]
            key = every[sample]
        at = self.whole.find(key)
        held = np.flatnonzero(at >= 0)
        same = _equal(body, start[sample[held]], (end - start)[sample[held]], self.body, self.whole_start[at[held]], self.whole_length[at[held]])
        at[held[~same]] = -1
        known = at >= 0
        size = np.ones(len(key), dtype=np.int64)
        ids = np.zeros(len(key), dtype="<u4")
        ids[known] = self.whole_rank[at[known]]
        if len(self.merged) > REMEMBERED:
            self.merged.clear()
        merged, misses = self.merged, sample[~known]
        missed = [text[a:b] for a, b in zip(start[misses].tolist(), end[misses].tolist())]
        for piece in missed:
            if piece not in merged:
                merged[piece] = self.merge(piece)
        parts = [merged[piece] for piece in missed]
        size[~known] = [len(p) >> 2 for p in parts]
        flat = np.zeros(int(size.sum()), dtype="<u4")
        begin = np.cumsum(size) - size
        flat[begin[known]] = ids[known]
        loose = np.repeat(~known, size)
        flat[loose] = np.frombuffer(b"".join(parts), dtype="<u4")
        many = size[code]
        to = np.cumsum(many)
        out = flat[np.repeat(begin[code] - (to - many), many) + np.arange(int(to[-1]))]
        row = np.searchsorted(start, offsets)
        return out, np.append(0, to)[row]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@cache
def _vocabulary(lines: bytes) -> Vocabulary:
    return Vocabulary(lines)


def _binary(body: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body)]).cast(pa.binary())


def _encoder(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared.value)
        for batch in batches:
            for part in pieces(batch, "text"):
                ids, offsets = vocabulary.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("row"), _binary(ids.view(np.uint8), offsets * 4), pa.array(np.diff(offsets), pa.int64())], names=["row", "ids", "n_tokens"])

    return run


def _decoder(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared.value)
        for batch in batches:
            names = batch.schema.names
            decoded = pa.array([None if x is None else vocabulary.decode(x.as_buffer()) for x in (y if y.is_valid else None for y in batch.column("ids"))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], names=[*names, "decoded"])

    return run


def encoded(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs -> (row: all columns of docs, ids: little-endian unsigned 32-bit ids, n_tokens).

    `path` is a rank file (base64 token and rank a line); it is read on the driver and broadcast, so
    its size is bounded by the vocabulary. Null and empty texts have no ids. Texts are encoded whole
    and without special tokens; repeated rows and columns of any name pass through unchanged.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    held = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([held.schema["row"], T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]).simpleString()
    return in_arrow(held, _encoder(shared), schema[len("struct<") : -1])


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """Adds decoded, the bytes of the column ids; null ids decode to null, no ids to no bytes."""
    shared = tokens.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    schema = T.StructType([*tokens.schema.fields, T.StructField("decoded", T.BinaryType())]).simpleString()
    return in_arrow(tokens, _decoder(shared), schema[len("struct<") : -1])
