"""Alignment of two tokenizers: links of overlapping tokens, counted by inverted bitmaps of each pair of ids."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventlake.llm._common import cut, in_arrow, pieces, release

BLOCK_BYTES, BLOCK_DOCS = 16 << 20, 1 << 15  # of a block of documents; a longer text is a block alone
PIECE_BYTES = 2 << 20  # texts that are tokenized together
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: byte-level pre-tokens

DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


# ---------------------------------------------------------------- the two tokenizers


class _Bytes:
    """Byte strings by index, laid end to end, so that a sequence of them is gathered at once."""

    def __init__(self, items: list[bytes]):
        self.body = np.frombuffer(b"".join(items), dtype=np.uint8)
        self.length = np.array([len(x) for x in items], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.length[ids]
        return self.body[np.repeat(self.start[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the rest from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE vocabulary file. Where its merges stand in the order of their ids, tiktoken encodes by ids as ranks."""

    def __init__(self, definition: str):
        model, byte = json.loads(definition)["model"], byte_alphabet()
        spelled = {t: bytes(byte[c] for c in t) for t in model["vocab"] if all(c in byte for c in t)}
        items = [b""] * (1 + max(model["vocab"].values()))
        for t, i in model["vocab"].items():
            items[i] = spelled.get(t, t.encode())
        self.bytes = _Bytes(items)
        self.library = Tokenizer.from_str(definition)
        self.library.encode_special_tokens = True
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = [model["vocab"].get(a + b) for a, b in merges]
        self.fast = None
        if made == sorted(set(made)) and made[0] >= 256:
            held = {items[i]: i for i in [*(model["vocab"][c] for c in byte), *made]}
            self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=held, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text).astype(np.int64)
            except BaseException as e:  # its pattern overflows on very long runs of white space
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.int64)


class Pieces:
    """A piece model file with byte fallback, which adds the space before a text itself."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        of, n = self.library, self.library.get_piece_size()
        self.bytes = _Bytes([bytes([int(of.id_to_piece(k)[3:5], 16)]) if of.is_byte(k) else of.id_to_piece(k).replace("▁", " ").encode() for k in range(n)])

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, dtype=np.int64) for x in self.library.encode(texts, num_threads=1)]


@lru_cache(maxsize=2)
def _tokenizers(definition: bytes, model: bytes) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(definition.decode()), Pieces(model)


# ---------------------------------------------------------------- alignment of a run of texts


def _spelled(table: _Bytes, ids: np.ndarray, first: np.ndarray, raw: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each text's tokens (ids from `first` to the next) join to its bytes (raw from `start` to the next)."""
    ends = np.concatenate([[0], np.cumsum(table.length[ids])])
    same = np.diff(ends[first]) == np.diff(start)
    keep = np.repeat(same, np.diff(first))
    byte = np.repeat(same, np.diff(start))
    wrong = np.zeros(len(raw) + 1, dtype=np.int64)
    at = np.flatnonzero(byte)
    wrong[at + 1] = table.joined(ids[keep]) != raw[at]
    wrong = np.cumsum(wrong)
    return same & (wrong[start[1:]] == wrong[start[:-1]])


class Aligned:
    """Token groups and links of a run of texts. Only texts that both tokenizers spell have tokens."""

    def __init__(self, texts: list[str | None], a: ByteLevel, b: Pieces, digits: _Bytes):
        held = [k for k, t in enumerate(texts) if t]
        spaced = [" " + texts[k] for k in held]
        bodies = [t.encode() for t in spaced]
        raw = np.frombuffer(b"".join(bodies), dtype=np.uint8)
        start = np.concatenate([[0], np.cumsum([len(x) for x in bodies])]).astype(np.int64)
        ids = [[a.encode(t) for t in spaced], b.encode_all([texts[k] for k in held])]
        firsts = [np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64) for each in ids]
        ids = [np.concatenate([np.zeros(0, np.int64), *each]) for each in ids]
        good = np.ones(len(held), dtype=bool)
        for table, i, f in zip((a.bytes, b.bytes), ids, firsts):
            good &= _spelled(table, i, f, raw, start)
        counts = [np.where(good, np.diff(f), 0) for f in firsts]
        ids = [i[np.repeat(good, np.diff(f))] for i, f in zip(ids, firsts)]
        n, at = len(texts), np.array(held, dtype=np.int64)[good]
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.zeros(n, dtype=np.int64) for _ in range(4))
        self.n_a[at], self.n_b[at] = counts[0][good], counts[1][good]
        self.sha = [""] * n
        doc = [np.repeat(at, c[good]) for c in counts]  # the text of each token
        length = [t.length[i] for t, i in zip((a.bytes, b.bytes), ids)]
        end = [np.cumsum(x) for x in length]  # both run over the same bytes
        self._groups(ids, doc, end, digits)
        first = np.searchsorted(end[1], end[0] - length[0], "right")
        last = np.searchsorted(end[1] - length[1], end[0], "left")
        links = last - first
        self.n_links += np.bincount(doc[0], weights=links, minlength=n).astype(np.int64)
        left = np.repeat(np.arange(len(links)), links)
        right = first[left] + np.arange(len(left)) - np.repeat(np.cumsum(links) - links, links)
        self.doc, self.a, self.b = doc[0][left], ids[0][left], ids[1][right]

    def _groups(self, ids: list, doc: list, end: list, digits: _Bytes) -> None:
        """Groups end where tokens of both end. The text `a1,a2|b1;a3|b2` of each document is laid out at once: a token's digits and a mark."""
        if not len(ids[0]):
            return
        common = end[0][np.isin(end[0], end[1], assume_unique=True)]
        group = [np.searchsorted(common, e, "left") for e in end]
        of_doc = doc[0][np.searchsorted(end[0], common)]
        self.n_groups += np.bincount(of_doc, minlength=len(self.n_groups))
        place = [np.arange(len(group[0])) + np.searchsorted(group[1], group[0], "left"), np.arange(len(group[1])) + np.searchsorted(group[0], group[1], "right")]
        line, mark, owner = (np.zeros(len(ids[0]) + len(ids[1]), dtype=np.int64) for _ in range(3))
        for k, closing in ((0, ord("|")), (1, ord(";"))):
            closes = np.append(group[k][1:] != group[k][:-1], True)
            line[place[k]], mark[place[k]], owner[place[k]] = ids[k], np.where(closes, closing, ord(",")), doc[k]
        text = digits.joined(line)  # each with a mark to be set
        stop = np.cumsum(digits.length[line])
        text[stop - 1] = mark
        view = memoryview(text)
        bound = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))
        begin = 0
        for d, to in zip(owner[bound].tolist(), stop[bound].tolist()):
            self.sha[d] = hashlib.sha256(view[begin : to - 1]).hexdigest()
            begin = to


# ---------------------------------------------------------------- inverted bitmaps of a block


def pack(pair: np.ndarray, doc: np.ndarray, pairs: int, docs: int) -> bytes:
    """The documents of each pair (both ascending): a bitmap where that is shorter, else 16-bit numbers of documents."""
    width = -(-docs // 8)
    n = np.bincount(pair, minlength=pairs)
    dense = 2 * n > width
    row = np.cumsum(dense) - 1
    inside = dense[pair]
    bits = np.zeros((int(dense.sum()), 8 * width), dtype=bool)
    bits[row[pair[inside]], doc[inside]] = True
    return n.astype("<u4").tobytes() + np.packbits(bits, axis=1).tobytes() + doc[~inside].astype("<u2").tobytes()


def unpack(packed: bytes, pairs: int, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(pair, doc) of each posting."""
    width = -(-docs // 8)
    n = np.frombuffer(packed, dtype="<u4", count=pairs).astype(np.int64)
    dense = 2 * n > width
    at, rows = 4 * pairs, int(dense.sum())
    bits = np.frombuffer(packed, dtype=np.uint8, offset=at, count=rows * width).reshape(rows, width)
    r, d = np.nonzero(np.unpackbits(bits, axis=1))
    few = np.frombuffer(packed, dtype="<u2", offset=at + rows * width).astype(np.int64)
    which = np.flatnonzero(~dense)
    return np.concatenate([np.flatnonzero(dense)[r], np.repeat(which, n[which])]), np.concatenate([d, few])


class Block:
    """Documents and the postings of their pairs: for each pair the bitmap of the documents that link it, and as
    further planes the binary digits of one less than its number of links in each."""

    def __init__(self):
        self.bytes, self.docs, self.parts, self.rows = 0, 0, [], []

    def add(self, ids: list, found: Aligned, base: int, size: int) -> None:
        key, links = np.unique((found.a * base + found.b) * BLOCK_DOCS + self.docs + found.doc, return_counts=True)
        self.parts.append((key, links))
        self.rows.append([ids, *(getattr(found, c) for c in COUNTS), found.sha])
        self.docs, self.bytes = self.docs + len(ids), self.bytes + size

    def closed(self, number: int, base: int) -> Iterator[pa.RecordBatch]:
        """A row (block, a, b, n) for each pair, n the documents that link it, and one row of the documents and planes."""
        key, links = (np.concatenate([p[k] for p in self.parts]) for k in (0, 1))
        order = np.argsort(key, kind="stable")
        key, more = key[order], links[order] - 1
        code, doc = key // BLOCK_DOCS, key % BLOCK_DOCS
        codes, pair, n = np.unique(code, return_inverse=True, return_counts=True)
        planes, k = [pack(pair, doc, len(codes), self.docs)], 0
        while (more >> k).any():
            on = (more >> k) & 1 == 1
            planes.append(pack(pair[on], doc[on], len(codes), self.docs))
            k += 1
        full = pa.nulls(len(codes), _STORED.field("docs").type), pa.nulls(len(codes), _STORED.field("planes").type)
        yield pa.record_batch([pa.array(np.full(len(codes), number)), codes // base, codes % base, n, *full], schema=_STORED)
        doc_id = [i for r in self.rows for i in r[0]]
        of = [np.concatenate([r[k] for r in self.rows]) for k in range(1, 5)]
        docs = pa.StructArray.from_arrays([pa.array(doc_id, pa.int64()), *map(pa.array, of), pa.array([h for r in self.rows for h in r[5]], pa.string())], names=_DOC.names)
        offsets = pa.array([0, len(docs)], pa.int32())
        none = pa.nulls(1, pa.int64())
        yield pa.record_batch([pa.array([number], pa.int64()), none, none, none, pa.ListArray.from_arrays(offsets, docs), pa.array([planes], pa.list_(pa.binary()))], schema=_STORED)


_DOC = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("groups_sha256", pa.string())])
_STORED = pa.schema([("block", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("docs", pa.list_(pa.struct(list(_DOC)))), ("planes", pa.list_(pa.binary()))])


def _blocks(shared):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _tokenizers(*shared.value)
        base = len(b.bytes.length)
        digits = _Bytes([b"%d " % k for k in range(max(base, len(a.bytes.length)))])
        number, block = TaskContext.get().partitionId() << 32, Block()
        for batch in batches:
            for part in pieces(batch, "text", PIECE_BYTES):
                size = part.column("text").nbytes
                if block.docs and (block.bytes + size > BLOCK_BYTES or block.docs + part.num_rows > BLOCK_DOCS):
                    yield from block.closed(number, base)
                    number, block = number + 1, Block()
                block.add(part.column("doc_id").to_pylist(), Aligned(part.column("text").to_pylist(), a, b, digits), base, size)
        if block.docs:
            yield from block.closed(number, base)

    return align


def _totals(doc: np.ndarray, count: np.ndarray, docs: int) -> np.ndarray:
    """Exact sums by document: doubles hold those of the low and the high halves."""
    low = np.bincount(doc, weights=count & 0x3FFFFFF, minlength=docs).astype(np.int64)
    return low + (np.bincount(doc, weights=count >> 26, minlength=docs).astype(np.int64) << 26)


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of one block with the scores that its postings return."""
    docs = left["docs"].combine_chunks().flatten()
    planes = left["planes"].combine_chunks().flatten().to_pylist()
    order = np.lexsort((right["b"].to_numpy(), right["a"].to_numpy()))
    count, best = right["count"].to_numpy()[order], right["best"].to_numpy()[order]
    n_best = total = np.zeros(len(docs), dtype=np.int64)
    for k, plane in enumerate(planes if len(order) else []):
        pair, doc = unpack(plane, len(order), len(docs))
        weight = 1 << max(0, k - 1)
        n_best = n_best + weight * np.bincount(doc[best[pair]], minlength=len(docs))
        total = total + weight * _totals(doc, count[pair], len(docs))
    fields = [docs.field(k) for k in range(len(_DOC))]
    return pa.table([*fields[:5], n_best, total, fields[5]], schema=pa.schema([*list(_DOC)[:5], ("n_best", pa.int64()), ("count_sum", pa.int64()), _DOC.field(5)]))


# ---------------------------------------------------------------- over the table


def blocks_of_links(docs: DataFrame, byte_level: str, piece_model: str, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """The written table of blocks: rows (block, a, b, n) of pairs and one row (block, docs, planes) a block."""
    with open(byte_level, "rb") as x, open(piece_model, "rb") as y:
        shared = docs.sparkSession.sparkContext.broadcast((x.read(), y.read()))
    rows = docs.select(F.col(id_).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = f"block long, a long, b long, n long, docs array<struct<{', '.join(':'.join(c.split()) for c in DOC.split(', '))}>>, planes array<binary>"
    return cut(in_arrow(rows, _blocks(shared), schema), "links")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, count, best): the documents that hold the pair linked, and whether no other pair of `a` has more.

    Blocks hold different documents, so the popcount of the OR of their bitmaps is the sum of theirs.
    """
    count = blocks.where("a is not null").groupBy("a", "b").agg(F.sum("n").alias("count"))
    return count.select("a", "b", "count", (F.col("count") == F.max("count").over(Window.partitionBy("a"))).alias("best"))


def aligned(docs: DataFrame, byte_level: str, piece_model: str, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """docs -> doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a byte-level BPE file (space + text), B a piece model (which adds the space). A text that is null or empty, or
    that the tokens of either do not spell byte for byte, has no tokens: zeros and ''. Groups are cut where
    tokens of both end; a link is a pair of occurrences whose bytes overlap; a pair of ids counts once in a document
    however often it is linked there. Each row is a document: rows that repeat an id or a text are counted one by
    one, a null id is kept. An empty table gives an empty one; other columns are ignored.

    A task turns its texts into blocks of bounded size. A block keeps its pairs inverted: for each the bitmap of its
    documents and the planes of their numbers of links. Only a row of three numbers a block and pair is shuffled to be
    counted; the counts go back to the blocks, whose postings return each document's scores. A pair that is in every document is a row a block.
    """
    blocks = blocks_of_links(docs, byte_level, piece_model, id_, text)
    pairs = blocks.where("a is not null").select(F.col("block").alias("of"), "a", "b").join(pair_counts(blocks), ["a", "b"])
    rows = blocks.where("a is null").select("block", "docs", "planes").groupBy("block").cogroup(pairs.groupBy("of"))
    out = rows.applyInArrow(_scored, DOC.replace(", groups", ", n_best long, count_sum long, groups"))
    found = cut(out, "aligned")
    release(blocks)
    return found
