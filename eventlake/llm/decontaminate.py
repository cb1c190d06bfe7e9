"""Benchmark decontamination by suffix arrays over shards of the corpus.

A shard is a run of a partition's documents. Its suffix array holds the word suffixes, in the order
of their first 13 words, that can begin a benchmark window at all (their first words occur at the
same place of some window). Every test suffix is binary-searched in it by its window; the range found
is the list of its verbatim locations. Windows that follow each other at locations that follow each other
are one match, so the longest verbatim match of a document with an item, and where it stands in both,
is the longest such run. The benchmark is the query set: it goes to the executors in blocks of a checked
size. No rows are shuffled, but for the hits where there is more than one block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm._common import ALNUM, U64, Words, cut, in_arrow, pieces

WINDOW = 13
BLOCK_BYTES = 8 << 20  # benchmark text that is broadcast at once
SHARD_BYTES = 4 << 20  # document text under one suffix array
LEADING = 4  # words of a suffix that are looked at before it is sorted
_KEY = f"S{8 * WINDOW}"
_TABLE = 20  # bits of the tables of leading words

HITS = "n_words bigint, n_hit bigint, item_ids array<string>, spans array<struct<start:bigint,n_words:bigint>>, matches array<struct<item_id:string,n_words:bigint,start:bigint,item_start:bigint>>"


class TestSuffixes:
    """Distinct windows of some benchmark items, as sorted keys, and the items of each."""

    __test__ = False

    def __init__(self, ids: list[str], texts: list[str]):
        words = Words(pa.array(texts, pa.string()), ALNUM)
        rows, items, lengths = [], [], []
        for k in range(len(texts)):
            own = words.hash[words.first[k] : words.first[k + 1]]
            if len(own):
                width = min(WINDOW, len(own))
                block = np.zeros((len(own) - width + 1, WINDOW), dtype=U64)
                block[:, :width] = np.lib.stride_tricks.sliding_window_view(own, width)
                rows.append(block)
                items.append(np.full(len(block), k))
                lengths.append(np.full(len(block), width))
        self.ids = np.array(ids, dtype=object)
        grid = np.concatenate(rows) if rows else np.zeros((0, WINDOW), dtype=U64)
        length = np.concatenate(lengths) if rows else np.zeros(0, dtype=np.int64)
        keys, self.key_of = np.unique(_keys(grid), return_inverse=True)
        sequence = self.key_of
        self.item_of = np.concatenate(items) if rows else np.zeros(0, dtype=np.int64)
        pairs = np.unique(self.key_of * max(1, len(ids)) + self.item_of)
        self.key_of, self.item_of = pairs // max(1, len(ids)), pairs % max(1, len(ids))
        self.from_key = np.searchsorted(self.key_of, np.arange(len(keys) + 1))
        self.keys, self.length = keys, np.zeros(len(keys), dtype=np.int64)
        self.windows = np.split(sequence, np.cumsum([len(r) for r in rows])[:-1]) if rows else []  # of each item with words, its keys in order
        self.item_with_words = [int(k[0]) for k in items]
        if rows:
            self.length[np.searchsorted(keys, _keys(grid))] = length
        self.after = self._upper(keys, self.length)
        shortest = int(length.min()) if rows else 0
        self.leading = []
        for k in range(min(LEADING, shortest)):
            seen = np.zeros(1 << _TABLE, dtype=bool)
            seen[grid[:, k] >> U64(64 - _TABLE)] = True
            self.leading.append(seen)

    @staticmethod
    def _upper(keys: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The last key that each window is a prefix of."""
        raw = np.frombuffer(keys.tobytes(), dtype=np.uint8).reshape(len(keys), 8 * WINDOW).copy()
        raw[np.arange(8 * WINDOW)[None, :] >= 8 * length[:, None]] = 255
        return raw.view(_KEY).ravel()

    def _longest(self, words: Words, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> dict[int, list[tuple[int, int, int, int]]]:
        """Of each row its longest match with each item: (item, words, start in the row, start in the item).

        The locations of an item's windows are taken in the order of the item. A location that follows one
        of the window before is the same match, one word longer.
        """
        out: dict[int, list[tuple[int, int, int, int]]] = {}
        for item, keys in zip(self.item_with_words, self.windows):
            best: dict[int, tuple[int, int, int]] = {}
            before, run = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            last = -2
            for q in np.flatnonzero(high[keys] > low[keys]):
                here = np.sort(at[low[keys[q]] : high[keys[q]]])
                length = np.ones(len(here), dtype=np.int64)
                if q == last + 1:
                    k = np.minimum(np.searchsorted(before, here - 1), len(before) - 1)
                    length += np.where((before[k] == here - 1) & (words.row[here] == words.row[here - 1]), run[k], 0)
                rows = words.row[here]
                order = np.lexsort((here, -length, rows))
                first = order[np.concatenate([[True], rows[order][1:] != rows[order][:-1]])]
                for row, n, place in zip(rows[first].tolist(), length[first].tolist(), here[first].tolist()):
                    if n > best.get(row, (0, 0, 0))[0]:
                        best[row] = (n, place - n + 1, int(q) - n + 1)
                before, run, last = here, length, q
            for row, (n, place, start) in best.items():
                out.setdefault(row, []).append((item, n + int(self.length[keys[0]]) - 1, place - int(words.first[row]), start))
        return out

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, list[tuple[int, int, int, int]]]]:
        """(hit mask over the words, 0/1; rows and items of occurring windows, each pair once; longest matches)."""
        n = len(words.hash)
        empty = np.zeros(0, dtype=np.int64)
        if not n or not len(self.keys):
            return np.zeros(n, dtype=bool), empty, empty, {}
        at = np.arange(n)
        for k, seen in enumerate(self.leading):
            at = at[at + k < n]
            at = at[seen[words.hash[at + k] >> U64(64 - _TABLE)]]
        if not len(at):
            return np.zeros(n, dtype=bool), empty, empty, {}
        end = words.first[words.row[at] + 1]
        grid = np.zeros((len(at), WINDOW), dtype=U64)
        for k in range(WINDOW):
            inside = at + k < end
            grid[inside, k] = words.hash[at[inside] + k]
        keys = _keys(grid)
        order = np.argsort(keys, kind="stable")  # the suffix array
        keys, at = keys[order], at[order]
        low, high = np.searchsorted(keys, self.keys, "left"), np.searchsorted(keys, self.after, "right")
        found = np.flatnonzero(high > low)
        count = (high - low)[found]
        place = at[np.repeat(low[found] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())] if len(found) else empty
        key = np.repeat(found, count)
        edge = np.zeros(n + 1, dtype=np.int64)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + self.length[key], -1)
        pairs = np.unique(words.row[place] * len(self.keys) + key) if len(place) else empty
        row, key = pairs // len(self.keys), pairs % len(self.keys)
        many = self.from_key[key + 1] - self.from_key[key]
        row = np.repeat(row, many)
        item = self.item_of[np.repeat(self.from_key[key] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())] if len(key) else empty
        pairs = np.unique(row * len(self.ids) + item) if len(row) else empty
        return np.cumsum(edge[:-1]) > 0, pairs // max(1, len(self.ids)), pairs % max(1, len(self.ids)), self._longest(words, at, low, high) if len(found) else {}


def _keys(grid: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(grid.astype(">u8")).view(_KEY).ravel()


def _searcher(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestSuffixes(*shared.value)
        for batch in batches:
            for part in pieces(batch, "text", SHARD_BYTES):
                words = Words(part.column("text"), ALNUM)
                hit, rows, items, longest = tests.search(words)
                n_words, n_hit, ids, spans, matches = [], [], [], [], []
                from_row = np.searchsorted(rows, np.arange(part.num_rows + 1))
                for k in range(part.num_rows):
                    own = hit[words.first[k] : words.first[k + 1]]
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                    n_words.append(len(own))
                    n_hit.append(int(own.sum()))
                    ids.append(sorted(set(tests.ids[items[from_row[k] : from_row[k + 1]]])))
                    spans.append([{"start": int(b), "n_words": int(e - b)} for b, e in zip(edges[::2], edges[1::2])])
                    matches.append([{"item_id": tests.ids[i], "n_words": n, "start": a, "item_start": q} for i, n, a, q in longest.get(k, ())])
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "n_words")]))]
                kinds.append(pa.list_(pa.struct([("item_id", pa.string()), *((c, pa.int64()) for c in ("n_words", "start", "item_start"))])))
                found = pa.StructArray.from_arrays([pa.array(v, kind) for v, kind in zip((n_words, n_hit, ids, spans, matches), kinds)], names=["n_words", "n_hit", "item_ids", "spans", "matches"])
                kept = [n for n in part.schema.names if n not in ("found", "text")]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in kept), found], names=[*kept, "found"])

    return run


def _joined(spans: F.Column) -> F.Column:
    """Spans that overlap or touch as one, in order."""
    end = lambda s: s["start"] + s["n_words"]
    last = lambda a: F.element_at(a, -1)
    longer = lambda a, s: F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(last(a)["start"].alias("start"), (F.greatest(end(last(a)), end(s)) - last(a)["start"]).alias("n_words"))))
    none = F.array().cast("array<struct<start:bigint,n_words:bigint>>")
    return F.aggregate(F.array_sort(spans), none, lambda a, s: F.when(F.size(a) == 0, F.array(s)).when(s["start"] <= end(last(a)), longer(a, s)).otherwise(F.concat(a, F.array(s))))


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """docs -> (row: all columns of docs as they are, found: n_words, n_hit, item_ids, spans, matches).

    Words are runs of letters and digits (A-Z lower-cased, any non-ASCII code point a letter). A
    window is 13 consecutive words of an item; an item of fewer words, but not none, is one window. A
    document word inside any occurrence of a window is hit; spans are the maximal runs of hit words.
    matches has for each item with hits the longest verbatim match: its words, and where it starts in the
    document and in the item. Null and empty texts have no words and no hits. Items with a
    null id or without words are ignored; rows that repeat an item count once. An empty benchmark
    hits nothing. Documents that repeat, and columns of any name, pass through unchanged.

    A benchmark of more than BLOCK_BYTES takes several passes over the texts, which are written once with
    a number for each row; what the passes find is joined by that number.
    """
    spark = docs.sparkSession
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    held = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))
    if blocks > 1:
        held = cut(held.withColumn("number", F.monotonically_increasing_id()), "numbered")
    own = "row" if blocks == 1 else "number"
    schema = T.StructType([held.schema[own], T.StructField("found", T._parse_datatype_string(HITS))]).simpleString()[len("struct<") : -1]
    parts = []
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).distinct().collect()
        shared = spark.sparkContext.broadcast(([r["id"] for r in part], [r["text"] for r in part]))
        parts.append(in_arrow(held.select(own, "text"), _searcher(shared), schema))
    if blocks == 1:
        return parts[0]
    hits = parts[0].select("number", "found")
    for more in parts[1:]:
        hits = hits.unionByName(more.where("found.n_hit > 0"))
    every = hits.groupBy("number").agg(F.max("found.n_words").alias("n_words"), *[F.flatten(F.collect_list(f"found.{c}")).alias(c) for c in ("item_ids", "spans", "matches")])
    every = every.select("number", "n_words", F.array_sort(F.array_distinct("item_ids")).alias("item_ids"), _joined(F.col("spans")).alias("spans"), F.array_sort("matches").alias("matches"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["n_words"])
    found = F.struct("n_words", n_hit.alias("n_hit"), "item_ids", "spans", "matches")
    return held.join(every.select("number", found.alias("found")), "number").select("row", "found")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids, contaminated (n_hit > 0 and 20 * n_hit >= n_words), spans and matches."""
    found = benchmark_hits(docs.select("doc_id", "text"), benchmark)
    return found.select("row.doc_id", "found.n_words", "found.n_hit", "found.item_ids", "found.spans", "found.matches").withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with their own columns, that are not contaminated."""
    found = benchmark_hits(docs, benchmark)
    return found.where(~((F.col("found.n_hit") > 0) & (20 * F.col("found.n_hit") >= F.col("found.n_words")))).select("row.*")
