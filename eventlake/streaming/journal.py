"""Audience-aware deduplication of a live stream: a bounded journal of recent inputs as keyed state."""

from __future__ import annotations

import heapq
from collections import OrderedDict
from collections.abc import Iterable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

INPUT = (
    "chain_id bigint, arrival bigint, delivery bigint, kind string, identity string, block_number bigint, owners array<string>, "
    "digest string, removed boolean, ancestor bigint, owner_id string, generation bigint"
)
OUTPUT = "chain_id bigint, shard int, arrival bigint, identity string, verdict string, owners array<string>, entries bigint, associations bigint"
ENTRY = pa.schema([("identity", pa.string()), ("position", pa.int64()), ("block", pa.int64()), ("digest", pa.string()), ("delivery", pa.int64()), ("owners", pa.list_(pa.string())), ("generations", pa.list_(pa.int64()))])
CHUNK = 1 << 13  # entries of the state, and rows of the output, that are written together
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shard_of(identity: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(identity), F.lit(shards)).cast("int")


def to_shards(rows: DataFrame, shards: int) -> DataFrame:
    """Rows with the shard of their chain's journal: a record by its identity; reorgs and owners go to every shard."""
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    return rows.withColumn("shard", F.explode(F.when(F.col("kind") == "record", F.array(shard_of(F.col("identity"), shards))).otherwise(every)))


class Journal:
    """What the owners of a chain have seen of late. Entries stand in the order of their last touch, oldest first.

    apply() takes a row and says what to do with it:
    delivered (to the owners that have not seen the input at their present generation), suppressed (all
    have), passed (removals, always), conflict (another payload than the one seen: nothing is delivered),
    poisoned (a delivery needs more entries or owner associations than the bounds allow, or one did before).
    A reorg forgets the inputs of blocks above its ancestor. When the next delivery begins, entries over
    `capacity` go, the least recently touched first, and more until the owner associations fit; those that
    the delivery itself touched are protected. Neither a reorg nor a delivery looks at entries that stay.
    """

    def __init__(self, capacity: int, associations: int):
        self.capacity, self.most = capacity, associations
        self.entries: OrderedDict[str, dict[str, Any]] = OrderedDict()
        self.at: dict[int, set[str]] = {}  # the entries of each block
        self.tops: list[int] = []  # a heap of the blocks of `at`, negative, and of some that it no longer has
        self.generations: dict[str, int] = {}
        self.delivery, self.position, self.held, self.poisoned = None, 0, 0, False
        self.own, self.own_held = 0, 0  # entries and associations that the present delivery has touched
        self.changed: set[str] = set()

    def restore(self, entries: Iterable[tuple], generations: Iterable[tuple], meta: tuple | None) -> None:
        rows = sorted(entries, key=lambda e: e[1])
        self.entries = OrderedDict((i, {"position": p, "block": b, "digest": d, "delivery": v, "seen": dict(zip(o, g))}) for i, p, b, d, v, o, g in rows)
        for identity, e in self.entries.items():
            self._place(identity, e["block"])
        self.generations = dict(generations)
        if meta is not None:
            self.delivery, self.position, self.poisoned = meta
        self.held = sum(len(e["seen"]) for e in self.entries.values())
        mine = [e for e in self.entries.values() if e["delivery"] == self.delivery]
        self.own, self.own_held = len(mine), sum(len(e["seen"]) for e in mine)

    def _place(self, identity: str, block: int | None) -> None:
        if block is not None:
            if block not in self.at:
                self.at[block] = set()
                heapq.heappush(self.tops, -block)
            self.at[block].add(identity)

    def _forget(self, identity: str) -> None:
        e = self.entries.pop(identity)
        if e["block"] is not None:
            held = self.at[e["block"]]
            held.discard(identity)
            if not held:
                del self.at[e["block"]]
        self.held -= len(e["seen"])
        if e["delivery"] == self.delivery:
            self.own, self.own_held = self.own - 1, self.own_held - len(e["seen"])
        self.changed.add(identity)

    def _next(self, delivery: int) -> None:
        while self.entries:
            identity, e = next(iter(self.entries.items()))
            if (len(self.entries) <= self.capacity and self.held <= self.most) or e["delivery"] == self.delivery:
                break  # what follows was touched later
            self._forget(identity)
        self.delivery, self.own, self.own_held = delivery, 0, 0

    def apply(self, row: dict[str, Any]) -> tuple[str, list[str]]:
        if self.poisoned:
            return "poisoned", []
        if row["delivery"] != self.delivery:
            self._next(row["delivery"])
        if row["kind"] == "reorg":
            while self.tops and -self.tops[0] > row["ancestor"]:
                for identity in list(self.at.get(-heapq.heappop(self.tops), ())):
                    self._forget(identity)
            return "reorg", []
        if row["kind"] == "owner":
            if row["generation"] is None:
                self.generations.pop(row["owner_id"], None)
            else:
                self.generations[row["owner_id"]] = row["generation"]
            return "owner", []
        if row["removed"]:
            return "passed", sorted(set(row["owners"]))
        e = self.entries.get(row["identity"])
        if e is not None and e["digest"] != row["digest"]:
            return "conflict", []
        seen = {} if e is None else e["seen"]
        fresh = sorted(o for o in set(row["owners"]) if seen.get(o) != self.generations.get(o, 0))
        if e is not None:
            self._forget(row["identity"])
        seen = seen | {o: self.generations.get(o, 0) for o in fresh}
        self.position += 1
        self.entries[row["identity"]] = {"position": self.position, "block": row["block_number"], "digest": row["digest"], "delivery": self.delivery, "seen": seen}
        self._place(row["identity"], row["block_number"])
        self.changed.add(row["identity"])
        self.held, self.own, self.own_held = self.held + len(seen), self.own + 1, self.own_held + len(seen)
        if self.own > self.capacity or self.own_held > self.most:
            self.poisoned = True
            return "poisoned", []
        return ("delivered", fresh) if fresh else ("suppressed", [])


class _Processor(StatefulProcessor):
    """The journal of one shard of a chain. Its entries are a list of Arrow batches of CHUNK entries, oldest first, as a call to the
    store an entry takes longer than all else; the generations of its owners are a map. Both are read at the first row of a micro-batch and written after the last."""

    def __init__(self, capacity: int, associations: int):
        self.bounds = capacity, associations

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = handle.getListState("entries", "chunk binary")
        self.generations = handle.getMapState("generations", "owner_id string", "generation bigint")
        self.meta = handle.getValueState("meta", "delivery bigint, position bigint, poisoned boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        journal = Journal(*self.bounds)
        stored = self.entries.get() if self.entries.exists() else ()
        known = {k[0]: v[0] for k, v in self.generations.iterator()}
        journal.restore((e for chunk in stored for e in _unpacked(chunk[0])), known.items(), self.meta.get() if self.meta.exists() else None)
        out = []
        for row in sorted((r for f in rows for r in _rows(f)), key=lambda r: r["arrival"]):
            verdict, owners = journal.apply(row)
            if row["kind"] == "record":
                out.append((*key, row["arrival"], row["identity"], verdict, owners, len(journal.entries), journal.held))
        if journal.changed:
            self.entries.put([(chunk,) for chunk in _packed(journal.entries)]) if journal.entries else self.entries.clear()
        for owner in journal.generations.keys() | known.keys():
            if owner not in journal.generations:
                self.generations.removeKey((owner,))
            elif journal.generations[owner] != known.get(owner):
                self.generations.updateValue((owner,), (journal.generations[owner],))
        self.meta.update((journal.delivery, journal.position, journal.poisoned))
        columns = ["chain_id", "shard", "arrival", "identity", "verdict", "owners", "entries", "associations"]
        for low in range(0, len(out), CHUNK):
            yield pd.DataFrame(out[low : low + CHUNK], columns=columns)

    def close(self) -> None:
        pass


def _packed(entries: OrderedDict[str, dict[str, Any]]) -> Iterator[bytes]:
    """Entries in their order, CHUNK at a time, as compressed Arrow streams."""
    held = list(entries.items())
    for low in range(0, len(held), CHUNK):
        part = held[low : low + CHUNK]
        columns = [[i for i, _ in part], *([e[c] for _, e in part] for c in ("position", "block", "digest", "delivery")), [list(e["seen"]) for _, e in part], [list(e["seen"].values()) for _, e in part]]
        batch = pa.record_batch([pa.array(v, f.type) for v, f in zip(columns, ENTRY)], schema=ENTRY)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, ENTRY, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(batch)
        yield sink.getvalue().to_pybytes()


def _unpacked(chunk: bytes) -> Iterator[tuple]:
    """(identity, position, block, digest, delivery, owners, generations) of each entry."""
    for batch in pa.ipc.open_stream(chunk):
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _rows(frame: pd.DataFrame) -> Iterator[dict[str, Any]]:
    """Rows with None for what is missing."""
    columns = {}
    for c in frame.columns:
        held, there = frame[c].tolist(), frame[c].notna().tolist()
        if c == "owners":
            columns[c] = [[] if v is None else list(v) for v in held]
        elif c in ("block_number", "ancestor", "generation", "delivery", "arrival"):
            columns[c] = [int(v) if ok else None for v, ok in zip(held, there)]
        else:
            columns[c] = [v if ok else None for v, ok in zip(held, there)]
    for values in zip(*columns.values()):
        yield dict(zip(columns, values))


def dedup_stream(rows: DataFrame, shards: int = 8, capacity: int = 4096, associations: int = 65536) -> DataFrame:
    """A stream of INPUT rows -> OUTPUT: a row for each record with its verdict, the owners it is delivered to, and the size of its journal.

    Kinds: record (identity, block_number, owners, digest, removed), reorg (ancestor), owner (owner_id with its new
    generation; null: the owner is gone). Rows of a chain are taken in order of `arrival` within a
    micro-batch, and micro-batches must come in that order; a delivery's rows have one number and follow one another. A chain's journal is cut by identity
    into `shards`, each with its own bounds, so one chain is many tasks' work; reorgs and owners go to all of
    them. A shard's state is `capacity` entries and one delivery at most, whatever the length of the stream.
    Needs the RocksDB state store (STATE_STORE).
    """
    keyed = to_shards(rows, shards).groupBy("chain_id", "shard")
    return keyed.transformWithStateInPandas(_Processor(capacity, associations), OUTPUT, "append", "none")
