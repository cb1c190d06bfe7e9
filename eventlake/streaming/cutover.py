"""History and live as one stream: live rows are buffered behind a fence until history reaches it, then drained."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

INPUT = (
    "chain_id bigint, arrival bigint, source string, kind string, identity string, block_number bigint, block_hash string, "
    "digest string, removed boolean, records bigint, bytes bigint, payload string"
)
OUTPUT = "chain_id bigint, shard int, arrival bigint, source string, identity string, block_number bigint, block_hash string, removed boolean, payload string, verdict string, phase string, buffered bigint"
LIMITS = (2048, 262144, 64 << 20)  # live batches, records and bytes before the cutover
_ORDER = {"head": 0, "record": 1, "ack": 2}
CHUNK = 8192  # rows that are Python objects at a time
_ARROW = pa.schema([(c, {"bigint": pa.int64(), "string": pa.large_string(), "boolean": pa.bool_()}[kind]) for c, kind in (x.split() for x in INPUT.split(", "))])
_META = ["fence", "acked", "through", "batches", "records", "bytes", "top", "checked", "poisoned", "seen"]


def to_shards(rows: DataFrame, shards: int) -> DataFrame:
    """Rows with their shard: a record by its height, heads and acknowledgements to every shard."""
    own = F.array(F.pmod(F.xxhash64("block_number"), F.lit(shards)).cast("int"))
    return rows.withColumn("shard", F.explode(F.when(F.col("kind") == "record", own).otherwise(F.sequence(F.lit(0), F.lit(shards - 1)))))


class Cutover:
    """One shard of the hand-over. apply() takes a row and gives the records that it settles, each with a verdict:

    history, live: delivered; suppressed: history delivered it, payload and block the same; payload, missing_in_history,
    missing_in_live: the two sources disagree between fence and cutover; below_fence: a live record that only
    history can vouch for; late_drop: a removal of a block that history never had; closed: history
    beyond the cutover; poisoned: live outgrew the bounds before it, nothing more is delivered.

    The fence is the first live head less one. History reaches it with the first acknowledgement at or above it,
    before or after the fence is known; that block is the cutover T. Live rows wait until then. History's
    witnesses are kept for `depth` heights and from the fence on.
    """

    def __init__(self, limits: tuple[int, int, int], depth: int):
        self.limits, self.depth = limits, depth
        self.fence = self.acked = self.through = self.top = None
        self.batches = self.records = self.bytes = 0
        self.checked = self.poisoned = False
        self.seen = -1  # the highest height of history so far
        self.buffer: list[dict[str, Any]] = []
        self.witnesses: dict[str, list] = {}  # identity: height, block hash, digest, whether live had it
        self.blocks: set[tuple[int, str]] = set()  # of the witnesses
        self.changed: set[str] = set()

    def restore(self, meta: Iterable | None, buffer: list[dict[str, Any]], witnesses: dict[str, list]) -> None:
        if meta is not None:
            for name, value in zip(_META, meta):
                setattr(self, name, value)
        self.buffer, self.witnesses = buffer, witnesses
        self.blocks = {(w[0], w[1]) for w in witnesses.values()}

    @property
    def phase(self) -> str:
        return "poisoned" if self.poisoned else "catching_up" if self.through is None else "live" if self.checked else "draining"

    def apply(self, row: dict[str, Any]) -> list[tuple[dict[str, Any], str]]:
        kind, number = row["kind"], row["block_number"]
        if self.poisoned:
            return [(row, "poisoned")] if kind == "record" else []
        if kind == "ack":
            self.acked = number if self.acked is None else max(self.acked, number)
            return self._ready() + self._missing(row)
        if kind == "head":
            return self._head(row)
        if row["source"] == "history":
            if self.through is not None:
                return [(row, "closed")]
            self.seen = max(self.seen, number)
            self.witnesses[row["identity"]] = [number, row["block_hash"], row["digest"], False]
            self.blocks.add((number, row["block_hash"]))
            self.changed.add(row["identity"])
            return [(row, "history")]
        if self.through is None:
            self.buffer.append(row)
            return []
        return [(row, self._judge(row))]

    def _head(self, row: dict[str, Any]) -> list[tuple[dict[str, Any], str]]:
        number = row["block_number"]
        if self.through is None:
            self.batches, self.records, self.bytes = self.batches + 1, self.records + row["records"], self.bytes + row["bytes"]
            if any(n > most for n, most in zip((self.batches, self.records, self.bytes), self.limits)):
                self.poisoned = True
                lost, self.buffer = self.buffer, []
                return [(r, "poisoned") for r in lost]
            if self.fence is None and number is not None:
                self.fence = max(number - 1, 0)
        if number is not None:
            self.top = number if self.top is None else max(self.top, number)
        return self._ready() + self._missing(row)

    def _ready(self) -> list[tuple[dict[str, Any], str]]:
        if self.through is not None or self.fence is None or self.acked is None or self.acked < self.fence:
            return []
        self.through = self.acked
        waiting, self.buffer = self.buffer, []
        return [(r, self._judge(r)) for r in waiting]

    def _missing(self, row: dict[str, Any]) -> list[tuple[dict[str, Any], str]]:
        """Once live is past the cutover, what history has between fence and cutover and live never sent."""
        if self.through is None or self.checked or self.top is None or self.top <= self.through:
            return []
        self.checked = True
        lost = sorted((i, w) for i, w in self.witnesses.items() if self.fence < w[0] <= self.through and not w[3])
        return [({**row, "source": "history", "identity": i, "block_number": w[0], "block_hash": w[1], "removed": False, "payload": None}, "missing_in_live") for i, w in lost]

    def _judge(self, row: dict[str, Any]) -> str:
        number = row["block_number"]
        if number > self.through:
            return "live"
        if row["removed"]:
            return "live" if (number, row["block_hash"]) in self.blocks else "late_drop"
        if number <= self.fence:
            return "below_fence"
        held = self.witnesses.get(row["identity"])
        if held is None:
            return "missing_in_history"
        if not held[3]:
            held[3] = True
            self.changed.add(row["identity"])
        return "suppressed" if (held[1], held[2]) == (row["block_hash"], row["digest"]) else "payload"

    def prune(self) -> None:
        """Forgets witnesses that no live row can meet any more."""
        floor = self.seen - self.depth if self.fence is None else min(self.fence, (self.through if self.through is not None else self.seen) - self.depth)
        for identity in [i for i, w in self.witnesses.items() if w[0] <= floor]:
            self.blocks.discard((self.witnesses[identity][0], self.witnesses[identity][1]))
            del self.witnesses[identity]
            self.changed.add(identity)


class _Processor(StatefulProcessor):
    """The waiting live rows are list state, appended to and cleared at the cutover; history's witnesses are map state."""

    def __init__(self, limits: tuple[int, int, int], depth: int):
        self.bounds = limits, depth

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.meta = handle.getValueState("meta", "fence bigint, acked bigint, through bigint, batches bigint, records bigint, bytes bigint, top bigint, checked boolean, poisoned boolean, seen bigint")
        self.buffer = handle.getListState("buffer", "arrival bigint, source string, kind string, identity string, block_number bigint, block_hash string, digest string, removed boolean, payload string")
        self.witnesses = handle.getMapState("witnesses", "identity string", "block_number bigint, block_hash string, digest string, met boolean")

    _KEPT = ["arrival", "source", "kind", "identity", "block_number", "block_hash", "digest", "removed", "payload"]

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        shard = Cutover(*self.bounds)
        stored = {k[0]: list(v) for k, v in self.witnesses.iterator()} if self.witnesses.exists() else {}
        waiting = [dict(zip(self._KEPT, r)) for r in self.buffer.get()] if self.buffer.exists() else []
        known = len(waiting)
        shard.restore(self.meta.get() if self.meta.exists() else None, waiting, {i: list(w) for i, w in stored.items()})
        out, cleared = [], False
        for row in in_order(rows):
            for r, verdict in shard.apply(row):
                out.append((*key, r["arrival"], r["source"], r["identity"], r["block_number"], r["block_hash"], r["removed"], r["payload"], verdict, shard.phase, len(shard.buffer)))
            cleared = cleared or len(shard.buffer) < known
            if len(out) >= CHUNK:
                yield _frame(out)
                out = []
        shard.prune()
        if cleared:
            self.buffer.clear()
            known = 0
        if len(shard.buffer) > known:
            self.buffer.appendList([tuple(r[c] for c in self._KEPT) for r in shard.buffer[known:]])
        for identity in shard.changed:
            if identity in shard.witnesses:
                self.witnesses.updateValue((identity,), tuple(shard.witnesses[identity]))
            elif identity in stored:
                self.witnesses.removeKey((identity,))
        self.meta.update(tuple(getattr(shard, c) for c in _META))
        yield _frame(out)

    def close(self) -> None:
        pass


def _frame(out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(out, columns=[c.split()[0] for c in OUTPUT.split(", ")]).astype({"block_number": "Int64"})


def in_order(frames: Iterable[pd.DataFrame], schema: pa.Schema = _ARROW) -> Iterator[dict[str, Any]]:
    """The rows by arrival, heads before records before acknowledgements. A micro-batch's rows wait as Arrow
    columns; Python objects are made of CHUNK of them at a time."""
    held = pa.concat_tables([schema.empty_table(), *[pa.Table.from_pandas(f, schema=schema, preserve_index=False) for f in frames]]).combine_chunks()
    kinds = held["kind"].to_pandas().map(_ORDER).to_numpy()
    order = np.lexsort((kinds, held["arrival"].to_numpy()))
    for k in range(0, len(order), CHUNK):
        yield from held.take(pa.array(order[k : k + CHUNK])).to_pylist()


def cutover_stream(rows: DataFrame, shards: int = 8, limits: tuple[int, int, int] = LIMITS, depth: int = 256) -> DataFrame:
    """A stream of INPUT rows of both sources -> OUTPUT: every record with its verdict (see Cutover), once.

    Kinds: record (identity, block_number, block_hash, digest, removed, payload), head (of live: the highest block,
    and the records and bytes, of the batch whose records follow it) and ack (of history: it is acknowledged
    through block_number). `arrival` orders the rows of both sources as they came; micro-batches must come in that order.
    Heads and acknowledgements go to every shard of a chain, so that all fix the same fence and cutover; records are dealt by height.
    Before the cutover the state is bounded by `limits`, after it by the witnesses of `depth` heights.
    Needs the RocksDB state store (journal.STATE_STORE).
    """
    return to_shards(rows, shards).groupBy("chain_id", "shard").transformWithStateInPandas(_Processor(limits, depth), OUTPUT, "append", "none")
