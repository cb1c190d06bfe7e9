"""Structured Streaming forms: a canonical-chain tracker keyed by chain, and a delivery stream."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

OUTPUT = "chain_id bigint, arrival bigint, outcome string, number bigint, hash string, ancestor bigint, old_tip bigint"
CHUNK = 1 << 13


def step(chain: list[list], block: dict[str, Any], depth: int) -> tuple[list[list], str, int | None, int | None]:
    """(chain, outcome, ancestor, old tip) after one block; a chain is [number, hash, parent hash, timestamp], oldest first.

    Outcomes are new, duplicate, reorg, conflicting_metadata (the same hash with another parent or time),
    gap, unknown_parent (the retained block before it has another hash) and exhausted (that block is
    not retained, or the successor of the tip has another parent); on the last four the chain stays as it was.
    """
    row = [block[c] for c in ("number", "hash", "parent_hash", "timestamp")]
    number, hash_, parent, _ = row
    if not chain:
        return [row], "new", None, None
    low, tip = chain[0][0], chain[-1][0]
    if number > tip + 1:
        return chain, "gap", None, None
    if number == tip + 1:
        return ([*chain, row][-depth:], "new", None, None) if chain[-1][1] == parent else (chain, "exhausted", None, None)
    if number < low:
        return chain, "exhausted", None, None
    at = number - low
    if chain[at][1] == hash_:
        return chain, "duplicate" if chain[at] == row else "conflicting_metadata", None, None
    if number == 0:
        return chain, "unknown_parent", None, None
    if number == low:
        return chain, "exhausted", None, None
    if chain[at - 1][1] != parent:
        return chain, "unknown_parent", None, None
    return [*chain[:at], row], "reorg", number - 1, tip


def track_canonical(arrivals: DataFrame, depth: int = 64) -> DataFrame:
    """A stream of (chain_id, arrival, number, hash, parent_hash, timestamp) -> one row an arrival with its outcome.

    The state of a chain is its newest `depth` blocks, so it is bounded whatever the stream's length.
    Within a micro-batch a chain's arrivals are taken in the order of `arrival`.
    """

    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        chain = json.loads(state.get[0]) if state.exists else []
        taken = pd.concat(list(frames)).sort_values("arrival")
        for low in range(0, len(taken), CHUNK):  # a frame, of which a part at a time is Python objects
            rows = []
            for r in taken.iloc[low : low + CHUNK].to_dict("records"):
                chain, outcome, ancestor, tip = step(chain, r, depth)
                rows.append((key[0], r["arrival"], outcome, r["number"], r["hash"], ancestor, tip))
            out = pd.DataFrame(rows, columns=["chain_id", "arrival", "outcome", "number", "hash", "ancestor", "old_tip"])
            yield out.astype({"ancestor": "Int64", "old_tip": "Int64"})
        state.update((json.dumps(chain),))

    return arrivals.groupBy("chain_id").applyInPandasWithState(update, OUTPUT, "chain string", "append", "NoTimeout")


def deliver_stream(source: DataFrame, normalize: Callable[[DataFrame], DataFrame], handler: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Pulls what the source has, normalizes each micro-batch and hands it over with its sequence (from 1).

    At-least-once: after a failure the last batch comes again with the same sequence, so a handler that
    appends by sequence (write_deliveries) makes it exactly once.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        handler(normalize(batch), batch_id + 1)

    return source.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(stream: DataFrame, key: list[str], timestamp: str, delay: str) -> DataFrame:
    """The simple form of audience-blind deduplication: the first row of an identity within the watermark."""
    return stream.withWatermark(timestamp, delay).dropDuplicatesWithinWatermark(key)


def progress(rows: DataFrame) -> DataFrame:
    """Blocks and reorgs that a tracker let through, and its errors, by kind."""
    return rows.groupBy("chain_id", "outcome").agg(F.count("*").alias("n"), F.max("number").alias("top"))
