"""Shards by jump consistent hashing of a stable key, with gapless slots."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm._common import U64, mix

BUCKET_ROWS = 50_000  # rows that are numbered together at most, on average


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key. With one more shard a key stays or moves to the new one."""
    key = mix(keys.astype(np.int64).view(U64) + U64(0x9E3779B97F4A7C15))
    shard, after = np.zeros(len(key), dtype=np.int64), np.zeros(len(key), dtype=np.int64)
    open_ = np.arange(len(key))
    while len(open_):
        shard[open_] = after[open_]
        key[open_] = key[open_] * U64(2862933555777941757) + U64(1)
        step = float(1 << 31) / ((key[open_] >> U64(33)).astype(np.float64) + 1.0)
        after[open_] = ((shard[open_] + 1) * step).astype(np.int64)
        open_ = open_[after[open_] < shards]
    return shard


def _jumper(shards: int):
    @F.pandas_udf("int")
    def shard(key: pd.Series) -> pd.Series:
        return pd.Series(jump(key.to_numpy(dtype=np.int64), shards).astype(np.int32))

    return shard


def sharded(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs -> doc_id, size, text_crc32, law, shard, slot, grown_shard (the shard with one more shard).

    The shard depends on the key and the number of shards alone, so copies of a text lie where their
    keys put them; a null key counts as 0. A null text has size 1 and the checksum of no bytes.
    Slots number the rows of a shard from 0 without gaps, by bucket of key, size and checksum, then by
    them, so rows of one key spread; rows that repeat get slots of their own. The numbering is counted by bucket first, so
    no task sorts a whole shard. Other columns are ignored.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
    )
    stable = F.coalesce("doc_id", F.lit(0).cast("long"))  # a null would turn its whole batch to floats
    rows = rows.withColumn("shard", _jumper(shards)(stable)).withColumn("grown_shard", _jumper(shards + 1)(stable))
    buckets = max(128, docs.count() // (shards * BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    placed = rows.withColumn("at", F.row_number().over(inside) - 1).join(offsets, ["shard", "bucket"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("offset") + F.col("at")).cast("long").alias("slot"), "grown_shard")
