"""Shared helpers: table reading, lineage cuts in the shared folder, vectorised word hashing."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------- tables and lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared scratch folder; a temporary one only where none is set and all runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^,]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
        folder = os.path.join(tempfile.gettempdir(), "eventlake-checkpoints")
    return folder.rstrip("/")


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    The written table survives the loss of any executor, so what follows is never recomputed
    from the start, and later readers prune its columns.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")  # the shuffle files of the write are of no more use after it
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete tables that `cut` wrote. Call it once all that reads them is itself written."""
    for df in tables:
        spark = df.sparkSession
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def in_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """mapInArrow. Spark bounds a batch by bytes (spark.sql.execution.arrow.maxBytesPerBatch) and by rows."""
    return df.mapInArrow(fn, schema)


# ---------------------------------------------------------------- words of whole texts

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words that white space ends: all but space and \t \n \v \f \r.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Bytes of words of letters and digits; every byte of a non-ASCII code point counts as a letter.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that close values come out unrelated."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(raw[2], dtype=np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    body = body[offsets[0] : offsets[-1]] if len(offsets) else body[:0]
    return body, offsets - (offsets[0] if len(offsets) else 0)


def pieces(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold about `limit` bytes together (one row at least)."""
    if not batch.num_rows:
        return
    _, offsets = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


class Words:
    """Words of the rows of a text column: 64-bit hash, row and byte span of each, in order."""

    def __init__(self, column: pa.Array, kind: np.ndarray):
        body, offsets = utf8(column)
        rows, size = len(column), len(body)
        low = LOWER[body]
        inside = kind[low]
        filled = offsets[1:] > offsets[:-1]
        before = np.zeros(size, dtype=bool)
        before[1:] = inside[:-1]
        before[offsets[:-1][filled]] = False
        start = np.flatnonzero(inside & ~before)
        after = np.zeros(size, dtype=bool)
        after[:-1] = inside[1:]
        after[offsets[1:][filled] - 1] = False
        end = np.flatnonzero(inside & ~after) + 1
        self.start, self.end = start, end
        self.row = np.searchsorted(offsets, start, "right") - 1
        self.first = np.searchsorted(start, offsets)  # the first word of each row, and the end
        length = end - start
        if len(start):
            flat = low[inside]
            begin = np.zeros(len(start), dtype=np.int64)
            np.cumsum(length[:-1], out=begin[1:])
            at = np.arange(len(flat)) - np.repeat(begin, length)
            power = np.ones(int(length.max()), dtype=U64)
            power[1:] = _BASE
            power = np.cumprod(power, dtype=U64)
            value = (flat.astype(U64) + U64(1)) * power[at]
            self.hash = mix(np.add.reduceat(value, begin) ^ (length.astype(U64) * U64(0xD6E8FEB86659FD93)))
        else:
            self.hash = np.zeros(0, dtype=U64)
        self.rows = rows


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of `width` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    h = np.full(n, width, dtype=U64)
    for k in range(width):
        h *= U64(0xD1342543DE82EF95)
        h += words[k : k + n]
    return mix(h)
