"""Delivery tokens and the estimated bytes of records and controls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def token(sequence: str | Column) -> Column:
    return F.lpad(F.lower(F.hex(F.col(sequence) if isinstance(sequence, str) else sequence)), 16, "0")


def accounted_bytes(topics: str | Column, data: str | Column, owners: str | Column) -> Column:
    """Estimated bytes of a log record: fixed parts, topics, data and the audience's owner ids."""
    t, d, o = (F.col(x) if isinstance(x, str) else x for x in (topics, data, owners))
    return 512 + 32 * F.size(t) + F.octet_length(d) + 64 + F.aggregate(o, F.lit(0), lambda a, x: a + F.octet_length(x) + 32)


def control_bytes(identifier: str | Column) -> Column:
    """Estimated bytes of a control."""
    return 256 + F.coalesce(F.octet_length(F.col(identifier) if isinstance(identifier, str) else identifier), F.lit(0))
