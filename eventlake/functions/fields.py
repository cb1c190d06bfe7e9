"""The fields of logs and blocks: widths, quantities and topics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_width(col: str, size: int) -> Column:
    """Whether a hexadecimal text holds exactly `size` bytes."""
    return F.coalesce(F.col(col).rlike(f"^[0-9a-f]{{{2 * size}}}$"), F.lit(False))


def quantity(col: str | Column) -> Column:
    """A big-endian hexadecimal quantity of at most 8 bytes; empty is 0, longer is null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.length(c) == 0, F.lit(0)).when(F.length(c) <= 16, F.conv(c, 16, 10)).cast("decimal(20,0)")


def topics_problem(topics: str = "topics") -> Column:
    """Null where the topics are at most four and their nulls only trail."""
    t = F.col(topics)
    first_null = F.array_position(F.transform(t, lambda x: x.isNull()), True)
    inner = (first_null > 0) & F.exists(F.slice(t, F.greatest(first_null, F.lit(1)).cast("int"), F.greatest(F.size(t), F.lit(1))), lambda x: x.isNotNull())
    return F.when(F.size(t) > 4, "too_many_topics").when(inner, "topic_after_null")


def normalize_topics(topics: str = "topics") -> Column:
    return F.array_compact(topics)
