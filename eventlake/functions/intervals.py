"""Half-open ranges of numbers as dyadic intervals, so that "which ranges hold this number" is a join on equal keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dyadic(low: str, high: str) -> Column:
    """The half-open range of two SQL expressions as an array of (level, part): part k of level j is the 2**j numbers from k * 2**j on.

    A level holds the part at the lower end where its number is odd, and the one before the upper end where that is.
    """
    part = lambda at: f"array(named_struct('level', x.level, 'part', {at}))"
    none = "cast(array() as array<struct<level: int, part: bigint>>)"
    sizes = f"transform(sequence(0, 62), j -> named_struct('level', j, 'a', -shiftright(-cast({low} as bigint), j), 'b', shiftright(cast({high} as bigint), j)))"
    ends = f"concat(if(x.a % 2 = 1, {part('x.a')}, {none}), if(x.b % 2 = 1, {part('x.b - 1')}, {none}))"
    return F.expr(f"flatten(transform(filter({sizes}, x -> x.a < x.b), x -> {ends}))")
