"""Running computations over one huge chain or session: segments are summarized apart, summaries are carried, segments run apart."""

from __future__ import annotations

import json
import math
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT_ROWS, MOST_SEGMENTS = 1 << 17, 1 << 14


class Fold:
    """A computation along ordered rows whose effect on what comes in can be stated for a run of rows alone.

    summary() of a run and after() give the carry behind it from the carry before it; run() gives the new columns of
    the rows (of `adds`) with the carry before them. Carries and summaries are JSON values of bounded size.
    """

    adds: str
    start: Any = None

    def summary(self, rows: pd.DataFrame) -> Any:
        raise NotImplementedError

    def after(self, carry: Any, summary: Any) -> Any:
        raise NotImplementedError

    def run(self, rows: pd.DataFrame, carry: Any) -> dict[str, Any]:
        raise NotImplementedError


def segmented(rows: DataFrame, order: str, size: int = SEGMENT_ROWS, n: int | None = None) -> DataFrame:
    """With segment: ascending ranges of `order` with about `size` rows each, or `n` of them. Rows of one value stay together."""
    return _segmented(rows, order, min(MOST_SEGMENTS, -(-rows.count() // size) if n is None else n))


def dealt(rows: DataFrame, keys: list[str], order: str, size: int = SEGMENT_ROWS) -> DataFrame:
    """segmented(), dealt by keys and segment over a partition for every `size` rows, whatever the session's number is: a window
    or group by them shuffles no more, and no task grows with the table."""
    n = rows.count()
    return _segmented(rows, order, min(MOST_SEGMENTS, -(-n // size))).repartition(max(1, -(-n // size)), *keys, "segment")


def _segmented(rows: DataFrame, order: str, n: int) -> DataFrame:
    bounds = sorted(set(rows.approxQuantile(order, [k / n for k in range(1, n)], 0.25 / n))) if n > 1 else []
    if not bounds:
        return rows.withColumn("segment", F.lit(0))
    cut = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="__at", outputCol="__segment")
    placed = cut.transform(rows.withColumn("__at", F.col(order).cast("double")))
    return placed.withColumn("segment", F.col("__segment").cast("int")).drop("__at", "__segment")


def scan(rows: DataFrame, keys: list[str], order: list[str], fold: Fold, size: int = SEGMENT_ROWS) -> DataFrame:
    """rows with the columns of the fold, run along `order` within each key.

    Keys of up to `size` rows stream through tasks in order. A larger key is cut into segments by the first column of
    `order`; a task holds one segment. What passes from segment to segment is a summary each: the only thing that one
    group holds of a whole key, 2**14 of them at most.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("__n"))
    most, few = counts.agg(F.max("__n"), F.count_if(F.col("__n") <= size)).first()
    if (most or 0) <= size:
        return _whole(rows, keys, order, fold)
    n = -(-most // size)
    if not few:
        return _cut(rows, keys, order, fold, size, n)
    large = F.broadcast(counts.where(F.col("__n") > size).select(*[F.col(k).alias(f"__{k}") for k in keys]))  # a row for `size` rows
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    cut = _cut(rows.join(large, same, "left_semi"), keys, order, fold, size, n)
    return cut.unionByName(_whole(rows.join(large, same, "left_anti"), keys, order, fold))


def _whole(rows: DataFrame, keys: list[str], order: list[str], fold: Fold) -> DataFrame:
    """scan() of keys that one task holds: many keys a task, one in memory."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(fold.adds)
    kinds = to_arrow_schema(added)

    def one(part: pa.Table) -> pa.Table:
        said = fold.run(part.to_pandas(), fold.start)
        new = [pa.array(said[f.name], type=f.type, from_pandas=True) for f in kinds]
        return pa.Table.from_arrays([*part.columns, *new], schema=pa.schema([*part.schema, *kinds]))

    def run(batches):
        open_ = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if open_ is None else pa.concat_tables([open_, t]).combine_chunks()
            if t.num_rows == 0:
                continue
            k = t.select(keys).to_pandas()
            was = k.shift(1)
            ends = np.flatnonzero(((k != was) & ~(k.isna() & was.isna())).any(axis=1).to_numpy())
            ends = [0, *ends[ends > 0]]
            open_ = t.slice(ends[-1])
            if len(ends) > 1:
                yield from pa.concat_tables([one(t.slice(low, high - low)) for low, high in zip(ends, ends[1:])]).combine_chunks().to_batches()
        if open_ is not None:
            yield from one(open_).combine_chunks().to_batches()

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, *order)
    return dealt.mapInArrow(run, StructType([*rows.schema.fields, *added.fields]))


def _cut(rows: DataFrame, keys: list[str], order: list[str], fold: Fold, size: int, n: int) -> DataFrame:
    """scan() of keys that are cut."""
    seg = segmented(rows, order[0], size, n)
    kinds = {f.name: f.dataType.simpleString() for f in seg.schema.fields}
    own = [*keys, "segment"]
    typed = lambda names: ", ".join(f"`{c}` {kinds[c]}" for c in names)
    ordered = lambda f: f.sort_values(order, kind="stable", ignore_index=True)

    def summarize(f: pd.DataFrame) -> pd.DataFrame:
        f = ordered(f)
        return f[own].head(1).assign(said=json.dumps(fold.summary(f)))

    def carry(f: pd.DataFrame) -> pd.DataFrame:
        f, now, out = f.sort_values("segment", ignore_index=True), fold.start, []
        for said in f["said"]:
            out.append(json.dumps(now))
            now = fold.after(now, json.loads(said))
        return f[own].assign(said=out)

    def run(f: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        f = ordered(f)
        return f.assign(**fold.run(f, json.loads(before["said"].iloc[0]))) if len(f) else f.assign(**{c.split()[0]: [] for c in fold.adds.split(", ")})

    said = seg.groupBy(*own).applyInPandas(summarize, f"{typed(own)}, said string")
    before = said.groupBy(*keys).applyInPandas(carry, f"{typed(own)}, said string").select(*[F.col(c).alias(f"of_{c}") for c in own], "said")
    out = seg.groupBy(*own).cogroup(before.groupBy(*[f"of_{c}" for c in own])).applyInPandas(run, f"{typed(seg.columns)}, {fold.adds}")
    return out.drop("segment")


def _int(x: Any) -> int | None:
    return None if x is None or pd.isna(x) else int(x)


class Surviving(Fold):
    """Along descending arrivals: whether every later arrival has a higher number. The carry is the least number so far."""

    adds = "survives boolean"

    def summary(self, rows):
        return int(rows["number"].min())

    def after(self, carry, summary):
        return summary if carry is None else min(carry, summary)

    def run(self, rows, carry):
        least = np.minimum.accumulate(np.concatenate([[math.inf if carry is None else carry], rows["number"].to_numpy()[:-1]]))
        return {"survives": rows["number"].to_numpy() < least}


class Branches(Fold):
    """Along arrivals: the tip before each, whether the arrival starts a branch at or below it, and the number of its branch."""

    adds = "tip bigint, tip_hash string, starts boolean, branch bigint"

    @staticmethod
    def _starts(numbers, hashes, tips, tip_hashes):
        return np.array([t is not None and t >= n and th != h for n, h, t, th in zip(numbers, hashes, tips, tip_hashes)], dtype=bool)

    def summary(self, rows):
        n, h = rows["number"].tolist(), rows["hash"].tolist()
        return [n[0], h[0], n[-1], h[-1], int(self._starts(n[1:], h[1:], n[:-1], h[:-1]).sum())]

    def after(self, carry, summary):
        number, hash_, last, last_hash, inside = summary
        tip, tip_hash, branch = carry or (None, None, 0)
        first = tip is not None and tip >= number and tip_hash != hash_
        return [last, last_hash, branch + inside + bool(first)]

    def run(self, rows, carry):
        tip, tip_hash, branch = carry or (None, None, 0)
        n, h = rows["number"].tolist(), rows["hash"].tolist()
        tips, hashes = [tip, *n[:-1]], [tip_hash, *h[:-1]]
        starts = self._starts(n, h, tips, hashes)
        return {"tip": pd.array(tips, dtype="Int64"), "tip_hash": hashes, "starts": starts, "branch": branch + np.cumsum(starts)}


class Certified(Fold):
    """Along sequences: the highest head so far; a reorg whose ancestor is below it clears it.

    The effect of a run on an unknown head is a step function: the head itself or the run's own, where no reorg cuts below it,
    else what came after the cut. The summary lists [greatest head that a step holds for, result, whether
    the head itself counts], of which a reorg adds one and heads that pass both sides merge some.
    """

    adds = "certified bigint"

    def summary(self, rows):
        steps = [[math.inf, None, True]]  # ascending
        for head, ancestor in zip(rows["head_number"], rows["ancestor"]):
            head, ancestor = _int(head), _int(ancestor)
            if ancestor is not None:
                cut = []
                for most, own, through in steps:
                    if through and (own is None or own <= ancestor):
                        low = [[ancestor, own, True]] if most > ancestor else [[most, own, True]]
                        cut += low + ([[most, None, False]] if most > ancestor else [])
                    else:
                        cut.append([most, own if own is not None and own <= ancestor else None, False])
                steps = cut
            if head is not None:
                steps = [[m, head if o is None else max(o, head), t] for m, o, t in steps]
            merged = []
            for step in steps:  # neighbours without the head itself that agree are one
                if merged and not step[2] and not merged[-1][2] and merged[-1][1] == step[1]:
                    merged[-1][0] = step[0]
                else:
                    merged.append(step)
            steps = merged
        return [[None if m == math.inf else m, o, t] for m, o, t in steps]

    def after(self, carry, summary):
        at = -math.inf if carry is None else carry
        for most, own, through in summary:
            if most is None or at <= most:
                found = [x for x in (own, carry if through else None) if x is not None]
                return max(found, default=None)
        return None

    def run(self, rows, carry):
        out = []
        for head, ancestor in zip(rows["head_number"], rows["ancestor"]):
            head, ancestor = _int(head), _int(ancestor)
            if ancestor is not None and carry is not None and carry > ancestor:
                carry = None
            if head is not None:
                carry = head if carry is None else max(carry, head)
            out.append(carry)
        return {"certified": pd.array(out, dtype="Int64")}


class Marks(Fold):
    """Along arrivals: the safe head before each row and after it, and the finalized head likewise.

    A mark raises a head, a reorg lowers the safe head to its ancestor: a run of them takes x to min(max(x, low), high).
    Marks above the coverage of their row do not count.
    """

    adds = "safe_before bigint, safe_head bigint, finalized_before bigint, finalized_head bigint"
    start = [None, None]

    @staticmethod
    def _steps(rows):
        for safe, final, ancestor, coverage in zip(rows["safe"], rows["finalized"], rows["ancestor"], rows["coverage"]):
            safe, final, ancestor, coverage = map(_int, (safe, final, ancestor, coverage))
            counts = lambda x: x if x is not None and (coverage is None or x <= coverage) else None  # noqa: B023, E731
            yield ancestor, counts(safe), counts(final)

    @staticmethod
    def _clamp(x, low, high):
        x = max([v for v in (x, low) if v is not None], default=None)
        return x if x is None or high is None else min(x, high)

    def summary(self, rows):
        low = high = top = None
        for ancestor, safe, final in self._steps(rows):
            if ancestor is not None:
                low, high = (None if low is None else min(low, ancestor)), ancestor if high is None else min(high, ancestor)
            if safe is not None:
                low, high = self._clamp(low, safe, None), None if high is None else max(high, safe)
            top = self._clamp(top, final, None)
        return [low, high, top]

    def after(self, carry, summary):
        return [self._clamp(carry[0], summary[0], summary[1]), self._clamp(carry[1], summary[2], None)]

    def run(self, rows, carry):
        safe, final = carry
        out = {c.split()[0]: [] for c in self.adds.split(", ")}
        for ancestor, s, f in self._steps(rows):
            out["safe_before"].append(safe)
            out["finalized_before"].append(final)
            safe, final = self._clamp(self._clamp(safe, None, ancestor), s, None), self._clamp(final, f, None)
            out["safe_head"].append(safe)
            out["finalized_head"].append(final)
        return {c: pd.array(v, dtype="Int64") for c, v in out.items()}


class Commits(Fold):
    """Along sequences, then ordinals, of right acks: which ack commits its sequence.

    An ack of sequence s commits where it is the first after the one that committed s - 1. The carry is the last
    committed sequence and its ordinal, or null once a sequence has no ack in time; a run's summary gives for each ack of its
    first sequence where the run would end.
    """

    adds = "commits boolean"
    start = [0, None]

    @staticmethod
    def _by_sequence(rows):
        sequence, ordinal = rows["sequence"].to_numpy(), rows["ordinal"].to_numpy()
        first = np.flatnonzero(np.concatenate([[True], sequence[1:] != sequence[:-1]]))
        return sequence[first], np.split(ordinal, first[1:]), first

    def summary(self, rows):
        sequences, acks, _ = self._by_sequence(rows)
        ends = [[int(sequences[-1]), int(o)] for o in acks[-1]]
        for k in range(len(acks) - 2, -1, -1):
            at = np.searchsorted(acks[k + 1], acks[k], "right") if sequences[k + 1] == sequences[k] + 1 else np.full(len(acks[k]), len(ends))
            ends = [ends[j] if j < len(ends) else None for j in at]
        return [int(sequences[0]), [int(o) for o in acks[0]], ends]

    def after(self, carry, summary):
        sequence, ordinals, ends = summary
        if carry is None or sequence != carry[0] + 1:
            return None
        at = 0 if carry[1] is None else int(np.searchsorted(ordinals, carry[1], "right"))
        return ends[at] if at < len(ends) else None

    def run(self, rows, carry):
        sequences, acks, first = self._by_sequence(rows)
        out = np.zeros(len(rows), dtype=bool)
        for s, ordinals, begin in zip(sequences, acks, first):
            if carry is None or s != carry[0] + 1:
                break
            at = 0 if carry[1] is None else int(np.searchsorted(ordinals, carry[1], "right"))
            if at == len(ordinals):
                break
            out[begin + at] = True
            carry = [int(s), int(ordinals[at])]
        return {"commits": out}
