"""Exact hard negatives: clusters of anchors share a list of candidates by angular bound, walked to a certified end."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm._common import cut, release

SAMPLE = 4096  # anchors, at most, on which the centroids are fitted
SAMPLE_NUMBERS = 1 << 20  # and components of them
CLUSTERS = 64
GROUP_NUMBERS, BLOCK_NUMBERS = 1 << 20, 1 << 22  # components of the anchors, of the candidates that meet in a task
MEMBERS = 256  # anchors that walk together
PAIR = ["dim", "group", "block"]
_MOST = np.iinfo(np.int64).max


# ---------------------------------------------------------------- the search inside a block


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in doubles where none can pass 2**53."""
    most = lambda x: math.sqrt(float((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
    if most(a) * most(b) < 2.0**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))


def _directions(x: np.ndarray) -> np.ndarray:
    n = _lengths(x)
    return x / np.where(n > 0, n, 1.0)[:, None]


def centroids(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from the first k rows; a centre that nobody chooses stays."""
    u = _directions(sample)
    centres = u[:k].copy()
    for _ in range(rounds):
        own = np.argmax(u @ centres.T, axis=1)
        for c in np.unique(own):
            centres[c] = u[own == c].sum(axis=0)
        centres = _directions(centres)
    return centres


def walk(anchors: np.ndarray, candidates: np.ndarray, centres: np.ndarray, wanted) -> None:
    """Shows the candidates to each anchor, best bounds of its cluster first, until none that is left can matter.

    For a cluster of centre m whose members stand within an angle s of it, a candidate c at the angle t from m
    scores at most |a| |c| cos(max(0, t - s)) with any member a. The list is sorted by that bound once; a member
    leaves it where the bound is below wanted.floor, the least score that can still change its result. The
    bound has a margin over the rounding of angles, so leaving is certified.
    """
    size, length = _lengths(anchors), _lengths(candidates)
    toward = _directions(candidates)
    own = np.argmax(_directions(anchors) @ centres.T, axis=1)
    for k in np.unique(own):
        members = np.flatnonzero(own == k)
        angle = lambda u: np.arccos(np.clip(u @ centres[k], -1.0, 1.0))  # noqa: B023, E731
        spread = angle(_directions(anchors[members])).max()
        bound = length * (np.cos(np.maximum(0.0, angle(toward) - spread)) + 1e-7)
        order = np.argsort(-bound, kind="stable")
        for first in range(0, len(members), MEMBERS):
            open_, at, step = members[first : first + MEMBERS], 0, 256
            while at < len(order):
                open_ = open_[bound[order[at]] * size[open_] + 0.5 >= wanted.floor(open_)]
                if not len(open_):
                    break
                columns = order[at : at + step]
                wanted.take(open_, columns, products(anchors[open_], candidates[columns]))
                at, step = at + step, min(2 * step, 4096)


class Best:
    """For each slot the `n` highest scores, ties by smaller id. Slots belong to anchors and have a least and a greatest score."""

    def __init__(self, n: int, owner: np.ndarray, low: np.ndarray, high: np.ndarray, ids: np.ndarray, fits):
        self.n, self.owner, self.high, self.ids, self.fits = n, owner, high, ids, fits
        self.least = np.where(low <= high, low, _MOST)
        self.slot = self.id = self.score = np.zeros(0, np.int64)
        self.start = np.searchsorted(owner, np.arange(owner.max(initial=-1) + 2))

    def _slots(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slots of the anchors and the places of their anchors in `rows`."""
        n = self.start[rows + 1] - self.start[rows]
        place = np.repeat(np.arange(len(rows)), n)
        return self.start[rows][place] + np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n), place

    def floor(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), _MOST)
        slots, place = self._slots(rows)
        np.minimum.at(out, place, self.least[slots])
        return out.astype(np.float64)  # the margins of walk are far above this rounding

    def take(self, rows: np.ndarray, columns: np.ndarray, scores: np.ndarray) -> None:
        slots, place = self._slots(rows)
        s = scores[place]
        hit = self.fits(rows, columns)[place] & (s >= self.least[slots][:, None]) & (s <= self.high[slots][:, None])
        r, c = np.nonzero(hit)
        if not len(r):
            return
        slot = np.concatenate([self.slot, slots[r]])
        id_, score = np.concatenate([self.id, self.ids[columns[c]]]), np.concatenate([self.score, s[r, c]])
        order = np.lexsort((id_, -score, slot))
        slot, id_, score = slot[order], id_[order], score[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = rank < self.n
        self.slot, self.id, self.score = slot[kept], id_[kept], score[kept]
        full = rank == self.n - 1
        self.least[slot[full]] = np.maximum(self.least[slot[full]], score[full])


def _matrix(t: pa.Table) -> np.ndarray:
    lists = t["vector"].combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _centres(fitted: dict[int, np.ndarray], a: np.ndarray) -> np.ndarray:
    return fitted.get(a.shape[1], np.zeros((1, a.shape[1])))


def _positives(fitted: dict[int, np.ndarray], n: int):
    schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        a, c = _matrix(left), _matrix(right)
        own, ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        mine, theirs = left["label"].to_numpy(), right["label"].to_numpy()
        fits = lambda r, j: (mine[r][:, None] == theirs[j]) & (own[r][:, None] != ids[j])
        far = np.full(len(own), _MOST)
        best = Best(n, np.arange(len(own)), -far, far, ids, fits)
        walk(a, c, _centres(fitted, a), best)
        return pa.table([own[best.slot], best.id, best.score], schema=schema)

    return search


def _negatives(fitted: dict[int, np.ndarray], n: int, low: int, high: int):
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    schema = pa.schema([(c, pa.int64()) for c in names])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        a, c = _matrix(left), _matrix(right)
        own, ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        mine, theirs = left["label"].to_numpy(), right["label"].to_numpy()
        pairs = left["positives"].combine_chunks()
        owner = np.repeat(np.arange(len(own)), pairs.value_lengths().to_numpy())
        positive = pairs.flatten()
        of, score = (positive.field(k).to_numpy() for k in ("positive_id", "positive_score"))
        at_least = np.array([-(-low * int(x) // 100) for x in score], dtype=np.int64)
        at_most = np.array([high * int(x) // 100 for x in score], dtype=np.int64)
        best = Best(n, owner, at_least, at_most, ids, lambda r, j: mine[r][:, None] != theirs[j])
        walk(a, c, _centres(fitted, a), best)
        k = best.slot
        return pa.table([own[owner[k]], of[k], score[k], best.id, best.score], schema=schema)

    return search


# ---------------------------------------------------------------- over the table


def integer_vectors(embeddings: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256) -> DataFrame:
    """-> vec_id, label, vector of floor(scale * x). Rows with a null id, label, vector or component, or one that is not finite, are left out."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = embeddings.where(F.col(id_).isNotNull() & F.col(label).isNotNull() & finite)
    return rows.select(F.col(id_).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.transform(vector, lambda x: F.floor(scale * x.cast("double"))).alias("vector"))


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """vectors(vec_id, label, vector of longs) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchor` is the condition (on vec_id, label) that makes a row an anchor. A row's score is its inner product with the anchor; higher ones
    come first, ties by smaller vec_id. An anchor's positives are its first `positives` other rows of its label;
    for each, the first `negatives` rows of other labels follow whose score is `low` to `high` percent of the positive's.

    Exact. Anchors and candidates are dealt into groups and blocks of bounded size by id, whatever their labels or
    vectors, and each pair of them is one task's: copies of a vector, or a label that holds most rows, are spread. In a task the anchors of a
    cluster share one list of the block's candidates (see walk), one sort a search; what a block finds best is
    merged by anchor. Centroids are fitted on SAMPLE anchors at most and steer only the order of the lists.

    A vec_id names one vector: rows that repeat it are one, that of the smallest label, then vector. Vectors of
    different dimensions do not meet. Rows whose squared length reaches 2**62, so that a score may be no long, take
    no part. Null ids, labels and vectors are left out; an anchor without positives, and a positive without
    negatives, give no rows; a positive of score 0 or less has those that fit the two inequalities as they stand. Other columns are ignored.
    """
    spark = vectors.sparkSession
    squared = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = vectors.where("vec_id is not null and label is not null").where(squared < 2.0**62)  # a null component makes it null
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")).select("vec_id", F.col("r.label").cast("long").alias("label"), "r.vector")
    one = cut(one.withColumns({"dim": F.size("vector"), "anchor": anchor}), "negatives-vectors")
    seen = one.agg(F.sum("dim"), F.sum(F.when(F.col("anchor"), F.col("dim"))), F.max("dim")).first()
    total, asked, widest = (int(x or 0) for x in seen)
    groups = max(1, -(-asked // GROUP_NUMBERS))
    blocks = max(1, -(-total // BLOCK_NUMBERS), min(2 * spark.sparkContext.defaultParallelism, -(-total // (1 << 15))))

    sample = one.where("anchor").select("dim", "vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(1, min(SAMPLE, SAMPLE_NUMBERS // max(1, widest)))).collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(r["dim"], []).append(r["vector"])
    fitted = {d: centroids(np.array(v, dtype=np.float64).reshape(len(v), d), min(CLUSTERS, 1 + len(v) // 8)) for d, v in by_dim.items()}

    dealt = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    to_all = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = one.withColumn("block", dealt(blocks, 1)).select("vec_id", "label", "vector", "dim", "block", to_all(groups).alias("group"))
    asking = one.where("anchor").withColumn("group", dealt(groups, 2))
    first = lambda n, by, s, i: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(s), i)) <= n

    meet = lambda a: a.withColumn("block", to_all(blocks)).groupBy(*PAIR).cogroup(candidates.groupBy(*PAIR))
    found = meet(asking.select("vec_id", "label", "vector", "dim", "group")).applyInArrow(_positives(fitted, positives), "anchor_id long, positive_id long, positive_score long")
    found = found.withColumn("in", first(positives, ["anchor_id"], "positive_score", "positive_id")).where("in").drop("in")
    held = found.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))  # a few an anchor
    held = cut(asking.join(held.withColumnRenamed("anchor_id", "vec_id"), "vec_id").select("vec_id", "label", "vector", "dim", "group", "positives"), "negatives-anchors")

    out = meet(held).applyInArrow(_negatives(fitted, negatives, low, high), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    out = out.withColumn("rank", rank).where(F.col("rank") <= negatives)
    out = cut(out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")
    release(one, held)
    return out
