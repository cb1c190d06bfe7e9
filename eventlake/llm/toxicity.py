"""Toxicity by a logistic classifier with a counterfactual penalty.

Features are hashed words and word beginnings, present or not. The classifier is fitted on a bounded
sample of labelled rows. Each of them that mentions a group is fitted together with its counterfactual,
the same text with the mention swapped for another group; the penalty is the squared difference of
both scores, so a neutral mention moves the score no more than any other would.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm._common import ALNUM, LOWER, U64, Words, in_arrow, mix, pieces, utf8

BITS = 20  # of a feature's hash
BEGINNINGS = (4, 5, 6)  # bytes of a word's beginning that are features of their own
SAMPLE = 12_000  # labelled rows that are fitted at most: those of the smallest hash of their id
SELECTED = 20_000  # features that are fitted at most, most telling first
LEAST_ROWS = 4  # rows of the sample that must hold a feature
COUNTERFACTUAL, RIDGE, ROUNDS = 1.0, 2e-4, 400

#: Words that name a group, by kind, in the four languages of the corpus.
GROUPS = [
    *(pair.split() for pair in ("men women", "boys girls", "man woman", "boy girl", "männer frauen", "schwarze weiße", "schwule lesben", "hommes femmes", "noirs blancs", "homosexuels lesbiennes", "hombres mujeres", "negros blancos", "homosexuales lesbianas")),
    "christians muslims jews hindus buddhists atheists".split(),
    "christian muslim jewish hindu buddhist atheist".split(),
    "black white asian latino arab african european american".split(),
    "gay lesbian bisexual straight transgender heterosexual".split(),
    "immigrants refugees foreigners natives".split(),
    "disabled deaf blind".split(),
    *(words.split() for words in ("christen muslime juden", "chrétiens musulmans juifs", "cristianos musulmanes judíos", "ausländer einheimische", "étrangers locaux", "extranjeros locales")),
]
_OTHER = {w: g[(k + 1) % len(g)] for g in GROUPS for k, w in enumerate(g)}
_MENTION = re.compile(r"\b(?:" + "|".join(sorted(_OTHER, key=len, reverse=True)) + r")\b", re.I)


def counterfactual(text: str) -> str | None:
    """The text with each mention of a group swapped for the next group of its kind; None without any."""
    swapped, n = _MENTION.subn(lambda m: _OTHER[m[0].lower()], text)
    return swapped if n else None


def row_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the words and their beginnings, in row order, repeats included."""
    words = Words(column, ALNUM)
    body, _ = utf8(column)
    low, n = LOWER[body].astype(U64) + U64(1), words.end - words.start
    rows, features = [words.row], [words.hash >> U64(64 - BITS)]
    part, done = np.zeros(len(n), dtype=U64), 0
    for size in BEGINNINGS:
        longer = np.flatnonzero(n > size)
        for k in range(done, size):
            has = np.flatnonzero(n > k)
            part[has] = part[has] * U64(0x100000001B3) + low[words.start[has] + k]
        done = size
        rows.append(words.row[longer])
        features.append(mix(part[longer] + U64(size)) >> U64(64 - BITS))
    return np.concatenate(rows), np.concatenate(features).astype(np.int64)


@dataclass
class Model:
    """Weights of the fitted features and the bias. Scores are sigmoids."""

    feature: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, dtype=np.float32)
        out[self.feature] = self.weight
        return out

    def scores(self, column: pa.Array, dense: np.ndarray) -> np.ndarray:
        row, feature = row_features(column)
        telling = dense[feature] != 0
        pair = np.unique(row[telling] << BITS | feature[telling])
        total = np.bincount(pair >> BITS, dense[pair & ((1 << BITS) - 1)], minlength=len(column))
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -30, 30)))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed distinct features of each row, and of its counterfactual or null."""

    def packed(column: pa.Array) -> list[bytes]:
        row, feature = row_features(column)
        pair = np.unique(row << BITS | feature)
        cut = np.searchsorted(pair >> BITS, np.arange(len(column) + 1))
        ids = (pair & ((1 << BITS) - 1)).astype("<u4")
        return [ids[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]

    for batch in batches:
        for part in pieces(batch, "text"):
            swapped = [counterfactual(t.as_py() or "") for t in part.column("text")]
            own = packed(part.column("text"))
            other = packed(pa.array([s or "" for s in swapped], pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array([o if s is not None else None for o, s in zip(other, swapped)], pa.binary()), part.column("label")], names=["own", "other", "label"])


def fit(rows: list[tuple[bytes, bytes | None, int]]) -> Model:
    """A model of (features, counterfactual's features or None, label 0/1) rows."""
    y = np.array([r[2] for r in rows], dtype=np.float64)
    if not len(rows) or y.min() == y.max():
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0 if not len(rows) else (-3.0 if y[0] == 0 else 3.0))

    def pairs(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        each = [np.frombuffer(p, dtype="<u4") for p in packed]
        return np.repeat(np.arange(len(each)), [len(e) for e in each]), np.concatenate(each).astype(np.int64)

    row, feature = pairs([r[0] for r in rows])
    n1, n0 = y.sum(), len(y) - y.sum()
    with1 = np.bincount(feature, y[row], minlength=1 << BITS)
    with0 = np.bincount(feature, 1 - y[row], minlength=1 << BITS)
    p1, p0 = (with1 + 0.5) / (n1 + 1), (with0 + 0.5) / (n0 + 1)
    telling = np.abs(p1 - p0) / np.sqrt(p1 * (1 - p1) / n1 + p0 * (1 - p0) / n0)
    telling[with1 + with0 < LEAST_ROWS] = 0
    chosen = np.sort(np.argsort(-telling, kind="stable")[:SELECTED])
    chosen = chosen[telling[chosen] > 3]
    if not len(chosen):
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(n1 / n0)))
    index = np.full(1 << BITS, -1, dtype=np.int64)
    index[chosen] = np.arange(len(chosen))

    def narrowed(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        held = index[feature] >= 0
        return row[held], index[feature[held]]

    row, feature = narrowed(row, feature)
    twin = np.array([k for k, r in enumerate(rows) if r[1] is not None], dtype=np.int64)
    other_row, other = narrowed(*pairs([rows[k][1] for k in twin])) if len(twin) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    w, bias = np.zeros(len(chosen)), float(np.log(n1 / n0))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, ROUNDS + 1):  # Adam over all rows
        z = np.bincount(row, w[feature], minlength=len(y)) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        g = p - y
        if len(twin):
            zo = np.bincount(other_row, w[other], minlength=len(twin)) + bias
            po = 1 / (1 + np.exp(-np.clip(zo, -30, 30)))
            gap = 2 * COUNTERFACTUAL * (p[twin] - po)
            np.add.at(g, twin, gap * p[twin] * (1 - p[twin]))
            go = -gap * po * (1 - po)
        grad = np.bincount(feature, g[row], minlength=len(w)) / len(y) + RIDGE * w
        if len(twin):
            grad += np.bincount(other, go[other_row], minlength=len(w)) / len(y)
        gb = g.mean() + (go.sum() / len(y) if len(twin) else 0.0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        rate = 0.05 / (1 + step / 100)
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
    w[np.abs(w) < 1e-3] = 0
    return Model(chosen, w, float(bias))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a row's label is never learned from: crc32 of its id as text, modulo 5, is 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.encode(column.cast("string"), "UTF-8")) % 5 == 0


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of the labelled documents that are not held out; `sample` rows at most.

    Only the text is a feature. Labels that are null or not 0 or 1 are left out; a document with
    several labels counts once with each.
    """
    known = labels.where("toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    known = known.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    packed = in_arrow(rows.select("text", "label"), _sampled, "own binary, other binary, label int")
    rows = packed.orderBy(F.xxhash64("own"), "label").limit(2 * sample).collect()
    return fit([(bytes(r["own"]), None if r["other"] is None else bytes(r["other"]), r["label"]) for r in rows])


def _scorer(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        dense = model.dense()
        for batch in batches:
            for part in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(model.scores(part.column("text"), dense), pa.float64())], names=["row", "score"])

    return run


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs -> (row: all columns of docs, score from 0 to 1). Null and empty texts get the model's bias."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([held.schema["row"], T.StructField("score", T.DoubleType())]).simpleString()
    return in_arrow(held, _scorer(shared), schema[len("struct<") : -1])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 where score >= 0.5). Repeated rows score alike; a null
    doc_id is not held out; without usable labels every score is 0.5."""
    model = trained(docs, labels)
    out = scored(docs.select("doc_id", "text"), model).select("row.doc_id", "score")
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with their own columns, that score below 0.5."""
    return scored(docs, trained(docs, labels)).where("score < 0.5").select("row.*")
