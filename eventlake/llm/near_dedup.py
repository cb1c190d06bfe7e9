"""Near-duplicate documents by a chosen-path set similarity join over minwise tokens.

Every document is the set of its distinct five-word shingles. Equal sets are one element first, so
groups of copies cost one row. Each independent tree then branches its nodes by chosen minwise
tokens: all sets of a node that share the chosen token stay together in a child. A node of few sets
is compared exhaustively; one of many sets is split into chunks that each meet the node's hub, sets
very like the hub leave the recursion (their links run through it), and the rest branches on. Sets of
crowded nodes are also grouped by the tokens that few of them share. Links
are confirmed on the full shingle sets, and linked sets form components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm._common import SPACED, U64, Words, cut, in_arrow, mix, pieces, window_hashes
from eventlake.llm.components import components

SHINGLE = 5
SIMILARITY = 75  # per cent
COORDINATES = 64  # minwise values kept of each set
TREES = 9
EARLY = 3  # trees whose groups are confirmed first; of the others only what may join components
NODE, LARGEST_NODE = 24, 256  # sets of a node that are compared exhaustively: at the root, and below as it doubles
BROADCAST_HUBS = 50_000  # hubs of a level up to which they are broadcast; more are shuffled
CHUNK = 16  # sets of a chunk of a larger node
PLAUSIBLE = 0.55  # estimated similarity from which a pair is worth the exact check
VERY_LIKE = 0.9  # estimated similarity to the hub from which a set leaves the recursion; its chunk still meets it
DEPTH = 24

_MULTIPLIERS = mix(np.arange(1, COORDINATES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def shingle_sets(column: pa.Array, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row. Fewer words than `width`: one shingle of all."""
    words = Words(column, SPACED)
    for k in range(len(column)):
        own = words.hash[words.first[k] : words.first[k + 1]]
        yield np.unique(window_hashes(own, min(width, len(own)))) if len(own) else own


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text"):
            n, h1, h2, signature = [], [], [], []
            for s in shingle_sets(part.column("text")):
                n.append(len(s))
                h1.append(s.sum(dtype=U64))
                h2.append(mix(s ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64))
                low = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=U64)
                for at in range(0, len(s), 4096):
                    np.minimum(low, np.multiply.outer(_MULTIPLIERS, s[at : at + 4096]).min(axis=1), out=low)
                signature.append((low >> U64(32)).astype(np.uint32).view(np.int32))
            flat = pa.array(np.concatenate(signature), pa.int32())
            at = pa.array(np.arange(0, len(n) * COORDINATES + 1, COORDINATES, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(np.array(h1, dtype=U64).view(np.int64)), pa.array(np.array(h2, dtype=U64).view(np.int64)), pa.ListArray.from_arrays(at, flat)],
                names=["doc_id", "n_shingles", "h1", "h2", "sig"],
            )


def _child(node: F.Column, coordinate: F.Column) -> F.Column:
    return F.xxhash64(node, coordinate, F.element_at("sig", (coordinate + 1).cast("int")))


def _roots() -> list[tuple[int, int]]:
    """(tree, coordinate): each tree chooses 4/3 coordinates on average, all of them different."""
    chosen, at = [], 0
    for tree in range(TREES):
        for _ in range(2 if tree % 3 == 0 else 1):
            chosen.append((tree, (at * 29 + 7) % COORDINATES))
            at += 1
    return chosen


def _agreement(a: str, b: str) -> F.Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(COORDINATES))


def candidate_groups(sets: DataFrame) -> DataFrame:
    """sets(rep, sig) -> (members, early): sorted ids of few sets that may hold links, each group once;
    early where one of the first trees has it."""
    small, level = [], None
    for tree, coordinate in _roots():
        part = (F.lit(tree).alias("tree"), F.lit(coordinate).alias("coordinate"))
        level = [*level, F.struct(*part)] if level else [F.struct(*part)]
    level = sets.select("rep", "sig", F.explode(F.array(*level)).alias("c"))
    level = level.select("rep", _child(F.col("c.tree").cast("long"), F.col("c.coordinate").cast("long")).alias("node"), (F.col("c.tree") < EARLY).alias("early"))
    for depth in range(DEPTH + 1):
        few = min(NODE << depth, LARGEST_NODE)
        sizes = level.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        level = cut(level.join(sizes, "node"), "path")
        small.append(level.where(F.col("n") <= few).select(F.col("node").alias("gid"), "rep", "early"))
        crowd = level.where(F.col("n") > few)
        if crowd.isEmpty():
            break
        crowd = crowd.join(sets, "rep")
        if depth == 0:
            small.append(rare_tokens(crowd.select("rep", "sig").dropDuplicates(["rep"])))
        hubs = crowd.groupBy("node").agg(F.min_by(F.struct("rep", "sig"), F.xxhash64("rep", "node")).alias("hub"))
        hubs = cut(hubs, "hubs")
        if hubs.count() <= BROADCAST_HUBS:  # else a crowded node would meet its hub in one task
            hubs = F.broadcast(hubs)
        chunk = F.xxhash64("node", F.lit(depth), F.pmod(F.xxhash64("rep", "node", F.lit(1)), F.ceil(F.col("n") / CHUNK)))
        crowd = crowd.join(hubs, "node").withColumn("like", _agreement("sig", "hub.sig"))
        first = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(COORDINATES))
        second = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(COORDINATES))
        chosen = F.when(F.pmod(F.xxhash64("node", F.lit(4)), F.lit(3)) == 0, F.array(first, second)).otherwise(F.array(first))
        crowd = cut(
            crowd.select("rep", "early", F.col("hub.rep").alias("hub"), "like", chunk.alias("gid"), F.transform(F.array_distinct(chosen), lambda c: _child(F.col("node"), c)).alias("children")),
            "crowd",
        )
        # The last level chunks everything that is left; above it only what may be linked to the hub.
        linked = crowd if depth == DEPTH else crowd.where((F.col("like") >= PLAUSIBLE) & (F.col("rep") != F.col("hub")))
        small.append(linked.select("gid", "rep", "early"))
        small.append(linked.select("gid", F.col("hub").alias("rep"), "early").distinct())
        level = crowd.where((F.col("like") < VERY_LIKE) | (F.col("rep") == F.col("hub"))).select("rep", F.explode("children").alias("node"), "early")
    rows = small[0]
    for more in small[1:]:
        rows = rows.unionByName(more)
    grouped = rows.join(sets, "rep").groupBy("gid").agg(F.collect_list(F.struct("rep", "sig")).alias("m"), F.bool_or("early").alias("early"))
    plausible = in_arrow(grouped.select("m", "early"), _plausible, "members array<bigint>, early boolean")
    return plausible.groupBy("members").agg(F.bool_or("early").alias("early"))


def rare_tokens(crowd: DataFrame) -> DataFrame:
    """(gid, rep, early) of the sets of crowded nodes that share a minwise token which few of them have.

    In a large family of sets that resemble each other below the threshold, most share the tokens of the
    family, and the hub and chunk rules may part a pair that is more alike. Such a pair shares tokens of its own: where
    pairs of the family agree in a share f of the coordinates and it in a share j, one of the 64 tokens is its own but
    for about (1 - (j - f)) ** 64. Groups hold LARGEST_NODE sets at most; tokens of more are the family's, which the
    recursion branches on.
    """
    token = crowd.select("rep", F.posexplode("sig").alias("at", "token")).select("rep", F.xxhash64(F.lit(-1), "at", "token").alias("gid"))
    few = token.groupBy("gid").agg(F.count("*").alias("n")).where(F.col("n").between(2, LARGEST_NODE))
    return token.join(few, "gid").select("gid", "rep", F.lit(False).alias("early"))


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each group the members that agree with another member in enough minwise values."""
    for batch in batches:
        out, early = [], []
        for group, first in zip(batch.column("m"), batch.column("early")):
            rows = group.values
            reps = rows.field("rep").to_numpy()
            if len(reps) < 2:
                continue
            sig = rows.field("sig").flatten().to_numpy().reshape(len(reps), COORDINATES)
            near = np.zeros(len(reps), dtype=bool)
            for k in range(len(reps)):
                like = (sig == sig[k]).mean(axis=1) >= PLAUSIBLE
                like[reps == reps[k]] = False
                near |= like
                near[k] |= like.any()
            if near.any():
                out.append(np.unique(reps[near]))
                early.append(first.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int64())), pa.array(early, pa.bool_())], names=["members", "early"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text"):
            held = [s.tobytes() for s in shingle_sets(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(held, pa.binary())], names=["rep", "members"])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of each group's links, confirmed on the full sets."""
    for batch in batches:
        a, b = [], []
        for group in batch.column("m"):
            rows = group.values
            reps = rows.field("rep").to_numpy()
            sets = [np.frombuffer(x.as_buffer(), dtype=U64) for x in rows.field("members")]
            tree = list(range(len(reps)))

            def top(k: int, tree: list[int] = tree) -> int:
                while tree[k] != k:
                    tree[k] = tree[tree[k]]
                    k = tree[k]
                return k

            for i in range(len(reps)):
                for j in range(i + 1, len(reps)):
                    x, y = (sets[i], sets[j]) if len(sets[i]) <= len(sets[j]) else (sets[j], sets[i])
                    if 100 * len(x) < SIMILARITY * len(y) or top(i) == top(j):
                        continue
                    at = np.searchsorted(y, x)
                    at[at == len(y)] = 0
                    common = int((y[at] == x).sum())
                    if 100 * common >= SIMILARITY * (len(x) + len(y) - common):
                        tree[top(i)] = top(j)
                        a.append(reps[i])
                        b.append(reps[j])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def full_sets(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """(rep, members): the whole shingle sets of the documents in groups, written once.

    The ids grow with the input, so the join is a shuffle at every size.
    """
    ids = groups.select(F.explode("members").alias("doc_id")).distinct()
    wanted = docs.join(ids.hint("shuffle_hash"), "doc_id", "left_semi")
    return cut(in_arrow(wanted, _sets, "rep bigint, members binary").dropDuplicates(["rep"]), "full-sets")


def confirmed(full: DataFrame, groups: DataFrame) -> DataFrame:
    """groups(gid, members) -> (a, b): links that span what is linked in each group, on the full sets."""
    member = groups.select("gid", F.explode("members").alias("rep"))
    together = member.join(full, "rep").groupBy("gid").agg(F.collect_list(F.struct("rep", "members")).alias("m"))
    return in_arrow(together.select("m"), _links, "a bigint, b bigint")


def _linked(docs: DataFrame, same: DataFrame | None) -> DataFrame:
    """docs(doc_id, text) whose ids, but for nulls, are distinct -> doc_id, n_shingles, component.

    same(a, b), if any, are more links.
    """
    seen = cut(in_arrow(docs, _features, "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, sig array<int>"), "sets")
    real = seen.where("n_shingles > 0 and doc_id is not null")
    rep = cut(real.groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("rep")), "reps")
    sets = real.join(rep, ["h1", "h2", "n_shingles"]).where("doc_id = rep").select("rep", "sig")
    sets = cut(sets, "reps-sig")
    groups = cut(candidate_groups(sets).select(F.xxhash64("members").alias("gid"), "members", "early"), "groups")
    full = full_sets(docs, groups)
    links = cut(confirmed(full, groups.where("early")), "links")
    known = components(links)
    # A later group inside one component has no link that would change it.
    late = groups.where("not early").select("gid", F.explode("members").alias("id"))
    late = late.join(known, "id", "left").groupBy("gid").agg(F.countDistinct(F.coalesce("component", "id")).alias("n")).where("n > 1")
    more = confirmed(full, groups.join(late.select("gid"), "gid", "left_semi"))
    links = links.unionByName(more)
    if same is not None:
        of = real.select("doc_id", "h1", "h2", "n_shingles").join(rep, ["h1", "h2", "n_shingles"]).select("doc_id", "rep")
        at = lambda c: of.select(F.col("doc_id").alias(c), F.col("rep").alias(f"{c}_rep"))
        named = same.join(at("a"), "a", "left").join(at("b"), "b", "left")
        links = links.unionByName(named.select(F.coalesce("a_rep", "a").alias("a"), F.coalesce("b_rep", "b").alias("b")))
    found = components(links).withColumnRenamed("id", "key").withColumnRenamed("component", "found")
    out = seen.select("doc_id", "n_shingles", "h1", "h2").join(rep, ["h1", "h2", "n_shingles"], "left").withColumn("key", F.coalesce("rep", "doc_id")).join(found, "key", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("found", "key").alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_shingles, component_id, kept.

    Documents link when 100 * |A and B| >= 75 * |A or B| of their shingle sets; a component is named
    by its smallest doc_id. Null and empty texts, and texts of white space, have no shingles and are
    alone. Rows with a null doc_id link with nothing: component_id is null and kept is true. Rows
    that repeat a doc_id are one document: their component is that of all their texts together. Other
    columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        out = _linked(docs, None).select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))
    else:
        # Each text of an id is an element of its own; those of one id are linked, and an element's name
        # gives way to the smallest id of its component.
        row = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
        rows = cut(docs.select("doc_id", row.alias("row"), "text"), "rows")
        first = rows.where("row is not null").groupBy("doc_id").agg(F.min("row").alias("a"))
        same = rows.where("row is not null").select("doc_id", F.col("row").alias("b")).distinct().join(first, "doc_id").where("a <> b").select("a", "b")
        elements = rows.select(F.col("row").alias("doc_id"), "text").dropDuplicates(["doc_id"])
        linked = cut(_linked(elements, same).select(F.col("doc_id").alias("row"), "n_shingles", "component"), "elements")
        own = rows.select("doc_id", "row").where("row is not null").join(linked, "row")
        least = own.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        out = own.join(least, "component").select("doc_id", "n_shingles", "component_id")
        bare = in_arrow(rows.where("row is null").select("doc_id", "text"), _features, "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, sig array<int>")
        out = out.unionByName(bare.select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
