"""Document fingerprints: a Merkle tree over paragraphs and sections, in built-in functions only.

Leaves are sentences, in pieces of at most 64 characters, so the leaves in order are the text. A paragraph
is a line. A section ends after a paragraph whose hash begins with one of the first four hexadecimal
digits, so an inserted paragraph moves no other boundary. Every inner node hashes its children's hashes;
equal texts, and only they, have equal roots. Two trees are compared from the root down: equal branches
are passed over, and only differing ones are looked into.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 256  # rows that are put in order together, on average
CELLS = 4096  # quantiles of the ids that are known to every task at most
BROADCAST_BUCKETS = 1_000_000  # buckets up to which the keys of their first rows are broadcast; more are shuffled
_LEAF = r"(?s).{0,62}?[.!?] |.{1,64}"
_PARAGRAPH = r"(?<=\n)"
NODE, PIECE = 8, 6  # hexadecimal digits that a fingerprint keeps of sections and paragraphs, and of leaves


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def merkle_tree(text: Column) -> Column:
    """The paragraphs in order: hash, and leaves (the first digits of each, joined by dots)."""
    hashed = F.transform(
        F.transform(F.split(text, _PARAGRAPH), lambda p: F.transform(F.regexp_extract_all(p, F.lit(_LEAF), F.lit(0)), lambda s: F.sha2(s, 256))),
        lambda h: F.struct(F.sha2(F.array_join(h, ""), 256).alias("hash"), F.array_join(F.transform(h, lambda x: F.substring(x, 1, PIECE)), ".").alias("leaves")),
    )
    return F.when(text == "", F.array().cast("array<struct<hash:string,leaves:string>>")).otherwise(hashed)


def fingerprint(tree: Column) -> Column:
    """root:sections. A section is its hash, "=" and its paragraphs; ";" stands between sections. A paragraph
    is its hash, "-", its leaves with "." between them, and ","."""
    end = lambda p: F.when(F.substring(p["hash"], 1, 1) < "4", ";").otherwise("")
    written = lambda part: F.split(F.array_join(F.transform(tree, lambda p: F.concat(part(p), F.lit(","), end(p))), ""), ";")
    whole = F.transform(written(lambda p: p["hash"]), lambda s: F.sha2(s, 256))
    short = written(lambda p: F.concat(F.substring(p["hash"], 1, NODE), F.lit("-"), p["leaves"]))
    sections = F.zip_with(whole, short, lambda h, s: F.concat(F.substring(h, 1, NODE), F.lit("="), s))
    return F.concat(F.sha2(F.array_join(whole, ""), 256), F.lit(":"), F.array_join(sections, ";"))


def _root(print_: Column) -> Column:
    return F.substring(print_, 1, 64)


def sections(print_: Column) -> Column:
    return F.split(F.substring(print_, F.lit(66), F.length(print_)), ";")


def paragraphs(sections_: Column) -> Column:
    """The paragraphs of some sections, in order."""
    body = F.array_join(F.transform(sections_, lambda s: F.substring(s, F.lit(NODE + 2), F.length(s))), "")
    return F.array_remove(F.split(body, ","), "")


def leaves(paragraphs_: Column) -> Column:
    """The leaves of some paragraphs, in order."""
    body = F.array_join(F.transform(paragraphs_, lambda p: F.substring(p, F.lit(NODE + 2), F.length(p))), ".")
    return F.array_remove(F.split(body, r"\."), "")


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: of two fingerprints' leaves the share that lies in equal branches (1 for equal roots).

    Sections are compared first, the paragraphs of differing sections next, the leaves of differing
    paragraphs last; branches that repeat count once.
    """
    both = lambda x, y, of: F.struct(F.array_intersect(x, y).alias("same"), of(F.array_except(x, y)).alias("x"), of(F.array_except(y, x)).alias("y"))
    count = lambda s, p: F.size(leaves(paragraphs(s))) + F.size(leaves(p))
    share = lambda same, n: F.coalesce(F.try_divide(2.0 * same, n), F.lit(0.0))
    by_leaves = lambda n, x, y: _let(F.struct(n.alias("n"), F.array_distinct(leaves(x)).alias("x"), F.array_distinct(leaves(y)).alias("y")), lambda t: share(t["n"] + F.size(F.array_intersect(t["x"], t["y"])), 2 * t["n"] + F.size(t["x"]) + F.size(t["y"])))
    differing = _let(both(sections(a), sections(b), paragraphs), lambda s: _let(both(s["x"], s["y"], lambda c: c), lambda p: by_leaves(count(s["same"], p["same"]), p["x"], p["y"])))
    return F.when(_root(a) == _root(b), 1.0).otherwise(differing)


def edited_range(a: Column, b: Column) -> Column:
    """(first, end): the 0-based paragraphs of b that differ from a's, from the first to the last of them;
    equal ends where b only lost paragraphs, and null for equal roots."""
    alike = lambda x, y: F.coalesce(F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False) - 1, F.lit(0))
    found = _let(
        F.struct(paragraphs(sections(a)).alias("x"), paragraphs(sections(b)).alias("y")),
        lambda s: _let(
            F.struct(alike(s["x"], s["y"]).alias("front"), alike(F.reverse(s["x"]), F.reverse(s["y"])).alias("back"), F.least(F.size(s["x"]), F.size(s["y"])).alias("least"), F.size(s["y"]).alias("n")),
            lambda t: F.struct(t["front"].cast("int").alias("first"), (t["n"] - F.least(t["back"], t["least"] - t["front"])).cast("int").alias("end")),
        ),
    )
    return F.when(_root(a) != _root(b), found)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs -> doc_id, text, fingerprint. Null texts count as empty; the empty text has no leaves."""
    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return _printed(body)


def _printed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("tree", merkle_tree(F.col("text"))).withColumn("fingerprint", fingerprint(F.col("tree"))).drop("tree")


def _bucketed(docs: DataFrame) -> tuple[DataFrame, int]:
    """docs with bucket, which follows the order of doc_id and h and holds few rows, and the number of rows.

    Quantiles of the ids (CELLS at most) bound the cells, so outliers and gaps move nothing; within
    a cell, rows are dealt by their distance from its start. An id of many rows has cells of its own,
    which are dealt by h. Null ids are the first bucket.
    """
    n = docs.count()
    cells = max(1, min(CELLS, n // BUCKET_ROWS))
    marks = docs.agg(F.percentile_approx("doc_id", [k / cells for k in range(cells)], 10 * CELLS)).first()[0] or [0]
    twice = {a for a, b in zip(marks, marks[1:]) if a == b}
    marks = sorted({*marks, *(a + 1 for a in twice if a < (1 << 63) - 1)})
    parts = max(1, n // (BUCKET_ROWS * cells))
    table = F.split(F.lit(",".join(map(str, marks))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(marks).bit_length()))])
    cell = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.coalesce(F.get(table, at + step) <= F.col("doc_id"), F.lit(False)), at + step).otherwise(at))
    found = docs.withColumns({"h": F.xxhash64("text"), "cell": cell})
    low, high = F.get(table, F.col("cell")).cast("double"), F.get(table, F.col("cell") + 1).cast("double")
    own = F.col("h").cast("double") / F.lit(2.0**64) + 0.5
    along = F.when(high - low <= 1, own).otherwise((F.col("doc_id").cast("double") - low) / (F.coalesce(high, F.lit(2.0**63)) - low))
    part = F.greatest(F.lit(0), F.least(F.lit(parts - 1), F.floor(along * parts))).cast("long")
    bucket = F.when(F.col("doc_id").isNull(), F.lit(-1).cast("long")).otherwise(F.col("cell").cast("long") * parts + part)
    return found.withColumn("bucket", bucket).drop("cell"), n


def with_next(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, text, fingerprint, next_text, next_print: the next row by doc_id, then a
    hash of the text; after the last the first. A null doc_id comes first.

    Rows are dealt to buckets of the id's order and led inside them: one shuffle of the texts. Only the
    first row of each bucket crosses to its neighbour; the buckets are ordered in two levels, so no
    task sees all of them.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt, n = _bucketed(docs)
    firsts = dealt.groupBy("bucket").agg(F.min(F.struct("doc_id", "h")).alias("k")).withColumn("upper", F.floor(F.col("bucket") / 4096))
    uppers = firsts.groupBy("upper").agg(F.min("bucket").alias("first"))
    uppers = uppers.select("upper", F.lead("first").over(Window.orderBy("upper")).alias("later"), F.min("first").over(Window.partitionBy()).alias("wrap"))
    after = firsts.select("bucket", "upper", F.lead("bucket").over(Window.partitionBy("upper").orderBy("bucket")).alias("near")).join(uppers, "upper")
    after = after.select(F.col("bucket").alias("previous"), F.coalesce("near", "later", "wrap").alias("bucket"))
    keys = firsts.join(after, "bucket").select("bucket", "previous", F.col("k.doc_id").alias("first_id"), F.col("k.h").alias("h"))
    if n // BUCKET_ROWS <= BROADCAST_BUCKETS:
        keys = F.broadcast(keys)
    crossing = dealt.join(keys, ["bucket", "h"]).where(F.col("doc_id").eqNullSafe(F.col("first_id"))).select("previous", "text").dropDuplicates(["previous"])
    crossing = _printed(crossing).select(F.col("previous").alias("bucket"), F.struct("text", "fingerprint").alias("crossing"))
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").asc_nulls_first(), "h")
    led = _printed(dealt).select("*", F.lead(F.struct("text", "fingerprint")).over(order).alias("inner"))
    led = led.join(crossing, "bucket", "left").withColumn("next", F.coalesce("inner", "crossing"))
    return led.select("doc_id", "text", "fingerprint", F.col("next.text").alias("next_text"), F.col("next.fingerprint").alias("next_print"))
