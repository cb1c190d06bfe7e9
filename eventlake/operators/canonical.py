"""Canonical chains: structural checks, reorgs, surviving blocks, ancestors and bounded retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.intervals import dyadic
from eventlake.operators import scans

BLOCK = ["number", "hash", "parent_hash", "timestamp"]
HEIGHTS = 1 << 13  # of a bucket that arrivals are dealt by
BUCKET, BUCKETS_DEPTH = 64, 16  # heights that a window looks at together: so many at least, and so many times its depth


def by_chain(order: str, chain: list[str] | None = None) -> Window:
    return Window.partitionBy(*(chain or [])).orderBy(order)


def same_block(a: str, b: str) -> Column:
    """Null-safe equality of all four fields of two block structs."""
    out = F.lit(True)
    for f in BLOCK:
        out = out & F.col(f"{a}.{f}").eqNullSafe(F.col(f"{b}.{f}"))
    return out


def link_violations(blocks: DataFrame, page: Column, allow_gaps: bool = False) -> DataFrame:
    """(rule, number): heights that do not ascend by one, and parents that are not the block before.

    The previous block is joined by height, so no window spans the chain.
    """
    before = blocks.select((F.col("number") + 1).alias("number"), F.col("hash").alias("before"))
    low = blocks.agg(F.min("number").alias("low"))
    joined = blocks.join(before, "number", "left").join(F.broadcast(low))
    gap = F.col("before").isNull() & (F.col("number") > F.col("low"))
    bent = F.col("before").isNotNull() & (F.col("before") != F.col("parent_hash"))
    rules = F.array_compact(F.array(F.when(gap & F.lit(not allow_gaps), F.lit("gap")), F.when(bent, F.lit("parent"))))
    return joined.select(F.explode(rules).alias("rule"), "number")


def parts_of(arrivals: DataFrame, copies: int = 1, size: int = scans.SEGMENT_ROWS) -> int:
    """Partitions for `size` rows each, of which `copies` are made of each arrival after they are dealt."""
    return max(1, -(-arrivals.count() * copies // size))


def by_height(rows: DataFrame, parts: int) -> DataFrame:
    """Rows with bucket, dealt by it: runs of HEIGHTS heights. What is exploded only afterwards stays dealt, and was shuffled once."""
    return rows.withColumn("bucket", F.floor(F.col("number") / HEIGHTS)).repartition(parts, "bucket")


def surviving(arrivals: DataFrame, chain: list[str]) -> DataFrame:
    """Arrivals of by_height() with survives: whether canonical_chain() keeps them, as none at or below their height arrived later.

    Windows run by chain and bucket, where the rows are; of each bucket the last arrival is carried to those above it, a row each.
    """
    own = [*chain, "bucket"]
    below = Window.partitionBy(*chain).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    last = arrivals.groupBy(*own).agg(F.max("arrival").alias("last")).select(*own, F.max("last").over(below).alias("below"))
    upto = Window.partitionBy(*own).orderBy("number")  # and what has the same number
    a = arrivals.withColumn("latest", F.max("arrival").over(upto)).join(F.broadcast(last), own)
    return a.select(*arrivals.columns, (F.col("arrival") == F.greatest("latest", "below")).alias("survives"))


def reorg_blocks(reorgs: DataFrame, arrivals: DataFrame, chain: list[str], parts: int) -> DataFrame:
    """Chain, arrival and the blocks (structs of BLOCK) anc, old and new of each reorg: the surviving ancestor, the old tip and the
    ancestor's surviving direct child. A reorg of which one is not there is left out.

    Arrivals are those of surviving(), over `parts` partitions: they stay where they are, and the reorgs' heights come to them.
    """
    c = F.col
    here = [*chain, "bucket", "number"]
    hash_, null = arrivals.schema["hash"].dataType, F.lit(None)
    ask = lambda role, number, asked: F.struct(F.lit(role).alias("role"), number.alias("number"), asked.cast(hash_).alias("hash"))
    three = F.array(ask("anc", c("ancestor"), null), ask("old", c("old_tip"), c("old_tip_hash")), ask("new", c("ancestor") + 1, null))
    asked = by_height(reorgs.select(*chain, "arrival", F.explode(three).alias("a")).select(*chain, "arrival", "a.*"), parts)
    block, key = F.struct(*BLOCK), [*here, "hash"]
    # A union of rows that are dealt alike stays dealt; a join would shuffle both sides by all of its keys.
    rows = arrivals.select(*key, null.cast("string").alias("role"), null.cast("long").alias("at"), block.alias("block"), F.when(c("survives"), block).alias("kept"))
    gap = null.cast(rows.schema["block"].dataType)
    rows = rows.unionByName(asked.select(*key, "role", c("arrival").alias("at"), gap.alias("block"), gap.alias("kept")))
    rows = rows.withColumns({"same": F.max("block").over(Window.partitionBy(*key)), "kept": F.max("kept").over(Window.partitionBy(*here))})
    found = rows.where("role is not null").select(*chain, "at", "role", F.when(c("role") == "old", c("same")).otherwise(c("kept")).alias("b"))
    of = lambda role: F.max(F.when(c("role") == role, c("b"))).alias(role)
    return found.groupBy(*chain, c("at").alias("arrival")).agg(of("anc"), of("old"), of("new")).where("anc is not null and old is not null and new is not null")


def reorg_events(arrivals: DataFrame, chain: list[str], size: int | None = scans.SEGMENT_ROWS) -> DataFrame:
    """Arrivals at or below the tip with another hash: ancestor, old tip and the new tip of the branch.

    Without a size they have a `segment`, ascending ranges of arrivals that they are dealt by (scans.dealt), and are not shuffled again.

    Redeliveries of the current block are assumed to be removed. Windows run by chain and segment of arrivals, so no
    task holds a chain. Of a segment its first and last block, the top of its rows before its first branch and whether it has one are
    carried: a row each.
    """
    c = F.col
    own = [*chain, "segment"]
    w = Window.partitionBy(*own).orderBy("arrival")
    narrow = [*chain, "arrival", "number", "hash"]
    a = arrivals.select(*narrow, "segment") if size is None else scans.dealt(arrivals.select(*narrow), chain, "arrival", size)
    a = a.select("*", F.lag("number").over(w).alias("tip"), F.lag("hash").over(w).alias("tip_hash"))
    starts = F.coalesce((c("tip") >= c("number")) & (c("tip_hash") != c("hash")), F.lit(False))
    a = a.withColumn("branch", F.sum(starts.cast("int")).over(w))
    block = F.struct("number", "hash")
    g = a.groupBy(*own, "branch").agg(F.min_by(F.struct("arrival", "number", "hash", "tip", "tip_hash"), "arrival").alias("first"), F.max_by(block, "arrival").alias("last"), F.max("number").alias("top"))
    edges = g.groupBy(*own).agg(F.min_by("first", "branch").alias("first"), F.max_by("last", "branch").alias("last"), F.min_by("top", "branch").alias("top"), F.max("branch").alias("branches"))
    along = Window.partitionBy(*chain).orderBy("segment")
    e = edges.withColumn("before", F.lag("last").over(along))
    e = e.withColumn("starts", F.coalesce((c("before.number") >= c("first.number")) & (c("before.hash") != c("first.hash")), F.lit(False)))
    # A branch goes on through segments without a branch of their own, and the head of the next that has one.
    e = e.withColumn("run", F.coalesce(F.sum((c("starts") | (c("branches") > 0)).cast("int")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    goes_on = e.groupBy(*chain, "run").agg(F.max(F.when(~c("starts"), c("top"))).alias("more")).withColumn("run", c("run") - 1)
    e = e.select(*own, "branches", "starts", "before", "run").join(F.broadcast(goes_on), [*chain, "run"], "left")
    g = g.join(F.broadcast(e), own).where((c("branch") > 0) | c("starts"))
    tip = lambda inside, outside: F.when(c("branch") > 0, c(inside)).otherwise(c(outside))
    new_tip = F.when(c("branch") == c("branches"), F.greatest("top", "more")).otherwise(c("top"))
    return g.select(*chain, c("first.arrival").alias("arrival"), (c("first.number") - 1).alias("ancestor"), tip("first.tip", "before.number").alias("old_tip"), tip("first.tip_hash", "before.hash").alias("old_tip_hash"), new_tip.alias("new_tip"))


def canonical_chain(arrivals: DataFrame, chain: list[str], size: int = scans.SEGMENT_ROWS) -> DataFrame:
    """The surviving block of each height: no later arrival has a height at or below its own.

    Windows run by chain and segment of arrivals; of the segments that follow only the least number is carried.
    """
    own = [*chain, "segment"]
    a = scans.dealt(arrivals, chain, "arrival", size)
    # From the last arrival back: a frame that only grows, so that a segment is one pass.
    back = lambda keys, order: Window.partitionBy(*keys).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, -1)
    least = a.groupBy(*own).agg(F.min("number").alias("least"))
    least = least.select(*own, F.min("least").over(back(chain, "segment")).alias("after"))
    a = a.join(F.broadcast(least), own)  # a row a segment
    a = a.withColumn("later", F.least("after", F.min("number").over(back(own, "arrival"))))
    return a.where(F.col("later").isNull() | (F.col("later") > F.col("number"))).select(*arrivals.columns)


def canonical_chain_segmented(arrivals: DataFrame, chain: list[str], size: int = scans.SEGMENT_ROWS) -> DataFrame:
    """The same where one chain holds most rows: segments of arrivals in tasks of their own, the least number of
    what follows carried between them. Reorgs may reach back any depth."""
    back = scans.scan(arrivals.withColumn("back", -F.col("arrival")), chain, ["back"], scans.Surviving(), size)
    return back.where("survives").select(*arrivals.columns)


def reorg_events_segmented(arrivals: DataFrame, chain: list[str], size: int = scans.SEGMENT_ROWS) -> DataFrame:
    """reorg_events where one chain holds most rows: the tip before a segment and the branches so far are carried."""
    a = scans.scan(arrivals.select(*chain, "arrival", "number", "hash"), chain, ["arrival"], scans.Branches(), size)
    tips = a.groupBy(*chain, "branch").agg(F.max("number").alias("new_tip"))
    return a.where("starts").join(tips, [*chain, "branch"]).select(*chain, "arrival", (F.col("number") - 1).alias("ancestor"), F.col("tip").alias("old_tip"), F.col("tip_hash").alias("old_tip_hash"), "new_tip")


def canonical_chain_bounded(arrivals: DataFrame, chain: list[str], depth: int, size: int = scans.SEGMENT_ROWS) -> DataFrame:
    """The same for one large chain whose reorgs reach at most `depth` back: a window over a bucket of heights instead of the
    whole chain. Only the last `depth` heights of a bucket go to the next one too, so that a row is shuffled once."""
    width = max(BUCKET, BUCKETS_DEPTH * depth)
    number, of = F.col("number"), lambda n: F.floor(n / width)
    a = arrivals.withColumn("bucket", F.explode_outer(F.sequence(of(number), of(number + depth))))
    a = a.repartition(max(1, -(-arrivals.count() // size)), *chain, "bucket")
    lower = Window.partitionBy(*chain, "bucket").orderBy("number").rangeBetween(-depth, 0)
    gone = number.isNotNull() & (F.max("arrival").over(lower) > F.col("arrival"))
    own = F.coalesce(F.col("bucket") == of(number), F.lit(True))
    return a.withColumn("gone", gone).where(own & ~F.coalesce("gone", F.lit(False))).select(*arrivals.columns)


def common_ancestor(retained: DataFrame, observed: DataFrame, chain: list[str]) -> DataFrame:
    """Per chain the highest height whose retained hash is the observed one (null: history exhausted), and
    the number of blocks of equal hash that disagree otherwise. Both sides are as long as the chain, so they are merged."""
    o = observed.select(*chain, "number", *[F.col(c).alias(f"seen_{c}") for c in BLOCK[1:]])
    j = retained.join(o.hint("merge"), [*chain, "number"])
    equal = F.col("hash") == F.col("seen_hash")
    conflict = equal & ~(F.col("parent_hash").eqNullSafe(F.col("seen_parent_hash")) & F.col("timestamp").eqNullSafe(F.col("seen_timestamp")))
    return j.groupBy(*chain).agg(F.max(F.when(equal, F.col("number"))).alias("ancestor"), F.count_if(conflict).alias("conflicts"))


def common_ancestor_by_height(retained: DataFrame, observed: DataFrame, chain: list[str]) -> DataFrame:
    """The same of rows that by_height() has dealt, which are not shuffled again: both sides are counted together, height by height."""
    dealt = ["bucket"]
    side = lambda df, n, m: df.select(*chain, *dealt, *BLOCK, F.lit(n).alias("kept"), F.lit(m).alias("seen"))
    rows = side(retained, 1, 0).unionByName(side(observed, 0, 1)).where(" and ".join(f"`{c}` is not null" for c in [*chain, "number"]))
    height = [*chain, *dealt, "number"]
    both = [F.sum(c).alias(c) for c in ("kept", "seen")]
    alike = rows.groupBy(*height, *BLOCK[1:]).agg(*both)
    pairs = alike.groupBy(*height, "hash").agg(*both, F.sum(F.col("kept") * F.col("seen")).alias("alike")).withColumn("equal", F.when(F.col("hash").isNotNull(), F.col("kept") * F.col("seen")).otherwise(0))
    met = pairs.groupBy(*height).agg(*both, F.sum("equal").alias("equal"), F.sum(F.when(F.col("equal") > 0, F.col("equal") - F.col("alike")).otherwise(0)).alias("conflicts"))
    met = met.where("kept > 0 and seen > 0")
    return met.groupBy(*chain).agg(F.max(F.when(F.col("equal") > 0, F.col("number"))).alias("ancestor"), F.sum("conflicts").alias("conflicts"))


def displaced(rows: DataFrame, reorgs: DataFrame, chain: list[str], number: str = "number", arrival: str = "arrival", size: int = scans.SEGMENT_ROWS) -> DataFrame:
    """Rows of the old branch in (ancestor, old tip] that arrived before the reorg.

    Reorgs become dyadic intervals of heights, of each only the last arrival counts, and each different height is looked
    up once a size of interval in use: the work is linear in rows and reorgs, however deep they reach. Rows and heights are dealt
    over a partition for every `size` rows, so that no sort spills.
    """
    parts = max(1, -(-rows.count() // size))
    cover = reorgs.select(*chain, F.col("arrival").alias("at"), F.explode(dyadic("ancestor + 1", "old_tip + 1")).alias("p"))
    cover = cover.select(*chain, "p.level", "p.part", "at").repartition(parts, *chain, "level", "part").groupBy(*chain, "level", "part").agg(F.max("at").alias("at"))
    levels = F.broadcast(cover.agg(F.collect_set("level").alias("levels")))  # one row
    heights = rows.select(*chain, F.col(number).alias("height")).repartition(parts, *chain, "height").distinct().join(levels).select(*chain, "height", F.explode("levels").alias("level"))
    heights = heights.withColumn("part", F.expr("shiftright(height, level)")).repartition(parts, *chain, "level", "part").join(cover.hint("merge"), [*chain, "level", "part"])
    last = heights.select(*chain, F.col("height").alias(number), "at").repartition(parts, *chain, number).groupBy(*chain, number).agg(F.max("at").alias("at"))
    return rows.repartition(parts, *chain, number).join(last.hint("merge"), [*chain, number]).where(F.col(arrival) < F.col("at")).select(*rows.columns)


def retain_depth(history: DataFrame, depth: int, chain: list[str]) -> DataFrame:
    """The newest `depth` heights of each chain (heights of a chain are contiguous). A row a chain is broadcast, so that no task takes a chain."""
    top = history.groupBy(*chain).agg(F.max("number").alias("top"))
    return history.join(F.broadcast(top), chain).where(F.col("number") > F.col("top") - depth).drop("top")


def retain_recent(witnesses: DataFrame, capacity: int, shard: list[str], touched: str = "last_touch") -> DataFrame:
    """The `capacity` most recently touched entries of each shard."""
    w = Window.partitionBy(*shard).orderBy(F.col(touched).desc())
    return witnesses.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= capacity)


def retain_owner_budget(witnesses: DataFrame, budget: int, shard: list[str], touched: str = "last_touch", owners: str = "n_owners", current: str = "current") -> tuple[DataFrame, DataFrame]:
    """(entries kept, violations): those of the current delivery, then from the newest back, as far as their
    owner counts add up to the budget. A current delivery that is over the budget by itself is a violation."""
    w = Window.partitionBy(*shard).orderBy(F.col(current).desc(), F.col(touched).desc()).rowsBetween(Window.unboundedPreceding, 0)
    kept = witnesses.withColumn("total", F.sum(owners).over(w)).where(F.col(current) | (F.col("total") <= budget))
    own = witnesses.where(F.col(current)).groupBy(*shard).agg(F.sum(owners).alias("total")).where(F.col("total") > budget)
    return kept, own.select(F.lit("current_over_budget").alias("rule"), *shard, "total")


def tip(history: DataFrame, chain: list[str]) -> DataFrame:
    return history.groupBy(*chain).agg(F.max("number").alias("tip"), F.max_by("hash", "number").alias("tip_hash"), F.min("number").alias("oldest"))


def coverage_boundary(coverage: DataFrame, page_blocks: DataFrame) -> DataFrame:
    """(rule, number): the block at the coverage height must be it, and its successor must link to it."""
    at = coverage.select(F.col("head_number").alias("number"), F.col("head_hash").alias("expected"))
    here = page_blocks.join(at, "number").where("hash <> expected").select(F.lit("boundary_hash").alias("rule"), "number")
    after = page_blocks.join(at.withColumn("number", F.col("number") + 1), "number").where("parent_hash <> expected").select(F.lit("successor_parent").alias("rule"), "number")
    return here.unionByName(after)


def page_lineage(pages: DataFrame) -> DataFrame:
    """Pages that suggest a rollback: they start at or below the block after the previous tip and do not link to it."""
    before = pages.select((F.col("page_id") + 1).alias("page_id"), F.col("guard_tip").alias("tip"), F.col("guard_tip_hash").alias("tip_hash"))
    j = pages.join(before, "page_id")
    return j.where((F.col("guard_first") <= F.col("tip") + 1) & (F.col("guard_first_parent") != F.col("tip_hash"))).select("page_id", "guard_first", "tip")


def verify_baselines(owners: DataFrame, blocks: DataFrame) -> DataFrame:
    """owners(owner_id, number, hash, parent_hash, timestamp): (owner_id, rule) of baselines that are not the
    source's block, or that disagree with another owner's."""
    b = blocks.select(F.col("number"), F.struct(*BLOCK).alias("b"))
    o = owners.select("owner_id", "number", F.struct(*BLOCK).alias("o"))
    per = o.groupBy("number").agg(F.count_distinct("o.hash").alias("hashes"))
    j = o.join(b, "number", "left").join(per, "number")
    rules = F.array_compact(F.array(F.when(F.col("b").isNull(), "unknown").when(~same_block("o", "b"), F.lit("differs")), F.when(F.col("hashes") > 1, F.lit("disagree"))))
    return j.select("owner_id", F.explode(rules).alias("rule"))


def reorg_shape(ancestor: str, old: str, new: str) -> Column:
    """Whether a reorg is well formed: both tips above the ancestor in height and time, distinct, direct children linked."""
    c = lambda x, f: F.col(f"{x}.{f}")
    ok = c(old, "hash") != c(new, "hash")
    for t in (old, new):
        ok = ok & (c(t, "number") > c(ancestor, "number")) & (c(t, "timestamp") > c(ancestor, "timestamp"))
        ok = ok & ((c(t, "number") != c(ancestor, "number") + 1) | (c(t, "parent_hash") == c(ancestor, "hash")))
    return ok


def finality_heads(marks: DataFrame, chain: list[str]) -> DataFrame:
    """marks(arrival, finalized, coverage, ancestor): running finalized head and the rule a row breaks."""
    w = Window.partitionBy(*chain).orderBy("arrival")
    before = F.max("finalized").over(w.rowsBetween(Window.unboundedPreceding, -1))
    m = marks.withColumn("before", before)
    rule = F.when(F.col("finalized") > F.col("coverage"), "above_coverage").when(F.col("finalized") < F.col("before"), "regressed").when(F.col("ancestor") < F.col("before"), "reorg_below_finalized")
    return m.select(*chain, "arrival", F.max("finalized").over(w).alias("head"), rule.alias("rule"))


def certified_heads(heads: DataFrame, session: list[str], size: int = scans.SEGMENT_ROWS) -> DataFrame:
    """heads(session, generation, sequence, head_number, ancestor) with certified: the highest head that history has certified.

    It belongs to a generation; a reorg (a row with an ancestor) clears it only where it cuts below it, and a lower
    page cannot lower it. In a row that has both, the reorg comes first.
    """
    return scans.scan(heads, [*session, "generation"], ["sequence"], scans.Certified(), size)


def head_marks(marks: DataFrame, chain: list[str], size: int = scans.SEGMENT_ROWS) -> DataFrame:
    """marks(arrival, safe, finalized, coverage, ancestor) with the safe and the finalized head and the rule a row breaks.

    Heads only rise, but a reorg below the safe head lowers it to the ancestor; one below the finalized head is an
    error, as are marks above the coverage, below their head, and a finalized head above the safe one.
    """
    m = scans.scan(marks, chain, ["arrival"], scans.Marks(), size)
    c = F.col
    rule = (
        F.when(c("finalized") > c("coverage"), "finalized_above_coverage")
        .when(c("safe") > c("coverage"), "safe_above_coverage")
        .when(c("ancestor") < c("finalized_before"), "reorg_below_finalized")
        .when(c("finalized") < c("finalized_before"), "finalized_regressed")
        .when(c("safe") < F.least(c("safe_before"), F.coalesce(c("ancestor"), c("safe_before"))), "safe_regressed")
        .when(c("finalized_head") > c("safe_head"), "finalized_above_safe")
    )
    return m.select(*marks.columns, "safe_head", "finalized_head", rule.alias("rule"))


def content_hash_violations(blocks: DataFrame, commitment: Column) -> DataFrame:
    """(rule, number, hash) of blocks whose hash is not the one that their own columns give; a null hash or commitment is one too."""
    return blocks.where(~F.coalesce(F.col("hash") == commitment, F.lit(False))).select(F.lit("content_hash").alias("rule"), "number", "hash")
