"""Audience sets, payload witnesses, history and live union, and two-source reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.intervals import dyadic

ALL, OWNERS, EXCEPT = "all", "owners", "except"
SCOPES = {"OWNER_CATCHUP": 0, "CANONICAL_PROGRESS": 1, "CANONICAL": 2}
LIFECYCLE = {"included": 1, "safe": 2, "finalized": 3}
IDENTITY = ["block_hash", "transaction_hash", "log_index"]
BROADCAST_GENERATIONS = 100_000  # rows up to which the generations of owners are broadcast; more are shuffled
HEIGHTS_A_TASK = 1 << 15


def _none() -> Column:
    return F.array().cast("array<string>")


def audience(mode: Column | str, owners: Column) -> Column:
    return F.struct((F.lit(mode) if isinstance(mode, str) else mode).alias("mode"), F.array_sort(F.array_distinct(owners)).alias("owners"))


def merge_audience(a: Column, b: Column) -> Column:
    """Everyone absorbs; lists unite; an exception list loses the other's owners, or meets another one."""
    am, bm, ao, bo = a["mode"], b["mode"], a["owners"], b["owners"]
    return (
        F.when((am == ALL) | (bm == ALL), audience(ALL, _none()))
        .when((am == OWNERS) & (bm == OWNERS), audience(OWNERS, F.array_union(ao, bo)))
        .when((am == EXCEPT) & (bm == OWNERS), audience(EXCEPT, F.array_except(ao, bo)))
        .when((am == OWNERS) & (bm == EXCEPT), audience(EXCEPT, F.array_except(bo, ao)))
        .otherwise(audience(EXCEPT, F.array_intersect(ao, bo)))
    )


def residual_audience(base_covered: Column, covered: Column, requested: Column, generations: Column) -> Column:
    """The part of the requested audience that has not seen the input at its current generation; null when
    nobody is left. covered and generations map owners to generations."""
    seen = F.filter(F.map_keys(covered), lambda o: F.coalesce(F.element_at(covered, o) == F.element_at(generations, o), F.lit(False)))
    lost = F.filter(F.map_keys(generations), lambda o: ~F.array_contains(seen, o))
    listed = F.filter(requested["owners"], lambda o: ~F.array_contains(seen, o))
    everyone = F.when(~base_covered, F.when(F.size(seen) == 0, audience(ALL, _none())).otherwise(audience(EXCEPT, seen))).when(F.size(lost) > 0, audience(OWNERS, lost))
    except_ = F.when(~base_covered, audience(EXCEPT, F.array_union(requested["owners"], seen))).when(F.size(F.array_except(lost, requested["owners"])) > 0, audience(OWNERS, F.array_except(lost, requested["owners"])))
    return F.when(requested["mode"] == ALL, everyone).when(requested["mode"] == EXCEPT, except_).when(F.size(listed) > 0, audience(OWNERS, listed))


def apply_coverage(deliveries: DataFrame, key: list[str]) -> DataFrame:
    """deliveries(key, owner_id, generation) -> the highest generation that each owner has seen."""
    return deliveries.groupBy(*key, "owner_id").agg(F.max("generation").alias("generation"))


def audience_rules(mode: str = "mode", owners: str = "owners", scope: str = "scope") -> dict[str, Column]:
    m, o = F.col(mode), F.col(owners)
    return {
        "empty_list": (m == OWNERS) & (F.size(o) == 0),
        "repeated_owner": F.size(o) != F.size(F.array_distinct(o)),
        "owner_id_too_long": F.exists(o, lambda x: F.octet_length(x) > 4096),
        "catchup_not_listed": (F.col(scope) == "OWNER_CATCHUP") & (m != OWNERS),
    }


def audience_known(records: DataFrame, owners: DataFrame) -> DataFrame:
    """Routed owners that the active revision does not have."""
    routed = records.select("*", F.explode("owners").alias("owner_id"))
    return routed.join(owners.select("owner_id").distinct(), "owner_id", "left_anti")


def payload_digest(logs: DataFrame) -> DataFrame:
    """With digest: every field of the payload under its length, so no two payloads share a framing."""
    part = lambda c: F.concat(F.coalesce(F.length(c), F.lit(-1)).cast("string"), F.lit(":"), F.coalesce(c, F.lit("")))
    fields = [F.col(c).cast("string") for c in ("block_number", "block_hash", "transaction_hash", "transaction_index", "log_index", "address")]
    fields += [F.array_join("topics", ","), F.col("data"), F.col("removed").cast("string")]
    return logs.withColumn("digest", F.sha2(F.concat(*[part(f) for f in fields]), 256))


def merge_duplicates(records: DataFrame, key: list[str]) -> DataFrame:
    """records(key, owner_id or null for everyone, scope, digest) of one batch -> one row an identity."""
    rank = F.create_map(*[x for k, v in SCOPES.items() for x in (F.lit(k), F.lit(v))])
    name = F.create_map(*[x for k, v in SCOPES.items() for x in (F.lit(v), F.lit(k))])
    g = records.groupBy(*key).agg(
        F.bool_or(F.col("owner_id").isNull()).alias("everyone"), F.array_sort(F.collect_set("owner_id")).alias("owners"), F.max(rank[F.col("scope")]).alias("s"), F.count_distinct("digest").alias("payloads")
    )
    return g.select(*key, "everyone", F.when(F.col("everyone"), _none()).otherwise(F.col("owners")).alias("owners"), name[F.col("s")].alias("scope"), (F.col("payloads") > 1).alias("conflict"))


def merge_block_metadata(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("number", "hash").agg(
        F.max("parent_hash").alias("parent_hash"), F.max("timestamp").alias("timestamp"), ((F.count_distinct("parent_hash") > 1) | (F.count_distinct("timestamp") > 1)).alias("conflict")
    )


def merge_lifecycle(marks: DataFrame, key: list[str]) -> DataFrame:
    """The furthest of included, safe and finalized; pending and reorged merge only with their like."""
    rank = F.create_map(*[x for k, v in LIFECYCLE.items() for x in (F.lit(k), F.lit(v))])
    kind = F.when(F.col("status").isin("pending", "reorged"), F.col("status")).otherwise("chain")
    g = marks.withColumns({"kind": kind, "rank": F.coalesce(rank[F.col("status")], F.lit(0))}).groupBy(*key)
    return g.agg(F.max_by("status", "rank").alias("status"), (F.count_distinct("kind") > 1).alias("conflict"))


def routing_fanout(records: DataFrame, installed: int) -> Column:
    """Projected owner associations of a batch."""
    n = F.size("owners")
    return F.sum(F.when(F.col("mode") == ALL, installed).when(F.col("mode") == EXCEPT, installed + n).otherwise(n))


def dropped_block() -> Column:
    """The block that a removal names; null for other records. Removals are never deduplicated."""
    return F.when(F.col("removed"), F.struct(F.col("block_number").alias("number"), F.col("block_hash").alias("hash")))


def fence(live: DataFrame, history: DataFrame, number: str = "block_number") -> DataFrame:
    """One row: the fence F (first live head less one) and T, the acknowledged history block that reaches it (null: none)."""
    f = live.agg(F.greatest(F.min_by(number, "arrival") - 1, F.lit(0)).alias("fence"))
    t = history.agg(F.max(number).alias("top"))
    return f.join(t).select("fence", F.when(F.col("top") >= F.col("fence"), F.col("top")).alias("through"))


def hybrid_union(history: DataFrame, live: DataFrame, cut: DataFrame) -> DataFrame:
    """History up to T and live rows above it, each input once; nothing of live before a cutover."""
    c = F.broadcast(cut)  # one row
    old = history.join(c).where(F.col("through").isNull() | (F.col("block_number") <= F.col("through"))).select(*history.columns)
    new = live.where(~F.col("removed")).join(c).where(F.col("block_number") > F.col("through")).select(*history.columns)
    return old.unionByName(new)


def overlap_violations(history: DataFrame, live: DataFrame, cut: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Live rows at or below T from its first head on that history lacks, or has with another payload."""
    key = key or IDENTITY
    c = F.broadcast(cut)
    inside = lambda df: df.join(c).where((F.col("block_number") <= F.col("through")) & (F.col("block_number") > F.col("fence")))
    a = inside(live.where(~F.col("removed"))).select(*key, F.col("digest").alias("live_digest"))
    b = inside(history).select(*key, F.col("digest").alias("history_digest"))
    j = a.join(b, key, "full").where(~F.col("live_digest").eqNullSafe(F.col("history_digest")))
    return j.select(*key, F.when(F.col("live_digest").isNull(), "missing_in_live").when(F.col("history_digest").isNull(), "missing_in_history").otherwise("payload").alias("rule"))


def late_drops(live: DataFrame, history: DataFrame, cut: DataFrame) -> DataFrame:
    """Removed live logs at or below T of blocks that history does not have: already resolved."""
    gone = live.where("removed").join(F.broadcast(cut)).where(F.col("block_number") <= F.col("through"))
    return gone.join(history.select("block_number", "block_hash").distinct(), ["block_number", "block_hash"], "left_anti").select(*live.columns)


def reconcile_controls(controls: DataFrame, cut: DataFrame) -> DataFrame:
    """controls(kind, number, ancestor, old_tip) -> with keep: progress and barriers above T, reorgs wholly above it, finality marks always."""
    k = F.col("kind")
    keep = F.when(k.isin("safe", "finalized"), True).when(k == "reorg", (F.col("old_tip") > F.col("through")) & (F.col("ancestor") >= F.col("through"))).otherwise(F.col("number") > F.col("through"))
    return controls.join(F.broadcast(cut)).withColumn("keep", keep).drop("fence", "through")


def recover_from_anchor(history: DataFrame, live: DataFrame, reorgs: DataFrame, anchor: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """After a live failure -> (rows with source, rebased reorgs, violations).

    A history reorg below the anchor moves it down to its ancestor and is rebased: its old tip becomes the
    tip that live had delivered. Up to the anchor live's delivered rows stand and history's copies are
    suppressed; above it history delivers. A live row up to the anchor that history does not have is a
    violation and goes.
    """
    moved = F.broadcast(reorgs.where(F.col("ancestor") < anchor).agg(F.coalesce(F.min("ancestor"), F.lit(anchor)).alias("anchor")))  # one row
    tip = F.broadcast(live.where("not removed").agg(F.max("block_number").alias("live_tip")))  # one row
    delivered = live.where(~F.col("removed")).join(moved).where(F.col("block_number") <= F.col("anchor")).drop("anchor")
    stood = delivered.join(history.select(*IDENTITY), IDENTITY, "left_semi").select(*history.columns, F.lit("live").alias("source"))
    alien = delivered.join(history.select(*IDENTITY), IDENTITY, "left_anti").select(F.lit("not_in_history").alias("rule"), *IDENTITY)
    missed = history.join(moved).where(F.col("block_number") <= F.col("anchor")).drop("anchor").join(delivered.select(*IDENTITY), IDENTITY, "left_anti")
    rest = history.join(moved).where(F.col("block_number") > F.col("anchor")).unionByName(missed, allowMissingColumns=True).select(*history.columns, F.lit("history").alias("source"))
    return stood.unionByName(rest), reorgs.join(tip).withColumn("old_tip", F.greatest("old_tip", "live_tip")).drop("live_tip"), alien


def branch_epochs(records: DataFrame, reorgs: DataFrame, heights: DataFrame | None = None) -> DataFrame:
    """records(block_number, arrival) with epoch: how many reorgs had displaced the height before the arrival.

    Reorgs are cut into dyadic intervals of heights, at most two of a size, and a height is looked up in the one
    interval of each size in use that holds it: a reorg of a million heights is forty rows at most, and the
    join is on equal keys. An interval's row lists the arrivals of the reorgs that have it. Records meet the list of their
    height. heights(block_number) are those of the records and maybe others, where they are had for less than the records.
    """
    cover = reorgs.select(F.col("arrival").alias("at"), F.explode(dyadic("ancestor + 1", "old_tip + 1")).alias("p")).select("at", "p.*")
    cover = cover.groupBy("level", "part").agg(F.collect_list("at").alias("times"))
    levels = F.broadcast(cover.agg(F.collect_set("level").alias("levels")))  # one row
    held = (records if heights is None else heights).select("block_number").distinct().join(levels).select("block_number", F.explode("levels").alias("level"))
    held = held.withColumn("part", F.expr("shiftright(block_number, level)"))
    displaced = held.join(cover, ["level", "part"]).groupBy("block_number").agg(F.flatten(F.collect_list("times")).alias("times"))
    before = F.size(F.filter("times", lambda t: t <= F.col("arrival")))
    epoch = F.when(F.col("times").isNull(), 0).otherwise(before).cast("long")
    return records.join(displaced, "block_number", "left").withColumn("epoch", epoch).drop("times")


def deduplicate(records: DataFrame, key: list[str], reorgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """records(key, block_number, owner_id, arrival, removed, digest) -> (with epoch and deliver, conflicts).

    Delivered is the first time that an owner meets an input. A reorg forgets what it displaced, so
    an input that comes back on a new branch is delivered again. Removals always pass. One identity
    with two payloads is a conflict (removals tell nothing of the payload).
    """
    seen = branch_epochs(records, reorgs)
    w = Window.partitionBy(*key, "epoch", "owner_id", "removed").orderBy("arrival")
    payloads = records.where(~F.col("removed")).groupBy(*key).agg(F.count_distinct("digest").alias("payloads")).where("payloads > 1")
    return seen.withColumn("deliver", F.col("removed") | (F.row_number().over(w) == 1)), payloads.select(F.lit("payload_conflict").alias("rule"), *key)


def deduplicate_generations(records: DataFrame, key: list[str], reorgs: DataFrame, generations: DataFrame, heights: DataFrame | None = None) -> DataFrame:
    """records(key, block_number, owners, arrival, removed, digest) -> with verdict and the owners it is delivered to.

    The batch form of streaming.journal.dedup_stream without bounds, row for row. generations(owner_id,
    arrival, generation) tell from when on an owner has which generation (null: gone); before the first it
    is 0. delivered: to the owners to whom this is the first time, at their generation and since the last
    reorg that displaced its height, that the input comes with the payload of its first time; suppressed:
    to nobody; conflict: it has another payload; passed: removals. Arrivals are unique, and an input has one height (its
    block's hash commits to it), so records are shuffled once, by height: all windows run where they then are. heights: see branch_epochs.
    """
    of = Window.partitionBy("owner_id").orderBy("arrival")
    g = generations.select(F.col("owner_id").alias("owner"), F.coalesce("generation", F.lit(0)).alias("generation"), F.col("arrival").alias("since"), F.lead("arrival").over(of).alias("until"))
    if generations.limit(BROADCAST_GENERATIONS + 1).count() <= BROADCAST_GENERATIONS:
        g = F.broadcast(g)
    if heights is not None:
        records = records.repartition(max(1, -(-heights.select("block_number").distinct().count() // HEIGHTS_A_TASK)), "block_number")
    own = ["block_number", *key]
    seen = branch_epochs(records, reorgs, heights)
    first = F.first("digest").over(Window.partitionBy(*own, "epoch", "removed").orderBy("arrival"))
    seen = seen.withColumn("agrees", ~F.col("removed") & first.eqNullSafe(F.col("digest")))
    asked = F.when(F.col("agrees"), F.array_distinct("owners"))
    seen = seen.select("*", F.posexplode_outer(asked).alias("place", "owner"))
    rest = [c for c in records.columns if c not in (*own, "arrival")]
    top = F.coalesce("place", F.lit(0)) == 0  # the row of a record that carries what it does not share with its other owners
    seen = seen.select(*own, "arrival", "epoch", "agrees", "owner", F.when(top, F.struct(*rest)).alias("record"))
    within = (seen["owner"] == g["owner"]) & (F.col("since") <= F.col("arrival")) & (F.col("until").isNull() | (F.col("arrival") < F.col("until")))
    seen = seen.join(g, within, "left").select(*own, "arrival", "epoch", "agrees", seen["owner"], F.coalesce("generation", F.lit(0)).alias("generation"), "record")
    turn = F.row_number().over(Window.partitionBy(*own, "epoch", "agrees", "owner", "generation").orderBy("arrival"))
    told = F.when(F.col("owner").isNotNull() & (turn == 1), F.col("owner"))
    fresh = F.collect_list("told").over(Window.partitionBy(*own, "arrival"))
    out = seen.withColumn("told", told).withColumn("fresh", F.array_sort(fresh)).where("record is not null").select(*own, "arrival", "agrees", "fresh", "record.*")
    verdict = F.when(F.col("removed"), "passed").when(~F.col("agrees"), "conflict").when(F.size("fresh") > 0, "delivered").otherwise("suppressed")
    owners = F.when(F.col("removed"), F.array_sort(F.array_distinct("owners"))).otherwise(F.col("fresh"))
    return out.select(*[c for c in records.columns if c != "owners"], verdict.alias("verdict"), owners.alias("owners"))


def log_identity() -> Column:
    return F.struct("chain_id", "block_hash", "transaction_hash", "log_index", F.lit("log").alias("kind"))


def block_identity() -> Column:
    return F.struct("chain_id", "hash", "number")


def pending_identity() -> Column:
    return F.struct("chain_id", "transaction_hash")


def control_phases(rows: DataFrame, batch: list[str]) -> DataFrame:
    """(batch, ordinal, phase, violation): reorgs, then records, then other controls; a reorg after another control is wrong."""
    phase = F.when(F.col("kind") == "reorg", 0).when(F.col("kind") == "record", 1).otherwise(2)
    r = rows.withColumn("phase", phase)
    before = F.max("phase").over(Window.partitionBy(*batch).orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1))
    return r.select(*batch, "ordinal", "phase", F.coalesce((F.col("phase") == 0) & (before > 0), F.lit(False)).alias("violation"))


def batch_accounting(records: DataFrame, batch: list[str], limits: tuple[int, int, int] = (2048, 262144, 64 << 20)) -> DataFrame:
    """Records, controls and bytes of live batches and whether a bound is passed."""
    g = records.groupBy(*batch).agg(F.count_if(~F.col("control")).alias("records"), F.count_if("control").alias("controls"), F.sum("bytes").alias("bytes"))
    return g.withColumn("over", (F.col("records") + F.col("controls") > limits[1]) | (F.col("bytes") > limits[2]))


def live_buffer_bounds(batches: DataFrame, shard: list[str], limits: tuple[int, int, int] = (2048, 262144, 64 << 20)) -> DataFrame:
    """The first batch of each shard at which the buffer before the cutover passes a bound."""
    w = Window.partitionBy(*shard).orderBy("arrival")
    b = batches.select(*shard, "arrival", F.row_number().over(w).alias("n"), F.sum("records").over(w).alias("r"), F.sum("bytes").over(w).alias("y"))
    return b.where((F.col("n") > limits[0]) | (F.col("r") > limits[1]) | (F.col("y") > limits[2])).groupBy(*shard).agg(F.min("arrival").alias("poisoned_at"))


def phase_timeline(arrivals: DataFrame, shard: list[str], cutover: Column, drained: Column, failed: Column) -> DataFrame:
    """Arrivals with their phase: catching up, draining, live or recovering."""
    w = Window.partitionBy(*shard).orderBy("arrival")
    at = lambda c: F.max(c.cast("int")).over(w)
    phase = F.when(at(failed) == 1, "recovering").when(at(drained) == 1, "live").when(at(cutover) == 1, "draining").otherwise("catching_up")
    return arrivals.withColumn("phase", phase)


def cross_source_reset(positions: DataFrame, reorgs: DataFrame) -> DataFrame:
    """positions(chain_id, source, head, token) rewound below the lowest ancestor of the other sources' reorgs; their token is cleared."""
    r = reorgs.select("chain_id", F.col("source").alias("other"), "ancestor")
    j = positions.join(r, "chain_id", "left").where(F.col("other").isNull() | (F.col("other") != F.col("source")))
    g = j.groupBy("chain_id", "source").agg(F.min("ancestor").alias("ancestor"))
    k = positions.join(g, ["chain_id", "source"], "left")
    hit = F.coalesce(F.col("ancestor") < F.col("head"), F.lit(False))
    return k.select("chain_id", "source", F.when(hit, F.col("ancestor")).otherwise(F.col("head")).alias("head"), F.when(hit, F.lit(None)).otherwise(F.col("token")).alias("token"))


def source_positions(acked: DataFrame, source: list[str]) -> DataFrame:
    return acked.groupBy(*source).agg(F.max_by("token", "sequence").alias("token"), F.max_by("head_number", "sequence").alias("head"), F.max("sequence").alias("sequence"))


def token_reuse(batches: DataFrame) -> DataFrame:
    return batches.groupBy("token").agg(F.count_distinct("digest").alias("digests")).where("digests > 1")


def compare_sources(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side that the other has less often, with both counts."""
    names = a.columns
    left, right = (x.groupBy(*names).agg(F.count("*").alias(c)) for x, c in ((a, "left_n"), (b.select(*names), "right_n")))
    j = left.join(right, names, "full").na.fill(0, ["left_n", "right_n"])
    return j.where("left_n <> right_n")


def pair_arrivals(a: DataFrame, b: DataFrame, chain: list[str]) -> DataFrame:
    """Blocks seen (at, and after which time) by both sources with equal hash, less each chain's first: the delay of a after b.

    The sources are merged whatever their estimated size: estimates do not see what a chain column multiplies.
    """
    right = b.select(*chain, "number", "hash", F.col("seen").alias("b_seen"), F.col("took").alias("b_took"))
    j = a.select(*chain, "number", "hash", F.col("seen").alias("a_seen"), F.col("took").alias("a_took")).join(right.hint("merge"), [*chain, "number", "hash"])
    first = F.broadcast(j.groupBy(*chain).agg(F.min("number").alias("first")))  # a row a chain
    return j.join(first, chain).where("number > first").select(*chain, "number", (F.col("a_seen") - F.col("b_seen")).alias("delta"), F.col("a_took"), F.col("b_took"))


def compare_stats(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Latency figures of paired arrivals and, where both sides' durations are there, how many times faster b was."""
    return pairs.groupBy(*by).agg(
        F.median("delta").alias("median"), F.avg("delta").alias("mean"), F.min("delta").alias("least"), F.max("delta").alias("most"), F.try_divide(F.sum("a_took"), F.sum("b_took")).alias("speed_up")
    )


def validate_source_positions(positions: DataFrame, coordinator: DataFrame) -> DataFrame:
    """(rule, key): source heads beyond the coordinator's or another block at its height, and tokens without a
    head, a digest or certified coverage."""
    from eventlake.operators.scan import violations

    j = positions.join(coordinator.select("chain_id", F.col("head").alias("coordinator_head"), F.col("hash").alias("coordinator_hash")), "chain_id", "left")
    held = F.col("token").isNotNull()
    rules = {
        "unknown_chain": F.col("coordinator_head").isNull(),
        "ahead_of_coordinator": F.col("head") > F.col("coordinator_head"),
        "other_block_at_head": (F.col("head") == F.col("coordinator_head")) & (F.col("hash") != F.col("coordinator_hash")),
        "token_without_head": held & F.col("head").isNull(),
        "token_without_digest": held & F.col("digest").isNull(),
        "token_without_coverage": held & (F.col("coverage").isNull() | (F.col("coverage") < F.col("head"))),
    }
    return violations(j, rules, F.concat_ws(":", "chain_id", "source"))


def validate_witnesses(witnesses: DataFrame, head: int, chain_id: int = 1) -> DataFrame:
    """(rule, key) of a journal(identity, chain_id, kind, status, digest, generation, current_generation,
    block_number, identity_block, coverage, proof_generation)."""
    from eventlake.operators.scan import violations

    pending = F.col("kind") == "pending"
    rules = {
        "wrong_chain": F.col("chain_id") != chain_id,
        "digest_missing": F.col("digest").isNull(),
        "generation_ahead": F.col("generation") > F.col("current_generation"),
        "lifecycle_of_kind": pending != (F.col("status") == "pending"),
        "block_of_identity": ~F.col("block_number").eqNullSafe(F.col("identity_block")),
        "block_ahead": F.col("block_number") > head,
        "coverage_ahead": F.col("coverage") > head,
        "proof_of_other_generation": F.col("proof_generation").isNotNull() & (F.col("proof_generation") != F.col("current_generation")),
        "proof_ahead": F.col("proof_generation").isNotNull() & (F.col("coverage").isNull() | (F.col("coverage") < F.col("block_number"))),
    }
    twice = witnesses.groupBy("identity").agg(F.count("*").alias("n"))
    return violations(witnesses, rules, F.col("identity")).unionByName(violations(twice, {"repeated_identity": F.col("n") > 1}, F.col("identity")))


def coverage_state(cursors: DataFrame, scanned: DataFrame) -> DataFrame:
    """(rule, key) of cursors(session_id, sequence, next_block, head_number, head_hash): the scan is at most one past
    the coverage, and the scanned block at the coverage height is the coverage block."""
    from eventlake.operators.scan import violations

    j = cursors.join(scanned.select(F.col("number").alias("head_number"), F.col("hash").alias("scanned_hash")), "head_number", "left")
    rules = {"scan_ahead": F.col("next_block") > F.col("head_number") + 1, "coverage_block": F.col("scanned_hash") != F.col("head_hash")}
    return violations(j, rules, F.concat_ws(":", "session_id", "sequence"))


def owner_only_reorgs(reorgs: DataFrame, owners: DataFrame, activation: int) -> DataFrame:
    """Reorgs whose old tip is below the activation block and outside a global backfill: no broadcast stream
    can represent them."""
    from eventlake.operators.routing import counts_for_all, global_backfill

    return reorgs.where(~counts_for_all(F.col("old_tip"), activation, global_backfill(owners, F.col("old_tip"))))
