"""The delivery log: cursors, acknowledgements, replay, sessions and their audits."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.intervals import dyadic
from eventlake.functions.sizes import accounted_bytes, control_bytes, token  # noqa: F401
from eventlake.operators import scans
from eventlake.operators.scan import violations

SLOT = ["session_id", "chain_id", "sequence"]
SESSION = SLOT[:2]
MANY_SESSIONS = 1000


def new_deliveries(stored: DataFrame, incoming: DataFrame, digest: str = "digest") -> tuple[DataFrame, DataFrame]:
    """(rows to append, violations): an identical redelivery is dropped, other content in a slot is a violation."""
    had = stored.select(*SLOT, F.col(digest).alias("had"))
    j = incoming.join(had.hint("merge"), SLOT, "left")  # a log is as long as what comes, so it is not broadcast
    return j.where("had is null").drop("had"), j.where(F.col("had").isNotNull() & (F.col("had") != F.col(digest))).select(F.lit("slot_conflict").alias("rule"), *SLOT)


def slot_clashes(incoming: DataFrame, digest: str = "digest") -> DataFrame:
    """(rule, slot): slots that one batch fills with different contents."""
    of = incoming.groupBy(*SLOT).agg(F.count("*").alias("n"), F.count(digest).alias("known"), F.min(digest).alias("a"), F.max(digest).alias("b"))
    return of.where((F.col("a") != F.col("b")) | ((F.col("known") > 0) & (F.col("known") < F.col("n")))).select(F.lit("slot_conflict").alias("rule"), *SLOT)


def write_deliveries(incoming: DataFrame, path: str, digest: str = "digest") -> int:
    """Appends new deliveries to a Parquet log, partitioned by session; raises on a slot conflict,
    with the log or inside the batch, before anything is written.

    Running it again with the same batch appends nothing, so it serves as a foreachBatch sink. Of the log
    only the sequences of the batch are read, and of up to MANY_SESSIONS sessions only their folders.
    """
    from eventlake.operators.validate import strict

    spark = incoming.sparkSession
    strict(slot_clashes(incoming, digest))
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        low, high = incoming.agg(F.min("sequence"), F.max("sequence")).first()
        stored = spark.read.parquet(path).where(F.col("sequence").between(low, high))
        sessions = [r[0] for r in incoming.select("session_id").distinct().limit(MANY_SESSIONS + 1).collect()]
        if len(sessions) <= MANY_SESSIONS:
            stored = stored.where(F.col("session_id").isin(sessions))
        rows, bad = new_deliveries(stored, incoming, digest)
        strict(bad)
    else:
        rows = incoming
    rows = rows.dropDuplicates(SLOT).persist()
    n = rows.count()
    if n:
        rows.write.mode("append").partitionBy("session_id").parquet(path)
    rows.unpersist()
    return n


def _ack_outcomes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The outcome of each ack of a partition in order of session and ordinal; the state is one sequence."""
    session, done = None, 0
    for f in frames:
        out = []
        for own, chain, sequence, known, right in zip(f["session_id"], f["chain_id"], f["sequence"], f["known"], f["right"]):
            if (own, chain) != session:
                session, done = (own, chain), 0
            if not known:
                out.append("none_pending")
            elif right and sequence == done + 1:
                done += 1
                out.append("committed")
            else:
                out.append("duplicate" if right and sequence == done else "mismatch")
        yield f[[*SESSION, "ordinal", "sequence"]].assign(outcome=out)


def classify_acks(deliveries: DataFrame, acks: DataFrame) -> DataFrame:
    """acks(session, chain, ordinal, sequence, token) -> outcome: committed, duplicate, mismatch or none_pending.

    Only an ack of the delivery after the last committed one, with its token, commits; a right ack
    that comes early changes nothing. A repeat of the last committed ack is a duplicate. A session's acks
    stream through one task in order of their ordinal, whatever their number.
    """
    known = deliveries.select(*SLOT, F.col("token").alias("expected"))
    j = acks.join(known, SLOT, "left").withColumns({"known": F.col("expected").isNotNull(), "right": F.coalesce(F.col("token") == F.col("expected"), F.lit(False))})
    j = j.select(*SESSION, "ordinal", "sequence", "known", "right").repartition(*SESSION).sortWithinPartitions(*SESSION, "ordinal")
    kinds = {f.name: f.dataType.simpleString() for f in j.schema.fields}
    return j.mapInPandas(_ack_outcomes, ", ".join(f"{c} {kinds[c]}" for c in (*SESSION, "ordinal", "sequence")) + ", outcome string")


def classify_acks_segmented(deliveries: DataFrame, acks: DataFrame, size: int = scans.SEGMENT_ROWS) -> DataFrame:
    """classify_acks where one session holds most acks: a session's sequences are cut into segments.

    A right ack is an arrow to the first right ack of the next sequence after it; the committed acks are the path from
    the first of sequence 1. Each segment says where its entries lead, the path is carried over the
    segments, and an ack is then judged by when its own sequence and the next were committed.
    """
    known = deliveries.select(*SLOT, F.col("token").alias("expected"))
    j = acks.join(known, SLOT, "left").withColumn("known", F.col("expected").isNotNull()).withColumn("right", F.coalesce(F.col("token") == F.col("expected"), F.lit(False)))
    j = j.select(*SESSION, "ordinal", "sequence", "known", "right")
    done = scans.scan(j.where("right and sequence > 0").select(*SLOT, "ordinal"), SESSION, ["sequence", "ordinal"], scans.Commits(), size).where("commits")
    own = done.select(*SLOT, F.col("ordinal").alias("at"))
    after = done.select(*SESSION, (F.col("sequence") - 1).alias("sequence"), F.col("ordinal").alias("next_at"))
    j = j.join(own, SLOT, "left").join(after, SLOT, "left")
    o = F.col("ordinal")
    outcome = (
        F.when(~F.col("known"), "none_pending")
        .when(F.col("right") & (o == F.col("at")), "committed")
        .when(F.col("right") & (F.col("at") < o) & (F.col("next_at").isNull() | (o < F.col("next_at"))), "duplicate")
        .otherwise("mismatch")
    )
    return j.select(*SESSION, "ordinal", "sequence", outcome.alias("outcome"))


def session_state(deliveries: DataFrame, acks: DataFrame) -> DataFrame:
    """Latest revision, acknowledged and pending sequence, cursor and promised tip of each session."""
    d = deliveries.join(acks.select(*SLOT, F.lit(True).alias("acked")), SLOT, "left").withColumn("acked", F.coalesce("acked", F.lit(False)))
    seq = F.when(F.col("acked"), F.col("sequence"))
    runtime = F.when(F.col("acked") & ~F.col("checkpoint_neutral"), F.col("sequence"))
    reorg = F.when(F.col("acked") & (F.col("payload_kind") == "reorg"), F.col("sequence"))
    data = F.when(F.col("acked") & (F.col("payload_kind") == "data"), F.col("sequence"))
    g = d.groupBy(*SESSION).agg(
        F.max("query_revision").alias("revision"),
        F.max(seq).alias("acked"),
        F.max_by("next_block", seq).alias("acked_next"),
        F.max_by("head_number", runtime).alias("runtime_head"),
        F.min(F.when(~F.col("acked"), F.col("sequence"))).alias("pending"),
        F.max(reorg).alias("r"),
        F.max(data).alias("d"),
        F.max_by("head_number", reorg).alias("reorg_head"),
    )
    return g.withColumn("promised", F.when(F.col("r") > F.coalesce("d", F.lit(0)), F.col("reorg_head"))).drop("r", "d", "reorg_head")


def pending_deliveries(deliveries: DataFrame, acks: DataFrame) -> DataFrame:
    return deliveries.join(acks, SLOT, "left_anti")


def replay_status(sends: DataFrame) -> DataFrame:
    """sends(session, sequence, sent_at) -> whether each is the first send of its slot or a replay."""
    w = Window.partitionBy("session_id", "sequence").orderBy("sent_at")
    return sends.withColumn("replay", F.row_number().over(w) > 1)


def service_metrics(deliveries: DataFrame, acks: DataFrame, sends: DataFrame, errors: DataFrame) -> DataFrame:
    """One row of counts over the delivery log, the acks, the sends (replay_status) and the source's errors."""
    d = deliveries.agg(F.count_distinct("session_id").alias("sessions"), F.count("*").alias("persisted"), F.count_if(F.col("payload_kind") == "reorg").alias("reorgs"), F.count_if("checkpoint_neutral").alias("neutral"))
    d = d.join(acks.agg(F.count("*").alias("acks"))).join(sends.agg(F.count_if("replay").alias("replayed")))
    return d.join(errors.agg(F.count("*").alias("source_errors")))


def cursor_regressions(deliveries: DataFrame) -> DataFrame:
    """(rule, session, sequence): a cursor other than a reorg's that goes back, loses its head or changes it at
    its height, and gaps in sequence or token."""
    w = Window.partitionBy(*SESSION).orderBy("sequence")
    lag = lambda c: F.lag(c).over(w)
    d = deliveries.select("*", lag("next_block").alias("p_next"), lag("head_number").alias("p_head"), lag("head_hash").alias("p_hash"), lag("sequence").alias("p_seq"))
    plain = (F.col("payload_kind") != "reorg") & F.col("p_seq").isNotNull()
    rules = {
        "next_block_regressed": plain & ~F.col("checkpoint_neutral") & (F.col("next_block") < F.col("p_next")),
        "head_regressed": plain & (F.col("head_number") < F.col("p_head")),
        "head_changed": plain & (F.col("head_number") == F.col("p_head")) & (F.col("head_hash") != F.col("p_hash")),
        "head_dropped": plain & F.col("p_head").isNotNull() & F.col("head_number").isNull(),
        "sequence_gap": F.col("sequence") != F.coalesce(F.col("p_seq"), F.lit(0)) + 1,
        "token_mismatch": F.col("token") != token("sequence"),
    }
    return violations(d, rules, F.concat_ws(":", "session_id", "sequence"))


def reorg_geometry(reorgs: DataFrame) -> DataFrame:
    """(rule, key) of reorg controls(session, sequence, p_head, p_hash, ancestor, old_tip, old_tip_hash, new_tip,
    next_block): the old tip is the acknowledged head, both tips are above the ancestor, and the cursor follows it."""
    rules = {
        "reorg_old_tip": ~(F.col("old_tip").eqNullSafe(F.col("p_head")) & F.col("old_tip_hash").eqNullSafe(F.col("p_hash"))),
        "reorg_tips_below_ancestor": F.least("old_tip", "new_tip") <= F.col("ancestor"),
        "reorg_cursor": F.col("next_block") != F.col("ancestor") + 1,
    }
    return violations(reorgs, rules, F.concat_ws(":", "session_id", "sequence"))


def validate_progress(deliveries: DataFrame) -> DataFrame:
    """Cursor regressions, and declared heads that do not fit the scan cursor."""
    rules = {"head_ahead_of_scan": F.col("head_number") >= F.col("next_block"), "next_not_after_head": (F.col("payload_kind") == "data") & (F.col("next_block") != F.col("head_number") + 1)}
    return cursor_regressions(deliveries).unionByName(violations(deliveries, rules, F.concat_ws(":", "session_id", "sequence")))


def activation_boundaries(rows: DataFrame) -> DataFrame:
    """rows(session, sequence, query_revision, next_block, activation, open_backfill): (rule, key)."""
    w = Window.partitionBy(*SESSION, "query_revision").orderBy("sequence")
    r = rows.withColumn("before", F.lag("activation").over(w))
    rules = {"boundary_missing": F.col("open_backfill") & F.col("activation").isNull(), "boundary_below_scan": F.col("activation") < F.col("next_block"), "boundary_moved": F.col("before").isNotNull() & ~F.col("before").eqNullSafe(F.col("activation"))}
    return violations(r, rules, F.concat_ws(":", "session_id", "sequence"))


def neutral_flags(deliveries: DataFrame) -> DataFrame:
    """Deliveries whose neutral flag is not that of a barrier without a block."""
    expected = (F.col("payload_kind") == "barrier") & F.col("head_number").isNull()
    return deliveries.where(F.col("checkpoint_neutral") != expected).select(*SLOT)


def scan_progress(deliveries: DataFrame) -> DataFrame:
    """Sequences where the scan trails the running coverage head."""
    w = Window.partitionBy(*SESSION).orderBy("sequence")
    return deliveries.select(*SLOT, "next_block", F.max("head_number").over(w).alias("coverage")).where(F.col("next_block") <= F.col("coverage"))


def resume_positions(hellos: DataFrame, state: DataFrame) -> DataFrame:
    """hellos(session, chain, sequence, token) against session_state -> confirmed, discovery or rejected."""
    j = hellos.join(state.select(*SESSION, "acked", "pending"), SESSION, "left")
    s = F.col("sequence")
    verdict = F.when(s == F.col("acked"), "confirmed").when((s == 0) & F.col("token").isNull(), "discovery").when((s == F.col("pending")) & (s == F.col("acked") + 1) & (F.col("token") == token("pending")), "confirmed").otherwise("rejected")
    return j.select(*SESSION, "sequence", verdict.alias("verdict"))


def validate_state_rows(state: DataFrame) -> DataFrame:
    """(rule, key) of persisted session rows that contradict themselves."""
    acked, pending = F.col("acked"), F.col("pending")
    rules = {
        "session_missing": F.coalesce(F.col("session_id") == "", F.lit(True)),
        "chain_invalid": F.coalesce(F.col("chain_id") <= 0, F.lit(True)),
        "revision_missing": F.col("revision").isNull(),
        "acked_invalid": acked < 1,
        "acked_without_cursor": acked.isNotNull() & F.col("acked_next").isNull(),
        "cursor_without_ack": acked.isNull() & F.col("acked_next").isNotNull(),
        "pending_not_next": pending != F.coalesce(acked, F.lit(0)) + 1,
        "runtime_without_ack": acked.isNull() & F.col("runtime_head").isNotNull(),
        "runtime_ahead": F.col("runtime_head") >= F.col("acked_next"),
        "promise_without_ack": acked.isNull() & F.col("promised").isNotNull(),
        "promise_ahead": F.col("promised") >= F.col("acked_next"),
    }
    return violations(state, rules, F.col("session_id"))


PAYLOADS = ["data", "reorg", "finality", "barrier"]


def validate_payloads(deliveries: DataFrame) -> DataFrame:
    """(rule, key) of what a delivery carries, by its kind.

    deliveries(session, chain, sequence, query_revision, checkpoint_neutral, payload_kind, head_number, head_hash, n_records
    (data), ancestor, old_tip, new_tip (reorg: structs of a block), finality, block_number (finality, barrier), barrier_id).
    """
    from eventlake.operators.canonical import reorg_shape

    kind, never = F.col("payload_kind"), F.lit(False)
    wide = lambda c: F.coalesce(c.rlike("^[0-9a-f]{64}$"), never)
    activation = F.concat(F.lit("desired-state:"), F.col("query_revision").cast("string"))
    neutral = (kind == "barrier") & F.col("block_number").isNull() & ((F.col("barrier_id") == activation) | F.col("barrier_id").startswith("source-progress:"))
    parts = [F.col(c) for c in ("ancestor", "old_tip", "new_tip")]
    missing, narrow = never, never
    for part in parts:
        missing = missing | part.isNull() | part["number"].isNull() | part["hash"].isNull()
        narrow = narrow | ~wide(part["hash"]) | ~wide(part["parent_hash"])
    rules = {
        "payload_missing": ~F.coalesce(kind.isin(*PAYLOADS), never),
        "head_width": F.col("head_number").isNotNull() & ~wide(F.col("head_hash")),
        "neutral_flag_wrong": F.col("checkpoint_neutral") != F.coalesce(neutral, never),
        "reorg_part_missing": (kind == "reorg") & missing,
        "reorg_part_width": (kind == "reorg") & ~missing & narrow,
        "reorg_shape": (kind == "reorg") & ~missing & ~F.coalesce(reorg_shape("ancestor", "old_tip", "new_tip"), never),
        "finality_kind": (kind == "finality") & ~F.coalesce(F.col("finality").isin("safe", "finalized"), never),
        "finality_block_missing": (kind == "finality") & F.col("block_number").isNull(),
        "empty_barrier_id": (kind == "barrier") & (F.coalesce(F.length("barrier_id"), F.lit(0)) == 0),
        "empty_data": (kind == "data") & (F.coalesce(F.col("n_records"), F.lit(0)) == 0),
    }
    return violations(deliveries, rules, F.concat_ws(":", "session_id", "sequence"))


def validate_session_rows(rows: DataFrame) -> DataFrame:
    """(rule, key) of whole persisted session rows: desired state, acknowledged and runtime cursor, promise, pending delivery, activation.

    rows(session_id, chain_id, revision, desired_session, desired_chain, desired_revision (null: no desired state),
    acked, acked_chain, acked_revision, acked_head, runtime, runtime_chain, runtime_revision, runtime_same (whether it is the acknowledged cursor), promised,
    pending, pending_session, pending_revision, pending_cursor (its cursor's sequence), pending_token, pending_kind, pending_activates, pending_certifies,
    activation). The rules of validate_state_rows, which reads session_state's columns, are not repeated.
    """
    c, never = F.col, F.lit(False)
    acked, pending = c("acked"), c("pending")
    held = pending.isNotNull()
    bare = (c("revision") == 0) & acked.isNull() & c("runtime").isNull() & pending.isNull() & c("promised").isNull()
    current = F.coalesce(pending, acked, F.lit(0))
    same = lambda *pairs: _all([F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])
    desired = c("desired_revision").isNotNull()
    rules = {
        "desired_state_missing": ~desired & ~bare,
        "desired_state_of_other_row": desired & ~same(("desired_session", "session_id"), ("desired_chain", "chain_id"), ("desired_revision", "revision")),
        "acked_cursor": acked.isNotNull() & ((acked < 1) | (c("acked_chain") != c("chain_id")) | (c("acked_revision") > c("revision"))),
        "runtime_cursor": c("runtime").isNotNull() & ((c("runtime") < 1) | (c("runtime_chain") != c("chain_id")) | (c("runtime_revision") > c("revision"))),
        "runtime_without_ack": c("runtime").isNotNull() & acked.isNull(),
        "runtime_ahead": c("runtime") > acked,
        "runtime_conflict": (c("runtime") == acked) & ~F.coalesce(c("runtime_same"), never),
        "promise_behind": c("promised") <= c("acked_head"),
        "pending_not_next": held & (pending != F.coalesce(acked, F.lit(0)) + 1),
        "pending_of_other_row": held & ~same(("pending_session", "session_id"), ("pending_revision", "revision")),
        "pending_cursor": held & ~same(("pending_cursor", "pending")),
        "pending_token": held & ~F.coalesce(c("pending_token") == token("pending"), never),
        "pending_payload": held & c("pending_kind").isNull(),
        "pending_not_certifying": held & c("promised").isNotNull() & ~F.coalesce(c("pending_activates"), never) & ~F.coalesce(c("pending_certifies"), never),
        "second_reorg": c("promised").isNotNull() & (c("pending_kind") == "reorg"),
        "activation_ahead": c("activation") > current,
        "activation_missing": desired & (c("activation") > 0) & (c("activation") <= current) & (F.coalesce(acked, F.lit(0)) < c("activation")) & ~F.coalesce((pending == c("activation")) & c("pending_activates"), never),
        "revision_not_acknowledged": desired & ((c("activation") == 0) & ~F.coalesce(c("pending_activates"), never) | (c("activation") > 0) & (F.coalesce(acked, F.lit(0)) >= c("activation"))) & ~F.coalesce(c("acked_revision") == c("revision"), never),
    }
    return violations(rows, rules, F.concat_ws(":", "session_id", "row"))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out


def reorg_then_replacement(reorgs: DataFrame, replacements: DataFrame, acks: DataFrame) -> DataFrame:
    """The deliveries that reorgs give rise to: first the control, and once it is acknowledged the replacement.

    reorgs(session, sequence, token, ancestor, new_tip), replacements(session, number, ...) the blocks of the new branches, acks(session,
    sequence, token). -> session, sequence, step (control, replacement, held), number (null: the control) and the
    other columns of a replacement. A control that is not acknowledged with its token holds its replacement and
    every later reorg of the session back; blocks at or below the ancestor or above the promised tip are no part of it.
    """
    said = acks.select(*SLOT, "token").distinct().withColumn("acked", F.lit(True))
    r = reorgs.join(said, [*SLOT, "token"], "left").withColumn("acked", F.coalesce("acked", F.lit(False)))
    before = Window.partitionBy(*SESSION).orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("reached", F.coalesce(F.min(F.col("acked").cast("int")).over(before), F.lit(1)) == 1)
    more = [x for x in replacements.columns if x not in (*SESSION, "number")]
    control = r.select(*SLOT, F.when(F.col("reached"), "control").otherwise("held").alias("step"), F.lit(None).cast("long").alias("number"), *[F.lit(None).cast(replacements.schema[x].dataType).alias(x) for x in more])
    parts = r.select(*SLOT, "acked", "reached", F.explode(dyadic("ancestor + 1", "new_tip + 1")).alias("p")).select("*", "p.level", "p.part").drop("p")
    levels = F.broadcast(parts.agg(F.collect_set("level").alias("levels")))  # one row
    blocks = replacements.join(levels).withColumn("level", F.explode("levels")).withColumn("part", F.expr("shiftright(number, level)"))
    found = blocks.join(parts, [*SESSION, "level", "part"])
    step = F.when(F.col("reached") & F.col("acked"), "replacement").otherwise("held")
    return control.unionByName(found.select(*SLOT, step.alias("step"), "number", *more))


def reorg_promises(deliveries: DataFrame, block_rows: DataFrame) -> DataFrame:
    """What follows each reorg's promise of a new tip, up to the delivery that keeps it.

    deliveries have new_tip and new_tip_hash at reorgs; block_rows(page_id, number, hash, parent_hash) are the
    block rows of data deliveries. -> session, sequence, promised_at, verdict: kept (the page holds the new
    tip and from it a linked chain up to its head, and the cursor follows that head), not_certified,
    second_reorg, or waiting (other controls pass).
    """
    w = Window.partitionBy(*SESSION).orderBy("sequence")
    promise = F.last(F.when(F.col("payload_kind") == "reorg", F.struct(F.col("sequence").alias("at"), F.col("new_tip").alias("number"), F.col("new_tip_hash").alias("hash"))), ignorenulls=True)
    d = deliveries.withColumn("p", promise.over(w.rowsBetween(Window.unboundedPreceding, -1))).where("p IS NOT NULL")
    before = block_rows.select("page_id", (F.col("number") + 1).alias("number"), F.col("hash").alias("before"))
    linked = block_rows.join(before, ["page_id", "number"], "left").select("page_id", "number", "hash", (F.col("before").isNull() | (F.col("before") != F.col("parent_hash"))).alias("bent"))
    above = d.where("payload_kind = 'data'").select(*SLOT, "page_id", "p").join(linked, "page_id").where(F.col("number") >= F.col("p.number"))
    own = F.col("number") == F.col("p.number")
    seen = above.groupBy(*SLOT).agg(
        F.count_if(own & (F.col("hash") == F.col("p.hash"))).alias("tips"), F.count_if(~own & F.col("bent")).alias("bent"), F.max("number").alias("top"), F.max_by("hash", "number").alias("top_hash")
    )
    d = d.join(seen, SLOT, "left")
    held = (F.col("tips") == 1) & (F.col("bent") == 0) & (F.col("top") == F.col("head_number")) & (F.col("top_hash") == F.col("head_hash")) & (F.col("next_block") == F.col("head_number") + 1)
    d = d.withColumn("kept", F.coalesce(held, F.lit(False)))
    since = Window.partitionBy(*SESSION, "p.at").orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    open_ = d.withColumn("done", F.coalesce(F.max("kept").over(since), F.lit(False))).where(~F.col("done"))
    verdict = F.when(F.col("kept"), "kept").when(F.col("payload_kind") == "data", "not_certified").when(F.col("payload_kind") == "reorg", "second_reorg").otherwise("waiting")
    return open_.select(*SLOT, F.col("p.at").alias("promised_at"), verdict.alias("verdict"))


def delivery_sizes(records: DataFrame, by: list[str]) -> DataFrame:
    """Estimated bytes of each delivery: its records and a frame of 16."""
    return records.groupBy(*by).agg((F.sum(accounted_bytes("topics", "data", "owners")) + 16).alias("bytes"))


def delivery_digests(records: DataFrame, by: list[str]) -> DataFrame:
    """One ordered digest of each delivery. Records of a delivery are bounded by its admission limits."""
    return records.groupBy(*by).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "digest"))), lambda x: x["digest"]), ","), 256).alias("digest"))
