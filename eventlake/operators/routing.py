"""Interest matching, owner activity, audiences and the normalized event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.intervals import dyadic

HEADER, LOG, PROGRESS = 0, 1, 2
MAX_FILTERS = 4096
SLICE = 1024  # targets that a row lists


def log_matches(topics: Column, address: Column, addresses: Column, accepted: Column) -> Column:
    """Any address or a listed one, and at every position any topic or an accepted one that exists."""
    positions = F.forall(F.transform(accepted, lambda v, i: (F.size(v) == 0) | F.coalesce(F.array_contains(v, F.get(topics, i)), F.lit(False))), lambda ok: ok)
    return ((F.size(addresses) == 0) | F.array_contains(addresses, address)) & positions


def covers(number: Column, from_block: str = "from_block", to_excl: str = "to_block_excl") -> Column:
    """Whether a half-open, possibly open-ended backfill holds the block; false without one."""
    return F.coalesce((F.col(from_block) <= number) & (F.col(to_excl).isNull() | (number < F.col(to_excl))), F.lit(False))


def global_backfill(owners: DataFrame, number: Column) -> Column:
    """Whether the own backfill of a canonical owner holds the block: then everything counts for everyone.

    Canonical owners are configuration, one as a rule and MAX_FILTERS at most (checked), so their
    ranges become part of the expression.
    """
    spans = owners.where("canonical AND from_block IS NOT NULL").select("from_block", "to_block_excl").distinct().limit(MAX_FILTERS + 1).collect()
    if len(spans) > MAX_FILTERS:
        raise ValueError("too many canonical owners")
    held = F.lit(False)
    for low, high in spans:
        held = held | ((number >= low) & (F.lit(True) if high is None else number < high))
    return held


def interest_active(number: Column, activation: int, everyone: Column | None = None) -> Column:
    base = (number >= activation) | covers(number)
    return base if everyone is None else base | everyone


def counts_for_all(number: Column, activation: int, everyone: Column | None = None) -> Column:
    """Whether a block is part of the coverage: live, or in a global backfill."""
    return number >= activation if everyone is None else (number >= activation) | everyone


def blocks_held(blocks: DataFrame, spans: DataFrame) -> DataFrame:
    """spans(low, high) -> of_low, of_high, n_blocks and first_block of the half-open ranges (null: open) that hold any block.

    Different ranges become dyadic intervals; blocks are counted once a size of interval in use and met by equal keys,
    so the work is linear in blocks and ranges.
    """
    ends = F.broadcast(blocks.agg(F.min("number").alias("least"), (F.max("number") + 1).alias("beyond")))  # one row
    spans = spans.select("low", "high").where("low IS NOT NULL").distinct().select(F.col("low").alias("of_low"), F.col("high").alias("of_high")).join(ends)
    spans = spans.select("of_low", "of_high", F.explode(dyadic("greatest(of_low, least)", "least(coalesce(of_high, beyond), beyond)")).alias("p")).select("of_low", "of_high", "p.*")
    levels = F.broadcast(spans.agg(F.collect_set("level").alias("levels")))  # one row
    held = blocks.select("number").join(levels).select("number", F.explode("levels").alias("level"))
    held = held.groupBy("level", F.expr("shiftright(number, level)").alias("part")).agg(F.count("*").alias("n"), F.min("number").alias("first"))
    return spans.join(held, ["level", "part"]).groupBy("of_low", "of_high").agg(F.sum("n").alias("n_blocks"), F.min("first").alias("first_block"))


def active_blocks(blocks: DataFrame, owners: DataFrame, activation: int) -> DataFrame:
    """owner_id, n_blocks, first_block of the blocks at which each owner is active; owners without any are left out.

    What counts for all is counted once for all, an owner's own backfill over the other blocks.
    """
    shared = counts_for_all(F.col("number"), activation, global_backfill(owners, F.col("number")))
    both = F.broadcast(blocks.where(shared).agg(F.count("*").alias("shared"), F.min("number").alias("shared_first")))  # one row
    o = owners.select("owner_id", F.col("from_block").alias("low"), F.col("to_block_excl").alias("high"))
    own = blocks_held(blocks.where(~shared), o)
    m = o.join(own, (F.col("low") == F.col("of_low")) & F.col("high").eqNullSafe(F.col("of_high")), "left").join(both).select("owner_id", (F.coalesce("n_blocks", F.lit(0)) + F.col("shared")).alias("n"), F.least("first_block", "shared_first").alias("first"))
    return m.where("n > 0").groupBy("owner_id").agg(F.sum("n").alias("n_blocks"), F.min("first").alias("first_block"))


def scope_of(number: Column, activation: int, everyone: Column | None = None) -> Column:
    return F.when(counts_for_all(number, activation, everyone), "CANONICAL_PROGRESS").otherwise("OWNER_CATCHUP")


def advances_canonical(scope: Column) -> Column:
    return scope.isin("CANONICAL", "CANONICAL_PROGRESS")


def attach_block_context(logs: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(logs with the timestamp of their block, logs without a block)."""
    b = blocks.select(F.col("number").alias("block_number"), "timestamp")
    return logs.drop("block_timestamp").join(b, "block_number"), logs.join(b, "block_number", "left_anti")


def _targets(interests: DataFrame, owners: DataFrame) -> DataFrame:
    """The log interests of owners that are there, each as one target. Their number is checked."""
    i = interests.where("kind = 'log'").join(owners, "owner_id")
    return i.select("addresses", F.struct(F.col("topics").alias("accepted"), "owner_id", "canonical", "from_block", "to_block_excl").alias("target"))


def checked(config: DataFrame) -> DataFrame:
    """Configured rows that become part of every row's plan: MAX_FILTERS at most."""
    if config.limit(MAX_FILTERS + 1).count() > MAX_FILTERS:
        raise ValueError("too many rows of configuration")
    return config


def _index(targets: DataFrame, slice_size: int) -> tuple[DataFrame, DataFrame]:
    """(address, listed) of addresses with up to `slice_size` targets, and (address, slice, listed) of the others.

    The targets of a hot address are dealt into slices by owner, so no row lists more than a few `slice_size`.
    """
    flat = targets.withColumn("address", F.explode(F.array_distinct("addresses"))).select("address", "target")
    n = flat.groupBy("address").agg(F.count("*").alias("n"))
    hot = n.where(F.col("n") > slice_size).select("address", F.ceil(F.col("n") / slice_size).alias("slices"))
    cold = flat.join(hot, "address", "left_anti").groupBy("address").agg(F.collect_list("target").alias("listed"))
    dealt = flat.join(hot, "address").withColumn("slice", F.pmod(F.xxhash64("target.owner_id", "target.accepted"), F.col("slices")))
    return cold, dealt.groupBy("address", "slice").agg(F.collect_list("target").alias("listed"))


def route_logs(logs: DataFrame, interests: DataFrame, owners: DataFrame, activation: int, slice_size: int = SLICE) -> DataFrame:
    """The logs that reach anyone, with canonical (everyone) and owners (sorted, distinct, or none for everyone).

    A log meets the targets that list its address, gathered by address, and those that take any address, which are a
    checked few; its audience is read off them in its own row. Addresses are joined by key, whatever their
    number. An address with more than `slice_size` targets is looked up slice by slice: a log of it meets each slice in a row of its
    own, and the audiences are merged. Rows that repeat are routed alike and kept.
    """
    targets = _targets(interests, owners)
    wild = checked(targets.where(F.size("addresses") == 0).select("target")).agg(F.collect_list("target").alias("wild"))
    cold, hot = _index(targets, slice_size)
    everyone = global_backfill(owners, F.col("block_number"))
    live = F.col("block_number") >= activation

    def met(rows: DataFrame) -> DataFrame:
        """Rows with their `listed` and `wild` targets -> canonical and owners."""
        none = F.array().cast(cold.schema["listed"].dataType)

        def reached(t: Column) -> Column:
            own = F.coalesce((t["from_block"] <= F.col("block_number")) & (t["to_block_excl"].isNull() | (F.col("block_number") < t["to_block_excl"])), F.lit(False))
            match = F.forall(F.transform(t["accepted"], lambda v, k: (F.size(v) == 0) | F.coalesce(F.array_contains(v, F.get("topics", k)), F.lit(False))), lambda ok: ok)
            return (F.col("everyone") | F.col("live") | own) & match

        rows = rows.withColumns({"everyone": everyone, "live": live})
        rows = rows.withColumn("met", F.filter(F.concat(F.coalesce("listed", none), F.coalesce("wild", none)), reached)).where(F.size("met") > 0)
        rows = rows.withColumn("canonical", F.col("everyone") | F.exists("met", lambda t: t["canonical"] & F.col("live")))
        names = F.array_sort(F.array_distinct(F.transform(F.filter("met", lambda t: ~t["canonical"] | F.col("live")), lambda t: t["owner_id"])))
        return rows.withColumn("owners", F.when(F.col("canonical"), F.array().cast("array<string>")).otherwise(names))

    one_row = F.broadcast(wild)
    if hot.isEmpty():  # configuration as a rule has no such address, and logs are then shuffled once
        return drop_unrouted(met(logs.join(cold, "address", "left").join(one_row)).select(*logs.columns, "canonical", "owners"))
    plain = met(logs.join(hot, "address", "left_anti").join(cold, "address", "left").join(one_row)).select(*logs.columns, "canonical", "owners")
    first = hot.groupBy("address").agg(F.min("slice").alias("slice")).withColumn("first", F.lit(True))
    sliced = logs.join(hot.join(first, ["address", "slice"], "left"), "address").join(one_row)
    sliced = met(sliced.withColumn("wild", F.when(F.col("first"), F.col("wild")))).select(*logs.columns, "slice", "canonical", "owners")
    once = sliced.groupBy(*logs.columns, "slice", "canonical", "owners").agg(F.count("*").alias("copies"))
    merged = once.groupBy(*logs.columns).agg(F.bool_or("canonical").alias("canonical"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("owners")))).alias("owners"), F.max("copies").alias("copies"))
    merged = merged.withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
    merged = merged.select(*logs.columns, "canonical", F.when(F.col("canonical"), F.array().cast("array<string>")).otherwise(F.col("owners")).alias("owners"))
    return drop_unrouted(plain.unionByName(merged))


def header_rows(blocks: DataFrame, interests: DataFrame, owners: DataFrame, activation: int) -> DataFrame:
    """Headers wanted by an active owner with a block interest: blocks, canonical, owners."""
    wanting = interests.where("kind = 'block'").join(owners, "owner_id").select("owner_id", "canonical", "from_block", "to_block_excl").distinct()
    every = checked(wanting).agg(F.collect_list(F.struct("owner_id", "canonical", "from_block", "to_block_excl")).alias("wanting"))
    n = F.col("number")
    rows = blocks.join(F.broadcast(every)).withColumns({"everyone": global_backfill(owners, n), "live": n >= activation})  # one row
    own = lambda t: F.coalesce((t["from_block"] <= n) & (t["to_block_excl"].isNull() | (n < t["to_block_excl"])), F.lit(False))
    rows = rows.withColumn("met", F.filter("wanting", lambda t: F.col("everyone") | F.col("live") | own(t))).where(F.size("met") > 0)
    rows = rows.withColumn("canonical", F.col("everyone") | (F.col("live") & F.exists("met", lambda t: t["canonical"])))
    names = F.array_sort(F.array_distinct(F.transform("met", lambda t: t["owner_id"])))
    return rows.select(*blocks.columns, "canonical", F.when(F.col("canonical"), F.array().cast("array<string>")).otherwise(names).alias("owners"))


def progress_rows(blocks: DataFrame, owners: DataFrame, activation: int) -> DataFrame:
    """The blocks that count as coverage, for everyone: live ones and those of a global backfill."""
    held = counts_for_all(F.col("number"), activation, global_backfill(owners, F.col("number")))
    return blocks.where(held).withColumns({"canonical": F.lit(True), "owners": F.array().cast("array<string>")})


PAYLOAD = {"transaction_hash": "string", "address": "string", "topics": "array<string>", "data": "string", "removed": "boolean"}


def normalize(blocks: DataFrame, logs: DataFrame, interests: DataFrame, owners: DataFrame, activation: int, page_blocks: int) -> DataFrame:
    """The event table: header (0), log (1) and progress (2) rows, routed and ordered within each page.

    Columns: number, kind, transaction_index, log_index, canonical, owners, block_hash, block_timestamp, the
    fields of a log (null in the other rows), scope, page_id, ordinal. Rows that reach neither everyone
    nor an owner are dropped. Pages bound the ordering window, so no task sorts more than a page.
    """
    zero = F.lit(0).cast("long")
    none = [F.lit(None).cast(kind).alias(c) for c, kind in PAYLOAD.items()]
    of_block = lambda df, kind: df.select("number", F.lit(kind).cast("long").alias("kind"), zero.alias("transaction_index"), zero.alias("log_index"), "canonical", "owners", F.col("hash").alias("block_hash"), F.col("timestamp").alias("block_timestamp"), *none)
    head, progress = of_block(header_rows(blocks, interests, owners, activation), HEADER), of_block(progress_rows(blocks, owners, activation), PROGRESS)
    log = route_logs(logs, interests, owners, activation).select(F.col("block_number").alias("number"), F.lit(LOG).cast("long").alias("kind"), "transaction_index", "log_index", "canonical", "owners", "block_hash", "block_timestamp", *PAYLOAD)
    rows = head.unionByName(log).unionByName(progress)
    page = F.floor(F.col("number") / page_blocks)
    order = Window.partitionBy(page).orderBy("number", "kind", "transaction_index", "log_index")
    scope = scope_of(F.col("number"), activation, global_backfill(owners, F.col("number")))
    return rows.select("*", scope.alias("scope"), page.alias("page_id"), F.row_number().over(order).cast("long").alias("ordinal"))


def drop_unrouted(records: DataFrame) -> DataFrame:
    return records.where(F.col("canonical") | (F.size("owners") > 0))


def certify_tail(records: DataFrame, heads: DataFrame) -> DataFrame:
    """The records, and a progress row for each page with records whose head no broadcast header or progress
    row names. A log does not certify its block. The row stands behind the page's last one."""
    certified = records.where(F.col("canonical") & (F.col("kind") != LOG)).select("page_id", F.col("number").alias("head_number")).distinct()
    last = records.groupBy("page_id").agg((F.max("ordinal") + 1).alias("ordinal"))
    bare = heads.where("head_number IS NOT NULL AND NOT carried").join(last, "page_id").join(certified, ["page_id", "head_number"], "left_anti")
    row = {"number": F.col("head_number"), "kind": F.lit(PROGRESS).cast("long"), "canonical": F.lit(True), "owners": F.array().cast("array<string>"), "block_hash": F.col("head_hash"), "scope": F.lit("CANONICAL_PROGRESS"), "page_id": F.col("page_id"), "ordinal": F.col("ordinal")}
    zero = {"transaction_index": F.lit(0).cast("long"), "log_index": F.lit(0).cast("long")}
    filled = row | zero
    return records.unionByName(bare.select(*[filled.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in records.schema.fields]))


def page_head(blocks: DataFrame, owners: DataFrame, activation: int, page_blocks: int) -> DataFrame:
    """page_id, head_number, head_hash, carried: the highest block of each page that counts as coverage; a page
    without one keeps the head of the page before (carried), and pages before the first have null.

    Pages are few beside blocks; the heads of a thousand pages are carried together.
    """
    n = F.when(counts_for_all(F.col("number"), activation, global_backfill(owners, F.col("number"))), F.col("number"))
    heads = blocks.groupBy(F.floor(F.col("number") / page_blocks).alias("page_id")).agg(F.max_by(F.struct("number", "hash"), n).alias("own"))
    heads = heads.withColumn("block", F.floor(F.col("page_id") / 1024))
    tops = heads.groupBy("block").agg(F.max_by("own", F.when(F.col("own").isNotNull(), F.col("page_id"))).alias("top"))
    tops = tops.select("block", F.last("top", ignorenulls=True).over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    inside = Window.partitionBy("block").orderBy("page_id").rowsBetween(Window.unboundedPreceding, 0)
    kept = heads.join(tops, "block").withColumn("head", F.coalesce(F.last("own", ignorenulls=True).over(inside), "before"))
    return kept.select("page_id", F.col("head.number").alias("head_number"), F.col("head.hash").alias("head_hash"), F.col("own").isNull().alias("carried"))


def empty_page_barriers(pages: DataFrame, records: DataFrame, heads: DataFrame, revision: int) -> DataFrame:
    """Pages without records -> their barrier with the head so far; neutral where the page moves no head."""
    empty = pages.select("page_id", "next_block").join(records.select("page_id").distinct(), "page_id", "left_anti").join(heads, "page_id", "left")
    return empty.select("page_id", F.concat_ws(":", F.lit("source-progress"), F.lit(str(revision)), F.col("next_block").cast("string")).alias("barrier_id"), "head_number", (F.col("head_number").isNull() | F.col("carried")).alias("checkpoint_neutral"))


def number_deliveries(rows: DataFrame, session: list[str], page: str, control: Column, base: int = 0) -> DataFrame:
    """A running sequence by session: controls take the slot before the data of their page."""
    order = Window.partitionBy(*session).orderBy(page, (~control))
    return rows.withColumn("sequence", F.row_number().over(order).cast("long") + base)


def decode_batch(records: DataFrame) -> DataFrame:
    """One row a record with its block context, status and source. Removed logs come back as reorged."""
    return records.withColumns({
        "block": F.struct(F.col("number"), F.col("block_hash").alias("hash"), F.col("block_timestamp").alias("timestamp")),
        "confirmations": F.lit(0).cast("long"),
        "status": F.when(F.coalesce(F.col("removed"), F.lit(False)), "reorged").otherwise("included"),
        "source": F.when(F.col("scope") == "OWNER_CATCHUP", "backfill").otherwise("subscription"),
    })


def deduplicable(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that may be deduplicated, those that always pass): removals and reorged records are signals."""
    signal = F.coalesce(F.col("removed"), F.lit(False)) | (F.col("status") == "reorged")
    return records.where(~signal), records.where(signal)


def proves_coverage(kind: Column, status: Column, number: Column) -> Column:
    """Whether an input proves that its block is covered: a record that is included, safe or finalized,
    progress, or a barrier with a block. Safe and finalized controls and blockless barriers do not."""
    record = (kind == "record") & status.isin("included", "safe", "finalized")
    return F.coalesce(record | (kind == "progress") | ((kind == "barrier") & number.isNotNull()), F.lit(False))


def compact_progress(records: DataFrame) -> DataFrame:
    """The highest progress of each page, as its trailing control."""
    return records.where(F.col("kind") == PROGRESS).groupBy("page_id").agg(F.max("number").alias("number"))


def log_context(logs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Logs with the parent and timestamp of their block, from the block rows of the same delivery."""
    b = blocks.select(F.col("number").alias("block_number"), F.col("parent_hash").alias("block_parent"), F.col("timestamp").alias("own_timestamp"))
    return logs.join(b, "block_number", "left").withColumn("block_timestamp", F.coalesce("own_timestamp", "block_timestamp")).drop("own_timestamp")
