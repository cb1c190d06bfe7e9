"""Range scans, point lookups, page building and admission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.operators.routing import MAX_FILTERS, log_matches

MAX_PAGE_BLOCKS, MAX_PAGE_LOGS, MAX_PAGE_BYTES = 2000, 10000, 16 << 20


def block_range(df: DataFrame, number: str, from_block: int, to_excl: int | None = None) -> DataFrame:
    """Rows of a half-open block range; the bounds are plain comparisons, so they reach the scan."""
    if to_excl is not None and to_excl <= from_block:
        raise ValueError("an empty block range")
    out = df.where(F.col(number) >= from_block)
    return out if to_excl is None else out.where(F.col(number) < to_excl)


def scan_logs(logs: DataFrame, interests: DataFrame, from_block: int, to_excl: int | None = None) -> DataFrame:
    """Logs of the range that match any log interest. Filters that list addresses are gathered by address and
    joined by it, whatever their number; the others go to every row and are of a checked number."""
    filters = compile_filters(interests)
    found = block_range(logs, "block_number", from_block, to_excl)
    free = filters.where(F.size("addresses") == 0).select("topics")
    if free.limit(MAX_FILTERS + 1).count() > MAX_FILTERS:
        raise ValueError("too many distinct filters")
    wild = free.agg(F.collect_list("topics").alias("wild"))
    listed = filters.select(F.explode("addresses").alias("address"), "topics").groupBy("address").agg(F.collect_list("topics").alias("listed"))
    none = F.array().cast(listed.schema["listed"].dataType)
    met = found.join(listed, "address", "left").join(F.broadcast(wild))  # wild is one row
    no_address = F.array().cast("array<string>")
    hit = F.exists(F.concat(F.coalesce("listed", none), "wild"), lambda accepted: log_matches(F.col("topics"), F.col("address"), no_address, accepted))
    return met.where(hit).select(*found.columns)


def canonical_interests(interests: DataFrame) -> DataFrame:
    """Sorted, distinct addresses and values by position; trailing wildcard positions trimmed, inner ones kept."""
    values = F.transform("topics", lambda v: F.array_sort(F.array_distinct(v)))
    width = F.array_max(F.transform(values, lambda v, i: F.when(F.size(v) > 0, i + 1).otherwise(0)))
    return interests.withColumns({"addresses": F.array_sort(F.array_distinct("addresses")), "topics": F.slice(values, F.lit(1), F.coalesce(width, F.lit(0)))})


def compile_filters(interests: DataFrame) -> DataFrame:
    """Distinct canonical log filters; one that matches everything stands for all."""
    c = canonical_interests(interests.where("kind = 'log'")).select("addresses", "topics").distinct()
    everything = (F.size("addresses") == 0) & (F.size("topics") == 0)
    any_ = c.agg(F.coalesce(F.bool_or(everything), F.lit(False)).alias("any"))
    return c.join(F.broadcast(any_), ~F.col("any") | everything).select("addresses", "topics")


def project_blocks(blocks: DataFrame, interests: DataFrame) -> DataFrame:
    """The four compact columns, or all columns when any owner has a block interest."""
    full = not interests.where("kind = 'block'").isEmpty()
    return blocks if full else blocks.select("number", "hash", "parent_hash", "timestamp")


def lookup_blocks(blocks: DataFrame, heights: DataFrame) -> DataFrame:
    return blocks.join(heights.select("number").distinct(), "number", "left_semi")


def archive_height(blocks: DataFrame) -> DataFrame:
    """The exclusive height; null (unavailable) for no blocks or height 0."""
    return blocks.agg((F.max("number") + 1).alias("h")).select(F.when(F.col("h") > 0, F.col("h")).alias("archive_height"))


def assign_pages(blocks: DataFrame, logs: DataFrame, from_block: int, max_blocks: int = 1000, max_logs: int = 5000) -> DataFrame:
    """number, bucket, part: pages of at most max_blocks blocks and, but for the last block, max_logs logs."""
    counts = logs.groupBy(F.col("block_number").alias("number")).agg(F.count("*").alias("n_logs"))
    b = blocks.select("number").join(counts, "number", "left").na.fill(0, ["n_logs"])
    b = b.withColumn("bucket", F.floor((F.col("number") - from_block) / max_blocks))
    before = Window.partitionBy("bucket").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return b.select("number", "bucket", F.floor(F.coalesce(F.sum("n_logs").over(before), F.lit(0)) / max_logs).alias("part"), "n_logs")


def split_pages_to_bytes(sized: DataFrame, max_bytes: int) -> DataFrame:
    """sized(page_id, number, bytes) -> with sub_page: bytes before the block over the limit; `overflow`
    marks blocks that alone exceed it."""
    before = Window.partitionBy("page_id").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return sized.select("*", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / max_bytes).alias("sub_page"), (F.col("bytes") > max_bytes).alias("overflow"))


def admit_pages(blocks: DataFrame, logs: DataFrame, page_blocks: int, max_blocks: int = MAX_PAGE_BLOCKS, max_logs: int = MAX_PAGE_LOGS, max_bytes: int = MAX_PAGE_BYTES) -> DataFrame:
    """page_id, n_blocks, n_logs, bytes, admitted."""
    if min(max_blocks, max_logs, max_bytes) <= 0:
        raise ValueError("limits are positive")
    page = lambda c: F.floor(F.col(c) / page_blocks).alias("page_id")
    b = blocks.groupBy(page("number")).agg(F.count("*").alias("n_blocks"))
    l_ = logs.groupBy(page("block_number")).agg(F.count("*").alias("n_logs"), F.sum(F.octet_length("data") + 32 * F.size("topics")).alias("bytes"))
    out = b.join(l_, "page_id", "left").na.fill(0, ["n_logs", "bytes"])
    return out.withColumn("admitted", (F.col("n_blocks") <= max_blocks) & (F.col("n_logs") <= max_logs) & (F.col("bytes") <= max_bytes))


def page_cursor_checks(pages: DataFrame, target: int) -> DataFrame:
    rules = {
        "cursor_not_after_start": F.col("next_block") <= F.col("from_block"),
        "cursor_past_target": F.col("next_block") > target,
        "archive_behind_cursor": F.col("archive_height").isNotNull() & (F.col("archive_height") < F.col("next_block")),
    }
    return violations(pages, rules, F.col("page_id"))


def broken(rules: dict) -> Column:
    """The names of the rules that a row breaks."""
    return F.array_compact(F.array(*[F.when(c, F.lit(r)) for r, c in rules.items()]))


def violations(df: DataFrame, rules: dict, key) -> DataFrame:
    """One row (rule, key) for each rule that a row breaks."""
    return df.select(F.explode(broken(rules)).alias("rule"), key.cast("string").alias("key"))


def page_guard(blocks: DataFrame, page_blocks: int) -> DataFrame:
    return blocks.groupBy(F.floor(F.col("number") / page_blocks).alias("page_id")).agg(
        F.min("number").alias("guard_first"),
        F.min_by("parent_hash", "number").alias("guard_first_parent"),
        F.max("number").alias("guard_tip"),
        F.max_by("hash", "number").alias("guard_tip_hash"),
        F.max("timestamp").alias("guard_tip_timestamp"),
    )


def scan_start_and_activation(owners: DataFrame, cursor_next: int | None, cursor_revision: int | None, revision: int, height: int, checkpoint_activation: int | None = None) -> DataFrame:
    """One row (start, activation) of a resumed scan."""
    low = owners.agg(F.min("from_block").alias("low"))
    if cursor_next is None:
        return low.select(F.coalesce("low", F.lit(height)).cast("long").alias("start"), F.lit(height).cast("long").alias("activation"))
    if cursor_revision < revision:
        return low.select(F.least("low", F.lit(cursor_next)).cast("long").alias("start"), F.lit(cursor_next).cast("long").alias("activation"))
    return low.select(F.lit(cursor_next).cast("long").alias("start"), F.lit(checkpoint_activation).cast("long").alias("activation"))
