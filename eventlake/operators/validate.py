"""Structural validation: every rule gives rows of a violations table; `strict` raises on any."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.fields import fixed_width, normalize_topics, quantity, topics_problem  # noqa: F401

ROWS_A_TASK = 1 << 16  # logs


class Violation(ValueError):
    """Raised by strict() with the first violations."""


def strict(violations: DataFrame) -> None:
    rows = violations.take(5)
    if rows:
        raise Violation("; ".join(str(r.asDict()) for r in rows))


def _by_block(logs: DataFrame, n: int | None = None) -> DataFrame:
    """Logs dealt by their block's hash, so that what must be single in a block is counted where it then is; a partition for every
    ROWS_A_TASK of their number `n`, where that is known."""
    return logs.repartition("block_hash") if n is None else logs.repartition(max(1, -(-n // ROWS_A_TASK)), "block_hash")


def duplicate_logs(logs: DataFrame) -> DataFrame:
    return _by_block(logs.select("block_hash", "log_index")).groupBy("block_hash", "log_index").agg(F.count("*").alias("n")).where("n > 1")


def identity_conflicts(logs: DataFrame, n: int | None = None) -> DataFrame:
    """(rule, block_hash, key) of transaction_conflicts, and duplicate_log with the log's index: logs are shuffled once, and
    sorted groups keep the least and greatest value instead of the distinct ones."""
    index = F.col("transaction_index").cast("string")
    one = lambda rule, key, value: F.struct(F.lit(rule).alias("rule"), key.alias("key"), value.alias("value"))
    held = F.array(one("duplicate_log", F.col("log_index").cast("string"), F.lit(None).cast("string")), one("hash_with_two_indexes", F.col("transaction_hash"), index), one("index_with_two_hashes", index, F.col("transaction_hash")))
    rows = _by_block(logs.select("block_hash", "log_index", "transaction_index", "transaction_hash"), n).select("block_hash", F.explode(held).alias("held")).select("block_hash", "held.*")
    g = rows.groupBy("block_hash", "rule", "key").agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
    return g.where(F.when(F.col("rule") == "duplicate_log", F.col("n") > 1).otherwise(F.col("least") < F.col("most"))).select("rule", "block_hash", "key")


def transaction_conflicts(logs: DataFrame) -> DataFrame:
    """(rule, block_hash, key): a hash with two indexes, or an index with two hashes, within a block."""
    return identity_conflicts(logs).where("rule <> 'duplicate_log'")


def block_identity_conflicts(records: DataFrame) -> DataFrame:
    return records.groupBy("number").agg(F.count_distinct(F.struct("hash", "timestamp")).alias("n")).where("n > 1")


def repeated_kind(records: DataFrame, kind: int) -> DataFrame:
    return records.where(F.col("kind") == kind).groupBy("page_id", "number").agg(F.count("*").alias("n")).where("n > 1")


def coverage_certificates(records: DataFrame) -> DataFrame:
    """Pages whose highest progress is below their highest broadcast record."""
    top = lambda c: F.max(F.when(c, F.col("number")))
    g = records.groupBy("page_id").agg(top(F.col("kind") == 2).alias("progress"), top(F.col("canonical") & (F.col("kind") != 2)).alias("broadcast"))
    return g.where(F.col("broadcast").isNotNull() & (F.col("progress").isNull() | (F.col("progress") < F.col("broadcast"))))


def order_violations(records: DataFrame, page: str = "page_id") -> DataFrame:
    key = F.struct("number", "kind", "transaction_index", "log_index")
    before = F.lag(key).over(Window.partitionBy(page).orderBy("ordinal"))
    return records.select(page, "ordinal", (before > key).alias("bad")).where("bad").select(page, "ordinal")


def log_block_hash(logs: DataFrame, blocks: DataFrame) -> DataFrame:
    b = blocks.select(F.col("number").alias("block_number"), "hash")
    return logs.join(b, "block_number").where("hash <> block_hash").select("block_number", "log_index", "block_hash")


def _log_shape() -> dict[str, Column]:
    """What makes the fields of a log unusable."""
    problem = topics_problem()
    return {
        "missing_field": F.col("transaction_index").isNull() | F.col("log_index").isNull() | F.col("data").isNull() | F.col("removed").isNull() | F.col("address").isNull(),
        "address_width": ~fixed_width("address", 20) & F.col("address").isNotNull(),
        "transaction_hash_width": ~fixed_width("transaction_hash", 32),
        "too_many_topics": F.coalesce(problem == "too_many_topics", F.lit(False)),
        "topic_after_null": F.coalesce(problem == "topic_after_null", F.lit(False)),
        "topic_width": F.exists("topics", lambda t: t.isNotNull() & ~t.rlike("^[0-9a-f]{64}$")),
    }


def validate_page(blocks: DataFrame, logs: DataFrame, from_block: int, next_block: int, target: int | None = None, archive_height: int | None = None, limits: tuple[int, int, int] | None = None) -> DataFrame:
    """(rule, key) of all structural rules over a range of blocks and its logs.

    Blocks are read once against their predecessors, logs once against their blocks, and once for the
    three keys that must be single in a block. limits are the blocks, logs and bytes of a response.
    """
    from eventlake.operators.canonical import link_violations
    from eventlake.operators.scan import broken, violations

    out = link_violations(blocks, F.lit(0)).select("rule", F.col("number").cast("string").alias("key"))
    bounds = blocks.agg(F.min("number").alias("low"), F.max("number").alias("high"), F.count("*").alias("n_blocks"))
    sizes = logs.agg(F.count("*").alias("n_logs"), F.sum(F.octet_length("data") + 32 * F.size("topics")).alias("bytes"))
    most = [F.lit(x) for x in limits or (None, None, None)]
    page = {
        "starts_elsewhere": F.col("low") != from_block,
        "ends_elsewhere": F.col("high") != next_block - 1,
        "no_progress": F.lit(next_block <= from_block),
        "cursor_beyond_target": F.lit(target is not None and next_block > target),
        "archive_behind_cursor": F.lit(archive_height is not None and archive_height < next_block),
        "response_limit": (F.col("n_blocks") > most[0]) | (F.col("n_logs") > most[1]) | (F.col("bytes") > most[2]),
    }
    out = out.unionByName(violations(bounds.join(sizes), page, F.lit("range")))  # one row each
    missing = F.col("number").isNull() | F.col("hash").isNull() | F.col("parent_hash").isNull() | F.col("timestamp").isNull()
    fields = {"block_hash_width": ~fixed_width("hash", 32), "parent_hash_width": ~fixed_width("parent_hash", 32), "missing_field": missing, "quantity_overflow": F.col("timestamp").cast("decimal(38,0)") > F.lit("18446744073709551615").cast("decimal(38,0)")}
    out = out.unionByName(violations(blocks, fields, F.col("number")))
    n = logs.count()
    known = blocks.select(F.col("number").alias("block_number"), F.col("hash").alias("own_hash"))
    alone = {"log_out_of_range": (F.col("block_number") < from_block) | (F.col("block_number") >= next_block), "log_removed": F.col("removed")} | _log_shape()
    # Only what a log's own fields say of it goes on to its block, so a task sorts narrow rows and a bounded number.
    slim = logs.select("block_number", "log_index", "block_hash", broken(alone).alias("own_rules")).repartition(max(1, -(-n // ROWS_A_TASK)), "block_number")
    rules = {"log_without_block": F.col("own_hash").isNull(), "log_block_hash": F.col("own_hash") != F.col("block_hash")}
    met = slim.join(known, "block_number", "left").select(F.explode(F.concat("own_rules", broken(rules))).alias("rule"), F.concat_ws(":", "block_number", "log_index").alias("key"))
    out = out.unionByName(met)
    return out.unionByName(identity_conflicts(logs, n).select("rule", F.concat_ws(":", "block_hash", "key").alias("key")))


def validate_records(records: DataFrame, owners: DataFrame, commitment: Column | None = None) -> DataFrame:
    """(rule, key) of the rules over event-table records: scope, audience, order, log shape, single identities,
    headers, catch-up and coverage. `commitment` is the hash that a header's own columns give.

    The records are computed once: what the rules look at is written to the shared folder and read from there.
    """
    from eventlake.operators.hybrid import SCOPES
    from eventlake.operators.scan import broken, violations
    from eventlake.sources.scratch import shared_path

    kind, n_owners = F.col("kind"), F.size("owners")
    catchup = F.col("scope") == "OWNER_CATCHUP"
    shape = F.lit(False)
    for bad in _log_shape().values():
        shape = shape | F.coalesce(bad, F.lit(False))
    rules = {
        "scope_unknown": ~F.coalesce(F.col("scope").isin(*SCOPES), F.lit(False)),
        "broadcast_names_owners": F.col("canonical") & (n_owners > 0),
        "owner_audience_empty": ~F.col("canonical") & (n_owners == 0),
        "owner_repeated": n_owners != F.size(F.array_distinct("owners")),
        "catchup_broadcast": catchup & F.col("canonical"),
        "catchup_progress": catchup & (kind == 2),
        "event_missing": ~F.coalesce(kind.isin(0, 1, 2), F.lit(False)),
        "log_shape": (kind == 1) & shape,
    }
    if commitment is not None:
        rules["header_mismatch"] = (kind == 0) & (F.col("block_hash") != commitment)
    key, path = F.concat_ws(":", "page_id", "ordinal"), shared_path(records.sparkSession, "records")
    looked_at = ["page_id", "ordinal", "number", "kind", "transaction_index", "log_index", "canonical", "owners", "block_hash", "block_timestamp", "transaction_hash"]
    records.select(*looked_at, broken(rules).alias("own_rules")).write.parquet(path)
    records = records.sparkSession.read.parquet(path)
    out = records.select(F.explode("own_rules").alias("rule"), key.alias("key"))
    named = records.select(key.alias("key"), F.explode(F.array_distinct("owners")).alias("owner_id"))
    out = out.unionByName(named.join(owners.select("owner_id").distinct(), "owner_id", "left_anti").select(F.lit("owner_unknown").alias("rule"), "key"))
    out = out.unionByName(order_violations(records).select(F.lit("event_order").alias("rule"), key.alias("key")))
    logs = records.where(kind == 1)
    rule = F.when(F.col("rule") == "duplicate_log", F.col("rule")).otherwise("transaction_identity").alias("rule")
    out = out.unionByName(identity_conflicts(logs, logs.count()).select(rule, F.concat_ws(":", "block_hash", "key").alias("key")))
    block = F.struct("block_hash", "block_timestamp")
    of_block = records.where(kind.isin(0, 2)).groupBy("page_id", "number").agg(F.count_if(kind == 0).alias("headers"), F.count_if(kind == 2).alias("progress"), (F.min(block) < F.max(block)).alias("blocks"))
    single = {"duplicate_header": F.col("headers") > 1, "duplicate_progress": F.col("progress") > 1, "block_identity": F.col("blocks")}
    out = out.unionByName(violations(of_block, single, F.concat_ws(":", "page_id", "number")))
    return out.unionByName(coverage_certificates(records).select(F.lit("missing_certificate").alias("rule"), F.col("page_id").cast("string").alias("key")))


def validate_guard(pages: DataFrame, blocks: DataFrame, page_blocks: int) -> DataFrame:
    """(rule, key) where a page's guard is not its ends."""
    from eventlake.operators.scan import page_guard, violations

    real = page_guard(blocks, page_blocks)
    names = [c for c in real.columns if c != "page_id"]
    j = pages.join(real.select("page_id", *[F.col(c).alias(f"real_{c}") for c in names]), "page_id")
    return violations(j, {c: ~F.col(c).eqNullSafe(F.col(f"real_{c}")) for c in names}, F.col("page_id"))
