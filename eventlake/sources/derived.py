"""The event-log tables that the registered queries derive from the star schema's `events` table.

Thirteen blocks for eighteen events in a row, the first of six logs and the others of one, so heights and
all that stands on them grow with the events; owners and interests from the users seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GENESIS = 1704067200
ACTIVATION = 360
PAGE_BLOCKS = 50
SESSIONS = 8


def block_hash(number: Column, branch: int | Column = 0) -> Column:
    branch = branch if isinstance(branch, Column) else F.lit(branch)
    return F.sha2(F.concat(F.lit("b:"), number.cast("string"), F.lit(":"), branch.cast("string")), 256)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leveled(spark.read.parquet(f"{sf_dir}/events.parquet"))


def leveled(e: DataFrame) -> DataFrame:
    """Events with their height and the number in their properties."""
    return e.select(
        "event_id",
        F.expr("event_id div 18 * 13 + greatest(0, event_id % 18 - 5)").alias("number"),
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        "value",
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks_of(events(spark, sf_dir))


def blocks_of(e: DataFrame) -> DataFrame:
    n = e.select("number").distinct()
    c = F.col("number")
    return n.select("number", block_hash(c).alias("hash"), block_hash(c - 1).alias("parent_hash"), (F.lit(GENESIS) + 3600 * c).alias("timestamp"))


def block_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical blocks and, at heights 48 and 49 of every fifty, a stale branch that is replaced."""
    b = blocks(spark, sf_dir).withColumn("chain_id", F.lit(1).cast("long"))
    n = F.col("number")
    good = b.select("chain_id", (n * 10 + 5).alias("arrival"), "number", "hash", "parent_hash", "timestamp")
    stale = b.where(n % 50 >= 48).select(
        "chain_id",
        F.when(n % 50 == 48, n * 10).otherwise((n - 1) * 10 + 1).alias("arrival"),
        "number",
        block_hash(n, 1).alias("hash"),
        F.when(n % 50 == 48, block_hash(n - 1)).otherwise(block_hash(n - 1, 1)).alias("parent_hash"),
        (F.col("timestamp") + 1).alias("timestamp"),
    )
    return good.unionByName(stale)


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs_of(events(spark, sf_dir))


def logs_of(e: DataFrame) -> DataFrame:
    """The logs of whole blocks."""
    e = e.withColumn("log_index", F.row_number().over(Window.partitionBy("number").orderBy("event_id")).cast("long") - 1)
    n, tx = F.col("number"), F.floor(F.col("log_index") / 2)
    return e.select(
        n.alias("block_number"),
        block_hash(n).alias("block_hash"),
        F.sha2(F.concat(F.lit("x:"), n.cast("string"), F.lit(":"), tx.cast("string")), 256).alias("transaction_hash"),
        tx.alias("transaction_index"),
        "log_index",
        address(F.col("user_id")).alias("address"),
        F.array(F.sha2(F.concat(F.lit("t0:"), "event_type"), 256), F.sha2(F.concat(F.lit("t1:"), F.col("k").cast("string")), 256)).alias("topics"),
        F.col("event_id").cast("string").alias("data"),
        (F.lit(GENESIS) + 3600 * n).alias("block_timestamp"),
        F.lit(False).alias("removed"),
    )


def address(user_id: Column) -> Column:
    return F.substring(F.sha2(F.concat(F.lit("a:"), user_id.cast("string")), 256), 1, 40)


def log_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live view: stale copies of two logs in three at the replaced heights, and their removals."""
    good, n = logs(spark, sf_dir), F.col("block_number")
    copies = good.where((n % 50 >= 48) & (F.col("data").cast("long") % 3 != 0)).withColumn("block_hash", block_hash(n, 1))
    at = F.when(n % 50 == 48, n * 10).otherwise((n - 1) * 10 + 1)
    gone = F.when(n % 50 == 48, n * 10 + 4).otherwise((n - 1) * 10 + 4)
    return good.withColumn("arrival", n * 10 + 5).unionByName(copies.withColumn("arrival", at)).unionByName(copies.withColumn("arrival", gone).withColumn("removed", F.lit(True)))


def owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """owner_id, canonical, from_block, to_block_excl: the base owner, four named ones and one for every three users."""
    fixed = "values ('', true, 240, 300), ('errors', false, null, null), ('pool', false, 100, 200), ('low', false, 300, null), ('heads', false, 50, 60)"
    base = spark.sql(f"select cast(col1 as string) owner_id, col2 canonical, cast(col3 as bigint) from_block, cast(col4 as bigint) to_block_excl from {fixed}")
    user = events(spark, sf_dir).select(F.expr("user_id div 3").alias("j")).distinct()
    start = (F.col("j") % 50) * 100
    user = user.select(F.concat(F.lit("user"), F.col("j").cast("string")).alias("owner_id"), F.lit(False).alias("canonical"), start.alias("from_block"), (start + 150).alias("to_block_excl"))
    return base.unionByName(user)


def interests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """owner_id, interest_id, kind (log or block), addresses, topics (accepted values by position)."""
    h = lambda p, v: f"sha2('{p}:{v}', 256)"
    a = lambda u: f"substring(sha2('a:{u}', 256), 1, 40)"
    none = "cast(array() as array<string>)"
    low = ", ".join(h("t1", k) for k in range(1, 10))
    rows = [
        ("''", "base", "log", none, f"array(array({h('t0', 'purchase')}))"),
        ("'errors'", "all", "log", none, f"array(array({h('t0', 'error')}), {none})"),
        ("'pool'", "two", "log", f"array({a(46)}, {a(8)}, {a(46)})", f"cast(array() as array<array<string>>)"),
        ("'low'", "k", "log", none, f"array({none}, array({low}))"),
        ("'heads'", "any", "block", none, "cast(array() as array<array<string>>)"),
    ]
    base = spark.sql(" union all ".join(f"select {o} owner_id, '{i}' interest_id, '{k}' kind, {ad} addresses, {t} topics" for o, i, k, ad, t in rows))
    user = events(spark, sf_dir).groupBy(F.expr("user_id div 3").alias("j")).agg(F.sort_array(F.collect_set(address(F.col("user_id")))).alias("addresses"))
    user = user.select(F.concat(F.lit("user"), F.col("j").cast("string")).alias("owner_id"), F.lit("own").alias("interest_id"), F.lit("log").alias("kind"), "addresses", F.expr("cast(array() as array<array<string>>)").alias("topics"))
    return base.unionByName(user)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, from_block, next_block, archive_height and the guard of each page of fifty blocks."""
    b = blocks(spark, sf_dir).withColumn("page_id", F.floor(F.col("number") / PAGE_BLOCKS))
    p = b.groupBy("page_id").agg(
        F.min("number").alias("from_block"),
        (F.max("number") + 1).alias("next_block"),
        F.min("number").alias("guard_first"),
        F.min_by("parent_hash", "number").alias("guard_first_parent"),
        F.max("number").alias("guard_tip"),
        F.max_by("hash", "number").alias("guard_tip_hash"),
        F.max("timestamp").alias("guard_tip_timestamp"),
    )
    return p.crossJoin(F.broadcast(b.agg((F.max("number") + 1).alias("archive_height"))))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivery log of each session: an activation barrier, then by page a reorg control and the data."""
    p = pages(spark, sf_dir).select("page_id", "next_block", F.col("guard_tip").alias("head_number"), F.col("guard_tip_hash").alias("head_hash"))
    reorg = p.where(F.col("next_block") % PAGE_BLOCKS == 0).select(
        "page_id", F.lit("reorg").alias("payload_kind"), (F.col("next_block") - 2).alias("next_block"), (F.col("next_block") - 3).alias("head_number"), block_hash(F.col("next_block") - 3).alias("head_hash"),
        F.col("head_number").alias("new_tip"), F.col("head_hash").alias("new_tip_hash"),
    )
    data = p.withColumns({"payload_kind": F.lit("data"), "new_tip": F.lit(None).cast("long"), "new_tip_hash": F.lit(None).cast("string")})
    start = p.where("page_id = 0").select(F.lit(-1).cast("long").alias("page_id"), F.lit("barrier").alias("payload_kind"), F.lit(0).cast("long").alias("next_block"), F.lit(None).cast("long").alias("head_number"), F.lit(None).cast("string").alias("head_hash"), F.lit(None).cast("long").alias("new_tip"), F.lit(None).cast("string").alias("new_tip_hash"))
    rows = data.unionByName(reorg).unionByName(start)
    rows = rows.withColumn("session", F.explode(F.sequence(F.lit(0), F.lit(SESSIONS - 1))))
    order = Window.partitionBy("session").orderBy("page_id", F.col("payload_kind") == "data")
    return rows.select(
        F.concat(F.lit("s"), F.col("session").cast("string")).alias("session_id"),
        F.lit(1).cast("long").alias("chain_id"),
        F.row_number().over(order).cast("long").alias("sequence"),
        F.lit(1).cast("long").alias("query_revision"),
        "payload_kind",
        "page_id",
        "next_block",
        "head_number",
        "head_hash",
        "new_tip",
        "new_tip_hash",
        (F.col("payload_kind") == "barrier").alias("checkpoint_neutral"),
    ).withColumn("token", F.lpad(F.lower(F.hex("sequence")), 16, "0"))


def acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = deliveries(spark, sf_dir)
    last = d.groupBy("session_id", "chain_id").agg(F.max("sequence").alias("last"))
    return d.join(last, ["session_id", "chain_id"]).where("sequence < last").select("session_id", "chain_id", "sequence", "token")
