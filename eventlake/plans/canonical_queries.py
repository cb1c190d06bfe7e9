"""Queries of canonical-chain tracking and structural validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlake.operators import canonical as K
from eventlake.operators import scans
from eventlake.operators import validate as V
from eventlake.plans.registry import query
from eventlake.plans.routing_queries import _normal
from eventlake.sources import derived as D
from eventlake.sources.derived import PAGE_BLOCKS

C = F.col
CHAIN, CHAINS = ["chain_id"], 8

#: Arrivals of eight chains: the same heights, hashed under the chain's name.
_CHAINS = "chains AS (SELECT c AS chain_id, arrival, number, sha256(c || hash) AS hash, sha256(c || parent_hash) AS parent_hash, timestamp FROM arrivals, range(1, 9) r(c))"


def _with(extra: str, sql: str) -> str:
    return f", {extra}\n{sql}"


def chains(s, d):
    return chains_of(D.block_arrivals(s, d))


def chains_of(arrivals):
    a = arrivals.drop("chain_id").withColumn("chain_id", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(CHAINS).cast("long"))))
    of = lambda c: F.sha2(F.concat(C("chain_id").cast("string"), C(c)), 256)
    return a.withColumns({"hash": of("hash"), "parent_hash": of("parent_hash")})


def chains_by_height(arrivals):
    """(chains, partitions): they are made of arrivals that are dealt by height already, so an eighth of their rows is shuffled."""
    parts = K.parts_of(arrivals, CHAINS)
    return chains_of(K.by_height(arrivals, parts)), parts


def bad_blocks(s, d):
    b = D.blocks(s, d).where("number <> 100")
    return b.withColumn("parent_hash", F.when(C("number") == 200, F.lit("00")).otherwise(C("parent_hash")))


_BAD = "bad AS (SELECT number, hash, CASE WHEN number = 200 THEN '00' ELSE parent_hash END AS parent_hash, timestamp FROM blocks WHERE number <> 100)"


def bad_logs(s, d):
    g = D.logs(s, d).withColumn("n", C("data").cast("long"))
    changed = g.select(
        C("block_number"),
        F.when(C("n") % 997 == 1, F.lit("ff")).otherwise(C("block_hash")).alias("block_hash"),
        C("transaction_hash"),
        F.when(C("n") % 997 == 2, C("transaction_index") + 1000).otherwise(C("transaction_index")).alias("transaction_index"),
        "log_index",
        F.when(C("n") % 997 == 3, F.substring("address", 1, 39)).otherwise(C("address")).alias("address"),
        F.when(C("n") % 997 == 4, F.concat("topics", "topics", "topics")).when(C("n") % 997 == 5, F.array(F.lit(None).cast("string"), F.get("topics", F.lit(0)))).otherwise(C("topics")).alias("topics"),
        "data",
        "block_timestamp",
        (C("n") % 997 == 6).alias("removed"),
    )
    return changed.unionByName(changed.where(C("data").cast("long") % 997 == 7))


_BAD_LOGS = """bad0 AS (SELECT block_number, CASE WHEN n % 997 = 1 THEN 'ff' ELSE block_hash END AS block_hash, transaction_hash, CASE WHEN n % 997 = 2 THEN transaction_index + 1000 ELSE transaction_index END AS transaction_index, log_index,
  CASE WHEN n % 997 = 3 THEN substr(address, 1, 39) ELSE address END AS address, CASE WHEN n % 997 = 4 THEN 'too_many_topics' WHEN n % 997 = 5 THEN 'topic_after_null' END AS topics, data, n % 997 = 6 AS removed FROM (SELECT *, CAST(data AS BIGINT) AS n FROM logs)),
bad_logs AS (SELECT * FROM bad0 UNION ALL SELECT * FROM bad0 WHERE CAST(data AS BIGINT) % 997 = 7)"""
_DUP = "SELECT block_hash, log_index, count(*) AS n FROM bad_logs GROUP BY ALL HAVING count(*) > 1"
_TX = """SELECT 'hash_with_two_indexes' AS rule, block_hash, transaction_hash AS key FROM bad_logs GROUP BY block_hash, transaction_hash HAVING count(DISTINCT transaction_index) > 1
UNION ALL SELECT 'index_with_two_hashes', block_hash, CAST(transaction_index AS VARCHAR) FROM bad_logs GROUP BY block_hash, transaction_index HAVING count(DISTINCT transaction_hash) > 1"""
_HASH = "SELECT l.block_number, l.log_index, l.block_hash FROM bad_logs l JOIN blocks b ON b.number = l.block_number WHERE b.hash <> l.block_hash"
_LINKS = """SELECT rule, number FROM (SELECT 'gap' AS rule, number FROM (SELECT number, lag(number) OVER (ORDER BY number) AS p FROM bad) WHERE number <> p + 1
UNION ALL SELECT 'parent', b.number FROM bad b JOIN bad p ON p.number = b.number - 1 WHERE b.parent_hash <> p.hash)"""

_REORGS = """w AS (SELECT *, lag(number) OVER (PARTITION BY chain_id ORDER BY arrival) AS tip, lag(hash) OVER (PARTITION BY chain_id ORDER BY arrival) AS tip_hash FROM chains),
m AS (SELECT *, tip >= number AND tip_hash <> hash AS starts FROM w), br AS (SELECT *, sum(CAST(coalesce(starts, false) AS INTEGER)) OVER (PARTITION BY chain_id ORDER BY arrival) AS branch FROM m),
reorgs AS (SELECT chain_id, arrival, number - 1 AS ancestor, tip AS old_tip, tip_hash AS old_tip_hash, max(number) OVER (PARTITION BY chain_id, branch) AS new_tip FROM br QUALIFY starts)"""
_CANON = "SELECT chain_id, number, hash FROM (SELECT *, min(number) OVER (PARTITION BY chain_id ORDER BY arrival ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM chains) WHERE later IS NULL OR later > number"


@query("jn2_log_block_hash", _with(_BAD_LOGS, _HASH))
def _(s, d):
    return V.log_block_hash(bad_logs(s, d), D.blocks(s, d))


@query("win1_win2_jn4_link_violations", _with(_BAD, _LINKS))
def _(s, d):
    return K.link_violations(bad_blocks(s, d), F.lit(0))


@query("aud8_validate_history", _with(_BAD, "SELECT 'parent' AS rule, b.number FROM bad b JOIN bad p ON p.number = b.number - 1 WHERE b.parent_hash <> p.hash"))
def _(s, d):
    return K.link_violations(bad_blocks(s, d), F.lit(0), allow_gaps=True)


@query("agg5_duplicate_logs", _with(_BAD_LOGS, _DUP))
def _(s, d):
    return V.duplicate_logs(bad_logs(s, d))


@query("agg6_transaction_conflicts", _with(_BAD_LOGS, _TX))
def _(s, d):
    return V.transaction_conflicts(bad_logs(s, d))


@query("agg7_block_identity_conflicts", "SELECT number, count(DISTINCT (hash, timestamp)) AS n FROM arrivals GROUP BY number HAVING count(DISTINCT (hash, timestamp)) > 1")
def _(s, d):
    return V.block_identity_conflicts(D.block_arrivals(s, d))


@query("agg8_duplicate_progress", "SELECT number // 50 AS page_id, number, 2 AS n FROM routed WHERE kind = 2 AND number % 7 = 0")
def _(s, d):
    r = _normal(s, d)
    return V.repeated_kind(r.unionByName(r.where("kind = 2 and number % 7 = 0")), 2)


@query(
    "agg9_coverage_certificate",
    "SELECT page_id, progress, broadcast FROM (SELECT number // 50 AS page_id, max(CASE WHEN number % 10 >= 8 THEN number - 3 ELSE number END) FILTER (WHERE kind = 2) AS progress, max(number) FILTER (WHERE canonical AND kind <> 2) AS broadcast FROM routed GROUP BY 1) WHERE broadcast IS NOT NULL AND coalesce(progress, -1) < broadcast",
)
def _(s, d):
    """Progress at heights that end on 8 or 9 names a lower block."""
    lower = (C("kind") == 2) & (C("number") % 10 >= 8)
    return V.coverage_certificates(_normal(s, d).withColumn("number", F.when(lower, C("number") - 3).otherwise(C("number"))))


@query(
    "win3_order_violations",
    "SELECT page_id, ordinal FROM (SELECT number // 50 AS page_id, o2 AS ordinal, lag((number, kind, transaction_index, log_index)) OVER (PARTITION BY number // 50 ORDER BY o2) > (number, kind, transaction_index, log_index) AS bad FROM (SELECT *, CASE WHEN ordinal % 20 = 3 THEN ordinal * 2 + 3 ELSE ordinal * 2 END AS o2 FROM ordered)) WHERE bad",
)
def _(s, d):
    shifted = F.when(C("ordinal") % 20 == 3, C("ordinal") * 2 + 3).otherwise(C("ordinal") * 2)
    return V.order_violations(_normal(s, d).withColumn("ordinal", shifted))


@query("win9_reorg_events", _with(f"{_CHAINS}, {_REORGS}", "SELECT * FROM reorgs"))
def _(s, d):
    return K.reorg_events(chains(s, d), CHAIN)


@query("win10_canonical_chain", _with(_CHAINS, _CANON))
def _(s, d):
    return K.canonical_chain(chains(s, d), CHAIN).select("chain_id", "number", "hash")


@query("win10_canonical_chain_bounded", _with(_CHAINS, _CANON))
def _(s, d):
    return K.canonical_chain_bounded(chains(s, d), CHAIN, 64).select("chain_id", "number", "hash")


@query("jn5_common_ancestor", _with(_CHAINS, "SELECT chain_id, max(number) FILTER (WHERE number < 140) AS ancestor, count(*) FILTER (WHERE number < 140 AND number % 20 = 7) AS conflicts FROM chains WHERE arrival % 10 = 5 GROUP BY chain_id"))
def _(s, d):
    """Observed: all arrivals, from height 140 on under another hash, below it at some heights with another time."""
    c, _ = chains_by_height(D.block_arrivals(s, d))
    n = C("number")
    observed = c.withColumns({"hash": F.when(n >= 140, F.lit("zz")).otherwise(C("hash")), "timestamp": C("timestamp") + F.when(n % 20 == 7, 1).otherwise(0)})
    return K.common_ancestor_by_height(K.surviving(c, CHAIN).where("survives"), observed, CHAIN)


@query("jn9_displaced", _with(f"{_CHAINS}, {_REORGS}", "SELECT DISTINCT c.chain_id, c.number, c.hash FROM chains c JOIN reorgs r ON r.chain_id = c.chain_id AND c.number > r.ancestor AND c.number <= r.old_tip AND c.arrival < r.arrival"))
def _(s, d):
    c = chains(s, d)
    return K.displaced(c, K.reorg_events(c, CHAIN), CHAIN).select("chain_id", "number", "hash")


@query(
    "jn6_verify_baselines",
    """SELECT o.owner_id, unnest(list_filter([CASE WHEN b.number IS NULL THEN 'unknown' WHEN o.owner_id IN ('pool', 'user2') THEN 'differs' END, CASE WHEN o.from_block = 100 THEN 'disagree' END], lambda x: x IS NOT NULL)) AS rule
FROM owners o LEFT JOIN blocks b ON b.number = o.from_block WHERE o.from_block IS NOT NULL""",
)
def _(s, d):
    """Every owner with a backfill names its first block; one names another time, one another hash, and some a block that is not there."""
    n = C("number")
    o = D.owners(s, d).where("from_block is not null").select("owner_id", C("from_block").alias("number"))
    b = o.select("owner_id", "number", F.when(C("owner_id") == "pool", F.lit("zz")).otherwise(D.block_hash(n)).alias("hash"), D.block_hash(n - 1).alias("parent_hash"), (F.lit(D.GENESIS) + 3600 * n + F.when(C("owner_id") == "user2", 1).otherwise(0)).alias("timestamp"))
    return K.verify_baselines(b, D.blocks(s, d))


@query("jn7_coverage_boundary", "SELECT 'boundary_hash' AS rule, guard_tip AS number FROM pages WHERE page_id % 5 = 3 UNION ALL SELECT 'successor_parent', guard_tip + 1 FROM pages WHERE page_id % 5 = 3 AND guard_tip + 1 < archive_height")
def _(s, d):
    p = D.pages(s, d)
    cover = p.select(C("guard_tip").alias("head_number"), F.when(C("page_id") % 5 == 3, F.lit("00")).otherwise(C("guard_tip_hash")).alias("head_hash"))
    return K.coverage_boundary(cover, D.blocks(s, d))


@query("jn14_page_lineage", "SELECT page_id, guard_first, guard_first - 1 AS tip FROM pages WHERE page_id % 4 = 1")
def _(s, d):
    p = D.pages(s, d)
    return K.page_lineage(p.withColumn("guard_first_parent", F.when(C("page_id") % 4 == 1, F.lit("00")).otherwise(C("guard_first_parent"))))


@query("win6_retain_depth", _with(_CHAINS, f"SELECT chain_id, number, hash FROM ({_CANON}) QUALIFY number > max(number) OVER (PARTITION BY chain_id) - 64"))
def _(s, d):
    return K.retain_depth(K.canonical_chain(chains(s, d), CHAIN), 64, CHAIN).select("chain_id", "number", "hash")


_WITNESS = "wit AS (SELECT user_id % 8 AS shard, user_id, max(event_id) AS last_touch, count(DISTINCT event_type) AS n_owners FROM ev GROUP BY ALL)"


def witnesses(s, d):
    return D.events(s, d).groupBy((C("user_id") % 8).alias("shard"), "user_id").agg(F.max("event_id").alias("last_touch"), F.count_distinct("event_type").alias("n_owners"))


@query("win7_retain_recent", _with(_WITNESS, "SELECT shard, user_id, last_touch, row_number() OVER (PARTITION BY shard ORDER BY last_touch DESC) AS rank FROM wit QUALIFY rank <= 20"))
def _(s, d):
    return K.retain_recent(witnesses(s, d), 20, ["shard"]).select("shard", "user_id", "last_touch", C("rank").cast("long").alias("rank"))


@query(
    "win8_retain_owner_budget",
    _with(
        _WITNESS,
        """SELECT 'kept' AS said, shard, user_id, CAST(total AS BIGINT) AS total FROM (SELECT *, user_id % 5 = 0 AS current, sum(n_owners) OVER (PARTITION BY shard ORDER BY user_id % 5 = 0 DESC, last_touch DESC ROWS UNBOUNDED PRECEDING) AS total FROM wit) WHERE current OR total <= 12
UNION ALL SELECT 'current_over_budget', shard, -1, sum(n_owners) FROM wit WHERE user_id % 5 = 0 GROUP BY shard HAVING sum(n_owners) > 12""",
    ),
)
def _(s, d):
    """Every fifth user is of the current delivery."""
    kept, over = K.retain_owner_budget(witnesses(s, d).withColumn("current", C("user_id") % 5 == 0), 12, ["shard"])
    return kept.select(F.lit("kept").alias("said"), "shard", "user_id", "total").unionByName(over.select(C("rule").alias("said"), "shard", F.lit(-1).cast("long").alias("user_id"), "total"))


@query("srt1_sorted_logs", "SELECT block_number, transaction_index, log_index, data FROM logs")
def _(s, d):
    return D.logs(s, d).select("block_number", "transaction_index", "log_index", "data").orderBy("block_number", "transaction_index", "log_index")


@query("srt2_tip_oldest", _with(_CHAINS, f"SELECT chain_id, max(number) AS tip, arg_max(hash, number) AS tip_hash, min(number) AS oldest FROM ({_CANON}) GROUP BY chain_id"))
def _(s, d):
    return K.tip(K.canonical_chain(chains(s, d), CHAIN), CHAIN)


@query("srt3_block_lookup", "SELECT number, hash, timestamp FROM blocks WHERE hash = (SELECT arg_max(block_hash, CAST(data AS BIGINT)) FROM logs) OR number = 17")
def _(s, d):
    b = D.blocks(s, d)
    wanted = D.logs(s, d).agg(F.max_by("block_hash", C("data").cast("long")).alias("hash"))
    return b.join(wanted, "hash", "left_semi").unionByName(b.where("number = 17")).select("number", "hash", "timestamp").distinct()


@query("fn9_content_hash_check", "SELECT number, hash FROM arrivals WHERE number % 50 >= 48 AND arrival % 10 <> 5")
def _(s, d):
    return K.content_hash_violations(D.block_arrivals(s, d), D.block_hash(C("number"))).select("number", "hash")


@query("fn10_reorg_shape", _with(f"{_CHAINS}, {_REORGS}", "SELECT chain_id, arrival, chain_id % 4 > 1 AS ok FROM reorgs"))
def _(s, d):
    arrivals = D.block_arrivals(s, d)
    c, parts = chains_by_height(arrivals)
    in_order = chains_of(scans.dealt(arrivals.select("arrival", "number", "hash", "parent_hash"), [], "arrival", scans.SEGMENT_ROWS // CHAINS))
    # Of the new branch its first block, which is the ancestor's direct child, is held against the shape.
    j = K.reorg_blocks(K.reorg_events(in_order, CHAIN, None), K.surviving(c, CHAIN), CHAIN, parts)
    # Of every four chains one has a later ancestor, and one the same block at both tips.
    k = C("chain_id") % 4
    j = j.withColumns({"anc": F.when(k == 0, C("anc").withField("timestamp", F.lit(10**12))).otherwise(C("anc")), "new": F.when(k == 1, C("old")).otherwise(C("new"))})
    return j.select("chain_id", "arrival", K.reorg_shape("anc", "old", "new").alias("ok"))


@query("fn11_same_block", "SELECT b.number, a.timestamp = b.timestamp AND a.hash = b.hash AS same FROM arrivals a JOIN blocks b USING (number)")
def _(s, d):
    a = D.block_arrivals(s, d).select(F.struct(*K.BLOCK).alias("a"), "number")
    return a.join(D.blocks(s, d).select(F.struct(*K.BLOCK).alias("b"), "number"), "number").select("number", K.same_block("a", "b").alias("same"))


@query(
    "win12_certified_coverage",
    "SELECT session_id, sequence, max(CASE WHEN payload_kind = 'data' THEN head_number END) OVER (PARTITION BY session_id ORDER BY sequence) AS certified FROM deliveries WHERE payload_kind <> 'barrier'",
)
def _(s, d):
    """The certified head along each session: its reorgs all stay above it, so none clears it (win12_certified_heads has some that do)."""
    x, reorg = D.deliveries(s, d).where("payload_kind <> 'barrier'"), C("payload_kind") == "reorg"
    x = x.select("session_id", C("query_revision").alias("generation"), "sequence", F.when(~reorg, C("head_number")).alias("head_number"), F.when(reorg, C("head_number")).alias("ancestor"))
    return K.certified_heads(x, ["session_id"]).select("session_id", "sequence", "certified")


@query(
    "win13_finality_heads",
    _with(
        _CHAINS,
        """SELECT chain_id, arrival, max(finalized) OVER w AS head, CASE WHEN finalized > coverage THEN 'above_coverage' WHEN finalized < max(finalized) OVER p THEN 'regressed' WHEN ancestor < max(finalized) OVER p THEN 'reorg_below_finalized' END AS rule
FROM (SELECT chain_id, arrival, number - 64 + CASE WHEN number % 100 = 7 THEN 70 ELSE 0 END AS finalized, number AS coverage, CASE WHEN number % 100 >= 55 AND number % 100 < 60 THEN number - 67 + number % 10 END AS ancestor FROM chains) WINDOW w AS (PARTITION BY chain_id ORDER BY arrival), p AS (PARTITION BY chain_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    ),
)
def _(s, d):
    m = chains(s, d).select("chain_id", "arrival", (C("number") - 64 + F.when(C("number") % 100 == 7, 70).otherwise(0)).alias("finalized"), C("number").alias("coverage"), F.when((C("number") % 100 >= 55) & (C("number") % 100 < 60), C("number") - 67 + C("number") % 10).alias("ancestor"))
    return K.finality_heads(m, CHAIN)


@query("aud2_validate_guard", "SELECT 'guard_tip' AS rule, CAST(page_id AS VARCHAR) AS key FROM pages WHERE page_id % 3 = 0 UNION ALL SELECT 'guard_first_parent', CAST(page_id AS VARCHAR) FROM pages WHERE page_id % 7 = 2")
def _(s, d):
    p = D.pages(s, d).withColumns({"guard_tip": C("guard_tip") - F.when(C("page_id") % 3 == 0, 1).otherwise(0), "guard_first_parent": F.when(C("page_id") % 7 == 2, F.lit("00")).otherwise(C("guard_first_parent"))})
    return V.validate_guard(p, D.blocks(s, d), PAGE_BLOCKS)


@query(
    "aud1_validate_page",
    _with(
        f"{_BAD}, {_BAD_LOGS}",
        f"""SELECT rule, count(*) AS n FROM (
SELECT rule, CAST(number AS VARCHAR) AS key FROM ({_LINKS}) UNION ALL SELECT 'parent_hash_width', '200'
UNION ALL SELECT 'ends_elsewhere', 'range' WHERE (SELECT max(number) FROM bad) <> 699 UNION ALL SELECT unnest(['cursor_beyond_target', 'archive_behind_cursor', 'response_limit']), 'range'
UNION ALL SELECT 'missing_field', '' FROM bad WHERE number = 300 UNION ALL SELECT 'missing_field', data FROM bad_logs WHERE CAST(data AS BIGINT) % 997 = 8 UNION ALL SELECT 'topic_width', data FROM bad_logs WHERE CAST(data AS BIGINT) % 997 = 9
UNION ALL SELECT 'log_out_of_range', data FROM bad_logs WHERE block_number >= 700 UNION ALL SELECT 'log_removed', data FROM bad_logs WHERE removed
UNION ALL SELECT 'address_width', data FROM bad_logs WHERE length(address) <> 40 UNION ALL SELECT topics, data FROM bad_logs WHERE topics IS NOT NULL
UNION ALL SELECT 'log_without_block', data FROM bad_logs WHERE block_number NOT IN (SELECT number FROM bad)
UNION ALL SELECT 'log_block_hash', data FROM bad_logs l JOIN bad b ON b.number = l.block_number WHERE b.hash <> l.block_hash
UNION ALL SELECT 'duplicate_log', block_hash FROM ({_DUP}) UNION ALL SELECT rule, key FROM ({_TX})) GROUP BY rule""",
    ),
)
def _(s, d):
    """A page that is too long, of blocks and logs that break each rule somewhere."""
    n = C("data").cast("long") % 997
    blocks = bad_blocks(s, d).withColumn("timestamp", F.when(C("number") != 300, C("timestamp")))
    logs = bad_logs(s, d).withColumns({"topics": F.when(n == 9, F.array(F.lit("00"))).otherwise(C("topics")), "data": F.when(n != 8, C("data"))})
    return V.validate_page(blocks, logs, 0, 700, 600, 650, (500, 10**9, 10**15)).groupBy("rule").agg(F.count("*").alias("n"))


@query("fn1_fixed_width", _with(_BAD_LOGS, "SELECT length(address) = 40 AS ok, count(*) AS n FROM bad_logs GROUP BY 1"))
def _(s, d):
    return bad_logs(s, d).groupBy(V.fixed_width("address", 20).alias("ok")).agg(F.count("*").alias("n"))


@query("fn2_quantity", "SELECT data, CAST(user_id * 65536 + k AS BIGINT) AS value FROM (SELECT CAST(event_id AS VARCHAR) AS data, user_id, k FROM ev)")
def _(s, d):
    e = D.events(s, d).select(C("event_id").cast("string").alias("data"), F.lower(F.hex(C("user_id") * 65536 + C("k"))).alias("q"))
    return e.select("data", V.quantity("q").cast("long").alias("value"))


@query("fn3_normalize_topics", _with(_BAD_LOGS, "SELECT coalesce(topics, 'fine') AS problem, count(*) AS n, CAST(sum(CASE topics WHEN 'too_many_topics' THEN 6 WHEN 'topic_after_null' THEN 1 ELSE 2 END) AS BIGINT) AS kept FROM bad_logs GROUP BY 1"))
def _(s, d):
    return bad_logs(s, d).groupBy(F.coalesce(V.topics_problem(), F.lit("fine")).alias("problem")).agg(F.count("*").alias("n"), F.sum(F.size(V.normalize_topics())).alias("kept"))


# ------------------------------------------------------------------ one huge chain or session, in segments

_SINGLE = "chains AS (SELECT * FROM arrivals)"
SEGMENT = 1 << 10  # rows, so that small tables too have several


@query("win10_canonical_chain_segmented", _with(_SINGLE, _CANON))
def _(s, d):
    """All arrivals as one chain, over as many tasks as it has segments."""
    return K.canonical_chain_segmented(D.block_arrivals(s, d), CHAIN, SEGMENT).select("chain_id", "number", "hash")


@query("win9_reorg_events_segmented", _with(f"{_SINGLE}, {_REORGS}", "SELECT chain_id, arrival, ancestor, old_tip, old_tip_hash, new_tip FROM reorgs"))
def _(s, d):
    return K.reorg_events_segmented(D.block_arrivals(s, d), CHAIN, SEGMENT)


#: Of each page and session: a head that came too early, the reorg of its last two heights, a late lower page, its own head.
_HEADS = """heads AS (SELECT 's' || s AS session_id, CAST(page_id // 40 AS BIGINT) AS generation, page_id * 4 + k AS sequence,
  CASE WHEN k = 0 AND page_id % 3 <> 1 OR k = 3 THEN guard_tip WHEN k = 2 AND page_id % 4 = 0 THEN guard_tip - 60 END AS head_number,
  CASE WHEN k = 1 AND next_block % 50 = 0 THEN guard_tip - 2 - page_id % 5 // 4 * 70 WHEN k = 2 AND page_id % 7 = 0 THEN guard_tip END AS ancestor FROM pages, range(0, 4) t(k), range(0, 8) r(s)),
numbered_heads AS (SELECT *, row_number() OVER (PARTITION BY session_id, generation ORDER BY sequence) AS n FROM heads)"""


@query(
    "win12_certified_heads",
    _with(
        _HEADS,
        """SELECT session_id, generation, sequence, certified FROM (WITH RECURSIVE run AS (
  SELECT session_id, generation, sequence, n, head_number AS certified FROM numbered_heads WHERE n = 1
  UNION ALL SELECT h.session_id, h.generation, h.sequence, h.n, greatest(h.head_number, CASE WHEN h.ancestor IS NULL OR r.certified <= h.ancestor THEN r.certified END)
  FROM run r JOIN numbered_heads h ON h.session_id = r.session_id AND h.generation = r.generation AND h.n = r.n + 1) SELECT * FROM run)""",
    ),
)
def _(s, d):
    p, k = C("page_id"), C("k")
    h = D.pages(s, d).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3)))).withColumn("session", F.explode(F.sequence(F.lit(0), F.lit(7))))
    h = h.select(
        F.concat(F.lit("s"), C("session").cast("string")).alias("session_id"),
        F.floor(p / 40).alias("generation"),
        (p * 4 + k).alias("sequence"),
        F.when(((k == 0) & (p % 3 != 1)) | (k == 3), C("guard_tip")).when((k == 2) & (p % 4 == 0), C("guard_tip") - 60).alias("head_number"),
        F.when((k == 1) & (C("next_block") % 50 == 0), C("guard_tip") - 2 - F.expr("page_id % 5 div 4") * 70).when((k == 2) & (p % 7 == 0), C("guard_tip")).alias("ancestor"),
    )
    return K.certified_heads(h, ["session_id"], SEGMENT).select("session_id", "generation", "sequence", "certified")


_MARKS = """marks AS (SELECT chain_id * 1000000 + arrival // 2000 AS chain_id, arrival, CASE WHEN number % 3 = 0 THEN number - 20 + CASE WHEN number % 31 = 7 THEN 25 ELSE 0 END - CASE WHEN number % 29 = 3 THEN 9 ELSE 0 END END AS safe,
  CASE WHEN number % 5 = 0 THEN number - 40 + CASE WHEN number % 7 = 0 THEN 22 WHEN number % 11 = 0 THEN 41 ELSE 0 END END AS finalized, number AS coverage, CASE WHEN number % 50 = 47 THEN number - 1 - number % 4 * 15 END AS ancestor FROM chains),
numbered_marks AS (SELECT *, row_number() OVER (PARTITION BY chain_id ORDER BY arrival) AS n FROM marks)"""


@query(
    "win13_head_marks",
    _with(
        f"{_CHAINS}, {_MARKS}",
        """SELECT chain_id, arrival, safe_head, finalized_head, CASE WHEN finalized > coverage THEN 'finalized_above_coverage' WHEN safe > coverage THEN 'safe_above_coverage' WHEN ancestor < finalized_before THEN 'reorg_below_finalized'
  WHEN finalized < finalized_before THEN 'finalized_regressed' WHEN safe < least(safe_before, ancestor) THEN 'safe_regressed' WHEN finalized_head > safe_head THEN 'finalized_above_safe' END AS rule FROM (WITH RECURSIVE run AS (
  SELECT *, CAST(NULL AS BIGINT) AS safe_before, CAST(NULL AS BIGINT) AS finalized_before, CASE WHEN safe <= coverage THEN safe END AS safe_head, CASE WHEN finalized <= coverage THEN finalized END AS finalized_head FROM numbered_marks WHERE n = 1
  UNION ALL SELECT h.*, r.safe_head, r.finalized_head, greatest(CASE WHEN h.safe <= h.coverage THEN h.safe END, CASE WHEN r.safe_head IS NOT NULL THEN least(r.safe_head, h.ancestor) END), greatest(CASE WHEN h.finalized <= h.coverage THEN h.finalized END, r.finalized_head)
  FROM run r JOIN numbered_marks h ON h.chain_id = r.chain_id AND h.n = r.n + 1) SELECT * FROM run)""",
    ),
)
def _(s, d):
    n = C("number")
    m = chains(s, d).select(
        (C("chain_id") * 1000000 + F.floor(C("arrival") / 2000)).alias("chain_id"),
        "arrival",
        F.when(n % 3 == 0, n - 20 + F.when(n % 31 == 7, 25).otherwise(0) - F.when(n % 29 == 3, 9).otherwise(0)).alias("safe"),
        F.when(n % 5 == 0, n - 40 + F.when(n % 7 == 0, 22).when(n % 11 == 0, 41).otherwise(0)).alias("finalized"),
        n.alias("coverage"),
        F.when(n % 50 == 47, n - 1 - n % 4 * 15).alias("ancestor"),
    )
    return K.head_marks(m, CHAIN, SEGMENT).select("chain_id", "arrival", "safe_head", "finalized_head", "rule")
