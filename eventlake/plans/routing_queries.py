"""Queries of scans, pages, filters, routing and normalization."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlake.operators import routing as R
from eventlake.operators import scan as S
from eventlake.plans.ctes import covered, everyone
from eventlake.plans.registry import query
from eventlake.sources import derived as D
from eventlake.sources.derived import ACTIVATION, PAGE_BLOCKS

C = F.col


def _topics(df):
    return df.withColumns({"topic0": F.get("topics", F.lit(0)), "topic1": F.get("topics", F.lit(1))}).drop("topics")


def _owners_text(df):
    return df.withColumn("owners", F.array_join("owners", ","))


@query("src1_scan_blocks", "SELECT number, hash FROM blocks WHERE number >= 100 AND number < 260")
def _(s, d):
    return S.block_range(D.blocks(s, d), "number", 100, 260).select("number", "hash")


@query(
    "src2_scan_logs",
    """SELECT block_number, log_index, address FROM logs l WHERE block_number >= 100 AND block_number < 400 AND EXISTS (SELECT 1 FROM interests i WHERE kind = 'log'
  AND (len(addresses) = 0 OR list_contains(addresses, l.address)) AND (len(t0) = 0 OR list_contains(t0, l.topic0)) AND (len(t1) = 0 OR list_contains(t1, l.topic1)))""",
)
def _(s, d):
    return S.scan_logs(D.logs(s, d), D.interests(s, d), 100, 400).select("block_number", "log_index", "address")


@query("src3_project_blocks", "SELECT number, hash, 'full' AS columns, number * 2 AS size FROM blocks UNION ALL SELECT number, hash, 'compact', NULL FROM blocks")
def _(s, d):
    """With a block interest all columns come, without any the compact ones."""
    b, i = D.blocks(s, d).withColumn("size", C("number") * 2), D.interests(s, d)
    full, compact = S.project_blocks(b, i), S.project_blocks(b, i.where("kind = 'log'"))
    rows = full.select("number", "hash", F.lit("full").alias("columns"), "size")
    return rows.unionByName(compact.withColumn("columns", F.lit("compact")).select("number", "hash", "columns"), allowMissingColumns=True)


@query("src4_lookup_blocks", "SELECT number, hash, parent_hash, timestamp FROM blocks WHERE number IN (SELECT from_block FROM owners)")
def _(s, d):
    return S.lookup_blocks(D.blocks(s, d), D.owners(s, d).where("from_block is not null").select(C("from_block").alias("number")))


@query("src5_archive_height", "SELECT max(number) + 1 AS archive_height FROM blocks")
def _(s, d):
    return S.archive_height(D.blocks(s, d))


@query(
    "src9_resume_scan",
    """SELECT 'none' AS cursor, min(from_block) AS start, (SELECT max(number) + 1 FROM blocks) AS activation FROM owners
UNION ALL SELECT 'older', least(min(from_block), 500), 500 FROM owners UNION ALL SELECT 'same', 500, 360""",
)
def _(s, d):
    o = D.owners(s, d)
    height = S.archive_height(D.blocks(s, d)).first()["archive_height"]
    parts = {"none": S.scan_start_and_activation(o, None, None, 2, height), "older": S.scan_start_and_activation(o, 500, 1, 2, height), "same": S.scan_start_and_activation(o, 500, 2, 2, height, ACTIVATION)}
    frames = [f.withColumn("cursor", F.lit(k)) for k, f in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "pag1_assign_pages",
    """SELECT number, number // 50 AS bucket, n_logs, CAST(coalesce(sum(n_logs) OVER (PARTITION BY number // 50 ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) // 100 AS part
FROM (SELECT b.number, count(l.block_number) AS n_logs FROM blocks b LEFT JOIN logs l ON l.block_number = b.number GROUP BY b.number)""",
)
def _(s, d):
    return S.assign_pages(D.blocks(s, d), D.logs(s, d), 0, PAGE_BLOCKS, 100)


@query(
    "pag2_split_pages_to_bytes",
    """SELECT number // 50 AS page_id, number, CAST(bytes AS BIGINT) AS bytes, CAST(floor(coalesce(sum(bytes) OVER (PARTITION BY number // 50 ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 1500) AS BIGINT) AS sub_page, bytes > 1500 AS overflow
FROM (SELECT block_number AS number, sum(64 + octet_length(encode(data))) AS bytes FROM logs GROUP BY 1)""",
)
def _(s, d):
    sized = D.logs(s, d).groupBy(C("block_number").alias("number")).agg(F.sum(F.lit(64) + F.octet_length("data")).alias("bytes"))
    return S.split_pages_to_bytes(sized.select(F.floor(C("number") / PAGE_BLOCKS).alias("page_id"), "number", "bytes"), 1500)


@query(
    "pag3_admit_pages",
    """SELECT b.page_id, n_blocks, coalesce(n_logs, 0) AS n_logs, CAST(coalesce(bytes, 0) AS BIGINT) AS bytes, n_blocks <= 50 AND coalesce(n_logs, 0) <= 69 AND coalesce(bytes, 0) <= 60000 AS admitted
FROM (SELECT number // 50 AS page_id, count(*) AS n_blocks FROM blocks GROUP BY 1) b LEFT JOIN (SELECT block_number // 50 AS page_id, count(*) AS n_logs, sum(64 + octet_length(encode(data))) AS bytes FROM logs GROUP BY 1) l USING (page_id)""",
)
def _(s, d):
    return S.admit_pages(D.blocks(s, d), D.logs(s, d), PAGE_BLOCKS, 50, 69, 60000)


@query(
    "pag4_page_cursor_checks",
    """SELECT rule, CAST(page_id AS VARCHAR) AS key FROM (SELECT 'cursor_not_after_start' AS rule, page_id FROM pages WHERE next_block <= from_block
UNION ALL SELECT 'cursor_past_target', page_id FROM pages WHERE next_block > 600 UNION ALL SELECT 'archive_behind_cursor', page_id FROM pages WHERE archive_height < next_block)""",
)
def _(s, d):
    return S.page_cursor_checks(D.pages(s, d), 600)


@query("pag5_page_guard", "SELECT page_id, guard_first, guard_first_parent, guard_tip, guard_tip_hash, guard_tip_timestamp FROM pages")
def _(s, d):
    return S.page_guard(D.blocks(s, d), PAGE_BLOCKS)


@query("flt3_canonicalize_interests", "SELECT owner_id, array_to_string(list_sort(list_distinct(addresses)), ',') AS addresses, array_to_string(list_sort(t0), ',') AS t0, array_to_string(list_sort(t1), ',') AS t1, CAST(CASE WHEN len(t1) > 0 THEN 2 WHEN len(t0) > 0 THEN 1 ELSE 0 END AS INTEGER) AS width FROM interests")
def _(s, d):
    at = lambda k: F.array_join(F.coalesce(F.get("topics", F.lit(k)), F.array().cast("array<string>")), ",")
    return S.canonical_interests(D.interests(s, d)).select("owner_id", F.array_join("addresses", ",").alias("addresses"), at(0).alias("t0"), at(1).alias("t1"), F.size("topics").alias("width"))


@query(
    "flt4_compile_filters",
    "SELECT DISTINCT array_to_string(list_sort(list_distinct(addresses)), ',') AS addresses, CASE WHEN len(t1) > 0 THEN 2 WHEN len(t0) > 0 THEN 1 ELSE 0 END AS width, array_to_string(list_sort(list_concat(t0, t1)), ',') AS accepted FROM interests WHERE kind = 'log'",
)
def _(s, d):
    i = D.interests(s, d)
    twice = i.unionByName(i.withColumns({"owner_id": F.concat(F.lit("copy-"), "owner_id"), "addresses": F.reverse("addresses")}))
    return S.compile_filters(twice).select(F.array_join("addresses", ",").alias("addresses"), F.size("topics").alias("width"), F.array_join(F.array_sort(F.flatten("topics")), ",").alias("accepted"))


@query(
    "flt1_log_matches",
    """SELECT i.owner_id, count(*) AS n, min(l.data) AS least FROM logs l JOIN interests i ON i.kind = 'log' AND (len(addresses) = 0 OR list_contains(addresses, l.address))
  AND (len(t0) = 0 OR list_contains(t0, l.topic0)) AND (len(t1) = 0 OR list_contains(t1, l.topic1)) GROUP BY i.owner_id""",
)
def _(s, d):
    i = D.interests(s, d).where("kind = 'log'").withColumnRenamed("topics", "accepted")
    match = R.log_matches(C("topics"), C("address"), C("addresses"), C("accepted"))
    listed = i.where(F.size("addresses") > 0).withColumn("address", F.explode(F.array_distinct("addresses")))
    m = D.logs(s, d).join(F.broadcast(R.checked(i.where(F.size("addresses") == 0))), match).select("owner_id", "data")
    m = m.unionByName(D.logs(s, d).join(listed, "address").where(match).select("owner_id", "data"))
    return m.groupBy("owner_id").agg(F.count("*").alias("n"), F.min("data").alias("least"))


@query("flt2_flt7_header_wanted", "SELECT number, owners FROM routed WHERE kind = 0")
def _(s, d):
    return _owners_text(R.header_rows(D.blocks(s, d), D.interests(s, d), D.owners(s, d), ACTIVATION)).select("number", "owners")


@query("flt5_portable_interests", "SELECT owner_id, interest_id, kind = 'log' AND width <= 4 AS portable, CASE WHEN kind = 'block' THEN 'block interest with options' END AS problem FROM interests")
def _(s, d):
    from eventlake.operators.topology import portable_interests

    return portable_interests(D.interests(s, d).withColumn("has_options", C("kind") == "block")).select("owner_id", "interest_id", "portable", "problem")


@query("flt6_interest_active", f"SELECT o.owner_id, count(*) AS n_blocks, min(number) AS first_block FROM owners o JOIN blocks b ON {covered('b.number')} OR coalesce(from_block <= number AND (to_block_excl IS NULL OR number < to_block_excl), false) GROUP BY o.owner_id")
def _(s, d):
    return R.active_blocks(D.blocks(s, d), D.owners(s, d), ACTIVATION)


@query("flt8_drop_unrouted", "SELECT count(*) AS kept, (SELECT count(*) FROM logs) AS scanned FROM routed WHERE kind = 1")
def _(s, d):
    logs = D.logs(s, d)
    kept = R.route_logs(logs, D.interests(s, d), D.owners(s, d), ACTIVATION).agg(F.count("*").alias("kept"))
    return kept.join(logs.agg(F.count("*").alias("scanned")))  # one row each


@query("flt9_coverage", "SELECT scope, count(*) AS n, CAST(sum(CASE WHEN scope = 'CANONICAL_PROGRESS' THEN 1 ELSE 0 END) AS BIGINT) AS advancing, max(number) AS proven FROM ordered GROUP BY scope")
def _(s, d):
    return _normal(s, d).groupBy("scope").agg(F.count("*").alias("n"), F.count_if(R.advances_canonical(C("scope"))).alias("advancing"), F.max("number").alias("proven"))


@query("flt10_dropped_blocks", "SELECT block_number, block_hash, count(*) AS n FROM log_arrivals WHERE removed GROUP BY ALL")
def _(s, d):
    from eventlake.operators.hybrid import dropped_block

    dropped = D.log_arrivals(s, d).select(dropped_block().alias("b")).where("b is not null")
    return dropped.groupBy(C("b.number").alias("block_number"), C("b.hash").alias("block_hash")).agg(F.count("*").alias("n"))


@query("jn1_attach_block_context", "SELECT l.data, b.timestamp, true AS known FROM logs l JOIN blocks b ON b.number = l.block_number WHERE b.number < 700 UNION ALL SELECT data, NULL, false FROM logs WHERE block_number >= 700")
def _(s, d):
    ok, lost = R.attach_block_context(D.logs(s, d), D.blocks(s, d).where("number < 700"))
    return ok.select("data", "timestamp", F.lit(True).alias("known")).unionByName(lost.select("data", F.lit(None).cast("long").alias("timestamp"), F.lit(False).alias("known")))


@query("jn3_agg1_route_events", "SELECT block_number, transaction_index, log_index, canonical, owners FROM audience")
def _(s, d):
    routed = R.route_logs(D.logs(s, d), D.interests(s, d), D.owners(s, d), ACTIVATION)
    return _owners_text(routed.select("block_number", "transaction_index", "log_index", "canonical", "owners"))


def _normal(s, d):
    return R.normalize(D.blocks(s, d), D.logs(s, d), D.interests(s, d), D.owners(s, d), ACTIVATION, PAGE_BLOCKS)


@query("nrm1_normalize", "SELECT number, kind, transaction_index, log_index, canonical, owners, scope, ordinal, block_hash, block_timestamp, transaction_hash, address, topics, data, removed FROM ordered")
def normalized(s, d):
    return _owners_text(_normal(s, d)).withColumn("topics", F.array_join("topics", ",")).drop("page_id")


@query("nrm2_event_order", "SELECT number // 50 AS page_id, count(*) AS n, max(ordinal) AS top FROM ordered GROUP BY 1")
def _(s, d):
    return _normal(s, d).groupBy("page_id").agg(F.count("*").alias("n"), F.max("ordinal").alias("top"))


@query("nrm3_progress_rows", f"SELECT number FROM blocks WHERE {covered('number')}")
def _(s, d):
    return R.progress_rows(D.blocks(s, d), D.owners(s, d), ACTIVATION).select("number")


@query("nrm4_scope_of", f"SELECT CASE WHEN {covered('block_number')} THEN 'CANONICAL_PROGRESS' ELSE 'OWNER_CATCHUP' END AS scope, count(*) AS n FROM logs GROUP BY 1")
def _(s, d):
    n = C("block_number")
    return D.logs(s, d).groupBy(R.scope_of(n, ACTIVATION, R.global_backfill(D.owners(s, d), n)).alias("scope")).agg(F.count("*").alias("n"))


@query(
    "nrm5_certify_tail",
    f"""SELECT page_id, number, kind, ordinal FROM (SELECT number // 50 AS page_id, number, kind, ordinal FROM ordered WHERE kind <> 2
UNION ALL SELECT t.page_id, t.top, 2, r.last + 1 FROM (SELECT number // 50 AS page_id, max(number) FILTER (WHERE {covered('number')}) AS top FROM blocks GROUP BY 1) t
  JOIN (SELECT number // 50 AS page_id, max(ordinal) AS last FROM ordered WHERE kind <> 2 GROUP BY 1) r USING (page_id)
  WHERE t.top IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ordered o WHERE o.kind = 0 AND o.canonical AND o.number = t.top))""",
)
def _(s, d):
    """Of the table without its progress rows: headers for everyone certify the pages of the global backfill only."""
    heads = R.page_head(D.blocks(s, d), D.owners(s, d), ACTIVATION, PAGE_BLOCKS)
    return R.certify_tail(_normal(s, d).where("kind <> 2"), heads).select("page_id", "number", "kind", "ordinal")


_HEADS = f"""heads AS (SELECT page_id, own IS NULL AS carried, last_value(own IGNORE NULLS) OVER w AS head_number, last_value(hash IGNORE NULLS) OVER w AS head_hash
  FROM (SELECT number // 50 AS page_id, max(number) FILTER (WHERE {covered('number')}) AS own, arg_max(hash, number) FILTER (WHERE {covered('number')}) AS hash FROM blocks GROUP BY 1) WINDOW w AS (ORDER BY page_id))"""


@query("nrm6_page_head", f", {_HEADS}\nSELECT page_id, head_number, head_hash, carried FROM heads")
def _(s, d):
    return R.page_head(D.blocks(s, d), D.owners(s, d), ACTIVATION, PAGE_BLOCKS)


@query(
    "nrm7_fn5_empty_page_to_barrier",
    f", {_HEADS}\nSELECT p.page_id, 'source-progress:1:' || p.next_block AS barrier_id, h.head_number, h.head_number IS NULL OR h.carried AS checkpoint_neutral FROM pages p JOIN heads h USING (page_id) WHERE p.page_id NOT IN (SELECT block_number // 50 FROM audience WHERE owners = 'errors')",
)
def _(s, d):
    a = R.route_logs(D.logs(s, d), D.interests(s, d), D.owners(s, d), ACTIVATION).where("array_join(owners, ',') = 'errors'")
    heads = R.page_head(D.blocks(s, d), D.owners(s, d), ACTIVATION, PAGE_BLOCKS)
    return R.empty_page_barriers(D.pages(s, d), a.select(F.floor(C("block_number") / PAGE_BLOCKS).alias("page_id")), heads, 1)


@query("nrm8_number_deliveries", "SELECT session_id, page_id, payload_kind, sequence FROM deliveries")
def _(s, d):
    rows = D.deliveries(s, d).select("session_id", "page_id", "payload_kind")
    return R.number_deliveries(rows, ["session_id"], "page_id", C("payload_kind") != "data")


@query(
    "nrm9_decode_batch",
    """SELECT number, kind, log_index, CASE WHEN scope = 'OWNER_CATCHUP' THEN 'backfill' ELSE 'subscription' END AS source, CASE WHEN kind = 1 AND number % 7 = 3 THEN 'reorged' ELSE 'included' END AS status,
  0 AS confirmations, block_hash AS hash, block_timestamp AS timestamp FROM ordered""",
)
def _(s, d):
    removed = F.when(C("kind") == R.LOG, C("number") % 7 == 3)
    rows = R.decode_batch(_normal(s, d).withColumn("removed", removed))
    return rows.select("number", "kind", "log_index", "source", "status", "confirmations", "block.hash", "block.timestamp")


@query("flt11_deduplicable", "SELECT block_number, log_index, arrival, NOT removed AS deduplicable FROM log_arrivals")
def _(s, d):
    a = D.log_arrivals(s, d).withColumn("status", F.when(C("removed"), "reorged").otherwise("included"))
    may, never = (x.select("block_number", "log_index", "arrival") for x in R.deduplicable(a))
    return may.withColumn("deduplicable", F.lit(True)).unionByName(never.withColumn("deduplicable", F.lit(False)))


@query(
    "flt12_proves_coverage",
    """SELECT kind, status, proves, count(*) AS n FROM (
SELECT CASE WHEN kind = 2 THEN 'progress' ELSE 'record' END AS kind, CASE WHEN kind = 2 THEN '' ELSE ['included', 'safe', 'finalized', 'pending', 'reorged'][number % 5 + 1] END AS status, kind = 2 OR number % 5 < 3 AS proves FROM ordered
UNION ALL SELECT payload_kind, CASE WHEN payload_kind = 'barrier' AND sequence % 2 = 0 THEN 'blockful' ELSE '' END, false FROM deliveries
UNION ALL SELECT 'barrier', 'blockful', true FROM deliveries WHERE payload_kind = 'data' UNION ALL SELECT CASE WHEN number % 2 = 0 THEN 'safe' ELSE 'finalized' END, '', false FROM blocks) GROUP BY ALL""",
)
def _(s, d):
    """Records and progress of the event table, controls of the deliveries, barriers with a block, and finality marks."""
    n = C("number")
    record = _normal(s, d).select(F.when(C("kind") == R.PROGRESS, "progress").otherwise("record").alias("kind"), F.when(C("kind") == R.PROGRESS, "").otherwise(F.element_at(F.array(*[F.lit(x) for x in ("included", "safe", "finalized", "pending", "reorged")]), (n % 5 + 1).cast("int"))).alias("status"), "number")
    none = F.lit(None).cast("long").alias("number")
    sent = D.deliveries(s, d)
    control = sent.select(C("payload_kind").alias("kind"), F.lit("").alias("status"), none)
    barrier = sent.where("payload_kind = 'data'").select(F.lit("barrier").alias("kind"), F.lit("blockful").alias("status"), C("head_number").alias("number"))
    mark = D.blocks(s, d).select(F.when(n % 2 == 0, "safe").otherwise("finalized").alias("kind"), F.lit("").alias("status"), "number")
    rows = record.unionByName(control).unionByName(barrier).unionByName(mark)
    return rows.groupBy("kind", "status", R.proves_coverage(C("kind"), C("status"), n).alias("proves")).agg(F.count("*").alias("n"))


@query("nrm10_compact_progress", "SELECT number // 50 AS page_id, max(number) AS number FROM ordered WHERE kind = 2 GROUP BY 1")
def _(s, d):
    return R.compact_progress(_normal(s, d))


@query("nrm11_log_context", "SELECT data, b.parent_hash AS block_parent, b.timestamp AS block_timestamp FROM logs l LEFT JOIN blocks b ON b.number = l.block_number")
def _(s, d):
    bare = D.logs(s, d).withColumn("block_timestamp", F.lit(None).cast("long"))
    return R.log_context(bare, D.blocks(s, d)).select("data", "block_parent", "block_timestamp")
