"""Queries of audience sets, deduplication, history and live union, and source comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlake.operators import hybrid as H
from eventlake.operators import canonical as K
from eventlake.operators import routing as R
from eventlake.operators.scan import violations
from eventlake.plans.canonical_queries import _CHAINS, _REORGS, CHAIN, _with, chains
from eventlake.plans.ctes import covered
from eventlake.plans.registry import query
from eventlake.plans.state_queries import _DIG, _records
from eventlake.sources import derived as D
from eventlake.sources.derived import ACTIVATION

C = F.col

_CUT = "cut AS (SELECT 589 AS fence, 600 AS through), history AS (SELECT * FROM logs WHERE block_number <= 600), live AS (SELECT * REPLACE (CASE WHEN CAST(data AS BIGINT) % 97 = 0 THEN 'changed' ELSE data END AS data) FROM log_arrivals WHERE block_number >= 590)"


def _sides(s, d):
    history = H.payload_digest(D.logs(s, d).where("block_number <= 600"))
    live = D.log_arrivals(s, d).where("block_number >= 590").withColumn("data", F.when(C("data").cast("long") % 97 == 0, F.lit("changed")).otherwise(C("data")))
    return history, H.payload_digest(live)


def _cut(s, d):
    history, live = _sides(s, d)
    return history, live, H.fence(live.where("not removed and block_number % 50 < 48"), history)


@query("str5_srt4_fence", "SELECT 589 AS fence, least(600, (SELECT max(block_number) FROM logs)) AS through")
def _(s, d):
    return _cut(s, d)[2]


@query("str5_set4_hybrid_union", _with(_CUT, "SELECT block_number, log_index, block_hash, data FROM history UNION ALL SELECT block_number, log_index, block_hash, data FROM live WHERE NOT removed AND block_number > 600"))
def _(s, d):
    history, live, cut = _cut(s, d)
    return H.hybrid_union(history, live, cut).select("block_number", "log_index", "block_hash", "data")


@query("jn8_suppress_overlap", _with(_CUT, "SELECT l.block_hash, l.transaction_hash, l.log_index, 'payload' AS rule FROM live l JOIN history h USING (block_hash, transaction_hash, log_index) WHERE l.data <> h.data UNION ALL SELECT block_hash, transaction_hash, log_index, 'missing_in_history' FROM live WHERE NOT removed AND block_number <= 600 AND block_hash <> sha256('b:' || block_number || ':0')"))
def _(s, d):
    return H.overlap_violations(*_cut(s, d))


@query("str6_late_drop_suppression", _with(_CUT, "SELECT block_number, log_index, block_hash FROM live WHERE removed AND block_number <= 600 AND block_hash NOT IN (SELECT block_hash FROM history)"))
def _(s, d):
    history, live, cut = _cut(s, d)
    return H.late_drops(live, history, cut).select("block_number", "log_index", "block_hash")


@query("str7_reconcile_controls", _with(f"{_CHAINS}, {_REORGS}", "SELECT chain_id, 'reorg' AS kind, arrival, old_tip > 600 AND ancestor >= 600 AS keep FROM reorgs UNION ALL SELECT chain_id, 'progress', arrival, number > 600 FROM chains"))
def _(s, d):
    c = chains(s, d)
    none = F.lit(None).cast("long")
    r = K.reorg_events(c, CHAIN).select("chain_id", F.lit("reorg").alias("kind"), "arrival", none.alias("number"), "ancestor", "old_tip")
    p = c.select("chain_id", F.lit("progress").alias("kind"), "arrival", "number", none.alias("ancestor"), none.alias("old_tip"))
    return H.reconcile_controls(r.unionByName(p), _cut(s, d)[2]).select("chain_id", "kind", "arrival", "keep")




_ONE = f"chains AS (SELECT * FROM arrivals), {_REORGS}"
_RECOVERED = "moved AS (SELECT coalesce(min(ancestor), 400) AS anchor FROM reorgs WHERE ancestor < 400)"


@query(
    "str8_recover_from_anchor",
    _with(
        f"{_ONE}, {_RECOVERED}",
        """SELECT 'row' AS kind, block_number AS number, log_index AS at, CASE WHEN block_number <= anchor THEN 'live' ELSE 'history' END AS said FROM logs, moved
UNION ALL SELECT 'reorg', ancestor, greatest(old_tip, (SELECT max(block_number) FROM log_arrivals)), '' FROM reorgs
UNION ALL SELECT 'violation', block_number, log_index, 'not_in_history' FROM log_arrivals, moved WHERE NOT removed AND block_number <= anchor AND block_hash <> sha256('b:' || block_number || ':0')""",
    ),
)
def _(s, d):
    """All that live had sent, stale branches too, fails at block 400; history tells of every reorg."""
    reorgs = K.reorg_events(D.block_arrivals(s, d), CHAIN).select("ancestor", "old_tip")
    live = D.log_arrivals(s, d)
    rows, rebased, alien = H.recover_from_anchor(D.logs(s, d), live, reorgs, 400)
    out = rows.select(F.lit("row").alias("kind"), C("block_number").alias("number"), C("log_index").alias("at"), C("source").alias("said"))
    out = out.unionByName(rebased.select(F.lit("reorg").alias("kind"), C("ancestor").alias("number"), C("old_tip").alias("at"), F.lit("").alias("said")))
    number = live.select("block_hash", "block_number").distinct()
    return out.unionByName(alien.join(number, "block_hash").select(F.lit("violation").alias("kind"), C("block_number").alias("number"), C("log_index").alias("at"), C("rule").alias("said")))


_SEEN = """seen AS (SELECT l.block_number, l.transaction_hash, l.log_index, l.block_hash, l.removed, l.arrival, l.data, unnest(string_split(a.owners, ',')) AS owner_id FROM log_arrivals l JOIN audience a USING (block_number, transaction_index, log_index)),
twice AS (SELECT * FROM seen UNION ALL SELECT * REPLACE (arrival + 1 AS arrival, CASE WHEN CAST(data AS BIGINT) % 11 = 0 THEN 'other' ELSE data END AS data) FROM seen WHERE log_index % 3 = 0),
epochs AS (SELECT t.*, (SELECT count(*) FROM reorgs r WHERE r.arrival <= t.arrival AND r.ancestor < t.block_number AND t.block_number <= r.old_tip) AS epoch FROM twice t)"""


def _deduplicated(s, d):
    """Routed live arrivals, every third log twice, of those some with another payload."""
    r = R.route_logs(D.log_arrivals(s, d), D.interests(s, d), D.owners(s, d), ACTIVATION)
    seen = r.withColumn("owner_id", F.explode(F.when(C("canonical"), F.array(F.lit(""))).otherwise(C("owners"))))
    again = seen.where("log_index % 3 = 0").withColumns({"arrival": C("arrival") + 1, "data": F.when(C("data").cast("long") % 11 == 0, "other").otherwise(C("data"))})
    records = seen.unionByName(again).withColumn("digest", F.sha2("data", 256))
    return H.deduplicate(records, H.IDENTITY, K.reorg_events(D.block_arrivals(s, d), CHAIN))


@query(
    "str9_str10_str11_dedup",
    _with(f"{_ONE}, {_SEEN}", "SELECT owner_id, removed, epoch, removed OR row_number() OVER (PARTITION BY block_hash, transaction_hash, log_index, epoch, owner_id, removed ORDER BY arrival) = 1 AS deliver, block_hash, log_index, arrival FROM epochs"),
)
def _(s, d):
    return _deduplicated(s, d)[0].select("owner_id", "removed", "epoch", "deliver", "block_hash", "log_index", "arrival")


@query("str9_payload_conflicts", _with(f"{_ONE}, {_SEEN}", "SELECT 'payload_conflict' AS rule, block_hash, transaction_hash, log_index FROM twice WHERE NOT removed GROUP BY block_hash, transaction_hash, log_index HAVING count(DISTINCT data) > 1"))
def _(s, d):
    return _deduplicated(s, d)[1]


#: Fixed values of the queries: from which arrival on an owner has which generation.
_GENERATIONS = [("", 3000, 1), ("errors", 4000, 1), ("", 5000, 2), ("user3", 2500, 1), ("low", 6100, 4)]
_COPIES = f"""{_ONE}, seen AS (SELECT l.block_number, l.transaction_hash, l.log_index, l.block_hash, l.removed, l.arrival, l.data, string_split(a.owners, ',') AS asked FROM log_arrivals l JOIN audience a USING (block_number, transaction_index, log_index)),
copied AS (SELECT * REPLACE (arrival * 1000 + 10 + 2 * log_index AS arrival) FROM seen
  UNION ALL SELECT * REPLACE ((arrival + 2) * 1000 + 11 + 2 * log_index AS arrival, CASE WHEN CAST(data AS BIGINT) % 11 = 0 THEN 'other' ELSE data END AS data) FROM seen WHERE log_index % 3 = 0 AND NOT removed
  UNION ALL SELECT * REPLACE ((arrival + 3008) * 1000 + 500 + 2 * log_index AS arrival) FROM seen WHERE CAST(data AS BIGINT) % 4 = 0),
aged AS (SELECT t.*, (SELECT count(*) FROM reorgs r WHERE r.arrival * 1000 <= t.arrival AND r.ancestor < t.block_number AND t.block_number <= r.old_tip) AS epoch FROM copied t),
judged AS (SELECT *, NOT removed AND data = first_value(data) OVER (PARTITION BY block_hash, transaction_hash, log_index, epoch, removed ORDER BY arrival) AS agrees FROM aged),
asked AS (SELECT *, unnest(asked) AS owner FROM judged WHERE agrees),
generations AS (SELECT * FROM (VALUES {", ".join(map(str, _GENERATIONS))}) t(owner, since, generation)),
timed AS (SELECT *, coalesce((SELECT max(generation) FROM generations g WHERE g.owner = asked.owner AND g.since * 1000 <= asked.arrival), 0) AS generation FROM asked),
fresh AS (SELECT block_hash, transaction_hash, log_index, arrival, owner FROM timed QUALIFY row_number() OVER (PARTITION BY block_hash, transaction_hash, log_index, epoch, owner, generation ORDER BY arrival) = 1),
told AS (SELECT block_hash, transaction_hash, log_index, arrival, string_agg(owner, ',' ORDER BY owner) AS owners FROM fresh GROUP BY ALL)"""
_VERDICTS = _with(
    _COPIES,
    "SELECT j.block_hash, j.log_index, j.arrival, CASE WHEN removed THEN 'passed' WHEN NOT agrees THEN 'conflict' WHEN t.owners IS NOT NULL THEN 'delivered' ELSE 'suppressed' END AS verdict, CASE WHEN removed THEN array_to_string(asked, ',') ELSE coalesce(t.owners, '') END AS owners FROM judged j LEFT JOIN told t USING (block_hash, transaction_hash, log_index, arrival)",
)


def _copies(s, d):
    """Routed live arrivals: every third log comes twice, some with another payload, and every fourth event again 300 heights later."""
    r = R.route_logs(D.log_arrivals(s, d), D.interests(s, d), D.owners(s, d), ACTIVATION).where("canonical or size(owners) > 0")
    r = r.withColumn("owners", F.when(C("canonical"), F.array(F.lit(""))).otherwise(C("owners"))).select(*H.IDENTITY, "block_number", "removed", "arrival", "data", "owners")
    n, data = C("log_index"), C("data").cast("long")
    copy = lambda at, text: F.struct(at.alias("arrival"), text.alias("data"))
    again = F.when(~C("removed") & (n % 3 == 0), copy((C("arrival") + 2) * 1000 + 11 + 2 * n, F.when(data % 11 == 0, "other").otherwise(C("data"))))
    late = F.when(data % 4 == 0, copy((C("arrival") + 3008) * 1000 + 500 + 2 * n, C("data")))
    copies = F.array_compact(F.array(copy(C("arrival") * 1000 + 10 + 2 * n, C("data")), again, late))
    rows = r.withColumn("copy", F.explode(copies)).withColumns({"arrival": C("copy.arrival"), "digest": F.sha2("copy.data", 256)}).drop("copy", "data")
    reorgs = K.reorg_events(D.block_arrivals(s, d), CHAIN).select("ancestor", "old_tip", (C("arrival") * 1000).alias("arrival"))
    generations = s.createDataFrame([(o, at * 1000, g) for o, at, g in _GENERATIONS], "owner_id string, arrival bigint, generation bigint")
    return rows, reorgs, generations


def _said(df):
    return df.select("block_hash", "log_index", "arrival", "verdict", F.array_join("owners", ",").alias("owners"))


@query("str9_generations", _VERDICTS)
def _(s, d):
    heights = D.events(s, d).select(C("number").alias("block_number"))
    return _said(H.deduplicate_generations(*_copies(s, d)[:1], H.IDENTITY, *_copies(s, d)[1:], heights))


@query("fn8_identities", _with(_CHAINS, "SELECT 'log' AS kind, count(DISTINCT (block_hash, transaction_hash, log_index)) AS n FROM log_arrivals UNION ALL SELECT 'block', count(DISTINCT (chain_id, hash, number)) FROM chains UNION ALL SELECT 'pending', count(DISTINCT transaction_hash) FROM logs"))
def _(s, d):
    one = F.lit(1).cast("long")
    count = lambda df, identity, kind: df.select(identity.alias("i")).distinct().agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
    out = count(D.log_arrivals(s, d).withColumn("chain_id", one), H.log_identity(), "log")
    return out.unionByName(count(chains(s, d), H.block_identity(), "block")).unionByName(count(D.logs(s, d).withColumn("chain_id", one), H.pending_identity(), "pending"))


@query("str12_control_phases", "SELECT chain_id, number // 50 AS batch, arrival AS ordinal, CASE WHEN arrival % 10 <> 5 AND number % 50 = 48 THEN 0 WHEN arrival % 10 = 5 THEN 1 ELSE 2 END AS phase, arrival % 10 <> 5 AND number % 50 = 48 AS violation FROM arrivals")
def _(s, d):
    kind = F.when((C("arrival") % 10 != 5) & (C("number") % 50 == 48), "reorg").when(C("arrival") % 10 == 5, "record").otherwise("progress")
    a = D.block_arrivals(s, d).select("chain_id", F.floor(C("number") / 50).alias("batch"), C("arrival").alias("ordinal"), kind.alias("kind"))
    return H.control_phases(a, ["chain_id", "batch"])


@query("agg14_batch_accounting", "SELECT block_number AS batch, count(*) FILTER (WHERE NOT removed) AS records, count(*) FILTER (WHERE removed) AS controls, CAST(sum(octet_length(encode(data)) + 512) AS BIGINT) AS bytes, count(*) > 5 OR sum(octet_length(encode(data)) + 512) > 15000 AS over FROM log_arrivals GROUP BY 1")
def _(s, d):
    a = D.log_arrivals(s, d).select(C("block_number").alias("batch"), C("removed").alias("control"), (F.octet_length("data") + 512).alias("bytes"))
    return H.batch_accounting(a, ["batch"], (2048, 5, 15000))


@query("str13_live_buffer_bounds", _with(_CHAINS, "SELECT chain_id, min(arrival) AS poisoned_at FROM (SELECT *, sum(number) OVER (PARTITION BY chain_id ORDER BY arrival) AS r FROM chains) WHERE r > 5000 GROUP BY chain_id"))
def _(s, d):
    c = chains(s, d).select("chain_id", "arrival", C("number").alias("records"), F.lit(1).alias("bytes"))
    return H.live_buffer_bounds(c, CHAIN, (10**6, 5000, 10**9))


@query("str14_phase_timeline", _with(_CHAINS, "SELECT chain_id, arrival, CASE WHEN max(number) OVER w >= 650 THEN 'recovering' WHEN max(number) OVER w >= 600 THEN 'live' WHEN max(number) OVER w >= 589 THEN 'draining' ELSE 'catching_up' END AS phase FROM chains WINDOW w AS (PARTITION BY chain_id ORDER BY arrival)"))
def _(s, d):
    n = C("number")
    return H.phase_timeline(chains(s, d), CHAIN, n >= 589, n >= 600, n >= 650).select("chain_id", "arrival", "phase")


@query("str15_cross_source_reset", _with(f"{_CHAINS}, {_REORGS}, pos AS (SELECT chain_id, source, CAST(300 + 50 * (source = 'live')::INT AS BIGINT) AS head FROM (SELECT DISTINCT chain_id FROM chains), (VALUES ('live'), ('archive')) t(source))", "SELECT p.chain_id, p.source, CASE WHEN p.source = 'archive' THEN (SELECT min(ancestor) FROM reorgs) ELSE p.head END AS head, p.source = 'live' AS has_token FROM pos p"))
def _(s, d):
    c = chains(s, d)
    pos = c.select("chain_id").distinct().withColumn("source", F.explode(F.array(F.lit("live"), F.lit("archive"))))
    pos = pos.select("chain_id", "source", F.when(C("source") == "live", 350).otherwise(300).cast("long").alias("head"), F.lit("t").alias("token"))
    r = K.reorg_events(c, CHAIN).withColumn("source", F.lit("live"))
    return H.cross_source_reset(pos, r).select("chain_id", "source", "head", C("token").isNotNull().alias("has_token"))


@query("str16_source_positions", "SELECT session_id, max(sequence) AS sequence, arg_max(token, sequence) AS token, arg_max(head_number, sequence) AS head FROM deliveries WHERE payload_kind = 'data' GROUP BY session_id")
def _(s, d):
    return H.source_positions(D.deliveries(s, d).where("payload_kind = 'data'"), ["session_id"])


@query("str17_idle_progress", f"SELECT number, NOT EXISTS (SELECT 1 FROM audience a WHERE a.block_number = number AND a.owners = '') AS idle FROM blocks WHERE {covered('number')}")
def _(s, d):
    a = R.route_logs(D.logs(s, d), D.interests(s, d), D.owners(s, d), ACTIVATION).where("canonical").select(C("block_number").alias("number"), F.lit(False).alias("busy")).distinct()
    return R.progress_rows(D.blocks(s, d), D.owners(s, d), ACTIVATION).select("number").join(a, "number", "left").select("number", C("busy").isNull().alias("idle"))


_AUD = "aud AS (SELECT user_id, bool_or(event_type = 'purchase') AS everyone, list_sort(list_distinct(list(event_type))) AS kinds FROM ev GROUP BY user_id)"


def _audiences(s, d):
    g = D.events(s, d).groupBy("user_id").agg(F.bool_or(C("event_type") == "purchase").alias("everyone"), F.array_sort(F.collect_set("event_type")).alias("kinds"))
    return g.select("user_id", "everyone", "kinds")


@query(
    "set1_merge_audience",
    _with(_AUD, """SELECT a.user_id, CASE WHEN a.user_id % 4 = 0 OR b.user_id % 4 = 0 THEN 'all' WHEN a.user_id % 2 = 0 OR b.user_id % 2 = 0 THEN 'except' ELSE 'owners' END AS mode,
array_to_string(CASE WHEN a.user_id % 4 = 0 OR b.user_id % 4 = 0 THEN [] WHEN a.user_id % 2 = 0 AND b.user_id % 2 = 0 THEN list_sort(list_intersect(a.kinds, b.kinds)) WHEN a.user_id % 2 = 0 THEN list_filter(a.kinds, lambda x: NOT list_contains(b.kinds, x))
WHEN b.user_id % 2 = 0 THEN list_filter(b.kinds, lambda x: NOT list_contains(a.kinds, x)) ELSE list_sort(list_distinct(list_concat(a.kinds, b.kinds))) END, ',') AS owners FROM aud a JOIN aud b ON b.user_id = a.user_id + 1"""),
)
def _(s, d):
    mode = lambda u: F.when(u % 4 == 0, H.ALL).when(u % 2 == 0, H.EXCEPT).otherwise(H.OWNERS)
    a = _audiences(s, d).select("user_id", H.audience(mode(C("user_id")), C("kinds")).alias("a"))
    b = a.select((C("user_id") - 1).alias("user_id"), C("a").alias("b"))
    return a.join(b, "user_id").select("user_id", H.merge_audience(C("a"), C("b")).alias("m")).select("user_id", "m.mode", F.array_join("m.owners", ",").alias("owners"))


@query(
    "set2_residual_audience",
    _with(_AUD, """SELECT user_id, CASE WHEN user_id % 2 = 0 THEN 'owners' WHEN len(kinds) = 0 THEN 'all' ELSE 'except' END AS mode, CASE WHEN user_id % 2 = 0 THEN array_to_string(list_filter(['click', 'nobody'], lambda x: NOT list_contains(kinds, x)), ',') ELSE array_to_string(kinds, ',') END AS owners FROM aud"""),
)
def _(s, d):
    a = _audiences(s, d)
    covered = F.map_from_arrays("kinds", F.transform("kinds", lambda k: F.lit(1)))
    generations = F.map_from_arrays(F.array_union("kinds", F.array(F.lit("nobody"))), F.transform(F.array_union("kinds", F.array(F.lit("nobody"))), lambda k: F.lit(1)))
    asked = F.when(C("user_id") % 2 == 0, H.audience(H.OWNERS, F.array(F.lit("click"), F.lit("nobody")))).otherwise(H.audience(H.ALL, F.array().cast("array<string>")))
    r = a.select("user_id", H.residual_audience(F.lit(False), covered, asked, generations).alias("r"))
    return r.select("user_id", "r.mode", F.array_join("r.owners", ",").alias("owners"))


@query("set3_apply_coverage", "SELECT user_id, event_type AS owner_id, max(number) AS generation FROM ev GROUP BY ALL")
def _(s, d):
    return H.apply_coverage(D.events(s, d).select("user_id", C("event_type").alias("owner_id"), C("number").alias("generation")), ["user_id"])


@query("set6_audience_rules", _with(_AUD, "SELECT 'empty_list' AS rule, CAST(user_id AS VARCHAR) AS key FROM aud WHERE user_id % 6 = 1 UNION ALL SELECT 'repeated_owner', CAST(user_id AS VARCHAR) FROM aud WHERE user_id % 6 = 3 UNION ALL SELECT 'catchup_not_listed', CAST(user_id AS VARCHAR) FROM aud WHERE user_id % 6 = 5"))
def _(s, d):
    u = C("user_id") % 6
    a = _audiences(s, d).select(
        "user_id",
        F.when(u == 5, H.ALL).otherwise(H.OWNERS).alias("mode"),
        F.when(u == 1, F.slice("kinds", 1, 0)).when(u == 3, F.concat("kinds", "kinds")).otherwise(C("kinds")).alias("owners"),
        F.when(u == 5, "OWNER_CATCHUP").otherwise("CANONICAL").alias("scope"),
    )
    return violations(a, H.audience_rules(), C("user_id"))


@query(
    "agg2_merge_duplicates",
    _with(_DIG.format("log_arrivals"), """SELECT transaction_hash, log_index, bool_or(log_index % 4 = 0) AS everyone, CASE WHEN bool_or(log_index % 4 = 0) THEN '' ELSE string_agg(DISTINCT CASE WHEN removed THEN 'b' ELSE 'a' END, ',' ORDER BY CASE WHEN removed THEN 'b' ELSE 'a' END) END AS owners,
CASE WHEN bool_or(block_number >= 360 OR block_number BETWEEN 240 AND 299) THEN 'CANONICAL_PROGRESS' ELSE 'OWNER_CATCHUP' END AS scope, count(DISTINCT digest) > 1 AS conflict FROM dig GROUP BY transaction_hash, log_index"""),
)
def _(s, d):
    r = H.payload_digest(D.log_arrivals(s, d))
    r = r.withColumns({"owner_id": F.when(C("log_index") % 4 == 0, F.lit(None)).when(C("removed"), "b").otherwise("a"), "scope": R.scope_of(C("block_number"), ACTIVATION, R.global_backfill(D.owners(s, d), C("block_number")))})
    return H.merge_duplicates(r, ["transaction_hash", "log_index"]).withColumn("owners", F.array_join("owners", ","))


@query("agg3_merge_block_metadata", "SELECT number, hash, parent_hash, timestamp, number % 100 = 9 AS conflict FROM blocks")
def _(s, d):
    b = D.blocks(s, d)
    bare = b.withColumns({"parent_hash": F.lit(None).cast("string"), "timestamp": F.when(C("number") % 100 == 9, C("timestamp") - 1)})
    return H.merge_block_metadata(b.unionByName(bare))


@query("agg4_merge_lifecycle", "SELECT number, CASE WHEN number % 3 = 0 THEN 'finalized' WHEN number % 3 = 1 THEN 'safe' ELSE 'included' END AS status, number % 10 = 4 AS conflict FROM blocks")
def _(s, d):
    b = D.blocks(s, d).select("number")
    mark = lambda w, k: b.where(w).select("number", F.lit(k).alias("status"))
    m = mark("true", "included").unionByName(mark("number % 3 <> 2", "safe")).unionByName(mark("number % 3 = 0", "finalized")).unionByName(mark("number % 10 = 4", "pending"))
    return H.merge_lifecycle(m, ["number"])


@query("agg10_routing_fanout", "SELECT block_number // 50 AS page_id, CAST(sum(CASE WHEN owners = '' THEN 10 ELSE len(string_split(owners, ',')) END) AS BIGINT) AS fanout FROM audience GROUP BY 1")
def _(s, d):
    r = _records(s, d).withColumn("mode", F.when(C("canonical"), H.ALL).otherwise(H.OWNERS))
    return r.groupBy("page_id").agg(H.routing_fanout(r, 10).alias("fanout"))


@query("jn12_set5_compare_sources", "SELECT block_number, log_index, data, CASE WHEN CAST(data AS BIGINT) % 50 = 1 THEN 1 ELSE 0 END AS left_n, 0 + CASE WHEN CAST(data AS BIGINT) % 50 = 2 THEN 2 ELSE 0 END AS right_n FROM logs WHERE CAST(data AS BIGINT) % 50 = 1 UNION ALL SELECT block_number, log_index, data, 1, 2 FROM logs WHERE CAST(data AS BIGINT) % 50 = 2")
def _(s, d):
    a = D.logs(s, d).select("block_number", "log_index", "data")
    b = a.where(C("data").cast("long") % 50 != 1)
    return H.compare_sources(a, b.unionByName(a.where(C("data").cast("long") % 50 == 2)))


_PAIRS = "pairs AS (SELECT chain_id, number, 7 + number % 13 AS delta, 20 + number % 3 AS a_took, 10 + number % 5 AS b_took FROM (SELECT DISTINCT chain_id, number, hash FROM chains WHERE arrival % 10 = 5) WHERE number % 2 = 0 AND number > 0)"


def _pairs(s, d):
    a = chains(s, d).where("arrival % 10 = 5")
    left = a.select("chain_id", "number", "hash", (C("timestamp") + 7 + C("number") % 13).alias("seen"), (20 + C("number") % 3).alias("took"))
    return H.pair_arrivals(left, a.where("number % 2 = 0").select("chain_id", "number", "hash", C("timestamp").alias("seen"), (10 + C("number") % 5).alias("took")), CHAIN)


@query("jn13_pair_arrivals", _with(f"{_CHAINS}, {_PAIRS}", "SELECT * FROM pairs"))
def _(s, d):
    return _pairs(s, d)


@query("agg13_compare_stats", _with(f"{_CHAINS}, {_PAIRS}", "SELECT chain_id, median(delta) AS median, avg(delta) AS mean, min(delta) AS least, max(delta) AS most, sum(a_took) / sum(b_took) AS speed_up FROM pairs GROUP BY chain_id"))
def _(s, d):
    return H.compare_stats(_pairs(s, d), CHAIN)


@query(
    "aud9_validate_source_positions",
    _with(
        _CHAINS,
        """SELECT ['ahead_of_coordinator', 'other_block_at_head', 'token_without_head', 'token_without_digest', 'token_without_coverage'][CAST(chain_id AS INTEGER)] AS rule, chain_id || ':live' AS key FROM (SELECT DISTINCT chain_id FROM chains WHERE chain_id <= 5)
UNION ALL SELECT 'token_without_coverage', '3:live' UNION ALL SELECT 'token_without_coverage', '1:live' UNION ALL SELECT 'unknown_chain', '6:live'""",
    ),
)
def _(s, d):
    """Of eight chains five break a rule each (the first and third one more), one is unknown and two are right."""
    t = K.tip(K.canonical_chain(chains(s, d), CHAIN), CHAIN)
    c = C("chain_id")
    pos = t.select(
        "chain_id", F.lit("live").alias("source"), F.when(c == 1, C("tip") + 1).when(c != 3, C("tip")).alias("head"), F.when(c == 2, "zz").otherwise(C("tip_hash")).alias("hash"),
        F.lit("t").alias("token"), F.when(c != 4, "d").alias("digest"), F.when(c == 5, C("tip") - 1).when(c != 3, C("tip")).alias("coverage"),
    )
    return H.validate_source_positions(pos, t.where("chain_id <> 6").select("chain_id", C("tip").alias("head"), C("tip_hash").alias("hash")))


_JOURNAL_RULES = ["wrong_chain", "generation_ahead", "lifecycle_of_kind", "block_of_identity", "coverage_ahead", "proof_of_other_generation", "proof_ahead", "digest_missing"]


@query(
    "aud10_validate_witnesses",
    f"""SELECT rule, count(*) AS n FROM (SELECT {_JOURNAL_RULES}[CAST(data AS BIGINT) % 40 + 1] AS rule FROM logs WHERE CAST(data AS BIGINT) % 40 < {len(_JOURNAL_RULES)}
UNION ALL SELECT 'block_ahead' FROM logs WHERE block_number > (SELECT max(number) - 5 FROM blocks) UNION ALL SELECT 'coverage_ahead' FROM logs WHERE block_number > (SELECT max(number) - 5 FROM blocks) AND CAST(data AS BIGINT) % 40 NOT IN (4, 6)
UNION ALL SELECT 'repeated_identity' FROM logs WHERE block_number = 7) GROUP BY rule""",
)
def _(s, d):
    """One in forty logs breaks each rule; the journal's head is five below the newest block; block 7 stands twice."""
    head = D.blocks(s, d).agg(F.max("number")).first()[0] - 5
    k, n = C("data").cast("long") % 40, C("block_number")
    w = H.payload_digest(D.logs(s, d)).select(
        F.concat_ws(":", *H.IDENTITY).alias("identity"), F.when(k == 0, 2).otherwise(1).alias("chain_id"), F.lit("log").alias("kind"), F.when(k == 2, "pending").otherwise("included").alias("status"),
        F.when(k != 7, C("digest")).alias("digest"), F.when(k == 1, 3).otherwise(1).alias("generation"), F.lit(2).alias("current_generation"), "block_number", F.when(k == 3, n + 1).otherwise(n).alias("identity_block"),
        F.when(k == 4, F.lit(head + 1)).when(k == 6, F.least(n, F.lit(head)) - 1).otherwise(n).alias("coverage"), F.when(k == 5, 1).when(k == 6, 2).alias("proof_generation"),
    )
    again = w.where("block_number = 7").withColumns({"chain_id": F.lit(1), "status": F.lit("included"), "digest": F.lit("x"), "generation": F.lit(1), "identity_block": n, "coverage": n, "proof_generation": F.lit(None).cast("int")})
    return H.validate_witnesses(w.unionByName(again), head).groupBy("rule").agg(F.count("*").alias("n"))


@query("aud11_token_reuse", "SELECT token, count(DISTINCT head_hash) AS digests FROM deliveries WHERE payload_kind = 'data' GROUP BY token HAVING count(DISTINCT head_hash) > 1 UNION ALL SELECT lpad(lower(to_hex(sequence)), 16, '0'), 2 FROM deliveries WHERE session_id = 's3' AND sequence = 9")
def _(s, d):
    x = D.deliveries(s, d).where("payload_kind = 'data' or (session_id = 's3' and sequence = 9)")
    return H.token_reuse(x.select("token", F.when((C("session_id") == "s3") & (C("sequence") == 9), F.lit("other")).otherwise(F.coalesce("head_hash", F.lit("-"))).alias("digest")))


@query("aud13_coverage_state", "SELECT 'scan_ahead' AS rule, session_id || ':' || sequence AS key FROM deliveries WHERE payload_kind = 'data' AND sequence % 8 = 1 UNION ALL SELECT 'coverage_block', session_id || ':' || sequence FROM deliveries WHERE payload_kind <> 'barrier' AND sequence % 8 = 3")
def _(s, d):
    k = C("sequence") % 8
    x = D.deliveries(s, d).withColumns({"next_block": C("next_block") + F.when((k == 1) & (C("payload_kind") == "data"), 5).otherwise(0), "head_hash": F.when(k == 3, "zz").otherwise(C("head_hash"))})
    return H.coverage_state(x, D.blocks(s, d))


@query("aud14_owner_only_reorg", _with(f"{_CHAINS}, {_REORGS}", "SELECT chain_id, ancestor, old_tip FROM reorgs WHERE old_tip < 360 AND NOT old_tip BETWEEN 240 AND 299"))
def _(s, d):
    return H.owner_only_reorgs(K.reorg_events(chains(s, d), CHAIN), D.owners(s, d), ACTIVATION).select("chain_id", "ancestor", "old_tip")
