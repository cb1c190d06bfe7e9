"""Queries of topology, deliveries, hybrid union and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlake.operators import canonical as K
from eventlake.operators import delivery as L
from eventlake.operators import hybrid as H
from eventlake.operators import routing as R
from eventlake.operators import topology as T
from eventlake.operators import validate as V
from eventlake.plans.canonical_queries import _CHAINS, _REORGS, CHAIN, _with, chains
from eventlake.plans.registry import query
from eventlake.plans.routing_queries import _normal
from eventlake.sources import derived as D
from eventlake.sources.derived import ACTIVATION, PAGE_BLOCKS

C = F.col


def _text(c):
    return F.array_join(c, ",")


# ------------------------------------------------------------------ topology

_REQ = """req AS (SELECT 's' || user_id AS session_id, event_id AS ordinal, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM ev),
requests AS (SELECT session_id, ordinal * 4 AS ordinal, r - 1 AS expected_revision, r AS new_revision, 'd' || r AS digest, 'applied' AS outcome FROM req
  UNION ALL SELECT session_id, ordinal * 4 + 1, r - 1, r, 'd' || r, 'duplicate' FROM req WHERE r % 3 = 0 UNION ALL SELECT session_id, ordinal * 4 + 2, r - 2, r - 1, 'x', 'conflict' FROM req WHERE r % 5 = 0
  UNION ALL SELECT session_id, ordinal * 4 + 3, r + 5, r + 6, 'y', 'conflict' FROM req WHERE r % 7 = 0)"""


def requests(s, d):
    from pyspark.sql import Window

    e = D.events(s, d).select(F.concat(F.lit("s"), C("user_id").cast("string")).alias("session_id"), C("event_id").alias("ordinal"))
    e = e.withColumn("r", F.row_number().over(Window.partitionBy("session_id").orderBy("ordinal")).cast("long"))
    row = lambda o, a, b, g: F.struct((C("ordinal") * 4 + o).alias("ordinal"), a.alias("expected_revision"), b.alias("new_revision"), g.alias("digest"))
    r, same = C("r"), F.concat(F.lit("d"), C("r").cast("string"))
    rows = F.array(row(0, r - 1, r, same), F.when(r % 3 == 0, row(1, r - 1, r, same)), F.when(r % 5 == 0, row(2, r - 2, r - 1, F.lit("x"))), F.when(r % 7 == 0, row(3, r + 5, r + 6, F.lit("y"))))
    return e.select("session_id", F.explode(F.array_compact(rows)).alias("q")).select("session_id", "q.*")


_ANSWERED = _with(_REQ, "SELECT session_id, ordinal, expected_revision, new_revision, outcome FROM requests")


@query("own1_apply_desired_state", _ANSWERED)
def _(s, d):
    return T.apply_desired_state(requests(s, d))


@query("own1_apply_desired_state_segmented", _ANSWERED)
def _(s, d):
    """Each session's requests over as many tasks as it has segments."""
    return T.apply_desired_state_segmented(requests(s, d), 1 << 10)


_SHOW = "owner_id, canonical, coalesce(from_block, -1) AS from_block, coalesce(to_block_excl, -1) AS to_block_excl"


def _show(df):
    return df.select("owner_id", "canonical", F.coalesce("from_block", F.lit(-1)).cast("long").alias("from_block"), F.coalesce("to_block_excl", F.lit(-1)).cast("long").alias("to_block_excl"))


def _moved(s, d):
    return D.owners(s, d).where("owner_id like 'user%'").withColumn("from_block", C("from_block") + 7)


@query("own2_upsert_owners", f"SELECT owner_id, canonical, coalesce(CASE WHEN owner_id LIKE 'user%' THEN from_block + 7 ELSE from_block END, -1) AS from_block, coalesce(to_block_excl, -1) AS to_block_excl FROM owners")
def _(s, d):
    return _show(T.upsert_owners(D.owners(s, d), _moved(s, d)))


@query("own3_replace_owners", "SELECT owner_id, canonical, from_block + 7 AS from_block, to_block_excl FROM owners WHERE owner_id LIKE 'user%'")
def _(s, d):
    return _show(T.replace_owners(D.owners(s, d), _moved(s, d)))


@query("own4_replace_with_global_backfill", "SELECT owner_id, canonical, from_block + 7 AS from_block, to_block_excl FROM owners WHERE owner_id LIKE 'user%' UNION ALL SELECT '', true, 90, -1")
def _(s, d):
    return _show(T.replace_owners_with_global_backfill(D.owners(s, d), _moved(s, d), 90))


@query("own5_add_owner", f"SELECT {_SHOW} FROM owners WHERE owner_id <> 'user2' UNION ALL SELECT owner_id, canonical, 207, to_block_excl FROM owners WHERE owner_id = 'user2'")
def _(s, d):
    return _show(T.add_owner(D.owners(s, d), _moved(s, d).where("owner_id = 'user2'"), 206))


@query("own6_canonical_catchup", f"SELECT {_SHOW} FROM owners WHERE owner_id NOT IN ('user2', '') UNION ALL SELECT 'user2', false, 300, -1 UNION ALL SELECT '', true, 301, -1")
def _(s, d):
    return _show(T.add_owner_with_canonical_catchup(D.owners(s, d), _moved(s, d).where("owner_id = 'user2'"), 300))


@query("own7_remove_owner", f"SELECT {_SHOW} FROM owners WHERE owner_id NOT LIKE 'user%'")
def _(s, d):
    return _show(T.remove_owner(D.owners(s, d), _moved(s, d)))


@query("own8_register_base", "SELECT owner_id, true AS canonical, -1 AS from_block, -1 AS to_block_excl, (SELECT count(*) FROM owners) AS dropped_of FROM owners WHERE owner_id = ''")
def _(s, d):
    o = D.owners(s, d)
    return _show(T.register_base_interests(o)).join(o.agg(F.count("*").alias("dropped_of")))


_PRINT = """framed AS (SELECT owner_id, sha256('interest:' || kind || ':' || len(a) || '[' || array_to_string(list_transform(a, lambda x: length(x) || ':' || x), '') || ']'
  || CASE WHEN w >= 1 THEN len(t0) || '[' || array_to_string(list_transform(list_sort(t0), lambda x: length(x) || ':' || x), '') || ']' ELSE '' END
  || CASE WHEN w >= 2 THEN len(t1) || '[' || array_to_string(list_transform(list_sort(t1), lambda x: length(x) || ':' || x), '') || ']' ELSE '' END) AS digest
  FROM (SELECT *, list_sort(list_distinct(addresses)) AS a, CASE WHEN len(t1) > 0 THEN 2 WHEN len(t0) > 0 THEN 1 ELSE 0 END AS w FROM interests)),
prints AS (SELECT owner_id, sha256(string_agg(digest, ',' ORDER BY digest)) AS fingerprint FROM framed GROUP BY owner_id)"""


@query("own12_interest_fingerprint", _with(_PRINT, "SELECT * FROM prints"))
def _(s, d):
    return T.interest_fingerprints(D.interests(s, d))


@query("own9_build_desired_state", _with(_PRINT, "SELECT o.owner_id, p.fingerprint, CAST(1 AS BIGINT) AS n_interests FROM owners o JOIN prints p USING (owner_id)"))
def _(s, d):
    return T.build_desired_state(D.owners(s, d), D.interests(s, d)).select("owner_id", "fingerprint", "n_interests")


@query("own10_validate_desired_state", "SELECT 'backfill_order' AS rule, owner_id AS key FROM owners WHERE owner_id LIKE 'user%' UNION ALL SELECT 'address_width', owner_id || '/own' FROM owners WHERE owner_id LIKE 'user%' UNION ALL SELECT 'unknown_owner', 'pool/two' FROM owners WHERE owner_id = 'pool'")
def _(s, d):
    o = D.owners(s, d).where("owner_id <> 'pool'").withColumn("to_block_excl", F.when(C("owner_id").startswith("user"), C("from_block")).otherwise(C("to_block_excl")))
    i = D.interests(s, d).withColumn("addresses", F.when(C("owner_id").startswith("user"), F.transform("addresses", lambda a: F.substring(a, 1, 39))).otherwise(C("addresses")))
    return T.validate_desired_state(o, i)


@query("own11_topology_diff", _with(_PRINT, "SELECT owner_id, CASE WHEN owner_id = 'errors' THEN 'removed' WHEN owner_id IN (SELECT owner_id FROM interests WHERE owner_id LIKE 'user%' AND len(addresses) > 1) THEN 'changed' ELSE 'listed' END AS change, CASE WHEN owner_id = 'errors' THEN -1 ELSE 2 END AS generation FROM prints UNION ALL SELECT 'new', 'added', 2"))
def _(s, d):
    i = D.interests(s, d)
    old = T.interest_fingerprints(i).withColumn("generation", F.lit(1))
    new = i.where("owner_id <> 'errors'").withColumn("addresses", F.when(C("owner_id").startswith("user"), F.slice("addresses", 1, 1)).otherwise(C("addresses")))
    more = i.where("owner_id = 'errors'").withColumn("owner_id", F.lit("new"))
    diff = T.topology_diff(old, T.interest_fingerprints(new.unionByName(more)), True, 2)
    return diff.select("owner_id", "change", F.coalesce("generation", F.lit(-1)).cast("long").alias("generation"))


@query("own13_exclusive_topology", "SELECT count(*) FILTER (WHERE owner_id = '') AS base, count(*) FILTER (WHERE owner_id <> '') AS named, true AS violated FROM interests UNION ALL SELECT 0, count(*), false FROM interests WHERE owner_id <> '' UNION ALL SELECT count(*), 0, false FROM interests WHERE owner_id = ''")
def _(s, d):
    """All owners, the named ones alone, and the base owner alone."""
    o, i = D.owners(s, d), D.interests(s, d)
    sets = [o, o.where("owner_id <> ''"), o.where("owner_id = ''")]
    rows = [T.exclusive_topology(x, i) for x in sets]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("agg11_interest_quotas", "SELECT 'addresses_per_interest' AS rule, owner_id AS key, len(addresses) AS value FROM interests WHERE len(addresses) > 2 UNION ALL SELECT 'owners', 'all', count(*) FROM owners HAVING count(*) > 8 UNION ALL SELECT 'bounded_span', 'all', max(to_block_excl - from_block) FROM owners HAVING max(to_block_excl - from_block) > 120")
def _(s, d):
    return T.interest_quotas(D.owners(s, d), D.interests(s, d), {"addresses_per_interest": 2, "owners": 8, "bounded_span": 120, "interests": 10_000})


@query("agg15_bkf2_min_backfill", "SELECT min(from_block) AS low, count(from_block) AS n FROM owners")
def _(s, d):
    return D.owners(s, d).agg(F.min("from_block").alias("low"), F.count("from_block").alias("n"))


@query("bkf1_backfill_covers", "SELECT owner_id, count(*) AS n FROM owners JOIN blocks ON from_block <= number AND (to_block_excl IS NULL OR number < to_block_excl) GROUP BY owner_id")
def _(s, d):
    o = D.owners(s, d).select("owner_id", C("from_block").alias("low"), C("to_block_excl").alias("high"))
    held = R.blocks_held(D.blocks(s, d), o)
    return o.join(held, (C("low") == C("of_low")) & C("high").eqNullSafe(C("of_high"))).groupBy("owner_id").agg(F.sum("n_blocks").alias("n"))


@query("bkf3_global_backfill", "SELECT number BETWEEN 90 AND 189 OR number >= 500 AS everyone, count(*) AS n FROM blocks GROUP BY 1")
def _(s, d):
    """The base owner's own backfill, and beside it a second canonical one that is open-ended."""
    base = T.base_owner(D.owners(s, d), 90).withColumn("to_block_excl", F.lit(190).cast("long"))
    o = D.owners(s, d).where("owner_id <> ''").unionByName(base).unionByName(base.withColumns({"from_block": F.lit(500).cast("long"), "to_block_excl": F.lit(None).cast("long")}))
    return D.blocks(s, d).groupBy(R.global_backfill(o, C("number")).alias("everyone")).agg(F.count("*").alias("n"))


@query("bkf4_backfill_complete", "SELECT owner_id, coalesce(to_block_excl, 360) AS target, 320 >= coalesce(to_block_excl, 360) AS complete FROM owners WHERE from_block IS NOT NULL")
def _(s, d):
    return T.backfill_complete(D.owners(s, d), 320, ACTIVATION)


@query("bkf5_mutation_fence", "SELECT 's' || user_id AS session_id, CASE WHEN user_id % 3 = 0 THEN 'replace' ELSE 'upsert' END AS kind, user_id % 3 <> 0 AS rejected FROM (SELECT DISTINCT user_id FROM ev)")
def _(s, d):
    r = D.events(s, d).select("user_id").distinct().select(F.concat(F.lit("s"), C("user_id").cast("string")).alias("session_id"), F.when(C("user_id") % 3 == 0, "replace").otherwise("upsert").alias("kind"))
    return T.mutation_fence(r, T.backfill_complete(D.owners(s, d), 320, ACTIVATION))


@query("bkf6_activation_delivery", "SELECT session_id, 'desired-state:2' AS barrier_id, 50 AS next_block, max(head_number) AS head_number, true AS checkpoint_neutral FROM deliveries GROUP BY session_id")
def _(s, d):
    heads = D.deliveries(s, d).groupBy("session_id").agg(F.max("next_block").alias("next_block"), F.max("head_number").alias("head_number"))
    return T.activation_delivery(heads, 2, 50)


@query("bkf7_owner_catchup_overlap", "SELECT o.number, kind, o.log_index FROM ordered o JOIN blocks b ON b.number = o.number WHERE o.scope = 'OWNER_CATCHUP' AND o.number % 10 = 3")
def _(s, d):
    b = D.blocks(s, d)
    history = b.withColumn("hash", F.when(C("number") % 10 == 3, F.lit("00")).otherwise(C("hash")))
    return T.owner_catchup_overlap(_normal(s, d).join(b.select("number", "hash"), "number"), history).select("number", "kind", "log_index")


# ------------------------------------------------------------------ deliveries


@query("snk1_new_deliveries", "SELECT session_id, sequence, 'new' AS status FROM deliveries WHERE sequence % 4 = 0 UNION ALL SELECT session_id, sequence, 'conflict' FROM deliveries WHERE sequence % 4 = 1")
def _(s, d):
    a = D.deliveries(s, d).withColumn("digest", F.sha2(F.concat_ws(":", "payload_kind", "next_block"), 256))
    incoming = a.withColumn("digest", F.when(C("sequence") % 4 == 1, F.lit("00")).otherwise(C("digest")))
    new, bad = L.new_deliveries(a.where("sequence % 4 <> 0"), incoming)
    return new.select("session_id", "sequence", F.lit("new").alias("status")).unionByName(bad.select("session_id", "sequence", F.lit("conflict").alias("status")))


_ACKED = """SELECT session_id, sequence * 4 AS ordinal, sequence, 'committed' AS outcome FROM acks
UNION ALL SELECT session_id, sequence * 4 + 1, sequence, CASE WHEN sequence % 3 = 0 THEN 'duplicate' ELSE 'mismatch' END FROM acks WHERE sequence % 5 < 2
UNION ALL SELECT session_id, (sequence - 3) * 4 + 2, sequence, 'mismatch' FROM acks WHERE sequence % 7 = 5 UNION ALL SELECT session_id, 3, -777, 'none_pending' FROM acks WHERE sequence = 1"""


@query(
    "snk2_commit_acks",
    _ACKED,
)
def _(s, d):
    return L.classify_acks(D.deliveries(s, d), _acked(s, d)).drop("chain_id")


@query("snk2_commit_acks_segmented", _ACKED)
def _(s, d):
    """Each session's acks over as many tasks as it has segments."""
    return L.classify_acks_segmented(D.deliveries(s, d), _acked(s, d), 1 << 10).drop("chain_id")


def _acked(s, d):
    """Acks in turn, repeats with and without the right token, right acks that come three deliveries early, and one of no delivery."""
    a = D.acks(s, d)
    again = a.where("sequence % 5 < 2").withColumns({"ordinal": C("sequence") * 4 + 1, "token": F.when(C("sequence") % 3 == 0, C("token")).otherwise(F.lit("ff"))})
    early = a.where("sequence % 7 = 5").withColumn("ordinal", (C("sequence") - 3) * 4 + 2)
    lost = a.where("sequence = 1").withColumns({"ordinal": F.lit(3).cast("long"), "sequence": F.lit(-777).cast("long")})
    every = a.withColumn("ordinal", C("sequence") * 4).unionByName(again).unionByName(early).unionByName(lost)
    return every


_STATE = "state AS (SELECT session_id, max(query_revision) AS revision, max(sequence) - 1 AS acked, arg_max(next_block, sequence) FILTER (WHERE sequence < n) AS acked_next, arg_max(head_number, sequence) FILTER (WHERE sequence < n AND NOT checkpoint_neutral) AS runtime_head, max(sequence) AS pending FROM (SELECT *, max(sequence) OVER (PARTITION BY session_id) AS n FROM deliveries) GROUP BY session_id)"


@query("snk3_snk4_session_state", _with(_STATE, "SELECT session_id, revision, acked, acked_next, runtime_head, pending FROM state"))
def _(s, d):
    return L.session_state(D.deliveries(s, d), D.acks(s, d)).select("session_id", "revision", "acked", "acked_next", "runtime_head", "pending")


@query("snk5_pending_deliveries", "SELECT session_id, sequence, token FROM deliveries QUALIFY sequence = max(sequence) OVER (PARTITION BY session_id)")
def _(s, d):
    return L.pending_deliveries(D.deliveries(s, d), D.acks(s, d)).select("session_id", "sequence", "token")


@query("snk6_replay_status", "SELECT session_id, sequence, sequence * 10 AS sent_at, false AS replay FROM deliveries UNION ALL SELECT session_id, sequence, sequence * 10 + 3, true FROM deliveries WHERE sequence % 6 = 0")
def _(s, d):
    a = D.deliveries(s, d).select("session_id", "sequence", (C("sequence") * 10).alias("sent_at"))
    return L.replay_status(a.unionByName(a.where("sequence % 6 = 0").withColumn("sent_at", C("sent_at") + 3)))


def _records(s, d):
    return R.route_logs(D.logs(s, d), D.interests(s, d), D.owners(s, d), ACTIVATION).withColumn("page_id", F.floor(C("block_number") / PAGE_BLOCKS))


@query("pag6_fn12_delivery_size", "SELECT block_number // 50 AS page_id, CAST(sum(640 + octet_length(encode(l.data)) + CASE WHEN a.owners = '' THEN 0 ELSE length(replace(a.owners, ',', '')) + 32 * len(string_split(a.owners, ',')) END) + 16 AS BIGINT) AS bytes FROM logs l JOIN audience a USING (block_number, transaction_index, log_index) GROUP BY 1")
def _(s, d):
    return L.delivery_sizes(_records(s, d), ["page_id"])


@query("fn12_control_bytes", "SELECT session_id, CAST(sum(256 + length(payload_kind)) AS BIGINT) AS bytes FROM deliveries WHERE payload_kind <> 'data' GROUP BY session_id")
def _(s, d):
    return D.deliveries(s, d).where("payload_kind <> 'data'").groupBy("session_id").agg(F.sum(L.control_bytes("payload_kind")).cast("long").alias("bytes"))


_DIG = "dig AS (SELECT *, sha256(array_to_string(list_transform([CAST(block_number AS VARCHAR), block_hash, transaction_hash, CAST(transaction_index AS VARCHAR), CAST(log_index AS VARCHAR), address, topic0 || ',' || topic1, data, CAST(removed AS VARCHAR)], lambda x: length(x) || ':' || x), '')) AS digest FROM {})"


@query("fn6_fn8_payload_digest", _with(_DIG.format("logs"), "SELECT block_number, log_index, digest FROM dig"))
def _(s, d):
    return H.payload_digest(D.logs(s, d)).select("block_number", "log_index", "digest")


@query("fn7_delivery_digest", _with(_DIG.format("logs"), "SELECT block_number // 50 AS page_id, sha256(string_agg(digest, ',' ORDER BY block_number * 100000 + log_index)) AS digest FROM dig GROUP BY 1"))
def _(s, d):
    r = H.payload_digest(D.logs(s, d)).select(F.floor(C("block_number") / PAGE_BLOCKS).alias("page_id"), (C("block_number") * 100000 + C("log_index")).alias("ordinal"), "digest")
    return L.delivery_digests(r, ["page_id"])


@query("fn4_delivery_token", "SELECT session_id, sequence, token FROM deliveries")
def _(s, d):
    return D.deliveries(s, d).select("session_id", "sequence", L.token("sequence").alias("token"))


@query("agg12_service_metrics", "SELECT count(DISTINCT session_id) AS sessions, count(*) AS persisted, count(*) FILTER (WHERE payload_kind = 'reorg') AS reorgs, count(*) FILTER (WHERE checkpoint_neutral) AS neutral, (SELECT count(*) FROM acks) AS acks, count(*) FILTER (WHERE sequence % 6 = 0) AS replayed, (SELECT count(*) FROM ev WHERE event_type = 'error') AS source_errors FROM deliveries")
def _(s, d):
    x = D.deliveries(s, d)
    sent = x.select("session_id", "sequence", (C("sequence") * 10).alias("sent_at"))
    sends = L.replay_status(sent.unionByName(sent.where("sequence % 6 = 0").withColumn("sent_at", C("sent_at") + 3)))
    return L.service_metrics(x, D.acks(s, d), sends, D.events(s, d).where("event_type = 'error'"))


def _broken(s, d):
    x = D.deliveries(s, d)
    changed = (C("sequence") % 13 == 8) & (C("payload_kind") == "data")  # the head of the reorg before it, under another hash
    x = x.withColumns({"head_number": F.when(changed, C("head_number") - 2).otherwise(C("head_number")), "head_hash": F.when(changed, F.lit("zz")).otherwise(C("head_hash"))})
    return x.withColumns({"next_block": F.when(C("sequence") % 9 == 6, C("next_block") - 200).otherwise(C("next_block")), "token": F.when(C("sequence") % 11 == 3, F.lit("ff")).otherwise(C("token"))})


_BROKEN = "broken AS (SELECT * REPLACE (CASE WHEN sequence % 13 = 8 AND payload_kind = 'data' THEN head_number - 2 ELSE head_number END AS head_number, CASE WHEN sequence % 13 = 8 AND payload_kind = 'data' THEN 'zz' ELSE head_hash END AS head_hash, CASE WHEN sequence % 9 = 6 THEN next_block - 200 ELSE next_block END AS next_block, CASE WHEN sequence % 11 = 3 THEN 'ff' ELSE token END AS token) FROM deliveries), lagged AS (SELECT *, lag(next_block) OVER w AS p_next, lag(head_number) OVER w AS p_head, lag(head_hash) OVER w AS p_hash, lag(sequence) OVER w AS p_seq FROM broken WINDOW w AS (PARTITION BY session_id ORDER BY sequence))"
_REGRESS = "SELECT 'next_block_regressed' AS rule, session_id || ':' || sequence AS key FROM lagged WHERE payload_kind <> 'reorg' AND p_seq IS NOT NULL AND NOT checkpoint_neutral AND next_block < p_next UNION ALL SELECT 'head_regressed', session_id || ':' || sequence FROM lagged WHERE payload_kind <> 'reorg' AND head_number < p_head UNION ALL SELECT 'head_changed', session_id || ':' || sequence FROM lagged WHERE payload_kind <> 'reorg' AND head_number = p_head AND head_hash <> p_hash UNION ALL SELECT 'token_mismatch', session_id || ':' || sequence FROM lagged WHERE sequence % 11 = 3"


@query("win4_win5_cursor_regressions", _with(_BROKEN, _REGRESS))
def _(s, d):
    return L.cursor_regressions(_broken(s, d))


@query("aud4_validate_progress", _with(_BROKEN, _REGRESS + " UNION ALL SELECT 'head_ahead_of_scan', session_id || ':' || sequence FROM broken WHERE head_number >= next_block UNION ALL SELECT 'next_not_after_head', session_id || ':' || sequence FROM broken WHERE payload_kind = 'data' AND next_block <> head_number + 1"))
def _(s, d):
    return L.validate_progress(_broken(s, d))


@query("win11_scan_progress", _with(_BROKEN, "SELECT session_id, sequence, next_block, coverage FROM (SELECT *, max(head_number) OVER (PARTITION BY session_id ORDER BY sequence) AS coverage FROM broken) WHERE next_block <= coverage"))
def _(s, d):
    return L.scan_progress(_broken(s, d)).drop("chain_id")


@query("aud5_activation_boundary", "SELECT 'boundary_moved' AS rule, session_id || ':' || sequence AS key FROM deliveries WHERE sequence IN (20, 21) UNION ALL SELECT 'boundary_below_scan', session_id || ':' || sequence FROM deliveries WHERE next_block > CASE WHEN sequence = 20 THEN 900 ELSE 600 END")
def _(s, d):
    x = D.deliveries(s, d).withColumns({"activation": F.when(C("sequence") == 20, 900).otherwise(600), "open_backfill": F.lit(True)})
    return L.activation_boundaries(x)


@query("aud6_neutral_flag", "SELECT session_id, sequence FROM deliveries WHERE sequence % 10 = 2")
def _(s, d):
    return L.neutral_flags(D.deliveries(s, d).withColumn("checkpoint_neutral", F.when(C("sequence") % 10 == 2, ~C("checkpoint_neutral")).otherwise(C("checkpoint_neutral")))).drop("chain_id")


_STATE_RULES = ["chain_invalid", "revision_missing", "acked_without_cursor", "pending_not_next", "runtime_ahead", "promise_ahead", "acked_invalid"]


@query(
    "aud7_validate_state_rows",
    f"SELECT rule, session_id AS key FROM (SELECT DISTINCT session_id, CAST(substr(session_id, 2) AS INTEGER) AS k FROM deliveries), (SELECT unnest({_STATE_RULES}) AS rule, unnest(range(0, 7)) AS slot) WHERE slot = k UNION ALL SELECT 'pending_not_next', 's6' UNION ALL SELECT unnest(['cursor_without_ack', 'runtime_without_ack', 'pending_not_next']), 's7'",
)
def _(s, d):
    """Each session's row breaks a rule of its own; the last ones, where the ack is wrong, several."""
    k = C("session_id")
    st = L.session_state(D.deliveries(s, d), D.acks(s, d))
    none = lambda c, of: F.when(k != of, C(c)).alias(c)
    bad = st.select(
        "session_id", F.when(k == "s0", 0).otherwise(C("chain_id")).alias("chain_id"), none("revision", "s1"), F.when(k == "s6", 0).when(k != "s7", C("acked")).alias("acked"), none("acked_next", "s2"),
        F.when(k == "s4", C("acked_next")).otherwise(C("runtime_head")).alias("runtime_head"), F.when(k == "s3", C("pending") + 3).otherwise(C("pending")).alias("pending"), F.when(k == "s5", C("acked_next") + 2).alias("promised"),
    )
    return L.validate_state_rows(bad)


@query(
    "aud4_reorg_geometry",
    """SELECT rule, session_id || ':' || sequence AS key FROM (SELECT *, lag(head_number) OVER w AS p_head FROM deliveries WINDOW w AS (PARTITION BY session_id ORDER BY sequence)),
  (SELECT unnest(['reorg_old_tip', 'reorg_tips_below_ancestor', 'reorg_cursor']) AS rule, unnest([0, 1, 2]) AS slot) WHERE payload_kind = 'reorg' AND page_id % 4 = slot OR payload_kind = 'reorg' AND p_head IS NULL AND rule = 'reorg_old_tip'""",
)
def _(s, d):
    """Reorgs of the acknowledged head to its page's tip: of every four pages three break a rule each."""
    from pyspark.sql import Window

    w = Window.partitionBy("session_id", "chain_id").orderBy("sequence")
    x = D.deliveries(s, d).withColumns({"p_head": F.lag("head_number").over(w), "p_hash": F.lag("head_hash").over(w)}).where("payload_kind = 'reorg'")
    k, tip = C("page_id") % 4, F.coalesce(C("p_head"), C("new_tip"))
    old = F.greatest(tip, C("head_number") + 1)  # the acknowledged head is the page before's tip: it stands for the stale tip
    r = x.withColumns({"ancestor": C("head_number"), "old_tip": old, "p_head": F.when(C("p_head").isNotNull(), old)})
    r = r.withColumns({"old_tip_hash": F.when(k == 0, F.lit("zz")).otherwise(C("p_hash")), "new_tip": F.when(k == 1, C("ancestor")).otherwise(C("new_tip")), "next_block": C("next_block") + F.when(k == 2, 1).otherwise(0)})
    return L.reorg_geometry(r)


@query("aud12_jn10_resume_positions", _with(_STATE, "SELECT session_id, sequence, verdict FROM (SELECT session_id, acked AS sequence, 'confirmed' AS verdict FROM state UNION ALL SELECT session_id, 0, 'discovery' FROM state UNION ALL SELECT session_id, pending, 'confirmed' FROM state UNION ALL SELECT session_id, 3, 'rejected' FROM state)"))
def _(s, d):
    st = L.session_state(D.deliveries(s, d), D.acks(s, d))
    none = F.lit(None).cast("string")
    h = lambda q, t: st.select("session_id", "chain_id", q.cast("long").alias("sequence"), t.alias("token"))
    hellos = h(C("acked"), none).unionByName(h(F.lit(0), none)).unionByName(h(C("pending"), L.token("pending"))).unionByName(h(F.lit(3), L.token(F.lit(3))))
    return L.resume_positions(hellos, st).drop("chain_id")


_PROMISES = """sent AS (SELECT session_id, sequence, page_id, CASE WHEN payload_kind = 'data' AND page_id % 4 = 2 THEN 'reorg' WHEN payload_kind = 'data' AND page_id % 8 = 3 THEN 'barrier' ELSE payload_kind END AS kind,
  CASE WHEN payload_kind = 'reorg' AND page_id % 4 = 1 THEN 'zz' WHEN payload_kind = 'data' AND page_id % 4 = 2 THEN head_hash ELSE new_tip_hash END AS promised, head_number, head_hash FROM deliveries),
promise AS (SELECT *, max(CASE WHEN kind = 'reorg' THEN sequence END) OVER w AS promised_at FROM sent WINDOW w AS (PARTITION BY session_id ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
judged AS (SELECT x.*, x.kind = 'data' AND p.promised = x.head_hash AS kept FROM promise x JOIN sent p ON p.session_id = x.session_id AND p.sequence = x.promised_at)"""


@query(
    "str3_str4_reorg_promises",
    _with(
        _PROMISES,
        """SELECT session_id, sequence, promised_at, CASE WHEN kept THEN 'kept' WHEN kind = 'data' THEN 'not_certified' WHEN kind = 'reorg' THEN 'second_reorg' ELSE 'waiting' END AS verdict FROM judged j
WHERE NOT EXISTS (SELECT 1 FROM judged k WHERE k.session_id = j.session_id AND k.promised_at = j.promised_at AND k.sequence < j.sequence AND k.kept)""",
    ),
)
def _(s, d):
    """Of every four pages one keeps its promise, one has another tip, one sends a second reorg, one sends a barrier or keeps it."""
    data, page = C("payload_kind") == "data", C("page_id")
    kind = F.when(data & (page % 4 == 2), "reorg").when(data & (page % 8 == 3), "barrier").otherwise(C("payload_kind"))
    tip = F.when((C("payload_kind") == "reorg") & (page % 4 == 1), F.lit("zz")).when(data & (page % 4 == 2), C("head_hash")).otherwise(C("new_tip_hash"))
    sent = D.deliveries(s, d).withColumns({"payload_kind": kind, "new_tip_hash": tip, "new_tip": F.coalesce("new_tip", "head_number")})
    rows = D.blocks(s, d).withColumn("page_id", F.floor(C("number") / PAGE_BLOCKS))
    return L.reorg_promises(sent, rows).drop("chain_id")


@query("jn11_audience_known", "SELECT block_number, log_index, o AS owner_id FROM (SELECT block_number, log_index, unnest(string_split(owners, ',')) AS o FROM audience WHERE owners <> '') WHERE o IN ('pool', 'user1')")
def _(s, d):
    a = R.route_logs(D.logs(s, d), D.interests(s, d), D.owners(s, d), ACTIVATION)
    return H.audience_known(a, D.owners(s, d).where("owner_id not in ('pool', 'user1')")).select("block_number", "log_index", "owner_id")


_RECORDS = """bad1 AS (SELECT *, CASE WHEN kind = 1 THEN CAST(data AS BIGINT) % 60 ELSE -1 END AS k, CASE WHEN kind <> 1 THEN number % 60 ELSE -1 END AS b FROM ordered),
bad AS (SELECT number // 50 AS page_id, number, CASE WHEN k = 14 THEN 9 ELSE kind END AS kind, CASE WHEN k = 7 THEN transaction_index + 1000 ELSE transaction_index END AS transaction_index, log_index,
  CASE WHEN k = 1 THEN true WHEN k IN (2, 3, 4) THEN false ELSE canonical END AS canonical,
  CASE WHEN k IN (1, 4) THEN ['nobody'] WHEN k = 2 THEN [] WHEN k = 3 THEN ['pool', 'pool'] WHEN owners = '' THEN [] ELSE string_split(owners, ',') END AS owners,
  CASE WHEN k = 0 THEN 'NOPE' WHEN kind = 2 AND b = 9 THEN 'OWNER_CATCHUP' ELSE scope END AS scope, CASE WHEN kind = 0 AND b = 11 THEN 'zz' ELSE block_hash END AS block_hash, block_timestamp, transaction_hash,
  k IN (5, 6) AS shapeless, CASE WHEN k = 13 THEN ordinal * 2 + 5 ELSE ordinal * 2 END AS ordinal, k = 8 OR kind = 2 AND b = 10 OR kind = 0 AND b = 12 AS again FROM bad1),
rec AS (SELECT * FROM bad UNION ALL SELECT * REPLACE (ordinal + 1 AS ordinal) FROM bad WHERE again)"""


@query(
    "aud3_validate_records",
    _with(
        _RECORDS,
        """SELECT rule, count(*) AS n FROM (SELECT 'scope_unknown' AS rule FROM rec WHERE scope = 'NOPE' UNION ALL SELECT 'broadcast_names_owners' FROM rec WHERE canonical AND len(owners) > 0
UNION ALL SELECT 'owner_audience_empty' FROM rec WHERE NOT canonical AND len(owners) = 0 UNION ALL SELECT 'owner_repeated' FROM rec WHERE len(owners) <> len(list_distinct(owners))
UNION ALL SELECT 'catchup_broadcast' FROM rec WHERE scope = 'OWNER_CATCHUP' AND canonical UNION ALL SELECT 'catchup_progress' FROM rec WHERE scope = 'OWNER_CATCHUP' AND kind = 2
UNION ALL SELECT 'event_missing' FROM rec WHERE kind = 9 UNION ALL SELECT 'log_shape' FROM rec WHERE kind = 1 AND shapeless UNION ALL SELECT 'header_mismatch' FROM rec WHERE kind = 0 AND block_hash = 'zz'
UNION ALL SELECT 'owner_unknown' FROM (SELECT unnest(list_distinct(owners)) AS o FROM rec) WHERE o NOT IN (SELECT owner_id FROM owners)
UNION ALL SELECT 'event_order' FROM (SELECT lag((number, kind, transaction_index, log_index)) OVER (PARTITION BY page_id ORDER BY ordinal) > (number, kind, transaction_index, log_index) AS bent FROM rec) WHERE bent
UNION ALL SELECT 'duplicate_log' FROM (SELECT 1 FROM rec WHERE kind = 1 GROUP BY block_hash, log_index HAVING count(*) > 1)
UNION ALL SELECT 'transaction_identity' FROM (SELECT 1 FROM rec WHERE kind = 1 GROUP BY block_hash, transaction_hash HAVING count(DISTINCT transaction_index) > 1 UNION ALL SELECT 1 FROM rec WHERE kind = 1 GROUP BY block_hash, transaction_index HAVING count(DISTINCT transaction_hash) > 1)
UNION ALL SELECT 'duplicate_header' FROM (SELECT 1 FROM rec WHERE kind = 0 GROUP BY page_id, number HAVING count(*) > 1) UNION ALL SELECT 'duplicate_progress' FROM (SELECT 1 FROM rec WHERE kind = 2 GROUP BY page_id, number HAVING count(*) > 1)
UNION ALL SELECT 'block_identity' FROM (SELECT 1 FROM rec WHERE kind IN (0, 2) GROUP BY page_id, number HAVING count(DISTINCT (block_hash, block_timestamp)) > 1)
UNION ALL SELECT 'missing_certificate' FROM (SELECT max(number) FILTER (WHERE kind = 2) AS p, max(number) FILTER (WHERE canonical AND kind <> 2) AS c FROM rec GROUP BY page_id) WHERE c IS NOT NULL AND coalesce(p, -1) < c) GROUP BY rule""",
    ),
)
def _(s, d):
    """The event table with each rule broken somewhere, and some records twice."""
    kind = C("kind")
    k = F.when(kind == R.LOG, C("data").cast("long") % 60).otherwise(-1)
    b = F.when(kind != R.LOG, C("number") % 60).otherwise(-1)
    n = _normal(s, d).withColumns({"k": k, "b": b})
    k, b = C("k"), C("b")
    names = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    n = n.withColumns({
        "again": (k == 8) | ((kind == 2) & (b == 10)) | ((kind == 0) & (b == 12)),
        "transaction_index": F.when(k == 7, C("transaction_index") + 1000).otherwise(C("transaction_index")),
        "canonical": F.when(k == 1, True).when(k.isin(2, 3, 4), False).otherwise(C("canonical")),
        "owners": F.when(k.isin(1, 4), names("nobody")).when(k == 2, names()).when(k == 3, names("pool", "pool")).otherwise(C("owners")),
        "scope": F.when(k == 0, "NOPE").when((kind == 2) & (b == 9), "OWNER_CATCHUP").otherwise(C("scope")),
        "block_hash": F.when((kind == 0) & (b == 11), "zz").otherwise(C("block_hash")),
        "address": F.when(k == 5, F.substring("address", 1, 39)).otherwise(C("address")),
        "data": F.when(k != 6, C("data")),
        "ordinal": F.when(k == 13, C("ordinal") * 2 + 5).otherwise(C("ordinal") * 2),
        "kind": F.when(k == 14, 9).otherwise(kind).cast("long"),
    })
    records = n.withColumn("ordinal", F.explode(F.when(C("again"), F.array(C("ordinal"), C("ordinal") + 1)).otherwise(F.array("ordinal"))))
    return V.validate_records(records, D.owners(s, d), D.block_hash(C("number"))).groupBy("rule").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ every rule broken somewhere

_PAYLOADS = """pay AS (SELECT session_id, sequence, page_id, CASE WHEN payload_kind <> 'data' THEN payload_kind WHEN page_id % 31 = 1 THEN 'odd' WHEN page_id % 6 = 5 THEN 'finality' WHEN page_id % 8 = 7 THEN 'barrier' ELSE 'data' END AS kind, checkpoint_neutral, head_number, payload_kind = 'data' AS was FROM deliveries)"""


@query(
    "aud3_payload_rules",
    _with(
        _PAYLOADS,
        """SELECT rule, session_id || ':' || sequence AS key FROM (SELECT *, unnest(list_filter([CASE WHEN kind = 'odd' THEN 'payload_missing' END, CASE WHEN was AND page_id % 31 = 2 THEN 'head_width' END,
  CASE WHEN kind = 'data' AND page_id % 31 = 3 OR kind = 'barrier' AND page_id % 16 = 15 THEN 'neutral_flag_wrong' END, CASE WHEN kind = 'reorg' AND page_id % 31 = 1 THEN 'reorg_part_missing' END,
  CASE WHEN kind = 'reorg' AND page_id % 31 = 2 THEN 'reorg_part_width' END, CASE WHEN kind = 'reorg' AND page_id % 31 = 3 THEN 'reorg_shape' END, CASE WHEN kind = 'finality' AND page_id % 12 = 5 THEN 'finality_kind' END,
  CASE WHEN kind = 'finality' AND page_id % 24 = 11 THEN 'finality_block_missing' END, CASE WHEN kind = 'barrier' AND page_id % 16 = 15 THEN 'empty_barrier_id' END, CASE WHEN kind = 'data' AND page_id % 31 = 4 THEN 'empty_data' END], lambda x: x IS NOT NULL)) AS rule FROM pay)""",
    ),
)
def _(s, d):
    """All deliveries, some as finality marks and barriers, with each rule of a payload broken on some pages."""
    p, was = C("page_id"), C("payload_kind") == "data"
    kind = F.when(~was, C("payload_kind")).when(p % 31 == 1, "odd").when(p % 6 == 5, "finality").when(p % 8 == 7, "barrier").otherwise("data")
    block = lambda n, branch=0: F.struct(n.alias("number"), D.block_hash(n, branch).alias("hash"), D.block_hash(n - 1, branch).alias("parent_hash"), (n * 3600 + branch).alias("timestamp"))
    x = D.deliveries(s, d).withColumns({"kind": kind, "is_reorg": C("payload_kind") == "reorg"})
    barrier, tip = C("kind") == "barrier", C("new_tip")
    start = barrier & (p < 0)
    old = block(tip, 1)
    x = x.withColumns({
        "ancestor": F.when(C("is_reorg"), block(C("head_number"))),
        "old_tip": F.when(C("is_reorg") & (p % 31 != 1), F.when(p % 31 == 2, old.withField("hash", F.lit("zz"))).otherwise(old)),
        "new_tip": F.when(C("is_reorg"), F.when(p % 31 == 3, block(tip).withField("hash", D.block_hash(tip, 1))).otherwise(block(tip))),
        "finality": F.when(p % 12 == 5, "odd").otherwise("safe"),
        "block_number": F.when((C("kind") == "finality") & (p % 24 != 11), C("head_number")),
        "barrier_id": F.when(start, F.concat(F.lit("desired-state:"), C("query_revision").cast("string"))).when(barrier, F.when(p % 16 == 15, "").otherwise(F.concat(F.lit("source-progress:1:"), p.cast("string")))),
        "checkpoint_neutral": barrier | ((C("kind") == "data") & (p % 31 == 3)),
        "head_hash": F.when(was & (p % 31 == 2), F.lit("00")).otherwise(C("head_hash")),
        "n_records": F.when(p % 31 == 4, 0).otherwise(50),
        "payload_kind": C("kind"),
    })
    return L.validate_payloads(x)


#: The rule that the sequences of each remainder break.
_BROKEN = [
    "desired_state_missing", "desired_state_of_other_row", "acked_cursor", "runtime_cursor", "runtime_ahead", "runtime_conflict", "promise_behind", "pending_not_next", "pending_of_other_row",
    "pending_cursor", "pending_token", "pending_payload", "pending_not_certifying", "second_reorg", "activation_ahead", "activation_missing", "revision_not_acknowledged",
]


@query("aud7_session_rules", f"SELECT rule, session_id || ':' || sequence AS key FROM deliveries, (SELECT unnest({_BROKEN}) AS rule, unnest(range(0, {len(_BROKEN)})) AS slot) WHERE sequence > 3 AND sequence % 23 = slot")
def _(s, d):
    """The row of each session as it stood before every delivery from the fourth on; of 23 in a row seventeen break a rule each."""
    n = C("sequence")
    k = {rule: n % 23 == slot for slot, rule in enumerate(_BROKEN)}
    pick = lambda rule, bad, good: F.when(k[rule], bad).otherwise(good)
    one, none = F.lit(1).cast("long"), F.lit(None).cast("long")
    promised = F.when(k["promise_behind"], n * 10 - 10).when(k["pending_not_certifying"] | k["second_reorg"], n * 10)
    pending = n + F.when(k["pending_not_next"], 1).otherwise(0)
    rows = D.deliveries(s, d).where("sequence > 3").select(
        "session_id", C("chain_id"), one.alias("revision"), C("session_id").alias("desired_session"), pick("desired_state_of_other_row", one + 1, one).alias("desired_chain"), pick("desired_state_missing", none, one).alias("desired_revision"),
        (n - 1).alias("acked"), pick("acked_cursor", one + 1, one).alias("acked_chain"), pick("revision_not_acknowledged", one - 1, one).alias("acked_revision"), (n * 10 - 10).alias("acked_head"),
        F.when(k["runtime_cursor"], 0).when(k["runtime_ahead"], n).when(k["runtime_conflict"], n - 1).otherwise(n - 2).alias("runtime"), one.alias("runtime_chain"), one.alias("runtime_revision"), F.lit(False).alias("runtime_same"), promised.alias("promised"),
        pending.alias("pending"), C("session_id").alias("pending_session"), pick("pending_of_other_row", one + 1, one).alias("pending_revision"), (pending + F.when(k["pending_cursor"], 1).otherwise(0)).alias("pending_cursor"),
        pick("pending_token", F.lit("ff"), F.lpad(F.lower(F.hex(pending)), 16, "0")).alias("pending_token"), F.when(k["second_reorg"], "reorg").when(~k["pending_payload"], "data").alias("pending_kind"), F.lit(False).alias("pending_activates"),
        (k["promise_behind"] | k["second_reorg"]).alias("pending_certifies"), F.when(k["activation_ahead"], n + 1).when(k["activation_missing"], n).otherwise(1).alias("activation"), n.alias("row"),
    )
    return L.validate_session_rows(rows)


@query(
    "own10_state_rules",
    """SELECT unnest(CASE j % 5 WHEN 1 THEN ['baseline_not_predecessor'] WHEN 3 THEN ['backfill_order'] WHEN 4 THEN ['baseline_width'] ELSE [] END) AS rule, 'user' || j AS key FROM (SELECT DISTINCT user_id // 3 AS j FROM ev)
UNION ALL SELECT CASE j % 3 WHEN 1 THEN 'full_block' ELSE 'unknown_block_mode' END, 'user' || j || '/head' FROM (SELECT DISTINCT user_id // 3 AS j FROM ev) WHERE j % 3 > 0
UNION ALL SELECT unnest(list_filter([CASE WHEN r % 11 = 0 THEN 'protocol_version' END, CASE WHEN r % 13 = 0 THEN 'revision_without_successor' WHEN r % 17 = 0 THEN 'revision_not_successor' END], lambda x: x IS NOT NULL)), 's' || user_id || CASE WHEN r % 13 = 0 THEN '' ELSE ':' || (r - 1) END
FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM ev)""",
)
def _(s, d):
    """Owners with retained baselines, a block interest each, and a request an event; some break a rule."""
    j = F.expr("try_cast(substring(owner_id, 5) as bigint)")
    low = C("from_block")
    hash_ = F.sha2("owner_id", 256)
    o = D.owners(s, d).where("owner_id like 'user%'").withColumn("j", j)
    o = o.withColumns({
        "to_block_excl": F.when(C("j") % 5 >= 2, F.when(C("j") % 5 == 4, C("to_block_excl")).otherwise(low)).otherwise(C("to_block_excl")),
        "baseline_number": F.when(C("j") % 5 != 3, low - F.when(C("j") % 5 == 1, 2).otherwise(1)), "baseline_hash": F.when(C("j") % 5 == 4, "ab").otherwise(hash_), "baseline_parent_hash": hash_,
    })
    own = D.interests(s, d).where("owner_id like 'user%'").withColumn("block_mode", F.lit(None).cast("string"))
    heads = own.withColumns({"interest_id": F.lit("head"), "kind": F.lit("block"), "addresses": F.array().cast("array<string>"), "block_mode": F.when(j % 3 == 0, "header").when(j % 3 == 1, "full")})
    asked = requests(s, d).where("ordinal % 4 = 0")
    r = C("new_revision")
    asked = asked.select("session_id", F.when(r % 11 == 0, 2).otherwise(1).alias("protocol_version"), F.when(r % 13 != 0, C("expected_revision")).alias("expected_revision"), (r + F.when((r % 17 == 0) & (r % 13 != 0), 1).otherwise(0)).alias("new_revision"))
    return T.validate_desired_state(o, own.unionByName(heads)).unionByName(T.validate_state_requests(asked, 1))


@query(
    "str3_reorg_then_replacement",
    """SELECT d.session_id, d.sequence, CASE WHEN d.sequence > coalesce(f.first, d.sequence) THEN 'held' ELSE 'control' END AS step, CAST(NULL AS BIGINT) AS number FROM deliveries d LEFT JOIN (SELECT session_id, min(sequence) AS first FROM deliveries WHERE payload_kind = 'reorg' AND page_id % 60 = 59 GROUP BY 1) f USING (session_id) WHERE payload_kind = 'reorg'
UNION ALL SELECT d.session_id, d.sequence, CASE WHEN d.sequence >= coalesce(f.first, d.sequence + 1) THEN 'held' ELSE 'replacement' END, b.number FROM deliveries d JOIN blocks b ON b.number > d.head_number AND b.number <= d.new_tip LEFT JOIN (SELECT session_id, min(sequence) AS first FROM deliveries WHERE payload_kind = 'reorg' AND page_id % 60 = 59 GROUP BY 1) f USING (session_id) WHERE payload_kind = 'reorg'""",
)
def _(s, d):
    """The reorgs of every session and the blocks that replace what they displaced; one control in sixty is never acknowledged."""
    x = D.deliveries(s, d).where("payload_kind = 'reorg'").select("session_id", "chain_id", "sequence", "token", "page_id", C("head_number").alias("ancestor"), "new_tip")
    blocks = D.blocks(s, d).select("number", "hash")
    sessions = x.select("session_id", "chain_id").distinct()
    per = blocks.join(F.broadcast(sessions)).select("session_id", "chain_id", "number", "hash")  # the sessions are eight
    return L.reorg_then_replacement(x, per, x.where("page_id % 60 <> 59")).select("session_id", "sequence", "step", "number")
