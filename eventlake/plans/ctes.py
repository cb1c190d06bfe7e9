"""The same derived tables as common table expressions for the SQL oracles."""



def everyone(number: str) -> str:
    """Whether the base owner's own backfill holds a block."""
    return f"({number} BETWEEN 240 AND 299)"


def covered(number: str) -> str:
    """Whether a block counts for everyone: from the activation on, or in the base owner's backfill."""
    return f"({number} >= 360 OR {everyone(number)})"


TABLES = f"""
ev AS (SELECT event_id, CAST(event_id // 18 * 13 + greatest(0, event_id % 18 - 5) AS BIGINT) AS number, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value FROM events),
blocks AS (SELECT number, sha256('b:' || number || ':0') AS hash, sha256('b:' || (number - 1) || ':0') AS parent_hash, 1704067200 + 3600 * number AS timestamp
  FROM (SELECT DISTINCT number FROM ev)),
arrivals AS (
  SELECT CAST(1 AS BIGINT) AS chain_id, number * 10 + 5 AS arrival, number, hash, parent_hash, timestamp FROM blocks
  UNION ALL SELECT 1, CASE WHEN number % 50 = 48 THEN number * 10 ELSE (number - 1) * 10 + 1 END, number, sha256('b:' || number || ':1'),
    CASE WHEN number % 50 = 48 THEN sha256('b:' || (number - 1) || ':0') ELSE sha256('b:' || (number - 1) || ':1') END, timestamp + 1 FROM blocks WHERE number % 50 >= 48),
numbered AS (SELECT *, row_number() OVER (PARTITION BY number ORDER BY event_id) - 1 AS log_index FROM ev),
logs AS (SELECT number AS block_number, sha256('b:' || number || ':0') AS block_hash, sha256('x:' || number || ':' || (log_index // 2)) AS transaction_hash, log_index // 2 AS transaction_index, log_index,
  substr(sha256('a:' || user_id), 1, 40) AS address, sha256('t0:' || event_type) AS topic0, sha256('t1:' || k) AS topic1, CAST(event_id AS VARCHAR) AS data, 1704067200 + 3600 * number AS block_timestamp, false AS removed FROM numbered),
copies AS (SELECT * REPLACE (sha256('b:' || block_number || ':1') AS block_hash) FROM logs WHERE block_number % 50 >= 48 AND CAST(data AS BIGINT) % 3 <> 0),
log_arrivals AS (
  SELECT *, block_number * 10 + 5 AS arrival FROM logs
  UNION ALL SELECT *, CASE WHEN block_number % 50 = 48 THEN block_number * 10 ELSE (block_number - 1) * 10 + 1 END FROM copies
  UNION ALL SELECT * REPLACE (true AS removed), CASE WHEN block_number % 50 = 48 THEN block_number * 10 + 4 ELSE (block_number - 1) * 10 + 4 END FROM copies),
owners AS (
  SELECT * FROM (VALUES ('', true, 240, 300), ('errors', false, NULL, NULL), ('pool', false, 100, 200), ('low', false, 300, NULL), ('heads', false, 50, 60)) t(owner_id, canonical, from_block, to_block_excl)
  UNION ALL SELECT DISTINCT 'user' || (user_id // 3), false, (user_id // 3) % 50 * 100, (user_id // 3) % 50 * 100 + 150 FROM ev),
interests AS (
  SELECT '' AS owner_id, 'base' AS interest_id, 'log' AS kind, CAST([] AS VARCHAR[]) AS addresses, [sha256('t0:purchase')] AS t0, CAST([] AS VARCHAR[]) AS t1, 1 AS width
  UNION ALL SELECT 'errors', 'all', 'log', [], [sha256('t0:error')], [], 2
  UNION ALL SELECT 'pool', 'two', 'log', [substr(sha256('a:46'), 1, 40), substr(sha256('a:8'), 1, 40), substr(sha256('a:46'), 1, 40)], [], [], 0
  UNION ALL SELECT 'low', 'k', 'log', [], [], [sha256('t1:' || i) FOR i IN range(1, 10)], 2
  UNION ALL SELECT 'heads', 'any', 'block', [], [], [], 0
  UNION ALL SELECT 'user' || (user_id // 3), 'own', 'log', list_sort(list_distinct(list(substr(sha256('a:' || user_id), 1, 40)))), [], [], 0 FROM ev GROUP BY user_id // 3),
pages AS (SELECT number // 50 AS page_id, min(number) AS from_block, max(number) + 1 AS next_block, (SELECT max(number) + 1 FROM blocks) AS archive_height, min(number) AS guard_first,
  arg_min(parent_hash, number) AS guard_first_parent, max(number) AS guard_tip, arg_max(hash, number) AS guard_tip_hash, max(timestamp) AS guard_tip_timestamp FROM blocks GROUP BY 1),
plan AS (
  SELECT page_id, 'data' AS payload_kind, next_block, guard_tip AS head_number, guard_tip_hash AS head_hash, CAST(NULL AS BIGINT) AS new_tip, CAST(NULL AS VARCHAR) AS new_tip_hash FROM pages
  UNION ALL SELECT page_id, 'reorg', next_block - 2, next_block - 3, sha256('b:' || (next_block - 3) || ':0'), guard_tip, guard_tip_hash FROM pages WHERE next_block % 50 = 0
  UNION ALL SELECT -1, 'barrier', 0, NULL, NULL, NULL, NULL FROM pages WHERE page_id = 0),
deliveries AS (SELECT 's' || s AS session_id, CAST(1 AS BIGINT) AS chain_id, row_number() OVER (PARTITION BY s ORDER BY page_id, payload_kind = 'data') AS sequence, CAST(1 AS BIGINT) AS query_revision, payload_kind, page_id,
  next_block, head_number, head_hash, new_tip, new_tip_hash, payload_kind = 'barrier' AS checkpoint_neutral,
  lpad(lower(to_hex(row_number() OVER (PARTITION BY s ORDER BY page_id, payload_kind = 'data'))), 16, '0') AS token FROM plan, range(0, 8) r(s)),
acks AS (SELECT session_id, chain_id, sequence, token FROM deliveries QUALIFY sequence < max(sequence) OVER (PARTITION BY session_id)),
matched AS (SELECT l.block_number, l.transaction_index, l.log_index, i.owner_id, o.canonical,
  {covered('l.block_number')} OR coalesce(o.from_block <= l.block_number AND (o.to_block_excl IS NULL OR l.block_number < o.to_block_excl), false) AS active
  FROM logs l JOIN interests i ON i.kind = 'log' AND (len(i.addresses) = 0 OR list_contains(i.addresses, l.address)) AND (len(i.t0) = 0 OR list_contains(i.t0, l.topic0)) AND (len(i.t1) = 0 OR list_contains(i.t1, l.topic1))
  JOIN owners o USING (owner_id)),
audience AS (SELECT block_number, transaction_index, log_index, bool_or(everyone OR canonical) AS canonical,
  CASE WHEN bool_or(everyone OR canonical) THEN '' ELSE coalesce(string_agg(DISTINCT owner_id, ',' ORDER BY owner_id), '') END AS owners FROM (SELECT *, {everyone('block_number')} AS everyone FROM matched WHERE active) GROUP BY block_number, transaction_index, log_index),
routed AS (
  SELECT number, CAST(0 AS BIGINT) AS kind, CAST(0 AS BIGINT) AS transaction_index, CAST(0 AS BIGINT) AS log_index, {everyone('number')} AS canonical, CASE WHEN {everyone('number')} THEN '' ELSE 'heads' END AS owners,
    hash AS block_hash, timestamp AS block_timestamp, CAST(NULL AS VARCHAR) AS transaction_hash, CAST(NULL AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS topics, CAST(NULL AS VARCHAR) AS data, CAST(NULL AS BOOLEAN) AS removed FROM blocks WHERE {covered('number')} OR number BETWEEN 50 AND 59
  UNION ALL SELECT block_number, 1, transaction_index, log_index, a.canonical, a.owners, l.block_hash, l.block_timestamp, l.transaction_hash, l.address, l.topic0 || ',' || l.topic1, l.data, l.removed FROM audience a JOIN logs l USING (block_number, transaction_index, log_index)
  UNION ALL SELECT number, 2, 0, 0, true, '', hash, timestamp, NULL, NULL, NULL, NULL, NULL FROM blocks WHERE {covered('number')}),
ordered AS (SELECT *, CASE WHEN {covered('number')} THEN 'CANONICAL_PROGRESS' ELSE 'OWNER_CATCHUP' END AS scope, row_number() OVER (PARTITION BY number // 50 ORDER BY number, kind, transaction_index, log_index) AS ordinal FROM routed)
"""


def oracle(query: str) -> str:
    return f"WITH {TABLES.strip()}\n{query.strip()}"
