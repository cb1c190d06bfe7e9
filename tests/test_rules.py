"""Each rule of desired states, payloads and session rows by one row that breaks it, and clean rows that break none."""

import pytest
from pyspark.sql import functions as F

from eventlake.operators import canonical as K
from eventlake.operators import delivery as L
from eventlake.operators import topology as T

H = "ab" * 32


def broken(spark, good, schema, cases, check, tag):
    """Runs the check over the good row and, for each case, a copy with some columns changed; -> rules by case."""
    names = [c.split()[0] for c in schema.split(", ")]
    rows = [good | {tag: "good"}] + [good | change | ({} if tag in change else {tag: f"case{k}"}) for k, (_, change) in enumerate(cases)]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)
    got = sorted((r.rule, r.key) for r in check(df).collect())
    return got


PAYLOAD = "session_id string, sequence bigint, query_revision bigint, checkpoint_neutral boolean, payload_kind string, head_number bigint, head_hash string, n_records bigint, ancestor struct<number:bigint,hash:string,parent_hash:string,timestamp:bigint>, old_tip struct<number:bigint,hash:string,parent_hash:string,timestamp:bigint>, new_tip struct<number:bigint,hash:string,parent_hash:string,timestamp:bigint>, finality string, block_number bigint, barrier_id string"
A, O, N = (10, "aa" * 32, "00" * 32, 100), (12, "bb" * 32, "11" * 32, 120), (13, "cc" * 32, "22" * 32, 130)
DATA = {"session_id": "", "sequence": 1, "query_revision": 4, "checkpoint_neutral": False, "payload_kind": "data", "head_number": 9, "head_hash": H, "n_records": 2, "ancestor": None, "old_tip": None, "new_tip": None, "finality": None, "block_number": None, "barrier_id": None}
REORG = DATA | {"payload_kind": "reorg", "ancestor": A, "old_tip": O, "new_tip": N, "n_records": None}
FINAL = DATA | {"payload_kind": "finality", "finality": "safe", "block_number": 5}
BARRIER = DATA | {"payload_kind": "barrier", "barrier_id": "source-progress:4:9", "checkpoint_neutral": True, "head_number": None, "head_hash": None}


@pytest.mark.parametrize(
    "good,cases",
    [
        (DATA, [("payload_missing", {"payload_kind": None}), ("payload_missing", {"payload_kind": "odd"}), ("head_width", {"head_hash": "ab"}), ("head_width", {"head_hash": None}), ("neutral_flag_wrong", {"checkpoint_neutral": True}), ("empty_data", {"n_records": 0}), ("empty_data", {"n_records": None})]),
        (REORG, [("reorg_part_missing", {"old_tip": None}), ("reorg_part_missing", {"new_tip": (13, None, "x", 1)}), ("reorg_part_width", {"old_tip": (12, "bb", "11" * 32, 120)}), ("reorg_shape", {"new_tip": (13, "bb" * 32, "22" * 32, 130)}), ("reorg_shape", {"old_tip": (10, "bb" * 32, "11" * 32, 120)})]),
        (FINAL, [("finality_kind", {"finality": "odd"}), ("finality_kind", {"finality": None}), ("finality_block_missing", {"block_number": None})]),
        (BARRIER, [("neutral_flag_wrong", {"block_number": 7}), ("neutral_flag_wrong", {"barrier_id": "desired-state:3"}), ("neutral_flag_wrong", {"checkpoint_neutral": False})]),
        (BARRIER | {"barrier_id": "desired-state:4"}, []),
        (BARRIER | {"barrier_id": "mine", "checkpoint_neutral": False, "block_number": 3}, [("empty_barrier_id", {"barrier_id": ""}), ("empty_barrier_id", {"barrier_id": None})]),
    ],
)
def test_payload_rules(spark, good, cases):
    got = broken(spark, good, PAYLOAD, cases, L.validate_payloads, "session_id")
    assert got == sorted((rule, f"case{k}:1") for k, (rule, _) in enumerate(cases))


SESSION = "session_id string, chain_id bigint, revision bigint, desired_session string, desired_chain bigint, desired_revision bigint, acked bigint, acked_chain bigint, acked_revision bigint, acked_head bigint, runtime bigint, runtime_chain bigint, runtime_revision bigint, runtime_same boolean, promised bigint, pending bigint, pending_session string, pending_revision bigint, pending_cursor bigint, pending_token string, pending_kind string, pending_activates boolean, pending_certifies boolean, activation bigint, row string"
ROW = dict(zip([c.split()[0] for c in SESSION.split(", ")], ["s", 1, 4, "s", 1, 4, 7, 1, 4, 70, 6, 1, 4, False, None, 8, "s", 4, 8, f"{8:016x}", "data", False, False, 3, ""]))


def test_session_rules(spark):
    cases = [
        ("desired_state_missing", {"desired_revision": None}),
        ("desired_state_of_other_row", {"desired_session": "t"}),
        ("desired_state_of_other_row", {"desired_revision": 3}),
        ("acked_cursor", {"acked_chain": 2}),
        ("runtime_cursor", {"runtime": 0}),
        ("runtime_ahead", {"runtime": 8}),
        ("runtime_conflict", {"runtime": 7}),
        ("promise_behind", {"promised": 70, "pending_certifies": True}),
        ("pending_not_next", {"pending": 9, "pending_cursor": 9, "pending_token": f"{9:016x}"}),
        ("pending_of_other_row", {"pending_revision": 3}),
        ("pending_cursor", {"pending_cursor": 7}),
        ("pending_token", {"pending_token": "ff"}),
        ("pending_payload", {"pending_kind": None}),
        ("pending_not_certifying", {"promised": 75}),
        ("second_reorg", {"promised": 75, "pending_kind": "reorg", "pending_certifies": True}),
        ("activation_ahead", {"activation": 9}),
        ("activation_missing", {"activation": 8}),
        ("revision_not_acknowledged", {"acked_revision": 3}),
        ("revision_not_acknowledged", {"acked_revision": 3, "activation": 0}),
    ]
    got = broken(spark, ROW, SESSION, cases, L.validate_session_rows, "row")
    assert got == sorted((rule, f"s:case{k}") for k, (rule, _) in enumerate(cases))
    bare = dict.fromkeys(ROW) | {"session_id": "s", "chain_id": 1, "revision": 0, "activation": 0, "row": ""}
    alone = ROW | {"acked": None, "acked_chain": None, "acked_revision": None, "acked_head": None, "runtime": None, "activation": 1, "pending": 1, "pending_cursor": 1, "pending_token": f"{1:016x}", "pending_kind": "barrier", "pending_activates": True}
    for good in (bare, alone):
        assert broken(spark, good, SESSION, [], L.validate_session_rows, "row") == []
    assert broken(spark, alone, SESSION, [("", {"runtime": 1})], L.validate_session_rows, "row") == [("runtime_without_ack", "s:case0")]


def test_desired_state_rules(spark):
    owner = "owner_id string, canonical boolean, from_block bigint, to_block_excl bigint, baseline_number bigint, baseline_hash string, baseline_parent_hash string"
    interest = "owner_id string, interest_id string, kind string, addresses array<string>, topics array<array<string>>, block_mode string"
    o = spark.createDataFrame([("", True, None, None, None, None, None), ("a", False, 10, 20, 9, H, H), ("b", False, 10, 10, 9, H, H), ("c", False, 10, 10, None, None, None), ("d", False, 10, 9, 9, H, H), ("e", False, 10, 20, 8, H, H), ("f", False, 10, None, 9, "ab", H), ("g", False, None, None, 3, H, H)], owner)
    i = spark.createDataFrame([("a", "h", "block", [], [], "header"), ("a", "f", "block", [], [], "full"), ("a", "n", "block", [], [], None), ("a", "u", "block", [], [], "odd"), ("a", "l", "log", [], [], None)], interest)
    got = sorted((r.rule, r.key) for r in T.validate_desired_state(o, i).collect())
    assert got == [("backfill_order", "c"), ("backfill_order", "d"), ("baseline_not_predecessor", "e"), ("baseline_not_predecessor", "g"), ("baseline_width", "f"), ("full_block", "a/f"), ("unknown_block_mode", "a/n"), ("unknown_block_mode", "a/u")]
    most = 2**63 - 1
    r = spark.createDataFrame([("s", 1, 3, 4), ("s", 2, 4, 5), ("", 1, 5, 6), (None, 1, 6, 7), ("s", 1, most, 1), ("s", 1, None, 1), ("s", 1, 7, 9), ("s", 1, 8, None)], "session_id string, protocol_version int, expected_revision bigint, new_revision bigint")
    got = sorted((x.rule, x.key) for x in T.validate_state_requests(r, 1).collect())
    assert got == [("protocol_version", "s:4"), ("revision_not_successor", "s:7"), ("revision_not_successor", "s:8"), ("revision_without_successor", "s"), ("revision_without_successor", f"s:{most}"), ("session_missing", "6"), ("session_missing", ":5")]


def test_replacement_waits_for_its_control(spark):
    slot = "session_id string, chain_id bigint, sequence bigint, token string"
    r = spark.createDataFrame([("s", 1, 3, "t3", 100, 103), ("s", 1, 7, "t7", 101, 102), ("s", 1, 9, "t9", 90, 101), ("t", 1, 3, "t3", 100, 101)], slot + ", ancestor bigint, new_tip bigint")
    b = spark.createDataFrame([(s, 1, n, f"h{n}") for s in "st" for n in range(99, 105)], "session_id string, chain_id bigint, number bigint, hash string")
    acks = spark.createDataFrame([("s", 1, 3, "t3"), ("s", 1, 3, "t3"), ("s", 1, 7, "bad"), ("s", 1, 9, "t9")], slot)
    got = sorted((x.session_id, x.sequence, x.step, x.number or 0) for x in L.reorg_then_replacement(r, b, acks).collect())
    want = [("s", 3, "control", 0), *[("s", 3, "replacement", n) for n in (101, 102, 103)], ("s", 7, "control", 0), ("s", 7, "held", 102), ("s", 9, "held", 0), *[("s", 9, "held", n) for n in (99, 100, 101)], ("t", 3, "control", 0), ("t", 3, "held", 101)]
    assert got == sorted(want)


def test_content_hashes(spark):
    df = spark.createDataFrame([(1, "1"), (2, "x"), (3, None), (None, "4")], "number bigint, hash string")
    assert sorted(r.number or 0 for r in K.content_hash_violations(df, F.col("number").cast("string")).collect()) == [0, 2, 3]
