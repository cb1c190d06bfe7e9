"""What a step holds or sends, on hand-made rows: no side of a growing join is broadcast, no task takes a whole chain."""

import pytest
from pyspark.sql import functions as F

from eventlake.operators import canonical as K
from eventlake.operators import hybrid as H
from eventlake.plans.queries import QUERIES


@pytest.fixture
def generous(spark):
    """A session whose estimates let Spark broadcast anything."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, str(1 << 30))
    yield spark
    spark.conf.set(name, before)


def joins(df):
    """The build or merge of each join of the plan, before it is run."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [line.strip(" :+-") for line in lines if "Join" in line]


def test_paired_sources_are_merged(generous):
    rows = generous.range(100).selectExpr("id % 2 chain_id", "id number", "cast(id as string) hash", "id + 3 seen", "2L took")
    pairs = H.pair_arrivals(rows, rows.withColumn("seen", F.col("number")), ["chain_id"])
    assert all(j.startswith("SortMergeJoin") for j in joins(pairs) if "hash" in j) and any("hash" in j for j in joins(pairs))
    assert {(r["delta"], r["n"]) for r in pairs.groupBy("delta").agg(F.count("*").alias("n")).collect()} == {(3, 98)}


def test_a_chain_and_what_was_observed_are_merged(generous):
    rows = generous.range(100).selectExpr("id % 2 chain_id", "id number", "cast(id as string) hash", "'p' parent_hash", "id timestamp")
    seen = rows.withColumn("hash", F.when(F.col("number") < 60, F.col("hash")).otherwise("zz"))
    found = K.common_ancestor(rows, seen, ["chain_id"])
    assert [j.split()[0] for j in joins(found)] == ["SortMergeJoin"]
    assert sorted(map(tuple, found.collect())) == [(0, 58, 0), (1, 59, 0)]


def heights(spark, n=400):
    """Arrivals of one chain with reorgs of one to three heights, over more than one bucket: (rows, ancestor, old tip and hash of each reorg)."""
    rows, at, tip = [], 0, None
    for k in range(n):
        number = (1 << 13) - n // 2 + k
        for branch in range(3 if k % 50 == 40 else 1):  # heights 40 to 42 of fifty come again
            for back in range(3) if branch else (0,):
                at += 1
                rows.append((1, at, number + back, f"{number + back}-{branch}", f"{number + back - 1}-x", number))
    return spark.createDataFrame(rows, "chain_id bigint, arrival bigint, number bigint, hash string, parent_hash string, timestamp bigint")


def test_survivors_and_blocks_of_reorgs_are_those_of_the_plain_forms(spark):
    a = heights(spark)
    chain = ["chain_id"]
    marked = K.surviving(K.by_height(a, 3), chain)
    want = sorted(map(tuple, K.canonical_chain(a, chain).collect()))
    assert sorted(map(tuple, marked.where("survives").select(*a.columns).collect())) == want and 0 < len(want) < a.count()
    reorgs = K.reorg_events(a, chain)
    rows, kept = a.collect(), {r[2]: tuple(r[2:]) for r in want}
    expected = []
    for r in reorgs.collect():
        old = [tuple(x[2:]) for x in rows if (x.number, x.hash) == (r.old_tip, r.old_tip_hash)]
        if r.ancestor in kept and r.ancestor + 1 in kept and old:
            expected.append((r.arrival, kept[r.ancestor], max(old), kept[r.ancestor + 1]))
    got = K.reorg_blocks(reorgs, marked, chain, 3).collect()
    assert sorted((r.arrival, tuple(r.anc), tuple(r.old), tuple(r.new)) for r in got) == sorted(expected) and expected


def merged(df):
    return [j for j in joins(df) if j.startswith(("SortMergeJoin", "ShuffledHashJoin"))]


def test_blocks_of_reorgs_are_found_where_the_chains_are(spark):
    assert not merged(QUERIES["fn10_reorg_shape"](spark, "/root/testdata/sf0.001"))  # a join would shuffle all chains by its keys


def test_a_common_ancestor_is_found_where_the_chains_are(spark):
    assert not merged(QUERIES["jn5_common_ancestor"](spark, "/root/testdata/sf0.001"))
    block = "chain_id bigint, number bigint, hash string, parent_hash string, timestamp bigint"
    one = [(1, 1, "a", "p", 1), (1, 2, "b", None, 1), (1, 2, "b", "p", 1), (1, 3, None, "p", 1), (1, None, "n", "p", 1), (2, 9000, "a", "p", 1), (3, 5, "a", "p", 1), (None, 5, "a", "p", 1)]
    two = [(1, 1, "a", "p", 1), (1, 1, "a", "q", None), (1, 2, "b", None, 1), (1, 2, "b", "p", 2), (1, 3, None, "p", 1), (1, None, "n", "p", 1), (2, 9000, "z", "p", 1), (4, 5, "a", "p", 1), (None, 5, "a", "p", 1)]
    one, two = spark.createDataFrame(one, block), spark.createDataFrame(two, block)
    want = sorted(map(tuple, K.common_ancestor(one, two, ["chain_id"]).collect()))
    got = K.common_ancestor_by_height(K.by_height(one, 3), K.by_height(two, 3), ["chain_id"])
    assert sorted(map(tuple, got.collect())) == want == [(1, 2, 4), (2, None, 0)]


def test_reorgs_and_deliveries_of_a_full_journal_look_at_what_they_change_only():
    import time

    from eventlake.streaming.journal import Journal

    row = {"kind": "record", "owners": ["a"], "digest": "d", "removed": False, "ancestor": None}
    journal, n = Journal(1 << 16, 1 << 20), 30_000
    for k in range(n):
        journal.apply(row | {"delivery": 0, "identity": str(k), "block_number": k})
    begin = time.process_time()
    for k in range(n):
        journal.apply(row | {"kind": "reorg", "delivery": k, "ancestor": n - 1 - k // 2})
    assert len(journal.entries) == n - 1 - (n - 1) // 2 + 1
    assert time.process_time() - begin < 5  # looking at each entry takes a minute


def test_any_number_of_filters_with_addresses(spark):
    from eventlake.operators import scan as S
    from eventlake.operators.routing import MAX_FILTERS

    topics = "cast(array() as array<array<string>>) topics"
    interests = spark.range(MAX_FILTERS + 2).selectExpr("'log' kind", "array(cast(id as string)) addresses", topics)
    logs = spark.range(5).selectExpr("id block_number", "array('t') topics", f"cast(id + {MAX_FILTERS} as string) address")
    assert S.scan_logs(logs, interests, 0).count() == 2
    free = spark.range(MAX_FILTERS + 2).selectExpr("'log' kind", "cast(array() as array<string>) addresses", "array(array(cast(id as string))) topics")
    with pytest.raises(ValueError):
        S.scan_logs(logs, free, 0)


def test_activity_of_owners_is_counted_by_keys(spark):
    from eventlake.operators import routing as R

    blocks = spark.range(3, 300).select(F.col("id").alias("number"))
    spans = [("", True, 20, 25), ("a", False, 0, 7), ("b", False, 290, None), ("c", False, None, None), ("d", False, 7, 7), ("a", False, 22, 40)]
    owners = spark.createDataFrame(spans, "owner_id string, canonical boolean, from_block bigint, to_block_excl bigint")
    active = lambda n, low, high: n >= 100 or 20 <= n < 25 or (low is not None and low <= n and (high is None or n < high))
    want = {}
    for owner, _, low, high in spans:
        for n in (n for n in range(3, 300) if active(n, low, high)):
            count, first = want.get(owner, (0, n))
            want[owner] = (count + 1, min(first, n))
    got = R.active_blocks(blocks, owners, 100)
    assert {r["owner_id"]: (r["n_blocks"], r["first_block"]) for r in got.collect()} == want
    # Only one-row sides are nested; before, each owner met each block.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "number" not in "".join(line for line in plan.splitlines() if "Join" in line)


def test_rows_of_a_micro_batch_are_python_objects_a_few_at_a_time():
    import pandas as pd

    from eventlake.streaming import cutover as U

    names = [c.split()[0] for c in U.INPUT.split(", ")]
    kinds = ["ack", "record", "head"]
    rows = [(1, k * 7919 % 1000, "live", kinds[k % 3], f"i{k}", None if k % 5 == 0 else k, "h", "d", k % 2 == 0, None, 3, None) for k in range(3 * U.CHUNK)]
    parts = [pd.DataFrame(rows[k :: 4], columns=names) for k in range(4)]
    got = list(U.in_order(parts))
    assert sorted(tuple(r[c] for c in names) for r in got if r["block_number"]) == sorted(r for r in rows if r[5])
    at = [(r["arrival"], U._ORDER[r["kind"]]) for r in got]
    assert at == sorted(at) and all(type(r["arrival"]) is int for r in got[:9])


def test_small_keys_stream_through_tasks_and_large_ones_are_cut(spark):
    from eventlake.operators import scans

    a = spark.range(4000).selectExpr("id % 400 chain_id", "-id arrival", "id number").unionAll(spark.range(300).selectExpr("-1L", "-id", "id"))
    want = a.groupBy("chain_id").agg(F.count("*").alias("n"))
    small = scans.scan(a.where("chain_id >= 0"), ["chain_id"], ["arrival"], scans.Surviving(), 50)
    assert "Pandas" not in small._jdf.queryExecution().executedPlan().toString()  # no group, and no call, a key
    got = scans.scan(a, ["chain_id"], ["arrival"], scans.Surviving(), 50)
    assert sorted(map(tuple, got.groupBy("chain_id").agg(F.count("*")).collect())) == sorted(map(tuple, want.collect()))
    assert got.where("survives").count() == 4300  # numbers fall along the order


@pytest.mark.parametrize("size", [2, 7, 50])
def test_windows_of_a_chain_run_by_segment(spark, size):
    from test_scans import chain_rows

    a = spark.createDataFrame(chain_rows(3, 300), "chain_id bigint, arrival bigint, number bigint, hash string, parent_hash string, timestamp bigint")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(K.canonical_chain(a, ["chain_id"], size)) == rows(K.canonical_chain(a, ["chain_id"]))
    assert rows(K.reorg_events(a, ["chain_id"], size)) == rows(K.reorg_events(a, ["chain_id"]))


def test_the_tracker_takes_chains_by_runs_and_keeps_one_of_them(spark, tmp_path, monkeypatch):
    import os

    from eventlake.plans import queries as Q
    from eventlake.plans import stream_queries as SQ

    monkeypatch.setattr(SQ, "shared_path", lambda s, tag: f"{tmp_path}/{tag}")
    monkeypatch.setattr(SQ, "RUN_ROWS", 1 << 10)
    sf = "/root/testdata/sf0.001"
    got = Q.QUERIES["str2_track_canonical"](spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, Q.QUERIES["win10_canonical_chain"](spark, sf).collect()))
    one = SQ.D.block_arrivals(spark, sf).count()
    assert spark.read.parquet(f"{tmp_path}/arrivals/in").count() == one  # not those of eight chains
    assert len([f for f in os.listdir(f"{tmp_path}/arrivals/state/offsets") if f.isdigit()]) == -(-8 * one // (1 << 10)) > 4


def test_the_tasks_of_chains_are_many_whatever_the_session_says(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    n = F.col("id")
    a = spark.range(4000).select((n % 2).alias("chain_id"), n.alias("arrival"), (n - F.when(n % 100 > 90, 30).otherwise(0)).alias("number"), n.cast("string").alias("hash"))
    spark.conf.set(name, "1")
    try:
        rows = lambda df: df.rdd.glom().map(len).collect()
        kept = rows(K.canonical_chain(a, ["chain_id"], 100))
        assert len(kept) == 40 and max(kept) < sum(kept) / 4
        assert len(rows(K.reorg_events(a, ["chain_id"], 100))) == 40
        top = K.retain_depth(K.canonical_chain(a, ["chain_id"], 100), 64, ["chain_id"])
        assert len(rows(top)) == 40 and not any("SortMergeJoin" in j for j in joins(top))
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("depth", [0, 7, 60])
def test_a_bounded_chain_shuffles_each_arrival_once(spark, depth):
    from test_scans import chain_rows

    rows = chain_rows(6, 700) + [(0, 5001, None, "none", "", 0), (0, None, 3, "late", "", 3)]
    a = spark.createDataFrame(rows, "chain_id bigint, arrival bigint, number bigint, hash string, parent_hash string, timestamp bigint")
    later = lambda r, x: None not in (r[1], x[1], r[2], x[2]) and x[0] == r[0] and x[1] > r[1] and r[2] - depth <= x[2] <= r[2]
    want = [r for r in rows if not any(later(r, x) for x in rows)]
    got = K.canonical_chain_bounded(a, ["chain_id"], depth, 100)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert not joins(got) and len(got.rdd.glom().collect()) == 15


def test_displaced_rows_are_dealt_by_their_number(spark):
    from test_scans import chain_rows

    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    rows = chain_rows(8, 700)
    a = spark.createDataFrame(rows, "chain_id bigint, arrival bigint, number bigint, hash string, parent_hash string, timestamp bigint")
    reorgs = [tuple(r) for r in K.reorg_events(a, ["chain_id"]).select("chain_id", "arrival", "ancestor", "old_tip").collect()]
    want = [r for r in rows if any(c == r[0] and low < r[2] <= high and r[1] < at for c, at, low, high in reorgs)]
    spark.conf.set(name, "1")
    try:
        given = spark.createDataFrame(reorgs, "chain_id bigint, arrival bigint, ancestor bigint, old_tip bigint")
        got = K.displaced(a, given, ["chain_id"], size=100).select(a.columns)
        assert sorted(map(tuple, got.collect())) == sorted(want) and want
        assert len(got.rdd.glom().collect()) == 14
    finally:
        spark.conf.set(name, before)


def test_a_log_of_deliveries_and_what_comes_are_merged(generous):
    from eventlake.operators import delivery as L

    rows = generous.range(40).selectExpr("concat('s', id % 2) session_id", "1L chain_id", "id sequence", "cast(id % 5 as string) digest")
    new, bad = L.new_deliveries(rows.where("sequence < 30"), rows.withColumn("digest", F.when(F.col("sequence") == 7, "x").otherwise(F.col("digest"))))
    assert all(j.startswith("SortMergeJoin") for df in (new, bad) for j in joins(df))
    assert new.count() == 10 and [r["sequence"] for r in bad.collect()] == [7]


def test_records_are_shuffled_once_for_all_windows_of_their_journal(spark):
    from eventlake.streaming.journal import Journal

    rows = [{"block_hash": f"b{k % 50}", "transaction_hash": f"t{k % 100}", "log_index": 0, "block_number": k % 50, "owners": ["a", f"o{k % 3}", "a"], "arrival": 10 * k, "removed": k % 9 == 0, "digest": "y" if k % 7 == 0 else "x"} for k in range(400)]
    records = spark.createDataFrame(rows, "block_hash string, transaction_hash string, log_index bigint, block_number bigint, owners array<string>, arrival bigint, removed boolean, digest string")
    reorgs, generations = [(20, 10**6, 1005), (3, 10**6, 2005)], [("a", 1505, 1), ("o1", 2505, 2)]
    args = spark.createDataFrame(reorgs, "ancestor bigint, old_tip bigint, arrival bigint"), spark.createDataFrame(generations, "owner_id string, arrival bigint, generation bigint")
    got = H.deduplicate_generations(records, H.IDENTITY, *args, records.select("block_number"))
    exchanges = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert not any("block_hash" in line or "arrival" in line for line in exchanges)  # before, one for the epochs and four by identity
    inputs = [r | {"kind": "record", "identity": r["transaction_hash"]} for r in rows]
    inputs += [{"kind": "reorg", "ancestor": a, "arrival": at} for a, _, at in reorgs] + [{"kind": "owner", "owner_id": o, "generation": g, "arrival": at} for o, at, g in generations]
    journal, want = Journal(1 << 20, 1 << 20), []
    for r in sorted(inputs, key=lambda r: r["arrival"]):
        said = journal.apply(r | {"delivery": r["arrival"]})
        want += [(r["arrival"], *said)] if r["kind"] == "record" else []
    assert sorted((r["arrival"], r["verdict"], r["owners"]) for r in got.collect()) == want
    assert {v for _, v, _ in want} == {"delivered", "suppressed", "passed", "conflict"}


def test_logs_of_a_page_are_dealt_by_their_number_and_meet_their_blocks_narrow(spark, monkeypatch):
    from eventlake.operators import validate as V

    logs = spark.range(300).selectExpr("id div 3 block_number", "'h' || id div 3 block_hash", "id % 3 log_index", "'t' || id % 3 transaction_hash", "id % 3 transaction_index", "'a' address", "array('x') topics", "'d' data", "false removed")
    logs = logs.unionByName(logs.where("block_number = 7 and log_index = 1").withColumns({"transaction_hash": F.lit("t0"), "removed": F.lit(True)}))
    blocks = spark.range(100).selectExpr("id number", "'h' || id hash", "'h' || (id - 1) parent_hash", "id timestamp")
    monkeypatch.setattr(V, "ROWS_A_TASK", 10)
    got = V.validate_page(blocks.where("number <> 50"), logs, 0, 100)
    lines = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
    assert sum("31), REPARTITION_BY_NUM" in line for line in lines) == 2  # before, one partition for any number of logs where they compress well
    rows = {(r["rule"], r["key"]) for r in got.collect()}
    assert {r for r in rows if r[0] in ("duplicate_log", "log_removed", "log_without_block", "hash_with_two_indexes", "index_with_two_hashes", "log_block_hash")} == {
        ("duplicate_log", "h7:1"), ("hash_with_two_indexes", "h7:t0"), ("index_with_two_hashes", "h7:1"), ("log_removed", "7:1"), *[("log_without_block", f"50:{k}") for k in range(3)],
    }


def test_records_are_computed_once_for_all_their_rules(spark):
    from eventlake.operators import validate as V

    of_log = ["if(kind = 1, 'x' || id % 4, null) transaction_hash", "if(kind = 1, repeat('a', 40), null) address", "cast(array() as array<string>) topics", "if(kind = 1, 'd', null) data", "if(kind = 1, false, null) removed"]
    rows = spark.range(120).selectExpr("id", "id div 12 page_id", "id % 12 ordinal", "id div 3 number", "id % 3 kind", "'CANONICAL' scope").selectExpr(
        "*", "0L transaction_index", "0L log_index", "kind <> 1 canonical", "if(kind = 1, array('o'), array()) owners", "'h' || number block_hash", "number block_timestamp", *of_log)
    again = rows.where("number = 5").withColumns({"owners": F.when(F.col("kind") == 1, F.array(F.lit("nobody"))).otherwise(F.col("owners")), "transaction_index": F.when(F.col("kind") == 1, 7).otherwise(0).cast("long"), "block_timestamp": F.col("number") + 1})
    owners = spark.createDataFrame([("o",)], "owner_id string")
    got = V.validate_records(rows.unionByName(again), owners, F.when(F.col("number") == 9, "zz").otherwise(F.col("block_hash")))
    assert "Range" not in got._jdf.queryExecution().executedPlan().toString()  # before, the source was read for each of the rules' keys
    counts = {r["rule"]: r["n"] for r in got.where("rule not in ('event_order', 'log_shape')").groupBy("rule").agg(F.count("*").alias("n")).collect()}
    assert counts == {"owner_unknown": 1, "duplicate_log": 1, "transaction_identity": 1, "duplicate_header": 1, "duplicate_progress": 1, "block_identity": 1, "header_mismatch": 1}
