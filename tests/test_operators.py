"""Operators on hand-made rows: errors, edge cases and the streaming forms."""

import pytest
from pyspark.sql import functions as F

from eventlake.operators import canonical as K
from eventlake.operators import delivery as L
from eventlake.operators import hybrid as H
from eventlake.operators import scan as S
from eventlake.operators import topology as T
from eventlake.operators import validate as V
from eventlake.plans import queries as Q
from eventlake.sources.providers import LiveSource, PageSource
from eventlake.streaming.tracker import step


def blocks(spark, rows):
    return spark.createDataFrame(rows, "chain_id bigint, arrival bigint, number bigint, hash string, parent_hash string, timestamp bigint")


TRIPLE = [(1, 0, 100, "10", "0f", 1), (1, 1, 101, "11", "10", 2), (1, 2, 102, "12", "11", 3), (1, 3, 102, "22", "11", 4), (1, 4, 103, "23", "22", 5)]


def test_empty_range_is_an_error(spark):
    with pytest.raises(ValueError):
        S.block_range(spark.range(3).toDF("number"), "number", 5, 5)


def test_reorg_triple(spark):
    r = K.reorg_events(blocks(spark, TRIPLE), ["chain_id"]).collect()
    assert [(x.ancestor, x.old_tip, x.old_tip_hash, x.new_tip) for x in r] == [(101, 102, "12", 103)]
    kept = K.canonical_chain(blocks(spark, TRIPLE), ["chain_id"])
    assert sorted(x.hash for x in kept.collect()) == ["10", "11", "22", "23"]
    bounded = K.canonical_chain_bounded(blocks(spark, TRIPLE), ["chain_id"], 64)
    assert sorted(x.hash for x in bounded.collect()) == ["10", "11", "22", "23"]


def test_tracker_outcomes():
    chain, said = [], []
    rows = [(100, "10", "0f"), (101, "11", "10"), (102, "12", "11"), (102, "12", "11"), (104, "14", "13"), (102, "22", "11"), (103, "33", "zz"), (90, "xx", "yy"), (102, "22", "zz"), (102, "44", "zz"), (100, "55", "0f")]
    for number, hash_, parent in rows:
        chain, outcome, ancestor, tip = step(chain, {"number": number, "hash": hash_, "parent_hash": parent, "timestamp": number}, 64)
        said.append((outcome, ancestor, tip))
    assert [s[0] for s in said] == ["new", "new", "new", "duplicate", "gap", "reorg", "exhausted", "exhausted", "conflicting_metadata", "unknown_parent", "exhausted"]
    assert said[5][1:] == (101, 102)
    assert [row[1] for row in chain] == ["10", "11", "22"]
    assert step([[0, "a", "z", 1]], {"number": 0, "hash": "b", "parent_hash": "y", "timestamp": 1}, 64)[1] == "unknown_parent"


def test_only_acks_in_turn_commit(spark):
    sent = spark.createDataFrame([("s", 1, k, f"t{k}") for k in range(1, 7)], "session_id string, chain_id bigint, sequence bigint, token string")
    acks = [(1, 1, "t1"), (2, 5, "t5"), (3, 2, "t2"), (4, 6, "t6"), (5, 2, "t2"), (6, 3, "xx"), (7, 3, "t3"), (8, 9, "t9")]
    df = spark.createDataFrame([("s", 1, *a) for a in acks], "session_id string, chain_id bigint, ordinal bigint, sequence bigint, token string")
    got = {r.ordinal: r.outcome for r in L.classify_acks(sent, df).collect()}
    assert [got[k] for k in range(1, 9)] == ["committed", "mismatch", "committed", "mismatch", "duplicate", "mismatch", "committed", "none_pending"]


def test_what_follows_a_promised_tip(spark):
    sent = "session_id string, chain_id bigint, sequence bigint, payload_kind string, page_id bigint, next_block bigint, head_number bigint, head_hash string, new_tip bigint, new_tip_hash string"
    rows = [(1, "reorg", None, 102, 101, "11", 103, "23"), (2, "barrier", None, 102, None, None, None, None), (3, "data", 7, 105, 104, "24", None, None), (4, "data", 8, 106, 105, "25", None, None)]
    rows += [(5, "reorg", None, 104, 103, "23", 104, "34"), (6, "reorg", None, 104, 103, "23", 104, "44"), (7, "data", 9, 106, 105, "45", None, None), (8, "data", 10, 106, 105, "45", None, None)]
    d = spark.createDataFrame([("s", 1, *r) for r in rows], sent)
    blocks = [(7, 103, "23", "12"), (7, 104, "24", "23"), (8, 105, "25", "24"), (9, 104, "44", "23"), (9, 105, "45", "xx"), (10, 104, "44", "23"), (10, 105, "45", "44")]
    got = L.reorg_promises(d, spark.createDataFrame(blocks, "page_id bigint, number bigint, hash string, parent_hash string")).collect()
    assert sorted((r.sequence, r.promised_at, r.verdict) for r in got) == [(2, 1, "waiting"), (3, 1, "kept"), (6, 5, "second_reorg"), (7, 6, "not_certified"), (8, 6, "kept")]


def test_strict_raises(spark):
    with pytest.raises(V.Violation):
        V.strict(spark.createDataFrame([("gap", 3)], "rule string, number bigint"))
    V.strict(spark.createDataFrame([], "rule string, number bigint"))


def test_topics(spark):
    df = spark.createDataFrame([(["a", None],), ([None, "a"],), (list("abcde"),), ([],)], "topics array<string>")
    assert [r[0] for r in df.select(V.topics_problem()).collect()] == [None, "topic_after_null", "too_many_topics", None]


def test_redelivery_and_conflict(spark, tmp_path):
    row = lambda digest: spark.createDataFrame([("s", 1, 1, digest)], "session_id string, chain_id bigint, sequence bigint, digest string")
    path = str(tmp_path / "log")
    assert L.write_deliveries(row("a"), path) == 1
    assert L.write_deliveries(row("a"), path) == 0
    with pytest.raises(V.Violation):
        L.write_deliveries(row("b"), path)


def test_conflict_inside_a_batch(spark, tmp_path):
    rows = lambda *digests: spark.createDataFrame([("s", 1, k, d) for k, d in digests], "session_id string, chain_id bigint, sequence bigint, digest string")
    path = str(tmp_path / "log")
    for second in ("b", None):
        with pytest.raises(V.Violation):
            L.write_deliveries(rows((1, "a"), (1, second)), path)
    assert L.write_deliveries(rows((1, "a"), (1, "a"), (2, "a")), path) == 2
    with pytest.raises(V.Violation):
        L.write_deliveries(rows((3, "a"), (3, "b")), path)
    assert spark.read.parquet(path).count() == 2


def test_delivery_of_every_log(spark, tmp_path):
    events = spark.range(20_000).select(F.col("id").alias("event_id"), F.lit(1).cast("long").alias("user_id"), F.lit("view").alias("event_type"), F.lit('{"k": 1}').alias("props"), F.lit(1.0).alias("value"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    got = Q.QUERIES["str1_src7_deliver_stream"](spark, str(tmp_path))
    assert got.distinct().count() == got.count() == 20_000
    assert got.agg(F.max("block_number")).first()[0] == 14_443


def test_anchor_must_touch_the_backfill(spark):
    o = spark.createDataFrame([("x", False, 10, 20)], "owner_id string, canonical boolean, from_block bigint, to_block_excl bigint")
    assert T.add_owner(o, o, 9).count() == T.add_owner(o, o, 10).count() == 1
    with pytest.raises(ValueError):
        T.add_owner(o, o, 8)


def test_no_cutover_before_the_fence(spark):
    log = "block_number bigint, block_hash string, arrival bigint, removed boolean"
    live = spark.createDataFrame([(590, "a", 1, False), (591, "b", 2, False)], log)
    history = spark.createDataFrame([(580, "x", 0, False)], log)
    cut = H.fence(live, history)
    assert tuple(cut.first()) == (589, None)
    assert [r.block_number for r in H.hybrid_union(history, live, cut).collect()] == [580]


def test_page_and_live_sources(spark, tmp_path):
    spark.dataSource.register(PageSource)
    spark.dataSource.register(LiveSource)
    name = "tests.numbers_source:Numbers"
    df = spark.read.format("eventlake-pages").option("provider", name).option("page_blocks", 10).load()
    assert df.rdd.getNumPartitions() == 3 and df.agg(F.sum("number")).first()[0] == 300
    q = spark.readStream.format("eventlake-live").option("provider", name).option("page_blocks", 10).load().writeStream.format("memory").queryName("live").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        for _ in range(60):
            q.processAllAvailable()
            if spark.table("live").count() >= 25:
                break
        assert spark.table("live").agg(F.sum("number"), F.count("*")).first()[:] == (300, 25)
    finally:
        q.stop()


def test_range_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "b")
    spark.range(1000).toDF("number").write.parquet(path)
    plan = S.block_range(spark.read.parquet(path), "number", 10, 20)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(number), GreaterThanOrEqual(number,10), LessThan(number,20)]" in plan
