"""Segmented scans against the window forms and plain loops, with many small segments."""

import random

import pytest
from pyspark.sql import functions as F

from eventlake.operators import canonical as K
from eventlake.operators import delivery as L
from eventlake.operators import scans
from eventlake.operators import topology as T


def chain_rows(seed, n, chains=2):
    """Arrivals of chains that branch off up to far below their tip."""
    rng, rows = random.Random(seed), []
    for c in range(chains):
        number = 0
        for k in range(n):
            number = max(0, number - rng.randrange(1, 60)) if rng.random() < 0.05 else number + 1
            rows.append((c, 2 * k, number, f"{c}:{k}", "", number))
    return rows


@pytest.mark.parametrize("size", [7, 64, 10**6])
def test_segments_of_a_chain_give_the_window_forms(spark, size):
    a = spark.createDataFrame(chain_rows(1, 900), "chain_id bigint, arrival bigint, number bigint, hash string, parent_hash string, timestamp bigint")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(K.canonical_chain_segmented(a, ["chain_id"], size)) == rows(K.canonical_chain(a, ["chain_id"]))
    names = ["chain_id", "arrival", "ancestor", "old_tip", "old_tip_hash", "new_tip"]
    assert rows(K.reorg_events_segmented(a, ["chain_id"], size).select(*names)) == rows(K.reorg_events(a, ["chain_id"]).select(*names))


def test_one_chain_of_a_million_arrivals_over_many_tasks(spark):
    n = F.col("id")
    number = n - (n % 1000 >= 990).cast("long") * 15 - F.floor(n / 100_000) * 50
    a = spark.range(1_000_000).select(F.lit(1).cast("long").alias("chain_id"), n.alias("arrival"), number.alias("number"), n.cast("string").alias("hash"))
    seg = scans.segmented(a, "arrival", 1 << 16).groupBy("segment").count().collect()
    assert len(seg) == 16 and max(r["count"] for r in seg) < 1.3 * (1 << 16)
    got, want = K.canonical_chain_segmented(a, ["chain_id"], 1 << 16), K.canonical_chain(a, ["chain_id"])
    total = lambda df: df.agg(F.count("*"), F.sum("arrival"), F.sum("number")).first()
    assert total(got) == total(want)


def test_empty_table_and_one_row(spark):
    schema = "chain_id bigint, arrival bigint, number bigint, hash string"
    assert K.canonical_chain_segmented(spark.createDataFrame([], schema), ["chain_id"]).count() == 0
    assert K.reorg_events_segmented(spark.createDataFrame([(1, 1, 1, "a")], schema), ["chain_id"]).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_certified_heads_are_those_of_a_loop(spark, seed):
    rng, rows, want = random.Random(seed), [], []
    for g in range(3):
        held, top = None, 50
        for k in range(300):
            top += rng.randrange(3)
            head = rng.choice([None, top, top - rng.randrange(30)])
            ancestor = top - rng.randrange(40) if rng.random() < 0.15 else None
            rows.append(("s", g, k, head, ancestor))
            held = None if ancestor is not None and held is not None and held > ancestor else held
            held = head if held is None else held if head is None else max(held, head)
            want.append(held)
    df = spark.createDataFrame(rows, "session_id string, generation int, sequence bigint, head_number bigint, ancestor bigint")
    out = {(r.generation, r.sequence): r.certified for r in K.certified_heads(df, ["session_id"], 37).collect()}
    assert [out[r[1], r[2]] for r in rows] == want


def test_reorgs_above_the_certified_head_keep_it(spark):
    df = spark.createDataFrame([("s", 0, 1, 100, None), ("s", 0, 2, None, 120), ("s", 0, 3, 90, None), ("s", 0, 4, None, 99), ("s", 0, 5, 95, None), ("s", 1, 6, 10, None)], "session_id string, generation int, sequence bigint, head_number bigint, ancestor bigint")
    assert [r.certified for r in K.certified_heads(df, ["session_id"]).orderBy("sequence").collect()] == [100, 100, 100, None, 95, 10]


@pytest.mark.parametrize("size", [11, 10**6])
def test_marks_are_those_of_a_loop(spark, size):
    rng, rows, want = random.Random(4), [], []
    safe = final = None
    for k in range(500):
        coverage = 100 + k
        s = coverage - rng.randrange(-1, 20) if rng.random() < 0.4 else None
        f = coverage - rng.randrange(5, 90) if rng.random() < 0.2 else None
        a = coverage - rng.randrange(1, 30) if rng.random() < 0.1 else None
        rows.append((1, k, s, f, coverage, a))
        if a is not None and safe is not None:
            safe = min(safe, a)
        if s is not None and s <= coverage:
            safe = s if safe is None else max(safe, s)
        if f is not None:
            final = f if final is None else max(final, f)
        want.append((safe, final))
    df = spark.createDataFrame(rows, "chain_id bigint, arrival bigint, safe bigint, finalized bigint, coverage bigint, ancestor bigint")
    assert [(r.safe_head, r.finalized_head) for r in K.head_marks(df, ["chain_id"], size).orderBy("arrival").collect()] == want


def test_every_rule_of_marks(spark):
    rows = [(1, 90, 80, 100, None), (2, 101, None, 100, None), (3, None, 101, 100, None), (4, None, None, 100, 79), (5, None, 79, 100, None), (6, 60, None, 100, None), (7, None, 95, 100, None), (8, 96, None, 100, 90), (9, 94, None, 100, 93)]
    df = spark.createDataFrame([(1, *r) for r in rows], "chain_id bigint, arrival bigint, safe bigint, finalized bigint, coverage bigint, ancestor bigint")
    got = K.head_marks(df, ["chain_id"]).orderBy("arrival").collect()
    assert [r.rule for r in got] == [None, "safe_above_coverage", "finalized_above_coverage", "reorg_below_finalized", "finalized_regressed", "safe_regressed", "finalized_above_safe", "reorg_below_finalized", "reorg_below_finalized"]
    assert [r.safe_head for r in got] == [90, 90, 90, 79, 79, 79, 79, 96, 94]


@pytest.mark.parametrize("size", [13, 10**6])
def test_acks_are_those_of_the_fold(spark, size):
    rng = random.Random(2)
    sent = [(s, 1, k, f"t{k}") for s in ("a", "b", "c") for k in range(1, 121)]
    acks = []
    for s in ("a", "b", "c"):
        order = [k + rng.choice([0] * 9 + [1, -1, 3]) for k in range(1, 111) for _ in range(rng.choice([1, 1, 2, 3]))]
        order = order if s != "c" else [k for k in order if k != 60]
        acks += [(s, 1, n, k, rng.choice([f"t{k}"] * 9 + ["xx"])) for n, k in enumerate(order)]
    acks += [("a", 1, 10**6 + n, 5, "t5") for n in range(50)]
    d = spark.createDataFrame(sent, "session_id string, chain_id bigint, sequence bigint, token string")
    a = spark.createDataFrame(acks, "session_id string, chain_id bigint, ordinal bigint, sequence bigint, token string")
    rows = lambda df: sorted(map(tuple, df.select("session_id", "ordinal", "sequence", "outcome").collect()))
    got = rows(L.classify_acks_segmented(d, a, size))
    assert got == rows(L.classify_acks(d, a))
    assert {r[3] for r in got} == {"committed", "duplicate", "mismatch", "none_pending"} - ({"none_pending"} if all(1 <= x[3] <= 120 for x in acks) else set())


@pytest.mark.parametrize("size", [9, 10**6])
def test_requests_are_those_of_the_fold(spark, size):
    rng, rows = random.Random(5), []
    for s in ("a", "b"):
        at = 0
        for k in range(150):
            kind = rng.random()
            expected = at + rng.choice([1, -1, 2]) if kind < 0.2 else at
            new = expected + (1 if rng.random() < 0.9 else 2)
            rows.append((s, k, expected, new, f"d{new}" if rng.random() < 0.9 else "x"))
            at += (expected, new) == (at, at + 1)
            if kind > 0.8:
                rows.append((s, k, at - 1, at, f"d{at}"))
    rows = [(s, n, e, r, d) for n, (s, _, e, r, d) in enumerate(rows)] + [("c", 0, -1, 0, ""), ("c", 1, 0, 1, "d1"), ("c", 2, -1, 0, "")]
    df = spark.createDataFrame(rows, "session_id string, ordinal bigint, expected_revision bigint, new_revision bigint, digest string")
    got, want = (sorted(map(tuple, f.collect())) for f in (T.apply_desired_state_segmented(df, size), T.apply_desired_state(df)))
    assert got == want and {r[4] for r in got} == {"applied", "duplicate", "conflict"}
