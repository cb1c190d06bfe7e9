"""The keyed journal and the live cutover: bounds, rewinds, generations, restarts and any interleaving."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventlake.operators import canonical as K
from eventlake.operators import hybrid as H
from eventlake.plans.stream_queries import journal_rows, run_in_order
from eventlake.streaming import cutover as C
from eventlake.streaming import journal as J


def inputs(seed, n, identities, with_reorgs=True):
    """Rows of one chain in order: records of rising heights, repeats, some removals, reorgs, new generations, other payloads."""
    rng, rows, head = random.Random(seed), [], 10
    blank = dict.fromkeys([c.split()[0] for c in J.INPUT.split(", ")])
    for k in range(n):
        row = blank | {"chain_id": 1, "arrival": k, "delivery": k // 7, "kind": "record", "removed": False}
        what = rng.random()
        if with_reorgs and what < 0.04:
            row |= {"kind": "reorg", "ancestor": head - rng.randrange(1, 6)}
            head = row["ancestor"]
        elif what < 0.08:
            row |= {"kind": "owner", "owner_id": rng.choice("abc"), "generation": rng.choice([k, k, None])}
        else:
            head += rng.random() < 0.3
            i = rng.randrange(identities)
            row |= {"identity": f"i{i}", "block_number": None if i % 11 == 0 else max(0, head - i % 4), "owners": rng.sample("abcd", rng.randrange(1, 4)), "digest": rng.choice(["x"] * 30 + ["y"]), "removed": rng.random() < 0.1}
        rows.append(row)
    return rows


def plain(rows, capacity, most):
    """The journal as a list that is rebuilt after each delivery. -> verdicts, and the list after each delivery."""
    journal, generation, out, after, poisoned = [], {}, [], {}, False
    for d in sorted({r["delivery"] for r in rows}):
        own = []
        for r in (r for r in rows if r["delivery"] == d):
            if poisoned:
                out += [("poisoned", [])] if r["kind"] == "record" else []
                continue
            if r["kind"] == "reorg":
                journal = [e for e in journal if e[1] is None or e[1] <= r["ancestor"]]
            elif r["kind"] == "owner":
                generation.pop(r["owner_id"], None) if r["generation"] is None else generation.update({r["owner_id"]: r["generation"]})
            elif r["removed"]:
                out.append(("passed", sorted(r["owners"])))
            else:
                e = next((e for e in journal if e[0] == r["identity"]), None)
                if e and e[2] != r["digest"]:
                    out.append(("conflict", []))
                    continue
                fresh = [o for o in sorted(r["owners"]) if not e or e[3].get(o) != generation.get(o, 0)]
                journal = [x for x in journal if x is not e] + [(r["identity"], r["block_number"], r["digest"], (e[3] if e else {}) | {o: generation.get(o, 0) for o in fresh})]
                own = [i for i in own if i != r["identity"]] + [r["identity"]]
                mine = [e for e in journal if e[0] in own]
                poisoned = len(mine) > capacity or sum(len(e[3]) for e in mine) > most
                out.append(("poisoned", []) if poisoned else ("delivered", fresh) if fresh else ("suppressed", []))
        full = list(journal)
        while journal and (len(journal) > capacity or sum(len(e[3]) for e in journal) > most) and journal[0][0] not in own:
            journal = journal[1:]
        after[d] = full, set(own), list(journal)
    return out, after


@pytest.mark.parametrize("seed,capacity,most", [(1, 10**6, 10**6), (2, 9, 10**6), (3, 40, 25), (4, 12, 30), (5, 3, 30)])
def test_journal_is_the_plain_list(seed, capacity, most):
    rows = inputs(seed, 900, 40)
    journal, got, size = J.Journal(capacity, most), [], 0
    for r in rows:
        said = journal.apply(r)
        got += [said] if r["kind"] == "record" else []
        size = max(size, len(journal.entries))
    want, _ = plain(rows, capacity, most)
    assert got == want
    assert size <= capacity + 7 and journal.held == sum(len(e["seen"]) for e in journal.entries.values())
    assert ("poisoned" in {v for v, _ in want}) == (capacity == 3)


def test_eviction_is_that_of_the_batch_form(spark):
    """After every delivery: WIN-7 and WIN-8 over what the journal held before it evicted."""
    capacity, most = 12, 30
    _, after = plain(inputs(6, 250, 30), capacity, most)
    rows = [(d, k, e[0], len(e[3]), e[0] in own) for d, (full, own, _) in after.items() for k, e in enumerate(full)]
    df = spark.createDataFrame(rows, "delivery int, last_touch int, identity string, n_owners int, current boolean")
    kept, over = retained(df, capacity, most)
    got = {}
    for r in kept.collect():
        got.setdefault(r.delivery, set()).add(r.identity)
    assert over.count() == 0
    assert got == {d: {e[0] for e in left} for d, (_, _, left) in after.items() if left}


def retained(df, capacity, most):
    return K.retain_owner_budget(K.retain_recent(df, capacity, ["delivery"]), most, ["delivery"])


def streamed(spark, rows, path, **kw):
    df = spark.createDataFrame([tuple(r.values()) for r in rows], J.INPUT)
    return run_in_order(spark, df, lambda s: J.dedup_stream(s, **kw), str(path))


def test_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    rows = inputs(7, 600, 60)
    out = streamed(spark, rows, tmp_path, shards=1, capacity=15, associations=40).orderBy("arrival").collect()
    want, _ = plain(rows, 15, 40)
    assert [(r.verdict, r.owners) for r in out] == want
    assert max(r.entries for r in out) <= 15 + 7
    assert {"delivered", "suppressed", "passed", "conflict"} <= {r.verdict for r in out}


def test_a_shard_calls_the_store_a_few_times_and_finds_its_journal_again():
    """However many entries change: the stream's time was that of a call an entry."""
    calls, rows = [], inputs(11, 4000, 3000)

    class Kept:
        def __init__(self, *_):
            self.held = {}

        def __getattr__(self, name):
            def call(*given):
                calls.append(name)
                if name == "clear":
                    self.held = {}
                elif name in ("put", "update"):
                    self.held["v"] = given[0]
                elif name == "updateValue":
                    self.held[given[0]] = given[1]
                elif name == "removeKey":
                    self.held.pop(given[0], None)
                return {"exists": bool(self.held), "get": self.held.get("v"), "iterator": iter(list(self.held.items()))}.get(name)

            return call

    class Handle:
        getMapState = getListState = getValueState = Kept

    shard, got = J._Processor(900, 10**6), []
    shard.init(Handle())
    for low in range(0, 4000, 1400):
        frames = [pd.DataFrame(rows[k : k + 100]) for k in range(low, min(low + 1400, 4000), 100)]
        got += [(v, list(o)) for f in shard.handleInputRows((1, 0), iter(frames), None) for v, o in zip(f["verdict"], f["owners"])]
    want, _ = plain(rows, 900, 10**6)
    assert got == want and len(calls) < 60


def test_stream_and_batch_agree_over_shards(spark, tmp_path):
    rng = random.Random(9)
    identity = lambda k: ("b" + str(k % 3), "t" + str(k), k % 2)
    rows, at = [], 0
    for n in range(40):
        for _ in range(6):
            k = rng.randrange(50)
            at += 1
            rows.append((*identity(k), k % 30, sorted(rng.sample("abc", rng.randrange(1, 4))), at * 1000, rng.random() < 0.1, rng.choice(["x", "x", "x", "x", "y"])))
    records = spark.createDataFrame(rows, "block_hash string, transaction_hash string, log_index int, block_number bigint, owners array<string>, arrival bigint, removed boolean, digest string")
    reorgs = spark.createDataFrame([(7, 10**6, 60_500), (2, 10**6, 150_500), (20, 10**6, 190_500)], "ancestor bigint, old_tip bigint, arrival bigint")
    generations = spark.createDataFrame([("a", 80_500, 1), ("b", 90_500, 3), ("a", 120_500, 2)], "owner_id string, arrival bigint, generation bigint")
    out = run_in_order(spark, journal_rows(records, reorgs, generations), lambda s: J.dedup_stream(s, shards=3), str(tmp_path))
    got = sorted((r.arrival, r.verdict, r.owners) for r in out.collect())
    want = H.deduplicate_generations(records, H.IDENTITY, reorgs, generations).collect()
    assert got == sorted((r.arrival, r.verdict, r.owners) for r in want)
    assert len({r.shard for r in out.select("shard").distinct().collect()}) == 3


def test_epochs_of_deep_and_shallow_reorgs(spark):
    rng = random.Random(3)
    reorgs = [(a, a + rng.choice([1, 2, 5, 1000, 10**6]), rng.randrange(1000)) for a in (rng.randrange(10**6) for _ in range(60))]
    records = [(rng.choice(reorgs)[rng.randrange(2)] + rng.randrange(-1, 2), rng.randrange(1000)) for _ in range(400)] + [(0, 5)]
    df = spark.createDataFrame(records, "block_number bigint, arrival bigint")
    r = spark.createDataFrame(reorgs, "ancestor bigint, old_tip bigint, arrival bigint")
    got = {(x.block_number, x.arrival): x.epoch for x in H.branch_epochs(df, r).collect()}
    assert got == {(n, t): sum(at <= t and a < n <= tip for a, tip, at in reorgs) for n, t in records}
    assert r.select(F.max(F.size(H.dyadic("ancestor + 1", "old_tip + 1")))).first()[0] <= 42
    assert H.branch_epochs(df, r.limit(0)).agg(F.max("epoch")).first()[0] == 0


# ---------------------------------------------------------------- cutover

HISTORY_TOP, LIVE_FROM = 30, 22


def record(source, n, k, arrival, branch="", removed=False, payload=None):
    hash_ = f"b{n}{branch}"
    return {"chain_id": 1, "arrival": arrival, "source": source, "kind": "record", "identity": f"{hash_}:{k}", "block_number": n, "block_hash": hash_, "digest": payload or f"p{n}.{k}", "removed": removed, "records": None, "bytes": None, "payload": payload or f"p{n}.{k}"}


def deliveries(changed=()):
    """History pages of four blocks, each with its acknowledgement; live batches of one block, with a stale branch that is removed."""
    control = lambda source, kind, n, records=None: {**dict.fromkeys(record("", 0, 0, 0)), "chain_id": 1, "source": source, "kind": kind, "block_number": n, "records": records, "bytes": records and 10 * records}
    history = [[record("history", n, k, 0) for n in range(p, min(p + 4, HISTORY_TOP + 1)) for k in range(n % 3 + 1)] + [control("history", "ack", min(p + 3, HISTORY_TOP))] for p in range(0, HISTORY_TOP + 1, 4)]
    live = []
    for n in range(LIVE_FROM, 40):
        own = [record("live", n, k, 0, payload="other" if (n, k) in changed else None) for k in range(n % 3 + 1)]
        stale = [record("live", n, 0, 0, "s"), record("live", n, 0, 0, "s", True)] if n % 5 == 4 else []
        live.append([control("live", "head", n, len(own) + len(stale)), *stale, *own])
    return history, live


def interleaved(rng, history, live):
    """Any merge of the two sources that keeps each one's order."""
    order = [0] * len(history) + [1] * len(live)
    rng.shuffle(order)
    its, rows = [iter(history), iter(live)], []
    for side in order:
        rows += next(its[side])
    return [r | {"arrival": k} for k, r in enumerate(rows)]


def run(rows, limits=C.LIMITS):
    shard, out = C.Cutover(limits, 256), []
    for r in rows:
        out += shard.apply(r)
    return shard, out


def test_any_interleaving_gives_the_batch_union(spark):
    rng = random.Random(5)
    history, live = deliveries()
    schema = "block_number bigint, identity string, arrival bigint, removed boolean"
    frame = lambda batches: spark.createDataFrame([(r["block_number"], r["identity"], k, bool(r["removed"])) for k, r in enumerate(r for b in batches for r in b if r["kind"] == "record")], schema)
    h, v = frame(history), frame(live)
    cut = H.fence(v.where(~F.col("identity").contains("s")), h)
    want = sorted(r.identity for r in H.hybrid_union(h, v.where(~F.col("removed") & ~(F.col("identity").contains("s") & (F.col("block_number") <= HISTORY_TOP))), cut).collect())
    for _ in range(300):
        shard, out = run(interleaved(rng, history, live))
        said = {}
        for r, verdict in out:
            said.setdefault(verdict, []).append(r)
        union = sorted(r["identity"] for v in ("history", "live") for r in said.get(v, []) if not r["removed"] and not (r["block_hash"].endswith("s") and r["block_number"] <= HISTORY_TOP))
        assert union == want and shard.phase == "live" and not shard.buffer
        assert shard.fence == LIVE_FROM - 1 <= shard.through <= HISTORY_TOP
        assert not {"poisoned", "payload", "below_fence", "missing_in_live"} & said.keys()
        assert {r["block_number"] for r in said.get("missing_in_history", [])} == {n for n in (24, 29) if n <= shard.through}
        assert {r["block_number"] for r in said.get("late_drop", [])} == {n for n in (24, 29) if n <= shard.through}


def test_disagreements_are_told():
    history, live = deliveries(changed={(23, 1)})
    live[2] = [r for r in live[2] if r["identity"] != "b24:0"]
    _, out = run([r | {"arrival": k} for k, r in enumerate([*sum(history, []), *sum(live, [])])])
    assert {(v, r["identity"]) for r, v in out if v in ("payload", "missing_in_live")} == {("payload", "b23:1"), ("missing_in_live", "b24:0")}


def test_no_cutover_without_the_fence_and_poison():
    history, live = deliveries()
    shard, out = run(sum(history[:5], []) + sum(live, []))
    assert shard.phase == "catching_up" and len(shard.buffer) == sum(r["kind"] == "record" for b in live for r in b)
    assert {v for _, v in out} == {"history"}
    for limits in ((3, 10**6, 10**6), (10**6, 9, 10**6), (10**6, 10**6, 85)):
        shard, out = run(sum(live, []) + sum(history, []), limits)
        assert shard.phase == "poisoned" and {v for _, v in out} == {"poisoned"} and not shard.buffer
    shard, _ = run(sum(history, []) + sum(live, []), (3, 10**6, 10**6))
    assert shard.phase == "live"


def test_cutover_stream_is_restarted(spark, tmp_path):
    rows = interleaved(random.Random(8), *deliveries(changed={(25, 0)}))
    _, want = run(rows)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], C.INPUT)
    out = run_in_order(spark, df, lambda s: C.cutover_stream(s, shards=3), str(tmp_path)).collect()
    key = lambda r, v: (r["source"], r["identity"], bool(r["removed"]), v)
    assert sorted(key(r, r.verdict) for r in out) == sorted(key(r, v) for r, v in want)
    assert len({r.shard for r in out}) == 3
