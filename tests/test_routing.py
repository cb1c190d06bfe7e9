"""Routing where one address is listed by very many owners."""

import random

import pytest
from pyspark.sql import functions as F

from eventlake.operators import routing as R

LOG = "block_number bigint, transaction_index bigint, log_index bigint, address string, topics array<string>, data string"
INTEREST = "owner_id string, interest_id string, kind string, addresses array<string>, topics array<array<string>>"
OWNER = "owner_id string, canonical boolean, from_block bigint, to_block_excl bigint"


def plain(logs, interests, owners, activation):
    out = []
    base = [(f, t) for _, c, f, t in owners if c and f is not None]
    for log in logs:
        n, address, topics = log[0], log[3], log[4]
        everyone = any(f <= n and (t is None or n < t) for f, t in base)
        names, all_ = set(), False
        for o, _, kind, addresses, accepted in interests:
            hit = next((x for x in owners if x[0] == o), None)
            if kind != "log" or hit is None or (addresses and address not in addresses):
                continue
            if not all(not v or (k < len(topics) and topics[k] in v) for k, v in enumerate(accepted)):
                continue
            own = hit[2] is not None and hit[2] <= n and (hit[3] is None or n < hit[3])
            if everyone or n >= activation or own:
                all_ = all_ or everyone or (hit[1] and n >= activation)
                names |= {o} if not hit[1] or n >= activation else set()
        if all_ or names:
            out.append((*log[:4], tuple(topics), log[5], all_, () if all_ else tuple(sorted(names))))
    return sorted(out)


@pytest.mark.parametrize("slice_size", [4, 1000])
def test_hot_addresses_are_those_of_a_plain_loop(spark, slice_size):
    rng = random.Random(6)
    owners = [(f"o{k}", k == 3, rng.choice([None, 10, 50]), rng.choice([None, 60, 90])) for k in range(60)]
    owners = [(o, c, f, None if f is None else t) for o, c, f, t in owners]
    interests = [(f"o{k}", "i", "log", ["hot"] + ["warm"] * (k % 4 == 0), [[], [rng.choice("xyz")]] if k % 2 else [[rng.choice("ab")]]) for k in range(55)]
    interests += [("o55", "w", "log", [], [["a"]]), ("o56", "c", "log", ["cold", "cold"], []), ("gone", "g", "log", ["hot"], []), ("o57", "h", "block", [], []), ("o7", "j", "log", ["hot"], [])]
    logs = [(rng.randrange(0, 130), 0, k, rng.choice(["hot", "hot", "warm", "cold", "none"]), [rng.choice("abc"), rng.choice("xyz")][: rng.randrange(3)], "d") for k in range(200)]
    logs += [logs[0]] * 3 + [next(x for x in logs if x[3] == "hot" and x[0] > 100)] * 2
    df, i, o = spark.createDataFrame(logs, LOG), spark.createDataFrame(interests, INTEREST), spark.createDataFrame(owners, OWNER)
    got = R.route_logs(df, i, o, 100, slice_size)
    assert sorted((*r[:4], tuple(r.topics), r.data, r.canonical, tuple(r.owners)) for r in got.collect()) == plain(logs, interests, owners, 100)


def test_an_address_of_many_owners_has_no_long_row(spark):
    n = 20_000
    o = spark.range(n).select(F.concat(F.lit("o"), F.col("id")).alias("owner_id"), F.lit(False).alias("canonical"), F.lit(0).cast("long").alias("from_block"), F.lit(None).cast("long").alias("to_block_excl"))
    i = o.select("owner_id", F.lit("i").alias("interest_id"), F.lit("log").alias("kind"), F.array(F.lit("hot")).alias("addresses"), F.array(F.array(F.lit("a"))).alias("topics"))
    cold, hot = R._index(R._targets(i, o), 256)
    assert cold.isEmpty() and hot.agg(F.max(F.size("listed"))).first()[0] < 400 and hot.count() == 79
    df = spark.createDataFrame([(5, 0, 0, "hot", ["a"], "d"), (5, 0, 1, "hot", ["b"], "d")], LOG)
    assert [(r.log_index, len(r.owners)) for r in R.route_logs(df, i, o, 100, 256).collect()] == [(0, n)]
