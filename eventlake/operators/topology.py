"""Owner topology: desired states, owner sets, fingerprints, quotas and backfill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.operators import scans
from eventlake.operators.scan import canonical_interests, violations

APPLIED, DUPLICATE, CONFLICT = "applied", "duplicate", "conflict"


def portable_interests(interests: DataFrame) -> DataFrame:
    """With portable and problem: block interests with options, full blocks and pending transactions are not portable."""
    problem = F.when((F.col("kind") == "block") & F.col("has_options"), "block interest with options").when(~F.col("kind").isin("log", "block"), "not portable")
    return interests.withColumn("problem", F.when(F.size("topics") > 4, "too many topic positions").otherwise(problem)).withColumn("portable", F.col("problem").isNull())


def apply_desired_state(requests: DataFrame) -> DataFrame:
    """requests(session_id, ordinal, expected_revision, new_revision, digest) -> with outcome.

    Compare and swap in the order of each session's requests: applied when expected is the committed
    revision and new its successor; an exact repeat of the committed state is a duplicate; anything
    else conflicts. The fold's state is one revision; a session's requests are few.
    """
    r = F.struct("ordinal", "expected_revision", "new_revision", "digest")
    g = requests.groupBy("session_id").agg(F.array_sort(F.collect_list(r)).alias("r"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("digest"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        ok = (x["expected_revision"] == a["at"]) & (x["new_revision"] == x["expected_revision"] + 1)
        same = (x["new_revision"] == a["at"]) & (x["digest"] == a["digest"])
        said = F.when(ok, APPLIED).when(same, DUPLICATE).otherwise(CONFLICT)
        return F.struct(F.when(ok, x["new_revision"]).otherwise(a["at"]).alias("at"), F.when(ok, x["digest"]).otherwise(a["digest"]).alias("digest"), F.concat(a["out"], F.array(said)).alias("out"))

    done = g.select("session_id", F.arrays_zip("r", F.aggregate("r", start, step, lambda a: a["out"]).alias("o")).alias("z"))
    z = done.select("session_id", F.explode("z").alias("z"))
    return z.select("session_id", "z.r.ordinal", "z.r.expected_revision", "z.r.new_revision", F.col("z")["o"].alias("outcome"))


def upsert_owners(current: DataFrame, listed: DataFrame) -> DataFrame:
    return current.join(listed.select("owner_id").distinct(), "owner_id", "left_anti").unionByName(listed)


def replace_owners(current: DataFrame, listed: DataFrame) -> DataFrame:
    """The listed owners and nothing else; the base owner goes too unless it is listed."""
    return listed.select(*current.columns)


def base_owner(current: DataFrame, from_block: int | None = None) -> DataFrame:
    """One canonical row of an empty id, shaped like `current`."""
    values = {"owner_id": F.lit(""), "canonical": F.lit(True), "from_block": F.lit(from_block).cast("long"), "to_block_excl": F.lit(None).cast("long")}
    return current.sparkSession.range(1).select(*[values.get(c, F.lit(None)).alias(c) for c in current.columns])


def replace_owners_with_global_backfill(current: DataFrame, listed: DataFrame, from_block: int) -> DataFrame:
    return replace_owners(current, listed).where("owner_id <> ''").unionByName(base_owner(current, from_block))


def add_owner(current: DataFrame, owner: DataFrame, anchor: int | None = None) -> DataFrame:
    """Add or replace one owner. A retained anchor is the backfill's start or its exact predecessor."""
    if anchor is not None and not owner.where(~(F.col("from_block") - anchor).isin(0, 1)).isEmpty():
        raise ValueError("the anchor is neither the start of the backfill nor its predecessor")
    return upsert_owners(current, owner)


def add_owner_with_canonical_catchup(current: DataFrame, owner: DataFrame, anchor: int) -> DataFrame:
    """The owner backfills from the anchor, which only it gets; everyone from the block after."""
    own = owner.withColumns({"from_block": F.lit(anchor).cast("long"), "to_block_excl": F.lit(None).cast("long")})
    return upsert_owners(current, own.unionByName(base_owner(current, anchor + 1)))


def remove_owner(current: DataFrame, owner_ids: DataFrame) -> DataFrame:
    return current.join(owner_ids.select("owner_id").distinct(), "owner_id", "left_anti")


def register_base_interests(current: DataFrame) -> DataFrame:
    return base_owner(current)


def interest_fingerprints(interests: DataFrame) -> DataFrame:
    """owner_id, fingerprint: the same for any order of interests, addresses and values; parts carry their lengths."""
    framed = lambda v: F.concat(F.size(v).cast("string"), F.lit("["), F.array_join(F.transform(v, lambda x: F.concat(F.length(x).cast("string"), F.lit(":"), x)), ""), F.lit("]"))
    c = canonical_interests(interests)
    one = F.sha2(F.concat(F.lit("interest:"), F.col("kind"), F.lit(":"), framed(F.col("addresses")), F.array_join(F.transform("topics", framed), "")), 256)
    return c.select("owner_id", one.alias("digest")).groupBy("owner_id").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), ","), 256).alias("fingerprint"))


def build_desired_state(owners: DataFrame, interests: DataFrame) -> DataFrame:
    """One row an owner, base first, then by id, with its fingerprint and its place."""
    prints = interest_fingerprints(interests)
    n = interests.groupBy("owner_id").agg(F.count("*").alias("n_interests"))
    return owners.join(prints, "owner_id", "left").join(n, "owner_id", "left").orderBy(F.col("owner_id") != "", "owner_id")


def validate_desired_state(owners: DataFrame, interests: DataFrame) -> DataFrame:
    """(rule, key) of the structural rules of a desired state.

    Owners may have baseline_number, baseline_hash and baseline_parent_hash: the retained block right before
    their backfill. Interests may have block_mode: header, or full, which is not portable.
    """
    per_owner = owners.groupBy("owner_id").agg(F.count("*").alias("n"), F.bool_or("canonical").alias("canonical"))
    base = owners.agg(F.count_if("canonical").alias("n_canonical"))
    key = F.col("owner_id")
    out = violations(per_owner, {"repeated_owner": F.col("n") > 1, "canonical_with_id": F.col("canonical") & (key != ""), "base_not_canonical": ~F.col("canonical") & (key == "")}, key)
    out = out.unionByName(violations(base, {"several_canonical": F.col("n_canonical") > 1}, F.lit("owners")))
    low, high = F.col("from_block"), F.col("to_block_excl")
    backfill = {"backfill_order": low >= high, "backfill_end_only": low.isNull() & high.isNotNull()}
    if "baseline_number" in owners.columns:  # an empty range is one that a baseline certifies
        number, wide = F.col("baseline_number"), lambda c: F.coalesce(F.col(c).rlike("^[0-9a-f]{64}$"), F.lit(False))
        backfill["backfill_order"] = (high < low) | ((high == low) & number.isNull())
        backfill["baseline_not_predecessor"] = number.isNotNull() & ~F.coalesce(number + 1 == low, F.lit(False))
        backfill["baseline_width"] = number.isNotNull() & ~(wide("baseline_hash") & wide("baseline_parent_hash"))
    out = out.unionByName(violations(owners, backfill, key))
    name = F.concat_ws("/", "owner_id", "interest_id")
    rules = {
        "address_width": F.exists("addresses", lambda a: ~a.rlike("^[0-9a-f]{40}$")),
        "topic_positions": F.size("topics") > 4,
        "topic_width": F.exists(F.flatten("topics"), lambda t: ~t.rlike("^[0-9a-f]{64}$")),
        "unknown_kind": ~F.col("kind").isin("log", "block"),
        "block_with_filter": (F.col("kind") == "block") & ((F.size("addresses") > 0) | (F.size("topics") > 0)),
        "interest_id_missing": F.coalesce(F.col("interest_id") == "", F.lit(True)),
    }
    if "block_mode" in interests.columns:
        rules["full_block"] = (F.col("kind") == "block") & (F.col("block_mode") == "full")
        rules["unknown_block_mode"] = (F.col("kind") == "block") & ~F.coalesce(F.col("block_mode").isin("header", "full"), F.lit(False))
    out = out.unionByName(violations(interests, rules, name))
    twice = interests.groupBy("owner_id", "interest_id").agg(F.count("*").alias("n"))
    out = out.unionByName(violations(twice, {"repeated_interest": F.col("n") > 1}, name))
    return out.unionByName(violations(interests.join(owners, "owner_id", "left_anti"), {"unknown_owner": F.lit(True)}, name))


def validate_state_requests(requests: DataFrame, protocol: int) -> DataFrame:
    """(rule, key) of requests(session_id, protocol_version, expected_revision, new_revision) for a desired state."""
    expected, new = F.col("expected_revision"), F.col("new_revision")
    rules = {
        "protocol_version": ~F.col("protocol_version").eqNullSafe(F.lit(protocol)),
        "session_missing": F.coalesce(F.col("session_id") == "", F.lit(True)),
        "revision_without_successor": expected.isNull() | (expected == F.lit(2**63 - 1)),
        "revision_not_successor": (expected < F.lit(2**63 - 1)) & ~F.coalesce(new - 1 == expected, F.lit(False)),
    }
    return violations(requests, rules, F.concat_ws(":", "session_id", "expected_revision"))


def exclusive_topology(owners: DataFrame, interests: DataFrame) -> DataFrame:
    """One row: whether base interests and named owners are both there."""
    i = interests.join(owners.select("owner_id"), "owner_id").agg(F.count_if(F.col("owner_id") == "").alias("base"), F.count_if(F.col("owner_id") != "").alias("named"))
    return i.select("base", "named", ((F.col("base") > 0) & (F.col("named") > 0)).alias("violated"))


def topology_diff(old: DataFrame, new: DataFrame, exact: bool, generation: int) -> DataFrame:
    """old(owner_id, fingerprint, generation), new(owner_id, fingerprint) -> change and new generation.

    An exact replacement stamps every owner; otherwise only listed owners are stamped, even unchanged.
    """
    o = old.select("owner_id", F.col("fingerprint").alias("was"), F.col("generation").alias("old_generation"))
    j = o.join(new, "owner_id", "full")
    gone = F.col("fingerprint").isNull()
    change = F.when(F.col("was").isNull(), "added").when(gone & F.lit(exact), "removed").when(gone, "untouched").when(F.col("was") != F.col("fingerprint"), "changed").otherwise("listed")
    stamp = F.when(gone & F.lit(exact), F.lit(None)).when(gone, F.col("old_generation")).otherwise(F.lit(generation))
    return j.select("owner_id", change.alias("change"), stamp.cast("long").alias("generation"))


def interest_quotas(owners: DataFrame, interests: DataFrame, limits: dict[str, int]) -> DataFrame:
    """(rule, key, value) of quotas that are passed."""
    per = interests.groupBy("owner_id").agg(
        F.count("*").alias("interests_per_owner"), F.max(F.size("addresses")).alias("addresses_per_interest"), F.sum(F.size("addresses") + F.size(F.flatten("topics"))).alias("filter_values")
    )
    total = interests.agg(F.count("*").alias("interests"), F.sum(F.size("addresses") + F.size(F.flatten("topics"))).alias("total_values"))
    count = owners.agg(F.count("*").alias("owners"), F.max(F.octet_length("owner_id")).alias("id_bytes"), F.max(F.col("to_block_excl") - F.col("from_block")).alias("bounded_span"))

    def over(df: DataFrame, key: Column) -> DataFrame:
        names = [c for c in df.columns if c in limits]
        found = F.array_compact(F.array(*[F.when(F.col(c) > limits[c], F.struct(F.lit(c).alias("rule"), F.col(c).cast("long").alias("value"))) for c in names]))
        return df.select(key.alias("key"), F.explode(found).alias("v")).select("v.rule", "key", "v.value")

    return over(per, F.col("owner_id")).unionByName(over(total, F.lit("all"))).unionByName(over(count, F.lit("all")))


def backfill_complete(owners: DataFrame, next_block: int, activation: int) -> DataFrame:
    """owner_id, target, complete: the acknowledged cursor has passed the backfill's end (or the activation block)."""
    target = F.coalesce("to_block_excl", F.lit(activation).cast("long"))
    return owners.where("from_block is not null").select("owner_id", target.alias("target"), (F.lit(next_block) >= target).alias("complete"))


def mutation_fence(requests: DataFrame, incomplete: DataFrame) -> DataFrame:
    """requests(session_id, kind): changes other than exact replacement are rejected while a backfill is open."""
    open_ = incomplete.where("not complete").agg((F.count("*") > 0).alias("open"))
    return requests.join(F.broadcast(open_)).withColumn("rejected", F.col("open") & (F.col("kind") != "replace")).drop("open")


def activation_delivery(heads: DataFrame, revision: int, start: int) -> DataFrame:
    """The neutral, blockless barrier of a new revision: it may rewind the scan but keeps the coverage head."""
    return heads.select("session_id", F.lit(f"desired-state:{revision}").alias("barrier_id"), F.least(F.lit(start).cast("long"), "next_block").alias("next_block"), "head_number", F.lit(True).alias("checkpoint_neutral"))


def owner_catchup_overlap(records: DataFrame, history: DataFrame) -> DataFrame:
    """Catch-up records whose block is not an exact retained canonical block."""
    return records.where("scope = 'OWNER_CATCHUP'").join(history.select("number", "hash"), ["number", "hash"], "left_anti")


def apply_desired_state_segmented(requests: DataFrame, size: int = scans.SEGMENT_ROWS) -> DataFrame:
    """apply_desired_state where one session holds most requests: its revisions are cut into segments.

    A request for revision r is an arrow to the first later one for r + 1; the applied ones are the path from the first for
    revision 1, carried over the segments. A request is then judged by when its revision and the next were applied.
    """
    ask = requests.where("new_revision = expected_revision + 1 and new_revision > 0").select("session_id", F.col("new_revision").alias("sequence"), "ordinal", F.col("digest").alias("said"))
    done = scans.scan(ask, ["session_id"], ["sequence", "ordinal"], scans.Commits(), size).where("commits")
    own = done.select("session_id", F.col("sequence").alias("new_revision"), F.col("ordinal").alias("at"), "said")
    after = done.select("session_id", (F.col("sequence") - 1).alias("new_revision"), F.col("ordinal").alias("next_at"))
    j = requests.join(own, ["session_id", "new_revision"], "left").join(after, ["session_id", "new_revision"], "left")
    o, first = F.col("ordinal"), F.col("new_revision") == 0  # revision 0 stands from the start, without a digest
    held = (first | (F.col("at") < o)) & (F.col("next_at").isNull() | (o < F.col("next_at")))
    applied = (F.col("expected_revision") + 1 == F.col("new_revision")) & (o == F.col("at"))
    same = held & (F.col("digest") == F.when(first, "").otherwise(F.col("said")))
    outcome = F.when(applied, APPLIED).when(same, DUPLICATE).otherwise(CONFLICT)
    return j.select("session_id", "ordinal", "expected_revision", "new_revision", outcome.alias("outcome"))
