"""URL rules as a sort-merge range join: reversed-host keys, one sorted sweep, a stack of nested rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm._common import cut, release

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["turned", "level", "path"]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; then up to `?`, `#` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.greatest(F.length(rest), F.lit(1))), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def _labels(host: str) -> Column:
    return F.length(host) - F.length(F.replace(F.col(host), F.lit("."), F.lit(""))) + 1


def _turned(level: str) -> Column:
    """The labels of a host from the last to the first, so that subdomains lie beside their domain."""
    return F.array_join(F.reverse(F.split(level, r"\.")), ".")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """rules(host, path, verdict) -> level, path, stack: a rule and the rules of its host that enclose it, outermost first.

    A rule's interval holds all paths that begin with its own, so intervals of a host are nested or
    apart. Only the lengths of path that a host's rules have are looked up as enclosing prefixes.
    """
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    r = rules.select(host.alias("level"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("level is not null and verdict is not null")
    r = r.groupBy("level", "path").agg(F.max("verdict").alias("verdict"))  # "block" is the greater
    lengths = r.groupBy("level").agg(F.collect_set(F.length("path")).alias("lengths"))
    prefix = r.join(lengths, "level").select("level", "path", F.explode("lengths").alias("n")).where(F.col("n") <= F.length("path"))
    prefix = prefix.select("level", F.col("path").alias("inner"), F.substring(F.col("path"), F.lit(1), F.col("n")).alias("path"))
    held = prefix.join(r, ["level", "path"]).groupBy("level", "inner")
    entry = F.struct(F.length("path").alias("n"), "path", "verdict")
    return held.agg(F.array_sort(F.collect_list(entry)).alias("stack")).withColumnRenamed("inner", "path")


def url_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls(host, path), distinct -> host, path, rule, verdict of the longest rule that fits; urls that no rule fits are left out.

    Each url stands in the sorted line once for each end of its host that is as long as some rule's at
    most, as (reversed host, path); rules stand there where their intervals begin. The line is cut into
    ranges of equal size, so one host, or one path of a domain, that holds most urls spreads over tasks. In a range
    the sweep carries the stack of the rule met last; a range begins with the stack that the ranges
    before it left. The innermost rule of the stack whose interval still holds the url is that end's.
    """
    stacks = rule_stacks(rules)
    most = F.broadcast(stacks.agg(F.coalesce(F.max(_labels("level")), F.lit(0)).alias("most")))  # one row
    ends = F.expr("transform(sequence(1, least(labels, most)), k -> substring_index(host, '.', -k))")
    points = urls.withColumn("labels", _labels("host")).join(most).where("most > 0").select(F.explode(ends).alias("level"), "path", "host")
    starts = stacks.select("level", "path", F.lit(None).cast("string").alias("host"), F.struct(F.col("level").alias("at"), "stack").alias("met"))
    line = points.unionByName(starts, allowMissingColumns=True).withColumn("turned", _turned("level"))
    line = cut(line.repartitionByRange(*_KEY, "host").withColumn("range", F.spark_partition_id()), "url-line")

    left = line.where("host is null").groupBy("range").agg(F.max_by("met", F.struct(*_KEY)).alias("met"))
    ranges = line.select("range").distinct().join(left, "range", "left")  # as many rows as shuffle partitions
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = F.broadcast(ranges.select("range", F.last("met", ignorenulls=True).over(before).alias("carried")))
    sweep = Window.partitionBy("range").orderBy(*_KEY, F.col("host").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    swept = line.withColumn("met", F.last("met", ignorenulls=True).over(sweep)).where("host is not null").join(ranges, "range")
    met = F.coalesce("met", "carried")
    path = F.col("path")
    active = F.filter(F.when(met["at"] == F.col("level"), met["stack"]), lambda e: path.startswith(e["path"]))
    fits = swept.select("host", "path", "level", F.try_element_at(active, F.lit(-1)).alias("top")).where("top is not null")
    size = F.length("level") + F.col("top.n")
    best = fits.groupBy("host", "path").agg(F.max(F.struct(size, F.length("level"), F.concat("level", "top.path").alias("rule"), F.col("top.verdict").alias("verdict"))).alias("best"))
    found = cut(best.select("host", "path", "best.rule", "best.verdict"), "url-verdicts")
    release(line)
    return found


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """pages -> row (all columns of a page), host, path, rule, verdict.

    A rule (host, path, verdict: allow or block) fits its host and all its subdomains where the url's path begins
    with the rule's. The longest fitting rule decides: most characters of host and path together, then of
    the host; of equal rules with both verdicts block holds. A url that no rule fits has a null rule and
    the verdict `default`. A null url, or one without `://`, has an empty host and path, which only a
    rule with an empty host fits. Rules with a null host or verdict are ignored, a null path of a rule is
    empty. Rows that repeat are judged alike and all kept; without rules or pages nothing fits.
    Each different url is judged once.
    """
    host, path = url_parts(F.coalesce(F.col(url), F.lit("")))
    rows = pages.select(F.struct(*pages.columns).alias("row"), host.alias("host"), path.alias("path"))
    found = url_verdicts(rows.select("host", "path").distinct(), rules)
    out = rows.join(found, ["host", "path"], "left")
    return out.select("row", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
