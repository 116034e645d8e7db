"""URL filters by a sorted sweep over interval-shaped rules, in DataFrame functions alone.

Every rule is a prefix of a canonical key, so it covers one interval of the sorted keys,
and intervals of prefixes nest. Rule starts, rule ends and keys are sorted together in
range partitions; each start and end carries the stack of rules open behind it, and a key
takes the stack of the last event before it. A partition begins with the stack that the
partitions before it leave behind. Two sweeps judge a URL: one over reversed hosts, whose
stack holds the nested hosts that have rules, and one over paths within each such host.

Only distinct keys are swept, so one host or path with very many URLs is one row there.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut
from .columns import without

#: Fixed ending of intervals: sorts behind every key with that prefix, as no UTF-8 text holds this byte.
BEHIND = "X'FF'"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """``www.example.com`` as ``com.example.www.``: a host and its subdomains share a prefix."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def with_ancestors(keys: DataFrame, pieces: Column) -> DataFrame:
    """Distinct ``key`` rows with ``stack``: the keys that are prefixes of it, itself included, shortest first.

    ``pieces`` lists the prefixes of ``key`` that can be keys.
    """
    keys = keys.select("key").distinct()
    parts = keys.select("key", F.explode(pieces).alias("part"))
    open_keys = keys.select(F.col("key").alias("part"))
    found = parts.join(open_keys, "part").groupBy("key").agg(F.collect_set("part").alias("stack"))
    return found.select("key", F.array_sort("stack", lambda a, b: F.length(a) - F.length(b)).alias("stack"))


def swept(points: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``key`` of ``points`` with the ``stack`` of rules open there.

    ``rules`` has ``(key, stack)`` as ``with_ancestors`` gives it. Nested prefixes make
    nested intervals, so the stack behind a rule's end is its own without its last entry.
    """
    at = F.col("key").cast("binary")
    opened = rules.select(at.alias("at"), F.lit(0).alias("turn"), F.lit(None).cast("string").alias("key"), "stack")
    closed = rules.select(F.concat(at, F.expr(BEHIND)).alias("at"), F.lit(0).alias("turn"), F.lit(None).cast("string").alias("key"),
                          F.expr("slice(stack, 1, size(stack) - 1)").alias("stack"))
    asked = points.select("key").distinct().select(
        at.alias("at"), F.lit(1).alias("turn"), "key", F.lit(None).cast("array<string>").alias("stack"))
    events = opened.unionByName(closed).unionByName(asked)
    placed = cut(events.repartitionByRange("at", "turn").withColumn("part", F.spark_partition_id()))
    order = Window.partitionBy("part").orderBy("at", "turn")
    known = placed.withColumn("stack", F.last("stack", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # one row per partition: what stands open behind it, and so before the next
    ends = placed.where("stack IS NOT NULL").groupBy("part").agg(F.max_by("stack", F.struct("at", "turn")).alias("left"))
    parts = placed.select("part").distinct().join(ends, "part", "left")
    before = parts.withColumn("before", F.last("left", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).select("part", "before")
    return (known.where("turn = 1").join(F.broadcast(before), "part")
            .select("key", F.coalesce("stack", "before", F.array().cast("array<string>")).alias("stack")))


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All rows and columns of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``(host, path, verdict)``. A rule fits its host and all subdomains if the
    path starts with the rule's; the longest (characters of host and path, then of the host,
    then the larger text) wins, and of equal rules with different verdicts ``block``. Rules with
    a null part or an empty host fit nothing. A URL that no rule fits, a null URL and one
    without ``://`` have a null rule and the verdict ``default``; host and path of the latter
    two are empty. Upper-case ASCII letters in the hosts of rules and URLs are lowered. Columns
    of ``pages`` named like the new ones give way to them.
    """
    pages = without(pages, "host", "path", "rule", "verdict")
    lowered = F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rules = (rules.where("host IS NOT NULL AND host <> '' AND path IS NOT NULL AND verdict IS NOT NULL")
             .groupBy(lowered.alias("host"), "path").agg(F.max("verdict").alias("verdict"))
             .withColumn("rule_host", reversed_host(F.col("host"))))
    # rules without a common host part are told apart from paths by a byte that neither holds
    rules = cut(rules.withColumn("rule_key", F.concat("rule_host", F.lit("\u0000"), "path")))
    urls = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    distinct = cut(urls.select("host", "path").where("host <> ''").distinct())

    labels = F.split(F.expr("substring(key, 1, length(key) - 1)"), r"\.")
    host_parts = F.transform(F.sequence(F.lit(1), F.size(labels)),
                             lambda i: F.concat(F.array_join(F.slice(labels, F.lit(1), i), "."), F.lit(".")))
    host_rules = with_ancestors(rules.select(F.col("rule_host").alias("key")), host_parts)
    hosts = distinct.select("host").distinct().withColumn("key", reversed_host(F.col("host")))
    active = hosts.join(swept(hosts, host_rules), "key").select("host", F.explode("stack").alias("rule_host"))

    head = F.instr("key", "\u0000")
    path_parts = F.transform(F.sequence(head, F.length("key")), lambda i: F.substring(F.col("key"), F.lit(1), i))
    path_rules = with_ancestors(rules.select(F.col("rule_key").alias("key")), path_parts)
    asked = cut(distinct.join(active, "host")
                .select("host", "path", F.concat("rule_host", F.lit("\u0000"), "path").alias("key")))
    stacks = swept(asked, path_rules).where("size(stack) > 0").select("key", F.try_element_at("stack", F.lit(-1)).alias("rule_key"))
    best = (asked.join(stacks, "key")
            .join(rules.select("rule_key", F.concat("host", "path").alias("rule"), "verdict",
                               F.length("host").alias("of_host")), "rule_key")
            .groupBy("host", "path")
            .agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "of_host", "rule")).alias("best")))
    best = best.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "best")
    return (urls.join(best, (urls.host == best._host) & (urls.path == best._path), "left")
            .select(*[urls[c] for c in urls.columns], F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
