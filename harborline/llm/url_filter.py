"""URL allow and block rules by a sort-merge range join.

A host turns into a key of its labels from right to left, each with a dot behind it, so that a host and its subdomains are
one interval of keys and the intervals of two rules are nested or apart. Rule starts and the distinct hosts are range
partitioned and sorted together; a sweep keeps, for every depth of nesting, the rule last started there. Those that still
enclose the host are the stack of active rules. A rule that reaches over several partitions is handed on to them: at most
one a depth and partition. The stacks go back to the pages by host; the path decides among the rules of a stack.

Only DataFrame functions. Defined results: a url that is null or has no ``://`` has empty host and path; the longest
fitting rule wins, then the longer host, then block before allow; where no rule fits the verdict is ``default``; rules
without a host are ignored and a null path counts as empty; repeated rows count each; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm.common import stored, width

DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path, as literal pieces of the url."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _rules_by_host(rules: DataFrame) -> DataFrame:
    """``key, depth, rules``: the rules of one host as one array, longest path first."""
    path = F.coalesce("path", F.lit(""))
    host = F.translate("host", _UPPER, _LOWER)
    entry = F.struct(
        F.length(F.concat(host, path)).alias("size"), F.length(host).alias("host_size"), F.col("verdict").alias("verdict"),
        F.concat(host, path).alias("rule"), path.alias("path"),
    )
    grouped = rules.filter(F.col("host").isNotNull()).groupBy(host.alias("host")).agg(F.collect_set(entry).alias("rules"))
    return grouped.select(host_key(F.col("host")).alias("key"), F.size(F.split("host", r"\.")).alias("depth"), "rules")


def active_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, stack``: for every distinct host the rules whose hosts enclose it."""
    spark = hosts.sparkSession
    starts = _rules_by_host(rules)
    kind = starts.schema["rules"].dataType.simpleString()
    points = hosts.select(
        host_key(F.col("host")).alias("key"), F.lit(None).cast("int").alias("depth"), F.lit(None).cast(kind).alias("rules"), "host"
    )
    # order: rules before the hosts of the same key, handed-on rules before both
    events = starts.withColumn("host", F.lit(None).cast("string")).unionByName(points).withColumn("turn", F.col("host").isNotNull().cast("int"))
    placed = stored(
        events.repartitionByRange(width(spark), "key").withColumn("part", F.spark_partition_id()), "url-events"
    )
    started = placed.filter(F.col("host").isNull())
    last = started.groupBy("part", "depth").agg(F.max_by(F.struct("key", "rules"), "key").alias("last"))
    until = F.coalesce(F.lead("part").over(Window.partitionBy("depth").orderBy("part")), F.lit(width(spark) - 1))
    handed = last.withColumn("until", until).filter(F.col("until") > F.col("part")).select(
        F.col("last.key").alias("key"), "depth", F.col("last.rules").alias("rules"), F.lit(None).cast("string").alias("host"),
        F.lit(-1).alias("turn"), F.explode(F.sequence(F.col("part") + 1, F.col("until"))).alias("part"),
    )
    # a host has no more labels than its length allows, so the depths are few
    depths = sorted(r["depth"] for r in started.select("depth").distinct().toLocalIterator())
    before = Window.partitionBy("part").orderBy(
        (F.col("turn") >= 0).cast("int"), "key", "turn"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entry = F.struct("key", "rules")
    levels = [F.last(F.when(F.col("depth") == d, entry), ignorenulls=True).over(before) for d in depths]
    none = F.array().cast(f"array<struct<key:string,rules:{kind}>>")
    swept = placed.unionByName(handed).select("host", F.col("key").alias("at"), (F.array(*levels) if levels else none).alias("levels"))
    enclosing = F.filter("levels", lambda r: r.isNotNull() & F.col("at").startswith(r["key"]))
    return swept.filter(F.col("host").isNotNull()).select("host", F.flatten(F.transform(enclosing, lambda r: r["rules"])).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page; ``rules`` has ``verdict, host, path``."""
    host, path = split_url(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    stacks = active_rules(urls.select("host").distinct(), rules)
    fits = F.filter("stack", lambda r: F.col("path").startswith(r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(r["size"], r["host_size"], r["verdict"], r["rule"])))
    return urls.join(stacks, "host", "left").withColumn("_best", best).select(
        "page_id", "host", "path", F.col("_best.rule").alias("rule"), F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict")
    )
