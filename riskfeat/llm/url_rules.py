"""URL filters as a sort-merge range join.

A host is written backwards, each label closed by a dot: ``m.example.net`` is
``net.example.m.``. A rule's host then covers one interval of such keys, and so does a rule's
path among paths; intervals are nested or apart. In a sorted sweep the rules that hold
at a point are a stack: the rule that opened last, and those it lies in, as far as
they are still open.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskfeat.llm.common import Stages, shares, slices

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _nested(rules: DataFrame, prefixes: Column) -> DataFrame:
    """Adds ``chain``: the starts of all rules of the same group that a rule lies in, its own last.

    ``rules`` has one row per (grp, start); ``prefixes`` lists the starts that could enclose one.
    """
    outer = rules.select("grp", F.col("start").alias("outer"))
    return (
        rules.withColumn("outer", F.explode(prefixes))
        .join(outer, ["grp", "outer"])
        .groupBy("grp", "start")
        .agg(F.collect_list("outer").alias("chain"))
        .withColumn("chain", F.array_sort("chain"))
    )


def sweep(points: DataFrame, rules: DataFrame, payload: list[str]) -> DataFrame:
    """The stack of open rules at every point, outermost first, as ``stack``.

    ``points`` has (grp, key, payload), ``rules`` (grp, start, chain). Groups are salted by
    their share of all points, and the rules of a group go to each of its salts.
    """
    salts = shares(points, ["grp"], slices(points.sparkSession)).select("grp", "salts")
    salted = points.join(salts, "grp").withColumn(
        "salt", F.pmod(F.xxhash64("key", *payload), F.col("salts")).cast("int")
    )
    opened = rules.join(salts, "grp").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    events = opened.select(
        "grp", "salt", F.col("start").alias("key"), F.lit(0).alias("is_point"), "chain",
        *[F.lit(None).cast(points.schema[c].dataType).alias(c) for c in payload],
    ).unionByName(
        salted.select("grp", "salt", "key", F.lit(1).alias("is_point"), *payload), allowMissingColumns=True
    )
    order = Window.partitionBy("grp", "salt").orderBy("key", "is_point")
    newest = F.last("chain", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        events.withColumn("chain", newest)
        .where("is_point = 1 AND chain IS NOT NULL")
        .withColumn("stack", F.filter("chain", lambda start: F.col("key").startswith(start)))
        .where(F.size("stack") > 0)
        .select("grp", "key", "stack", *payload)
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to rows with a ``url``.

    ``rules`` has (host, path, verdict). A rule fits its host and all subdomains where the
    url's path starts with the rule's; the longest (host and path together, then host) wins, and
    of equal rules with different verdicts the later in the alphabet ("block" before "allow").
    A url that no rule fits has a null rule and the default verdict; a null url, or one without
    ``://``, has an empty host and path, which no rule fits. Rules with nulls or an empty
    host fit nothing. Rows are kept as they are, repeated ones too; columns named host, path,
    rule or verdict are replaced. Empty tables give their empty or undecided results.
    """
    stages = Stages(pages.sparkSession, "url-rules")
    pages = pages.withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url")))
    rules = rules.where("host <> '' AND path IS NOT NULL AND verdict IS NOT NULL").select(
        host_key(F.translate("host", UPPER, LOWER)).alias("rule_key"),
        F.translate("host", UPPER, LOWER).alias("rule_host"),
        F.col("path").alias("rule_path"),
        "verdict",
    )
    sites = stages(
        pages.where("host <> ''").select("host", "path").distinct()
        .withColumn("key", host_key(F.col("host")))
        # The last two labels of the host; a rule of one label goes to all groups below it.
        .withColumn("grp", F.concat(F.substring_index("key", ".", 2), F.lit("."))),
        "sites",
    )

    hosts = rules.select(F.lit("").alias("grp"), F.col("rule_key").alias("start")).distinct()
    labels = F.split(F.col("start"), r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda k: F.concat(F.array_join(F.slice(labels, 1, k), "."), F.lit(".")),
    )
    chains = _nested(hosts, suffixes).withColumn("labels", F.size(F.split("start", r"\.")) - 1)
    groups = sites.select("grp").distinct().withColumn("top", F.concat(F.substring_index("grp", ".", 1), F.lit(".")))
    wide = chains.where("labels = 1").select(F.col("start").alias("top"), "start", "chain")
    narrow = chains.where("labels > 1").select(
        F.concat(F.substring_index("start", ".", 2), F.lit(".")).alias("grp"), "start", "chain"
    )
    by_host = narrow.unionByName(wide.join(groups, "top").select("grp", "start", "chain"))
    covered = sweep(sites, by_host, ["host", "path"])

    points = stages(
        covered.select(F.explode("stack").alias("grp"), F.col("path").alias("key"), "host"), "covered"
    )
    paths = rules.select(F.col("rule_key").alias("grp"), F.col("rule_path").alias("start")).distinct()
    prefixes = F.transform(
        F.sequence(F.lit(0), F.length("start")), lambda k: F.substring(F.col("start"), F.lit(1), k)
    )
    hits = sweep(points, _nested(paths, prefixes), ["host"]).select(
        "host", F.col("key").alias("path"), F.col("grp").alias("rule_key"), F.get("stack", F.size("stack") - 1).alias("rule_path")
    )
    rule = F.concat("rule_host", "rule_path")
    best = (
        hits.join(rules, ["rule_key", "rule_path"])
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(F.length(rule).alias("n"), F.length("rule_host").alias("h"), rule.alias("rule"), "verdict")
            ).alias("best")
        )
        .select("host", "path", "best.rule", "best.verdict")
    )
    kept = [c for c in pages.columns if c not in ("rule", "verdict")]
    return (
        pages.select(kept)
        .join(best, ["host", "path"], "left")
        .select(*kept, "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
    )


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict) in the program."""
    rows = [
        spark.range(1).select(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict"))
        for h, p, v in rules
    ]
    return reduce(DataFrame.unionByName, rows)
