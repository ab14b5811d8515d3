"""URL filters: nested prefix rules found by a sort-merge range join.

A rule is a host and a path prefix. Its canonical key, the host's labels in
reverse, a zero byte and the path, covers the interval of all keys it is a prefix of, and
such intervals are nested or apart. The sweep sorts interval ends and looked-up keys together
by ranges; the number of open intervals is the height of the stack of active
rules, and the rule on top is the last one opened at that height.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lower_az, partitions_for, staged

ALLOW, BLOCK = "allow", "block"
RULE_SCHEMA = "host string, path string, verdict string"

_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_END = b"\xff"  # above every byte of UTF-8 text


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return lower_az(F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 1))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 2)


def rules_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("\0"), path).cast("binary")


def _clean_rules(rules: DataFrame) -> DataFrame:
    """One row per (host, path), hosts in lower case; of contradicting verdicts, block."""
    host, path = lower_az(F.coalesce("host", F.lit(""))), F.coalesce("path", F.lit(""))
    return (
        rules.where(F.col("verdict").isin(ALLOW, BLOCK))
        .groupBy(host.alias("host"), path.alias("path"))
        .agg(F.max("verdict").alias("verdict"))
        .select("*", _labels(F.col("host")).alias("labels"))
        .select("*", _key(F.col("labels"), F.col("path")).alias("k"))
    )


def innermost(points: DataFrame, rules: DataFrame) -> DataFrame:
    """For each key of ``points`` (column ``k``, distinct) the innermost rule whose interval holds it.

    Rows: ``k``, ``rule`` (a struct, null if no interval holds the key). Both sides are dealt out
    by ranges of the key, so no range grows with the input; what one range
    hands the next is the number of open intervals and the last rule opened at
    each height: a row per range and height.
    """
    rule = F.struct("host", "path", "verdict")
    void = F.lit(None).cast(rules.select(rule.alias("r")).schema["r"].dataType)
    sorted_ends = (
        rules.select("k", F.lit(1).alias("step"), rule.alias("rule"))
        .unionByName(rules.select(F.concat("k", F.lit(_END)).alias("k"), F.lit(-1).alias("step"), void.alias("rule")))
        .unionByName(points.select("k", F.lit(0).alias("step"), void.alias("rule")))
    )
    dealt = staged(
        sorted_ends.repartitionByRange(partitions_for(sorted_ends), "k").select("*", F.spark_partition_id().alias("part")), "url-sweep"
    )
    order = [F.col("k"), F.col("step").desc()]  # at equal keys, opened before looked up
    sums = dealt.groupBy("part").agg(F.sum("step").alias("steps"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    carried = sums.select("part", F.coalesce(F.sum("steps").over(before), F.lit(0)).alias("height"))
    here = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    at = dealt.join(carried, "part").select(
        "part", "k", "step", "rule", (F.col("height") + F.sum("step").over(here)).alias("height")
    )
    level = Window.partitionBy("part", "height").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    topped = at.select("part", "k", "step", "height", F.last("rule", ignorenulls=True).over(level).alias("top"))
    opened = at.where("step = 1").groupBy("part", "height").agg(F.max_by("rule", "k").alias("left"))
    most = opened.agg(F.max("height")).first()[0] or 1
    earlier = Window.partitionBy("height").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    handed = (
        sums.select("part", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(most).cast("long"))).alias("height"))
        .join(opened, ["part", "height"], "left")
        .select("part", "height", F.last("left", ignorenulls=True).over(earlier).alias("left"))
    )
    return (
        topped.where("step = 0")
        .join(handed, ["part", "height"], "left")
        .select("k", F.when(F.col("height") > 0, F.coalesce("top", "left")).alias("rule"))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = ALLOW, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """The longest rule that fits each url, and its verdict.

    A rule fits its host and all subdomains if the url's path starts with the rule's.
    Rows: the id, ``host``, ``path``, ``rule`` (host and path joined, null if none fits), ``verdict``.

    A url has a key for each of its host's parent domains, so that a rule for a
    domain holds for its subdomains under the path. Keys keep as many labels and path characters as
    the longest rule has, which is all a rule can look at; urls that agree in
    those are looked up once, however many there are.

    Defined cases: a null url or one without ``://`` has an empty host and path, fits no rule
    and gets ``default``; so does every url without a fitting rule. Rules with other verdicts than
    allow and block are ignored; of equal rules block wins. Of fitting rules of equal
    length the one with the longer host wins. Repeated rows stay. Other columns are not looked at.
    """
    clean = staged(_clean_rules(rules), "url-rules")
    most_labels, most_chars = clean.agg(F.max(F.size("labels")), F.max(F.length("path"))).first()
    urls = pages.select(
        F.col(id_column).alias("id"), url_host(F.col(url_column)).alias("host"), url_path(F.col(url_column)).alias("path")
    )
    out = [F.col("id").alias(id_column), "host", "path"]
    if most_labels is None:
        return urls.select(*out, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    urls = urls.select(
        "*",
        F.slice(_labels(F.col("host")), 1, most_labels).alias("labels"),
        F.substring("path", 1, most_chars).alias("start"),
    ).select("*", F.array_join("labels", ".").alias("site"))
    seen = urls.where("host <> ''").groupBy("site", "start").agg(F.first("labels").alias("labels"))
    asked = staged(
        seen.select(
            "site", "start", F.explode(F.transform(F.sequence(F.lit(1), F.size("labels")), lambda d: F.slice("labels", 1, d))).alias("up")
        ).select("site", "start", _key(F.col("up"), F.col("start")).alias("k")),
        "url-keys",
    )
    found = innermost(asked.select("k").distinct(), clean).where("rule is not null")
    better = F.struct(
        (F.length("rule.host") + F.length("rule.path")).alias("chars"), F.length("rule.host").alias("host_chars"), "rule"
    )
    judged = staged(
        asked.join(found, "k")
        .groupBy("site", "start")
        .agg(F.max(better)["rule"].alias("rule"))
        .select("site", "start", F.concat("rule.host", "rule.path").alias("rule"), "rule.verdict"),
        "url-verdicts",
    )
    return urls.join(judged, ["site", "start"], "left").select(
        *out, "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
