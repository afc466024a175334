"""URL filters by a sort-merge range join (operator 10).

A host is written as its labels in reverse, each closed by a dot, so that a
rule's host and all of its subdomains are one interval of keys that starts
with the rule's own.  Distinct (host, path) pairs and rules are cut into
ranges of that key, a rule going to every range its interval meets, and each
sorted range is swept once: a stack holds the rules whose host encloses the
current key, and those of them whose path starts the url's path compete; the
longest wins.

Defined results: a null url, or one without ``://``, has empty host and path
and fits no rule; a rule with a null host or path fits nothing; equal rules
count once, and of rules that differ in verdict only the smaller verdict
stands; of two fitting rules of equal length the longer host wins; a url that
no rule fits gets ``default``.  Repeated urls and page ids are judged row by
row.  Extra columns of ``pages`` pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DEFAULT = "allow"
#: Rows of the sample that sets the range bounds; bounds change balance only, never results.
BOUND_SAMPLE = 4096


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """``blog.example.net`` as ``net.example.blog.``."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows (part, key, kind, ...) of whole ranges: rules (kind 0) before the urls they enclose."""
    stack: list[tuple[str, dict]] = []
    current, part = None, None
    ordered: list[tuple] = []
    for pdf in batches:
        out = []
        for p, key, kind, host, path, verdict in zip(pdf["part"], pdf["key"], pdf["kind"], pdf["host"],
                                                     pdf["path"], pdf["verdict"]):
            if p != part:
                stack, part, current = [], p, None
            if key != current:
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                current, ordered = key, None
            if kind == 0:
                if not stack or stack[-1][0] != key:
                    stack.append((key, {}))
                stack[-1][1].setdefault(path, (len(host) + len(path), len(host), host + path, path, verdict))
                ordered = None
                continue
            if ordered is None:
                ordered = sorted((r for _, level in stack for r in level.values()), reverse=True)
            best = next((r for r in ordered if path.startswith(r[3])), None)
            out.append((host, path, best and best[2], best and best[4]))
        yield pd.DataFrame(out, columns=["host", "path", "rule", "verdict"])


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT,
          rows_per_range: int = 20_000) -> DataFrame:
    """``pages`` with host, path, rule and verdict; ``rules`` are (host, path, verdict)."""
    spark = pages.sparkSession
    prepare(spark)
    pages = (pages.drop("host", "path", "rule", "verdict")
             .withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url))))
    pairs = pages.select("host", "path").distinct().withColumn("key", host_key(F.col("host")))
    # bounds of the ranges, over (key, path): a host with a third of all urls is cut by path
    at = F.concat("key", F.lit("\x00"), "path")
    n = pairs.count()
    parts = max(1, -(-n // rows_per_range))
    bounds: list[str] = []
    if parts > 1:
        seen = [r[0] for r in pairs.select(at.alias("at")).orderBy(F.xxhash64("at")).limit(BOUND_SAMPLE).collect()]
        seen.sort(key=lambda s: s.encode())
        bounds = sorted({seen[len(seen) * i // parts] for i in range(1, parts)}, key=lambda s: s.encode())
    edges = F.array(*[F.lit(b) for b in bounds]).cast("array<string>")

    def range_of(c: Column) -> Column:
        return F.size(F.filter(edges, lambda b: b <= c))

    rules = (rules.dropna(subset=["host", "path"]).groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
             .withColumn("key", host_key(F.col("host"))))
    last = F.concat(F.expr("left(key, char_length(key) - 1)"), F.lit("/"))  # '/' follows '.': the interval's end
    rules = rules.withColumn("part", F.explode(F.sequence(range_of(F.col("key")), range_of(last))))
    events = (rules.select("part", "key", F.lit(0).alias("kind"), "host", "path", "verdict")
              .unionByName(pairs.select(range_of(at).alias("part"), "key", F.lit(1).alias("kind"), "host", "path",
                                        F.lit(None).cast("string").alias("verdict"))))
    judged = (events.repartition(parts, "part").sortWithinPartitions("part", "key", "kind", "path")
              .mapInPandas(_sweep, "host string, path string, rule string, verdict string"))
    return (pages.join(judged, ["host", "path"], "left")
            .withColumn("verdict", F.coalesce("verdict", F.lit(default))))
