"""URL rules by a sort-merge range join, in DataFrame operations only.

A host is turned round and closed with a dot (``example.net`` -> ``ten.elpmaxe.``).
Then all hosts under a rule's host lie in one interval of the sorted keys, and
intervals of different rules are nested or disjoint.  Rules and pages are sorted
together inside key ranges; a running window keeps, per depth of nesting, the
rule host opened last - the stack of the sweep.  Entries of the stack whose
interval has ended are skipped, the rest are compared with the path.

Ranges come from a sample of keys from all partitions at a rate that keeps it
at the same size; it only decides how evenly the rows are dealt.  A range is
cut into ``salts`` parts by page, each with its own copy of the rules that reach
into the range, so a host with a third of all pages spreads over ``salts``
tasks.  Ranges and salts follow the session's shuffle partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import shuffle_partitions

#: A-Z and a-z, for lower-casing ASCII letters only.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.reverse(host), F.lit("."))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", ranges: int | None = None, salts: int | None = None,
               default: str = "allow", sample_keys: int = 20_000) -> DataFrame:
    """Every page with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``.  A rule fits its host and
    the host's subdomains if the page's path starts with the rule's path; of
    several, the longest host and path together wins, then the longest host,
    then the smallest verdict (``allow`` before ``block``).  Without a rule:
    ``rule`` is null and ``verdict`` is ``default``.  A null url or one without
    ``://`` has an empty host and path, and no rule fits it.  Rules with a null
    or empty host are ignored, a null path is empty, repeated rules count once.
    Other columns stay, except those named like a result.  Rows are never
    merged: repeated pages come back as often as they are given.
    """
    tasks = shuffle_partitions(pages.sparkSession)
    ranges = ranges or min(64, max(16, tasks // 8))
    salts = salts or max(8, -(-tasks // ranges))
    result = ["host", "path", "rule", "verdict"]
    rows = pages.drop(*[c for c in result if c in pages.columns])
    kept = rows.columns
    url = F.col(f"`{url_col}`")
    keyed = rows.withColumn("host", host_of(url)).withColumn("path", path_of(url)) \
        .withColumn("_key", host_key(F.col("host")))

    # One row a rule host: its paths travel together, so equal keys meet once.
    hosts = (
        rules.where(F.col("host").isNotNull() & (F.col("host") != ""))
        .select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host").agg(F.sort_array(F.collect_set(F.struct(
            (F.char_length("path") + F.char_length("host")).alias("len"), F.char_length("host").alias("hlen"),
            "host", "path", "verdict"))).alias("_rules"))
        .withColumn("_key", host_key(F.col("host")))
        .withColumn("_depth", F.size(F.split("host", "\\.")))
    )
    depths = [r["_depth"] for r in hosts.select("_depth").distinct().collect()]  # as many as labels in a name
    if not depths:
        return keyed.select(*[F.col(f"`{c}`") for c in kept], "host", "path", F.lit(None).cast("string").alias("rule"),
                            F.lit(default).alias("verdict"))

    bounds = _bounds(keyed, ranges, sample_keys)
    def bucket(key: Column) -> Column:
        return reduce(lambda a, b: a + (key >= F.lit(b)).cast("int"), bounds, F.lit(0))

    # A rule reaches from its key to the last key that starts with it.
    opened = (
        hosts.withColumn("_end", F.concat(F.expr("substring(_key, 1, char_length(_key) - 1)"), F.lit("/")))
        .withColumn("_bucket", F.explode(F.sequence(bucket(F.col("_key")), bucket(F.col("_end")))))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        .select("_bucket", "_salt", "_key", F.lit(0).alias("_kind"), "_depth",
                F.struct("_key", "_rules").alias("_open"))
    )
    # Maps and variants have no hash; the other columns tell rows apart.
    spread = [F.col(f"`{f.name}`") for f in rows.schema.fields if f.dataType.simpleString().split("<")[0] not in ("map", "variant")]
    page = F.struct(*[F.col(f"`{c}`") for c in kept], F.col("host"), F.col("path"))
    asked = keyed.select(
        bucket(F.col("_key")).alias("_bucket"),
        F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int").alias("_salt"),
        "_key", F.lit(1).alias("_kind"), page.alias("_page"))
    swept = opened.unionByName(asked, allowMissingColumns=True)
    sweep = Window.partitionBy("_bucket", "_salt").orderBy("_key", "_kind") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for d in depths:
        swept = swept.withColumn(f"_at{d}", F.last(F.when(F.col("_depth") == d, F.col("_open")), ignorenulls=True).over(sweep))
    def fitting(d: int) -> Column:
        at = F.col(f"_at{d}")
        fits = F.filter(at["_rules"], lambda r: F.col("_page.path").startswith(r["path"]))
        return F.when(F.col("_key").startswith(at["_key"]), fits).otherwise(F.array())
    found = swept.where(F.col("_kind") == 1).withColumn("_fits", F.concat(*[fitting(d) for d in depths]))
    best = F.array_max(F.transform("_fits", lambda r: F.struct(
        r["len"].alias("len"), r["hlen"].alias("hlen"), (r["verdict"] == "allow").alias("a"), r["host"].alias("host"),
        r["path"].alias("path"), r["verdict"].alias("verdict"))))
    return found.withColumn("_best", best).select(
        *[F.col(f"_page.`{c}`") for c in kept], F.col("_page.host").alias("host"), F.col("_page.path").alias("path"),
        F.concat("_best.host", "_best.path").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))


def _bounds(keyed: DataFrame, ranges: int, sample_keys: int) -> list[str]:
    """At most ``ranges`` - 1 keys that cut a sample of about ``sample_keys`` rows of all partitions into equal parts."""
    rate = sample_keys / max(keyed.count(), 1)
    picked = keyed.select("_key") if rate >= 1 else keyed.select("_key").where(F.rand(seed=7) < rate)
    keys = sorted(r[0] for r in picked.collect())
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []
