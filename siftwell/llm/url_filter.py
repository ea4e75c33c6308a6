"""URL filters: a sort-merge range join of urls with host and path rules, in DataFrame functions only.

A host's canonical key is its labels reversed, each closed by a dot
(``m.example.net`` is ``net.example.m.``). All hosts under a rule's host are
then those whose key begins with the rule's, and all paths that a rule fits
begin with its path: both are intervals [key, key and byte 255), and the
intervals of all rules are nested or disjoint. Bounds and urls are sorted
together by key, in ranges, and each range is swept once (``sweep``): a url takes
what the last bound at or before its key holds.

There are two sweeps. Over host keys a bound holds the stack of rule hosts that
are open from there on (at most 127, a host's labels). A url is then asked once
for each of them, with that host's key and its own path as one key, and there a
bound holds the one innermost rule, the longest path that fits, however many
rules a host has. Of a url's answers the longest rule decides; urls under fewer
than two rule hosts need no comparison and aren't shuffled for it.

A bound is in one range only; a range gets what is open where it begins, one
value a range, broadcast only where all of these together are small. Urls of one
key are ordered by a hash of id and path, so a host that holds any share of the
rows falls into many ranges. No row is dropped: a null url, or one without
``://``, has an empty host and path and gets the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.llm.common import cut, read_table

#: (host, path, action)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url: both empty where it is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def host_key(host: Column) -> Column:
    """Labels reversed, each closed by a dot; the empty host stays empty."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, action string")


def distinct_rules(rules: DataFrame) -> DataFrame:
    """(host, path, action): rules with a host and a path, one for each such pair."""
    return rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).groupBy("host", "path").agg(F.max("action").alias("action"))


def _bounds(rows: DataFrame, key: Column, inside: Column, outside: Column) -> DataFrame:
    """(key, kind, held): where each row's interval begins, with ``inside``, and where it ends, with ``outside``."""
    bound = lambda at, kind, held: F.struct(at.alias("key"), F.lit(kind).alias("kind"), F.struct(held.alias("value")).alias("held"))
    both = F.array(bound(key, 1, inside), bound(F.concat(key, F.lit(b"\xff")), 0, outside))
    return rows.select(F.explode(both).alias("b")).select("b.*")


def host_bounds(rules: DataFrame) -> DataFrame:
    """Bounds over host keys: the rule hosts open from there on, the innermost first.

    A host's stack is itself and the rule hosts above it, found by equi-joins on
    its at most 127 parent hosts.
    """
    hosts = rules.select("host").distinct()
    labels = F.split("host", r"\.")
    above = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("parent"))
    stacks = above.join(hosts.withColumnRenamed("host", "parent"), "parent").groupBy("host").agg(F.collect_list("parent").alias("stack"))
    ordered = F.transform(F.reverse(F.array_sort(F.transform("stack", lambda h: F.struct(F.length(h).alias("n"), h.alias("h"))))), lambda x: x["h"])
    stacks = stacks.select(host_key(F.col("host")).cast("binary").alias("key"), ordered.alias("stack"))
    return _bounds(stacks, F.col("key"), F.col("stack"), F.slice("stack", 2, F.greatest(F.size("stack") - 1, F.lit(0))))


def path_key(host: Column, path: Column) -> Column:
    """A host (by its length and itself, so that none is the begin of another) and a path as one key."""
    return F.concat(F.unhex(F.lpad(F.hex(F.octet_length(host)), 8, "0")), host.cast("binary"), path.cast("binary"))


def path_bounds(rules: DataFrame) -> DataFrame:
    """Bounds over host and path: the innermost rule from there on.

    Behind a rule's interval the rule around it holds again: its longest
    proper prefix, found by equi-joins on the begins of its path.
    """
    rule = F.struct("host", "path", "action")
    shorter = F.when(F.length("path") > 0, F.transform(F.sequence(F.lit(0), F.length("path") - 1), lambda n: F.substring("path", F.lit(1), n)))
    begins = rules.select("host", "path", F.explode(shorter).alias("begin"))
    around = begins.join(rules.select("host", F.col("path").alias("begin"), rule.alias("rule")), ["host", "begin"]).groupBy("host", "path").agg(F.max_by("rule", F.length("begin")).alias("outer"))
    rows = rules.select("host", "path", rule.alias("own")).join(around, ["host", "path"], "left")
    return _bounds(rows, path_key(F.col("host"), F.col("path")), F.col("own"), F.col("outer"))


#: Characters of what all ranges begin with, up to which it is broadcast.
SMALL = 4 << 20


def sweep(points: DataFrame, bounds: DataFrame, buckets: int) -> DataFrame:
    """``points`` (key, spread and further columns) with ``value``: what the last bound at or before their key holds."""
    spark = points.sparkSession
    order = ["key", "kind", "spread"]
    # Ends come before starts, and both before points, at one key; no two ends share a key.
    events = points.withColumn("kind", F.lit(2)).unionByName(bounds.withColumn("spread", F.lit(0).cast("long")), allowMissingColumns=True)
    # The ranges are sampled: both uses below must see the same ones.
    events = cut(events.repartitionByRange(buckets, *order).withColumn("range", F.spark_partition_id()))
    last = events.where("kind < 2").groupBy("range").agg(F.max_by("held", F.struct("key", "kind")).alias("last"))
    ranges = spark.range(buckets).select(F.col("id").cast("int").alias("range")).join(last, "range", "left")
    before = cut(ranges.select("range", F.last("last", ignorenulls=True).over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("open")))
    size = before.agg(F.sum(F.length(F.to_json("open")))).head()[0] or 0
    own = F.last("held", ignorenulls=True).over(Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = events.withColumn("own", own).where("kind = 2").join(F.broadcast(before) if size <= SMALL else before, "range")
    return swept.withColumn("value", F.coalesce("own", "open")["value"]).select(*points.columns, "value")


def filter_urls(urls: DataFrame, rules: DataFrame, key: str, url: str = "url", default: str = DEFAULT, buckets: int | None = None) -> DataFrame:
    """(key, host, path, rule, verdict), one row for each row of ``urls``.

    ``rule`` is the deciding rule's host and path, null where none fits; equal
    rules count once, and of two rules that differ only in their action the
    one later in the alphabet wins. Repeated urls and ids are judged alike.
    """
    spark = urls.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rules = cut(distinct_rules(rules))
    host, path = split_url(F.col(url))
    rows = urls.select(F.col(key).alias("id"), host.alias("host"), path.alias("path"))
    spread = F.xxhash64("id", "path").alias("spread")
    points = rows.select("id", "host", "path", host_key(F.col("host")).cast("binary").alias("key"), spread)
    # A row gets its number where its table is stored: what follows sees the same one.
    under = cut(sweep(points, host_bounds(rules), buckets).select("id", "host", "path", F.coalesce("value", F.array().cast("array<string>")).alias("stack")).withColumn("row", F.monotonically_increasing_id()))
    asked = under.where(F.size("stack") > 0).select("row", "id", "host", "path", (F.size("stack") > 1).alias("more"), F.explode("stack").alias("rule_host"))
    answers = sweep(asked.select("row", "id", "host", "path", "more", path_key(F.col("rule_host"), F.col("path")).alias("key"), spread), path_bounds(rules), buckets)
    told = [F.col("id").alias(key), "host", "path", F.concat("value.host", "value.path").alias("rule"), F.coalesce("value.action", F.lit(default)).alias("verdict")]
    length = F.struct((F.length("value.host") + F.length("value.path")).alias("n"), F.length("value.host").alias("h"))
    best = answers.where("more").groupBy("row").agg(F.first("id").alias("id"), F.first("host").alias("host"), F.first("path").alias("path"), F.max_by("value", length).alias("value"))
    none = under.where(F.size("stack") == 0).select(F.col("id").alias(key), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    return none.unionByName(answers.where(~F.col("more")).select(*told)).unionByName(best.select(*told))


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    """One row per page: host, path, the rule that decides and the verdict."""
    return filter_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), rule_table(spark, RULES), "page_id")


OP10_SQL = """
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(host, path, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fit AS (
  SELECT p.page_id, r.host || r.path AS rule, r.action,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, fit.rule, coalesce(fit.action, 'allow') AS verdict
FROM p LEFT JOIN fit ON p.page_id = fit.page_id AND fit.k = 1
"""
