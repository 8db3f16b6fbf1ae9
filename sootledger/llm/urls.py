"""URL rules as a sort-merge range join: a sorted sweep over reversed-host keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed values of the registered query: host, path, verdict.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def key_of(host: Column, path: Column) -> Column:
    """Canonical key, as bytes: the host's labels from the right, a zero byte, the path."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("\0"), path).cast("binary")


def boundaries(rules: DataFrame) -> DataFrame:
    """Where the stack of active rules changes: rows (top_label, key, depth, rule, verdict).

    A rule is active from its key to the last key that begins with it. At its end the rule below it
    on the stack becomes active again: the longest other rule of the host whose path begins it, found by
    an equality join on the prefixes of the rules' own paths.
    """
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block wins over allow
    rules = rules.withColumn("rule", F.concat("host", "path"))
    shorter = rules.select("host", "path", F.explode(F.sequence(F.lit(0), F.length("path"))).alias("n")).where(
        F.col("n") < F.length("path")
    ).select("host", "path", F.expr("left(path, n)").alias("below"))
    below = (
        shorter.join(rules.select("host", F.col("path").alias("below"), "rule", "verdict"), ["host", "below"])
        .groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.length("below")).alias("under"))
    )
    whole = rules.join(below, ["host", "path"], "left").withColumn("key", key_of(F.col("host"), F.col("path")))
    label = F.element_at(F.split("host", r"\."), -1).alias("top_label")
    starts = whole.select(label, "key", F.struct("rule", "verdict").alias("active"))
    ends = whole.select(label, F.concat("key", F.lit(b"\xff")).alias("key"),
                        F.coalesce("under", F.struct(F.lit(None).cast("string").alias("rule"),
                                                     F.lit(None).cast("string").alias("verdict"))).alias("active"))
    return starts.unionByName(ends)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Rows (page_id, host, path, rule, verdict), one for each row of pages.

    A rule fits its host and all subdomains, where the path begins with the rule's; the longest wins.
    Each url looks up the key of its host and of every domain above it. Urls and boundaries meet
    in one sort by key within (last label, share of the urls): a hot host spreads over the shares,
    boundaries go to each share. The last boundary at or before a key tells which rule is on top.
    Urls without rule get the default; NULL urls and urls without '://' have empty host and path.
    Repeated rows are judged once and returned as often as they came.
    """
    shares = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    urls = (
        pages.groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("times"))
        .withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
        .withColumn("share", F.pmod(F.xxhash64("page_id", "url"), F.lit(shares)).cast("int"))
    )
    labels = F.split("host", r"\.")
    looked_up = urls.select(
        "page_id", "url", "times", "host", "path", "share",
        F.element_at(labels, -1).alias("top_label"),
        F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)),
                              lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("domain"),
    ).withColumn("key", key_of(F.col("domain"), F.col("path")))
    edges = boundaries(rules).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    events = looked_up.unionByName(edges, allowMissingColumns=True)
    sweep = W.partitionBy("top_label", "share").orderBy("key", F.col("times").isNotNull())
    swept = events.withColumn("on", F.last("active", ignorenulls=True).over(sweep.rowsBetween(W.unboundedPreceding, 0)))
    best = F.max(F.when(F.col("on.rule").isNotNull(),
                        F.struct(F.length("on.rule").alias("n"), F.length("domain").alias("d"), "on.rule", "on.verdict")))
    judged = (
        swept.where("times is not null")
        .groupBy("top_label", "share", "page_id", "url", "host", "path", "times").agg(best.alias("best"))
    )
    return judged.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    listed = F.array(*(F.struct(*map(F.lit, rule)) for rule in RULES))
    rules = spark.range(0, 1, 1, 1).select(F.inline(listed).alias("host", "path", "verdict"))
    return judge(pages, rules)


OP4_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
         row_number() OVER () AS r
  FROM pages),
rules(rule_host, rule_path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT r, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY r ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS k
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (r)
"""
