"""URL filter: rules on a host and a path prefix, found by joining expanded URLs on hash prefixes.

Every URL expands into (host suffix, path prefix) expressions, restricted to the shapes (labels of
the host, length of the path) that some rule has, so that an URL of any length makes at most as many
rows as there are shapes. Expressions meet the rules in an equi-join on the first eight hex digits of
SHA-256; the full digest then confirms, and the longest rule of an URL wins (of equally long ones the
one with the longer host, then a block before an allow).

The expansion works on distinct (host, path) pairs, so a host with a third of all rows costs one row
for each of its paths. Rules are broadcast only up to ``broadcast_rules`` rows (counted first); more
are joined by a shuffle, with the URL side spread over ``salts`` copies of the rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_path(df: DataFrame, url: str, host: str = "host", path: str = "path") -> DataFrame:
    """Adds host and path; null and what has no ``://`` get empty ones."""
    u = F.col(url)
    rest = F.when(F.locate("://", u) > 0, u.substr(F.locate("://", u) + F.lit(3), F.length(u)))
    return df.withColumn("__rest", rest).withColumn(host, F.coalesce(F.translate(F.regexp_extract("__rest", r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))).withColumn(path, F.coalesce(F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1), F.lit(""))).drop("__rest")


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def filter_urls(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", broadcast_rules: int = 100_000, salts: int = 16) -> DataFrame:
    """``df`` with host, path, rule and verdict for each row's URL.

    ``rules``: host, path (empty or begins with ``/``) and verdict (allow or block). A rule holds for its
    host and all subdomains if the URL's path starts with the rule's. Rules with a null or empty host
    are ignored; a repeated rule counts once, as a block if its verdicts differ.
    Null URLs and such without ``://`` have an empty host and path, no rule and the default verdict.
    Repeated rows are judged alike; other columns pass through, but columns named host, path, rule or
    verdict are replaced. No table or no rule: no rows, or all with the default verdict.
    """
    own = (
        rules.where(F.length("host") > 0)
        .groupBy(F.col("host").alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"))
        .agg(F.max("verdict").alias("r_verdict"))  # block > allow
        .withColumn("expr", F.concat("r_host", "r_path"))
        .withColumn("labels", _labels(F.col("r_host")))
        .withColumn("cut", F.length("r_path"))
    )
    shapes = [tuple(x) for x in own.select("labels", "cut").distinct().collect()]
    few = own.limit(broadcast_rules + 1).count() <= broadcast_rules
    urls = with_host_path(df.drop("host", "path", "rule", "verdict"), url)
    if not shapes:
        return urls.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    pairs = urls.select("host", "path").where(F.length("host") > 0).distinct()
    expanded = pairs.withColumn("have", _labels(F.col("host"))).withColumn("shape", F.explode(F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(b).alias("cut")) for a, b in sorted(shapes)])))
    expanded = expanded.where((F.col("shape.labels") <= F.col("have")) & (F.col("shape.cut") <= F.length("path")))
    suffix = reduce(lambda e, k: F.when(F.col("shape.labels") == k, F.substring_index("host", ".", -k)).otherwise(e), sorted({a for a, _ in shapes}), F.lit(None).cast("string"))
    expanded = expanded.withColumn("u_host", suffix).withColumn("u_path", F.col("path").substr(F.lit(1), F.col("shape.cut")))
    digest = lambda host, path: F.sha2(F.concat(host, F.lit("\n"), path), 256)
    expanded = expanded.select("host", "path", digest(F.col("u_host"), F.col("u_path")).alias("u_digest"))
    own = own.withColumn("digest", digest(F.col("r_host"), F.col("r_path"))).withColumn("short", F.substring("digest", 1, 8))
    expanded = expanded.withColumn("short", F.substring("u_digest", 1, 8))
    if few:
        met = expanded.join(F.broadcast(own), "short")
    else:
        expanded = expanded.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(salts)))
        own = own.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        met = expanded.join(own, ["short", "salt"])
    met = met.where(F.col("digest") == F.col("u_digest"))
    rank = F.struct(F.length("expr"), F.length("r_host"), F.col("r_verdict"), F.col("expr"))
    best = met.groupBy("host", "path").agg(F.max(rank).alias("best")).select("host", "path", F.col("best.expr").alias("rule"), F.col("best.r_verdict").alias("__own"))
    # rows without a host have no rule; they don't meet in the join, however many they are
    out = urls.where(F.length("host") > 0).join(best, ["host", "path"], "left")
    out = out.unionByName(urls.where(F.length("host") == 0), allowMissingColumns=True)
    keep = [c for c in urls.columns if c not in ("host", "path")]
    return out.select(*keep, "host", "path", "rule", F.coalesce("__own", F.lit(default)).alias("verdict"))


#: The rules that the registered query applies: host, path, verdict.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
SQL = rf"""
with u as (select page_id, row_number() over () as n, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) end as rest from pages),
p as (select page_id, n, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), '{_UPPER}', '{_LOWER}') as host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from u),
r(rh, rp, rv) as (values {_VALUES}),
m as (select n, rh || rp as rule, rv, row_number() over (partition by n order by length(rh || rp) desc, length(rh) desc, rv desc) as k
      from p join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp))
select page_id, host, path, rule, coalesce(rv, 'allow') as verdict from p left join (select * from m where k = 1) using (n)
"""
