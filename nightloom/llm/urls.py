"""URL rules: host-suffix and path-prefix expressions joined on short hash prefixes (native Spark)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bytes_at_most, fresh, others, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: The rules of the query contract as (action, host, path).
CONTRACT_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def host_suffixes(host: Column, sizes: list[int]) -> Column:
    """The host itself and its parent domains (``a.b.c``, ``b.c``, ``c``), of as many labels as some rule's host has.

    So the bytes of a host's expressions grow with its length, not with the square of its labels.
    """
    n_labels = F.char_length(host) - F.char_length(F.translate(host, ".", "")) + 1
    return F.array_compact(F.array(*[F.when(n_labels >= n, F.substring_index(host, ".", -n)) for n in sizes]))


def path_prefixes(path: Column, lengths: list[int]) -> Column:
    """The prefixes of a path, as long as some rule's path; longer ones than the path fall away."""
    sizes = F.array(*[F.lit(n) for n in lengths])
    return F.transform(F.filter(sizes, lambda n: n <= F.char_length(path)), lambda n: F.substring(path, F.lit(1), n))


def url_rules(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given in code as a table (action, host, path)."""
    return spark.createDataFrame(rules, "action string, host string, path string")


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", broadcast_bytes: int = 32 << 20) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    A rule (action, host, path) fits a URL if the URL's host is the rule's or a subdomain and the URL's
    path starts with the rule's. The longest rule (host and path together) wins; among equally long ones
    the longer host, then ``block``. Without a fitting rule ``rule`` is null and ``verdict`` is ``default``.

    Each distinct (host, path) is expanded into its host suffixes times its path prefixes. Expressions meet
    the rules by an equi-join on the first 4 bytes of their SHA-256; the full digest is then compared.
    Working on distinct (host, path) folds hot pages before any shuffle, and the last join is an ordinary
    sort-merge join, which adaptive execution splits where a key is hot. Rules are broadcast only if
    they measure at most ``broadcast_bytes``; larger lists are shuffled.

    Null or relative URLs have an empty host and path and fit no rule. Rows with equal URLs all stay;
    empty tables give empty results. Columns of ``pages`` named host, path, rule or verdict are replaced; other names never clash.
    """
    named = rules.select(
        F.lower("action").alias("_action"), F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("_rhost"), F.coalesce("path", F.lit("")).alias("_rpath")
    ).filter("_rhost != ''")
    # at most one per length and number of labels that a rule has
    sizes = named.agg(F.sort_array(F.collect_set(F.char_length("_rpath"))), F.sort_array(F.collect_set(F.size(F.split("_rhost", r"\.", -1))))).first()
    lengths, labels = list(sizes[0]), list(sizes[1])
    digest = lambda *parts: F.unhex(F.sha2(F.concat(*parts), 256))
    listed = named.select("_action", "_rhost", "_rpath", digest("_rhost", "_rpath").alias("_rdigest")).withColumn("_short", F.substring("_rdigest", 1, 4))
    if bytes_at_most(named, ["_action", "_rhost", "_rpath"], broadcast_bytes):
        listed = F.broadcast(listed)

    kept = others(pages, ("host", "path", "rule", "verdict"))
    source, best_ = fresh(pages, "_url", "_best")
    parsed = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(url).alias(source)).withColumns({"host": host_of(F.col(source)), "path": path_of(F.col(source))})
    pairs = parsed.select("host", "path").filter("host != ''").distinct()
    listing = lambda sizes, made: made if sizes else F.array().cast("array<string>")
    expressions = pairs.withColumn("_suffix", F.explode(listing(labels, host_suffixes(F.col("host"), labels)))).withColumn("_prefix", F.explode(listing(lengths, path_prefixes(F.col("path"), lengths))))
    hashed = expressions.select("host", "path", digest("_suffix", "_prefix").alias("_digest")).withColumn("_short", F.substring("_digest", 1, 4))
    fitting = hashed.join(listed, "_short").filter("_digest = _rdigest")
    rank = F.struct(F.char_length(F.concat("_rhost", "_rpath")), F.char_length("_rhost"), F.when(F.col("_action") == "block", 1).otherwise(0))
    best = fitting.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("_rhost", "_rpath").alias("rule"), F.col("_action").alias("verdict")), rank).alias(best_))
    return parsed.join(best, ["host", "path"], "left").select(
        *[F.col(f"`{c}`") for c in kept], "host", "path", F.col(f"{best_}.rule").alias("rule"), F.coalesce(f"{best_}.verdict", F.lit(default)).alias("verdict")
    )


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, url_rules(spark, CONTRACT_RULES)).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
WITH parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
         row_number() OVER () AS rn
  FROM pages),
rules(action, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT rn, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(action, length(rhost || rpath)) AS action
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY rn)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM parts LEFT JOIN fits USING (rn)
"""
