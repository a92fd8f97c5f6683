"""URL filters: host and path rules, and a list of URLs behind a blocked Bloom filter.

Rules are a table of any size. A URL's host has few suffixes, and the rules of one host have few different path lengths: so a URL
is looked up by (host suffix, path cut to such a length), and the longest rule found counts.

The listed canonical URLs are hashed into blocks of four 64-bit words, one bit in each word. The
filter is a table with one row per block, built by ``bit_or`` with a map-side combine. Asked URLs
join it on the block number; those with all four bits set are possible hits. A hash join with the
list itself removes the false positives. Everything is Column expressions and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.runtime import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of the filter for each listed URL; a block has 256.
BITS_PER_URL = 16
# Query parameters that tell where a visitor came from, not what page it is.
TRACKING = r"^(utm_[^=]*|gclid|dclid|fbclid|msclkid|yclid|mc_cid|mc_eid|igshid)(=|$)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def query_of(url: Column) -> Column:
    """After the path's ``?`` up to ``#``; empty without one."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column, query: Column) -> Column:
    """One form for URLs of one page; null without a host.

    The host loses a leading ``www.`` and a default port, the path ``.html`` and slashes at its end, the query
    its tracking parameters; the other parameters are sorted.
    """
    site = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)?$", "")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING)))
    rest = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(host != "", F.concat(site, F.regexp_replace(path, r"(\.html)?/*$", ""), rest))


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(rule_host, rule_path, by_rule, place) of rules (host, path, verdict); of rules for one host and path the first."""
    rows: dict[tuple[str, str], tuple[str, int]] = {}
    for place, (host, path, verdict) in enumerate(rules):
        rows.setdefault((host, path), (verdict, place))
    return spark.createDataFrame([(*key, *value) for key, value in rows.items()], "rule_host string, rule_path string, by_rule string, place int")


def rules_of(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, by_rule) of the distinct ``urls`` (host, path) that a rule fits: the longest, the first of equally long ones.

    A rule fits its host and all subdomains when the path starts with the rule's.
    """
    parts = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    lengths = rules.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    hosts = urls.select("host").distinct().select("host", F.explode(F.array_distinct(suffixes)).alias("rule_host"))
    tests = hosts.join(lengths, "rule_host").groupBy("host").agg(F.collect_list(F.struct("rule_host", "lengths")).alias("tests"))
    asked = urls.join(tests, "host").select("host", "path", F.inline("tests"))
    asked = asked.select("host", "path", "rule_host", F.explode("lengths").alias("length")).where(F.length("path") >= F.col("length"))
    found = asked.withColumn("rule_path", F.substring("path", F.lit(1), F.col("length"))).join(rules, ["rule_host", "rule_path"])
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("long"), (-F.col("place")).alias("place"), rule.alias("rule"), "by_rule"))
    return found.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.by_rule")


def _bits(url: Column, blocks: int) -> list[Column]:
    """The block of a URL and its bit in each of the block's words."""
    spread = F.xxhash64(url, F.lit(1))
    words = [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(spread, 6 * i).bitwiseAND(63).cast("int"))
        for i in range(4)
    ]
    return [F.pmod(F.xxhash64(url), F.lit(blocks)).alias("block"), *(w.alias(f"w{i}") for i, w in enumerate(words))]


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w3): the filter over the column ``canon``."""
    return listed.select(*_bits(F.col("canon"), blocks)).groupBy("block").agg(
        *(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4))
    )


def possible(asked: DataFrame, table: DataFrame, blocks: int) -> DataFrame:
    """The asked ``canon`` with all bits set in the filter; Spark broadcasts a table that is small enough."""
    own = asked.select("canon", *(c.alias(n) for c, n in zip(_bits(F.col("canon"), blocks), ["block", "b0", "b1", "b2", "b3"], strict=True)))
    hit = F.lit(True)
    for i in range(4):
        hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"b{i}")) != 0)
    return own.join(table, "block").where(hit).select("canon")


def block_count(n: int) -> int:
    return max(1, -(-n * BITS_PER_URL // 256))


def judge(
    pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] | DataFrame, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``.

    The verdict is that of the longest fitting rule (host, path, ``allow`` or ``block``), given as a list or as a table of
    :func:`rules_table`; there may be any number of rules. Without
    one, a URL whose canonical form is among the column ``url`` of ``listed`` is blocked, any other
    is allowed. Reads only the named columns, so extra columns cannot clash. A null URL or one
    without ``://`` has an empty host and path, no canonical form and is allowed. Repeated rows and
    null ids stay rows of their own; repeated and null listed URLs count once and not at all; an
    empty table gives an empty result.
    """
    table = rules if isinstance(rules, DataFrame) else rules_table(pages.sparkSession, rules)
    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), query_of(url).alias("query"))
    rows = rows.select("page_id", "host", "path", canonical(F.col("host"), F.col("path"), F.col("query")).alias("canon"))
    rows = materialize(rows, "urls")
    by_rule = materialize(rules_of(rows.where("host <> ''").select("host", "path").distinct(), table), "ruled")
    rows = rows.join(by_rule, ["host", "path"], "left")

    names = listed.select(canonical(host_of(url), path_of(url), query_of(url)).alias("canon")).where("canon is not null").distinct()
    names = materialize(names, "listed")
    blocks = block_count(names.count())
    asked = rows.where("by_rule is null and canon is not null").select("canon").distinct()
    hits = possible(asked, bloom(names, blocks), blocks).join(names, "canon").select("canon", F.lit("block").alias("by_list"))
    return rows.join(hits, "canon", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", "by_list", F.lit("allow")).alias("verdict")
    )
