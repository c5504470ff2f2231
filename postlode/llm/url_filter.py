"""URL rules as a sort-merge range join.

A rule `host/path` fits its host and all subdomains. With the labels of a host
reversed, a rule's hosts are one interval of keys, so a sweep over pages and
rules in order of key keeps the rules that are open in a stack: a rule is
popped by the first key that does not start with its own. Pages are cut into
ranges by (key, hash of the id), so that one host's pages can fill many ranges,
and a rule goes to each range that its interval meets.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Above all keys that start with a rule's key.
END = chr(0x10FFFF)
#: The driver holds 16 keys for each range while it cuts them.
MOST_RANGES = 1 << 14


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_key(host: Column) -> Column:
    """example.org -> org.example. : a subdomain's key starts with its domain's."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]] | DataFrame) -> DataFrame:
    """(rule_host, rule_path, verdict): hosts in lower case, each rule once.

    Of equal rules in a sequence the first holds; a DataFrame has no order, so
    there it is the verdict that comes first by code point.
    """
    if not isinstance(rules, DataFrame):
        first: dict[tuple[str, str, str], str] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            first.setdefault((host.translate(str.maketrans(UPPER, LOWER)), slash, path), verdict)
        return spark.createDataFrame([(h, s + p, v) for (h, s, p), v in first.items()], "rule_host string, rule_path string, verdict string")
    host = F.substring_index("rule", "/", 1)
    named = rules.select(F.translate(host, UPPER, LOWER).alias("rule_host"), F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("rule_path"), "verdict")
    return named.groupBy("rule_host", "rule_path").agg(F.min("verdict").alias("verdict"))


class Paths:
    """The rules of one host: of those whose path starts a page's, the longest is found by one lookup for each length."""

    def __init__(self) -> None:
        self.rules: dict[str, tuple[str, str]] = {}
        self.lengths: list[int] = []

    def add(self, path: str, rule: str, verdict: str) -> None:
        self.rules[path] = rule, verdict
        if len(path) not in self.lengths:
            self.lengths = sorted([*self.lengths, len(path)], reverse=True)

    def longest(self, path: str) -> tuple[str, str] | None:
        return next((self.rules[path[:n]] for n in self.lengths if n <= len(path) and path[:n] in self.rules), None)


def apply_rules(pages: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", rows_per_range: int = 50_000) -> DataFrame:
    """(id, host, path, rule, verdict): one row for each row of pages.

    rules: pairs (verdict, 'host/path'), or a DataFrame of (verdict, rule), see
    rule_table for equal ones. Of the rules that fit a page the longest wins,
    of equally long ones that with the longer host. Pages that none fits, null
    urls and urls without :// have rule null and the default verdict. Repeated
    rows stay repeated. Ranges of pages are read as streams; there is one for
    about rows_per_range of them, and MOST_RANGES at most.
    """
    spark = pages.sparkSession
    rules = rule_table(spark, rules)
    host = host_of(F.col(url_col))
    keyed = pages.select(F.col(id_col).alias("id"), host.alias("host"), path_of(F.col(url_col)).alias("path"))
    keyed = keyed.withColumn("key", reversed_key(F.col("host"))).withColumn("salt", F.xxhash64("id", "path"))
    # boundaries: about one for so many pages, from a sample whose size follows only their number
    count = keyed.count()
    ranges = max(1, min(MOST_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), count // rows_per_range)))
    wanted = 16 * ranges
    sample = sorted((r.key, r.salt) for r in keyed.select("key", "salt").where(F.pmod(F.xxhash64("salt"), F.lit(1 << 20)) < F.lit(max(1, (1 << 20) * wanted // max(count, 1)))).limit(4 * wanted).collect())
    bounds = [sample[i * len(sample) // ranges] for i in range(1, ranges)] if len(sample) > ranges else []
    keys = [k for k, _ in bounds]

    @F.pandas_udf("int")
    def range_of(key: pd.Series, salt: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, (k, s)) for k, s in zip(key, salt, strict=True)], dtype="int32")

    @F.pandas_udf("array<int>")
    def ranges_of(key: pd.Series) -> pd.Series:
        return pd.Series([list(range(bisect_left(keys, k), bisect_right(keys, k + END) + 1)) for k in key])

    none = F.lit(None).cast("string")
    found = keyed.select(range_of("key", "salt").alias("part"), "key", F.lit(1).alias("kind"), "id", "host", "path", none.alias("rule"), none.alias("verdict"))
    rule_key = reversed_key(F.col("rule_host"))
    ruled = rules.select(F.explode(ranges_of(rule_key)).alias("part"), rule_key.alias("key"), F.lit(0).alias("kind"), F.lit(None).cast(keyed.schema["id"].dataType).alias("id"), F.col("rule_host").alias("host"), F.col("rule_path").alias("path"), F.concat("rule_host", "rule_path").alias("rule"), "verdict")
    events = found.unionByName(ruled).repartitionById(ranges, "part").sortWithinPartitions("part", "key", "kind")

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack: list[tuple[str, Paths]] = []
        part = None
        for batch in batches:
            rows, n = [], batch.shape[0]
            columns = [batch[c].tolist() for c in ("part", "key", "kind", "path", "rule", "verdict")]
            for i, (p, key, kind, path, rule, verdict) in enumerate(zip(*columns, strict=True)):
                if p != part:
                    stack, part = [], p
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, Paths()))
                    stack[-1][1].add(path, rule, verdict)
                    continue
                best = None
                for _, own in stack:  # outer hosts first, so that of equal lengths the longer host stays
                    if (fits := own.longest(path)) and (best is None or len(fits[0]) >= len(best[0])):
                        best = fits
                rows.append((i, *(best or (None, default))))
            if n and rows:
                at, names, says = zip(*rows, strict=True)
                yield batch.iloc[list(at)][["id", "host", "path"]].assign(rule=names, verdict=says)

    kind = keyed.schema["id"].dataType.simpleString()
    return events.mapInPandas(sweep, f"id {kind}, host string, path string, rule string, verdict string").withColumnRenamed("id", id_col)
