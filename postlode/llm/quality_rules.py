"""Host-level quality rules, with DataFrame functions only.

Every document gets counts and a base verdict. Failures are summed by host,
each host's failure rate is shrunk towards the rate of all hosts with a beta
prior fitted to the hosts themselves, and the host's verdict joins back to its
documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlode.llm.common import WORD, words
from postlode.shared import stored

SYMBOLS = "[#*$%&|<>]"


def _window_hashes(w: Column) -> Column:
    """A 64-bit hash of each three-word window of w, in order."""
    hashes = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    return F.slice(hashes, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))


def _repeat_words(hashes: Column) -> Column:
    """Words in windows found twice or more.

    Sorting (hash, place) puts equal windows side by side, so the work is
    n log n for a text of n words; texts whose windows all differ skip it.
    """
    s = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), s)


def _covered(s: Column) -> Column:
    twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
    places = F.sort_array(F.transform(twice, lambda x: x["at"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    total = F.aggregate(places, start, lambda acc, at: F.struct((acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n"), at.alias("last")))
    return F.coalesce(total["n"], F.lit(0).cast("long"))


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words); null and empty texts count 0."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    base = docs.select(F.col(id_col).alias(id_col), F.col(host_col).alias("host"), words(text).alias("_w"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"), lines.alias("_lines"))
    base = base.withColumn("_h", _window_hashes(F.col("_w"))).withColumn("_s", _repeat_words(F.col("_h")))
    return base.select(id_col, "host", F.size("_w").cast("long").alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"), "n_symbols", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), _covered(F.col("_s")).alias("n_repeat_words"))


def host_verdicts(counts: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """(host, host_docs, host_failures, host_rate, host_ok) of rows with host and base_failed.

    The prior is Beta(a, b) with the mean and variance of the hosts' raw rates
    (method of moments). Hosts that do not differ, or a single host, shrink to
    the common mean; hosts that differ as much as a rate can keep their own.
    Only the prior's three moments reach the driver.
    """
    hosts = counts.groupBy("host").agg(F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failures"))
    rate = F.col("host_failures") / F.col("host_docs")
    mean, variance = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    mean, variance = mean or 0.0, variance or 0.0
    strength = max(mean * (1 - mean) / variance - 1, 0.0) if variance > 1e-12 else 1e6
    rate = (F.col("host_failures") + F.lit(mean * strength)) / (F.col("host_docs") + F.lit(strength))
    return hosts.select("*", rate.alias("host_rate"), (rate <= max_rate).alias("host_ok"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_words: int = 50, max_repeat_percent: int = 50, max_host_rate: float = 0.5) -> DataFrame:
    """One row for each row of docs: its counts, base_failed, its host's figures, and kept.

    A document fails by itself with fewer than min_words words or with over
    max_repeat_percent of them in repeated windows. It is kept if it does not
    fail and its host's shrunk failure rate is at most max_host_rate. Null and
    empty texts have no words and fail; a null host is a host of its own;
    repeated rows stay repeated; an empty table gives an empty result.
    """
    counts = document_counts(docs, id_col, text_col, host_col)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    counts = stored(counts.withColumn("base_failed", failed), "counts")
    hosts = stored(host_verdicts(counts, max_host_rate), "hosts").withColumnRenamed("host", "_host")
    # Spark knows the size of the written hosts: it broadcasts them if they are few, and splits a hot host otherwise
    joined = counts.join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("host_ok"))
