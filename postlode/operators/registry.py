"""A registry of employers and their boards, matched against names and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlode.functions.text import fold, tokens


def enabled(registry: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Entries that are switched on, of some names only where names are given."""
    rows = registry.where(F.coalesce("enabled", F.lit(True)))
    return rows.where(F.lower("name").isin(*[n.lower() for n in names])) if names is not None else rows


def names(registry: DataFrame) -> DataFrame:
    """The different names of enabled entries."""
    return enabled(registry).select("name").distinct()


def find(wanted: DataFrame, companies: DataFrame) -> DataFrame:
    """(query, ats, slug, name, kind): each wanted name's companies, once for each board and slug.

    A name that is a company's name or slug is `exact`. Only names without an
    exact company take `token` ones, in whose name and slug they are a word.
    Both are joins on equal keys.
    """
    asked = wanted.select(F.trim("query").alias("query")).where("query <> ''").distinct().withColumn("_q", fold(F.col("query")))
    base = companies.select("ats", "slug", "name")
    exact = base.withColumn("_k", F.explode(F.array_distinct(F.array(fold(F.col("name")), fold(F.col("slug"))))))
    slug_words = F.split(F.lower(F.regexp_replace("slug", "(?<=[a-z0-9])(?=[A-Z])", " ")), "[^a-z0-9]+")
    words = base.withColumn("_k", F.explode(F.array_intersect(tokens(F.col("name")), slug_words))).where("_k <> ''")
    both = exact.withColumn("kind", F.lit("exact")).unionByName(words.withColumn("kind", F.lit("token")))
    met = asked.join(both, F.col("_q") == F.col("_k")).groupBy("query", "ats", "slug").agg(F.min("name").alias("name"), F.min("kind").alias("kind"))
    # exact comes before token in the alphabet
    best = met.withColumn("_best", F.min("kind").over(Window.partitionBy("query")))
    return best.where(F.col("kind") == F.col("_best")).select("query", "ats", "slug", "name", "kind")


def resolved(postings: DataFrame, registry: DataFrame) -> DataFrame:
    """postings with the registry's `entry` for their company, null where it has none."""
    known = registry.groupBy(F.trim(fold(F.col("name"))).alias("_key")).agg(F.min("name").alias("entry"))
    return postings.withColumn("_by", F.trim(fold(F.col("company")))).join(known, F.col("_by") == F.col("_key"), "left").drop("_by", "_key")


def coverage(registry: DataFrame, rules: DataFrame) -> DataFrame:
    """(ats, state) of boards that entries use and that rules know: covered, missing_rule, or rule_without_entry."""
    used = registry.where("ats IS NOT NULL").select("ats").distinct().withColumn("_used", F.lit(True))
    known = rules.select("ats").distinct().withColumn("_known", F.lit(True))
    state = F.when(F.col("_used").isNull(), "rule_without_entry").when(F.col("_known").isNull(), "missing_rule").otherwise("covered")
    return used.join(known, "ats", "full_outer").select("ats", state.alias("state"))


def latest_tenants(runs: DataFrame) -> DataFrame:
    """(company, tenants) that the last run of each company saw; runs: (company, at, tenant)."""
    last = runs.groupBy("company").agg(F.max("at").alias("_last"))
    own = runs.join(last, "company").where(F.col("at") == F.col("_last"))
    return own.groupBy("company").agg(F.array_sort(F.collect_set("tenant")).alias("tenants"))


def title_match(wanted: Column, page: Column) -> Column:
    """The share of a title's words that a page's text has."""
    own = F.array_distinct(tokens(wanted))
    return F.when(F.size(own) > 0, F.size(F.array_intersect(own, tokens(page))) / F.size(own)).otherwise(0.0)


def page_kind(status: Column, matches: Column, body: Column) -> Column:
    """live, soft_dead, dead or unclear: what an answer says about a posting."""
    gone = F.coalesce(body, F.lit("")).rlike(r"(?i)no longer (?:available|accepting)|position (?:has been|was) filled|nicht mehr verfügbar")
    return F.when(status.isin(404, 410), "dead").when((status == 200) & gone, "soft_dead").when((status == 200) & (matches >= 0.5), "live").otherwise("unclear")
