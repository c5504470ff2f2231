"""Which rows to look at again, and how what is found there joins what is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlode.operators.running import running_sums


def plan(rows: DataFrame, records: DataFrame, top: int) -> DataFrame:
    """The first rows by score, each as new, retry or seen by its stored record (id, ok)."""
    first = rows.orderBy(F.desc("score"), F.desc("id")).limit(top)
    state = F.when(F.col("ok").isNull(), "new").when(F.col("ok"), "seen").otherwise("retry")
    return first.join(records.select("id", "ok"), "id", "left").withColumn("state", state).drop("ok")


def classify_seen(url: Column, digest: Column, known_url: Column, known_digest: Column, pending_digest: Column) -> Column:
    """A new address is a change; an equal digest is none; a digest that waits is no news; else the text changed."""
    return F.when(~url.eqNullSafe(known_url), "url_changed").when(digest.eqNullSafe(known_digest) & pending_digest.isNull(), "unchanged").when(digest.eqNullSafe(pending_digest), "pending").otherwise("changed")


def fill(rows: DataFrame, found: DataFrame, short: int = 600) -> DataFrame:
    """rows with the found description where theirs is short and it is longer, and the found salary where they have none; found: (id, found_description, found_salary)."""
    theirs = F.length(F.coalesce("description", F.lit("")))
    better = (theirs < short) & (F.length("found_description") > theirs)
    joined = rows.join(found, "id", "left")
    return joined.withColumns({"description": F.when(better, F.col("found_description")).otherwise(F.col("description")), "description_source": F.when(better, F.lit("hydration")), "salary": F.coalesce("salary", "found_salary")}).drop("found_description", "found_salary")


def candidates(rows: DataFrame, shown: DataFrame, short: int = 600) -> DataFrame:
    """Shown rows whose description is empty or short."""
    return rows.where(F.length(F.trim(F.coalesce("description", F.lit("")))) < short).join(shown.select("id"), "id", "left_semi")


def merge_liveness(rows: DataFrame, verdicts: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """The newest verdict of each row, and whether it has to be asked again; verdicts: (id, state, checked_at)."""
    newest = verdicts.groupBy("id").agg(F.max_by("state", "checked_at").alias("liveness"), F.max("checked_at").alias("checked_at"))
    old = (F.unix_micros(now) - F.unix_micros("checked_at")) / F.lit(3600e6) > hours
    return rows.join(newest, "id", "left").withColumn("recheck", F.coalesce(old, F.lit(True)))


def remove_dead(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    return rows.join(verdicts.where(F.col("state") == "hard_dead").select("id").distinct(), "id", "left_anti")


def sample(rows: DataFrame, buckets: list[tuple[str, Column, int]], seed: int = 1) -> DataFrame:
    """So many rows of each bucket, a row in the first bucket that it fits; the same rows at every run."""
    bucket = F.coalesce(*[F.when(c, F.lit(n)) for n, c, _ in buckets])
    quota = F.create_map(*[x for n, _, k in buckets for x in (F.lit(n), F.lit(k))])
    w = Window.partitionBy("bucket").orderBy(F.xxhash64(F.lit(seed), "id"), "id")
    placed = rows.withColumn("bucket", bucket).where("bucket IS NOT NULL").withColumn("_n", F.row_number().over(w))
    # the largest quota is a limit that tasks apply before rows move
    return placed.where(F.col("_n") <= max([k for _, _, k in buckets], default=0)).where(F.col("_n") <= quota[F.col("bucket")]).drop("_n")


def quotas(rows: DataFrame, stratum: str, total: int) -> DataFrame:
    """(stratum, size, quota): `total` rows shared by size, rounded down; who has the largest remainders gets one of what is left.

    Equal remainders go by size, the larger first, then by name, null last. No
    quota is above its stratum's size.
    """
    sizes = rows.groupBy(stratum).agg(F.count("*").alias("size"))
    both = sizes.join(F.broadcast(sizes.agg(F.sum("size").alias("_all"))))  # one row
    exact = F.least(F.lit(total), F.col("_all")) * F.col("size")
    parts = both.select(stratum, "size", F.least(F.lit(total), F.col("_all")).alias("_want"), F.lit(1).alias("_one"), F.floor(exact / F.col("_all")).cast("long").alias("quota"), F.pmod(exact, F.col("_all")).alias("_rest"))
    left = parts.agg((F.max("_want") - F.sum("quota")).alias("_left"))
    order = [F.desc("_rest"), F.desc("size"), F.col(stratum).asc_nulls_last()]
    placed = running_sums(parts, order, {"_before": F.col("_one")}).join(F.broadcast(left))  # one row
    return placed.select(stratum, "size", (F.col("quota") + F.when((F.col("_before") < F.col("_left")) & (F.col("_rest") > 0), 1).otherwise(0)).alias("quota"))


def stratified_sample(rows: DataFrame, stratum: str, total: int, id_col: str = "id", seed: int = 1, taken: DataFrame | None = None) -> DataFrame:
    """`total` rows in proportion to their strata, the same at every run; those whose ids are `taken` are left out first, so refills are disjoint.

    Rows are taken by a digest of id and seed. How many rows of a stratum come
    before a row is a running sum, so a stratum of any size is split.
    """
    free = rows if taken is None else rows.join(taken.select(id_col), id_col, "left_anti")
    share = quotas(free, stratum, total).select(F.col(stratum).alias("_stratum"), "quota")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    placed = running_sums(free, [digest, F.col(id_col)], {"_n": F.lit(1)}, [stratum])
    return placed.join(share, F.col(stratum).eqNullSafe(F.col("_stratum"))).where(F.col("_n") < F.col("quota")).drop("_n", "_stratum", "quota")


def violations(rows: DataFrame, labels: list[str]) -> DataFrame:
    """(id, error) of a labelled ranking: unknown labels, missing reasons, ranks that repeat, breakdowns that do not sum to the score."""
    total = F.aggregate(F.map_values("score_breakdown"), F.lit(0.0), lambda a, x: a + x)
    repeated = rows.groupBy("rank").agg(F.count("*").alias("_n")).where("_n > 1").select("rank", F.lit(True).alias("_again"))
    errors = F.array_compact(F.array(
        F.when(~F.coalesce(F.col("label").isin(*labels), F.lit(False)), F.lit("label")),
        F.when(F.trim(F.coalesce("justification", F.lit(""))) == "", F.lit("justification")),
        F.when(F.col("rank").isNull() | (F.col("rank") < 1), F.lit("rank")),
        F.when(F.col("_again"), F.lit("rank_repeats")),
        F.when(F.abs(F.round(total, 2) - F.round("score", 2)) > 1e-9, F.lit("breakdown")),
    ))
    return rows.join(repeated, "rank", "left").select("id", F.explode(errors).alias("error"))


def blind_candidates(rows: DataFrame, shown: DataFrame, top: int) -> DataFrame:
    """The first rows by score, not shown, that have no description at all: nothing could be said about them yet."""
    blind = rows.where(F.trim(F.coalesce("description", F.lit(""))) == "").join(shown.select("id"), "id", "left_anti")
    return blind.orderBy(F.desc("score"), "id").limit(top)


def reassessed(rows: DataFrame, changed: DataFrame, reason: Column) -> DataFrame:
    """rows with the reason found again where a new description (id, description) came in; the others keep theirs."""
    fresh = changed.select("id", F.col("description").alias("_new"))
    joined = rows.join(fresh, "id", "left").withColumn("description", F.coalesce("_new", "description"))
    return joined.withColumn("reason", F.when(F.col("_new").isNotNull(), reason).otherwise(F.col("reason"))).drop("_new")


def relation(a: Column, b: Column) -> Column:
    """How two readings of one field stand: match, conflict, only_first, only_second, or neither."""
    one, two = F.nullif(F.lower(F.trim(a)), F.lit("")), F.nullif(F.lower(F.trim(b)), F.lit(""))
    return F.when(one.isNull() & two.isNull(), "neither").when(two.isNull(), "only_first").when(one.isNull(), "only_second").when(one == two, "match").otherwise("conflict")


def compared(first: DataFrame, second: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(field, relation, n) over two tables of readings, rows of one of them alone included."""
    named = second.select(F.col(key).alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields])
    joined = first.join(named, F.col(key) == F.col("_key"), "full_outer")
    flat = joined.select(F.inline(F.array(*[F.struct(F.lit(f).alias("field"), relation(F.col(f), F.col(f"_{f}")).alias("relation")) for f in fields])))
    return flat.groupBy("field", "relation").agg(F.count("*").alias("n"))
