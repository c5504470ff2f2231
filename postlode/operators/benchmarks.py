"""How well scores agree with labels, without comparing all pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlode.operators.running import running_sums
from postlode.shared import checkpointed


def _below(rows: DataFrame, by: str | None) -> tuple[DataFrame, list]:
    """Counts of each label at each score, with those at lower scores (below_<label>), and the labels in order.

    Labels are a short scale. Scores are dealt out in ranges, within groups too.
    """
    group = [by] if by else []
    # what follows reads the few counts alone, so rows are scored once
    counts = checkpointed(rows.groupBy(*group, "score", "label").agg(F.count("*").alias("n")))
    labels = [r["label"] for r in counts.select("label").distinct().orderBy("label").collect()]
    wide = counts.groupBy(*group, "score").pivot("label", labels).agg(F.sum("n")).na.fill(0)
    return running_sums(wide, F.col("score"), {f"below_{x}": F.col(f"`{x}`") for x in labels}, group), labels


def concordance(rows: DataFrame, by: str | None = None) -> DataFrame:
    """(pairs, concordant, discordant, tied, concordance, tau) of rows with label and score, by group.

    A pair counts if its labels differ. Rows are first counted by (score,
    label); running sums over scores then give the pairs, in n log n.
    """
    group = [by] if by else []
    wide, labels = _below(rows, by)
    over = lambda f: sum((f(hi, lo) for i, hi in enumerate(labels) for lo in labels[:i]), F.lit(0))
    good = over(lambda hi, lo: F.col(f"`{hi}`") * F.col(f"below_{lo}"))
    bad = over(lambda hi, lo: F.col(f"`{lo}`") * F.col(f"below_{hi}"))
    tied = over(lambda hi, lo: F.col(f"`{hi}`") * F.col(f"`{lo}`"))
    sums = wide.groupBy(*group).agg(F.sum(good).alias("concordant"), F.sum(bad).alias("discordant"), F.sum(tied).alias("tied"))
    pairs = F.col("concordant") + F.col("discordant") + F.col("tied")
    share = lambda x: F.round(F.when(pairs > 0, x / pairs), 6)
    return sums.select(*group, pairs.alias("pairs"), "concordant", "discordant", "tied", share(F.col("concordant")).alias("concordance"), share(F.col("concordant") - F.col("discordant")).alias("tau"))


def inversions(rows: DataFrame) -> DataFrame:
    """rows with `outranked`: how many rows of a lower label have a higher score. No pairs are made."""
    wide, labels = _below(rows, None)
    totals = wide.groupBy().agg(*[F.sum(f"`{x}`").alias(f"all_{x}") for x in labels])
    above = {x: F.col(f"all_{x}") - F.col(f"below_{x}") - F.col(f"`{x}`") for x in labels}
    by_label = F.array(*[F.struct(F.lit(x).alias("_label"), sum((above[lo] for lo in labels[:i]), F.lit(0)).cast("long").alias("outranked")) for i, x in enumerate(labels)])
    # totals is one row
    table = wide.join(F.broadcast(totals)).select(F.col("score").alias("_score"), F.inline(by_label))
    return rows.join(table, (F.col("score") == F.col("_score")) & (F.col("label") == F.col("_label"))).drop("_score", "_label")


def extremes(rows: DataFrame, labels: Sequence, limit: int = 6, best: bool = True) -> DataFrame:
    """Of some labels the rows with the highest scores (good scores of bad labels), or the lowest."""
    order = F.desc("score") if best else F.asc("score")
    return rows.where(F.col("label").isin(*labels)).orderBy(order, "id").limit(limit)


def ranks_within(rows: DataFrame, by: str, order: Sequence[Column]) -> DataFrame:
    """rows with their rank among the rows of one stratum, which may be of any size; `order` should leave no ties."""
    counted = running_sums(rows, order, {"rank_within": F.lit(1)}, [by])
    return counted.withColumn("rank_within", (F.col("rank_within") + 1).cast("int"))


def rescored_outcomes(outcomes: DataFrame, scores: DataFrame) -> DataFrame:
    """(day, n, mean_score, answered_mean) of outcomes (id, day, answered) under the scores (id, score) of today."""
    joined = outcomes.join(scores, "id")
    return joined.groupBy("day").agg(F.count("*").alias("n"), F.round(F.avg("score"), 4).alias("mean_score"), F.round(F.avg(F.when(F.col("answered"), F.col("score"))), 4).alias("answered_mean"))


def tie_groups(rows: DataFrame) -> DataFrame:
    """(score, n, labels): groups of equal scores, and whether their labels differ."""
    return rows.groupBy("score").agg(F.count("*").alias("n"), F.count_distinct("label").alias("labels")).where("n > 1").withColumn("mixed", F.col("labels") > 1)


def by_label(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("score"), 4).alias("mean_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score"))


def component_profile(rows: DataFrame) -> DataFrame:
    """(component, label, mean) of rows with label and score_breakdown."""
    return rows.select("label", F.explode("score_breakdown").alias("component", "value")).groupBy("component", "label").agg(F.round(F.avg("value"), 4).alias("mean_value"))


def bands(rows: DataFrame, edges: list[float]) -> DataFrame:
    """(band, n, positives, share): band k holds scores from edges[k-1] up to edges[k]."""
    band = sum((F.when(F.col("score") >= e, 1).otherwise(0) for e in edges), F.lit(0))
    return rows.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.sum("label").alias("positives"), F.round(F.avg("label"), 4).alias("share"))


def precision_at(rows: DataFrame, k: int, id_col: str = "id") -> DataFrame:
    return rows.orderBy(F.desc("score"), id_col).limit(k).agg(F.count("*").alias("k"), F.sum("label").alias("positives"), F.round(F.avg("label"), 4).alias("share"))
