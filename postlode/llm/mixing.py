"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlode.llm.common import word_count
from postlode.operators.running import running_sums
from postlode.shared import checkpointed, stored


def numbered_sources(sources: DataFrame) -> DataFrame:
    """sources with `rank` from 0, by code point and null last."""
    return running_sums(sources, F.col("source").asc_nulls_last(), {"rank": F.lit(1)})


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3) -> DataFrame:
    """(source, source_size, target) of rows with source and size.

    Sources take the weights in turn and share the sum of all sizes in their
    proportion. A target stops at `most` times its source's size; what it
    leaves is shared again by weight. Those that stop are the first in order of
    size / weight, so sums over the sources before each one tell where they
    end, whatever the number of sources. Sources of size 0 have target 0.
    """
    sources = numbered_sources(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = sources.withColumn("_weight", weight).withColumn("_most", F.col("source_size") * F.lit(float(most)))
    sources = running_sums(sources.withColumn("_ratio", F.col("_most") / F.col("_weight")), F.col("_ratio"), {"stopped": F.col("_most"), "used": F.col("_weight")})
    sources = checkpointed(sources)
    total, free = sources.agg(F.sum("source_size"), F.sum("_weight")).first()
    share = (F.lit(float(total or 0)) - F.col("stopped")) / (F.lit(float(free or 0)) - F.col("used"))
    first = sources.where(share < F.col("_ratio")).agg(F.min_by(share, "_ratio")).first()[0]
    target = F.col("_most") if first is None else F.least(F.lit(first) * F.col("_weight"), F.col("_most"))
    return sources.select("source", "source_size", target.alias("target"))


#: A draw is a number of 52 bits; each next seed of a source turns all draws on by this share of the circle.
DRAWS = 1 << 52
TURN = int((5**0.5 - 1) / 2 * DRAWS)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), most: float = 3, seed: int = 1, seeds: int = 64) -> DataFrame:
    """One row for each row of docs: (id, source, size, source_size, target, turn, copies).

    A source's rate is target / source_size. A document is taken floor(rate)
    times, and once more if a number drawn from its id and its source's seed is
    below the rate's fraction, so reruns agree. Of `seeds` seeds each source has
    the one (`turn`) whose copies come nearest to its target. Null and empty texts have
    size 0 and their copies hold no words; a source without words has rate 0.
    Rows that repeat an id draw the same number; a null id draws as an empty one.
    """
    named = docs.select(F.col(id_col).alias(id_col), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    sizes, plans = _planned(named, F.col(id_col), weights, most, seed, seeds)
    joined = sizes.join(plans, F.col("source").eqNullSafe(F.col("_source")), "left")
    return joined.withColumn("copies", _copies(F.col("_draw"), most, F.col("turn"))).drop("_source", "_draw")


def _planned(sizes: DataFrame, doc_id: Column, weights: tuple[float, ...], most: float, seed: int, seeds: int) -> tuple[DataFrame, DataFrame]:
    """Sizes (source, size, ...) with each row's draw, written; and (_source, source_size, target, turn), written."""
    sizes = stored(sizes.withColumn("_draw", _draw(doc_id, seed)), "sizes")
    targets = stored(source_targets(sizes, weights, most), "targets")
    joined = sizes.select(F.col("source").alias("_own"), "size", "_draw").join(targets, F.col("_own").eqNullSafe(F.col("source"))).where("size > 0")
    tried = joined.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))))
    # summed up in tasks before rows move: a source has as many rows as there are seeds
    taken = tried.groupBy("source", "target", "turn").agg(F.sum(_copies(F.col("_draw"), most, F.col("turn")) * F.col("size")).alias("taken"))
    near = taken.groupBy("source").agg(F.min(F.struct(F.abs(F.col("taken") - F.col("target")).alias("off"), "turn")).alias("best"))
    turns = near.select(F.col("source").alias("_source"), "best.turn")
    plans = targets.join(turns, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source").withColumnRenamed("source", "_source")
    return sizes, stored(plans.withColumn("turn", F.coalesce("turn", F.lit(0))), "plans")


def _draw(doc_id: Column, seed: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def _copies(draw: Column, most: float, turn: Column) -> Column:
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    turned = F.pmod(draw + turn.cast("long") * F.lit(TURN), F.lit(DRAWS)) / F.lit(float(DRAWS))
    return (F.floor(rate) + F.when(turned < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), most: float = 3, seed: int = 1, seeds: int = 64) -> DataFrame:
    """The rows of docs with all their columns, each as often as mix() takes it.

    Only the targets of the sources are joined. They are a written table, whose
    size Spark knows before it plans the join, so texts move only where the
    sources are too many to be broadcast.
    """
    sizes = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    _, plans = _planned(sizes, F.col("_id"), weights, most, seed, seeds)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_own"), F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    joined = rows.join(plans, F.col("_own").eqNullSafe(F.col("_source")), "left").withColumn("_copies", _copies(_draw(F.col("_id"), seed), most, F.col("turn")))
    return joined.where("_copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).select("_row.*")
