"""Bounded samples of labelled documents, from which the classifiers learn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.llm.common import training_row
from postlode.shared import checkpointed


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """((id, text, label) of at most per_class rows of each label, rows of each label in all).

    Only rows that training_row() admits count. Ids are taken in order of a
    hash, so the sample is the same at every run; the rows of labels that
    repeat an id count once, with the larger label, and null labels not at all.
    Of the texts of a repeated id the one with the least hash is taken.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & training_row(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    known = checkpointed(known)
    counts = {r["label"]: r["n"] for r in known.where("label in (0, 1)").groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = (F.xxhash64("id"), F.col("id"))
    taken = [known.where(F.col("label") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    ids = checkpointed(taken[0].unionByName(taken[1]))
    # at most 2 * per_class rows of two numbers: a bound that does not grow with the data
    found = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(ids), "id")
    return found.groupBy("id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("label").alias("label")), counts
