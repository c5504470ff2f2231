"""A training corpus from documents, in five stages.

Toxic documents go; of near-duplicates one stays; word runs that repeat go
from the texts that are left; sources are mixed to target weights; what comes
out is encoded. Each stage works on all that the one before kept, and all but
the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode import ship
from postlode.llm import bpe, mixing, simhash, substring_dedup, toxicity
from postlode.shared import drop_stored, stored, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.5; the model learns from the labels of the documents given.

    Null and empty texts have the leak's score alone; labels of other documents
    do not count; repeated rows are scored alike; an empty table stays empty.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model, keep=COLUMNS[2:])
    return scored.where("score < 0.5").select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates one row: that with the smallest doc_id, rows without one last, then by a hash of the row.

    Rows are told apart by that hash, so a repeated or missing doc_id neither
    loses a text nor keeps a copy.
    """
    row = F.unhex(F.sha1(F.to_json(F.struct(*COLUMNS))))
    kept = simhash.representatives(docs, row)
    return docs.select(*COLUMNS, row.alias("_row")).join(kept.withColumnRenamed("row", "_row"), "_row", "left_semi").dropDuplicates(["_row"]).select(*COLUMNS)


def remove_repeated_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words that runs of 35 words repeat; n_chars follows the text. Texts may become empty."""
    cleaned = substring_dedup.remove_repeats(docs.select(*COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: not at all, or up to three times.

    Texts without words are taken at their source's rate too; a null source is
    a source of its own; rows that repeat an id are drawn alike; a source
    without words, or an empty table, gives no rows.
    """
    return mixing.mixed_documents(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's tokens: (doc_id, source, n_tokens, ids), ids packed as little-endian unsigned 32-bit numbers.

    Null and empty texts have no tokens; repeated rows stay repeated.
    """
    ids = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), keep=("source",))
    return ids.select("doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", keep_harmless),
    ("near_duplicates", keep_one_of_near_copies),
    ("substring_dedup", remove_repeated_runs),
    ("mixing", mix_sources),
    ("bpe", encode),
]
#: Training, fingerprints and merges are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents, each written to the shared folder as Parquet and read again.

    What a stage wrote on its way is deleted when its result is written, and so
    is the result of the stage before. Runs that go on at once do not meet.
    """
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        with written() as paths:
            docs = stored(stage(spark, docs, sf_dir), name)
        drop_stored(spark, [*before, *paths[:-1]])
        before = paths[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
