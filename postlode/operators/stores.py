"""Records that stay between runs: the last of each key, histories, JSON lines, and what a run puts out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.functions.text import parse_time


def to_iso(c: Column) -> Column:
    """A time as text that sorts as it does."""
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def from_iso(c: Column) -> Column:
    return parse_time(c)


def latest(records: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last record of each key by `order`; a hot key is reduced before it is shuffled."""
    values = [c for c in records.columns if c not in key]
    best = records.groupBy(*key).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_best"))
    return best.select(*key, "_best.*")


def upserted(known: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """known with the rows of fresh in place of those of their key. Doing it twice changes nothing."""
    return known.join(fresh.select(key), key, "left_anti").unionByName(fresh.select(*known.columns))


def seen_history(seen: DataFrame, key: str, at: str) -> DataFrame:
    """(key, first_seen, last_seen, runs) of a ledger of sightings."""
    return seen.groupBy(key).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count_distinct(at).alias("runs"))


def archived(known: DataFrame, run: DataFrame, key: str) -> DataFrame:
    """Rows that a run did not see; rows without a key were never seen, and stay."""
    return known.join(run.select(key).distinct(), key, "left_anti")


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON lines; a line that is no record has all its fields null and stands whole in `_bad`."""
    return spark.read.schema(f"{schema}, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)


def line_counts(lines: DataFrame) -> DataFrame:
    """How many lines are records and how many are not. Columns are read by the cache that Spark asks for bad lines."""
    return lines.select("_bad", *[c for c in lines.columns if c != "_bad"]).agg(F.count_if(F.col("_bad").isNull()).alias("records"), F.count_if(F.col("_bad").isNotNull()).alias("bad"))


def new_since(records: DataFrame, at: str, last: Column) -> DataFrame:
    """Records after the last one that was read."""
    return records.where(F.col(at) > last)


def previous_dates(current: DataFrame, previous: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """current with the dates of its previous output where it has none of its own."""
    before = previous.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = current.join(before, key, "left")
    return joined.withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop(*[f"_{c}" for c in columns])


def save_outputs(rows: DataFrame, path: str, flat: Sequence[str]) -> None:
    """Rows as JSON lines, and some columns of them as CSV; each is replaced as a whole when it is written."""
    rows.write.mode("overwrite").json(f"{path}/json")
    rows.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/csv")


def summary(records: DataFrame, kind: str = "kind", ok: str = "ok") -> DataFrame:
    """Records of a run by kind: how many, how many went well, and the share."""
    return records.groupBy(kind).agg(F.count("*").alias("n"), F.count_if(F.col(ok)).alias("ok"), F.round(F.count_if(F.col(ok)) / F.count("*"), 4).alias("share"))
