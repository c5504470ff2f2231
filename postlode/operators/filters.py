"""Stages that drop postings and say why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlode.rules import Reason, first_reason


def funnel(rows: DataFrame, stages: Sequence[tuple[str, Column]], by: Sequence[str] = ()) -> DataFrame:
    """How many rows each stage leaves, in one pass: a row counts for a stage if it passes all up to it."""
    passed, counts = F.lit(True), []
    for name, condition in stages:
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(passed).alias(name))
    return rows.groupBy(*by).agg(F.count("*").alias("collected"), *counts)


def with_reason(rows: DataFrame, reasons: Sequence[Reason], column: str = "reason") -> DataFrame:
    return rows.withColumn(column, first_reason(reasons))


def eligible(rows: DataFrame, stages: Sequence[tuple[str, Column]], reasons: Sequence[Reason] = ()) -> DataFrame:
    """Rows that pass all stages and that no reason excludes; cheap conditions belong first."""
    for _, condition in stages:
        rows = rows.where(condition)
    return rows.where(first_reason(reasons).isNull()) if reasons else rows


def hard_removals(rows: DataFrame, reasons: Sequence[Reason], column: str = "reason") -> DataFrame:
    """Rows without those that a hard reason names."""
    return rows.where(F.col(column).isNull() | ~F.col(column).isin([r.name for r in reasons if r.hard]))


def reason_matrix(rows: DataFrame, by: str, names: Sequence[str], column: str = "reason") -> DataFrame:
    """The reasons as columns: rows, rows of each reason, and those that no reason names, by group."""
    named = [F.count_if(F.col(column) == n).alias(n) for n in names]
    return rows.groupBy(by).agg(F.count("*").alias("total"), *named, F.count_if(F.col(column).isNull()).alias("applicable"))


def assessability(description: Column, short: int = 600, wall: str = r"(?i)\b(?:sign in|log in) to (?:view|continue)\b") -> Column:
    """Why a description cannot be judged: empty, login_wall, short, or null."""
    text = F.trim(F.coalesce(description, F.lit("")))
    return F.when(text == "", "empty").when(text.rlike(wall), "login_wall").when(F.length(text) < short, "short")


def is_stale(posted: Column, reference: Column, months: float = 12) -> Column:
    """Older than so many months of 30.44 days; without a date it is not."""
    return F.coalesce(F.datediff(reference, posted) / 30.44 > months, F.lit(False))


def finds(text: Column, patterns: dict[str, str]) -> Column:
    """The names of the patterns that a text matches, in the order given."""
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(name)) for name, p in patterns.items()]))


def plausible_id(provider: Column, value: Column, patterns: dict[str, str]) -> Column:
    """Whether an id has the form its provider's ids have; null for providers without a known form."""
    return F.coalesce(*[F.when(provider == name, F.coalesce(value.rlike(p), F.lit(False))) for name, p in patterns.items()], F.lit(None).cast("boolean"))
