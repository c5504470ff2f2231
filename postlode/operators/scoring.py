"""Scores with a breakdown, and a total order of postings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HALF_LIFE_DAYS, MOST_DAYS = 365.0, 3650.0


def age_days(posted: Column, now: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(posted)) / F.lit(86_400e6)


def freshness(posted: Column, now: Column, half_life: float = HALF_LIFE_DAYS, most: float = MOST_DAYS) -> Column:
    """Halves with every half-life of age; 1 without a date or for a date to come."""
    age = age_days(posted, now)
    return F.when(age.isNull() | (age <= 0), 1.0).otherwise(F.pow(F.lit(0.5), F.least(age, F.lit(most)) / half_life))


def with_score(rows: DataFrame, components: Mapping[str, Column], decay: Column | None = None) -> DataFrame:
    """rows with score and score_breakdown; the parts of a breakdown sum to the score.

    The decay's part is what it takes from the sum of the others.
    """
    parts = {name: F.round(F.coalesce(c, F.lit(0.0)), 2) for name, c in components.items()}
    total = sum(parts.values(), F.lit(0.0))
    if decay is not None:
        parts["decay"] = F.round(F.round(total * decay, 2) - total, 2)
        total = total + parts["decay"]
    breakdown = F.create_map(*[x for name, c in parts.items() for x in (F.lit(name), c)])
    return rows.withColumns({"score": F.round(total, 2), "score_breakdown": breakdown})


def official_order() -> list[Column]:
    return [F.desc("score"), F.lower("title"), F.lower("company"), F.asc("id")]


def top_capped(rows: DataFrame, top: int = 100, per_company: int = 2, company: str = "company") -> DataFrame:
    """The first `top` rows of the official order with at most so many of a company, and their rank.

    The cap is a group limit, which tasks apply before rows move; ranks are
    given to the `top` rows that are left.
    """
    own = Window.partitionBy(company).orderBy(*official_order())
    capped = rows.withColumn("company_rank", F.row_number().over(own)).where(F.col("company_rank") <= per_company)
    first = capped.orderBy(*official_order()).limit(top)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(*official_order())))


def hidden_by_cap(rows: DataFrame, top: int = 100, per_company: int = 2, company: str = "company") -> DataFrame:
    """Rows among the first `top` of all that the cap of a company displaces."""
    first = rows.orderBy(*official_order()).limit(top)
    own = Window.partitionBy(company).orderBy(*official_order())
    return first.withColumn("company_rank", F.row_number().over(own)).where(F.col("company_rank") > per_company)


def signals(rows: DataFrame, id_col: str = "id") -> DataFrame:
    """Non-zero parts of each row's score, the largest first."""
    parts = rows.select(id_col, F.explode("score_breakdown").alias("component", "value")).where("value <> 0")
    own = Window.partitionBy(id_col).orderBy(F.desc(F.abs("value")), "component")
    return parts.withColumn("place", F.row_number().over(own))
