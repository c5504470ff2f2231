"""A run from postings to a ranking: filter, exclude, deduplicate, score, rank."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlode.operators import dedup, filters, scoring
from postlode.rules import Reason


@dataclass(frozen=True)
class Plan:
    stages: Sequence[tuple[str, Column]]
    reasons: Sequence[Reason]
    components: Mapping[str, Column]
    decay: Column | None = None
    mirrored: Sequence[tuple[str, str]] = ()
    top: int = 100
    per_company: int = 2
    keep: Sequence[str] = field(default=("id", "title", "company", "source"))

    def funnel(self, postings: DataFrame) -> DataFrame:
        return filters.funnel(postings, [*self.stages, ("eligible", filters.first_reason(self.reasons).isNull())])

    def reasons_of(self, postings: DataFrame) -> DataFrame:
        return filters.with_reason(postings, self.reasons).groupBy("reason").agg(F.count("*").alias("n"))

    def ranking(self, postings: DataFrame) -> DataFrame:
        """The first rows after all stages; postings need `_ord`, their order of arrival."""
        rows = filters.eligible(postings, self.stages, self.reasons)
        rows = dedup.survivors(rows, dedup.cascade(rows, self.mirrored))
        scored = scoring.with_score(rows, self.components, self.decay)
        return scoring.top_capped(scored, self.top, self.per_company).select("rank", *self.keep, "score", "score_breakdown")
