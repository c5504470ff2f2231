"""Facts in free text: levels of a language, deadlines, durations, work modes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlode.functions.spans import after, around, let, spans
from postlode.functions.text import marked

DATE = r"(\d{1,2}\.\d{1,2}\.\d{4}|\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4})"
#: The stronger demand first.
QUALIFIERS = {
    "fluent": r"\b(?:native|mother tongue|fluent|fließend|verhandlungssicher|c1|c2)\b",
    "good": r"\b(?:good|gute|advanced|b2)\b",
    "basic": r"\b(?:basic|grundkenntnisse|a1|a2|b1)\b",
}
SOFT = r"\b(?:plus|advantage|nice to have|von vorteil|wünschenswert)\b"


def language_level(text: Column, language: str = r"\b(?:german|deutsch)\w*", ahead: int = 45, behind: int = 25, qualifiers: dict[str, str] | None = None, soft: str = SOFT) -> Column:
    """struct(level, reason): the strongest demand in a window around any mention of a language, null without a mention.

    A qualifier counts within `ahead` characters before a mention and `behind`
    after it; a demand that the text right behind calls welcome is `optional`.
    """
    strong = list((qualifiers or QUALIFIERS).items())
    names = [n for n, _ in strong] + ["mentioned", "optional"]

    def ranked(s: Column) -> Column:
        window = around(text, s, ahead, behind)
        found = F.coalesce(*[F.when(window.rlike(f"(?i){p}"), F.lit(i)) for i, (_, p) in enumerate(strong)], F.lit(len(strong)))
        rank = F.when(after(text, s, 2 * behind).rlike(f"(?i){soft}"), len(strong) + 1).otherwise(found)
        return F.struct(rank.alias("rank"), s["at"].alias("at"), window.alias("reason"))

    best = let(F.array_min(F.transform(spans(text, f"(?iU){language}"), ranked)), lambda b: F.when(b.isNotNull(), F.struct(F.get(F.array(*map(F.lit, names)), b["rank"]).alias("level"), b["reason"].alias("reason"))))
    return F.when(text.isNotNull(), best)


DEADLINE = r"(?i)(?:deadline|apply by|bewerbungsfrist|bis zum)[^\d]{0,40}"


def deadline(text: Column, marker: str = DEADLINE) -> Column:
    """The date that follows a deadline marker, null without one."""
    found = F.regexp_extract(text, marker + DATE, 1)
    raw = F.when(marked(text, ("deadline", "apply by", "bewerbungsfrist", "bis zum")), found) if marker == DEADLINE else found
    return let(raw, lambda r: F.when(r != "", F.coalesce(F.try_to_date(r, "d.M.yyyy"), F.try_to_date(r, "yyyy-MM-dd"), F.try_to_date(r, "d/M/yyyy"))))


def duration_months(text: Column) -> Column:
    """The smaller number of a duration in months."""
    return F.regexp_extract(text, r"(?i)(\d{1,2})\s*(?:(?:-|–|to|bis)\s*\d{1,2}\s*)?(?:months?|monate?n?)\b", 1).try_cast("int")


def deadline_kind(employer: Column, text: Column, platform: Column) -> Column:
    return F.when(employer.isNotNull(), "employer").when(deadline(text).isNotNull(), "textual").when(platform.isNotNull(), "platform").otherwise("none")


def deadline_date(employer: Column, text: Column, platform: Column) -> Column:
    """The date of the deadline that deadline_kind names."""
    return F.coalesce(employer, deadline(text), platform)


def days_until(due: Column, today: Column) -> Column:
    return F.datediff(due, today)


def reference_day(collected_at: Column) -> Column:
    """The day of a run, as an aggregate: that of its newest row."""
    return F.to_date(F.max(collected_at))


def urgency(days_left: Column) -> Column:
    return F.when(days_left < 0, "past").when(days_left <= 7, "red").when(days_left <= 21, "yellow").when(days_left.isNotNull(), "green")


def work_mode(remote: Column, text: Column) -> Column:
    return F.when(text.rlike(r"(?i)\bhybrid\b"), "hybrid").when(F.coalesce(remote, F.lit(False)) | text.rlike(r"(?i)\b(?:remote|home ?office)\b"), "remote").otherwise("on_site")
