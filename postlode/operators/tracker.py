"""Applications: an append-only log of events, and what follows from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Events that set a status, and days.
STATUS_EVENTS = ("saved", "applied", "interview", "offer", "rejected", "withdrawn")
FOLLOWUP_DAYS, GUARD_DAYS = 10, 30


def event_type(text: Column, explicit: Column) -> Column:
    """The stated type, else what a message's words say."""
    t = F.lower(F.coalesce(text, F.lit("")))
    told = F.when(t.rlike(r"\b(?:offer)\b"), "offer").when(t.rlike(r"\b(?:interview)\b"), "interview").when(t.rlike(r"\b(?:reject\w*|unfortunately|absage)\b"), "rejected").when(t.rlike(r"\b(?:applied|application sent|beworben)\b"), "applied").otherwise("note")
    return F.coalesce(F.lower(F.nullif(F.trim(explicit), F.lit(""))), told)


def append_events(log: DataFrame, fresh: DataFrame) -> DataFrame:
    """log with the events whose message id it does not have yet; of several events of a message the first by time, type and job counts."""
    first = F.min_by(F.struct(*fresh.columns), F.struct("ts", "event_type", "job_id"))
    new = fresh.groupBy("message_id").agg(first.alias("_first")).select("_first.*").join(log.select("message_id"), "message_id", "left_anti")
    return log.unionByName(new.select(*log.columns))


def status(events: DataFrame) -> DataFrame:
    """Each job's last event that sets a status, by time and then by message."""
    setting = F.col("event_type").isin(*STATUS_EVENTS)
    return events.where(setting).groupBy("job_id").agg(F.max_by("event_type", F.struct("ts", "message_id")).alias("status"), F.max("ts").alias("since"), F.count("*").alias("events"))


def followups(events: DataFrame, today: Column, after: int = FOLLOWUP_DAYS) -> DataFrame:
    """Jobs applied for at least so many days ago, of which nothing was heard since."""
    folded = events.groupBy("job_id").agg(F.max(F.when(F.col("event_type") == "applied", F.col("ts"))).alias("applied"), F.max("ts").alias("last"))
    return folded.where((F.col("applied") == F.col("last")) & (F.datediff(today, F.to_date("applied")) >= after)).select("job_id", "applied")


def reminders(shortlist: DataFrame, today: Column, within: int = 7) -> DataFrame:
    left = F.datediff("deadline", today)
    return shortlist.withColumn("days_left", left).where((left >= 0) & (left <= within))


def weekly(events: DataFrame, today: Column, days: int = 7) -> DataFrame:
    """Counts of the last days, the jobs applied for, and the share that was answered."""
    recent = events.where((F.to_date("ts") > F.date_sub(today, days)) & (F.to_date("ts") <= today))
    applied, answered = F.count_distinct(F.when(F.col("event_type") == "applied", F.col("job_id"))), F.count_distinct(F.when(F.col("event_type").isin("interview", "offer", "rejected"), F.col("job_id")))
    return recent.agg(F.count("*").alias("events"), applied.alias("applied"), answered.alias("answered"), F.round(F.when(applied > 0, answered / applied), 4).alias("response_rate"))


def cadence(sent: Column, today: Column) -> Column:
    age = F.datediff(today, sent)
    return F.when(age <= 7, "week").when(age <= 14, "fortnight").when(age <= 28, "month").otherwise("old")


def guards(rejections: DataFrame, today: Column, days: int = GUARD_DAYS) -> DataFrame:
    """Each company's latest rejection, and until when it holds new applications back."""
    until = F.date_add("rejected", days)
    return rejections.groupBy("company").agg(F.max("rejected").alias("rejected")).select("company", "rejected", until.alias("until"), (until >= today).alias("active"))


def response_status(events: DataFrame, today: Column, days: int = FOLLOWUP_DAYS) -> DataFrame:
    """(job_id, state, waiting): answered, waiting or overdue of each job applied for, and the days since."""
    heard = F.col("event_type").isin("interview", "offer", "rejected")
    folded = events.groupBy("job_id").agg(F.max(F.when(F.col("event_type") == "applied", F.col("ts"))).alias("applied"), F.max(F.when(heard, F.col("ts"))).alias("heard"))
    since = F.datediff(today, F.to_date("applied"))
    state = F.when(F.col("heard") >= F.col("applied"), "answered").when(since >= days, "overdue").otherwise("waiting")
    return folded.where("applied IS NOT NULL").select("job_id", state.alias("state"), since.alias("waiting"))


def feedback(ranking: DataFrame, statuses: DataFrame, bands: Sequence[int] = (10, 30, 100)) -> DataFrame:
    """(band, n, applied, answered) of a ranking (job_id, rank): how far down applications and answers come from."""
    band = F.coalesce(*[F.when(F.col("rank") <= b, F.lit(b)) for b in bands], F.lit(None).cast("int"))
    told = statuses.select("job_id", "status")
    joined = ranking.join(told, "job_id", "left").withColumn("band", band)
    applied, answered = F.col("status").isin("applied", "interview", "offer", "rejected"), F.col("status").isin("interview", "offer", "rejected")
    return joined.groupBy("band").agg(F.count("*").alias("n"), F.count_if(applied).alias("applied"), F.count_if(answered).alias("answered"))


def freshness_bands(days: Column, edges: Sequence[int] = (7, 30, 90, 365)) -> Column:
    """The first of the edges that an age does not pass, null beyond the last or without a date."""
    return F.coalesce(*[F.when(days <= e, F.lit(e)) for e in edges], F.lit(None).cast("int"))


def stated_score(raw: Column) -> Column:
    """A score from 1 to 5 as a reader writes it, with a decimal comma; null for anything else."""
    value = F.replace(F.trim(raw), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(value.between(1, 5), value)


def score_verdict(score: Column) -> Column:
    return F.when(score >= 4, "good").when(score >= 3, "fair").when(score.isNotNull(), "poor")


def markdown_tables(lines: DataFrame, header: str) -> DataFrame:
    """(file, line, cells) of the rows of pipe tables that follow a header line; lines: (file, line, text)."""
    piped = F.trim("text").startswith("|")
    w = Window.partitionBy("file").orderBy("line")
    marked = lines.withColumns({"_piped": piped, "_start": F.when(piped & F.col("text").contains(header), 1).otherwise(0), "_break": F.when(piped, 0).otherwise(1)})
    grouped = marked.withColumns({"_tables": F.sum("_start").over(w), "_breaks": F.sum("_break").over(w)})
    first = Window.partitionBy("file", "_tables").orderBy("line")
    rows = grouped.where("_piped AND _tables > 0 AND _start = 0").withColumn("_b", F.first("_breaks").over(first))
    own = rows.where(F.col("_breaks") == F.col("_b")).where(~F.col("text").rlike(r"^\s*\|[\s:|-]+\|\s*$"))
    cells = F.transform(F.split(F.regexp_replace(F.trim("text"), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    return own.select("file", "line", cells.alias("cells"))
