"""The ladder of reasons why a posting does not suit: twenty reasons in order, the first that applies names it.

Detectors look at sentences or at windows around mentions, and say nothing of
texts that they do not understand. The rules are data: callers pass their own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlode.functions import requirements as req
from postlode.functions.requirements import has, in_a_sentence
from postlode.functions.spans import after, around, spans
from postlode.rules import Reason

#: The reasons in their order, and those that remove a posting for good.
REASONS = (
    "german_required", "native_language", "visa_blocked", "thesis_title", "werkstudent_puro", "master_required", "eu_citizenship_required",
    "nl_enrolment_required", "de_enrolment_required", "eu_enrolment_required", "phd_position", "duration_over_6m", "duration_conflict",
    "full_time_permanent", "job_type_non_internship", "erasmus_program", "spontaneous_pool", "experience_required", "recent_graduate", "stale_posting",
)
HARD = ("german_required", "job_type_non_internship", "experience_required", "native_language", "duration_conflict", "recent_graduate")
#: Titles of programmes and of kinds of work that are no student roles.
PROGRAMMES = req.PROGRAMMES
TYPES = ("freelance", "volunteer", "ehrenamt", "minijob", "aushilfe", "schulpraktikum", "zivildienst", "au pair")
ERASMUS = r"(?iU)\berasmus\+?"
POOL = r"(?iU)\b(?:spontaneous|speculative|unsolicited|open|initiative) application\b|\binitiativ(?:e|bewerbung|stelle)?\b|\bspontanbewerbung\b|\btalent (?:pool|community)\b|\bcandidature spontanée\b"
INTERN = r"(?iU)\b(?:internships?|praktikum|praktikums|stage)\b"
GERMAN, FRENCH, DUTCH = r"\b(?:german|deutsch\w*)", r"\b(?:french|französisch\w*|français)", r"\b(?:dutch|niederländisch\w*|nederlands)"
#: What a demand for a language sounds like within 45 characters ahead of it and 25 behind; the first that fits decides.
NEGATED = r"\b(?:not required|no|not necessary|nicht erforderlich|keine?)\b"
WISHED = r"\b(?:preferred|plus|advantage|nice to have|beneficial|bonus|von vorteil|wünschenswert|ideally|idealerweise)\b"
DEMANDED = r"\b(?:required|must|mandatory|fluent|fluency|fließend\w*|verhandlungssicher\w*|very good|sehr gute?|excellent|proficient|native|c1|c2|b2|erforderlich|zwingend|gute)\b"
LEVELS = ("required", "preferred", "plus", "none")


def language_demand(text: Column, language: str = GERMAN) -> Column:
    """required, preferred, plus or none: the strongest over all mentions of a language, null without a mention."""
    t = F.lower(F.coalesce(text, F.lit("")))

    def one(s: Column) -> Column:
        w = around(t, s, 45, 25)
        # a wish just behind the mention is about it, whatever is said ahead
        return F.when(w.rlike(NEGATED), 3).when(after(t, s, 50).rlike(WISHED), 1).when(w.rlike(DEMANDED), 0).when(w.rlike(WISHED), 1).otherwise(2)

    strongest = F.array_min(F.transform(spans(t, language), one))
    return F.get(F.array(*map(F.lit, LEVELS)), strongest)


def mentions_english(text: Column) -> Column:
    return has(text, r"(?i)\b(?:english|englisch\w*|anglais|inglés)\b")


def mentions_german(text: Column) -> Column:
    return has(text, f"(?i){GERMAN}")


def enrolled_in(description: Column, where: str) -> Column:
    """Asks for enrolment at universities of a place; work in that place is no enrolment."""
    school = r"(?:universit\w+|hochschule\w*|hbo|college)"
    near = rf"(?iU)\b(?:enrol+ed|immatrikuliert|enrol+ment|studium|stud(?:ying|ies))\b.*\b(?:{where})\b.*{school}|\b(?:enrol+ed|immatrikuliert|enrol+ment|studium|stud(?:ying|ies))\b.*{school}.*\b(?:{where})\b"
    return in_a_sentence(description, near, r"(?iU)\bduale\b")


def erasmus_programme(title: Column) -> Column:
    return has(title, ERASMUS)


def spontaneous_pool(title: Column) -> Column:
    return has(title, POOL)


def duration_conflict(description: Column, most: int = 6) -> Column:
    """A sentence about the internship says that it lasts longer; a range that begins within the limit does not, nor does `within 12 months`."""
    months = r"(?iU)\b(\d{1,2})\s*[- ]?(?:months?|monate?n?|monatig\w*)\b"
    years = r"(?iU)\b(?:1|one)[- ]year\b"
    ranged = r"(?iU)\b\d{1,2}\s*(?:-|–|to|bis)\s*\d{1,2}\s*(?:months?|monate?n?)|\bwithin\b"
    over = lambda s: (F.coalesce(F.regexp_extract(s, months, 1).try_cast("int") > most, F.lit(False)) | s.rlike(years)) & ~s.rlike(ranged)
    return F.exists(req.sentences(description), lambda s: s.rlike(INTERN) & over(s))


def full_time_permanent(title: Column, description: Column, employment_type: Column) -> Column:
    """Stated as full time, and no mark of student work in title or description."""
    full = F.replace(F.upper(F.trim(F.coalesce(employment_type, F.lit("")))), F.lit("-"), F.lit("_")) == "FULL_TIME"
    return full & ~has(title, req.STUDENT) & ~has(description, req.STUDENT)


def other_job_type(title: Column, description: Column) -> Column:
    """The kind of a job that is no internship, null for one; a title that names an internship too is one."""
    return F.when(~has(title, INTERN), req.job_type(title, description))


def excluded_type(title: Column, programmes: tuple[str, ...] = PROGRAMMES, types: tuple[str, ...] = TYPES) -> Column:
    """Whether a title names a programme or a kind of work that is never a student role."""
    return has(title, r"(?iU)\b(?:" + "|".join(programmes + types) + r")\b")


def ladder(reference: Column, policy: Column | None = None, months: float = 12) -> list[Reason]:
    """The reasons over columns title, description, employment_type and posted_at. policy: an employer's stated visa policy."""
    t, d, e = F.col("title"), F.col("description"), F.col("employment_type")
    text = F.concat_ws(" ", t, d)
    blocked = req.requires_permit(d) if policy is None else req.requires_permit(d) | (policy == "candidate_must_have_authorization")
    applies: Mapping[str, Column] = {
        "german_required": language_demand(text) == "required",
        "native_language": req.requires_native(d),
        "visa_blocked": blocked,
        "thesis_title": req.is_thesis(t),
        "werkstudent_puro": req.is_only_working_student(t),
        "master_required": req.requires_master(t, d),
        "eu_citizenship_required": req.requires_citizenship(d),
        "nl_enrolment_required": enrolled_in(d, r"dutch|netherlands"),
        "de_enrolment_required": enrolled_in(d, r"german|germany|deutsch\w*"),
        "eu_enrolment_required": enrolled_in(d, r"eu|european"),
        "phd_position": req.requires_phd(t, d),
        "duration_over_6m": req.longer_than(t),
        "duration_conflict": duration_conflict(d),
        "full_time_permanent": full_time_permanent(t, d, e),
        "job_type_non_internship": other_job_type(t, d).isNotNull(),
        "erasmus_program": erasmus_programme(t),
        "spontaneous_pool": spontaneous_pool(t),
        "experience_required": req.requires_experience(d),
        "recent_graduate": req.targets_graduates(d),
        "stale_posting": F.datediff(reference, F.col("posted_at")) / 30.44 > months,
    }
    return [Reason(name, applies[name], name in HARD) for name in REASONS]


def candidate_fit() -> Column:
    """array<struct<key, kind, detail>> of what speaks for an application; kinds are ok, warn and info."""
    t, d = F.col("title"), F.coalesce("description", F.lit(""))
    text, none = F.concat_ws(" ", t, d), F.lit(None).cast("string")
    german, permit = language_demand(text), req.work_authorization(text)
    sign = lambda key, kind, detail=none: F.struct(F.lit(key).alias("key"), kind.alias("kind"), detail.alias("detail"))
    ok = lambda condition, other: F.when(F.coalesce(condition, F.lit(False)), "ok").otherwise(other)
    kind = req.student_type(t, d, F.col("employment_type"))["type"]
    permit_kind = F.when(permit.isin("existing_required", "no_sponsorship", "unclear"), "warn").when(permit == "support", "ok").otherwise("info")
    return F.array_compact(F.array(
        sign("germany", ok(F.lower("country_iso") == "de", "info")),
        sign("student_type", ok(has(t, req.STUDENT), "info"), F.col("employment_type")),
        sign("english", ok(mentions_english(text), "info")),
        sign("location_known", ok(F.trim("location") != "", "warn")),
        sign("description_known", ok(F.trim(d) != "", "info")),
        F.when(german.isNotNull() & (german != "none"), sign("german", F.when(german == "required", "warn").otherwise("info"), german)),
        sign("work_auth", permit_kind, permit),
        F.when(kind.isNotNull() & (kind != "internship"), sign("student_subtype", F.lit("info"), kind)),
    ))


def possible_problems(today: Column, kind: Column, due: Column) -> Column:
    """array<struct<key, severity>> of what stands against an application; kind and due: of its deadline."""
    t, d = F.col("title"), F.coalesce("description", F.lit(""))
    text = F.concat_ws(" ", t, d)
    german, permit, left = language_demand(text), req.work_authorization(text), F.datediff(due, today)
    found = lambda condition, key, severity: F.when(condition, F.struct(F.lit(key).alias("key"), F.lit(severity).alias("severity")))
    own = kind.isin("employer", "textual")
    return F.array_compact(F.array(
        found(german == "required", "german_required", "hard"), found(german == "preferred", "german_preferred", "soft"),
        found(permit == "existing_required", "wa_existing", "hard"), found(permit == "no_sponsorship", "wa_no_sponsorship", "hard"), found(permit == "unclear", "wa_unclear", "soft"),
        found(own & (left <= 2), "deadline", "hard"), found(own & (left > 2), "deadline", "soft"),
        found((kind == "platform") & (left < 0), "sf_validity_passed", "hard"),
        found(has(t, req.SENIOR) & ~has(t, req.STUDENT), "senior_title", "hard"),
    ))


def quality_flags(today: Column, kind: Column) -> Column:
    """Names of what a posting's data lack: array<string>."""
    d = F.trim(F.coalesce("description", F.lit("")))
    text = F.concat_ws(" ", "title", d)
    flag = lambda condition, key: F.when(condition, F.lit(key))
    return F.array_compact(F.array(
        flag(kind == "none", "no_deadline"), flag(kind == "platform", "platform_validity"), flag(kind == "textual", "deadline_textual"),
        flag(F.trim(F.coalesce("location", F.lit(""))) == "", "no_location"), flag(F.length(d) < 200, "short_description"),
        flag(~mentions_english(text) & ~mentions_german(text), "no_language"), flag(F.datediff(today, F.col("posted_at")) > 60, "old_posting"),
    ))


def readiness(problems: Column) -> Column:
    """ready without any problem, else verify."""
    return F.when(F.size(problems) == 0, "ready").otherwise("verify")


def ambiguous_job_type(title: Column) -> Column:
    """A title that names both an internship and a working student's job."""
    return has(title, INTERN) & has(title, req.SUBTYPES["working_student"])
