"""What a posting asks of its applicants, from its title and description.

Detectors are columns. Those that depend on a sentence look at sentences one by
one, so that a negation or a wish elsewhere in the text does not reach them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlode.functions.text import fold, marked
from postlode.rules import any_word

STUDENT = r"(?iU)\b(?:praktik(?:um|ant|antin)|werkstudent\w*|working student|intern(?:ship)?s?|stage|stagiaire|trabajo en practicas|tirocinio)\b"
#: Titles of programmes that are no student roles, and of school placements; the callers' own lists may take their place.
PROGRAMMES = ("apprenticeship", "ausbildung", "ausbildungsplatz", "duales studium", "graduate programme", "graduate trainee", "school placement", "schulerpraktikum", "schülerpraktikum", "trainee programme", "traineeprogramm")
PROGRAMME = "(?iU)" + any_word(PROGRAMMES)
SENIOR = r"(?iU)\b(?:senior|lead|head of|director|principal|manager)\b"
STUDENT_TYPES = ("intern", "internship", "working_student")
SUBTYPES = {"working_student": r"(?iU)\b(?:werkstudent\w*|working student)\b", "mandatory_internship": r"(?iU)\b(?:pflichtpraktikum|mandatory internship)\b", "voluntary_internship": r"(?iU)\b(?:freiwilliges praktikum|voluntary internship)\b", "internship": r"(?iU)\b(?:praktik(?:um|ant|antin)|intern(?:ship)?)\b"}
#: Words of which each match of a pattern has one; texts without any are not searched (see text.marked).
STUDENT_MARKS = ("praktik", "student", "intern", "stag", "trabajo en", "tirocinio")
JOB_MARKS = ("hiwi", "student", "thesis", "abschlussarbeit", "permanent", "unbefristet")
VISA_MARKS = ("visa", "sponsor", "relocation", "permit", "erlaubnis")
SPECIFIC = ("working_student", "mandatory_internship", "voluntary_internship")


def has(c: Column, pattern: str, *marks: Iterable[str]) -> Column:
    """Whether a text has a match of a pattern; marks are as in text.marked."""
    found = F.coalesce(c, F.lit("")).rlike(pattern)
    return F.when(marked(c, *marks), found).otherwise(False) if marks else found


def sentences(c: Column) -> Column:
    """Sentences of a text; a full stop inside a number or after a single letter ends none."""
    return F.split(F.coalesce(c, F.lit("")), r"(?<![0-9]|\b[A-Za-z])[.!?]+\s+|\n+|[!?]+")


def in_a_sentence(c: Column, wanted: str, unless: str | None = None, marks: Sequence[Iterable[str]] = ()) -> Column:
    """Some sentence has the one pattern and not the other; a text without the marks of the first is not cut."""
    found = F.exists(sentences(c), lambda s: s.rlike(wanted) & (~s.rlike(unless) if unless else F.lit(True)))
    return F.when(marked(c, *marks), found).otherwise(False) if marks else found


def is_student_role(title: Column, description: Column, employment_type: Column) -> Column:
    """Programmes are never student roles; a marker in the title is one; a marker elsewhere is not for senior titles."""
    kind = F.replace(F.lower(F.trim(F.coalesce(employment_type, F.lit("")))), F.lit("-"), F.lit("_"))
    elsewhere = has(description, STUDENT, STUDENT_MARKS) | kind.isin(*STUDENT_TYPES)
    return F.when(has(title, PROGRAMME), False).when(has(title, STUDENT), True).otherwise(elsewhere & ~has(title, SENIOR))


def _subtype(c: Column) -> Column:
    return F.coalesce(*[F.when(has(c, p), F.lit(n)) for n, p in SUBTYPES.items()])


def student_type(title: Column, description: Column, employment_type: Column) -> Column:
    """struct(type, conflict), null for other roles; two different specific types are unclear, and a conflict."""
    a, b = _subtype(title), _subtype(description)
    clash = F.coalesce(a.isin(*SPECIFIC) & b.isin(*SPECIFIC) & (a != b), F.lit(False))
    chosen = F.when(clash, "unclear").otherwise(F.coalesce(F.when(b.isin(*SPECIFIC), b), F.when(a.isin(*SPECIFIC), a), a, b, F.lit("unclear")))
    return F.when(is_student_role(title, description, employment_type), F.struct(chosen.alias("type"), clash.alias("conflict")))


def is_thesis(title: Column) -> Column:
    return has(title, r"(?iU)\b(?:bachelor|master|diplom)?(?:thesis|arbeit)\b") & has(title, r"(?iU)thesis|bachelorarbeit|masterarbeit|abschlussarbeit|diplomarbeit")


def is_only_working_student(title: Column) -> Column:
    return has(title, SUBTYPES["working_student"]) & ~has(title, SUBTYPES["internship"])


def requires_master(title: Column, description: Column) -> Column:
    """Asks for a master's degree, once phrases that leave the choice are taken out."""
    free = F.regexp_replace(F.concat_ws(". ", title, description), r"(?iU)bachelor(?:'?s)?(?: degree)?\s*(?:/|or|oder)\s*master\w*|scrum master|master data", " ")
    found = has(free, r"(?iU)\bmaster'?s?\b(?: degree| student| studium)|\bmasterstud\w+")
    return F.when(marked(title, ("master",)) | marked(description, ("master",)), found).otherwise(False)


def requires_phd(title: Column, description: Column) -> Column:
    return has(F.concat_ws(". ", title, description), r"(?iU)\b(?:ph\.?\s?d|doctoral|promotion\s?sstudent\w*|doktorand\w*)\b", ("ph", "doctoral", "promotion", "doktorand"))


def requires_citizenship(description: Column) -> Column:
    return in_a_sentence(description, r"(?iU)\b(?:eu|eea|european) (?:citizen\w*|national\w*)\b", r"(?iU)\b(?:non|outside)\b", [("citizen", "national")])


def requires_enrolment(description: Column, where: str = r"german|deutsch\w*|dutch|eu|european") -> Column:
    return in_a_sentence(description, rf"(?iU)\b(?:enrol+ed|immatrikuliert|enrol+ment)\b[^.]*\b(?:{where})\b")


def requires_experience(description: Column, least: int = 1) -> Column:
    """Asks for at least so many years; offers of experience, wishes, and `0-2 years` do not."""
    years = r"(?iU)\b(\d{1,2})\s*(?:\+|(?:-|–|to|bis)\s*\d{1,2})?\s*(?:years?|jahren?)\b[^.]*\b(?:experience|erfahrung)"
    soft = r"(?iU)\b(?:plus|advantage|nice to have|von vorteil|no experience|founded|seit)\b"
    found = F.exists(sentences(description), lambda s: F.coalesce(F.regexp_extract(s, years, 1).try_cast("int") >= least, F.lit(False)) & ~s.rlike(soft))
    return F.when(marked(description, ("experience", "erfahrung"), ("year", "jahre")), found).otherwise(False)


def requires_native(description: Column) -> Column:
    return in_a_sentence(description, r"(?iU)\b(?:native speaker|native level|muttersprach\w+|mother tongue)\b", r"(?iU)\b(?:or|oder|plus|ideally|idealerweise)\b", [("native", "muttersprach", "mother tongue")])


def requires_permit(description: Column) -> Column:
    return in_a_sentence(description, r"(?iU)\b(?:valid|existing|gültige?)\b[^.]*\b(?:work permit|residence permit|arbeitserlaubnis|aufenthaltserlaubnis)\b", r"(?iU)\b(?:if|falls|help|support)\b", [("permit", "erlaubnis")])


def targets_graduates(description: Column, reach: int = 100) -> Column:
    """Speaks of recent graduates, and of no enrolment within reach of it."""
    around = F.regexp_extract_all(F.coalesce(description, F.lit("")), F.lit(rf"(?isU).{{0,{reach}}}\b(?:recent graduates?|absolvent\w*)\b.{{0,{reach}}}"), F.lit(0))
    # the bounded gaps cost much at every place, so only texts with a mention pay for them
    near = (F.size(around) > 0) & ~F.exists(around, lambda a: a.rlike(r"(?iU)enrol|immatrikul"))
    return F.when(has(description, r"(?i)recent graduate|absolvent"), near).otherwise(False)


def longer_than(title: Column, months: int = 6) -> Column:
    return F.coalesce(F.regexp_extract(F.coalesce(title, F.lit("")), r"(?iU)\b(\d{1,2})\s*(?:(?:-|–|to|bis)\s*\d{1,2}\s*)?(?:months?|monate?n?)\b", 1).try_cast("int") > months, F.lit(False))


def job_type(title: Column, description: Column) -> Column:
    """hiwi, working_student, thesis, permanent, or null: the first that the title, or else the description, speaks of."""
    ladder = lambda c: F.when(has(c, r"(?iU)\b(?:hiwi|student assistant|studentische hilfskraft)\b"), "hiwi").when(has(c, SUBTYPES["working_student"]), "working_student").when(has(c, r"(?iU)thesis|abschlussarbeit"), "thesis").when(has(c, r"(?iU)\b(?:permanent|unbefristet\w*)\b"), "permanent")
    return F.coalesce(ladder(title), F.when(~has(title, STUDENT) & marked(description, JOB_MARKS), ladder(description)))


def work_authorization(text: Column) -> Column:
    """One of five states: existing_required, no_sponsorship, support, unclear, no_vocab."""
    return (
        F.when(~marked(text, VISA_MARKS), "no_vocab")
        .when(requires_permit(text), "existing_required")
        .when(in_a_sentence(text, r"(?iU)\b(?:no|not|cannot|unable)\b[^.]*\b(?:sponsor\w*|visa)\b"), "no_sponsorship")
        .when(in_a_sentence(text, r"(?iU)\b(?:offer|provide|support|help)\w*\b[^.]*\b(?:visa|sponsor\w*|relocation)\b"), "support")
        .when(has(text, r"(?iU)\b(?:visa|work permit|sponsor\w*)\b"), "unclear")
        .otherwise("no_vocab")
    )


def work_auth_requirement(text: Column) -> Column:
    state = work_authorization(text)
    right = in_a_sentence(text, r"(?iU)\bright to work\b|\beu only\b")
    return F.when((state == "existing_required") | right, "right_to_work_required").when(state == "support", "sponsorship_offered").otherwise("none_mentioned")


def salary_category(title: Column) -> Column:
    t = fold(F.coalesce(title, F.lit("")))
    return F.when(t.rlike(SUBTYPES["working_student"]), "working_student").when(t.rlike("thesis|abschlussarbeit"), "thesis").when(t.rlike(SUBTYPES["internship"]), "internship").otherwise("other")
