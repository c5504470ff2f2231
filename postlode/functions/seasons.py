"""When a posting starts and ends: semesters, ranges of months, single starts, and starts at once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlode.functions.spans import after, around, let, spans
from postlode.rules import any_word

#: Names of months by their number; longer names come first in patterns.
MONTHS = {
    1: "january januar jan", 2: "february februar feb", 3: "march märz maerz mar", 4: "april apr", 5: "may mai", 6: "june juni jun",
    7: "july juli jul", 8: "august aug", 9: "september sept sep", 10: "october oktober oct okt", 11: "november nov", 12: "december dezember dec dez",
}
NAMES = {name: n for n, names in MONTHS.items() for name in names.split()}
MONTH = "(?:" + "|".join(sorted(NAMES, key=lambda n: (-len(n), n))) + r")\.?"
#: A wise person is no semester: that abbreviation needs its year.
SEMESTER = r"\b(?:(?:sommersemester|summer semester|sose|wintersemester|winter semester)(?:\s+(?:20)?\d{2}(?:\s*/\s*(?:20)?\d{2})?)?|wise\s+(?:20)?\d{2}(?:\s*/\s*(?:20)?\d{2})?)\b"
RANGE = rf"\b{MONTH}(?:\s+20\d\d)?\s*(?:-|–|to|bis|until)\s*{MONTH}\s+20\d\d\b"
OPENING = r"\b(?:ab|from|starting|start(?:ing)?(?: in| date)?|beginn\w*|as of)\s*:?\s+"
START = rf"{OPENING}(?:(?:\d{{1,2}}\.?\s+)?{MONTH}\s+20\d\d|\d{{1,2}}\.\d{{1,2}}\.20\d\d|20\d\d-\d\d)\b"
AMBIGUOUS = rf"{OPENING}{MONTH}(?![a-z])(?!\s+20\d\d)"
IMMEDIATE = r"\b(?:ab sofort|sofort|immediately|asap)\b"
#: Words by which a start at once is about a job: what is offered, and when and how long. A brand that "startet sofort durch" is none.
START_WORDS = ("arbeitsbeginn", "available", "beginn", "eintritt", "eintrittsdatum", "internship", "job", "laufzeit", "monat", "monate", "monaten", "month", "months", "opening", "position", "praktikum", "role", "start", "startdatum", "startet am", "stelle", "vacancy", "verfügbar", "weeks", "werkstudent", "wochen")
CONTEXT = "(?U)" + any_word(START_WORDS)
#: Kinds of hits, the one that says most first.
KINDS = ("semester", "range", "start", "ambiguous_start", "immediate")
HIT = "array<struct<rank:int,at:int,kind:string,term:string,start:string,end:string,context:boolean>>"


def _month(c: Column) -> Column:
    """The number of the month that a text begins with."""
    known = F.create_map(*[F.lit(x) for name, n in NAMES.items() for x in (name, n)])
    return F.try_element_at(known, F.regexp_extract(c, rf"({MONTH.removesuffix(chr(92) + '.?')})", 1))


def _of(year: Column, month: Column) -> Column:
    """yyyy-MM; months beyond the year run over."""
    index = year * 12 + month - 1
    return F.when(month.isNotNull(), F.format_string("%04d-%02d", F.floor(index / 12), F.pmod(index, F.lit(12)) + 1))


def _number(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(c, pattern, group).try_cast("int")


def _hit(kind: str, span: Column, start: Column, end: Column, context: Column | None = None) -> Column:
    none = F.lit(None).cast("boolean")
    return F.struct(F.lit(KINDS.index(kind)).alias("rank"), span["at"].alias("at"), F.lit(kind).alias("kind"), span["term"].alias("term"), start.alias("start"), end.alias("end"), (none if context is None else context).alias("context"))


def _semester(s: Column) -> Column:
    year = _number(s["term"], r"(?:20)?(\d{2})(?:\s*/|$)") + 2000
    summer = s["term"].rlike("^(?:so|su)")
    month = F.when(summer, 4).otherwise(10)
    return _hit("semester", s, _of(year, F.when(year.isNotNull(), month)), _of(year, F.when(year.isNotNull(), month + 5)))


def _range(s: Column) -> Column:
    second = F.regexp_extract(s["term"], r"(?:-|–|\bto|\bbis|\buntil)\s*(.*)$", 1)
    first, last = _month(s["term"]), _month(second)
    named, stated = _number(s["term"], rf"^{MONTH}\s+(20\d\d)"), _number(second, r"(20\d\d)")
    # one year stands for the first month; the last one may be of the next
    begins = F.coalesce(named, stated)
    ends = F.when(named.isNotNull(), stated).otherwise(stated + F.when(last < first, 1).otherwise(0))
    return _hit("range", s, _of(begins, first), _of(ends, last))


def _start(text: Column, s: Column) -> Column:
    date = F.regexp_replace(s["term"], f"^{OPENING}", "")
    year = _number(date, r"(20\d\d)")
    month = F.coalesce(_month(date), _number(date, r"^\d{1,2}\.(\d{1,2})\."), _number(date, r"^20\d\d-(\d\d)"))
    months = _number(after(text, s, 80), r"\b(?:für|for)\s+(\d{1,2})\s+(?:monate?n?|months?)\b")
    month = F.when(month.between(1, 12), month)
    return _hit("start", s, _of(year, month), F.when(months.isNotNull(), _of(year, month + months - 1)))


def season_hits(text: Column) -> Column:
    """All hits of a text, by kind and then by place: (rank, at, kind, term, start, end, context).

    start and end are yyyy-MM. A start with a duration behind it has an end.
    context tells whether words about a start are near a start at once.
    """
    return let(F.lower(F.coalesce(text, F.lit(""))), _hits)


def _hits(t: Column) -> Column:
    none = F.lit(None).cast("string")
    near = lambda s: around(t, s, 60, 60).rlike(CONTEXT)
    found = F.concat(
        F.transform(spans(t, SEMESTER), _semester), F.transform(spans(t, RANGE), _range),
        F.filter(F.transform(spans(t, START), lambda s: _start(t, s)), lambda h: h["start"].isNotNull()),
        F.transform(spans(t, AMBIGUOUS), lambda s: _hit("ambiguous_start", s, none, none)),
        F.transform(spans(t, IMMEDIATE), lambda s: _hit("immediate", s, none, none, near(s))),
    )
    return F.array_sort(found.cast(HIT))


def window_text(title: Column, description: Column) -> Column:
    """What is searched for a start: title and description as one text."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" — "), F.coalesce(description, F.lit("")))


def season(hits: Column) -> Column:
    """The hit that counts: the first; of starts at once the first with context, if there is one."""
    def chosen(found: Column) -> Column:
        first = F.get(found, F.lit(0))
        told = F.get(F.filter(found, lambda h: (h["kind"] == "immediate") & h["context"]), F.lit(0))
        return F.when((first["kind"] == "immediate") & ~first["context"], F.coalesce(told, first)).otherwise(first)

    return let(hits, chosen)


def season_label(hit: Column) -> Column:
    """Text that groups hits in a calendar, null without a hit."""
    return let(hit, _label)


def _label(hit: Column) -> Column:
    year = F.substring(hit["start"], 1, 4)
    summer = hit["term"].rlike("^(?:so|su)")
    semester = F.when(year.isNull(), F.when(summer, "SoSe").otherwise("WiSe")).when(summer, F.concat(F.lit("SoSe "), year)).otherwise(F.concat(F.lit("WiSe "), year, F.lit("/"), F.substring(hit["end"], 3, 2)))
    return (
        F.when(hit["kind"] == "semester", semester)
        .when((hit["kind"] == "range") & hit["start"].isNotNull() & hit["end"].isNotNull(), F.concat(hit["start"], F.lit("/"), hit["end"]))
        .when(hit["kind"] == "start", hit["start"])
        .when(hit["kind"] == "ambiguous_start", "month without year")
        .when(hit["kind"] == "immediate", "at once")
    )


def start_conflict(hit: Column, earliest: str, latest: str) -> Column:
    """TOO_EARLY, TOO_LATE or IMMEDIATE against the wanted months (yyyy-MM), else null."""
    told = lambda h: F.when((h["kind"] == "immediate") & h["context"], "IMMEDIATE").when(h["start"] < earliest, "TOO_EARLY").when(h["start"] > latest, "TOO_LATE")
    return let(hit, told)


def start_is_ambiguous(hits: Column) -> Column:
    return F.exists(hits, lambda h: h["kind"] == "ambiguous_start")
