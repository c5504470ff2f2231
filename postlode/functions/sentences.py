"""The sentences of a text, cut once for all detectors, and the words in them that an answer rests on."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlode.functions.spans import let

#: Their dot ends no sentence.
ABBREVIATIONS = ("ggf", "bzw", "evtl", "inkl", "etc", "z.B", "u.a", "d.h", "e.g", "i.e", "approx", "incl")
EVIDENCE = "struct<at:int,term:string>"


def sentences(text: Column, abbreviations: Sequence[str] = ABBREVIATIONS) -> Column:
    """array<string>: a text cut behind each of . ! ? ; that white space follows; the pieces make up the text, so places can be told. Null has none."""
    short = "|".join(a.replace(".", r"\.") for a in abbreviations)
    guard = rf"(?<!(?:^|[\s(])(?:{short})\.)" if short else ""
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, rf"(?i)(?<=[.!?;]){guard}(?=\s)"))


def evidence(pieces: Column, pattern: str, unless: str | None = None) -> Column:
    """struct<at, term>: the first match of a pattern within a sentence ahead of which, in that sentence, `unless` does not occur; else null.

    `at` counts characters of the text from 0. A condition that holds for the
    first match of a sentence stands ahead of its later ones too, so one match
    a sentence is looked at.
    """
    ahead = lambda x: F.get(F.split(x, pattern, 2), F.lit(0))
    holds = lambda x: x.rlike(pattern) & (~ahead(x).rlike(unless) if unless else F.lit(True))

    def found(i: Column) -> Column:
        piece = F.get(pieces, i - 1)
        at = F.aggregate(F.slice(pieces, F.lit(1), i - 1), F.lit(0), lambda n, x: n + F.length(x)) + F.length(ahead(piece))
        return F.when(i > 0, F.struct(at.cast("int").alias("at"), F.regexp_extract(piece, pattern, 0).alias("term")))

    return let(F.array_position(F.transform(pieces, holds), True).cast("int"), found).cast(EVIDENCE)


def first_evidence(text: Column, ladder: Sequence[tuple[str, str, str | None]], abbreviations: Sequence[str] = ABBREVIATIONS) -> Column:
    """struct<state, at, term>: the first rung (state, pattern, unless) that a text has evidence for, and that evidence; null without.

    Only rungs whose pattern occurs at all are looked at sentence by sentence.
    """
    whole = F.coalesce(text, F.lit(""))

    def named(state: str) -> Callable[[Column], Column]:
        return lambda e: F.when(e.isNotNull(), F.struct(F.lit(state).alias("state"), e["at"].alias("at"), e["term"].alias("term")))

    def searched(pieces: Column) -> Column:
        return F.coalesce(*[let(F.when(whole.rlike(p), evidence(pieces, p, unless)), named(state)) for state, p, unless in ladder])

    return let(sentences(text, abbreviations), searched)


#: Rules of our own; the order is that in which states count.
CONDITIONS = r"(?iU)\bggf\b|\bgegebenenfalls\b|\b(?:wenn|falls|sofern|soweit) (?:vorliegend|vorhanden|erforderlich)\b|\b(?:if|where) (?:applicable|available|present|indicated)\b|\bif you (?:have|hold|possess)\b"
WORK_AUTHORIZATION = (
    ("no_sponsorship", r"(?iU)\b(?:no|not|cannot|can't|unable to|kein\w*)\b[^.;!?]{0,60}?\b(?:sponsor\w*|visa|visum)", None),
    ("support", r"(?iU)\b(?:offer|provide|support|help|assist|unterstütz)\w*\b[^.;!?]{0,60}?\b(?:visa|visum|sponsor\w*|work permit|relocation)\b", None),
    ("existing_required", r"(?iU)\b(?:valid|existing|already have|gültige[nrms]?|vorhandene[nrms]?)\b[^.;!?]{0,60}?\b(?:work permit|residence permit|work authori[sz]ation|arbeitserlaubnis|aufenthaltserlaubnis|aufenthaltstitel)\b", CONDITIONS),
    ("unclear", r"(?iU)\b(?:visa|visum|work permit|residence permit|arbeitserlaubnis|aufenthalts\w+|sponsorship)\b", None),
)
AGREEMENT_GATES = (
    ("employer_agreement_only", r"(?i)external\s+agreements?\s+(?:cannot|can't|can not)\s+be\s+accepted", None),
    ("university_signs", r"(?i)agreement[^.\n]{0,80}\bsigned\s+by\s+(?:your|the)\s+(?:university|school)\b", None),
)


def work_authorization_evidence(text: Column) -> Column:
    """struct<state, at, term> of what a text says of permits and sponsorship: a permit asked for under a condition is not required."""
    return first_evidence(text, WORK_AUTHORIZATION)


def agreement_gate(text: Column) -> Column:
    """struct<state, at, term>: an agreement that somebody else has to sign before an internship; the posting stays eligible."""
    return first_evidence(text, AGREEMENT_GATES)


def needs_recheck(status: Column, checked: Column, now: Column, hours: int = 24) -> Column:
    """Whether a liveness verdict is too old to rely on: unknown, never checked, or longer ago than so many hours."""
    known = F.lower(F.trim(F.coalesce(status, F.lit("")))) != "unknown"
    return ~(known & F.coalesce(now - checked <= F.make_dt_interval(hours=F.lit(hours)), F.lit(False)))
