"""Places of a pattern in a text, and the text around them, with built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<at:int,term:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spans(text: Column, pattern: str) -> Column:
    """array<struct<at, term>> of the matches of a pattern, in order; places count characters from 0.

    The pieces between matches tell where the matches are, so the pattern must
    not match the empty string. Null texts have no matches.
    """
    t = F.coalesce(text, F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + F.length(x["gap"])
        found = F.concat(acc["found"], F.array(F.struct(at.alias("at"), x["term"].alias("term"))))
        return F.struct((at + F.length(x["term"])).alias("at"), found.alias("found"))

    def placed(terms: Column) -> Column:
        gaps = F.slice(F.split(t, pattern), F.lit(1), F.size(terms))
        return F.aggregate(F.zip_with(gaps, terms, lambda g, x: F.struct(g.alias("gap"), x.alias("term"))), start, step)["found"]

    return F.when(t.rlike(pattern), let(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), placed)).otherwise(F.array().cast(SPAN))


def before(text: Column, span: Column, most: int) -> Column:
    """At most so many characters ahead of a span."""
    first = F.greatest(span["at"] - most, F.lit(0))
    return F.substring(text, first + 1, span["at"] - first)


def after(text: Column, span: Column, most: int) -> Column:
    return F.substring(text, span["at"] + F.length(span["term"]) + 1, F.lit(most))


def around(text: Column, span: Column, ahead: int, behind: int) -> Column:
    """The span with so many characters on both sides."""
    first = F.greatest(span["at"] - ahead, F.lit(0))
    return F.substring(text, first + 1, span["at"] - first + F.length(span["term"]) + behind)
