"""Word lists as data, and the columns that apply them.

A rule set is compiled once on the driver into one alternation for each list,
so a filter costs one regular expression whatever the length of its list.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlode.functions.spans import let
from postlode.functions.text import fold


def any_word(terms: Sequence[str]) -> str:
    """A pattern for any of the terms as a whole word of folded text; an empty list matches nothing."""
    return r"\b(?:" + "|".join(map(re.escape, terms)) + r")\b" if terms else r"(?!)"


def folded(c: Column) -> Column:
    return fold(F.coalesce(c, F.lit("")))


def names(text: Column, terms: Sequence[str]) -> Column:
    """Whether a folded text has one of the terms."""
    return text.rlike(any_word(terms)) if terms else F.lit(False)


def mentions(c: Column, terms: Sequence[str]) -> Column:
    return names(folded(c), terms)


@dataclass(frozen=True)
class Area:
    """Terms of an area by strength, with what a mention in the title and in the description is worth."""

    levels: Mapping[str, tuple[Sequence[str], float, float]]
    zeroed: Mapping[str, Sequence[str]] = field(default_factory=dict)
    threshold: float = 1.5

    def score(self, title: Column, description: Column) -> Column:
        """Each level counts once by the title and once by the description.

        A level's terms that `zeroed` lists for a context do not count in
        titles that speak of that context; the level's other terms still do.
        """
        def of_title(text: Column) -> Column:
            total = F.lit(0.0)
            for terms, worth, _ in self.levels.values():
                hit = names(text, [t for t in terms if not any(t in z for z in self.zeroed.values())])
                for context, bound in self.zeroed.items():
                    hit = hit | (names(text, [t for t in terms if t in bound]) & ~names(text, [context]))
                total = total + F.when(hit, worth).otherwise(0.0)
            return total

        def of_description(text: Column) -> Column:
            return sum((F.when(names(text, terms), worth).otherwise(0.0) for terms, _, worth in self.levels.values()), F.lit(0.0))

        # a text is folded once for all levels
        return let(folded(title), of_title) + let(folded(description), of_description)


@dataclass(frozen=True)
class Reason:
    """Why a posting is dropped: the first reason that applies names it."""

    name: str
    applies: Column
    hard: bool = False


def first_reason(reasons: Sequence[Reason]) -> Column:
    """The name of the first reason whose condition is true; a null condition is no evidence."""
    return F.coalesce(*[F.when(r.applies, F.lit(r.name)) for r in reasons], F.lit(None).cast("string"))
