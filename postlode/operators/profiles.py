"""Further ranking profiles: the same postings, other components, an order of their own.

A profile is data: blocks of patterns with what a title and a description are
worth. Each gives components for scoring.with_score, and never touches the
score of another profile.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlode.functions.text import fold
from postlode.operators import scoring
from postlode.rules import Area, any_word, mentions

#: Weights of the profiles' components.
NUCLEUS, ADJACENT, CONTEXT = (2.5, 1.0), (1.25, 0.5), (0.75, 0.5)
PRIMARY, RELATED, TYPE, COUNTRY, CAPITAL = 3.0, 2.0, 1.0, 1.0, 0.5
OTHER_FUNCTION, OFF_TARGET, CORE, WATCHED = -1.0, -2.5, 1.5, 0.5
SENIOR, MANAGER, FULL_TIME = -3.0, -1.0, -0.5


@dataclass(frozen=True)
class Block:
    """Terms that count each in a title, and once together in a description."""

    terms: Sequence[str]
    in_title: float
    in_description: float

    def in_titles(self, title: Column) -> Column:
        """How many different terms a title has."""
        folded = fold(F.coalesce(title, F.lit("")))
        return sum((folded.rlike(any_word([t])).cast("int") for t in self.terms), F.lit(0))

    def score(self, title: Column, description: Column) -> Column:
        return self.in_titles(title) * F.lit(self.in_title) + F.when(mentions(description, self.terms), self.in_description).otherwise(0.0)


def masked(title: Column, phrases: Sequence[str]) -> Column:
    """A title without names of products, so that words inside them are no terms of an area; longer names go first."""
    for phrase in sorted(phrases, key=len, reverse=True):
        title = F.regexp_replace(title, rf"(?i)\b{phrase}\b", " ")
    return title


def located(country: Column, location: Column, home: str = "de", capital: str = "berlin") -> Column:
    """What the home country and its capital are worth; remote work is neutral."""
    there = F.coalesce(F.lower(location).contains(capital), F.lit(False))
    return F.when(country == home, COUNTRY).otherwise(0.0) + F.when(there, CAPITAL).otherwise(0.0)


def off_target(title: Column, functions: Mapping[str, Sequence[str]], primary: Sequence[str], ungated: Sequence[str] = ()) -> Column:
    """A title of another function costs OFF_TARGET, unless it names the primary area; `ungated` functions cost it even then."""
    hit = lambda names: mentions(title, [t for n in names for t in functions[n]])
    gated = [n for n in functions if n not in ungated]
    return F.when(hit(ungated) | (hit(gated) & ~mentions(title, primary)), OFF_TARGET).otherwise(0.0)


def seniority(title: Column, employment_type: Column, student: Sequence[str], senior: Sequence[str], manager: Sequence[str]) -> Column:
    """Senior and managing titles cost much, unless a mark of student work protects them; full time costs a little."""
    free = ~mentions(title, student)
    full = F.replace(F.lower(F.trim(F.coalesce(employment_type, F.lit("")))), F.lit("-"), F.lit("_")) == "full_time"
    cost = lambda condition, points: F.when(condition, points).otherwise(0.0)
    return cost(free & mentions(title, senior), SENIOR) + cost(free & mentions(title, manager), MANAGER) + cost(full, FULL_TIME)


@dataclass(frozen=True)
class Materials:
    """The second profile: an engineering nucleus, what is next to it, and a context that counts only beside one of them."""

    nucleus: Sequence[str]
    adjacent: Sequence[str]
    context: Sequence[str]
    primary: Sequence[str]
    related: Sequence[str]
    student: Sequence[str]
    other: Sequence[str]
    home: str = "de"
    capital: str = "berlin"

    def components(self) -> dict[str, Column]:
        title, description = F.col("title"), F.col("description")
        nucleus, adjacent = Block(self.nucleus, *NUCLEUS), Block(self.adjacent, *ADJACENT)
        technical = (nucleus.in_titles(title) + adjacent.in_titles(title)) > 0
        when = lambda terms, points: F.when(mentions(title, terms), points).otherwise(0.0)
        return {
            "materials": nucleus.score(title, description),
            "adjacent": adjacent.score(title, description),
            "context": F.when(technical, Block(self.context, *CONTEXT).score(title, description)).otherwise(0.0),
            "area": when(self.primary, PRIMARY) + when(self.related, RELATED),
            "type": when(self.student, TYPE),
            "location": located(F.col("country_iso"), F.col("location"), self.home, self.capital),
            "penalties": when(self.other, OTHER_FUNCTION),
        }


@dataclass(frozen=True)
class Abroad:
    """The third profile: every target country counts alike, and watched employers count a little."""

    area: Area
    skills: Sequence[str]
    core: Sequence[str]
    student: Sequence[str]
    senior: Sequence[str]
    manager: Sequence[str]
    primary: Sequence[str]
    functions: Mapping[str, Sequence[str]]
    targets: Sequence[str]
    watched: Sequence[str]
    ungated: Sequence[str] = ()
    products: Sequence[str] = ()
    language: Callable[[], Column] = field(default=lambda: F.lit(0.0))

    def components(self) -> dict[str, Column]:
        title, description = F.col("title"), F.col("description")
        when = lambda condition, points: F.when(F.coalesce(condition, F.lit(False)), points).otherwise(0.0)
        known = F.lower(F.trim(F.coalesce("company", F.lit("")))).isin(*[w.lower() for w in self.watched])
        return {
            "area": self.area.score(masked(title, self.products), F.lit("")) * 2.0,
            "skills": sum((when(mentions(description, [s]), 1.0) for s in self.skills), F.lit(0.0)),
            "language": self.language(),
            "type": when(mentions(title, self.student), TYPE),
            "location": when(F.col("country_iso").isin(*self.targets), COUNTRY),
            "interest": when(known, WATCHED),
            "penalties": seniority(title, F.col("employment_type"), self.student, self.senior, self.manager),
            "fn": off_target(title, self.functions, self.primary, self.ungated),
            "core": when(mentions(title, self.core), CORE),
        }


def ranked(rows: DataFrame, components: Mapping[str, Column], decay: Column | None, top: int) -> DataFrame:
    """The first rows by a profile's score, in the official order."""
    return scoring.with_score(rows, components, decay).orderBy(*scoring.official_order()).limit(top)


def abroad(rows: DataFrame, home: str = "de") -> DataFrame:
    """Rows whose country is known and not the home country; a remote one without a country is not abroad."""
    return rows.where(F.col("country_iso").isNotNull() & (F.col("country_iso") != home))


def rescored(rows: DataFrame, changed: DataFrame, components: Mapping[str, Column], decay: Column | None = None) -> DataFrame:
    """rows with score and score_breakdown, where those of `changed` (id, description) are scored anew and the others keep theirs."""
    new = rows.join(changed.select("id", F.col("description").alias("_new")), "id")
    new = new.withColumn("description", F.col("_new")).drop("_new", "score", "score_breakdown")
    return rows.join(changed.select("id"), "id", "left_anti").unionByName(scoring.with_score(new, components, decay))


def penalties(rows: DataFrame) -> DataFrame:
    """The parts of each row's score that cost something, the worst first."""
    return scoring.signals(rows).where("value < 0")
