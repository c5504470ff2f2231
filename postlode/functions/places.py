"""Countries and cities from the ways postings write places."""

from __future__ import annotations

from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from postlode.functions.text import ACCENTED, PLAIN, fold

#: A starting dimension; callers pass their own.
COUNTRIES = {"germany": "de", "deutschland": "de", "france": "fr", "spain": "es", "netherlands": "nl", "austria": "at", "switzerland": "ch", "united kingdom": "gb", "united states": "us", "usa": "us", "poland": "pl", "italy": "it"}
#: Codes that the word `europe` stands for.
EUROPE = tuple("ad al at ba be bg ch cy cz de dk ee es fi fr gb gr hr hu ie is it li lt lu lv mc md me mk mt nl no pl pt ro rs se si sk sm ua uk va".split())


@lru_cache(4)
def iso_countries(spark: SparkSession, languages: tuple[str, ...] = ("en", "de")) -> dict[str, str]:
    """Folded names of all countries of ISO 3166 in some languages -> code, from the tables of the Java runtime."""
    locale = spark._jvm.java.util.Locale
    shown = [locale.forLanguageTag(x) for x in languages]
    return {plain(locale("", code).getDisplayCountry(x)): code.lower() for code in locale.getISOCountries() for x in shown} | COUNTRIES


def plain(name: str) -> str:
    """A name as `fold` folds columns."""
    return name.lower().replace("ß", "ss").translate(str.maketrans(ACCENTED, PLAIN))


def _literal(names: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])


def segments(location: Column) -> Column:
    """The parts of a place between commas and semicolons, folded and trimmed."""
    parts = F.transform(F.split(fold(F.coalesce(location, F.lit(""))), "[,;]"), lambda p: F.regexp_replace(F.trim(F.substring_index(p, " | ", 1)), r"\.$", ""))
    return F.filter(parts, lambda p: p != "")


def infer_country(location: Column, country: Column, iso: Column, names: Mapping[str, str] = COUNTRIES) -> Column:
    """The ISO code: a country's name as a whole part of the place beats the given codes, which beat a code at its end.

    Names are sought as the last part, the first, in brackets at a part's end,
    and before ` - `; a name inside a longer word never counts. A code as the
    first of several parts counts as a name; one in the middle never does.
    """
    known, parts = _literal(names), segments(location)
    codes = F.array(*[F.lit(c) for c in sorted(set(names.values()))])
    of = lambda p: F.try_element_at(known, p)
    first_of = lambda xs: F.get(F.filter(xs, lambda x: x.isNotNull()), F.lit(0))
    backwards = F.reverse(parts)
    bracket = first_of(F.transform(backwards, lambda p: of(F.regexp_extract(p, r"\(([^()]+)\)$", 1))))
    dashed = first_of(F.transform(backwards, lambda p: of(F.substring_index(p, " - ", 1))))
    anywhere = first_of(F.transform(parts, of))
    given = lambda c: F.when(F.array_contains(codes, F.lower(F.trim(c))), F.lower(F.trim(c)))
    tail = F.regexp_extract(F.array_join(parts, ","), r"(?:^|,)([a-z]{2})(?:,\d{4,6})?$", 1)
    token = F.when(F.array_contains(codes, tail), tail)
    leading = F.get(parts, F.lit(0))
    lead = F.when((F.size(parts) > 1) & F.array_contains(codes, leading), leading)
    return F.coalesce(of(F.get(backwards, F.lit(0))), of(leading), lead, bracket, dashed, anywhere, given(iso), given(country), token)


def parse_country_spec(spec: str, known: Mapping[str, str] = COUNTRIES) -> frozenset[str] | str:
    """`all`, `remote`, `europe`, or codes between commas; an unknown code is an error."""
    low = spec.strip().lower()
    if low in ("all", "remote"):
        return low
    if low == "europe":
        return frozenset(EUROPE)
    codes = frozenset(x.strip() for x in low.split(",") if x.strip())
    if not codes or codes - set(known.values()) - set(EUROPE):
        raise ValueError(f"unknown country in {spec!r}")
    return codes


def matches_country(iso: Column, remote: Column, spec: frozenset[str] | str) -> Column:
    if spec == "all":
        return F.lit(True)
    if spec == "remote":
        return F.coalesce(remote, F.lit(False))
    return F.coalesce(iso.isin(*sorted(spec)), F.lit(False))


def is_remote(location: Column, remote: Column) -> Column:
    return F.coalesce(remote, F.lit(False)) | F.coalesce(location.rlike(r"(?i)\b(?:remote|home ?office)\b"), F.lit(False))


def city(location: Column, aliases: Mapping[str, str] | None = None) -> Column:
    """The first part without a postal code, by its alias where there is one."""
    first = F.regexp_replace(F.coalesce(F.get(segments(location), F.lit(0)), F.lit("")), r"^\d{4,5}\s+", "")
    return F.coalesce(F.try_element_at(_literal(aliases), first), first) if aliases else first


def country_mismatch(location: Column, iso: Column, cities: Mapping[str, str], targets: tuple[str, ...]) -> Column:
    """The code is a target, but the city is known to lie outside all targets; an unknown city is no evidence."""
    at = F.try_element_at(_literal(cities), city(location))
    return F.coalesce(iso.isin(*targets) & ~at.isin(*targets), F.lit(False))
