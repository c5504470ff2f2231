"""Keys under which the same posting, employer or tenant meets itself in other sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlode.functions import places
from postlode.functions.spans import let
from postlode.functions.text import canonical_url, fold, identity, title_bag

#: German words of titles and what they are in English; callers add their own.
TITLE_WORDS = {"einkauf": "purchasing", "logistik": "logistics", "produktion": "production", "vertrieb": "sales", "finanzen": "finance", "lieferkette": "supply chain", "daten": "data"}
#: Words of a slug that mark a trial tenant.
TRIAL = ("demo", "sandbox", "stage", "staging", "qa", "test", "uat")
#: Words that tell a language; the one with most of them names it.
LANGUAGE_WORDS = {"de": ("der", "die", "das", "und", "fur", "mit", "bei"), "en": ("the", "and", "for", "with", "of", "in"), "fr": ("le", "la", "les", "et", "pour", "avec", "des"), "es": ("el", "los", "las", "y", "para", "con", "del")}
#: UTF-8 read as Latin-1: a leading byte and the bytes that continue it, as characters.
BROKEN = r"[Â-ß][\u0080-¿]|[à-ï][\u0080-¿]{2}|[ð-ô][\u0080-¿]{3}"


def apostrophes(c: Column) -> Column:
    """Typographic apostrophes as plain ones."""
    return F.translate(c, "‘’‛ʼ´", "'''''")


def looks_broken(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(BROKEN)


def repaired(c: Column) -> Column:
    """Text that was decoded as Latin-1 decoded again as UTF-8; text that is right, or beyond Latin-1, stays.

    The repair holds only if decoding loses nothing, that is if encoding it
    again gives the text there was.
    """
    once = F.try_validate_utf8(F.decode(F.encode(c, "ISO-8859-1"), "UTF-8"))
    sound = F.decode(F.encode(once, "UTF-8"), "ISO-8859-1") == c
    within = ~c.rlike(r"[^\u0000-ÿ]")
    return F.when(looks_broken(c) & within & F.coalesce(sound, F.lit(False)), once).otherwise(c)


def language_of(c: Column, words: Mapping[str, Sequence[str]] = LANGUAGE_WORDS) -> Column:
    """The language with the most of its words in a text, the first by code among equals; null without any."""
    found = F.regexp_extract_all(fold(F.coalesce(c, F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    known = lambda w, own: F.size(F.filter(w, lambda x: x.isin(*own)))
    counts = lambda w: F.array_min(F.array(*[F.struct((-known(w, own)).alias("n"), F.lit(code).alias("code")) for code, own in words.items()]))
    return let(let(found, counts), lambda best: F.when(best["n"] < 0, best["code"]))


def translated_bag(title: Column, words: Mapping[str, str] = TITLE_WORDS) -> Column:
    """title_bag with its words in one language; titles meet only if all their words do."""
    known = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    own = F.transform(F.split(title_bag(title), " "), lambda w: F.coalesce(F.try_element_at(known, w), w))
    return F.array_join(F.array_sort(F.array_distinct(F.split(F.array_join(own, " "), " "))), " ")


def city_alias_key(location: Column, aliases: Mapping[str, str]) -> Column:
    """The first part of a place by its alias: one city under its names in two languages."""
    return places.city(location, aliases)


def reference(c: Column) -> Column:
    """A feed's reference number without the marks around it, in capitals; null if nothing is left."""
    return F.nullif(F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s_\-./]", "")), F.lit(""))


def decoded_reference(c: Column) -> Column:
    """The first part of a base-64 reference `number/version`, null where it is none."""
    plain = F.decode(F.try_to_binary(c, F.lit("base64")), "UTF-8")
    return reference(F.when(plain.rlike(r"^[\x20-\x7E]+$"), F.substring_index(plain, "/", 1)))


def company_key(company: Column) -> Column:
    """The words that tell a company apart, as one text."""
    return F.array_join(identity(company), " ")


def same_employer(a: Column, b: Column) -> Column:
    """Whether one company's telling words hold the other's; a name without any is no evidence."""
    x, y = identity(a), identity(b)
    inside = (F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0)
    return (F.size(x) > 0) & (F.size(y) > 0) & inside


def cross_source_key(company: Column, title: Column, location: Column) -> Column:
    """A digest of employer, title and city under which sources meet, null if one is empty."""
    parts = [company_key(company), title_bag(title), places.city(location)]
    whole = F.concat_ws("\x1f", *parts)
    return F.when((parts[0] != "") & (parts[1] != "") & (parts[2] != ""), F.sha2(whole, 256))


def guarded_location(location: Column, source: Column, guards: Mapping[str, str]) -> Column:
    """A source's default place is no place: the placeholder that `guards` names for it becomes null."""
    known = F.create_map(*[F.lit(x) for pair in guards.items() for x in pair])
    return F.when(~F.coalesce(F.lower(F.trim(location)) == F.lower(F.try_element_at(known, source)), F.lit(False)), location)


def host_of(url: Column) -> Column:
    """The host of an address in lower case, without user and port; empty without one."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def under(host: Column, domain: str) -> Column:
    """Whether a host is a domain or below it."""
    return (host == domain) | F.endswith(host, F.lit(f".{domain}"))


@dataclass(frozen=True)
class Board:
    """A kind of board: its domain, where a tenant's slug and a job's id stand in an address, and addresses that are dead."""

    name: str
    domain: str
    slug: str
    job: str = r"/(\d+)(?:[/?#]|$)"
    dead: str = r"(?!)"


def board_of(url: Column, boards: Sequence[Board]) -> Column:
    """The name of the first board whose domain an address lies under, null for others."""
    return F.coalesce(*[F.when(under(host_of(url), b.domain), F.lit(b.name)) for b in boards], F.lit(None).cast("string"))


def slug_of(url: Column, boards: Sequence[Board]) -> Column:
    """The tenant's slug in an address of a known board, null without one."""
    return F.coalesce(*[F.when(under(host_of(url), b.domain), F.nullif(F.lower(F.regexp_extract(url, f"(?i){b.slug}", 1)), F.lit(""))) for b in boards], F.lit(None).cast("string"))


def job_id_of(url: Column, boards: Sequence[Board]) -> Column:
    return F.coalesce(*[F.when(under(host_of(url), b.domain), F.nullif(F.regexp_extract(url, b.job, 1), F.lit(""))) for b in boards], F.lit(None).cast("string"))


def format_status(url: Column, boards: Sequence[Board]) -> Column:
    """legacy_dead for an address of a form that is known to be dead, current for other jobs of a known board, else null."""
    state = lambda b: F.when(url.rlike(b.dead), "legacy_dead").when(url.rlike(b.job), "current")
    return F.coalesce(*[F.when(under(host_of(url), b.domain), state(b)) for b in boards], F.lit(None).cast("string"))


def tenant_key(board: Column, slug_or_url: Column) -> Column:
    """board:slug, or board:address without scheme, www, campaign parameters and closing slashes."""
    address = F.regexp_replace(F.regexp_replace(canonical_url(slug_or_url), r"^[a-z][a-z0-9+.-]*://", ""), r"^www\.", "")
    slug = F.regexp_replace(F.lower(F.trim(slug_or_url)), "/+$", "")
    return F.concat(F.lower(F.coalesce(board, F.lit(""))), F.lit(":"), F.when(F.contains(slug_or_url, F.lit("://")), address).otherwise(slug))


def trial_slug(slug: Column) -> Column:
    """Whether a slug names a trial tenant."""
    parts = F.split(F.lower(F.coalesce(slug, F.lit(""))), "[^a-z0-9]+")
    return F.arrays_overlap(parts, F.array(*map(F.lit, TRIAL)))


def board_verdict(status: Column, jobs: Column, error: Column) -> Column:
    """What an answer of a board means: valid, or why it is not. The names are fixed values."""
    failed = F.coalesce(error, F.lit("")) != ""
    gone = status.isin(404, 410)
    return (
        F.when((status == 0) & failed, "unreachable").when(gone & (jobs > 0), "stale_404_live_api").when(gone, "http_not_found")
        .when(status != 200, "http_error").when(failed | (jobs <= 0), "branded_shell_no_jobs").otherwise("valid")
    )


def unwrapped(url: Column, parameters: Sequence[str] = ("url", "target", "redirect", "dest", "u")) -> Column:
    """The address that a redirecting one carries in a parameter, else the address itself."""
    inner = F.regexp_extract(F.coalesce(url, F.lit("")), rf"(?i)[?&](?:{'|'.join(parameters)})=(https?(?:://|%3A%2F%2F)[^&#]+)", 1)
    return F.when(inner != "", F.try_url_decode(inner)).otherwise(url)
