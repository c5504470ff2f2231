"""Column functions over titles, urls, places and token lists."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlode.functions.spans import let

#: Accented letters of the closed alphabet and what they fold to.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"
#: Query parameters that name a campaign, never a page.
TRACKING = ["gclid", "fbclid", "msclkid", "dclid", "twclid", "ttclid", "li_fat_id", "igshid", "mc_cid", "mc_eid", "ref", "referrer", "referer", "source", "spm", "_ga", "_gl", "_hsenc", "_hsmi"]
#: Words of titles that do not tell postings apart.
FUNCTION_WORDS = "a an and or of in on at to for from with your you my our the as by be do it der die das den dem des ein eine einen einem einer und oder im fur von mit bei zu als start starte deine bereich unser werden".split()
#: Rules of our own for gender tags, and for marks of student work that count as one.
GENDER_TAGS = r"\b(?:[mfwd](?:/[mfwd]){1,2}|mwd|x|[mw]/[mw]/div\.?|all genders?|any gender|alle geschlechter)\b"
STUDENT_MARKERS = r"\b(?:werkstudent(?:en?|in)?|praktikant(?:en?|in)?|praktikums?|internships?|interns?)\b"
#: Each match of GENDER_TAGS or STUDENT_MARKERS in a folded title has one of these.
TAG_PARTS = ("/", "x", "mwd", "gender", "geschlechter", "intern", "praktik", "werkstudent")
#: What `$` of a pattern takes for the end of a last line.
LINE_ENDS = ("\n", "\r", "\u0085", "\u2028", "\u2029")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def fold(c: Column) -> Column:
    """Lower case, ß as ss, accents of the closed alphabet dropped."""
    return F.translate(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), ACCENTED, PLAIN)


def marked(c: Column, *marks: Iterable[str]) -> Column:
    """Whether a text has one of each of the marks (ASCII, in lower case) in any case; null has none.

    A plain search, far cheaper than a pattern: what lacks the words that a
    pattern (?i) or (?iU) needs can't match it. The letters are those that
    (?iU) takes for ASCII ones.
    """
    odd, plain = "\u017f\u0131\u0130\u212a", "siik"
    whole = F.coalesce(c, F.lit(""))
    spelt = reduce(Column.__or__, [F.contains(whole, F.lit(x)) for x in odd])
    low = F.lower(F.when(spelt, F.translate(whole, odd, plain)).otherwise(whole))
    return let(low, lambda t: reduce(Column.__and__, [reduce(Column.__or__, [F.contains(t, F.lit(m)) for m in any_of]) for any_of in marks]))


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(fold(F.coalesce(c, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def canonical_url(url: Column) -> Column:
    """Without fragment, campaign parameters and closing slashes, in lower case; null is empty."""
    whole = F.trim(F.coalesce(url, F.lit("")))
    # without a fragment, a query and a line's end there is nothing for the patterns to find but slashes
    plain = ~F.contains(whole, F.lit("#")) & ~F.contains(whole, F.lit("?")) & ~F.right(whole, F.lit(1)).isin(*LINE_ENDS)
    return F.when(plain, F.lower(F.rtrim(whole, F.lit("/")))).otherwise(_without_campaign(whole))


def _without_campaign(url: Column) -> Column:
    u = F.regexp_replace(url, "#.*$", "")
    query = F.regexp_replace(u, r"^[^?]*\??", "")
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).rlike("^utm_") & ~F.lower(F.substring_index(p, "=", 1)).isin(TRACKING))
    base = F.regexp_extract(u, r"^[^?]*", 0)
    whole = F.when(F.size(kept) > 0, F.concat(base, F.lit("?"), F.array_join(kept, "&"))).otherwise(base)
    return F.lower(F.regexp_replace(whole, "/+$", ""))


def title_bag(title: Column) -> Column:
    """The distinct words of a title in order of the alphabet, without gender tags and function words."""
    # the patterns run only on titles that have a part of what they look for
    replaced = lambda t: F.regexp_replace(F.regexp_replace(t, GENDER_TAGS, " "), STUDENT_MARKERS, "working student")
    marked = lambda t: reduce(Column.__or__, [F.contains(t, F.lit(x)) for x in TAG_PARTS])
    plain = let(fold(F.coalesce(title, F.lit(""))), lambda t: F.when(marked(t), replaced(t)).otherwise(t))
    found = F.regexp_extract_all(plain, F.lit("[a-z0-9]+"), F.lit(0))
    return F.array_join(F.sort_array(F.filter(F.array_distinct(found), lambda w: ~w.isin(FUNCTION_WORDS))), " ")


def place_key(location: Column) -> Column:
    """The first part of a place, folded, without a postal code."""
    first = F.substring_index(F.coalesce(location, F.lit("")), ",", 1)
    replaced = lambda f: F.regexp_replace(F.regexp_replace(f, r"^\s*\d{4,5}\s+", ""), r"\s+", " ")
    # without digits and with single spaces alone the patterns change nothing
    return let(fold(first), lambda f: F.trim(F.when((F.translate(f, "0123456789\t\n\x0b\f\r", "") != f) | F.contains(f, F.lit("  ")), replaced(f)).otherwise(f)))


def identity(company: Column, noise: Iterable[str] = ("gmbh", "ag", "se", "inc", "ltd", "co", "kg", "group", "the")) -> Column:
    """The words that tell a company apart, sorted."""
    return F.array_sort(F.filter(F.array_distinct(tokens(company)), lambda w: ~w.isin(list(noise))))


def jaccard(a: Column, b: Column) -> Column:
    """Of two token lists as sets; 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def parse_time(c: Column) -> Column:
    """A timestamp from ISO or RFC 822 text, null where it is neither."""
    day_free = F.regexp_replace(c, r"^\w{3}, ", "")
    return F.coalesce(c.try_cast("timestamp"), F.try_to_timestamp(day_free, F.lit("dd MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(c, F.lit("dd.MM.yyyy")))


def parse_amount(c: Column) -> Column:
    """A number whose last separator is the decimal one if one or two digits follow it."""
    plain = F.regexp_replace(c, r"[^\d.,]", "")
    decimal = plain.rlike(r"[.,]\d{1,2}$")
    whole = F.regexp_replace(F.regexp_replace(plain, r"[.,]\d{1,2}$", ""), "[.,]", "")
    cents = F.regexp_extract(plain, r"[.,](\d{1,2})$", 1)
    return F.when(decimal, F.concat(whole, F.lit("."), cents)).otherwise(F.regexp_replace(plain, "[.,]", "")).try_cast("double")
