"""What structured data on an employer's page says about a posting, and whether it speaks of the same one.

Pages give JobPosting objects as variants, parsed once; nothing here changes a
posting, it only states relations: match, conflict, missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlode.functions import places
from postlode.functions.money import period_name
from postlode.functions.spans import let
from postlode.functions.text import blank_to_null, title_bag
from postlode.sources.readers import html_text

#: Types of employment that sources agree on.
TYPES = ("FULL_TIME", "PART_TIME", "CONTRACT", "INTERN", "TEMPORARY")
HYBRID, REMOTE, ON_SITE = r"(?i)\bhybrid\b", r"(?i)\b(?:remote|home ?office)\b", r"(?i)\b(?:on-?site|vor ort|in office)\b"


def _text(post: Column, path: str) -> Column:
    return blank_to_null(F.try_variant_get(post, path, "string"))


def _first(post: Column, path: str) -> Column:
    """The value at a path, or the first of an array that stands there."""
    return F.coalesce(F.try_variant_get(post, f"{path}[0]", "variant"), F.try_variant_get(post, path, "variant"))


def iso_day(c: Column) -> Column:
    """The day of an ISO date or time, null for anything else."""
    return F.substring(F.trim(c), 1, 10).try_cast("date")


def identifier(post: Column) -> Column:
    """A posting's own identifier: the value of an object, its name, or the plain text."""
    plain = _text(post, "$.identifier")
    return F.coalesce(_text(post, "$.identifier.value"), _text(post, "$.identifier.name"), F.when(~plain.startswith("{"), plain))


def salary(post: Column) -> Column:
    """struct(min, max, currency, period), null unless both bounds are above 0; one bound stands for both."""
    number = lambda path: F.try_variant_get(post, path, "string").try_cast("double")
    one = number("$.baseSalary.value")
    low, high = F.coalesce(number("$.baseSalary.value.minValue"), one), F.coalesce(number("$.baseSalary.value.maxValue"), one)
    low, high = F.coalesce(low, high), F.coalesce(high, low)
    made = F.struct(low.alias("min"), high.alias("max"), F.upper(_text(post, "$.baseSalary.currency")).alias("currency"), period_name(_text(post, "$.baseSalary.value.unitText")).alias("period"))
    return F.when((low > 0) & (high > 0), made)


def location(post: Column) -> Column:
    """struct(city, region, postal_code, country, street, telecommute) of the first place, null without an address."""
    return let(_first(post, "$.jobLocation"), _place)


def _place(place: Column) -> Column:
    names = {"addressLocality": "city", "addressRegion": "region", "postalCode": "postal_code", "addressCountry": "country", "streetAddress": "street"}
    parts = F.struct(*[F.coalesce(_text(place, f"$.address.{k}.name"), _text(place, f"$.address.{k}")).alias(v) for k, v in names.items()], F.coalesce(F.lower(F.try_variant_get(place, "$['@type']", "string")).contains("telecommute"), F.lit(False)).alias("telecommute"))
    return let(parts, lambda p: F.when(F.coalesce(*[p[v] for v in names.values()]).isNotNull(), p))


def fields(post: Column) -> Column:
    """A JobPosting's fields, from a variant (see readers.job_ld), as a struct of evidence."""
    return let(post, _fields)


def _fields(post: Column) -> Column:
    return F.struct(
        _text(post, "$.title").alias("title"), iso_day(_text(post, "$.validThrough")).alias("valid_through"), iso_day(_text(post, "$.datePosted")).alias("date_posted"),
        salary(post).alias("salary"), blank_to_null(F.try_variant_get(_first(post, "$.employmentType"), "$", "string")).alias("employment_type"), location(post).alias("location"),
        blank_to_null(html_text(_text(post, "$.description"))).alias("description"), identifier(post).alias("identifier"), _text(post, "$.hiringOrganization.name").alias("organization"),
    )


def _shares_words(a: Column, b: Column) -> Column:
    """The share of a's words that b has; 0 without words."""
    own = F.filter(F.split(title_bag(a), " "), lambda w: w != "")
    return F.when(F.size(own) > 0, F.size(F.array_intersect(own, F.split(title_bag(b), " "))) / F.size(own)).otherwise(0.0)


def speaks_of(found: Column, title: Column, company: Column, external_id: Column, url: Column) -> Column:
    """Whether evidence is about a posting: its id is the posting's or stands in the address, or the titles agree and the employers do not contradict."""
    no, own = F.lit(False), F.lower(F.trim(external_id))
    same_id = F.coalesce((own != "") & (F.lower(found["identifier"]) == own), no)
    in_url = F.coalesce((F.trim(external_id) != "") & F.contains(url, F.trim(external_id)), no)
    alike = F.coalesce(title_bag(found["title"]) == title_bag(title), no) | (_shares_words(title, F.concat_ws(" ", found["title"], found["description"])) >= 0.5)
    theirs, ours = F.lower(F.trim(found["organization"])), F.lower(F.trim(company))
    contrary = F.coalesce((theirs != "") & (ours != "") & ~F.contains(ours, theirs) & ~F.contains(theirs, ours), no)
    return same_id | in_url | (found["title"].isNotNull() & alike & ~contrary)


def contradicts(found: Column, title: Column, external_id: Column) -> Column:
    """Titles without a common word, or an identifier that is not the posting's."""
    a, b = title_bag(found["title"]), title_bag(title)
    apart = F.coalesce((a != "") & (b != "") & ~F.arrays_overlap(F.split(a, " "), F.split(b, " ")), F.lit(False))
    return apart | F.coalesce((F.trim(external_id) != "") & (F.lower(found["identifier"]) != F.lower(F.trim(external_id))), F.lit(False))


def location_relation(found: Column, place: Column, aliases: dict[str, str] | None = None) -> Column:
    """confirmed or conflict of the two cities, null where one is unknown."""
    a, b = F.nullif(places.city(found["location"]["city"], aliases), F.lit("")), F.nullif(places.city(place, aliases), F.lit(""))
    return F.when(a.isNotNull() & b.isNotNull(), F.when(a == b, "confirmed").otherwise("conflict"))


def raw_fields(raw: Column) -> Column:
    """Fields that boards keep beside a posting, from JSON text; blanks are null, and an address to apply at must be http."""
    return let(F.try_parse_json(raw), _raw_fields)


def _raw_fields(raw: Column) -> Column:
    apply = _text(raw, "$.apply_url")
    flag = F.try_variant_get(raw, "$.is_remote", "string")
    return F.struct(
        *[_text(raw, f"$.{n}").alias(n) for n in ("department", "employment_type", "commitment", "requisition_id", "global_id")],
        F.when(apply.rlike("(?i)^https?:"), apply).alias("apply_url"), F.when(flag.isin("true", "false"), flag == "true").alias("is_remote"),
    )


def type_relation(stated: Column, student: Column) -> Column:
    """match, conflict or missing of a stated type and what the rules say: the type tells hours, the rules tell the role."""
    name = F.regexp_replace(F.upper(F.trim(stated)), "[- ]", "_")
    agrees = F.when(name == "INTERN", student).when(name == "PART_TIME", True).otherwise(~student)
    return F.when(name.isin(*TYPES), F.when(agrees, "match").otherwise("conflict")).otherwise("missing")


def remote_relation(flag: Column, text: Column) -> Column:
    """match, conflict or missing of a flag and the words of a text; a text without such words contradicts nothing."""
    says = F.when(text.rlike(HYBRID), "hybrid").when(text.rlike(REMOTE), "remote").when(text.rlike(ON_SITE), "on_site").otherwise("none")
    return F.when(flag.isNull(), "missing").when(flag & (says == "on_site"), "conflict").when(~flag & says.isin("remote", "hybrid"), "conflict").otherwise("match")


def worth_a_look(description: Column, deadline: Column, pay: Column, short: int = 600) -> Column:
    """Whether a page could add something: a short description, no deadline, or no pay."""
    return (F.length(F.trim(F.coalesce(description, F.lit("")))) < short) | deadline.isNull() | pay.isNull()


def priority(description: Column, deadline: Column, pay: Column) -> Column:
    """How many of the three a page could add, for the order of a bounded list."""
    return (F.length(F.trim(F.coalesce(description, F.lit("")))) < 600).cast("int") + deadline.isNull().cast("int") + pay.isNull().cast("int")
