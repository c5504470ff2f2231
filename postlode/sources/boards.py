"""Field maps of public boards and feeds: what each calls the fields of a posting.

A map takes one item of a landed page, as JSON text or as the HTML of a card,
and gives the columns that readers.posting() makes postings of. Items that
lack a title, an employer or an address are no postings.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.functions.applicability import PROGRAMMES, TYPES
from postlode.functions.places import infer_country
from postlode.functions.requirements import STUDENT, has
from postlode.functions.text import blank_to_null, parse_time
from postlode.sources.readers import html_text, posting

Map = Callable[[Column], Mapping[str, Column]]
#: Fixed values of ISO 3166: three-letter codes of countries around the target ones.
ALPHA_3 = {"deu": "de", "aut": "at", "che": "ch", "nld": "nl", "bel": "be", "lux": "lu", "fra": "fr", "fin": "fi", "esp": "es", "ita": "it", "pol": "pl", "gbr": "gb", "irl": "ie", "usa": "us"}


def get(item: Column, *paths: str) -> Column:
    """The first of some paths that has a value."""
    return F.coalesce(*[blank_to_null(F.get_json_object(item, f"$.{p}")) for p in paths])


def moment(c: Column) -> Column:
    """A time from milliseconds, seconds, or text."""
    number = c.try_cast("long")
    return F.coalesce(F.timestamp_millis(F.when(number > 10**11, number)), F.timestamp_seconds(F.when(number.between(1, 10**11), number)), parse_time(c))


def intern_candidate(title: Column) -> Column:
    """A cheap test before a posting is read: a mark of student work, and no programme or other kind of work."""
    return has(title, STUDENT) & ~has(title, r"(?iU)\b(?:" + "|".join(PROGRAMMES + TYPES) + r")\b")


def federal_agency(item: Column) -> dict[str, Column]:
    """The German federal employment agency: nested addresses, full time as a flag."""
    part = lambda name: get(item, f"stellenlokationen[0].adresse.{name}")
    town = blank_to_null(F.concat_ws(" ", part("plz"), part("ort")))
    place = F.concat_ws(", ", town, F.initcap(part("region")), F.initcap(part("land")))
    reference = get(item, "referenznummer", "refnr")
    return {
        "title": get(item, "stellenangebotsTitel", "titel", "hauptberuf"), "company": F.coalesce(get(item, "firma", "arbeitgeber"), F.lit("Bundesagentur")),
        "url": F.concat(F.lit("https://www.arbeitsagentur.de/jobsuche/jobdetail/"), F.url_encode(reference)), "external_id": reference, "location": place,
        "country_iso": F.when(F.upper(part("land")).isin("DEUTSCHLAND", "DE") | place.rlike(r"(?i)\bgermany\b"), "de"),
        "employment_type": F.when(get(item, "arbeitszeitVollzeit") == "true", "FULL_TIME").otherwise(get(item, "vertragsdauer", "arbeitszeit")),
        "description": html_text(get(item, "stellenangebotsBeschreibung")), "posted_at": moment(get(item, "datumErsteVeroeffentlichung", "aktuelleVeroeffentlichungsdatum")),
    }


def european_portal(item: Column) -> dict[str, Column]:
    """The European mobility portal: countries as keys, descriptions in several languages, times in milliseconds."""
    identity, places = get(item, "id"), F.from_json(F.get_json_object(item, "$.locationMap"), "map<string,array<string>>")
    country = F.get(F.map_keys(places), F.lit(0))
    regions = F.array_join(F.slice(F.coalesce(F.try_element_at(places, country), F.array().cast("array<string>")), 1, 3), ", ")
    told = F.from_json(F.get_json_object(item, "$.translations"), "map<string,struct<description:string>>")
    other = F.get(F.filter(F.transform(F.map_values(told), lambda t: blank_to_null(t["description"])), lambda d: d.isNotNull()), F.lit(0))
    return {
        "title": get(item, "title"), "company": F.coalesce(get(item, "employerName", "employer.name"), F.lit("EURES")), "external_id": identity,
        "url": F.concat(F.lit("https://europa.eu/eures/portal/jv-se/jv-details/"), F.url_encode(identity), F.lit("?lang=en")),
        "location": F.when(regions != "", F.concat(country, F.lit(" ("), regions, F.lit(")"))).otherwise(country), "country_iso": F.when(F.length(country) == 2, F.lower(country)),
        "employment_type": get(item, "positionOfferingCode"), "description": html_text(F.coalesce(get(item, "description"), other)), "posted_at": moment(get(item, "creationDate")),
    }


def arbeitnow(item: Column) -> dict[str, Column]:
    """A German board: the country is the board's, not the text's."""
    slug = get(item, "slug")
    return {
        "title": get(item, "title"), "company": get(item, "company_name"), "url": F.coalesce(get(item, "url"), F.concat(F.lit("https://www.arbeitnow.com/jobs/"), slug)), "external_id": slug,
        "location": get(item, "location"), "country_iso": F.lit("de"), "employment_type": get(item, "job_types[0]"), "description": html_text(get(item, "description")),
        "remote": get(item, "remote") == "true", "posted_at": moment(get(item, "created_at")),
    }


def remoteok(item: Column) -> dict[str, Column]:
    """A remote board: its first item is a legal note, without a position."""
    slug, place = get(item, "slug"), get(item, "location")
    return {
        "title": get(item, "position"), "company": get(item, "company"), "url": F.coalesce(get(item, "url"), F.concat(F.lit("https://remoteok.com/remote-jobs/"), slug)), "external_id": slug,
        "location": place, "country_iso": infer_country(place, F.lit(None).cast("string"), F.lit(None).cast("string")), "description": html_text(get(item, "description")),
        "remote": F.lit(True), "posted_at": moment(get(item, "date")),
    }


def freehire(item: Column) -> dict[str, Column]:
    slug, place, stated = get(item, "public_slug"), get(item, "location"), F.lower(get(item, "countries[0]"))
    return {
        "title": get(item, "title"), "company": get(item, "company"), "url": F.coalesce(get(item, "url"), F.concat(F.lit("https://freehire.me/jobs/"), slug)), "external_id": F.coalesce(slug, get(item, "external_id")),
        "location": place, "country_iso": infer_country(place, F.lit(None).cast("string"), stated), "description": html_text(get(item, "description")), "posted_at": moment(get(item, "posted_at")),
    }


def alpha_2(code: Column) -> Column:
    """The two letters of a country's three, null for countries that are not listed."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in ALPHA_3.items() for x in pair]), F.lower(F.trim(code)))


def amazon(item: Column) -> dict[str, Column]:
    """A company's own board: three-letter countries, paths instead of addresses."""
    return {
        "title": get(item, "title"), "company": F.coalesce(get(item, "company_name"), F.lit("Amazon")), "url": F.concat(F.lit("https://www.amazon.jobs"), get(item, "job_path")),
        "external_id": get(item, "id_icims", "id"), "location": get(item, "normalized_location", "location"), "country_iso": alpha_2(get(item, "country_code")),
        "employment_type": get(item, "job_schedule_type"), "description": html_text(get(item, "description", "description_short")), "posted_at": F.coalesce(moment(get(item, "posted_date")), F.try_to_timestamp(get(item, "posted_date"), F.lit("MMMM d, yyyy"))),
    }


#: Each board's map and where the items of a page are.
JSON_BOARDS: dict[str, tuple[Map, str]] = {
    "direct:bundesagentur": (federal_agency, "$.ergebnisliste"), "direct:eures": (european_portal, "$.jvs"), "arbeitnow": (arbeitnow, "$.data"),
    "remoteok": (remoteok, "$"), "freehire": (freehire, "$.data"), "amazon_jobs": (amazon, "$.jobs"),
}


def json_items(spark: SparkSession, path: str, items: str) -> DataFrame:
    """(item) of the arrays of landed JSON pages, as JSON text."""
    page = spark.read.text(path, wholetext=True)
    return page.select(F.explode(F.from_json(F.get_json_object("value", items), "array<string>")).alias("item"))


def read_board(spark: SparkSession, path: str, source: str) -> DataFrame:
    """The postings of a board's landed pages."""
    fields, items = JSON_BOARDS[source]
    return posting(json_items(spark, path, items), fields(F.col("item")), F.lit(source))


def counted(spark: SparkSession, path: str, source: str) -> DataFrame:
    """(rows, candidates, invalid) of a board's pages: items, those that may be student work, and those of them that are no postings."""
    fields, items = JSON_BOARDS[source]
    made = json_items(spark, path, items).select(*[c.alias(n) for n, c in fields(F.col("item")).items() if n in ("title", "company", "url")])
    candidate = intern_candidate(F.col("title"))
    return made.agg(F.count_if(F.col("title").isNotNull()).alias("rows"), F.count_if(candidate).alias("candidates"), F.count_if(candidate & (F.col("company").isNull() | F.col("url").isNull())).alias("invalid"))


def rss_flavour(title: Column, link: Column, description: Column, published: Column, company: str, flavour: str = "plain", iso: str = "de") -> dict[str, Column]:
    """Columns of a feed's items. The address is the id, since guids carry the time of a cache.

    `titled` feeds end titles with (City, DE, 12345); `country` feeds may have
    a country where the description should be.
    """
    text = html_text(description)
    place = F.lit(None).cast("string")
    if flavour == "titled":
        tail = r"\s*\(([^(),]+,\s*[A-Z]{2},\s*\d{4,5})\)\s*$"
        place, title = F.nullif(F.regexp_extract(title, tail, 1), F.lit("")), F.regexp_replace(title, tail, "")
    if flavour == "country":
        bare = F.lower(F.trim(text)).isin("germany", "deutschland")
        place, text = F.when(bare, "Germany"), F.when(~bare, text)
    return {"title": title, "company": F.lit(company), "url": link, "external_id": blank_to_null(link), "location": place, "country_iso": F.lit(iso), "description": text, "posted_at": parse_time(published)}


def read_feed(spark: SparkSession, path: str, source: str, company: str, flavour: str = "plain") -> DataFrame:
    raw = spark.read.format("xml").option("rowTag", "item").schema("title string, link string, description string, pubDate string").load(path)
    return posting(raw, rss_flavour(F.col("title"), F.col("link"), F.col("description"), F.col("pubDate"), company, flavour), F.lit(source))


def cards(html: Column, card: str) -> Column:
    """The pieces of a listing's HTML that a pattern cuts out, each once."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(f"(?s){card}"), F.lit(0)))


def inner(card: Column, pattern: str) -> Column:
    """The text of a pattern's group in a card."""
    return blank_to_null(html_text(F.regexp_extract(card, f"(?s){pattern}", 1)))


def listing(pages: DataFrame, card: str, fields: Mapping[str, str], source: str, base: str = "", company: str | None = None, last_comma: bool = False) -> DataFrame:
    """Postings from the cards of HTML listings (html): each field is the group of a pattern.

    last_comma: employer and place stand together, parted by the last comma.
    An address without a host is the base's.
    """
    rows = pages.select(F.explode(cards(F.col("html"), card)).alias("card"))
    made = {name: inner(F.col("card"), pattern) for name, pattern in fields.items()}
    if last_comma:
        both = made["company"]
        made |= {"company": F.regexp_extract(both, r"^(.*?)(?:,[^,]*)?$", 1), "location": F.nullif(F.regexp_extract(both, r",([^,]*)$", 1), F.lit(""))}
    made["url"] = F.when(made["url"].rlike("^https?://"), made["url"]).otherwise(F.concat(F.lit(base), made["url"]))
    if company is not None:
        made["company"] = F.coalesce(made.get("company", F.lit(None).cast("string")), F.lit(company))
    if "posted_at" in made:
        made["posted_at"] = parse_time(made["posted_at"])
    return posting(rows, made, F.lit(source)).dropDuplicates(["id"])


def page_numbers(html: Column, pattern: str = r"[?&]page=(\d+)") -> Column:
    """The different page numbers that a listing's pager links to, in order."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(pattern), F.lit(1)), lambda n: n.cast("int"))))


def day_without_year(c: Column, today: Column) -> Column:
    """`October 24` as the latest such day that is not after today."""
    year = F.year(today)
    of = lambda y: F.to_date(F.try_to_timestamp(F.concat(F.trim(c), F.lit(" "), y.cast("string")), F.lit("MMMM d yyyy")))
    return F.when(of(year) <= today, of(year)).otherwise(of(year - 1))


def sitemap_postings(urls: DataFrame, source: str, company: str) -> DataFrame:
    """Postings from addresses alone (loc): the last part of the path is the title."""
    slug = F.regexp_extract("loc", r"([^/]+)/*$", 1)
    return posting(urls, {"title": F.replace(slug, F.lit("-"), F.lit(" ")), "company": F.lit(company), "url": F.col("loc"), "external_id": slug, "country_iso": F.lit("de")}, F.lit(source))


def known_type(name: Column, known: tuple[str, ...]) -> Column:
    """A slice's kind of board if it is one that is known, else null."""
    low = F.lower(F.trim(name))
    return F.when(low.isin(*known), low)
