"""Postings from landed files: bulk CSV slices with a manifest, feeds, JSON boards, HTML and markdown listings.

Fetching is not part of the library: every reader takes a path that Spark can
open, so that a run can be repeated.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlode.functions.text import blank_to_null, parse_time

POSTING = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "source", "title", "company", "url", "location", "country_iso", "description", "external_id", "employment_type")] + [T.StructField("remote", T.BooleanType()), T.StructField("posted_at", T.TimestampType())])
BULK = "title string, company string, url string, ats_id string, location string, country_iso string, description string, employment_type string, posted_at string"


def posting(rows: DataFrame, columns: Mapping[str, Column], source: Column) -> DataFrame:
    """rows as postings: trimmed, blank to null, without those that lack title, company or url.

    An id is company|source:external id where there is one, else the first 16 digits of the url's SHA-1.
    """
    made = rows.select(*[blank_to_null(columns.get(n, F.lit(None).cast("string")).cast("string")).alias(n) for n in POSTING.names if n not in ("id", "source", "remote", "posted_at")], source.alias("source"), columns.get("remote", F.lit(None)).cast("boolean").alias("remote"), columns.get("posted_at", F.lit(None).cast("timestamp")).alias("posted_at"))
    made = made.where("title IS NOT NULL AND company IS NOT NULL AND url IS NOT NULL")
    own = F.concat("company", F.lit("|"), "source", F.lit(":"), "external_id")
    return made.withColumn("id", F.coalesce(own, F.substring(F.sha1(F.col("url").cast("binary")), 1, 16))).select(*POSTING.names)


def manifest(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """(ats, csv, sha256, rows) of a bulk manifest; a wrong version or no slices fail before any slice is read."""
    raw = spark.read.text(path, wholetext=True)
    found = raw.select(F.get_json_object("value", "$.schema_version").alias("v"), F.from_json(F.get_json_object("value", "$.by_ats"), "map<string,struct<csv:string,sha256:string,rows:bigint>>").alias("m")).first()
    if found is None or not found["m"] or version is not None and found["v"] != version:
        raise ValueError(f"manifest {path} has no slices or not version {version}")
    return spark.createDataFrame([(k, v["csv"], v["sha256"], v["rows"]) for k, v in sorted(found["m"].items())], "ats string, csv string, sha256 string, rows long")


def bulk(spark: SparkSession, paths: list[str], where: Column | None = None, lines: bool = False) -> DataFrame:
    """Rows of CSV slices as postings; the source is bulk:<name of the slice>. `where` is a cheap filter on the raw columns.

    lines: every row is one line, so that many tasks can share a slice; else a
    slice is read by one task, as quoted texts may hold line ends.
    """
    raw = spark.read.csv(paths, schema=BULK, header=True, multiLine=not lines, escape='"')
    raw = raw.where(where) if where is not None else raw
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1)
    return posting(raw, {c: F.col(c) for c in raw.columns} | {"external_id": F.col("ats_id"), "posted_at": parse_time(F.col("posted_at"))}, F.concat(F.lit("bulk:"), name))


def slice_rows(spark: SparkSession, paths: list[str], lines: bool) -> DataFrame:
    """(csv, found_rows) of slices, read by lines or whole."""
    raw = spark.read.csv(paths, schema=BULK, header=True, multiLine=not lines, escape='"')
    return raw.groupBy(F.col("_metadata.file_name").alias("csv")).agg(F.count("*").alias("found_rows"))


def one_line_slices(spark: SparkSession, paths: list[str], expected: DataFrame) -> tuple[list[str], list[str]]:
    """The paths of slices that have their declared rows when read by lines, and the others, for bulk()."""
    found = slice_rows(spark, paths, True).join(expected.select("csv", "rows"), "csv").where("found_rows = rows")
    plain = {r["csv"] for r in found.select("csv").collect()}  # a manifest has few slices
    name = lambda p: p.rsplit("/", 1)[-1]
    return [p for p in paths if name(p) in plain], [p for p in paths if name(p) not in plain]


def slice_errors(spark: SparkSession, paths: list[str], expected: DataFrame, most_bytes: int = 1 << 30) -> DataFrame:
    """Slices of a manifest whose rows or SHA-256 differ from what it declares.

    A digest needs a slice as one value, so slices over most_bytes are held to
    their rows alone; they are not read for it.
    """
    counts = slice_rows(spark, paths, False)
    sums = spark.read.format("binaryFile").load(paths).where(F.col("length") <= most_bytes)
    sums = sums.select(F.regexp_extract("path", "([^/]+)$", 1).alias("csv"), F.sha2("content", 256).alias("found_sha256"))
    joined = expected.join(counts, "csv", "left").join(sums, "csv", "left")
    large = F.col("found_sha256").isNull() & F.col("found_rows").isNotNull()
    return joined.where(~F.col("rows").eqNullSafe(F.col("found_rows")) | ~large & ~F.lower("sha256").eqNullSafe(F.col("found_sha256")))


def rss(spark: SparkSession, path: str, source: str, company: str | None = None) -> DataFrame:
    """Items of RSS feeds as postings."""
    schema = "title string, link string, description string, pubDate string, guid string, company string, location string"
    raw = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)
    named = F.coalesce(F.col("company"), F.lit(company))
    return posting(raw, {"title": F.col("title"), "url": F.col("link"), "description": html_text(F.col("description")), "external_id": F.col("guid"), "company": named, "location": F.col("location"), "posted_at": parse_time(F.col("pubDate"))}, F.lit(source))


def sitemap(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(loc, lastmod) of sitemap entries whose address matches."""
    return spark.read.format("xml").option("rowTag", "url").schema("loc string, lastmod string").load(path).where(F.col("loc").rlike(pattern)).withColumn("lastmod", parse_time(F.col("lastmod")))


def json_board(spark: SparkSession, path: str, items: str, fields: Mapping[str, list[str]], source: str) -> DataFrame:
    """Objects of a JSON page's array as postings; each field takes the first of its paths that has a value."""
    page = spark.read.text(path, wholetext=True).select(F.explode(F.from_json(F.get_json_object("value", items), "array<string>")).alias("item"))
    pick = {name: F.coalesce(*[blank_to_null(F.get_json_object("item", p)) for p in paths]) for name, paths in fields.items()}
    if "posted_at" in pick:
        epoch = F.timestamp_millis(pick["posted_at"].try_cast("long"))
        pick["posted_at"] = F.coalesce(epoch, parse_time(pick["posted_at"]))
    return posting(page, pick, F.lit(source))


def links(html: Column, pattern: str = "") -> Column:
    """array<struct<href, text>> of a page's links whose address matches."""
    raw = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r'(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>'), F.lit(0))
    made = F.transform(raw, lambda a: F.struct(F.regexp_extract(a, r'(?is)href="([^"]*)"', 1).alias("href"), F.trim(F.regexp_replace(a, r"(?s)<[^>]*>", "")).alias("text")))
    return F.filter(made, lambda x: x["href"].rlike(pattern)) if pattern else made


def html_title(html: Column) -> Column:
    return blank_to_null(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1))


def html_text(html: Column) -> Column:
    """Text without scripts, styles, comments and tags; the common entities decoded; spaces collapsed."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style|head)\b.*?</\1\s*>|<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def lenient_json(text: Column) -> Column:
    """A variant of JSON text that may hold raw control characters or backslashes that escape nothing; null if it is still none.

    Sound text is parsed as it is. In the rest, control characters become
    spaces, and a backslash before anything that cannot be escaped goes.
    """
    plain = F.regexp_replace(text, r"[\x00-\x1F]+", " ")
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(F.regexp_replace(plain, r"(\\[\"\\/bfnrt]|\\u[0-9a-fA-F]{4})|\\", "$1")))


def _members(v: Column) -> Column:
    """The objects of a graph or of an array, or the object itself."""
    return F.coalesce(F.try_variant_get(v, "$['@graph']", "array<variant>"), F.try_variant_get(v, "$", "array<variant>"), F.array(v))


def job_ld(html: Column) -> Column:
    """The JobPosting objects among a page's ld+json scripts, in graphs and arrays too, as an array of variants.

    Each script is parsed once; a damaged one is repaired first (see
    lenient_json), and one beyond repair says nothing.
    """
    blocks = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r'(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>'), F.lit(1))
    found = F.flatten(F.transform(F.flatten(F.transform(F.transform(blocks, lenient_json), _members)), _members))
    kind = lambda v: F.coalesce(F.try_variant_get(v, "$['@type']", "array<string>"), F.array(F.try_variant_get(v, "$['@type']", "string")))
    return F.filter(found, lambda v: F.coalesce(F.array_contains(kind(v), "JobPosting"), F.lit(False)))


def job_description(html: Column, least: int = 120) -> Column:
    """The text of the first posting of a page whose description has `least` characters at least, null without one.

    Shorter ones are what boards repeat on every page.
    """
    texts = F.transform(job_ld(html), lambda v: html_text(F.try_variant_get(v, "$.description", "string")))
    return F.get(F.filter(texts, lambda t: F.length(t) >= least), F.lit(0))



def markdown_listing(spark: SparkSession, path: str, source: str, company: str | None = None) -> DataFrame:
    """Linked headings of markdown listings as postings: `## [title](url)` with the company in the line below."""
    text = spark.read.text(path, wholetext=True)
    hits = F.regexp_extract_all("value", F.lit(r"(?m)^#{1,4} \[[^\]]+\]\([^)]+\)[^\n]*(?:\n+[^\n#][^\n]*)?"), F.lit(0))
    rows = text.select(F.explode(hits).alias("h"))
    named = F.coalesce(blank_to_null(F.regexp_extract("h", r"\n+([^\n,|]+)", 1)), F.lit(company))
    return posting(rows, {"title": F.regexp_extract("h", r"\[([^\]]+)\]", 1), "url": F.regexp_extract("h", r"\]\(([^)]+)\)", 1), "company": named, "location": F.regexp_extract("h", r"\n+[^\n,|]+[,|]\s*([^\n]+)", 1)}, F.lit(source))


def union(*parts: DataFrame) -> DataFrame:
    """All postings with their order of arrival in `_ord`: by part, then by id."""
    whole = parts[0].withColumn("_part", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        whole = whole.unionByName(p.withColumn("_part", F.lit(i)), allowMissingColumns=True)
    return whole.withColumn("_ord", F.struct("_part", "id")).drop("_part")
