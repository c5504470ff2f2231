"""Order-defined removal of duplicate postings.

Rows arrive in the order of `_ord`. The cascade is a fold: a row that shares a
key with an earlier one merges into it and registers none of its own keys, so
it is not a matter of connected components.

Spark takes rows that an array was exploded into, and files, for smaller than
they are. So joins whose two sides grow with the postings are merge joins by
hint: none of them passes the driver as a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlode.functions.keys import decoded_reference, reference, translated_bag
from postlode.functions.text import canonical_url, identity, place_key, title_bag
from postlode.operators.cascade import fold_apart, shared_keys
from postlode.operators.components import components
from postlode.operators.residents import RANK, bucket_fold, in_ranges, whole_buckets
from postlode.operators.running import running_sums
from postlode.shared import arrow_schema, checkpointed, drop_stored, stored, written

#: The tiers of keys, in order of candidate_keys().
TIERS = ("external_id", "url", "company+title+location", "mirror", "company+title+location+translated", "reference")


def key_parts() -> dict[str, Column]:
    """What takes patterns to compute, and is named several times in keys."""
    return {"_url": canonical_url(F.col("url")), "_bag": title_bag(F.col("title")), "_place": place_key(F.col("location"))}


def key_columns(mirrored: Sequence[tuple[str, str]] = (), words: Mapping[str, str] | None = None, references: Mapping[str, bool] | None = None, made: Mapping[str, Column] | None = None) -> list[tuple[str, Column]]:
    """(tier, key) for each key that a posting can have, the strongest first; null where it has none. made: columns that hold key_parts() already."""
    company, source = F.trim(F.coalesce("company", F.lit(""))), F.trim(F.coalesce("source", F.lit("")))
    url, bag, place = (made or key_parts()).values()
    low = F.lower(company)
    sep = F.lit("\x1f")
    whole = lambda *parts: F.concat(*[x for p in parts for x in (p, sep)])
    listed = F.lit(False)
    for a, b in mirrored:
        listed = listed | source.isin(a, b)
    return [
        ("external_id", F.when(F.col("external_id").isNotNull(), whole(company, source, F.trim("external_id"))).when(F.col("id").isNotNull(), whole(F.col("id").cast("string")))),
        ("url", F.when(url != "", whole(company, url))),
        ("company+title+location", F.when((low != "") & (bag != "") & (place != ""), whole(low, bag, place))),
        *([("mirror", F.when(listed & (low != "") & (bag != ""), whole(low, bag)))] if mirrored else []),
        *([("company+title+location+translated", F.when((low != "") & (place != ""), whole(low, F.nullif(translated_bag(F.col("title"), words), F.lit("")), place)))] if words else []),
        *[("reference", F.when(source == name, whole((decoded_reference if encoded else reference)(F.col("external_id"))))) for name, encoded in (references or {}).items()],
    ]


def _listed(columns: Sequence[tuple[str, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(key.isNotNull(), F.struct(F.lit(tier).alias("tier"), key.alias("key"))) for tier, key in columns]))


def candidate_keys(mirrored: Sequence[tuple[str, str]] = (), words: Mapping[str, str] | None = None, references: Mapping[str, bool] | None = None) -> Column:
    """array<struct<tier, key>> of a posting, the strongest first.

    Keys of title tiers ignore the case of the company, those of ids and urls
    do not; a key counts whatever the tier that gave it. words: a dictionary
    under which titles of two languages meet. references: sources whose ids are
    references that other feeds repeat, and whether theirs are encoded.
    """
    return _listed(key_columns(mirrored, words, references))


def keyed_rows(rows: DataFrame, mirrored: Sequence[tuple[str, str]] = (), **others: Column) -> DataFrame:
    """(_ord, others, a column for each tier of key), written once; each part of a key is computed once a row."""
    parts = key_parts()
    keys = key_columns(mirrored, made={c: F.col(c) for c in parts})
    return stored(rows.withColumns(parts).select("_ord", *[c.alias(n) for n, c in others.items()], *[c.alias(tier) for tier, c in keys]), "keyed")


def _tiers(keyed: DataFrame) -> list[tuple[str, Column]]:
    return [(t, F.col(f"`{t}`")) for t in keyed.columns if t in TIERS]


def flat_keys(keyed: DataFrame) -> DataFrame:
    """(_ord, i, tier, key, digest): a row for each key of keyed_rows(); keys are told apart by hashes of 96 bits, tiers are places in TIERS."""
    rows = [F.struct(F.lit(i).alias("i"), F.lit(TIERS.index(t)).cast("tinyint").alias("tier"), F.xxhash64(key).alias("key"), F.hash(key).alias("digest"), key.isNotNull().alias("_is")) for i, (t, key) in enumerate(_tiers(keyed))]
    return keyed.select("_ord", F.inline(F.array(*rows))).where("_is").drop("_is")


def posted_key(at: Column) -> Column:
    """Text that sorts as dates do, those without one last."""
    return F.coalesce(F.concat(F.lit("0"), at.cast("string")), F.lit("1"))


def prefers(candidate: dict, current: dict) -> bool:
    """Whether a row takes the place of the one it meets. Not an order: two rows can each beat the other."""
    for trait in ("has_description", "has_type"):
        if candidate[trait] and not current[trait]:
            return True
    for trait in ("has_description", "has_type"):
        if candidate[trait] != current[trait]:
            return False
    return candidate["posted_key"] < current["posted_key"]


def fold(rows: list[dict], mirrored: frozenset[frozenset[str]] = frozenset()) -> list[tuple[int, int, str]]:
    """(loser, winner, tier) for rows in order, each with `keys` as (tier, key); winners can lose later."""
    held: dict[str, dict] = {}
    owned: dict[int, set[str]] = {}
    removed = []
    for row in rows:
        met = next(((tier, key) for tier, key in row["keys"] if key in held and (tier != "mirror" or frozenset((row["source"], held[key]["source"])) in mirrored)), None)
        if met is None:
            for _, key in row["keys"]:
                if key in held:
                    owned[held[key]["_ord"]].discard(key)
                held[key] = row
                owned.setdefault(row["_ord"], set()).add(key)
            continue
        winner = held[met[1]]
        if prefers(row, winner):
            keys = owned.pop(winner["_ord"])
            held |= dict.fromkeys(keys, row)
            owned[row["_ord"]] = keys
            row, winner = winner, row
        removed.append((row["_ord"], winner["_ord"], met[0]))
    return removed


def key_edges(keyed: DataFrame) -> DataFrame:
    """(a, b): each row beside the first row of each key that it shares; keyed: as keyed_rows() has it."""
    return shared_keys(flat_keys(keyed)).where("least < _ord").select(F.col("least").alias("a"), F.col("_ord").alias("b"))


def component_sizes(rows: DataFrame, mirrored: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """(size, components): how many rows keys connect, and how often; look at it before a cascade with mirrored sources."""
    with written() as paths:
        keyed = keyed_rows(rows, mirrored)
    found = components(key_edges(keyed))
    drop_stored(rows.sparkSession, paths)
    return found.groupBy("component").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("components"))


def cascade(rows: DataFrame, mirrored: Sequence[tuple[str, str]] = (), most_rounds: int = 50) -> DataFrame:
    """(loser, winner, tier) by `_ord`: what the fold over all rows removes.

    rows: _ord (different numbers), id, external_id, source, company, title,
    location, url, description, employment_type, posted_at. Only rows that
    share a key reach the fold, without their texts. It is done in rounds and
    ranges (see cascade.py), so neither a key nor a component meets in one
    task; only what keys of mirrored sources connect does.
    """
    known = {"has_description": F.coalesce(F.col("description"), F.lit("")) != "", "has_type": F.coalesce(F.col("employment_type"), F.lit("")) != ""}
    with written() as paths:
        keyed = keyed_rows(rows, mirrored, source=F.col("source"), posted_key=posted_key(F.col("posted_at")), **known)
    flat = flat_keys(keyed)
    named = lambda lost: lost.withColumn("tier", F.get(F.array(*map(F.lit, TIERS)), F.col("tier").cast("int")))
    if not mirrored:
        found = named(fold_apart(keyed, flat, most_rounds))
        drop_stored(rows.sparkSession, paths)
        return found
    # whether a mirror key counts depends on who holds it, so what such keys connect is replayed whole
    shared = stored(shared_keys(flat).drop("least"), "shared")
    groups = components(key_edges(keyed))
    bound = shared.where(F.col("tier") == TIERS.index("mirror")).join(groups.hint("merge"), F.col("_ord") == F.col("node")).select("component").distinct()
    groups = checkpointed(groups.join(bound.hint("merge"), "component", "left_semi"))
    free = shared.join(groups.hint("merge"), F.col("_ord") == F.col("node"), "left_anti")
    whole = keyed.select("_ord", "source", "has_description", "has_type", "posted_key", _listed(_tiers(keyed)).alias("keys"))
    return _replayed(whole.join(groups.hint("merge"), F.col("_ord") == F.col("node")).drop("node"), mirrored).unionByName(named(fold_apart(keyed, free, most_rounds)))


def _replayed(grouped: DataFrame, mirrored: Sequence[tuple[str, str]]) -> DataFrame:
    """(loser, winner, tier): the fold of each component, by one task."""
    pairs = frozenset(frozenset(p) for p in mirrored)
    kind = grouped.schema["_ord"].dataType.simpleString()
    schema = f"loser {kind}, winner {kind}, tier string"
    out = arrow_schema(schema)

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by component and order; a component that a batch cuts is carried on."""
        held: list[dict] = []
        for batch in batches:
            removed = []
            for r in batch.to_pylist():
                if held and r["component"] != held[0]["component"]:
                    removed += fold(held, pairs)
                    held = []
                held.append(r | {"keys": [(k["tier"], k["key"]) for k in r["keys"]]})
            yield _removed(removed, out)
        yield _removed(fold(held, pairs), out)

    return grouped.repartition("component").sortWithinPartitions("component", "_ord").mapInArrow(replay, schema)


def _removed(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True) if rows else [()] * len(schema), schema, strict=True)], schema=schema)


def survivors(rows: DataFrame, removed: DataFrame) -> DataFrame:
    return rows.join(removed.select(F.col("loser").alias("_ord")).hint("merge"), "_ord", "left_anti")


def mirrors(rows: DataFrame, german: str = r"(?iU)\b(?:der|die|das|und|praktik\w+|werkstudent\w*)\b", english: str = r"(?iU)\b(?:the|and|intern\w*|working student)\b") -> DataFrame:
    """(loser, winner): of postings with one company, source and requisition in two languages, the best stays.

    The order is total (described, then typed, then earliest, then first
    arrival), so an aggregate finds the winner; rows whose country or type
    contradicts the winner's are no mirrors of it, and rows without a company,
    source or requisition have none.
    """
    language = F.when(F.col("title").rlike(german) & ~F.col("title").rlike(english), "de").when(F.col("title").rlike(english) & ~F.col("title").rlike(german), "en")
    described, typed = F.coalesce("description", F.lit("")) != "", F.coalesce("employment_type", F.lit("")) != ""
    key = ["company", "source", "requisition"]
    order = F.struct(~described, ~typed, F.col("posted_at").isNull(), "posted_at", "_ord")
    # a hot requisition is reduced before it is shuffled, and its rows are joined to one winner
    found = rows.where(" AND ".join(f"{k} IS NOT NULL" for k in key)).select(*key, order.alias("_order"), "_ord", language.alias("l"), title_bag(F.col("title")).alias("t"), "country_iso", "employment_type")
    best = found.groupBy(*key).agg(F.min_by(F.struct("_ord", "l", "t", "country_iso", "employment_type"), "_order").alias("w"))
    ranked = found.join(best.hint("merge"), key)
    agree = F.lit(True)
    for c in ("country_iso", "employment_type"):
        agree = agree & F.coalesce(F.col(c) == F.col(f"w.{c}"), F.lit(True))
    alike = (F.col("t") == F.col("w.t")) | F.coalesce(F.col("l") != F.col("w.l"), F.lit(False))
    return ranked.where((F.col("_ord") != F.col("w._ord")) & agree & alike).select(F.col("_ord").alias("loser"), F.col("w._ord").alias("winner"))


def cross_source(rows: DataFrame, bulk_prefix: str = "bulk:", most_rows: int = 50_000) -> DataFrame:
    """(loser, winner) among postings of different sources with one title and city, by the same employer.

    A bulk source beats others; then a description, a type, the earlier date
    and the earlier arrival decide. Where all rows of a bucket rank alike, none
    takes another's place, so the first row of each source and country decides
    for all of its kind. Buckets whose rows differ in rank are replayed row by
    row, those of more than most_rows in ranges (see residents.py). Rows
    without a place, title or company are left alone; rows without a source go
    with others, but none goes with them.
    """
    keys, kind = ["_key", "_digest"], ["source", "country"]
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    parts = {"_at": place_key(F.col("location")), "_title": title_bag(F.col("title")), "_who": F.array_join(identity(F.col("company")), " ")}
    whole, told = F.concat_ws("\x1f", *parts), (F.col("_at") != "") & (F.col("_title") != "") & (F.col("_who") != "")
    with written() as paths:
        # keys take many regular expressions, so rows are written once, with hashes of 96 bits for them
        made = stored(rows.withColumns(parts).select(
            F.when(told, F.xxhash64(whole)).alias("_key"), F.hash(whole).alias("_digest"), F.trim(F.coalesce("source", F.lit(""))).alias("source"), F.lower(F.coalesce("country_iso", F.lit(""))).alias("country"),
            F.coalesce(F.startswith("source", F.lit(bulk_prefix)), F.lit(False)).alias("bulk"), filled("description").alias("described"), filled("employment_type").alias("typed"), posted_key(F.col("posted_at")).alias("posted"), "_ord",
        ), "sources").where("_key IS NOT NULL")
        # numbers stand for ranks and sources, as those that hashes keep together need no sort
        rank, source = F.xxhash64(*RANK), F.xxhash64("source")
        buckets = made.groupBy(*keys).agg(F.min(rank).alias("least"), F.max(rank).alias("most"), F.min(source).alias("a"), F.max(source).alias("b"), F.max((F.col("source") == "").cast("int")).alias("none"), F.count("*").alias("_n"))
        buckets = buckets.where("a <> b").select(*keys, ((F.col("least") != F.col("most")) | (F.col("none") == 1)).alias("_mixed"), "_n")
        # written first, so that both sides of the join are shuffled and Spark can split the rows of a large bucket
        buckets = stored(buckets, "buckets")
        met = stored(made.join(buckets.hint("merge"), keys), "met")
    drop_stored(rows.sparkSession, paths[:2])
    mixed, same = met.where("_mixed"), met.where("NOT _mixed")
    # a kind whose first row goes has each of its rows go with the same winner; where all rank alike, any rank will do
    alike = same.groupBy(*keys, *kind).agg(F.min("_ord").alias("_ord")).select("*", *[F.lit("" if c == "posted" else False).alias(c) for c in RANK])
    lost = alike.join(bucket_fold(alike, keys, most_rows).withColumnRenamed("loser", "_ord").hint("merge"), "_ord").select(*keys, *kind, "winner")
    plain = same.join(lost.hint("merge"), [*keys, *kind]).select(F.col("_ord").alias("loser"), "winner")
    found = plain.unionByName(whole_buckets(mixed.where(F.col("_n") <= most_rows), keys))
    large = mixed.where(F.col("_n") > most_rows)
    return found if large.isEmpty() else found.unionByName(in_ranges(large, keys, most_rows))


def wildcard_pairs(rows: DataFrame, anywhere: Column) -> DataFrame:
    """(loser, winner): the n-th posting of a (company, title) for any place goes with the n-th for a concrete place.

    Pairs are first in, first out on both sides, so numbering each side and joining equal numbers is the whole fold.
    Numbers are running sums, so a title may have any number of postings.
    """
    key = [F.lower("company").alias("_c"), title_bag(F.col("title")).alias("_t")]
    numbered = running_sums(rows.select("_ord", *key, anywhere.alias("_any")), F.col("_ord"), {"_n": F.lit(1)}, ["_c", "_t", "_any"])
    general, concrete = numbered.where("_any"), numbered.where("NOT _any")
    return general.join(concrete.withColumnRenamed("_ord", "winner").drop("_any").hint("merge"), ["_c", "_t", "_n"]).select(F.col("_ord").alias("loser"), "winner")
