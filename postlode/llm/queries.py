"""The queries of this subpackage over the tables of a folder, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.llm import bpe, collocations, common, impact_index, language_id, mixing, mpeg_ts, quality_model, quality_rules, simhash, substring_dedup, toxicity, url_filter, warc
from postlode.shared import stored

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_rules(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _classified(scores: DataFrame, threshold: float, *more: str) -> DataFrame:
    return scores.select("doc_id", (~common.training_row(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *more)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _classified(toxicity.score(docs, toxicity.train(docs, labels)), 0.5, "offending")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.apply_rules(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    read = bpe.decode(bpe.encode(documents(spark, sf_dir), path), path)
    return read.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.read_records(warc.write_records(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    page = F.expr("nullif(id, '')").cast("long")
    return read.select(page.alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op8_mpeg_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = mpeg_ts.read_media(mpeg_ts.store_media(documents(spark, sf_dir)))
    index = F.col("pts_index")
    feature = F.format_string("packets=%d;random_access=%d;last_pts=%d;continuity_errors=%d", F.size(index), F.size(F.filter(index, lambda x: x["random_access"])), F.array_max(F.transform(index, lambda x: x["pts"])), "continuity_errors")
    return read.select("doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.expr("substring(payload, -64)")).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"), "pts_index")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(documents(spark, sf_dir))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _classified(quality_model.score(docs, quality_model.train(docs, labels)), 0.3)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, place = documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 4
    found = language_id.identify(docs, language_id.train(docs, place != 2))
    return found.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"), F.col("lang").alias("lang_pred"), F.col("cosine").alias("score"), "rejected")


def op12_impact_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    n, total = impact_index.statistics(docs)
    index = stored(impact_index.build(docs, n, total), "impact_index")
    return impact_index.search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_toxicity, op3_substring_dedup, op4_url_filter, op5_bpe, op6_simhash, op7_warc, op8_mpeg_ts, op9_mixing, op10_quality_model, op11_language_id, op12_impact_index, op13_collocations)}

#: Words by place for each row of documents.
ROWS = r"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents), w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d)"""
QUALITY_SQL = ROWS + r""", lines AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM (SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w))),
r AS (SELECT rid, count(DISTINCT i + k) AS n FROM g, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY rid),
f AS (SELECT w.rid, doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words FROM w JOIN lines ON lines.rid = w.rid LEFT JOIN r ON r.rid = w.rid),
x AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS bad FROM x GROUP BY source),
m AS (SELECT avg(bad / n) AS mean, var_pop(bad / n) AS v FROM h),
q AS (SELECT mean, CASE WHEN v > 1e-12 THEN greatest(mean * (1 - mean) / v - 1, 0) ELSE 1e6 END AS s FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND (bad + mean * s) / (n + s) <= 0.5 AS kept FROM x JOIN h ON h.source IS NOT DISTINCT FROM x.source, q"""
REPEATS_SQL = ROWS + r""", p AS (SELECT rid, i, w[i] AS word, array_to_string(w[i : i + 34], ' ') AS run, i + 34 <= len(w) AS whole FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
s AS (SELECT rid, i, CASE WHEN whole THEN count(*) OVER (PARTITION BY whole, run) ELSE 0 END > 1 AS again FROM p),
c AS (SELECT rid, i, max(again::INT) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) = 1 AS gone FROM s),
k AS (SELECT p.rid, count(*) FILTER (WHERE gone) AS n, string_agg(word, ' ' ORDER BY p.i) FILTER (WHERE NOT gone) AS kept FROM p JOIN c ON c.rid = p.rid AND c.i = p.i GROUP BY p.rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k ON k.rid = w.rid"""
URL_SQL = r"""WITH a AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT unnest(['allow', 'block', 'block', 'allow', 'block']) AS verdict, unnest(['org', 'example.org', 'example.org', 'com', 'com']) AS h, unnest(['/', '/es/', '/en/1', '/fr/', '/de/']) AS p),
m AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict FROM a JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT a.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM a LEFT JOIN m ON m.page_id = a.page_id"""
WARC_SQL = r"""WITH a AS (SELECT page_id, coalesce(html, '') AS h FROM pages), f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first, unhex(sha1(h))::BIT::VARCHAR AS b FROM a)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + 16 * (substr(b, 5 * i + 1, 1) = '1')::INT + 8 * (substr(b, 5 * i + 2, 1) = '1')::INT + 4 * (substr(b, 5 * i + 3, 1) = '1')::INT + 2 * (substr(b, 5 * i + 4, 1) = '1')::INT + (substr(b, 5 * i + 5, 1) = '1')::INT)::INT, 1)), '') AS payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM f"""
MIX_SQL = r"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM s),
o AS (SELECT *, 3.0::DOUBLE * source_size AS most, sum(source_size) OVER ()::DOUBLE AS total, 3.0::DOUBLE * source_size / weight AS ratio FROM w),
c AS (SELECT *, total - coalesce(sum(most) OVER (ORDER BY ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest, sum(weight) OVER (ORDER BY ratio ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM o),
l AS (SELECT rest / free AS share FROM c WHERE rest / free < ratio ORDER BY ratio LIMIT 1),
t AS (SELECT source, source_size, least(coalesce(share, 1e300) * weight, most) AS target FROM o LEFT JOIN l ON TRUE),
r AS (SELECT row_number() OVER () AS rid, d.doc_id, d.source, size, source_size, target, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0 END::DOUBLE AS rate, ('0x' || substr(md5('1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS draw FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source),
z AS (SELECT *, ((floor(rate) + CASE WHEN ((draw + turn * 2783377641436328) % 4503599627370496) / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM r, (SELECT unnest(range(64)) AS turn)),
b AS (SELECT source, turn, row_number() OVER (PARTITION BY source ORDER BY abs(sum(taken)::BIGINT - any_value(target)), turn) AS i FROM z WHERE size > 0 GROUP BY source, turn)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN taken ELSE 0 END AS taken FROM z LEFT JOIN b ON b.source IS NOT DISTINCT FROM z.source AND i = 1 WHERE z.turn = coalesce(b.turn, 0)"""
RANKED_SQL = r"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT row_number() OVER () AS qid, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT count(*)::BIGINT AS big_n, sum(len(w))::BIGINT AS big_l FROM d WHERE len(w) > 0),
m AS (SELECT rid, 25 + (75 * len(w) * big_n) // big_l AS m FROM d, s WHERE len(w) > 0),
tf AS (SELECT rid, t, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(w) AS t FROM d) GROUP BY rid, t),
df AS (SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM tf, s GROUP BY t, big_n),
qt AS (SELECT qid, t, count(*)::BIGINT AS times FROM (SELECT qid, unnest(w) AS t FROM q) GROUP BY qid, t),
c AS (SELECT qid, tf.rid, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM qt JOIN df ON df.t = qt.t JOIN tf ON tf.t = qt.t JOIN m ON m.rid = tf.rid GROUP BY qid, tf.rid),
r AS (SELECT qid, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM c JOIN d ON d.rid = c.rid WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r JOIN q ON q.qid = r.qid WHERE rank <= 10"""
PHRASES_SQL = r"""WITH p AS (SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
g AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS ph FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p), (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, ph, string_split(ph, ' ') AS w, count(*)::BIGINT AS a FROM g GROUP BY lang, k, ph HAVING count(*) >= 30),
part AS (SELECT lang, k, ph, a, j, array_to_string(w[1 : j], ' ') AS x, array_to_string(w[j + 1 : k], ' ') AS y FROM f, (SELECT unnest([1, 2, 3]) AS j) WHERE j < k),
cut AS (SELECT c.lang, c.k, c.ph, c.a, j, fx.a AS l, fy.a AS r, (2000000::HUGEINT * c.a) // (fx.a + fy.a) AS score FROM part c JOIN f fx ON fx.lang = c.lang AND fx.ph = c.x JOIN f fy ON fy.lang = c.lang AND fy.ph = c.y),
low AS (SELECT *, row_number() OVER (PARTITION BY lang, ph ORDER BY score, j) AS i FROM cut),
inside AS (SELECT c.lang, array_to_string(c.w[s : s + n - 1], ' ') AS ph, max(c.a) AS a FROM f c, (SELECT unnest([1, 2, 3]) AS s), (SELECT unnest([2, 3]) AS n) WHERE n < c.k AND s + n - 1 <= c.k GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN inside ON inside.lang = low.lang AND inside.ph = low.ph WHERE i = 1 AND (inside.a IS NULL OR 100 * inside.a < 80 * low.a)),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
best AS (SELECT *, ph AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, ph) AS rank FROM kept)
SELECT best.lang, rank::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM best JOIN n ON n.lang = best.lang WHERE rank <= 2000"""
#: The others are beyond SQL: trained models, XXH64 and bit votes, merges of a vocabulary, stored streams. Tests hold them against plain versions.
ORACLES = {"op1_quality_rules": QUALITY_SQL, "op3_substring_dedup": REPEATS_SQL, "op4_url_filter": URL_SQL, "op7_warc": WARC_SQL, "op9_mixing": MIX_SQL, "op12_impact_index": RANKED_SQL, "op13_collocations": PHRASES_SQL}
