"""Registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    conversation_repair,
    decontaminate,
    language_id,
    license_scan,
    line_dedup,
    near_dedup,
    ngram_lm,
    quality_classifier,
    quality_rules,
    rank_bpe,
    ranked_search,
    url_filter,
)
from .frames import crc_mod, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return put


@query("op1_line_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    done = line_dedup.dedup_lines(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return done.select("row.doc_id", "text", "spans", removed.alias("bytes_removed"))


@query("op2_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    members, nodes = near_dedup.classes(docs)
    return members.join(nodes, "key").select(
        F.col("own_id").alias("doc_id"), F.col("first.id").alias("class_id"), F.col("n_links").alias("n_verified_links"),
        (F.col("own_id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key"))).alias("kept"))


@query("op3_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_decode(docs).select(
        "row.doc_id", "bpe.n_tokens", F.sha2("bpe.ids", 256).alias("ids_sha256"),
        F.sha2(F.col("bpe.decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    posterior, weights = quality_classifier.learn(docs)
    return quality_classifier.score(docs, posterior, weights).select("row.doc_id", "c.*")


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    dictionaries = language_id.learn(docs.where(~held_out))
    return language_id.predict(docs.select("doc_id", "text", held_out.alias("held_out")), dictionaries).select(
        "row.doc_id", "row.held_out", F.col("lid.lang").alias("lang_pred"), "lid.score", "lid.rejected")


@query("op6_ngram_lm")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 7) == 2
    model = ngram_lm.train(docs.where(~held_out))
    return ngram_lm.score(docs.select("doc_id", "text", held_out.alias("held_out")), model).select(
        "row.doc_id", "row.held_out", "lm.n_tokens", "lm.n_known", F.lit(model["total"]).cast("long").alias("train_tokens"),
        "lm.base_score", "lm.score", "lm.perplexity")


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = quality_rules.trusted_labels(read(spark, sf_dir, "labels"))
    ratio, threshold = quality_rules.fit(docs, trusted)
    return quality_rules.judge(docs, ratio, threshold=threshold).select("row.doc_id", "q.*")


def _op8_sql() -> str:
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    plain = "trim(regexp_replace(replace(body, '&', ' and '), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' ')"
    for old, new in license_scan.EQUIVALENT:
        plain = f"replace({plain}, '{old}', '{new}')"
    known = ", ".join(f"('{d}', '{name}')" for d, name in license_scan.known_digests())
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split({low}, chr(10)) AS lines FROM documents),
known(digest, license) AS (VALUES {known}),
units AS (
  SELECT r, true AS whole, array_to_string([x FOR x IN lines IF NOT regexp_matches(x, '{license_scan.COPYRIGHT}')], ' ') AS body FROM d
  UNION ALL
  SELECT r, false, CASE WHEN regexp_matches(x, '{license_scan.COPYRIGHT}') THEN '' ELSE x END
  FROM (SELECT r, unnest(lines) AS x FROM d)),
hits AS (SELECT r, whole, license FROM units JOIN known ON sha256({plain}) = digest)
SELECT doc_id, max(CASE WHEN whole THEN license END) AS whole_license,
       coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses,
       CAST(count(CASE WHEN NOT whole THEN 1 END) AS BIGINT) AS n_notices
FROM d LEFT JOIN hits USING (r) GROUP BY r, doc_id
"""


@query("op8_license_scan", _op8_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(docs).select(
        F.col("id").alias("doc_id"), "whole_license", F.concat_ws(",", "licenses").alias("licenses"), "n_notices")


@query("op9_url_filter")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages).withColumnRenamed("id", "page_id")


OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, [x FOR x IN regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, [x FOR x IN regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT r, i, pos.n, item FROM pos JOIN win ON pos.s = win.s AND pos.n = win.n),
cover AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (r) LEFT JOIN found USING (r)
"""


@query("op10_decontaminate", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark"))
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"))


@query("op11_rank_bpe")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = rank_bpe.decode(rank_bpe.encode(docs))
    numbers = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(numbers.cast("binary"), 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


# rows after damage are numbered, and the cheapest edits from row i on are found for each of the four states, last row first;
# an answer is (cost, edits, repaired lines), of which the least is taken
OP12_SQL = r"""
WITH RECURSIVE
place AS (SELECT *, row_number() OVER () AS rid, encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')) AS k
          FROM conversations),
bits AS (SELECT CAST(b AS BIGINT) AS b, list_reduce(list_prepend(CAST(b AS BIGINT), CAST(range(8) AS BIGINT[])),
                lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS v FROM range(256) t(b)),
crc AS (SELECT list(v ORDER BY b) AS t FROM bits),
hit AS (SELECT place.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(('0x' || hex(k)[2 * i + 1:2 * i + 2]) AS BIGINT) FOR i IN range(octet_length(k))]),
               lambda a, x: xor(a // 256, crc.t[(xor(a % 256, x)) + 1])), 4294967295) % 20 AS c FROM place, crc),
hurt AS (SELECT rid, conv_id, turn, CASE WHEN c = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
                CASE WHEN c = 1 THEN '' WHEN c = 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
                unnest(range(CASE WHEN c = 0 THEN 0 WHEN c = 3 THEN 2 ELSE 1 END)) AS copy FROM hit),
placed AS (SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), rid, copy) AS i FROM hurt),
rows AS (SELECT g, conv_id, turn, i, role, text, role[1:1] AS ini, lag(role[1:1]) OVER (PARTITION BY g ORDER BY i) AS prev,
                CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                     WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'd'
                     WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault FROM placed),
facts AS (SELECT g, any_value(conv_id) AS conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(CASE WHEN fault = 'b' THEN 1 END) AS blank, count(CASE WHEN fault = 'd' THEN 1 END) AS duplicate,
                 count(CASE WHEN fault = 't' THEN 1 END) AS truncated,
                 count(CASE WHEN i > 1 AND prev || ini NOT IN ('su', 'ua', 'au') THEN 1 END) AS illegal FROM rows GROUP BY g),
best AS (
  SELECT g, n AS i, {'c': 0, 'e': '', 't': CAST([] AS VARCHAR[])} AS z, {'c': 10, 'e': 'II', 't': ['user:', 'assistant:']} AS s,
         {'c': 5, 'e': 'I', 't': ['assistant:']} AS u, {'c': 0, 'e': '', 't': CAST([] AS VARCHAR[])} AS a FROM facts
  UNION ALL
  SELECT g, i - 1, z0,
         least(s0, {'c': u0.c + 5, 'e': 'I' || u0.e, 't': list_prepend('user:', u0.t)},
               {'c': a0.c + 10, 'e': 'II' || a0.e, 't': list_prepend('user:', list_prepend('assistant:', a0.t))}),
         least(u0, {'c': a0.c + 5, 'e': 'I' || a0.e, 't': list_prepend('assistant:', a0.t)}),
         least(a0, {'c': u0.c + 5, 'e': 'I' || u0.e, 't': list_prepend('user:', u0.t)})
  FROM (SELECT g, i,
      least(least(zd, {'c': u1.c + 5, 'e': 'I' || u1.e, 't': list_prepend('user:', u1.t)})) AS z0, sd AS s0, u1 AS u0, ad AS a0
    FROM (SELECT b.g, b.i,
        least({'c': b.z.c + 2, 'e': 'D' || b.z.e, 't': b.z.t},
              {'c': b.s.c + more + CASE WHEN stay AND ini = 's' THEN 0 ELSE 1000000 END, 'e': 'K' || b.s.e, 't': list_prepend(l, b.s.t)},
              {'c': b.u.c + more + CASE WHEN stay AND ini = 'u' THEN 0 ELSE 1000000 END, 'e': 'K' || b.u.e, 't': list_prepend(l, b.u.t)},
              {'c': b.u.c + more + CASE WHEN stay THEN 1 ELSE 1000000 END, 'e': 'R' || b.u.e, 't': list_prepend('user:' || text, b.u.t)}) AS zd,
        least({'c': b.s.c + 2, 'e': 'D' || b.s.e, 't': b.s.t},
              {'c': b.u.c + more + CASE WHEN stay AND ini = 'u' THEN 0 ELSE 1000000 END, 'e': 'K' || b.u.e, 't': list_prepend(l, b.u.t)},
              {'c': b.u.c + more + CASE WHEN stay THEN 1 ELSE 1000000 END, 'e': 'R' || b.u.e, 't': list_prepend('user:' || text, b.u.t)}) AS sd,
        least({'c': b.u.c + 2, 'e': 'D' || b.u.e, 't': b.u.t},
              {'c': b.a.c + more + CASE WHEN stay AND ini = 'a' THEN 0 ELSE 1000000 END, 'e': 'K' || b.a.e, 't': list_prepend(l, b.a.t)},
              {'c': b.a.c + more + CASE WHEN stay THEN 1 ELSE 1000000 END, 'e': 'R' || b.a.e, 't': list_prepend('assistant:' || text, b.a.t)}) AS u1,
        least({'c': b.a.c + 2, 'e': 'D' || b.a.e, 't': b.a.t},
              {'c': b.u.c + more + CASE WHEN stay AND ini = 'u' THEN 0 ELSE 1000000 END, 'e': 'K' || b.u.e, 't': list_prepend(l, b.u.t)},
              {'c': b.u.c + more + CASE WHEN stay THEN 1 ELSE 1000000 END, 'e': 'R' || b.u.e, 't': list_prepend('user:' || text, b.u.t)}) AS ad
      FROM best b JOIN (SELECT *, fault NOT IN ('b', 'd') AS stay, CASE WHEN fault = 't' THEN 5 ELSE 0 END AS more, role || ':' || text AS l FROM rows) r
        ON r.g = b.g AND r.i = b.i))),
done AS (SELECT facts.*, z FROM facts JOIN best ON best.g = facts.g AND best.i = 0)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(z.c, 0) AS BIGINT) AS cost, coalesce(z.e, '') AS audit,
       sha256(coalesce(array_to_string(z.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op12_conversation_repair", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    hurt = conversation_repair.damaged(read(spark, sf_dir, "conversations"))
    done = conversation_repair.repair(hurt, copies=F.col("copies"))
    return conversation_repair.digests(done).withColumnRenamed("conv", "conv_id")


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"[x FOR x IN regexp_split_to_array({_LOW}, '{ranked_search.BETWEEN}') IF x <> '']"
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
k AS (SELECT row_number() OVER () AS i, item_id, list_distinct({_TERMS}) AS t FROM benchmark),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
asked AS (SELECT i, item_id, unnest(t) AS term FROM k),
held AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
         FROM (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
           FROM held, size GROUP BY term),
scored AS (SELECT i, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id,
                  CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
           FROM asked JOIN held USING (term) JOIN weight USING (term), size GROUP BY i, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""


@query("op13_ranked_search", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = ranked_search.search(docs, read(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
