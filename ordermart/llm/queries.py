"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm.bundles import archive_and_read
from ordermart.llm.common import read_table
from ordermart.llm.contamination import contamination
from ordermart.llm.jaccard import near_duplicate_classes
from ordermart.llm.lexical import ranked_search
from ordermart.llm.negatives import mine_embeddings
from ordermart.llm.packing import pack_documents
from ordermart.llm.quality import judge_quality
from ordermart.llm.sharding import shard_documents
from ordermart.llm.spans import cut_repeated_spans
from ordermart.llm.suffixes import deduplicate_bytes
from ordermart.llm.topk import search_embeddings
from ordermart.llm.toxicity import judge_toxicity
from ordermart.llm.urls import fixed_rules, judge_urls


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"), shards=24)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_embeddings(read_table(spark, sf_dir, "embeddings"), k=10)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return cut_repeated_spans(docs).select(
        "doc_id",
        "text",
        F.col("_n_sentences").alias("n_sentences"),
        F.col("_n_removed").alias("n_removed"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"), fixed_rules(spark))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(read_table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = deduplicate_bytes(read_table(spark, sf_dir, "documents"))
    run = F.transform("removed", lambda r: F.concat_ws("+", r["start"], r["length"]))
    return cut.withColumn("removed", F.array_join(run, ","))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=20)


def op12_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(read_table(spark, sf_dir, "pages"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_embeddings(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_quality_classifier,
        op3_exact_top_k,
        op4_substring_dedup,
        op5_toxicity,
        op6_url_filters,
        op7_ngram_jaccard_join,
        op8_suffix_array_dedup,
        op9_benchmark_decontamination,
        op10_best_fit_packing,
        op11_ranked_lexical_search,
        op12_warc_bundles,
        op13_hard_negatives,
    )
}

ORACLE: dict[str, str] = {
    "op3_exact_top_k": r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS code FROM embeddings
), pairs AS (
    SELECT q.vec_id AS query_id, v.vec_id,
           len(list_filter(list_zip(q.code, v.code), lambda p: p[1] <> p[2])) AS distance
    FROM v q, v WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance
FROM ranked WHERE rank <= 10
""",
    "op6_url_filters": r"""
WITH rules(verdict, host, path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
           ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parsed AS (
    SELECT page_id, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw_host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM cut
), lowered AS (
    SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
    FROM parsed
)
SELECT p.page_id, p.host, p.path,
       arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
       coalesce(arg_max(r.verdict, length(r.host || r.path)), 'allow') AS verdict
FROM (SELECT *, row_number() OVER () AS n FROM lowered) p
LEFT JOIN rules r
  ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
GROUP BY p.n, p.page_id, p.host, p.path
""",
    "op7_ngram_jaccard_join": r"""
WITH RECURSIVE doc AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), keyed AS (SELECT *, CASE WHEN len(w) > 0 THEN 'w ' || array_to_string(w, ' ') ELSE 't ' || text END AS words FROM doc),
kind AS (
    SELECT row_number() OVER () AS k, words, any_value(w) AS w, count(*) AS n_copies,
           count(DISTINCT text) AS n_texts, min(doc_id) AS first_doc
    FROM keyed GROUP BY words
), gram AS (
    SELECT DISTINCT k, md5(array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ')) AS g
    FROM kind, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS t(i) WHERE len(w) > 0
), size AS (SELECT k, count(*) AS n FROM gram GROUP BY k),
common AS (SELECT a.k AS a, b.k AS b, count(*) AS n FROM gram a JOIN gram b ON a.g = b.g AND a.k <> b.k GROUP BY ALL),
link AS (
    SELECT a, b FROM common JOIN size s ON s.k = a JOIN size t ON t.k = b
    WHERE 5 * common.n >= 4 * (s.n + t.n - common.n)
), reach(a, b) AS (
    SELECT k, k FROM kind UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
), class AS (SELECT reach.a AS k, min(first_doc) AS class_id FROM reach JOIN kind ON kind.k = reach.b GROUP BY reach.a),
linked AS (SELECT link.a AS k, sum(n_texts) AS n FROM link JOIN kind ON kind.k = link.b GROUP BY link.a)
SELECT keyed.doc_id, class_id,
       CAST(coalesce(linked.n, 0) + CASE WHEN len(kind.w) > 0 THEN n_texts - 1 ELSE 0 END AS BIGINT) AS n_links, n_copies
FROM keyed JOIN kind USING (words) JOIN class USING (k) LEFT JOIN linked USING (k)
""",
    "op8_suffix_array_dedup": r"""
WITH doc AS (
    SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h
    FROM documents
), part AS (
    SELECT n, b, substr(h, 2 * b + 1, 2 * 655) AS h FROM doc, unnest(range(0, strlen(h) // 2 - 399, 256)) AS t(b)
), place AS (
    SELECT n, b + j AS i, md5(substr(h, 2 * j + 1, 800)) AS string
    FROM part, unnest(range(0, strlen(h) // 2 - 399)) AS t(j)
), again AS (SELECT string FROM place GROUP BY string HAVING count(*) > 1),
covered AS (
    SELECT n, i, CASE WHEN i <= lag(i) OVER (PARTITION BY n ORDER BY i) + 400 THEN 0 ELSE 1 END AS opens
    FROM place WHERE string IN (SELECT string FROM again)
), run AS (
    SELECT n, min(i) AS start, max(i) + 400 AS stop
    FROM (SELECT n, i, sum(opens) OVER (PARTITION BY n ORDER BY i) AS number FROM covered)
    GROUP BY n, number
), piece AS (
    SELECT n, start, stop, lag(stop, 1, 0) OVER (PARTITION BY n ORDER BY start) AS before FROM run
), told AS (
    SELECT n, CAST(sum(stop - start) AS BIGINT) AS n_removed, count(*) AS n_spans,
           string_agg(start || '+' || (stop - start), ',' ORDER BY start) AS removed,
           string_agg(substr(any_h, 2 * before + 1, 2 * (start - before)), '' ORDER BY start)
               || substr(max(any_h), 2 * max(stop) + 1) AS kept
    FROM (SELECT piece.*, h AS any_h FROM piece JOIN doc USING (n)) GROUP BY n
), decoded AS (
    SELECT n, decode(unhex(array_to_string(list_transform(
        regexp_extract_all(kept, '(?:' || whole || '|' || broken || ')'),
        lambda c: CASE WHEN regexp_full_match(c, whole) THEN c ELSE 'EFBFBD' END), ''))) AS text
    FROM told, (SELECT
        '[0-7].|(?:C[2-9A-F]|D.)[89AB].|E0[AB].[89AB].|E[1-9A-CEF](?:[89AB].){2}|ED[89].[89AB].'
        || '|F0[9AB].(?:[89AB].){2}|F[1-3](?:[89AB].){3}|F48.(?:[89AB].){2}' AS whole,
        'E0[AB].|E[1-9A-CEF][89AB].|ED[89].|F0[9AB].(?:[89AB].)?|F[1-3](?:[89AB].){1,2}|F48.(?:[89AB].)?|..' AS broken)
)
SELECT doc.doc_id, strlen(doc.text) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256, coalesce(decoded.text, doc.text) AS text,
       coalesce(removed, '') AS removed
FROM doc LEFT JOIN told USING (n) LEFT JOIN decoded USING (n)
""",
    "op9_benchmark_decontamination": r"""
WITH doc AS (
    SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), item_window AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS size,
           array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS phrase
    FROM item, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i)
    WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM item_window),
doc_window AS (
    SELECT n, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase
    FROM doc, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)
    WHERE len(w) >= size
), matched AS (
    SELECT d.n, d.i, d.size, m.item_id FROM doc_window d JOIN item_window m USING (size, phrase)
), hit AS (
    SELECT n, count(DISTINCT p) AS n_hit
    FROM (SELECT n, unnest(range(i, i + size)) AS p FROM matched) GROUP BY n
), ids AS (
    SELECT n, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
    FROM (SELECT DISTINCT n, CAST(item_id AS VARCHAR) AS item_id FROM matched) GROUP BY n
)
SELECT doc.doc_id, CAST(len(doc.w) AS BIGINT) AS n_words, coalesce(hit.n_hit, 0) AS n_hit,
       coalesce(ids.n_items, 0) AS n_items, sha256(coalesce(ids.listed, '')) AS items_sha256,
       coalesce(hit.n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (n) LEFT JOIN ids USING (n)
""",
    "op11_ranked_lexical_search": r"""
WITH doc AS (
    SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), item AS (
    SELECT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), wanted AS (SELECT item_id, term, count(*) AS repeats FROM item GROUP BY ALL),
total AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM doc WHERE len(w) > 0),
held AS (
    SELECT n, term, count(*) AS tf FROM (SELECT n, unnest(w) AS term FROM doc)
    WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM held GROUP BY term), total
), length AS (SELECT n, doc_id, 100 - 25 + ((25 * len(w) * docs) // terms) AS m FROM doc, total),
scored AS (
    SELECT item_id, doc_id, n,
           CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM wanted JOIN held USING (term) JOIN weight USING (term) JOIN length USING (n)
    GROUP BY item_id, doc_id, n
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
""",
    "op12_warc_bundles": """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
           coalesce(html, '') AS html FROM pages
), top AS (SELECT html, max(page_id) AS response FROM p WHERE payload_bytes >= 1000 GROUP BY html)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM p LEFT JOIN top USING (html)
""",
    "op13_hard_negatives": """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
           CAST(list_sum(list_transform(list_zip(a.x, v.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a, v WHERE a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id
), positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), mined AS (
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
    FROM positive JOIN pairs USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM mined WHERE rank <= 10
""",
}
