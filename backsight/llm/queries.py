"""The registered queries of the numbered operators, each over its whole table, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from backsight.llm import conversations, decontaminate, forest, language, licences, pieces, quality, simhash, substrings, tokens, topk, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def share_code(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, and get batches of at most 4 MB."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontaminate(spark, sf_dir):
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLES["op1_decontaminate"] = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + 12], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc_words, sizes WHERE len(w) >= size)),
hits AS (SELECT r, i, size, item_id FROM doc_windows JOIN item_windows USING (size, words)),
hit_words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hits) GROUP BY r),
hit_items AS (
  SELECT r, count(DISTINCT item_id) AS n_items, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


@query
def op3_substring_dedup(spark, sf_dir):
    found = substrings.deduplicate(table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


ORACLES["op3_substring_dedup"] = r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS words
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc_words WHERE len(w) >= 50 AND doc_id IS NOT NULL)),
first_in AS (SELECT words, min(doc_id) AS least FROM windows GROUP BY words),
gone AS (
  SELECT DISTINCT r, p FROM (
    SELECT r, unnest(range(i, i + 50)) AS p FROM windows JOIN first_in USING (words) WHERE doc_id > least)),
kept AS (
  SELECT r, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS words
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc_words) ANTI JOIN gone USING (r, p)
  GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM doc_words LEFT JOIN kept USING (r)
"""


@query
def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op10_top_k(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"))


ORACLES["op10_top_k"] = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v, len(embedding) AS n FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, x.vec_id AS vec_id, list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM vectors q JOIN vectors x ON q.n = x.n AND q.vec_id <> x.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_token_files(spark, sf_dir):
    written = tokens.write_ids(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return tokens.checked(tokens.read_ids(written))


@query
def op7_warc(spark, sf_dir):
    index = warc.normalise(warc.write_archives(table(spark, sf_dir, "pages")))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op7_warc"] = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
first_of AS (
  SELECT payload_digest, min(page_id) AS first_id FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM payloads LEFT JOIN first_of USING (payload_digest)
"""


@query
def op8_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op6_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = quality.score(docs, quality.train(docs, labels))
    return found.select("row.doc_id", "n_words", "p_low_quality", "p_toxic", "rejected")


@query
def op2_pieces(spark, sf_dir):
    found = pieces.encode(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), keep=["doc_id"])
    return found.select("row.doc_id", "n_tokens", "ids_crc32", "round_trip")


def document_paths(documents: DataFrame) -> DataFrame:
    """Documents as files of a tree: blocks of 16 in blocks of 16; the first document of a block is its licence file."""
    block = lambda n: F.expr(f"cast(floor(doc_id / {n}) as string)")
    path = (
        F.when(F.col("doc_id") % 4096 == 0, F.concat(block(4096), F.lit("/LICENSE")))
        .when(F.col("doc_id") % 256 == 0, F.concat_ws("/", block(4096), block(256), F.lit("LICENSE")))
        .when(F.col("doc_id") % 16 == 0, F.concat_ws("/", block(4096), block(256), block(16), F.lit("LICENSE")))
        .when(F.col("doc_id").isNotNull(), F.concat_ws("/", block(4096), block(256), block(16), F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))
    )
    return documents.select("doc_id", path.alias("path"), "text")


@query
def op4_licences(spark, sf_dir):
    found = licences.scan(document_paths(table(spark, sf_dir, "documents")))
    return found.select("path", "own_licence", "own_score", "licence", "licensed_by")


_TEMPLATE_ROWS = ", ".join(f"('{name}', '{name}/{k}', '{text}')" for name, texts in sorted(licences.TEMPLATES.items()) for k, text in enumerate(texts))
ORACLES["op4_licences"] = rf"""
WITH files AS (
  SELECT row_number() OVER () AS number, coalesce(text, '') AS text, doc_id,
         (doc_id // 4096)::VARCHAR AS a, (doc_id // 256)::VARCHAR AS b, (doc_id // 16)::VARCHAR AS c FROM documents),
placed AS (
  SELECT number, text, CASE WHEN doc_id % 4096 = 0 THEN a || '/' WHEN doc_id % 256 = 0 THEN a || '/' || b || '/'
                            ELSE a || '/' || b || '/' || c || '/' END AS directory,
         CASE WHEN doc_id % 16 = 0 THEN 'LICENSE' ELSE doc_id || '.txt' END AS name FROM files),
raw_segments AS (
  SELECT number, line FROM (SELECT number, unnest(string_split(text, chr(10))) AS line FROM placed)
  WHERE regexp_matches(line, '(?i)licen[cs]e|copyright|redistribution|permission is')
  UNION ALL SELECT number, text FROM placed WHERE name = 'LICENSE'),
each_segment AS (
  SELECT DISTINCT number, array_to_string(regexp_extract_all(lower(line), '{licences.WORD}'), ' ') AS segment FROM raw_segments),
distinct_segments AS (SELECT DISTINCT segment FROM each_segment WHERE segment <> ''),
terms AS (
  SELECT segment, term, count(*) AS tf FROM (SELECT segment, unnest(string_split(segment, ' ')) AS term FROM distinct_segments) GROUP BY ALL),
frequency AS (SELECT term, count(*) AS df FROM terms GROUP BY term),
total AS (SELECT count(*)::DOUBLE AS n FROM distinct_segments),
weighted AS (SELECT segment, term, tf * (ln((n + 1) / (df + 1)) + 1) AS w FROM terms JOIN frequency USING (term), total),
norms AS (SELECT segment, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY segment),
notices(licence, template, text) AS (VALUES {_TEMPLATE_ROWS}),
notice_terms AS (
  SELECT licence, template, term, count(*) AS tf
  FROM (SELECT licence, template, unnest(regexp_extract_all(lower(text), '{licences.WORD}')) AS term FROM notices) GROUP BY ALL),
notice_weights AS (
  SELECT licence, template, term, tf * (ln((n + 1) / (coalesce(df, 0) + 1)) + 1) AS t FROM notice_terms LEFT JOIN frequency USING (term), total),
notice_norms AS (SELECT template, sqrt(sum(t * t)) AS own FROM notice_weights GROUP BY template),
scores AS (
  SELECT segment, licence, round(sum(w * t) / (any_value(norm) * any_value(own)), 6) AS score
  FROM weighted JOIN notice_weights USING (term) JOIN norms USING (segment) JOIN notice_norms USING (template)
  GROUP BY segment, licence, template),
own AS (
  SELECT number, licence, score FROM each_segment JOIN scores USING (segment) WHERE score >= 0.8
  QUALIFY row_number() OVER (PARTITION BY number ORDER BY score DESC, licence) = 1),
given AS (
  SELECT directory, licence AS given FROM placed JOIN own USING (number) WHERE name = 'LICENSE'
  QUALIFY row_number() OVER (PARTITION BY directory ORDER BY score DESC, licence) = 1),
inherited AS (
  SELECT p.number, g.directory, g.given FROM placed p ANTI JOIN own USING (number) JOIN given g ON starts_with(p.directory, g.directory)
  QUALIFY row_number() OVER (PARTITION BY p.number ORDER BY length(g.directory) DESC) = 1)
SELECT p.directory || p.name AS path, o.licence AS own_licence, o.score AS own_score,
       coalesce(o.licence, i.given) AS licence, i.directory AS licensed_by
FROM placed p LEFT JOIN own o USING (number) LEFT JOIN inherited i USING (number)
"""


@query
def op12_minhash_forest(spark, sf_dir):
    return forest.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


ORACLES["op12_minhash_forest"] = r"""
WITH RECURSIVE doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT r, s FROM (
    SELECT r, array_to_string(w[i:i + 1], ' ') AS s
    FROM (SELECT r, w, unnest(range(1, greatest(len(w), 2))) AS i FROM doc_words WHERE len(w) > 0))),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
digests AS (SELECT r, md5(string_agg(s, ' ' ORDER BY s)) AS digest, count(*) AS n FROM shingles GROUP BY r),
nodes AS (SELECT digest, any_value(n) AS n, min(r) AS node FROM digests GROUP BY digest),
members AS MATERIALIZED (
  SELECT node, n, s, row_number() OVER (PARTITION BY node ORDER BY df, s) AS place
  FROM nodes JOIN shingles ON r = node JOIN (SELECT s, count(*) AS df FROM shingles GROUP BY s) USING (s)),
-- two sets that link share one of their 1 + n / 5 rarest members
rare AS MATERIALIZED (SELECT * FROM members WHERE place <= n // 5 + 1),
candidates AS MATERIALIZED (
  SELECT DISTINCT x.node AS a, y.node AS b FROM rare x JOIN rare y USING (s)
  WHERE x.node < y.node AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)),
common AS (
  SELECT a, b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS c
  FROM candidates JOIN members x ON x.node = a JOIN members y ON y.node = b AND y.s = x.s GROUP BY a, b),
links AS MATERIALIZED (
  SELECT a, b FROM common WHERE 100 * c >= 80 * (na + nb - c) UNION ALL SELECT b, a FROM common WHERE 100 * c >= 80 * (na + nb - c)),
reach AS (SELECT node AS a, node AS b FROM nodes UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least_ids AS (SELECT node, min(doc_id) AS id FROM nodes JOIN digests USING (digest) JOIN doc_words USING (r) GROUP BY node),
named AS (SELECT a AS node, min(id) AS component_id FROM reach JOIN least_ids ON node = b GROUP BY a)
SELECT doc_id, coalesce(d.n, 0)::BIGINT AS n_shingles, coalesce(component_id, CASE WHEN d.n IS NULL THEN doc_id END) AS component_id,
       coalesce(doc_id = coalesce(component_id, CASE WHEN d.n IS NULL THEN doc_id END), false) AS kept
FROM doc_words LEFT JOIN digests d USING (r) LEFT JOIN nodes o USING (digest) LEFT JOIN named USING (node)
"""


@query
def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op11_conversations(spark, sf_dir):
    return conversations.repair(table(spark, sf_dir, "conversations"))
