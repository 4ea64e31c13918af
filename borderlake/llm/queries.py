"""Queries that apply the operators to the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .collocations import collocations
from .common import ROW, read_table
from .decontaminate import find_items
from .exact_dedup import exact_dedup
from .html_extract import html_extract
from .language_id import language_id
from .line_dedup import line_dedup
from .lm_score import lm_score
from .secrets import scan_secrets
from .sentencepiece_lattice import round_trip
from .simhash import simhash_groups
from .suffix_dedup import suffix_dedup
from .warc import archive_round_trip
from .whitening import whitened_components


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop(ROW)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive_round_trip(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents")).drop(ROW)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled as good are the target, all others the background."""
    target = read_table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm_score(read_table(spark, sf_dir, "documents"), target).drop(ROW)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract(read_table(spark, sf_dir, "pages")).drop(ROW)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_components(read_table(spark, sf_dir, "embeddings"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_warc": op2_warc,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_line_dedup": op4_line_dedup,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_language_id": op6_language_id,
    "op7_lm_score": op7_lm_score,
    "op8_html_extraction": op8_html_extraction,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_secret_scan": op11_secret_scan,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_phrase_collocations": op13_phrase_collocations,
}

#: Items are at least five words long in the tables given; the operator takes shorter ones too.
DECONTAMINATION = r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
), split AS (
  SELECT kind, id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda w: w <> '') AS words
  FROM texts
), sets AS (
  SELECT kind, id, list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS shingles
  FROM split WHERE len(words) >= 5
), items AS (
  SELECT id AS item_id, len(shingles) AS n_item, unnest(shingles) AS shingle FROM sets WHERE kind = 'i'
), docs AS (
  SELECT id AS doc_id, unnest(shingles) AS shingle FROM sets WHERE kind = 'd'
)
SELECT doc_id, item_id, count(*) AS n_shared, n_item, count(*) / n_item AS containment
FROM docs JOIN items USING (shingle) GROUP BY doc_id, item_id, n_item HAVING count(*) * 5 >= n_item * 4
"""

WARC = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), firsts AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM payloads
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, true AS verified
FROM firsts
"""

#: Keys of lines: stripped of ASCII white space, A-Z lowered, at least 40 code points.
LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS n, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, n, line,
    translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), frequent AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT k.doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE k.doc_id <> f.holder) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE f.holder IS NULL OR k.doc_id = f.holder), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key
GROUP BY k.doc_id
"""

EXACT_DEDUP = r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM normal WINDOW w AS (PARTITION BY t)
"""

#: Places of matches: the lengths of the gaps and matches before. Links are the pairs of the interval join.
SECRET_SCAN = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), kinds AS (
  SELECT * FROM (VALUES
    (0, 'assign', '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 6),
    (1, 'access', '(AKIA[A-Z0-9]+)', 20),
    (2, 'hex', '([0-9a-f]{24,})', 24),
    (3, 'account', '(?:[Uu][Ss][Ee][Rr](?:_?[Nn][Aa][Mm][Ee]|_?[Ii][Dd])?|[Ll][Oo][Gg][Ii][Nn]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt](?:_?[Ii][Dd])?|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]|[Aa][Cc][Cc][Ee][Ss][Ss]_?[Kk][Ee][Yy](?:_?[Ii][Dd])?)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.@-]+)', 3),
    (4, 'opaque', '([A-Za-z0-9+/_=-]{16,})', 16),
    (5, 'endpoint', '([a-z][a-z0-9+.-]{1,15}://[A-Za-z0-9_.:@-]+(?:/[A-Za-z0-9_./?=&%-]*)?)', 8)
  ) AS k(kind, name, pattern, least)
), cut AS (
  SELECT row, kind, name, least, pattern, string_split_regex(text, pattern) AS gaps, regexp_extract_all(text, pattern) AS hits, regexp_extract_all(text, pattern, 1) AS held, text
  FROM docs, kinds
), hits AS (
  SELECT row, kind, name, least, hit, held, text,
    list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS start
  FROM (SELECT row, kind, name, least, gaps, hits, text, unnest(range(1, len(hits) + 1)) AS i, unnest(hits) AS hit, unnest(held) AS held FROM cut)
), found AS (
  SELECT row, kind, name, start::INTEGER AS s, (start + length(hit))::INTEGER AS e,
    len(regexp_extract_all(text[1:start::INTEGER], '\n[\x20\t\r]*\n')) AS scope
  FROM hits WHERE length(held) >= least AND (kind <> 4 OR (regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]')))
), spans AS (
  SELECT * FROM found f WHERE kind NOT IN (3, 4) OR NOT EXISTS
    (SELECT 1 FROM found b WHERE b.row = f.row AND b.kind < 3 AND b.s < f.e AND f.s < b.e)
), links AS (
  SELECT x.row, x.kind AS k1, x.s AS s1, y.kind AS k2, y.s AS s2
  FROM spans x JOIN spans y ON x.row = y.row AND x.scope = y.scope AND x.kind IN (0, 2, 4) AND y.kind IN (1, 3, 5)
    AND y.s - x.e <= 200 AND x.s - y.e <= 200
), reported AS (
  SELECT * FROM spans p WHERE kind < 3
    OR EXISTS (SELECT 1 FROM links WHERE links.row = p.row AND ((k1 = kind AND s1 = s) OR (k2 = kind AND s2 = s)))
)
SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
  sha256(coalesce(string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (WHERE kind < 3), '')) AS base_sha256,
  coalesce(string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind), '') AS spans
FROM docs LEFT JOIN reported USING (row) GROUP BY row, doc_id
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), texts AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), grams AS (
  SELECT lang, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase, k
  FROM texts, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(words) >= k
), counted AS (
  SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS words FROM counted WHERE k >= 2 AND f >= 30
), cuts AS (
  SELECT lang, phrase, a, unnest(range(1, k)) AS cut, words, k FROM candidates
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
  FROM cuts c
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:c.cut], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[c.cut + 1:], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_phrases AS (
  SELECT lang, a AS longer, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: array_to_string(words[i:i + m - 1], ' '))))) AS phrase
  FROM candidates WHERE k > 2
), covered AS (
  SELECT lang, phrase, max(longer) AS longer FROM inner_phrases GROUP BY ALL
), kept AS (
  SELECT s.* FROM lowest s LEFT JOIN covered v ON v.lang = s.lang AND v.phrase = s.phrase
  WHERE 100::HUGEINT * coalesce(v.longer, 0) < 80::HUGEINT * s.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

ORACLE_SQL = {
    "op1_benchmark_decontamination": DECONTAMINATION,
    "op2_warc": WARC,
    "op4_line_dedup": LINE_DEDUP,
    "op9_exact_dedup": EXACT_DEDUP,
    "op11_secret_scan": SECRET_SCAN,
    "op13_phrase_collocations": COLLOCATIONS,
}
