"""Queries of the operators, each over its whole table; SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docketry.llm.collocations import collocations
from docketry.llm.decontaminate import contamination_report
from docketry.llm.knn_join import nearest_report
from docketry.llm.language_id import language_report
from docketry.llm.line_dedup import line_report
from docketry.llm.media import media_report
from docketry.llm.merkle import manifest_report
from docketry.llm.mixing import mix
from docketry.llm.ngram_join import jaccard_components
from docketry.llm.quality import quality_report
from docketry.llm.secret_scan import secret_report
from docketry.llm.token_files import token_report
from docketry.llm.warc import warc_report

#: A vocabulary file of the public tokenizers.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_report(spark, table(spark, sf_dir, "pages"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op8_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_report(table(spark, sf_dir, "embeddings"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_report(spark, table(spark, sf_dir, "documents"), BYTE_BPE)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_report(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_language_id,
        op3_quality,
        op4_source_mix,
        op5_line_dedup,
        op6_warc,
        op7_ngram_join,
        op8_knn_join,
        op9_token_files,
        op10_decontamination,
        op11_merkle_manifest,
        op12_collocations,
        op13_media_columns,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op6_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages),
d AS (SELECT page_id, first_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS hex FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
 array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((((strpos('0123456789abcdef', substr(hex, CAST(i * 5 // 4 + 1 AS INT), 1)) - 1) * 16 + greatest(strpos('0123456789abcdef', substr(hex, CAST(i * 5 // 4 + 2 AS INT), 1)) - 1, 0)) // CAST(pow(2, 3 - i * 5 % 4) AS BIGINT)) % 32 AS INT), 1)), '') AS payload_digest,
 CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM d""",
    "op7_ngram_join": r"""
WITH RECURSIVE dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, w[i : i + least(len(w), 3) - 1] AS s FROM dw, range(1, len(w) - least(len(w), 3) + 2) r(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 90 * (x.n + y.n - m)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.b, reach.root FROM reach JOIN e ON e.a = reach.node WHERE reach.root < e.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, min(root)) AS component_id FROM documents d JOIN reach ON node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n""",
    "op8_knn_join": r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS "rank" FROM s)
SELECT query_id, CAST("rank" AS INT) AS "rank", vec_id, score FROM r WHERE "rank" <= 5""",
    "op11_merkle_manifest": r"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT *, coalesce(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 0) AS reg FROM documents, tab),
f AS (SELECT doc_id, lang, coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS a,
 n_chars, CASE WHEN xor(reg, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS m_chars, coalesce(octet_length(encode(text)) || ':' || text, '-') AS z FROM d),
h AS (SELECT doc_id, lang, sha256(a || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || z) AS leaf, sha256(a || coalesce(length(CAST(m_chars AS VARCHAR)) || ':' || m_chars, '-') || z) AS changed FROM f),
p AS (SELECT *, coalesce('=' || lang, '') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM h),
low AS (SELECT g, 0 AS lev, list(leaf ORDER BY i) AS x FROM p GROUP BY g
 UNION ALL SELECT g, lev + 1, list_transform(range(0, len(x), 2), lambda j: sha256(x[j + 1] || coalesce(x[j + 2], ''))) FROM low WHERE len(x) > 1),
s AS (SELECT g, lev AS depth, x[1] AS subroot, row_number() OVER (ORDER BY g) - 1 AS gi FROM low WHERE len(x) = 1),
high AS (SELECT 0 AS lev, list(subroot ORDER BY gi) AS x FROM s
 UNION ALL SELECT lev + 1, list_transform(range(0, len(x), 2), lambda j: sha256(x[j + 1] || coalesce(x[j + 2], ''))) FROM high WHERE len(x) > 1),
lev AS (SELECT g, lev, x FROM low WHERE len(x) > 1 UNION ALL SELECT s.g, s.depth + high.lev, high.x FROM s, high WHERE len(high.x) > 1),
walk AS (SELECT p.doc_id, p.leaf, p.g, 0 AS lev, p.i, s.gi, s.depth, s.subroot, '' AS proof, p.changed AS node FROM p JOIN s ON s.g = p.g
 UNION ALL SELECT w.doc_id, w.leaf, w.g, w.lev + 1, w.at // 2, w.gi, w.depth, w.subroot, w.proof || coalesce(l.x[xor(w.at, 1) + 1], ''),
  sha256(CASE WHEN w.at % 2 = 1 THEN l.x[w.at] || w.node ELSE w.node || coalesce(l.x[w.at + 2], '') END) FROM (SELECT *, CASE WHEN lev = depth THEN gi ELSE i END AS at FROM walk) w JOIN lev l ON l.g = w.g AND l.lev = w.lev),
r AS (SELECT x[1] AS root FROM high WHERE len(x) = 1), m AS (SELECT g, max(lev) + 1 AS last FROM lev GROUP BY g)
SELECT w.doc_id, w.leaf, w.subroot, r.root, sha256(w.proof) AS proof_sha256, w.node AS folded_root, w.node = r.root AS verified FROM walk w JOIN r ON true LEFT JOIN m ON m.g = w.g WHERE w.lev = coalesce(m.last, 0)""",
    "op12_collocations": r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t), u AS MATERIALIZED (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, 1 AS k, w[i] AS phrase FROM u UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM u WHERE i < len(w) UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM u WHERE i + 1 < len(w)),
c AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM g GROUP BY ALL HAVING count(*) >= 10), n AS (SELECT lang, count(*) AS n FROM u GROUP BY lang),
x AS (SELECT *, 1 AS j, w[1] AS p, w[2] AS q FROM c WHERE k = 2 UNION ALL SELECT *, 1, w[1], w[2] || ' ' || w[3] FROM c WHERE k = 3 UNION ALL SELECT *, 2, w[1] || ' ' || w[2], w[3] FROM c WHERE k = 3),
y AS (SELECT x.lang, x.phrase, x.a, j, l.a AS l, r.a AS r, CAST(1000000 * CAST(x.a AS HUGEINT) * x.a // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score FROM x JOIN c l ON l.lang = x.lang AND l.phrase = p JOIN c r ON r.lang = x.lang AND r.phrase = q),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS best FROM y),
o AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, w[1] || ' ' || w[2] AS phrase FROM c WHERE k = 3 UNION ALL SELECT lang, a, w[2] || ' ' || w[3] FROM c WHERE k = 3) GROUP BY ALL),
z AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS "rank" FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE best = 1 AND (longer IS NULL OR 100 * longer < 50 * b.a))
SELECT z.lang, "rank", phrase, a, l, r, n, score FROM z JOIN n ON n.lang = z.lang WHERE "rank" <= 2000""",
    "op10_decontamination": r"""
WITH iw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
ig AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, w[i : i + least(len(w), 13) - 1] AS g FROM iw, range(1, len(w) - least(len(w), 13) + 2) r(i) WHERE len(w) > 0),
dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dg AS (SELECT doc_id, n, i, w[i : i + n - 1] AS g FROM dw, (SELECT DISTINCT n FROM ig) s, range(1, len(w) - n + 2) r(i)),
h AS (SELECT doc_id, i, dg.n, item_id FROM dg JOIN ig ON dg.n = ig.n AND dg.g = ig.g),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY 1)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
 coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM dw LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""",
}
