"""Named queries of this package: ``opN_<name>`` and ``pipeline``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lapse.llm import alignment, best_fit
from lapse.llm.common import table
from lapse.llm.decontamination import contaminated
from lapse.llm.fingerprints import fingerprints
from lapse.llm.language_model import scores
from lapse.llm.licenses import scan
from lapse.llm.merkle import every_third, manifest
from lapse.llm.near_dedup import near_duplicates
from lapse.llm.packing import VOCABULARY, pack
from lapse.llm.paragraph_dedup import repeated_passages
from lapse.llm.quality import quality_scores
from lapse.llm.sharding import shard
from lapse.llm.suffix_dedup import repeated_strings


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op6_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_strings(table(spark, sf_dir, "documents")).drop("starts", "stops")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("detections")


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(table(spark, sf_dir, "documents"), public_tokenizers.path(alignment.A_MODEL),
                                public_tokenizers.path(alignment.B_MODEL))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"), every_third()).drop("path")


QUERIES = {f.__name__: f for f in (
    op1_near_dedup, op2_passages, op3_quality, op4_sharding, op5_fingerprints, op6_repeated_strings,
    op7_decontamination, op8_licenses, op9_lm_scores, op10_packing, op11_alignment, op12_best_fit, op13_merkle)}

#: Links between all documents that share a shingle, by their full sets, and
#: the smallest document reachable over them.
_NEAR_DEDUP = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b
      ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * common >= 85 * (x.n + y.n - common)),
e AS (SELECT a AS u, b AS v FROM l UNION ALL SELECT b AS u, a AS v FROM l),
r AS (SELECT u, u AS root FROM e UNION SELECT e.v AS u, r.root FROM r JOIN e ON e.u = r.u),
c AS (SELECT u, min(root) AS root FROM r GROUP BY u)
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.root, t.doc_id) AS component_id,
       t.doc_id = coalesce(c.root, t.doc_id) AS kept
FROM t LEFT JOIN n ON n.doc_id = t.doc_id LEFT JOIN c ON c.u = t.doc_id"""

#: All windows of 100 bytes (as hexadecimal digits) that also start earlier,
#: their runs, and the digest of what lies between the runs.
_REPEATED_STRINGS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT d.doc_id, t.p, md5(substr(d.x, 2 * t.p + 1, 200)) AS s
      FROM d, unnest(range(0, CAST(length(d.x) // 2 AS BIGINT) - 99)) AS t(p)),
m AS (SELECT doc_id, p FROM (
        SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w) WHERE k > 1),
g AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS fresh FROM m),
h AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM g),
r AS (SELECT doc_id, span, min(p) AS a, max(p) + 100 AS b FROM h GROUP BY doc_id, span),
k AS (SELECT doc_id, lag(b, 1, CAST(0 AS BIGINT)) OVER (PARTITION BY doc_id ORDER BY a) AS one, a AS two FROM r
      UNION ALL SELECT doc_id, max(b) AS one, NULL AS two FROM r GROUP BY doc_id),
kept AS (SELECT k.doc_id, string_agg(CASE WHEN two IS NULL THEN substr(x, 2 * one + 1)
                                     ELSE substr(x, 2 * one + 1, 2 * (two - one)) END, '' ORDER BY one) AS hx
         FROM k JOIN d ON k.doc_id = d.doc_id GROUP BY k.doc_id),
t AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(length(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(t.removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(t.spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.hx, d.x))) AS kept_sha256
FROM d LEFT JOIN t ON t.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

#: Leaves numbered per language, levels by recursion, siblings of every node on
#: the way up, and the root folded again; CRC-32 bit by bit.
_MERKLE = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang, text, coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
      || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
      || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
          lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, c: list_reduce(list_prepend(xor(crc, c), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
          lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END)),
        CAST(4294967295 AS BIGINT)) AS crc FROM documents),
h AS (SELECT doc_id, lang, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
        CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(octet_length(encode(low)) || ':' || low, '-')) END AS changed FROM f),
leaf AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS place FROM h),
n AS (
  SELECT lang, 0 AS level, place, leaf AS digest FROM leaf
  UNION ALL
  SELECT lang, level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS nodes FROM n) WHERE nodes > 1 GROUP BY lang, level, place // 8),
sub AS (SELECT lang, level AS top, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
        FROM (SELECT *, max(level) OVER (PARTITION BY lang) AS top FROM n) WHERE level = top),
m AS (
  SELECT 0 AS level, place, digest FROM sub
  UNION ALL
  SELECT level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM (SELECT *, count(*) OVER () AS nodes FROM m) WHERE nodes > 1 GROUP BY level, place // 8),
root AS (SELECT digest FROM m WHERE level = (SELECT max(level) FROM m)),
s AS (
  SELECT lang, level, place, coalesce(string_agg(digest, '' ORDER BY place) OVER (
      PARTITION BY lang, level, place // 8 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '' ORDER BY place) OVER (
      PARTITION BY lang, level, place // 8 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM n),
t AS (
  SELECT level, place, coalesce(string_agg(digest, '' ORDER BY place) OVER (
      PARTITION BY level, place // 8 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '' ORDER BY place) OVER (
      PARTITION BY level, place // 8 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM m),
step AS (
  SELECT leaf.lang, leaf.place, s.level, s.l, s.r FROM leaf JOIN sub ON leaf.lang IS NOT DISTINCT FROM sub.lang
    JOIN s ON s.lang IS NOT DISTINCT FROM leaf.lang AND s.level < sub.top AND s.place = leaf.place >> CAST(3 * s.level AS INT)
  UNION ALL
  SELECT leaf.lang, leaf.place, sub.top + t.level, t.l, t.r FROM leaf JOIN sub ON leaf.lang IS NOT DISTINCT FROM sub.lang
    JOIN t ON t.level < (SELECT max(level) FROM m) AND t.place = sub.place >> CAST(3 * t.level AS INT)),
fold AS (
  SELECT lang, place, 0 AS level, coalesce(changed, leaf) AS digest FROM leaf
  UNION ALL
  SELECT fold.lang, fold.place, fold.level + 1, sha256(step.l || fold.digest || step.r) FROM fold JOIN step
    ON fold.lang IS NOT DISTINCT FROM step.lang AND fold.place = step.place AND fold.level = step.level),
done AS (SELECT lang, place, arg_max(digest, level) AS digest FROM fold GROUP BY lang, place),
proof AS (SELECT lang, place, sha256(string_agg(l || r, '' ORDER BY level)) AS digest FROM step GROUP BY lang, place)
SELECT leaf.doc_id, leaf.leaf, sub.digest AS subroot, root.digest AS root, coalesce(proof.digest, sha256('')) AS proof_sha256,
       done.digest AS folded_root, done.digest = root.digest AS verified
FROM leaf JOIN root ON true JOIN sub ON leaf.lang IS NOT DISTINCT FROM sub.lang
  JOIN done ON done.lang IS NOT DISTINCT FROM leaf.lang AND done.place = leaf.place
  LEFT JOIN proof ON proof.lang IS NOT DISTINCT FROM leaf.lang AND proof.place = leaf.place"""

#: The other operators have no SQL (models, tokenizers, hashes of their own) or
#: none that ends on whole tables; tests compare them with brute force.
ORACLE_SQL: dict[str, str] = {"op1_near_dedup": _NEAR_DEDUP, "op6_repeated_strings": _REPEATED_STRINGS,
                              "op13_merkle": _MERKLE}
