"""The queries of the operators over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    alignment, centroids, decontaminate, licenses, lm_scores, mixing, packing, quality, secrets, simhash, token_counts, topk, toxicity)


#: Rows that go to a Python worker at a time. Spark's default of 10,000 whole texts takes tens of MB on both sides.
ARROW_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.lm_scores(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=None).drop("text_hash", "n_near_items")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(table(spark, sf_dir, "embeddings"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), carry={"ids_crc32": F.crc32("ids")})
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.clusters(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", F.sha2(F.array_join("centroid", ","), 256)).drop("centroid")


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.alignment(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
        render=_sha256)
    return found.withColumnRenamed("groups", "groups_sha256")


QUERIES = {
    f.__name__: f
    for f in (op1_token_counts, op2_secret_scan, op3_toxicity, op4_lm_scores, op5_simhash, op6_mixing, op7_decontamination, op8_quality,
              op9_exact_topk, op10_license_scan, op11_packing, op12_centroids, op13_alignment)}


def _clusters_sql(k: int = 16, rounds: int = 3) -> str:
    """The rounds of op12 written out one after the other."""
    nearest = """
a{r} AS MATERIALIZED (
  SELECT n, min_by(c, distance * {k} + c) AS c, min(distance) AS distance
  FROM (SELECT v.n, m.c, CAST(list_sum(list_transform(list_zip(v.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
        FROM v CROSS JOIN m{r} m) GROUP BY n)"""
    moved = """
m{next} AS MATERIALIZED (
  SELECT m.c, coalesce(x.v, m.v) AS v
  FROM m{r} m LEFT JOIN (
    SELECT c, list(mean ORDER BY pos) AS v
    FROM (SELECT c, pos, CAST(floor_div AS BIGINT) AS mean
          FROM (SELECT c, pos, (s - ((s % n) + n) % n) // n AS floor_div
                FROM (SELECT a.c, pos, CAST(sum(v.v[pos]) AS BIGINT) AS s, count(*) AS n
                      FROM a{r} a JOIN v USING (n) CROSS JOIN (SELECT unnest(range(1, 65)) AS pos) GROUP BY a.c, pos))) GROUP BY c) x USING (c))"""
    steps = [s.format(r=r, next=r + 1, k=k) for r in range(rounds) for s in (nearest, moved)] + [nearest.format(r=rounds, k=k)]
    return """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
m0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, v FROM v WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT %d)),%s
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a%d a JOIN v USING (n) JOIN m%d m ON m.c = a.c""" % (k, ",".join(steps), rounds, rounds)

SQL = {
    "op6_mixing": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), '-'), text)) AS place, row_number() OVER () AS n
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number
  FROM d GROUP BY source),
c AS (SELECT *, CAST((number - 1) % 3 + 1 AS DOUBLE) AS weight, CAST(3 * source_size AS DOUBLE) AS cap FROM s),
l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM c),
t AS (SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target FROM l),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
r AS (
  SELECT doc_id, size, source_size, target, whole, target - whole * source_size AS budget,
    CAST(sum(size) OVER (PARTITION BY d.source ORDER BY place, n) AS BIGINT) AS upto
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (whole + CASE WHEN upto <= budget OR (upto - size < budget AND upto - budget <= budget - (upto - size)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r""",
    "op7_decontamination": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s:s + 12], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
dw AS (
  SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d CROSS JOIN (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
h AS (SELECT r, s, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
p AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM h) GROUP BY r),
m AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS digest
  FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN m USING (r)""",
    "op9_exact_topk": """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS row, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, row) AS rank FROM s) WHERE rank <= 5""",
    "op12_centroids": _clusters_sql(),
}
