"""Registered queries of the training-data operators, with production parameters.

Each query applies one operator to its whole table; the columns of a query's
contract are derived from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.llm import (alignment, chat_format, ego_join, hnsw, importance, mixing, packing,
                       piece_sampling, quality_gam, sharding, simhash_bk, token_counts, toxicity)
from plume.llm.common import crc_fold, read

TOKENIZERS = "/opt/tokenizers"
QUALITY_FOLD, QUALITY_CUT = (3, 1), 0.5
TOXIC_FOLD, TOXIC_CUT = (4, 2), 0.3


def held_out(fold: tuple[int, int]) -> Column:
    """Rows whose labels are never learned from; a null id is not held out."""
    return F.coalesce(crc_fold("doc_id", fold[0]) == fold[1], F.lit(False))


def train_labels(spark: SparkSession, sf_dir: str, fold: tuple[int, int]) -> DataFrame:
    return read(spark, sf_dir, "labels").filter(~held_out(fold))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text").unionByName(own)
    return chat_format.digests(chat_format.format_turns(rows))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_bk.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.encode(read(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, train_labels(spark, sf_dir, TOXIC_FOLD))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(TOXIC_FOLD).alias("held_out"), "score",
        (F.col("score") >= TOXIC_CUT).cast("int").alias("predicted"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.near_duplicates(read(spark, sf_dir, "embeddings"), cosine=0.9)


def op9_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality_gam.train(docs, train_labels(spark, sf_dir, QUALITY_FOLD))
    return quality_gam.score(docs, model).select(
        "doc_id", held_out(QUALITY_FOLD).alias("held_out"), "score",
        (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json",
                           f"{TOKENIZERS}/piece_bpe_32k.model")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"), n_shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_token_counts": op4_token_counts,
    "op5_toxicity": op5_toxicity,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_mixing": op7_mixing,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_token_packing": op9_token_packing,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
    "op13_sharding": op13_sharding,
}

_OP7 = r"""
WITH sized AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0
              ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
         ((coalesce(doc_id, 0)::HUGEINT * 2654435761) % 4294967296 + 4294967296) % 4294967296 AS k
  FROM documents),
sources AS (SELECT source, sum(size)::DOUBLE AS source_size FROM sized GROUP BY source),
named AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS rk
  FROM sources),
weighed AS (
  SELECT *, CASE rk % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END::DOUBLE AS weight,
         2 * source_size AS most FROM named),
priced AS (
  SELECT *, row_number() OVER o AS place,
         (sum(source_size) OVER () * 1.5::DOUBLE
          - coalesce(sum(most) OVER (ORDER BY most / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY most / weight, rk)),
price AS (SELECT arg_min(level, place) AS level FROM priced WHERE most > level * weight),
targets AS (
  SELECT p.source, p.rk, p.source_size,
         CASE WHEN p.most <= p.level * p.weight OR price.level IS NULL THEN p.most
              ELSE least(p.most, price.level * p.weight) END AS target
  FROM priced p, price),
laid AS (
  SELECT d.doc_id, d.size, t.source_size::BIGINT AS source_size, t.target, t.rk,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id NULLS FIRST, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
cut AS (
  SELECT *, greatest(0, least(size, round(target)::BIGINT - start)) AS t1,
         greatest(0, least(size, round(target)::BIGINT - start - source_size)) AS t2,
         CASE rk % 3 WHEN 0 THEN -0.8 WHEN 1 THEN 0.0 ELSE 0.8 END::DOUBLE AS s,
         least(1.0::DOUBLE, start::DOUBLE / target) AS y1,
         least(1.0::DOUBLE, (start + source_size)::DOUBLE / target) AS y2
  FROM laid)
SELECT doc_id, size, source_size, target, (t1 + t2)::BIGINT AS taken,
       CASE WHEN t1 <= 0 THEN NULL WHEN s = 0 THEN y1 ELSE
         greatest(0.0::DOUBLE, least(1.0::DOUBLE, (-(1 - s) + sqrt((1 - s) * (1 - s) + 4 * s * y1)) / (2 * s))) END
         AS position1,
       CASE WHEN t2 <= 0 THEN NULL WHEN s = 0 THEN y2 ELSE
         greatest(0.0::DOUBLE, least(1.0::DOUBLE, (-(1 - s) + sqrt((1 - s) * (1 - s) + 4 * s * y2)) / (2 * s))) END
         AS position2
FROM cut
"""

_OP11 = r"""
WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS t
  FROM range(256) r(i)),
docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
aims AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
placed AS (
  SELECT row_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs
  UNION ALL SELECT -1, w, unnest(range(1, len(w) + 1)) FROM aims),
runs AS (
  SELECT row_id, w[i] AS f FROM placed
  UNION ALL SELECT row_id, w[i] || ' ' || w[i + 1] FROM placed WHERE i + 1 <= len(w)
  UNION ALL SELECT row_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM placed WHERE i + 2 <= len(w)),
many AS (SELECT row_id, f, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(range(octet_length(encode(f))),
                            lambda i: ('0x' || substr(hex(encode(f)), (2 * i + 1)::BIGINT, 2))::BIGINT)),
             lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM many), crc_table),
found AS (SELECT row_id, bucket, sum(n) AS n FROM many JOIN hashed USING (f) GROUP BY ALL),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE row_id >= 0), 0)::DOUBLE AS s,
         coalesce(sum(n) FILTER (WHERE row_id < 0), 0)::DOUBLE AS t FROM found GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain
  FROM sums),
weights AS (SELECT row_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
            FROM found JOIN gains USING (bucket) WHERE row_id >= 0 GROUP BY row_id),
scored AS (
  SELECT doc_id, len(w) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256(concat('42:', doc_id)), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (row_id)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST, n_features DESC) AS place,
         count(*) FILTER (WHERE able) OVER () AS n
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 5 * n // 100 THEN place END AS rank
FROM ranked
"""

ORACLE_SQL: dict[str, str] = {"op7_mixing": _OP7, "op11_importance_resampling": _OP11}
