"""The queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audio, bpe, mixing, repeats, sharding, simhash, topk, toxicity, warc, wrapper
from .common import durable, table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents sampled to the target weights of mixing.TARGETS."""
    kept = mixing.mix(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "source", "lang", "topic", "tokens", F.round("probability", 6).alias("probability"))


def op2_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of the recordings that sonify makes of embeddings, and the matches of other recordings - later by part of a hop, with 20 dB of noise - of the rows whose id is
    divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    prints = durable(audio.fingerprints(audio.sonify(vectors)))
    asked = audio.fingerprints(audio.sonify(vectors.where(F.col("vec_id") % 50 == 0), delay=200, noise=0.1))
    return audio.match_recordings(prints, asked, among=False)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents encoded by a public vocabulary, and decoded again."""
    return bpe.encode_digests(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents in 16 shards whose row counts are at most one apart."""
    return sharding.bounded_ring(table(spark, sf_dir, "documents"), shards=16)


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows of embeddings for each row whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.exact_topk(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document, learnt from the labels of the training folds."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return wrapper.main_texts(table(spark, sf_dir, "pages"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 200-byte strings that also start elsewhere."""
    return repeats.digests(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and conversion records of every page."""
    return warc.derive_pages(table(spark, sf_dir, "pages"))


#: The vocabulary file that op3 and the pipeline use; a parameter of the operator.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_audio": op2_audio,
    "op3_bpe": op3_bpe,
    "op4_sharding": op4_sharding,
    "op5_topk": op5_topk,
    "op6_toxicity": op6_toxicity,
    "op7_wrapper": op7_wrapper,
    "op8_repeats": op8_repeats,
    "op9_simhash": op9_simhash,
    "op10_warc": op10_warc,
}

ORACLE: dict[str, str] = {
    "op1_mixing": mixing.oracle(),
    "op5_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
}
