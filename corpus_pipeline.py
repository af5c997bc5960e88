"""A corpus pipeline: toxic documents go, near-duplicates and repeated passages go, sources are mixed, and what stays is encoded.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the columns of documents;
the last returns doc_id, n_tokens, ids, ids_sha256 and decoded_sha256.

In every stage a null text counts as the empty text, null ids, languages and sources are values like others, columns besides those of documents ride along whatever their names (and
are dropped by the last stage), repeated rows are rows of their own (until the second stage, which keeps one), texts are read whole however long, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from colonnade.llm import bpe, mixing, nearcopies, repeats, toxicity
from colonnade.llm.common import stored, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold. Empty texts are scored, too; where a class has no labels every score is 0 and all stay."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, a verified Jaccard similarity of 0.8 or more. Of a group the smallest doc_id stays, a null one
    only where there is no other; all texts without words are copies of each other."""
    return nearcopies.representatives(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages that also start elsewhere; one that loses all stays, with an empty text, and n_chars is counted anew."""
    return repeats.clean(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents by source, language and topic weights. A document without an id draws by its text."""
    return mixing.rows_of_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and digests of them and of what they decode to; an empty text has no ids."""

    def emit(codec: bpe.Codec, ids: list[list[int]]) -> dict[str, pa.Array]:
        return {
            "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
            "ids": pa.array(ids, pa.list_(pa.int32())),
            "ids_sha256": pa.array([bpe.digest(x) for x in ids], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in ids], pa.string()),
        }

    return bpe.encode_texts(docs, VOCABULARY, public_tokenizers.PATTERN, emit, "n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-duplicates", drop_near_duplicates),
    ("suffix-array repeats", drop_repeats),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL can express neither the trained scores nor the suffix sort; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written to the shared folder for the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
