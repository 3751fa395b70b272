"""The corpus pipeline: toxicity, language, near-duplicates, mixing and encoding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir). ``run`` applies
them to the documents in order, writing each result as Parquet and reading it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.bpe_pairs import encode_decode
from reelrank.llm.common import Shelved, table
from reelrank.llm.language_ecoc import identify
from reelrank.llm.mixing import mix_to_weights
from reelrank.llm.queries import (MIX_EPOCHS, MIX_LEVELS, MIX_WEIGHTS, bpe_digests,
                                  default_tokenizer, id_remainder, with_domain)
from reelrank.llm.simhash_bktree import near_duplicates
from reelrank.llm.toxicity_ordinal import score_toxicity
from reelrank.session import cut_lineage

# The mixture keeps up to this share of the tokens that reach it.
PIPELINE_BUDGET_SHARE = 0.8
# Documents whose two best languages score closer than this are rejected.
PIPELINE_MIN_GAP = 0.05


def row_key() -> Column:
    """What a decision is about: a doc_id (null after all others) and its text. Rows that
    share an id, or have none, are told apart by their texts."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                    F.xxhash64("text").alias("text"))


def _select(docs: DataFrame, judged: DataFrame, key: str, how: str) -> DataFrame:
    """The rows of ``docs`` whose key is (left_semi) or is not (left_anti) in ``judged``."""
    found = cut_lineage(judged.select(F.col(key).alias("found")).distinct(), "judged-keys")
    shelf = Shelved(docs)
    own = F.struct(F.col(shelf.at("doc_id")).isNull().alias("none"),
                   F.col(shelf.at("doc_id")).alias("id"),
                   F.xxhash64(shelf.at("text")).alias("text"))
    return shelf.finish(shelf.table.withColumn("own", own)
                        .join(found, F.col("own") == F.col("found"), how))


def _judged(docs: DataFrame, *columns: str) -> DataFrame:
    """What a judgement reads: the key of each row, its text and ``columns``."""
    return docs.select(row_key().alias("key"), "text", *columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    judged = score_toxicity(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"),
                            key=row_key())
    return _select(docs, judged.where("toxic"), "doc_id", "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: not ``und``, and not ambiguous between two languages."""
    keyed = _judged(docs, "doc_id", "lang")
    learn = keyed.where(F.col("lang").isNotNull() & (id_remainder("doc_id", 5) != 0))
    judged = identify(keyed, learn, id_col="key", min_gap=PIPELINE_MIN_GAP)
    bad = judged.where((F.col("lang_pred") == "und") | F.col("ambiguous"))
    return _select(docs, bad, "key", "left_anti")


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: that with the smallest doc_id (one without an id only
    where no other has one), and one row of it."""
    found = near_duplicates(_judged(docs), id_col="key", shingle=4, radius=4)
    first = found.where(F.col("key") == F.col("component_id"))
    shelf = Shelved(_select(docs, first, "key", "left_semi"))
    return shelf.finish(shelf.table.withColumn("hash", F.xxhash64(shelf.at("text")))
                        .dropDuplicates([shelf.at("doc_id"), "hash"]))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents (repeated by epoch) that meet the target weights."""
    shelf = Shelved(docs)
    own = shelf.table.withColumns({c: F.col(shelf.at(c)) for c in ("doc_id", "text", "lang", "source")})
    out = mix_to_weights(with_domain(own), MIX_LEVELS, MIX_WEIGHTS, PIPELINE_BUDGET_SHARE, MIX_EPOCHS)
    return shelf.finish(out)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and decoded text of what is left."""
    return bpe_digests(encode_decode(docs, default_tokenizer()))


STAGES = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_duplicates", near_duplicate),
    ("mixing", mixing),
    ("bpe_encoding", encoding),
]

# Trained models, fingerprints and merges are beyond SQL; the tests hold the rows of run()
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
