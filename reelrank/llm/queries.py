"""The registered queries of the training-data operators: name -> f(spark, sf_dir)."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.alignment import align_texts, score_links
from reelrank.llm.bloom_lm import score_texts
from reelrank.llm.bpe_pairs import encode_decode
from reelrank.llm.common import ascii_lower, table
from reelrank.llm.language_ecoc import identify
from reelrank.llm.line_frequency import line_quality
from reelrank.llm.merkle_manifest import COLUMNS, fold, leaf_digest, manifest, proof
from reelrank.llm.mixing import mix_to_weights
from reelrank.llm.permutation_index import search
from reelrank.llm.quote_threads import link_quotes
from reelrank.llm.sharding import shard_rows
from reelrank.llm.simhash_bktree import near_duplicates
from reelrank.llm.toxicity_ordinal import score_toxicity
from reelrank.llm.url_filters import judge_urls
from reelrank.session import cut_lineage

# The URL rules (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

# Target weights of the mixture; nodes that are not named weigh 1.
MIX_LEVELS = ("domain", "lang", "source")
MIX_WEIGHTS = {
    ("d0",): 4.0, ("d1",): 2.0,
    ("d0", "en"): 3.0, ("d1", "en"): 2.0, ("d2", "de"): 2.0,
    ("d0", "en", "src0"): 2.0, ("d1", "fr", "src1"): 3.0,
}
MIX_BUDGET_SHARE = 0.5
MIX_EPOCHS = 2

SHARDS = 16


def default_tokenizer() -> str:
    """The byte-level BPE file: $BPE_TOKENIZER, or that of the public tokenizers package."""
    if path := os.environ.get("BPE_TOKENIZER"):
        return path
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def default_pieces() -> str:
    """The sentence-piece file: $PIECE_TOKENIZER, or that of the public tokenizers package."""
    if path := os.environ.get("PIECE_TOKENIZER"):
        return path
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def id_remainder(id_col: str, n: int) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % n


def as_mail(conversations: DataFrame) -> DataFrame:
    """Conversations as mail programs send them: every message first quotes the message
    before it, which itself starts with its quote of the one before that."""
    own = F.coalesce("text", F.lit(""))

    def quoted(marks: str, text: Column) -> Column:
        return F.array_join(F.transform(F.split(text, "\n", -1),
                                        lambda x: F.concat(F.lit(marks), x)), "\n")

    def earlier(back: int) -> DataFrame:
        return (conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL")
                .groupBy(F.col("conv_id").alias(f"_c{back}"),
                         (F.col("turn") + back).alias(f"_o{back}"))
                .agg(F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"),
                                    own.alias("text"))).alias(f"_m{back}")))

    one, two = earlier(1), earlier(2)
    joined = (conversations.join(one, (F.col("conv_id") == F.col("_c1"))
                                 & (F.col("turn") == F.col("_o1")), "left")
              .join(two, (F.col("conv_id") == F.col("_c2")) & (F.col("turn") == F.col("_o2")),
                    "left"))
    inner = F.when(F.col("_m2").isNotNull(), F.concat(
        F.lit("> On turn "), (F.col("turn") - 2).cast("string"), F.lit(", "), F.col("_m2.role"),
        F.lit(" wrote:\n"), quoted("> > ", F.col("_m2.text")), F.lit("\n"))).otherwise(F.lit(""))
    outer = F.when(F.col("_m1").isNotNull(), F.concat(
        F.lit("On turn "), (F.col("turn") - 1).cast("string"), F.lit(", "), F.col("_m1.role"),
        F.lit(" wrote:\n"), inner, quoted("> ", F.col("_m1.text")), F.lit("\n\n"))
    ).otherwise(F.lit(""))
    return joined.select("conv_id", "turn", "role", F.concat(outer, own).alias("text"))


def op1_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reply-ordered conversations without quotes, from all conversations in mail form."""
    out = link_quotes(as_mail(table(spark, sf_dir, "conversations")))
    return out.select("conv_id", "turn", "role", "body", F.sha2("body", 256).alias("body_sha256"),
                      "n_quoted_lines", "quote_levels", "reply_to", "root", "depth", "position")


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows by inner product of every twentieth embedding."""
    return search(table(spark, sf_dir, "embeddings"))


def op3_language_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    learn = docs.where(F.col("lang").isNotNull() & (id_remainder("doc_id", 5) != 0))
    held = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))
    return identify(docs, learn, held_out=held)


def op4_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity and toxicity of every document, learnt from the labels."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_bpe_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids and the decoded text of every document."""
    out = encode_decode(table(spark, sf_dir, "documents"), default_tokenizer())
    return bpe_digests(out)


def bpe_digests(encoded: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL under ``URL_RULES``."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    out = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op7_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints (4-word shingles) and components at 4 bits of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op8_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and quality verdict of every document; its source is the host."""
    out = line_quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "n_line_chars", "n_left_chars")


def op9_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log10 probability of every document, learnt from nine tenths."""
    docs = table(spark, sf_dir, "documents")
    rest = id_remainder("doc_id", 10)
    return score_texts(docs, train=rest != 0, held_out=rest == 0)


def with_domain(docs: DataFrame) -> DataFrame:
    """Adds ``domain``: sources are grouped by their number; 'other' without one."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), r"([0-9]{1,9})$", 1)
    return docs.withColumn("domain", F.when(number == "", F.lit("other")).otherwise(
        F.concat(F.lit("d"), F.pmod(number.try_cast("int"), F.lit(4)).cast("string"))))


def op10_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents (and epochs) that meet the target weights with half of all tokens."""
    out = mix_to_weights(with_domain(table(spark, sf_dir, "documents")), MIX_LEVELS, MIX_WEIGHTS,
                         MIX_BUDGET_SHARE, MIX_EPOCHS)
    return out.select("doc_id", "domain", "lang", "source", "n_tokens", "epoch", "order_key")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether a third of them, with their
    texts in lower case, still fold to the root."""
    docs = table(spark, sf_dir, "documents")
    lowered = leaf_digest([ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in COLUMNS])
    tampered = F.coalesce(id_remainder("doc_id", 3) == 0, F.lit(False))
    out = manifest(docs, carry={"lowered": F.when(tampered, lowered)})
    out = out.withColumn("folded_root", fold(F.coalesce("lowered", "leaf"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root",
                      F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups and links between two tokenizers, for every document."""
    aligned = align_texts(table(spark, sf_dir, "documents"), default_tokenizer(), default_pieces())
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    written = cut_lineage(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return score_links(written).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best",
                                       "count_sum", "groups_sha256")


def op13_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot and shard after growth of every document; its id is the key."""
    docs = table(spark, sf_dir, "documents")
    out = shard_rows(docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32")), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                      "grown_shard")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quote_threads, op2_permutation_index, op3_language_ecoc, op4_toxicity_ordinal,
        op5_bpe_pairs, op6_url_filters, op7_simhash_bktree, op8_line_frequency, op9_bloom_lm,
        op10_mix_to_weights, op11_merkle_manifest, op12_token_alignment, op13_jump_shards)
}
