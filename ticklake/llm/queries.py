"""The registered queries of the subpackage: name -> fn(spark, sf_dir).

Each applies one operator, with the parameters below, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import (
    bitslice, blockjoin, bpe, chat, interpolation, linededup, merkle, mixing, pii, quality, simhash, trie, warc)
from ticklake.llm.common import id_remainder
from ticklake.sources.tables import read_table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


@query("op1_bitsliced_topk")
def op1_bitsliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.search(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
                           F.col("vec_id") % 20 == 0, k=20)


@query("op2_line_windows")
def op2_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return linededup.dedup_lines(docs)


MIX_LEVELS = ["domain", "lang", "source"]
MIX_WEIGHTS = [{"web": 4, "books": 3, "news": 2, "code": 1}, {"en": 5, "de": 2, "fr": 2, "es": 1}, {}]
MIX_SEED = 17


def with_domain(docs: DataFrame, name: str = "domain") -> DataFrame:
    """The tables name no domain: sources are dealt to four by their md5."""
    first = F.substring(F.md5(F.coalesce("source", F.lit("")).cast("binary")), 1, 1)
    return docs.withColumn(name, F.when(first < "4", "web").when(first < "8", "books")
                           .when(first < "c", "news").otherwise("code"))


@query("op3_mix_sources")
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_domain(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return mixing.choose(docs, MIX_LEVELS, MIX_WEIGHTS, share=(1, 2), epochs=2, seed=MIX_SEED).drop("key")


@query("op4_simhash_vptree")
def op4_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash.near_duplicates(docs, shingle=4, radius=4).select("doc_id", "fingerprint", "component_id")


@query("op5_skipchain_pii")
def op5_skipchain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return pii.find(docs, pii.train(docs))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    return quality.train(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))


@query("op6_warc_derivatives")
def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(read_table(spark, sf_dir, "pages", "page_id", "url", "html")))


@query("op7_bradley_terry_quality")
def op7_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    scored = quality.score(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


def multilingual_ranks() -> tuple[dict[bytes, int], str]:
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return bpe.load_ranks(f.read()), public_tokenizers.PATTERN


@query("op8_bpe_transducer")
def op8_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encode_documents(docs, *multilingual_ranks())


@query("op9_deleted_interpolation")
def op9_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op10_block_join_ann")
def op10_block_join_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockjoin.search(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
                            F.col("vec_id") % 100 == 0, k=10)


HARD_TEXT = "\\### Assistant: </turn> ok"      # conversation -7: a text of the format's own control strings


@query("op11_chat_template")
def op11_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit(HARD_TEXT).alias("text"))
    return chat.read_back(chat.format_conversations(rows.unionByName(hard)))


@query("op12_merkle_manifest")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit_documents(read_table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text"))


@query("op13_prefix_trie")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations rebuilt on the first turns of every twentieth one."""
    c = F.col("conv_id")
    seqs = trie.sequences(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return trie.prefix_trie(trie.with_heads(seqs, (id_remainder(c, 4)).cast("int"), c - c % 20, longest=3))
