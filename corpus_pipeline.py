"""Corpus pipeline over ``documents``: five stages, each a table to the next.

    1 quality     Bradley-Terry scores; documents below the cut go
    2 lines       repeated three-line windows go; texts left empty by it go
    3 near_dups   SimHash groups; the document of the smallest id stays
    4 mixture     leaves are cut to their share of the token budget
    5 tokens      byte-level BPE ids and digests of each document

Stages 1 to 4 return the columns of documents (``n_chars`` follows the text);
stage 5 returns doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids.
``run`` writes each stage's result to the shared checkpoint folder and reads
it again, so that a lost executor costs at most the stage it was in.
"""

from pyspark.sql import functions as F

from ticklake.llm import bpe, linededup, mixing, quality, queries, simhash
from ticklake.llm.common import store


def quality_stage(spark, docs, sf_dir):
    return quality.reject(docs, queries.quality_model(spark, docs, sf_dir))


def line_stage(spark, docs, sf_dir):
    """Documents of which nothing is left go; what was empty before stays."""
    out = linededup.dedup_lines(docs, n_lines="_lines", n_removed="_removed")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_removed") > 0, F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.where((F.col("_removed") == 0) | (F.length("text") > 0)).select(docs.columns)


def near_duplicate_stage(spark, docs, sf_dir):
    return simhash.keep_first(docs, shingle=4, radius=4)


def mixing_stage(spark, docs, sf_dir):
    """Three quarters of the tokens, no document more than once.  The level
    that the documents lack has a name of its own: a column ``domain`` of
    theirs passes through."""
    domain = "_mixing_" + queries.MIX_LEVELS[0]
    mixed = mixing.mix(queries.with_domain(docs, domain), [domain, *queries.MIX_LEVELS[1:]], queries.MIX_WEIGHTS,
                       share=(3, 4), epochs=1, seed=queries.MIX_SEED)
    return mixed.select(docs.columns)


def token_stage(spark, docs, sf_dir):
    return bpe.encode_documents(docs, *queries.multilingual_ranks(), with_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_dups", near_duplicate_stage),
    ("mixture", mixing_stage),
    ("tokens", token_stage),
]

# The first stage is a fitted model, which SQL cannot express: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
