"""Preparation of the documents table for training, in five stages.

Each stage reads the documents that its predecessor kept and returns the columns of
``documents``; the last one returns the encoded documents.  ``run`` writes every result as
Parquet in the shared checkpoint folder and rereads it for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscape.llm import bpe, decontam, exact_dedup, ngram_join, quality
from cellscape.llm.queries import MIN_SCORE, quality_model, table, tokenizer_file
from cellscape.session import Scratch


#: Pieces that a worker of the last stage remembers: few, since the stages before left the executors' heaps full.
CODEC_MEMO = 100_000


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score under MIN_SCORE) go."""
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, out="_score", forget=True)
    return scored.where(F.col("_score") >= MIN_SCORE).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 on five-word shingles one stays."""
    return ngram_join.one_of_each_group(docs, k=5, similarity=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark windows over a twentieth of their words go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, and the text decoded from them."""
    import public_tokenizers

    tokens = bpe.read_ranks(tokenizer_file())
    decoded = bpe.round_trip(docs, tokens, public_tokenizers.PATTERN, memo=CODEC_MEMO)
    return decoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          F.decode("decoded", "utf-8").alias("text"))


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("bpe", encode),
]

#: The classifier and the tokenizer can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES:
        docs = scratch.put(name, stage(spark, docs, sf_dir))
    return docs
