"""Exact deduplication by 128-bit content hash with byte comparison inside the groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscape.llm.text import BLANKS
from cellscape.session import Scratch

GROUP = ["_keep_id", "_group_size", "_text_sha256"]


def normalised(text: Column) -> Column:
    """Every run of blanks becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def _members(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("_norm")).select(
        "doc_id", F.md5("_norm").alias("_hash"), "_norm")


def content_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per distinct normalised text: _hash, _norm, _keep_id, _group_size, _text_sha256.

    Rows are grouped by the 128-bit hash together with the text, so the bytes themselves
    decide inside a hash group and a collision gives two classes.  The partial aggregation
    keeps one row per text and task, so a large group of copies does not reach one task.
    """
    return (_members(docs, text, doc_id).groupBy("_hash", "_norm")
            .agg(F.min("doc_id").alias("_keep_id"), F.count(F.lit(1)).alias("_group_size"))
            .withColumn("_text_sha256", F.sha2("_norm", 256)))


def _with_group(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The rows of ``docs`` with _hash, keep_id, group_size and text_sha256 of their class.

    Rows find their class by the hash.  Hashes that stand for several texts (collisions) are
    told apart by the text in a second join, which only such rows enter.
    """
    classes = content_classes(docs, text, doc_id)
    scratch = Scratch(docs.sparkSession)
    by_hash = scratch.put("hashes", classes.groupBy("_hash").agg(
        F.count(F.lit(1)).alias("_texts"), *(F.max(c).alias(c) for c in GROUP)))
    rows = docs.withColumn("_hash", F.md5(normalised(F.col(text))))
    grouped = rows.join(by_hash.where("_texts = 1").drop("_texts"), "_hash")
    clashing = by_hash.where("_texts > 1").select("_hash")
    if clashing.isEmpty():
        return grouped
    apart = (rows.join(clashing, "_hash", "left_semi").withColumn("_norm", normalised(F.col(text)))
             .join(classes.join(clashing, "_hash", "left_semi"), ["_hash", "_norm"]).drop("_norm"))
    return grouped.unionByName(apart)


def _kept(doc_id: Column) -> Column:
    return F.coalesce(doc_id == F.col("_keep_id"), F.col("_keep_id").isNull())


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after ``normalised``; null equals empty.  The
    smallest doc_id of a group stays.  Null ids rank behind all others: a group without any
    id has a null keep_id and all its rows are marked kept.  Rows that repeat the id and the
    text of the keeper are marked kept too; ``deduplicate`` returns one of them.  An empty
    table gives an empty result; other columns of ``docs``, whatever their names, are not read.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _with_group(narrow, "text", "doc_id").select(
        "doc_id", F.col("_keep_id").alias("keep_id"), F.col("_group_size").alias("group_size"),
        _kept(F.col("doc_id")).alias("kept"), F.col("_text_sha256").alias("text_sha256"))


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, one for each group of equal texts, columns unchanged."""
    return (_with_group(docs, text, doc_id).where(_kept(F.col(doc_id)))
            .dropDuplicates(["_hash", "_text_sha256"]).select(*docs.columns))
