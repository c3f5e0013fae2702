"""Count matrices derived from the warehouse tables.

Each builder is a plain join + aggregate plan over the parquet tables, so the matrix
grows with the tables and every filter/projection is pushed into the scans.

F1 supplier x part      cell = l_suppkey, gene = l_partkey (name p_name), value = sum(l_quantity)
F2 customer x part name cell = o_custkey, gene = p_name (id = min p_partkey), value = sum(l_quantity)
F3 vectors              cell = vec_id, v = embedding, label = truth/cluster label
F4 document x word      cell = doc_id, gene = lower-cased word split on one space, value = count
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscape.matrix import CountMatrix


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def supplier_part(spark: SparkSession, sf_dir: str) -> CountMatrix:
    """suppliers as cells, parts as genes (duplicate gene names by design)."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    expr = (
        li.groupBy(F.col("l_suppkey").alias("cell_id"), F.col("l_partkey").alias("gene_id"))
        .agg(F.sum("l_quantity").cast("double").alias("value"))
        .where(F.col("value") != 0)
    )
    cells = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("cell_id"), F.col("s_nationkey").cast("string").alias("group")
    )
    genes = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("gene_id"), F.col("p_name").alias("gene_name")
    )
    return CountMatrix(cells=cells, genes=genes, expr=expr)


def part_name_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One gene per distinct part name; the id is the smallest part key with that name."""
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_name").alias("gene_name"))
        .agg(F.min("p_partkey").alias("gene_id"))
        .select("gene_id", "gene_name")
    )


def customer_partname(spark: SparkSession, sf_dir: str) -> CountMatrix:
    """customers as cells (group = market segment), part names as genes."""
    genes = part_name_genes(spark, sf_dir)
    part_gene = (
        table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("gene_name"))
        .join(genes, "gene_name")
        .select(F.col("p_partkey").alias("l_partkey"), "gene_id")
    )
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    expr = (
        li.join(part_gene, "l_partkey")
        .join(orders, "l_orderkey")
        .groupBy(F.col("o_custkey").alias("cell_id"), "gene_id")
        .agg(F.sum("l_quantity").cast("double").alias("value"))
        .where(F.col("value") != 0)
    )
    cells = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cell_id"), F.col("c_mktsegment").alias("group")
    )
    return CountMatrix(cells=cells, genes=genes, expr=expr)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cell_id, v ARRAY<DOUBLE>, label INT)."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("cell_id"),
        F.col("embedding").cast("array<double>").alias("v"),
        F.col("label").cast("int").alias("label"),
    )


def document_words(spark: SparkSession, sf_dir: str) -> CountMatrix:
    """documents as cells, lower-cased words (split on one space) as genes.

    Gene ids are ``xxhash64`` of the word; the whole text of every document is used.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    words = docs.select(
        F.col("doc_id").alias("cell_id"), F.explode(F.split(F.lower("text"), " ")).alias("gene_name")
    )
    expr0 = words.groupBy("cell_id", "gene_name").agg(F.count(F.lit(1)).cast("double").alias("value"))
    genes = expr0.select("gene_name").distinct().withColumn("gene_id", F.xxhash64("gene_name"))
    expr = expr0.select("cell_id", F.xxhash64("gene_name").alias("gene_id"), "value")
    cells = docs.select(F.col("doc_id").alias("cell_id"), F.col("lang").alias("group"))
    return CountMatrix(cells=cells, genes=genes.select("gene_id", "gene_name"), expr=expr)
