"""Jaccard self-join of documents on word n-grams, as a blocked sparse matrix product.

Rows of the incidence matrix are classes of documents with equal n-gram sets, columns are
n-grams.  Links are pairs of rows whose overlap reaches the bound that their sizes set.  All
steps lose no link:

1. Sieve.  Of each row, the n-grams with the smallest hashes stand for it: as many as a
   linked row can lack, plus a lead.  Linked rows share at least the lead among these, so a
   row with fewer n-grams that occur elsewhere has no link and leaves.
2. Prefix.  The full rows that stay are ordered from rare to frequent n-grams.  Linked rows
   share one of the first n - bound + 1; n-grams of a single row can't be it.
3. Product, in blocks by prefix n-gram and size class.  First every row meets one pivot of
   its block; verified links give components.  Then pairs of different components are
   multiplied out: overlap counts are accumulated over the blocks, and pairs below the bound
   are dropped before the exact overlap is taken from the full rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscape.llm.components import components
from cellscape.llm.text import BLANKS, shingle_hashes, words
from cellscape.session import Scratch


#: Parts of the n-gram space in which overlaps are bounded one by one.
PARTS = 32


def _with_grams(df: DataFrame, text: str, k: int) -> DataFrame:
    """Replace the text by ``g``, its distinct n-grams in order of their hashes.

    The words are a column of their own, so that they are split once and not once per n-gram.
    """
    return (df.withColumn("w", words(F.col(text), BLANKS)).withColumn("g", shingle_hashes(F.col("w"), k))
            .withColumn("g", F.sort_array(F.array_distinct("g"))).drop(text, "w"))


def _at_least(n: Column, similarity: int) -> Column:
    """The overlap that a link needs with a row of size n at either end: ceil(similarity * n / 100)."""
    return F.ceil(n * similarity / F.lit(100.0))


def _class_key(grams: Column) -> list[Column]:
    return [F.xxhash64(grams).alias("h1"), F.xxhash64(F.lit(7), grams).alias("h2")]


def linked_groups(docs: DataFrame, k: int = 5, similarity: int = 80, lead: float = 0.1,
                  text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Words are lower-cased (A-Z) runs of non-blanks.  A document's set holds its distinct
    k-word shingles; with fewer words the whole sequence is one shingle; without words or
    text it is empty and has no links.  Two documents link when their Jaccard similarity is at
    least ``similarity`` per cent; component_id is the smallest doc_id reachable by links, the
    document's own included.  Rows with a null doc_id can't be named: they get their
    n_shingles, a null component_id and link nothing.  Repeated rows, and rows with one id but
    other texts, each get their row.  An empty table gives an empty result; further columns
    are not read.

    N-grams are known by 64-bit hashes and equal sets by 128 bits, so a pair's overlap is
    wrong with a probability of about (n-grams of the pair)^2 / 2^64.  ``lead`` sets how much
    of each row the sieve looks at beyond the least; it changes the cost and not the result.
    """
    scratch = Scratch(docs.sparkSession)
    lack = 1 - similarity / 100
    n = F.col("n")

    # Signatures: the sieve's n-grams of each row, cut from the full set at once.
    lead_of = lambda m: F.greatest(F.lit(1), F.floor(m * lead))
    taken = (n - _at_least(n, similarity) + lead_of(n)).cast("int")
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    signatures = scratch.put("signatures", _with_grams(narrow, "text", k)
                             .select("doc_id", F.size("g").alias("n"), "g")
                             .select("doc_id", "n", *_class_key(F.col("g")),
                                     F.slice("g", 1, F.least(n, F.greatest(taken, F.lit(1)))).alias("g")))
    named = signatures.where(F.col("doc_id").isNotNull() & (n > 0))
    classes = scratch.put("classes", named.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("g").alias("g"))
        .withColumn("cid", F.monotonically_increasing_id()))
    members = scratch.put("members", signatures.select("doc_id", "n", "h1", "h2")
                          .join(classes.select("h1", "h2", "cid"), ["h1", "h2"], "left").select("doc_id", "n", "cid"))
    scratch.drop("signatures")

    # 1. Sieve.
    entries = classes.select("cid", F.explode("g").alias("g"))
    shared = entries.groupBy("g").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("g")
    partner = lead_of(_at_least(n, similarity))  # the lead of the smallest row it may link with
    left = scratch.put("left", entries.join(shared, "g").groupBy("cid").agg(F.count(F.lit(1)).alias("m"))
                       .join(classes.select("cid", "n", "rep", "h1", "h2"), "cid").where(F.col("m") >= partner)
                       .select("cid", "rep", "h1", "h2"))
    reps = scratch.put("reps", classes.select("cid", "rep"))
    scratch.drop("classes")

    # 2. Prefixes of the full rows of what is left.  What is left grows with the input, so it is
    # merged with the texts and not broadcast.
    full = (_with_grams(narrow.toDF("rep", "text").join(left.select("rep").distinct().hint("merge"), "rep"), "text", k)
            .select("rep", "g", *_class_key(F.col("g")))
            .join(left, ["rep", "h1", "h2"]).dropDuplicates(["cid"]).select("cid", F.size("g").alias("n"), "g"))
    rows = scratch.put("rows", full)
    cells = rows.select("cid", "n", F.explode("g").alias("g"))
    frequency = cells.groupBy("g").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    alone = n - F.size("s")
    # The profile counts the n-grams that others share in each part of the n-gram space.
    part = F.pmod("g", F.lit(PARTS))
    ordered = (cells.join(frequency, "g").groupBy("cid", "n")
               .agg(F.sort_array(F.collect_list(F.struct("df", "g"))).alias("s"),
                    F.array(*(F.count(F.when(part == i, 1)).cast("int") for i in range(PARTS))).alias("profile"))
               .where(F.size("s") >= _at_least(n, similarity)))
    length = (n - _at_least(n, similarity) + 1 - alone).cast("int")
    prefixes = scratch.put("prefixes", ordered.select("cid", "n", alone.alias("alone"), "profile", F.posexplode(
        F.slice("s", 1, F.greatest(length, F.lit(0)))).alias("at", "x"))
        .select("cid", "n", "alone", "profile", F.col("x.g").alias("g"), (F.col("alone") + F.col("at") + 1).alias("place")))

    # 3a. Every row meets the pivot of its blocks: the row with the fewest n-grams of its own.
    pivots = prefixes.groupBy("g").agg(
        F.min(F.struct((F.col("alone") / n).alias("own"), (-n).alias("size"), "cid")).alias("p"),
        F.count(F.lit(1)).alias("m")).where("m > 1")
    stars = (prefixes.join(pivots.select("g", F.col("p.cid").alias("b"), (-F.col("p.size")).alias("nb")), "g")
             .where((F.col("cid") != F.col("b"))
                    & (F.least(n, F.col("nb")) * 100 >= F.greatest(n, F.col("nb")) * similarity))
             .groupBy(F.col("cid").alias("a"), "b").agg(F.count(F.lit(1)).alias("c")))
    links = scratch.put("star-links", _verified(stars.select("a", "b"), rows, similarity))
    labels = components(links, scratch, "star")

    # 3b. Pairs of different components, block by block.  Only n-grams that other rows have can
    # overlap, which bounds the sizes of a row's partners; blocks are keyed by the size classes
    # of both, so a row meets only rows that it could link with by size.  In a block, the rows
    # outside its most frequent component meet the others.
    shared_n = n - F.col("alone")
    low = _at_least(n, similarity)
    high = F.least(F.floor(n * 100 / F.lit(float(similarity))),
                   F.floor((shared_n * (100 + similarity) - n * similarity) / F.lit(float(similarity))))
    scale = lambda m: F.floor(F.log(m.cast("double")) / (-math.log(similarity / 100) / 4)).cast("int")
    sized = (prefixes.join(labels.toDF("cid", "label"), "cid", "left")
             .select("cid", "n", "g", "place", "profile", shared_n.alias("e"), F.coalesce("label", "cid").alias("label"),
                     scale(n).alias("own"), F.sequence(scale(low), scale(F.greatest(low, high))).alias("partners")))
    per_label = sized.groupBy("g", "label").agg(F.count(F.lit(1)).alias("m"))
    mixed = (per_label.groupBy("g").agg(F.max(F.struct("m", "label")).alias("x"), F.count(F.lit(1)).alias("labels"))
             .where("labels > 1").select("g", F.col("x.label").alias("major")))
    blocks = scratch.put("blocks", sized.join(mixed, "g").withColumn("minor", F.col("label") != F.col("major")))
    here = blocks.where("minor").select(
        "g", F.col("own").alias("x"), F.explode("partners").alias("y"), F.col("cid").alias("a"), F.col("n").alias("na"),
        F.col("e").alias("ea"), F.col("place").alias("pa"), F.col("label").alias("la"), F.col("profile").alias("fa"))
    there = blocks.select(
        "g", F.explode("partners").alias("x"), F.col("own").alias("y"), F.col("cid").alias("b"), F.col("n").alias("nb"),
        F.col("e").alias("eb"), F.col("place").alias("pb"), F.col("label").alias("lb"), F.col("profile").alias("fb"), "minor")
    sizes = similarity * (F.col("na") + F.col("nb"))
    # A pair overlaps in each part of the n-gram space by the smaller of its counts at most.
    in_parts = F.aggregate(F.zip_with("fa", "fb", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    flipped = [("a", "b"), ("b", "a"), ("na", "nb"), ("nb", "na"), ("pa", "pb"), ("pb", "pa")]
    products = (here.join(there, ["g", "x", "y"])
                .where((F.col("la") != F.col("lb")) & (~F.col("minor") | (F.col("a") < F.col("b")))
                       & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * similarity)
                       & (F.least("ea", "eb") * (100 + similarity) >= sizes)
                       & (in_parts * (100 + similarity) >= sizes))
                # Which row is the minor one differs from block to block; a pair is summed up in one order.
                .select(F.inline(F.array(F.when(F.col("a") < F.col("b"), F.struct("a", "b", "na", "nb", "pa", "pb"))
                                         .otherwise(F.struct(*(F.col(y).alias(x) for x, y in flipped))))))
                .groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("c"), F.max("pa").alias("pa"),
                                                   F.max("pb").alias("pb")))
    # Behind the last shared prefix n-gram, at most the rest of the shorter remainder can overlap.
    most = F.col("c") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    candidates = products.where(most * (100 + similarity) >= sizes).select("a", "b")
    more = _verified(candidates, rows, similarity)
    every = scratch.put("links", links.unionByName(more))
    groups = components(every, scratch, "all").toDF("cid", "label")

    component = groups.join(reps, "cid").groupBy("label").agg(F.min("rep").alias("component"))
    classed = (reps.join(groups, "cid", "left").join(component, "label", "left")
               .select("cid", F.coalesce("component", "rep").alias("component")))
    return (members.join(classed, "cid", "left")
            .select("doc_id", n.cast("long").alias("n_shingles"), F.when(
                F.col("doc_id").isNotNull(),
                F.when(n > 0, F.col("component")).otherwise(F.col("doc_id"))).alias("component_id")))


def _verified(pairs: DataFrame, rows: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full rows link."""
    sets = rows.select("cid", "g")
    both = pairs.join(sets.toDF("a", "ga"), "a").join(sets.toDF("b", "gb"), "b")
    common = F.size(F.array_intersect("ga", "gb"))
    union = F.size("ga") + F.size("gb") - common
    return both.where(common * 100 >= union * similarity).select("a", "b")


def one_of_each_group(docs: DataFrame, k: int = 5, similarity: int = 80, text: str = "text",
                      doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay when each linked group keeps its smallest doc_id, columns unchanged.

    Rows without an id stay.  Of rows that repeat the smallest id all stay, since they can't
    be told apart by name.
    """
    gone = (linked_groups(docs, k, similarity, text=text, doc_id=doc_id)
            .where(F.col("component_id").isNotNull() & (F.col("component_id") < F.col("doc_id")))
            .select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(gone, F.col(doc_id) == F.col("_gone"), "left_anti")
