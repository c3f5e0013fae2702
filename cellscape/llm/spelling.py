"""Spelling variant grouping: a trie frontier, joined level by level with a distributed edge table.

The words form a trie whose unbranched paths are one edge each, so its depth is the number of branchings
along a word and not the word's length.  A frontier state is (word, pos, node, edits): the first ``pos`` characters of
``word`` lead to ``node`` with so many edits.  Every level joins the frontier with the edges of its nodes.  A state without
edits meets all edges of its node: it follows its own, and leaves it where a neighbour's path parts from its own, by one
replaced character or by one character of the word skipped.  A state with one edit meets the one edge with its next character.  Those
that end with their word at a word's node are neighbours.

Each pair is found once: from the longer word, or from the one whose replaced character is smaller.  Nodes are
known by the hash of their prefix; a collision could only add false paths, and every pair is compared exactly in the end.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cellscape.llm.hot import PARTS, join_hot, join_split
from cellscape.llm.text import lower_ascii
from cellscape.session import Scratch

#: Everything that is no letter of the runs.
NON_RUN = "[^A-Za-zÀ-ÿ]+"
#: No character of a word: stands for the end of a word among the first characters of a node's edges.
END = "."


def runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_length: int = 1) -> DataFrame:
    """(doc_id, run): every maximal run of at least ``min_length`` letters, A-Z lower-cased; null texts have none."""
    every = docs.select(F.col(doc_id).alias("doc_id"), F.explode(F.split(F.col(text), NON_RUN)).alias("run"))
    # Most runs have no capital letter at all, which ``lower`` tells at less cost than replacing character by character.
    return every.where(F.length("run") >= min_length).select(
        "doc_id", F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(lower_ascii(F.col("run"))).alias("run"))


def _cut(text: Column, start: Column, length: Column) -> Column:
    """``length`` characters from 0-based ``start``; empty beyond the end."""
    return F.substring(text, start + 1, F.greatest(length, F.lit(0)))


def _edge_table(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, edges): for every branching node and the root its edges; ``ends`` is the word that ends at the child,
    ``after`` the pairs of characters that go on from it (END where a word ends), each behind a bar."""
    length = F.length("word")
    prefixes = scratch.put("prefixes", words.select("word", F.explode(F.transform(F.sequence(F.lit(0), length), lambda d: F.struct(
        d.alias("depth"), F.xxhash64(F.substring(F.col("word"), F.lit(1), d)).alias("node"),
        F.substring(F.col("word"), d + 1, F.lit(1)).alias("next")))).alias("p")).select("word", "p.*"))
    branching = prefixes.groupBy("node").agg(F.min("next").alias("a"), F.max("next").alias("b")).where("a <> b").select("node")
    branching = scratch.put("branching", branching)
    on_path = join_hot(prefixes.select("word", "depth", "node"), branching, "node", prefixes.count())
    step = F.struct(F.col("depth"), F.col("node"))
    ends = F.array(F.struct(F.lit(0).alias("depth"), F.xxhash64(F.lit("")).alias("node")),
                   F.struct(length.alias("depth"), F.xxhash64("word").alias("node")))
    # A word without any branching node (the only one) still has its root.
    paths = (words.select("word").join(on_path.groupBy("word").agg(F.collect_list(step).alias("steps")), "word", "left")
             .select("word", F.sort_array(F.array_union(ends, F.coalesce("steps", ends))).alias("steps")))
    edge = F.transform(F.sequence(F.lit(1), F.size("steps") - 1), lambda i: F.struct(
        F.get("steps", i - 1)["node"].alias("node"),
        _cut(F.col("word"), F.get("steps", i - 1)["depth"], F.get("steps", i)["depth"] - F.get("steps", i - 1)["depth"]).alias("label"),
        F.get("steps", i)["node"].alias("child"), F.when(F.get("steps", i)["depth"] == length, F.col("word")).alias("ends")))
    edges = paths.select(F.explode(edge).alias("e")).select("e.*").groupBy("node", "label", "child").agg(F.max("ends").alias("ends"))
    edges = scratch.put("edges", edges)
    first = edges.groupBy(F.col("node").alias("child")).agg(F.array_join(F.collect_set(F.substring("label", 1, 1)), "").alias("first"))
    ended = F.when(F.col("ends").isNull(), "").otherwise(END)
    edges = edges.join(first, "child", "left").withColumn("first", F.concat(F.coalesce("first", F.lit("")), ended))
    # What a node goes on with: the first two characters of its edges and of those behind short ones.
    chars = F.filter(F.split("first", ""), lambda c: c != "")
    pairs = F.when(F.length("label") > 1, F.array(F.substring("label", 1, 2))).otherwise(F.transform(chars, lambda c: F.concat("label", c)))
    after = edges.groupBy(F.col("node").alias("child")).agg(F.array_join(F.flatten(F.collect_list(pairs)), "|").alias("after"))
    full = edges.join(after, "child", "left").select("node", F.struct(
        "label", "child", "ends", F.concat(F.lit("|"), F.coalesce("after", F.lit("")), F.lit("|"), ended).alias("after")).alias("e"))
    return scratch.put("trie", full.groupBy("node").agg(F.collect_list("e").alias("edges")))


def _going(word: Column, pos: Column) -> Column:
    """What the rest of the word must find in ``after``: its next two characters, END at its end."""
    more = F.when(pos + 2 > F.length(word), END).otherwise("")
    return F.concat(F.lit("|"), F.substring(word, pos + 1, F.lit(2)), more)


def _states(word: Column, moves: list[tuple[Column, Column, Column]]) -> Column:
    """Array of the states behind the edge (label, child, ends, after) of a row, one for each (condition, pos, edits)."""
    nothing = F.lit(None).cast("string")
    rows = []
    for when, to, edits in moves:
        left = F.length(word) - to
        # Without an edit so far, one character of the word that is left where another word ends is skipped as the one edit.
        near = F.when((left == 0) & (edits == 1) | (left == 1) & (edits == 0), F.col("ends")).otherwise(nothing)
        alive = when & F.when(edits == 1, (left >= 0) & F.contains("after", _going(word, to))).otherwise(left > 0)
        rows.append(F.struct(to.cast("int").alias("pos"), F.col("child").alias("node"), edits.alias("edits"), near.alias("near"),
                             F.coalesce(alive, F.lit(False)).alias("alive")))
    return F.array(*rows)


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, other): both directions of all pairs of ``words`` at one inserted, deleted or replaced character."""
    trie = _edge_table(words, scratch)
    edge = trie.select("node", F.explode("edges").alias("e")).select("node", "e.*")
    by_first = scratch.put("by-first", edge.select(F.xxhash64("node", F.substring("label", 1, 1)).alias("key"), "label", "child", "ends", "after"))
    trie = trie.withColumnRenamed("node", "key")
    word, pos, n = F.col("word"), F.col("pos"), F.length("label")
    same = F.substring(word, pos + 1, n) == F.col("label")
    first, own = F.substring("label", 1, 1), F.substring(word, pos + 1, F.lit(1))
    replaced = (first > own) & (F.substring(word, pos + 2, n - 1) == F.substring(F.col("label"), F.lit(2), n))
    skipped = (first != own) & (F.substring(word, pos + 2, n) == F.col("label"))
    follow = F.when(first == own, same).otherwise(replaced), pos + n, F.when(first == own, 0).otherwise(1)
    start = words.select("word", F.lit(0).alias("pos"), F.xxhash64(F.lit("")).alias("key"), F.lit(0).alias("edits"),
                         F.lit(None).cast("string").alias("near"))
    fresh_n, edited_n, frontiers = words.count(), 0, [scratch.put("frontier-0", start)]
    while fresh_n or edited_n:
        live = frontiers[-1].where(pos < F.length(word))
        # Few states in a level make few hot keys of either kind.
        share = F.when(F.col("edits") == 0, fresh_n).otherwise(edited_n) / PARTS
        hot = {0: [], 1: []}
        for r in live.groupBy("edits", "key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > share).collect():
            hot[r.edits].append(r.key)
        parts = []
        if fresh_n:  # every edge of the node
            at = join_split(live.where("edits = 0").select("word", "pos", "key"), trie, "key", hot[0])
            at = at.select("word", "pos", F.explode("edges").alias("e")).select("word", "pos", "e.*")
            at = at.where((first >= own) | (first == F.substring(word, pos + 2, F.lit(1)))).where(
                (first == own) | (replaced & F.contains("after", _going(word, pos + n))) | (skipped & F.contains("after", _going(word, pos + n + 1))))
            parts.append(at.select("word", F.inline(_states(word, [follow, (skipped, pos + n + 1, F.lit(1))]))))
        if edited_n:  # the one edge that goes on with the word's next character
            at = join_split(live.where("edits = 1").select("word", "pos", "key"), by_first, "key", hot[1])
            parts.append(at.select("word", F.inline(_states(word, [(same, pos + n, F.lit(1))]))))
        moved = functools.reduce(DataFrame.unionByName, parts).where("alive")
        key = F.when(F.col("edits") == 0, F.col("node")).otherwise(F.xxhash64("node", F.substring(word, pos + 1, F.lit(1))))
        seen, going = Observation(), pos < F.length(word)
        moved = moved.select("word", "pos", key.alias("key"), "edits", "near").observe(
            seen, F.count_if(going & (F.col("edits") == 0)).alias("fresh"), F.count_if(going & (F.col("edits") == 1)).alias("edited"))
        frontiers.append(scratch.put(f"frontier-{len(frontiers)}", moved))
        fresh_n, edited_n = seen.get["fresh"], seen.get["edited"]
    found = functools.reduce(DataFrame.unionByName, (f.where("near is not null").select("word", F.col("near").alias("other")) for f in frontiers))
    exact = found.where(F.levenshtein("word", "other") == 1).distinct()
    return scratch.put("near", exact.unionByName(exact.select(F.col("other").alias("word"), F.col("word").alias("other"))))


def variants(words: DataFrame) -> DataFrame:
    """One row per word of ``words`` (word, n): word, form, root, n, n_near, form_n.

    ``n_near`` counts the words at one edit.  ``form`` is the one with the largest n (ties: the smallest in code-point
    order) if its n is at least twice the word's; else it is null and so is form_n.  ``root`` is the last of
    the forms of forms, the word itself if it has none.  Rows that repeat a word are merged and their n summed; null or
    empty words are left out and a null n counts as 0; words of any length are compared whole; an empty table gives an
    empty result; other columns are not read.
    """
    scratch = Scratch(words.sparkSession)
    words = scratch.put("words", words.where("word <> ''").groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))
    near = near_words(words, scratch)
    best = (near.join(words.select(F.col("word").alias("other"), F.col("n").alias("m")), "other")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best")))
    fits = -F.col("best.less") >= 2 * F.col("n")
    forms = scratch.put("forms", words.join(best, "word", "left").select(
        "word", F.when(fits, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, -F.col("best.less")).alias("form_n")))
    # n at least doubles from form to form, so chains have no circle and the jumps below are few.
    roots, round_ = forms.where("form is not null").select("word", F.col("form").alias("root")), 0
    roots = scratch.put("roots-0", roots)
    while True:
        links = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = join_hot(roots, links, "root", roots.count()).select("word", F.col("next").alias("root"))
        moved = scratch.put(f"moved-{round_}", moved)
        if moved.isEmpty():
            break
        stayed = roots.join(moved.select("word"), "word", "left_anti")
        round_ += 1
        roots = scratch.put(f"roots-{round_}", moved.unionByName(stayed))
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
