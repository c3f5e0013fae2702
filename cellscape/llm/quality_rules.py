"""Quality rules: base counts of a text, and its divergence from the reference of its language.

The references are histograms over all documents that pass the base rules: one of character
classes and one of common words for each language.  A document is judged by the Jensen-Shannon
distance (base 2, so 0 to 1) of its own two histograms from those of its language.  Everything is a
DataFrame or SQL expression; texts are never sorted or shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscape.llm.hot import join_hot
from cellscape.llm.text import BLANKS
from cellscape.session import Scratch

SYMBOLS = r"[#*$%&|<>]+"
#: Character classes, counted in this order, each on what those before it left over; the last class is the rest.
#: The first pattern takes the blanks away as well, which are not counted.
CLASSES = [("lower", r"[a-z \t-\r]+"), ("upper", r"[A-Z]+"), ("beyond", r"[^\x00-\x7F]+"), ("symbol", SYMBOLS),
           ("mark", r"[.,;:!?'\"()-]+"), ("digit", r"[0-9]+")]
#: Common words are looked up by their hash in so many lists.
BUCKETS = 64


@dataclass(frozen=True)
class Rules:
    """The limits.  ``common`` words make the histogram of a language, all others share one more bin."""

    min_words: int = 50
    max_repeat_percent: int = 50
    common: int = 100
    #: Largest distances that are kept.
    max_class_distance: float = 0.25
    max_word_distance: float = 0.50
    #: Guards: a histogram of fewer entries, or a reference of fewer, is not judged.
    min_chars: int = 200
    min_histogram_words: int = 50
    min_reference: int = 10_000


def _repeat_words(windows: str) -> Column:
    """Words inside three-word windows that occur twice or more, from ``windows`` = sorted (hash, place)."""
    def same(place: Column, hashed: Column) -> Column:
        return F.coalesce(F.get(windows, place)["h"] == hashed, F.lit(False))

    twice = F.filter(windows, lambda x, i: same(i - 1, x["h"]) | same(i + 1, x["h"]))
    return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))


def base_counts(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and ``classes``
    (the counts of CLASSES and of the rest) and ``words``.  Null text has no words."""
    text_ = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("words", F.array_remove(F.split(text_, BLANKS), ""))
    out = out.withColumn("n_words", F.size("words").cast("long")).withColumn(
        "word_chars", F.length(F.array_join("words", "")).cast("long"))
    left, before, counts = text_, F.col("word_chars"), []
    for name, pattern in CLASSES:
        out = out.withColumn("_left", F.regexp_replace(left, pattern, "")).withColumn(f"_{name}", F.length("_left").cast("long"))
        counts.append(before - F.col(f"_{name}"))
        left, before = F.col("_left"), F.col(f"_{name}")
    out = out.withColumn("classes", F.array(*counts, before)).drop("_left", *(f"_{name}" for name, _ in CLASSES))
    lines = F.filter(F.split(F.col(text), "\n"), lambda line: F.regexp_like(line, F.lit(r"[^ \t-\r]")))
    out = out.withColumn("_lines", F.coalesce(lines, F.array().cast("array<string>")))
    out = out.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")).drop("_lines")
    hashes = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    out = out.withColumn("_hashes", hashes).withColumn(
        "_hashes", F.slice("_hashes", F.lit(1), F.greatest(F.size("_hashes") - 2, F.lit(0))))
    # Most texts have no window twice: only the others are sorted.
    some = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    placed = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("_windows", F.when(some, placed).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    out = out.withColumn("n_repeat_words", _repeat_words("_windows").cast("long"))
    failed = ((F.col("n_words") < rules.min_words)
              | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))
    symbol = [name for name, _ in CLASSES].index("symbol")
    return (out.withColumn("n_symbols", F.get("classes", F.lit(symbol))).withColumn("base_failed", failed)
            .drop("_hashes", "_windows"))


def _term(p: Column, q: Column) -> Column:
    """One bin's part of twice the divergence; p and q are its shares."""
    m = (p + q) / 2
    return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)


def _distance(twice: Column) -> Column:
    return F.when(twice.isNotNull(), F.sqrt(F.greatest(twice / 2, F.lit(0.0))))


def _bins(words: str, buckets: str) -> Column:
    """The bins of the common words in ``words``; ``buckets`` holds (word, bin) by the hash of the word."""
    def bin_of(word: Column) -> Column:
        same = F.filter(F.get(buckets, F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")), lambda e: e["word"] == word)
        return F.get(same, F.lit(0))["bin"]

    return F.filter(F.transform(words, bin_of), lambda b: b.isNotNull())


def _counted(ordered: str, starts: str) -> Column:
    """(bin, n) from the bins in order and the places where a new one starts."""
    return F.transform(starts, lambda at, i: F.struct(
        F.get(ordered, at).alias("bin"), (F.coalesce(F.get(starts, i + 1), F.size(ordered)) - at).alias("n")))


def judge(docs: DataFrame, rules: Rules = Rules(), text: str = "text", doc_id: str = "doc_id", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, base_failed, class_distance, word_distance and kept.

    A document is kept when it passes the base rules and neither distance is over its limit.  A distance is
    null, and so rejects nothing, when the text has too few characters or words for it or its language too few
    in all documents that pass the base rules.  Null lang counts as one more language.  Common words are the
    most frequent words of a language as they are written (ties: the smaller one).  Null and empty texts have no words
    and fail the base rules; repeated rows and null ids are judged each on their own; very long texts
    are read whole inside one row; an empty table gives an empty result.  Other columns of ``docs``, whatever
    their names, are not read.
    """
    scratch = Scratch(docs.sparkSession)
    # Rows are known by their place, as ids may be null or repeat.
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(lang), F.lit("")).alias("lang"),
                       F.col(lang).isNull().alias("no_lang"), F.col(text).alias("text"))
    rows = rows.withColumn("lang", F.when(F.col("no_lang"), F.lit("none")).otherwise(F.concat(F.lit("="), "lang"))).drop("no_lang")
    base = scratch.put("base", base_counts(rows, rules).withColumn("_row", F.monotonically_increasing_id())
                       .select("_row", "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               "base_failed", "classes", F.when(~F.col("base_failed"), F.col("words")).alias("words")), "zstd")
    passed = base.where("not base_failed")
    words = passed.select("_row", "lang", F.explode("words").alias("word"))
    per_lang = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    totals = passed.groupBy("lang").agg(F.sum("n_words").alias("total"))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    common = (scratch.put("common", per_lang.withColumn("bin", F.row_number().over(first)).where(F.col("bin") <= rules.common))
              .join(totals, "lang").where(F.col("total") >= rules.min_reference)
              .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bin", "word", (F.col("n") / F.col("total")).alias("q")))).alias("c")))
    buckets = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.filter(
        F.col("c"), lambda e: F.pmod(F.xxhash64(e["word"]), F.lit(BUCKETS)) == b))
    common = common.select("lang", F.transform("c", lambda e: e["q"]).alias("word_shares"), buckets.alias("buckets"))

    n_classes = len(CLASSES) + 1
    sums = passed.groupBy("lang").agg(*(F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(n_classes)))
    all_chars = sum((F.col(f"c{i}") for i in range(1, n_classes)), F.col("c0"))
    shares = sums.where(all_chars >= rules.min_reference).select(
        "lang", F.array(*(F.col(f"c{i}") / all_chars for i in range(n_classes))).alias("class_shares"))
    references = scratch.put("references", totals.select("lang").join(shares, "lang", "left").join(common, "lang", "left"))

    judged = join_hot(passed.select("_row", "lang", "word_chars", "classes", "n_words", "words"), references, "lang", base.count())
    judged = judged.withColumn("bins", F.sort_array(_bins("words", "buckets"))).withColumn("starts", F.filter(
        F.transform("bins", lambda b, i: F.when((i == 0) | (b != F.get("bins", i - 1)), i)), lambda i: i.isNotNull()))
    judged = judged.withColumn("counted", _counted("bins", "starts"))
    # Of the common words that a text lacks, each adds its share: all of them less the shares of those it has.
    zero, common_share = F.lit(0.0), F.aggregate("word_shares", F.lit(0.0), lambda s, q: s + q)
    present = F.aggregate("counted", zero, lambda s, b: s + _term(b["n"] / F.col("n_words"), F.get("word_shares", b["bin"] - 1))
                          - F.get("word_shares", b["bin"] - 1))
    twice_words = present + common_share + _term(1 - F.size("bins") / F.col("n_words"), 1 - common_share)
    terms = F.zip_with("classes", "class_shares", lambda n, q: _term(n / F.col("word_chars"), q))
    twice_classes = F.aggregate(terms, zero, lambda s, x: s + x)
    distances = judged.select(
        "_row", F.when(F.col("word_chars") >= rules.min_chars, _distance(twice_classes)).alias("class_distance"),
        F.when(F.col("n_words") >= rules.min_histogram_words, _distance(twice_words)).alias("word_distance"))
    far = (F.coalesce(F.col("class_distance") > rules.max_class_distance, F.lit(False))
           | F.coalesce(F.col("word_distance") > rules.max_word_distance, F.lit(False)))
    return (base.drop("words", "classes", "lang").join(distances, "_row", "left")
            .withColumn("kept", ~F.col("base_failed") & ~far).drop("_row"))
