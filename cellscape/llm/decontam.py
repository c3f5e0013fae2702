"""Benchmark decontamination as a prefix-filtered containment join.

Every item is cut into windows of ``size`` words, and a window into k-word shingles.  A
window lies in a document only if all its shingles do, so one of them, the rarest in the
corpus, is the whole necessary prefix.  Documents are joined with the windows on that
shingle; its place gives the one possible start, which must respect the document's ends
(positional and length bound); then every shingle must stand at its place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.llm.text import NON_WORD, digest, occurrences, shingle_texts, words
from cellscape.session import Scratch


def item_windows(items: DataFrame, size: int, item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(item_id, words, window): ``size`` consecutive words; a shorter item with words is one window."""
    w, n = F.col("w"), F.size("w")
    starts = F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))
    return (items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"),
                         words(F.col(item_text), NON_WORD).alias("w"))
            .where(n > 0)
            .select("item_id", F.explode(F.transform(starts, lambda i: F.slice(w, i + 1, F.lit(size)))).alias("words"))
            .withColumn("window", F.concat_ws(" ", "words")))


def _shingled(windows: DataFrame, k: int) -> DataFrame:
    """Add k (a window of fewer words is one shingle) and the window's shingles."""
    m = F.size("words")
    lists = F.when(m >= k, shingle_texts(F.col("words"), k)).otherwise(F.array(F.col("window")))
    return windows.select("window", m.alias("len"), F.least(m, F.lit(k)).alias("k"), lists.alias("shingles"))


def window_occurrences(docs: DataFrame, windows: DataFrame, k: int, text: str = "text") -> DataFrame:
    """(digest, start, len, window): every place where a window of ``windows`` occurs in a text."""
    scratch = Scratch(docs.sparkSession)
    shingled = scratch.put("windows", _shingled(windows.select("window", "words").distinct(), k))
    dictionary = scratch.put("dictionary", shingled.select("k", F.explode("shingles").alias("shingle")).distinct()
                             .withColumn("sid", F.monotonically_increasing_id()))
    sizes = sorted(r.k for r in dictionary.select("k").distinct().collect())  # at most k numbers
    found = occurrences(docs.select(F.col(text).alias("text")), dictionary, NON_WORD, sizes) if sizes else \
        dictionary.select(F.lit("").alias("digest"), F.lit(0).alias("pos"), F.lit(0).alias("n"), "sid").limit(0)
    found = scratch.put("found", found)

    # Order the shingles of a window by rarity; the first is its necessary prefix.
    rarity = found.groupBy("sid").agg(F.count(F.lit(1)).alias("count"))
    placed = (shingled.select("window", "len", "k", F.posexplode("shingles").alias("at", "shingle"))
              .join(dictionary, ["k", "shingle"]).join(rarity, "sid"))
    prefixes = (placed.groupBy("window", "len", "k")
                .agg(F.min(F.struct("count", "sid", "at")).alias("first"),
                     F.array_sort(F.collect_list(F.struct("at", "sid"))).alias("sids"))
                .where(F.size("sids") == F.col("len") - F.col("k") + 1)  # a shingle that never occurs rules it out
                .select("window", "len", F.col("first.sid").alias("sid"), F.col("first.at").alias("at"), "sids"))
    start = F.col("pos") - F.col("at")
    candidates = (found.join(prefixes, "sid").where((start >= 0) & (start + F.col("len") <= F.col("n")))
                  .select("digest", start.alias("start"), "len", "window", F.inline("sids").alias("at", "sid"),
                          F.size("sids").alias("needed")))
    return (candidates.withColumn("pos", F.col("start") + F.col("at"))
            .join(found.select("digest", "pos", "sid"), ["digest", "pos", "sid"])
            .groupBy("digest", "start", "len", "window").agg(F.count(F.lit(1)).alias("n"), F.first("needed").alias("needed"))
            .where("n = needed").select("digest", "start", "len", "window"))


def _by_text(docs: DataFrame, items: DataFrame, size: int, k: int, text: str, item_text: str, item_id: str) -> DataFrame:
    windows = item_windows(items, size, item_text, item_id)
    at = Scratch(docs.sparkSession).put("at", window_occurrences(docs, windows, k, text))
    hits = (at.select("digest", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("pos"))
            .distinct().groupBy("digest").agg(F.count(F.lit(1)).alias("n_hit")))
    named = (at.select("digest", "window").distinct()
             .join(windows.select("window", "item_id").distinct(), "window")
             .select("digest", "item_id").distinct()
             .groupBy("digest").agg(F.array_sort(F.collect_list("item_id")).alias("items")))
    return hits.join(named, "digest")


def contamination(docs: DataFrame, items: DataFrame, size: int = 13, k: int = 3, share: tuple[int, int] = (1, 20),
                  text: str = "text", doc_id: str = "doc_id", item_text: str = "text",
                  item_id: str = "item_id") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted list), contaminated.

    Words are lower-cased runs of digits, ASCII letters and characters beyond ASCII.  A word
    is hit when an occurrence of any item window covers it.  A document is contaminated when
    it has hits and they are at least ``share`` of its words.  Null and empty texts have no
    words and are clean; items without words have no windows; a null item_id is listed as
    the empty string, items with one id count once.  Repeated rows each get their row.
    Empty tables on either side and further columns of any name are fine.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    by_text = _by_text(narrow, items, size, k, "text", item_text, item_id)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (narrow.select("doc_id", digest(F.col("text")).alias("digest"),
                          F.size(words(F.col("text"), NON_WORD)).cast("long").alias("n_words"))
            .join(by_text, "digest", "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    ((n_hit > 0) & (share[1] * n_hit >= share[0] * F.col("n_words"))).alias("contaminated")))


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 13, k: int = 3, share: tuple[int, int] = (1, 20),
                  text: str = "text", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns unchanged."""
    by_text = _by_text(docs, items, size, k, text, item_text, item_id).select("digest", "n_hit")
    keyed = docs.withColumn("_digest", digest(F.col(text)))
    n_words = F.size(words(F.col(text), NON_WORD))
    dirty = F.coalesce(share[1] * F.col("_n_hit") >= share[0] * n_words, F.lit(False))
    return (keyed.join(by_text.toDF("_digest", "_n_hit"), "_digest", "left")
            .where(~dirty).select(*docs.columns))
