"""Column expressions on texts that several operators share (all stay in the JVM)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Word separators of the shingle operators: blank and the control characters tab to carriage return.
BLANKS = r"[ \t-\r]+"
#: Everything that is no digit, ASCII letter or character beyond ASCII.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column, separators: str = BLANKS) -> Column:
    """Lower-cased (A-Z) words; null and empty texts have none."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), separators), lambda w: w != F.lit(""))


def shingle_hashes(word_list: Column, k: int) -> Column:
    """64-bit hashes of the k-word shingles in order; a shorter, non-empty list is one shingle."""
    n = F.size(word_list)
    at = F.when(n >= k, F.sequence(F.lit(0), n - k)).when(n > 0, F.array(F.lit(0))).otherwise(
        F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*(F.get(word_list, i + j) for j in range(k))))


def shingle_texts(word_list: Column, k: int) -> Column:
    """The k-word shingles themselves, blank-joined, with the position of their first word."""
    n = F.size(word_list)
    at = F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.concat_ws(" ", *(F.get(word_list, i + j) for j in range(k))))


def occurrences(texts: DataFrame, shingles: DataFrame, separators: str, sizes: list[int]) -> DataFrame:
    """(digest, pos, n, sid): where the shingles of a dictionary occur in the distinct texts.

    ``texts`` has a column ``text``; ``shingles`` has (sid, k, shingle).  n is the number of
    words.  Texts are known by their md5 digest, so copies give the same rows, and the
    partial aggregation merges them before the shuffle.  Spark broadcasts the dictionary
    when its size is under the session's threshold and shuffles both sides otherwise.
    """
    base = texts.select(digest(F.col("text")).alias("digest"), words(F.col("text"), separators).alias("w"))
    found = None
    for k in sizes:
        at_k = (base.select("digest", F.size("w").alias("n"), F.posexplode(shingle_texts(F.col("w"), k))
                            .alias("pos", "shingle"))
                .join(shingles.where(F.col("k") == k).select("sid", "shingle"), "shingle")
                .select("digest", "pos", "n", "sid"))
        found = at_k if found is None else found.unionByName(at_k)
    return found.distinct()


def digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))
