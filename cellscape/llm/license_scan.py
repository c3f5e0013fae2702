"""License scans: MinHash bands over overlapping text windows, then exact containment.

Shingles outside every template cannot change a containment, so the windows are projected
onto the template vocabulary first; most windows become empty.  A template of n words is
searched in windows of 2S words that start every S words, S the power of two from n up, so
every occurrence lies whole in a window.  One hash function per band; the number of bands
follows from the smallest possible Jaccard similarity of a matching window.
"""

from __future__ import annotations

import math
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscape.llm.text import NON_WORD, digest, occurrences, shingle_texts, words
from cellscape.session import Scratch


def shipped_templates() -> list[tuple[str, str]]:
    """(template_id, text) of the license texts, headers and statements in ``templates/``; a small table, read by the driver."""
    return [(p.stem, p.read_text(encoding="utf-8")) for p in sorted(Path(__file__).with_name("templates").glob("*.txt"))]


def bands_for(containment: float, certainty: float) -> int:
    """Bands needed so that a window which holds a template is retrieved with ``certainty``.

    A window has 2S < 4n starts of shingles, of which at least containment * n match a
    template of n shingles: its Jaccard similarity is over containment / 5.
    """
    return math.ceil(math.log(1 - certainty) / math.log(1 - containment / 5))


def _signature(sids: Column, bands: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                       lambda b: F.struct(b.alias("band"), F.array_min(
                           F.transform(sids, lambda s: F.xxhash64(s, b))).alias("low")))


def license_matches(docs: DataFrame, templates: DataFrame, k: int = 2, containment: float = 0.8,
                    certainty: float = 0.9999, text: str = "text", explained: bool = False) -> DataFrame:
    """(digest, template_id, containment, n_windows) for the distinct texts with a match.

    With ``explained``, a template does not match in a window where another one has a higher
    containment and holds all the shingles that it found: a near variant of the text, and no
    text of its own.  Two notices in one window are both kept, as is whatever is there in full.
    """
    scratch = Scratch(docs.sparkSession)
    w = F.col("w")
    shingled = (templates.dropna(subset=["template_id"])
                .select("template_id", words(F.col("text"), NON_WORD).alias("w")).where(F.size("w") > 0)
                .select("template_id", F.least(F.size("w"), F.lit(k)).alias("k"),
                        F.pow(F.lit(2), F.ceil(F.log2(F.size("w")))).cast("int").alias("stride"),
                        F.explode(F.when(F.size("w") >= k, shingle_texts(w, k))
                                  .otherwise(F.array(F.concat_ws(" ", w)))).alias("shingle")).distinct())
    dictionary = scratch.put("dictionary", shingled.select("k", "shingle").distinct()
                             .withColumn("sid", F.monotonically_increasing_id()))
    known = scratch.put("templates", shingled.join(dictionary, ["k", "shingle"])
                        .select("template_id", "stride", "sid"))
    sizes = sorted(r.k for r in dictionary.select("k").distinct().collect())  # at most k numbers
    bands = bands_for(containment, certainty)
    wanted = (known.groupBy("template_id", "stride").agg(F.sort_array(F.collect_set("sid")).alias("t_sids"))
              .select("template_id", "stride", "t_sids", F.inline(_signature(F.col("t_sids"), bands))))
    if not sizes:
        return wanted.select(F.lit("").alias("digest"), "template_id", F.lit(0.0).alias("containment"),
                             F.lit(0).cast("long").alias("n_windows"))
    found = scratch.put("found", occurrences(docs.select(F.col(text).alias("text")), dictionary, NON_WORD, sizes))
    block = F.floor(F.col("pos") / F.col("stride"))
    windows = (found.join(known.select("sid", "stride").distinct(), "sid")
               .select("digest", "stride", "sid", F.explode(F.array(block - 1, block)).alias("window"))
               .where("window >= 0")
               .groupBy("digest", "stride", "window").agg(F.collect_set("sid").alias("sids"))
               .select("digest", "stride", "window", "sids", F.inline(_signature(F.col("sids"), bands))))
    share = F.size(F.array_intersect("sids", "t_sids")) / F.size("t_sids")
    near = windows.join(wanted, ["stride", "band", "low"])
    if explained:
        t = (near.select("digest", "stride", "window", "template_id", share.alias("containment"),
                         F.array_intersect("t_sids", "sids").alias("own"))
             .where(F.col("containment") >= containment).distinct()
             # At most as many rows in a group as there are templates.
             .groupBy("digest", "stride", "window")
             .agg(F.collect_list(F.struct("template_id", "containment", "own")).alias("m")))
        kept = F.filter("m", lambda x: ~F.exists("m", lambda y: (y.containment > x.containment)
                                                 & (F.size(F.array_except(x.own, y.own)) == 0)))
        matches = t.select("digest", "window", F.inline(kept))
    else:
        matches = (near.select("digest", "window", "template_id", share.alias("containment"))
                   .where(F.col("containment") >= containment).distinct())
    return (matches.groupBy("digest", "template_id")
            .agg(F.max("containment").alias("containment"), F.count(F.lit(1)).alias("n_windows")))


def license_scan(docs: DataFrame, templates: DataFrame, k: int = 2, containment: float = 0.8,
                 certainty: float = 0.9999, text: str = "text", doc_id: str = "doc_id",
                 explained: bool = False) -> DataFrame:
    """One row per document: doc_id, licenses (sorted template ids), containment (best, or null), n_windows.

    ``templates`` has (template_id, text); templates without id or words are left out.
    Words are lower-cased runs of digits, letters and characters beyond ASCII.  A template
    matches when a window holds at least ``containment`` of its distinct k-word shingles;
    with ``explained``, not where it is a near variant of a better match (``license_matches``).
    Null and empty texts match nothing; repeated rows each get their row; an empty table
    gives an empty result, no templates give empty lists; further columns are not read.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    matches = (license_matches(narrow, templates, k, containment, certainty, explained=explained).groupBy("digest")
               .agg(F.sort_array(F.collect_set("template_id")).alias("licenses"),
                    F.max("containment").alias("containment"), F.sum("n_windows").alias("n_windows")))
    return (narrow.select("doc_id", digest(F.col("text")).alias("digest")).join(matches, "digest", "left")
            .select("doc_id", F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
                    "containment", F.coalesce("n_windows", F.lit(0).cast("long")).alias("n_windows")))
