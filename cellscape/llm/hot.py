"""A many-to-one join whose hot keys spread over all tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than one part in so many of the rows is hot; so there are never as many hot keys as this.
PARTS = 1000


def hot_keys(many: DataFrame, key: str, rows: int) -> list:
    """The keys that hold more than ``rows / PARTS`` of the ``rows`` rows of ``many``: fewer than PARTS values."""
    counts = many.groupBy(key).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > rows / PARTS)
    return [r[0] for r in counts.select(key).collect() if r[0] is not None]


def join_split(many: DataFrame, one: DataFrame, key: str, hot: list) -> DataFrame:
    """``many`` joined (inner) with ``one``, which has one row per ``key``: the rows of ``one`` for the ``hot`` keys are broadcast
    and the hot rows stay where they are; all others are shuffled.  Null keys join nothing."""
    if not hot:
        return many.join(one, key)
    is_hot = F.col(key).isin(hot)
    return (many.where(is_hot).join(F.broadcast(one.where(is_hot)), key)
            .unionByName(many.where(~is_hot).join(one.where(~is_hot), key)))


def join_hot(many: DataFrame, one: DataFrame, key: str, rows: int) -> DataFrame:
    """``join_split`` with the hot keys counted out first."""
    return join_split(many, one, key, hot_keys(many, key, rows))
