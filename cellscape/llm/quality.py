"""Quality classifier: logistic regression on hashed word n-grams with FTRL updates.

Features are hashed n-grams of the words and of the words' shapes (kinds of characters in
order, runs as one; a word that repeats the one before has a shape of its own), weighted by
their share of the document's n-grams.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Weights are hashed into 2^BITS places; place 0 is the constant.
BITS = 18
#: Follow-the-regularised-leader: learning rate, its offset, L1 and L2 strength; passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 1e-4, 1e-4, 3
#: Words whose hashes a worker remembers.
MEMO = 100_000
#: Weight of the n-gram shares against the constant.
SCALE = 8.0


@dataclass
class QualityModel:
    weights: np.ndarray


def _shape(word: str) -> str:
    kinds = ("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return re.sub(r"(.)\1+", r"\1", "".join(kinds), flags=re.DOTALL)


class Features:
    """Places and values of a text's features; ``memory`` may outlive the object."""

    def __init__(self, memory: dict | None = None):
        self.memory = {} if memory is None else memory

    def _hashes(self, word: str) -> tuple[int, int]:
        known = (zlib.crc32(word.encode()), zlib.crc32(b"shape " + _shape(word).encode()))
        if len(self.memory) >= MEMO:
            self.memory.clear()
        if len(word) <= 40:
            self.memory[word] = known
        return known

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, values and borders (one more than texts) of all n-grams of the texts."""
        known = self.memory
        hashes: list[tuple[int, int]] = []
        lengths = []
        for x in texts:
            words = (x or "").split()
            hashes += [known.get(w) or self._hashes(w) for w in words]
            lengths.append(len(words))
        word, shape = np.array(hashes, np.uint64).reshape(-1, 2).T
        owner = np.repeat(np.arange(len(texts)), lengths)
        streams = []
        if len(word):
            same = np.zeros(len(word), bool)
            same[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
            shape = np.where(same, np.uint64(1), shape)
            a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
            streams = [(word * a, owner)]
            for base, sizes in ((word, (2,)), (shape, (1, 2, 3))):
                for k in sizes:
                    if len(base) < k:
                        continue
                    mixed = base[:len(base) - k + 1] + np.uint64(k)
                    for j in range(1, k):
                        mixed = mixed * a + base[j:len(base) - k + 1 + j]
                    inside = owner[:len(mixed)] == owner[k - 1:]
                    streams.append(((mixed * b)[inside], owner[:len(mixed)][inside]))
        counts = np.maximum(np.array(lengths, float), 1) * max(1, len(streams))
        ones = np.arange(len(texts))
        text = np.concatenate([ones, *(o for _, o in streams)])
        place = np.concatenate([np.zeros(len(texts), np.int64),
                                *((h >> np.uint64(64 - BITS)).astype(np.int64) for h, _ in streams)])
        value = np.concatenate([np.ones(len(texts)), *(SCALE / counts[o] for _, o in streams)])
        order = np.argsort(text, kind="stable")
        return place[order], value[order], np.searchsorted(text[order], np.arange(len(texts) + 1))


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _follow_leader(texts: list[str | None], labels: np.ndarray) -> np.ndarray:
    """Weights after PASSES over the texts, one FTRL-proximal update per text."""
    z, n, features = np.zeros(1 << BITS), np.zeros(1 << BITS), Features()
    rows = []
    for x in texts:
        place, value, _ = features.of([x])
        at, where = np.unique(place, return_inverse=True)
        rows.append((at.astype(np.int32), np.bincount(where, value)))
    for _ in range(PASSES):
        for (at, x), label in zip(rows, labels, strict=True):
            w = _weights(z[at], n[at])
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return _weights(z, n)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 16_000, learners: int = 4, text: str = "text",
          doc_id: str = "doc_id", label: str = "quality") -> QualityModel:
    """Fit on at most ``max_rows`` labelled documents, those with the smallest id hashes.

    The sample is the documented bound of the fit: it is dealt to ``learners`` tasks, each
    follows the leader on its share, and the weights are averaged.  Null ids, labels other
    than 0 and 1 and unlabelled documents are left out; of repeated labels the larger
    counts.  Without any label all scores are one half.
    """
    chosen = (labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).dropna()
              .where(F.col("_label").isin(0, 1)).groupBy("_id").agg(F.max("_label").alias("_label"))
              .withColumn("_order", F.xxhash64("_id")).orderBy("_order", "_id").limit(max_rows))
    sample = (docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
              .join(F.broadcast(chosen), "_id")  # at most max_rows ids
              .withColumn("_learner", F.pmod("_order", F.lit(learners))))

    def learn(rows):
        import pandas as pd

        rows = rows.sort_values(["_order", "_text"], na_position="first")
        w = _follow_leader([x if isinstance(x, str) else None for x in rows["_text"]], rows["_label"].to_numpy(float))
        return pd.DataFrame({"rows": [len(rows)], "weights": [w.astype(np.float32).tobytes()]})

    parts = sample.groupBy("_learner").applyInPandas(learn, "rows long, weights binary").collect()  # one row per learner
    total = sum(r.rows for r in parts)
    weights = sum((np.frombuffer(r.weights, np.float32) * (r.rows / total) for r in parts),
                  np.zeros(1 << BITS, np.float32))
    return QualityModel(weights)


def score(df: DataFrame, model: QualityModel, text: str = "text", out: str = "score", forget: bool = False) -> DataFrame:
    """Add the probability of label 1 as ``out``; whole texts are read.

    With ``forget`` a task gives back the memory of its words when it ends, for jobs whose later stages need it.

    Null and empty texts get the score of the constant alone.  Repeated rows and other columns
    stay, a column named ``out`` is replaced, an empty table gives an empty result.
    """
    names = [c for c in df.columns if c != out]
    schema = T.StructType([df.schema[c] for c in names] + [T.StructField(out, T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast({"weights": model.weights, "memory": {}})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The broadcast value stays in a worker between tasks, and with it the words' hashes.
        weights, features = shared.value["weights"], Features(shared.value["memory"])
        try:
            for batch in batches:
                at, scores = batch.schema.get_field_index(text), []
                for start in range(0, batch.num_rows, 64):
                    place, value, borders = features.of(batch.column(at).slice(start, 64).to_pylist())
                    dots = np.add.reduceat(weights[place] * value, borders[:-1])
                    scores.append(1 / (1 + np.exp(-np.clip(dots, -30, 30))))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.get_field_index(c)) for c in names),
                     pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=[*names, out])
        finally:
            if forget:
                shared.value["memory"].clear()
                features = batch = None
                gc.collect()
                pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
