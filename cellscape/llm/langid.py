"""Language identification by mixture inference over byte n-grams.

Every language is a distribution over hashed byte trigrams, learned from labelled texts.  A
document is a mixture of languages; expectation-maximisation estimates the shares.  From all
languages on, the one with the least share is dropped while the penalised likelihood (BIC)
does not get worse, which selects the document's set of languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
#: Trigrams are hashed into 2^BITS bins; counts are smoothed by SMOOTHING.
BITS, SMOOTHING = 15, 0.5
#: Steps of expectation-maximisation for the full set, and after each dropped language.
FIRST_STEPS, NEXT_STEPS = 8, 4
#: A language costs PENALTY times half the logarithm of the number of trigrams.
PENALTY = 4.0
#: Documents per block of counts (times 2^BITS bins).
BLOCK = 32

#: Non-letters of ASCII count as blanks; bytes beyond ASCII stay as they are.
_CLASSES = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


@dataclass
class LanguageModel:
    languages: list[str]
    likelihood: np.ndarray  # languages x bins


def _counts(texts: list[str | None]) -> np.ndarray:
    """Trigram counts, texts x bins; a null text has none."""
    parts = [b"" if x is None else b" " + x.lower().encode() + b" " for x in texts]
    data = _CLASSES[np.frombuffer(b"".join(parts), np.uint8)]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32) | (owner[1:] != owner[:-1])  # runs of blanks are one
    data, owner = data[keep].astype(np.uint32), owner[keep]
    if len(data) < 3:
        return np.zeros((len(parts), 1 << BITS), np.int64)
    grams = data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]
    inside = owner[:-2] == owner[2:]
    bins = (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    where = (owner[:-2].astype(np.int64) << BITS | bins)[inside]
    return np.bincount(where, minlength=len(parts) << BITS).reshape(len(parts), -1)


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str | None]]]:
    for start in range(0, batch.num_rows, BLOCK):
        yield start, batch.column(column).slice(start, BLOCK).to_pylist()


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from all rows of ``docs`` with a text and a language.

    Tasks count on their own and send one row per language and used bin; the model on the
    driver is bounded by languages x bins, whatever the number of documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for start, texts in _blocks(batch, 1):
                names = np.array(batch.column(0).slice(start, len(texts)).to_pylist(), object)
                counts = _counts(texts)
                for name in set(names):
                    total[name] = total.get(name, 0) + counts[names == name].sum(axis=0)
        for name, counts in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used)), pa.array(used), pa.array(counts[used])],
                                             names=["lang", "bin", "n"])

    rows = (docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).dropna()
            .mapInArrow(run, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(rows["lang"].unique())
    counts = np.full((len(languages), 1 << BITS), SMOOTHING)
    counts[np.searchsorted(languages, rows["lang"]), rows["bin"]] += rows["n"]
    return LanguageModel(languages, counts / counts.sum(axis=1, keepdims=True))


def _expect(shares, active, likely, counts, starts, owner, total, steps):
    """EM steps on the shares (languages x texts); returns them with the log-likelihoods."""
    for step in range(steps + 1):
        joint = shares[:, owner] * likely
        mix = joint.sum(axis=0)
        if step == steps:
            return shares, np.add.reduceat(counts * np.log(mix), starts)
        shares = np.add.reduceat(joint * (counts / mix), starts, axis=1) / total * active
        shares = np.maximum(shares, 1e-12) * active
        shares /= shares.sum(axis=0)


def mixtures(texts: list[str | None], model: LanguageModel) -> np.ndarray:
    """Shares, texts x languages: the selected set sums to one, other languages have zero."""
    out = np.zeros((len(texts), len(model.languages)))
    counts = _counts(texts)
    owner, bins = np.nonzero(counts)
    if not len(owner) or not model.languages:
        return out
    n = counts[owner, bins].astype(float)
    rows, starts, owner = np.unique(owner, return_index=True, return_inverse=True)
    likely, total = model.likelihood[:, bins], np.add.reduceat(n, starts)
    active = np.ones((len(model.languages), len(rows)))
    shares, fit = _expect(active / len(active), active, likely, n, starts, owner, total, FIRST_STEPS)
    price = PENALTY * 0.5 * np.log(np.maximum(total, 2))
    open_rows = np.ones(len(rows), bool)
    for _ in range(len(active) - 1):
        least = np.where(active > 0, shares, np.inf).argmin(axis=0)
        fewer = active.copy()
        fewer[least, np.arange(len(rows))] = 0
        trial = shares * fewer
        trial, trial_fit = _expect(trial / trial.sum(axis=0), fewer, likely, n, starts, owner, total, NEXT_STEPS)
        open_rows &= fit - trial_fit <= price
        if not open_rows.any():
            break
        active, shares = np.where(open_rows, fewer, active), np.where(open_rows, trial, shares)
        fit = np.where(open_rows, trial_fit, fit)
    out[rows] = shares.T
    return out


def detect(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add lang_pred, score and languages (the selected set with its shares) to every row.

    ``lang_pred`` is the language of the largest share and ``score`` that share.  Null texts,
    texts without a letter, and all texts under an empty model, are ``und`` with score 0 and
    no languages.  Whole texts are read; repeated rows and other columns stay, columns with
    the new names are replaced, an empty table gives an empty result.
    """
    names = [c for c in df.columns if c not in ("lang_pred", "score", "languages")]
    found = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())]))
    schema = T.StructType([df.schema[c] for c in names] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("languages", found)])
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.likelihood))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LanguageModel(*shared.value)
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        for batch in batches:
            at = batch.schema.get_field_index(text)
            pred, score, sets = [], [], []
            for _, texts in _blocks(batch, at):
                texts = [x if x is not None and any(map(str.isalpha, x)) else None for x in texts]
                for x, shares in zip(texts, mixtures(texts, known), strict=True):
                    if x is None or not shares.any():
                        pred.append(UNKNOWN), score.append(0.0), sets.append([])
                        continue
                    best = int(shares.argmax())
                    pred.append(known.languages[best]), score.append(min(1.0, float(shares[best])))
                    sets.append([{"lang": known.languages[i], "share": float(shares[i])} for i in np.flatnonzero(shares)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in names),
                 pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(sets, kind)],
                names=[*names, "lang_pred", "score", "languages"])

    return df.mapInArrow(run, schema)
