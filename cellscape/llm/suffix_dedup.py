"""Removal of long repeated byte strings by bucket-pointer refinement of sampled suffixes.

A string of ``length`` bytes is known by the suffix that starts at its anchor: the place of
its smallest (q-gram identifier, place).  Equal strings have their anchors at the same
place, so only suffixes at anchors are sorted into buckets, about one in a hundred.

Buckets start from the identifier of the q-gram at the anchor and are refined by the
identifiers of later offsets, each level reusing the one before (q, 2q = ``length``).  A
bucket of one suffix is finished at once.  Neighbouring strings with one anchor form a run;
runs that agree in all their bytes repeat as a whole.  What remains is refined string by
string, in pieces whose common core repeats.

Identifiers are 64-bit fingerprints of the bytes instead of ranks, so no level needs a
global sort; Spark's shuffle gathers equal identifiers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscape.session import Scratch

#: Bytes handled at a time; a place inside such a segment fits in PLACE_BITS bits.
SEGMENT, PLACE_BITS = 1 << 20, 21
#: Starts of one piece of a run that is refined string by string.
PIECE = 32


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of identifiers (published splitmix64 finaliser; fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Segment:
    """Identifiers of all substrings of a run of bytes, from sums of byte values times powers."""

    _powers: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def __init__(self, data: np.ndarray):
        if _Segment._powers is None:
            base = 0x9E3779B97F4A7C15
            values = _mix(np.arange(1, 257, dtype=np.uint64))
            up = np.cumprod(np.full(2 * SEGMENT, base, np.uint64))
            down = np.cumprod(np.full(2 * SEGMENT, pow(base, -1, 1 << 64), np.uint64))
            _Segment._powers = (values, up, down)
        values, up, self.down = _Segment._powers
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * up[:len(data)], out=self.sums[1:])

    def identifier(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.down[start])

    def identifiers(self, q: int) -> np.ndarray:
        """Of the q-gram at every place."""
        return _mix((self.sums[q:] - self.sums[:-q]) * self.down[:len(self.sums) - q])


def _refined(ids: np.ndarray, step: int) -> np.ndarray:
    """Identifiers of twice the length: the bucket here and the bucket ``step`` later."""
    return _mix(ids[:-step] * np.uint64(0xD6E8FEB86659FD93) + ids[step:])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x)
    grid = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    grid[:n] = x
    grid = grid.reshape(-1, width)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n - width + 1], before[width - 1:n])


def _runs(data: np.ndarray, bounds: np.ndarray, length: int, q: int):
    """The segment, its q-gram identifiers, and per run: text, anchor, first and last start.

    ``bounds`` are the borders of the texts in ``data``; strings never cross them.
    """
    if len(data) < length:
        return None
    segment = _Segment(data)
    ids = segment.identifiers(q)
    places = np.uint64((1 << PLACE_BITS) - 1)
    low = _sliding_min((ids & ~places) | np.arange(len(ids), dtype=np.uint64), length - q + 1) & places
    lengths = np.diff(bounds)
    text = np.repeat(np.arange(len(lengths)), lengths)[:len(low)]
    start = np.flatnonzero(np.arange(len(low)) + length <= bounds[1:][text])
    if not len(start):
        return None
    anchor, text = low[start].astype(np.int64), text[start]
    first = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(text) != 0)])
    last = np.r_[first[1:], len(start)] - 1
    return segment, ids, text[first], anchor[first], start[first], start[last]


def _segments(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, borders, first row, place of the first byte in its text).

    Several texts share a segment; a text of more than SEGMENT bytes is cut into segments that
    overlap by ``length`` - 1 bytes, so each of its strings lies in exactly one.
    """
    borders = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    values = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(borders, borders[row] + SEGMENT, "right")) - 1)
        begin, stop = borders[row], borders[end]
        if end == row + 1:
            for at in range(begin, max(begin + 1, stop - length + 1), SEGMENT - length + 1):
                piece = values[at:min(at + SEGMENT, stop)]
                yield piece, np.array([0, len(piece)]), row, int(at - begin)
        else:
            yield values[begin:stop], borders[row:end + 1] - begin, row, 0
        row = end


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchored(length: int, q: int):
    """Task function: texts (tid, copies, data) to runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tid, copies = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for data, bounds, row, skipped in _segments(batch.column(2), length):
                found = _runs(data, bounds, length, q)
                if found is None:
                    continue
                segment, ids, text, anchor, first, last = found
                span = segment.identifier(first, last + length)
                shape = _mix(((anchor - first) * 2 * length + (anchor - last)).astype(np.uint64))
                from_text = skipped - bounds[:-1][text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tid[row + text]), pa.array(copies[row + text]), _signed(ids[anchor]),
                     _signed(_mix(span + shape)), pa.array((anchor + from_text).astype(np.int64)),
                     pa.array((first + from_text).astype(np.int64)), pa.array((last + from_text).astype(np.int64))],
                    names=["tid", "copies", "bucket", "span", "anchor", "first", "last"])

    return run


def _pieced(length: int, q: int):
    """Task function: texts (tid, copies, data, anchors) to pieces of the runs at these anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tid, copies = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            wanted = batch.column(3)
            for data, bounds, row, skipped in _segments(batch.column(2), length):
                found = _runs(data, bounds, length, q)
                if found is None:
                    continue
                segment, ids, text, anchor, first, last = found
                from_text = skipped - bounds[:-1][text]
                lists = wanted.slice(row, len(bounds) - 1)
                owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
                keys = owner << 40 | lists.flatten().to_numpy(zero_copy_only=False)
                chosen = np.isin(text << 40 | (anchor + from_text), keys)
                whole = _refined(ids, q)
                out: list[list] = [[], [], [], [], []]
                for t, a, f, e, move in zip(*(x[chosen] for x in (text, anchor, first, last, from_text)), strict=True):
                    # Pieces lie at fixed distances from the anchor, so equal strings share them.
                    for g in range((a - e) // PIECE, (a - f) // PIECE + 1):
                        start, stop = max(f, a - g * PIECE - PIECE + 1), min(e, a - g * PIECE)
                        core = a - g * PIECE
                        out[0].append(row + t)
                        out[1].append((core, core - PIECE + 1 + length))
                        out[2].append(g)
                        out[3].append(start + move)
                        out[4].append(whole[start:stop + 1].view(np.int64))
                if not out[0]:
                    continue
                rows, core = np.array(out[0]), np.array(out[1])
                cores = _mix(segment.identifier(core[:, 0], core[:, 1]) + np.array(out[2]).astype(np.uint64))
                ends = np.cumsum([0, *map(len, out[4])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tid[rows]), pa.array(copies[rows]), _signed(cores), pa.array(np.array(out[3], np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(out[4])))],
                    names=["tid", "copies", "core", "first", "ids"])

    return run


def repeated_spans(docs: DataFrame, length: int = 400, text: str = "text") -> DataFrame:
    """(key, spans) of the distinct texts that hold repeats; key is ``text_key`` of the text.

    ``spans`` are the maximal runs of UTF-8 bytes that lie in a string of ``length`` bytes
    which also starts anywhere else, in this text or another; they are sorted (start, stop).
    """
    if length % 2:
        raise ValueError("length must be even")
    q, scratch = length // 2, Scratch(docs.sparkSession)
    # Copies of a text are merged; their number counts every string of it that often.
    texts = scratch.put("texts", docs.where(F.octet_length(text) >= length)
                        .select(text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
                        .groupBy("key", "text").agg(F.count(F.lit(1)).alias("copies"))
                        .select("key", F.monotonically_increasing_id().alias("tid"), "copies",
                                F.col("text").cast("binary").alias("data")))
    runs = scratch.put("runs", texts.select("tid", "copies", "data").mapInArrow(
        _anchored(length, q),
        "tid long, copies long, bucket long, span long, anchor long, first long, last long"))
    # Buckets of anchors, refined by the whole span of the run.
    place = F.xxhash64("tid", "anchor")
    refined = runs.groupBy("bucket", "span").agg(F.sum("copies").alias("alike"), F.min(place).alias("one"))
    buckets = (refined.groupBy("bucket").agg(F.sum("alike").alias("all"), F.min("alike").alias("least"))
               .where("all > 1").select("bucket", "least"))
    status = refined.join(buckets, "bucket")
    sorted_runs = scratch.put("sorted", runs.join(status, ["bucket", "span"]).select(
        "tid", "anchor", "first", "last", "alike", ((F.col("least") == 1) & (place == F.col("one"))).alias("open")))
    whole = sorted_runs.where("alike > 1").select("tid", F.col("first").alias("start"),
                                                  (F.col("last") + length).alias("stop"))
    # Runs without their like stay open, and with them one run of each span in their bucket.
    open_runs = sorted_runs.where("open").groupBy("tid").agg(F.collect_list("anchor").alias("anchors"))
    scratch.drop("runs")
    # What is left is refined string by string where the core of its piece repeats.
    pieces = scratch.put("pieces", texts.select("tid", "copies", "data").join(open_runs, "tid")
                         .select("tid", "copies", "data", "anchors")
                         .mapInArrow(_pieced(length, q), "tid long, copies long, core long, first long, ids array<long>"))
    cores = pieces.groupBy("core").agg(F.sum("copies").alias("n")).where("n > 1").select("core")
    strings = (pieces.join(cores, "core").select("tid", "copies", "first", F.posexplode("ids").alias("at", "id"))
               .select("tid", "copies", (F.col("first") + F.col("at")).alias("start"), "id"))
    repeated = strings.groupBy("id").agg(F.sum("copies").alias("n")).where("n > 1").select("id")
    single = strings.join(repeated, "id").select("tid", "start", (F.col("start") + length).alias("stop"))
    covered = scratch.put("covered", whole.unionByName(single))
    scratch.drop("pieces", "sorted")
    return _merged(covered).join(texts.select("tid", "key"), "tid").select("key", "spans")


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _merged(covered: DataFrame) -> DataFrame:
    """(tid, spans): touching and overlapping intervals of a text become one."""
    order = Window.partitionBy("tid").orderBy("start", "stop")  # a text's own strings
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)
    run = F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (covered.withColumn("opens", opens).withColumn("run", run)
            .groupBy("tid", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
            .groupBy("tid").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans")))


def remove_repeats(docs: DataFrame, length: int = 400, text: str = "text") -> DataFrame:
    """Add to every row of ``docs``: n_bytes, spans (removed byte spans) and kept (binary).

    A byte goes when a string of ``length`` bytes covers it that also starts elsewhere in the
    table, in the same text or another; all places lose it, and strings are judged on the
    input.  Texts are UTF-8 bytes, null counts as empty, matches never cross texts; shorter
    texts stay whole.  Cuts may fall inside a character.  Repeated rows are copies of one
    another, so both lose all strings.  Columns of ``docs`` with the names of the new ones are
    replaced; an empty table gives an empty result.  ``length`` must be even.
    """
    spans = repeated_spans(docs, length, text)
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    cut = F.coalesce("_spans", none)
    n_bytes = F.octet_length(data).cast("long")
    # The kept parts lie between the end of one span and the start of the next.
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(cut, lambda s: s.stop))
    stops = F.concat(F.transform(cut, lambda s: s.start), F.array(n_bytes))
    parts = F.zip_with(starts, stops, lambda a, b: F.substring(data, (a + 1).cast("int"), (b - a).cast("int")))
    kept = F.aggregate(parts, F.lit(b""), lambda x, y: F.concat(x, y))
    return (docs.drop("n_bytes", "spans", "kept").withColumn("_key", text_key(F.col(text)))
            .join(spans.toDF("_key", "_spans"), "_key", "left")
            .withColumns({"n_bytes": n_bytes, "spans": cut, "kept": kept}).drop("_key", "_spans"))
