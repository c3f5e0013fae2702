"""Byte-level BPE encoding and decoding as a tree reduction.

Encodings form a monoid: the join of two neighbours is the encoding of their joined bytes.
``Codec.encode_bytes`` encodes the halves of a piece and joins them by re-encoding a window
of tokens around the seam, which grows until both of its edges are stable.

Why a stable edge proves the result: call a pair of neighbouring tokens stable when encoding
their joined bytes gives the two tokens back.  Merges run by (rank, place).  If some merge
crossed an edge between tokens, the first one to do so would be the best merge open in the
two tokens beside that edge as well, so the pair would not be stable.  A sequence whose
pairs are all stable is therefore the encoding of its bytes.  Pairs inside the left part,
the window and the right part are stable since each is an encoding, so only the two edges of
the window have to be tried.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Pieces of up to this many bytes are merged directly.
LEAF = 2
#: Halves of up to this many bytes are remembered.
SHORT = 5
#: Entries of each memory of a worker, if no other number is given; a full one starts anew.
MEMO = 400_000
#: Bytes of text encoded at a time.
SLICE = 4 << 20


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of lines ``base64 rank``; the ranks run from 0 without gaps."""
    with open(path, "rb") as lines:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines))
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError(f"ranks in {path} have gaps or repeats")
    return [token for _, token in pairs]


class Codec:
    """``memory`` holds what has been learned about pieces; it may outlive the codec."""

    def __init__(self, tokens: list[bytes], pattern: str, memory: dict | None = None, memo: int = MEMO):
        import regex

        self.find = regex.compile(pattern).findall
        self.blank_before_space = regex.compile(r"\s |^ ").search
        memory = {} if memory is None else memory
        if "ranks" not in memory:
            memory |= {"ranks": {token: rank for rank, token in enumerate(tokens)},
                       "halves": {}, "pairs": {}, "pieces": {}, "chunks": {}}
        self.tokens, self.memo = tokens, memo
        self.ranks: dict[bytes, int] = memory["ranks"]
        self.halves: dict[bytes, tuple[int, ...]] = memory["halves"]
        self.pairs: dict[tuple[int, int], tuple[int, ...]] = memory["pairs"]
        self.pieces: dict[str, tuple[int, ...]] = memory["pieces"]
        self.chunks: dict[str, tuple[int, ...]] = memory["chunks"]

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """The encoding by merging, best rank first and leftmost among equals."""
        if len(piece) > 24:
            return self._merge_long(piece)
        ranks = self.ranks
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return tuple([ranks[x] for x in parts])

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap of open pairs, for windows that have grown."""
        ranks, tokens, n = self.ranks, self.tokens, len(piece)
        ids: list[int | None] = [ranks[piece[i:i + 1]] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []
        current: dict[tuple[int, int], int | None] = {}

        def offer(i: int, j: int) -> None:
            current[i, j] = rank = ranks.get(tokens[ids[i]] + tokens[ids[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, j))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            rank, i, j = heapq.heappop(heap)
            if ids[i] is None or ids[j] is None or after[i] != j or current[i, j] != rank:
                continue
            ids[i], ids[j] = rank, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        return tuple(x for x in ids if x is not None)

    def pair(self, left: int, right: int) -> tuple[int, ...]:
        """The encoding of two tokens' bytes; the pair is stable when it is the pair itself."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.merge(self.tokens[left] + self.tokens[right])
            if len(self.pairs) >= self.memo:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The monoid's operation: the encoding of the joined bytes of two encodings."""
        if not left or not right:
            return left + right
        i = j = 1
        window = self.pair(left[-1], right[0])
        while True:
            left_holds = i >= len(left) or self.pair(left[-i - 1], window[0]) == (left[-i - 1], window[0])
            right_holds = j >= len(right) or self.pair(window[-1], right[j]) == (window[-1], right[j])
            if left_holds and right_holds:
                return left[:max(0, len(left) - i)] + window + right[j:]
            i, j = (i if left_holds else 2 * i), (j if right_holds else 2 * j)
            window = self.merge(b"".join([self.tokens[t] for t in left[-i:] + right[:j]]))

    def encode_bytes(self, piece: bytes) -> tuple[int, ...]:
        """Halves first, then their join; short halves come back often and are remembered."""
        n = len(piece)
        if n <= SHORT:
            known = self.halves.get(piece)
            if known is not None:
                return known
        if n <= LEAF:
            ids = self.merge(piece)
        else:
            half = (n + 1) // 2
            ids = self.join(self.encode_bytes(piece[:half]), self.encode_bytes(piece[half:]))
        if n <= SHORT:
            if len(self.halves) >= self.memo:
                self.halves.clear()
            self.halves[piece] = ids
        return ids

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """A match of the split pattern; one that is a token as a whole is that token."""
        known = self.pieces.get(piece)
        if known is not None:
            return known
        data = piece.encode()
        whole = self.ranks.get(data)
        ids = self.encode_bytes(data) if whole is None else (whole,)
        if len(piece) <= 40:
            if len(self.pieces) >= self.memo:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text.

        A match of the pattern has no blank behind a non-blank, so a text may be cut there
        and its chunks encoded apart.  Where every space follows a non-blank, the chunks are
        the text split at spaces, and a chunk (a word with its marks) is looked up whole.
        """
        if self.blank_before_space(text):
            return [i for piece in self.find(text) for i in self.encode_piece(piece)]
        known = self.chunks
        first, *rest = text.split(" ")
        flat = [i for piece in self.find(first) for i in self.encode_piece(piece)]
        for chunk in rest:
            flat += known.get(chunk) or self.encode_chunk(chunk)
        return flat

    def encode_chunk(self, chunk: str) -> tuple[int, ...]:
        """A chunk and the space before it."""
        ids = tuple([i for piece in self.find(" " + chunk) for i in self.encode_piece(piece)])
        if len(chunk) <= 40:
            if len(self.chunks) >= self.memo:
                self.chunks.clear()
            self.chunks[chunk] = ids
        return ids


def _slices(weights: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows that weigh about ``most`` together; a heavier row is a run of its own."""
    ends = np.cumsum(weights.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // most
    cuts = (np.flatnonzero(np.diff(ends)) + 1).tolist()
    for start, stop in zip([0, *cuts], [*cuts, len(weights)], strict=True):
        if stop > start:
            yield start, stop


def _with_column(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(df: DataFrame, tokens: list[bytes], pattern: str, text: str = "text", out: str = "ids",
           memo: int = MEMO) -> DataFrame:
    """Add the token ids of each whole text as an array column ``out``.

    Every match of ``pattern`` is encoded on its own, without special tokens.  Null and empty
    texts have no tokens.  A column that is already named ``out`` is replaced; all others,
    and repeated rows, stay as they are; an empty table gives an empty result.  A very long
    text, also one without any blank, takes time in proportion to its length but for the
    growth of windows.  ``tokens`` is the vocabulary in order of rank, which is small by
    nature and sent to the executors once.  ``memo`` bounds what a worker remembers about pieces;
    it changes the cost and not the result.
    """
    schema = _with_column(df, out, T.ArrayType(T.IntegerType(), False))
    names = [f.name for f in schema.fields[:-1]]
    return df.mapInArrow(_encoder(_vocabulary(df, tokens), pattern, text, names, out, memo), schema)


def decode(df: DataFrame, tokens: list[bytes], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes of each id list as a binary column ``out``; a null or empty list has none.

    Joining bytes is the decoder's monoid: tokens are looked up as leaves of one buffer per
    run of rows, and a row's bytes are the span between its first and its last leaf.  An id
    outside the vocabulary is an error.
    """
    schema = _with_column(df, out, T.BinaryType())
    names = [f.name for f in schema.fields[:-1]]
    return df.mapInArrow(_decoder(_vocabulary(df, tokens), ids, names, out), schema)


def round_trip(df: DataFrame, tokens: list[bytes], pattern: str, text: str = "text", ids: str = "ids",
               out: str = "decoded", memo: int = MEMO) -> DataFrame:
    """``encode`` followed by ``decode`` in the same worker; the text gives way to what was decoded.

    One worker per task runs both, so a task needs the memory of one.  Nulls, empty tables and
    other columns are treated as the two do.
    """
    kept = [f for f in df.schema.fields if f.name not in (text, ids, out)]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField(ids, T.ArrayType(T.IntegerType(), False)),
                           T.StructField(out, T.BinaryType())])
    vocabulary = _vocabulary(df, tokens)
    encoded = _encoder(vocabulary, pattern, text, names, ids, memo)
    decoded = _decoder(vocabulary, ids, [*names, ids], out)
    return df.mapInArrow(lambda batches: decoded(encoded(batches)), schema)


def _vocabulary(df: DataFrame, tokens: list[bytes]):
    return df.sparkSession.sparkContext.broadcast({"tokens": tokens, "memory": {}})


def _encoder(vocabulary, pattern: str, text: str, names: list[str], out: str, memo: int):
    """Batches with the columns ``names`` and the ids of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The broadcast value stays in a worker between tasks, and with it the codec's memory.
        codec = Codec(vocabulary.value["tokens"], pattern, vocabulary.value["memory"], memo)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            for start, stop in _slices(pc.binary_length(texts), SLICE):
                flat, ends = [], [0]
                for x in texts.slice(start, stop - start).to_pylist():
                    flat += codec.encode(x or "")
                    ends.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(n)) for n in names), ids],
                                                 names=[*names, out])

    return run


def _decoder(vocabulary, ids: str, names: list[str], out: str):
    """Batches with the columns ``names`` and the bytes of ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(vocabulary.value["tokens"], pa.large_binary())
        for batch in batches:
            every = batch.column(batch.schema.get_field_index(ids))
            for start, stop in _slices(pc.list_value_length(every), SLICE // 4):
                part, lists = batch.slice(start, stop - start), every.slice(start, stop - start)
                counts = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                leaves = table.take(lists.flatten())
                at = np.frombuffer(leaves.buffers()[1], np.int64, len(leaves) + 1, leaves.offset * 8)
                spans = np.ascontiguousarray(at[np.concatenate(([0], np.cumsum(counts)))])
                data = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(counts), [None, pa.py_buffer(spans), leaves.buffers()[2]])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(n)) for n in names), data.cast(pa.binary())],
                    names=[*names, out])

    return run
