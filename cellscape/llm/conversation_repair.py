"""Conversation structure repair by Four-Russians block tables.

The cheapest edits that give a conversation the role order ``(s?(ua)+)?`` are a shortest path over four
states (nothing yet, after s, after u, after a).  A row acts on the vector of the four costs-to-go; there are ten
kinds of rows (``SYMBOLS``) and, once the least cost is subtracted, few vectors.  So the effect of every block of
BLOCK symbols on every vector is tabled beforehand.  A conversation is processed from its end, one lookup
per block; the edits are then traced from its start, where each block is expanded backward into the vectors
between its symbols.  As these are costs-to-go, taking the least letter of all cheapest moves at every
point gives the least audit of all cheapest ones.

Rows are range-partitioned in order, so a conversation of any length is cut into chunks of at most
CHUNK_ROWS rows.  A chunk is a function from the vector behind it to the one before it, and then from the state
before it to the one behind it; these functions are composed over the chunks of a partition and then over
partitions.  Only conversations that lie in several chunks, or at the edge of a partition, need that.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscape.session import Scratch

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: State after a user or assistant row that is inserted or renamed to what the state wants.
WANTED = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}
NEW_ROLE = {AFTER_U: "user", AFTER_A: "assistant"}
#: Roles by their initial; any other initial has no place.
ROLES = "sua"
OTHER = 3
#: Rows: role class (0 to 3), the same truncated (4 to 7), to be deleted, no row (fills up a block).
SYMBOLS, MUST_DELETE, NO_ROW = 10, 8, 9
BLOCK = 4
CHUNK_ROWS, CHUNK_CHARS = 1024, 1 << 20
BLANK_CHARS = " \t\n\x0b\x0c\r"


def _keep(state: int, role: int) -> int | None:
    if role == 0:
        return AFTER_S if state == START else None
    if role == 1:
        return AFTER_U if state != AFTER_U else None
    return AFTER_A if role == 2 and state == AFTER_U else None


def _with_inserts(costs: list[int]) -> list[int]:
    for _ in range(2):
        costs = [min(c, INSERT + costs[WANTED[s]]) for s, c in enumerate(costs)]
    return costs


def _moves(behind: tuple, symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost to go, state) of the edits that consume one row."""
    found = [("D", DELETE + behind[state], state)]
    if symbol < MUST_DELETE:
        extra = TRUNCATED if symbol >= 4 else 0
        to = _keep(state, symbol % 4)
        if to is not None:
            found.append(("K", KEEP + extra + behind[to], to))
        found.append(("R", REROLE + extra + behind[WANTED[state]], WANTED[state]))
    return found


def _before(behind: tuple, symbol: int) -> list[int]:
    if symbol == NO_ROW:
        return list(behind)
    return _with_inserts([min(cost for _, cost, _ in _moves(behind, symbol, s)) for s in range(4)])


def _letters(behind: tuple, symbol: int, state: int) -> tuple[str, int]:
    """The least letters of a cheapest way past one row, and the state behind it."""
    if symbol == NO_ROW:
        return "", state
    before, letters = _before(behind, symbol), ""
    while True:
        cheapest = {letter: to for letter, cost, to in _moves(behind, symbol, state) if cost == before[state]}
        if INSERT + before[WANTED[state]] == before[state]:
            cheapest["I"] = WANTED[state]
        letter = min(cheapest)
        letters, state = letters + letter, cheapest[letter]
        if letter != "I":
            return letters, state


class Tables:
    """Normalised cost vectors, their transitions by symbol and by block, and the traced letters."""

    def __init__(self) -> None:
        far = 100
        self.vectors = [tuple(_with_inserts([0, far, far, 0]))]
        number = {self.vectors[0]: 0}
        steps: list[list[int]] = []
        self.letters: list[list[list[tuple[str, int]]]] = []
        for v in self.vectors:  # grows while it is read, until no new vector appears
            row = []
            for symbol in range(SYMBOLS):
                costs = _before(v, symbol)
                least = min(costs)
                normal = tuple(c - least for c in costs)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                row.append(number[normal])
            steps.append(row)
            self.letters.append([[_letters(v, symbol, s) for s in range(4)] for symbol in range(SYMBOLS)])
        self.step = steps
        # blocks[code] = transition of all vectors; the last symbol of a block acts first.
        step = np.array(steps, dtype=np.int32)
        blocks = np.arange(len(self.vectors), dtype=np.int32)[None, :]
        for _ in range(BLOCK):
            blocks = np.concatenate([step[:, symbol][blocks] for symbol in range(SYMBOLS)])
        self.blocks = blocks


@functools.lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def blocks_of(symbols: list[int]) -> tuple[list[int], list[int]]:
    """The symbols filled up to whole blocks, and the code of every block (first symbol weighs most)."""
    filled = symbols + [NO_ROW] * (-len(symbols) % BLOCK)
    codes = []
    for i in range(0, len(filled), BLOCK):
        code = 0
        for symbol in filled[i:i + BLOCK]:
            code = code * SYMBOLS + symbol
        codes.append(code)
    return filled, codes


def trace(symbols: list[int], behind: int, state: int) -> tuple[list[str], int]:
    """The letters for each symbol and the state behind the last one; ``behind`` is the vector there."""
    t = tables()
    filled, codes = blocks_of(symbols)
    edges = [behind]
    for code in reversed(codes):
        edges.append(int(t.blocks[code, edges[-1]]))
    edges.reverse()
    letters = []
    for b in range(len(codes)):
        block = filled[b * BLOCK:(b + 1) * BLOCK]
        after = [edges[b + 1]]  # vectors behind the block's symbols, expanded backward
        for symbol in reversed(block[1:]):
            after.append(t.step[after[-1]][symbol])
        for symbol, v in zip(block, reversed(after)):
            out, state = t.letters[v][symbol][state]
            letters.append(out)
    return letters[:len(symbols)], state


# --- rows to chunks --------------------------------------------------------------------------------

_ROW = "struct<turn:bigint,role:string,text:string,flaw:int,digest:binary>"
_CHUNK = f"conv_id {{0}}, chunk bigint, alone boolean, rows array<{_ROW}>"


def _prepared(rows: DataFrame, conv_id: str, turn: str, role: str, text: str, present: Column) -> DataFrame:
    out = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                      F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
                      F.coalesce(present, F.lit(False)).alias("present"))
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANK_CHARS)), -1, 1)
    flaw = F.when(~F.col("present"), -1).when(last == "", 2).when(last.isin(".", "!", "?"), 0).otherwise(1)
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    return out.withColumn("flaw", flaw.cast("int")).withColumn("digest", digest).drop("present")


def _chunks(prepared: DataFrame) -> DataFrame:
    """Rows in order, cut into chunks of one conversation each; ``alone``: surely the only one of its conversation."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("_tie")]
    placed = prepared.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    conv_type = dict(prepared.dtypes)["conv_id"]
    schema = _CHUNK.format(conv_type)
    arrow = _arrow_schema(prepared.sparkSession, schema)

    def cut(batches):
        from pyspark import TaskContext

        base, seq, first = TaskContext.get().partitionId() << 32, 0, True
        conv, rows, chars, whole, out = None, [], 0, True, []

        def flush(alone):
            nonlocal seq, rows, chars
            out.append((conv, base + seq, alone, rows))
            seq, rows, chars = seq + 1, [], 0

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "flaw", "digest")]
            for c, turn, role, text, flaw, digest in zip(*columns):
                if first:
                    conv, first, whole = c, False, False  # it may have begun in the partition before
                elif c != conv:
                    flush(whole)
                    conv, whole = c, True
                elif len(rows) >= CHUNK_ROWS or chars >= CHUNK_CHARS:
                    whole = False
                    flush(False)
                rows.append({"turn": turn, "role": role, "text": text, "flaw": flaw, "digest": digest})
                chars += len(text)
            if out:
                yield _batch(out, arrow)
                out = []
        if not first:
            flush(False)  # it may go on in the next partition
            yield _batch(out, arrow)

    return placed.drop("_tie").mapInArrow(cut, schema)


def _arrow_schema(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _read(rows: list[dict], seen) -> list[tuple[dict, str, int]]:
    """(row, fault, symbol) of the rows that are there; ``seen`` holds the digests of earlier chunks."""
    seen, out = set(() if seen is None else seen), []
    for row in rows:
        if row["flaw"] < 0:
            continue
        fault = ("", "truncated", "blank")[row["flaw"]]
        if fault != "blank" and row["digest"] in seen:
            fault = "duplicate"
        seen.add(row["digest"])
        role = ROLES.find(row["role"][:1]) if row["role"] else OTHER
        symbol = MUST_DELETE if fault in ("blank", "duplicate") else (role if role >= 0 else OTHER) + 4 * (fault == "truncated")
        out.append((row, fault, symbol))
    return out


# --- chunks of one conversation --------------------------------------------------------------------

def _seen_before(chunks: DataFrame, scratch: Scratch) -> DataFrame:
    """(chunk, seen): digests of a chunk that an earlier chunk of the conversation holds."""
    rows = chunks.select("conv_id", "chunk", F.explode("rows").alias("r")).where("r.flaw >= 0")
    held = scratch.put("held", rows.select("conv_id", "chunk", F.col("r.digest").alias("digest")).distinct())
    first = held.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(
        F.min("chunk").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")) & (F.col("chunk") > F.col("first"))
    return held.join(first, same).groupBy("chunk").agg(F.collect_list("digest").alias("seen"))


def _scan(maps: DataFrame, start: int, backward: bool, scratch: Scratch, name: str) -> DataFrame:
    """(chunk, value) from (conv_id, chunk, map): what reaches a chunk when ``start`` goes through the maps of all
    chunks of its conversation that come before it (behind it, if ``backward``).

    Maps are composed over the chunks of one partition, then over partitions; no task holds more than one of the two.
    """
    maps = maps.withColumn("part", F.shiftright("chunk", 32))
    conv_type = dict(maps.dtypes)["conv_id"]

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk", ascending=not backward)
        total = np.arange(len(pdf["map"].iloc[0]))
        for m in pdf["map"]:
            total = np.asarray(m)[total]
        return pd.DataFrame({"conv_id": pdf["conv_id"].iloc[:1].to_numpy(), "part": pdf["part"].iloc[:1].to_numpy(), "map": [total]})

    def through(order: str):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(order, ascending=not backward)
            at, values = int(pdf["value"].iloc[0]) if "value" in pdf else start, []
            for m in pdf["map"]:
                values.append(at)
                at = int(m[at])
            return pd.DataFrame({"conv_id": pdf["conv_id"].to_numpy(), order: pdf[order].to_numpy(), "value": values})
        return run

    parts = maps.groupBy("conv_id", "part").applyInPandas(whole, f"conv_id {conv_type}, part bigint, map array<int>")
    reached = scratch.put(f"{name}-parts", parts.groupBy("conv_id").applyInPandas(
        through("part"), f"conv_id {conv_type}, part bigint, value int"))
    reached = reached.toDF("c", "p", "value")
    joined = maps.join(reached, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).drop("c", "p")
    return joined.groupBy("conv_id", "part").applyInPandas(
        through("chunk"), f"conv_id {conv_type}, chunk bigint, value int").select("chunk", "value")


def _contexts(spread: DataFrame, scratch: Scratch) -> DataFrame:
    """(chunk, seen, behind, state) for the chunks of conversations that may lie in several."""
    conv_type = dict(spread.dtypes)["conv_id"]
    seen = spread.join(scratch.put("seen", _seen_before(spread, scratch)), "chunk", "left")

    def symbols(batches):
        for pdf in batches:
            codes = [[s for _, _, s in _read(rows, known)] for rows, known in zip(pdf["rows"], pdf["seen"])]
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "chunk": pdf["chunk"], "seen": pdf["seen"], "symbols": codes})

    read = scratch.put("symbols", seen.select("conv_id", "chunk", "seen", "rows").mapInPandas(
        symbols, f"conv_id {conv_type}, chunk bigint, seen array<binary>, symbols array<int>"))

    def vectors(batches):
        t = tables()
        for pdf in batches:
            maps = []
            for codes in pdf["symbols"]:
                reach = np.arange(len(t.vectors))
                for code in reversed(blocks_of([int(c) for c in codes])[1]):
                    reach = t.blocks[code][reach]
                maps.append(reach)
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "chunk": pdf["chunk"], "map": maps})

    schema = f"conv_id {conv_type}, chunk bigint, map array<int>"
    behind = scratch.put("behind", _scan(scratch.put("vectors", read.select("conv_id", "chunk", "symbols").mapInPandas(
        vectors, schema)), 0, True, scratch, "back").withColumnRenamed("value", "behind"))

    def states(batches):
        for pdf in batches:
            maps = [[trace([int(c) for c in codes], int(v), s)[1] for s in range(4)]
                    for codes, v in zip(pdf["symbols"], pdf["behind"])]
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "chunk": pdf["chunk"], "map": maps})

    forward = scratch.put("states", read.join(behind, "chunk").select("conv_id", "chunk", "symbols", "behind").mapInPandas(
        states, schema))
    state = _scan(forward, START, False, scratch, "forth").withColumnRenamed("value", "state")
    ends = read.groupBy("conv_id").agg(F.max("chunk").alias("chunk")).select("chunk", F.lit(True).alias("last"))
    return (read.select("chunk", "seen").join(behind, "chunk").join(state, "chunk").join(ends, "chunk", "left")
            .withColumn("last", F.col("last").isNotNull()))


def _with_contexts(rows: DataFrame, conv_id: str, turn: str, role: str, text: str, present: Column | None) -> tuple[DataFrame, DataFrame]:
    """Chunks that are whole conversations and chunks of others, each with what they need to know."""
    scratch = Scratch(rows.sparkSession)
    there = F.lit(True) if present is None else present
    chunks = scratch.put("chunks", _chunks(_prepared(rows, conv_id, turn, role, text, there)))
    spread = chunks.where("not alone")
    known = scratch.put("contexts", _contexts(spread, scratch))
    whole = chunks.where("alone").select("conv_id", "chunk", "rows", F.lit(None).cast("array<binary>").alias("seen"),
                                         F.lit(0).alias("behind"), F.lit(START).alias("state"), F.lit(True).alias("last"))
    return whole, spread.join(known, "chunk").select(*whole.columns)


class Edit(NamedTuple):
    letter: str
    row: dict | None  #: None for an insert
    fault: str
    role: str | None  #: role after the edit, None for a deleted row


def _edited(rows: list[dict], seen, behind: int, state: int, last: bool) -> Iterator[Edit]:
    read = _read(rows, seen)
    letters, _ = trace([symbol for _, _, symbol in read], behind, state)
    for (row, fault, symbol), word in zip(read, letters):
        for letter in word:
            if letter == "D":
                yield Edit(letter, row, fault, None)
                continue
            state = _keep(state, symbol % 4) if letter == "K" else WANTED[state]
            if letter == "I":
                yield Edit(letter, None, "", NEW_ROLE[state])
            else:
                yield Edit(letter, row, fault, row["role"] if letter == "K" else NEW_ROLE[state])
    while last and state in (AFTER_S, AFTER_U):
        state = WANTED[state]
        yield Edit("I", None, "", NEW_ROLE[state])


# --- results ---------------------------------------------------------------------------------------

_COSTS = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}
FAULTS = ("blank", "duplicate", "truncated")
LEGAL = ("su", "ua", "au")
_PIECE = ("conv_id {0}, chunk bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "low bigint, high bigint, turns bigint, first string, final string, audit string, body string")
_REPORT = ("conv_id {0}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
           "audit string, repaired_sha256 string")
_EDIT = "conv_id {0}, chunk bigint, place int, edit string, turn bigint, role string, text string"
_CONTEXT = ("conv_id", "chunk", "rows", "seen", "behind", "state", "last")


def _piece(conv, chunk: int, rows: list[dict], *context) -> tuple:
    present = [r for r in rows if r["flaw"] >= 0]
    turns = {r["turn"] for r in present if r["turn"] is not None}
    roles = [r["role"][:1] for r in present]
    counts, cost, audit, body = dict.fromkeys(FAULTS, 0), 0, [], []
    for e in _edited(rows, *context):
        audit.append(e.letter)
        cost += _COSTS[e.letter] + (TRUNCATED if e.fault == "truncated" and e.letter != "D" else 0)
        if e.fault:
            counts[e.fault] += 1
        if e.role is not None:
            body.append(f"{e.role}:{e.row['text'] if e.row else ''}")
    illegal = sum(a + b not in LEGAL for a, b in zip(roles, roles[1:]))
    return (conv, chunk, *counts.values(), illegal, cost, min(turns, default=None), max(turns, default=None), len(turns),
            roles[0] if roles else None, roles[-1] if roles else None, "".join(audit), "\n".join(body) if body else None)


def _rows_of(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    while some := list(itertools.islice(rows, size)):
        yield _batch(some, schema)


def _reports(pieces: Iterator[tuple], names: list[str]) -> Iterator[tuple]:
    """One report per conversation from its pieces, which follow one another in order; the digest is fed piece by
    piece, so of a conversation only the audit is held."""
    for conv, group in itertools.groupby((dict(zip(names, p)) for p in pieces), key=lambda p: p["conv_id"]):
        total = dict.fromkeys((*FAULTS, "illegal", "cost"), 0)
        low = high = final = None
        turns, audit, sha, any_body = 0, [], hashlib.sha256(), False
        for p in group:
            for c in total:
                total[c] += p[c]
            if p["first"] is not None:
                total["illegal"] += final is not None and final + p["first"] not in LEGAL
                final = p["final"]
            if p["turns"]:
                # Turns rise, so a turn lies in two pieces only as the last of one and the first of the next.
                turns += p["turns"] - (high == p["low"])
                low, high = (p["low"] if low is None else low), p["high"]
            audit.append(p["audit"])
            if p["body"] is not None:
                sha.update((("\n" if any_body else "") + p["body"]).encode())
                any_body = True
        yield (conv, high - low + 1 - turns if turns else 0, *total.values(), "".join(audit), sha.hexdigest())


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           present: Column | None = None) -> DataFrame:
    """One row per conv_id: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A conversation's rows are taken by turn, null turns first, rows of one turn by role and then by the MD5 of role
    and text.  Null roles and texts count as one space; a null conv_id is a conversation of its own; an empty role has no
    place in the order and makes its neighbours illegal.  Rows for which ``present`` does not hold are not there, but their
    conv_id is reported: without rows, with zeros, an empty audit and the digest of the empty string.
    Repeated rows are duplicates.  Texts may be of any length that fits a row; an empty table gives an empty
    result; other columns, whatever their names, are read by ``present`` only.
    """
    whole, spread = _with_contexts(rows, conv_id, turn, role, text, present)
    conv_type = dict(whole.dtypes)["conv_id"]
    piece, report = _PIECE.format(conv_type), _REPORT.format(conv_type)
    pieces, reports = _arrow_schema(rows.sparkSession, piece), _arrow_schema(rows.sparkSession, report)

    def both(batches):
        return _batches(_reports((_piece(*c) for c in _rows_of(batches, _CONTEXT)), pieces.names), reports)

    def first(batches):
        return _batches((_piece(*c) for c in _rows_of(batches, _CONTEXT)), pieces)

    def second(batches):
        return _batches(_reports(_rows_of(batches, tuple(pieces.names)), pieces.names), reports)

    # Whole conversations need no shuffle; the others come together piece by piece, in order.
    gathered = spread.mapInArrow(first, piece).repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return whole.mapInArrow(both, report).unionByName(gathered.mapInArrow(second, report))


def edits(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
          present: Column | None = None) -> DataFrame:
    """The edits themselves, one row each: conv_id, chunk, place (in the chunk), edit (K, R, D or I), turn, role, text.

    Ordered by chunk and place, the rows with other edits than D are the repaired conversations.  Edge cases as in ``repair``.
    """
    whole, spread = _with_contexts(rows, conv_id, turn, role, text, present)
    schema = _EDIT.format(dict(whole.dtypes)["conv_id"])
    arrow = _arrow_schema(rows.sparkSession, schema)

    def listed(batches):
        for conv, chunk, *context in _rows_of(batches, _CONTEXT):
            for place, e in enumerate(_edited(*context)):
                yield (conv, chunk, place, e.letter, e.row and e.row["turn"], e.row["role"] if e.letter == "D" else e.role,
                       e.row["text"] if e.row else "")

    return whole.unionByName(spread).mapInArrow(lambda batches: _batches(listed(batches), arrow, 4096), schema)
