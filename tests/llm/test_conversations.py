"""op13 against a shortest-path search over whole audits."""

import hashlib
import heapq
import random
import re
import zlib

from pyspark.sql import functions as F

from cellscape.llm import conversation_repair as R
from cellscape.llm.queries import damaged_conversations

SMALL = "/root/testdata/sf0.001"


def damage(rows):
    """(conv, turn, role, text) after the contract's damage, by conversation in order."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kept = out.setdefault(conv, [])
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        kept.extend([(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1))
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = text.strip(" \t\n\x0b\x0c\r")[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Dijkstra on (cost, audit) over (rows read, shape of the roles so far): the least audit of the least cost."""
    shape = re.compile(r"s?(ua)*u?")
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, body = heapq.heappop(heap)
        state = (i, roles if len(roles) < 2 else roles[-1])
        if state in done:
            continue
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, "\n".join(body)
        done.add(state)
        nexts = []
        for new in ("user", "assistant"):
            nexts.append((cost + 3, audit + "I", i, roles + new[0], (*body, f"{new}:")))
        if i < len(rows):
            _, role, text = rows[i]
            nexts.append((cost + 4, audit + "D", i + 1, roles, body))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 if faults[i] == "truncated" else 0
                nexts.append((cost + extra, audit + "K", i + 1, roles + (role[:1] or "-"), (*body, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    nexts.append((cost + 3 + extra, audit + "R", i + 1, roles + new[0], (*body, f"{new}:{text}")))
        for n in nexts:
            if shape.fullmatch(n[3]):
                heapq.heappush(heap, n)


def wanted(conversations):
    for conv, rows in conversations.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        faults = faults_of(rows)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, body = cheapest(rows, faults)
        yield (conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
               hashlib.sha256(body.encode()).hexdigest())


def key(row):
    return (row[0] is not None, row[0] or 0)


def test_small_table_whole(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    got = [tuple(r) for r in R.repair(damaged_conversations(table), present=F.col("present")).collect()]
    want = list(wanted(damage([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])))
    assert sorted(got, key=key) == sorted(want, key=key)


def random_rows(seed, n_convs=150):
    rnd = random.Random(seed)
    texts = ["Yes.", "No", "", " \t", "What?", "ok!", "a.\n", "b .", None, "é" * 2000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "sys", "user"]
    rows = []
    for c in range(n_convs):
        for _ in range(rnd.choice([0, 1, 2, 5, 9, 14])):
            rows.append((c if c else None, rnd.choice([None, *range(12)]), rnd.choice(roles[:3] if c % 3 else roles), rnd.choice(texts)))
    return rows


def test_awkward_rows_and_small_chunks(spark, monkeypatch):
    rows = random_rows(5)
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, chunk int, rows string")
    want = sorted(wanted({c: rs for c, rs in _plain(rows).items()}), key=key)
    got = sorted((tuple(r) for r in R.repair(table).collect()), key=key)
    assert got == want
    # Chunks of three rows over many partitions: every conversation goes through the composed maps.
    monkeypatch.setattr(R, "CHUNK_ROWS", 3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted((tuple(r) for r in R.repair(table).collect()), key=key) == want
        bodies = {}
        for r in sorted(R.edits(table).collect(), key=lambda r: (r.chunk, r.place)):
            body = bodies.setdefault(r.conv_id, ["", []])
            body[0] += r.edit
            if r.edit != "D":
                body[1].append(f"{r.role}:{r.text}")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    digests = {c: (a, hashlib.sha256("\n".join(b).encode()).hexdigest()) for c, (a, b) in bodies.items()}
    assert digests == {w[0]: (w[7], w[8]) for w in want if w[7]}


def _plain(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return out


def test_one_long_conversation_of_equal_rows(spark, monkeypatch):
    """All rows of the same turn, role and text but a few: cut into chunks, every later one a duplicate."""
    monkeypatch.setattr(R, "CHUNK_ROWS", 50)
    rows = [(7, 1, "user", "Same.")] * 900 + [(7, 2, "assistant", "Fine."), (8, 1, "user", "Same.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r.conv_id: r for r in R.repair(table).collect()}
    assert (got[7].duplicate, got[7].cost, got[7].audit, got[7].gaps) == (899, 899 * 4, "K" + "D" * 899 + "K", 0)
    assert got[7].repaired_sha256 == hashlib.sha256(b"user:Same.\nassistant:Fine.").hexdigest()
    assert (got[8].audit, got[8].cost) == ("KI", 3)


def test_dropped_and_empty(spark):
    table = spark.createDataFrame([(1, 1, "user", "Hi.", False), (2, 1, "assistant", "Hi.", True)],
                                  "conv_id long, turn long, role string, text string, here boolean")
    got = {r.conv_id: tuple(r)[1:] for r in R.repair(table, present=F.col("here")).collect()}
    assert got[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[2] == (0, 0, 0, 0, 0, 3, "IK", hashlib.sha256(b"user:\nassistant:Hi.").hexdigest())
    assert R.repair(table.limit(0), present=F.col("here")).count() == 0
