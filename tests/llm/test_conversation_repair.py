"""Conversation repair against a plain search over all edits."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from quarry.llm.conversation_repair import SuffixPath, damaged, repair_conversations, repair_digest

SCHEMA = "conv_id long, turn long, role string, text string"
FULL = {"u": "user", "a": "assistant"}


def damage(rows):
    conv = defaultdict(list)
    for c, t, r, x in rows:
        conv[c]
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 1:
            x = ""
        elif kind == 2:
            x = re.sub("[.!?]", "", x)
        elif kind == 4:
            r = "user"
        conv[c] += [(t, r, x)] * {0: 0, 3: 2}.get(kind, 1)
    return conv


def cheapest(rows, faults):
    """Dijkstra over (cost, audit): the first end reached is the cheapest, least audit."""
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, out
        want = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        heapq.heappush(heap, (cost + 2, audit + "I", i, want, (*out, FULL[want] + ":")))
        if i == len(rows):
            continue
        _, role, text = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
        if faults[i] in ("blank", "duplicate"):
            continue
        more = cost + (faults[i] == "truncated")
        heapq.heappush(heap, (more + 2, audit + "R", i + 1, want, (*out, f"{FULL[want]}:{text}")))
        if role[:1] == want or (state == "" and role[:1] == "s"):
            heapq.heappush(heap, (more, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}")))


def plain(rows):
    out = {}
    for c, rs in damage(rows).items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in rs if t is not None]
        faults, seen = [], set()
        for _, r, x in rs:
            y = x.strip(" \t\n\r\x0b\x0c")
            faults.append("blank" if not y else "duplicate" if (r, x) in seen else
                          "truncated" if y[-1] not in ".!?" else "")
            seen.add((r, x))
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rs, rs[1:]))
        cost, audit, made = cheapest(rs, faults)
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                  *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit,
                  hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def random_rows(conversations, longest, seed):
    rng = random.Random(seed)
    texts = ["a.", "b", "", "  ", None, "c!", "d. ", "é", "x\x0b", "y?\n", "." * 3]
    return [(c, rng.choice([None, 1, 2, 3, 4, 5, 9]), rng.choice(["user", "assistant", "system", "tool", None, ""]),
             rng.choice(texts)) for c in [*range(conversations), None] for _ in range(rng.randint(1, longest))]


def test_random_damage_against_search(spark):
    rows = random_rows(300, 9, 3)
    rows += rows[:200]  # repeated rows
    got = {r[0]: tuple(r)[1:] for r in repair_digest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == plain(rows)


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in repair_digest(df).collect()}
    assert got == plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_empty_table_clashing_columns_and_long_conversation(spark):
    assert repair_digest(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, i, ("user", "assistant")[i % 2], f"{i} " + "word " * 50 + ".") for i in range(3000)]
    rows += [(2, 0, "user", "x" * 2_000_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("pos", "letter", "seen", "signature", "audit", "cost", "dropped", "kind", "copy"):
        df = df.withColumn(name, F.lit("z"))
    got = {r[0]: tuple(r)[1:] for r in repair_digest(df).collect()}
    assert got == plain(rows)


def test_repaired_rows_are_legal_and_digest_alike(spark):
    rows = random_rows(60, 6, 5)
    fixed = repair_conversations(damaged(spark.createDataFrame(rows, SCHEMA)), dropped="dropped")
    made = defaultdict(list)
    for r in fixed.rows().orderBy("conv_id", "pos").collect():
        made[r.conv_id].append(r)
    for c, d in {r.conv_id: r for r in fixed.digests().collect()}.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in made[c]))
        text = "\n".join(f"{r.role}:{r.text}" for r in made[c])
        assert hashlib.sha256(text.encode()).hexdigest() == d.repaired_sha256
        assert "".join(r.edit for r in made[c]) == d.audit.replace("D", "")


def test_shared_ends_are_computed_once():
    path = SuffixPath()
    for s in sorted(["ua" * 500, "s" + "ua" * 500, "x" + "ua" * 500], key=lambda s: s[::-1]):
        path.repair(s)
    assert path.made == 1 + 1000 + 2
