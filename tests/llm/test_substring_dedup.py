"""The FM-index and substring dedup against plain scans."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm.fm_index import FmIndex, intervals
from quarry.llm.substring_dedup import drop_repeats

SCHEMA = "doc_id long, text string"


def test_matching_statistics():
    rng = random.Random(1)

    def longest(q, i, indexed, before=None):
        best = 0
        for n, s in enumerate(indexed):
            for j in range(len(s)):
                size = 0
                while i + size < len(q) and j + size < len(s) and q[i + size] == s[j + size]:
                    size += 1
                if before is None or (n, j) < before:
                    best = max(best, size)
        return best

    for _ in range(60):
        seqs = [[rng.randint(1, 4) for _ in range(rng.randint(1, 12))] for _ in range(rng.randint(1, 12))]
        asked = [[rng.randint(0, 5) for _ in range(rng.randint(1, 12))] for _ in range(6)]
        sizes, flat = np.array(list(map(len, seqs))), np.array([x for s in seqs for x in s])
        index = FmIndex(flat, sizes)
        found = index.matching_statistics(np.array([x for q in asked for x in q]), np.array(list(map(len, asked))))
        assert found.tolist() == [longest(q, i, seqs) for q in asked for i in range(len(q))]
        order = np.full(index.n, len(flat))
        order[index.inner] = np.arange(len(flat))
        own = index.matching_statistics(flat, sizes, order, np.arange(len(flat)))
        assert own.tolist() == [longest(s, i, seqs, (n, i)) for n, s in enumerate(seqs) for i in range(len(s))]
    assert intervals(np.array([0, 3, 2, 1, 0, 0, 3, 3, 0, 0]), 3) == [(1, 4), (6, 10)]


def plain(rows, window):
    first = {}
    key = lambda d: (d is not None, d or 0)
    docs = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in docs:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, (key(d), i)), (key(d), i))
    out = []
    for d, w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if (key(d), i) > first[tuple(w[i:i + window])]:
                gone[i:i + window] = [True] * window
        out.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def by_value(rows):
    return sorted(rows, key=str)


def found(df, window, **kw):
    return by_value((r.doc_id, r.n_words, r.n_removed, r.kept_text)
                    for r in drop_repeats(df, min_words=window, **kw).collect())


def passages(n, vocabulary, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    shared = [[rng.choice(words) for _ in range(rng.randint(15, 60))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(shared)
            at = rng.randint(0, len(w))
            w[at:at] = p[rng.randint(0, 5):len(p) - rng.randint(0, 5)]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    copies = [(n + i, rows[3 * i][1]) for i in range(n // 6)]
    odd = [(None, None), (None, "a " * 100), (n + 1, "a b " * 60), (7, rows[9][1]), (7, rows[9][1]),
           (None, rows[10][1]), (5, ""), (6, " \n"), (n + 500, "é 中\xa0文 " * 30)]
    return rows + copies + odd


@pytest.mark.parametrize("vocabulary, window, settings", [
    (300, 20, {}), (300, 20, {"hot": 3, "shard_words": 500}), (2, 20, {}), (2, 5, {"hot": 4}), (3, 90, {})])
def test_against_plain_scan(spark, vocabulary, window, settings):
    rows = passages(150, vocabulary, vocabulary + window)
    assert found(spark.createDataFrame(rows, SCHEMA), window, **settings) == by_value(plain(rows, window))


def test_hot_passage_in_many_contexts(spark):
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join([f"x{rng.randint(0, 9 ** 6)}" for _ in range(9)] + passage
                         + [f"y{rng.randint(0, 9 ** 6)}" for _ in range(9)])) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df, 20, hot=50) == found(df, 20) == by_value(plain(rows, 20))


def test_spans_clashing_columns_empty_table_and_long_text(spark):
    rows = [(1, "a " * 5 + " ".join(f"w{i}" for i in range(200_000))), (2, "b " + " ".join(f"w{i}" for i in range(25)))]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "anchor", "body", "start", "removed", "gone", "words", "__x"):
        df = df.withColumn(name, F.lit("z"))
    got = {r.doc_id: r for r in drop_repeats(df).collect()}
    assert [(s.start, s.stop) for s in got[2].removed] == [(1, 26)] and got[2].kept_text == "b"
    assert got[1].n_removed == 0 and got[1].row == "z" and got[1].n_words == 200_005
    assert drop_repeats(df.limit(0)).count() == 0
