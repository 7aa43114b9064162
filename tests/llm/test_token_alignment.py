"""Token alignment against a plain walk over both token sequences."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from quarry.llm.token_alignment import Csr, Tokenizers, alignment_digest, links, token_links

A, B = str(P.path("byte_bpe_50k.json")), str(P.path("piece_bpe_32k.model"))
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ALPHABET = ["a", "b", " ", "  ", "\n", "\t", "\r", " ", "é", "ß", "中", "😀", "'s", "1", "23", "...", "The", " and",
            "\r\n", "　", "\x1c", "\x85", "<s>", "<|endoftext|>", "́", "▁", "=====", "\x00", "​"]


def walk(both, text):
    """Groups as pairs of id lists; None if the texts cannot be aligned."""
    if not text:
        return None
    raw = (" " + text).encode()
    a = both.a.encode(" " + text, add_special_tokens=False).ids
    b = both.b.encode(text)
    sizes = []
    for ids, table in ((a, both.a_bytes), (b, both.b_bytes)):
        if b"".join(table[t] for t in ids) != raw:
            return None
        sizes.append(np.cumsum([len(table[t]) for t in ids]).tolist())
    groups, i, j = [], 0, 0
    for cut in sorted(set(sizes[0]) & set(sizes[1])):
        x, y = [], []
        while i < len(a) and sizes[0][i] <= cut:
            x.append(a[i])
            i += 1
        while j < len(b) and sizes[1][j] <= cut:
            y.append(b[j])
            j += 1
        groups.append((x, y))
    return groups


def plain(rows):
    both = Tokenizers(A, B)
    found = [(d, walk(both, t)) for d, t in rows]
    held = [(d, g, [(x, y) for xs, ys in g or () for x in xs for y in ys]) for d, g in found]
    count = collections.Counter(p for _, _, ps in held for p in set(ps))
    top = collections.defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for d, g, ps in held:
        if g is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        sha = hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g).encode())
        out.append((d, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(ps),
                    sum(count[p] == top[p[0]] for p in ps), sum(count[p] for p in ps), sha.hexdigest()))
    return out


def by_value(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("block_chars", [1 << 10, 8 << 20])
def test_random_texts(spark, block_chars):
    rng = random.Random(block_chars)
    rows = [(i, "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30)))) for i in range(1500)]
    rows += rows[:50] + [(None, None), (1, None), (None, "abc"), (5, "x" * 30000), (6, " " * 5000 + "y\n" * 900)]
    got = alignment_digest(spark.createDataFrame(rows, "doc_id long, text string"), A, B, block_chars=block_chars)
    assert by_value(got.collect()) == by_value(plain(rows))


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert by_value(alignment_digest(df, A, B).collect()) == by_value(plain(map(tuple, df.collect())))


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment_digest(df, A, B).count() == 0
    assert token_links(df, A, B).count() == 0
    df = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    for name in ("block", "holder", "pairs", "n", "best", "links", "at"):
        df = df.withColumn(name, F.lit("z"))
    assert by_value(alignment_digest(df, A, B).collect()) == by_value(plain([(1, "one two")]))


def test_links_of_texts(spark):
    both = Tokenizers(A, B)
    texts = ["Unbelievable 😀 naïveté", "a  b\n\nc", "", None, "▁"]
    got = token_links(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"), A, B)
    for r in got.collect():
        groups = walk(both, texts[r.i]) or []
        assert sorted((x.group, x.a, x.b) for x in r.links) == sorted(
            (g, x, y) for g, (xs, ys) in enumerate(groups) for x in xs for y in ys)
        if groups:
            assert sum(x.bytes for x in r.links) == len((" " + texts[r.i]).encode())


def test_products_against_dense():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 3, (17, 23)), rng.integers(0, 3, (23, 9))

    def sparse(m):
        r, c = np.nonzero(m)
        return Csr.from_entries(r, c, m[r, c], *m.shape)

    def dense(s):
        m = np.zeros((s.height, s.width), np.int64)
        m[s.rows(), s.cols] = s.data
        return m
    assert (dense(sparse(x).times(sparse(y))) == x @ y).all()
    assert (dense(sparse(x).transposed()) == x.T).all()
    assert (sparse(x).times_vector(np.arange(23)) == x @ np.arange(23)).all()
    overlap, shared, _, _ = links(np.array([2, 3, 1]), np.array([1, 4, 1]))
    assert dense(overlap).tolist() == [[1, 1, 0], [0, 3, 0], [0, 0, 1]]
    assert dense(shared).tolist() == [[1, 1, 0], [1, 1, 0], [0, 0, 1]]
