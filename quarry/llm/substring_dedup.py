"""Substring dedup: repeated passages, by an FM-index for each shard.

A window is ``min_words`` consecutive words of one document.  A word goes if
a window over it also starts earlier (smaller doc_id, or the same document
and an earlier start).

Streaming all documents past the index of every shard of documents would
cost documents x shards.  So shards are made by content: every window has an
*anchor*, the least hash among its runs of ``anchor_words`` words, and equal
windows have equal anchors.  Neighbouring windows mostly share theirs; such
a stretch is one *segment*, about seven words and a window long.  All
segments of an anchor go to one shard, so a window meets its copies there.

1. Segments are cut where documents are read; only their anchor, a digest of
   their words and their position are written (one row for some seven words).
2. Anchors that occur once are clean; counting them shuffles one number.
3. Segments with the same words are one *body*, judged by its first
   occurrence; in all others each window is a repeat.  Copies, however many,
   are thus one body, and partial sums come before the shuffle.
4. Bodies that share their anchor with another body may share a part of
   their windows.  Their words are cut from their first document and sent to
   the anchor's shard, about ``shard_words`` words each.  There they are
   indexed (:mod:`quarry.llm.fm_index`), each body streams past the index,
   and its matching statistics, counting earlier positions only, tell which
   of its windows start earlier elsewhere.
5. An anchor with more than ``hot`` bodies (the edges of a passage that very
   many documents share) would be a shard of its own: its bodies are cut into
   single windows, and equal windows are grouped with partial sums.
6. Verdicts return to the occurrences, and the windows' words to the documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import schema_with, slices, small_batches, stored, text_bytes, worker_cache
from .fm_index import FmIndex

CACHE_WORDS = 200_000
BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes], memory: dict) -> np.ndarray:
    """Two 64-bit hashes for each word."""
    import xxhash
    new = set(words).difference(memory)
    if len(memory) + len(new) > CACHE_WORDS:
        memory.clear()
        new = set(words)
    for w in new:
        memory[w] = xxhash.xxh3_128_digest(w)
    return np.frombuffer(b"".join(map(memory.__getitem__, words)), np.uint64).reshape(-1, 2)


def cut_segments(hashes: np.ndarray, sizes: np.ndarray, window: int, run: int):
    """The segments of some documents (word hashes in a row, words of each):
    anchor, digest of the words, document, first word, number of words."""
    none = np.zeros(0, np.int64)
    n = len(hashes) - window + 1
    if n <= 0:
        return none, none, none, none, none
    doc = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.concatenate(([0], np.cumsum(sizes)))
    h = hashes[:, 0]
    grams = h[:len(h) - run + 1].copy()
    for k in range(1, run):
        grams = mix(grams * BASE) + h[k:len(h) - run + 1 + k]
    grams = mix(grams)
    per = window - run + 1
    least = grams[:n].copy()
    for k in range(1, per):
        np.minimum(least, grams[k:n + k], out=least)
    place = np.zeros(n, np.int64)
    for k in range(per - 1, -1, -1):  # the leftmost of equal ones
        np.copyto(place, np.arange(k, n + k), where=grams[k:n + k] == least)
    whole = np.flatnonzero(doc[:n] == doc[window - 1:])
    if not len(whole):
        return none, none, none, none, none
    new = np.ones(len(whole), bool)
    new[1:] = (np.diff(whole) != 1) | (np.diff(place[whole]) != 0)
    first = np.flatnonzero(new)
    start = whole[first]
    words = np.diff(np.append(first, len(whole))) + window - 1
    # Digest by sums of powers: of the same words the same, wherever they stand.
    power = np.full(len(hashes), BASE)
    power[0] = 1
    power = np.multiply.accumulate(power)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes[:, 1] * power)))
    inverse = np.full(len(hashes), np.uint64(pow(int(BASE), -1, 1 << 64)))
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    body = mix((sums[start + words] - sums[start]) * inverse[start] + words.astype(np.uint64))
    return least[start].view(np.int64), body.view(np.int64), doc[start], start - begin[doc[start]], words


def segments(base: DataFrame, window: int, run_words: int) -> DataFrame:
    """``anchor, body, doc_id, row, start, n`` of every segment of ``base(doc_id, row, text)``."""
    import pyarrow as pa

    def run(batches):
        memory = worker_cache("passage_words", dict)
        for b in slices(batches):
            parts = [t.split() if t else [] for t in text_bytes(b.column(2))]
            sizes = np.array(list(map(len, parts)), np.int64)
            with np.errstate(over="ignore"):
                anchor, body, doc, start, n = cut_segments(
                    word_hashes([w for p in parts for w in p], memory), sizes, window, run_words)
            own = pa.array(doc, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(body), b.column(0).take(own), b.column(1).take(own),
                 pa.array(start, pa.int32()), pa.array(n, pa.int32())],
                names=["anchor", "body", "doc_id", "row", "start", "n"])

    return small_batches(base).mapInArrow(run, "anchor long, body long, doc_id long, row long, start int, n int")


def repeated_windows(bodies: list[list[bytes]], doc: np.ndarray, start: np.ndarray, window: int) -> np.ndarray:
    """For each body a number whose bit i tells that its window i also starts earlier."""
    sizes = np.array(list(map(len, bodies)), np.int64)
    number: dict[bytes, int] = {}
    flat = np.array([number.setdefault(w, len(number) + 1) for b in bodies for w in b], np.int64)
    index = FmIndex(flat, sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # word of its body
    docs, words = np.repeat(doc, sizes), np.repeat(start, sizes) + at
    by = np.lexsort((words, docs))
    step = np.ones(len(by), bool)
    step[1:] = (np.diff(docs[by]) != 0) | (np.diff(words[by]) != 0)
    order = np.empty(len(by), np.int64)
    order[by] = np.cumsum(step)  # equal for the same word of the same document
    indexed = np.zeros(index.n, np.int64)
    indexed[index.inner] = order
    indexed[~index.inner] = len(order) + 1
    found = index.matching_statistics(flat, sizes, indexed, order) >= window
    bit = np.where(found, np.int64(1) << np.minimum(at, 62), 0)
    return np.add.reduceat(bit, np.cumsum(sizes) - sizes)


def judged_by_index(bodies: DataFrame, window: int, shards: int) -> DataFrame:
    """``anchor, body, repeats`` of ``bodies(anchor, body, doc_id, start, words)``, a shard at a time."""
    import pyarrow as pa

    def judge(table: pa.Table) -> pa.Table:
        split = [t.split(b" ") for t in text_bytes(table.column("words").combine_chunks())]
        repeats = repeated_windows(split, table.column("doc_id").to_numpy(),
                                   table.column("start").to_numpy().astype(np.int64), window)
        return pa.table({"anchor": table.column("anchor"), "body": table.column("body"),
                         "repeats": pa.array(repeats, pa.int64())})

    dealt = bodies.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(judge, "anchor long, body long, repeats long")


def judged_by_window(bodies: DataFrame, window: int) -> DataFrame:
    """The same for the bodies of hot anchors: equal windows are grouped."""
    word = F.split("words", " ")
    cut = bodies.withColumn("i", F.explode(F.sequence(F.lit(0), F.size(word) - window))).select(
        "anchor", "body", "i", F.array_join(F.slice(word, F.col("i") + 1, window), " ").alias("window"),
        F.struct("doc_id", (F.col("start") + F.col("i")).alias("at")).alias("here"))
    first = cut.groupBy("window").agg(F.min("here").alias("first"))
    again = cut.join(first, "window").filter("here > first")
    return again.groupBy("anchor", "body").agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("repeats"))


def words_of(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """``anchor, body, doc_id, start, hot, words`` of the bodies ``wanted``,
    cut from their first document; a document's bodies come as one list."""
    import pyarrow as pa

    lists = wanted.groupBy("doc_id", "row").agg(
        F.collect_list(F.struct("anchor", "body", "start", "n", "hot")).alias("cuts"))
    rows = base.join(lists, ["doc_id", "row"]).select("doc_id", "text", "cuts")

    def run(batches):
        for b in slices(batches):
            out = []
            for d, t, cuts in zip(b.column(0).to_pylist(), text_bytes(b.column(1)), b.column(2).to_pylist()):
                w = t.split()
                out += [(c["anchor"], c["body"], d, c["start"], c["hot"],
                         b" ".join(w[c["start"]:c["start"] + c["n"]])) for c in cuts]
            cols = list(zip(*out)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(cols, types)]
            yield pa.RecordBatch.from_arrays([*arrays[:5], arrays[5].cast(pa.string())],
                                             names=["anchor", "body", "doc_id", "start", "hot", "words"])

    cut = small_batches(rows).mapInArrow(
        run, "anchor long, body long, doc_id long, start int, hot boolean, words string")
    # Rows that agree in id and text give a body twice.
    return cut.dropDuplicates(["anchor", "body"])


def repeats(base: DataFrame, window: int, run_words: int, shard_words: int, hot: int) -> DataFrame:
    """``doc_id, row, gone``: for each document with repeated windows a list of
    ``(start, bits)``, bit i standing for the window at ``start + i``."""
    found = stored(segments(base, window, run_words), "segments")
    # Written first: a join of two plain shuffles is split where an anchor is hot.
    anchors = stored(found.groupBy("anchor").agg(F.count("*").alias("k")).filter("k > 1").select("anchor"), "anchors")
    hits = stored(found.join(anchors, "anchor", "left_semi"), "repeated-segments")
    bodies = stored(hits.groupBy("anchor", "body").agg(
        F.min(F.struct("doc_id", "start", "row")).alias("first"), F.max("n").alias("n")), "bodies")
    crowds = bodies.groupBy("anchor").agg(F.count("*").alias("k")).filter("k > 1")
    wanted = bodies.join(crowds, "anchor").select("anchor", "body", "first.doc_id", "first.row", "first.start", "n",
                                                  (F.col("k") > hot).alias("hot"))
    cut = stored(words_of(base, wanted), "body-words")
    cold = cut.filter("NOT hot")
    total = cold.agg(F.sum(F.length("words") - F.length(F.translate("words", " ", "")) + 1)).first()[0] or 0
    told = judged_by_index(cold, window, 1 + int(total) // shard_words).unionByName(
        judged_by_window(cut.filter("hot"), window))
    # Written first, as the anchors: a body that very many documents hold is split.
    verdicts = stored(bodies.join(told, ["anchor", "body"], "left").select(
        "anchor", "body", "first", F.coalesce("repeats", F.lit(0)).alias("repeats")), "verdicts")
    is_first = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("start") == F.col("first.start"))
    every = F.expr(f"shiftleft(1L, n - {window - 1}) - 1")
    marks = hits.join(verdicts, ["anchor", "body"]).select(
        "doc_id", "row", "start", F.when(is_first, F.col("repeats")).otherwise(every).alias("bits")).filter("bits != 0")
    once = marks.groupBy("doc_id", "row", "start").agg(F.max("bits").alias("bits"))
    return once.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "bits")).alias("gone"))


def drop_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 20,
                 anchor_words: int = 8, shard_words: int = 1 << 19, hot: int = 2048) -> DataFrame:
    """``df`` with ``kept_text`` (the words that stay, one space between),
    ``n_words``, ``n_removed`` (long) and ``removed``, the stretches of words
    that go as ``array<struct<start:int,stop:int>>``, behind all its columns;
    columns with those names are replaced.

    ``doc_id`` must be a whole number; a null one counts as the smallest.
    Rows that repeat a doc_id are parts of one document that all start at
    word 0: a window goes if one with its words starts earlier in any of
    them, and rows that agree in everything are treated alike.  Null, empty
    and blank texts have no words and keep the empty text.  Words are runs
    of anything but space and tab to carriage return, compared as they are.
    """
    import pyarrow as pa

    own = ["kept_text", "n_words", "n_removed", "removed"]
    run_words = min(max(anchor_words, min_words - 61), min_words)  # at most 62 windows a segment
    rows = df.select(*[c for c in df.columns if c not in own])
    id_column = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    row_column = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    base = rows.select(id_column.alias("doc_id"), row_column.alias("row"), F.col(text).cast("string").alias("text"))
    gone = repeats(base.filter(F.col("text").isNotNull()), min_words, run_words, shard_words, hot).select(
        F.col("doc_id").alias("__doc"), F.col("row").alias("__row"), F.col("gone").alias("__gone"))
    joined = rows.join(gone, (id_column == F.col("__doc")) & (row_column == F.col("__row")), "left").select(
        *[rows[c] for c in rows.columns], "__gone")
    text_at = rows.columns.index(text)
    schema = schema_with(rows, kept_text="string", n_words="long", n_removed="long",
                         removed="array<struct<start:int,stop:int>>")

    def clean(t: bytes | None, marks: list | None):
        words = t.split() if t else []
        if not marks:
            return b" ".join(words), len(words), 0, []
        edge = np.zeros(len(words) + 1, np.int64)
        for m in marks:
            bits, at = m["bits"], m["start"]
            while bits:
                i = (bits & -bits).bit_length() - 1
                edge[at + i] += 1
                edge[at + i + min_words] -= 1
                bits &= bits - 1
        away = np.cumsum(edge[:-1]) > 0
        turn = np.flatnonzero(np.diff(np.concatenate(([False], away, [False])).astype(np.int8)))
        kept = [w for w, x in zip(words, away.tolist()) if not x]
        spans = [{"start": a, "stop": b} for a, b in zip(turn[::2].tolist(), turn[1::2].tolist())]
        return b" ".join(kept), len(words), int(away.sum()), spans

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for b in slices(batches):
            texts = text_bytes(b.column(text_at).cast(pa.string()))
            out = [clean(t, g) for t, g in zip(texts, b.column(b.num_columns - 1).to_pylist())]
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(cols[0], pa.binary()).cast(pa.string()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], kind)], names=[*b.schema.names[:-1], *own])

    return small_batches(joined).mapInArrow(run, schema)
