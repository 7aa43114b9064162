"""Near-duplicates by min-max hashing.

Every document is the set of its distinct word shingles.  ``permutations``
hash functions are evaluated on each shingle; under each one *both* the
least and the greatest value are kept, so ``permutations`` evaluations give
a signature of twice that length.  Least and greatest are both unbiased
(either agrees with probability equal to the Jaccard similarity) and they
are negatively correlated, so the signature's variance is below that of as
many independent minima.  Bands of ``rows`` signature values (a band holds
minima only or maxima only, of different permutations) make the candidates.

From sets to classes:

1. Equal sets (equal 128-bit digests of the sorted shingle hashes) become
   one representative, so exact copies, however many, are one row.
2. Sets that share a band value are candidates.  A bucket is never
   expanded into pairs of rows.  Each round, one member is drawn in every
   bucket as pivot, the members outside its class are checked against it,
   and the classes found are merged; members already in the pivot's class
   need no check.
3. After ``rounds`` rounds, all pairs of a bucket that are still in different
   classes are checked, so no candidate link is lost: the bucket's members
   are dealt into chunks of ``chunk`` by a hash, each pair of chunks is one
   group, and a task checks the pairs of its group in memory.  A pair that
   shares several buckets is checked in one of them, drawn by its ids; a pair
   linked through others of its group needs no check.  Only links come out.
4. A link is confirmed on the full sets: ``100 * both >= percent * either``.

With 42 bands of 6, a pair at 0.85 is missed with probability 2e-9, one at 0.8
with 3e-6.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, small_batches, stored, text_bytes, worker_cache
from .components import connected_components

CACHE_WORDS = 50_000


def shingle_set(words: list[bytes], size: int, memory: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles; a shorter
    sequence is one shingle, no word at all is the empty set."""
    import xxhash
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)], np.uint64)
    new = set(words).difference(memory)
    if len(memory) + len(new) > CACHE_WORDS:
        memory.clear()
        new = set(words)
    for w in new:
        memory[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    s = h[:n].copy()
    for k in range(1, size):
        s = mix(s * np.uint64(0x9E3779B97F4A7C15)) + h[k:n + k]
    return np.unique(mix(s))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def multipliers(permutations: int, seed: int = 41) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 2 ** 63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 2 ** 63, permutations, dtype=np.uint64))


def minmax_signature(shingles: np.ndarray, permutations: int) -> np.ndarray:
    """Minima, then maxima, of the shingles under every permutation."""
    a, b = multipliers(permutations)
    low = np.full(permutations, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(permutations, np.uint64)
    for at in range(0, len(shingles), 1024):
        h = shingles[at:at + 1024][None, :] * a[:, None] + b[:, None]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        low, high = np.minimum(low, h.min(axis=1)), np.maximum(high, h.max(axis=1))
    return np.concatenate((low, high))


def band_values(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit value for each band, its position mixed in."""
    parts = signature.reshape(-1, rows)
    v = np.arange(1, len(parts) + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for k in range(rows):
        v = mix(v ^ parts[:, k]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1)
    return v.view(np.int64)


def sketch(df: DataFrame, shingle: int, permutations: int, rows: int) -> DataFrame:
    """``doc_id, n_shingles``, the set's digest (two longs) and its band
    values, of every row of ``df(doc_id, text)``; whole texts, no shuffle."""
    import pyarrow as pa

    def run(batches):
        import xxhash
        memory = worker_cache("shingle_words", dict)
        for b in slices(batches):
            n, d1, d2, bands = [], [], [], []
            for t in text_bytes(b.column(1)):
                s = shingle_set(t.lower().split() if t else [], shingle, memory)
                raw = s.tobytes()
                n.append(len(s))
                d1.append(xxhash.xxh3_64_intdigest(raw, 1) - (1 << 63) if len(s) else None)
                d2.append(xxhash.xxh3_64_intdigest(raw, 2) - (1 << 63) if len(s) else None)
                bands.append(band_values(minmax_signature(s, permutations), rows) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "d1", "d2", "bands"])

    return small_batches(df).mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>")


def texts_of(base: DataFrame, ids: DataFrame, shingle: int, permutations: int, rows: int) -> DataFrame:
    """``id, text, bands`` of the documents ``ids(id)``, repeated rows once."""
    import pyarrow as pa

    def run(batches):
        memory = worker_cache("shingle_words", dict)
        for b in slices(batches):
            bands = [band_values(minmax_signature(shingle_set(t.lower().split(), shingle, memory), permutations), rows)
                     for t in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bands, pa.list_(pa.int64()))],
                                             names=["id", "text", "bands"])

    once = (base.withColumnRenamed("doc_id", "id").filter("text IS NOT NULL").join(ids, "id", "left_semi")
            .groupBy("id", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text")).select("id", "text"))
    return once.mapInArrow(run, "id long, text string, bands array<long>")


def meets(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets are alike enough."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(x) + len(y) - len(np.union1d(x, y))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` of document ids whose full sets meet the similarity."""
    import pyarrow as pa

    def run(batches):
        memory = worker_cache("shingle_words", dict)
        known: dict[bytes, np.ndarray] = {}  # sets of the texts met last

        def set_of(text):
            found = known.get(text)
            if found is None:
                if len(known) >= 64:
                    known.clear()
                found = known[text] = shingle_set(text.lower().split(), shingle, memory)
            return found

        for b in slices(batches):
            keep = []
            for x, y in zip(text_bytes(b.column(2)), text_bytes(b.column(3))):
                keep.append(meets(set_of(x), set_of(y), percent))
            yield b.filter(pa.array(keep, pa.bool_())).select(["u", "v"])

    with_u = pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("x")), "u")
    both = with_u.join(texts.select(F.col("id").alias("v"), F.col("text").alias("y")), "v")
    return both.select("u", "v", "x", "y").mapInArrow(run, "u long, v long")


def owned_pairs(band: int, left: np.ndarray, right: np.ndarray, salt: np.ndarray):
    """Pairs of rows of two band matrices that share ``band``'s column value
    and for which, of all bands they share, this one is drawn.  ``salt`` is a
    number for each pair."""
    same = left[:, None, :] == right[None, :, :]
    n = same.sum(axis=2, dtype=np.int64)
    rank = same[:, :, :band].sum(axis=2, dtype=np.int64)  # shared bands before this one
    return np.nonzero(same[:, :, band] & (rank == salt % np.maximum(n, 1)))


def links_in_group(ids, classes, sets, bands, chunk, pair: tuple[int, int], band_value: int, percent: int):
    """Links among the members of two chunks of one bucket (or within one):
    the ids of pairs that meet the similarity, as few as connect all that do."""
    parent: dict[int, int] = {int(c): int(c) for c in classes}

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    at = np.nonzero(bands == band_value)
    if not len(at[1]):
        return []
    band, out = int(at[1][0]), []
    left, right = np.flatnonzero(chunk == pair[0]), np.flatnonzero(chunk == pair[1])
    step = max(1, (4 << 20) // max(1, len(right) * bands.shape[1]))
    for a in range(0, len(left), step):
        rows = left[a:a + step]
        low = np.minimum(ids[rows][:, None], ids[right][None, :]).astype(np.uint64)
        high = np.maximum(ids[rows][:, None], ids[right][None, :]).astype(np.uint64)
        salt = (mix(low * np.uint64(0x9E3779B97F4A7C15) + high) >> np.uint64(33)).astype(np.int64)
        for i, j in zip(*owned_pairs(band, bands[rows], bands[right], salt)):
            x, y = rows[i], right[j]
            if ids[x] == ids[y] or (pair[0] == pair[1] and x > y):
                continue
            u, v = root(int(classes[x])), root(int(classes[y]))
            if u != v and meets(sets[x], sets[y], percent):
                parent[max(u, v)] = min(u, v)
                out.append((int(min(ids[x], ids[y])), int(max(ids[x], ids[y]))))
    return out


def remaining_links(members: DataFrame, texts: DataFrame, shingle: int, percent: int, chunk: int) -> DataFrame:
    """All links ``(u, v)`` between members ``(bucket, id, n, c)`` of a bucket
    that are in different classes ``c``, up to what connects them."""
    import pyarrow as pa

    lots = members.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("k"),
                                         F.sum("n").alias("s")).filter("lo != hi")
    chunks = F.ceil(F.greatest(F.col("k") / chunk, F.col("s") / (chunk * 2048))).cast("int")
    dealt = members.join(lots.select("bucket", chunks.alias("chunks")), "bucket").withColumn(
        "chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "bucket", "id", "c", "chunk", F.least("chunk", "o").alias("i"), F.greatest("chunk", "o").alias("j"))
    rows = dealt.join(texts, "id")

    def check(table):
        memory = worker_cache("shingle_words", dict)
        sets = [shingle_set(t.lower().split(), shingle, memory)
                for t in text_bytes(table.column("text").combine_chunks())]
        first = {k: table.column(k)[0].as_py() for k in ("bucket", "i", "j")}
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(sets), -1)
        found = links_in_group(table.column("id").to_numpy(), table.column("c").to_numpy(), sets, bands,
                               table.column("chunk").to_numpy(), (first["i"], first["j"]), first["bucket"], percent)
        return pa.table({"u": pa.array([f[0] for f in found], pa.int64()),
                         "v": pa.array([f[1] for f in found], pa.int64())})

    return rows.groupBy("bucket", "i", "j").applyInArrow(check, "u long, v long")


def near_duplicate_classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5,
                           percent: int = 80, permutations: int = 126, rows: int = 6,
                           rounds: int = 2, chunk: int = 1024) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``df``.

    ``component_id`` is the least doc_id that confirmed links reach, the own
    one included; ``kept`` says that it is the own one.  Null or blank text
    has the empty set, links with nothing, and is kept.  Rows that repeat a
    doc_id are one document, linked by any of its texts.  Rows without a
    doc_id link with nothing, have a null ``component_id`` and are kept.
    """
    if permutations % rows:
        raise ValueError("rows must divide permutations")
    base = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketches = stored(sketch(base, shingle, permutations, rows), "sketch")
    filled = sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # Equal sets have equal bands: one row, under the least of their ids.
    sets = filled.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("id"))
    banded = (filled.join(sets, ["d1", "d2", "n_shingles"]).filter("doc_id = id")
              .select("id", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket")))
    shared = banded.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo != hi")
    members = stored(banded.join(shared.select("bucket"), "bucket").select("bucket", "id", "n").distinct(), "buckets")
    texts = stored(texts_of(base, members.select("id").distinct(), shingle, permutations, rows), "texts")
    # Documents that share a set are linked by it, whatever their other texts.
    links = filled.join(sets, ["d1", "d2", "n_shingles"]).filter("doc_id != id").select(
        F.col("id").alias("u"), F.col("doc_id").alias("v")).distinct()
    classes = None
    for turn in range(rounds + 1):
        at = members.withColumn("c", F.col("id")) if classes is None else (
            members.join(classes, members.id == classes.node, "left")
            .select("bucket", "id", "n", F.coalesce("component", "id").alias("c")))
        if turn < rounds:
            lots = at.groupBy("bucket").agg(
                F.min("c").alias("lo"), F.max("c").alias("hi"),
                F.min_by(F.struct("id", "n", "c"), F.xxhash64(F.lit(turn), "id")).alias("other")).filter("lo != hi")
            pairs = (at.join(lots.select("bucket", "other"), "bucket").filter("c != other.c AND id != other.id")
                     .filter(F.least("n", "other.n") * 100 >= F.greatest("n", "other.n") * percent)
                     .select(F.least("id", "other.id").alias("u"), F.greatest("id", "other.id").alias("v")).distinct())
            found = confirmed(pairs, texts.select("id", "text"), shingle, percent)
        else:
            found = remaining_links(at, texts, shingle, percent, chunk)
        classes = connected_components(links.unionByName(found))
        links = classes.select(F.col("component").alias("u"), F.col("node").alias("v"))
    return sketches.join(classes, sketches.doc_id == classes.node, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))
