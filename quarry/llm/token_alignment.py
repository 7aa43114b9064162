"""Alignment of two tokenizers by products of sparse incidence matrices.

Both tokenizers cut the same bytes.  With A the incidence of A's tokens and
bytes (a row for each token, a column for each byte) and B that of B's
tokens, the product ``A Bᵀ`` holds for each pair of tokens how many bytes
they share: the *overlap links*.  Where a token of A and one of B end at the
same byte the text falls into *groups*; with GA and GB the incidences of
tokens and groups, ``GA GBᵀ`` holds the pairs that share a group: the
*shared-group links*.  All matrices are in compressed rows (:class:`Csr`),
made by hand; products go row by row after Gustavson: a row of the product
is the sum of those rows of the right matrix that its own row names.

Text is aligned in units, a run of blanks and the word behind it.  No token
of either kind spans the start of a unit, so a unit is tokenized and
aligned once and then remembered by its worker.

Over a corpus:

1. Each task takes its documents in blocks of about ``block_chars``
   characters.  A block has the matrices D (documents x units, how often)
   and U (units x id pairs, how many links).  The pattern of ``D U`` tells
   which document holds which id pair; its column counts are the block's
   document frequencies.  A block, its D, U and frequencies are one row of a
   table in the shared folder.
2. Frequencies are added up by id pair: a row for each block and pair, not
   for each document.  A pair's count is thus known, and whether it is the
   highest of its A id.
3. Counts go back to the blocks that hold the pair, and ``D (U counts)``,
   two matrix-vector products, gives every document its sums.

A task holds one block; no step gathers a pair's documents.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import no_cycle_search, release_memory, schema_with, slices, small_batches, stored, worker_cache
from .prefix_tokens import byte_alphabet

BLANK = "▁"  # U+2581, a space in pieces
# Units a worker remembers; beyond, it keeps the half that it met most often (no result depends on it).
CACHE_UNITS = 250_000
# Units tokenized and aligned at once.
STEP_UNITS = 1 << 13
# Elements of a product computed at once.
STEP = 1 << 22
# Blanks, then a word.  White space that is not one of the three blanks counts
# as part of a word; blanks behind such a character do not start a unit.
UNIT_RE = re.compile(r"[ \n\t]*[^ \n\t]+(?:(?<=\s)[ \n\t]+[^ \n\t]*)*|[ \n\t]+")


class Csr:
    """A sparse matrix in compressed rows: row ``i`` has the columns
    ``cols[ptr[i]:ptr[i + 1]]`` and their ``data``."""

    def __init__(self, ptr: np.ndarray, cols: np.ndarray, data: np.ndarray, width: int):
        self.ptr, self.cols, self.data, self.width = ptr, cols, data, width

    @classmethod
    def from_ranges(cls, start: np.ndarray, stop: np.ndarray, width: int) -> Csr:
        """Row ``i`` has ones in the columns ``start[i]`` to ``stop[i] - 1``."""
        ptr = np.concatenate(([0], np.cumsum(stop - start)))
        cols = np.arange(ptr[-1]) + np.repeat(start - ptr[:-1], stop - start)
        return cls(ptr, cols, np.ones(len(cols), np.int64), width)

    @classmethod
    def from_entries(cls, rows: np.ndarray, cols: np.ndarray, data: np.ndarray, height: int, width: int) -> Csr:
        """Entries in any order; those of one place are added up."""
        key = rows.astype(np.int64) * max(width, 1) + cols
        order = np.argsort(key, kind="stable")
        key, data = key[order], data[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key = key[first]
        data = np.add.reduceat(data, first) if len(first) else data
        ptr = np.searchsorted(key, np.arange(height + 1, dtype=np.int64) * max(width, 1))
        return cls(ptr, key % max(width, 1), data, width)

    @property
    def height(self) -> int:
        return len(self.ptr) - 1

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(self.height), np.diff(self.ptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.cols, kind="stable")
        ptr = np.concatenate(([0], np.cumsum(np.bincount(self.cols, minlength=self.width))))
        return Csr(ptr, self.rows()[order], self.data[order], self.height)

    def times(self, right: Csr) -> Csr:
        """Gustavson's product: for each entry (i, k) the row k of ``right``,
        scaled, is added to row i.  Some rows at a time bound the memory."""
        size = np.diff(right.ptr)[self.cols]
        work = np.concatenate(([0], np.cumsum(size)))[self.ptr]  # multiplications before each row
        parts, at = [], 0
        while at < self.height:
            end = max(at + 1, int(np.searchsorted(work, work[at] + STEP, side="right")) - 1)
            a, b = self.ptr[at], self.ptr[end]
            n = size[a:b]
            take = np.arange(n.sum()) + np.repeat(right.ptr[self.cols[a:b]] - (np.cumsum(n) - n), n)
            rows = np.repeat(np.repeat(np.arange(end - at), np.diff(self.ptr[at:end + 1])), n)
            parts.append(Csr.from_entries(rows, right.cols[take], np.repeat(self.data[a:b], n) * right.data[take],
                                          end - at, right.width))
            at = end
        if not parts:
            return Csr(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), right.width)
        shift = np.concatenate(([0], np.cumsum([p.ptr[-1] for p in parts])))
        ptr = np.concatenate([[0], *[p.ptr[1:] + s for p, s in zip(parts, shift)]])
        return Csr(ptr, np.concatenate([p.cols for p in parts]), np.concatenate([p.data for p in parts]), right.width)

    def dump(self) -> bytes:
        """The matrix in as few bytes as its numbers need; entries are not negative."""
        out = [np.array([self.height, len(self.cols), self.width], np.int64).tobytes()]
        for part in (np.diff(self.ptr), self.cols, self.data):
            kind = np.min_scalar_type(int(part.max(initial=0)))
            out += [kind.char.encode(), part.astype(kind).tobytes()]
        return b"".join(out)

    @classmethod
    def load(cls, raw: bytes) -> Csr:
        height, n, width = np.frombuffer(raw, np.int64, 3).tolist()
        parts, at = [], 24
        for size in (height, n, n):
            kind = np.dtype(chr(raw[at]))
            parts.append(np.frombuffer(raw, kind, size, at + 1).astype(np.int64))
            at += 1 + size * kind.itemsize
        return cls(np.concatenate(([0], np.cumsum(parts[0]))), parts[1], parts[2], width)

    def times_vector(self, v: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(self.data * v[self.cols])))
        return total[self.ptr[1:]] - total[self.ptr[:-1]]


def links(a_len: np.ndarray, b_len: np.ndarray) -> tuple[Csr, Csr, np.ndarray, np.ndarray]:
    """Two cuts of the same bytes, as token lengths: the overlap links (data:
    shared bytes), the shared-group links, and each token's group (A's, B's)."""
    a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
    width = int(a_end[-1]) if len(a_end) else 0
    a = Csr.from_ranges(a_end - a_len, a_end, width)
    b = Csr.from_ranges(b_end - b_len, b_end, width)
    overlap = a.times(b.transposed())
    near = np.searchsorted(b_end, a_end)
    cuts = a_end[b_end[near] == a_end] if width else a_end  # both end at the last byte
    a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
    ga = Csr.from_ranges(a_group, a_group + 1, len(cuts))
    gb = Csr.from_ranges(b_group, b_group + 1, len(cuts))
    return overlap, ga.times(gb.transposed()), a_group, b_group


class Tokenizers:
    """Tokenizer A (a ``tokenizers`` file, byte-level) and B (a
    ``sentencepiece`` model), and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        import sentencepiece
        import tokenizers
        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        raw = byte_alphabet()
        names = sorted(self.a.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        self.a_bytes = [bytes(raw[c] for c in t) if all(c in raw for c in t) else t.encode() for t, _ in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array(list(map(len, t)), np.int64) for t in (self.a_bytes, self.b_bytes))
        # Units may be cut where no piece could span the cut.
        self.cuts = not any("\n" in p or "\t" in p or BLANK in p.lstrip(BLANK) for p in pieces)
        self.blank = self.b.piece_to_id(BLANK)

    def units(self, text: str) -> list[str]:
        """``" " + text`` in units; their tokens in a row are the text's."""
        return UNIT_RE.findall(" " + text) if self.cuts else [" " + text]

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both tokenizers for each unit.  B puts a blank in front by
        itself: one is taken off a unit that starts with one, and B's is taken
        off again where the unit starts with another character."""
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        b = self.b.encode([u[1:] if u[:1] == " " else u for u in units], num_threads=1)
        for i, u in enumerate(units):
            if u == " ":  # B has nothing to put its blank in front of
                b[i] = [self.blank]
            elif u[:1] != " ":
                b[i] = b[i][1:] if b[i][:1] == [self.blank] else []  # [] fails the byte check
        return a, b


class Units:
    """The aligned units met so far, in flat arrays; ``index`` has their numbers.

    ``pair_ptr, pairs, times``: the matrix units x id pairs, in compressed
    rows; a pair is ``a << 32 | b``, its data the unit's links of that pair."""

    def __init__(self, both: Tokenizers):
        self.both = both
        ids = range(max(len(both.a_bytes), len(both.b_bytes)))
        self.texts = np.array([f"{mark}{i}" for mark in ";,|" for i in ids], dtype=object)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []  # of each unit, a semicolon in front of every group
        self.good, self.used = np.zeros(0, bool), np.zeros(0, np.int64)
        self.sizes = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, links
        self.pair_ptr = np.zeros(1, np.int64)
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, units: list[str]) -> None:
        """Tokenize and align new units, some at a time."""
        made = [self.aligned(units[at:at + STEP_UNITS]) for at in range(0, len(units), STEP_UNITS)]
        if not made:
            return
        at = len(self.groups)
        self.index.update(zip(units, range(at, at + len(units))))
        for m in made:
            self.groups += m[0]
        self.used = np.concatenate((self.used, np.zeros(len(units), np.int64)))
        good, sizes, width, pairs, times = (np.concatenate([m[i] for m in made]) for i in range(1, 6))
        self.good, self.sizes = np.concatenate((self.good, good)), np.concatenate((self.sizes, sizes))
        self.pair_ptr = np.concatenate((self.pair_ptr, self.pair_ptr[-1] + np.cumsum(width)))
        self.pairs, self.times = np.concatenate((self.pairs, pairs)), np.concatenate((self.times, times))

    def keep(self, which: np.ndarray) -> None:
        """Forget all units but some."""
        names, width = list(self.index), np.diff(self.pair_ptr)[which]
        self.index = {names[u]: i for i, u in enumerate(which.tolist())}
        self.groups = [self.groups[u] for u in which.tolist()]
        self.good, self.sizes, self.used = self.good[which], self.sizes[which], self.used[which]
        ptr = np.concatenate(([0], np.cumsum(width)))
        take = np.arange(ptr[-1]) + np.repeat(self.pair_ptr[which] - ptr[:-1], width)
        self.pair_ptr, self.pairs, self.times = ptr, self.pairs[take], self.times[take]

    def aligned(self, units: list[str]):
        """Of each unit its groups as text, whether its tokens' bytes are its
        own, its sizes and the number of its id pairs; then the pairs and their links."""
        both, n = self.both, len(units)
        a_ids, b_ids = both.encode(units)
        raw = [u.encode("utf-8", "replace") for u in units]
        good = same_bytes(both.a_bytes, a_ids, raw) & same_bytes(both.b_bytes, b_ids, raw)
        for i in np.flatnonzero(~good).tolist():
            a_ids[i], b_ids[i] = [], []
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, n) for ids in (a_ids, b_ids))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a_ids, b_ids))
        _, shared, a_group, b_group = links(both.a_size[a], both.b_size[b])
        a_unit = np.repeat(np.arange(n), n_a)
        entry = shared.rows()
        known, col = unique(a[entry] << 32 | b[shared.cols])
        by_unit = Csr.from_entries(a_unit[entry], col, np.ones(len(col), np.int64), n, len(known))
        group_unit = np.zeros(int(a_group[-1]) + 1 if len(a_group) else 0, np.int64)
        group_unit[a_group] = a_unit
        sizes = np.stack((n_a, n_b, np.bincount(group_unit, minlength=n), np.bincount(a_unit[entry], minlength=n)),
                         axis=1)
        return (self.group_texts(n_a + n_b, a, a_group, b, b_group), good, sizes, np.diff(by_unit.ptr),
                known[by_unit.cols], by_unit.data)

    def group_texts(self, size, a, a_group, b, b_group) -> list[str]:
        """``;a1,a2|b1;a3|b2,b3`` of each unit of ``size`` tokens, A's and B's."""
        step = len(self.texts) // 3
        a_text = a + step * (np.diff(a_group, prepend=-1) == 0)
        b_text = b + step * (1 + (np.diff(b_group, prepend=-1) != 0))
        order = np.argsort(np.concatenate((2 * a_group, 2 * b_group + 1)), kind="stable")
        parts = self.texts[np.concatenate((a_text, b_text))[order]].tolist()
        stop = np.cumsum(size).tolist()
        return ["".join(parts[x:y]) for x, y in zip([0, *stop], stop)]


def same_bytes(table: list[bytes], ids: list[list[int]], raw: list[bytes]) -> np.ndarray:
    """For each unit, whether its tokens' bytes in a row are its own."""
    made = [b"".join([table[t] for t in x]) for x in ids]
    return np.fromiter(map(bytes.__eq__, made, raw), bool, len(raw))


def unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, sorted, and where each value stands among them."""
    order = np.argsort(values, kind="stable")
    new = np.diff(values[order], prepend=values[order[:1]] - 1) != 0
    at = np.empty(len(values), np.int64)
    at[order] = np.cumsum(new) - 1
    return values[order][new], at


class Block:
    """Some documents and their units."""

    def __init__(self, units: Units):
        self.units, self.ids, self.parts, self.chars = units, [], [], 0

    def add(self, doc_id, text: str | None) -> None:
        text = text or ""
        self.ids.append(doc_id)
        self.parts.append(self.units.both.units(text) if text else [])
        self.chars += len(text)

    def row(self, number: int) -> dict:
        """The block as a row of the blocks table."""
        import hashlib
        memory, n = self.units, len(self.parts)
        memory.add(list(set(chain.from_iterable(self.parts)).difference(memory.index)))
        size = np.fromiter(map(len, self.parts), np.int64, n)
        flat = np.fromiter(map(memory.index.__getitem__, chain.from_iterable(self.parts)), np.int64, size.sum())
        doc = np.repeat(np.arange(n), size)
        bad = np.zeros(n, bool)
        bad[doc[~memory.good[flat]]] = True
        if bad.any():
            flat, doc, size = flat[~bad[doc]], doc[~bad[doc]], np.where(bad, 0, size)
        cut = np.concatenate(([0], np.cumsum(size)))
        texts, groups = flat.tolist(), memory.groups
        sha = ["" if x == y else hashlib.sha256("".join([groups[u] for u in texts[x:y]])[1:].encode()).hexdigest()
               for x, y in zip(cut.tolist(), cut[1:].tolist())]
        seen = np.zeros(len(groups), bool)
        seen[flat] = True
        used = np.flatnonzero(seen)
        d = Csr.from_entries(doc, (np.cumsum(seen) - 1)[flat], np.ones(len(flat), np.int64), n, len(used))
        total = [d.times_vector(v) for v in memory.sizes[used].T]
        width = np.diff(memory.pair_ptr)[used]
        u_ptr = np.concatenate(([0], np.cumsum(width)))
        take = np.arange(u_ptr[-1]) + np.repeat(memory.pair_ptr[used] - u_ptr[:-1], width)
        pairs, u_col = unique(memory.pairs[take])
        u = Csr(u_ptr, u_col, memory.times[take], len(pairs))
        frequency = np.bincount(d.times(u).cols, minlength=len(pairs))
        memory.used += np.bincount(flat, minlength=len(groups))
        if len(groups) > CACHE_UNITS:
            memory.keep(np.sort(np.argsort(memory.used)[-CACHE_UNITS // 2:]))
        return {"block": number, "ids": self.ids, "n_a": total[0], "n_b": total[1], "n_groups": total[2],
                "n_links": total[3], "sha": sha, "d": d.dump(), "u": u.dump(), "pairs": pairs, "docs": frequency}


def blocks(df: DataFrame, a_path: str, b_path: str, block_chars: int) -> DataFrame:
    """The blocks table of ``df(doc_id, text)``: see :class:`Block`."""
    import pyarrow as pa

    id_type = df.schema["doc_id"].dataType.simpleString()
    lists = {"n_a": "int", "n_b": "int", "n_groups": "int", "n_links": "bigint", "sha": "string", "pairs": "bigint",
             "docs": "int"}
    # The matrices are plain bytes: Spark reads arrays of numbers at several times their size.
    schema = f"block long, ids array<{id_type}>, d binary, u binary, " + ", ".join(
        f"{k} array<{v}>" for k, v in lists.items())
    arrow = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}

    def run(batches):
        from pyspark import TaskContext
        memory = worker_cache(f"align:{a_path}:{b_path}", lambda: Units(Tokenizers(a_path, b_path)))
        first, made, block, kind = TaskContext.get().partitionId() << 32, 0, Block(memory), None

        def batch_of(block, number):
            row = block.row(number)
            cols = [pa.array([row["block"]], pa.int64()), pa.array([row["ids"]], pa.list_(kind)),
                    pa.array([row["d"]], pa.binary()), pa.array([row["u"]], pa.binary())]
            cols += [pa.array([row[k]], pa.list_(arrow[v])) for k, v in lists.items()]
            return pa.RecordBatch.from_arrays(cols, names=["block", "ids", "d", "u", *lists])

        with no_cycle_search():
            for b in slices(batches, 64):
                kind = b.column(0).type
                for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    block.add(d, t)
                    if block.chars >= block_chars or len(block.ids) >= block_chars >> 6:
                        yield batch_of(block, first + made)
                        block, made = Block(memory), made + 1
                        release_memory()
            if block.ids:
                yield batch_of(block, first + made)

    return small_batches(df).mapInArrow(run, schema)


def pair_counts(table: DataFrame) -> DataFrame:
    """``pair, n, best``: in how many documents each id pair is linked, and
    whether that is the highest number of its A id."""
    counts = stored(table.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
                    .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum(F.col("p.docs").cast("long")).alias("n")),
                    "pair-counts")
    a_id = F.shiftright("pair", 32)
    top = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("top"))
    return counts.withColumn("a", a_id).join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def alignment_digest(df: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text",
                     block_chars: int = 1 << 19) -> DataFrame:
    """One row for each row of ``df``: ``doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum`` (long) and ``groups_sha256``.

    ``n_best`` counts the links whose id pair is linked in as many documents
    as the best pair of its A id (ties included), ``count_sum`` adds up the
    document counts over the links.  A row is a document of its own, also
    where rows repeat a doc_id or agree in everything.  Texts that are null,
    empty, or whose tokens' bytes are not the text's have zeros and an empty
    string, and count for no pair.  Other columns of ``df`` are not read; an
    empty table gives no row.
    """
    import pyarrow as pa

    base = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    table = stored(blocks(base, a_path, b_path, block_chars), "token-blocks")
    held = table.select(F.col("block").alias("holder"), F.posexplode("pairs").alias("at", "pair"))
    told = held.join(pair_counts(table), "pair").select("holder", "at", "n", "best")
    id_type = base.schema["doc_id"].dataType.simpleString()
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = f"doc_id {id_type}, " + ", ".join(f"{c} long" for c in numbers) + ", groups_sha256 string"

    def join(rows: pa.Table, counts: pa.Table) -> pa.Table:
        def values(name):
            return rows.column(name).combine_chunks().flatten()

        n_pairs = len(values("pairs"))
        n, best = np.zeros(n_pairs, np.int64), np.zeros(n_pairs, np.int64)
        at = counts.column("at").to_numpy()
        n[at] = counts.column("n").to_numpy()
        best[at] = counts.column("best").combine_chunks().to_numpy(zero_copy_only=False)
        d, u = (Csr.load(rows.column(c)[0].as_py()) for c in ("d", "u"))
        sums = [d.times_vector(u.times_vector(v)) for v in (best, n)]
        cols = [values("ids"), *[values(c).cast(pa.int64()) for c in numbers[:4]],
                *[pa.array(s, pa.int64()) for s in sums], values("sha")]
        return pa.Table.from_arrays(cols, names=["doc_id", *numbers, "groups_sha256"])

    return table.groupBy("block").cogroup(told.groupBy("holder")).applyInArrow(join, schema)


def token_links(df: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """``df`` with ``links``: all pairs of tokens of A and B in a group, each
    ``a, b`` (ids), ``a_at, b_at`` (token numbers), ``bytes`` (how many they
    share; 0 for tokens that only share the group) and ``group``.  An empty
    list where the two cannot be aligned.  A column ``links`` is replaced."""
    import pyarrow as pa

    base = df.select(*[c for c in df.columns if c != "links"])
    at = base.columns.index(text)
    kind = "array<struct<a:int,b:int,a_at:int,b_at:int,bytes:int,group:int>>"
    schema = schema_with(base, links=kind)
    arrow = pa.list_(pa.struct([(n, pa.int32()) for n in ("a", "b", "a_at", "b_at", "bytes", "group")]))

    def linked(both: Tokenizers, t: str | None) -> list[dict]:
        a, b = both.encode([" " + t]) if t else ([[]], [[]])
        a, b = a[0], b[0]
        raw = (" " + (t or "")).encode("utf-8", "replace")
        if b"".join([both.a_bytes[x] for x in a]) != raw or b"".join([both.b_bytes[x] for x in b]) != raw:
            return []
        overlap, shared, group, _ = links(np.array([len(both.a_bytes[x]) for x in a]),
                                          np.array([len(both.b_bytes[x]) for x in b]))
        common = dict(zip(zip(overlap.rows().tolist(), overlap.cols.tolist()), overlap.data.tolist()))
        return [{"a": a[i], "b": b[j], "a_at": i, "b_at": j, "bytes": common.get((i, j), 0), "group": int(group[i])}
                for i, j in zip(shared.rows().tolist(), shared.cols.tolist())]

    def run(batches):
        both = worker_cache(f"tokenizers:{a_path}:{b_path}", lambda: Tokenizers(a_path, b_path))
        for b in slices(batches, 64):
            out = [linked(both, t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, arrow)], names=[*b.schema.names, "links"])

    return small_batches(base).mapInArrow(run, schema)
