"""Exact token counts at every prefix of a text, for byte-level BPE.

A text is cut into pretokens by the tokenizer's pattern; a dynamic program
over a pretoken's bytes stores, at every prefix, the last token of that
prefix's own encoding and the number of tokens:

    the last token of prefix ``i`` is the one token ``t`` that ends there and
    may follow the last token of prefix ``i - len(t)``; its count is that
    prefix's count plus one.

Two tokens may follow each other when no merge happens across the seam.
Replaying the merges of both sides in order of rank shows it: a seam merge
happens when its rank comes before the next merge of either side.

The counts of whole texts follow by adding up pretokens, apart from two
places where a prefix is cut otherwise than the text: in a run of white
space (its last character joins the next word) and in ``'re 've 'll``.
Both are corrected, so entry ``i`` is what the library gives for ``text[:i]``.
Truncation to a budget and window splits then need no tokenizer: see
:func:`count_at`, :func:`cut_at`.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import schema_with, slices, small_batches, worker_cache
from .head_table import U64, HeadTable, mix

NEVER = 1 << 60
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")
# Words remembered by a worker; beyond, the memory starts afresh (no result depends on it).
CACHE_WORDS = 200_000
# Pretokens of more bytes are counted one by one.
LONG_BYTES = 256
GROUP_CHARS = 1 << 20


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes:
    printable Latin-1 bytes stand for themselves, the others follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class PairTable:
    """Whether pairs of tokens may follow each other, as far as known."""

    def __init__(self, bits: int = 22):
        self.bits = bits
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int8)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.view(U64)) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """1 yes, 0 no, -1 unknown.  A slot holds one pair; a newer one replaces an older one."""
        slot = self.slots(keys)
        return np.where(self.keys[slot] == keys, self.values[slot], -1)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        slot = self.slots(keys)
        self.keys[slot], self.values[slot] = keys, values


class PrefixCounter:
    """Prefix token counts for one byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        raw = byte_alphabet()
        to_bytes = lambda s: bytes(raw[c] for c in s)
        self.special = [a["content"] for a in spec["added_tokens"]]
        self.split_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                                           or r"(?!)")
        self.pattern = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.space = regex.compile(r"\s+")
        self.tokens = {to_bytes(t): i for t, i in spec["model"]["vocab"].items()}
        self.rank: dict[tuple[int, int], int] = {}   # pair of tokens -> merge rank
        self.made: dict[int, tuple[int, int, int]] = {}  # token -> its rank, left part, right part
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = (m.split(" ") if isinstance(m, str) else m)
            left, right = self.tokens[to_bytes(a)], self.tokens[to_bytes(b)]
            self.rank[left, right] = r
            whole = self.tokens[to_bytes(a) + to_bytes(b)]
            if whole not in self.made:
                self.made[whole] = (r, left, right)
        self.tails = {t[k:] for t in self.tokens for k in range(len(t))}
        self.table = HeadTable(self.tokens.items())
        self.pairs = PairTable()
        self.sides: tuple[dict, dict] = ({}, {})
        self.seams: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[bytes, bool]] = {}

    def side(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The tokens that touch one end of ``token`` while it is put
        together, first to last, each with the rank of the merge that ends it."""
        known = self.sides[right]
        if token not in known:
            chain, end = [], NEVER
            while True:
                chain.append((token, end))
                if token not in self.made:
                    break
                end, left, r = self.made[token]
                token = r if right else left
            known[chain[0][0]] = chain[::-1]
            return chain[::-1]
        return known[token]

    def follows(self, a: int, b: int) -> bool:
        """Whether the bytes of ``a`` then ``b`` are encoded as just these two."""
        seam = self.seams.get((a, b))
        if seam is None:
            left, right = self.side(a, True), self.side(b, False)
            i = j = 0
            while True:
                (x, x_end), (y, y_end) = left[i], right[j]
                m = self.rank.get((x, y), NEVER)
                if m < x_end and m <= y_end and m != NEVER:
                    seam = False
                    break
                if x_end == y_end == NEVER:
                    seam = True
                    break
                if x_end <= y_end:
                    i += 1
                else:
                    j += 1
            if len(self.seams) >= 4 * CACHE_WORDS:
                self.seams.clear()
            self.seams[a, b] = seam
        return seam

    def all_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`follows` for whole arrays; pairs met before come from a table."""
        keys = (a.astype(np.int64) << 32) | b
        known = self.pairs.find(keys)
        unknown = np.flatnonzero(known < 0)
        if len(unknown):
            new = np.unique(keys[unknown])
            told = np.array([self.follows(int(k >> 32), int(k & 0xFFFFFFFF)) for k in new], np.int8)
            self.pairs.add(new, told)
            known[unknown] = told[np.searchsorted(new, keys[unknown])]
        return known == 1

    def byte_counts(self, word: bytes) -> list[int]:
        """Token counts of all byte prefixes of one pretoken, from 0."""
        tokens, tails, follows = self.tokens, self.tails, self.follows
        last, count = [-1], [0]
        for i in range(1, len(word) + 1):
            ends = []
            for k in range(i - 1, -1, -1):
                piece = word[k:i]
                if piece not in tails:
                    break
                t = tokens.get(piece)
                if t is not None:
                    ends.append((k, t))
            for k, t in reversed(ends):
                if k == 0 or follows(last[k], t):
                    last.append(t)
                    count.append(count[k] + 1)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
        return count

    def many(self, words: list[str]) -> None:
        """Remember :meth:`word` for many pretokens: the program advances all
        of them by a byte at a time.  Long ones are left to :meth:`word`."""
        raws = [w.encode("utf-8", "replace") for w in words]
        short = [i for i, r in enumerate(raws) if 0 < len(r) <= LONG_BYTES]
        words, raws = [words[i] for i in short], [raws[i] for i in short]
        if not words:
            return
        size = np.fromiter(map(len, raws), np.int64, len(raws))
        data = np.frombuffer(b"".join(raws), np.uint8)
        stop = np.cumsum(size)
        start, length, token = self.table.matches(data.astype(U64), np.repeat(stop, size))
        word_of = np.repeat(np.arange(len(raws)), size)
        begin = stop - size
        # Node 0 of a word comes before its first byte; node x + 1 after byte x.
        node = start + word_of[start]
        source, target = node, node + length
        depth = start - begin[word_of[start]] + length
        order = np.argsort(depth, kind="stable")
        source, target, token, depth = source[order], target[order], token[order], depth[order]
        last, count = np.full(len(data) + len(raws), -1), np.zeros(len(data) + len(raws), np.int32)
        cut = np.searchsorted(depth, np.arange(1, int(size.max()) + 2))
        for x, y in zip(cut[:-1], cut[1:]):
            src, tok = source[x:y], token[x:y]
            before = last[src]
            ok = before < 0
            rest = np.flatnonzero(~ok)
            ok[rest] = self.all_follow(before[rest], tok[rest])
            last[target[x:y][ok]] = tok[ok]
            count[target[x:y][ok]] = count[src[ok]] + 1
        # A node that no token ended at stays at 0 beyond its word's start.
        heads = begin + np.arange(len(raws))
        inner = np.ones(len(count), bool)
        inner[heads] = False
        counts = count[inner]
        if not counts.all():
            raise ValueError("the vocabulary lacks a byte")
        for w, r, a, b in zip(words, raws, begin.tolist(), stop.tolist()):
            self.keep(w, r, counts[a:b])

    def keep(self, p: str, raw: bytes, counts: np.ndarray) -> tuple[bytes, bool]:
        if len(raw) != len(p):  # keep the last byte of every character
            counts = counts[np.append((np.frombuffer(raw, np.uint8)[1:] & 0xC0) != 0x80, True)]
        if p in LONG_CONTRACTIONS:
            counts = counts.copy()
            counts[1] = 2
        found = (counts.tobytes(), self.space.fullmatch(p) is not None)
        self.words[p] = found
        return found

    def word(self, p: str) -> tuple[bytes, bool]:
        """Counts after each character of a pretoken (int32), and whether it is white space."""
        found = self.words.get(p)
        if found is None:
            raw = p.encode("utf-8", "replace")
            found = self.keep(p, raw, np.array(self.byte_counts(raw), dtype=np.int32)[1:])
        return found

    def prepare(self, texts: list) -> list:
        """Remember the pretokens of a group of texts; returns each text's
        pretokens (None for a text with special strings)."""
        new, parts = set(), []
        for t in texts:
            found = None if self.split_special.search(t or "") else self.pattern.findall(t or "")
            parts.append(found)
            new.update(found or ())
        unknown = new.difference(self.words)
        if len(self.words) + len(unknown) > CACHE_WORDS:
            self.words.clear()
            unknown = new
        self.many(sorted(unknown))
        return parts

    def plain(self, text: str, parts: list[str] | None = None) -> tuple[np.ndarray, int]:
        """Counts after each character of a text without special strings, and of all of it."""
        parts = self.pattern.findall(text) if parts is None else parts
        if not parts:
            return np.zeros(0, np.int32), 0
        found = [self.words.get(p) or self.word(p) for p in parts]
        local = np.frombuffer(b"".join([x[0] for x in found]), np.int32)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        end = np.cumsum(size)
        before = np.concatenate(([0], np.cumsum(local[end - 1])))
        out = local + np.repeat(before[:-1], size).astype(np.int32)
        for k in [k for k, x in enumerate(found) if x[1]]:
            if k + 1 < len(parts) and self.space.match(parts[k + 1]):
                run = np.frombuffer(self.word(parts[k] + parts[k + 1][0])[0], np.int32)
                out[end[k]] = before[k] + run[-1]
        return out, int(out[-1])

    def counts(self, text: str | None, pretokens: list[str] | None = None) -> np.ndarray:
        """Token counts of ``text[:0]``, ``text[:1]`` ... ``text``; ``pretokens``
        are those of :meth:`prepare`, if at hand."""
        if pretokens is not None:
            return np.concatenate((np.zeros(1, np.int32), self.plain(text or "", pretokens)[0]))
        parts, total = [np.zeros(1, np.int32)], 0
        pieces, marks = [], []
        start = 0
        for m in self.split_special.finditer(text or ""):
            pieces.append((text or "")[start:m.start()])
            marks.append(m.group())
            start = m.end()
        pieces.append((text or "")[start:])
        for i, piece in enumerate(pieces):
            if i < len(marks):
                inside, _ = self.plain(piece + marks[i][:-1])
                parts.append(inside + np.int32(total))
                total += self.plain(piece)[1] + 1
                parts.append(np.array([total], np.int32))
            else:
                inside, n = self.plain(piece)
                parts.append(inside + np.int32(total))
                total += n
        return np.concatenate(parts)


def pack(counts: np.ndarray) -> bytes:
    """Prefix counts as steps from one to the next, in one byte each if they fit."""
    steps = np.diff(counts)
    small = not len(steps) or (steps.min() >= -128 and steps.max() < 128)
    return (b"\1" + steps.astype(np.int8).tobytes()) if small else (b"\4" + steps.astype("<i4").tobytes())


def unpack(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed, np.int8 if packed[:1] == b"\1" else "<i4", offset=1)
    return np.concatenate(([0], np.cumsum(steps, dtype=np.int64)))


def count_at(packed: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` characters."""
    return int(unpack(packed)[n_chars])


def cut_at(packed: bytes, budget: int, start: int = 0) -> int:
    """The longest prefix (in characters, ``start`` at least) of at most ``budget`` tokens."""
    counts = unpack(packed)
    fit = np.flatnonzero(counts <= budget)
    return int(max(fit[-1], start))


def prefix_token_counts(df: DataFrame, tokenizer_path: str, text: str = "text", budget: int = 1024) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_tokens``, ``fits_chars`` (long; the longest
    prefix within ``budget`` tokens) and ``prefix_counts`` (binary, see
    :func:`unpack`).  Null text counts as empty: 0, 0, 0.  Columns with these
    names are replaced, all others pass through; nothing is shuffled.

    ``tokenizer_path`` names the tokenizer's file on every executor.
    """
    import pyarrow as pa

    own = ["n_bytes", "n_tokens", "fits_chars", "prefix_counts"]
    base = df.select(*[c for c in df.columns if c not in own])
    schema = schema_with(base, n_bytes="long", n_tokens="long", fits_chars="long", prefix_counts="binary")

    def run(batches):
        counter = worker_cache(f"prefix:{tokenizer_path}", lambda: PrefixCounter(tokenizer_path))
        for b in slices(batches, 1024):
            texts, at = b.column(text).to_pylist(), 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end] or "") <= GROUP_CHARS):
                    chars += len(texts[end] or "")
                    end += 1
                part, own_texts = b.slice(at, end - at), texts[at:end]
                pretokens = counter.prepare(own_texts)
                n_bytes, n_tokens, fits, packed = [], [], [], []
                for t, parts in zip(own_texts, pretokens):
                    counts = counter.counts(t, parts)
                    n_bytes.append(len((t or "").encode("utf-8", "replace")))
                    n_tokens.append(int(counts[-1]))
                    fits.append(int(np.flatnonzero(counts <= budget)[-1]))
                    packed.append(pack(counts))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                     pa.array(fits, pa.int64()), pa.array(packed, pa.binary())], names=[*part.schema.names, *own])
                at = end

    return small_batches(base).mapInArrow(run, schema)


def token_digest(df: DataFrame, tokenizer_path: str, limit: int = 1024) -> DataFrame:
    """Per document: bytes, tokens, whether it exceeds ``limit``, and the prefix that fits."""
    return prefix_token_counts(df.select("doc_id", "text"), tokenizer_path, budget=limit).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fits_chars")
