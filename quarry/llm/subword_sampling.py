"""Subword sampling without replacement over a SentencePiece vocabulary.

A text's segmentations are the paths of a lattice: nodes are character
positions, edges the vocabulary's pieces.  A piece of merge rank ``r`` has
probability proportional to ``1 / (r + 1)`` (Zipf's law stands in for the
frequencies that a BPE model does not hold), a path the product of its
pieces'.  Gumbel top-k: give every path its log-probability plus a Gumbel
draw, and the ``k`` largest are a sample without replacement.

The paths are too many to perturb, so the largest values are found top
down, as an A* search whose bounds are exact: the largest perturbed value
below a partial path is itself Gumbel, around the log-probability of all its
completions (backward sums over the lattice).  The search expands a partial
path by its next piece: one piece inherits the bound, all its siblings
together get one truncated draw below it, which is their bound.  Following
the inheriting pieces to the end emits a segmentation; the next one starts
at the highest sibling bound that is left.  After ``k`` segmentations the
highest bound left is the ``k+1``-st value ``t``, and a path of
log-probability ``l`` has the inclusion score ``1 - exp(-exp(l - t))``, by
which sums over the sample can be weighted without bias.

No piece runs across two characters that follow each other in no piece (a
letter and a line's end, mostly a letter and a blank), so the lattice of a text
is a chain of the lattices of its words, cut there.  A worker makes a word's
lattice once and keeps it for later batches, up to a bound.  All texts of a
batch walk at once, in numpy.  Draws are hashes of the row's key, the sample and
the position: a row gives the same segmentations in every run, batch and
partition.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import no_cycle_search, schema_with, slices, small_batches, worker_cache
from .head_table import U64, HeadTable, mix

BLANK = "▁"
# Texts are taken in groups of about so many characters (no result depends on it).
BATCH_CHARS = 1 << 17
# A worker drops lattices once its words have more characters than this (no result depends on it).
KEPT_CHARS = 1 << 19
SEED = U64(0x9E3779B97F4A7C15)


def stirred(h, *parts):
    """A hash of ``h`` and some integers, one after the other."""
    with np.errstate(over="ignore"):
        for p in parts:
            h = mix((h ^ np.asarray(p).astype(U64)) + SEED)
    return h


def unit(h) -> np.ndarray:
    """Numbers in (0, 1) from hashes."""
    return ((h >> U64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def uniform(*parts) -> np.ndarray:
    """Numbers in (0, 1) from integers, the same for the same integers."""
    return unit(stirred(SEED, *parts))


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``count`` numbers from each ``start`` on, in a row."""
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(int(count.sum()))


def code_points(text: str) -> np.ndarray:
    """The characters of a text, its spaces as blanks."""
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(cps == ord(" "), np.uint32(ord(BLANK)), cps)


def pair_slot(a, b):
    """Where :attr:`Vocabulary.joined` has two characters that follow each other."""
    with np.errstate(over="ignore"):
        return ((a * np.uint32(0x9E3779B1) + b) * np.uint32(0x85EBCA6B)) >> np.uint32(12)


class Vocabulary:
    """The pieces of a model and their scores."""

    def __init__(self, model_path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.raw = np.array([p.encode() for p in self.pieces], dtype=object)
        for b, i in self.bytes.items():
            self.raw[i] = bytes([b])
        self.ids = {self.pieces[i]: (i, -math.log1p(max(0.0, -sp.get_score(i)))) for i in plain}
        self.byte_score = -math.log1p(n)
        # Whether two characters follow each other in a piece; two that share a slot only make a longer word.
        self.joined = np.zeros(1 << 20, bool)
        beside = np.array([(ord(x), ord(y)) for p in self.ids for x, y in zip(p, p[1:])], np.uint32).reshape(-1, 2)
        self.joined[pair_slot(beside[:, 0], beside[:, 1])] = True
        self.table = HeadTable(([ord(c) for c in p], i) for p, (i, _) in self.ids.items())
        self.score = np.zeros(n)
        for i, score in self.ids.values():
            self.score[i] = score
        self.known = Lexicon(self)

    def decode(self, ids) -> str:
        """The text of a piece sequence: blanks restored, bytes joined, the
        blank that encoding put in front taken off."""
        raw = b"".join(self.raw[np.asarray(ids, np.int64)].tolist())
        text = raw.decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:] if text[:1] == " " else text


class Lattices:
    """The lattices of some words (at least one), in flat arrays.

    A word of ``n`` characters has ``n + 1`` nodes from ``head`` to ``tail``;
    node ``x`` has the edges ``first[x]`` to ``first[x + 1]``, each with its
    ``piece`` (``-1 - c`` for a character ``c`` without a piece), its ``step``
    in characters and its share ``prob`` of the node's completions, ``others``
    for all other edges of the node, ``run`` up to this edge.  An end node has
    one idle edge.  Nothing depends on the words beside a word."""

    def __init__(self, vocab: Vocabulary, words: list[str]):
        size = np.fromiter(map(len, words), np.int64, len(words))
        cps = code_points("".join(words)).astype(U64)
        self.tail = np.cumsum(size + 1) - 1
        self.head = self.tail - size
        end = np.repeat(np.cumsum(size), size)  # where the word of a character ends
        node = np.arange(len(cps)) + np.repeat(np.arange(len(words)), size)
        src, step, piece = vocab.table.matches(cps, end)
        bare = np.ones(len(cps), bool)  # characters without a piece of their own
        bare[src[step == 1]] = False
        bare = np.flatnonzero(bare)
        c = cps[bare].astype(np.int64)
        n_bytes = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
        score = np.concatenate((vocab.score[piece], n_bytes * vocab.byte_score))
        src, step = np.concatenate((src, bare)), np.concatenate((step, np.ones(len(bare), np.int64)))
        piece = np.concatenate((piece, -1 - c))
        src = np.concatenate((node[src], self.tail))
        order = np.argsort(src, kind="stable")
        src = src[order]
        idle = len(self.tail)
        self.step = np.concatenate((step, np.zeros(idle, np.int64)))[order]
        self.piece = np.concatenate((piece, np.zeros(idle, np.int64)))[order]
        score = np.concatenate((score, np.zeros(idle)))[order]
        n_nodes = int(self.tail[-1]) + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(src, minlength=n_nodes)))).astype(np.int64)
        total = self.backward(src, score, n_nodes)
        self.prob = np.exp(score + total[src + self.step] - total[src])
        self.prob[self.step == 0] = 1.0
        # Share of the other edges of an edge's node, summed apart from a share near 1.
        light = np.where(self.prob > 0.5, 0.0, self.prob)
        self.others = np.where(self.prob > 0.5, np.add.reduceat(light, self.first[:-1])[src], 1.0 - self.prob)
        self.run, at, last = self.prob.copy(), self.first[:-1], self.first[1:] - 1
        while len(at):  # the second edges of all nodes, then the third
            more = at < last
            at, last = at[more] + 1, last[more]
            self.run[at] = np.minimum(self.run[at] + self.run[at - 1], 1.0)
        self.run[self.first[1:] - 1] = 1.0

    def backward(self, src, score, n_nodes: int):
        """Log of the summed completions of every node: all nodes at distance
        1 from their word's end, then 2, and so on."""
        total = np.zeros(n_nodes)
        far = np.repeat(self.tail, self.tail - self.head + 1) - np.arange(n_nodes)
        nodes = np.argsort(far, kind="stable")
        counts = np.diff(self.first)[nodes]
        edges = ranges(self.first[nodes], counts)
        target, score = src[edges] + self.step[edges], score[edges]
        node_cut = np.searchsorted(far[nodes], np.arange(far.max() + 2))
        edge_cut = np.concatenate(([0], np.cumsum(counts)))
        for d in range(1, len(node_cut) - 1):
            a, b = node_cut[d], node_cut[d + 1]
            ea, eb = edge_cut[a], edge_cut[b]
            v = score[ea:eb] + total[target[ea:eb]]
            seg = edge_cut[a:b] - ea
            top = np.maximum.reduceat(v, seg)
            total[nodes[a:b]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, counts[a:b])), seg))
        return total


class Column:
    """A flat array that grows at its end."""

    def __init__(self, values):
        self.data, self.n = values, len(values)

    def add(self, values) -> None:
        end = self.n + len(values)
        if end > len(self.data):
            data = np.empty(end + end // 2, self.data.dtype)
            data[:self.n] = self.data[:self.n]
            self.data = data
        self.data[self.n:end] = values
        self.n = end

    @property
    def values(self) -> np.ndarray:
        return self.data[:self.n]


class Lexicon:
    """The lattices of the words met so far, one after the other.

    Beyond :data:`KEPT_CHARS` characters those of words that only one batch
    held are dropped, or all, if that leaves more than half."""

    EDGES = {"step": np.int32, "piece": np.int32, "prob": np.float64, "others": np.float64, "run": np.float64}

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.start({}, np.zeros(0, np.int64), np.zeros(1, np.int64), {k: np.zeros(0, t) for k, t in self.EDGES.items()})

    def start(self, words, tail, first, edges) -> None:
        self.number: dict[str, int] = defaultdict(None, zip(words, range(len(words))))
        self.number.default_factory = self.number.__len__  # words are numbered as they come
        self.tail, self.first = Column(tail), Column(first)  # the end node of each word, the first edge of each node
        self.edges = {k: Column(v) for k, v in edges.items()}
        self.met = np.zeros(len(tail), np.int64)

    def cut(self, text: str, starts: np.ndarray):
        """The words of ``text``, which begins anew at ``starts``: where each begins, and its number."""
        if self.tail.n and self.tail.values[-1] + 1 - self.tail.n > KEPT_CHARS:
            self.drop()
        if not text:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cps = code_points(text)
        new = np.ones(len(cps), bool)
        new[1:] = ~self.vocab.joined[pair_slot(cps[:-1], cps[1:])]
        new[starts] = True
        at = np.flatnonzero(new)
        cuts, number, held = [*at.tolist(), len(text)], self.number, len(self.number)
        which = np.array([number[text[a:b]] for a, b in zip(cuts, islice(cuts, 1, None))], np.int64)
        if len(self.number) > held:
            self.add(Lattices(self.vocab, list(islice(self.number, held, None))))
        met = np.zeros(len(self.number), np.int64)
        met[which] = 1
        met[:held] += self.met
        self.met = met
        return at, which

    def add(self, made: Lattices) -> None:
        nodes, edges = self.first.n - 1, int(self.first.values[-1])
        self.tail.add(made.tail + nodes)
        self.first.add(made.first[1:] + edges)
        for name, column in self.edges.items():
            column.add(getattr(made, name))

    def drop(self) -> None:
        tail, first = self.tail.values, self.first.values
        head = np.concatenate(([0], tail[:-1] + 1))
        stay = np.flatnonzero(self.met > 1)
        size = tail[stay] + 1 - head[stay]
        if size.sum() - len(stay) > KEPT_CHARS // 2:
            self.__init__(self.vocab)
            return
        words = list(self.number)
        count = np.diff(first)[ranges(head[stay], size)]
        edges = ranges(first[head[stay]], first[tail[stay] + 1] - first[head[stay]])
        self.start([words[i] for i in stay.tolist()], np.cumsum(size) - 1, np.concatenate(([0], np.cumsum(count))),
                   {k: v.data[edges] for k, v in self.edges.items()})


class Walks:
    """The chains of words' lattices of some texts in a row, and random walks through them."""

    def __init__(self, vocab: Vocabulary, texts: list[str], keys: np.ndarray):
        spelt = [" " + t.replace(BLANK, " ") if t else "" for t in texts]
        size = np.fromiter(map(len, spelt), np.int64, len(spelt))
        self.doc_at = np.cumsum(size) - size
        known = vocab.known
        at, which = known.cut("".join(spelt), self.doc_at[size > 0])
        self.at = np.append(at, size.sum())  # position of each word, all texts in a row
        self.keys = keys.astype(np.int64).view(U64)
        self.word_start = np.searchsorted(at, np.append(self.doc_at, size.sum()))
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.word_start))
        self.first = known.first.values
        self.step, self.piece, self.prob, self.others, self.run = (known.edges[k].values for k in Lexicon.EDGES)
        self.tail = known.tail.values[which]
        self.head = self.tail - np.diff(self.at)

    @property
    def cum(self):
        """The number of an edge's node plus the running share."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first)) + self.run

    def drawn(self, node, x):
        """The first edge of each node that reaches ``x`` in ``cum``, else its last."""
        return self.reached(node, x - node)

    def reached(self, node, share):
        """The first edge of each node whose running share reaches ``share``: a
        search among the node's own edges, which lie together."""
        low, high = self.first[node], self.first[node + 1] - 1
        todo = np.flatnonzero(low < high)
        a, b, x = low[todo], high[todo], share[todo]
        while len(todo):
            middle = (a + b) >> 1
            right = self.run[middle] < x
            a, b = np.where(right, middle + 1, a), np.where(right, b, middle)
            low[todo] = a
            more = np.flatnonzero(a < b)
            todo, a, b, x = todo[more], a[more], b[more], x[more]
        return low

    def keyed(self, number: int):
        """The hash of every text's key and a number; :meth:`draws` goes on from it."""
        return stirred(SEED, self.keys, np.full(len(self.keys), number))

    def draws(self, keyed, doc, pos):
        """A number in (0, 1) for each position of a document."""
        return unit(stirred(keyed[doc], pos - self.doc_at[doc]))

    def walk(self, words, nodes, sample: int):
        """Random paths from a node of each of some words to its end:
        word, position and edge of every step, in order of position."""
        w, node, out, keyed = words, nodes, [], self.keyed(sample)
        go = node < self.tail[w]
        w, node = w[go], node[go]
        pos, tail, doc = self.at[w] + node - self.head[w], self.tail[w], self.doc[w]
        while len(w):
            edge = self.reached(node, self.draws(keyed, doc, pos))
            out.append((w, pos, edge))
            step = self.step[edge]
            node = node + step
            go = np.flatnonzero(node < tail)
            w, node, pos, tail, doc = w[go], node[go], (pos + step)[go], tail[go], doc[go]
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        w, pos, edge = (np.concatenate([o[i] for o in out]) for i in range(3))
        order = np.argsort(pos, kind="stable")
        return w[order], pos[order], edge[order]


def truncated(loc, bound, u):
    """Gumbel values around ``loc``, given that they lie below ``bound``."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        out = loc - np.log(np.exp(loc - bound) - np.log(u))
    return np.where(np.isneginf(loc), -np.inf, np.minimum(out, bound))


def by_doc(doc: np.ndarray, values: np.ndarray, n: int):
    """Sums up to and including each entry within its document (sorted by document)."""
    total = np.cumsum(values)
    start = np.searchsorted(doc, np.arange(n))
    before = np.concatenate(([0.0], total))[start]
    return total - before[doc]


class Path:
    """A sampled segmentation: position and edge of its steps, the bound of
    each step's untaken siblings, and where it left the path it came from."""

    def __init__(self, pos, edge, below, branch: int, gone: tuple):
        self.pos, self.edge, self.below, self.branch, self.gone = pos, edge, below, branch, gone

    def taken_at(self, i: int) -> tuple:
        """The edges at step ``i`` that segmentations found so far went through."""
        return (int(self.edge[i]), *(self.gone if i == self.branch else ()))


def log_inclusion(x: float) -> float:
    """``log(1 - exp(-exp(x)))``, also where the score itself is too small for a float."""
    return x if x < -30 else math.log(-math.expm1(-math.exp(min(x, 50.0))))


def sample_texts(vocab: Vocabulary, texts: list[str], keys: np.ndarray, k: int, seed: int) -> list[list[tuple]]:
    """For each text up to ``k`` distinct segmentations, best first, each
    ``(piece codes, log_prob, perturbed, log_inclusion)``."""
    n = len(texts)
    walks = Walks(vocab, texts, mix(keys.astype(np.int64).view(U64) ^ U64(seed)).view(np.int64))
    found: list[list[tuple]] = [[] for _ in range(n)]
    paths: list[list[Path]] = [[] for _ in range(n)]
    bound = -np.log(-np.log(uniform(walks.keys, np.full(n, 1 << 40))))
    live = np.arange(n)
    doc_of_word = walks.doc
    word, pos, edge = walks.walk(np.arange(len(walks.head)), walks.head, 0)
    doc = doc_of_word[word]
    branch_of: dict[int, tuple] = {}  # document -> step of the branch, edges gone there, share left beside the new one
    for sample in range(k):
        start, end = np.searchsorted(doc, live), np.searchsorted(doc, live, side="right")
        logq = np.log(walks.prob[edge])
        through = by_doc(doc, logq, n)
        left = walks.others[edge]
        for d, a in zip(live.tolist(), start.tolist()):
            if d in branch_of:
                i, _, share = branch_of[d]
                left[a + i] = share
        siblings = np.full(len(left), -np.inf)
        np.log(left, out=siblings, where=left > 0)
        u = walks.draws(walks.keyed((1 << 41) + sample), doc, pos)
        below = truncated(through - logq + siblings, bound[doc], u)
        starts = []
        for d, a, b in zip(live.tolist(), start.tolist(), end.tolist()):
            i, gone, _ = branch_of.get(d, (0, (), 0.0))
            below[a:a + i] = -np.inf  # these siblings have their bounds in the path it came from
            paths[d].append(Path(pos[a:b], edge[a:b], below[a:b], i if gone else -1, gone))
            found[d].append((edge[a:b], float(through[b - 1]) if b > a else 0.0, float(bound[d])))
            best = max((p for p in paths[d] if len(p.below)), key=lambda p: p.below.max(), default=None)
            bound[d] = best.below.max() if best is not None else -np.inf
            if bound[d] > -np.inf:
                starts.append((d, best, int(best.below.argmax())))
        if sample + 1 == k or not starts:
            break
        live = np.array([d for d, _, _ in starts])
        branch_of, words, nodes, heads = {}, [], [], []
        for (d, path, i), u1 in zip(starts, uniform(walks.keys[live], np.full(len(live), (1 << 42) + sample))):
            path.below[i] = -np.inf  # opened
            p, gone = int(path.pos[i]), path.taken_at(i)
            w = int(np.searchsorted(walks.at, p, side="right")) - 1
            node = int(walks.head[w]) + p - int(walks.at[w])
            free = [e for e in range(int(walks.first[node]), int(walks.first[node + 1])) if e not in gone]
            share = np.cumsum(walks.prob[free])
            pick = free[min(int(np.searchsorted(share, u1 * share[-1])), len(free) - 1)]
            branch_of[d] = (i, gone, float(walks.prob[[e for e in free if e != pick]].sum()))
            heads.append((path.pos[:i + 1], np.append(path.edge[:i], pick)))
            words.append(w)
            nodes.append(node + int(walks.step[pick]))
        w0 = np.array(words)
        later = np.concatenate([np.arange(w + 1, walks.word_start[d + 1]) for w, d in zip(words, live.tolist())])
        tw, tp, te = walks.walk(np.concatenate((w0, later)), np.concatenate((nodes, walks.head[later])), sample + 1)
        a, b = (np.searchsorted(doc_of_word[tw], live, side=x).tolist() for x in ("left", "right"))
        pos = np.concatenate([x for h, i, j in zip(heads, a, b) for x in (h[0], tp[i:j])])
        edge = np.concatenate([x for h, i, j in zip(heads, a, b) for x in (h[1], te[i:j])])
        doc = np.repeat(live, [len(h[0]) + j - i for h, i, j in zip(heads, a, b)])
    return [[(walks.piece[path], logp, g, log_inclusion(logp - bound[d])) for path, logp, g in found[d]]
            for d in range(n)]


def piece_ids(vocab: Vocabulary, codes: np.ndarray) -> np.ndarray:
    """Vocabulary ids of a path; a character without a piece becomes its bytes."""
    return ids_of(vocab, codes)[0]


def ids_of(vocab: Vocabulary, codes: np.ndarray):
    """Vocabulary ids of some codes in a row, and how many each code has."""
    size = np.ones(len(codes), np.int64)
    bare = codes < 0
    if not bare.any():
        return codes.astype(np.int32), size
    chars, which = np.unique(-1 - codes[bare], return_inverse=True)
    spelt = [[vocab.bytes[b] for b in chr(c).encode("utf-8", "replace")] for c in chars.tolist()]
    width = np.array(list(map(len, spelt)))[which]
    table = np.array([x + [0] * (4 - len(x)) for x in spelt], np.int32)
    size[bare] = width
    at = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.int32)
    out[at[~bare]] = codes[~bare]
    for j in range(4):
        has = width > j
        out[at[bare][has] + j] = table[which[has], j]
    return out, size


def decoding(vocab: Vocabulary, texts: list[str], of: list[int], ids: np.ndarray, ends: list[int]) -> list[bool]:
    """Whether each run of ``ids``, up to its end, decodes to the text it is
    ``of``.  Runs whose bytes are those of the text as it was encoded do."""
    raw = vocab.raw[ids].tolist()
    want = [t.replace(" ", BLANK) for t in texts]
    coded = [(BLANK + t).encode("utf-8", "surrogatepass") if t else b"" for t in want]
    return [b"".join(raw[a:b]) == coded[i] or vocab.decode(ids[a:b]) == texts[i].replace(BLANK, " ")
            for i, a, b in zip(of, [0, *ends], ends)]


def sample_segmentations(df: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", k: int = 2,
                         seed: int = 7) -> DataFrame:
    """One row for each sampled segmentation of each row of ``df``: its
    columns, then ``sample`` (int, from 1, largest perturbed value first),
    ``ids`` (array<int>), ``log_prob``, ``perturbed``, ``log_inclusion``,
    ``inclusion`` (double; 0 where the score of a long text is below all floats)
    and ``decodes``: whether decoding the ids gives the text back.

    A text with fewer than ``k`` segmentations gives all it has, each with
    inclusion 1.  Empty and null texts have one, without pieces.  A null key
    draws like the key 0.  Rows that agree in key and text give the same
    samples.  Columns with those names are replaced.  Nothing is shuffled.
    """
    import pyarrow as pa

    own = ["sample", "ids", "log_prob", "perturbed", "log_inclusion", "inclusion", "decodes"]
    base = df.select(*[c for c in df.columns if c not in own]).withColumn(
        "__key", F.coalesce(F.col(key).cast("long") if dict(df.dtypes)[key] in ("bigint", "int", "smallint", "tinyint")
                            else F.xxhash64(key), F.lit(0)))
    text_at = base.columns.index(text)
    schema = schema_with(base.drop("__key"), sample="int", ids="array<int>", log_prob="double", perturbed="double",
                         log_inclusion="double", inclusion="double", decodes="boolean")

    def run(batches):
        vocab = worker_cache(f"pieces:{model_path}", lambda: Vocabulary(model_path))
        with no_cycle_search():
            for b in slices(batches, 1024):
                texts = [t or "" for t in b.column(text_at).to_pylist()]
                keys = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
                at = 0
                while at < len(texts):
                    end, chars = at, 0
                    while end < len(texts) and (end == at or chars + len(texts[end]) <= BATCH_CHARS):
                        chars += len(texts[end])
                        end += 1
                    found = sample_texts(vocab, texts[at:end], keys[at:end], k, seed)
                    rows = [(i, j, *r) for i, rs in enumerate(found) for j, r in enumerate(rs)]
                    flat, size = ids_of(vocab, np.concatenate([r[2] for r in rows]))
                    ends = np.cumsum([len(r[2]) for r in rows])
                    offsets = np.concatenate(([0], np.cumsum(size)))[np.append(0, ends)].astype(np.int32)
                    back = decoding(vocab, texts[at:end], [r[0] for r in rows], flat, offsets[1:].tolist())
                    part = b.slice(at, end - at).take(pa.array([r[0] for r in rows], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:-1], pa.array([r[1] + 1 for r in rows], pa.int32()),
                         pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                         *[pa.array([r[c] for r in rows], pa.float64()) for c in (3, 4, 5)],
                         pa.array([math.exp(r[5]) for r in rows], pa.float64()), pa.array(back, pa.bool_())],
                        names=[*part.schema.names[:-1], *own])
                    at = end

    return small_batches(base).mapInArrow(run, schema)


def decode_pieces(df: DataFrame, model_path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the text of its piece ids (null for null)."""
    import pyarrow as pa

    base = df.select(*[c for c in df.columns if c != to])
    schema, at = schema_with(base, **{to: "string"}), base.columns.index(ids)

    def run(batches):
        vocab = worker_cache(f"pieces:{model_path}", lambda: Vocabulary(model_path))
        for b in batches:
            out = [None if x is None else vocab.decode(x) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, to])

    return small_batches(base).mapInArrow(run, schema)
