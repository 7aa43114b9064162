"""Language identification by a string kernel.

Kernel: two texts are as alike as the share of n-grams (lengths 1 to
``order``) present in both, ``k(x, y) = |P(x) & P(y)| / sqrt(|P(x)| |P(y)|)``,
where ``P`` is the *set* of a text's n-grams over its lower-cased letters,
every run of other characters being one blank.  Counts do not matter, so a
long text and a repeated line weigh no more than their set.

Training takes a bounded sample of labelled rows (``per_class`` rows of a
language at most, of up to ``max_chars`` characters each, chosen by a hash
of the text).  Of those, ``landmarks`` rows of each language are Nystroem
landmarks: a text becomes its kernel values against the landmarks times
``K_mm^(-1/2)``, and one ridge regression per language (one against the
rest, targets +1 and -1) is solved on that map.

Scoring covers every row and whole texts: each Arrow batch becomes a 0/1
matrix over the landmarks' n-grams, one matrix product gives its kernel
block, a second one the scores of all languages.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import schema_with, slices, small_batches, worker_cache

UNDETERMINED = "und"
BLANK = 0


def letter_table() -> np.ndarray:
    """For every code point: that of its lower-case form if it is a letter, else 0."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


@dataclass
class KernelModel:
    """A fitted classifier; its size depends on the sample's parameters only."""

    languages: list[str]
    order: int
    alphabet: np.ndarray = field(repr=False)   # sorted code points of known letters
    vocabulary: np.ndarray = field(repr=False)  # sorted n-gram codes of the landmarks
    landmarks: np.ndarray = field(repr=False)   # n-grams x landmarks, columns scaled by 1/sqrt(|P|)
    weights: np.ndarray = field(repr=False)     # landmarks x languages


def letters(text: str, table: np.ndarray) -> np.ndarray:
    """Lower-cased letters as code points, one 0 for each run of others, 0 at both ends."""
    cps = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    low = np.concatenate(([0], table[cps], [0])).astype(np.uint32)
    keep = np.ones(len(low), dtype=bool)
    keep[1:] = (low[1:] != 0) | (low[:-1] != 0)
    return low[keep]


def ngrams(symbols: np.ndarray, base: int, order: int) -> np.ndarray:
    """The sorted distinct n-gram codes of a symbol sequence, lengths 1 to ``order``.
    Code of a length: its symbols as digits, after all codes of shorter lengths."""
    kind = np.uint32 if base ** order * 2 < 2 ** 32 else np.uint64
    s = symbols.astype(kind)
    parts, codes, start = [], s, 0
    for n in range(1, order + 1):
        if n > 1:
            codes = codes[:-1] * kind(base) + s[n - 1:]
            if not len(codes):
                break
        parts.append(codes + kind(start))
        start += base ** n
    return np.unique(np.concatenate(parts))


def symbols_of(low: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Blank 0, known letters from 2 on; every other letter shares symbol 1."""
    at = np.searchsorted(alphabet, low)
    at[at == len(alphabet)] = 0
    return np.where(low == 0, 0, np.where(alphabet[at] == low, at + 2, 1))


def fit_kernel_model(texts: list[str], labels: list[str], landmarks: int = 64, order: int = 3,
                     ridge: float = 1e-3) -> KernelModel:
    """Fit on a bounded sample held in memory; its letters are the alphabet."""
    table = worker_cache("letters", letter_table)
    lows = [letters(t, table) for t in texts]
    alphabet = np.unique(np.concatenate(lows))
    alphabet = alphabet[alphabet != 0]
    if not len(alphabet):
        alphabet = np.array([ord("a")], dtype=np.uint32)
    base = len(alphabet) + 2
    if base ** order * 2 >= 2 ** 64:
        raise ValueError(f"n-grams of {order} letters out of {len(alphabet)} do not fit 64 bits")
    sets = [ngrams(symbols_of(x, alphabet), base, order) for x in lows]
    languages = sorted(set(labels))
    marks = [i for lang in languages for i in [i for i, x in enumerate(labels) if x == lang][:landmarks]]
    vocabulary = np.unique(np.concatenate([sets[i] for i in marks]))
    columns = np.zeros((len(vocabulary), len(marks)), dtype=np.float32)
    for j, i in enumerate(marks):
        columns[np.searchsorted(vocabulary, sets[i]), j] = 1 / np.sqrt(len(sets[i]))
    model = KernelModel(languages, order, alphabet, vocabulary, columns, np.zeros((len(marks), len(languages))))
    kernel = kernel_block(model, sets)
    values, vectors = np.linalg.eigh(kernel[marks].astype(np.float64))
    good = values > 1e-6 * values.max()
    root = (vectors[:, good] / np.sqrt(values[good])) @ vectors[:, good].T
    phi = kernel @ root
    targets = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    solved = np.linalg.solve(phi.T @ phi + ridge * len(texts) * np.eye(phi.shape[1]), phi.T @ targets)
    model.weights = root @ solved
    return model


def kernel_block(model: KernelModel, sets: list[np.ndarray]) -> np.ndarray:
    """Kernel values of some texts (n-gram sets) against the landmarks."""
    present = np.zeros((len(sets), len(model.vocabulary)), dtype=np.float32)
    for i, s in enumerate(sets):
        at = np.searchsorted(model.vocabulary, s)
        at[at == len(model.vocabulary)] = 0
        present[i, at[model.vocabulary[at] == s]] = 1
    sizes = np.array([max(len(s), 1) for s in sets], dtype=np.float64)
    return (present @ model.landmarks).astype(np.float64) / np.sqrt(sizes)[:, None]


def predict_batch(model: KernelModel, texts: list, block: int = 256) -> tuple[list[str], list[float]]:
    """Language and score of each text; ``und`` and 0 without a letter.  The
    score is the softmax of the regression values (spread by 4) at the winner."""
    table = worker_cache("letters", letter_table)
    base = len(model.alphabet) + 2
    langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    rows, sets = [], []

    def flush():
        if rows:
            values = kernel_block(model, sets) @ model.weights
            top = values.argmax(axis=1)
            share = np.exp(4 * (values - values.max(axis=1, keepdims=True)))
            share = share.max(axis=1) / share.sum(axis=1)
            for i, j, p in zip(rows, top, share):
                langs[i], scores[i] = model.languages[j], float(p)
            rows.clear()
            sets.clear()

    for i, t in enumerate(texts):
        if t is None:
            continue
        low = letters(t, table)
        if low.any():
            rows.append(i)
            sets.append(ngrams(symbols_of(low, model.alphabet), base, model.order))
            if len(rows) == block:
                flush()
    flush()
    return langs, scores


def training_sample(df: DataFrame, text: str, label: str, per_class: int, max_chars: int) -> tuple[list, list]:
    """About ``per_class`` labelled texts of each language, the same ones each
    time: a row is taken when the hash of its text falls below that
    language's share, repeated texts once.  Only drawn texts are shuffled."""
    eligible = df.filter(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}")
                         & (F.char_length(text) <= max_chars))
    counts = eligible.groupBy(label).agg(F.count("*").alias("n")).collect()  # one row per language
    if not counts:
        return [], []
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col(label) == r[label], min(1.0, per_class / r["n"])).otherwise(share)
    draw = (F.xxhash64(F.lit(17), text) % 2 ** 30 + 2 ** 30) / 2.0 ** 31
    rows = eligible.filter(draw < share).select(label, text).distinct().collect()  # a text once, however many hold it
    by: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        by.setdefault(r[0], []).append(r[1])
    texts, labels = [], []
    for lang, found in sorted(by.items()):
        step = max(1.0, len(found) / per_class)
        found = [found[int(i * step)] for i in range(min(per_class, len(found)))]
        rng = np.random.default_rng(len(lang))
        texts += [found[i] for i in rng.permutation(len(found))]
        labels += [lang] * len(found)
    return texts, labels


def train_language_model(df: DataFrame, text: str = "text", label: str = "lang", per_class: int = 400,
                         max_chars: int = 20_000, **kernel) -> KernelModel | None:
    """Fit on a bounded sample of the labelled rows of ``df``; None without any."""
    texts, labels = training_sample(df, text, label, per_class, max_chars)
    return fit_kernel_model(texts, labels, **kernel) if texts else None


def identify_language(df: DataFrame, model: KernelModel | None, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (0 to 1) from the text alone.

    Null text, text without a letter, and every row when there is no model
    get ``und`` and 0.  Columns of those two names are replaced.  Rows and
    all other columns pass through as they are; nothing is shuffled.
    """
    import pyarrow as pa

    keep = [c for c in df.columns if c not in ("lang_pred", "score")]
    base = df.select(*keep)
    if model is None:
        return base.withColumn("lang_pred", F.lit(UNDETERMINED)).withColumn("score", F.lit(0.0))
    # Bounded by the sample's parameters.  Plain values travel: a task may run where this package is not installed.
    shared = df.sparkSession.sparkContext.broadcast(vars(model))
    schema = schema_with(base, lang_pred="string", score="double")

    def run(batches):
        own = KernelModel(**shared.value)
        for b in slices(batches):
            langs, scores = predict_batch(own, b.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*b.schema.names, "lang_pred", "score"])

    return small_batches(base).mapInArrow(run, schema)


def held_out(doc_id) -> Column:
    """Rows kept out of training: crc32 of the id's text is 2 modulo 4 (null: no)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def train_on_documents(docs: DataFrame) -> KernelModel | None:
    """The model of a documents table, from its rows that are not held out."""
    return train_language_model(docs.filter(F.col("doc_id").isNotNull() & ~held_out("doc_id"))
                                .select("text", "lang"))


