"""Embedding hook (UDF-1, UDF-2) and an offline hash embedder.

The reference's only user code hook is an embedding model.  Here a model
is any picklable object with::

    dim: int
    input: "text" | "tokens"          # what embed_batch receives
    embed_batch(values: list) -> list[np.ndarray | None]
    embed_arrow(values: pa.Array) -> pa.Array   # optional: the same on Arrow
                                                # values, list<float> or null each

It runs inside an Arrow UDF, once for each slice of a batch, and is built
lazily once per Python worker.  Only rows that need a vector reach it: the
input of every other row is masked to NULL before the UDF.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import analyze

# Fixed values: the hash embedder's rule.
HASH_DIM = 64
HEX_DIGITS = "0123456789abcdef"

_UDF_IDS = itertools.count()
# What a model gets at once.
SLICE_ROWS = 1_024
SLICE_SIZE = 1 << 18
# The same for a model that reads Arrow values, of which no Python objects are made.
ARROW_ROWS = 16_384
ARROW_SIZE = 1 << 21


def _token_slot(token: str, dim: int) -> tuple[int, float]:
    h = hashlib.md5(token.encode("utf-8")).hexdigest()
    bucket = (16 * HEX_DIGITS.index(h[0]) + HEX_DIGITS.index(h[1])) % dim
    sign = 1.0 if HEX_DIGITS.index(h[2]) < 8 else -1.0
    return bucket, sign


class HashEmbedder:
    """Feature-hashing stand-in model: per token ``m = md5(token)``, bucket
    ``(16*hex1 + hex2) mod dim``, sign ``+`` when ``hex3 < 8``; summed per
    bucket and L2-normalised.  Tokens come from the library analyzer, so the
    embedder and BM25 see the same terms.  No tokens -> no vector."""

    input = "tokens"

    def __init__(self, dim: int = HASH_DIM, max_tokens: int | None = None):
        """Like a real model, it refuses a batch that holds an input of more than ``max_tokens``."""
        self.dim, self.max_tokens = dim, max_tokens

    def embed_batch(self, values) -> list:
        lists = [np.asarray(v, dtype=object) if v is not None else np.empty(0, dtype=object) for v in values]
        lengths = np.array([len(v) for v in lists], dtype=np.int64)
        out = [None] * len(lists)
        if lengths.sum() == 0:
            return out
        codes, distinct = pd.factorize(np.concatenate(lists))
        some, vectors = self._vectors(lengths, codes, distinct)
        for i, vec in zip(some.tolist(), vectors):
            out[i] = vec
        return out

    def embed_arrow(self, values: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        tokens = values.flatten().dictionary_encode()
        some, vectors = self._vectors(lengths, tokens.indices.to_numpy(zero_copy_only=False), tokens.dictionary.to_pylist())
        place = np.full(len(values), -1)
        place[some] = np.arange(len(some))
        offsets = pa.array(np.arange(len(some) + 1, dtype=np.int32) * self.dim)
        return pa.ListArray.from_arrays(offsets, pa.array(vectors.ravel())).take(pa.array(place, mask=place < 0))

    def _vectors(self, lengths: np.ndarray, codes: np.ndarray, distinct) -> tuple[np.ndarray, np.ndarray]:
        """All token lists at once, their tokens numbered: hash each distinct
        token once, and sum signs per (row, bucket).  The rows with a vector, and these."""
        if self.max_tokens is not None and lengths.max(initial=0) > self.max_tokens:
            raise ValueError(f"more than {self.max_tokens} tokens")
        slots = np.array([_token_slot(t, self.dim) for t in distinct], dtype=np.float64).reshape(-1, 2)
        cells = np.repeat(np.arange(len(lengths)) * self.dim, lengths) + slots[:, 0].astype(np.int64)[codes]
        mat = np.bincount(cells, slots[:, 1][codes], minlength=len(lengths) * self.dim).reshape(-1, self.dim)
        norms = np.sqrt((mat * mat).sum(axis=1))
        some = np.flatnonzero(norms > 0)
        return some, (mat[some] / norms[some, None]).astype(np.float32)


def _model_input(model, text: Column) -> Column:
    return analyze(text) if getattr(model, "input", "text") == "tokens" else text


def embed_each(model, values: list) -> tuple[list, list]:
    """Vectors and reasons of failure.  A batch that the model refuses is
    halved until the values that it fails on stand alone, so ``f`` of them cost
    about ``2 f log2(n)`` further calls.  A vector of another length than
    ``model.dim`` is a failure too."""
    vectors, reasons, todo = [None] * len(values), [None] * len(values), [(0, len(values))]
    while todo:
        start, end = todo.pop()
        try:
            got = list(model.embed_batch(values[start:end]))
            if len(got) != end - start:
                raise ValueError(f"{len(got)} vectors for {end - start} inputs")
        except Exception as e:  # whatever the model raises is that value's reason
            if end - start == 1:
                reasons[start] = f"{type(e).__name__}: {e}"
            elif end > start:
                middle = (start + end) // 2
                todo += [(start, middle), (middle, end)]
            continue
        for i, vec in enumerate(got, start):
            if vec is not None and len(vec) != model.dim:
                reasons[i] = f"ValueError: {len(vec)} components instead of {model.dim}"
            else:
                vectors[i] = vec
    return vectors, reasons


def _parts(values: pa.Array, rows: int, most: int):
    """The rows to embed, in slices of at most ``rows`` rows and, a longer row
    aside, ``most`` tokens (texts: characters): their places and inputs."""
    given = np.flatnonzero(values.is_valid().to_numpy(zero_copy_only=False))
    if not len(given):
        return
    size = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.utf8_length(values)
    size = size.take(pa.array(given)).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    while at < len(given):
        n = max(1, int(np.searchsorted(np.cumsum(size[at:at + rows]), most, side="right")))
        yield given[at:at + n], values.take(pa.array(given[at:at + n]))
        at += n


def _slices(values: pa.Array):
    """The same as Python lists, for models that read these."""
    for given, inputs in _parts(values, SLICE_ROWS, SLICE_SIZE):
        yield given.tolist(), inputs.to_pylist()


def _embed_arrow(model, values: pa.Array) -> pa.Array:
    """The vectors of a batch by a model that reads Arrow values."""
    parts = list(_parts(values, ARROW_ROWS, ARROW_SIZE))
    if not parts:
        return pa.nulls(len(values), pa.list_(pa.float32()))
    place = np.full(len(values), -1)
    place[np.concatenate([given for given, _ in parts])] = np.arange(sum(len(given) for given, _ in parts))
    got = pa.concat_arrays([model.embed_arrow(inputs).cast(pa.list_(pa.float32())) for _, inputs in parts])
    return got.take(pa.array(place, mask=place < 0))


def embed_column(model, text, mask: Column | None = None, with_errors: bool = False) -> Column:
    """An Arrow UDF column: the model's vector for ``text`` (NULL in, NULL
    out).  Rows where ``mask`` is false reach the UDF as NULL.  A failing model
    fails the job, or ``with_errors`` yields ``struct<vector, error>``."""
    if model is None:
        raise ValueError("no embedding model configured")
    text = F.col(text) if isinstance(text, str) else text
    value = _model_input(model, text)
    if mask is not None:
        value = F.when(mask, value)

    # The batch stays in Arrow; Python objects exist for one slice at a time.
    def _embed(values: pa.Array) -> pa.Array:
        if hasattr(model, "embed_arrow"):
            return _embed_arrow(model, values)
        vectors = [None] * len(values)
        for given, inputs in _slices(values):
            for i, vec in zip(given, model.embed_batch(inputs)):
                vectors[i] = None if vec is None else np.asarray(vec, dtype=np.float32)
        return pa.array(vectors, pa.list_(pa.float32()))

    def _embed_or_reason(values: pa.Array) -> pa.Array:
        vectors, reasons = [None] * len(values), [None] * len(values)
        for given, inputs in _slices(values):
            for i, vec, why in zip(given, *embed_each(model, inputs)):
                vectors[i], reasons[i] = None if vec is None else np.asarray(vec, dtype=np.float32), why
        return pa.StructArray.from_arrays([pa.array(vectors, pa.list_(pa.float32())), pa.array(reasons, pa.string())],
                                          names=["vector", "error"])

    if with_errors:
        _embed_or_reason.__name__ = f"embed_{next(_UDF_IDS)}"
        return F.arrow_udf(_embed_or_reason, "vector array<float>, error string")(value)
    _embed.__name__ = f"embed_{next(_UDF_IDS)}"
    # Deterministic, so identical subplans over embedded rows share their
    # exchanges; searches never filter on the vector column itself (the
    # scoring kernel skips missing vectors), so Catalyst has no filter to copy
    # the model call into.  A model that is not a pure function should have
    # its output written once (a table under spark.checkpoint.dir) before
    # several searches read it.
    return F.arrow_udf(_embed, "array<float>")(value)


def _missing(vec: Column) -> Column:
    return vec.isNull() | (F.size(vec) == 0)


def _has_text(text: Column) -> Column:
    return text.isNotNull() & (F.trim(text) != "")


def embed_documents(df: DataFrame, model, text_col: str = "content", vector_col: str = "embedding",
                    tasks: int | None = None, errors_col: str | None = None) -> DataFrame:
    """UDF-1: fill a vector only where it is missing and the text is not
    empty; other rows are untouched.  Without a model nothing changes.

    The model runs where the rows are read; ``tasks`` deals them out anew
    first, for an input of fewer splits than the model needs tasks.

    With ``errors_col``, a text that the model fails on costs its own vector
    only: the row stays without one and that column tells why (NULL for all
    other rows).  Write the result once, then its rows with a reason are the
    errors table.  Without it, a failing model fails the job."""
    if model is None:
        return df if errors_col is None else df.withColumn(errors_col, F.lit(None).cast("string"))
    if tasks:
        df = df.repartition(tasks)
    vec, text = F.col(vector_col), F.col(text_col)
    need = _missing(vec) & _has_text(text)
    if errors_col is not None:
        got = df.withColumn("_embedded", embed_column(model, text, need, with_errors=True))
        return got.withColumns({vector_col: F.coalesce(F.when(~need, vec), F.col("_embedded.vector")),
                                errors_col: F.col("_embedded.error")}).drop("_embedded")
    return df.withColumn(vector_col, F.coalesce(
        F.when(~need, vec), embed_column(model, text, need)))


def embed_queries(queries: DataFrame, model, text_col: str = "text", vector_col: str = "vector") -> DataFrame:
    """UDF-2 / SRCH-5: a given vector wins; otherwise the text is embedded.
    Needing an embedding without a model is an error (D18)."""
    if vector_col not in queries.columns:
        queries = queries.withColumn(vector_col, F.lit(None).cast("array<float>"))
    vec, text = F.col(vector_col), F.col(text_col) if text_col in queries.columns else F.lit(None).cast("string")
    need = _missing(vec) & _has_text(text)
    if model is None:
        if queries.select(need.alias("need")).where("need").limit(1).count():
            raise ValueError("a text query needs an embedding model")
        return queries
    return queries.withColumn(vector_col, F.coalesce(
        F.when(~need, vec), embed_column(model, text, need)))
