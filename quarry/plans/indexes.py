"""Index choice by name (the reference's index helpers, SRCH-2/3/4/6/8).

An :class:`IndexSpec` names an index type the way the reference's users do;
:func:`build_index` turns it into the Spark structure that serves it:

* ``FLAT`` -> no index: exact search (SRCH-1).
* ``IVF_FLAT`` / ``IVF_SQ8`` / ``IVF_PQ`` -> :func:`quarry.operators.ivf.build_ivf`.
* ``HNSW``, ``AUTOINDEX``, ``DISKANN``, ``GPU_IVF_FLAT``, ``GPU_IVF_PQ`` promise the
  same contract (approximate top-k) and are served by IVF_FLAT (``GPU_IVF_PQ``
  by IVF_PQ) with the ``nlist`` given.
* ``SPARSE_INVERTED_INDEX`` / ``SPARSE_WAND`` -> the BM25 index (SRCH-6); their
  ``drop_ratio_search`` is kept for searches (SRCH-8).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators.bm25 import build_bm25_index
from ..operators.ivf import build_ivf

# Index type names and the defaults of the reference's helpers.
DENSE_TYPES = ("FLAT", "IVF_FLAT", "IVF_SQ8", "IVF_PQ", "HNSW", "AUTOINDEX", "DISKANN", "GPU_IVF_FLAT", "GPU_IVF_PQ")
SPARSE_TYPES = ("SPARSE_INVERTED_INDEX", "SPARSE_WAND")
NLIST = 1024


@dataclass(frozen=True)
class IndexSpec:
    index_type: str = "AUTOINDEX"
    metric: str = "cosine"
    field_name: str = "embedding"
    params: dict = field(default_factory=dict)

    @classmethod
    def flat(cls, metric="cosine"):
        return cls("FLAT", metric)

    @classmethod
    def ivf_flat(cls, nlist=NLIST, metric="cosine"):
        return cls("IVF_FLAT", metric, params={"nlist": nlist})

    @classmethod
    def ivf_sq8(cls, nlist=NLIST, metric="cosine"):
        return cls("IVF_SQ8", metric, params={"nlist": nlist})

    @classmethod
    def ivf_pq(cls, nlist=NLIST, m=8, nbits=8, metric="cosine"):
        return cls("IVF_PQ", metric, params={"nlist": nlist, "m": m, "nbits": nbits})

    @classmethod
    def hnsw(cls, nlist=NLIST, metric="cosine"):
        return cls("HNSW", metric, params={"nlist": nlist})

    @classmethod
    def auto(cls, nlist=NLIST, metric="cosine"):
        return cls("AUTOINDEX", metric, params={"nlist": nlist})

    @classmethod
    def sparse_inverted(cls, field_name="sparse", drop_ratio_search=0.0):
        return cls("SPARSE_INVERTED_INDEX", "bm25", field_name, {"drop_ratio_search": drop_ratio_search})

    @classmethod
    def sparse_wand(cls, field_name="sparse", drop_ratio_search=0.0):
        return cls("SPARSE_WAND", "bm25", field_name, {"drop_ratio_search": drop_ratio_search})

    @property
    def kind(self) -> str:
        t = self.index_type.strip().upper()
        if t not in DENSE_TYPES + SPARSE_TYPES:
            raise ValueError(f"unknown index type {self.index_type!r}")
        return t


def build_index(corpus: DataFrame, spec: IndexSpec, text_col: str = "content", schema=None):
    """The structure serving ``spec``: ``None`` (exact), an ``IvfIndex`` or a
    ``Bm25Index`` (with ``drop_ratio_search`` set on it).  ``schema`` (a
    ``CollectionSpec``) brings the analyzer of ``text_col``."""
    t = spec.kind
    if t == "FLAT":
        return None
    if t in SPARSE_TYPES:
        index = build_bm25_index(corpus, text_col, analyzer=schema.analyzer_of(text_col) if schema is not None else None)
        index.drop_ratio_search = float(spec.params.get("drop_ratio_search", 0.0))
        return index
    vec = spec.field_name
    nlist = int(spec.params.get("nlist", NLIST))
    kind = {"IVF_SQ8": "sq8", "IVF_PQ": "pq", "GPU_IVF_PQ": "pq"}.get(t, "flat")
    return build_ivf(corpus, nlist=nlist, metric=spec.metric, kind=kind, m=int(spec.params.get("m", 8)),
                     nbits=int(spec.params.get("nbits", 8)), vector_col=vec)
