"""Request objects and the search dispatch (SRCH-0, SRCH-5, LIM-1, D19).

A request is an immutable set of keyword defaults; the dispatch turns it
into one of the DataFrame plans of :mod:`quarry.operators`.  Searches take a
*table* of queries (``query_id`` plus ``text`` and/or ``vector``), so one
plan answers all of them.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.embed import embed_queries
from ..operators import tables
from ..operators.bm25 import Bm25Index, bm25_search, build_bm25_index
from ..operators.hybrid import hybrid_search
from ..operators.ivf import IvfIndex, ivf_search
from ..operators.knn import vector_search
from ..sources.schema import CollectionSpec
from ..sources.segments import default_columns


class SearchType(Enum):
    VECTOR = "vector"
    BM25 = "bm25"
    HYBRID = "hybrid"

    @classmethod
    def parse(cls, name, default: "SearchType | None" = None) -> "SearchType":
        """Names match trimmed and in any case; empty -> ``default`` (or an
        error without one); unknown -> error."""
        if isinstance(name, SearchType):
            return name
        if name is None or not str(name).strip():
            if default is None:
                raise ValueError("search type is empty")
            return default
        key = str(name).strip().upper()
        for t in cls:
            if t.name == key:
                return t
        raise ValueError(f"unknown search type {name!r}; expected VECTOR, BM25 or HYBRID")


# Index names that promise approximate top-k; all are served by IVF here.
APPROXIMATE_INDEXES = ("IVF_FLAT", "IVF_SQ8", "IVF_PQ", "HNSW", "AUTOINDEX", "DISKANN", "GPU_IVF_FLAT", "GPU_IVF_PQ")


@dataclass(frozen=True)
class SearchRequest:
    search_type: SearchType = SearchType.VECTOR
    top_k: int = 10
    offset: int = 0
    filter: object = None  # SQL predicate string or Column
    partitions: tuple = ()
    similarity_threshold: float = 0.0
    output_fields: tuple = ()  # empty -> default columns
    metric: str | None = None  # not given: the index's metric, cosine without an index
    follows_index: bool = field(init=False, default=False)  # whether no metric was given
    nprobe: int = 8
    drop_ratio: float | None = None  # None: the index's drop_ratio_search
    vector_weight: float = 0.5
    text_weight: float = 0.5
    norm: str = "arctan"
    text_col: str = "text"
    vector_col: str = "vector"
    corpus_vector_col: str = "embedding"
    params: dict = field(default_factory=dict)

    def __post_init__(self):
        object.__setattr__(self, "follows_index", self.metric is None)
        object.__setattr__(self, "metric", self.metric or "cosine")

    def with_params(self) -> "SearchRequest":
        """``params`` by their index names (``nprobe``, ``drop_ratio_search``)
        count over the fields of the same meaning."""
        names = {"nprobe": "nprobe", "drop_ratio_search": "drop_ratio", "drop_ratio": "drop_ratio",
                 "metric": "metric", "metric_type": "metric"}
        unknown = set(self.params) - set(names)
        if unknown:
            raise ValueError(f"unknown search parameters: {sorted(unknown)}")
        return replace(self, params={}, **{names[k]: v for k, v in self.params.items()})

    @classmethod
    def of(cls, top_k: int = 10, **kw) -> "SearchRequest":
        return cls(SearchType.VECTOR, top_k, **kw)

    @classmethod
    def bm25(cls, top_k: int = 10, **kw) -> "SearchRequest":
        return cls(SearchType.BM25, top_k, **kw)

    @classmethod
    def hybrid(cls, top_k: int = 10, vector_weight: float = 0.5, text_weight: float = 0.5, **kw) -> "SearchRequest":
        return cls(SearchType.HYBRID, top_k, vector_weight=vector_weight, text_weight=text_weight, **kw)

    @property
    def is_vector_search(self) -> bool:
        return self.search_type is SearchType.VECTOR

    @property
    def is_bm25_search(self) -> bool:
        return self.search_type is SearchType.BM25

    @property
    def is_hybrid_search(self) -> bool:
        return self.search_type is SearchType.HYBRID

    @property
    def has_partitions(self) -> bool:
        return bool(self.partitions)

    def columns(self):
        return list(self.output_fields) if self.output_fields else None


@dataclass(frozen=True)
class QueryRequest:
    filter: object = None
    partition: str | None = None
    offset: int = 0
    limit: int = 100
    output_fields: tuple = ()


def query_errors(queries: DataFrame, request: SearchRequest, has_model: bool = False,
                 corpus: DataFrame | None = None) -> DataFrame:
    """Queries that cannot run, with the reason: ``query_id, error``.
    The search itself skips them; good queries are unaffected.  With
    ``corpus``, vectors of a length that none of its vectors has are named too."""
    text = F.col(request.text_col) if request.text_col in queries.columns else F.lit(None).cast("string")
    vec = F.col(request.vector_col) if request.vector_col in queries.columns else F.lit(None).cast("array<float>")
    no_text = text.isNull() | (F.trim(text) == "")
    no_vec = vec.isNull() | (F.size(vec) == 0)
    if request.search_type is SearchType.VECTOR:
        err = F.when(no_vec & no_text, F.lit("no vector and no text")).when(
            no_vec & F.lit(not has_model), F.lit("text query needs an embedding model"))
    else:
        err = F.when(no_text, F.lit("text is empty")).when(
            F.lit(request.search_type is SearchType.HYBRID) & no_vec & F.lit(not has_model),
            F.lit("text query needs an embedding model"))
    if corpus is not None and request.search_type is not SearchType.BM25:
        held = corpus.agg(F.collect_set(F.size(request.corpus_vector_col))).scalar()  # lengths, not vectors
        queries = queries.withColumn("__held", held)
        wrong = ~no_vec & ~F.array_contains("__held", F.size(vec))
        err = F.when(err.isNotNull(), err).when(wrong, F.concat(
            F.lit("vector has "), F.size(vec), F.lit(" dimensions, the corpus has "),
            F.array_join(F.array_sort(F.filter("__held", lambda n: n > 0)), ", ")))
    return queries.select("query_id", err.alias("error")).where(F.col("error").isNotNull())


def search(corpus: DataFrame, queries: DataFrame, request: SearchRequest = SearchRequest(), *,
           bm25_index: Bm25Index | None = None, ivf_index: IvfIndex | None = None, model=None,
           corpus_text_col: str = "content", spec: CollectionSpec | None = None) -> DataFrame:
    """SRCH-0: run ``request`` for every row of ``queries``.

    VECTOR (and HYBRID's dense branch) uses the IVF index when one is given
    (approximate, ``nprobe``), else exact search; a text query is embedded first when a model is
    given (SRCH-5).  BM25 and HYBRID use ``bm25_index`` or build one from
    ``corpus``.  ``spec`` names the columns returned by default (fields not
    marked excluded) and the analyzer of a BM25 index built here.  A metric
    other than the given index's is an error.
    """
    follows = request.follows_index and not {"metric", "metric_type"} & set(request.params)
    request = request.with_params()
    if ivf_index is not None and not follows and request.metric != ivf_index.metric:
        raise ValueError(f"the request's metric {request.metric!r} is not the index's {ivf_index.metric!r}")
    metric = ivf_index.metric if ivf_index is not None else request.metric
    columns = request.columns()
    if columns is None and spec is not None:
        columns = default_columns(corpus, spec)
    t = SearchType.parse(request.search_type, SearchType.VECTOR)
    common = dict(pred=request.filter, partitions=list(request.partitions) or None)
    if t is not SearchType.BM25:
        queries = embed_queries(queries, model, request.text_col, request.vector_col)
    if t is SearchType.VECTOR:
        if ivf_index is not None:
            return ivf_search(ivf_index, queries, request.top_k, request.offset, nprobe=request.nprobe,
                              threshold=request.similarity_threshold, columns=columns,
                              query_vector_col=request.vector_col, **common)
        return vector_search(corpus, queries, request.top_k, request.offset, metric=metric,
                             vector_col=request.corpus_vector_col,
                             threshold=request.similarity_threshold, columns=columns,
                             query_vector_col=request.vector_col, **common)
    index = bm25_index or build_bm25_index(corpus, corpus_text_col,
                                           analyzer=spec.analyzer_of(corpus_text_col) if spec is not None else None)
    if t is SearchType.BM25:
        return bm25_search(index, queries, request.top_k, request.offset, text_col=request.text_col,
                           corpus=corpus, threshold=request.similarity_threshold, drop_ratio=request.drop_ratio,
                           columns=columns, **common)
    return hybrid_search(corpus, index, queries, request.top_k, request.offset,
                         weights=(request.vector_weight, request.text_weight), norm=request.norm,
                         metric=metric, threshold=request.similarity_threshold,
                         columns=columns, text_col=request.text_col,
                         query_vector_col=request.vector_col, ivf_index=ivf_index, nprobe=request.nprobe,
                         vector_col=request.corpus_vector_col, drop_ratio=request.drop_ratio,
                         **common)


@dataclass(frozen=True)
class SearchOutcome:
    """What a search gives back: the hits, and the queries that could not run."""

    hits: DataFrame
    errors: DataFrame  # query_id, error


def search_with_errors(corpus: DataFrame, queries: DataFrame, request: SearchRequest = SearchRequest(), *,
                       model=None, **kw) -> SearchOutcome:
    """:func:`search`, and the bad queries with their reasons beside it."""
    checked = replace(request, search_type=SearchType.parse(request.search_type, SearchType.VECTOR))
    return SearchOutcome(search(corpus, queries, request, model=model, **kw),
                         query_errors(queries, checked, has_model=model is not None, corpus=corpus))


def run_query(base: DataFrame, request: QueryRequest = QueryRequest()) -> DataFrame:
    """LIM-1 through a request object."""
    return tables.query(base, request.filter, request.partition, request.offset, request.limit,
                        list(request.output_fields) or None)
