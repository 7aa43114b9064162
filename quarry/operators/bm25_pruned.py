"""BM25 top-k in two passes with term bounds (SRCH-7 on large collections).

:func:`quarry.operators.bm25.bm25_search` sums every (query, document) pair
that shares a term; the common terms of a query bring most of these rows and
hardly any score.  Here a table holds each term's highest document weight:

1. The terms of a query that can give most are scored first, until they occur
   in several times ``k`` documents; the best ``k`` of those are then scored in
   full.  The lowest of these scores is the query's threshold: the k-th best of
   all documents is no lower.
2. The terms that together cannot reach the threshold are set aside.  A
   document that holds none of the others cannot win, so only the others are
   joined with their postings, and of the documents found only those stay that
   the terms set aside could still lift to the threshold.  These terms are then
   looked up in the document's own row: those of the upper half first, then
   those of the lower half for the documents still open.

Documents are written once, a row each.  Each pass deals these rows with the
queries' terms (:mod:`quarry.operators.bm25_rows`): no posting and no pair of a
query and a document is shuffled or written.

The hits and scores are those of the plain search.  A query with fewer than
``k`` documents in the first pass has no threshold and sets nothing aside.
Nothing but the hits is bounded by a parameter: thresholds come from the data.
A filter is applied once, when the documents are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bm25_doc_weight
from ..session import broadcast_budget, materialize
from .bm25 import Bm25Index, query_terms, scoped_rows
from .bm25_rows import DOC, SLACK, one_row_each, packed, scored_rows
from .knn import attach_columns, scope_corpus
from .topk import apply_threshold, rank_topk

# Documents that the first pass looks for, as a multiple of k.
LEAD = 8


def doc_weights(index: Bm25Index) -> DataFrame:
    """``partition_name, id, term, part``: the document side of each posting's
    score.  Rows that repeat a key are one document and are summed (postings
    lie by document, so the sum needs no exchange).  Rows without an id are
    never hits."""
    part = bm25_doc_weight("tf", "dl", F.lit(float(index.avgdl) or 1.0), index.k1, index.b)
    return (index.postings.where(F.col("id").isNotNull() & F.col("partition_name").isNotNull())
            .groupBy(*DOC, "term").agg(F.sum(part).alias("part")))


def term_bounds(weights: DataFrame) -> DataFrame:
    """``term, df, bound``: the highest document weight of every term."""
    return weights.groupBy("term").agg(F.count("*").alias("df"), F.max("part").alias("bound"))


def _small(df: DataFrame, text: str | None = None) -> DataFrame:
    """``df`` marked for broadcast if its measured bytes fit the session's budget."""
    row = F.lit(64) if text is None else F.octet_length(text) + 64
    size = df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= broadcast_budget(df.sparkSession) else df


def weight_rows(index: Bm25Index, weights: DataFrame | None = None) -> DataFrame:
    """:func:`doc_weights` as one row for each document."""
    if weights is not None or index.counted is None:
        return packed(doc_weights(index) if weights is None else weights)
    return one_row_each(index.document_rows().where(F.col("id").isNotNull() & F.col("partition_name").isNotNull()))


def entries(rows: DataFrame) -> DataFrame:
    """``partition_name, id, term, part`` of rows of documents."""
    return rows.select(*DOC, F.explode(F.arrays_zip("terms", "parts")).alias("e")).select(
        *DOC, F.col("e.terms").alias("term"), F.col("e.parts").alias("part"))


def pruned_parts(index: Bm25Index, queries: DataFrame, kk: int, *, weights: DataFrame | None = None,
                 text_col: str = "text", pred=None, partitions=None, corpus: DataFrame | None = None,
                 drop_ratio: float | None = None) -> dict[str, DataFrame]:
    """The tables of both passes: ``terms`` (all, with ``lead``), ``judged``
    (with ``aside`` and its lower half, ``low``), ``weights``, ``open`` and
    ``halved`` (documents that can still win before and after the upper half)
    and ``candidates`` (full scores; the best of each query and task)."""
    # Filtered before they are written: the corpus is read once for all passes, and bounds are those of possible hits.
    rows = materialize(scoped_rows(weight_rows(index, weights), pred, partitions, corpus), "bm25-weights")
    ratio = index.drop_ratio_search if drop_ratio is None else drop_ratio
    weighted = materialize(query_terms(index, queries, text_col, ratio), "bm25-query-terms")
    # Bounds of the terms asked for; the others are not counted.
    bounds = term_bounds(entries(rows).join(_small(weighted.select("term").distinct(), "term"), "term", "left_semi"))
    most = (F.col("weight") * F.col("bound")).alias("most")
    best_first = Window.partitionBy("query_id").orderBy(F.col("most").desc(), "term")
    before = F.coalesce(F.sum("df").over(best_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    terms = materialize(
        weighted.join(bounds, "term")
        .select("query_id", "term", "weight", "df", most).withColumn("lead", before < LEAD * kk), "bm25-led-terms")

    leaders = scored_rows(rows, terms.withColumn("kind", (~F.col("lead")).cast("int")), kk, "lead")
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id", "partition_name")
    floors = (leaders.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= kk).groupBy("query_id")
              .agg(F.count("*").alias("n"), F.min("full").alias("floor")).where(F.col("n") >= kk)
              .select("query_id", "floor"))

    least_first = Window.partitionBy("query_id").orderBy("most", F.col("term").desc())
    reach = F.sum("most").over(least_first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    of_query = Window.partitionBy("query_id")
    judged = terms.join(floors, "query_id", "left").withColumn("reach", reach).withColumn(
        "aside", F.coalesce(F.col("reach") < F.col("floor") - SLACK, F.lit(False))).withColumn(
        "low", F.row_number().over(least_first) * 2 <= F.sum(F.col("aside").cast("int")).over(of_query))
    # What the terms left out at each step could add: all that are set aside, then their lower half.
    rest = lambda out: F.coalesce(F.max(F.when(out, F.col("reach"))).over(of_query), F.lit(0.0))
    judged = materialize(judged.withColumns({
        "kind": F.when(~F.col("aside"), 0).when(~F.col("low"), 1).otherwise(2),
        "rest0": rest(F.col("aside")), "rest1": rest(F.col("aside") & F.col("low"))}), "bm25-judged-terms")
    steps = {name: scored_rows(rows, judged, kk, step)
             for name, step in (("open", "open"), ("halved", "halved"), ("candidates", "best"))}
    return {"terms": terms, "judged": judged, "weights": entries(rows), **steps}


def bm25_pruned_search(index: Bm25Index, queries: DataFrame, k: int = 10, offset: int = 0, *,
                       weights: DataFrame | None = None, text_col: str = "text", pred=None, partitions=None,
                       corpus: DataFrame | None = None, threshold: float | None = 0.0,
                       drop_ratio: float | None = None, columns=None) -> DataFrame:
    """The rows of :func:`quarry.operators.bm25.bm25_search`, by two passes.
    ``weights`` are the written :func:`doc_weights` of the same index; else
    its documents are read."""
    parts = pruned_parts(index, queries, k + offset, weights=weights, text_col=text_col, pred=pred, partitions=partitions,
                         corpus=corpus, drop_ratio=drop_ratio)
    ranked = apply_threshold(rank_topk(parts["candidates"], k, offset).withColumn("distance", F.col("score")), threshold)
    ranked = ranked.select("query_id", "rank", "partition_name", "id", "score", "distance")
    if corpus is None:
        return ranked
    cols = [c for c in corpus.columns if c not in ("embedding", "sparse")] if columns is None else list(columns)
    return attach_columns(ranked, scope_corpus(corpus, None, partitions), cols)
