"""BM25 full-text index and top-k (SRCH-6, SRCH-7, SRCH-8; SURVEY D5).

Index build: every document is tokenised once and its terms are counted where
it is read, in its sorted tokens.  The counts, a row for each document, are
written to the shared folder, and the term table and the collection
statistics (N and avgdl, one row) are read from there.  Texts are shuffled
only when the corpus lies in fewer files than there are cores.

Search: query terms (with repeats counted) join the term table for idf; per
(query, doc) sum of ``idf * qtf * tf*(k1+1) / (tf + k1*(1-b+b*dl/avgdl))``;
per-query top-k.  Filters cut the documents before anything is scored.  An index
of this session has a row for each document, and the sums are made where these
rows are (:mod:`quarry.operators.bm25_rows`).  A saved index has its postings
only: the query terms join them on ``term``.  They are broadcast when their
measured bytes fit the budget, so postings stay where their documents are;
beyond it the join shuffles on the term and AQE splits common ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import BM25_B, BM25_K1, analyze, bm25_doc_weight, idf
from ..session import broadcast_budget, materialize
from .bm25_rows import DOC, one_row_each, scored_rows
from .knn import attach_columns, scope_corpus
from .topk import apply_threshold, rank_topk

STATS = "n_docs long, avgdl double, k1 double, b double, analyzer string, drop_ratio_search double"


@dataclass
class Bm25Index:
    postings: DataFrame  # term, partition_name, id, tf, dl
    terms: DataFrame  # term, df, cf
    n_docs: int
    avgdl: float
    k1: float = BM25_K1
    b: float = BM25_B
    analyzer: str | None = None
    drop_ratio_search: float = 0.0  # index-level default of SRCH-8
    counted: DataFrame | None = None  # partition_name, id, dl, terms, tfs; an index of this session only

    def document_rows(self) -> DataFrame:
        """``partition_name, id, terms, parts``: a row for each row counted,
        with the document side of each term's score."""
        part = lambda tf: bm25_doc_weight(tf, "dl", F.lit(float(self.avgdl) or 1.0), self.k1, self.b)
        return self.counted.select(*DOC, "terms", F.transform("tfs", part).alias("parts"))

    def write(self, root: str, n_files: int | None = None) -> None:
        """Persist the index; postings are clustered by term so a search
        that names its terms reads few row groups."""
        spark = self.postings.sparkSession
        by = ("term", "partition_name", "id")  # not the term alone: a common one is many files
        post = self.postings.repartitionByRange(n_files, *by) if n_files else self.postings
        post.sortWithinPartitions(*by).write.mode("error").parquet(f"{root}/postings")
        self.terms.write.mode("error").parquet(f"{root}/terms")
        self._stats(spark).coalesce(1).write.mode("error").json(f"{root}/stats")

    def _stats(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(self.n_docs, self.avgdl, self.k1, self.b, self.analyzer, self.drop_ratio_search)], STATS)

    @staticmethod
    def _from(postings: DataFrame, terms: DataFrame, st) -> "Bm25Index":
        return Bm25Index(postings, terms, int(st["n_docs"]), float(st["avgdl"]), float(st["k1"]), float(st["b"]),
                         st["analyzer"], float(st["drop_ratio_search"] or 0.0))

    def save_table(self, name: str, n_buckets: int, path: str | None = None) -> None:
        """Persist as catalog tables: postings bucketed by document key and
        sorted by term inside each bucket.  A search over the saved index
        keeps the in-session plan: the bucketed scan reports its document
        partitioning, so the per-(query, doc) sums run without an exchange,
        and the pushed term list skips row groups inside each bucket."""
        spark = self.postings.sparkSession
        def write(df, table, bucketed=False):
            w = df.write.mode("error")
            if bucketed:
                w = w.bucketBy(n_buckets, "partition_name", "id").sortBy("term")
            if path:
                w = w.option("path", f"{path}/{table}")
            w.saveAsTable(f"{name}_{table}")
        write(self.postings, "postings", bucketed=True)
        write(self.terms, "terms")
        write(self._stats(spark), "stats")

    @staticmethod
    def from_table(spark: SparkSession, name: str) -> "Bm25Index":
        return Bm25Index._from(spark.table(f"{name}_postings"), spark.table(f"{name}_terms"),
                               spark.table(f"{name}_stats").first())

    @staticmethod
    def read(spark: SparkSession, root: str) -> "Bm25Index":
        return Bm25Index._from(spark.read.parquet(f"{root}/postings"), spark.read.parquet(f"{root}/terms"),
                               spark.read.schema(STATS).json(f"{root}/stats").first())


def dealt_out(corpus: DataFrame) -> DataFrame:
    """``corpus``, its rows dealt over all cores when it lies in fewer files
    than there are cores: a file of one row group is one task."""
    cores, files = corpus.sparkSession.sparkContext.defaultParallelism, corpus.inputFiles()
    return corpus.repartition(cores) if 0 < len(files) < cores else corpus


def count_terms(corpus: DataFrame, text_col: str, analyzer: str | None) -> DataFrame:
    """``partition_name, id, dl, terms, tfs``: a row for each row, its distinct
    terms and how often each occurs, counted in its sorted tokens: nothing is shuffled."""
    rows = corpus.select("partition_name", "id", F.sort_array(F.coalesce(
        analyze(text_col, analyzer), F.array().cast("array<string>"))).alias("toks"))
    new = lambda i: (i == 1) | (F.element_at("toks", i) != F.element_at("toks", F.greatest(i - 1, F.lit(1))))
    rows = rows.withColumn("at", F.when(F.size("toks") > 0, F.filter(F.sequence(F.lit(1), F.size("toks")), new))
                           .otherwise(F.array().cast("array<int>")))
    return rows.select(
        "partition_name", "id", F.size("toks").cast("long").alias("dl"),
        F.transform("at", lambda i: F.element_at("toks", i)).alias("terms"),
        F.transform("at", lambda i, j: F.coalesce(F.get("at", j + 1), F.size("toks") + 1) - i).alias("tfs"))


def build_bm25_index(corpus: DataFrame, text_col: str = "content", *, k1: float = BM25_K1, b: float = BM25_B,
                     analyzer: str | None = None) -> Bm25Index:
    """SRCH-6: postings, term table and collection statistics.

    ``avgdl`` is ``sum(tf) / N``; N counts every row of ``corpus`` (a row
    without text has length 0) whatever filter a later search applies (D5).
    The postings go to the folder in ``spark.checkpoint.dir``;
    :meth:`Bm25Index.write` and :meth:`Bm25Index.save_table` keep an index
    for good.
    """
    counted = materialize(count_terms(dealt_out(corpus.select("partition_name", "id", text_col)), text_col, analyzer),
                          "bm25")
    st = counted.agg(F.count("*").alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("t")).first()

    def entries(rows: DataFrame) -> DataFrame:
        return (rows.select("partition_name", "id", "dl", F.explode(F.arrays_zip("terms", "tfs")).alias("e"))
                .select(F.col("e.terms").alias("term"), "partition_name", "id", F.col("e.tfs").cast("long").alias("tf"), "dl"))

    # Clustered by document, so a search's sums need no exchange; rows are shuffled, not their entries.
    postings = entries(counted.repartition("partition_name", "id"))
    terms = (entries(counted).groupBy("term")
             .agg(F.count(F.lit(1)).cast("long").alias("df"), F.sum("tf").cast("long").alias("cf")))
    return Bm25Index(postings, terms, int(st["n"]), float(st["t"]) / st["n"] if st["n"] else 0.0, k1, b, analyzer,
                     counted=counted)


def query_terms(index: Bm25Index, queries: DataFrame, text_col: str = "text", drop_ratio: float = 0.0) -> DataFrame:
    """Weighted terms per query: ``query_id, term, qtf, weight = idf * qtf``.

    Terms absent from the collection contribute nothing and are left out.
    ``drop_ratio`` (SRCH-8) removes the ``floor(r * n)`` lowest-weight terms
    of each query (ties: term ascending).
    """
    if not 0.0 <= drop_ratio < 1.0:
        raise ValueError("drop_ratio must be in [0, 1)")
    qt = (queries.where(F.col(text_col).isNotNull() & (F.trim(F.col(text_col)) != ""))
          .select("query_id", F.explode(analyze(text_col, index.analyzer)).alias("term"))
          .groupBy("query_id", "term").agg(F.count(F.lit(1)).cast("long").alias("qtf")))
    words, held = qt.select("term").distinct(), index.terms.select("term", "df")
    size = words.agg(F.coalesce(F.sum(F.octet_length("term") + 64), F.lit(0))).first()[0]
    if size <= broadcast_budget(qt.sparkSession):  # other terms are not counted
        held = held.join(F.broadcast(words), "term", "left_semi")
    qt = qt.join(held, "term")
    qt = qt.withColumn("weight", idf(F.lit(float(index.n_docs)), F.col("df")) * F.col("qtf"))
    if drop_ratio > 0:
        by_q = Window.partitionBy("query_id")
        order = by_q.orderBy(F.col("weight").asc(), F.col("term").asc())
        qt = (qt.withColumn("_n", F.count(F.lit(1)).over(by_q))
              .withColumn("_pos", F.row_number().over(order))
              .where(F.col("_pos") > F.floor(F.col("_n") * F.lit(float(drop_ratio))))
              .drop("_n", "_pos"))
    return qt.select("query_id", "term", "qtf", "weight")


def scoped_rows(rows: DataFrame, pred=None, partitions=None, corpus: DataFrame | None = None) -> DataFrame:
    """Those of ``rows`` (with ``partition_name, id``) that a search by these filters ranks."""
    if partitions:
        names = [partitions] if isinstance(partitions, str) else list(partitions)
        rows = rows.where(F.col("partition_name").isin(names))
    if pred is not None and not (isinstance(pred, str) and not pred.strip()):
        if corpus is None:
            raise ValueError("a predicate on document columns needs the corpus")
        rows = rows.join(scope_corpus(corpus, pred, partitions).select(*DOC), DOC, "left_semi")
    return rows


def bm25_candidates(index: Bm25Index, queries: DataFrame, *, text_col: str = "text", pred=None,
                    partitions=None, corpus: DataFrame | None = None, drop_ratio: float | None = None) -> DataFrame:
    """Every (query, doc) sharing at least one term, with its BM25 score
    (the lexical join JOI-4: query terms join postings on ``term``).
    ``drop_ratio=None`` uses the index's ``drop_ratio_search``."""
    ratio = index.drop_ratio_search if drop_ratio is None else drop_ratio
    qt = query_terms(index, queries, text_col, ratio)
    post = scoped_rows(index.postings, pred, partitions, corpus)
    contrib = F.col("weight") * bm25_doc_weight("tf", "dl", F.lit(float(index.avgdl) or 1.0), index.k1, index.b)
    size = qt.agg(F.coalesce(F.sum(F.octet_length("term") + 64), F.lit(0))).first()[0]
    if size <= broadcast_budget(qt.sparkSession):
        qt = F.broadcast(qt)
    scored = (qt.join(post, "term")
              .groupBy("query_id", "partition_name", "id")
              .agg(F.sum(contrib).alias("score")))
    return scored.withColumn("distance", F.col("score"))


def bm25_search(index: Bm25Index, queries: DataFrame, k: int = 10, offset: int = 0, *, text_col: str = "text",
                pred=None, partitions=None, corpus: DataFrame | None = None, threshold: float | None = 0.0,
                drop_ratio: float | None = None, columns=None) -> DataFrame:
    """SRCH-7: top-k documents per query by BM25.

    Result: ``query_id, rank, partition_name, id, score, distance`` plus
    ``columns`` (needs ``corpus``; default none when no corpus is given).
    """
    if index.counted is None:
        cands = bm25_candidates(index, queries, text_col=text_col, pred=pred, partitions=partitions,
                                corpus=corpus, drop_ratio=drop_ratio)
    else:
        terms = materialize(query_terms(index, queries, text_col, index.drop_ratio_search if drop_ratio is None else drop_ratio),
                            "bm25-query-terms")
        cands = scored_rows(one_row_each(scoped_rows(index.document_rows(), pred, partitions, corpus)), terms, k + offset)
    ranked = rank_topk(cands, k, offset).withColumn("distance", F.col("score"))
    ranked = apply_threshold(ranked, threshold)
    ranked = ranked.select("query_id", "rank", "partition_name", "id", "score", "distance")
    if corpus is None:
        return ranked
    cols = [c for c in corpus.columns if c not in ("embedding", "sparse")] if columns is None else list(columns)
    return attach_columns(ranked, scope_corpus(corpus, None, partitions), cols)
