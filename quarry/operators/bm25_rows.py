"""BM25 scores by document rows (SRCH-7 over an index of this session).

A document is one row: its distinct terms and their weights (the document side
of the score).  Documents are dealt once, with the terms of the queries beside
them, as :mod:`quarry.operators.knn` deals vectors: lots of queries, and
stripes of documents that a task reads as a stream in the order of ids.  A task
sums the shared terms of a slice of documents in numpy and keeps the best rows
of each query, so neither postings nor pairs of a query and a document are
shuffled, and a task's memory depends on the lot and the slice only.

Terms have a ``kind``.  Those of kind 0 say which documents a query meets.  With
a ``floor`` for each query, documents that the other kinds cannot lift to it
(``rest0``, ``rest1``: what kinds 1 and 2, or 2 alone, can add at most) are left
out before these are looked up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import round_score
from ..session import broadcast_budget
from .knn import KEPT, LEAST_ROWS, QUERY_ROWS

DOC = ["partition_name", "id"]
# Scores are ranked after rounding to 6 places; what differs by less is a tie.
SLACK = 2e-6
# Documents times queries, and shared terms, of a slice.
_MAX_CELLS = 4_000_000
_MAX_LINKS = 2_000_000
# Documents of a stripe at least; terms of a lot.
STRIPE_ROWS = 4_096
LOT_TERMS = 1 << 20


def one_row_each(rows: DataFrame) -> DataFrame:
    """``rows`` (``partition_name, id, terms, parts``) with the rows of one key
    made one, their weights summed.  Only keys that occur again are exploded."""
    twice = rows.groupBy(*DOC).agg(F.count("*").alias("n")).where("n > 1").select(
        *(F.col(c).alias(f"_{c}") for c in DOC))
    size = twice.agg(F.coalesce(F.sum(sum(F.coalesce(F.octet_length(f"_{c}"), F.lit(0)) for c in DOC) + 64), F.lit(0))).first()[0]
    if not size:
        return rows
    if size <= broadcast_budget(rows.sparkSession):
        twice = F.broadcast(twice)
    same = F.lit(True)
    for c in DOC:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    summed = (rows.join(twice, same, "left_semi").select(*DOC, F.explode(F.arrays_zip("terms", "parts")).alias("e"))
              .groupBy(*DOC, F.col("e.terms").alias("term")).agg(F.sum("e.parts").alias("part")))
    return rows.join(twice, same, "left_anti").select(*DOC, "terms", "parts").unionByName(packed(summed))


def packed(weights: DataFrame) -> DataFrame:
    """A row for each document from ``partition_name, id, term, part``."""
    rows = weights.groupBy(*DOC).agg(F.collect_list(F.struct("term", "part")).alias("e"))
    return rows.select(*DOC, F.col("e.term").alias("terms"), F.col("e.part").alias("parts"))


class _Asked:
    """The terms of a lot's queries; of each kind, the queries of every word."""

    def __init__(self, table: pa.Table):
        of_query = table.column("query_id").combine_chunks().dictionary_encode()
        of_term = table.column("term").combine_chunks().dictionary_encode()
        self.ids, self.words = of_query.dictionary, of_term.dictionary
        q, word = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (of_query, of_term))
        weight, kind = table.column("weight").to_numpy(), table.column("kind").to_numpy()
        self.n, self.links = len(self.ids), []
        for k in range(3):
            own = np.flatnonzero(kind == k)
            own = own[np.argsort(word[own], kind="stable")]
            start = np.searchsorted(word[own], np.arange(len(self.words) + 1))
            self.links.append((start, np.diff(start), q[own], weight[own]))
        self.count = sum(x[1] for x in self.links)
        self.floor, self.rest = np.full(self.n, -np.inf), np.zeros((2, self.n))
        if "floor" in table.schema.names:
            floor = table.column("floor").to_numpy()
            self.floor[q] = np.where(np.isnan(floor), -np.inf, floor)
            for j in range(2):
                self.rest[j][q] = table.column(f"rest{j}").to_numpy()

    def pairs(self, kind: int, doc: np.ndarray, word: np.ndarray, part: np.ndarray):
        """Document times query, and the score's share, of the entries' terms of ``kind``."""
        start, count, query, weight = self.links[kind]
        n = count[word]
        entry = np.repeat(np.arange(len(word)), n)
        at = np.arange(len(entry)) + np.repeat(start[word] - np.cumsum(n) + n, n)
        return doc[entry] * self.n + query[at], part[entry] * weight[at]

    def added(self, kind: int, keys: np.ndarray, score: np.ndarray, n_docs: int, doc, word, part) -> np.ndarray:
        """``score`` of the pairs ``keys`` with their terms of ``kind``."""
        if not len(keys) or not len(self.links[kind][2]):
            return score
        held = np.zeros(n_docs, bool)
        held[keys // self.n] = True
        own = held[doc]
        key, share = self.pairs(kind, doc[own], word[own], part[own])
        place = np.full(n_docs * self.n, -1)
        place[keys] = np.arange(len(keys))
        place = place[key]
        hit = place >= 0
        return score + np.bincount(place[hit], share[hit], minlength=len(keys))


class _Best:
    """The best ``kk`` documents of each query so far.  They come in the order
    of ids: of those with the same rounded score an earlier one stays."""

    def __init__(self, n: int, kk: int):
        self.n, self.kk, self.least = n, kk, np.full(n, -np.inf)
        self.pending, self.kept, self.waiting = [], None, 0

    def better(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        return np.flatnonzero(round_score(score) > self.least[q])

    def take(self, q, score, at, *more) -> None:
        self.pending.append((q, round_score(score), at, score, *more))
        self.waiting += len(q)
        if self.waiting > max(1 << 16, self.n * self.kk // 2):
            self.merge()

    def merge(self) -> None:
        if not self.pending:
            return
        found = self.pending + ([self.kept] if self.kept is not None else [])
        found = [np.concatenate(f) for f in zip(*found)]
        order = np.lexsort((found[2], -found[1], found[0]))
        q = found[0][order]
        start = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
        rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
        order, rank = order[rank < self.kk], rank[rank < self.kk]
        self.kept, self.pending, self.waiting = tuple(f[order] for f in found), [], 0
        last = order[rank == self.kk - 1]
        self.least[found[0][last]] = found[1][last]


def _scores(kk: int, step: str):
    """The task, for ``mapInArrow``: the terms of each lot come first, then its documents."""
    names = ["query_id", "partition_name", "id", "score", "full"][:5 if step == "lead" else 4]

    def batch_of(asked: _Asked, q, score, ids, parts, *full) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [asked.ids.take(pa.array(q)), pa.array(parts, pa.string()), pa.array(ids, pa.string()), pa.array(score),
             *map(pa.array, full)], names=names)

    def read(asked: _Asked, best: _Best, batch: pa.RecordBatch, first: int):
        size = pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False)
        word = pc.fill_null(pc.index_in(batch.column("terms").flatten(), value_set=asked.words), -1).to_numpy(zero_copy_only=False)
        own = np.flatnonzero(word >= 0)
        word, doc = word[own], np.repeat(np.arange(batch.num_rows), size)[own]
        part = batch.column("parts").flatten().to_numpy(zero_copy_only=False)[own]
        ids, parts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "partition_name"))
        links = np.concatenate(([0], np.cumsum(np.bincount(doc, asked.count[word], minlength=batch.num_rows))))
        a = 0
        while a < batch.num_rows:
            b = int(np.searchsorted(links, links[a] + _MAX_LINKS, side="right")) - 1
            b = min(max(b, a + 1), a + max(1, _MAX_CELLS // asked.n), batch.num_rows)
            i, j = np.searchsorted(doc, (a, b))
            entries = doc[i:j] - a, word[i:j], part[i:j]
            key, share = asked.pairs(0, *entries)
            score = np.bincount(key, share, minlength=(b - a) * asked.n)
            keys = np.flatnonzero(score)
            score = score[keys]
            if step not in ("plain", "lead"):
                for kind in (1, 2):
                    q = keys % asked.n
                    may = np.flatnonzero(score + asked.rest[kind - 1][q] >= asked.floor[q] - SLACK)
                    keys, score = keys[may], score[may]
                    if step == ("open", "halved")[kind - 1]:
                        break
                    score = asked.added(kind, keys, score, b - a, *entries)
            d, q = np.divmod(keys, asked.n)
            if step in ("open", "halved"):
                yield batch_of(asked, q, score, ids[a + d], parts[a + d])
            else:
                some = best.better(q, score)
                keys, d, q, score = keys[some], d[some], q[some], score[some]
                full = (asked.added(1, keys, score, b - a, *entries),) if step == "lead" else ()
                best.take(q, score, first + a + d, ids[a + d], parts[a + d], *full)
            a = b

    def done(asked: _Asked, best: _Best):
        best.merge()
        if best.kept is not None and len(best.kept[0]):
            q, _, _, score, ids, parts, *full = best.kept
            yield batch_of(asked, q, score, ids, parts, *full)

    def run(batches):
        group, terms, asked, best, first = None, [], None, None, 0
        for batch in batches:
            groups, tags = batch.column("_g").to_numpy(), batch.column("_tag").to_numpy()
            cuts = np.flatnonzero((np.diff(groups) != 0) | (np.diff(tags) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if groups[a] != group:
                    if asked is not None:
                        yield from done(asked, best)
                    group, terms, asked, first = groups[a], [], None, 0
                part = batch.slice(a, b - a)
                if tags[a] == 0:
                    terms.append(part.drop_columns(["terms", "parts"]))
                elif terms:  # without terms nothing is met
                    if asked is None:
                        asked = _Asked(pa.Table.from_batches(terms))
                        best = _Best(asked.n, kk)
                    yield from read(asked, best, part, first)
                    first += part.num_rows
        if asked is not None:
            yield from done(asked, best)

    return run


def scored_rows(rows: DataFrame, terms: DataFrame, kk: int, step: str = "plain") -> DataFrame:
    """``query_id, partition_name, id, score`` of documents that share a term.

    ``rows`` holds one row for each document (:func:`one_row_each`), ``terms`` the
    weighted terms of the queries, written beforehand.  ``plain``: the best
    ``kk`` of each query and stripe by all terms.  ``lead``: those by the terms
    of kind 0, with ``full``, the score by all.  ``best``: as ``plain``, leaving
    out what cannot reach the floor; ``open`` and ``halved`` give all pairs that
    are left before kind 1 and before kind 2."""
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    n_tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * cores)
    if "kind" not in terms.columns:
        terms = terms.withColumn("kind", F.lit(0))
    qid = terms.schema["query_id"].dataType.simpleString()
    most = min(QUERY_ROWS, max(1, KEPT // max(kk, 1)))
    # One-row aggregates as scalar subqueries: no join, and no job while the plan is made.
    n = F.count_distinct("query_id")
    lots = terms.agg(F.greatest(F.lit(1), F.ceil(n / most), F.ceil(F.count("*") / LOT_TERMS),
                                F.least(F.lit(2 * cores), F.ceil(n / LEAST_ROWS))).cast("int")).scalar()
    stripes = rows.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / STRIPE_ROWS)).cast("int")).scalar()

    def sized(df: DataFrame) -> DataFrame:
        return df.withColumn("_lots", lots).withColumn(
            "_stripes", F.least(stripes, F.ceil(F.lit(n_tasks) / F.col("_lots")).cast("int")))

    asked = sized(terms.select("query_id", "term", "weight", "kind", *(c for c in ("floor", "rest0", "rest1") if c in terms.columns)))
    asked = asked.select("*", F.explode(F.sequence(F.lit(0), F.col("_stripes") - 1)).alias("_s")).select(
        (F.pmod(F.xxhash64("query_id"), F.col("_lots")).cast("int") * F.col("_stripes") + F.col("_s")).alias("_g"),
        F.lit(0).alias("_tag"), *(c for c in asked.columns if c not in ("_lots", "_stripes")))
    stripe = F.pmod(F.xxhash64(*DOC), F.col("_stripes")).cast("int")
    rows = sized(rows.select(*DOC, "terms", "parts")).select("*", F.explode(F.sequence(F.lit(0), F.col("_lots") - 1)).alias("_lot"))
    rows = rows.select((F.col("_lot") * F.col("_stripes") + stripe).alias("_g"), F.lit(1).alias("_tag"), *DOC, "terms", "parts")
    dealt = (asked.unionByName(rows, allowMissingColumns=True).repartitionById(n_tasks, F.pmod("_g", F.lit(n_tasks)))
             .sortWithinPartitions("_g", "_tag", "id", "partition_name"))
    more = ", full double" if step == "lead" else ""
    return dealt.mapInArrow(_scores(kk, step), f"query_id {qid}, partition_name string, id string, score double{more}")
