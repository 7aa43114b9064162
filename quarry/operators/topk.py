"""Per-query ranking shared by every search (LIM-2, FLT-5, SURVEY D2).

Order: score rounded to 6 places descending, then id ascending.  The rank
filter is a ``row_number() <= offset + k`` so Spark plans a partial
``WindowGroupLimit`` before the shuffle on ``query_id``: each task sends at
most ``offset + k`` rows per query, whatever the candidate count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY_COLUMNS = ("partition_name", "id")


def rank_topk(scored: DataFrame, k: int, offset: int = 0, *, score_col: str = "score",
              group_col: str = "query_id", id_cols=("id", "partition_name")) -> DataFrame:
    """Keep ranks ``offset+1 .. offset+k`` per group; adds ``rank`` (long) and
    rounds ``score_col`` to 6 places (ties are decided on the rounded value)."""
    if k < 0 or offset < 0:
        raise ValueError("k and offset must be >= 0")
    order = [F.col(score_col).desc()] + [F.col(c).asc() for c in id_cols if c in scored.columns]
    w = Window.partitionBy(group_col).orderBy(*order)
    ranked = (
        scored.withColumn(score_col, F.round(F.col(score_col), 6))
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= offset + k)
    )
    if offset:
        ranked = ranked.where(F.col("rank") > offset)
    return ranked.withColumn("rank", F.col("rank").cast("long"))


def apply_threshold(ranked: DataFrame, threshold: float | None, score_col: str = "score") -> DataFrame:
    """FLT-5: keep ``score >= threshold`` after the top-k (default 0.0)."""
    if threshold is None:
        return ranked
    return ranked.where(F.col(score_col) >= F.lit(float(threshold)))
