"""Connected components of a link table, by large-star and small-star rounds.

Links never leave Spark: each round joins the links with one minimum per
node, and its result is written to the shared folder, so lineage stays
short and a lost executor loses nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One round.  Large star: every neighbour above a node is linked to the
    least node around it.  Small star: every neighbour below, and the node."""
    if small:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    met = near.join(least, "u")
    if small:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    else:
        out = met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u != v").distinct()


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of links (count and two order-free sums)."""
    h = F.xxhash64("u", "v")
    r = edges.agg(F.count("*"), F.bit_xor(h), F.coalesce(F.sum((h % 1_000_003).cast("long")), F.lit(0))).first()
    return tuple(r)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)`` (long, not
    null); the component is its least node.  Self links and repeated links do
    no harm; an empty table gives an empty one."""
    now = stored(edges.filter("u != v").select("u", "v").distinct(), "links")
    state = _state(now)
    for _ in range(max_rounds):
        if not state[0]:
            break
        after = stored(_star(_star(now, small=False), small=True), "links")
        drop_stored(now)
        new_state = _state(after)
        now, done = after, new_state == state
        state = new_state
        if done:
            break
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    own = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
