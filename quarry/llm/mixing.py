"""Mixing sources to target weights by pivotal dependent rounding, in
DataFrame expressions only.

Targets: the sources, ordered by code point (null last), weigh 5, 2, 1,
5, 2, 1 ... and share ``share`` times all words; a source's target stops at
``cap`` times its size, and what is above goes to the others by weight until
none is above.

Every document should be taken ``target / source size`` times.  The whole
part of that is certain; its fraction is rounded so that a source's words
hardly move: two documents trade fractions, one up and one down by as many
words, by a fair draw (neither fraction changes on average), until one is 0
or 1; the other goes on to the next trade.  Blocks of ``block`` documents
trade among themselves, their one open document each goes on to a block of
blocks, and so on up a tree; the last open document of a source is rounded
to the nearer side.  So a source misses its target by half a document at
most, and a document is never taken more often than its expected copies,
rounded up.

A level of the tree is one shuffle of narrow rows (no texts), spread by
source and block, so a source that holds most documents is many blocks.
Draws are hashes of the document and the level: a rerun gives the same mix.
Rows that agree in id, source and size are one entry that counts as often
as it occurs, added up before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RE, let, stored

ENTRY = ["doc_id", "source", "size"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def source_targets(entries: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``source, source_size, entries, target`` for ``entries(source, size, n)``.

    The windows run over one row for each source.  Sorted by cap for each
    unit of weight, a source is capped if sharing all that the sources
    before it leave would lift it above its own cap.
    """
    sizes = entries.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                          F.count("*").alias("entries"))
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (order - 1) % len(weights) + 1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last())
    most = F.col("source_size") * F.lit(float(cap))
    t = sizes.withColumn("weight", weight).withColumn("room", most / F.col("weight"))
    t = t.withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
    before = F.coalesce(F.sum(most).over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    t = t.withColumn("unit", (F.col("total") - before) / F.sum("weight").over(
        by_room.rowsBetween(0, Window.unboundedFollowing)))
    t = t.withColumn("capped", F.col("unit") >= F.col("room"))
    # Rows past the first uncapped one subtract caps that are not reached: theirs are lower.
    unit = F.max(F.when(~F.col("capped"), F.col("unit"))).over(every)
    return t.withColumn("target", F.when(F.col("capped"), most).otherwise(unit * F.col("weight"))).select(
        "source", "source_size", "entries", "target")


def draw(seed: int, level: int) -> Column:
    """A number in [0, 1) for a document at a level of the tree."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(level), *ENTRY), 11) / F.lit(2.0 ** 53)


def trade(xs: Column) -> Column:
    """The trades of one block, in the order of the array: the entries that
    went up to 1, the one that stays open, and its fraction."""
    numbered = F.transform(xs, lambda x, i: x.withField("i", i))
    start = F.struct(F.lit(-1).alias("i"), F.lit(1.0).alias("size"), F.lit(0.0).alias("p"),
                     F.expr("cast(array() as array<int>)").alias("ups"))

    def step(acc, x):
        up = F.least(acc["size"] * (1 - acc["p"]), x["size"] * x["p"])
        down = F.least(acc["size"] * acc["p"], x["size"] * (1 - x["p"]))
        rise = x["u"] * (up + down) < down
        moved = F.when(rise, up).otherwise(-down)
        first_done = F.when(rise, acc["size"] * (1 - acc["p"]) <= x["size"] * x["p"]).otherwise(
            acc["size"] * acc["p"] <= x["size"] * (1 - x["p"]))

        def settle(m):
            upped = F.when(m["first_done"] & m["rise"], F.array(acc["i"])).when(
                ~m["first_done"] & ~m["rise"], F.array(x["i"])).otherwise(F.expr("cast(array() as array<int>)"))
            p = F.when(m["first_done"], x["p"] - m["moved"] / x["size"]).otherwise(acc["p"] + m["moved"] / acc["size"])
            return F.struct(F.when(m["first_done"], x["i"]).otherwise(acc["i"]).alias("i"),
                            F.when(m["first_done"], x["size"]).otherwise(acc["size"]).alias("size"),
                            F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)).alias("p"),
                            F.concat(acc["ups"], upped).alias("ups"))

        both = let(F.struct(rise.alias("rise"), moved.alias("moved"), first_done.alias("first_done")), settle)
        begin = F.struct(x["i"].alias("i"), x["size"].alias("size"), x["p"].alias("p"), acc["ups"].alias("ups"))
        return F.when(acc["i"] < 0, begin).otherwise(both)

    return F.aggregate(numbered, start, step)


def pivotal_copies(entries: DataFrame, targets: DataFrame, seed: int, block: int) -> DataFrame:
    """``doc_id, source, size, n, source_size, target, copies``: how often the
    mix takes each entry, all its ``n`` rows together."""
    one = targets.withColumnRenamed("source", "__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    blocks = F.ceil(F.col("entries") / F.lit(block)).cast("long")
    known = entries.join(one, F.col("source").eqNullSafe(F.col("__source"))).select(
        *ENTRY, "n", "source_size", "target", (F.col("n") * rate).alias("e"),
        F.pmod(F.xxhash64(F.lit(seed), *ENTRY), blocks).alias("block"))
    whole = F.floor(F.col("e") + 1e-9)
    fraction = F.greatest(F.col("e") - whole, F.lit(0.0))
    fraction = F.when(fraction < 1e-9, F.lit(0.0)).otherwise(fraction)
    known = known.withColumn("whole", whole.cast("long")).withColumn("p", fraction)
    # An entry without words moves no words: it is drawn alone.
    alone = (F.col("p") == 0) | (F.col("size") == 0)
    known = known.withColumn("open", ~alone).withColumn(
        "up", alone & (draw(seed, -1) < F.col("p"))).drop("e")
    most = targets.agg(F.max(blocks)).first()[0] or 0
    kept = ENTRY + ["n", "source_size", "target", "whole", "block"]
    done, level, now = [], 0, known
    while True:
        done.append(now.filter(~F.col("open")))
        row = F.struct(F.xxhash64(F.lit(level), F.lit(seed), *ENTRY).alias("h"),
                       *[F.col(c) for c in kept if c not in ("source", "source_size", "target")],
                       F.col("size").cast("double").alias("words"), "p", draw(seed, level).alias("u"))
        grouped = now.filter("open").groupBy("source", "source_size", "target", "block").agg(
            F.sort_array(F.collect_list(row)).alias("xs"))
        traded = grouped.withColumn("r", trade(F.transform(grouped.xs, lambda x: F.struct(
            x["words"].alias("size"), x["p"].alias("p"), x["u"].alias("u")))))
        entry = F.posexplode("xs").alias("i", "x")
        last = most <= 1
        level += 1
        is_open = F.col("i") == F.col("r.i")
        flat = traded.select("source", "source_size", "target", "r", entry).select(
            *[F.col(c) if c in ("source", "source_size", "target") else F.col(f"x.{c}").alias(c) for c in kept[:-1]],
            F.floor(F.col("x.block") / block).cast("long").alias("block"),
            F.when(is_open, F.col("r.p")).otherwise(F.lit(0.0)).alias("p"),
            (is_open & F.lit(not last)).alias("open"),
            F.when(is_open, F.lit(last) & (F.col("r.p") >= 0.5)).otherwise(
                F.array_contains("r.ups", F.col("i"))).alias("up"))
        now = stored(flat, f"mix{level}")
        most = -(-most // block)
        if last:
            done.append(now)
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(*ENTRY, "n", "source_size", "target",
                      (F.col("whole") + F.col("up").cast("long")).alias("copies"))


def mix_plan(df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
             weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 2024,
             block: int = 64) -> DataFrame:
    """How often the mix takes the rows of ``df``: ``doc_id, source, size, n,
    source_size, target, copies``, one row for all ``n`` rows that agree in
    the first three.  Null text has size 0; a null source is a source of its
    own, a null doc_id an id of its own; an empty table gives an empty plan."""
    entries = stored(df.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                               word_count(F.col(text)).alias("size"))
                     .groupBy(*ENTRY).agg(F.count("*").alias("n")), "entries")
    targets = stored(source_targets(entries, weights, share, cap), "targets")
    return pivotal_copies(entries, targets, seed, block)


def copies_of_row(position: Column) -> Column:
    """The copies of the row at a position (from 0) among an entry's ``n`` rows."""
    return F.floor(F.col("copies") / F.col("n")).cast("long") + (
        position < F.col("copies") % F.col("n")).cast("long")


def mixed_documents(df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
                    **settings) -> DataFrame:
    """The mix itself: each row of ``df`` as often as the plan takes it, with the columns of ``df``."""
    plan = mix_plan(df, doc_id, source, text, **settings).select(
        *[F.col(c).alias(f"__{c}") for c in ENTRY], "n", "copies").filter("copies > 0").select(
        *[f"__{c}" for c in ENTRY], F.struct("n", "copies").alias("__plan"))
    keyed = df.withColumn("__words", word_count(F.col(text)))
    met = keyed.join(plan, F.col(doc_id).eqNullSafe(F.col("__doc_id")) & F.col(source).eqNullSafe(F.col("__source"))
                     & (F.col("__words") == F.col("__size")))
    once = met.filter("__plan.n = 1").withColumn("__copies", F.col("__plan.copies"))
    # Rows that agree in id, source and size share their copies in the order of a hash.
    place = F.row_number().over(Window.partitionBy(*[f"__{c}" for c in ENTRY]).orderBy(
        F.xxhash64(*[F.col(c) for c in df.columns]))) - 1
    many = met.filter("__plan.n > 1").withColumn("__place", place)
    each = F.floor(F.col("__plan.copies") / F.col("__plan.n")).cast("long")
    more = (F.col("__place") < F.col("__plan.copies") % F.col("__plan.n")).cast("long")
    many = many.withColumn("__copies", each + more).drop("__place")
    both = once.unionByName(many).filter("__copies > 0")
    return both.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*df.columns)


def mix_digest(df: DataFrame, **settings) -> DataFrame:
    """Per row of ``df``: ``doc_id, size, source_size, target, taken, copies``."""
    plan = mix_plan(df, **settings)
    rows = plan.withColumn("row", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))))
    copies = copies_of_row(F.col("row"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"),
                       copies.alias("copies"))
