"""Line-first quality rules, in DataFrame expressions only.

Every line is judged by itself; lines that fail are removed; a document
that loses too much of its text is rejected.  Nothing is shuffled: one
document is one row, and a row is judged within the scan.

Rules, first match wins (a line without a word is never judged and never
removed):

``boilerplate``
    holds a stock phrase (:data:`BOILERPLATE`), any case;
``navigation``
    a menu: two separators (``| » › • ·``) or more, and one for every
    four words at least;
``punctuation``
    no word of it ends in a sentence mark, closing quotes aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_RE, let, words

# Phrases of page furniture and licence lines, in lower case.
BOILERPLATE = [
    "all rights reserved", "licensed under", "released under the", "terms of use", "terms of service",
    "privacy policy", "cookie policy", "use of cookies", "javascript", "lorem ipsum", "sign in to",
    "subscribe to", "click here", "skip to content", "share this page", "copyright ©", "copyright (c)",
]
SEPARATOR_RE = "[|»›•·]"
SENTENCE_RE = r"""[.!?…。！？:;][”’"')\]»]*(?:[\x20\x09-\x0D]|$)"""
RULES = ("boilerplate", "navigation", "punctuation")


def has_boilerplate(text: Column) -> Column:
    """Whether a text holds one of the stock phrases."""
    def any_of(low):
        found = low.contains(BOILERPLATE[0])
        for phrase in BOILERPLATE[1:]:
            found = found | low.contains(phrase)
        return found
    return let(F.lower(text), any_of)


def line_rule(line: Column, maybe_boilerplate: Column) -> Column:
    """The rule a line fails, or null."""
    n_seps = F.regexp_count(line, F.lit(SEPARATOR_RE))
    return (F.when(~line.rlike(WORD_RE), F.lit(None).cast("string"))
            .when(maybe_boilerplate & has_boilerplate(line), "boilerplate")
            .when((n_seps >= 2) & (n_seps * 4 >= F.regexp_count(line, F.lit(WORD_RE))), "navigation")
            .when(~line.rlike(SENTENCE_RE), "punctuation"))


def repeated_window_words(ws: Column, width: int = 5) -> Column:
    """How many words lie in a ``width``-word window that the array holds
    twice or more.  Windows are compared as text; hashes only tell that a
    document has no repeat at all, which needs no further look."""
    n = F.size(ws) - (width - 1)
    spots = F.sequence(F.lit(0), n - 1)

    def window(i):
        return [F.get(ws, i + k) for k in range(width)]

    def covered(at):
        end = F.aggregate(
            at, F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n")),
            lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(width), p - a["last"])).alias("n")))
        return end["n"]

    def marked(s):
        same = lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))
        return F.sort_array(F.transform(
            F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1))), lambda x: x["i"]))

    distinct = F.size(F.array_distinct(F.transform(spots, lambda i: F.xxhash64(*window(i)))))
    windows = F.sort_array(F.transform(
        spots, lambda i: F.struct(F.concat_ws(" ", *window(i)).alias("w"), i.alias("i"))))
    return F.when(n <= 1, 0).when(distinct == n, 0).otherwise(let(let(windows, marked), covered))


def quality_rules(df: DataFrame, text: str = "text", min_words: int = 10, max_repeat_pct: int = 20,
                  max_lost: float = 0.5) -> DataFrame:
    """``df`` with one struct column ``quality``:

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long),
    ``base_failed``, ``kept`` (boolean), ``lost_words`` and one count per
    rule (``n_boilerplate`` ...), and ``clean_text``: the lines that pass,
    joined by ``\\n``.

    A document is kept unless ``base_failed`` or more than ``max_lost`` of
    its words stand in removed lines.  Null text counts as a text without
    words; a clashing column named ``quality`` is replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(t, "\n")
    judged = let(has_boilerplate(t), lambda maybe: F.transform(
        lines, lambda x: F.struct(x.alias("line"), line_rule(x, maybe).alias("rule"))))
    n_in = lambda part: F.aggregate(
        part, F.lit(0), lambda n, x: n + F.regexp_count(x["line"], F.lit(WORD_RE)))
    with_word = F.filter(lines, lambda x: x.rlike(WORD_RE))

    def failed_by(js, rule):
        return F.size(F.filter(js, lambda x: x["rule"] == rule)).cast("long")

    def from_lines(js):
        failed = F.filter(js, lambda x: x["rule"].isNotNull())
        return F.struct(
            n_in(failed).cast("long").alias("lost_words"),
            *[failed_by(js, r).alias(f"n_{r}") for r in RULES],
            F.array_join(F.transform(F.filter(js, lambda x: x["rule"].isNull()), lambda x: x["line"]), "\n")
            .alias("clean_text"))

    def from_words(ws):
        return F.struct(F.size(ws).cast("long").alias("n_words"),
                        F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
                        repeated_window_words(ws).cast("long").alias("n_repeat_words"))

    # Columns of their own, not one struct: the optimizer would inline a
    # struct's parts at every use and compute them again.
    w, ln, n_symbols, n_dup = (f"__quality_{x}" for x in ("words", "lines", "symbols", "dup"))
    counted = df.select(
        *[F.col(c) for c in df.columns if c != "quality"],
        let(words(t), from_words).alias(w), let(judged, from_lines).alias(ln),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias(n_symbols),
        let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias(n_dup))
    w, ln = F.col(w), F.col(ln)
    n_words, n_repeat = w["n_words"], w["n_repeat_words"]
    base_failed = (n_words < min_words) | (n_repeat * 100 > n_words * max_repeat_pct)
    return counted.select(
        *[F.col(c) for c in df.columns if c != "quality"],
        F.struct(
            n_words.alias("n_words"), w["word_chars"].alias("word_chars"), F.col(n_symbols).alias("n_symbols"),
            F.col(n_dup).alias("n_dup_lines"), n_repeat.alias("n_repeat_words"),
            base_failed.alias("base_failed"),
            (~base_failed & (ln["lost_words"] <= n_words * F.lit(max_lost))).alias("kept"),
            ln["lost_words"].alias("lost_words"), *[ln[f"n_{r}"].alias(f"n_{r}") for r in RULES],
            ln["clean_text"].alias("clean_text")).alias("quality"))
