"""URL filters: rules first, then a classifier on segmented names.

Host names run words together.  A unigram Viterbi splits every distinct
letter run of the hosts into the words of highest total probability; the
word counts come from the whole texts of all pages, urls and dotted names
aside: a page that prints its own host would make the joined name a word.  A
multinomial naive Bayes, trained on all pages that a rule decides, then scores
the words of host and path.  What the deciding rule itself matched is no
feature of such a page: it would teach the rules, not the names they stand for.
Tokens are hashed to ``2 ** bits`` counters, so the model's size is fixed
whatever the vocabulary.

Everything is counted per distinct run, word or host, with partial sums
before each shuffle; page texts stay where they are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, schema_with, stored

# (host and path prefix, verdict): the rules of the registered query.
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block")]
MAX_WORD = 63  # fixed value: the longest label a host name can have
MARKUP = (r"(?is)<!--.*?(?:-->|\z)|<(script|style)(?=[\s/>]).*?(?:</\1(?=[\s/>])[^>]*(?:>|\z)|\z)"
          r"|<[a-z/!?][^>]*(?:>|\z)|&#?[a-z0-9]{1,32};")
# A url, or a dotted name from its first character on; no start inside a run, so that long runs cost one pass.
ADDRESS = (r"""(?:[a-zA-Z][a-zA-Z0-9+.-]{0,15})?://[^\s<>"']*"""
           r"|(?<![\p{L}\p{N}_.-])[\p{L}\p{N}_-]++\.[\p{L}\p{N}_-][\p{L}\p{N}_.-]*+")


def url_part(url: Column, group: int) -> Column:
    """1: what stands between the first ``://`` and ``/ ? #``; 2: from there to ``? #``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]], value: int) -> Column:
    """The longest rule that fits (``value`` 0) or its verdict (1); null if none fits."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule[0].partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, rule[value]).otherwise(out)
    return out


def letter_runs(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+)"), F.lit(1))


def page_text(html: Column) -> Column:
    """What a page says: tags, comments, character references and all of script
    and style become blanks (what is left open reaches to the end), then urls
    and dotted names."""
    return F.regexp_replace(F.regexp_replace(html, MARKUP, " "), ADDRESS, " ")


def best_split(run: str, logp: dict[str, float], log_total: float) -> list[str]:
    """The words of highest total log-probability; an unknown word of ``n``
    letters has that of ten words over ``10 ** n``."""
    best, back = [0.0], [0]
    for end in range(1, len(run) + 1):
        top, at = -math.inf, 0
        for start in range(max(0, end - MAX_WORD), end):
            w = run[start:end]
            p = best[start] + logp.get(w, math.log(10) - log_total - len(w) * math.log(10))
            if p > top:
                top, at = p, start
        best.append(top)
        back.append(at)
    words, end = [], len(run)
    while end:
        words.append(run[back[end]:end])
        end = back[end]
    return words[::-1]


def word_counts(texts: Column, df: DataFrame) -> DataFrame:
    """``word, n`` over all of ``df``; words of up to :data:`MAX_WORD` letters."""
    return (df.select(F.explode(letter_runs(texts)).alias("word")).filter(F.length("word") <= MAX_WORD)
            .groupBy("word").agg(F.count("*").alias("n")))


def segment_runs(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """``run, words`` for distinct ``runs(run)``.  Each run meets the counts of
    its own substrings only, by an equi join on the word."""
    import pyarrow as pa

    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    log_total = math.log(max(total, 1))
    starts = F.sequence(F.lit(1), F.length("run"))
    subs = F.flatten(F.transform(starts, lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.length("run") - i + 1, F.lit(MAX_WORD))), lambda n: F.substring("run", i, n))))
    parts = runs.select("run", F.explode(F.array_distinct(subs)).alias("word"))
    known = parts.join(counts, "word").groupBy("run").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def split(batches):
        for b in batches:
            out = [best_split(r, {k["word"]: math.log(k["n"]) - log_total for k in known or ()}, log_total)
                   for r, known in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.string()))],
                                             names=["run", "words"])

    return runs.join(known, "run", "left").select("run", "known").mapInArrow(split, "run string, words array<string>")


def segment_hosts(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``host, host_runs`` for distinct ``hosts(host)``: the words of each letter run, in order."""
    runs = hosts.select("host", F.posexplode(letter_runs(F.col("host"))).alias("at", "run"))
    split = segment_runs(runs.select("run").distinct(), counts)
    words = runs.join(split, "run").groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("at", "words"))).alias("w"))
    return words.select("host", F.transform("w", lambda x: x["words"]).alias("host_runs"))


def unruled(rule: Column, host_runs: Column, path: Column) -> tuple[Column, Column]:
    """Host words and path without what ``rule`` matched of them: the last
    labels of the host and the first characters of the path."""
    name = F.substring_index(rule, "/", 1)
    runs = F.coalesce(host_runs, F.array().cast("array<array<string>>"))
    rest = F.when(rule.isNull(), runs).otherwise(
        F.slice(runs, 1, F.greatest(F.size(runs) - F.size(letter_runs(F.coalesce(name, F.lit("")))), F.lit(0))))
    tail = F.when(rule.isNull(), path).otherwise(path.substr(F.length(rule) - F.length(name) + 1, F.length(path)))
    return F.flatten(rest), tail


def path_tokens(path: Column) -> Column:
    """Letter runs of a path in lower case; every digit run is one same token."""
    found = F.regexp_extract_all(F.lower(path), F.lit(r"(\p{L}+|\p{N}+)"), F.lit(1))
    return F.transform(found, lambda t: F.when(t.rlike(r"^\p{N}"), F.lit("0")).otherwise(t))


def token_slots(host_words: Column, path: Column, bits: int) -> Column:
    tokens = F.concat(F.transform(host_words, lambda w: F.concat(F.lit("host "), w)),
                      F.transform(path_tokens(path), lambda w: F.concat(F.lit("path "), w)))
    return F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(2 ** bits)).cast("int"))


def train_bayes(df: DataFrame, bits: int, smoothing: float = 1.0) -> tuple[np.ndarray, float]:
    """Log-odds of ``block`` for every slot, and the prior's, from all rows of
    ``df(label, slots)``.  At most ``2 * 2 ** bits`` sums come to the driver."""
    prior = {r["label"]: r["n"] for r in df.groupBy("label").agg(F.count("*").alias("n")).collect()}
    counts = np.zeros((2, 2 ** bits))
    sums = df.select("label", F.explode("slots").alias("slot")).groupBy("label", "slot").agg(
        F.count("*").alias("n")).toPandas()
    for row, label in enumerate(("allow", "block")):
        own = sums[sums["label"] == label]
        counts[row, own["slot"].to_numpy(np.int64)] = own["n"].to_numpy(np.float64)
    share = np.log(counts + smoothing) - np.log(counts.sum(axis=1, keepdims=True) + smoothing * 2 ** bits)
    odds = share[1] - share[0]
    odds[counts.sum(axis=0) == 0] = 0.0  # a token never seen says nothing
    n_allow, n_block = prior.get("allow", 0), prior.get("block", 0)
    return odds, math.log((n_block + smoothing) / (n_allow + smoothing))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, url: str = "url", html: str = "html",
               bits: int = 18) -> DataFrame:
    """The columns of ``pages`` without ``html``, then ``host, path, rule,
    verdict, block_score`` (probability that naive Bayes gives to block) and
    ``host_words``.  Columns with those names are replaced.

    A null url, or one without ``://``, has an empty host and path, fits no
    rule and is judged by the prior alone.  Without any page that a rule
    decides, every verdict is ``allow``; equal odds are ``allow``.  Repeated
    rows count, and come back, as often as they occur; urls of any length are
    judged whole.
    """
    import pyarrow as pa

    own = ["host", "path", "rule", "verdict", "block_score", "host_words"]
    base = pages.select(*[c for c in pages.columns if c not in (*own, html)],
                        ascii_lower(url_part(F.col(url), 1)).alias("host"), url_part(F.col(url), 2).alias("path"))
    base = base.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules, 0)).withColumn(
        "verdict", matching_rule(F.col("host"), F.col("path"), rules, 1))
    counts = stored(word_counts(page_text(F.col(html)), pages), "words")
    hosts = segment_hosts(base.select("host").distinct(), counts)
    seen_host, seen_path = unruled(F.col("rule"), F.col("host_runs"), F.col("path"))
    tokens = (base.join(hosts, "host", "left").withColumn("__slots", token_slots(seen_host, seen_path, bits))
              .withColumn("host_words", F.array_join(F.flatten("host_runs"), " ")).drop("host_runs"))
    odds, prior = train_bayes(tokens.filter("verdict IS NOT NULL").select(
        F.col("verdict").alias("label"), F.col("__slots").alias("slots")), bits)
    shared = pages.sparkSession.sparkContext.broadcast(odds)  # 2 ** bits numbers
    at = tokens.columns.index("__slots")
    schema = schema_with(tokens, __odds="double")

    def score(batches):
        for b in batches:
            slots = b.column(at)
            flat = np.concatenate(([0.0], np.cumsum(shared.value[slots.flatten().to_numpy(zero_copy_only=False)])))
            ends = np.cumsum(slots.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            sums = flat[ends] - flat[np.concatenate(([0], ends[:-1]))] if len(ends) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sums + prior, pa.float64())],
                                             names=[*b.schema.names, "__odds"])

    scored = tokens.mapInArrow(score, schema)
    rest = [c for c in base.columns if c not in own]
    return scored.select(
        *rest, "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("__odds") > 0, "block").otherwise("allow")).alias("verdict"),
        (1 / (1 + F.exp(-F.col("__odds")))).alias("block_score"), "host_words")
