"""Text analysis (FN-7) and the BM25 term score (FN-8).

The default analyzer (SURVEY D6) lower-cases the text, takes runs of
letters/digits as tokens, and splits runs of CJK ideographs into
overlapping bigrams (a lone ideograph stays a token).  Everything is a
JVM-side expression: ``regexp_extract_all`` plus higher-order functions,
and the bigram branch only runs on rows that contain an ideograph.
"""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: token patterns and BM25 constants.
CJK_RANGE = r"\x{4e00}-\x{9fff}"
TOKEN_PATTERN = r"([\x{4e00}-\x{9fff}]+|[\p{L}\p{N}&&[^\x{4e00}-\x{9fff}]]+)"
PLAIN_TOKEN_PATTERN = r"([\p{L}\p{N}]+)"
NON_WORD_PATTERN = r"[^\p{L}\p{N}]+"
_CJK = r"[\x{4e00}-\x{9fff}]"
_WORD = r"[\p{L}\p{N}&&[^\x{4e00}-\x{9fff}]]"
CJK_TOKEN_PATTERN = (r"(?=(" + _CJK + "{2}" + "|(?<!" + _CJK + ")" + _CJK + "(?!" + _CJK + ")"
                     + "|(?<!" + _WORD + ")" + _WORD + "+))")
BM25_K1 = 1.2
BM25_B = 0.75


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def analyze(text, analyzer: str | None = None) -> Column:
    """Tokens of ``text`` as ``array<string>``.

    ``analyzer=None`` is the default CJK-aware analyzer; any other value is
    a Java regex with one capture group whose matches (on the lower-cased
    text) are the tokens.  NULL text gives an empty array.

    The CJK branch is a single regex pass: a zero-width lookahead captures,
    at each position, either the ideograph bigram starting there, a lone
    ideograph, or a whole letter/digit run starting there, so overlapping
    bigrams come out of ``regexp_extract_all`` without any lambda.
    """
    t = F.lower(F.coalesce(_col(text), F.lit("")))
    if analyzer is not None:
        return F.regexp_extract_all(t, F.lit(analyzer), 1)
    # Without an ideograph the default pattern equals runs of letters/digits,
    # i.e. a split on runs of anything else (faster than extracting matches).
    plain = F.array_remove(F.split(t, NON_WORD_PATTERN), "")
    split = F.regexp_extract_all(t, F.lit(CJK_TOKEN_PATTERN), 1)
    return F.when(t.rlike(f"[{CJK_RANGE}]"), split).otherwise(plain)


def idf(n_docs, doc_freq) -> Column:
    """ln(1 + (N - df + 0.5) / (df + 0.5))."""
    n, d = _col(n_docs), _col(doc_freq)
    return F.log(1.0 + (n - d + 0.5) / (d + 0.5))


def bm25_doc_weight(tf, dl, avgdl, k1: float = BM25_K1, b: float = BM25_B) -> Column:
    """Document side of the BM25 term score: tf*(k1+1) / (tf + k1*(1-b+b*dl/avgdl))."""
    tf, dl = _col(tf), _col(dl)
    avg = avgdl if isinstance(avgdl, Column) else F.lit(float(avgdl))
    return tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * dl / avg))
