"""The pipeline's stages, each against plain Python on its own input."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from quarry.llm.common import stored
from tests.llm.test_table_operators import brute_classes, brute_lines

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the of and water house garden letter morning street window answer question number people".split(),
         "de": "der die und wasser haus garten brief morgen strasse fenster antwort frage nummer leute".split()}
SHARED = ["this line stands in many documents of the table", "and so does this other one, word for word"]


def documents():
    rng = random.Random(3)
    rows = []
    for i in range(160):
        lang = "en" if i % 2 else "de"
        lines = [" ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(5, 12))) for _ in range(rng.randint(2, 6))]
        if i % 8 == 1:
            lines.insert(rng.randint(0, len(lines)), rng.choice(SHARED))
        rows.append((i, "\n".join(lines), lang, f"s{i % 5}"))
    near = rows[7][1].split(" ")
    rows += [(200 + i, rows[7][1], "en", "s1") for i in range(3)]  # exact copies
    rows += [(210, " ".join([*near, "extra"]), "en", "s2"), (211, SHARED[0], "en", "s3")]
    rows += [(220, None, "en", "s0"), (221, "", "en", "s0"), (222, "12 34 \n 56", "en", None), (None, rows[3][1], "en", "s0"),
             (3, rows[3][1], "en", None), (3, rows[3][1], "en", None), (223, "the house and the water\n" * 3000, "en", "s4")]
    return [(*r, len(r[1] or "")) for r in rows]


def test_stages_against_plain_python(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    stages = dict(cp.STAGES)

    def step(name, df):
        out = stored(stages[name](spark, df, "unused"), name)
        return out, out.collect()

    told, rows = step("language_id", docs)
    assert told.columns == docs.columns
    given = collections.Counter(tuple(r) for r in docs.collect())
    assert collections.Counter(map(tuple, rows)) == collections.Counter(
        {r: n for r, n in given.items() if any(c.isalpha() for c in r[1] or "")})

    cleaned, rows = step("line_dedup", told)
    want = collections.Counter()
    for (d, text, _, dropped), n in brute_lines([(r.doc_id, r.text) for r in told.collect()]).items():
        if text.split() or not dropped:
            want[d, text] += n
    assert collections.Counter((r.doc_id, r.text) for r in rows) == want
    assert all(r.n_chars == len(r.text) for r in rows) and cleaned.columns == docs.columns

    kept, rows = step("near_dedup", cleaned)
    pairs = [(r.doc_id, r.text) for r in cleaned.collect()]
    classes = brute_classes(pairs, 5, 80)
    assert collections.Counter((r.doc_id, r.text) for r in rows) == collections.Counter(
        (d, t) for d, t in pairs if d is None or classes[d] == d)

    mixed, rows = step("mix_sources", kept)
    size, taken, copies = collections.Counter(), collections.Counter(), collections.Counter(map(tuple, rows))
    before = collections.Counter(tuple(r) for r in kept.collect())
    for r, n in before.items():
        size[r[3]] += n * len((r[1] or "").split())
    for r, n in copies.items():
        assert n <= 2 * before[r]
        taken[r[3]] += n * len(r[1].split())
    assert all(taken[s] <= 2 * size[s] for s in size)
    assert 1.2 * sum(size.values()) < sum(taken.values()) < 1.8 * sum(size.values())

    _, rows = step("subword_samples", mixed)
    assert all(r.decodes for r in rows)
    by = collections.Counter((r.doc_id, r["sample"]) for r in rows)
    rows_of = collections.Counter(r.doc_id for r in mixed.collect())
    assert all(by[d, 1] == n == by[d, 2] for d, n in rows_of.items())
    assert len({(r.doc_id, tuple(r.ids)) for r in rows}) >= 2 * len(rows_of)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(1, "a", None, None, 1)] * 3])
def test_odd_tables_and_clashing_columns(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("kept", "kept_text", "component_id", "score", "lang_pred", "copies", "__x", "bands", "n"):
        docs = docs.withColumn(name, F.lit("z"))
    for name, stage in cp.STAGES:
        out = stage(spark, docs, "unused")
        if name != "subword_samples":
            assert out.columns == docs.columns
        docs = stored(out, name)
    assert docs.count() == (0 if not rows or rows[0][1] is None else docs.count())
