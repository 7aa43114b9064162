"""Quality rules, prefix counts, language identification, subword sampling:
against brute force, and on odd rows."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import language_id as li
from quarry.llm import prefix_tokens as pt
from quarry.llm import subword_sampling as sw
from quarry.llm.quality import quality_rules
from quarry.llm.queries import tokenizer_file

P = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_quality(text):
    ws = WORD.findall(text or "")
    grams = collections.Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    covered = {i + k for i in range(len(ws) - 4) if grams[tuple(ws[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered), len(ws) < 10 or 100 * len(covered) > 20 * len(ws))


ODD_TEXTS = [None, "", " \n\t\n", "one", "a b c d e a b c d e", "x " * 40, "ä ö ü.\nß", "a b c d e f g a b c d e.\n" * 3,
             "\n".join(["Home | News | About | Help"] * 4), "All Rights Reserved.\n" + "word " * 30 + "end.",
             "é" * 5000, "word. " * 20000, "same line here.\nsame line here.\n", "a\x00b c"]


def test_quality_counts(spark):
    rnd = random.Random(4)
    texts = ODD_TEXTS + ["".join(rnd.choice(["a ", "b ", "c ", "\n", "d.", " e", "#", "\t"]) for _ in range(60))
                         for _ in range(60)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, quality string")
    got = {r.doc_id: r.quality for r in quality_rules(df).collect()}
    for i, t in enumerate(texts):
        q = got[i]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == \
            brute_quality(t), t


def test_quality_verdict(spark):
    prose = "These words are plain and form a sentence that ends well here."
    rows = [("prose", prose), ("menu", "\n".join(["Home | News | Shop | Help | More"] * 3 + ["A menu has no sentence"])),
            ("licence", prose + " " + prose + "\nLicensed under the MIT License.")]
    df = spark.createDataFrame(rows, "id string, text string")
    got = {r.id: r.quality for r in quality_rules(df).collect()}
    assert got["prose"].kept and not got["menu"].kept
    assert got["licence"].n_boilerplate == 1 and got["licence"].clean_text == prose + " " + prose
    assert quality_rules(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def counter():
    return pt.PrefixCounter(str(P.path("byte_bpe_50k.json")))


def test_prefix_counts_equal_the_library(counter):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(str(P.path("byte_bpe_50k.json")))
    rnd = random.Random(3)
    bits = ["a", "'", "r", "e", "l", "v", " ", " ", "\n", "\t", "é", "1", "!", "the", "tion", "<|endoftext|>", "<|end",
            "漢", "👍", "   ", "====", "'re", " ", "\x1c", "don't", "İ"]
    for _ in range(300):
        s = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))
        want = [len(e.ids) for e in lib.encode_batch([s[:i] for i in range(len(s) + 1)], add_special_tokens=False)]
        counts = counter.counts(s)
        assert counts.tolist() == want, s
        packed = pt.pack(counts)
        assert pt.unpack(packed).tolist() == want
        budget = rnd.randint(0, 8)
        assert pt.cut_at(packed, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_prefix_counts_of_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "hello world"), (3, "hello world"), (4, "a" * 20000)],
                               "n_bytes long, text string")
    rows = pt.prefix_token_counts(df.withColumnRenamed("n_bytes", "doc_id"), str(P.path("byte_bpe_50k.json")),
                                  budget=1).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append((r.n_bytes, r.n_tokens, r.fits_chars))
    assert by[1] == by[2] == [(0, 0, 0)]
    assert by[3] == [(11, 2, 5)] * 2
    assert by[4][0][0] == 20000


def test_language_kernel_is_the_brute_force_kernel():
    texts = ["Straße und Haus", "a house and a street", "ab ab ab", "…"]
    model = li.fit_kernel_model(texts[:3], ["de", "en", "en"], landmarks=2)
    table = li.letter_table()

    def grams(t):
        s = " ".join(["", *re.findall(r"[^\W\d_]+", t.lower()), ""])
        return {s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}
    base = len(model.alphabet) + 2
    sets = [li.ngrams(li.symbols_of(li.letters(t, table), model.alphabet), base, 3) for t in texts[:3]]
    block = li.kernel_block(model, sets)
    marks = [texts[0], texts[1], texts[2]]
    for i, x in enumerate(texts[:3]):
        for j, y in enumerate(marks):
            a, b = grams(x), grams(y)
            assert math.isclose(block[i, j], len(a & b) / math.sqrt(len(a) * len(b)), rel_tol=1e-5)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = li.train_on_documents(docs)
    out = li.identify_language(docs, model).filter(li.held_out("doc_id"))
    n, good = out.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 100 and good / n > 0.96
    again = li.identify_language(docs, li.train_on_documents(docs)).filter(li.held_out("doc_id"))
    assert out.select("doc_id", "lang_pred", "score").exceptAll(again.select("doc_id", "lang_pred", "score")).count() == 0


def test_language_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, "q"), (2, "", "en", "q"), (3, "123 !?", "en", "q"), (4, "x" * 300000, None, "q"),
                                (5, "漢字", "en", "q")], "doc_id long, text string, lang string, score string")
    model = li.train_on_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in li.identify_language(df, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] in model.languages and 0 <= got[4][1] <= 1 and got[5][0] in model.languages
    assert li.train_on_documents(df.limit(0)) is None
    assert [r.lang_pred for r in li.identify_language(df, None).collect()] == ["und"] * 5


@pytest.fixture(scope="module")
def vocab():
    return sw.Vocabulary(str(P.path("piece_bpe_32k.model")))


def all_segmentations(vocab, text):
    s, out = sw.BLANK + text.replace(" ", sw.BLANK), {}

    def go(i, ids, lp):
        if i == len(s):
            out[tuple(ids)] = lp
            return
        for j in range(i + 1, len(s) + 1):
            if s[i:j] in vocab.ids:
                go(j, [*ids, vocab.ids[s[i:j]][0]], lp + vocab.ids[s[i:j]][1])
        if s[i] not in vocab.ids:
            b = s[i].encode()
            go(i + 1, [*ids, *[vocab.bytes[x] for x in b]], lp + len(b) * vocab.byte_score)
    go(0, [], 0.0)
    total = math.log(sum(math.exp(v) for v in out.values()))
    return {k: v - total for k, v in out.items()}


@pytest.mark.parametrize("text", ["the on", "ab ①x", "thing"])
def test_samples_follow_the_lattice(vocab, text):
    want = all_segmentations(vocab, text)
    n = 4000
    found = sw.sample_texts(vocab, [text] * n, np.arange(n), 3, 7)
    ids = [[tuple(sw.piece_ids(vocab, s[0]).tolist()) for s in f] for f in found]
    assert all(len(set(x)) == 3 for x in ids)
    assert all(math.isclose(want[i], s[1], abs_tol=1e-9) for x, f in zip(ids, found) for i, s in zip(x, f))
    first = collections.Counter(x[0] for x in ids)
    both = collections.Counter((x[0], x[1]) for x in ids)
    top = sorted(want, key=want.get)[-3:]
    for a in top:
        assert abs(first[a] / n - math.exp(want[a])) < 0.04
    for a, b in itertools.permutations(top, 2):
        pa, pb = math.exp(want[a]), math.exp(want[b])
        assert abs(both[a, b] / n - pa * pb / (1 - pa)) < 0.04
    # Weighted by its inclusion score, the sample estimates sums over all segmentations.
    assert abs(np.mean([sum(math.exp(s[1] - s[3]) for s in f) for f in found]) - 1) < 0.02


def test_sampling_rows(spark, vocab):
    df = spark.createDataFrame([(1, None, "e"), (2, "", "e"), (3, "a", "e"), (4, "  two  spaces\n\ttab ", "e"), (4, "  two  spaces\n\ttab ", "e"),
                                (None, "null key", "e"), (6, "word " * 30000 + "語" * 3000, "e")], "doc_id long, text string, ids string")
    path = str(P.path("piece_bpe_32k.model"))
    rows = sw.sample_segmentations(df, path, k=3).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert [list(r.ids) for r in by[1]] == [list(r.ids) for r in by[2]] == [[]]
    assert by[1][0].inclusion == 1.0
    assert len(by[3]) == 2 and all(r.inclusion == 1.0 for r in by[3])  # "▁a", "▁" "a"
    assert len(by[4]) == 6 and len({(r.sample, tuple(r.ids)) for r in by[4]}) == 3
    assert all(r.decodes for r in rows) and len(by[6]) == 3 and len(by[None]) == 3
    back = sw.decode_pieces(sw.sample_segmentations(df, path, k=1), path).collect()
    assert all(r.decoded == (r.text or "") for r in back)
    assert sw.sample_segmentations(df.limit(0), path).count() == 0


def test_samples_do_not_depend_on_the_batch(vocab):
    texts = ["some words here", "other words", "", "some words here"]
    whole = sw.sample_texts(vocab, texts, np.arange(4), 2, 7)
    for i, t in enumerate(texts):
        alone = sw.sample_texts(vocab, [t], np.array([i]), 2, 7)[0]
        assert [x[0].tolist() for x in alone] == [x[0].tolist() for x in whole[i]]


def test_samples_decode_like_the_library(spark):
    import sentencepiece
    path = tokenizer_file("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["plain words", "line\nbreak\ttab", "naïve 😀 中文 ▁", " lead and trail ", "\x00\x01", "a  b", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in sw.sample_segmentations(df, path, k=3).collect():
        text = (texts[r.doc_id] or "").replace("▁", " ")
        assert r.decodes and sp.decode(list(r.ids)) == text
    back = sw.decode_pieces(spark.createDataFrame([([sp.piece_to_id("<0xE4>")],), (None,)], "ids array<int>"), path)
    assert [r.decoded for r in back.collect()] == ["�", None]


def test_large_alphabets_keep_their_letters(spark):
    rng = random.Random(6)
    scripts = {"a": [chr(0x4E00 + i) for i in range(1500)], "b": [chr(0xAC00 + i) for i in range(1500)]}
    rows = [(i, "".join(rng.choice(scripts[lang]) for _ in range(60)), lang) for i in range(160) for lang in scripts]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df = df.unionByName(df.filter("doc_id = 0")).unionByName(df.filter("doc_id = 0"))  # repeated rows
    model = li.train_on_documents(df)
    assert len(model.alphabet) > 2500
    got = li.identify_language(df, model).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.98 * len(got)
    assert li.identify_language(df.limit(0), model).count() == 0
    assert li.identify_language(df, li.train_on_documents(df.limit(0))).filter("lang_pred != 'und'").count() == 0


def test_a_draw_searches_its_own_node():
    """op3: every draw searched the edges of all words; a node's own edges give the same."""
    vocab = sw.Vocabulary(tokenizer_file("piece_bpe_32k.model"))
    rng = np.random.default_rng(3)
    texts = ["the cat sat on the mat", "", "字 of antidisestablishmentarianism", "a" * 300]
    walks = sw.Walks(vocab, texts, np.arange(len(texts)))
    node = rng.integers(0, len(walks.first) - 1, 4000)
    u = np.concatenate((rng.random(3900), np.full(50, 2.0 ** -54), np.full(50, 1 - 2.0 ** -53)))
    every = np.searchsorted(walks.cum, node + u, side="left")
    want = np.clip(every, walks.first[node], walks.first[node + 1] - 1)
    assert (walks.drawn(node, node + u) == want).all()
    assert len(walks.drawn(node[:0], u[:0])) == 0


def test_a_word_has_one_lattice_for_all_batches(monkeypatch):
    """pipeline, op3: every batch made the lattices of its words anew, and a line's end joined two words to one."""
    vocab = sw.Vocabulary(tokenizer_file("piece_bpe_32k.model"))
    rng = random.Random(8)
    words = ["".join(rng.choices("aeinrst", k=rng.randint(2, 9))) for _ in range(400)]
    texts = [rng.choice([" ", "\n", ", "]).join(rng.choices(words, k=80)) + "語" for _ in range(60)]
    made, make = [], sw.Lattices.__init__
    monkeypatch.setattr(sw.Lattices, "__init__", lambda self, v, w: (made.extend(w), make(self, v, w))[1])
    whole = sw.sample_texts(vocab, texts, np.arange(60), 2, 7)
    assert len(made) == len(set(made)) and not any("\n" in w and len(w) > 1 for w in made)
    n = len(made)
    for kept in (sw.KEPT_CHARS, 900, 0):  # what is kept changes no sample
        monkeypatch.setattr(sw, "KEPT_CHARS", kept)
        for i in range(0, 60, 7):
            for one, f in zip(sw.sample_texts(vocab, texts[i:i + 7], np.arange(60)[i:i + 7], 2, 7), whole[i:i + 7]):
                assert [x[0].tolist() for x in one] == [x[0].tolist() for x in f]
                assert np.allclose([x[1:] for x in one], [x[1:] for x in f], rtol=1e-9)
        assert (len(made) == n) == (kept == 1 << 19)
        held = vocab.known
        assert len(held.number) == held.tail.n == len(held.met) and held.first.values[-1] == held.edges["prob"].n
