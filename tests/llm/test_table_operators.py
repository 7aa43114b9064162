"""Near-duplicates, line dedup, mixing, WARC, URL filter, vector search:
against brute force, and on odd rows."""

import collections
import hashlib
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import line_dedup as ld
from quarry.llm import minmax_hash as mh
from quarry.llm import mixing
from quarry.llm import multi_index_hash as mi
from quarry.llm import url_filter as uf
from quarry.llm import warc
from quarry.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randint(0, 200), rnd.randint(0, 200)) for _ in range(150)] + [(500, i) for i in range(501, 560)] + [(7, 7)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    want = components({x for e in links for x in e}, links)
    assert all(want[n] == c for n, c in got.items())
    assert {n for e in links if e[0] != e[1] for n in e} == set(got)
    assert connected_components(df.limit(0)).count() == 0


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_classes(rows, n, percent):
    sets = collections.defaultdict(list)
    for d, t in rows:
        if d is not None and shingles(t, n):
            sets[d].append(shingles(t, n))
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] for x in sets[a] for y in sets[b]
             if 100 * len(x & y) >= percent * len(x | y)]
    return components({d for d, _ in rows if d is not None}, links)


def near_copies(rnd, n_groups, size, words):
    rows, i = [], 0
    for g in range(n_groups):
        base = [f"w{rnd.randint(0, 400)}" for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(rnd.randint(0, words // 12)):
                own[rnd.randrange(words)] = f"x{rnd.randint(0, 9999)}"
            rows.append((i, " ".join(own)))
            i += 1
    rnd.shuffle(rows)
    return rows


def test_near_duplicates(spark):
    rnd = random.Random(5)
    rows = near_copies(rnd, 6, 25, 120) + [(1000 + i, "exact copy of one text that many hold") for i in range(40)]
    rows += [(2000, None), (2001, ""), (2002, " \t "), (2003, "one"), (2004, "One"), (2005, "two words"), (None, "one"),
             (2006, "w " * 30000), (2007, "W " * 29000), (3, "a second text of document three"), (2008, "a second text of document three")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for kw in ({}, {"shingle": 3, "percent": 85}, {"shingle": 3, "percent": 85, "chunk": 4, "rounds": 0}):
        got = mh.near_duplicate_classes(df, **kw).collect()
        want = brute_classes(rows, kw.get("shingle", 5), kw.get("percent", 80))
        assert len(got) == len(rows)
        for r in got:
            assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
            assert r.kept == (r.doc_id is None or r.doc_id == want[r.doc_id])
    assert mh.near_duplicate_classes(df.limit(0)).count() == 0


def test_signature_agreement_is_jaccard():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2 ** 63, 3000, dtype=np.uint64)
    x, y = np.unique(a[:2000]), np.unique(a[500:2500])
    same = mh.minmax_signature(x, 512) == mh.minmax_signature(y, 512)
    assert abs(same.mean() - 1500 / 2500) < 0.06


def brute_lines(rows, min_docs=3):
    key = lambda x: x.strip(" \t\n\r\x0b\x0c").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    held = collections.defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                held[key(x)].add(-1 if d is None else d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if len(held.get(key(x), ())) < min_docs or max(held[key(x)]) == (-1 if d is None else d)]
        out.append((d, "\n".join(left), len(lines), len(lines) - len(left)))
    return collections.Counter(out)


def line_rows(seed=3, n=60):
    rnd = random.Random(seed)
    pool = [f"this is shared line number {i} of the pool" for i in range(12)] + ["short", "", "  THIS IS shared LINE number 1 of the pool\t", "ä" * 19, "Ö" * 20]
    return [(i, "\n".join(rnd.choice(pool + [f"a line that only document {i} holds"]) for _ in range(rnd.randint(0, 9)))) for i in range(n)]


@pytest.mark.parametrize("broadcast_bytes", [32 << 20, 0])
def test_line_dedup(spark, broadcast_bytes):
    rows = line_rows() + [(7, "this is shared line number 2 of the pool"), (None, "this is shared line number 3 of the pool"), (61, None), (62, "x" * 300000)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, n_lines string")
    got = ld.dedup_lines(df, broadcast_bytes=broadcast_bytes).collect()
    assert collections.Counter((r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in got) == brute_lines(rows)
    assert ld.dedup_lines(df.limit(0)).count() == 0


def test_line_references_are_counted(spark):
    line = "a line that several documents share"
    docs = lambda *ids: spark.createDataFrame([(i, line) for i in ids], "doc_id long, text string")
    index = ld.LineIndex(spark).insert(docs(1, 2, 3)).insert(docs(1)).delete(docs(1))
    dropped = lambda: {r.doc_id for r in index.drop_lines(docs(1, 2, 3)).collect() if r.n_dropped}
    assert dropped() == {1, 2}
    index.delete(docs(1, 9, 9))
    assert dropped() == set() and index.counts().first()["n_docs"] == 2
    index.insert(docs(1)).insert(docs(1)).insert(docs(4)).delete(docs(1))
    assert dropped() == {1, 2, 3}
    index.delete(docs(1, 2, 3, 4))
    assert index.counts().count() == 0 and index.holders().count() == 0 and dropped() == set()


def test_line_dedup_is_reversible(spark):
    rows = line_rows()
    first = spark.createDataFrame(rows[:40], "doc_id long, text string")
    second = spark.createDataFrame(rows[40:], "doc_id long, text string")
    both = first.unionByName(second)
    index = ld.LineIndex(spark, shard_keys=8).insert(first)
    state = lambda i: (set(map(tuple, i.counts().collect())), set(map(tuple, i.holders().collect())))
    before = state(index)
    index.insert(second)
    whole = ld.LineIndex(spark, shard_keys=8).insert(both)
    assert state(index) == state(whole)
    got = index.drop_lines(both).collect()
    assert collections.Counter((r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in got) == brute_lines(rows)
    index.delete(second)
    assert state(index) == before
    keys = {r["key"] for r in index.counts().filter("n_docs >= 3").collect()}
    held = {r["shard"]: ld.CuckooFilter.load(bytes(r["filter"])) for r in index.filters().collect()}
    assert all(held[(k >> 40) % index.shards].contains(np.array([k]))[0] for k in keys)


def test_cuckoo_filter():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(-2 ** 62, 2 ** 62, 5000))
    f = ld.build_filter(keys)
    assert f.contains(keys).all()
    others = np.setdiff1d(rng.integers(-2 ** 62, 2 ** 62, 50000), keys)
    assert f.contains(others).mean() < 0.002
    for k in keys[:2500]:
        assert f.delete(int(k))
    assert f.contains(keys[2500:]).all() and f.contains(keys[:2500]).mean() < 0.01
    assert (ld.CuckooFilter.load(f.dump()).table == f.table).all()


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        unit = (total - sum(fixed.values())) / sum(w[s] for s in free)
        over = [s for s in free if unit * w[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **{s: unit * w[s] for s in free}}
        fixed.update({s: cap * sizes[s] for s in over})


def test_mixing(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 60)), rnd.choice(["a", "a", "a", "é", "Z", "b", None])) for i in range(900)]
    rows += [(5000, "same row here", "b")] * 301 + [(None, None, "b"), (None, None, "b"), (6000, "w " * 20000, "tiny")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, source string, copies string")
    got = mixing.mix_digest(df).collect()
    size = lambda t: len((t or "").split())
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    want = brute_targets(sizes)
    assert len(got) == len(rows)
    by_target = collections.Counter()
    most = collections.Counter()
    for r in got:
        assert r.taken <= 2 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        by_target[r.source_size, round(r.target, 6)] += r.taken
        most[r.source_size, round(r.target, 6)] = max(most[r.source_size, round(r.target, 6)], r["size"])
    assert set(by_target) == {(sizes[s], round(want[s], 6)) for s in sizes}
    for k, taken in by_target.items():
        assert abs(taken - k[1]) <= most[k] / 2 + 1e-6
    again = mixing.mix_digest(df.repartition(7)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r["size"], r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    words = collections.Counter()
    for r in mixed.collect():
        words[r.source] += size(r.text)
    assert all(words[s] == by_target[sizes[s], round(want[s], 6)] for s in sizes)
    assert mixing.mix_digest(df.limit(0)).count() == 0 and mixing.mixed_documents(df.limit(0)).count() == 0


def test_mixing_is_fair(spark):
    rows = [(i, "w " * (1 + i % 7), "abc"[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = collections.Counter()
    for seed in range(12):
        for r in mixing.mix_plan(df, seed=seed, block=8).collect():
            taken[r.source] += r.copies
    plan = mixing.mix_plan(df).collect()
    for s in "abc":
        rate = next(r.target / r.source_size for r in plan if r.source == s)
        assert abs(taken[s] / (12 * 20) - rate) < 0.15


def test_warc_round_trip(spark):
    big = "<p>é</p>" * 200
    rows = [(1, "http://a/\r\nX: y", big), (2, None, big), (3, "http://b/ü", "small"), (4, "http://b", "small"), (5, "http://c", None),
            (6, "u", ""), (7, "u", "x" * 2_000_000), (None, "n", big), (9, "d", "dup" * 500), (9, "d", "dup" * 500), (8, "d", "dup" * 500)]
    df = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, payload string")
    folder = f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid.uuid4().hex}"
    manifest = warc.write_archives(df, folder, archive_bytes=4000)
    got = warc.read_archives(manifest, folder).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.page_id].append(r)
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    for page, _, html in rows:
        for r in by[page]:
            assert (r.payload_bytes, r.payload_digest) == (len((html or "").encode()), sha(html))
            if r.record_type == "response":
                assert bytes(r.payload) == (html or "").encode()
    kind = {p: sorted({(r.record_type, r.refers_to) for r in rs}, key=str) for p, rs in by.items()}
    assert kind[1] == [("revisit", 2)] and kind[2] == [("response", None)] and kind[None] == [("revisit", 2)]
    assert kind[3] == kind[4] == kind[5] == kind[7] == [("response", None)]
    assert kind[9] == [("response", None)] and kind[8] == [("revisit", 9)]
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_warc_reader_detects_damage():
    raw = warc.write_record(1, "http://a", b"payload one") + warc.write_record(2, None, b"p" * 70000, 1)
    one_by_one = lambda data, n: iter([data[i:i + n] for i in range(0, len(data), n)])
    for n in (1, 7, 1 << 16):
        assert [r["page_id"] for r in warc.read_records(one_by_one(raw, n))] == [1, 2]
    with pytest.raises(warc.WarcError):
        list(warc.read_records(iter([raw[:-5]])))
    import gzip
    plain = gzip.decompress(warc.write_record(1, "http://a", b"payload one"))
    for bad in (plain.replace(b"payload one", b"payload two"), plain[:-1], plain + b"x", plain.replace(b"Content-Length: 9", b"Content-Length: 8")):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(iter([gzip.compress(bad)])))


URLS = ["http://www.example.com/en/1", "https://example.com/en/2", "http://a.example.com/en/3", "http://Blog.Example.com/de/4", "http://x.net/es/5",
        "http://net/es/6", "http://xnet/es/7", "http://x.net/fr", "no scheme", None, "http://h?q=/en/", "http://h#f", "://", "http://COM/x",
        "http://evilexample.com/en/", "http://x.org/en/8", "x://y://z/p", "http://ÄB.com/a"]


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host_end = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    host, tail = rest[:host_end], rest[host_end:]
    path = tail[:min([tail.index(c) for c in "?#" if c in tail] + [len(tail)])]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, _ in uf.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best)):
            best = rule
    return host, path, best


def test_url_rules(spark):
    rows = [(i, u, "<title>some blog words</title>", "c", "own") for i, u in enumerate(URLS)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string, slots string")
    for r in uf.judge_urls(df).collect():
        assert r.slots == "own"
        assert (r.host, r.path, r.rule) == brute_rule(URLS[r.page_id])
        assert r.verdict == dict(uf.RULES)[r.rule] if r.rule else r.verdict in ("allow", "block")
    assert uf.judge_urls(df.limit(0)).count() == 0
    assert {r.verdict for r in uf.judge_urls(df, rules=[]).collect()} == {"allow"}


def test_url_words_come_from_whole_pages(spark):
    body = ("<html><head><title>none</title><STYLE>red{}</STYLE><script type='x'>if (a < b) hush('</p>')</script ></head>"
            "<!-- hush > hush --><p class='hush'>Green&amp;<b>House</b> 5 < 6</p><p>tea&#32;pot</p>")
    rows = [(1, "http://greenhouse.com/a", body), (2, "http://teapot.com/b", "<p>tea pot</p><script>hush hush"),
            (3, "http://hushhush.org/c", None), (4, "http://redred.org", "pot <!-- red red")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.word: r.n for r in uf.word_counts(uf.page_text(F.col("html")), df).collect()}
    assert got == {"none": 1, "green": 1, "house": 1, "tea": 2, "pot": 3}
    words = {r.page_id: r.host_words for r in uf.judge_urls(df).collect()}
    assert words[1].startswith("green house ") and words[2].startswith("tea pot ")
    open_ends = [(i, x * 200_000) for i, x in enumerate(("<a", "<!--", "<script>", "<", "a ", "&a"))]
    big = spark.createDataFrame(open_ends, "page_id long, html string")
    assert {r.word: r.n for r in uf.word_counts(uf.page_text(F.col("html")), big).collect()} == {"a": 400_000}


def test_addresses_are_no_words(spark):
    body = ("Green house. See http://greenhouse.example.com/x?y=z or www.greenhouse.com, greenhouse.org. "
            "Grün.haus a.b. end. tea-pot (tea.pot)")
    df = spark.createDataFrame([(1, body)], "page_id long, html string")
    got = {r.word: r.n for r in uf.word_counts(uf.page_text(F.col("html")), df).collect()}
    assert got == {"green": 1, "house": 1, "see": 1, "or": 1, "end": 1, "tea": 1, "pot": 1}
    # long runs cost one pass and no stack
    long = [(i, x * 200_000) for i, x in enumerate(("ab", "a.", "://", "a-", ".", "é:"))]
    big = spark.createDataFrame(long, "page_id long, html string")
    assert {r.word for r in uf.word_counts(uf.page_text(F.col("html")), big).collect()} == {"a", "é"}
    # a host's longest label can be one word
    label = "x" * 63
    df = spark.createDataFrame([(1, f"http://{label}yes.com/", f"{label} yes b org com"), (2, "http://b.org/", None)],
                               "page_id long, url string, html string")
    assert {r.page_id: r.host_words for r in uf.judge_urls(df).collect()} == {1: f"{label} yes com", 2: "b org"}


def plain_bayes(rows, bits):
    """Verdicts and scores of undecided urls by counting in dictionaries; the hosts' runs are words as they are."""
    import math
    import re
    counts, priors, out = {"allow": {}, "block": {}}, {"allow": 0, "block": 0}, {}
    runs = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    tokens = lambda h, p: ([("host", w) for w in h] + [
        ("path", "0" if t[0].isdigit() else t) for t in re.findall(r"[^\W\d_]+|\d+", p.lower())])
    for _, url in rows:
        host, path, rule = brute_rule(url)
        if rule:
            verdict, name = dict(uf.RULES)[rule], rule.split("/", 1)[0]
            host_words = runs(host)[:len(runs(host)) - len(runs(name))]
            priors[verdict] += 1
            for t in tokens(host_words, path[len(rule) - len(name):]):
                counts[verdict][t] = counts[verdict].get(t, 0) + 1
    total = {v: sum(counts[v].values()) for v in counts}
    for i, url in rows:
        host, path, rule = brute_rule(url)
        if rule is None:
            odds = math.log((priors["block"] + 1) / (priors["allow"] + 1))
            for t in tokens(runs(host), path):
                if t in counts["allow"] or t in counts["block"]:
                    odds += (math.log(counts["block"].get(t, 0) + 1) - math.log(total["block"] + 2 ** bits)
                             - math.log(counts["allow"].get(t, 0) + 1) + math.log(total["allow"] + 2 ** bits))
            out[i] = odds
    return out


def test_undecided_urls_against_plain_bayes(spark):
    import math
    names = ["news", "shop", "pills", "blog"]
    urls = [None, "no scheme", "http://news.org/cheap/1", "http://pills.org/cheap/2", "http://blog.pills.net/x/3",
            "http://news.net/daily/9", "http://" + "pills." * 3000 + "org/" + "cheap/" * 3000, "http://x.org"]
    urls += [f"http://{n}.com/daily/{i}" for i, n in enumerate(names * 3)]
    urls += [f"http://pills.net/es/cheap/{i}" for i in range(9)] + ["http://shop.net/fr/", "http://a.example.com/en/cheap"]
    urls += urls[3:5] * 2  # repeated rows
    rows = list(enumerate(urls))
    html = " ".join(names * 50 + ["com", "net", "org", "example"] * 50)
    df = spark.createDataFrame([(i, u, html) for i, u in rows], "page_id long, url string, html string")
    want = plain_bayes(rows, 18)
    got = {r.page_id: r for r in uf.judge_urls(df).collect()}
    assert len(got) == len(rows)
    for i, odds in want.items():
        score = 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0
        assert abs(got[i].block_score - score) < 1e-9
        assert got[i].verdict == ("block" if odds > 0 else "allow")
    assert {got[i].verdict for i in want} == {"allow", "block"}


def test_segmentation_is_the_best_split():
    import itertools
    import math
    logp = {w: math.log(p) for w, p in {"the": .3, "red": .2, "house": .1, "ho": .05, "use": .05, "t": .01, "her": .1, "ed": .1}.items()}
    total = math.log(1000)
    cost = lambda w: logp.get(w, math.log(10) - total - len(w) * math.log(10))
    for run in ("theredhouse", "therhouse", "zzthe", "h"):
        best = max((sum(cost(run[a:b]) for a, b in zip((0, *c), (*c, len(run)))), [run[a:b] for a, b in zip((0, *c), (*c, len(run)))])
                   for k in range(len(run)) for c in itertools.combinations(range(1, len(run)), k))
        assert math.isclose(sum(map(cost, uf.best_split(run, logp, total))), best[0])
    assert uf.best_split("theredhouse", logp, total) == ["the", "red", "house"]


def test_bayes_scores(spark):
    df = spark.createDataFrame([("allow", [1, 2]), ("allow", [1]), ("block", [3, 3, 2])], "label string, slots array<int>")
    odds, prior = uf.train_bayes(df, 4)
    assert np.isclose(odds[3], np.log((2 + 1) / (3 + 16)) - np.log((0 + 1) / (3 + 16)))
    assert odds[5] == 0 and np.isclose(prior, np.log(2 / 3))


def test_multi_index_probing_finds_the_whole_ball():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 2 ** 16, (500, 4)).astype(np.uint16)
    codes[100:200] = codes[:100] ^ (1 << rng.integers(0, 16, (100, 4))).astype(np.uint16)
    index = mi.SubstringIndexes(codes)
    for radius in (0, 1, 3, 4, 7, 24, 30):
        assert (index.within(codes[:50], radius) == (mi.hamming(codes[:50], codes) <= radius)).all()


def test_nearest_recall_and_ties(spark):
    emb = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = mi.nearest(emb, F.col("vec_id") % 20 == 0).collect()
    rows = emb.select("vec_id", "embedding").toPandas()
    x, ids = np.array(rows.embedding.tolist(), np.float64), rows.vec_id.to_numpy()
    hits = total = 0
    by = collections.defaultdict(list)
    for r in got:
        by[r.query_id].append(r)
    for i in np.flatnonzero(ids % 20 == 0):
        s = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -s)) if j != i][:20]
        mine = sorted(by[ids[i]], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, len(mine) + 1))
        for r in mine:
            assert abs(r.score - s[np.flatnonzero(ids == r.vec_id)[0]]) < 1e-12
        hits += len({r.vec_id for r in mine} & set(ids[order]))
        total += len(order)
    assert hits / total >= 0.9


def test_nearest_fills_every_query(spark):
    """k rows for each query, or all others: tight groups, outliers, one with negative products, small tables."""
    rng = np.random.default_rng(4)
    heart = rng.normal(size=(10, 16))
    x = np.concatenate([np.repeat(heart, 200, axis=0) + rng.normal(size=(2000, 16)) * 1e-4, rng.normal(size=(8, 16)),
                        -heart.sum(axis=0)[None] * 3])
    ids = rng.permutation(len(x)) * 20
    asked = [int(i) for i in (*ids[:2000:100], *ids[2000:])]

    def count(ids, x, asked, **kw):
        df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
        by = collections.defaultdict(list)
        for r in mi.nearest(df, F.col("vec_id").isin(asked), **kw).collect():
            by[r.query_id].append(r)
        for q, rs in by.items():
            rs.sort(key=lambda r: r.rank)
            assert [r.rank for r in rs] == list(range(1, len(rs) + 1)) and len({r.vec_id for r in rs} - {q}) == len(rs)
            assert [r.score for r in rs] == sorted((r.score for r in rs), reverse=True)
        return {q: len(by[q]) for q in asked}

    assert count(ids, x, asked, block_bytes=64 << 10) == dict.fromkeys(asked, 20)
    for n in (2, 21, 40):
        few = [int(i) for i in ids[-n:]]
        assert count(ids[-n:], x[-n:], few) == dict.fromkeys(few, min(20, n - 1))


def test_nearest_odd_rows(spark):
    v = [1.0, 2.0, 0.0, 1.0]
    rows = [(0, v), (20, [float("nan"), 1.0, 1.0, 1.0]), (40, None), (60, [0.0] * 4), (80, [1.0, None, 1.0, 1.0]), (100, [1.0] * 3), (120, []),
            (None, v), (3, v), (2, v), (2, v), (1, v), (5, [-1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in mi.nearest(df, F.col("vec_id") % 20 == 0, k=3).collect()]
    assert sorted(got) == [(0, 1, 1, 6.0), (0, 2, 2, 6.0), (0, 3, 3, 6.0)]
    assert mi.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
