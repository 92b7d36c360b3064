"""Each operator against brute force on small tables, and on nulls, empty tables, repeated rows and odd columns."""

import collections
import functools
import hashlib
import math
import pathlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from coursematch.llm import crf, decontam, hyperplane, kdtree, licenses, linededup, minhash, mixing, suffixdedup, suffixtree
from coursematch.llm.common import Store
from coursematch.llm.components import components
from plain_tree import BITS, Tree

RND = random.Random(5)
VOCAB = ["alpha", "Beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu"]


def sentence(n):
    return " ".join(RND.choice(VOCAB) for _ in range(n))


@functools.cache
def corpus():
    """Texts with exact and near copies, ties, nulls, empty and long texts, a repeated row, and columns with clashing names."""
    texts = [sentence(RND.randint(1, 60)) for _ in range(40)]
    near = sentence(80).split()
    for _ in range(25):
        w = list(near)
        w[RND.randrange(80)] = RND.choice(VOCAB)
        texts.append(" ".join(w))
    texts += [texts[0]] * 6 + ["", " \n\t", None, "one", "one two", sentence(6000), "a\nb\nc\nd\na\nb\nc", "x\na\nb\nc\nd", "\n\n\n"]
    rows = [(i * 3, t, "en" if i % 2 else None, f"s{i % 3}", i, "clash") for i, t in enumerate(texts)]
    return rows + [rows[3], (None, "a row without an id", None, None, None, None)]


SCHEMA = "doc_id long, text string, lang string, source string, size long, rep string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(r[0], i % 4 > 0, i % 5 == 0) for i, r in enumerate(corpus()) if r[0] is not None and i % 2], "doc_id long, quality boolean, toxic boolean").select(
        "doc_id", F.col("quality").cast("int"), F.col("toxic").cast("int")).unionAll(spark.createDataFrame([(None, 1, 1), (0, None, 1), (3, 7, 0)], "doc_id long, quality int, toxic int"))


def words(t):
    return (t or "").encode().lower().split()


def smallest(links, nodes):
    up = {n: n for n in nodes}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, j) for j in range(200, 260)] + [(1, 1), (3, 2), (2, 3), (300, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame([*links, (None, 4)], "a long, b long"), Store(spark, "t")).collect()}
    want = smallest([x for x in links if x[0] != x[1]], {n for x in links for n in x if x != (1, 1)})
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), Store(spark, "t")).count() == 0


@pytest.mark.parametrize("k,limit", [(3, "0.85"), (5, "0.8")])
@pytest.mark.parametrize("block", [3, 128])
def test_minhash(docs, empty, monkeypatch, k, limit, block):
    monkeypatch.setattr(minhash, "BLOCK", block)        # 3: buckets take many blocks
    sets = {}
    for i, t, *_ in corpus():
        w = words(t)
        if i is not None:
            sets[i] = {tuple(w[j: j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    share = float(limit)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and len(sets[a] & sets[b]) * 100 >= round(share * 100) * len(sets[a] | sets[b])]
    want = smallest(links, sets)
    got = minhash.near_duplicates(docs, k, limit).collect()
    assert len(got) == len(corpus())
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles, r.kept) == (want[r.doc_id], len(sets[r.doc_id]), want[r.doc_id] == r.doc_id)
    if block == 3:
        assert minhash.near_duplicates(empty, k, limit).collect() == []


def test_minhash_signature_is_circulant():
    sets = [np.unique(np.random.default_rng(i).integers(0, 1 << 63, 50 + i).astype(np.uint64)) for i in range(5)]
    sig = minhash.signatures(sets, 8, chunk=60)
    for i, s in enumerate(sets):
        for k in range(8):
            assert sig[i, k] == min(int(x) for x in minhash.rank(minhash.scatter(s) + np.uint32(k)))


@pytest.mark.parametrize("block", [4, 512])
def test_hyperplanes(spark, monkeypatch, block):
    monkeypatch.setattr(hyperplane, "BLOCK", block)
    rng = np.random.default_rng(4)
    base = rng.standard_normal((8, 16))
    rows = [(i, (base[i % 8] + rng.standard_normal(16) * (0.05 if i % 3 else 0.3)).tolist(), "x") for i in range(80)]
    rows += [(100, rows[0][1], None), (101, rows[0][1], None), (102, None, ""), (103, [], ""), (104, [0.0] * 16, ""), (105, [float("nan")] * 16, ""), (106, [None] + [1.0] * 15, ""),
             (107, [1.0, 2.0], ""), (108, [2.0, 4.0], ""), (None, rows[0][1], ""), (109, [-0.0, 1.0], ""), (110, [0.0, 1.0], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, code string")
    good = {i: np.array(v) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    links = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b])
             and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.9]
    n = collections.Counter(x for p in links for x in p)
    want = smallest(links, [r[0] for r in rows if r[0] is not None])
    got = hyperplane.near_vectors(df).collect()
    assert len(got) == len(rows) and len(links) > 50
    for r in got:
        assert (r.n_links, r.component_id) == (n[r.vec_id], want.get(r.vec_id))
    assert hyperplane.near_vectors(df.limit(0)).collect() == []


def test_suffix_tree(docs, empty):
    rows = corpus()
    counts = collections.Counter()
    for i, t, *_ in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*words(t), None])
    total, kinds = sum(counts.values()), len(counts)
    got = suffixtree.score(docs).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        w = [*words(text[r.doc_id]), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), total)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w))
        assert math.isfinite(r.score) and r.score < 0
    assert suffixtree.score(empty).collect() == []


def test_suffix_tree_states_are_distributions():
    rng = np.random.default_rng(1)
    seq = [0]
    for _ in range(40_000):         # a chain of order two
        seq.append(int((seq[-1] * 3 + (seq[-2] if len(seq) > 1 else 0) + (rng.random() < 0.2) * rng.integers(1, 6)) % 6))
    t, first = np.array(seq, np.int64) + 10, np.array([0, len(seq)])
    tree = Tree(len(t), 6)
    tree.words, tree.n = np.unique(t, return_counts=True)
    tree.contexts[0] = np.ones(6, bool)
    for level in (0, 1):
        w, ctx = tree.numbers(t, first, level + 1)
        ok = ctx[level] >= 0
        tree.learn(level, *np.unique((ctx[level][ok] << BITS) | w[ok], return_counts=True))
    assert np.isfinite(tree.back[1]).sum() > 10
    smooth = 1 / (tree.total + tree.kinds + 1)          # the root keeps this much for words not seen
    for a in range(6):
        for b in range(6):
            p = sum(10 ** tree.score(np.array([a + 10, b + 10, c + 10]), np.array([0, 3]))[2][2] for c in range(6))
            assert p == pytest.approx(1, abs=2 * smooth)
    _, base, out = tree.score(t, first)
    assert out.mean() > base.mean() + 0.2


def by_hand(train, texts):
    """Scores of a suffix tree over tuples, every context up to its depth tried by its count alone; and the longest kept context."""
    n = collections.Counter(tuple(t[i:j]) for t in train for i in range(len(t)) for j in range(i + 1, len(t) + 1))
    total, kinds = sum(c for g, c in n.items() if len(g) == 1), sum(len(g) == 1 for g in n)
    log = {g: math.log10((c + 1) / (total + kinds + 1)) for g, c in n.items() if len(g) == 1}
    back, length = {}, 0
    while length < suffixtree.DEPTH:
        length += 1
        after = collections.defaultdict(list)
        for g, c in n.items():
            if len(g) == length + 1 and c >= 2 and n[g[:-1]] >= 4:
                after[g[:-1]].append(g)
        kept = {}
        for ctx, found in after.items():
            p, below = [n[g] / n[ctx] for g in found], [10 ** log[g[1:]] for g in found]
            rest = max(1 - sum(p), 1e-12), max(1 - sum(below), 1e-12)
            kl = sum(a * math.log(a / b) for a, b in zip(p, below)) + rest[0] * math.log(rest[0] / rest[1])
            if kl >= 0.01 and 2 * n[ctx] * kl >= len(p) + 3 * math.sqrt(2 * len(p)):
                kept[ctx] = 1 - sum((n[g] - 0.75) / n[ctx] for g in found)
            for g, b in zip(found, below):
                log[g] = math.log10((n[g] - 0.75) / n[ctx] + kept[ctx] * b) if ctx in kept else log[g[1:]]
        back |= kept

    def word(t, i):
        out = log.get((t[i],), math.log10(1 / (total + kinds + 1)))
        for m in range(1, min(i, length) + 1):
            ctx = tuple(t[i - m: i])
            out = log[ctx + (t[i],)] if ctx + (t[i],) in log else out + math.log10(back[ctx]) if ctx in back else out
        return out

    return [sum(word(t, i) for i in range(len(t))) for t in texts], max(map(len, back))


@pytest.mark.parametrize("head, depth", [(1e-6, 3), (2.0, 4)])
def test_suffix_tree_by_hand(spark, monkeypatch, head, depth):
    monkeypatch.setattr(suffixtree, "HEAD", head)     # the same scores whichever runs are joined
    monkeypatch.setattr(suffixtree, "DEPTH", depth)
    rng = random.Random(7)
    rows = []
    for i in range(300):            # a word is one of the three before it
        w = ["a", "b", "c"]
        for _ in range(rng.randint(2, 14)):
            w.append(w[-rng.randint(1, 3)] if rng.random() < 0.9 else rng.choice("abcdefg"))
        rows.append((i, " ".join(w)))
    rows += [(300, ""), (301, "new words b"), (302, "a b c a new b c a")]
    tok = [[*t.split(), None] for _, t in rows]
    want, longest = by_hand([t for (i, _), t in zip(rows, tok) if zlib.crc32(str(i).encode()) % 7 != 2], tok)
    assert longest >= 3
    got = {r.doc_id: r.score for r in suffixtree.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {i: pytest.approx(x) for (i, _), x in zip(rows, want)}


def test_suffix_tree_keeps_rare_contexts_of_a_large_corpus(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 != 2]
    rows = [(i, "so it goes " * 234_000) for i in ids[:10]]
    rows += [(i, f"w{i % 2} v{i % 2}") for i in ids[10:18]]     # four times each among seven million words
    r = {r.doc_id: r for r in suffixtree.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}[ids[12]]
    assert r.train_tokens > 7_000_000 and r.score > r.base_score + 8


def test_suffix_tree_leaves_no_shuffled_runs(spark):
    rng = random.Random(4)
    words_ = [f"w{i}" for i in range(20_000)]
    rows = [(i, " ".join(rng.choices(words_, k=500))) for i in range(400)]
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f: f.stat().st_size for d in folders for f in pathlib.Path(d).glob("*/shuffle_*.data")}
    before = files()
    got = suffixtree.score(spark.createDataFrame(rows, "doc_id long, text string"))
    for _ in range(20):             # files go a little later
        left = sum(n for f, n in files().items() if f not in before)
        if left < 2e6:
            break
        time.sleep(0.5)
    assert left < 2e6               # 200,000 pairs of words, most of them there once, are more
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()


def test_suffix_tree_index():
    rng = np.random.default_rng(5)
    keys = np.unique(np.concatenate([rng.integers(-2**63, 2**63 - 1, 5000), np.arange(-20, 20), [2**63 - 1, -2**63]]))
    rng.shuffle(keys)
    x = np.concatenate([keys, rng.integers(-2**63, 2**63 - 1, 5000), [0, -1, 21]])
    place = {k: i for i, k in enumerate(keys.tolist())}
    assert suffixtree.Index(keys).find(x).tolist() == [place.get(k, -1) for k in x.tolist()]
    assert suffixtree.Index(keys[:0]).find(x[:3]).tolist() == [-1] * 3


def test_decontamination(docs, empty, spark):
    rng = random.Random(2)
    items = [(i, "".join(rng.choice("abcdefghij é") for _ in range(n)).strip() + "z") for i, n in enumerate([60, 120, 300, 90, 11, 3])]

    def damaged(t, n):
        t = list(t)
        for p in rng.sample(range(2, len(t) - 2), n):
            t[p] = rng.choice(["", "X", t[p] + "y"])
        return "".join(t)

    rows, want = [], {}
    for d in range(60):
        i, t = items[d % 4]
        edits = (0, 1, max(1, int(len(t) * 0.05) // 2))[d % 3]
        rows.append((d, sentence(30) + " " + damaged("".join(c.upper() if c.isascii() else c for c in t) if d % 2 else t, edits).replace(" ", "\n ") + sentence(d * 20), "e"))
        want[d] = i
    rows += [(100 + d, sentence(200), "") for d in range(5)] + [(200, None, ""), (201, "", ""), (202, items[2][1][:150], ""), (None, items[1][1], ""), (0, rows[0][1], "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, hits string")
    bench = spark.createDataFrame([*items, (None, "no id but a text that is long"), (50, None)], "item_id long, text string")
    got = decontam.contamination(df, bench).select("row.doc_id", F.col("hits.item_id").alias("items")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["items"] == ([want[r.doc_id]] if r.doc_id in want else [1] if r.doc_id is None else []), r
    assert decontam.contamination(empty, bench).collect() == []
    assert all(r.hits == [] or not r.hits for r in decontam.contamination(df, bench.limit(0)).collect())


def test_decontamination_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 100)
    items = [(i, sentence(12) + f" item {i}") for i in range(7)]
    df = spark.createDataFrame([(i, "so " + t + " on") for i, t in items] + [(9, items[0][1] + " " + items[6][1])], "doc_id long, text string")
    got = {r.doc_id: sorted(h.item_id for h in r.hits) for r in decontam.contamination(df, spark.createDataFrame(items, "item_id long, text string")).select("row.doc_id", "hits").collect()}
    assert got == {**{i: [i] for i, _ in items}, 9: [0, 6]}


def test_banded_alignment():
    rng = random.Random(8)
    for _ in range(150):
        t = "".join(rng.choice("abcd") for _ in range(rng.randint(60, 90)))
        item = decontam.Items([(1, t)])
        u = list(t)
        for p in rng.sample(range(len(t)), rng.randint(0, 5)):
            u[p] = rng.choice(["", "x", "y" + u[p]])
        lead = rng.randint(0, 20)
        doc = "z" * lead + "".join(u) + "z" * 10
        d = [0] * (len(doc) + 1)
        for c in t:                                     # plain semi-global distance
            e = [d[0] + 1]
            for j in range(1, len(doc) + 1):
                e.append(min(d[j - 1] + (c != doc[j - 1]), d[j] + 1, e[-1] + 1))
            d = e
        best = min(d)
        step = int(item.e[0]) + 1
        got = item.edits(0, np.frombuffer(doc.encode(), np.uint8), lead - step, 2 * step)
        assert (got[0] if got else None) == (best if best <= item.e[0] else None)


def test_line_field(docs, labels, empty):
    assert crf.quality(docs, labels).count() == len(corpus())
    assert all(0 <= r.score <= 1 for r in crf.quality(docs, labels).collect())
    assert {r.score for r in crf.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert crf.quality(empty, labels).collect() == []


def test_line_field_learns(spark):
    good = [(i, "\n".join(sentence(8).capitalize() + "." for _ in range(1 + i % 7)), 1) for i in range(120)]
    bad = [(200 + i, sentence(5) + ".\n" + "\n".join(" | ".join(["x!!"] * 9) for _ in range(2 + i % 5)), 0) for i in range(60)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string, q int")
    got = crf.quality(df, df.select("doc_id", F.col("q").alias("quality"))).select("row.*", "score").collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 30 and all((r.score >= 0.5) == (r.q == 1) for r in held)


def test_line_field_takes_bounded_lines(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(crf, "fit", lambda x, first, label: taken.append((len(x), len(label))) or {})
    df = spark.createDataFrame([(i % 60, "a\nb\nc", i % 2) for i in range(90)] + [(100, "x\n" * 6000, 0)], "doc_id long, text string, quality int")
    n = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(60))
    crf.train(df, df)
    crf.train(df, df, fit_lines=31)
    assert taken == [(3 * n, n), (30, 10)]
    assert crf.train(df, df, fit_lines=2) == {"prior": 0.5}


def test_forward_backward():
    rng = np.random.default_rng(0)
    first, odds, step = np.array([0, 1, 4, 9]), rng.standard_normal(9), rng.standard_normal((2, 2))
    p, pairs = crf.chances(odds, first, step)
    want, total = np.zeros(9), np.zeros((2, 2))
    for a, b in zip(first, first[1:]):
        z, marginal, joint = 0, np.zeros(b - a), np.zeros((2, 2))
        for bits in range(1 << (b - a)):
            y = [(bits >> i) & 1 for i in range(b - a)]
            w = math.exp(sum(odds[a + i] * y[i] for i in range(b - a)) + sum(step[y[i], y[i + 1]] for i in range(b - a - 1)))
            z += w
            marginal += w * np.array(y)
            for i in range(b - a - 1):
                joint[y[i], y[i + 1]] += w
        want[a:b] = marginal / z
        total += joint / z
    assert np.allclose(p, want) and np.allclose(pairs, total)


def test_lines_of_features():
    texts = ["", "a", "\n", "ab\n\ncd", "THE THE THE\nx | y"]
    raw = "".join(texts).encode()
    offs = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    x, size, first = crf.features(np.frombuffer(raw, np.uint8), offs)
    assert [list(size[a:b]) for a, b in zip(first, first[1:])] == [[len(line) for line in t.split("\n")] for t in texts]
    assert x[-2, 6] == pytest.approx(2 / 3) and x[-1, 4] == pytest.approx(1 / 5)


@pytest.mark.parametrize("n", [1, 3, 40])
def test_kd_tree(docs, empty, n):
    got = kdtree.shard(docs, n_shards=n).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in got) == sorted(-1 if r[0] is None else r[0] for r in corpus())
    text = {r[0]: r[1] for r in corpus()}
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None) and 0 <= r.shard < n
    for s in range(n):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    if n == 40:
        assert kdtree.shard(empty).collect() == []


def test_kd_tree_sizes(spark):
    """Near-equal bytes although one text has a third of all rows; other copies stay together."""
    rows = [(i, "hot " * 50 if i % 3 == 0 else f"text {i % 900} " * (1 + i % 37), "en", f"s{i % 5}") for i in range(6000)]
    got = kdtree.shard(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), n_shards=12).collect()
    size, of = collections.Counter(), collections.defaultdict(set)
    for r in got:
        size[r.shard] += r.size
        of[r.text_crc32].add(r.shard)
    assert len(size) == 12 and max(size.values()) <= 1.03 * min(size.values())
    assert sorted(len(s) for s in of.values())[:-1] == [1] * (len(of) - 1)
    assert kdtree.shard(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), n_shards=None, target_bytes=100_000).agg(F.max("shard")).first()[0] >= 5


def test_license_scan(spark, docs, empty):
    texts = ["All rights reserved. Licensed under CC BY-NC 4.0.", "cc by cc by\ncc", "the GNU General  Public\nLicense", "general publiç license", "",
             "Permission is hereby granted, free of charge, to any and every person obtaining a copy of this software", None, "all rights, reserved rights reserved", "Released under the MIT License."]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "x"), (None, "cc by", ""), (None, "all rights", ""), (None, "x rights reserved", "")], "doc_id long, text string, label string")
    rows = licenses.scan(df).collect()
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert len(rows) == 13 and len(got) == 9 and sum(r.doc_id == 0 for r in rows) == 2
    # words of one row never complete a phrase of another without a doc_id
    assert sorted((r.n_words, r.n_base, r.base_labels) for r in rows if r.doc_id is None) == [(2, 0, ""), (2, 1, "cc-by"), (3, 0, "")]
    for i, t in enumerate(texts):
        w = [x.decode() for x in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())]
        at = [(j, lab) for ph, lab in licenses.BASE.items() for j in range(len(w)) if w[j: j + len(ph.split())] == ph.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(sorted({lab for _, lab in at})))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
    assert got[0].labels == "cc-by,cc-by-nc-4.0,reserved" and got[5].labels == "mit" and got[8].labels == "mit" and got[5].score >= licenses.COVER
    assert got[4].labels == "" and got[4].score == 0
    assert licenses.scan(empty).collect() == []


def test_line_windows(docs, empty):
    rows = {r[0]: r[1] for r in corpus() if r[0] is not None}
    seen, gone = {}, collections.defaultdict(set)
    for i in sorted(rows):
        lines = rows[i].split("\n") if rows[i] is not None else []
        for j in range(len(lines) - 2):
            if seen.setdefault(tuple(lines[j: j + 3]), (i, j)) != (i, j):
                gone[i] |= {j, j + 1, j + 2}
    got = linededup.drop_repeated_lines(docs).collect()
    assert len(got) == len(corpus()) and sum(map(len, gone.values())) > 5
    for r in got:
        if r.doc_id is None:
            assert (r.n_removed, r.text) == (0, "a row without an id")
            continue
        lines = rows[r.doc_id].split("\n") if rows[r.doc_id] is not None else None
        assert r.n_removed == len(gone[r.doc_id])
        assert r.text == (None if lines is None else "\n".join(x for j, x in enumerate(lines) if j not in gone[r.doc_id]))
    assert linededup.drop_repeated_lines(empty).collect() == []


def test_line_windows_of_texts_with_one_id(spark):
    """Only the text that repeats a passage is cut, not another one of the same doc_id."""
    rows = [(1, "a\nb\nc"), (2, "p\na\nb\nc\nq"), (2, "v\nw\nx\ny\nz"), (2, "v\nw\nx\ny\nz"), (2, None)]
    got = linededup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_removed, r.text or "") for r in got) == [
        (1, 3, 0, "a\nb\nc"), (2, 0, 0, ""), (2, 5, 0, "v\nw\nx\ny\nz"), (2, 5, 0, "v\nw\nx\ny\nz"), (2, 5, 3, "p\nq")]


def test_deep_shallow_sort():
    rng = random.Random(3)
    for _ in range(60):
        base = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 100))) for _ in range(4)]
        strings = [b[: rng.randint(0, len(b))] + bytes(rng.choice(b"abc\0") for _ in range(rng.randint(0, 3))) for b in (rng.choice(base) for _ in range(rng.randint(1, 60)))]
        group = np.array([rng.randint(0, 2) for _ in strings])
        order, lcp = suffixdedup.deep_shallow(group, strings)
        got = [(group[i], strings[i]) for i in order]
        assert got == sorted(got)
        for x in range(1, len(order)):
            (g, s), (h, t) = got[x - 1], got[x]
            assert lcp[x] == (-1 if g != h else next((j for j, (c, d) in enumerate(zip(s, t)) if c != d), min(len(s), len(t))))


@pytest.mark.parametrize("most", [2, 20_000])
def test_repeated_bytes(spark, docs, empty, monkeypatch, most):
    monkeypatch.setattr(suffixdedup, "MOST", most)      # 2: large buckets are settled window by window
    rng = random.Random(3)
    parts = ["".join(rng.choice("abcdefgh é\n") for _ in range(400)) for _ in range(6)]
    rows = []
    for i in range(120):
        s = ""
        for _ in range(rng.randint(0, 4)):
            x = rng.randint(0, 300)
            s += rng.choice(parts)[x: x + rng.randint(20, 300)] + rng.choice(["", "x", "For " * rng.randint(0, 60)])
        rows.append((i, s if i % 17 else None, "x"))
    rows += [(500, rows[1][1], ""), (501, rows[1][1], ""), rows[5], (None, rows[1][1], "")]
    seen, want = {}, {}
    for i, t in sorted({(r[0], r[1] or "") for r in rows if r[0] is not None}):
        b = t.encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 99):
            if seen.setdefault(b[p: p + 100], (i, p)) != (i, p):
                gone[p: p + 100] = True
        want[i] = (len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    got = suffixdedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string, seg string").repartition(4)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]
    if most == 2:
        assert suffixdedup.drop_repeats(empty).collect() == []


def test_mixing(docs, labels, empty):
    assert mixing.mix(docs, labels).count() == len(corpus())
    assert all(r.rate == pytest.approx(1) for r in mixing.mix(docs, labels.limit(0)).collect())
    assert mixing.mix(empty, labels, shares={"clean": 1.0}).collect() == []


def test_mixing_meets_targets(spark):
    rng = random.Random(6)
    rows, marks = [], []
    for i in range(900):
        kind = rng.choice([0, 0, 0, 1, 2])
        w = sentence(rng.randint(5, 60)).split()
        for _ in range(4):
            w.insert(rng.randrange(len(w)), ["calm", "||", "vile"][kind])
        rows.append((i, " ".join(w)))
        marks.append((i, int(kind != 1), int(kind == 2)))
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    shares = {"clean": 0.7, "low": 0.25, "toxic": 0.05}
    out = mixing.mix(df, lab, shares=shares).select("row.doc_id", "n_tokens", "p0", "p1", "p2", "rate").toPandas()
    total = out.n_tokens.sum()
    for i, d in enumerate(mixing.DOMAINS):
        assert (out.rate * out.n_tokens * out[f"p{i}"]).sum() / total == pytest.approx(shares[d], abs=1e-4)
    assert (out.rate >= 0).all()
    want = np.array([2 if t else 1 - q for _, q, t in marks])
    assert (out.sort_values("doc_id")[["p0", "p1", "p2"]].to_numpy().argmax(axis=1) == want).mean() > 0.97
    assert mixing.mix(df, lab, factors={"toxic": 0.0}, keep=["doc_id"]).where("p2 > 0.9").agg(F.max("rate")).first()[0] < 0.3


def test_mixing_learns_words_of_a_small_language(spark):
    rng = random.Random(8)
    rows, marks = [], []
    for i in range(1200):
        kind = (0, 0, 0, 1, 2)[i % 5]
        w = sentence(20).split()
        if kind == 2 and i % 15 != 4:
            w += rng.sample([f"vile{j}" for j in range(80)], 40)        # more and commoner words than the small language has
        elif kind == 2:
            w.append("malo")
        rows.append((i, " ".join(w)))
        marks.append((i, int(kind != 1), int(kind == 2)))
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = mixing.classifier(df, lab)["words"]
    assert "malo" in found and len(found) >= 81
    assert found["malo"][2] > max(found["malo"][:2])
