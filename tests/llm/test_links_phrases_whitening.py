"""URL verdicts over the link graph, phrase collocations and whitening, against brute force on small tables."""

import collections
import itertools
import random
import re

import numpy as np
import pytest

from coursematch.llm import collocations as coll
from coursematch.llm import whitening as white
from coursematch.llm.linkgraph import Rule, judge
from coursematch.llm.queries import URL_RULES

RULES = [Rule(*r) for r in URL_RULES]
ODD_URLS = [None, "", "no scheme", "http://", "://x.com/a", "HTTP://WWW.Example.COM/en/x?q#f", "http://example.com/en/1", "http://a.example.com/en/", "http://example.com",
            "http://example.com?x/en/", "http://notexample.com/en/", "http://x.net/es/1", "http://x.net/es", "http://x.net/Es/", "http://net/fr/", "http://com/", "http://com", "a://b://c.com/d",
            "http://x.com#/en/", "http://ÄB.com/ü?", "http://x.com:80/", "http://www.example.com/en/"]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1])
    return re.sub("[A-Z]+", lambda x: x.group().lower(), m[1]), m[2]


def fit(host, path):
    found = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(found, key=lambda r: len(r.host + r.path), default=None)


ROUNDS = 12


def by_hand(rows):
    cut = [parts(u) for _, u, _ in rows]
    fits = [fit(*p) for p in cut]
    hosts = collections.defaultdict(list)
    for (h, _), f in zip(cut, fits):
        if h:
            hosts[h].append(f.verdict if f else None)
    links = collections.Counter()
    for (h, _), (_, _, html) in zip(cut, rows):
        for dst in re.findall(r"""(?i)href=["'](?:[a-z]+:)?//([^/?#"'\s<>]+)""", html or ""):
            if h and dst.lower() != h:
                links[h, dst.lower()] += 1
    ranks = []
    for verdict, edges in (("allow", links), ("block", {(b, a): n for (a, b), n in links.items()})):
        out = collections.Counter()
        for (a, _), n in edges.items():
            out[a] += n
        seed = {h: sum(v == verdict for v in vs) / len(vs) for h, vs in hosts.items()}
        rank = dict(seed)
        for _ in range(ROUNDS):
            nxt = collections.defaultdict(float, seed)
            for (a, b), n in edges.items():
                nxt[b] += 0.85 * rank.get(a, 0) * n / out[a]
            rank = nxt
        ranks.append(rank)
    verdicts = []
    for (h, _), f in zip(cut, fits):
        t, d = (round(r.get(h, 0), 6) if h else 0 for r in ranks)
        verdicts.append(f.verdict if f else "block" if d >= 0.5 and d > t else "allow")
    return [(r[0], h, p, f.host + f.path if f else None, v) for r, (h, p), f, v in zip(rows, cut, fits, verdicts)]


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def test_urls_against_rounds_by_hand(spark):
    rnd = random.Random(3)
    hosts = ["good.com", "bad.net", "a.org", "b.org", "c.org", "farm.org", "www.example.com", "example.com", "hub.org", "UP.org"]
    rows = [(i, u, None) for i, u in enumerate(ODD_URLS)]
    for i in range(200):
        h = rnd.choice(hosts)
        to = ["bad.net"] * 4 if h == "farm.org" else rnd.choices(hosts, k=rnd.randrange(4))
        html = "".join(f'<a {rnd.choice(["href", "HREF"])}="{rnd.choice(["http:", "https:", ""])}//{t}/x">y</a>' for t in to) + '<a href="/own">z</a>'
        rows.append((100 + i, f"http://{h}/{rnd.choice(['en', 'es', 'fr', ''])}/{i}", html))
    rows += [rows[-1]] * 3 + [(None, "http://bad.net/de/", None)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, verdict string").repartition(4)
    got = judge(df, RULES, rounds=ROUNDS).collect()
    assert sorted([tuple(r[:5]) for r in got], key=key) == sorted(by_hand(rows), key=key)
    assert any(r.distrust > 0 and r.host in ("farm.org", "a.org") for r in got) and any(r.trust > 0 and r.host == "b.org" for r in got)
    assert judge(df.limit(0), RULES).count() == 0


def test_a_host_that_links_to_blocked_ones_is_blocked(spark):
    link = lambda h: f'<a href="http://{h}/">x</a>'
    rows = [(1, "http://bad.net/es/", None), (2, "http://farm.org/", link("bad.net")), (3, "http://good.com/", link("a.org") + link("b.org")), (4, "http://a.org/", link("bad.net")),
            (5, "http://behind.org/", link("farm.org") * 9), (6, "http://alone.org/", "")]
    got = {r.host: r for r in judge(spark.createDataFrame(rows, "page_id long, url string, html string"), RULES, threshold=0.4).collect()}
    assert {h: r.verdict for h, r in got.items()} == {"bad.net": "block", "farm.org": "block", "good.com": "allow", "a.org": "allow", "behind.org": "allow", "alone.org": "allow"}
    assert got["farm.org"].distrust == got["a.org"].distrust == pytest.approx(0.425) and got["a.org"].trust == pytest.approx(0.425) and got["behind.org"].distrust == pytest.approx(0.36125)


def test_longest_rule_wins_and_ties(spark):
    df = spark.createDataFrame([(1, "http://a.com/xyzw", None)], "page_id long, url string, html string")
    rules = [Rule("com", "/xyzw", "block"), Rule("a.com", "/xy", "allow")]  # equal lengths: the longer host
    for order in itertools.permutations(rules):
        assert judge(df, order).first().verdict == "allow"
    assert judge(df, []).first().rule is None


# ---------------------------------------------------------------- phrases

def phrases_by_hand(rows, least, top, depth=5):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]+", lambda x: x.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, min(depth, len(w) - i) + 1):
                    f[lang, tuple(w[i: i + k])] += 1
    f = {k: v for k, v in f.items() if v >= least}
    out = collections.defaultdict(list)
    for (lang, w), a in f.items():
        if len(w) < 2:
            continue
        if any(g == lang and len(v) > len(w) and b >= a and any(v[i: i + len(w)] == w for i in range(len(v))) for (g, v), b in f.items()):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def phrase_rows():
    rnd = random.Random(8)
    vocab = ["of", "the", "New", "york", "city", "état", "x" * 70, "a-b", "ßt", "mu"]
    rows = []
    for i in range(150):
        w = []
        while len(w) < rnd.randrange(40):
            w += ["new", "York", "city", "Hall"] if rnd.random() < 0.1 else [rnd.choice(vocab) + rnd.choice(["", "", ",", ".", "!\n", "\t", "\x0b"])]
        rows.append((" ".join(w), rnd.choice(["en", "de", None, "und", ""])))
    return rows + [(None, "en"), ("", None), (" .,\n ", "fr"), ("of the " * 3000, "en"), ("y" * 200_000, "en")] + [rows[0]] * 5


@pytest.mark.parametrize("budget, top, depth", [(1 << 19, 2000, 5), (40, 2000, 5), (300, 7, 5), (40, 2000, 3)])
def test_phrases_against_counting(spark, budget, top, depth):
    rows = phrase_rows()
    df = spark.createDataFrame([(t, lang, 1, "s") for t, lang in rows], "text string, lang string, n long, phrase string").repartition(5)
    got = coll.collocations(df, least=3, top=top, depth=depth, budget=budget).collect()
    assert sorted(tuple(r) for r in got) == phrases_by_hand(rows, 3, top, depth)


def test_phrases_of_nothing(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert coll.collocations(df).count() == 0
    assert coll.collocations(spark.createDataFrame([("a b a b", "en")], "text string, lang string")).count() == 0


def test_scores_past_64_bits(spark):
    row = spark.sql("select (1000 * cast(4000000000000000 as decimal(19,0)) * cast(9000000000000000 as decimal(19,0))) div (cast(3000000000000 as decimal(19,0)) * cast(7000000000000 as decimal(19,0))) as s").first()
    assert row.s == 1000 * 4000000000000000 * 9000000000000000 // (3000000000000 * 7000000000000)


def test_packed_suffixes_come_back():
    rng = np.random.default_rng(1)
    for v in (3, 300, 70000):
        words = rng.integers(1, 1 << 63, v, dtype=np.uint64)
        lanes, counts = coll._leaves(words[rng.integers(0, v, (5, 2000))], rng.integers(1, 400, 2000))
        back = coll._unpack(coll._pack(lanes, counts))
        assert (back[0] == lanes).all() and (back[1] == counts).all()


# ---------------------------------------------------------------- whitening

@pytest.mark.parametrize("seed, scale", [(1, [1.0] * 6), (2, [30.0, 9, 3, 1, 1e-2, 0]), (3, [5.0])])
def test_rank_one_updates(seed, scale):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(120, len(scale))) * scale
    x[10:20] = x[5]
    whole, parts = white.Spectrum.empty(len(scale)), [white.Spectrum.empty(len(scale)) for _ in range(4)]
    for i, row in enumerate(x):
        whole.add(row)
        parts[i % 3].add(row)
    for p in parts[1:]:
        parts[0].merge(p)
    scatter = np.cov(x.T, bias=True).reshape(len(scale), -1) * len(x)
    for s in (whole, parts[0]):
        assert s.n == len(x) and np.allclose(s.mean, x.mean(0))
        assert np.allclose(s.vectors.T @ s.vectors, np.eye(len(scale)), atol=1e-12)
        assert np.allclose(s.vectors * s.values @ s.vectors.T, scatter, atol=1e-11 * max(1, np.abs(scatter).max()))


def check_whitened(got, rows, k=4):
    sound = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    quant = [(i, tuple(int(np.floor(256 * float(np.float32(c)))) for c in v)) for i, v in sound]
    fit = sorted({v for _, v in quant})
    n, d = len(fit), len(fit[0])
    x = np.array(fit, float)
    mean = np.array([sum(c) / n for c in zip(*fit)])
    cov = (x - mean).T @ (x - mean) / n
    values, axes = np.linalg.eigh(cov)
    sums = [sum(c) for c in zip(*fit)]
    expect = collections.Counter((i, sum((n * c - s) ** 2 for c, s in zip(v, sums)), j) for i, v in quant for j in range(1, min(k, d) + 1))
    assert collections.Counter((r.vec_id, int(r.deviation), r.component) for r in got) == expect
    first = {}
    for i, v in quant:
        first.setdefault(i, v)
    signs = {}
    for r in got:
        assert r.n == n and abs(r.explained - values[-r.component] / cov.trace()) < 1e-10 and r.identity_error < 1e-9
        if r.vec_id is None:
            continue
        plain = (np.array(first[r.vec_id]) - mean) @ axes[:, -r.component] / np.sqrt(values[-r.component])
        sign = signs.setdefault(r.component, np.sign(plain * r.whitened)) if abs(plain) > 0.1 else None
        if sign is not None:
            assert abs(plain * sign - r.whitened) < 1e-8


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 8)) * [3, 2, 1.5, 1, .5, .3, .2, .1] + 5
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[0][1]) for i in range(100)] + [(None, rows[1][1]), (2000, None), (2001, [None] * 8), (2002, [float("nan")] * 8), (2003, [float("inf")] + [0.0] * 7), (2004, [-0.0] * 8)]
    df = spark.createDataFrame([(i, v, "n", 0) for i, v in rows], "vec_id long, embedding array<float>, n string, component int").repartition(20)
    check_whitened(white.whiten(df).collect(), rows)


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert white.whiten(spark.createDataFrame([], schema)).count() == 0
    one = white.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0])], schema)).collect()
    assert [(r.component, r.whitened, r.identity_error, int(r.deviation)) for r in one] == [(1, None, 0.0, 0), (2, None, 0.0, 0)] * 2
    mixed = white.whiten(spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (5, [])], schema)).collect()
    assert {(r.vec_id, r.component, r.n) for r in mixed} == {(1, 1, 2), (2, 1, 2), (3, 1, 2), (3, 2, 2), (4, 1, 2), (4, 2, 2)}
    assert all(abs(abs(r.whitened) - 1) < 1e-12 for r in mixed if r.component == 1)
    huge = white.whiten(spark.createDataFrame([(i, [1e12 * (i % 7), 3.0 * i]) for i in range(9)], schema)).collect()
    assert {r.vec_id for r in huge} == set(range(9)) and all(abs(r.identity_error) < 1e-4 for r in huge)
