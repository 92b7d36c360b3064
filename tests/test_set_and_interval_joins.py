"""Gram-index wildcard join, sweep overlap join, set containment, numbered characters, one-pass code replacement."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from coursematch.functions.codes import ALL_CODES, CRITERIA_CODES, replace_codes
from coursematch.operators.containment import accepted_combinations, code_mask
from coursematch.operators.explode import code_flags, code_flags_by_index, indexed_characters
from coursematch.operators.joins import overlap_join, overlapping_intervals, pattern_candidates, wildcard_join

KEY = lambda t: tuple((v is not None, v) for v in t)


def regex(p):
    return re.compile("".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in p), re.S)


def patterns_and_values():
    rnd = random.Random(12)
    patterns = {"".join(rnd.choice("AB1 _%\\ñ") for _ in range(rnd.randint(0, 8))) for _ in range(500)}
    patterns |= {"%AB%", "%A_B%", "A%B%1", "%", "%%", "", "_", "__%", "%ñ", "A%", "%1_", "_A%_B"}
    values = {"".join(rnd.choice("AB1 \\ñ\n") for _ in range(rnd.randint(0, 9))) for _ in range(200)} | {"", "A", "AB"}
    return sorted(patterns), sorted(values)


def test_wildcards_inside_and_out_against_regex(spark):
    patterns, values = patterns_and_values()
    left = spark.createDataFrame([(i, p) for i, p in enumerate([*patterns, patterns[3], None])], "pid int, pat string")
    right = spark.createDataFrame([(v, k) for v in values for k in range(1 + (v == "AB"))] + [(None, 9)], "val string, copy int")
    expected = []
    for r in left.collect():
        hits = [(v, c) for v in values for c in range(1 + (v == "AB")) if r.pat is not None and regex(r.pat).fullmatch(v)]
        expected += [(r.pid, *h) for h in hits] or [(r.pid, None, None)]
    assert rows(wildcard_join(left, right, "pat", "val"), "pid", "val", "copy") == sorted(expected, key=KEY)
    assert rows(wildcard_join(left, right, "pat", "val", how="inner"), "pid", "val", "copy") == sorted((e for e in expected if e[1] is not None), key=KEY)


def test_candidates_are_those_of_the_rarest_gram(spark):
    """600 courses of 40 subjects: a pattern without a literal prefix meets those of its rarest gram."""
    subjects = ["".join(p) for p in itertools.islice(itertools.product("ABCDE", "FGHI", "KL"), 40)]
    values = spark.createDataFrame([(f"{s} {100 + 7 * i % 600}",) for i, s in enumerate(subjects * 15)], "value string").distinct()
    patterns = spark.createDataFrame([("_FK 1__",), ("%FK 12%",), ("___ 107",), ("%GL%9",), ("*",), ("A%",)], "pattern string")
    got = {r.pattern: r.n for r in pattern_candidates(patterns, values).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()}
    all_values = [r.value for r in values.collect()]

    def fewest(p):
        """Fewest values that have one of the pattern's grams of up to three characters at its place."""
        if "%" in p:
            parts = p.split("%")
            spots = [("s", i, parts[0]) for i in range(len(parts[0]))] + [("e", i, parts[-1][::-1]) for i in range(len(parts[-1]))] + [("f", i, t) for t in parts[1:-1] for i in range(len(t))]
        else:
            spots = [("x", i, p) for i in range(len(p))]
        counts = []
        for kind, i, text in spots:
            g = text[i: i + 3].split("_")[0]
            if g:
                counts.append(sum({"x": len(v) == len(p) and v[i: i + len(g)] == g, "s": v[i: i + len(g)] == g, "e": v[::-1][i: i + len(g)] == g, "f": g in v}[kind] for v in all_values))
        return min(counts)

    assert got == {p: fewest(p) for p in ("_FK 1__", "%FK 12%", "___ 107", "%GL%9", "A%") if fewest(p)}
    assert got["_FK 1__"] <= len(all_values) / 10      # a key of one character would meet a quarter


def interval_rows(rnd, n, keys):
    out = []
    for i in range(n):
        a, b = rnd.randrange(30), rnd.randrange(30)
        kind = rnd.random()
        s, e = (min(a, b), max(a, b)) if kind < 0.7 else (max(a, b), min(a, b)) if kind < 0.8 else (None, b) if kind < 0.87 else (a, None) if kind < 0.94 else (None, None)
        out.append((i, rnd.choice(keys), *(f"{x:02d}" if x is not None else None for x in (s, e)), rnd.random() < 0.8))
    return out + out[:5]


def meets(a, b, c, d):
    inside = lambda x, lo, hi: None not in (x, lo, hi) and lo <= x <= hi
    return inside(c, a, b) or inside(d, a, b) or inside(a, c, d) or inside(b, c, d)


@pytest.mark.parametrize("bins", [1, 5, 64])
def test_overlaps_with_reversed_null_and_repeated_intervals(spark, bins):
    rnd = random.Random(bins)
    keys = ["hot"] * 6 + ["k1", "k2", None]
    left, right = interval_rows(rnd, 90, keys), interval_rows(rnd, 70, keys)
    l = spark.createDataFrame(left, "id int, k string, s string, e string, on boolean")
    r = spark.createDataFrame(right, "rid int, rk string, rs string, re string, x boolean").drop("x")
    expected = []
    for a in left:
        hits = [b[:4] for b in right if a[4] and a[1] is not None and a[1] == b[1] and meets(a[2], a[3], b[2], b[3])]
        expected += [(*a, *h) for h in hits] or [(*a, None, None, None, None)]
    args = dict(keys=[(F.col("k"), F.col("rk"))], left_interval=(F.col("s"), F.col("e")), right_interval=(F.col("rs"), F.col("re")), condition=F.col("on"), bins=bins)
    assert rows(overlap_join(l, r, **args)) == sorted(expected, key=KEY)
    assert rows(overlap_join(l, r, how="inner", **args)) == sorted((e for e in expected if e[5] is not None), key=KEY)


def test_a_pair_of_intervals_comes_out_once_and_near_bins_only(spark):
    """4,000 intervals of one key, each over 3 of 4,000 days: the sweep meets its neighbours, not 16 million pairs."""
    days = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("_s"), (F.col("id") + 2).alias("_e"))
    found = overlapping_intervals(days, days, ["k"], bins=256)
    assert found.count() == found.distinct().count() == sum(min(3999, i + 2) - max(0, i - 2) + 1 for i in range(4000))


def subset(a, w):
    return set(a) <= set(w)


def test_accepted_combinations_against_python_sets(spark):
    rnd = random.Random(2)
    codes = [*CRITERIA_CODES[:6], *CRITERIA_CODES[-2:]]
    word = lambda n: "".join(rnd.choice(codes) for _ in range(rnd.randint(0, n)))
    criteria = [(word(3), word(2), word(4)) for _ in range(150)] + [("", "", ""), (None, None, None), ("?", "", ""), ("", "?", ""), ("", "", "?H"), ("H?", "G", "")]
    combos = [(word(5),) for _ in range(60)] + [("",), (None,), ("?",), ("H?",), ("Hor",), ("H",)]
    c, w = spark.createDataFrame(criteria * 2, "ac_all string, rc_ord string, rc_and string"), spark.createDataFrame(combos * 2, "ac_cw string")
    got = accepted_combinations(c, w, CRITERIA_CODES)
    expected = {(a or "", o or "", n or "", x or "") for a, o, n in criteria for (x,) in combos
                if subset(a or "", x or "") and not set(o or "") & set(x or "") and not (n and x and subset(x, n))}
    assert rows(got) == sorted(expected)
    pairs = c.distinct().crossJoin(w.distinct())
    assert rows(got) == rows(code_flags(pairs).where("ac_match = 1 and rc_ord_match = 1 and rc_and_match = 1").drop("ac_match", "rc_ord_match", "rc_and_match").distinct())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_masks(spark):
    df = spark.createDataFrame([("",), (None,), ("G",), ("HG",), ("GG",), ("x?",)], "v string")
    assert [r.m for r in df.select(code_mask(F.col("v"), ("G", "H", "x")).alias("m")).collect()] == [0, 0, 1, 3, 1, 4 | 1 << 62]
    with pytest.raises(ValueError):
        code_mask(F.col("v"), ("ab",))


def test_numbered_characters_and_their_flags(spark):
    strings = spark.createDataFrame([("Hñ",), ("",), (None,), ("abc",), ("abc",)], "s string")
    assert rows(indexed_characters(strings)) == [("Hñ", 1, "H"), ("Hñ", 2, "ñ"), ("abc", 1, "a"), ("abc", 2, "b"), ("abc", 3, "c")]
    with pytest.raises(Exception, match="over 60"):
        indexed_characters(spark.createDataFrame([("x" * 61,)], "s string")).collect()
    rnd = random.Random(1)
    word = lambda: None if rnd.random() < 0.1 else "".join(rnd.choice("GHcñ") for _ in range(rnd.randint(0, 3)))
    pairs = spark.createDataFrame([tuple(word() for _ in range(4)) for _ in range(300)], "ac_all string, rc_ord string, rc_and string, ac_cw string")
    assert rows(code_flags_by_index(pairs)) == rows(code_flags(pairs))


def chained(value):
    for long_code, short_code in ALL_CODES.items():
        value = re.sub(rf"(?<![a-zA-Z]){long_code}(?![a-zA-Z])", short_code, value)
    return value


def test_code_tokens_as_if_replaced_in_table_order(spark):
    rnd = random.Random(6)
    pieces = [*ALL_CODES, "h", "c", "Z", "or", "OR", " ", "&", "(", ")", "¿", "1", "\n", "ñ", "_", ""]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 9))) for _ in range(2000)] + ["H HU", "HU & H", "CSCS", "C-CS"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", replace_codes(F.col("t")).alias("r"))
    assert {r.i: r.r for r in got.collect()} == {i: chained(t) for i, t in enumerate(texts)}
    assert spark.createDataFrame([(None,)], "t string").select(replace_codes(F.col("t"))).first()[0] is None
