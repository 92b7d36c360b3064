
import itertools
import random
import re

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from coursematch.functions import criteria as crit
from coursematch.operators.explode import code_flags
from coursematch.operators.joins import wildcard_join
from coursematch.plans.rules import PAIR, expand_rules, requirement_pairs
from coursematch.queries import inputs

ALPHABET = ["a", "B", "ñ"]
STRINGS = [""] + ["".join(p) for n in (1, 2) for p in itertools.product(ALPHABET, repeat=n)]


def _py_flags(a, o, n, w):
    """The criteria semantics on Python sets, per character."""
    ac = int(all(ch in w for ch in a))
    ro = int(not any(ch in w for ch in o))
    ra = 0 if (n and w and all(ch in n for ch in w)) else 1
    return ac, ro, ra


def test_criteria_closed_forms_match_explode_and_python(spark):
    random.seed(7)
    data = [(a, o, n, w) for a in STRINGS for w in STRINGS for o, n in
            [(random.choice(STRINGS), random.choice(STRINGS))]]
    data += [(a, o, n, w) for o in STRINGS for n in STRINGS for a, w in
             [(random.choice(STRINGS), random.choice(STRINGS))]]
    df = spark.createDataFrame(data, "ac_all string, rc_ord string, rc_and string, ac_cw string").distinct()
    closed = df.select(
        "ac_all", "rc_ord", "rc_and", "ac_cw",
        crit.as_flag(crit.ac_match(F.col("ac_all"), F.col("ac_cw"))).alias("ac_match"),
        crit.as_flag(crit.rc_ord_match(F.col("rc_ord"), F.col("ac_cw"))).alias("rc_ord_match"),
        crit.as_flag(crit.rc_and_match(F.col("rc_and"), F.col("ac_cw"))).alias("rc_and_match"))
    exploded = code_flags(df)
    a, b = rows(closed), rows(exploded)
    assert a == b
    for r in a:
        assert r[4:] == _py_flags(*r[:4]), r


def _like_to_regex(p):
    return "^" + "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in p) + "$"


def test_wildcard_join_matches_brute_force(spark):
    random.seed(11)
    chars = ["A", "B", "1", " ", "_", "%", "\\"]
    patterns = sorted({"".join(random.choice(chars) for _ in range(random.randint(0, 6))) for _ in range(300)})
    values = sorted({"".join(random.choice(["A", "B", "1", " ", "\\"]) for _ in range(random.randint(0, 6)))
                     for _ in range(150)})
    left = spark.createDataFrame([(i, p) for i, p in enumerate(patterns)], "pid int, pat string")
    right = spark.createDataFrame([(v,) for v in values], "val string")
    got = rows(wildcard_join(left, right, "pat", "val"), "pid", "val")
    expected = []
    for i, p in enumerate(patterns):
        rx = re.compile(_like_to_regex(p), re.S)
        hits = [v for v in values if rx.match(v)]
        expected += [(i, v) for v in hits] or [(i, None)]
    assert got == sorted(expected, key=lambda t: (t[0], t[1] is not None, t[1]))


def test_one_pass_equals_union_of_pair_runs(spark):
    """SURVEY Q17: all pairs at once = each pair run alone, for pairs sharing a first year."""
    i = inputs(spark, SF_SMALL)
    all_pairs = expand_rules(i.req_main, i.sub_req, i.sub_req_ar, i.dprog, i.dprog_req)
    pairs = [(r[0], r[1]) for r in requirement_pairs(i.req_main).collect()]
    shared = {}
    for rq, ly in pairs:
        shared.setdefault(rq, []).append(ly)
    rq, lyts = next((k, v) for k, v in sorted(shared.items()) if len(v) > 1)
    for ly in lyts:
        wanted = spark.createDataFrame([(rq, ly)], "rqfyt string, lyt string")
        one = expand_rules(i.req_main, i.sub_req, i.sub_req_ar, i.dprog, i.dprog_req, pairs=wanted)
        sliced = all_pairs.filter((F.col("pair_rqfyt") == rq) & (F.col("pair_lyt") == ly))
        a, b = rows(one.drop(*PAIR)), rows(sliced.drop(*PAIR))
        assert a == b and len(a) > 0


def test_split_cutoff_equals_single_window(spark):
    """The default rule expansion (window only for groups with a '!' row, first-pseudo join
    elsewhere) gives exactly the rows of one window over everything."""
    i = inputs(spark, SF_SMALL)
    args = (i.req_main, i.sub_req, i.sub_req_ar, i.dprog, i.dprog_req)
    split = expand_rules(*args, method="split")
    window = expand_rules(*args, method="window")
    a, b = rows(split), rows(window)
    assert a == b and len(a) > 0
