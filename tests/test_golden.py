"""Hand-worked rows (FIXTURES.md section 3): one test per behaviour and quirk."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from coursematch.functions import criteria as crit
from coursematch.operators.joins import overlap_join, wildcard_join
from coursematch.plans.crosswalk import expand_crosswalk
from coursematch.plans.matching import course_pattern, level_condition, rule_item_match
from conftest import normalise_criteria
from coursematch.plans.offered import offered_courses
from coursematch.plans.rules import RULE_COLUMNS, expand_rules

# --- crosswalk ---------------------------------------------------------------


def test_crosswalk_golden(spark):
    raw = spark.createDataFrame([
        ("D1", "HU & C"),
        ("D2", "HUAD OR (HU or SB) & C & H"),
        ("D3", "CS"),
        ("D4", "(L or MA) & G"),
        ("D5", "SOBE OR SB & CS & H & G"),
    ], "designation string, expr string")
    got = rows(expand_crosswalk(raw))
    assert got == sorted([
        ("-", ""), ("D1", "Hc"), ("D2", "Hch"), ("D2", "Sch"), ("D2", "¿"), ("D3", "Q"),
        ("D4", "tg"), ("D4", "vg"), ("D5", "SQhg"), ("D5", "Ñ")])


def test_crosswalk_only_first_part_splits_on_or(spark):
    # SURVEY Q11: later '&' parts keep their letters, and ' OR ' only becomes ' or '.
    raw = spark.createDataFrame([("D", "C or G & H or SB")], "designation string, expr string")
    got = [r for r in rows(expand_crosswalk(raw)) if r[0] == "D"]
    assert got == [("D", "chorS"), ("D", "ghorS")]


def test_crosswalk_more_than_four_parts_fails(spark):
    raw = spark.createDataFrame([("D", "C & G & H & L & MA")], "designation string, expr string")
    with pytest.raises(Exception):
        expand_crosswalk(raw).collect()


# --- criteria ----------------------------------------------------------------

@pytest.mark.parametrize("a,w,expected", [("Hc", "Hch", 1), ("hc", "Hc", 0), ("", "Hc", 1), ("", "", 1),
                                          ("c", "", 0), ("¿", "¿", 1)])
def test_ac_match(spark, a, w, expected):
    df = spark.createDataFrame([(a, w)], "a string, w string")
    assert df.select(crit.as_flag(crit.ac_match(F.col("a"), F.col("w")))).first()[0] == expected


@pytest.mark.parametrize("o,w,expected", [("gv", "vg", 0), ("g", "Hc", 1), ("", "Hc", 1), ("g", "", 1)])
def test_rc_ord_match(spark, o, w, expected):
    df = spark.createDataFrame([(o, w)], "o string, w string")
    assert df.select(crit.as_flag(crit.rc_ord_match(F.col("o"), F.col("w")))).first()[0] == expected


@pytest.mark.parametrize("n,w,expected", [("tH", "H", 0), ("H", "Hch", 1), ("", "Hch", 1), ("tH", "", 1)])
def test_rc_and_match(spark, n, w, expected):
    df = spark.createDataFrame([(n, w)], "n string, w string")
    assert df.select(crit.as_flag(crit.rc_and_match(F.col("n"), F.col("w")))).first()[0] == expected


def test_rc_and_intent_option(spark):
    # SURVEY Q2: the documented intent (reject when W holds all of N) as an option.
    df = spark.createDataFrame([("tH", "H"), ("tH", "tHc")], "n string, w string")
    got = [r[0] for r in df.select(crit.as_flag(crit.rc_and_match(F.col("n"), F.col("w"), True))).collect()]
    assert got == [1, 0]


# --- normalisation -------------------------------------------------------------

def _rule(**over):
    base = {c: None for c in RULE_COLUMNS}
    base.update(rname="R", subreq_id="1", rqfyt="20187", lyt="20194", seq1=1, seq2=1, seq3=1, seq4=1,
                course="MAT 117", matchctl="", ar_type="A")
    base.update(over)
    return base


def _rules_df(spark, dicts):
    schema = ", ".join(f"{c} {'int' if c.startswith('seq') else 'string'}" for c in RULE_COLUMNS)
    return spark.createDataFrame([tuple(d[c] for c in RULE_COLUMNS) for d in dicts], schema)


def test_normalise_golden(spark):
    df = _rules_df(spark, [
        _rule(subreq_id="a", rqfyt="2018 7", rqfyt2=None, ac1="H", ac2=" c "),
        _rule(subreq_id="b", ac1="H", ac2=" c ", acor="-"),
        _rule(subreq_id="c", acor="-"),
        _rule(subreq_id="d", ac1="U"),
        _rule(subreq_id="e", ac4="2.00"),
        _rule(subreq_id="f", rcand="-", rc1="t", rc2="H", rc="Q"),
        _rule(subreq_id="g", rc1="t", rc2="H", rc="Q"),
    ])
    got = rows(normalise_criteria(df), "subreq_id", "rqfyt", "rqfyt2", "ac_all", "upper_lower_acc",
               "rc_and", "rc_ord")
    assert got == [
        ("a", "2187", None, "Hc", "", "", ""),
        ("b", "2187", None, "H", "", "", ""),
        ("b", "2187", None, "c", "", "", ""),
        ("c", "2187", None, "", "", "", ""),
        ("d", "2187", None, "", "U", "", ""),
        ("e", "2187", None, "", "", "", ""),
        ("f", "2187", None, "", "", "tH", "Q"),
        ("g", "2187", None, "", "", "", "QtH"),
    ]


# --- effective dating ------------------------------------------------------------

def test_effective_dating_golden(spark):
    as_of = date(2026, 1, 1)
    offer = spark.createDataFrame([
        ("1", date(2020, 1, 1), "MAT", "117", "Y"),
        ("1", date(2031, 1, 1), "MAT", "118", "Y"),
        ("2", None, "ENG", "101", "Y"),
        ("2", date(2031, 1, 1), "ENG", "102", "Y"),
        ("3", date(2020, 1, 1), "BIO", "100", "Y"),
    ], "crse_id string, effdt date, subject string, catalog_nbr string, schedule_print string")
    catalog = spark.createDataFrame([
        ("1", date(2020, 1, 1), "A", "D20", 1, 3),
        ("1", date(2021, 1, 1), "A", "D21", 1, 3),
        ("1", date(2030, 1, 1), "A", "D30", 1, 3),
        ("1", date(2031, 1, 1), "A", "D31", 1, 3),
        ("2", date(2020, 1, 1), "A", "E20", 1, 3),
        ("3", date(2020, 1, 1), "A", "B20", 1, 3),
        ("3", date(2021, 1, 1), "I", "B21", 1, 3),
    ], "crse_id string, effdt date, eff_status string, rqmnt_designtn string, "
       "units_minimum int, units_maximum int")
    got = rows(offered_courses(offer, catalog, as_of), "crse_id", "full_crse", "rqmnt_designtn")
    # course 1: offer of 2031, catalog rows of 2021 (current) and 2031 (future);
    # course 2: the NULL-dated offer ranks first; course 3: inactive latest row is not replaced.
    assert got == [("1", "MAT 118", "D21"), ("1", "MAT 118", "D31"), ("2", "ENG 101", "E20")]


# --- windows: cutoff and hidden rows --------------------------------------------------

def _one_subreq(spark, sra_rows):
    req_main = spark.createDataFrame(
        [("Q", "I", "UNI", "R1", "20187", "20194", "T", "M", None, None, None, None)],
        "instidq string, instid string, instcd string, rname string, rqfyt string, lyt string, "
        "rtitle1 string, rqtype string, ac1 string, ac2 string, rc1 string, rc2 string")
    sub_req = spark.createDataFrame(
        [("Q", "I", "UNI", "R1", "20187", 10, 1, "C", 1, 2, 3, 6) + (None,) * 12],
        "instidq string, instid string, instcd string, rname string, rqfyt string, int_seq_no long, "
        "user_seq_no int, grp string, grpmin int, grpmax int, hcmin int, hcmax int, ac1 string, "
        "ac2 string, ac3 string, ac4 string, ac5 string, acor string, rc1 string, rc2 string, "
        "rc3 string, rc4 string, rc5 string, rcand string")
    sub_req_ar = spark.createDataFrame(
        [(10, seq, "MAT 117", None, None, None, ar, m, None, None) for seq, m, ar in sra_rows],
        "sub_int_seq_no long, user_seq_no int, course string, tflg string, ctitle string, "
        "crsflag string, ar_type string, matchctl string, ac string, rc string")
    dprog = spark.createDataFrame([], "instidq string, instid string, instcd string, dprog string, "
                                      "dpfyt string, college string")
    dprog_req = spark.createDataFrame([], "instidq string, instid string, instcd string, dpfyt string, "
                                          "dprname string, dprog string, category string, int_seq_no long")
    return expand_rules(req_main, sub_req, sub_req_ar, dprog, dprog_req)


@pytest.mark.parametrize("sra_rows,kept", [
    ([(1, None, "A"), (2, "$", "A"), (3, None, "A"), (4, None, "A")], [(1, ""), ]),
    ([(1, None, "A"), (2, "!", "A"), (3, None, "A"), (4, None, "A")], [(1, ""), (2, ""), (4, "")]),
    ([(1, None, "A"), (2, "$", None), (3, None, "A"), (4, None, "A")], [(1, ""), (3, ""), (4, "")]),
])
def test_cutoff_and_hidden_golden(spark, sra_rows, kept):
    got = rows(_one_subreq(spark, sra_rows), "seq2", "matchctl")
    assert got == kept


# --- wildcard and level ----------------------------------------------------------------

COURSES3 = [("MAT 117",), ("MAT 317",), ("MAT 817",)]


@pytest.mark.parametrize("course,acc,rej,expected", [
    ("MAT", "", "", ["MAT 117", "MAT 317", "MAT 817"]),
    ("MAT ***", "", "", ["MAT 117", "MAT 317", "MAT 817"]),
    ("MAT 3**", "", "", ["MAT 317"]),
    ("MAT 117", "", "", ["MAT 117"]),
    ("mat", "", "", []),
    ("", "", "", []),
    ("MAT", "U", "", ["MAT 317"]),
    ("MAT", "L", "", ["MAT 117"]),
    ("MAT", "UL", "", ["MAT 317"]),
    ("MAT", "", "U", ["MAT 117", "MAT 317", "MAT 817"]),
    ("**T 117", "", "", ["MAT 117"]),
    ("%117", "", "", ["MAT 117"]),
    ("%17", "", "", []),
    ("%", "", "", ["MAT 117", "MAT 317", "MAT 817"]),
    ("___ _1_", "", "", ["MAT 117", "MAT 317", "MAT 817"]),
    ("*** ***", "", "", ["MAT 117", "MAT 317", "MAT 817"]),
    ("_%3_7", "", "", ["MAT 317"]),
])
def test_wildcard_and_level_golden(spark, course, acc, rej, expected):
    rules = spark.createDataFrame([(course, acc, rej)], "course string, acc string, rej string")
    courses = spark.createDataFrame(COURSES3, "full_crse string")
    r = rules.withColumn("_pattern", course_pattern(F.col("course")))
    cond = lambda v: level_condition(F.col("acc"), F.col("rej"), v)
    got = [x[0] for x in rows(wildcard_join(r, courses, "_pattern", "full_crse", cond), "full_crse")]
    assert got == (expected or [None])


def test_strict_level_reject_option(spark):
    rules = spark.createDataFrame([("MAT", "", "U")], "course string, acc string, rej string")
    courses = spark.createDataFrame(COURSES3, "full_crse string")
    r = rules.withColumn("_pattern", course_pattern(F.col("course")))
    cond = lambda v: level_condition(F.col("acc"), F.col("rej"), v, strict_reject=True)
    got = [x[0] for x in rows(wildcard_join(r, courses, "_pattern", "full_crse", cond), "full_crse")]
    assert got == ["MAT 117", "MAT 817"]


# --- left join, then criteria -----------------------------------------------

def test_left_join_then_criteria(spark):
    rules = spark.createDataFrame([
        ("r1", "MAT", "c", "", "", "", ""),      # matches only courses whose codes fail -> gone
        ("r2", "ZZZ", "", "", "", "", ""),       # no course, no accept codes -> one NULL row
        ("r3", "ZZZ", "c", "", "", "", ""),      # no course, accept codes -> gone
        ("r4", "MAT 1**", "H", "", "", "", ""),  # matches a course with code H
    ], "rname string, course string, ac_all string, rc_ord string, rc_and string, "
       "upper_lower_acc string, upper_lower_rej string")
    courses = spark.createDataFrame([("MAT 117", "1", "H"), ("MAT 317", "2", None)],
                                    "full_crse string, crse_id string, ac_cw string")
    got = rows(rule_item_match(rules, courses), "rname", "full_crse")
    assert got == [("r2", None), ("r4", "MAT 117")]


# --- overlap -----------------------------------------------------------------------

def test_overlap_golden(spark):
    left = spark.createDataFrame([("k", "20007", "20054")], "k string, s string, e string")
    right = spark.createDataFrame([("k", "20054", "20104", "a"), ("k", "20057", "20104", "b"),
                                   ("k", "20017", None, "c")], "k2 string, s2 string, e2 string, id string")
    j = overlap_join(left, right, [(F.col("k"), F.col("k2"))], (F.col("s"), F.col("e")),
                     (F.col("s2"), F.col("e2")))
    assert [r[0] for r in rows(j, "id")] == ["a", "c"]
