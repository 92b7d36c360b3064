"""Rows that name a list are cut off before they meet its members; what a query does not return is not stored."""

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from coursematch.operators import containment, explode
from coursematch.plans import lists, rules
from coursematch.queries import QUERIES, inputs

REQ = "instidq string, instid string, instcd string, rname string, rqfyt string, lyt string, rtitle1 string, rqtype string, ac1 string, ac2 string, rc1 string, rc2 string"
SUB = ("instidq string, instid string, instcd string, rname string, rqfyt string, int_seq_no long, user_seq_no int, grp string, grpmin int, grpmax int, hcmin int, hcmax int, "
       + ", ".join(f"{c} string" for c in ("ac1", "ac2", "ac3", "ac4", "ac5", "acor", "rc1", "rc2", "rc3", "rc4", "rc5", "rcand")))
ROW = "sub_int_seq_no long, user_seq_no int, course string, tflg string, ctitle string, crsflag string, ar_type string, matchctl string, ac string, rc string"


def _tables(spark, seed):
    """Lists with pseudo members early, late and nowhere, NULL numbers and years, blanks, reversed years, lists without members."""
    pick = random.Random(seed)
    req, sub, ar, n = [], [], [], 0
    for i in range(24):
        kind = "L" if i % 2 else "M"
        first = pick.choice(["19957", "19967", "19967 ", "19977"])
        for last in {pick.choice(["19964", "19984", "19944", None]) for _ in range(2)}:
            req.append(("Q", "I", "UNI", f"R{i} ", first, last, f"T{i}", kind, None, None, None, None))
        for _ in range(3):
            n += 1
            sub.append(("Q", "I", "UNI", f"R{i} ", first, n, n % 4, "H", 1, 1, 3, 6, *[pick.choice(["H", "C", None]) for _ in range(5)], "-", *[None] * 6))
            for k in range(pick.randint(0, 6)):
                mark = pick.choice([None, None, "L", "L", "$", "!", "N", "P "])
                course = f"R{pick.randrange(1, 24, 2)}" if mark == "L" else pick.choice(["ABC 101", "ABC", "PSEUDO", "XYZ ***"])
                ar.append((n, 10 * n + k if pick.random() < 0.9 else None, course, None, None, None, pick.choice(["A", "A", "A ", "R", None]), mark, None, None))
    d = spark.createDataFrame([("Q", "I", "UNI", "P", "19957", "C")], "instidq string, instid string, instcd string, dprog string, dpfyt string, college string")
    dr = spark.createDataFrame([("Q", "I", "UNI", "P", "19957", "R0", 1, "A")], "instidq string, instid string, instcd string, dprog string, dpfyt string, dprname string, int_seq_no long, category string")
    return (spark.createDataFrame(req, REQ), spark.createDataFrame(sub, SUB), spark.createDataFrame(ar, ROW).distinct(), d, dr)


def test_lists_cut_off_at_heads_equal_one_window(spark):
    for seed in (1, 2):
        tables = _tables(spark, seed)
        split, window = rows(rules.expand_rules(*tables)), rows(rules.expand_rules(*tables, method="window"))
        assert split == window and any(r[len(rules.PAIR) + rules.RULE_COLUMNS.index("rqfyt2")] for r in split)


def _spy(monkeypatch, *modules) -> dict:
    staged = {}
    for module in modules:
        def spy(df, name, real=module.stage):
            staged[name] = real(df, name)
            return staged[name]
        monkeypatch.setattr(module, "stage", spy)
    return staged


def test_lists_that_no_row_names_are_not_joined(spark, monkeypatch):
    staged = _spy(monkeypatch, rules, lists)
    rules.expand_rules(*_tables(spark, 3))
    named = {r[0].strip() for r in staged["course-rows"].where("trim(sra_matchctl) = 'L'").select("sra_course").collect()}
    kept = {r[0].strip() for r in staged["named-lists"].select("li_rname").distinct().collect()}
    every = {r[0].strip() for r in staged["course-rows"].where("trim(rm_rqtype) = 'L'").select("sr_rname").distinct().collect()}
    assert kept and kept <= named and kept < every


def test_columns_of_the_result_table_are_stored_for_it_alone(spark, monkeypatch):
    staged = _spy(monkeypatch, rules)
    i = inputs(spark, SF_SMALL)
    args = (i.req_main, i.sub_req, i.sub_req_ar, i.dprog, i.dprog_req)
    some = rules.expand_rules(*args, columns=["tflg"])
    assert not {"rm_rtitle1", "sra_ctitle", "sr_grp", "dp_category"} & set(staged["course-rows"].columns) and "sra_tflg" in staged["course-rows"].columns
    whole = rules.expand_rules(*args)
    assert whole.columns == [*rules.PAIR, *rules.RULE_COLUMNS]
    assert rows(whole.select(some.columns)) == rows(some)


def test_criteria_are_computed_once(spark, monkeypatch):
    """The criteria queries store distinct criteria, not the rules, and read them, not the long computation, several times."""
    from coursematch.plans import matching
    staged = _spy(monkeypatch, explode, containment, matching)
    found = QUERIES["code_index"](spark, SF_SMALL)
    assert {"criteria-pairs", "rule-criteria"} <= set(staged) and "lineitem" not in found._jdf.queryExecution().executedPlan().toString()
    assert staged["rule-criteria"].count() == staged["rule-criteria"].distinct().count()
    found = QUERIES["criteria_accepted"](spark, SF_SMALL)
    assert {"criteria", "combinations"} <= set(staged)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "course-rows" not in plan and found.where(F.col("ac_all").isNull()).count() == 0
