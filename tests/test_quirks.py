
from pyspark.sql import functions as F

from conftest import rows
from coursematch.plans.matching import course_pattern
from coursematch.plans.rules import expand_rules

RM = ("instidq string, instid string, instcd string, rname string, rqfyt string, lyt string, "
      "rtitle1 string, rqtype string, ac1 string, ac2 string, rc1 string, rc2 string")
SR = ("instidq string, instid string, instcd string, rname string, rqfyt string, int_seq_no long, "
      "user_seq_no int, grp string, grpmin int, grpmax int, hcmin int, hcmax int, ac1 string, "
      "ac2 string, ac3 string, ac4 string, ac5 string, acor string, rc1 string, rc2 string, "
      "rc3 string, rc4 string, rc5 string, rcand string")
SRA = ("sub_int_seq_no long, user_seq_no int, course string, tflg string, ctitle string, "
       "crsflag string, ar_type string, matchctl string, ac string, rc string")
DPROG = "instidq string, instid string, instcd string, dprog string, dpfyt string, college string"
DPROG_REQ = ("instidq string, instid string, instcd string, dpfyt string, dprname string, dprog string, "
             "category string, int_seq_no long")


def _rm(name, rqtype="M", instid="I"):
    return ("Q", instid, "UNI", name, "20187", "20194", "T", rqtype, None, None, None, None)


def _sr(name, seq_no, instid="I"):
    return ("Q", instid, "UNI", name, "20187", seq_no, 1, "C", 1, 2, 3, 6) + (None,) * 12


def _sra(sub, seq, course, matchctl=None, ar="A"):
    return (sub, seq, course, None, None, None, ar, matchctl, None, None)


def _rules(spark, rm, sr, sra, dprog=(), dprog_req=()):
    return expand_rules(spark.createDataFrame(rm, RM), spark.createDataFrame(sr, SR),
                        spark.createDataFrame(sra, SRA), spark.createDataFrame(list(dprog), DPROG),
                        spark.createDataFrame(list(dprog_req), DPROG_REQ))


def test_list_and_non_list_rows_are_separate_cutoff_partitions(spark):
    # Q6: a pseudo course inside a list cuts off the rest of that list only.
    out = _rules(spark,
                 [_rm("R1"), _rm("LST", rqtype="L")],
                 [_sr("R1", 10), _sr("LST", 20)],
                 [_sra(10, 1, "MAT 117"), _sra(10, 2, "LST", "L"), _sra(10, 3, "MAT 118"),
                  _sra(20, 1, "ENG 101"), _sra(20, 2, "ENG 102", "$"), _sra(20, 3, "ENG 103")])
    assert rows(out, "rname", "seq2", "seq4", "course") == [
        ("LST", 1, 1, "ENG 101"),
        ("R1", 1, 1, "MAT 117"), ("R1", 2, 1, "ENG 101"), ("R1", 3, 1, "MAT 118")]


def test_unmatched_list_reference_keeps_its_name(spark):
    # Q21: no list of that name -> the row stays, course = the name, passed by matchctl 'L'.
    out = _rules(spark, [_rm("R1")], [_sr("R1", 10)], [_sra(10, 1, "NOPE", "L")])
    assert rows(out, "course", "matchctl", "rqfyt2") == [("NOPE", "L", None)]


def test_program_top_row_ignores_institution(spark):
    # Q22: the top program row per (name, year) may belong to another institution;
    # then no program joins and the college exclusion cannot apply.
    dprog = [("Q", "I", "UNI", "P1", "20187", "MAPP x"), ("Q", "J", "UNI", "P1", "20187", "C1")]
    dprog_req = [("Q", "I", "UNI", "20187", "R1", "P1", "A", 1), ("Q", "J", "UNI", "20187", "R1", "P1", "A", 2)]
    out = _rules(spark, [_rm("R1")], [_sr("R1", 10)], [_sra(10, 1, "MAT 117")], dprog, dprog_req)
    assert rows(out, "rname", "college") == [("R1", None)]
    # Without the foreign row the MAPP program joins and excludes the rule.
    out = _rules(spark, [_rm("R1")], [_sr("R1", 10)], [_sra(10, 1, "MAT 117")], dprog[:1], dprog_req[:1])
    assert out.count() == 0


def test_three_character_course_is_a_subject(spark):
    # Q10: any 3-character course is a subject wildcard; '*' is only replaced for other lengths.
    df = spark.createDataFrame([("R12",), ("M*T",), ("MAT 1**",), ("",)], "course string")
    got = [r[0] for r in df.select(course_pattern(F.col("course"))).collect()]
    assert got == ["R12 ___", "M*T ___", "MAT 1__", ""]


def test_acor_contains_but_rcand_equals(spark):
    # Q18: acor is tested with contains '-', rcand with equality to '-'.
    from conftest import normalise_criteria
    from test_golden import _rule, _rules_df
    df = _rules_df(spark, [_rule(subreq_id="h", ac1="H", ac2="c", acor="x-y"),
                           _rule(subreq_id="i", rc1="t", rcand=" -")])
    got = rows(normalise_criteria(df), "subreq_id", "ac_all", "rc_and", "rc_ord")
    assert got == [("h", "H", "", ""), ("h", "c", "", ""), ("i", "", "", "t")]
