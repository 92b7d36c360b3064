"""Registered queries: one per operator of the inventory, each over whole tables.

Every callable takes (spark, sf_dir) and returns a lazy DataFrame. Domain
tables are derived from the driver's tables by ``sources.derive``; the
generic operators also run directly on the driver's own tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursematch.config import MatchConfig
from coursematch.functions.codes import CRITERIA_CODES
from coursematch.functions.text import term_code
from coursematch.operators.containment import accepted_combinations
from coursematch.operators.explode import code_flags, code_flags_by_index
from coursematch.operators.joins import wildcard_join
from coursematch.operators.ranges import previous_value, running_sum
from coursematch.operators.versions import current_or_future, latest_version
from coursematch.operators.windows import before_first, dedupe_by_key
from coursematch.plans import course_match as cm
from coursematch.plans.crosswalk import courses_with_codes, expand_crosswalk
from coursematch.plans.matching import (
    course_matches, course_pattern, criteria_flags, criteria_pairs, level_condition, rule_item_match)
from coursematch.plans.offered import offered_courses
from coursematch.plans.normalise import SUB_ACCEPT_COLUMNS, accept_alternatives, level_marks
from coursematch.plans.rules import (
    PAIR, _prefixed, course_lists, expand_rules, of_institution, program_top1, requirement_pairs,
    row_tests, with_course_rows, with_list_members, with_programs, with_sub_requirements)
from coursematch.sources.derive import AS_OF, INSTITUTION, domain
from coursematch.staging import stage

CFG = MatchConfig(as_of=date.fromisoformat(AS_OF), institution=INSTITUTION)
# The pair bound by named parameters in ``param_slice`` (the source runs its
# rule query once per pair with exactly this binding).
SLICE_PAIR = {"rqfyt": "19957", "lyt": "19954"}
# ``running_cutoff`` / ``lag_marker`` on events: what counts as a marker row.
CUTOFF_EVENT, CUTOFF_VALUE, LAG_EVENT = "error", 150.0, "signup"
# Rows of a block of the range-split windows over events.
WINDOW_BLOCK = 1 << 16

INPUT_NAMES = ["ps_crse_offer", "ps_crse_catalog", "crosswalk_raw", "req_main", "sub_req",
               "sub_req_ar", "dprog", "dprog_req"]


def inputs(spark: SparkSession, sf_dir: str) -> cm.Inputs:
    d = domain(spark, sf_dir)
    return cm.Inputs(*[d[n] for n in INPUT_NAMES])


def _rules(spark, sf_dir):
    # none of the queries below returns the columns that only the result table has
    return cm.rules(inputs(spark, sf_dir), CFG, columns=())


def _staged_rules(spark, sf_dir):
    # buckets are for the deduplication, which these queries don't run
    return stage(_rules(spark, sf_dir), "rules")


def _courses(spark, sf_dir):
    return cm.courses(inputs(spark, sf_dir), CFG)


# --- sources, parameters ----------------------------------------------------

def q_requirement_pairs(spark, sf_dir):
    return requirement_pairs(domain(spark, sf_dir)["req_main"])


def q_param_slice(spark, sf_dir):
    i = inputs(spark, sf_dir)
    # Named parameter markers bind the pair; the pair set then reduces the requirements, course rows and lists.
    pair = spark.sql("SELECT rqfyt, lyt FROM {pairs} WHERE rqfyt = :rqfyt AND lyt = :lyt", args=SLICE_PAIR, pairs=requirement_pairs(i.req_main))
    return expand_rules(i.req_main, i.sub_req, i.sub_req_ar, i.dprog, i.dprog_req, pairs=pair, institution=INSTITUTION).drop(*PAIR)


# --- effective dating -------------------------------------------------------

def q_latest_version(spark, sf_dir):
    orders = domain(spark, sf_dir)["orders"]
    latest = latest_version(orders.select("o_orderkey", "o_custkey", "o_orderdate"),
                            ["o_custkey"], "o_orderdate")
    return latest.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))


def q_current_or_future(spark, sf_dir):
    orders = domain(spark, sf_dir)["orders"].select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("effdt"))
    return current_or_future(orders, ["o_custkey"], CFG.day())


def q_offered_items(spark, sf_dir):
    d = domain(spark, sf_dir)
    return offered_courses(d["ps_crse_offer"], d["ps_crse_catalog"], CFG.day())


# --- joins ------------------------------------------------------------------

def _req_sub(d):
    return with_sub_requirements(_prefixed(d["req_main"], "rm_"), _prefixed(d["sub_req"], "sr_"))


def q_inner_composite_join(spark, sf_dir):
    j = _req_sub(domain(spark, sf_dir))
    return j.select(F.col("rm_rname").alias("rname"), F.col("rm_rqfyt").alias("rqfyt"),
                    F.col("rm_lyt").alias("lyt"), F.col("rm_rqtype").alias("rqtype"),
                    F.col("sr_int_seq_no").alias("int_seq_no"), F.col("sr_grp").alias("grp"))


def q_left_join_detail(spark, sf_dir):
    d = domain(spark, sf_dir)
    sr, sra = d["sub_req"], d["sub_req_ar"]
    j = sr.join(sra, sr["int_seq_no"] == sra["sub_int_seq_no"], "left")
    return j.select(sr["rname"], sr["int_seq_no"], sr["user_seq_no"].alias("seq1"),
                    sra["user_seq_no"].alias("seq2"), sra["course"], sra["matchctl"])


def q_course_lists(spark, sf_dir):
    d = domain(spark, sf_dir)
    return course_lists(d["req_main"], d["sub_req"], d["sub_req_ar"], INSTITUTION)


def q_overlap_join(spark, sf_dir):
    d = domain(spark, sf_dir)
    base = _req_sub(d).filter(of_institution(F.col("rm_instcd"), INSTITUTION))
    lists = _prefixed(course_lists(d["req_main"], d["sub_req"], d["sub_req_ar"], INSTITUTION), "li_")
    j = with_list_members(stage(with_course_rows(base, _prefixed(d["sub_req_ar"], "sra_")), "course-rows"), stage(lists, "lists"))
    return j.select(F.col("rm_rname").alias("rname"), F.col("rm_lyt").alias("lyt"),
                    F.col("sr_user_seq_no").alias("seq1"), F.col("sra_user_seq_no").alias("seq2"),
                    F.col("sra_course").alias("course"), F.col("li_rqfyt").alias("rqfyt2"),
                    F.col("li_lyt").alias("lyt2"), F.col("li_seq1").alias("seq3"),
                    F.col("li_seq2").alias("seq4"))


def q_program_top1(spark, sf_dir):
    d = domain(spark, sf_dir)
    base = _req_sub(d).filter(of_institution(F.col("rm_instcd"), INSTITUTION))
    j = with_programs(base, _prefixed(program_top1(d["dprog"], d["dprog_req"], INSTITUTION), "dp_"))
    return j.select(F.col("rm_lyt").alias("lyt"), F.col("sr_rname").alias("rname"),
                    F.col("sr_int_seq_no").alias("int_seq_no"), F.col("dp_college").alias("college"),
                    F.col("dp_category").alias("category"))


# --- windows ----------------------------------------------------------------

def q_running_cutoff(spark, sf_dir):
    ev = domain(spark, sf_dir)["events"].select("event_id", "user_id", "ts", "event_type", "value")
    flag = (F.col("event_type") == CUTOFF_EVENT) & (F.col("value") > CUTOFF_VALUE)
    return before_first(ev, ["user_id"], ["ts", "event_id"], flag).select("event_id", "user_id", "event_type")


def q_running_sum(spark, sf_dir):
    ev = domain(spark, sf_dir)["events"].select("event_id", "user_id", "event_type", "ts", F.floor("value").alias("whole"))
    marker = F.when(F.col("event_type") == CUTOFF_EVENT, F.lit(1)).otherwise(F.lit(0))
    out = running_sum(ev, ["user_id"], ["ts", "event_id"], "whole", "running_value", block_rows=WINDOW_BLOCK)
    # over all rows of one kind: few, large partitions
    out = running_sum(out, ["event_type"], ["ts", "event_id"], "whole", "running_type_value", block_rows=WINDOW_BLOCK)
    return running_sum(out, ["user_id"], ["ts", "event_id"], marker, "running_markers", block_rows=WINDOW_BLOCK).select(
        "event_id", "user_id", "event_type", "running_value", "running_type_value", "running_markers")


def q_lag_marker(spark, sf_dir):
    ev = domain(spark, sf_dir)["events"].select("event_id", "user_id", "ts", "event_type")
    out = previous_value(ev, ["user_id"], ["ts", "event_id"], "event_type", "prev_type", block_rows=WINDOW_BLOCK)
    return (out.filter(F.coalesce(F.col("prev_type"), F.lit("")) != LAG_EVENT)
               .select("event_id", "user_id", "event_type", "prev_type"))


def q_dedupe_by_key(spark, sf_dir):
    li = domain(spark, sf_dir)["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    out = dedupe_by_key(li, ["l_orderkey", "l_linenumber"],
                        ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# --- predicates, scalar functions --------------------------------------------

def q_rule_filters(spark, sf_dir):
    sra = domain(spark, sf_dir)["sub_req_ar"]
    course = F.trim("course")
    kept = sra.filter(row_tests(F.col("ar_type"), F.col("matchctl"), F.col("crsflag"), course))
    return kept.select("sub_int_seq_no", "user_seq_no", course.alias("course"), "matchctl")


def q_term_code(spark, sf_dir):
    rm = domain(spark, sf_dir)["req_main"]
    return rm.select("rname", "rqfyt", "lyt", term_code(F.col("rqfyt")).alias("rqfyt_code"),
                     term_code(F.col("lyt")).alias("lyt_code"))


def q_or_explode(spark, sf_dir):
    sr = domain(spark, sf_dir)["sub_req"]
    return sr.select("int_seq_no", F.coalesce(F.col("acor"), F.lit("")).alias("acor"),
                     level_marks(F.col, SUB_ACCEPT_COLUMNS).alias("levels"), F.explode(accept_alternatives(F.col)).alias("ac_5"))


# --- crosswalk ----------------------------------------------------------------

def q_crosswalk_expand(spark, sf_dir):
    return expand_crosswalk(domain(spark, sf_dir)["crosswalk_raw"])


def q_crosswalk_join(spark, sf_dir):
    return _courses(spark, sf_dir)


# --- rules, criteria, matching -----------------------------------------------

def q_rules_expanded(spark, sf_dir):
    i = inputs(spark, sf_dir)
    return expand_rules(i.req_main, i.sub_req, i.sub_req_ar, i.dprog, i.dprog_req, institution=INSTITUTION)


def q_criteria_normalise(spark, sf_dir):
    return _rules(spark, sf_dir).select(
        *PAIR, "rname", "subreq_id", "rqfyt", "lyt", "rqfyt2", "lyt2", "seq1", "seq2", "seq3", "seq4",
        "upper_lower_acc", "upper_lower_rej", "ac_all", "rc_ord", "rc_and")


def q_criteria_match(spark, sf_dir):
    return criteria_flags(criteria_pairs(_rules(spark, sf_dir), _courses(spark, sf_dir)))


def q_code_explode(spark, sf_dir):
    return code_flags(criteria_pairs(_rules(spark, sf_dir), _courses(spark, sf_dir)))


def q_code_index(spark, sf_dir):
    return code_flags_by_index(criteria_pairs(_rules(spark, sf_dir), _courses(spark, sf_dir)))


def q_criteria_accepted(spark, sf_dir):
    return accepted_combinations(_rules(spark, sf_dir), expand_crosswalk(domain(spark, sf_dir)["crosswalk_raw"]), CRITERIA_CODES)


def _pattern_join(spark, sf_dir, with_level: bool):
    rules, courses = _staged_rules(spark, sf_dir), _courses(spark, sf_dir)
    cond = ((lambda v: level_condition(F.col("upper_lower_acc"), F.col("upper_lower_rej"), v))
            if with_level else None)
    j = wildcard_join(rules.withColumn("_pattern", course_pattern(F.col("course"))), courses, "_pattern", "_value",
                      value_condition=cond, how="left", matches=course_matches(rules, courses))
    return j.select(*PAIR, "rname", "subreq_id", "seq1", "seq2", "seq3", "seq4", "course", "lyt2",
                    "upper_lower_acc", "full_crse", "crse_id", "ac_cw")


def q_wildcard_match(spark, sf_dir):
    return _pattern_join(spark, sf_dir, with_level=False)


def q_level_match(spark, sf_dir):
    return _pattern_join(spark, sf_dir, with_level=True)


def q_rule_item_match(spark, sf_dir):
    m = rule_item_match(_staged_rules(spark, sf_dir), _courses(spark, sf_dir))
    return m.select(*PAIR, "rname", "subreq_id", "seq1", "seq2", "seq3", "seq4", "course", "lyt2",
                    "full_crse", "crse_id", "ac_all", "rc_ord", "rc_and", "ac_cw")


def q_course_match(spark, sf_dir):
    return cm.course_match(inputs(spark, sf_dir), CFG)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "requirement_pairs": q_requirement_pairs,
    "param_slice": q_param_slice,
    "latest_version": q_latest_version,
    "current_or_future": q_current_or_future,
    "offered_items": q_offered_items,
    "inner_composite_join": q_inner_composite_join,
    "left_join_detail": q_left_join_detail,
    "course_lists": q_course_lists,
    "overlap_join": q_overlap_join,
    "program_top1": q_program_top1,
    "running_cutoff": q_running_cutoff,
    "running_sum": q_running_sum,
    "lag_marker": q_lag_marker,
    "dedupe_by_key": q_dedupe_by_key,
    "rule_filters": q_rule_filters,
    "term_code": q_term_code,
    "or_explode": q_or_explode,
    "crosswalk_expand": q_crosswalk_expand,
    "crosswalk_join": q_crosswalk_join,
    "rules_expanded": q_rules_expanded,
    "criteria_normalise": q_criteria_normalise,
    "criteria_match": q_criteria_match,
    "code_explode": q_code_explode,
    "code_index": q_code_index,
    "criteria_accepted": q_criteria_accepted,
    "wildcard_match": q_wildcard_match,
    "level_match": q_level_match,
    "rule_item_match": q_rule_item_match,
    "course_match": q_course_match,
}
