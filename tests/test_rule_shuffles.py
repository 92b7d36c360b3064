"""The rule expansion moves its wide rows once: one pass over the course rows, criteria before staging, one join a row."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from coursematch.operators.ranges import keep_shown
from coursematch.plans import rules
from coursematch.plans.normalise import CRITERIA_PARTS
from coursematch.queries import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _spy(monkeypatch) -> dict:
    staged = {}

    def spy(df, name, real=rules.stage):
        staged[name] = df
        return real(df, name)

    monkeypatch.setattr(rules, "stage", spy)
    return staged


def test_list_members_come_from_the_staged_course_rows(spark, monkeypatch):
    staged = _spy(monkeypatch)
    QUERIES["rules_expanded"](spark, SF_SMALL)
    assert "lineitem" in _plan(staged["course-rows"])
    assert "lineitem" not in _plan(staged["lists"]) and staged["lists"].count() > 0


def test_criteria_are_computed_before_the_course_rows_are_staged(spark, monkeypatch):
    staged = _spy(monkeypatch)
    QUERIES["criteria_normalise"](spark, SF_SMALL)
    columns = staged["course-rows"].columns
    assert set(CRITERIA_PARTS) <= set(columns) and not {"sr_ac1", "sr_rcand", "rm_rc1", "sra_ac"} & set(columns)


def test_keep_shown_joins_each_row_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        data = [(g, lst, i, f"wide{g}{lst}{i}", (g + i) % 5 == 4, i % 3 == 0 and lst is None) for g in range(6) for lst in (None, "l") for i in range(9)]
        df = spark.createDataFrame(data, "g int, lst string, i int, payload string, stop boolean, bang boolean")
        kept = keep_shown(df, ["g", "lst"], ["i"], F.col("stop"), F.col("bang"), may_hide=F.col("lst").isNull())
        plan = _plan(kept)
        # the payload goes through one exchange in each of the two branches
        moved = [line for line in plan.splitlines() if "Join" in line]
        assert len(moved) == 2 and len(re.findall(r"SortMergeJoin.*LeftAnti", plan)) == 1, plan
        expected = []
        for g in range(6):
            for lst in (None, "l"):
                for i in range(9):
                    if (g + i) % 5 == 4:
                        break
                    if not (lst is None and i > 0 and (i - 1) % 3 == 0):
                        expected.append(f"wide{g}{lst}{i}")
        assert sorted(r.payload for r in kept.collect()) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
