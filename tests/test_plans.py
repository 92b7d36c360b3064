"""Plan shape: the flagship stays on equi-joins, JVM expressions and partial top-1."""

from conftest import SF_SMALL
from coursematch.queries import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_has_no_nested_loop_cartesian_or_python(spark):
    plan = _plan(QUERIES["course_match"](spark, SF_SMALL))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, bad


def test_top1_windows_are_limited_before_the_shuffle(spark):
    plan = _plan(QUERIES["dedupe_by_key"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = QUERIES["inner_composite_join"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = [line for line in plan.splitlines() if "FileScan parquet" in line]
    # sub_req is a view of orders: only the two columns that it needs are read
    orders = next(s for s in schemas if "o_custkey" in s)
    assert "o_orderdate" not in orders and "o_totalprice" not in orders


def test_param_slice_reduces_every_branch_to_its_pair(spark, monkeypatch):
    """What is staged for one pair, sub-requirements, course rows, lists and joined rows, is of that pair alone."""
    from coursematch.plans import rules
    from coursematch.queries import SLICE_PAIR
    staged = {}

    def spy(df, name, real=rules.stage):
        staged[name] = (real(df, name), df.count())
        return staged[name][0]

    monkeypatch.setattr(rules, "stage", spy)
    assert QUERIES["param_slice"](spark, SF_SMALL).count() > 0
    assert set(staged) == {"needs", "course-rows", "lists"}
    pair = (SLICE_PAIR["rqfyt"], SLICE_PAIR["lyt"])
    for name in ("needs", "course-rows"):
        assert [tuple(r) for r in staged[name][0].select(*rules.PAIR).distinct().collect()] == [pair], name
    named = {r[0].strip() for r in staged["course-rows"][0].where("trim(sra_matchctl) = 'L'").select("sra_course").collect()}
    assert {r[0].strip() for r in staged["lists"][0].select("rname").distinct().collect()} <= named
    one = {name: n for name, (_, n) in staged.items()}
    QUERIES["rules_expanded"](spark, SF_SMALL).count()
    assert 8 * one["course-rows"] < staged["course-rows"][1] and one["lists"] < staged["lists"][1]


def test_staged_rules_are_matched_without_a_shuffle(spark):
    """Bucketed by a prefix of the dedupe key, the rules go through join and deduplication where they lie."""
    from coursematch.plans import course_match as cm
    from coursematch.queries import CFG, inputs
    from coursematch.staging import drop_bucketed
    i = inputs(spark, SF_SMALL)
    rules = cm.staged_rules(i, CFG)
    result = cm.course_match(i, CFG, rules_df=rules)
    plan = _plan(result)
    assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    assert result.count() > 0
    drop_bucketed(rules)


def test_plans_hold_without_broadcasts(spark):
    """Every query, with broadcasts off: no nested loop, no cartesian product, no Python."""
    import __spark_entry__ as e
    assert set(QUERIES) <= set(e.oracle_sql())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, fn in QUERIES.items():
            plan = _plan(fn(spark, "/root/testdata/sf0.01"))
            for bad in ("NestedLoopJoin", "CartesianProduct", "EvalPython", "MapInArrow"):
                assert bad not in plan, (name, bad)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
