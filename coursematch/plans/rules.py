"""J3-J5: requirement pairs, course lists and the expanded sub-requirement rules.

The source runs the rule query once per (first year, last year) pair. Here all
pairs run in one pass: every requirement row carries its own pair
(``pair_rqfyt``, ``pair_lyt`` = trimmed years) and the pair joins the keys of
every window, so one pass equals the union of the per-pair runs.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursematch.functions.text import eq_blank_padded, like
from coursematch.operators.joins import overlap_join
from coursematch.operators.ranges import keep_shown
from coursematch.operators.windows import lag_marker, running_cutoff, top1
from coursematch.plans.lists import LIST_COLUMNS, list_heads, named_lists, shown_members
from coursematch.plans.normalise import CRITERIA_PARTS, RAW_CRITERIA, criteria_parts
from coursematch.staging import stage

REQ_KEYS = ["instidq", "instid", "instcd", "rname", "rqfyt"]
PAIR = ["pair_rqfyt", "pair_lyt"]

# ---------------------------------------------------------------------------
# Fixed values of the source query.
# ---------------------------------------------------------------------------
LIST_RQTYPE = "L"
LIST_MATCHCTL = "L"
PSEUDO_MATCHCTL = ("$", "S", "P")
PASS_MATCHCTL = ("L", "N")
HIDE_NEXT_MARK = "!"
REJECT_AR_TYPE = "R"
ACCEPT_AR_TYPE = "A"
EXCLUDED_COLLEGE_WORDS = ("MAPP", "TAG")
PROGRAM_CATEGORIES = ("A", "C", "F", "G", "L", "M", "N", "P", "Q", "R", "S", "X", "e", "f", "t", "y", "z")
# ---------------------------------------------------------------------------

RULE_COLUMNS = [
    "rname", "subreq_id", "rqfyt", "lyt", "rtitle1", "seq1", "seq2", "seq3", "seq4", "course",
    "tflg", "ctitle", "college", "category", "ar_type", "rqtype", "rqfyt2", "lyt2", "matchctl",
    "grp", "grpmin", "grpmax", "hcmin", "hcmax", "r_ac1", "r_ac2", "r_rc1", "r_rc2", "ac", "rc",
    "ac1", "ac2", "ac3", "ac4", "ac5", "acor", "rc1", "rc2", "rc3", "rc4", "rc5", "rcand",
]


# What the list join, the row tests and the output need of a requirement's course rows.
BASE_COLUMNS = [
    *PAIR, "rm_instidq", "rm_instid", "rm_instcd", "rm_rqfyt", "rm_lyt", "rm_rtitle1", "rm_rqtype", "rm_ac1", "rm_ac2", "rm_rc1", "rm_rc2",
    "sr_rname", "sr_rqfyt", "sr_int_seq_no", "sr_user_seq_no", "sr_grp", "sr_grpmin", "sr_grpmax", "sr_hcmin", "sr_hcmax",
    *(f"sr_{c}" for c in ("ac1", "ac2", "ac3", "ac4", "ac5", "acor", "rc1", "rc2", "rc3", "rc4", "rc5", "rcand")),
    "dp_college", "dp_category", "sra_sub_int_seq_no", "sra_user_seq_no", "sra_course", "sra_tflg", "sra_ctitle", "sra_crsflag", "sra_ar_type",
    "sra_matchctl", "sra_ac", "sra_rc", "_seq2_int",
]
# Rule columns that only the output needs, and what each comes from: left out where a caller does not ask for them.
OUTPUT_ONLY = {"rtitle1": "rm_rtitle1", "tflg": "sra_tflg", "ctitle": "sra_ctitle", "category": "dp_category",
               **{c: f"sr_{c}" for c in ("grp", "grpmin", "grpmax", "hcmin", "hcmax")}}


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def _c(name: str) -> Column:
    return F.col(name)


def of_institution(code: Column, institution: str | None) -> Column:
    """Rows of one institution; trailing blanks do not count. None: of all."""
    return F.lit(True) if institution is None else eq_blank_padded(code, institution)


def requirement_pairs(req_main: DataFrame) -> DataFrame:
    """J3: distinct trimmed (rqfyt, lyt) pairs, as a DataFrame (never collected)."""
    return req_main.select(F.trim("rqfyt").alias("rqfyt"), F.trim("lyt").alias("lyt")).distinct()


def with_sub_requirements(rm: DataFrame, sr: DataFrame) -> DataFrame:
    """Requirements (rm_) joined to their sub-requirements (sr_) on the five keys."""
    return rm.join(sr, [rm["rm_" + k] == sr["sr_" + k] for k in REQ_KEYS], "inner")


def with_course_rows(rows: DataFrame, sra: DataFrame) -> DataFrame:
    """Sub-requirement rows left-joined to their course rows (sra_)."""
    return rows.join(sra, rows["sr_int_seq_no"] == sra["sra_sub_int_seq_no"], "left")


def with_programs(rows: DataFrame, progs: DataFrame) -> DataFrame:
    """Sub-requirement rows left-joined to their program row (dp_), without the excluded colleges."""
    return _program_rows(rows, progs).filter(_college_allowed(_c("dp_college")))


def _program_rows(rows: DataFrame, progs: DataFrame) -> DataFrame:
    return rows.join(progs, [
        F.trim("sr_instidq") == _c("dp_instidq"),
        F.trim("sr_instid") == _c("dp_instid"),
        F.trim("sr_instcd") == _c("dp_instcd"),
        F.trim("sr_rname") == _c("dp_dprname"),
        F.trim("sr_rqfyt") == F.trim("dp_dpfyt"),
    ], "left")


def with_list_members(rows: DataFrame, lists: DataFrame, heads: bool = False) -> DataFrame:
    """Course rows that name a list left-joined to its members (li_) of an overlapping time. With ``heads``, ``lists`` has one row a list and time."""
    return overlap_join(
        rows, lists,
        keys=[(F.trim("rm_instidq"), F.trim("li_instidq")),
              (F.trim("rm_instid"), F.trim("li_instid")),
              (F.trim("rm_instcd"), F.trim("li_instcd")),
              (F.trim("sra_course"), F.trim("li_rname"))],
        left_interval=(F.trim("rm_rqfyt"), F.trim("rm_lyt")),
        right_interval=(F.trim("li_rqfyt"), F.trim("li_lyt")),
        condition=F.trim("sra_matchctl") == LIST_MATCHCTL,
        how="left", stage_right=heads)


def row_tests(ar_type: Column, matchctl: Column, crsflag: Column, course: Column) -> Column:
    """Tests of one course row: accepted, no pseudo course, no flag, and a course or a passing mark."""
    shape = ((like(course, F.lit("___ ___"))
              & (course.rlike(r"[0-9]{3}\z") | course.contains("*")))
             | course.rlike(r"^[A-Za-z]{3}\z")
             | F.trim(matchctl).isin(*PASS_MATCHCTL))
    return ((F.trim(ar_type) != REJECT_AR_TYPE)
            & ~F.coalesce(matchctl, F.lit("")).isin(*PSEUDO_MATCHCTL)
            & (F.trim(F.coalesce(crsflag, F.lit(""))) == "")
            & shape)


def course_lists(req_main: DataFrame, sub_req: DataFrame, sub_req_ar: DataFrame,
                 institution: str | None = None, reduce: bool = False) -> DataFrame:
    """J4: members of every course list (a requirement of type 'L' of the institution).

    ``reduce`` drops the course rows of other sub-requirements by a semi-join first, for a few lists out of many.
    """
    rm = _prefixed(req_main.filter(of_institution(F.col("instcd"), institution)
                                   & (F.trim("rqtype") == LIST_RQTYPE)), "rm_")
    sr = _prefixed(sub_req, "sr_")
    sra = _prefixed(sub_req_ar, "sra_")
    # The inner join to list requirements only involves sub_req and req_main
    # columns, so it runs first: the course-row join then touches the
    # sub-requirements of lists only, not the whole table.
    heads = with_sub_requirements(rm, sr)
    if reduce:
        sra = sra.join(heads.select(F.col("sr_int_seq_no").alias("_id")).distinct(), F.col("sra_sub_int_seq_no") == F.col("_id"), "left_semi")
    return _list_members(with_course_rows(heads, sra))


def _list_members(rows: DataFrame, left_out: Collection[str] = ()) -> DataFrame:
    marks = [F.trim(f"sra_{c}").alias(c) for c in ("tflg", "ctitle") if c not in left_out]
    return rows.select(
        _c("rm_instidq").alias("instidq"), _c("rm_instid").alias("instid"),
        _c("rm_instcd").alias("instcd"), _c("sr_rname").alias("rname"),
        _c("rm_rqfyt").alias("rqfyt"), _c("rm_lyt").alias("lyt"),
        _c("sr_user_seq_no").alias("seq1"), _c("sra_user_seq_no").alias("seq2"),
        _c("sra_course").alias("course"), *marks, _c("rm_rqtype").alias("rqtype"),
        _c("sra_matchctl").alias("matchctl"))


def program_top1(dprog: DataFrame, dprog_req: DataFrame, institution: str | None = None) -> DataFrame:
    """Degree-program row per (program requirement name, first year): highest int_seq_no.

    Only programs of the institution and of the listed categories take part.
    The top row is chosen per (dprname, dpfyt) alone; institution keys are only
    compared later in the join, as in the source.
    """
    d = _prefixed(dprog, "d_")
    dr = _prefixed(dprog_req, "dr_")
    keys = ["instidq", "instid", "instcd", "dprog", "dpfyt"]
    joined = (dr.join(d, [dr["dr_" + k] == d["d_" + k] for k in keys], "inner")
                .filter(of_institution(F.trim("d_instcd"), institution)
                        & F.trim("dr_category").isin(*PROGRAM_CATEGORIES)))
    progs = joined.select(
        F.trim("dr_instidq").alias("instidq"), F.trim("dr_instid").alias("instid"),
        F.trim("dr_instcd").alias("instcd"), F.trim("dr_dpfyt").alias("dpfyt"),
        F.trim("dr_dprname").alias("dprname"), _c("dr_category").alias("category"),
        _c("d_college").alias("college"), _c("dr_int_seq_no").alias("int_seq_no"))
    # Ties on int_seq_no are broken by the remaining columns (the source leaves them arbitrary).
    return top1(progs, ["dprname", "dpfyt"],
                [F.col("int_seq_no").desc_nulls_first(), "instidq", "instid", "instcd", "category", "college"])


def _college_allowed(college: Column) -> Column:
    up = F.upper(college)
    allowed = None
    for word in EXCLUDED_COLLEGE_WORDS:
        t = ~up.contains(word)
        allowed = t if allowed is None else allowed & t
    return allowed | college.isNull()


def of_pairs(req: DataFrame, pairs: DataFrame) -> DataFrame:
    """Requirements of the pairs (rqfyt, lyt) of a table: a semi-join on the trimmed years."""
    p = pairs.select(F.col("rqfyt").alias("_p1"), F.col("lyt").alias("_p2"))
    return req.join(p, (F.trim(req["rqfyt"]) == p["_p1"]) & (F.trim(req["lyt"]) == p["_p2"]), "left_semi")


def expand_rules(req_main: DataFrame, sub_req: DataFrame, sub_req_ar: DataFrame,
                 dprog: DataFrame, dprog_req: DataFrame,
                 pairs: DataFrame | None = None, raw_criteria: bool = True,
                 method: str = "split", institution: str | None = None, columns: Collection[str] | None = None) -> DataFrame:
    """J5: sub-requirement rule rows of every requirement pair, lists expanded.

    Returns ``PAIR + RULE_COLUMNS``. Steps, in the source's order of effect:
    requirement x sub-requirement (5 keys) -> program top row (left) and the
    college exclusion -> course rows (left) -> list members (left; trimmed
    keys, list name = course, overlapping year ranges, course row marked 'L')
    -> running cutoff at the first pseudo course and the previous row's mark,
    both over the rows before the final filters -> final filters.

    ``pairs`` (rqfyt, lyt) restricts the requirement side to some pairs, as one
    run of the source does to one; course lists still come from every requirement. The pairs'
    sub-requirements then reduce the course rows, and the lists that those name reduce the lists, by
    semi-joins before the big joins, so that a run for one pair reads the tables but shuffles little of them.

    The sources are read once for the sub-requirements' course rows, of which the list members are a part (for ``pairs``, once for
    each). Both are staged with the columns needed; lists that no row names go no further. Rows that name a list meet its heads, take their cutoff
    and only then meet its members (``shown_members``); for the others the cutoff and the previous-row test are
    ``operators.ranges.keep_shown``: a grouped minimum, and a range-split window over the keys that matter. ``method="window"`` stages nothing and runs both tests as one
    window over whole partitions; it gives the same rows (for a total order).

    ``raw_criteria=False`` replaces the 18 raw criteria columns by their
    row-local criteria strings (``normalise.CRITERIA_PARTS``), computed before the
    course rows are staged.

    ``columns`` names the rule columns that are wanted of those in ``OUTPUT_ONLY`` (default: all); the others of them are not stored
    or shuffled, and not returned.
    """
    if method not in ("split", "window"):
        raise ValueError("method must be 'split' or 'window'")
    put = stage if method == "split" else lambda df, name: df
    req = req_main.filter(of_institution(F.col("instcd"), institution))
    years = F.trim("rm_rqfyt").isNotNull() & F.trim("rm_lyt").isNotNull()
    # One pass over the course rows gives those of the rules and the members of the lists, unless pairs reduce both.
    once = method == "split" and pairs is None
    if pairs is not None:
        req = of_pairs(req, pairs)
    progs = _prefixed(program_top1(dprog, dprog_req, institution), "dp_")
    # The program join and the college test depend on the sub-requirement only:
    # applying them before the course and list joins drops rows earlier.
    base = (with_sub_requirements(_prefixed(req, "rm_"), _prefixed(sub_req, "sr_"))
            .withColumn("pair_rqfyt", F.trim("rm_rqfyt")).withColumn("pair_lyt", F.trim("rm_lyt")))
    base = _program_rows(base, progs)
    of_rules = F.coalesce(_college_allowed(_c("dp_college")) & years, F.lit(False))
    of_lists = F.coalesce(F.trim("rm_rqtype") == LIST_RQTYPE, F.lit(False))
    base = base.filter(of_rules | of_lists) if once else base.filter(of_rules)
    course_rows, list_reqs = sub_req_ar, req_main
    if pairs is not None:
        base = put(base, "needs")
        course_rows = sub_req_ar.join(base.select(F.col("sr_int_seq_no").alias("_id")).distinct(), F.col("sub_int_seq_no") == F.col("_id"), "left_semi")
    base = with_course_rows(base, _prefixed(course_rows, "sra_")).withColumn("_seq2_int", _c("sra_user_seq_no").cast("int"))
    raw = {"r_ac1": "rm_ac1", "r_ac2": "rm_ac2", "r_rc1": "rm_rc1", "r_rc2": "rm_rc2",
           "ac": "sra_ac", "rc": "sra_rc",
           **{c: f"sr_{c}" for c in ("ac1", "ac2", "ac3", "ac4", "ac5", "acor",
                                      "rc1", "rc2", "rc3", "rc4", "rc5", "rcand")}}
    left_out = set() if columns is None else set(OUTPUT_ONLY) - set(columns)
    unread = {OUTPUT_ONLY[c] for c in left_out}
    stored = BASE_COLUMNS
    if not raw_criteria:
        # row-local, so done before anything is stored, joined to lists or shuffled
        base = base.select("*", *criteria_parts(lambda name: _c(raw[name])))
        stored = [c for c in BASE_COLUMNS if c not in raw.values()] + CRITERIA_PARTS
    base = put(base.select(*[c for c in stored if c not in unread]), "course-rows")
    members = base.filter(of_lists)
    base = base.filter(of_rules)
    named = base.where(F.trim("sra_matchctl") == LIST_MATCHCTL).select(F.trim("sra_course").alias("_name")).distinct()
    if pairs is not None:
        list_reqs = req_main.join(named, F.trim("rname") == F.col("_name"), "left_semi")
    member_columns = [c for c in LIST_COLUMNS if c.removeprefix("li_") not in left_out]
    lists = _list_members(members, left_out) if once else course_lists(list_reqs, sub_req, sub_req_ar, institution, reduce=pairs is not None)
    lists = _prefixed(put(lists, "lists"), "li_").select(*member_columns)
    if once:
        lists = named_lists(lists, named)

    is_list = F.trim("li_rqtype") == LIST_RQTYPE
    matchctl_coa = (F.when(is_list, F.coalesce(F.trim("li_matchctl"), F.lit("")))
                     .otherwise(F.coalesce(F.trim("sra_matchctl"), F.lit(""))))
    course = (F.when(is_list, F.coalesce(F.trim("li_course"), F.lit("")))
               .otherwise(F.coalesce(F.trim("sra_course"), F.lit(""))))
    pseudo = eq_blank_padded(_c("sra_ar_type"), ACCEPT_AR_TYPE) & matchctl_coa.isin(*PSEUDO_MATCHCTL)
    tests = row_tests(_c("sra_ar_type"), matchctl_coa, _c("sra_crsflag"), course)

    # Non-list rows of a sub-requirement share one partition (list columns
    # NULL); each referenced list forms its own. Ties in the source's order are
    # broken by the list's last year and the sub-requirement id.
    partition = [*PAIR, "sr_rname", "sr_rqfyt", "li_rname", "li_rqfyt", "sr_user_seq_no"]
    order = ["_seq2_int", "li_seq1", "li_seq2", "li_lyt", "sr_int_seq_no"]
    if method == "window":
        rows = with_list_members(base, lists)
        rows = running_cutoff(rows, partition, order, pseudo, "_cutoff")
        rows = lag_marker(rows, partition, order, "sra_matchctl", "_lag_m")
        kept = rows.filter(tests & (F.col("_cutoff") == 0)
                           & ~F.coalesce(F.col("_lag_m"), F.lit("")).contains(HIDE_NEXT_MARK))
    else:
        # Rows of a list carry the mark of the row that names it, which is 'L':
        # only non-list rows can hide the next one.
        heads = list_heads(lists, F.coalesce(F.trim("li_matchctl"), F.lit("")).isin(*PSEUDO_MATCHCTL))
        headed = with_list_members(base, heads, heads=True)
        members = shown_members(headed.filter(F.col("li_rname").isNotNull()), lists, eq_blank_padded(_c("sra_ar_type"), ACCEPT_AR_TYPE), partition, order)
        nothing = [F.lit(None).cast(lists.schema[c].dataType).alias(c) for c in member_columns]
        alone = headed.filter(F.col("li_rname").isNull()).select(*base.columns, *nothing)
        hides = F.coalesce(_c("sra_matchctl"), F.lit("")).contains(HIDE_NEXT_MARK)
        # the list columns of these rows are NULL, in their keys too
        alone = keep_shown(alone, [c for c in partition if c not in LIST_COLUMNS], [c for c in order if c not in LIST_COLUMNS], ends=pseudo, hides_next=hides, only=tests)
        kept = alone.unionByName(members.filter(tests).select(*base.columns, *member_columns))

    # Output columns, built on the surviving rows only.
    if raw_criteria:
        criteria = [_c(src).alias(name) for name, src in raw.items()]
        out_columns = RULE_COLUMNS
    else:
        criteria = [_c(name) for name in CRITERIA_PARTS]
        out_columns = [c for c in RULE_COLUMNS if c not in RAW_CRITERIA] + CRITERIA_PARTS
    matchctl = (F.when(matchctl_coa.isNull() | (F.trim(matchctl_coa) == HIDE_NEXT_MARK), F.lit(""))
                 .otherwise(matchctl_coa))
    expressions = {
        "rname": F.trim("sr_rname"),
        "subreq_id": _c("sra_sub_int_seq_no").cast("string"),
        "rqfyt": F.trim("sr_rqfyt"),
        "lyt": F.trim("rm_lyt"),
        "rqfyt2": F.trim("li_rqfyt"),
        "lyt2": F.trim("li_lyt"),
        "rtitle1": _c("rm_rtitle1"),
        "seq1": _c("sr_user_seq_no"),
        "seq2": _c("sra_user_seq_no"),
        "seq3": F.coalesce(_c("li_seq1"), F.lit(1)),
        "seq4": F.coalesce(_c("li_seq2"), F.lit(1)),
        "course": course,
        "tflg": F.coalesce(F.trim("sra_tflg"), _c("li_tflg")),
        "ctitle": F.coalesce(F.trim("sra_ctitle"), _c("li_ctitle")),
        "college": _c("dp_college"),
        "category": _c("dp_category"),
        "ar_type": _c("sra_ar_type"),
        "rqtype": _c("rm_rqtype"),
        "matchctl": matchctl,
        **{c: _c(f"sr_{c}") for c in ("grp", "grpmin", "grpmax", "hcmin", "hcmax")},
    }
    out = kept.select(*PAIR, *[e.alias(name) for name, e in expressions.items() if name not in left_out], *criteria)
    return out.select(*PAIR, *[c for c in out_columns if c not in left_out])
