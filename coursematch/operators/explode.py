"""Character explode and per-group all/none flags over code strings.

The explode-and-aggregate way of evaluating the criteria: every code string
is exploded into its characters, each character is tested against the other
string, and one grouped aggregate folds the tests back into 0/1 flags. It is
the row-wise equivalent of ``functions.criteria`` and serves as its
brute-force check; both must agree on every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursematch.staging import stage

KEYS = ["ac_all", "rc_ord", "rc_and", "ac_cw"]


def code_flags(pairs: DataFrame) -> DataFrame:
    """``ac_match``, ``rc_ord_match``, ``rc_and_match`` (0/1) per distinct row of ``pairs``.

    One explode of the three strings, tagged by role, and one grouped
    aggregate (partial aggregation before the shuffle):

    * accept: every accept code occurs in the combination;
    * any-of reject: no reject code occurs in the combination;
    * all-of reject: fails when the all-of string is set and every code of a
      non-empty combination occurs in it.
    """
    w = F.coalesce(F.col("ac_cw"), F.lit(""))
    base = pairs.select(*[F.coalesce(F.col(k), F.lit("")).alias(k) for k in KEYS[:3]], w.alias("ac_cw")).distinct()

    def tagged(col: str, role: str):
        return F.transform(F.split(F.col(col), ""), lambda c: F.struct(F.lit(role).alias("role"), c.alias("code")))

    exploded = base.select(*KEYS, F.explode(F.concat(tagged("ac_all", "a"), tagged("rc_ord", "o"),
                                                     tagged("ac_cw", "w"))).alias("t"))
    role, code = F.col("t.role"), F.col("t.code")
    in_cw = F.instr(F.col("ac_cw"), code) > 0
    in_and = F.instr(F.col("rc_and"), code) > 0
    missing_accept = F.sum(F.when((role == "a") & (code != "") & ~in_cw, 1).otherwise(0))
    reject_hits = F.sum(F.when((role == "o") & (code != "") & in_cw, 1).otherwise(0))
    cw_codes = F.sum(F.when((role == "w") & (code != ""), 1).otherwise(0))
    cw_outside_and = F.sum(F.when((role == "w") & (code != "") & ~in_and, 1).otherwise(0))
    agg = exploded.groupBy(*KEYS).agg(missing_accept.alias("_miss"), reject_hits.alias("_hits"),
                                      cw_codes.alias("_cw"), cw_outside_and.alias("_out"))
    return agg.select(
        *KEYS,
        F.when(F.col("_miss") == 0, 1).otherwise(0).alias("ac_match"),
        F.when(F.col("_hits") == 0, 1).otherwise(0).alias("rc_ord_match"),
        F.when((F.col("rc_and") != "") & (F.col("_cw") > 0) & (F.col("_out") == 0), 0)
         .otherwise(1).alias("rc_and_match"))


def indexed_characters(strings: DataFrame, longest: int = 60) -> DataFrame:
    """(``s``, ``i``, ``code``): every character of each distinct string of the column ``s`` with its place from 1.

    A recursive query: each step takes the next character of the strings that have one, so it ends
    after the longest one. Spark bounds the depth of a recursion (100 steps unless set otherwise), so strings of over ``longest``
    characters are an error, not a shorter result; criteria have at most 24 codes. (Its row limit, 1,000,000 unless
    ``spark.sql.cteRecursionRowLimit`` says otherwise, is an error too.) NULL and '' have no characters.
    """
    spark = strings.sparkSession
    checked = strings.select("s").distinct().where("s != ''").select(
        F.when(F.char_length("s") > longest, F.raise_error(F.lit(f"a string of over {longest} characters"))).otherwise(F.col("s")).alias("s"))
    return spark.sql("""
        WITH RECURSIVE chars(s, i, code) AS (
          SELECT s, 1, substring(s, 1, 1) FROM {strings}
          UNION ALL
          SELECT s, i + 1, substring(s, i + 1, 1) FROM chars WHERE i < char_length(s)
        )
        SELECT s, i, code FROM chars""", strings=checked)


def code_flags_by_index(pairs: DataFrame) -> DataFrame:
    """``code_flags`` from characters that a recursive query has numbered: each string of a criteria row is joined to its
    characters and each character tested against the combination. The rows are staged, as they are read five times."""
    w = F.coalesce(F.col("ac_cw"), F.lit(""))
    base = stage(pairs.select(*[F.coalesce(F.col(k), F.lit("")).alias(k) for k in KEYS[:3]], w.alias("ac_cw")).distinct(), "criteria-pairs")
    every = base.select(F.explode(F.array("ac_all", "rc_ord", "ac_cw")).alias("s"))
    chars = indexed_characters(every)

    def tests(column: str, name: str, hit) -> DataFrame:
        met = base.join(chars, base[column] == chars["s"])
        return met.groupBy(*KEYS).agg(F.sum(F.when(hit, 1).otherwise(0)).alias(name), F.count(F.lit(1)).alias(name + "_all"))

    in_cw, in_and = F.instr(F.col("ac_cw"), F.col("code")) > 0, F.instr(F.col("rc_and"), F.col("code")) > 0
    found = (base.join(tests("ac_all", "_miss", ~in_cw), KEYS, "left").join(tests("rc_ord", "_hits", in_cw), KEYS, "left")
             .join(tests("ac_cw", "_out", ~in_and), KEYS, "left"))
    none = lambda c: F.coalesce(F.col(c), F.lit(0)) == 0
    return found.select(
        *KEYS, F.when(none("_miss"), 1).otherwise(0).alias("ac_match"), F.when(none("_hits"), 1).otherwise(0).alias("rc_ord_match"),
        F.when((F.col("rc_and") != "") & ~none("_out_all") & none("_out"), 0).otherwise(1).alias("rc_and_match"))
