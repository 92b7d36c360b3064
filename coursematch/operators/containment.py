"""Set-containment join on code strings: which combinations satisfy which criteria, without a cross join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursematch.staging import stage

#: The bit of "some character outside the known codes"; at most 62 codes have a bit of their own.
OTHER = 62
EMPTY = -1


def code_mask(value: Column, codes: Sequence[str]) -> Column:
    """The codes of a string as bits of a long, in the order of ``codes``; bit ``OTHER`` if any other character stands in it. NULL is ''."""
    if len(codes) > OTHER or any(len(c) != 1 for c in codes):
        raise ValueError(f"up to {OTHER} codes of one character")
    v = F.coalesce(value, F.lit(""))
    mask = F.when(F.call_function("translate", v, F.lit("".join(codes)), F.lit("")) != "", F.lit(1 << OTHER)).otherwise(F.lit(0).cast("long"))
    for i, c in enumerate(codes):
        mask = mask.bitwiseOR(F.when(v.contains(c), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return mask


def _bits(mask: Column, n: int) -> Column:
    """Numbers of the set bits among the first ``n``."""
    return F.filter(F.array(*[F.lit(i) for i in range(n)]), lambda i: mask.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0)


def containing(sets: DataFrame, supersets: DataFrame, bits: int, salts: int = 16) -> DataFrame:
    """(``mask``, ``super_mask``) of distinct masks where the set's first ``bits`` bits all stand in the superset.

    An inverted index: a superset is listed under each of its bits, a set asks under the one of its bits that
    the fewest supersets have, and the others are tested by one bit operation. The empty set is in every
    superset, so all of that is result; its rows are dealt over ``salts`` keys.
    """
    sets = sets.select("mask").distinct()
    supersets = supersets.select(F.col("mask").alias("super_mask")).distinct()
    own = supersets.select("super_mask", F.explode(_bits(F.col("super_mask"), bits)).alias("bit"), F.lit(0).alias("salt"))
    empty = supersets.select("super_mask", F.lit(EMPTY).alias("bit"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    counts = own.groupBy("bit").agg(F.count(F.lit(1)).alias("n"))
    asked = sets.select("mask", F.explode(_bits(F.col("mask"), bits)).alias("bit")).join(counts, "bit", "left")
    rarest = asked.groupBy("mask").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "bit")).alias("best")).select("mask", F.col("best.bit").alias("bit"), F.lit(0).alias("salt"))
    known = (1 << bits) - 1
    none = sets.where(F.col("mask").bitwiseAND(F.lit(known)) == 0).select("mask", F.lit(EMPTY).alias("bit"), F.pmod(F.xxhash64("mask"), F.lit(salts)).cast("int").alias("salt"))
    met = rarest.unionAll(none).join(own.unionAll(empty), ["bit", "salt"])
    inside = F.col("mask").bitwiseAND(F.lit(known)).bitwiseAND(F.bitwise_not("super_mask")) == 0
    return met.where(inside).select("mask", "super_mask")


def accepted_combinations(criteria: DataFrame, combinations: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Distinct criteria (``ac_all``, ``rc_ord``, ``rc_and``) with each distinct combination ``ac_cw`` that meets them.

    Met: every accept code stands in the combination; no any-of reject code does; and not (both the all-of
    reject string and the combination are non-empty and every code of the combination is among the rejects).
    All three are bit operations on masks, except where a string has characters outside ``codes``: those
    pairs are tested on the strings themselves. NULL strings read as ''. Empty tables give none. Both sides are staged, distinct:
    they are read several times, and ``criteria`` may be a long computation.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    c = criteria.select(text("ac_all"), text("rc_ord"), text("rc_and")).distinct()
    w = combinations.select(text("ac_cw")).distinct()
    c = stage(c, "criteria").select("*", *[code_mask(F.col(k), codes).alias(m) for k, m in (("ac_all", "mask"), ("rc_ord", "_any"), ("rc_and", "_all"))])
    w = stage(w, "combinations").withColumn("super_mask", code_mask(F.col("ac_cw"), codes))
    met = containing(c, w.select(F.col("super_mask").alias("mask")), len(codes))
    pairs = c.join(met, "mask").join(w, "super_mask")
    other = F.lit(1 << OTHER)
    a, any_, all_, sup = (F.col(n) for n in ("mask", "_any", "_all", "super_mask"))
    delete = lambda x, y: F.call_function("translate", x, y, F.lit(""))
    odd = a.bitwiseOR(any_).bitwiseOR(all_).bitwiseAND(other) != 0
    by_bits = (any_.bitwiseAND(sup) == 0) & ~((all_ != 0) & (sup != 0) & (sup.bitwiseAND(F.bitwise_not(all_)) == 0))
    cw = F.col("ac_cw")
    by_text = ((delete(F.col("ac_all"), cw) == "") & (F.char_length(delete(F.col("rc_ord"), cw)) == F.char_length("rc_ord"))
               & ~((F.col("rc_and") != "") & (cw != "") & (delete(cw, F.col("rc_and")) == "")))
    return pairs.where(F.when(odd, by_text).otherwise(by_bits)).select("ac_all", "rc_ord", "rc_and", "ac_cw")
