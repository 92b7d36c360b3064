"""Licence scans by diagonal voting, in DataFrame operations.

Every pair of neighbouring words of a text is looked up among the pairs of the templates. A hit votes for
the diagonal (its place less the template's place); the votes of neighbouring diagonals are merged, so a
span survives inserted or left-out words, and spans that cover enough of the template are reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Common licence notices, in words as the scan sees them, and their labels.
NOTICES = {
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
}
COVER = 0.85        # share of a notice's word pairs that a span must hold
DRIFT = 2           # largest step between diagonals of one span
#: Words as the scan takes them, before lower-casing.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _templates(spark) -> DataFrame:
    """A row for each word pair of each template: a fixed, small table."""
    rows = []
    for t, (phrase, label) in enumerate([*BASE.items(), *NOTICES.items()]):
        w = phrase.split()
        rows += [(t, i, w[i], w[i + 1], len(w) - 1, label, t < len(BASE)) for i in range(len(w) - 1)]
    return spark.createDataFrame(rows, "template int, t_at int, t1 string, t2 string, pairs int, label string, is_base boolean")


def scan(documents: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) for every row.

    n_base counts the places where a base phrase's words stand one after another, first_word and last_word
    are the smallest and largest of them. spans are the notices found (label, first word, last word,
    coverage); labels are those of both, score the largest coverage (1 for a base phrase, 0 for none).
    A null or empty text has no words. Rows are told apart by doc_id (null is one) and text; repeated rows are
    scanned once, and each comes back. Other columns are not read.
    """
    spark = documents.sparkSession
    templates = F.broadcast(_templates(spark))
    lower = lambda c: F.translate(c, UPPER, LOWER)
    firsts = sorted({w for p in [*BASE, *NOTICES] for w in p.split()[:-1]})

    body = F.coalesce(F.col(text), F.lit(""))
    listed = documents.select("doc_id", F.xxhash64(body).alias("h"), F.regexp_extract_all(body, F.lit(WORDS), F.lit(0)).alias("w"))
    pairs = F.arrays_zip(F.col("w").alias("w1"), F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0))).alias("w2"))
    placed = listed.select("doc_id", "h", F.size("w").cast("long").alias("n_words"), F.posexplode_outer(pairs).alias("at", "p"))
    # the first row of a document stays whether or not it is a hit; lower() finds at least the words that translate() finds
    near = placed.select("doc_id", "h", "n_words", "at", F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2")).where(
        F.col("at").isNull() | (F.col("at") == 0) | F.lower("w1").isin(firsts))
    hits = (near.join(templates, (lower("w1") == F.col("t1")) & (lower("w2") == F.col("t2")), "left")
            .where("at is null or at = 0 or template is not null"))

    # a row is at its first place once for each template place there: the largest count is that of repeated rows
    votes = hits.groupBy("doc_id", "h", "template", (F.col("at") - F.col("t_at")).alias("diagonal")).agg(
        F.max("n_words").alias("n_words"), F.sum(F.when(F.col("at").isNull() | (F.col("at") == 0), 1).otherwise(0)).alias("copies"), F.first("pairs").alias("pairs"), F.first("label").alias("label"), F.first("is_base").alias("is_base"),
        F.collect_set(F.when(F.col("template").isNotNull(), F.col("t_at"))).alias("seen"), F.min("at").alias("lo"), F.max("at").alias("hi"))
    w = Window.partitionBy("doc_id", "h", "template").orderBy("diagonal")
    steps = votes.withColumn("new", F.when(F.col("diagonal") - F.lag("diagonal").over(w) <= DRIFT, 0).otherwise(1))
    spans = (steps.withColumn("span", F.sum("new").over(w)).groupBy("doc_id", "h", "template", "span").agg(
        F.max("n_words").alias("n_words"), F.max("copies").alias("copies"), F.first("label").alias("label"), F.first("is_base").alias("is_base"), F.first("pairs").alias("pairs"),
        F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"), F.min("lo").alias("lo"), (F.max("hi") + 1).alias("hi"),
        F.collect_list(F.when(F.col("is_base") & (F.size("seen") == F.col("pairs")), F.col("diagonal"))).alias("places")))
    cover = F.size("seen") / F.col("pairs")
    verified = F.coalesce(~F.col("is_base") & (cover >= COVER) & (F.col("hi") - F.col("lo") + 1 <= 2 * (F.col("pairs") + 1)), F.lit(False))
    is_base = F.coalesce(F.col("is_base") & (F.size("places") > 0), F.lit(False))
    per = spans.groupBy("doc_id", "h").agg(
        F.max("n_words").alias("n_words"), F.max("copies").alias("copies"), F.coalesce(F.sum(F.when(is_base, F.size("places"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(is_base, F.array_min("places"))).cast("long").alias("first_word"), F.max(F.when(is_base, F.array_max("places"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_base | verified, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(is_base, F.lit(1.0)).when(verified, cover)), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(verified, F.struct("label", F.col("lo").alias("first"), F.col("hi").alias("last"), cover.alias("cover"))))).alias("spans"))
    return per.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("h", "copies", "copy")
