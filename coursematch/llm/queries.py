"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from coursematch.llm.minhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), words_per_shingle=3, similarity="0.85")


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from coursematch.llm.suffixtree import score

    return score(_table(spark, sf_dir, "documents"))


def op3_hyperplane(spark: SparkSession, sf_dir: str) -> DataFrame:
    from coursematch.llm.hyperplane import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.9)


def op6_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from coursematch.llm.kdtree import shard

    return shard(_table(spark, sf_dir, "documents"), n_shards=40)


def op7_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    from coursematch.llm.licenses import scan

    return scan(_table(spark, sf_dir, "documents")).drop("spans")


def op8_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from coursematch.llm.linededup import drop_repeated_lines

    kept = drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


def op4_qgrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    from coursematch.llm.decontam import contamination

    found = contamination(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", (F.size("hits") > 0).alias("contaminated"), F.size("hits").cast("long").alias("n_items"),
                        F.array_sort(F.array_distinct("hits.item_id")).alias("items"))


def op5_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from coursematch.llm.crf import quality

    scored = quality(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return scored.select("row.doc_id", F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    from coursematch.llm.suffixdedup import drop_repeats

    return drop_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from coursematch.llm.mixing import mix

    mixed = mix(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"),
                shares={"clean": 0.8, "low": 0.15, "toxic": 0.05}, keep=["doc_id"])
    return mixed.select("row.doc_id", "n_tokens", F.col("p0").alias("p_clean"), F.col("p1").alias("p_low"), F.col("p2").alias("p_toxic"), "rate")


#: The rules of the url query.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op11_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    from coursematch.llm.linkgraph import Rule, judge

    return judge(_table(spark, sf_dir, "pages"), [Rule(*r) for r in URL_RULES]).drop("trust", "distrust")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from coursematch.llm.collocations import collocations

    return collocations(_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from coursematch.llm.whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


QUERIES = {f.__name__: f for f in (
    op1_minhash, op2_suffix_tree, op3_hyperplane, op4_qgrams, op5_crf, op6_kdtree, op7_diagonals, op8_line_windows, op9_deep_shallow, op10_mixing,
    op11_link_graph, op12_collocations, op13_whitening)}
