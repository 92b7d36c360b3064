"""The corpus pipeline: quality, near-duplicates, contamination, mixture, shards.

``STAGES`` holds (name, function); each function takes (spark, docs, sf_dir) and returns the documents that
stay, with their columns; the last one returns the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursematch.llm.common import Store
from coursematch.llm.crf import quality
from coursematch.llm.decontam import contamination
from coursematch.llm.kdtree import shard
from coursematch.llm.minhash import without_near_duplicates
from coursematch.llm.mixing import mix

#: Expected tokens of each domain after mixing, as a share of those before it: toxic text goes, the rest stays.
FACTORS = {"clean": 1.0, "low": 1.0, "toxic": 0.0}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores at 0.5 or more; whole rows pass through, nothing is shuffled."""
    return quality(docs, _table(spark, sf_dir, "labels")).where("score >= 0.5").select("row.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id. Rows without a doc_id stay."""
    return without_near_duplicates(docs, words_per_shingle=5, similarity="0.8")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    return contamination(docs, _table(spark, sf_dir, "benchmark")).where(F.size("hits") == 0).select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once or not at all (rates go from 0 to 1, so no copies come back): it stays if a hash of its doc_id and text,
    even over 0 to 1, is under its rate, so the domains' tokens come to what the rates come to, within the spread of such draws."""
    rated = mix(docs, _table(spark, sf_dir, "labels"), factors=FACTORS, most=1.0)
    draw = F.pmod(F.xxhash64("row.doc_id", "row.text"), F.lit(1 << 30)) / float(1 << 30)
    return rated.where(draw < F.col("rate")).select("row.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document."""
    return shard(docs, n_shards=40)


STAGES = [("quality", good_quality), ("minhash", without_copies), ("decontamination", without_benchmark), ("mixing", mixed), ("sharding", sharded)]

#: SQL can't express the fitted classifiers; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    store = Store(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        kept = store.put(out, name)
        if i:
            store.drop(docs)
        docs = kept
    return docs
