"""J10: the result as gzip CSV, one folder or one object per requirement pair."""

from __future__ import annotations

import gzip
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coursematch.config import MatchConfig
from coursematch.plans import course_match as cm
from coursematch.plans.rules import PAIR
from coursematch.staging import drop_bucketed

# CSV as the source writes it: header, no index, NULL and '' both empty, '"'
# doubled inside quoted fields, blanks kept as they are.
CSV_OPTIONS = {
    "header": "true",
    "compression": "gzip",
    "nullValue": "",
    "emptyValue": "",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_result(result: DataFrame, path: str, replace: str = "all") -> None:
    """Write the result partitioned by pair (``pair_rqfyt=…/pair_lyt=…/part-*.csv.gz``).

    Rows are range-partitioned on (pair, rname, seq1) first: each writer task
    covers one contiguous range, so a pair gets few files, and a pair holding
    a large share of the rows is spread over several writers instead of one.
    ``replace="all"`` leaves nothing of an earlier run; ``"pairs"`` replaces
    only the pairs present in ``result`` (a run for named pairs).
    """
    if replace not in ("all", "pairs"):
        raise ValueError("replace must be 'all' or 'pairs'")
    order = [c for c in (*PAIR, "rname", "seq1") if c in result.columns]
    (result.repartitionByRange(*order).write.mode("overwrite")
           .option("partitionOverwriteMode", "static" if replace == "all" else "dynamic")
           .partitionBy(*PAIR).options(**CSV_OPTIONS).csv(path))


def _header_member(columns: list[str]) -> bytes:
    """A gzip member that holds the header line, quoted as the CSV writer quotes."""
    quoted = ['"' + c.replace('"', '""') + '"' if set(c) & set(',"\n\r') else c for c in columns]
    return gzip.compress((",".join(quoted) + "\n").encode("utf-8"), mtime=0)


def write_objects(result: DataFrame, path: str, prefix: str = "part", replace: str = "all") -> list[str]:
    """Write one object for each pair, ``{prefix}-{rqfyt}-{lyt}.csv.gz``, without the pair columns; returns their names.

    Tasks write a pair's rows as headerless gzip parts in parallel (by ranges, so that a large pair has many writers).
    A gzip file may be several gzip members one after another, so an object is a header member and then the
    parts in row order: nothing is unpacked or packed again. Where the file system can join files (``concat``), no
    byte moves; elsewhere the driver's JVM copies them stream to stream, a buffer at a time. Each object is built beside the
    target folder and moved over its predecessor in one rename, so readers never see half of one.
    ``replace="all"`` also removes objects of pairs that this result doesn't have; ``"pairs"`` leaves them.
    """
    if replace not in ("all", "pairs"):
        raise ValueError("replace must be 'all' or 'pairs'")
    spark = result.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    to_path = lambda *p: jvm.org.apache.hadoop.fs.Path(*p)
    target = to_path(path)
    fs = target.getFileSystem(conf)
    target = fs.makeQualified(target)
    work = to_path(target.getParent(), f"_{target.getName()}-{uuid.uuid4().hex}")
    columns = [c for c in result.columns if c not in PAIR]
    order = [c for c in (*PAIR, "rname", "seq1") if c in result.columns]
    try:
        (result.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy(*PAIR)
               .options(**{**CSV_OPTIONS, "header": "false"}).csv(to_path(work, "parts").toString()))
        fs.mkdirs(target)
        header, names = _header_member(columns), []
        overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
        value = lambda folder: folder.getPath().getName().split("=", 1)[1]  # noqa: E731  (escaped, as in folder names)
        folders = lambda p: [f for f in fs.listStatus(p) if f.isDirectory()]
        for first in folders(to_path(work, "parts")):
            for last in folders(first.getPath()):
                parts = sorted((f.getPath() for f in fs.listStatus(last.getPath())), key=lambda p: p.getName())
                name = f"{prefix}-{value(first)}-{value(last)}.csv.gz"
                built = to_path(work, name)
                out = fs.create(built)
                out.write(header)
                joined = False
                if fs.hasPathCapability(built, "fs.capability.paths.concat"):
                    out.close()
                    sources = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
                    for i, p in enumerate(parts):
                        sources[i] = p
                    fs.concat(built, sources)
                    joined = True
                if not joined:
                    for p in parts:
                        source = fs.open(p)
                        jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
                        source.close()
                    out.close()
                context.rename(built, to_path(target, name), overwrite)
                names.append(name)
        if replace == "all":
            for f in fs.listStatus(target):
                old = f.getPath().getName()
                if old.startswith(prefix + "-") and old.endswith(".csv.gz") and old not in names:
                    fs.delete(f.getPath(), False)
        return sorted(names)
    finally:
        fs.delete(work, True)


def read_objects(spark: SparkSession, path: str, schema: StructType, prefix: str = "part") -> DataFrame:
    """The objects of ``write_objects`` with the types they had; the pair comes from the object's name (its last year has no '-')."""
    body = StructType([f for f in schema.fields if f.name not in PAIR])
    rows = spark.read.schema(body).options(**CSV_OPTIONS).csv(f"{path.rstrip('/')}/{prefix}-*.csv.gz").select("*", F.col("_metadata.file_name").alias("_name"))
    found = [F.regexp_extract("_name", rf"^{prefix}-(.*)-([^-]*)\.csv\.gz$", i) for i in (1, 2)]
    decode = lambda v: F.url_decode(F.replace(v, F.lit("+"), F.lit("%2B")))
    pair = [decode(decode(v)) for v in found]       # once for the URI that Spark gives, once for the name
    return rows.withColumns(dict(zip(PAIR, pair))).select([f.name for f in schema.fields])


def read_result(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A written result, with the types it had."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path).select([f.name for f in schema.fields])


def pair_table(spark: SparkSession, pairs) -> DataFrame:
    """The named pairs of a partial run as a table (rqfyt, lyt)."""
    return spark.createDataFrame([tuple(p) for p in pairs], "rqfyt string, lyt string").distinct()


def run_and_write(inputs: cm.Inputs, path: str, cfg: MatchConfig = MatchConfig()) -> DataFrame:
    """The whole job: rules (staged while it runs), courses, matching, CSV per pair.

    With ``cfg.objects`` that is one object a pair, else a folder of parts a pair.
    Returns the written result, read from ``path``. With ``cfg.pairs`` only
    those pairs are computed and replaced.
    """
    cfg = replace(cfg, as_of=cfg.day())
    which = "all" if cfg.pairs is None else "pairs"
    spark = inputs.req_main.sparkSession
    wanted = None if cfg.pairs is None else pair_table(spark, cfg.pairs)
    rules = cm.staged_rules(inputs, cfg, wanted)
    try:
        result = cm.course_match(inputs, cfg, rules_df=rules)
        (write_objects if cfg.objects else write_result)(result, path, replace=which)
        schema = result.schema
    finally:
        drop_bucketed(rules)
    return (read_objects if cfg.objects else read_result)(spark, path, schema)
