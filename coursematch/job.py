"""A run from files to files: ``python -m coursematch.job --source DIR --crosswalk CSV --output DIR``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from coursematch.config import MatchConfig, build_session
from coursematch.plans import course_match as cm
from coursematch.sources.readers import read_crosswalk_csv, read_table
from coursematch.sources.sinks import run_and_write

TABLES = ("ps_crse_offer", "ps_crse_catalog", "req_main", "sub_req", "sub_req_ar", "dprog", "dprog_req")


def read_inputs(spark: SparkSession, cfg: MatchConfig) -> cm.Inputs:
    """The source tables under ``cfg.source`` (one folder each) and the crosswalk CSV."""
    tables = {t: read_table(spark, f"{cfg.source.rstrip('/')}/{t}", t, cfg.source_format) for t in TABLES}
    return cm.Inputs(crosswalk_raw=read_crosswalk_csv(spark, cfg.crosswalk), **tables)


def run(spark: SparkSession, cfg: MatchConfig) -> DataFrame:
    """Read, match, write; returns the written result."""
    if not (cfg.source and cfg.crosswalk and cfg.output):
        raise ValueError("source, crosswalk and output are needed")
    return run_and_write(read_inputs(spark, cfg), cfg.output, cfg)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    for name in ("source", "crosswalk", "output"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--format", default="parquet")
    p.add_argument("--objects", action="store_true", help="one csv.gz for each pair in place of a folder")
    p.add_argument("--institution")
    p.add_argument("--as-of", type=date.fromisoformat, help="YYYY-MM-DD; today if not given")
    p.add_argument("--pair", action="append", metavar="FIRST,LAST", help="only this requirement pair; may be repeated")
    a = p.parse_args(argv)
    pairs = tuple(tuple(x.split(",", 1)) for x in a.pair) if a.pair else None
    cfg = MatchConfig(as_of=a.as_of, institution=a.institution, source=a.source, source_format=a.format,
                      crosswalk=a.crosswalk, output=a.output, objects=a.objects, pairs=pairs)
    run(build_session(None), cfg)


if __name__ == "__main__":
    main()
