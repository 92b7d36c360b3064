import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from coursematch.config import tune_session

    ckpt = tempfile.mkdtemp(prefix="cm-test-ckpt-", dir="/tmp")
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    tune_session(s)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (None sorts first) for order-free comparison."""
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))


def normalise_criteria(rules):
    """Rule rows with raw criteria columns to criteria strings and term codes, as a run does in two steps."""
    from coursematch.plans.normalise import RAW_CRITERIA, criteria_parts, finish_criteria
    return finish_criteria(rules.select("*", *criteria_parts()).drop(*RAW_CRITERIA))
