"""J10 sink, readers, the driver entry and the oracle on the smallest tables."""

import glob
import gzip
import os
from dataclasses import replace

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from coursematch.plans.rules import PAIR
from coursematch.sources.readers import CROSSWALK_EXPR_HEADER, read_crosswalk_csv
from coursematch.sources.sinks import read_objects, read_result, write_objects, write_result


def test_write_result_csv_per_pair(spark, tmp_path):
    df = spark.createDataFrame(
        [("19957", "19954", "R1", None, " a ", 'say "hi"', ""),
         ("19957", "19974", "R2", "x", "b", "c,d", "e")],
        "pair_rqfyt string, pair_lyt string, rname string, subreq_id string, tflg string, "
        "ctitle string, matchctl string")
    out = str(tmp_path / "result")
    write_result(df, out)
    files = sorted(glob.glob(f"{out}/pair_rqfyt=*/pair_lyt=*/*.csv.gz"))
    assert len(files) == 2
    first = gzip.open(files[0], "rt", encoding="utf-8").read().splitlines()
    assert first[0] == "rname,subreq_id,tflg,ctitle,matchctl"
    # NULL and '' both empty, blanks kept, quotes doubled
    assert first[1] == 'R1,, a ,"say ""hi""",'
    second = gzip.open(files[1], "rt", encoding="utf-8").read().splitlines()
    assert second[1] == 'R2,x,b,"c,d",e'


def test_staged_tables_go_when_told(spark):
    from coursematch.staging import drop_bucketed, stage, stage_bucketed, unstage
    plain, bucketed = stage(spark.range(5), "t"), stage_bucketed(spark.range(50).withColumn("k", F.col("id") % 7), "t", 4, ["k"], ["id"])
    for back, n, drop in ((plain, 5, unstage), (bucketed, 50, drop_bucketed)):
        folder = back._staged_path.removeprefix("file:")
        assert back.count() == n and os.path.isdir(folder)
        drop(back)
        assert not os.path.exists(folder)
    assert spark.sparkContext.getCheckpointDir() is not None


OBJECT_ROWS = [("19957", "19954", f"R{i:04d}", None if i % 3 else i, ' a ' if i % 2 else 'say "hi", ñ') for i in range(900)] + [("2000/7", "20 04", "R", None, "x;y"), ("20017", "20014", "S", 4, None)]
OBJECT_SCHEMA = "pair_rqfyt string, pair_lyt string, rname string, seq1 int, ctitle string"


def test_one_object_for_each_pair(spark, tmp_path):
    df = spark.createDataFrame(OBJECT_ROWS, OBJECT_SCHEMA).repartition(6)
    out = str(tmp_path / "objects")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # several writers for this little
    names = write_objects(df, out)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert names == ["part-19957-19954.csv.gz", "part-2000%2F7-20 04.csv.gz", "part-20017-20014.csv.gz"]
    assert sorted(f for f in os.listdir(out) if f.endswith(".gz")) == names and os.listdir(tmp_path) == ["objects"]
    raw = open(f"{out}/part-19957-19954.csv.gz", "rb").read()
    assert raw.count(b"\x1f\x8b\x08") > 2           # a header member and several parts
    lines = gzip.decompress(raw).decode().splitlines()
    # integers with NULLs stay integers, NULL is empty, quotes doubled, one header
    assert lines[0] == "rname,seq1,ctitle" and lines[1:4] == ['R0000,0,"say ""hi"", ñ"', "R0001,, a ", 'R0002,,"say ""hi"", ñ"'] and len(lines) == 901
    assert lines[1:] == sorted(lines[1:])
    back = read_objects(spark, out, df.schema)
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted((tuple(r) for r in back.collect()), key=key) == sorted(OBJECT_ROWS, key=key)


def test_objects_are_replaced_whole(spark, tmp_path):
    rows3 = [("1", "2", "a", 1, "x"), ("3", "4", "b", 2, "y")]
    df, out = spark.createDataFrame(rows3, OBJECT_SCHEMA), str(tmp_path / "objects")
    write_objects(df, out)
    write_objects(df.where("pair_rqfyt = '1'").withColumn("seq1", F.lit(9)), out, replace="pairs")
    assert sorted(tuple(r) for r in read_objects(spark, out, df.schema).collect()) == [("1", "2", "a", 9, "x"), ("3", "4", "b", 2, "y")]
    write_objects(df.where("pair_rqfyt = '3'"), out)
    assert [f for f in os.listdir(out) if f.endswith(".gz")] == ["part-3-4.csv.gz"]


def test_a_second_run_leaves_nothing_of_the_first(spark, tmp_path):
    schema = "pair_rqfyt string, pair_lyt string, rname string, seq1 int"
    both = spark.createDataFrame([("19957", "19954", "R1", 1), ("19957", "19974", "R2", 2)], schema)
    one = both.filter("rname = 'R1'").withColumn("seq1", F.lit(7))
    out, before = str(tmp_path / "r"), spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    write_result(both, out)
    write_result(one, out, replace="pairs")         # the other pair stays
    assert sorted(tuple(r) for r in read_result(spark, out, both.schema).collect()) == [("19957", "19954", "R1", 7), ("19957", "19974", "R2", 2)]
    write_result(one, out)
    assert [tuple(r) for r in read_result(spark, out, both.schema).collect()] == [("19957", "19954", "R1", 7)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_job_from_files_to_csv(spark, tmp_path):
    from coursematch import job
    from coursematch.config import MatchConfig
    from coursematch.queries import CFG, inputs, q_course_match
    source = inputs(spark, SF_SMALL)
    for name in job.TABLES:
        getattr(source, name).write.parquet(str(tmp_path / name))
    source.crosswalk_raw.withColumnsRenamed({"designation": "PS", "expr": CROSSWALK_EXPR_HEADER}).coalesce(1).write.option("header", True).csv(str(tmp_path / "cw"))
    cfg = MatchConfig(as_of=CFG.as_of, institution=CFG.institution, source=str(tmp_path), crosswalk=str(tmp_path / "cw"), output=str(tmp_path / "out"))
    back = job.run(spark, cfg)
    want = q_course_match(spark, SF_SMALL)
    assert back.columns == want.columns and back.count() == want.count() > 0
    assert glob.glob(f"{tmp_path}/out/pair_rqfyt=*/pair_lyt=*/*.csv.gz")
    # the same run as one object a pair, for one pair
    pair = tuple(want.select(*PAIR).first())
    some = job.run(spark, replace(cfg, output=str(tmp_path / "objects"), objects=True, pairs=(pair,)))
    assert [f for f in os.listdir(tmp_path / "objects") if f.endswith(".gz")] == [f"part-{pair[0]}-{pair[1]}.csv.gz"]
    assert some.columns == want.columns and some.count() == want.where((F.col(PAIR[0]) == pair[0]) & (F.col(PAIR[1]) == pair[1])).count() > 0


def test_default_day_is_today():
    from datetime import date

    from coursematch.config import MatchConfig
    assert MatchConfig().day() == date.today() and MatchConfig(as_of=date(2020, 1, 2)).day() == date(2020, 1, 2)


@pytest.mark.parametrize("header", ["PS Requirement Designation", "PS"])
def test_crosswalk_csv_reader(spark, tmp_path, header):
    p = tmp_path / "cw.csv"
    p.write_text(f'{header},DARS Subreq AC1-AC5,Other\nGE11,"HUAD OR (HU or SB) & C & H",x\n', encoding="utf-8")
    got = [tuple(r) for r in read_crosswalk_csv(spark, str(p)).collect()]
    assert got == [("GE11", "HUAD OR (HU or SB) & C & H")]


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == PAIR and len(df.columns) == 24


def test_oracle_agrees_on_small_tables(spark):
    import __spark_entry__ as e
    from collections import Counter
    from coursematch.queries import QUERIES
    qs, sql = e.queries(), e.oracle_sql()
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    for name in QUERIES:
        df = qs[name](spark, SF_SMALL)
        res = con.execute(sql[name])
        ocols = [d[0] for d in res.description]
        assert sorted(ocols) == sorted(df.columns), name
        order = sorted(df.columns)
        s = Counter(tuple(r[c] for c in order) for r in df.collect())
        o = Counter(tuple(dict(zip(ocols, r))[c] for c in order) for r in res.fetchall())
        assert s == o, name


def test_run_and_write_end_to_end(spark, tmp_path):
    from coursematch.queries import CFG, inputs, q_course_match
    from coursematch.sources.sinks import run_and_write
    out = str(tmp_path / "job")
    run_and_write(inputs(spark, SF_SMALL), out, CFG)
    back = (spark.read.option("header", True).option("inferSchema", False).csv(out)
                 .select("pair_rqfyt", "pair_lyt", "rname", "seq1", "seq2", "full_crse"))
    expected = q_course_match(spark, SF_SMALL).selectExpr(
        "pair_rqfyt", "pair_lyt", "rname", "cast(seq1 as string) seq1", "cast(seq2 as string) seq2", "full_crse")
    assert back.count() == expected.count() > 0
    assert back.exceptAll(expected).count() == 0
    assert len(glob.glob(f"{out}/pair_rqfyt=*/pair_lyt=*")) == expected.select(*PAIR).distinct().count()


def test_jdbc_source_options_come_from_environment(monkeypatch):
    # No database is reachable here: only the option set handed to Spark's JDBC reader is checked.
    from coursematch.sources.readers import JdbcSource
    monkeypatch.setenv("CM_TEST_USER", "reader")
    monkeypatch.setenv("CM_TEST_PASSWORD", "secret")
    src = JdbcSource(url="jdbc:postgresql://db.example/ods", user_env="CM_TEST_USER",
                     password_env="CM_TEST_PASSWORD", fetch_size=5000)
    opts = src.options()
    assert opts["user"] == "reader" and opts["password"] == "secret"
    assert opts["fetchsize"] == "5000" and opts["driver"] == "org.postgresql.Driver"
