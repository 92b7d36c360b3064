"""Domain tables derived from the driver's TPC-H-like tables.

The driver's data holds no course, requirement or program data, so the domain
tables are derived from it by plain SQL that Spark and DuckDB evaluate alike
(``string``, ``chr``, ``substr``, ``||``, integer ``%``). Each text names its
inputs as ``{name}`` placeholders: Spark binds them to DataFrames through
``spark.sql(text, **frames)``, the DuckDB oracle turns them into CTE names.
NULLs are put in on purpose (the driver tables hold none). The derivation is
test data only; production reads the real tables through ``sources.readers``.
"""

from __future__ import annotations

import threading
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _union_all(select: str, column: str, values) -> str:
    return "\n    UNION ALL\n    ".join(select.format(**{column: v}) for v in values)


# name -> (SQL template, inputs). Inputs are base tables or earlier views.
#: The institution and the day of the derived test data.
INSTITUTION = "UNI"
AS_OF = "1998-06-01"

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "d_item": ("""
SELECT
  cast(p_partkey AS string) AS crse_id,
  upper(substr(p_name, 1, 1)) || chr(cast(65 + p_partkey % 26 AS int))
    || chr(cast(65 + p_partkey % 23 AS int)) AS subject,
  cast(100 + p_partkey % 600 AS string) AS catalog_nbr,
  p_size,
  p_partkey
FROM {part}""", ("part",)),

    "ps_crse_offer": ("""
SELECT
  i.crse_id,
  cast(l.l_shipdate AS date) AS effdt,
  i.subject,
  i.catalog_nbr,
  CASE WHEN l.l_linestatus = 'O' AND l.l_linenumber = 1 THEN 'N'
       WHEN l.l_linenumber = 7 THEN NULL
       ELSE 'Y' END AS schedule_print
FROM {lineitem} l JOIN {d_item} i ON l.l_partkey = i.p_partkey""", ("lineitem", "d_item")),

    "ps_crse_catalog": ("""
SELECT
  i.crse_id,
  CASE WHEN l.l_linenumber = 6 THEN NULL ELSE cast(l.l_shipdate AS date) END AS effdt,
  CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber <= 2 THEN 'I' ELSE 'A' END AS eff_status,
  CASE WHEN i.p_size % 3 = 0 THEN '-' ELSE 'D' || cast(i.p_size AS string) END AS rqmnt_designtn,
  1 + l.l_linenumber % 3 AS units_minimum,
  3 + l.l_linenumber % 2 AS units_maximum
FROM {lineitem} l JOIN {d_item} i ON l.l_partkey = i.p_partkey""", ("lineitem", "d_item")),

    "crosswalk_raw": ("""
SELECT DISTINCT
  'D' || cast(p_size AS string) AS designation,
  CASE p_size % 5
    WHEN 0 THEN 'HU & C'
    WHEN 1 THEN 'HUAD OR (HU or SB) & C & H'
    WHEN 2 THEN 'CS'
    WHEN 3 THEN '(L or MA) & G'
    ELSE 'SOBE OR SB & CS & H & G' END AS expr
FROM {part}""", ("part",)),

    "req_main": ("""
SELECT
  'Q' AS instidq,
  'I' AS instid,
  CASE WHEN c_custkey % 50 = 49 THEN 'XX' ELSE 'UNI' END AS instcd,
  'R' || cast(c_custkey AS string) || ' ' AS rname,
  cast(1995 + c_custkey % 6 AS string) || '7' AS rqfyt,
  cast(1995 + c_custkey % 6 + c_custkey % 4 + 2 * k AS string) || '4' AS lyt,
  'T' || cast(c_custkey % 40 AS string) AS rtitle1,
  CASE WHEN c_custkey % 5 = 0 THEN 'L' ELSE 'M' END AS rqtype,
  CASE WHEN c_custkey % 9 = 0 THEN '¿' END AS ac1,
  CASE WHEN c_custkey % 12 = 1 THEN 'U' END AS ac2,
  CASE WHEN c_custkey % 8 = 0 THEN 'ñ' END AS rc1,
  cast(NULL AS string) AS rc2
FROM (
    SELECT c_custkey, 0 AS k FROM {customer}
    UNION ALL
    SELECT c_custkey, 1 AS k FROM {customer} WHERE c_custkey % 10 = 0
) c""", ("customer",)),

    "sub_req": ("""
SELECT
  'Q' AS instidq,
  'I' AS instid,
  CASE WHEN o_custkey % 50 = 49 THEN 'XX' ELSE 'UNI' END AS instcd,
  'R' || cast(o_custkey AS string) || ' ' AS rname,
  cast(1995 + o_custkey % 6 AS string) || '7' AS rqfyt,
  o_orderkey AS int_seq_no,
  cast(o_orderkey AS int) AS user_seq_no,
  CASE WHEN o_orderkey % 2 = 0 THEN 'H' ELSE 'C' END AS grp,
  1 AS grpmin,
  1 + o_orderkey % 2 AS grpmax,
  3 AS hcmin,
  6 AS hcmax,
  CASE o_orderkey % 5 WHEN 0 THEN 'H' WHEN 1 THEN 'Q' WHEN 2 THEN 'U' WHEN 3 THEN ' c ' END AS ac1,
  CASE o_orderkey % 7 WHEN 0 THEN 'c' WHEN 1 THEN 'h' WHEN 2 THEN 'L' END AS ac2,
  cast(NULL AS string) AS ac3,
  CASE WHEN o_orderkey % 6 = 0 THEN '2.00' END AS ac4,
  cast(NULL AS string) AS ac5,
  CASE WHEN o_orderkey % 3 = 0 THEN '-' END AS acor,
  CASE o_orderkey % 11 WHEN 0 THEN 'g' WHEN 1 THEN 'v' WHEN 2 THEN 'U' WHEN 3 THEN 'c' END AS rc1,
  CASE o_orderkey % 13 WHEN 0 THEN 't' WHEN 1 THEN 'H' END AS rc2,
  cast(NULL AS string) AS rc3,
  cast(NULL AS string) AS rc4,
  cast(NULL AS string) AS rc5,
  CASE WHEN o_orderkey % 4 = 1 THEN '-' END AS rcand
FROM {orders}""", ("orders",)),

    "sub_req_ar": ("""
SELECT
  l.l_orderkey AS sub_int_seq_no,
  cast(row_number() OVER (PARTITION BY l.l_orderkey
                          ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
                                   l.l_extendedprice, l.l_shipdate) AS int) AS user_seq_no,
  CASE WHEN l.l_linenumber = 7 THEN 'R' || cast((l.l_suppkey % 30) * 5 AS string)
       WHEN l.l_linenumber <= 2 THEN i.subject || ' ' || i.catalog_nbr
       WHEN l.l_linenumber = 3 THEN i.subject
       WHEN l.l_linenumber = 4 THEN i.subject || ' ***'
       WHEN l.l_linenumber = 5 AND l.l_orderkey % 997 = 1 THEN '*** ***'
       WHEN l.l_linenumber = 5 AND l.l_suppkey % 11 = 0 THEN '*' || substr(i.subject, 2, 2) || ' ' || i.catalog_nbr
       WHEN l.l_linenumber = 5 AND l.l_suppkey % 11 = 1 THEN '**' || substr(i.subject, 3, 1) || ' 1**'
       WHEN l.l_linenumber = 5 THEN i.subject || ' ' || cast(1 + i.p_size % 6 AS string) || '**'
       ELSE 'PSEUDO' END AS course,
  CASE WHEN l.l_suppkey % 7 = 0 THEN 'T' END AS tflg,
  CASE WHEN l.l_suppkey % 7 = 0 THEN 'M' END AS ctitle,
  CASE WHEN l.l_suppkey % 9 = 8 THEN 'P' END AS crsflag,
  CASE WHEN l.l_linenumber = 1 AND l.l_returnflag = 'N' THEN 'R'
       WHEN l.l_linenumber = 2 AND l.l_returnflag = 'N' AND l.l_linestatus = 'F' THEN NULL
       ELSE 'A' END AS ar_type,
  CASE WHEN l.l_linenumber = 7 THEN 'L'
       WHEN l.l_linenumber = 6 AND l.l_returnflag = 'R' THEN '$'
       WHEN l.l_linenumber = 6 THEN 'N'
       WHEN l.l_linenumber = 3 AND l.l_returnflag = 'A' AND l.l_linestatus = 'F' THEN '!' END AS matchctl,
  CASE WHEN l.l_suppkey % 10 = 0 THEN 'H' END AS ac,
  CASE WHEN l.l_suppkey % 10 = 1 THEN 'Q' END AS rc
FROM {lineitem} l JOIN {d_item} i ON l.l_partkey = i.p_partkey""", ("lineitem", "d_item")),

    "dprog": ("""
SELECT
  'Q' AS instidq,
  'I' AS instid,
  'UNI' AS instcd,
  'P' || cast(n_nationkey AS string) AS dprog,
  cast(1995 + y AS string) || '7' AS dpfyt,
  CASE WHEN n_nationkey % 8 = 0 THEN 'Mapp x'
       WHEN n_nationkey % 8 = 1 THEN 'TAG'
       WHEN n_nationkey % 8 = 2 THEN NULL
       ELSE 'C' || cast(n_regionkey AS string) END AS college
FROM (
    """ + _union_all("SELECT n_nationkey, n_regionkey, {y} AS y FROM {{nation}}", "y", range(6)) + """
) n""", ("nation",)),

    "dprog_req": ("""
SELECT
  'Q' AS instidq,
  'I' AS instid,
  'UNI' AS instcd,
  'P' || cast(c_nationkey AS string) AS dprog,
  cast(1995 + c_custkey % 6 AS string) || '7' AS dpfyt,
  'R' || cast(c_custkey AS string) AS dprname,
  c_custkey * 2 + k AS int_seq_no,
  CASE WHEN c_custkey % 4 = 0 THEN 'B' ELSE 'A' END AS category
FROM (
    SELECT c_custkey, c_nationkey, 0 AS k FROM {customer} WHERE c_custkey % 3 <> 0
    UNION ALL
    SELECT c_custkey, c_nationkey, 1 AS k FROM {customer} WHERE c_custkey % 3 <> 0
) c""", ("customer",)),
}


def _closure(names) -> list[str]:
    """Derived views needed by ``names``, inputs first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in BASE_TABLES or name in order:
            return
        for dep in VIEWS[name][1]:
            visit(dep)
        order.append(name)

    for n in names:
        visit(n)
    return order


class Domain:
    """The base and derived tables of one data folder, as views: reading one starts no job.

    ``load`` writes derived tables once as parquet under the session's
    checkpoint folder; from then on they are scanned like source tables.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._frames:
                if name in BASE_TABLES:
                    df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
                else:
                    text, deps = VIEWS[name]
                    df = self.spark.sql(text, **{d: self[d] for d in deps})
                self._frames[name] = df
            return self._frames[name]

    def load(self, *names: str) -> "Domain":
        """Store the named derived tables (default: all), inputs first."""
        from coursematch.config import checkpoint_dir
        folder = f"{checkpoint_dir(self.spark).rstrip('/')}/domain-{uuid.uuid4().hex}"
        with self._lock:
            for n in _closure(names or VIEWS):
                self[n].write.mode("overwrite").parquet(f"{folder}/{n}")
                self._frames[n] = self.spark.read.parquet(f"{folder}/{n}")
                for other, (_, deps) in VIEWS.items():
                    if n in deps:
                        self._frames.pop(other, None)
        return self


@lru_cache(maxsize=8)
def _domain(spark: SparkSession, sf_dir: str) -> Domain:
    return Domain(spark, sf_dir)


def domain(spark: SparkSession, sf_dir: str) -> Domain:
    """Shared ``Domain`` per (session, folder)."""
    return _domain(spark, sf_dir)
