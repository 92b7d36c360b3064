"""Explicit schemas of the source and result tables (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql.types import (DateType, DecimalType, IntegerType, LongType, StringType, StructField,
                               StructType)

S, I, D = StringType(), IntegerType(), DateType()
N = DecimalType(10, 2)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, typ, True) for name, typ in fields])


PS_CRSE_OFFER = _schema(("crse_id", S), ("effdt", D), ("subject", S), ("catalog_nbr", S),
                        ("schedule_print", S))
PS_CRSE_CATALOG = _schema(("crse_id", S), ("effdt", D), ("eff_status", S), ("rqmnt_designtn", S),
                          ("units_minimum", N), ("units_maximum", N))
REQ_MAIN = _schema(*[(c, S) for c in ("instidq", "instid", "instcd", "rname", "rqfyt", "lyt", "rtitle1",
                                       "rqtype", "ac1", "ac2", "rc1", "rc2")])
SUB_REQ = _schema(("instidq", S), ("instid", S), ("instcd", S), ("rname", S), ("rqfyt", S),
                  ("int_seq_no", LongType()), ("user_seq_no", I), ("grp", S),
                  ("grpmin", N), ("grpmax", N), ("hcmin", N), ("hcmax", N),
                  *[(c, S) for c in ("ac1", "ac2", "ac3", "ac4", "ac5", "acor",
                                     "rc1", "rc2", "rc3", "rc4", "rc5", "rcand")])
SUB_REQ_AR = _schema(("sub_int_seq_no", LongType()), ("user_seq_no", I),
                     *[(c, S) for c in ("course", "tflg", "ctitle", "crsflag", "ar_type", "matchctl",
                                        "ac", "rc")])
DPROG_REQ = _schema(("instidq", S), ("instid", S), ("instcd", S), ("dpfyt", S), ("dprname", S),
                    ("dprog", S), ("category", S), ("int_seq_no", LongType()))
DPROG = _schema(*[(c, S) for c in ("instidq", "instid", "instcd", "dprog", "dpfyt", "college")])
TABLES = {
    "ps_crse_offer": PS_CRSE_OFFER,
    "ps_crse_catalog": PS_CRSE_CATALOG,
    "req_main": REQ_MAIN,
    "sub_req": SUB_REQ,
    "sub_req_ar": SUB_REQ_AR,
    "dprog_req": DPROG_REQ,
    "dprog": DPROG,
}
