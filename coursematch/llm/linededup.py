"""Repeated passages of lines: overlapping three-line windows, found globally by hash."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursematch.llm.common import Store

WINDOW = 3


def _windows(batches):
    for batch in batches:
        ids, bodies, at, keys = [], [], [], []
        for doc, body, text in zip(batch.column("doc_id").to_pylist(), batch.column("body").to_pylist(), batch.column("text")):
            lines = [hashlib.blake2b(x, digest_size=16).digest() for x in text.as_py().encode().split(b"\n")]
            for i in range(len(lines) - WINDOW + 1):
                ids.append(doc)
                bodies.append(body)
                at.append(i)
                keys.append(hashlib.blake2b(b"".join(lines[i: i + WINDOW]), digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bodies, pa.int64()), pa.array(at, pa.int32()), pa.array(keys, pa.binary())], ["doc_id", "body", "at", "key"])


def _cut(batches):
    for batch in batches:
        n_lines, removed, kept = [], [], []
        for text, starts in zip(batch.column("text"), batch.column("starts").to_pylist()):
            lines = [] if text.as_py() is None else text.as_py().split("\n")
            gone = {s + j for s in starts or () for j in range(WINDOW)}
            n_lines.append(len(lines))
            removed.append(len(gone))
            kept.append(None if text.as_py() is None else "\n".join(x for i, x in enumerate(lines) if i not in gone))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                         ["doc_id", "n_lines", "n_removed", "text"])


def drop_repeated_lines(documents: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_removed, text) for every row: its text without passages that stand earlier.

    Lines end at line feeds. Every run of three consecutive lines is a window; its first occurrence is the
    one with the smallest doc_id, then the smallest line. All lines that later occurrences cover go
    (windows are judged on the input), the others stay in order. A text of fewer than three lines has no
    window. A null text has no lines and stays null. Rows are told apart by doc_id and text: repeated rows are
    the same document, none is later than another, and each comes back; of different texts with one doc_id,
    the occurrence at the smaller line is the earlier one, and at the same line none is. Rows without a doc_id are neither searched nor cut.
    Other columns are not read. Keys are 128-bit hashes of whole lines.
    """
    store = Store(documents.sparkSession, "lines")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("body"))
    windows = store.put(docs.where("doc_id is not null and text is not null").mapInArrow(_windows, "doc_id long, body long, at int, key binary"), "windows")
    place = F.struct("doc_id", "at")
    repeated = windows.groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "first")
    later = windows.join(repeated, "key").where(place != F.col("first")).groupBy("doc_id", "body").agg(F.collect_set("at").alias("starts"))
    return docs.join(later, ["doc_id", "body"], "left").mapInArrow(_cut, "doc_id long, n_lines long, n_removed long, text string")
